"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, collocations, image_copies, lexical_search, license_scan, line_dedup, ngram_join, packing, quality, source_mix, token_counts, token_files, vector_links


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe_codec": bpe_codec.op1_bpe_codec,
        "op5_source_mix": source_mix.op5_source_mix,
        "op9_license_scan": license_scan.op9_license_scan,
        "op6_ngram_join": ngram_join.op6_ngram_join,
        "op2_vector_links": vector_links.op2_vector_links,
        "op3_quality": quality.op3_quality,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op10_image_copies": image_copies.op10_image_copies,
        "op7_token_files": token_files.op7_token_files,
        "op4_token_counts": token_counts.op4_token_counts,
        "op11_collocations": collocations.op11_collocations,
        "op12_packing": packing.op12_packing,
        "op13_lexical_search": lexical_search.op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_source_mix": source_mix.OP5_SQL,
        "op8_line_dedup": line_dedup.OP8_SQL,
        "op9_license_scan": license_scan.OP9_SQL,
        "op11_collocations": collocations.OP11_SQL,
        "op13_lexical_search": lexical_search.OP13_SQL,
    }
