"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens that no piece of the model crosses. Pre-tokens not
seen before are held as ragged numpy arrays of symbols, and in each round every
sequence merges its lowest-rank pair, all sequences at once; the symbols that
survive are counted.

Defined results: a null or empty text has no tokens; rows are independent, so
repeated rows give repeated rows; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NEVER = np.int64(1 << 40)


class Merges:
    """The pairs of symbols that the model merges, and the ranks of what they give."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        pieces = [sp.id_to_piece(i) for i in plain]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece of this model crosses a word's start")
        order = np.unique([-sp.get_score(i) for i in plain], return_inverse=True)[1]
        self.fallback = any(sp.is_byte(i) for i in range(n))
        self.prefix = len(sp.encode("a")) != 0 and sp.encode_as_pieces("a")[0].startswith(SPACE)
        symbols = {p: k for k, p in enumerate(pieces)}
        for c in sorted({c for p in pieces for c in p}):
            symbols.setdefault(c, len(symbols))
        self.other = len(symbols)  # any character that no piece has
        #: Tokens that a symbol left at the end stands for; -1: its bytes.
        self.weight = np.array([1 if s in range(len(pieces)) else (len(c.encode()) if self.fallback else 1) for c, s in symbols.items()] + [-1], np.int64)
        self.char = np.full(0x110000, self.other, np.int32)
        for s, k in symbols.items():
            if len(s) == 1:
                self.char[ord(s)] = k
        keys, ranks, into = [], [], []
        for k, p in enumerate(pieces):
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * (self.other + 1) + b)
                    ranks.append(order[k])
                    into.append(k)
        by = np.argsort(keys, kind="stable")
        self.keys = np.append(np.array(keys, np.int64)[by], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array(ranks, np.int64)[by], NEVER)
        self.into = np.append(np.array(into, np.int64)[by], -1)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a * np.int64(self.other + 1) + b
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NEVER), np.where(hit, self.into[at], -1)

    def count(self, words: list[str]) -> np.ndarray:
        """The tokens of each word; a word's symbols merge with each other only."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        sym = self.char[points].astype(np.int64)
        seq = np.repeat(np.arange(len(words)), lengths)
        total = np.zeros(len(words), np.int64)
        bytes_of = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        alone = sym == self.other
        np.add.at(total, seq[alone], bytes_of[alone] if self.fallback else 1)
        if not self.fallback and alone.any():  # neighbouring unknown characters are one token
            again = alone[1:] & alone[:-1] & (seq[1:] == seq[:-1])
            np.subtract.at(total, seq[1:][again], 1)
        sym = np.where(alone, -1, sym)  # in no pair; counted already
        rank, into = self._pairs(sym, seq)
        while len(sym):
            # What belongs to words without a pair is counted and leaves.
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            live = np.repeat(least < NEVER, sizes)
            done = ~live & (sym >= 0)
            np.add.at(total, seq[done], self.weight[sym[done]])
            if not live.any():
                break
            least = np.repeat(least, sizes)[live]
            sym, seq, rank, into = sym[live], seq[live], rank[live], into[live]
            chosen = self._leftmost(rank == least, sym, seq, least, into)
            sym = np.where(chosen, into, sym)
            keep = np.r_[True, ~chosen[:-1]]
            near = chosen | np.r_[chosen[1:], False] | np.r_[False, False, chosen[:-2]][: len(chosen)] | np.r_[False, chosen[:-1]]
            near = (near | np.r_[False, near[:-1]] | np.r_[near[1:], False])[keep]
            sym, seq, rank, into = sym[keep], seq[keep], rank[keep], into[keep]
            self._renew(sym, seq, rank, into, near)
        return total

    def _pairs(self, sym: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, into = np.full(len(sym), NEVER), np.full(len(sym), -1, np.int64)
        self._renew(sym, seq, rank, into, np.ones(len(sym), bool))
        return rank, into

    def _renew(self, sym, seq, rank, into, where) -> None:
        """Looks up the pairs that begin at the given places again."""
        at = np.flatnonzero(where)
        rank[at], into[at] = NEVER, -1
        at = at[at < len(sym) - 1]
        at = at[(seq[at] == seq[at + 1]) & (sym[at] >= 0) & (sym[at + 1] >= 0)]
        rank[at], into[at] = self.look(sym[at], sym[at + 1])

    def _leftmost(self, best, sym, seq, least, into) -> np.ndarray:
        """Of the places of each word's lowest-rank pair, those to merge now.

        From the left, none that overlaps one merged before it, and none after a
        merge whose new neighbours give a pair of lower rank, which comes first.
        """
        at = np.flatnonzero(best)
        run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        offset = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
        at = at[offset % 2 == 0]
        new = into[at]
        joined = np.r_[False, (np.diff(at) == 2)]  # the symbol on the left was merged just now
        left = np.where(joined, np.r_[-1, new[:-1]], sym[at - 1])
        has_left = (at > 0) & (seq[at - 1] == seq[at]) & (left >= 0)
        after = np.minimum(at + 2, len(sym) - 1)
        has_right = (at + 2 < len(sym)) & (seq[after] == seq[at]) & (sym[after] >= 0)
        lower = np.zeros(len(at), bool)
        for has, a, b in ((has_left, left, new), (has_right, new, sym[after])):
            k = np.flatnonzero(has)
            lower[k] |= self.look(a[k], b[k])[0] < least[at[k]]
        if lower.any():
            before = np.cumsum(lower) - lower
            first = np.r_[True, seq[at[1:]] != seq[at[:-1]]]
            base = before[np.flatnonzero(first)][np.cumsum(first) - 1]
            at = at[before == base]
        chosen = np.zeros(len(sym), bool)
        chosen[at] = True
        return chosen


class Counter:
    """Counts of texts, with the counts of up to ``limit`` short pre-tokens kept."""

    ROOM = 4_000_000  # characters that are counted together

    def __init__(self, model: bytes, limit: int = 1_000_000):
        self.merges, self.limit = Merges(model), limit
        self.known: dict[str, int] = {}
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def split(self, text: str) -> list[str]:
        """Pre-tokens; where it begins a word, the space before it stays implied only in the key."""
        if not text:
            return []
        if self.merges.prefix and "  " not in text and SPACE not in text and "\0" not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return ["\0" + w for w in self.words((SPACE if self.merges.prefix else "") + text.replace(" ", SPACE))]

    def counts(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        todo: list[list[str]] = []
        room = 0
        for text in texts:
            todo.append(self.split(text))
            room += len(text)
            if room > self.ROOM:
                out += self._counted(todo)
                todo, room = [], 0
        return out + self._counted(todo)

    def _counted(self, split: list[list[str]]) -> list[int]:
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        got = {}
        if new:
            full = [w[1:] if w[:1] == "\0" else SPACE + w for w in new]
            got = dict(zip(new, self.merges.count(full).tolist(), strict=True))
            room = max(0, self.limit - len(known))
            known.update([(w, n) for w, n in got.items() if len(w) <= 48][:room])
        if all(w in known for w in got):
            return [sum(map(known.__getitem__, words)) for words in split]
        return [sum([known[w] if w in known else got[w] for w in words]) for words in split]


_COUNTERS: dict[str, Counter] = {}


def counter(model: bytes) -> Counter:
    key = hashlib.sha256(model).hexdigest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(model)
    return _COUNTERS[key]


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` of every row; texts are never shuffled."""
    with open(model_path or public_tokenizers.path(MODEL), "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model.value)
        for batch in batches:
            n = count.counts([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    out = rows.mapInArrow(work, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens, and whether it has more than 4096 tokens."""
    return count_tokens(table(spark, sf_dir, "documents"))
