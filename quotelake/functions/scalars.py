"""Scalar functions as column expressions; all tolerate nulls and malformed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(38,18)"
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

# Fixed values of the archive format.
SIDES = {"buy": 1, "bid": 1, "bids": 1, "yes": 1, "sell": 2, "ask": 2, "asks": 2, "no": 2}
ACTIONS = {"set": 1, "absolute": 1, "update": 1, "delete": 2, "remove": 2, "reset": 3, "delta": 4, "add": 4}
SNAPSHOTS = {"exchange": 1, "initial": 1, "recovery": 2, "reconciliation": 3, "closing": 4, "checkpoint": 5}
ENTITIES = {"market": 1, "token": 2}
KEY_PREFIX = "archive-v2"  # a deployment that reads keys made elsewhere passes the prefix they were made with


def as_decimal(text: Column) -> Column:
    """A number that the type holds exactly, else null: excess digits are never rounded."""
    clean = F.trim(text)
    number = F.regexp_replace(clean, r"[eE].*$", "")
    power = F.when(clean.rlike("[eE]"), F.regexp_extract(clean, r"[eE]([+-]?\d+)$", 1).try_cast("int")).otherwise(0)
    after = F.length(F.regexp_extract(number, r"\.(\d*?)0*$", 1))
    spare = F.length(F.regexp_extract(number, r"(0*)(\.0*)?$", 1))
    places = F.when(after > 0, after).otherwise(-spare) - power
    return F.when(F.coalesce(places <= 18, F.lit(True)), clean.try_cast(NUMBER))


def as_int(text: Column) -> Column:
    """Text of digits with an optional sign, else null."""
    clean = F.trim(text)
    return F.when(clean.rlike(r"^[+-]?\d+$"), clean.try_cast("bigint"))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts)


def from_micros(n: Column) -> Column:
    return F.timestamp_add("MICROSECOND", n, F.expr(EPOCH))


def parse_timestamp(text: Column) -> Column:
    """ISO text (UTC unless it has an offset) or an epoch number in s, ms, µs or ns by its size."""
    n = F.trim(text).try_cast(NUMBER)
    size = F.abs(n)
    scaled = F.when(size >= F.lit(10**18), F.floor(n / 1000)).when(size >= F.lit(10**15), F.floor(n)).when(size >= F.lit(10**12), F.floor(n * 1000)).otherwise(F.floor(n * 1_000_000))
    zoned = F.concat(F.regexp_replace(F.trim(text), r"(Z|[+-]\d\d:?\d\d)$", ""))
    offset = F.regexp_extract(F.trim(text), r"T.*([+-])(\d\d):?(\d\d)$", 1)
    minutes = F.regexp_extract(F.trim(text), r"T.*[+-](\d\d):?(\d\d)$", 1).try_cast("int") * 60 + F.regexp_extract(F.trim(text), r"T.*[+-]\d\d:?(\d\d)$", 1).try_cast("int")
    shift = F.when(offset == "+", -minutes).when(offset == "-", minutes).otherwise(0)
    iso = F.timestamp_add("MINUTE", shift, zoned.try_cast("timestamp_ntz"))
    return F.coalesce(from_micros(scaled.cast("bigint")), iso)


def loose_bool(text: Column) -> Column:
    """Numbers: not 0; other text: true only for true, 1 or yes; null stays null."""
    n = text.try_cast("double")
    return F.when(n.isNotNull(), n != 0).otherwise(F.lower(F.trim(text)).isin("true", "1", "yes"))


def json_list(text: Column) -> Column:
    """The strings of a JSON list, else an empty array."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def canonical_json(text: Column) -> Column:
    """Keys sorted, no blanks; numbers in their shortest form."""
    return F.to_json(F.try_parse_json(text))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def stable_key(kind: str, external_id: Column, prefix: str = KEY_PREFIX) -> Column:
    """63 bits of a digest; never 0."""
    digest = F.sha2(F.concat(F.lit(f"{prefix}\0{kind}\0"), external_id.cast("string")), 256)
    top = F.conv(F.substring(digest, 1, 1), 16, 10).cast("int").bitwiseAND(7)
    key = F.conv(F.concat(top.cast("string"), F.substring(digest, 2, 15)), 16, 10).cast("bigint")
    return F.when(key == 0, 1).otherwise(key)


def code(text: Column, codes: dict[str, int]) -> Column:
    """The code of a name, null for an unknown one."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(text))).cast("tinyint")


def decimal_split(text: Column) -> tuple[Column, Column]:
    """Exact mantissa and scale of decimal text, also with an exponent; null if either doesn't fit 64 and 8 bits."""
    clean = F.trim(text)
    fine = clean.rlike(r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$")
    number = F.regexp_replace(clean, r"[eE].*$", "")
    power = F.when(clean.rlike("[eE]"), F.regexp_extract(clean, r"[eE]([+-]?\d+)$", 1).try_cast("int")).otherwise(0)
    scale = F.length(F.regexp_extract(number, r"\.(\d*)$", 1)) - power
    mantissa = F.replace(number, F.lit("."), F.lit("")).try_cast("bigint")
    fits = fine & mantissa.isNotNull() & scale.between(-128, 127)
    return F.when(fits, mantissa), F.when(fits, scale).cast("tinyint")


def decimal_join(mantissa: Column, scale: Column) -> Column:
    return F.concat(mantissa.cast("string"), F.lit("E"), (-scale.cast("int")).cast("string")).try_cast(NUMBER)


def plain_number(number: Column) -> Column:
    """Decimal text without trailing zeros or a bare point."""
    text = number.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def trade_fingerprint(exchange: Column, market: Column, outcome: Column, ts: Column, price: Column, size: Column, side: Column, trade_id: Column) -> Column:
    """A digest that equal trades share however their numbers and names are spelt."""
    parts = [F.lower(exchange), market.cast("string"), outcome.cast("string"), micros(ts).cast("string"), plain_number(price), plain_number(size), F.lower(side), trade_id.cast("string")]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def request_params(url: Column) -> Column:
    """An array of (key, value) of the query part; blank values are kept."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    part = lambda p, i: F.try_url_decode(F.coalesce(F.get(F.split(p, "=", 2), F.lit(i)), F.lit("")))
    return F.transform(pairs, lambda p: F.struct(part(p, 0).alias("key"), part(p, 1).alias("value")))


def score_split(text: Column) -> tuple[Column, Column]:
    """The two sides of ``a-b`` as decimals."""
    parts = F.split(text, "-", 2)
    return F.get(parts, F.lit(0)).try_cast("decimal(18,6)"), F.get(parts, F.lit(1)).try_cast("decimal(18,6)")


def keep_sample(digest: Column, rate: float) -> Column:
    """Whether a digest falls in the first ``rate`` of all; the same in every run."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") < F.lit(int(rate * (1 << 60)))


def length_key(*parts: Column) -> Column:
    return F.concat(*[F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")) for p in parts])


def first_present(payload: Column, *paths: str) -> Column:
    """The first key of a JSON object that is there and not null; empty text counts."""
    return F.coalesce(*[F.get_json_object(payload, f"$.{p}") for p in paths])


def nested_id(payload: Column) -> Column:
    """A list's first entry; of an object its id, ticker or slug; a scalar as text; empty: null."""
    listed = F.get(F.from_json(payload, "array<string>"), F.lit(0))
    one = F.when(F.trim(payload).startswith("["), listed).otherwise(payload)
    found = F.coalesce(*[F.get_json_object(one, f"$.{k}") for k in ("id", "ticker", "slug")])
    out = F.when(F.trim(one).startswith("{"), found).otherwise(one)
    return F.when(out != "", out)


def dict_list(payload: Column) -> Column:
    """An object as a list of one; of a list only its objects, as JSON text."""
    listed = F.filter(F.from_json(payload, "array<string>"), lambda x: F.trim(x).startswith("{"))
    return F.when(F.trim(payload).startswith("{"), F.array(payload)).otherwise(F.coalesce(listed, F.array().cast("array<string>")))


def selectors(external_id: Column, exchange: str, *others: Column) -> Column:
    """All names under which a market may be listed."""
    names = F.array(external_id, F.concat(F.lit(exchange + ":"), external_id), *others)
    return F.array_distinct(F.array_compact(names))


def keep_keys(payload: Column, *keys: str) -> Column:
    """A JSON object reduced to the named keys; nulls are left out."""
    return F.to_json(F.struct(*[F.get_json_object(payload, f"$.{k}").alias(k) for k in keys]))
