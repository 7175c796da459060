"""Queries over the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from .q_book import real
from .registry import family
from .standins import table, view, with_views

Q, SQL, query = family()


TEXT = "CASE event_id % 6 WHEN 0 THEN CAST(CAST(value AS DECIMAL(18, 2)) AS {t}) WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN concat(' ', CAST(event_id AS {t}), ' ') WHEN 4 THEN '1.5' END"


def texts(spark, d):
    return table(spark, d, "events").withColumn("raw", F.expr(TEXT.replace("{t}", "STRING")))


DUCK_TEXT = "WITH r AS (SELECT *, " + TEXT.replace("{t}", "VARCHAR") + " AS raw FROM events) "


@query("s1_as_decimal", DUCK_TEXT + "SELECT event_id, try_cast(trim(raw) AS DECIMAL(38, 18))::VARCHAR AS number FROM r")
def _(spark, d):
    return texts(spark, d).withColumn("number", s.as_decimal(F.col("raw"))).select("event_id", F.col("number").cast("decimal(38,18)").cast("string").alias("number"))


@query("s2_as_int", DUCK_TEXT + r"SELECT event_id, CASE WHEN regexp_matches(trim(raw), '^[+-]?\d+$') THEN try_cast(trim(raw) AS BIGINT) END AS number FROM r")
def _(spark, d):
    return texts(spark, d).select("event_id", s.as_int(F.col("raw")).alias("number"))


@query(
    "s3_parse_timestamp",
    """WITH r AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') WHEN 1 THEN (epoch_us(ts) // 1000000)::VARCHAR WHEN 2 THEN (epoch_us(ts) // 1000)::VARCHAR
    WHEN 3 THEN epoch_us(ts)::VARCHAR WHEN 4 THEN (epoch_us(ts) * 1000)::VARCHAR ELSE 'soon' END AS raw, ts FROM events)
    SELECT event_id, raw, CASE event_id % 6 WHEN 1 THEN to_timestamp(epoch_us(ts) // 1000000)::TIMESTAMPTZ AT TIME ZONE 'UTC' WHEN 2 THEN epoch_ms(epoch_us(ts) // 1000) WHEN 5 THEN NULL ELSE ts END::TIMESTAMP AS parsed FROM r""",
)
def _(spark, d):
    us = s.micros(F.col("ts"))
    kind = F.col("event_id") % 6
    raw = F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).when(kind == 1, F.expr("x div 1000000").cast("string")).when(kind == 2, F.expr("x div 1000").cast("string")).when(kind == 3, F.col("x").cast("string")).when(kind == 4, (F.col("x") * 1000).cast("string")).otherwise("soon")
    return table(spark, d, "events").withColumn("x", us).select("event_id", raw.alias("raw")).withColumn("parsed", s.parse_timestamp(F.col("raw")))


@query("s5_loose_bool", "WITH r AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'True' WHEN 1 THEN '0' WHEN 2 THEN 'yes' WHEN 3 THEN 'on' WHEN 4 THEN '2.5' END AS raw FROM events) SELECT event_id, CASE event_id % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false WHEN 4 THEN true END AS flag FROM r")
def _(spark, d):
    raw = F.expr("CASE event_id % 6 WHEN 0 THEN 'True' WHEN 1 THEN '0' WHEN 2 THEN 'yes' WHEN 3 THEN 'on' WHEN 4 THEN '2.5' END")
    return table(spark, d, "events").select("event_id", s.loose_bool(raw).alias("flag"))


@query("s6_json_list", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type || ',' || user_id ELSE '' END AS listed FROM events")
def _(spark, d):
    raw = F.expr("CASE event_id % 3 WHEN 0 THEN concat('[\"', event_type, '\", \"', user_id, '\"]') WHEN 1 THEN 'nope' END")
    return table(spark, d, "events").select("event_id", F.array_join(s.json_list(raw), ",").alias("listed"))


@query("s7_s8_content_hash", "SELECT event_id, sha256('{\"a\":\"' || event_type || '\",\"b\":' || user_id || '}') AS digest FROM events")
def _(spark, d):
    """Equal objects with keys in another order and with blanks have one digest."""
    raw = F.concat(F.lit('{ "b" : '), F.col("user_id").cast("string"), F.lit(', "a": "'), F.col("event_type"), F.lit('"}'))
    return table(spark, d, "events").select("event_id", s.content_hash(s.canonical_json(raw)).alias("digest"))


@query("s9_stable_key", f"WITH h AS (SELECT event_id, sha256('{s.KEY_PREFIX}' || chr(0) || 'market' || chr(0) || event_id) AS d FROM events) SELECT event_id, ('0x' || (('0x' || d[1])::INT & 7) || d[2:16])::BIGINT AS archive_key FROM h")
def _(spark, d):
    return table(spark, d, "events").select("event_id", s.stable_key("market", F.col("event_id")).alias("archive_key"))


@query("s10_code_maps", "SELECT event_id, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 4 END AS side_code, event_id % 4 + 1 AS action_code FROM (SELECT event_id, event_type FROM events)".replace("WHEN 'view' THEN 2 WHEN 'click' THEN 4 END", "WHEN 'view' THEN 2 END").replace("event_id % 4 + 1 AS", "(event_id % 4 + 1)::INT AS"))
def _(spark, d):
    name = F.expr("CASE event_type WHEN 'signup' THEN 'Bids' WHEN 'view' THEN 'NO' ELSE 'other' END")
    action = F.element_at(F.array(*map(F.lit, ("update", "remove", "reset", "add"))), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", s.code(name, s.SIDES).cast("int").alias("side_code"), s.code(action, s.ACTIONS).cast("int").alias("action_code"))


@query("s11_s12_decimal_codes", "WITH r AS (SELECT event_id, value::DECIMAL(18, 2) AS v FROM events) SELECT event_id, (v * 100)::BIGINT AS mantissa, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 4 END AS scale, round(CASE WHEN event_id % 2 = 0 THEN v ELSE v / 100 END::DOUBLE, 6) AS joined FROM r")
def _(spark, d):
    text = F.col("value").cast("decimal(18,2)").cast("string")
    mantissa, scale = s.decimal_split(F.when(F.col("event_id") % 2 == 0, text).otherwise(F.concat(text, F.lit("E-2"))))
    rows = table(spark, d, "events").select("event_id", mantissa.alias("mantissa"), scale.cast("int").alias("scale"))
    return rows.withColumn("joined", s.decimal_join(F.col("mantissa"), F.col("scale"))).select("event_id", "mantissa", "scale", *real("joined"))


@query("s13_ts_ns", "SELECT event_id, epoch_us(ts) * 1000 AS ts_ns FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", (s.micros(F.col("ts")) * 1000).alias("ts_ns"))


@query("s14_trade_fingerprint", with_views("md_trades", "SELECT trade_id, sha256('pm|' || market || '|' || token || '|' || epoch_us(executed_at) || '|' || rtrim(rtrim(price::VARCHAR, '0'), '.') || '|' || rtrim(rtrim(size::VARCHAR, '0'), '.') || '|' || side || '|' || trade_id) AS fingerprint FROM md_trades"))
def _(spark, d):
    c = F.col
    return view(spark, d, "md_trades").select("trade_id", s.trade_fingerprint(F.lit("PM"), c("market"), c("token"), c("executed_at"), c("price"), c("size"), F.upper("side"), c("trade_id")).alias("fingerprint"))


@query("s15_request_params", r"WITH q AS (SELECT page_id, unnest(string_split(regexp_extract(url, '\?([^#]*)', 1), '&')) AS p FROM pages) SELECT page_id, string_split(p, '=')[1] AS key, coalesce(string_split(p, '=')[2], '') AS value FROM q WHERE p <> ''")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", F.inline(s.request_params(F.col("url"))))


@query("s17_score_split", "SELECT event_id, round((user_id % 7)::DOUBLE, 6) AS home, CASE WHEN event_id % 5 <> 0 THEN round((event_id % 9)::DOUBLE, 6) END AS away FROM events")
def _(spark, d):
    text = F.expr("CASE WHEN event_id % 5 = 0 THEN concat(user_id % 7, '-x') ELSE concat(user_id % 7, '-', event_id % 9) END")
    home, away = s.score_split(text)
    return table(spark, d, "events").select("event_id", home.alias("home"), away.alias("away")).select("event_id", *real("home", "away"))


@query("s18_hash_sample", "SELECT event_id FROM events WHERE ('0x' || sha256(event_id::VARCHAR)[1:15])::BIGINT < (0.05 * 1152921504606846976)::BIGINT")
def _(spark, d):
    return table(spark, d, "events").where(s.keep_sample(s.content_hash(F.col("event_id").cast("string")), 0.05)).select("event_id")


@query("s19_length_key", "SELECT event_id, length(event_type) || ':' || event_type || length(user_id::VARCHAR) || ':' || user_id AS stream_key FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", s.length_key(F.col("event_type"), F.col("user_id")).alias("stream_key"))


@query("s4_s16_first_ids", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS first_value, CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN event_type ELSE user_id::VARCHAR END AS nested FROM events")
def _(spark, d):
    payload = F.expr("CASE event_id % 3 WHEN 0 THEN '{\"a\":\"\",\"b\":1}' ELSE concat('{\"b\":\"', event_type, '\"}') END")
    nested = F.expr("CASE event_id % 3 WHEN 0 THEN '[]' WHEN 1 THEN concat('[{\"ticker\":\"', event_type, '\"}]') ELSE concat('{\"id\":', user_id, ',\"slug\":\"x\"}') END")
    return table(spark, d, "events").select("event_id", s.first_present(payload, "a", "b").alias("first_value"), s.nested_id(nested).alias("nested"))


@query("s20_selectors", "SELECT o_orderkey, 'm' || o_orderkey || ',pm:m' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN ',' || o_orderpriority ELSE '' END AS names FROM orders")
def _(spark, d):
    key = F.concat(F.lit("m"), F.col("o_orderkey").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(s.selectors(key, "pm", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))), ",").alias("names"))


@query("s22_dict_list", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END::INT AS n_objects FROM events")
def _(spark, d):
    payload = F.expr("CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN concat('[', props, ',3,', props, ']') ELSE '7' END")
    return table(spark, d, "events").select("event_id", F.size(s.dict_list(payload)).alias("n_objects"))
