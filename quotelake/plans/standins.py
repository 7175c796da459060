"""Stand-in views: the given tables in the shape of market data.

Each view has its SQL for Spark (``{table}`` stands for a table) and for DuckDB.
Where both engines read the same text, one is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "1998-01-15 00:00:00"
LAST = "2024-01-31 00:00:00"

_EVENTS = """
SELECT user_id AS token_key, ts, event_id AS seq, event_type, k, v,
       CASE WHEN event_type = 'signup' AND k < 50 THEN 0 ELSE 1 END AS kind,
       event_type = 'signup' AND k < 50 AND k % 5 = 0 AS is_recon,
       CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS side,
       CAST((CASE WHEN k % 2 = 0 THEN 30 ELSE 60 END + k % 10) * 0.01 AS DECIMAL(18, 6)) AS price,
       CASE event_type WHEN 'error' THEN 2 WHEN 'purchase' THEN 4 ELSE 1 END AS action,
       CAST(CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN v - 40 ELSE v END AS DECIMAL(18, 2)) AS x
FROM ev"""

_TRADES = """
SELECT concat('m', CAST(user_id % 50 AS {text})) AS market, user_id AS token, event_id AS trade_id, CAST((k + 1) / 101.0 AS DECIMAL(18, 6)) AS price,
       v AS size, CASE WHEN k % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, ts AS executed_at
FROM ev WHERE event_type = 'purchase'"""

_MARKETS = """
SELECT concat('m', CAST(o_orderkey AS {text})) AS external_id, o_orderkey, o_custkey AS event_id,
       o_orderstatus IN ('O', 'P') AS active, o_orderstatus = 'F' AS closed, false AS archived,
       o_orderstatus = 'O' OR o_orderpriority <> '5-LOW' AS accepting, o_orderkey % 7 <> 0 AS book,
       CAST(floor(o_totalprice / power(10, o_orderkey % 8)) AS DECIMAL(18, 2)) AS liquidity,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS DECIMAL(18, 2)) ELSE CAST(coalesce(price_sum, 0) % 1000 AS DECIMAL(18, 2)) END AS volume_24h,
       CASE WHEN o_orderkey % 2 = 1 THEN CAST(coalesce(discounts / lines, 0) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS spread,
       o_orderpriority = '1-URGENT' AS rewards, tokens, coalesce(n_tokens, 0) AS n_tokens, o_orderdate AS open_time, {close} AS close_time
FROM {orders} o LEFT JOIN li ON o.o_orderkey = li.l_orderkey"""

_POLLS = """
SELECT user_id AS market, ts AS observed_at, event_id AS seq, CASE WHEN k < 70 THEN 'active' ELSE event_type END AS status, v AS volume,
       CASE WHEN k % 4 = 0 THEN NULL ELSE ts - INTERVAL '1 hour' * (k % 3) END AS source_ts
FROM ev"""

_PRICES = """
SELECT event_type AS provider, user_id % 10 AS instrument, CASE WHEN k < 70 THEN 1 ELSE 2 + k % 2 END AS price, ts, event_id AS seq, k
FROM ev"""

_CONFIG = """
SELECT o_custkey AS scope_id, o_orderpriority AS cfg_type, o_orderdate AS effective_from, o_orderkey AS id,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1 day' * (o_orderkey % 60 + 1) END AS declared_to,
       o_orderkey % 4 AS setting
FROM {orders}"""

_OBJECTS = """
SELECT l_returnflag AS stream, CAST(l_shipdate AS DATE) AS date, CAST(round(l_extendedprice * 100) AS BIGINT) AS bytes, CAST(l_quantity AS BIGINT) AS n_rows, l_shipdate AS uploaded_at,
       row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS id
FROM {lineitem}"""

_PREVIOUS = """
SELECT concat('m', CAST(o_orderkey AS {text})) AS external_id, CASE WHEN o_orderkey % 11 = 0 THEN 'full' WHEN o_orderkey % 11 <= 3 THEN 'sampled' ELSE 'none' END AS tier,
       TIMESTAMP{ntz} '1998-01-15 00:00:00' - INTERVAL '1 minute' * (o_orderkey % 60) AS tier_since
FROM {orders}"""

_SPARK_EV = "WITH ev AS (SELECT *, CAST(get_json_object(props, '$.k') AS INT) AS k, CAST(value AS DECIMAL(18, 2)) AS v FROM {events})"
_DUCK_EV = "SELECT *, (props->>'$.k')::INT AS k, value::DECIMAL(18, 2) AS v FROM events"
_LI = "SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS price_sum, sum(CAST(l_discount AS DECIMAL(18, 2))) AS discounts, count(*) AS lines, {n_tokens} AS n_tokens, {tokens} AS tokens FROM {lineitem} GROUP BY l_orderkey"

# Line numbers are at most 7, so a set of them is an integer, which needs no object aggregate.
_BITS = "bit_or(shiftleft(1L, CAST(l_linenumber AS INT)))"

_SPARK = {
    "bk_events": f"{_SPARK_EV} {_EVENTS}",
    "md_trades": f"{_SPARK_EV} {_TRADES.replace('{text}', 'STRING')}",
    "mk_markets": "WITH li AS ("
    + _LI.replace("{tokens}", f"array_join(filter(sequence(0, 62), i -> shiftright({_BITS}, i) % 2 = 1), ',')").replace("{n_tokens}", f"CAST(bit_count({_BITS}) AS BIGINT)")
    + ") "
    + _MARKETS.replace("{text}", "STRING").replace("{close}", "o_orderdate + INTERVAL '20 days'").replace("discounts / lines", "CAST(discounts AS DOUBLE) / lines"),
    "md_polls": f"{_SPARK_EV} {_POLLS}",
    "ref_prices": f"{_SPARK_EV} {_PRICES}",
    "cfg_rows": _CONFIG,
    "mk_prev_tiers": _PREVIOUS.replace("{text}", "STRING").replace("{ntz}", "_NTZ"),
}

_DUCK = {
    "ev": _DUCK_EV,
    "bk_events": _EVENTS,
    "md_trades": _TRADES.replace("{text}", "VARCHAR"),
    "li": _LI.replace("{tokens}", "array_to_string(list_sort(list(DISTINCT l_linenumber)), ',')").replace("{n_tokens}", "count(DISTINCT l_linenumber)").replace("{lineitem}", "lineitem"),
    "mk_markets": _MARKETS.replace("{text}", "VARCHAR").replace("{close}", "o_orderdate + INTERVAL 20 DAY").replace("{orders}", "orders").replace("discounts / lines", "discounts::DOUBLE / lines"),
    "md_polls": _POLLS.replace("INTERVAL '1 hour' *", "INTERVAL 1 HOUR *"),
    "ref_prices": _PRICES,
    "cfg_rows": _CONFIG.replace("INTERVAL '1 day' *", "INTERVAL 1 DAY *").replace("{orders}", "orders"),
    "objects": _OBJECTS.replace("{lineitem}", "lineitem"),
    "mk_prev_tiers": _PREVIOUS.replace("{text}", "VARCHAR").replace("{ntz}", "").replace("INTERVAL '1 minute' *", "INTERVAL 1 MINUTE *").replace("{orders}", "orders"),
}
_NEEDS = {"bk_events": ["ev"], "md_trades": ["ev"], "md_polls": ["ev"], "ref_prices": ["ev"], "mk_markets": ["li"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view as a DataFrame."""
    text = _SPARK[name]
    tables = {t: table(spark, sf_dir, t) for t in ("events", "orders", "lineitem", "customer") if "{" + t + "}" in text}
    return spark.sql(text, **tables)


def with_views(names: str, sql: str) -> str:
    """DuckDB SQL with the named views (space-separated) as leading table expressions; ``sql`` begins with its own ones or SELECT."""
    need: list[str] = []
    for name in names.split():
        need += [n for n in [*_NEEDS.get(name, []), name] if n not in need]
    text = ", ".join(f"{n} AS ({_DUCK[n]})" for n in need)
    sql = sql.strip()
    return f"WITH RECURSIVE {text}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH RECURSIVE {text} {sql}"
