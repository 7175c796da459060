"""Queries over the history operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import from_micros, micros
from ..operators import history as h
from .q_book import exact
from .registry import family
from .standins import view, with_views

Q, SQL, query = family()


def versions(spark, d):
    polls = view(spark, d, "md_polls").withColumn("content", h.digest("status"))
    return h.scd2(polls, ["market"], ["observed_at", "seq"], "content", ["status", "volume"], ["source_ts"])


V = """c AS (SELECT *, row_number() OVER w AS rn, lag(status) OVER w AS old FROM md_polls WINDOW w AS (PARTITION BY market ORDER BY observed_at, seq)),
n AS (SELECT *, sum((rn = 1 OR status IS DISTINCT FROM old)::INT) OVER (PARTITION BY market ORDER BY observed_at, seq ROWS UNBOUNDED PRECEDING) AS version_number FROM c),
v AS (SELECT market, version_number, min(observed_at) AS valid_from, max(observed_at) AS last_observed_at, count(*) AS observations, any_value(status) AS status, arg_min(volume, (observed_at, seq)) AS volume, max(source_ts) AS source_ts FROM n GROUP BY ALL),
ver AS (SELECT *, lead(valid_from) OVER (PARTITION BY market ORDER BY version_number) AS valid_to FROM v)"""


def po(sql: str) -> str:
    return with_views("md_polls", sql)


@query("v1_metadata_digest", po("SELECT market, seq, sha256('=' || status) AS content FROM md_polls"))
def _(spark, d):
    return view(spark, d, "md_polls").select("market", "seq", h.digest("status").alias("content"))


@query("v2_scd2_history", po(f"WITH {V} SELECT market, version_number::BIGINT AS version_number, status, valid_from, valid_to, last_observed_at, observations, volume::DECIMAL(38, 6)::VARCHAR AS volume FROM ver"))
def _(spark, d):
    return versions(spark, d).select("market", "version_number", "status", "valid_from", "valid_to", "last_observed_at", "observations", *exact("volume"))


@query("v3_version_clock_merge", po(f"WITH {V} SELECT market, version_number::BIGINT AS version_number, source_ts FROM ver"))
def _(spark, d):
    return versions(spark, d).select("market", "version_number", "source_ts")


@query(
    "v4_stale_guard",
    po("WITH b AS (SELECT *, max(source_ts) OVER w AS top, max(observed_at) OVER w AS seen FROM md_polls WINDOW w AS (PARTITION BY market ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT market, seq, coalesce(CASE WHEN source_ts IS NOT NULL AND top IS NOT NULL THEN source_ts <= top ELSE observed_at <= seen END, false) AS stale FROM b"),
)
def _(spark, d):
    return h.mark_stale(view(spark, d, "md_polls"), ["market"], ["seq"], "source_ts", "observed_at").select("market", "seq", "stale")


@query("v5_sparse_patch", po("SELECT market, arg_max(status, seq) FILTER (status <> 'view') AS status, (arg_max(volume, seq) FILTER (seq % 2 = 0))::DECIMAL(38, 6)::VARCHAR AS volume FROM md_polls GROUP BY market"))
def _(spark, d):
    """Rows that each patch some fields, laid over each other."""
    rows = view(spark, d, "md_polls").select("market", "seq", F.when(F.col("status") != "view", F.col("status")).alias("status"), F.when(F.col("seq") % 2 == 0, F.col("volume")).alias("volume"))
    return h.merge_rows(rows, ["market"], ["seq"], ["status", "volume"]).select("market", "status", *exact("volume"))


CONFIG = "u AS (SELECT scope_id, cfg_type, effective_from, arg_max(setting, id) AS setting, max(id) AS id FROM cfg_rows GROUP BY ALL)"


def settings(spark, d):
    rows = view(spark, d, "cfg_rows")
    return rows.groupBy("scope_id", "cfg_type", "effective_from").agg(F.max_by("setting", "id").alias("setting"), F.max("id").alias("id"))


@query("v6_config_history", with_views("cfg_rows", f"WITH {CONFIG}, l AS (SELECT *, lag(setting) OVER w AS old, row_number() OVER w AS rn FROM u WINDOW w AS (PARTITION BY scope_id, cfg_type ORDER BY effective_from)) SELECT scope_id, cfg_type, effective_from, setting, id FROM l WHERE rn = 1 OR setting IS DISTINCT FROM old"))
def _(spark, d):
    return h.drop_unchanged(settings(spark, d), ["scope_id", "cfg_type"], ["effective_from"], "setting").select("scope_id", "cfg_type", "effective_from", "setting", "id")


@query(
    "v6_scheduled_history",
    with_views(
        "cfg_rows",
        """WITH m AS (SELECT scope_id // 8 AS scope, cfg_type, date_trunc('month', effective_from) AS starts, id, effective_from AS observed_at, effective_from - INTERVAL 1 HOUR * (id % 5) AS source_ts, setting // 2 AS setting, declared_to FROM cfg_rows),
c AS (SELECT *, row_number() OVER w AS rn, lag((setting, declared_to)) OVER w AS old FROM m WINDOW w AS (PARTITION BY scope, cfg_type, starts ORDER BY id)),
u AS (SELECT scope, cfg_type, starts, arg_max((setting, declared_to), id) AS last, max(observed_at) AS observed_at, max(source_ts) AS source_ts, count(*) FILTER (rn = 1 OR (setting, declared_to) IS DISTINCT FROM old) AS revisions FROM c GROUP BY ALL)
SELECT scope, cfg_type, starts, last[1] AS setting, observed_at, source_ts, revisions, least(last[2], lead(starts) OVER (PARTITION BY scope, cfg_type ORDER BY starts)) AS effective_to FROM u""",
    ),
)
def _(spark, d):
    """Settings announced for the month; what was announced for the same month before is replaced."""
    rows = view(spark, d, "cfg_rows").select(
        F.expr("scope_id div 8").alias("scope"), "cfg_type", F.date_trunc("month", "effective_from").cast("timestamp_ntz").alias("starts"), "id", F.col("effective_from").cast("timestamp_ntz").alias("observed_at"),
        F.timestamp_add("HOUR", -(F.col("id") % 5).cast("int"), F.col("effective_from").cast("timestamp_ntz")).alias("source_ts"), F.expr("setting div 2").alias("setting"), F.col("declared_to").cast("timestamp_ntz").alias("declared_to"),
    )
    out = h.scheduled_versions(rows, ["scope", "cfg_type"], "starts", ["id"], "setting", "declared_to", "observed_at", "source_ts")
    return out.select("scope", "cfg_type", "starts", "setting", "observed_at", "source_ts", "revisions", "effective_to")


@query("v7_stitch_intervals", with_views("cfg_rows", "SELECT id, effective_from, least(declared_to, lead(effective_from) OVER (PARTITION BY scope_id, cfg_type ORDER BY effective_from, id)) AS effective_to FROM cfg_rows"))
def _(spark, d):
    return h.stitch_intervals(view(spark, d, "cfg_rows"), ["scope_id", "cfg_type"], "effective_from", "id", "declared_to").select("id", "effective_from", "effective_to")


@query("v8_bumped_versions", with_views("cfg_rows", "WITH n AS (SELECT *, epoch_us(effective_from) AS us, row_number() OVER (PARTITION BY scope_id, effective_from ORDER BY id) AS tie FROM cfg_rows) SELECT id, make_timestamp(us + tie - 1) AS effective_from FROM n"))
def _(spark, d):
    rows = view(spark, d, "cfg_rows").withColumn("us", micros(F.col("effective_from")))
    return h.bump_ties(rows, ["scope_id"], "us", ["effective_from", "id"]).select("id", from_micros(F.col("bumped")).alias("effective_from"))


MEMBERS = """g AS (SELECT user_id AS market, ts, event_id AS seq, CASE WHEN event_type <> 'error' THEN event_type END AS grp, k % 2 AS role FROM ev),
c AS (SELECT *, row_number() OVER w AS rn, lag((grp, role)) OVER w AS old FROM g WINDOW w AS (PARTITION BY market ORDER BY ts, seq)),
n AS (SELECT *, sum((rn = 1 OR (grp, role) IS DISTINCT FROM old)::INT) OVER (PARTITION BY market ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS version_number FROM c),
v AS (SELECT market, version_number, any_value(grp) AS grp, any_value(role) AS role, min(ts) AS valid_from FROM n GROUP BY ALL),
w AS (SELECT *, lead(valid_from) OVER (PARTITION BY market ORDER BY version_number) AS valid_to FROM v)"""


@query("v9_group_membership", with_views("ev", f"WITH {MEMBERS} SELECT market, grp, role, valid_from, valid_to FROM w WHERE grp IS NOT NULL"))
def _(spark, d):
    """Memberships of a market; one ends when the group or role changes or the group goes."""
    rows = view(spark, d, "bk_events").select(F.col("token_key").alias("market"), "ts", "seq", F.when(F.col("event_type") != "error", F.col("event_type")).alias("grp"), (F.col("k") % 2).alias("role"))
    rows = rows.withColumn("content", h.digest("grp", "role"))
    return h.scd2(rows, ["market"], ["ts", "seq"], "content", ["grp", "role"]).where("grp IS NOT NULL").select("market", "grp", "role", "valid_from", "valid_to")


@query("v10_current_version", po(f"WITH {V} SELECT market, version_number::BIGINT AS version_number, status FROM ver WHERE valid_to IS NULL"))
def _(spark, d):
    return h.current_versions(versions(spark, d)).select("market", "version_number", "status")


@query("v11_version_as_of", po(f"WITH {V} SELECT market, version_number::BIGINT AS version_number, status FROM ver WHERE valid_from <= TIMESTAMP '2024-01-10' AND (valid_to IS NULL OR TIMESTAMP '2024-01-10' < valid_to)"))
def _(spark, d):
    return h.versions_as_of(versions(spark, d), F.lit("2024-01-10").cast("timestamp_ntz")).select("market", "version_number", "status")


@query("v12_seen_bounds", po("SELECT market, min(observed_at) AS first_seen_at, max(observed_at) AS last_seen_at FROM md_polls GROUP BY market"))
def _(spark, d):
    return view(spark, d, "md_polls").groupBy("market").agg(F.min("observed_at").alias("first_seen_at"), F.max("observed_at").alias("last_seen_at"))


@query("v13_coalesce_merge", po("SELECT market, arg_max(source_ts, seq) FILTER (source_ts IS NOT NULL) AS source_ts, arg_max(status, seq) AS status FROM md_polls GROUP BY market"))
def _(spark, d):
    return h.merge_rows(view(spark, d, "md_polls"), ["market"], ["seq"], ["source_ts", "status"]).select("market", "source_ts", "status")


@query("v14_effective_time", po("SELECT market, seq, coalesce(source_ts, observed_at) AS effective_at FROM md_polls"))
def _(spark, d):
    return view(spark, d, "md_polls").select("market", "seq", F.coalesce("source_ts", "observed_at").alias("effective_at"))


@query(
    "v15_run_supersede",
    with_views("ev", "WITH r AS (SELECT user_id AS job, event_id AS run, ts AS started_at, CASE WHEN k % 3 > 0 THEN ts + INTERVAL 1 HOUR * k END AS finished_at FROM ev WHERE event_type = 'signup'), l AS (SELECT *, lead(started_at) OVER (PARTITION BY job ORDER BY started_at, run) AS next FROM r) SELECT job, run, CASE WHEN next IS NOT NULL AND (finished_at IS NULL OR next < finished_at) THEN 'cancelled' WHEN finished_at IS NULL THEN 'running' ELSE 'completed' END AS status FROM l"),
)
def _(spark, d):
    runs = view(spark, d, "bk_events").where("event_type = 'signup'").select(F.col("token_key").alias("job"), F.col("seq").alias("run"), F.col("ts").alias("started_at"), F.when(F.col("k") % 3 > 0, F.timestamp_add("HOUR", F.col("k"), F.col("ts"))).alias("finished_at"))
    return h.supersede(runs, "job", "started_at", "finished_at", "run").select("job", "run", "status")
