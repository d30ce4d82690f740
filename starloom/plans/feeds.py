"""Queries on change windows and on facts that are maintained from them.

The order changes of events: lsn = event_id, key = user_id, operation from event_type.  Header and line
changes of orders follow from the key: order % 10 = 0 inserted, % 7 = 0 updated, % 13 = 0 deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import net_amount
from starloom.operators import changefeed, facts, pipeline
from starloom.plans.star import F_SQL, Star
from starloom.sources.connectors import publishable

QUERIES: dict = {}
SQL: dict[str, str] = {}
FROM_LSN, TO_LSN = 1000, 6000


def report(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Star(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _log(s: Star) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", 2).when(F.col("event_type") == "error", 1).otherwise(4)
    return s.raw("events").select(F.col("event_id").alias("lsn"), F.col("ts").alias("commit_time"), F.col("user_id").alias("key"), op.alias("operation"), "value")


_LOG = "log AS (SELECT event_id AS lsn, ts AS commit_time, user_id AS key, CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN 1 ELSE 4 END AS operation, value FROM events)"
_WINDOW = f"{_LOG}, w AS (SELECT * FROM log WHERE lsn > {FROM_LSN} AND lsn <= {TO_LSN})"


def _window(s: Star) -> DataFrame:
    return _log(s).filter((F.col("lsn") > FROM_LSN) & (F.col("lsn") <= TO_LSN))


@report(f"WITH {_WINDOW} SELECT lsn, key, operation, value FROM w")
def cdc_window(s: Star) -> DataFrame:
    """The changes after one position and up to another."""
    return _window(s).select("lsn", "key", "operation", "value")


@report(f"WITH {_WINDOW} SELECT key, lsn, operation, value FROM w QUALIFY row_number() OVER (PARTITION BY key ORDER BY lsn DESC) = 1")
def cdc_net_changes(s: Star) -> DataFrame:
    return changefeed.net_changes(_window(s), ["key"], ["lsn"], ["operation", "value"])


@report(f"WITH {_WINDOW} SELECT CASE operation WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' ELSE 'update' END AS operation_name, count(*) AS changes FROM w GROUP BY ALL")
def cdc_split_by_op(s: Star) -> DataFrame:
    return changefeed.split_by_operation(_window(s), F.col("operation")).groupBy("operation_name").agg(F.count(F.lit(1)).alias("changes"))


@report(f"WITH {_LOG} SELECT key, lsn, operation, value FROM log QUALIFY row_number() OVER (PARTITION BY key ORDER BY lsn DESC) = 1")
def cdc_net_changes_whole(s: Star) -> DataFrame:
    """The last change of each key over the whole log."""
    return changefeed.net_changes(_log(s), ["key"], ["lsn"], ["operation", "value"])


@report(f"WITH {_LOG} SELECT CASE operation WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' ELSE 'update' END AS operation_name, count(*) AS changes FROM log GROUP BY ALL")
def cdc_split_by_op_whole(s: Star) -> DataFrame:
    """Changes by operation over the whole log."""
    return changefeed.split_by_operation(_log(s), F.col("operation")).groupBy("operation_name").agg(F.count(F.lit(1)).alias("changes"))


_TX = "tx AS (SELECT *, (event_id // 7)::BIGINT AS lsn FROM events)"


@report(f"WITH {_TX}, n AS (SELECT lsn, count(*) AS n FROM tx WHERE lsn > 100 GROUP BY lsn), r AS (SELECT lsn, n, sum(n) OVER (ORDER BY lsn ROWS UNBOUNDED PRECEDING) AS upto FROM n) SELECT event_id, lsn FROM tx WHERE lsn IN (SELECT lsn FROM r WHERE upto <= 1000 OR upto = n)")
def cdc_capped_window(s: Star) -> DataFrame:
    """The next whole transactions of seven changes each, up to 1000 rows."""
    tx = s.raw("events").withColumn("lsn", F.floor(F.col("event_id") / 7).cast("bigint")).select("event_id", "lsn")
    return changefeed.whole_transactions(tx, "lsn", 100, 1000, F.floor(F.col("lsn") / 10_000))


@report("SELECT rtrim(capture_instance) AS capture_instance, count(*) AS changes, count(DISTINCT lower(ltrim(start_lsn, '0x'))) > 0 AS any_lsn FROM order_changes GROUP BY ALL")
def capture_counts(s: Star) -> DataFrame:
    d = s.raw("order_changes").groupBy(F.rtrim("capture_instance").alias("capture_instance"))
    return d.agg(F.count(F.lit(1)).alias("changes"), (F.count("start_lsn") > 0).alias("any_lsn"))


@report("SELECT capture_instance, last_lsn IS NULL AS never_read FROM stream_state WHERE rtrim(capture_instance) NOT IN (SELECT rtrim(capture_instance) FROM order_changes)")
def config_without_capture(s: Star) -> DataFrame:
    st, ch = s.raw("stream_state"), s.raw("order_changes").select(F.rtrim("capture_instance").alias("capture_instance")).distinct()
    return pipeline.never_captured(st, ch, "capture_instance").select("capture_instance", F.col("last_lsn").isNull().alias("never_read"))


@report("SELECT capture_instance, rows_published, CASE WHEN capture_instance = 'dbo_Region' THEN true ELSE is_active END AS is_active, CASE WHEN capture_instance = 'dbo_Region' THEN 'rt.region2' ELSE topic_name END AS topic_name FROM stream_state")
def watermark_state(s: Star) -> DataFrame:
    """Configuration taken over into the state, run-time columns untouched."""
    from starloom.sources.connectors import upsert_config

    st = s.raw("stream_state").select("capture_instance", "rows_published", "is_active", "topic_name")
    conf = s.spark.createDataFrame([("dbo_Region", True, "rt.region2")], "capture_instance string, is_active boolean, topic_name string")
    return upsert_config(st, conf, "capture_instance", ["is_active", "topic_name"])


# Facts from orders and lines

_LINES = "l AS (SELECT l_orderkey AS order_id, l_partkey, l_linenumber, l_quantity, l_shipdate FROM lineitem), h AS (SELECT o_orderkey AS order_id, o_custkey, o_totalprice FROM orders)"


def _lines(s: Star) -> DataFrame:
    return s.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")


def _headers(s: Star) -> DataFrame:
    return s.raw("orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_totalprice")


@report(f"WITH {_LINES} SELECT count(*) AS lines, count(DISTINCT order_id) AS orders, round(sum(l_quantity), 2) AS quantity FROM l JOIN h USING (order_id)")
def fact_build(s: Star) -> DataFrame:
    d = facts.build(_headers(s), _lines(s), "order_id")
    return d.agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("order_id").alias("orders"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@report("SELECT round(sum(cast(l_extendedprice AS DECIMAL(15,2)) * (1 - cast(l_discount AS DECIMAL(4,2)))), 2)::DOUBLE AS net_revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def net_revenue(s: Star) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(15,2)") * (F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)"))
    li = s.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), amount.alias("amount"))
    return li.join(s.raw("orders").select("o_orderkey"), "o_orderkey").agg(F.round(F.sum("amount"), 2).cast("double").alias("net_revenue"))


@report(f"WITH {F_SQL} SELECT count(*) AS lines, count(*) FILTER (abs(line_total - CAST(CAST(unit_price AS DECIMAL(15,4)) * quantity * (1 - CAST(round(discount::DOUBLE, 4) AS DECIMAL(9,4))) AS DECIMAL(19,4))) > 0.005) AS off FROM f")
def line_totals_checked(s: Star) -> DataFrame:
    """Stored line totals against price, quantity and discount."""
    f = s.facts("unit_price", "quantity", "discount", "line_total")
    off = F.abs(F.col("line_total") - net_amount(F.col("unit_price"), F.col("quantity"), F.col("discount"))) > 0.005
    return f.agg(F.count(F.lit(1)).alias("lines"), F.count_if(off).alias("off"))


@report(f"WITH {_LINES} SELECT order_id, l_partkey, l_linenumber, l_shipdate, o_totalprice FROM l JOIN h USING (order_id) WHERE order_id % 7 = 0")
def header_fan_out(s: Star) -> DataFrame:
    """Changed headers rewrite all of their lines."""
    changed = _headers(s).filter("order_id % 7 = 0")
    return facts.header_fan_out(_headers(s), changed, _lines(s), "order_id").select("order_id", "l_partkey", "l_linenumber", "l_shipdate", "o_totalprice")


@report(f"WITH {_LINES} SELECT order_id, l_partkey, l_linenumber, l_shipdate, o_custkey FROM l JOIN h USING (order_id) WHERE order_id % 10 = 0")
def line_side_apply(s: Star) -> DataFrame:
    return facts.line_side(_headers(s), _lines(s).filter("order_id % 10 = 0"), "order_id").select("order_id", "l_partkey", "l_linenumber", "l_shipdate", "o_custkey")


@report("SELECT order_id, product_key, 1 AS is_deleted FROM (SELECT * FROM fact_orders QUALIFY row_number() OVER (PARTITION BY order_id, product_key ORDER BY _version DESC) = 1) WHERE order_id % 13 = 0 AND coalesce(is_deleted, 0) = 0")
def delete_order_tombstones(s: Star) -> DataFrame:
    f = s.facts("is_deleted", "_version")
    gone = f.filter("order_id % 13 = 0").select("order_id")
    return facts.tombstones(f, gone, "order_id", F.col("_version") + 1).select("order_id", "product_key", "is_deleted")


@report(f"WITH {F_SQL} SELECT order_id, product_key, quantity FROM f WHERE order_id % 13 <> 0 OR order_id IS NULL")
def fact_incremental_final_state(s: Star) -> DataFrame:
    """Facts after the tombstones of deleted orders were appended."""
    f = s.facts("quantity", "is_deleted", "_version")
    t = facts.tombstones(f, f.filter("order_id % 13 = 0").select("order_id"), "order_id", F.col("_version") + 1)
    return facts.apply(f, t, ["order_id", "product_key"]).filter("is_deleted = 0").select("order_id", "product_key", "quantity")


@report("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 9)")
def affected_snapshot_semi(s: Star) -> DataFrame:
    keys = s.raw("customer").filter("c_custkey % 10 = 9").select(F.col("c_custkey").alias("o_custkey"))
    return facts.snapshot(s.raw("orders"), keys, "o_custkey").select("o_orderkey", "o_custkey")


@report(f"WITH {_LINES} SELECT l.order_id, l.l_partkey, l.l_linenumber, l.l_shipdate, (h.order_id IS NOT NULL)::INT AS has_header FROM l LEFT JOIN (SELECT * FROM h WHERE order_id % 3 <> 0) h ON h.order_id = l.order_id")
def late_header(s: Star) -> DataFrame:
    """Lines whose header hasn't come stay, without its values."""
    return facts.stitch(_headers(s).filter("order_id % 3 <> 0"), _lines(s), "order_id").select("order_id", "l_partkey", "l_linenumber", "l_shipdate", "has_header")


# Running a warehouse


@report("SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, ts::DATE AS event_date FROM events WHERE props IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1")
def audit_index(s: Star) -> DataFrame:
    """Event payloads parsed, the last document of each user and type, with their day."""
    d = s.raw("events").select(F.concat_ws("|", "user_id", "event_type").alias("id"), "event_id", "user_id", "ts", "props")
    return pipeline.audit_index(d, "props", "k bigint", "id", "ts").select("event_id", "user_id", "k", "event_date")


@report("SELECT CASE WHEN user_id % 7 = 3 THEN 'stream' WHEN user_id % 11 = 5 THEN 'warehouse' END AS peer, count(*) AS flows, count(DISTINCT user_id) AS ids FROM events GROUP BY ALL")
def flow_labels(s: Star) -> DataFrame:
    """Flows by the known port at either end."""
    e = s.raw("events").select("user_id", F.when(F.col("user_id") % 11 == 5, 5432).otherwise(1).alias("src"), F.when(F.col("user_id") % 7 == 3, 9092).otherwise(1).alias("dst"))
    peer = pipeline.flow_peer(F.col("src"), F.col("dst"), {5432: "warehouse", 9092: "stream"}).alias("peer")
    return e.groupBy(peer).agg(F.count(F.lit(1)).alias("flows"), F.countDistinct("user_id").alias("ids"))


_KEPT = "kept AS (SELECT event_type AS source, event_id AS lsn FROM events WHERE event_id > 500 + length(event_type) * 100), st AS (SELECT event_type AS source, 1000::BIGINT AS last_lsn FROM events GROUP BY ALL)"


@report(f"WITH {_KEPT} SELECT st.source, last_lsn AS last_read, min(lsn) AS oldest_kept FROM st JOIN kept ON kept.source = st.source GROUP BY ALL HAVING min(lsn) > last_lsn")
def cdc_gaps(s: Star) -> DataFrame:
    """Sources of which changes after the last one read were purged."""
    e = s.raw("events").select(F.col("event_type").alias("source"), F.col("event_id").alias("lsn"))
    kept = e.filter(F.col("lsn") > 500 + F.length("source") * 100)
    state = e.select("source").distinct().withColumn("last_lsn", F.lit(1000).cast("bigint"))
    return pipeline.gaps(kept, state, "source", "lsn", "last_lsn")


@report("SELECT rtrim(c.capture_instance) AS capture_instance, c.operation, count(*) AS changes FROM order_changes c JOIN stream_state s ON s.capture_instance = rtrim(c.capture_instance) WHERE s.is_active AND (c.operation <> 1 OR s.propagate_deletes) GROUP BY ALL")
def publishable_changes(s: Star) -> DataFrame:
    """What is passed on under each source's delete policy."""
    c = s.raw("order_changes").select(F.rtrim("capture_instance").alias("capture_instance"), "operation")
    d = publishable(c, s.raw("stream_state"), "capture_instance", "operation")
    return d.groupBy("capture_instance", "operation").agg(F.count(F.lit(1)).alias("changes"))


@report("SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY ALL")
def joined_names(s: Star) -> DataFrame:
    """Distinct names of a group as one text, in order."""
    return s.raw("customer").groupBy("c_nationkey").agg(F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ", ").alias("segments"))
