"""Queries on stream telemetry, data quality, storage, blobs and column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import any_differs, coerce, date_key
from starloom.operators import lake, quality, telemetry
from starloom.plans.star import C_OPEN, E_OPEN, F_SQL, P_OPEN, Star

QUERIES: dict = {}
SQL: dict[str, str] = {}


def report(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Star(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_FAILED = "coalesce(length(rtrim(error)) > 0, false)"


@report(f"SELECT capture_instance, count(*) AS events, sum(rows_written)::BIGINT AS rows_written, round(avg(lag_ms), 3) AS avg_lag_ms, round(quantile_cont(lag_ms, 0.95), 3) AS p95_lag_ms, max(lag_ms) AS max_lag_ms, max(event_time) AS last_event, count(*) FILTER ({_FAILED}) AS errors, count(*) FILTER (event_time > (SELECT max(event_time) FROM stream_events) - INTERVAL 1 HOUR) AS events_last_hour FROM stream_events GROUP BY ALL")
def stream_health(s: Star) -> DataFrame:
    return telemetry.health(s.raw("stream_events"))


@report("SELECT date_trunc('minute', event_time) AS minute, count(*) AS events, round(avg(lag_ms), 3) AS avg_lag_ms, round(quantile_cont(lag_ms, 0.95), 3) AS p95_lag_ms FROM stream_events GROUP BY ALL")
def lag_per_minute(s: Star) -> DataFrame:
    return telemetry.per_minute(s.raw("stream_events"))


@report("SELECT round(avg(lag_ms), 3) AS avg_lag, round(quantile_cont(lag_ms, 0.95), 3) AS p95_lag, round(median(lag_ms), 3) AS median_lag FROM stream_events WHERE event_time >= TIMESTAMP '2024-11-08' AND event_time <= TIMESTAMP '2024-11-15'")
def lag_summary(s: Star) -> DataFrame:
    e = s.raw("stream_events").filter("event_time >= timestamp_ntz'2024-11-08 00:00:00' and event_time <= timestamp_ntz'2024-11-15 00:00:00'")
    return e.agg(F.round(F.avg("lag_ms"), 3).alias("avg_lag"), F.round(F.percentile("lag_ms", F.lit(0.95)), 3).alias("p95_lag"), F.round(F.median("lag_ms"), 3).alias("median_lag"))


@report("SELECT scd_outcome, count(*) AS events FROM stream_events GROUP BY ALL")
def scd_outcome_breakdown(s: Star) -> DataFrame:
    return s.raw("stream_events").groupBy("scd_outcome").agg(F.count(F.lit(1)).alias("events"))


_FEED = ["event_time", "capture_instance", "business_key", "kafka_partition", "kafka_offset"]


@report("SELECT strftime(event_time, '%H:%M:%S') AS clock, regexp_replace(capture_instance, '^dbo_', '') AS source, business_key, operation, scd_outcome, rows_written, lag_ms FROM stream_events ORDER BY event_time DESC NULLS LAST, capture_instance, business_key, kafka_partition, kafka_offset, lag_ms LIMIT 30")
def live_feed(s: Star) -> DataFrame:
    d = s.raw("stream_events").orderBy(F.desc_nulls_last("event_time"), *_FEED[1:], "lag_ms").limit(30)
    return d.select(F.date_format("event_time", "HH:mm:ss").alias("clock"), F.regexp_replace("capture_instance", "^dbo_", "").alias("source"), "business_key", "operation", "scd_outcome", "rows_written", "lag_ms")


@report(f"SELECT count(*) AS events, sum(rows_written)::BIGINT AS rows_written, count(*) FILTER ({_FAILED}) AS errors, round(100.0 * count(*) FILTER ({_FAILED}) / count(*), 4)::DOUBLE AS error_pct, date_diff('second', max(event_time), TIMESTAMP '2024-12-31') AS idle_seconds FROM stream_events")
def error_rate(s: Star) -> DataFrame:
    bad = telemetry.failed(F.col("error"))
    idle = F.unix_timestamp(F.lit("2024-12-31 00:00:00").cast("timestamp")) - F.unix_timestamp(F.max("event_time").cast("timestamp"))
    return s.raw("stream_events").agg(F.count(F.lit(1)).alias("events"), F.sum("rows_written").alias("rows_written"), F.count_if(bad).alias("errors"), F.round(100.0 * F.count_if(bad) / F.count(F.lit(1)), 4).alias("error_pct"), idle.alias("idle_seconds"))


@report("WITH c AS (SELECT capture_instance AS term, count(*) AS n FROM stream_events GROUP BY ALL), t AS (SELECT term FROM c ORDER BY n DESC, term LIMIT 4) SELECT CASE WHEN term IN (SELECT term FROM t) THEN term ELSE 'Other' END AS term, sum(n)::BIGINT AS events FROM c GROUP BY ALL")
def topn_with_other(s: Star) -> DataFrame:
    return telemetry.top_with_other(s.raw("stream_events"), "capture_instance", 4)


@report("WITH p AS (SELECT topic, date_trunc('day', event_time) AS bucket, max(kafka_offset) AS peak FROM stream_events GROUP BY ALL) SELECT topic, bucket, peak, CASE WHEN lag(peak) OVER w IS NULL THEN NULL WHEN peak < lag(peak) OVER w THEN peak ELSE peak - lag(peak) OVER w END AS increase FROM p WINDOW w AS (PARTITION BY topic ORDER BY bucket)")
def counter_rate(s: Star) -> DataFrame:
    return telemetry.counter_rate(s.raw("stream_events"), "topic", F.date_trunc("day", "event_time"), "kafka_offset")


@report("SELECT capture_instance, count(*) AS events FROM stream_events WHERE event_time >= TIMESTAMP '2024-11-20' - INTERVAL 7 DAY GROUP BY ALL")
def ttl_expiry(s: Star) -> DataFrame:
    d = telemetry.keep_newer(s.raw("stream_events"), "event_time", 7, F.lit("2024-11-20 00:00:00").cast("timestamp_ntz"))
    return d.groupBy("capture_instance").agg(F.count(F.lit(1)).alias("events"))


# Quality


@report(f"WITH {C_OPEN}, {P_OPEN}, {E_OPEN}, a AS (SELECT 'customers' AS table_name, 750 AS expected, (SELECT count(*) FROM co) AS actual UNION ALL SELECT 'products', 250, (SELECT count(*) FROM po) UNION ALL SELECT 'employees', 385, (SELECT count(*) FROM eo)) SELECT table_name, expected::BIGINT AS expected, actual, CASE WHEN expected = actual THEN 'OK' ELSE 'MISMATCH' END AS status FROM a")
def reconcile_counts(s: Star) -> DataFrame:
    tables = {"customers": s.open("dim_customer", "customer_alternate_key"), "products": s.open("dim_products", "product_alternate_key"), "employees": s.open("dim_employees", "employee_alternate_key")}
    wanted = s.spark.createDataFrame([("customers", 750), ("products", 250), ("employees", 385)], "table_name string, expected bigint")
    return quality.reconcile(quality.counts(tables), wanted)


_RC = "SELECT trim(customer_alternate_key) AS k, company_name, contact_name FROM (SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY trim(customer_alternate_key), start_date ORDER BY _version DESC) = 1) WHERE end_date = TIMESTAMP '2106-01-01'"


def _open_customers(s: Star, table: str) -> DataFrame:
    from starloom.operators.standing import current

    d = current(s.raw(table), {"k": F.trim("customer_alternate_key")}, ["company_name", "contact_name"])
    return d.select("k", "company_name", "contact_name")


@report(f"WITH b AS ({_RC.format(t='dim_customer')}), r AS ({_RC.format(t='rt_dim_customer')}) SELECT (SELECT count(*) FROM b) AS batch_rows, (SELECT count(*) FROM r) AS stream_rows, (SELECT count(*) FROM r) - (SELECT count(*) FROM b) AS delta, (SELECT count(*) FROM (SELECT k FROM b INTERSECT SELECT k FROM r)) AS in_both")
def path_comparison(s: Star) -> DataFrame:
    return quality.overlap(_open_customers(s, "dim_customer"), _open_customers(s, "rt_dim_customer"), "k")


@report(f"WITH b AS ({_RC.format(t='dim_customer')}), r AS ({_RC.format(t='rt_dim_customer')}) SELECT coalesce(b.k, r.k) AS k, CASE WHEN r.k IS NULL THEN 'batch only' WHEN b.k IS NULL THEN 'stream only' ELSE 'differs' END AS status FROM b FULL JOIN r ON b.k = r.k WHERE b.k IS NULL OR r.k IS NULL OR b.company_name IS DISTINCT FROM r.company_name OR b.contact_name IS DISTINCT FROM r.contact_name")
def customer_drift(s: Star) -> DataFrame:
    return quality.drift(_open_customers(s, "dim_customer"), _open_customers(s, "rt_dim_customer"), "k", ["company_name", "contact_name"])


@report("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphan_details(s: Star) -> DataFrame:
    """Orders without lines."""
    return s.raw("orders").select("o_orderkey").join(s.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@report(f"WITH {F_SQL} SELECT count(*) AS fact_rows, count(*) FILTER (product_key = 0) AS no_product, count(*) FILTER (coalesce(customer_key, 0) = 0) AS no_customer, count(*) FILTER (product_key = 0 OR coalesce(customer_key, 0) = 0 OR employee_key = 0) AS unresolved, count(*) FILTER (order_date_key = 0) AS no_date FROM f")
def integrity_unresolved(s: Star) -> DataFrame:
    f = s.facts("customer_key", "employee_key", "order_date_key")
    no_c = F.coalesce("customer_key", F.lit(0)) == 0
    return f.agg(F.count(F.lit(1)).alias("fact_rows"), F.count_if(F.col("product_key") == 0).alias("no_product"), F.count_if(no_c).alias("no_customer"), F.count_if((F.col("product_key") == 0) | no_c | (F.col("employee_key") == 0)).alias("unresolved"), F.count_if(F.col("order_date_key") == 0).alias("no_date"))


@report(f"WITH {C_OPEN}, {P_OPEN}, {E_OPEN} SELECT (SELECT count(*) FROM co WHERE rtrim(company_name) = '') + (SELECT count(*) FROM po WHERE rtrim(product_name) = '') + (SELECT count(*) FROM eo WHERE rtrim(full_name) = '') AS stubs")
def inferred_count(s: Star) -> DataFrame:
    rows = None
    for t, a, n in (("dim_customer", "customer_alternate_key", "company_name"), ("dim_products", "product_alternate_key", "product_name"), ("dim_employees", "employee_alternate_key", "full_name")):
        one = s.open(t, a, n).filter(F.rtrim(n) == "").agg(F.count(F.lit(1)).alias("n"))
        rows = one if rows is None else rows.union(one)
    return rows.agg(F.sum("n").alias("stubs"))


@report(f"WITH {F_SQL} SELECT (CASE WHEN order_date IS NULL THEN 190001 ELSE year(order_date) * 100 + month(order_date) END)::BIGINT AS partition, count(*) AS rows FROM f GROUP BY ALL ORDER BY partition DESC LIMIT 12")
def partition_sizes(s: Star) -> DataFrame:
    part = F.coalesce(F.year("order_date") * 100 + F.month("order_date"), F.lit(190001)).cast("bigint").alias("partition")
    return s.facts("order_date").groupBy(part).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("partition")).limit(12)


@report()
def storage_per_table(s: Star) -> DataFrame:
    """Rows, files and bytes of the largest tables."""
    from starloom.sources.connectors import storage

    out = None
    for t in ("fact_orders", "lineitem", "orders"):
        one = storage(s.raw(t), t)
        out = one if out is None else out.unionByName(one)
    return out


# Blobs


@report("SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS size_bytes, sha256(text) AS checksum_sha256 FROM documents")
def lake_catalogue(s: Star) -> DataFrame:
    return lake.catalogue(s.raw("documents").select("doc_id", "text"), "doc_id", "text")


@report("SELECT doc_id, CASE WHEN doc_id % 20 = 0 THEN 'missing' ELSE 'modified' END AS status FROM documents WHERE doc_id % 20 = 0 OR doc_id % 20 = 1")
def lake_verify(s: Star) -> DataFrame:
    """Every 20th blob taken away and the one after it changed."""
    d = s.raw("documents").select("doc_id", "text")
    now = d.filter("doc_id % 20 <> 0").withColumn("text", F.when(F.col("doc_id") % 20 == 1, F.concat(F.coalesce("text", F.lit("")), F.lit("x"))).otherwise(F.col("text")))
    return lake.verify(lake.catalogue(d, "doc_id", "text"), lake.catalogue(now, "doc_id", "text"), "doc_id")


# Column functions


@report("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(s: Star) -> DataFrame:
    return s.raw("events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@report("SELECT c_custkey, upper(left(c_name, 1)) AS initial, rtrim(coalesce(c_mktsegment, '')) AS segment, concat_ws('|', c_custkey, c_nationkey) AS business_key FROM customer")
def string_normalise(s: Star) -> DataFrame:
    from starloom.functions.values import normalise
    from starloom.sources.connectors import business_key

    c = normalise(s.raw("customer"), ["c_mktsegment"])
    return c.select("c_custkey", F.upper(F.left("c_name", F.lit(1))).alias("initial"), F.col("c_mktsegment").alias("segment"), business_key(["c_custkey", "c_nationkey"]).alias("business_key"))


@report("SELECT o_orderkey, coalesce(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate), 0)::INT AS date_key, date_trunc('month', o_orderdate)::TIMESTAMP AS month, 2001 - year(o_orderdate) AS years FROM orders")
def date_parts(s: Star) -> DataFrame:
    d = F.col("o_orderdate")
    return s.raw("orders").select("o_orderkey", date_key(d).alias("date_key"), F.date_trunc("month", d).alias("month"), (F.lit(2001) - F.year(d)).cast("bigint").alias("years"))


@report("SELECT event_id, coalesce(TRY_CAST(event_type AS INT), 0) AS number, coalesce(TRY_CAST(value AS DECIMAL(19,4)), 0)::DECIMAL(19,4) AS amount FROM events")
def coerce_zero_values(s: Star) -> DataFrame:
    from pyspark.sql import types as T

    return s.raw("events").select("event_id", coerce(F.col("event_type"), T.IntegerType()).alias("number"), coerce(F.col("value"), T.DecimalType(19, 4)).alias("amount"))


@report("SELECT count(*) FILTER (contact_name IS DISTINCT FROM fax) AS differ, count(*) AS rows FROM staging_suppliers, (SELECT NULL::VARCHAR AS fax)")
def null_safe_compare(s: Star) -> DataFrame:
    d = s.raw("staging_suppliers").withColumn("fax", F.lit(None).cast("string"))
    return d.agg(F.count_if(any_differs([(F.col("contact_name"), F.col("fax"))])).alias("differ"), F.count(F.lit(1)).alias("rows"))


@report()
def approx_distinct(s: Star) -> DataFrame:
    return s.raw("lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey").alias("orders"), F.percentile_approx("l_quantity", 0.95).alias("p95"))
