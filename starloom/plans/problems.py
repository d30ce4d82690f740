"""Queries over hierarchies, change feeds, late events, copies, histories, orphans and as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.text import bare, epoch_micros
from starloom.operators import asof, changefeed, diff, hierarchy, history, late, orphans
from starloom.operators.skew import look_up
from starloom.operators.standing import current, live, open_end, standing
from starloom.sources.tables import Scratch, load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _trimmed(c: str) -> Column:
    return F.rtrim(F.col(c))


# 1. Parent-child links to full hierarchies


def managers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, parent of the current employees; parent is null where there is no manager."""
    e = load(spark, sf_dir, "dim_employees")
    now = current(e, {"id": F.col("employee_alternate_key")}, ["reports_to", "parent_employee_key"])
    owner = e.filter(F.col("employee_key") != 0).groupBy(F.col("employee_key").alias("parent_employee_key")).agg(F.min("employee_alternate_key").alias("__sl_owner"))
    n = look_up(now, owner, "parent_employee_key", F.col("id"))
    own = F.when(F.col("reports_to") != 0, F.col("reports_to"))
    return n.select("id", F.coalesce(own, F.when(F.col("parent_employee_key") != 0, F.col("__sl_owner"))).alias("parent"))


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hierarchy.resolve(spark, managers(spark, sf_dir)).filter(F.col("cycle_key").isNotNull())
    return found.select(F.col("id").alias("employee_alternate_key"), "cycle_key")


@query
def p1_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every current employee with manager, top manager, depth, path and the number of subordinates."""
    m = Scratch(spark).put(managers(spark, sf_dir))
    below = hierarchy.subtree_sizes(spark, m)
    return hierarchy.paths(spark, m).join(below, "id", "left").select(
        F.col("id").alias("employee_alternate_key"), F.col("parent").alias("manager_key"), F.col("root").alias("top_manager_key"), "depth",
        F.array_join("path", "/").alias("path"), F.col("descendants").alias("subordinates"), "cycle_key",
    )


@query
def p1_subordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every employee with each of their subordinates and how far below these are."""
    d = hierarchy.descendants(hierarchy.paths(spark, managers(spark, sf_dir)))
    return d.select(F.col("ancestor").alias("employee_alternate_key"), F.col("descendant").alias("subordinate_key"), "distance")


_MANAGERS = """
standing AS (SELECT * FROM dim_employees QUALIFY row_number() OVER (PARTITION BY employee_alternate_key, start_date ORDER BY _version DESC) = 1),
cur AS (SELECT employee_alternate_key::BIGINT AS id, reports_to, parent_employee_key FROM standing WHERE end_date = TIMESTAMP '2106-01-01 00:00:00' AND employee_alternate_key IS NOT NULL),
owner AS (SELECT employee_key, min(employee_alternate_key)::BIGINT AS alt FROM dim_employees WHERE employee_key <> 0 GROUP BY employee_key),
raw AS (SELECT c.id, coalesce(nullif(c.reports_to, 0), o.alt) AS parent FROM cur c LEFT JOIN owner o ON o.employee_key = c.parent_employee_key),
links AS (SELECT r.id, k.id AS parent FROM raw r LEFT JOIN cur k ON k.id = r.parent)"""

SQL["p1_found"] = f"""
WITH RECURSIVE {_MANAGERS},
down AS (SELECT id FROM links WHERE parent IS NULL UNION SELECT l.id FROM links l JOIN down d ON l.parent = d.id),
endless AS (SELECT id, parent FROM links WHERE id NOT IN (SELECT id FROM down)),
reach AS (SELECT id, parent AS tm FROM endless UNION SELECT r.id, e.parent FROM reach r JOIN endless e ON e.id = r.tm),
loops AS (SELECT id, min(tm) AS cycle_key FROM reach WHERE id IN (SELECT r.id FROM reach r WHERE r.tm = r.id) GROUP BY id)
SELECT r.id AS employee_alternate_key, min(l.cycle_key)::BIGINT AS cycle_key FROM reach r JOIN loops l ON l.id = r.tm GROUP BY r.id"""

SQL["p1_hierarchy"] = f"""
WITH RECURSIVE {_MANAGERS},
down AS (SELECT id, id AS root, 0::BIGINT AS depth, id::VARCHAR AS path FROM links WHERE parent IS NULL
  UNION ALL SELECT l.id, d.root, d.depth + 1, d.path || '/' || l.id FROM links l JOIN down d ON l.parent = d.id),
up AS (SELECT id, parent AS tm FROM links WHERE parent IS NOT NULL AND id IN (SELECT id FROM down) UNION ALL SELECT u.id, l.parent FROM up u JOIN links l ON l.id = u.tm WHERE l.parent IS NOT NULL),
below AS (SELECT tm, count(*) AS n FROM up GROUP BY tm),
endless AS (SELECT id, parent FROM links WHERE id NOT IN (SELECT id FROM down)),
reach AS (SELECT id, parent AS tm FROM endless UNION SELECT r.id, e.parent FROM reach r JOIN endless e ON e.id = r.tm),
loops AS (SELECT id, min(tm) AS cycle_key FROM reach WHERE id IN (SELECT r.id FROM reach r WHERE r.tm = r.id) GROUP BY id),
on_or_below AS (SELECT r.id, min(l.cycle_key)::BIGINT AS cycle_key FROM reach r JOIN loops l ON l.id = r.tm GROUP BY r.id)
SELECT l.id AS employee_alternate_key, l.parent AS manager_key, d.root AS top_manager_key, d.depth, d.path,
  CASE WHEN d.id IS NOT NULL THEN coalesce(b.n, 0) END AS subordinates, c.cycle_key
FROM links l LEFT JOIN down d ON d.id = l.id LEFT JOIN below b ON b.tm = l.id LEFT JOIN on_or_below c ON c.id = l.id"""

SQL["p1_subordinates"] = f"""
WITH RECURSIVE {_MANAGERS},
down AS (SELECT id FROM links WHERE parent IS NULL UNION SELECT l.id FROM links l JOIN down d ON l.parent = d.id),
up AS (SELECT id, parent AS tm, 1 AS distance FROM links WHERE parent IS NOT NULL AND id IN (SELECT id FROM down)
  UNION ALL SELECT u.id, l.parent, u.distance + 1 FROM up u JOIN links l ON l.id = u.tm WHERE l.parent IS NOT NULL)
SELECT tm::BIGINT AS employee_alternate_key, id AS subordinate_key, distance::BIGINT AS distance FROM up"""


# 2. Applying a stream of inserts, updates and deletes


def _feed(spark: SparkSession, sf_dir: str) -> changefeed.EqualityDeleteTable:
    return changefeed.apply_feed(spark, load(spark, sf_dir, "order_changes"), load(spark, sf_dir, "stream_state"))


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = lambda c: F.col(c).cast("bigint").alias(c)
    return _feed(spark, sf_dir).lines().select(big("order_id"), big("product_id"), F.col("pos.start_lsn").alias("start_lsn"), F.col("pos.seqval").alias("seqval"), big("is_deleted"))


@query
def p2_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines that are there, with their values and those of their order's last known header."""
    t = _feed(spark, sf_dir)
    return t.live().join(t.headers(), "order_id", "left").select("order_id", "product_id", "unit_price", "quantity", "discount", "freight", "ship_name", "order_date")


def _hex(c: str) -> str:
    return f"lpad(right(ltrim(regexp_replace(regexp_replace(lower(trim({c})), '^0x', ''), '[^0-9a-f]', '', 'g'), '0'), 20), 20, '0')"


_COUNTING = f"""
changes AS (SELECT rtrim(capture_instance) AS ci, operation, {_hex('start_lsn')} AS lsn, {_hex('seqval')} AS seq, * EXCLUDE (capture_instance, operation, start_lsn, seqval) FROM order_changes),
counting AS (SELECT c.* FROM changes c JOIN stream_state s ON rtrim(s.capture_instance) = c.ci AND c.lsn <= {_hex('s.last_lsn')} WHERE c.operation <> 3),
own AS (SELECT * FROM counting WHERE ci = 'dbo_OrderDetails' QUALIFY row_number() OVER (PARTITION BY order_id, product_id ORDER BY lsn DESC, seq DESC, operation DESC) = 1),
gone AS (SELECT order_id, max(lsn || seq) AS pos FROM counting WHERE ci = 'dbo_Orders' AND operation = 1 GROUP BY order_id)"""

SQL["p2_found"] = f"""
WITH {_COUNTING}
SELECT o.order_id::BIGINT AS order_id, o.product_id::BIGINT AS product_id,
  CASE WHEN g.pos > o.lsn || o.seq THEN left(g.pos, 20) ELSE o.lsn END AS start_lsn,
  CASE WHEN g.pos > o.lsn || o.seq THEN right(g.pos, 20) ELSE o.seq END AS seqval,
  CASE WHEN g.pos > o.lsn || o.seq OR o.operation = 1 THEN 1 ELSE 0 END::BIGINT AS is_deleted
FROM own o LEFT JOIN gone g ON g.order_id = o.order_id"""

SQL["p2_order_lines"] = f"""
WITH {_COUNTING},
headers AS (SELECT * FROM counting WHERE ci = 'dbo_Orders' AND operation <> 1 QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC, seq DESC) = 1)
SELECT o.order_id, o.product_id, o.unit_price, o.quantity, o.discount, h.freight, h.ship_name, h.order_date
FROM own o LEFT JOIN gone g ON g.order_id = o.order_id LEFT JOIN headers h ON h.order_id = o.order_id
WHERE o.operation <> 1 AND (g.pos IS NULL OR g.pos <= o.lsn || o.seq)"""


# 3. Late and out-of-order events


LOADS = ((0.6, 1.0), (0.0, 0.4), (0.35, 0.7))  #: shares of the time from the first to the last arrival: loads that overlap and come out of order


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of a store into which the events came in three loads by time of arrival."""
    e = load(spark, sf_dir, "stream_events")
    lo, hi = e.agg(F.min(epoch_micros(F.col("event_time"))), F.max(epoch_micros(F.col("event_time")))).first()
    store = late.PartialStore(spark, Scratch(spark).path())
    if lo is None:
        return store.partials()
    at = lambda share: F.timestamp_micros(F.lit(int(lo + share * (hi - lo)))).cast("timestamp_ntz")
    nameless = F.col("topic").isNull() | F.col("kafka_partition").isNull() | F.col("kafka_offset").isNull()
    for n, (a, b) in enumerate(LOADS):
        own = {0: F.col("event_time") > at(0.7), 1: F.col("event_time") <= at(0.4), 2: (F.col("event_time") > at(0.4)) & (F.col("event_time") <= at(0.7))}[n]  # records that can't be told apart come once
        store.load(e.filter((F.col("event_time") >= at(a)) & (F.col("event_time") <= at(b)) & (own | ~nameless)), str(n))
    return store.partials()


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = late.revisions(_partials(spark, sf_dir))
    return r.filter(F.col("revised_in").isNotNull()).select("capture_instance", "period_start", "revised_in")


@query
def p3_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour's counts and sums as they stood at its end and after each hour in which late events came."""
    return late.revisions(_partials(spark, sf_dir))


@query
def p3_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.totals(_partials(spark, sf_dir))


_EVENTS = """
firsts AS (SELECT * FROM stream_events QUALIFY row_number() OVER (PARTITION BY rtrim(topic), kafka_partition, kafka_offset
  ORDER BY event_time, (source_time IS NULL AND lag_ms IS NULL), capture_instance, source_time, lag_ms, rows_written) = 1),
timed AS (SELECT rtrim(capture_instance) AS capture_instance, epoch_us(event_time) AS arrived, coalesce(epoch_us(source_time), epoch_us(event_time) - lag_ms * 1000) AS happened,
  coalesce(rows_written, 0) AS rows_written, coalesce(length(rtrim(error)) > 0, false) AS failed FROM firsts),
placed AS (SELECT *, floor(happened / 3600000000.0)::BIGINT * 3600 AS period_start, floor(arrived / 3600000000.0)::BIGINT * 3600 AS arrived_in FROM timed WHERE happened IS NOT NULL AND arrived IS NOT NULL),
told AS (SELECT *, arrived >= (period_start + 3600) * 1000000 AS late, arrived > (period_start + 10800) * 1000000 AS refused FROM placed)"""

SQL["p3_found"] = f"WITH {_EVENTS} SELECT DISTINCT capture_instance, period_start, arrived_in AS revised_in FROM told WHERE late AND NOT refused"

SQL["p3_revisions"] = f"""
WITH {_EVENTS},
per AS (SELECT capture_instance, period_start, CASE WHEN late THEN arrived_in END AS revised_in, count(*) AS e, sum(rows_written)::BIGINT AS r, sum(failed::INT)::BIGINT AS f FROM told WHERE NOT refused GROUP BY ALL)
SELECT capture_instance, period_start, revised_in,
  row_number() OVER w - max((revised_in IS NULL)::INT) OVER (PARTITION BY capture_instance, period_start) AS revision,
  e AS added_events, r AS added_rows_written, f AS added_errors,
  sum(e) OVER w::BIGINT AS events, sum(r) OVER w::BIGINT AS rows_written, sum(f) OVER w::BIGINT AS errors
FROM per WINDOW w AS (PARTITION BY capture_instance, period_start ORDER BY revised_in NULLS FIRST ROWS UNBOUNDED PRECEDING)"""

SQL["p3_totals"] = f"""
WITH {_EVENTS}
SELECT capture_instance, period_start, count(*) FILTER (NOT refused) AS events, coalesce(sum(rows_written) FILTER (NOT refused), 0)::BIGINT AS rows_written,
  coalesce(sum(failed::INT) FILTER (NOT refused), 0)::BIGINT AS errors, count(*) FILTER (late AND NOT refused) AS late_events, count(*) FILTER (refused) AS refused_events
FROM told GROUP BY ALL"""


# 4. Differences between two copies

CUSTOMER_FIELDS = ["company_name", "contact_name", "contact_title", "phone", "fax"]


def _copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    scratch = Scratch(spark)
    key = {"customer_alternate_key": F.trim("customer_alternate_key")}
    return tuple(scratch.put(current(load(spark, sf_dir, t), key, CUSTOMER_FIELDS)) for t in ("dim_customer", "rt_dim_customer"))


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, stream = _copies(spark, sf_dir)
    d = diff.differences(spark, batch, stream, "customer_alternate_key", {f: bare(F.col(f)) for f in CUSTOMER_FIELDS})
    return d.select(F.col("key").alias("customer_alternate_key"), "field_name")


@query
def p4_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p4_found with both values."""
    batch, stream = _copies(spark, sf_dir)
    d = diff.differences(spark, batch, stream, "customer_alternate_key", {f: bare(F.col(f)) for f in CUSTOMER_FIELDS})
    return d.select(F.col("key").alias("customer_alternate_key"), "field_name", F.col("left_value").alias("batch_value"), F.col("right_value").alias("stream_value"))


@query
def p4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of either copy, in both, missing on a side and differing."""
    batch, stream = _copies(spark, sf_dir)
    r = diff.range_counts(batch, stream, "customer_alternate_key", {f: bare(F.col(f)) for f in CUSTOMER_FIELDS})
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
    return r.agg(total("left_rows", "batch_rows"), total("right_rows", "stream_rows"), total("in_both", "in_both"), total("left_only", "batch_only"), total("right_only", "stream_only"), total("differing", "differing"))


def _side(table: str) -> str:
    fields = ", ".join(f"rtrim(coalesce({f}, '')) AS {f}" for f in CUSTOMER_FIELDS)
    return f"""(SELECT trim(customer_alternate_key) AS k, {fields} FROM
  (SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY trim(customer_alternate_key), start_date ORDER BY _version DESC) = 1)
  WHERE end_date = TIMESTAMP '2106-01-01 00:00:00' QUALIFY row_number() OVER (PARTITION BY trim(customer_alternate_key) ORDER BY start_date DESC) = 1)"""


_BOTH = f"b AS {_side('dim_customer')}, s AS {_side('rt_dim_customer')}"
_CASES = "SELECT k, 'batch only' AS f, NULL AS x, NULL AS y FROM b WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT k, 'stream only', NULL, NULL FROM s WHERE k NOT IN (SELECT k FROM b)" + "".join(
    f" UNION ALL SELECT b.k, '{f}', b.{f}, s.{f} FROM b JOIN s ON b.k = s.k WHERE b.{f} <> s.{f}" for f in CUSTOMER_FIELDS
)
SQL["p4_found"] = f"WITH {_BOTH} SELECT k AS customer_alternate_key, f AS field_name FROM ({_CASES})"
SQL["p4_differences"] = f"WITH {_BOTH} SELECT k AS customer_alternate_key, f AS field_name, x AS batch_value, y AS stream_value FROM ({_CASES})"
SQL["p4_counts"] = f"""
WITH {_BOTH}, cases AS ({_CASES})
SELECT (SELECT count(*) FROM b) AS batch_rows, (SELECT count(*) FROM s) AS stream_rows, (SELECT count(*) FROM b JOIN s ON b.k = s.k) AS in_both,
  (SELECT count(*) FROM cases WHERE f = 'batch only') AS batch_only, (SELECT count(*) FROM cases WHERE f = 'stream only') AS stream_only,
  (SELECT count(DISTINCT k) FROM cases WHERE f NOT IN ('batch only', 'stream only')) AS differing"""


# 5. History of changing attributes

PRODUCT_HISTORY = {"unit_price": False, "supplier_id": False, "category_name": False, "discontinued": False}
SUPPLIER_HISTORY = {"contact_name": True, "contact_title": True, "city": True, "country": True, "phone": True}


def _product_log(spark: SparkSession, sf_dir: str, attributes: dict[str, bool]) -> DataFrame:
    p = load(spark, sf_dir, "staging_products")
    text = {"category_name"}
    states = history.last_loaded(p, {"alternate_key": F.col("product_id").cast("bigint")}, F.col("snapshot_date"), {a: _trimmed(a) if a in text else F.col(a) for a in attributes})
    return history.attribute_log(states, ["alternate_key"], attributes)


def _supplier_log(spark: SparkSession, sf_dir: str, attributes: dict[str, bool]) -> DataFrame:
    s = load(spark, sf_dir, "staging_suppliers")
    states = history.last_loaded(s, {"alternate_key": F.col("supplier_id").cast("bigint")}, F.col("updated_at"), {a: bare(F.col(a)) for a in attributes})
    return history.attribute_log(states, ["alternate_key"], attributes)


@query
def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unit_price of a product and contact_name of a supplier with its period."""
    log = _product_log(spark, sf_dir, {"unit_price": False}).withColumn("entity", F.lit("product"))
    log = log.unionByName(_supplier_log(spark, sf_dir, {"contact_name": True}).withColumn("entity", F.lit("supplier")))
    i = history.intervals(log, ["entity", "alternate_key", "attribute"], open_end())
    time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return i.select("entity", "alternate_key", "attribute", "value", time("valid_from"), time("valid_to"))


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_values(spark, sf_dir).select("entity", "alternate_key", "valid_from", "valid_to")


@query
def p5_product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of each product over all tracked attributes."""
    log = _product_log(spark, sf_dir, PRODUCT_HISTORY)
    v = history.versions(log, ["alternate_key"], list(PRODUCT_HISTORY), open_end())
    return v.withColumnRenamed("alternate_key", "product_id")


@query
def p5_supplier_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _supplier_log(spark, sf_dir, SUPPLIER_HISTORY)
    v = history.versions(log, ["alternate_key"], list(SUPPLIER_HISTORY), open_end())
    return v.withColumnRenamed("alternate_key", "supplier_id")


_VALUES = """
sp AS (SELECT product_id::BIGINT AS k, snapshot_date::TIMESTAMP AS tm, unit_price::VARCHAR AS v FROM (SELECT * FROM staging_products WHERE product_id IS NOT NULL AND snapshot_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_id, snapshot_date ORDER BY _loaded_at DESC, unit_price DESC NULLS LAST) = 1) WHERE unit_price IS NOT NULL),
ss AS (SELECT supplier_id::BIGINT AS k, updated_at AS tm, rtrim(coalesce(contact_name, '')) AS v FROM staging_suppliers WHERE supplier_id IS NOT NULL AND updated_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY supplier_id, updated_at ORDER BY _loaded_at DESC, rtrim(coalesce(contact_name, '')) DESC) = 1),
e AS (SELECT 'product' AS entity, 'unit_price' AS attribute, * FROM sp UNION ALL SELECT 'supplier', 'contact_name', * FROM ss),
c AS (SELECT * FROM e QUALIFY lag(v) OVER (PARTITION BY entity, k ORDER BY tm) IS DISTINCT FROM v),
p AS (SELECT entity, k AS alternate_key, attribute, v AS value, strftime(tm, '%Y-%m-%d %H:%M:%S') AS valid_from,
  strftime(coalesce(lead(tm) OVER (PARTITION BY entity, k ORDER BY tm), TIMESTAMP '2106-01-01'), '%Y-%m-%d %H:%M:%S') AS valid_to FROM c)"""
SQL["p5_values"] = f"WITH {_VALUES} SELECT * FROM p"
SQL["p5_found"] = f"WITH {_VALUES} SELECT entity, alternate_key, valid_from, valid_to FROM p"


def _versions_sql(table: str, key: str, at: str, columns: dict[str, str]) -> str:
    filled = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in columns)
    changed = " OR ".join(f"lag({c}) OVER (PARTITION BY {key} ORDER BY tm) IS DISTINCT FROM {c}" for c in columns)
    order = ", ".join(f"{x} DESC NULLS LAST" for x in columns.values())
    return f"""
WITH one AS (SELECT {key}, {at}::TIMESTAMP AS tm, {', '.join(f'{x} AS {c}' for c, x in columns.items())} FROM {table} WHERE {key} IS NOT NULL AND {at} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {key}, {at} ORDER BY _loaded_at DESC, {order}) = 1),
f AS (SELECT {key}, tm, {filled} FROM one WINDOW w AS (PARTITION BY {key} ORDER BY tm)),
c AS (SELECT * FROM f QUALIFY {changed})
SELECT {key}::BIGINT AS {key}, {', '.join(columns)}, tm AS valid_from, coalesce(lead(tm) OVER (PARTITION BY {key} ORDER BY tm), TIMESTAMP '2106-01-01') AS valid_to FROM c"""


SQL["p5_product_versions"] = _versions_sql("staging_products", "product_id", "snapshot_date", {"unit_price": "unit_price::VARCHAR", "supplier_id": "supplier_id::VARCHAR", "category_name": "rtrim(category_name)", "discontinued": "discontinued::VARCHAR"})
SQL["p5_supplier_versions"] = _versions_sql("staging_suppliers", "supplier_id", "updated_at", {c: f"rtrim(coalesce({c}, ''))" for c in SUPPLIER_HISTORY})


# 6. References to records that do not exist


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = live(load(spark, sf_dir, "fact_orders"), ["order_id", "product_key"], ["customer_key", "order_date"])
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).cast("bigint").alias("key")) for f in ("customer_key", "product_key"))))
    facts = lines.select("order_date", each.alias("r")).select(F.lit("fact_orders").alias("table_name"), "r.field_name", "r.key", F.col("order_date").alias("at"))
    p = history.last_loaded(load(spark, sf_dir, "staging_products"), {"product_id": F.col("product_id")}, F.col("snapshot_date"), {"unit_price": F.col("unit_price"), "supplier_id": F.col("supplier_id")})
    return facts.unionByName(p.select(F.lit("staging_products").alias("table_name"), F.lit("supplier_id").alias("field_name"), F.col("supplier_id").cast("bigint").alias("key"), "at"))


def _parents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    keys, versions = [], []
    for field, table, key, alt in (("customer_key", "dim_customer", "customer_key", "customer_alternate_key"), ("product_key", "dim_products", "product_key", "product_alternate_key"), ("supplier_id", "dim_suppliers", "supplier_alternate_key", "supplier_alternate_key")):
        d = load(spark, sf_dir, table)
        entity = F.rtrim(F.col(alt).cast("string"))
        keys.append(d.select(F.lit(field).alias("field_name"), F.col(key).cast("bigint").alias("key"), entity.alias("entity")))
        s = standing(d, {"entity": entity, "start_date": F.col("start_date")}, ["end_date"])
        versions.append(s.select(F.lit(field).alias("field_name"), "entity", "start_date", "end_date"))
    union = lambda x: x[0].unionByName(x[1]).unionByName(x[2])
    return union(keys), union(versions)


@query
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.find(spark, _references(spark, sf_dir), *_parents(spark, sf_dir))


@query
def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct bad references per table, field, month and reason."""
    return p6_found(spark, sf_dir).groupBy("table_name", "field_name", "period_month", "reason").agg(F.count(F.lit(1)).alias("bad_keys"))


@query
def p6_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming copy's customers, by the month each version starts, that the batch copy doesn't know at that time."""
    key, batch = F.trim("customer_alternate_key"), load(spark, sf_dir, "dim_customer")
    refs = load(spark, sf_dir, "rt_dim_customer").select(F.lit("rt_dim_customer").alias("table_name"), F.lit("customer_alternate_key").alias("field_name"), key.alias("key"), F.col("start_date").alias("at"))
    keys = batch.select(F.lit("customer_alternate_key").alias("field_name"), key.alias("key"), key.alias("entity"))
    v = standing(batch, {"entity": key, "start_date": F.col("start_date")}, ["end_date"])
    return orphans.find(spark, refs, keys, v.select(F.lit("customer_alternate_key").alias("field_name"), "entity", "start_date", "end_date"))


SQL["p6_text_keys"] = """
WITH r AS (SELECT DISTINCT trim(customer_alternate_key) AS key, start_date AS tm FROM rt_dim_customer WHERE trim(customer_alternate_key) NOT IN ('', '0')),
v AS (SELECT trim(customer_alternate_key) AS key, start_date, end_date FROM dim_customer QUALIFY row_number() OVER (PARTITION BY trim(customer_alternate_key), start_date ORDER BY _version DESC) = 1),
told AS (SELECT r.key, r.tm, count(v.key) AS known, count(v.key) FILTER (v.start_date <= r.tm AND r.tm < v.end_date) AS valid, min(v.start_date) AS first FROM r LEFT JOIN v ON v.key = r.key GROUP BY ALL)
SELECT DISTINCT 'rt_dim_customer' AS table_name, 'customer_alternate_key' AS field_name, coalesce(strftime(tm, '%Y%m')::BIGINT, 190001) AS period_month, key AS ref_key,
  CASE WHEN known = 0 THEN 'missing' WHEN first > tm THEN 'later' ELSE 'deleted' END AS reason FROM told WHERE known = 0 OR (tm IS NOT NULL AND valid = 0)"""


_LIVE = "live AS (SELECT * FROM (SELECT * FROM fact_orders QUALIFY row_number() OVER (PARTITION BY order_id, product_key ORDER BY _version DESC) = 1) WHERE coalesce(is_deleted, 0) = 0)"


def _parent_sql(field: str, table: str, key: str, alt: str) -> tuple[str, str]:
    return (
        f"SELECT DISTINCT '{field}' AS f, {key}::BIGINT AS key, rtrim({alt}::VARCHAR) AS entity FROM {table}",
        f"SELECT '{field}' AS f, rtrim({alt}::VARCHAR) AS entity, start_date, end_date FROM {table} QUALIFY row_number() OVER (PARTITION BY rtrim({alt}::VARCHAR), start_date ORDER BY _version DESC) = 1",
    )


_PK, _PV = zip(*(_parent_sql(*x) for x in (("customer_key", "dim_customer", "customer_key", "customer_alternate_key"), ("product_key", "dim_products", "product_key", "product_alternate_key"), ("supplier_id", "dim_suppliers", "supplier_alternate_key", "supplier_alternate_key"))), strict=True)
_BAD = f"""
{_LIVE},
refs AS (SELECT 'fact_orders' AS t, 'customer_key' AS f, customer_key::BIGINT AS key, order_date AS tm FROM live UNION ALL SELECT 'fact_orders', 'product_key', product_key, order_date FROM live
  UNION ALL SELECT 'staging_products', 'supplier_id', supplier_id, snapshot_date FROM (SELECT * FROM staging_products QUALIFY row_number() OVER (PARTITION BY product_id, snapshot_date ORDER BY _loaded_at DESC, unit_price DESC NULLS LAST, supplier_id DESC NULLS LAST) = 1)),
r AS (SELECT DISTINCT * FROM refs WHERE key IS NOT NULL AND key <> 0),
ks AS ({' UNION ALL '.join(_PK)}), vs AS ({' UNION ALL '.join(f'({x})' for x in _PV)}),
told AS (SELECT r.t, r.f, r.key, r.tm, count(ks.entity) AS known, count(vs.entity) FILTER (vs.start_date <= r.tm AND r.tm < vs.end_date) AS valid, min(vs.start_date) AS first
  FROM r LEFT JOIN ks ON ks.f = r.f AND ks.key = r.key LEFT JOIN vs ON vs.f = r.f AND vs.entity = ks.entity GROUP BY ALL),
bad AS (SELECT DISTINCT t AS table_name, f AS field_name, coalesce(strftime(tm, '%Y%m')::BIGINT, 190001) AS period_month, key AS ref_key,
  CASE WHEN known = 0 THEN 'missing' WHEN first > tm THEN 'later' ELSE 'deleted' END AS reason FROM told WHERE known = 0 OR (tm IS NOT NULL AND valid = 0))"""
SQL["p6_found"] = f"WITH {_BAD} SELECT * FROM bad"
SQL["p6_counts"] = f"WITH {_BAD} SELECT table_name, field_name, period_month, reason, count(*) AS bad_keys FROM bad GROUP BY ALL"


# 7. Attributes as known at event time


def _lines_as_of(spark: SparkSession, sf_dir: str, values: list[str]) -> DataFrame:
    """Live lines with a date and a known employee, and the values of that employee's version valid then."""
    scratch = Scratch(spark)
    e = load(spark, sf_dir, "dim_employees")
    lines = live(load(spark, sf_dir, "fact_orders"), ["order_id", "product_key"], ["employee_key", "order_date"])
    owner = e.filter(F.col("employee_key").isNotNull()).groupBy("employee_key").agg(F.min("employee_alternate_key").alias("employee"))
    lines = look_up(lines.filter(F.col("order_date").isNotNull() & F.col("employee_key").isNotNull()), owner, "employee_key", F.col("order_id"), how="inner")
    lines = scratch.put(lines)
    own = ["employee_key", *values]
    versions = standing(e, {"employee": F.col("employee_alternate_key"), "start_date": F.col("start_date")}, ["end_date", "_version", *own])
    return asof.as_of(lines, versions, ["order_id", "product_key"], "employee", "order_date", own)


@query
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _lines_as_of(spark, sf_dir, []).withColumn("valid", F.coalesce("valid_employee_key", F.lit(0)))
    big = lambda c, n: F.col(c).cast("bigint").alias(n)
    return d.filter(F.col("valid") != F.col("employee_key")).select(big("order_id", "order_id"), big("product_key", "product_key"), big("employee_key", "employee_key"), big("valid", "valid_employee_key"))


@query
def p7_lines_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each such line with the employee's name, title and manager as they were at order_date."""
    d = _lines_as_of(spark, sf_dir, ["full_name", "title", "reports_to"])
    return d.select("order_id", "product_key", "order_date", "employee_key", "valid_employee_key", "full_name", "title", "reports_to")


_ASOF = f"""
{_LIVE},
owner AS (SELECT employee_key, min(employee_alternate_key) AS alt FROM dim_employees WHERE employee_key IS NOT NULL GROUP BY employee_key),
lines AS (SELECT l.order_id, l.product_key, l.employee_key, l.order_date, o.alt FROM live l JOIN owner o ON o.employee_key = l.employee_key WHERE l.order_date IS NOT NULL),
vs AS (SELECT * FROM dim_employees QUALIFY row_number() OVER (PARTITION BY employee_alternate_key, start_date ORDER BY _version DESC) = 1),
j AS (SELECT l.*, v.employee_key AS valid_employee_key, v.full_name, v.title, v.reports_to FROM lines l LEFT JOIN vs v ON v.employee_alternate_key = l.alt AND v.start_date <= l.order_date AND l.order_date < v.end_date
  QUALIFY row_number() OVER (PARTITION BY l.order_id, l.product_key ORDER BY v.start_date DESC NULLS LAST, v._version DESC, v.employee_key DESC) = 1)"""
SQL["p7_found"] = f"""
WITH {_ASOF}
SELECT order_id::BIGINT AS order_id, product_key::BIGINT AS product_key, employee_key::BIGINT AS employee_key, coalesce(valid_employee_key, 0)::BIGINT AS valid_employee_key
FROM j WHERE coalesce(valid_employee_key, 0) <> employee_key"""
SQL["p7_lines_as_of"] = f"WITH {_ASOF} SELECT order_id, product_key, order_date, employee_key, valid_employee_key, full_name, title, reports_to FROM j"
