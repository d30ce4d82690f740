"""Queries on whole loads: facts with all their keys, change windows, streamed dimensions, comparison boards.

Stand-ins, where the test data lacks a table: suppliers for employees, regions for shippers, customers'
nations and segments for addresses, documents for photographs.  A tenth of each dimension (id % 10 = 9) is
left out, so that facts need inferred members; orders with id % 10 = 0 are new, % 7 = 0 changed and
% 13 = 0 deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contract import DIMENSIONS, Dimension
from starloom.functions.text import hex_position, next_position
from starloom.functions.values import net_amount, zero
from starloom.operators import facts, keys, lake, pipeline, quality, scd, telemetry
from starloom.operators.standing import standing
from starloom.plans.problems import _COUNTING, _feed
from starloom.plans.star import C_OPEN, E_OPEN, F_SQL, P_OPEN, S_OPEN, Star
from starloom.sources.connectors import SOURCES, decode, encode
from starloom.sources.tables import Scratch, load
from starloom.streaming import applier, dimensions

QUERIES: dict = {}
SQL: dict[str, str] = {}
AT = "2025-06-01 00:00:00"


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _at():
    return F.lit(AT).cast("timestamp_ntz")


# Facts with all their keys

ADDRESS = {"ship_country": "country", "ship_region": "region", "ship_city": "city", "ship_postal_code": "postal_code", "ship_address": "address"}
KEYS = ["customer_key", "product_key", "employee_key", "shipper_key"]
_COLUMNS = ["order_id", "product_id", *KEYS, "geography_key", "order_date_key", "required_date_key", "shipped_date_key", "freight", "quantity", "line_total", "is_deleted", "_version"]


def _places(s: Star) -> DataFrame:
    """customer id and address columns; a region is missing for some."""
    c, n, r = s.raw("customer"), s.raw("nation"), s.raw("region")
    n = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ship_country"), F.when(F.col("n_nationkey") % 4 != 0, F.col("r_name")).alias("ship_region"))
    c = c.select(F.col("c_custkey").alias("customer_id"), "c_nationkey", F.col("c_mktsegment").alias("ship_city"), F.col("c_nationkey").cast("string").alias("ship_postal_code"), F.lit("").alias("ship_address"))
    return c.join(F.broadcast(n), "c_nationkey")  # 25 nations


def _geography(s: Star) -> DataFrame:
    """The address dimension, numbered in the order of its columns; addresses of every sixth nation are unknown."""
    d = _places(s).filter("c_nationkey % 6 <> 5").select(*(F.coalesce(F.col(a), F.lit("")).alias(b) for a, b in ADDRESS.items())).distinct()
    return keys.assign_keys_ordered(d, list(ADDRESS.values()), "geography_key")


def _headers(s: Star) -> DataFrame:
    o = s.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").cast("decimal(19,4)").alias("freight"), F.col("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("required_date"),
    )
    return o.join(_places(s).drop("c_nationkey"), "customer_id", "left")


def _lines(s: Star) -> DataFrame:
    """The last version of each (order, product)."""
    li = s.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("employee_id"), F.col("l_linenumber").alias("ship_via"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(19,4)").alias("unit_price"), F.col("l_discount").cast("float").alias("discount"), F.col("l_shipdate").alias("shipped_date"),
    )
    values = ["employee_id", "ship_via", "quantity", "unit_price", "discount", "shipped_date"]
    return standing(li, ["order_id", "product_id"], values, F.struct("shipped_date", "ship_via"))


def _references(s: Star) -> list[facts.Reference]:
    out = []
    for column, table, raw, key in (("customer_id", "dim_customer", "customer", "c_custkey"), ("product_id", "dim_products", "part", "p_partkey"), ("employee_id", "dim_employees", "supplier", "s_suppkey"), ("ship_via", "dim_shippers", "region", "r_regionkey")):
        d = DIMENSIONS[table]
        rows = s.raw(raw).filter(F.col(key) % 10 != 9).select((F.col(key) + 1).cast("bigint").alias(d.surrogate), F.col(key).cast("bigint").alias(d.alternate))
        out.append(facts.Reference(column, d, rows, keys.highest_key(rows, d.surrogate)))
    return out


def _loaded(s: Star, headers: DataFrame, lines: DataFrame, references: list[facts.Reference], version: int) -> DataFrame:
    lines = lines.withColumn("__sl_product", F.col("product_id"))  # the key's own column stays as the line's identity
    d, _ = facts.load(s.spark, headers, lines.withColumns({c: F.col(c).cast("bigint") for c in ("employee_id", "ship_via")}), "order_id", references, _geography(s), ADDRESS, ["order_date", "required_date", "shipped_date"], _at(), F.lit(version))
    return d.withColumnRenamed("__sl_product", "product_id").select(*_COLUMNS)


def _inferred_as_one(d: DataFrame, references: list[facts.Reference]) -> DataFrame:
    """Inferred members' keys follow no order that SQL knows; they are shown as -1."""
    return d.withColumns({r.dimension.surrogate: F.when(F.col(r.dimension.surrogate) > r.highest, F.lit(-1)).otherwise(F.col(r.dimension.surrogate)).cast("bigint") for r in references})


def _known(key: str, table: str, c: str) -> str:
    return f"CASE WHEN {key} IS NULL OR {key} = 0 AND {key} NOT IN (SELECT {c} FROM {table} WHERE {c} % 10 <> 9) THEN 0 WHEN {key} IN (SELECT {c} FROM {table} WHERE {c} % 10 <> 9) THEN {key} + 1 ELSE -1 END::BIGINT"


_DATE_KEY = "coalesce(year({0}) * 10000 + month({0}) * 100 + day({0}), 0)"
_PLACES = "places AS (SELECT c_custkey, c_nationkey, n_name AS country, CASE WHEN n_nationkey % 4 <> 0 THEN r_name ELSE '' END AS region, c_mktsegment AS city FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey)"
_GEO = f"{_PLACES}, geo AS (SELECT *, row_number() OVER (ORDER BY country, region, city, c_nationkey::VARCHAR) AS geography_key FROM (SELECT DISTINCT country, region, city, c_nationkey FROM places WHERE c_nationkey % 6 <> 5))"
_LAST = "li AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC) = 1)"


def _facts_sql(where: str, more: str, version: str) -> str:
    amount = f"CAST(CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DECIMAL(15,4)) * (l_quantity::INT + {more}) * (1 - CAST(round(l_discount::FLOAT::DOUBLE, 4) AS DECIMAL(9,4))) AS DECIMAL(19,4))"
    return f"""WITH {_GEO}, {_LAST}
SELECT l_orderkey AS order_id, l_partkey AS product_id, {_known('o_custkey', 'customer', 'c_custkey')} AS customer_key, {_known('l_partkey', 'part', 'p_partkey')} AS product_key,
  {_known('l_suppkey', 'supplier', 's_suppkey')} AS employee_key, {_known('l_linenumber', 'region', 'r_regionkey')} AS shipper_key, coalesce(g.geography_key, 0)::BIGINT AS geography_key,
  {_DATE_KEY.format('o_orderdate')}::BIGINT AS order_date_key, CASE WHEN o_orderkey % 5 <> 0 THEN {_DATE_KEY.format('(o_orderdate + INTERVAL 30 DAY)')} ELSE 0 END::BIGINT AS required_date_key,
  {_DATE_KEY.format('l_shipdate')}::BIGINT AS shipped_date_key, CAST(o_totalprice AS DECIMAL(19,4)) + {more} AS freight, (l_quantity::INT + {more})::BIGINT AS quantity, {amount} AS line_total, {version} AS version
FROM li JOIN orders ON o_orderkey = l_orderkey LEFT JOIN places p ON p.c_custkey = o_custkey LEFT JOIN geo g ON g.country = p.country AND g.region = p.region AND g.city = p.city AND g.c_nationkey = p.c_nationkey WHERE {where}"""


def _shown(d: DataFrame) -> DataFrame:
    big = lambda c: F.col(c).cast("bigint").alias(c)
    return d.select(*map(big, _COLUMNS[:10]), F.col("freight").cast("decimal(19,4)").alias("freight"), big("quantity"), "line_total", F.col("_version").alias("version"))


@query(_facts_sql("true", "0", "1::BIGINT"))
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load: every line with four keys, inferred members among them, its address key and three date keys."""
    s = Star(spark, sf_dir)
    refs = _references(s)
    return _shown(_inferred_as_one(_loaded(s, _headers(s), _lines(s), refs, 1), refs))


def _changed(d: DataFrame, *columns: str) -> DataFrame:
    return d.withColumns({c: (F.col(c) + F.when(F.col("order_id") % 7 == 0, 1).otherwise(0)).cast(d.schema[c].dataType) for c in columns})


def _window(s: Star) -> DataFrame:
    """Order changes after the first load, several for some orders."""
    o = s.raw("orders").select(F.col("o_orderkey").alias("order_id"))
    kinds = F.array_compact(F.array(*(F.when(F.col("order_id") % n == 0, F.struct(F.lit(op).alias("operation"), F.lit(v).alias("_version"))) for n, op, v in ((10, 2, 10), (7, 4, 11), (13, 1, 12)))))
    return o.select("order_id", F.explode(kinds).alias("c")).select("order_id", "c.operation", "c._version")


@query(_facts_sql("l_orderkey % 13 <> 0", "CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END", "CASE WHEN l_orderkey % 10 = 0 OR l_orderkey % 7 = 0 THEN 20 ELSE 1 END::BIGINT"))
def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live facts after a window of inserts, updates and deletes was applied to the first load."""
    s, scratch = Star(spark, sf_dir), Scratch(spark)
    refs = _references(s)
    before = scratch.put(_loaded(s, _headers(s).filter("order_id % 10 <> 0"), _lines(s).filter("order_id % 10 <> 0"), refs, 1))
    rebuild = lambda h, l: _loaded(s, h, l, refs, 20)
    written = scratch.put(facts.incremental(before, _window(s), _changed(_headers(s), "freight"), _changed(_lines(s), "quantity"), "order_id", ["order_id", "product_id"], rebuild, F.lit(20)))
    now = facts.apply(before, written, ["order_id", "product_id"]).filter("is_deleted = 0")
    return _shown(_inferred_as_one(now, refs))


_POS = "lpad(right(ltrim(regexp_replace(regexp_replace(lower(trim({0})), '^0x', ''), '[^0-9a-f]', '', 'g'), '0'), 20), 20, '0')"


@query(f"WITH c AS (SELECT rtrim(capture_instance) AS capture_instance, max({_POS.format('start_lsn')}) AS upto, count(*) AS n FROM order_changes GROUP BY ALL), s AS (SELECT rtrim(capture_instance) AS capture_instance, {_POS.format('last_lsn')} AS last FROM stream_state), w AS (SELECT rtrim(o.capture_instance) AS capture_instance, count(*) AS changes, max({_POS.format('start_lsn')}) AS upto FROM order_changes o JOIN s ON s.capture_instance = rtrim(o.capture_instance) WHERE s.last IS NULL OR {_POS.format('start_lsn')} > s.last GROUP BY ALL) SELECT s.capture_instance, coalesce(w.upto, s.last) AS last_lsn, coalesce(w.changes, 0) AS changes FROM s LEFT JOIN w USING (capture_instance)")
def cdc_next_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's changes after the position in the state, and the state once they are applied."""
    name = F.rtrim("capture_instance").alias("capture_instance")
    state = load(spark, sf_dir, "stream_state").select(name, hex_position(F.col("last_lsn")).alias("last_lsn"))
    changes = load(spark, sf_dir, "order_changes").select(name, hex_position(F.col("start_lsn")).alias("start_lsn"))
    w = pipeline.unread(changes, state, "capture_instance", "start_lsn", "last_lsn")
    n = w.groupBy("capture_instance").agg(F.count(F.lit(1)).alias("changes"))
    after = pipeline.read_upto(w, state, "capture_instance", "start_lsn", "last_lsn")
    return after.join(n, "capture_instance", "left").select("capture_instance", "last_lsn", F.coalesce("changes", F.lit(0)).alias("changes"))


@query(f"SELECT {_POS.format('start_lsn')} AS lsn, max(commit_time) AS committed_at, lpad(lower(printf('%x', ('0x' || right({_POS.format('start_lsn')}, 12))::BIGINT + 1)), 12, '0') AS next_tail FROM order_changes WHERE start_lsn IS NOT NULL GROUP BY ALL")
def lsn_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each position was committed, and the last twelve digits of the position after it."""
    c = load(spark, sf_dir, "order_changes").select(hex_position(F.col("start_lsn")).alias("lsn"), F.col("commit_time").alias("committed_at"))
    return pipeline.position_times(c, "lsn", "committed_at").withColumn("next_tail", F.right(next_position(F.col("lsn")), F.lit(12)))


# Rows, where other queries compare totals


@query("SELECT p_partkey AS product_id, count(*) OVER () AS keys, true AS dense FROM part")
def surrogate_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part has one key, and the keys together are 101 .. 100 + n."""
    d = keys.assign_keys(load(spark, sf_dir, "part").select("p_partkey"), "p_partkey", "product_key", 100)
    n = d.agg(F.count(F.lit(1)).alias("keys"), F.countDistinct("product_key").alias("distinct"), F.max("product_key").alias("last"), F.min("product_key").alias("first")).select("keys", ((F.col("distinct") == F.col("keys")) & (F.col("first") == 101) & (F.col("last") == 100 + F.col("keys"))).alias("dense"))
    return d.select(F.col("p_partkey").alias("product_id"), F.lit(1).alias("one")).join(F.broadcast(n.withColumn("one", F.lit(1))), "one").drop("one")  # one row


_UPDATES = "u AS (SELECT supplier_id, updated_at, rtrim(coalesce(contact_name, '')) AS contact_name, rtrim(coalesce(phone, '')) AS phone FROM staging_suppliers WHERE supplier_id IS NOT NULL AND updated_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY supplier_id, updated_at ORDER BY _loaded_at DESC, rtrim(coalesce(contact_name, '')) DESC, rtrim(coalesce(phone, '')) DESC) = 1)"
_SEQUENCE = f"{_UPDATES}, c AS (SELECT *, sum(cut) OVER (PARTITION BY supplier_id ORDER BY updated_at) AS version_no FROM (SELECT *, (contact_name IS DISTINCT FROM lag(contact_name) OVER (PARTITION BY supplier_id ORDER BY updated_at))::INT AS cut FROM u)), v AS (SELECT supplier_id, version_no, min(updated_at) AS start_date, max_by(phone, updated_at) AS phone, max_by(contact_name, updated_at) AS contact_name FROM c GROUP BY ALL)"
_SEQUENCE_ROWS = f"WITH {_SEQUENCE} SELECT supplier_id::BIGINT AS supplier_id, version_no::BIGINT AS version_no, contact_name, phone, start_date, coalesce(lead(start_date) OVER (PARTITION BY supplier_id ORDER BY version_no), TIMESTAMP '2106-01-01') AS end_date FROM v"


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.coalesce(F.rtrim(c), F.lit("")).alias(c)
    u = load(spark, sf_dir, "staging_suppliers").filter(F.col("supplier_id").isNotNull() & F.col("updated_at").isNotNull()).select("supplier_id", "updated_at", "_loaded_at", text("contact_name"), text("phone"))
    return standing(u, ["supplier_id", "updated_at"], ["contact_name", "phone"], "_loaded_at")


@query(_SEQUENCE_ROWS)
def scd_sequential_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version that a supplier's updates make one after the other."""
    v = scd.sequence(_updates(spark, sf_dir), "supplier_id", "updated_at", "updated_at", ["phone"], ["contact_name"])
    return v.select(F.col("supplier_id").cast("bigint").alias("supplier_id"), "version_no", "contact_name", "phone", "start_date", "end_date")


_FAULTS = {"dim_customer": "phone", "dim_products": "unit_price", "dim_employees": "notes", "dim_suppliers": "home_page"}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', 'missing in table: {c}'), ('{t}', 'not in contract: other')" for t, c in _FAULTS.items()) + ", ('dim_products', 'type of discontinued: string, not int')) t(table_name, problem)")
def contract_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the contract says of stored dimensions with planted faults: a column gone, one too many, one of another type."""
    said = []
    for t, gone in _FAULTS.items():
        d = load(spark, sf_dir, t).drop(gone).withColumn("other", F.lit(1))
        d = d.withColumn("discontinued", F.col("discontinued").cast("string")) if t == "dim_products" else d
        said += [(t, x) for x in DIMENSIONS[t].differences(d.schema)]
    return spark.createDataFrame(said, "table_name string, problem string")


_TYPES = {"int": "0", "bigint": "0", "smallint": "0", "float": "0.0", "double": "0.0", "decimal(19,4)": "0.0000", "string": "", "boolean": "false", "date": "1900-01-01", "timestamp_ntz": "1970-01-01 00:00:00"}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{v}')" for t, v in _TYPES.items()) + ") t(type, zero)")
def zero_value_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands for null in a column of each type."""
    from pyspark.sql import types as T

    kinds = {f.name: f.dataType for f in T.StructType.fromDDL(", ".join(f"`{t}` {t}" for t in _TYPES))}
    each = F.array(*(F.struct(F.lit(t).alias("type"), zero(k).cast("string").alias("zero")) for t, k in kinds.items()))
    return spark.range(1).select(F.inline(each))


@query("SELECT supplier_id::BIGINT AS supplier_id, updated_at, (coalesce(contact_name, '~') <> coalesce(phone, '~'))::BOOLEAN AS differ FROM staging_suppliers")
def null_safe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null-safe inequality of two columns that are null at times."""
    from starloom.functions.values import any_differs

    return load(spark, sf_dir, "staging_suppliers").select(F.col("supplier_id").cast("bigint").alias("supplier_id"), "updated_at", any_differs([(F.col("contact_name"), F.col("phone"))]).alias("differ"))


@query("SELECT * FROM (VALUES ('customer_key', (SELECT max(customer_key) FROM dim_customer)), ('product_key', (SELECT max(product_key) FROM dim_products)), ('employee_key', (SELECT max(employee_key) FROM dim_employees)), ('supplier_key', (SELECT max(supplier_key) FROM dim_suppliers)), ('rt_customer_key', (SELECT max(customer_key) FROM rt_dim_customer)), ('geography_key', 0), ('empty_key', 0)) t(key, highest)")
def high_water_marks_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest surrogate key of each dimension; 0 for empty ones."""
    tables = {"customer_key": ("dim_customer", "customer_key"), "product_key": ("dim_products", "product_key"), "employee_key": ("dim_employees", "employee_key"), "supplier_key": ("dim_suppliers", "supplier_key"), "rt_customer_key": ("rt_dim_customer", "customer_key")}
    marks = [(k, keys.highest_key(load(spark, sf_dir, t), c)) for k, (t, c) in tables.items()]
    nothing = spark.createDataFrame([], "k int")
    return spark.createDataFrame([*marks, ("geography_key", keys.highest_key(nothing, "k")), ("empty_key", keys.highest_key(nothing, "k"))], "key string, highest int")


@query("SELECT DISTINCT l_suppkey AS employee_id, c_nationkey AS territory_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE l_suppkey % 10 <> 9 AND c_nationkey % 5 <> 4")
def bridge_known_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of employee and territory of which both are known."""
    s = Star(spark, sf_dir)
    pairs = s.raw("lineitem").select("l_orderkey", F.col("l_suppkey").alias("employee_id")).join(s.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")), "l_orderkey")
    pairs = pairs.join(s.raw("customer").select("c_custkey", F.col("c_nationkey").alias("territory_id")), "c_custkey").select("employee_id", "territory_id").distinct()
    left = s.raw("supplier").filter("s_suppkey % 10 <> 9").select(F.col("s_suppkey").alias("employee_id"))
    return facts.bridge(pairs, left, s.raw("nation").filter("n_nationkey % 5 <> 4").select(F.col("n_nationkey").alias("territory_id")), "employee_id", "territory_id")


_STORED = "customer dim_customer dim_employees dim_products dim_suppliers documents events fact_orders lineitem nation order_changes orders part region rt_dim_customer staging_products staging_suppliers stream_events stream_state supplier".split()


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _STORED))
def storage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every stored table as their files tell."""
    from starloom.sources.connectors import storage

    out = None
    for t in _STORED:
        one = storage(load(spark, sf_dir, t), t).select("table_name", "rows")
        out = one if out is None else out.unionByName(one)
    return out


# Views


@query(f"WITH {P_OPEN} SELECT product_key::BIGINT AS product_key, product_alternate_key::BIGINT AS product_id, product_name, category_name, unit_price, discontinued::BIGINT AS discontinued, start_date FROM po")
def current_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Star(spark, sf_dir).open("dim_products", "product_alternate_key", "product_key", "product_name", "category_name", "unit_price", "discontinued")
    return p.select(F.col("product_key").cast("bigint").alias("product_key"), F.col("product_alternate_key").cast("bigint").alias("product_id"), "product_name", "category_name", "unit_price", F.col("discontinued").cast("bigint").alias("discontinued"), "start_date")


@query(f"WITH {E_OPEN} SELECT employee_key::BIGINT AS employee_key, employee_alternate_key::BIGINT AS employee_id, full_name, title, hire_date, date_diff('year', birth_date, DATE '2024-12-31') AS age FROM eo")
def current_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open employees with their age at the end of 2024, as a computed column."""
    from starloom.functions.values import years_between

    e = Star(spark, sf_dir).open("dim_employees", "employee_alternate_key", "employee_key", "full_name", "title", "hire_date", "birth_date")
    age = years_between(F.col("birth_date"), F.lit("2024-12-31").cast("date")).cast("bigint").alias("age")
    return e.select(F.col("employee_key").cast("bigint").alias("employee_key"), F.col("employee_alternate_key").cast("bigint").alias("employee_id"), "full_name", "title", "hire_date", age)


@query(f"WITH {S_OPEN} SELECT supplier_key::BIGINT AS supplier_key, supplier_alternate_key::BIGINT AS supplier_id, company_name, contact_name, start_date FROM so")
def current_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Star(spark, sf_dir).open("dim_suppliers", "supplier_alternate_key", "supplier_key", "company_name", "contact_name")
    return p.select(F.col("supplier_key").cast("bigint").alias("supplier_key"), F.col("supplier_alternate_key").cast("bigint").alias("supplier_id"), "company_name", "contact_name", "start_date")


@query("SELECT n_nationkey::BIGINT AS territory_key, rtrim(n_name) AS territory, rtrim(r_name) AS region FROM nation LEFT JOIN region ON r_regionkey = n_regionkey")
def current_territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Star(spark, sf_dir).geography
    return g.select(F.col("geo").cast("bigint").alias("territory_key"), F.col("country").alias("territory"), "region")


@query("SELECT r_regionkey::BIGINT AS region_id, CASE WHEN r_regionkey % 2 = 0 THEN rtrim(r_name) || ' (new)' ELSE rtrim(r_name) END AS region_name, CASE WHEN r_regionkey % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS version FROM region")
def reference_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference table imported with version 1, some rows changed by a later version, read as its current view."""
    r = load(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("region_id"), F.rtrim("r_name").alias("region_name"))
    first = pipeline.seed_reference(r)
    later = r.filter("region_id % 2 = 0").select("region_id", F.concat("region_name", F.lit(" (new)")).alias("region_name"), F.lit(2).cast("bigint").alias("_version"))
    return standing(first.unionByName(later), ["region_id"], ["region_name", "_version"]).withColumnRenamed("_version", "version")


@query(f"WITH {E_OPEN} SELECT e.employee_key::BIGINT AS employee_key, e.employee_alternate_key::BIGINT AS employee_code, e.full_name, e.title, rtrim(n_name) AS country, d.doc_id, coalesce(strlen(d.text), 0)::BIGINT AS size_bytes FROM eo e LEFT JOIN nation ON n_nationkey = e.geography_key % 25 LEFT JOIN documents d ON d.doc_id = e.employee_alternate_key")
def employee_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open employees with their country and the catalogued photograph of their code."""
    s = Star(spark, sf_dir)
    e = s.open("dim_employees", "employee_alternate_key", "employee_key", "full_name", "title", "geography_key").withColumn("geo", F.pmod("geography_key", F.lit(25)))
    photos = lake.catalogue(s.raw("documents").select("doc_id", "text"), "doc_id", "text").select(F.col("doc_id").alias("employee_code"), "doc_id", "size_bytes")
    e = e.join(s.geography, "geo", "left").withColumn("employee_code", F.col("employee_alternate_key").cast("bigint")).join(photos, "employee_code", "left")
    return e.select(F.col("employee_key").cast("bigint").alias("employee_key"), "employee_code", "full_name", "title", "country", "doc_id", F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"))


# Boards


def _stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as the streaming path has them."""
    t = _feed(spark, sf_dir)
    d = t.live().join(t.headers(), "order_id", "left")
    return d.select("order_id", "product_id", net_amount(F.col("unit_price"), F.col("quantity"), F.col("discount")).alias("line_total"), "order_date")


_STREAM_LINES = f"{_COUNTING}, headers AS (SELECT * FROM counting WHERE ci = 'dbo_Orders' AND operation <> 1 QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC, seq DESC) = 1), sl AS (SELECT o.order_id, o.product_id, CAST(CAST(o.unit_price AS DECIMAL(15,4)) * o.quantity * (1 - CAST(round(o.discount::DOUBLE, 4) AS DECIMAL(9,4))) AS DECIMAL(19,4)) AS line_total, h.order_date FROM own o LEFT JOIN gone g ON g.order_id = o.order_id LEFT JOIN headers h ON h.order_id = o.order_id WHERE o.operation <> 1 AND (g.pos IS NULL OR g.pos <= o.lsn || o.seq))"


@query(f"WITH {F_SQL}, {_STREAM_LINES} SELECT 'batch' AS path, round(sum(line_total), 2)::DOUBLE AS revenue, count(DISTINCT order_id) AS orders, count(*) AS lines FROM f UNION ALL SELECT 'stream', round(sum(line_total), 2)::DOUBLE, count(DISTINCT order_id), count(*) FROM sl")
def paths_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, orders and lines of the batch and of the streaming path."""
    batch = Star(spark, sf_dir).facts("line_total").select("order_id", "line_total")
    one = lambda d, n: d.agg(F.round(F.sum("line_total"), 2).cast("double").alias("revenue"), F.countDistinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines")).select(F.lit(n).alias("path"), "*")
    return one(batch, "batch").unionByName(one(_stream_lines(spark, sf_dir).select("order_id", "line_total"), "stream"))


@query(f"WITH {F_SQL}, {_STREAM_LINES}, b AS (SELECT date_trunc('month', order_date)::TIMESTAMP AS month, count(DISTINCT order_id) AS n FROM f GROUP BY ALL), s AS (SELECT date_trunc('month', order_date)::TIMESTAMP AS month, count(DISTINCT order_id) AS n FROM sl GROUP BY ALL) SELECT coalesce(b.month, s.month) AS month, coalesce(b.n, 0) AS batch_orders, coalesce(s.n, 0) AS stream_orders FROM b FULL JOIN s ON b.month IS NOT DISTINCT FROM s.month")
def paths_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month of both paths."""
    month = F.date_trunc("month", "order_date").cast("timestamp_ntz").alias("month")
    each = lambda d, side: d.select(F.lit(side).alias("side"), month, "order_id").distinct()
    d = each(Star(spark, sf_dir).facts("order_date"), "b").unionByName(each(_stream_lines(spark, sf_dir), "s"))
    return d.groupBy("month").agg(F.count_if(F.col("side") == "b").alias("batch_orders"), F.count_if(F.col("side") == "s").alias("stream_orders"))


def _overlap_sql(name: str, left: str, right: str) -> str:
    return f"SELECT '{name}' AS dimension, (SELECT count(*) FROM ({left})) AS batch_rows, (SELECT count(*) FROM ({right})) AS stream_rows, (SELECT count(*) FROM ({left} INTERSECT {right})) AS in_both"


_RT = "SELECT trim(customer_alternate_key) AS k FROM (SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY trim(customer_alternate_key), start_date ORDER BY _version DESC) = 1) WHERE end_date = TIMESTAMP '2106-01-01' GROUP BY 1"


@query(f"WITH {P_OPEN}, {S_OPEN}, {E_OPEN}, {F_SQL}, {_STREAM_LINES} " + " UNION ALL ".join([
    _overlap_sql("DimCustomer", _RT.format(t="dim_customer"), _RT.format(t="rt_dim_customer")),
    _overlap_sql("DimProducts", "SELECT product_alternate_key::BIGINT AS k FROM po", "SELECT DISTINCT product_id::BIGINT AS k FROM staging_products WHERE product_id IS NOT NULL"),
    _overlap_sql("DimSuppliers", "SELECT supplier_alternate_key::BIGINT AS k FROM so", "SELECT DISTINCT supplier_id::BIGINT AS k FROM staging_suppliers WHERE supplier_id IS NOT NULL"),
    _overlap_sql("DimEmployees", "SELECT employee_alternate_key::BIGINT AS k FROM eo", "SELECT DISTINCT employee_alternate_key::BIGINT AS k FROM dim_employees WHERE employee_alternate_key IS NOT NULL"),
    _overlap_sql("FactOrders", "SELECT DISTINCT order_id::BIGINT AS k FROM f", "SELECT DISTINCT order_id::BIGINT AS k FROM sl"),
]))
def path_comparison_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of either path and in both, for each dimension and the facts; staging stands for streamed products and suppliers."""
    from starloom.operators.standing import current

    s = Star(spark, sf_dir)
    key = lambda d, c: d.filter(F.col(c).isNotNull()).select(F.col(c).cast("bigint").cast("string").alias("k")).distinct()
    customers = lambda t: current(s.raw(t), {"k": F.trim("customer_alternate_key")}, ["phone"]).select("k")
    pairs = {
        "DimCustomer": (customers("dim_customer"), customers("rt_dim_customer")),
        "DimProducts": (key(s.open("dim_products", "product_alternate_key"), "product_alternate_key"), key(s.raw("staging_products"), "product_id")),
        "DimSuppliers": (key(s.open("dim_suppliers", "supplier_alternate_key"), "supplier_alternate_key"), key(s.raw("staging_suppliers"), "supplier_id")),
        "DimEmployees": (key(s.open("dim_employees", "employee_alternate_key"), "employee_alternate_key"), key(s.raw("dim_employees"), "employee_alternate_key")),
        "FactOrders": (key(s.facts(), "order_id"), key(_stream_lines(spark, sf_dir), "order_id")),
    }
    out = None
    for name, (batch, stream) in pairs.items():
        one = quality.overlap(batch, stream, "k").select(F.lit(name).alias("dimension"), "batch_rows", "stream_rows", "in_both")
        out = one if out is None else out.unionByName(one)
    return out


@query("WITH b AS (SELECT * FROM (SELECT trim(customer_alternate_key) AS k, * FROM (SELECT * FROM dim_customer QUALIFY row_number() OVER (PARTITION BY trim(customer_alternate_key), start_date ORDER BY _version DESC) = 1) WHERE end_date = TIMESTAMP '2106-01-01') QUALIFY row_number() OVER (PARTITION BY k ORDER BY start_date DESC) = 1), s AS (SELECT * FROM (SELECT trim(customer_alternate_key) AS k, * FROM (SELECT * FROM rt_dim_customer QUALIFY row_number() OVER (PARTITION BY trim(customer_alternate_key), start_date ORDER BY _version DESC) = 1) WHERE end_date = TIMESTAMP '2106-01-01') QUALIFY row_number() OVER (PARTITION BY k ORDER BY start_date DESC) = 1) SELECT coalesce(b.k, s.k) AS k, CASE WHEN s.k IS NULL THEN 'batch only' WHEN b.k IS NULL THEN 'stream only' ELSE 'differs' END AS status FROM b FULL JOIN s ON b.k = s.k WHERE b.k IS NULL OR s.k IS NULL OR (b.company_name, b.contact_name, b.contact_title, b.phone, b.fax) IS DISTINCT FROM (s.company_name, s.contact_name, s.contact_title, s.phone, s.fax)")
def customer_drift_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift over all five attributes."""
    from starloom.operators.standing import current

    five = ["company_name", "contact_name", "contact_title", "phone", "fax"]
    side = lambda t: current(load(spark, sf_dir, t), {"k": F.trim("customer_alternate_key")}, five)
    return quality.drift(side("dim_customer"), side("rt_dim_customer"), "k", five)


@query("SELECT date_trunc('hour', event_time)::TIMESTAMP AS interval_start, capture_instance, count(*) AS events FROM stream_events GROUP BY ALL")
def events_per_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and source."""
    return load(spark, sf_dir, "stream_events").groupBy(F.date_trunc("hour", "event_time").alias("interval_start"), "capture_instance").agg(F.count(F.lit(1)).alias("events"))


@query("WITH h AS (SELECT order_id, max(received_at) AS seen FROM order_changes WHERE rtrim(capture_instance) = 'dbo_Orders' AND order_id IS NOT NULL GROUP BY ALL) SELECT count(*) AS headers_cached FROM h WHERE seen >= (SELECT max(seen) FROM h) - INTERVAL 7 DAY")
def headers_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers within their time to live."""
    c = load(spark, sf_dir, "order_changes").filter((F.rtrim("capture_instance") == "dbo_Orders") & F.col("order_id").isNotNull())
    h = c.groupBy("order_id").agg(F.max("received_at").alias("seen"))
    last = h.agg(F.max("seen")).first()[0]
    return telemetry.keep_newer(h, "seen", 7, F.lit(last).cast("timestamp_ntz")).agg(F.count(F.lit(1)).alias("headers_cached"))


@query("SELECT capture_instance, round(avg(lag_ms), 3) AS avg_lag FROM (SELECT capture_instance, epoch_ms(event_time) - epoch_ms(source_time) AS lag_ms FROM stream_events) GROUP BY ALL")
def lag_recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag from the two times instead of the stored number."""
    e = load(spark, sf_dir, "stream_events").select("capture_instance", telemetry.lag_ms(F.col("event_time"), F.col("source_time")).alias("lag_ms"))
    return e.groupBy("capture_instance").agg(F.round(F.avg("lag_ms"), 3).alias("avg_lag"))


@query("SELECT 'region' AS step, count(*) AS rows, 'success' AS status FROM region UNION ALL SELECT 'nation', count(*), 'success' FROM nation UNION ALL SELECT 'supplier', count(*), 'success' FROM supplier")
def load_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log after three loaders ran in the order of what they need."""
    scratch = Scratch(spark)
    root, log = scratch.path(), scratch.path()
    loaders = {t: (lambda t=t: load(spark, sf_dir, t)) for t in ("supplier", "nation", "region")}
    pipeline.run_all(spark, loaders, root, log, {"region": set(), "nation": {"region"}, "supplier": {"nation"}})
    return spark.read.parquet(log).select("step", "rows", "status")


# Streams


def _messages(frames: list[DataFrame], scratch: Scratch) -> str:
    """Frames of messages (key, value) as files that a stream reads one after the other."""
    path = scratch.path()
    for f in frames:
        f.coalesce(1).write.mode("append").json(path)
    return path


def _data(c: str, type_: str):
    return F.try_element_at("data", F.lit(c)).try_cast(type_).alias(c)


_SUPPLIER = Dimension("dim_suppliers", "supplier_key", "supplier_alternate_key", "phone string", "contact_name string", {"supplier_alternate_key": "supplier_id"})


def _supplier_rows(df: DataFrame) -> DataFrame:
    d = decode(df).filter(F.col("capture_instance").isNotNull())
    source = d.select(_data("supplier_id", "bigint"), _data("contact_name", "string"), _data("phone", "string"), F.col("source_time").cast("timestamp_ntz").alias("at"), F.col("lsn").alias("position"))
    return _SUPPLIER.rows(source, "at", "position")


def _supplier_messages(spark: SparkSession, sf_dir: str, parts: int) -> list[DataFrame]:
    """Supplier updates as envelopes, in as many files by year of update; the last one holds all later years."""
    u = _updates(spark, sf_dir).withColumns({"op": F.lit(4), "lsn": F.date_format("updated_at", "yyyyMMddHHmmssSSSSSS"), "seq": F.lit("0")})
    m = encode(u, SOURCES[6], "lsn", "seq", "op", "updated_at", ["supplier_id", "contact_name", "phone"])
    first = u.agg(F.min(F.year("updated_at"))).first()[0] or 0
    span = F.least(F.left(F.get_json_object("value", "$.source_time"), F.lit(4)).cast("int") - first, F.lit(parts - 1))
    return [m.filter(span == i) for i in range(parts)]


def _stream_suppliers(spark: SparkSession, sf_dir: str, before: Callable | None = None, twice: bool = False) -> dimensions.DimensionTable:
    scratch = Scratch(spark)
    table = dimensions.DimensionTable(spark, scratch.path(), _SUPPLIER)
    if before:
        before(table)
    frames = _supplier_messages(spark, sf_dir, 3)
    path = _messages(frames + frames[:2] if twice else frames, scratch)
    with dimensions.Lease(spark, table.path):
        dimensions.apply_dimension(applier.read_files(spark, path), table, _supplier_rows, scratch.path()).awaitTermination()
    return table


def _version_rows(t: dimensions.DimensionTable) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("supplier_alternate_key").orderBy("start_date")
    return t.rows().select(F.col("supplier_alternate_key").alias("supplier_id"), F.row_number().over(w).cast("bigint").alias("version_no"), "contact_name", "phone", "start_date", "end_date")


@query(_SEQUENCE_ROWS)
def stream_dimension_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier updates applied by a stream in three micro-batches: every version with its period."""
    return _version_rows(_stream_suppliers(spark, sf_dir))


@query(_SEQUENCE_ROWS)
def stream_dimension_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after two of the three files were delivered once more."""
    return _version_rows(_stream_suppliers(spark, sf_dir, twice=True))


_NAMED = "SELECT DISTINCT supplier_id::BIGINT AS k FROM staging_products WHERE supplier_id IS NOT NULL AND supplier_id <> 0"


@query(f"WITH n AS ({_NAMED}), u AS (SELECT DISTINCT supplier_id::BIGINT AS k FROM staging_suppliers WHERE supplier_id IS NOT NULL AND updated_at IS NOT NULL) SELECT coalesce(n.k, u.k) AS supplier_id, CASE WHEN u.k IS NULL THEN 1 ELSE 0 END::BIGINT AS inferred, n.k IS NOT NULL AS key_from_stub FROM n FULL JOIN u ON n.k = u.k")
def stream_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that products named before they were streamed: inferred members, filled in place under the same key."""
    wanted = load(spark, sf_dir, "staging_products").select(F.col("supplier_id").cast("bigint").alias("supplier_alternate_key")).distinct()
    held = {}

    def infer(t: dimensions.DimensionTable) -> None:
        t.ensure(wanted, F.lit("2000-01-01").cast("timestamp_ntz"), F.lit(0))
        held["stubs"] = Scratch(spark).put(t.rows().select(F.col("supplier_key").alias("stub_key"), F.col("supplier_alternate_key").alias("k")))

    t = _stream_suppliers(spark, sf_dir, infer)
    first = t.rows().groupBy("supplier_alternate_key").agg(F.min_by("supplier_key", "start_date").alias("key"), F.max("is_inferred").cast("bigint").alias("inferred"))
    d = first.join(held["stubs"], F.col("supplier_alternate_key") == F.col("k"), "left")
    return d.select(F.col("supplier_alternate_key").alias("supplier_id"), "inferred", F.coalesce(F.col("key") == F.col("stub_key"), F.lit(False)).alias("key_from_stub"))


@query(f"WITH {S_OPEN}, seed AS (SELECT supplier_alternate_key::BIGINT AS k FROM so), u AS (SELECT DISTINCT supplier_id::BIGINT AS k FROM staging_suppliers WHERE supplier_id IS NOT NULL AND updated_at IS NOT NULL) SELECT coalesce(seed.k, u.k) AS supplier_id, seed.k IS NOT NULL AS seeded, u.k IS NOT NULL AS streamed FROM seed FULL JOIN u ON seed.k = u.k")
def stream_after_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table seeded from the batch warehouse's open rows, then kept by the stream: no supplier lost, keys continued."""
    now = Star(spark, sf_dir).open("dim_suppliers", "supplier_alternate_key", "supplier_key", "phone", "contact_name")

    def seed(t: dimensions.DimensionTable) -> None:
        rows = now.withColumns({"start_date": F.lit("2000-01-01").cast("timestamp_ntz"), "is_inferred": F.lit(0), "position": F.lit(""), "_version": F.lit(0)})
        t._append(rows.withColumns({c: F.coalesce(F.rtrim(c), F.lit("")) for c in ("phone", "contact_name")}))

    t = _stream_suppliers(spark, sf_dir, seed)
    d = t.rows().groupBy(F.col("supplier_alternate_key").alias("supplier_id")).agg((F.min("start_date") == F.lit("2000-01-01").cast("timestamp_ntz")).alias("seeded"), (F.max("position") > "").alias("streamed"))
    return d


_PAIR = "SELECT DISTINCT l_suppkey AS employee_id, l_linenumber::BIGINT AS territory_id FROM lineitem"


@query(f"SELECT employee_id, territory_id FROM ({_PAIR}) WHERE (employee_id + territory_id) % 3 <> 0 OR (employee_id + territory_id) % 2 = 0")
def stream_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge rows added, every third one deleted, and half of those added again, by three micro-batches of which the last comes twice."""
    scratch = Scratch(spark)
    p = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("employee_id"), F.col("l_linenumber").cast("bigint").alias("territory_id")).distinct()
    n = F.col("employee_id") + F.col("territory_id")
    steps = [(p, 2, "01"), (p.filter(n % 3 == 0), 1, "02"), (p.filter((n % 3 == 0) & (n % 2 == 0)), 2, "03")]
    source = SOURCES[2]
    frames = [encode(d.withColumns({"op": F.lit(op), "lsn": F.lit(lsn), "seq": F.lit("0"), "at": F.lit(AT).cast("timestamp_ntz")}), source, "lsn", "seq", "op", "at", ["employee_id", "territory_id"]) for d, op, lsn in steps]
    table = dimensions.BridgeTable(spark, scratch.path(), "employee_id", "territory_id")

    def batch(df: DataFrame, _: int) -> None:
        table.append(decode(df).select(_data("employee_id", "bigint"), _data("territory_id", "bigint"), (F.col("operation") == "1").cast("int").alias("is_deleted"), F.col("lsn").alias("position")))

    applier.run_to_end(applier.read_files(spark, _messages([*frames, frames[2]], scratch)), batch, scratch.path())
    return table.pairs()


_EMPLOYEE = Dimension("dim_employees", "employee_key", "employee_alternate_key", "parent_employee_key bigint", "reports_to bigint", {"employee_alternate_key": "employee_id"})


@query(f"WITH {E_OPEN}, m AS (SELECT employee_alternate_key::BIGINT AS id, max(reports_to)::BIGINT AS boss FROM eo WHERE employee_alternate_key IS NOT NULL GROUP BY ALL) SELECT m.id AS employee_id, k.id AS manager_id FROM m LEFT JOIN m k ON k.id = m.boss")
def stream_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees streamed in three parts, managers often after those who report to them; links are mended after each part."""
    scratch = Scratch(spark)
    e = Star(spark, sf_dir).open("dim_employees", "employee_alternate_key", "reports_to").filter(F.col("employee_alternate_key").isNotNull())
    e = e.groupBy(F.col("employee_alternate_key").cast("bigint").alias("employee_id")).agg(F.max("reports_to").cast("bigint").alias("reports_to"))
    e = e.withColumns({"op": F.lit(2), "lsn": F.lit("01"), "seq": F.lit("0"), "at": F.lit(AT).cast("timestamp_ntz")})
    part = F.pmod(F.xxhash64("employee_id"), F.lit(3))
    frames = [encode(e.filter(part == i), SOURCES[5], "lsn", "seq", "op", "at", ["employee_id", "reports_to"]) for i in range(3)]
    table = dimensions.DimensionTable(spark, scratch.path(), _EMPLOYEE)

    def rows(df: DataFrame) -> DataFrame:
        d = decode(df)
        return _EMPLOYEE.rows(d.select(_data("employee_id", "bigint"), _data("reports_to", "bigint"), F.col("source_time").cast("timestamp_ntz").alias("at"), F.col("lsn").alias("position")), "at", "position")

    relink = lambda said, batch_id: table.relink("parent_employee_key", "reports_to", F.lit(1000 + batch_id))
    dimensions.apply_dimension(applier.read_files(spark, _messages(frames, scratch)), table, rows, scratch.path(), relink).awaitTermination()
    now = table.open_rows()
    boss = now.select(F.col("employee_key").alias("parent_employee_key"), F.col("employee_alternate_key").alias("manager_id"))
    return now.join(boss, "parent_employee_key", "left").select(F.col("employee_alternate_key").alias("employee_id"), "manager_id")


@query("SELECT rtrim(capture_instance) AS capture_instance, CASE operation WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' WHEN 3 THEN 'before' ELSE 'update' END AS operation, count(*) AS events, round(avg(epoch_ms(received_at) - epoch_ms(commit_time)), 3) AS avg_lag, count(*) AS audited FROM order_changes WHERE rtrim(capture_instance) = 'dbo_OrderDetails' GROUP BY ALL")
def stream_events_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry rows and audit documents of line changes, as the applier writes them."""
    scratch = Scratch(spark)
    c = load(spark, sf_dir, "order_changes").filter(F.rtrim("capture_instance") == "dbo_OrderDetails")
    c = c.select(F.rtrim("capture_instance").alias("capture_instance"), F.lit("fact_orders").alias("target_table"), "operation", F.concat_ws("|", "order_id", "product_id").alias("business_key"), F.col("commit_time").alias("source_time"), F.col("received_at").alias("applied"), F.lit(1).alias("rows_written"), F.lit(None).cast("string").alias("scd_outcome"), F.lit(None).cast("string").alias("error"))
    events = scratch.put(dimensions.stream_events(c, F.col("applied")))
    audit = scratch.put(dimensions.audit_documents(events).withColumn("operation", F.get_json_object("body", "$.operation")), ["event_date"])
    n = audit.groupBy("operation").agg(F.count("body").alias("audited"))
    d = events.groupBy("capture_instance", "operation").agg(F.count(F.lit(1)).alias("events"), F.round(F.avg("lag_ms"), 3).alias("avg_lag"))
    return d.join(n, "operation").select("capture_instance", "operation", "events", "avg_lag", "audited")
