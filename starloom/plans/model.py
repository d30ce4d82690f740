"""Queries on dimensions: calendar, keys, look-ups, versions, SCD and hierarchies.

Where incoming changes are needed they follow from the key by arithmetic that both engines share:
key % 10 = 9 is new, key % 5 = 0 changes a type-2 column, key % 7 = 0 a type-1 column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.contract import DIMENSIONS
from starloom.functions.values import zero
from starloom.operators import keys, scd
from starloom.operators.standing import OPEN_END, open_end, standing
from starloom.plans.star import C_SQL, D_SQL, E_OPEN, F_SQL, G_SQL, P_OPEN, P_SQL, Star

QUERIES: dict = {}
SQL: dict[str, str] = {}
AT = "2025-06-01 00:00:00"
VERSION = 1_750_000_000_000


def report(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Star(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _at():
    return F.lit(AT).cast("timestamp_ntz")


@report(f"WITH {D_SQL} SELECT date_key, full_date, dayofweek(full_date) + 1 AS day_of_week, dayname(full_date) AS day_name, day(full_date) AS day_of_month, dayofyear(full_date) AS day_of_year, month_number, monthname(full_date) AS month_name, quarter(full_date) AS quarter, season_number, ['Winter', 'Spring', 'Summer', 'Autumn'][season_number] AS season, calendar_year FROM d")
def dim_date(s: Star) -> DataFrame:
    return s.dates


@report(f"WITH {G_SQL} SELECT geo::BIGINT AS geography_key, country, region FROM g")
def flatten_left_join(s: Star) -> DataFrame:
    return s.geography.select(F.col("geo").cast("bigint").alias("geography_key"), "country", "region")


@report("SELECT c_nationkey AS geo, 'customer' AS origin FROM customer UNION SELECT s_nationkey, 'supplier' FROM supplier UNION SELECT n_nationkey, 'nation' FROM nation")
def dim_geography_union(s: Star) -> DataFrame:
    one = lambda t, c: s.raw(t).select(F.col(c).alias("geo"), F.lit(t).alias("origin")).distinct()
    return one("customer", "c_nationkey").union(one("supplier", "s_nationkey")).union(one("nation", "n_nationkey")).distinct()


@report("SELECT row_number() OVER (ORDER BY rtrim(n_name), n_nationkey) AS geography_key, rtrim(n_name) AS country FROM nation")
def surrogate_keys_ordered(s: Star) -> DataFrame:
    n = s.raw("nation").select(F.rtrim("n_name").alias("country"), "n_nationkey")
    return keys.assign_keys_ordered(n, ["country", "n_nationkey"], "geography_key").select("geography_key", "country")


@report("SELECT count(*) AS rows, count(*) AS distinct_keys, 101::BIGINT AS first_key, 100 + count(*) AS last_key FROM part")
def surrogate_keys(s: Star) -> DataFrame:
    """Keys given to all parts are dense and unique, and start after the highest key there is."""
    d = keys.assign_keys(s.raw("part").select("p_partkey"), "p_partkey", "product_key", 100)
    return d.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("product_key").alias("distinct_keys"), F.min("product_key").alias("first_key"), F.max("product_key").alias("last_key"))


@report("SELECT max(customer_key)::BIGINT AS customer_key, (SELECT max(product_key) FROM dim_products)::BIGINT AS product_key, (SELECT max(employee_key) FROM dim_employees)::BIGINT AS employee_key FROM dim_customer")
def high_water_marks(s: Star) -> DataFrame:
    out = None
    for t, k in (("dim_customer", "customer_key"), ("dim_products", "product_key"), ("dim_employees", "employee_key")):
        one = s.raw(t).agg(F.max(k).cast("bigint").alias(k)).withColumn("one", F.lit(1))
        out = one if out is None else out.join(one, "one")
    return out.drop("one")


@report(f"WITH {P_OPEN}, s AS (SELECT product_id, snapshot_date FROM staging_products GROUP BY ALL) SELECT s.product_id::BIGINT AS product_id, s.snapshot_date, coalesce(max(po.product_key), 0)::BIGINT AS product_key FROM s LEFT JOIN po ON po.product_alternate_key = s.product_id GROUP BY ALL")
def resolve_keys_with_default(s: Star) -> DataFrame:
    incoming = s.raw("staging_products").select("product_id", "snapshot_date").distinct()
    d = keys.resolve(incoming, s.open("dim_products", "product_alternate_key", "product_key"), "product_id", "product_alternate_key", "product_key", "product_key", spread=F.col("snapshot_date"))
    return d.select(F.col("product_id").cast("bigint").alias("product_id"), "snapshot_date", "product_key")


@report("SELECT DISTINCT supplier_id::BIGINT AS supplier_alternate_key, '' AS company_name, TIMESTAMP '2106-01-01' AS end_date, 1 AS is_inferred FROM staging_products WHERE supplier_id <> 0 AND supplier_id NOT IN (SELECT supplier_alternate_key FROM dim_suppliers)")
def inferred_members(s: Star) -> DataFrame:
    """Stubs for suppliers that products name and the dimension lacks."""
    d = s.raw("dim_suppliers")
    missing = keys.missing_keys(s.raw("staging_products"), d, "supplier_id", "supplier_alternate_key")
    st = keys.stubs(DIMENSIONS["dim_suppliers"], missing, keys.highest_key(d, "supplier_key"), _at(), F.lit(VERSION))
    return st.select(F.col("supplier_alternate_key").cast("bigint").alias("supplier_alternate_key"), "company_name", "end_date", "is_inferred")


@report(f"WITH {E_OPEN} SELECT e.employee_alternate_key::BIGINT AS employee_id, coalesce(m.employee_key, 0)::BIGINT AS parent_key FROM eo e LEFT JOIN eo m ON m.employee_alternate_key = e.reports_to")
def hierarchy_resolved(s: Star) -> DataFrame:
    """The surrogate key of each open employee's manager; 0 without one."""
    e = s.open("dim_employees", "employee_alternate_key", "employee_key", "reports_to")
    d = keys.hierarchy_keys(e, "employee_key", "employee_alternate_key", "reports_to", "parent_key")
    return d.select(F.col("employee_alternate_key").cast("bigint").alias("employee_id"), F.col("parent_key").cast("bigint").alias("parent_key"))


# Versions

_LINE = ["l_orderkey", "l_partkey"]


@report("SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_shipdate DESC, l_linenumber DESC) = 1")
def dedup_latest(s: Star) -> DataFrame:
    """The last version of each order line: (order, part) repeats, shipdate and line number are the version."""
    li = s.raw("lineitem")
    d = standing(li, _LINE, ["l_quantity", "l_shipdate"], F.struct("l_shipdate", "l_linenumber"))
    return d.select(*_LINE, "l_quantity", "l_shipdate")


@report(f"WITH {F_SQL} SELECT order_id, product_key, quantity, line_total FROM f")
def tombstone_live(s: Star) -> DataFrame:
    return s.facts("quantity", "line_total")


@report("SELECT count(*) FILTER (is_deleted = 1) AS tombstoned, count(*) AS keys FROM (SELECT * FROM fact_orders QUALIFY row_number() OVER (PARTITION BY order_id, product_key ORDER BY _version DESC) = 1)")
def tombstone_count(s: Star) -> DataFrame:
    d = standing(s.raw("fact_orders"), ["order_id", "product_key"], ["is_deleted"])
    return d.agg(F.count_if(F.col("is_deleted") == 1).alias("tombstoned"), F.count(F.lit(1)).alias("keys"))


@report("SELECT (SELECT count(*) FROM dim_products) AS raw_rows, (SELECT count(*) FROM (SELECT DISTINCT product_alternate_key, start_date FROM dim_products)) AS standing_rows, (SELECT count(*) FROM (SELECT end_date FROM dim_products QUALIFY row_number() OVER (PARTITION BY product_alternate_key, start_date ORDER BY _version DESC) = 1) WHERE end_date = TIMESTAMP '2106-01-01') AS open_rows")
def version_counts(s: Star) -> DataFrame:
    st = s.products()
    n = lambda d, c: d.agg(F.count(F.lit(1)).alias(c)).withColumn("one", F.lit(1))
    return n(s.raw("dim_products"), "raw_rows").join(n(st, "standing_rows"), "one").join(n(st.filter(F.col("end_date") == open_end()), "open_rows"), "one").drop("one")


@report(f"WITH {C_SQL} SELECT customer_alternate_key, start_date, end_date, customer_key::BIGINT AS customer_key FROM c WHERE end_date = TIMESTAMP '2106-01-01'")
def scd_current_view(s: Star) -> DataFrame:
    return s.open("dim_customer", "customer_alternate_key", "customer_key").select("customer_alternate_key", "start_date", "end_date", F.col("customer_key").cast("bigint").alias("customer_key"))


@report(" UNION ALL ".join(f"SELECT '{t}' AS dimension, count(*) AS closed FROM (SELECT end_date FROM {t} QUALIFY row_number() OVER (PARTITION BY {a}, start_date ORDER BY _version DESC) = 1) WHERE end_date <> TIMESTAMP '2106-01-01'" for t, a in (("dim_products", "product_alternate_key"), ("dim_customer", "customer_alternate_key"), ("dim_employees", "employee_alternate_key"), ("dim_suppliers", "supplier_alternate_key"))))
def scd_history_rows(s: Star) -> DataFrame:
    out = None
    for t, a in (("dim_products", "product_alternate_key"), ("dim_customer", "customer_alternate_key"), ("dim_employees", "employee_alternate_key"), ("dim_suppliers", "supplier_alternate_key")):
        one = s.versions(t, a).filter(F.col("end_date") != open_end()).agg(F.count(F.lit(1)).alias("closed")).select(F.lit(t).alias("dimension"), "closed")
        out = one if out is None else out.unionByName(one)
    return out


_CLOSED = [("dim_products", "product_alternate_key", "product_name"), ("dim_customer", "customer_alternate_key", "company_name"), ("dim_employees", "employee_alternate_key", "full_name"), ("dim_suppliers", "supplier_alternate_key", "company_name")]


@report("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS dimension, {a}::VARCHAR AS source_key, {n} AS label, start_date, end_date FROM (SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY {a}, start_date ORDER BY _version DESC) = 1) WHERE end_date <> TIMESTAMP '2106-01-01'" for t, a, n in _CLOSED) + ") ORDER BY end_date DESC, dimension, source_key, start_date LIMIT 50")
def closed_versions_feed(s: Star) -> DataFrame:
    out = None
    for t, a, n in _CLOSED:
        one = s.versions(t, a, n).filter(F.col("end_date") != open_end()).select(F.lit(t).alias("dimension"), F.col(a).cast("string").alias("source_key"), F.col(n).alias("label"), "start_date", "end_date")
        out = one if out is None else out.unionByName(one)
    return out.orderBy(F.desc("end_date"), "dimension", "source_key", "start_date").limit(50)


@report(f"WITH {P_SQL} SELECT product_alternate_key::BIGINT AS product_id, start_date, end_date, unit_price FROM p")
def product_price_versions(s: Star) -> DataFrame:
    """The stored price versions of every product."""
    return s.products("unit_price").select(F.col("product_alternate_key").cast("bigint").alias("product_id"), "start_date", "end_date", "unit_price")


# Slowly changing dimensions


def _incoming(s: Star) -> tuple[DataFrame, DataFrame]:
    p = s.raw("part")
    k = F.col("p_partkey")
    now = p.filter(k % 10 != 9).select((k + 1).alias("product_key"), k.alias("product_id"), "p_name", "p_type", F.lit(0).alias("is_inferred"), F.lit("2024-01-01").cast("timestamp_ntz").alias("start_date"), open_end().alias("end_date"))
    new = p.select(k.alias("product_id"), F.when(k % 7 == 0, F.concat("p_name", F.lit("*"))).otherwise(F.col("p_name")).alias("p_name"), F.when(k % 5 == 0, F.concat("p_type", F.lit("*"))).otherwise(F.col("p_type")).alias("p_type"))
    return new, now


def _classified(s: Star) -> DataFrame:
    new, now = _incoming(s)
    return scd.classify(new, now, "product_id", ["p_name"], ["p_type"])


_OUTCOME = "CASE WHEN p_partkey % 10 = 9 THEN 'new' WHEN p_partkey % 5 = 0 THEN 'type2' WHEN p_partkey % 7 = 0 THEN 'type1' ELSE 'unchanged' END"
_NAME, _TYPE = "CASE WHEN p_partkey % 7 = 0 THEN p_name || '*' ELSE p_name END", "CASE WHEN p_partkey % 5 = 0 THEN p_type || '*' ELSE p_type END"


@report(f"SELECT p_partkey AS product_id, {_OUTCOME} AS scd_outcome FROM part")
def scd_classify(s: Star) -> DataFrame:
    return _classified(s).select("product_id", "scd_outcome")


def _plan(s: Star) -> DataFrame:
    _, now = _incoming(s)
    return scd.write_plan(_classified(s), "product_key", "product_id", ["p_name"], ["p_type"], [], _at(), F.lit(VERSION), keys.highest_key(now, "product_key"))


@report(f"WITH o AS (SELECT *, {_OUTCOME} AS scd_outcome FROM part) SELECT 'open' AS action, p_partkey AS product_id, {_NAME} AS p_name, {_TYPE} AS p_type, TIMESTAMP '{AT}' AS start_date, TIMESTAMP '{OPEN_END}' AS end_date FROM o WHERE scd_outcome IN ('new', 'type2') UNION ALL SELECT 'close', p_partkey, p_name, p_type, TIMESTAMP '2024-01-01', TIMESTAMP '{AT}' FROM o WHERE scd_outcome = 'type2'")
def scd2_close_open(s: Star) -> DataFrame:
    return _plan(s).filter("action <> 'overwrite'").select("action", "product_id", "p_name", "p_type", "start_date", "end_date")


@report(f"WITH o AS (SELECT *, {_OUTCOME} AS scd_outcome FROM part) SELECT p_partkey + 1 AS product_key, p_partkey AS product_id, {_NAME} AS p_name, p_type FROM o WHERE scd_outcome = 'type1'")
def scd1_overwrite(s: Star) -> DataFrame:
    return _plan(s).filter("action = 'overwrite'").select("product_key", "product_id", "p_name", "p_type")


@report("SELECT supplier_id::BIGINT AS supplier_id, sum(cut)::BIGINT AS versions FROM (SELECT supplier_id, (rtrim(coalesce(contact_name, '')) IS DISTINCT FROM lag(rtrim(coalesce(contact_name, ''))) OVER (PARTITION BY supplier_id ORDER BY updated_at))::INT AS cut FROM (SELECT * FROM staging_suppliers QUALIFY row_number() OVER (PARTITION BY supplier_id, updated_at ORDER BY _loaded_at DESC) = 1)) GROUP BY ALL")
def scd_sequential(s: Star) -> DataFrame:
    """How many versions each supplier gets when all its updates are applied in order."""
    u = standing(s.raw("staging_suppliers"), ["supplier_id", "updated_at"], ["contact_name", "phone"], "_loaded_at")
    u = u.withColumn("contact_name", F.coalesce(F.rtrim("contact_name"), F.lit("")))
    v = scd.sequence(u, "supplier_id", "updated_at", "updated_at", ["phone"], ["contact_name"])
    return v.groupBy(F.col("supplier_id").cast("bigint").alias("supplier_id")).agg(F.count(F.lit(1)).alias("versions"))


@report(f"WITH {P_OPEN} SELECT product_alternate_key::BIGINT AS product_id, 'Fish' AS category_name FROM po WHERE category_name = 'Seafood' UNION ALL SELECT product_alternate_key, 'Fruit' FROM po WHERE category_name = 'Produce'")
def rename_cascade(s: Star) -> DataFrame:
    """New versions of products that quote a renamed category; closed ones stay."""
    now = s.open("dim_products", "product_alternate_key", "product_key", "category_name").withColumn("is_inferred", F.lit(0))
    renames = s.spark.createDataFrame([("Seafood", "Fish"), ("Produce", "Fruit"), ("Meat/Poultry", "Meat/Poultry")], "old_value string, new_value string")
    changed = scd.rename_cascade(now, renames, "category_name").select("product_alternate_key", "category_name")
    c = scd.classify(changed, now, "product_alternate_key", [], ["category_name"])
    w = scd.write_plan(c, "product_key", "product_alternate_key", [], ["category_name"], [], _at(), F.lit(VERSION), 0)
    return w.filter("action = 'open'").select(F.col("product_alternate_key").cast("bigint").alias("product_id"), "category_name")


@report("SELECT 1000 + row_number() OVER (ORDER BY supplier_id) - row_number() OVER (ORDER BY supplier_id) AS zero, supplier_id::BIGINT AS supplier_id, company_name FROM (SELECT supplier_id, max_by(company_name, (updated_at, _loaded_at)) AS company_name FROM staging_suppliers WHERE supplier_id NOT IN (SELECT supplier_alternate_key FROM dim_suppliers) GROUP BY ALL)")
def stub_enrichment(s: Star) -> DataFrame:
    """Stubs overwritten in place by their first real row: same key, whatever changed."""
    d = s.raw("dim_suppliers")
    last = standing(s.raw("staging_suppliers"), ["supplier_id"], ["company_name", "contact_name"], F.struct("updated_at", "_loaded_at")).withColumnRenamed("supplier_id", "supplier_alternate_key")
    missing = keys.missing_keys(last, d, "supplier_alternate_key", "supplier_alternate_key")
    st = keys.stubs(DIMENSIONS["dim_suppliers"], missing, 0, _at(), F.lit(VERSION))
    c = scd.classify(last, st, "supplier_alternate_key", ["company_name"], ["contact_name"]).filter("scd_outcome = 'enriched'")
    w = scd.write_plan(c, "supplier_key", "supplier_alternate_key", ["company_name"], ["contact_name"], [], _at(), F.lit(VERSION), 0)
    w = w.join(st.select(F.col("supplier_key").alias("stub_key"), "supplier_alternate_key"), "supplier_alternate_key")
    return w.select((F.lit(1000) + F.col("supplier_key") - F.col("stub_key")).alias("zero"), F.col("supplier_alternate_key").cast("bigint").alias("supplier_id"), "company_name")


@report(f"WITH {F_SQL}, {P_SQL} SELECT p.category_name AS as_was, count(*) AS lines FROM f JOIN p ON p.product_key = f.product_key GROUP BY ALL")
def as_was(s: Star) -> DataFrame:
    d = s.facts().join(s.products("category_name").select("product_key", "category_name"), "product_key")
    return d.groupBy(F.col("category_name").alias("as_was")).agg(F.count(F.lit(1)).alias("lines"))


@report("SELECT unnest(['dim_customer', 'dim_products', 'dim_employees', 'dim_suppliers']) AS table_name, 0::BIGINT AS problems")
def contract_problems(s: Star) -> DataFrame:
    """In how many columns each stored dimension differs from the contract."""
    said = [(t, len(DIMENSIONS[t].differences(s.raw(t).schema))) for t in ("dim_customer", "dim_products", "dim_employees", "dim_suppliers")]
    return s.spark.createDataFrame(said, "table_name string, problems bigint")


@report("SELECT count(*) AS rows, 0 AS zero_int, '' AS zero_text FROM dim_suppliers")
def zero_values(s: Star) -> DataFrame:
    from pyspark.sql import types as T

    return s.raw("dim_suppliers").agg(F.count(F.lit(1)).alias("rows")).select("rows", zero(T.IntegerType()).alias("zero_int"), zero(T.StringType()).alias("zero_text"))
