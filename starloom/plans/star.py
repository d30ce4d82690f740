"""The star schema's frames, and the same as SQL, for the report queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dates import dim_date
from starloom.operators.standing import live, open_end, standing
from starloom.sources.tables import load

FACT_KEYS = ["order_id", "product_key"]


class Star:
    """Lazily loaded frames; each holds only what a query then selects, as column pruning reaches the scans."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return load(self.spark, self.dir, name)

    def facts(self, *columns: str) -> DataFrame:
        """Live order lines with the columns asked for."""
        return live(self.raw("fact_orders"), FACT_KEYS, [c for c in columns if c not in FACT_KEYS])

    def versions(self, table: str, alternate: str, *columns: str) -> DataFrame:
        """Standing versions of a dimension."""
        return standing(self.raw(table), [alternate, "start_date"], [*columns, "end_date"])

    def open(self, table: str, alternate: str, *columns: str) -> DataFrame:
        return self.versions(table, alternate, *columns).filter(F.col("end_date") == open_end())

    def products(self, *columns: str) -> DataFrame:
        return self.versions("dim_products", "product_alternate_key", "product_key", *columns)

    def customers(self, *columns: str) -> DataFrame:
        return self.versions("dim_customer", "customer_alternate_key", "customer_key", *columns)

    def employees(self, *columns: str) -> DataFrame:
        return self.versions("dim_employees", "employee_alternate_key", "employee_key", *columns)

    @cached_property
    def geography(self) -> DataFrame:
        """Flattened nation and region; stands in for the address dimension, whose keys repeat after 25 here."""
        n, r = self.raw("nation"), self.raw("region")
        return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(F.col("n_nationkey").alias("geo"), F.rtrim("n_name").alias("country"), F.rtrim("r_name").alias("region"))

    @cached_property
    def dates(self) -> DataFrame:
        return dim_date(self.spark)


def geo(c: str = "geography_key"):
    return F.pmod(F.col(c), F.lit(25)).alias("geo")


F_SQL = "f AS (SELECT * FROM (SELECT * FROM fact_orders QUALIFY row_number() OVER (PARTITION BY order_id, product_key ORDER BY _version DESC) = 1) WHERE coalesce(is_deleted, 0) = 0)"


def dim_sql(name: str, table: str, alternate: str, only_open: bool = False) -> str:
    where = " WHERE end_date = TIMESTAMP '2106-01-01'" if only_open else ""
    return f"{name} AS (SELECT * FROM (SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {alternate}, start_date ORDER BY _version DESC) = 1){where})"


P_SQL = dim_sql("p", "dim_products", "product_alternate_key")
C_SQL = dim_sql("c", "dim_customer", "customer_alternate_key")
E_SQL = dim_sql("e", "dim_employees", "employee_alternate_key")
P_OPEN, C_OPEN, E_OPEN = (dim_sql(n, t, a, True) for n, t, a in (("po", "dim_products", "product_alternate_key"), ("co", "dim_customer", "customer_alternate_key"), ("eo", "dim_employees", "employee_alternate_key")))
S_OPEN = dim_sql("so", "dim_suppliers", "supplier_alternate_key", True)
G_SQL = "g AS (SELECT n_nationkey AS geo, rtrim(n_name) AS country, rtrim(r_name) AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"
D_SQL = """d AS (SELECT x::DATE AS full_date, year(x) * 10000 + month(x) * 100 + day(x) AS date_key, year(x) AS calendar_year, month(x) AS month_number, ((month(x) % 12) // 3 + 1) AS season_number
  FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS x))"""
