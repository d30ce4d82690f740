"""Report queries over the star schema: sales, customers and products, workforce and geography.

Facts are joined to the version of a dimension they were loaded with (as_was), so that closed versions
stay in reports; as_is queries go over the alternate key to the open version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.values import one_of, years_between
from starloom.plans.star import C_OPEN, C_SQL, D_SQL, E_OPEN, E_SQL, F_SQL, G_SQL, P_OPEN, P_SQL, S_OPEN, Star, geo

QUERIES: dict = {}
SQL: dict[str, str] = {}


def report(sql: str):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Star(spark, sf_dir))
        SQL[f.__name__] = sql
        return f

    return register


def _double(c, n: str, digits: int = 2):
    return F.round(c, digits).cast("double").alias(n)


_MONTH = "strftime(make_date((order_date_key // 10000)::INT, (order_date_key // 100 % 100)::INT, 1), '%Y-%m')"


def _key_month():
    """Month of the smart key: no join with the calendar is needed."""
    k = F.col("order_date_key")
    return F.concat_ws("-", F.lpad(F.floor(k / 10000).cast("string"), 4, "0"), F.lpad(F.pmod(F.floor(k / 100), F.lit(100)).cast("string"), 2, "0")).alias("month")


def sales(s: Star, categories: list[str] | None = None, countries: list[str] | None = None, *columns: str) -> DataFrame:
    """Lines with a date and a known product, with category and country of shipment; filters as in the reports."""
    f = s.facts("order_date_key", "line_total", "geography_key", *columns).filter(F.col("order_date_key") > 0)
    f = f.join(s.products("category_name").select("product_key", "category_name"), "product_key")
    f = f.withColumn("geo", geo()).join(s.geography, "geo", "left")
    return f.filter(one_of(F.col("category_name"), categories) & one_of(F.col("country"), countries))


_SALES = f"{F_SQL}, {P_SQL}, {G_SQL}, s AS (SELECT f.*, p.category_name, g.country FROM f JOIN p ON p.product_key = f.product_key LEFT JOIN g ON g.geo = f.geography_key % 25 WHERE f.order_date_key > 0)"


@report(f"WITH {_SALES} SELECT {_MONTH} AS month, round(sum(line_total), 2)::DOUBLE AS revenue FROM s GROUP BY ALL")
def monthly_revenue(s: Star) -> DataFrame:
    return sales(s).groupBy(_key_month()).agg(_double(F.sum("line_total"), "revenue"))


@report(f"WITH {_SALES} SELECT {_MONTH} AS month, round(sum(line_total), 2)::DOUBLE AS revenue FROM s WHERE category_name IN ('Seafood', 'Produce') AND country IN ('FRANCE', 'GERMANY', 'CHINA') GROUP BY ALL")
def monthly_revenue_filtered(s: Star) -> DataFrame:
    return sales(s, ["Seafood", "Produce"], ["FRANCE", "GERMANY", "CHINA"]).groupBy(_key_month()).agg(_double(F.sum("line_total"), "revenue"))


@report(f"WITH {_SALES} SELECT {_MONTH} AS month, count(DISTINCT order_id) AS orders FROM s GROUP BY ALL")
def monthly_orders(s: Star) -> DataFrame:
    return sales(s).groupBy(_key_month()).agg(F.countDistinct("order_id").alias("orders"))


@report(f"WITH {_SALES}, o AS (SELECT {_MONTH} AS month, order_id, sum(line_total) AS total FROM s GROUP BY ALL) SELECT month, round(avg(total), 2)::DOUBLE AS avg_order FROM o GROUP BY ALL")
def avg_order_value(s: Star) -> DataFrame:
    return sales(s).groupBy(_key_month(), "order_id").agg(F.sum("line_total").alias("total")).groupBy("month").agg(_double(F.avg("total"), "avg_order"))


@report(f"WITH {F_SQL} SELECT round(100.0 * count(DISTINCT CASE WHEN shipped_date_key > 0 THEN order_id END) / count(DISTINCT order_id), 1)::DOUBLE AS shipped_pct FROM f")
def fill_rate(s: Star) -> DataFrame:
    per = s.facts("shipped_date_key").groupBy("order_id").agg(F.max((F.col("shipped_date_key") > 0).cast("int")).alias("shipped"))
    return per.agg(_double(100.0 * F.sum("shipped") / F.count(F.lit(1)), "shipped_pct", 1))


@report(f"WITH {F_SQL} SELECT sum(freight)::DOUBLE AS freight FROM (SELECT DISTINCT order_id, freight FROM f)")
def freight_fan_trap_safe(s: Star) -> DataFrame:
    return s.facts("freight").select("order_id", "freight").distinct().agg(F.sum("freight").cast("double").alias("freight"))


@report(f"WITH {_SALES} SELECT {_MONTH} AS month, round(sum(line_total), 0)::DOUBLE AS revenue, count(DISTINCT order_id) AS orders FROM s GROUP BY ALL")
def revenue_orders_trend(s: Star) -> DataFrame:
    return sales(s).groupBy(_key_month()).agg(_double(F.sum("line_total"), "revenue", 0), F.countDistinct("order_id").alias("orders"))


@report(f"WITH {_SALES} SELECT category_name, round(sum(line_total), 0)::DOUBLE AS revenue FROM s GROUP BY ALL")
def revenue_by_category(s: Star) -> DataFrame:
    return sales(s).groupBy("category_name").agg(_double(F.sum("line_total"), "revenue", 0))


@report(f"WITH {F_SQL}, {P_SQL} SELECT p.product_alternate_key::BIGINT AS product_id, round(sum(f.line_total), 0)::DOUBLE AS revenue FROM f JOIN p ON p.product_key = f.product_key GROUP BY ALL ORDER BY revenue DESC, product_id LIMIT 10")
def top_products(s: Star) -> DataFrame:
    d = s.facts("line_total").join(s.products().select("product_key", "product_alternate_key"), "product_key")
    return d.groupBy(F.col("product_alternate_key").cast("bigint").alias("product_id")).agg(_double(F.sum("line_total"), "revenue", 0)).orderBy(F.desc("revenue"), "product_id").limit(10)


_CUSTOMERS = f"WITH {F_SQL}, {C_SQL}, {G_SQL} SELECT c.customer_alternate_key AS customer, g.country, count(DISTINCT f.order_id) AS orders, round(sum(f.line_total), 2)::DOUBLE AS revenue"


def _by_customer(s: Star) -> DataFrame:
    c = s.customers("geography_key").select("customer_key", F.rtrim("customer_alternate_key").alias("customer"), geo())
    d = s.facts("customer_key", "line_total").join(c, "customer_key").join(s.geography, "geo", "left")
    return d.groupBy("customer", "country").agg(F.countDistinct("order_id").alias("orders"), _double(F.sum("line_total"), "revenue"))


@report(f"{_CUSTOMERS} FROM f JOIN c ON c.customer_key = f.customer_key LEFT JOIN g ON g.geo = c.geography_key % 25 GROUP BY ALL ORDER BY revenue DESC, customer, country LIMIT 12")
def top_customers(s: Star) -> DataFrame:
    return _by_customer(s).orderBy(F.desc("revenue"), "customer", "country").limit(12)


@report(f"SELECT *, round(revenue / orders, 0)::DOUBLE AS avg_order FROM ({_CUSTOMERS} FROM f JOIN c ON c.customer_key = f.customer_key LEFT JOIN g ON g.geo = c.geography_key % 25 GROUP BY ALL) ORDER BY revenue DESC, customer, country LIMIT 15")
def customer_detail(s: Star) -> DataFrame:
    return _by_customer(s).withColumn("avg_order", F.round(F.col("revenue") / F.col("orders"), 0)).orderBy(F.desc("revenue"), "customer", "country").limit(15)


@report(f"WITH {F_SQL}, {D_SQL} SELECT dayname(d.full_date) AS day_name, count(o.order_id) AS orders FROM d LEFT JOIN (SELECT DISTINCT order_id, order_date_key FROM f) o ON o.order_date_key = d.date_key WHERE d.full_date BETWEEN DATE '2023-01-01' AND DATE '2024-12-31' GROUP BY ALL")
def orders_by_weekday(s: Star) -> DataFrame:
    d = s.dates.filter(F.col("full_date").between("2023-01-01", "2024-12-31")).select("date_key", "day_name")
    o = s.facts("order_date_key").select("order_id", F.col("order_date_key").alias("date_key")).distinct()
    return d.join(o, "date_key", "left").groupBy("day_name").agg(F.count("order_id").alias("orders"))


@report(f"WITH {F_SQL}, {D_SQL} SELECT d.calendar_year || ' ' || ['Winter', 'Spring', 'Summer', 'Autumn'][d.season_number] AS period, round(sum(f.line_total), 1)::DOUBLE AS revenue FROM f JOIN d ON d.date_key = f.order_date_key GROUP BY ALL")
def revenue_by_season(s: Star) -> DataFrame:
    d = s.dates.select(F.col("date_key").alias("order_date_key"), F.concat_ws(" ", "calendar_year", "season").alias("period"))
    return s.facts("order_date_key", "line_total").join(F.broadcast(d), "order_date_key").groupBy("period").agg(_double(F.sum("line_total"), "revenue", 1))  # 16,801 days


@report(f"WITH {F_SQL}, {P_SQL} SELECT p.category_name, count(DISTINCT p.product_key) AS products, sum(f.quantity)::BIGINT AS units, round(avg(f.unit_price), 2)::DOUBLE AS avg_price, round(sum(f.line_total), 0)::DOUBLE AS revenue FROM f JOIN p ON p.product_key = f.product_key GROUP BY ALL")
def category_performance(s: Star) -> DataFrame:
    d = s.facts("quantity", "unit_price", "line_total").join(s.products("category_name").select("product_key", "category_name"), "product_key")
    return d.groupBy("category_name").agg(F.countDistinct("product_key").alias("products"), F.sum("quantity").alias("units"), _double(F.avg("unit_price"), "avg_price"), _double(F.sum("line_total"), "revenue", 0))


@report(f"WITH {F_SQL}, {P_SQL} SELECT p.category_name, sum(f.quantity)::BIGINT AS units FROM f JOIN p ON p.product_key = f.product_key GROUP BY ALL")
def units_by_category(s: Star) -> DataFrame:
    d = s.facts("quantity").join(s.products("category_name").select("product_key", "category_name"), "product_key")
    return d.groupBy("category_name").agg(F.sum("quantity").alias("units"))


@report(f"WITH {F_SQL}, {C_SQL}, t AS (SELECT c.customer_alternate_key AS customer, sum(f.line_total) AS total FROM f JOIN c ON c.customer_key = f.customer_key GROUP BY ALL) SELECT customer, round(total, 0)::DOUBLE AS revenue, round((sum(total) OVER (ORDER BY total DESC, customer ROWS UNBOUNDED PRECEDING))::DOUBLE / (SELECT sum(total) FROM t)::DOUBLE, 6) AS cumulative_share FROM t ORDER BY total DESC, customer LIMIT 25")
def revenue_concentration(s: Star) -> DataFrame:
    """The 25 largest customers and the share of all revenue that they have together."""
    c = s.customers().select("customer_key", F.rtrim("customer_alternate_key").alias("customer"))
    per = s.facts("customer_key", "line_total").join(c, "customer_key").groupBy("customer").agg(F.sum("line_total").alias("total"))
    every = per.agg(F.sum("total").alias("every")).withColumn("one", F.lit(1))
    top = per.orderBy(F.desc("total"), "customer").limit(25).withColumn("one", F.lit(1)).join(F.broadcast(every), "one")  # one row
    w = Window.orderBy(F.desc("total"), "customer").rowsBetween(Window.unboundedPreceding, 0)  # 25 rows
    return top.select("customer", _double(F.col("total"), "revenue", 0), F.round(F.sum("total").over(w).cast("double") / F.col("every").cast("double"), 6).alias("cumulative_share"))


@report(f"WITH {P_OPEN} SELECT count(*) FILTER (discontinued = 0) AS active, count(*) FILTER (discontinued = 1) AS discontinued, round(avg(unit_price) FILTER (discontinued = 0), 2)::DOUBLE AS avg_price_active FROM po")
def product_counts(s: Star) -> DataFrame:
    p = s.open("dim_products", "product_alternate_key", "discontinued", "unit_price")
    active = F.col("discontinued") == 0
    return p.agg(F.count_if(active).alias("active"), F.count_if(F.col("discontinued") == 1).alias("discontinued"), _double(F.avg(F.when(active, F.col("unit_price"))), "avg_price_active"))


@report(f"WITH {C_OPEN}, {S_OPEN}, {F_SQL} SELECT (SELECT count(*) FROM co) AS customers, (SELECT count(*) FROM so) AS suppliers, (SELECT count(DISTINCT customer_key) FROM f) AS buying_customers")
def customer_counts(s: Star) -> DataFrame:
    one = lambda d: d.withColumn("one", F.lit(1))
    c = one(s.open("dim_customer", "customer_alternate_key").agg(F.count(F.lit(1)).alias("customers")))
    p = one(s.open("dim_suppliers", "supplier_alternate_key").agg(F.count(F.lit(1)).alias("suppliers")))
    b = one(s.facts("customer_key").agg(F.countDistinct("customer_key").alias("buying_customers")))
    return c.join(p, "one").join(b, "one").drop("one")


@report(f"WITH {F_SQL}, {E_SQL} SELECT e.employee_alternate_key::BIGINT AS employee_id, round(sum(f.line_total), 0)::DOUBLE AS revenue FROM f JOIN e ON e.employee_key = f.employee_key GROUP BY ALL")
def revenue_per_employee(s: Star) -> DataFrame:
    d = s.facts("employee_key", "line_total").join(s.employees().select("employee_key", "employee_alternate_key"), "employee_key")
    return d.groupBy(F.col("employee_alternate_key").cast("bigint").alias("employee_id")).agg(_double(F.sum("line_total"), "revenue", 0))


@report(f"WITH {F_SQL}, {E_SQL}, {E_OPEN} SELECT eo.employee_alternate_key::BIGINT AS employee_id, eo.title, coalesce(m.full_name, '— root —') AS manager, count(DISTINCT f.order_id) AS orders, round(sum(f.line_total), 0)::DOUBLE AS revenue FROM f JOIN e ON e.employee_key = f.employee_key JOIN eo ON eo.employee_alternate_key = e.employee_alternate_key LEFT JOIN eo m ON m.employee_key = eo.parent_employee_key GROUP BY ALL")
def org_chart(s: Star) -> DataFrame:
    """Each employee's open version with manager, orders and revenue over all of the employee's versions."""
    now = s.open("dim_employees", "employee_alternate_key", "employee_key", "title", "full_name", "parent_employee_key")
    boss = now.select(F.col("employee_key").alias("parent_employee_key"), F.col("full_name").alias("manager"))
    who = now.select("employee_alternate_key", "title", "parent_employee_key").join(boss, "parent_employee_key", "left")
    d = s.facts("employee_key", "line_total").join(s.employees().select("employee_key", "employee_alternate_key"), "employee_key").join(who, "employee_alternate_key")
    return d.groupBy(F.col("employee_alternate_key").cast("bigint").alias("employee_id"), "title", F.coalesce("manager", F.lit("— root —")).alias("manager")).agg(F.countDistinct("order_id").alias("orders"), _double(F.sum("line_total"), "revenue", 0))


@report(f"WITH {F_SQL}, {G_SQL} SELECT g.country, round(sum(f.line_total), 0)::DOUBLE AS revenue FROM f JOIN g ON g.geo = f.geography_key % 25 WHERE g.country <> '' GROUP BY ALL ORDER BY revenue DESC, country LIMIT 15")
def revenue_by_country(s: Star) -> DataFrame:
    d = s.facts("geography_key", "line_total").withColumn("geo", geo()).join(s.geography, "geo").filter("country <> ''")
    return d.groupBy("country").agg(_double(F.sum("line_total"), "revenue", 0)).orderBy(F.desc("revenue"), "country").limit(15)


@report(f"WITH {F_SQL}, {G_SQL} SELECT count(DISTINCT g.country) AS countries FROM f JOIN g ON g.geo = f.geography_key % 25 WHERE g.country <> ''")
def countries_served(s: Star) -> DataFrame:
    d = s.facts("geography_key").select(geo()).distinct().join(s.geography, "geo").filter("country <> ''")
    return d.agg(F.countDistinct("country").alias("countries"))


@report(f"WITH {E_OPEN} SELECT count(*) AS employees, count(DISTINCT CASE WHEN parent_employee_key > 0 THEN parent_employee_key END) AS managers, round(avg(year(DATE '2024-12-31') - year(hire_date)), 1)::DOUBLE AS avg_tenure FROM eo")
def workforce(s: Star) -> DataFrame:
    e = s.open("dim_employees", "employee_alternate_key", "parent_employee_key", "hire_date")
    boss = F.when(F.col("parent_employee_key") > 0, F.col("parent_employee_key"))
    return e.agg(F.count(F.lit(1)).alias("employees"), F.countDistinct(boss).alias("managers"), _double(F.avg(years_between(F.col("hire_date"), F.lit("2024-12-31").cast("date"))), "avg_tenure", 1))


_TERRITORY = "SELECT DISTINCT l.l_suppkey AS employee, c.c_nationkey AS territory FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey"


def _territories(s: Star) -> DataFrame:
    """Suppliers stand in for employees and their customers' nations for territories."""
    li = s.raw("lineitem").select("l_orderkey", F.col("l_suppkey").alias("employee"))
    o = s.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = s.raw("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("territory"))
    return li.join(o, "l_orderkey").join(c, "o_custkey").select("employee", "territory").distinct()


@report(f"WITH b AS ({_TERRITORY}), {G_SQL} SELECT b.employee, count(*) AS territories, min(g.region) AS primary_region FROM b JOIN g ON g.geo = b.territory GROUP BY ALL")
def territory_coverage(s: Star) -> DataFrame:
    d = _territories(s).join(s.geography, F.col("territory") == F.col("geo"))
    return d.groupBy("employee").agg(F.count(F.lit(1)).alias("territories"), F.min("region").alias("primary_region"))


@report(_TERRITORY)
def bridge_employee_territory(s: Star) -> DataFrame:
    return _territories(s)


@report(f"WITH {F_SQL}, {P_SQL}, {P_OPEN} SELECT po.category_name, round(sum(f.line_total), 2)::DOUBLE AS as_is_revenue FROM f JOIN p ON p.product_key = f.product_key JOIN po ON po.product_alternate_key = p.product_alternate_key GROUP BY ALL")
def revenue_as_is(s: Star) -> DataFrame:
    """Revenue by today's category: fact, version, alternate key, open version."""
    now = s.open("dim_products", "product_alternate_key", "category_name").select("product_alternate_key", "category_name")
    d = s.facts("line_total").join(s.products().select("product_key", "product_alternate_key"), "product_key").join(now, "product_alternate_key")
    return d.groupBy("category_name").agg(_double(F.sum("line_total"), "as_is_revenue"))


@report(f"WITH {_SALES} SELECT category_name, country, round(sum(line_total), 2)::DOUBLE AS revenue, grouping(category_name)::INT AS all_categories, grouping(country)::INT AS all_countries FROM s GROUP BY ROLLUP (category_name, country)")
def rollup_revenue(s: Star) -> DataFrame:
    return sales(s).rollup("category_name", "country").agg(_double(F.sum("line_total"), "revenue"), F.grouping("category_name").cast("int").alias("all_categories"), F.grouping("country").cast("int").alias("all_countries"))


@report(f"WITH {_SALES} SELECT category_name, country, round(sum(line_total), 2)::DOUBLE AS revenue, grouping(category_name)::INT AS all_categories, grouping(country)::INT AS all_countries FROM s GROUP BY CUBE (category_name, country)")
def cube_revenue(s: Star) -> DataFrame:
    return sales(s).cube("category_name", "country").agg(_double(F.sum("line_total"), "revenue"), F.grouping("category_name").cast("int").alias("all_categories"), F.grouping("country").cast("int").alias("all_countries"))


@report(f"WITH {F_SQL}, {P_SQL} SELECT * FROM (SELECT p.category_name, p.product_alternate_key::BIGINT AS product_id, sum(f.quantity)::BIGINT AS units FROM f JOIN p ON p.product_key = f.product_key GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY units DESC, product_id) <= 3")
def top_products_per_category(s: Star) -> DataFrame:
    d = s.facts("quantity").join(s.products("category_name").select("product_key", "product_alternate_key", "category_name"), "product_key")
    per = d.groupBy("category_name", F.col("product_alternate_key").cast("bigint").alias("product_id")).agg(F.sum("quantity").alias("units"))
    rank = F.row_number().over(Window.partitionBy("category_name").orderBy(F.desc("units"), "product_id"))
    return per.withColumn("__sl_rank", rank).filter("__sl_rank <= 3").drop("__sl_rank")
