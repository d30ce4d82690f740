"""Slowly changing dimensions of types 0, 1 and 2 from one contract.

One join classifies every incoming row; one pass writes what follows from it.  A stub (is_inferred)
is overwritten in place whatever changed, so that facts keep its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.values import any_differs
from starloom.operators.keys import assign_keys
from starloom.operators.standing import open_end

NEW, TYPE1, TYPE2, SAME, STUB = "new", "type1", "type2", "unchanged", "enriched"


def classify(incoming: DataFrame, open_rows: DataFrame, business_key: str, type1: list[str], type2: list[str]) -> DataFrame:
    """incoming with scd_outcome, and the open row's columns in the struct ``current``.

    Type 2 goes before type 1.  Null equals null.  Columns in neither list are type 0: they never
    change.  incoming and open_rows must have each business key once; null keys are always new.
    """
    o = open_rows.select(F.col(business_key).alias("__sl_bk"), F.struct(*open_rows.columns).alias("current"))
    d = incoming.join(o, F.col(business_key) == F.col("__sl_bk"), "left").drop("__sl_bk")
    differs = lambda names: any_differs([(F.col(c), F.col(f"current.{c}")) for c in names])
    stub = F.col("current.is_inferred") == 1 if "is_inferred" in open_rows.columns else F.lit(False)
    outcome = F.when(F.col("current").isNull(), NEW).when(stub, STUB).when(differs(type2), TYPE2).when(differs(type1), TYPE1).otherwise(SAME)
    return d.withColumn("scd_outcome", outcome)


def write_plan(classified: DataFrame, key: str, business_key: str, type1: list[str], type2: list[str], fixed: list[str], at: Column, version: Column, after: int | Column) -> DataFrame:
    """Rows to append, with ``action``: open (a new version), close (the old one, ended) or overwrite.

    A type-2 change gives two rows from one read of its input.  Closed rows keep all their
    values.  New surrogate keys start after ``after``; unchanged rows give nothing.
    """
    attributes = [*type1, *type2, *fixed]
    d = classified.filter(F.col("scd_outcome") != SAME)
    actions = F.when(F.col("scd_outcome") == TYPE2, F.array(F.lit("close"), F.lit("open"))).when(F.col("scd_outcome") == NEW, F.array(F.lit("open"))).otherwise(F.array(F.lit("overwrite")))
    d = d.withColumn("action", F.explode(actions))
    kept = F.col("action") == "close"
    d = d.select(
        "action", "scd_outcome", business_key,
        F.when(F.col("action") != "open", F.col(f"current.{key}")).alias("__sl_key"),
        *(F.when(kept | ((F.lit(c in fixed)) & (F.col("action") == "overwrite") & (F.col("scd_outcome") != STUB)), F.col(f"current.{c}")).otherwise(F.col(c)).alias(c) for c in attributes),
        F.when(F.col("action") == "open", at).otherwise(F.col("current.start_date")).alias("start_date"),
        F.when(kept, at).otherwise(open_end()).alias("end_date"),
        version.cast("bigint").alias("_version"),
    )
    opened = assign_keys(d.filter(F.col("action") == "open").drop("__sl_key"), business_key, key, after)
    rest = d.filter(F.col("action") != "open").withColumn(key, F.col("__sl_key").cast("bigint")).drop("__sl_key")
    return opened.unionByName(rest).select("action", "scd_outcome", key, business_key, *attributes, "start_date", "end_date", "_version")


def sequence(changes: DataFrame, business_key: str, order: str, at: str, type1: list[str], type2: list[str]) -> DataFrame:
    """All versions that several changes of a key make when applied one after the other.

    Changes in ``order``; a version starts where a type-2 column differs from the change before, and
    shows the type-1 values of its last change.  Columns: business key, version_no, attributes,
    start_date, end_date.  The key's window holds one micro-batch's changes of that key.
    """
    w = Window.partitionBy(business_key).orderBy(order)
    cut = ~F.coalesce(F.lag(F.struct(*type2)).over(w).eqNullSafe(F.struct(*type2)), F.lit(False))
    d = changes.withColumn("__sl_cut", cut.cast("int")).withColumn("version_no", F.sum("__sl_cut").over(w).cast("bigint"))
    v = d.groupBy(business_key, "version_no").agg(F.min(at).alias("start_date"), *(F.max_by(c, order).alias(c) for c in [*type1, *type2]))
    nxt = F.lead("start_date").over(Window.partitionBy(business_key).orderBy("version_no"))
    return v.select(business_key, "version_no", *type1, *type2, "start_date", F.coalesce(nxt, open_end()).alias("end_date"))


def rename_cascade(open_rows: DataFrame, renames: DataFrame, column: str) -> DataFrame:
    """Open rows that quote a renamed value, with the new one: input of classify and write_plan.

    renames: old_value, new_value, each old value once.
    """
    r = renames.filter(~F.col("old_value").eqNullSafe(F.col("new_value"))).select(F.col("old_value").alias("__sl_old"), F.col("new_value").alias("__sl_new"))
    d = open_rows.join(r, F.col(column) == F.col("__sl_old"))
    return d.withColumn(column, F.col("__sl_new")).select(*open_rows.columns)
