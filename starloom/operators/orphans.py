"""References to records that do not exist, by bitmaps per key range and period.

Keys of any type are dictionary-encoded first: every key that is referred to or known gets an integer,
dense within hash buckets.  For each field, period and range of 2^15 codes the references are one
bitmap; so are the keys the parent table knows, and the keys whose entity one version covers for the
whole period.  Reference AND-NOT known leaves exactly the missing keys.  Reference AND-NOT covered
leaves, of the others, the few that may lack a version at some moment of the period; those bits are
decoded, and only their references are looked at by exact time.  Bitmaps are combined before the
shuffle, so a hot key is one bit per task.  Coverage is kept for nodes of 1, 8, 64, ... periods instead
of each period (see asof.cover), so a version that holds for years is a few bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.bitmaps import bitmap_of, compress, key_of, range_of, surviving
from starloom.operators.asof import STRIDE, cover, levels_for, matches
from starloom.operators.ordering import rank_within
from starloom.operators.skew import look_up
from starloom.sources.tables import Scratch

NO_DATE = 190001  # period of references without a date (fixed value)
CODE_BUCKETS = 64


def encode(values: DataFrame, columns: list[str], buckets: int = CODE_BUCKETS) -> DataFrame:
    """columns and code: each distinct combination its own integer, dense within hash buckets.  Nulls have none."""
    d = values.select(*columns)
    for c in columns:
        d = d.filter(F.col(c).isNotNull())
    d = d.distinct().withColumn("__sl_part", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("bigint"))
    d = rank_within(d.withColumn("__sl_own", F.struct(*columns)), ["__sl_part"], "__sl_own", "__sl_r", 1)
    return d.select(*columns, (F.col("__sl_r") * buckets + F.col("__sl_part")).alias("code"))


def _month(c: Column) -> Column:
    return (F.year(c) * 12 + F.month(c) - 1).cast("bigint")


def _period(c: Column) -> Column:
    """yyyyMM of a count of months since year 0."""
    return (F.floor(c / 12) * 100 + F.pmod(c, F.lit(12)) + 1).cast("bigint")


def _plain(codes: DataFrame, by: list[str]) -> DataFrame:
    return codes.withColumn("range", range_of(F.col("code"))).groupBy(*by, "range").agg(bitmap_of("code").alias("plain"))


def _packed(codes: DataFrame, by: list[str], name: str) -> DataFrame:
    return _plain(codes, by).select(*by, "range", compress("plain").alias(name))


def _on(columns: list[str]) -> Column:
    """One text of several columns, to join on; a null differs from every value."""
    return F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns))


def _joined(left: DataFrame, right: DataFrame, columns: list[str], spread: Column, how: str) -> DataFrame:
    """left joined to right on columns that may hold a hot combination."""
    l, r = left.withColumn("__sl_on", _on(columns)), right.withColumn("__sl_on", _on(columns)).drop(*columns)
    return look_up(l, r, "__sl_on", spread, how=how).drop("__sl_on")


def _covered(versions: DataFrame, coded: DataFrame, months: DataFrame, first: Column, last: Column, levels: int) -> DataFrame:
    """field_name, month, range, covered: the codes that one version covers for the whole month, for the months asked for."""
    whole = versions.select("field_name", "entity", F.explode(cover(first, last + 1, levels)).alias("n"))
    nodes = whole.select("field_name", "entity", "n.level", "n.node").distinct()
    nodes = nodes.join(coded.filter(F.col("entity").isNotNull()).select("field_name", "entity", "code"), ["field_name", "entity"])
    bits = _plain(nodes.select("field_name", "level", "node", "code"), ["field_name", "level", "node"])
    own = F.array(*(F.struct(F.lit(k).alias("level"), F.floor(F.col("at") / F.lit(1 << (STRIDE * k))).cast("bigint").alias("node")) for k in range(levels)))
    m = months.select("field_name", "month", F.explode(own).alias("n")).select("field_name", "month", "n.level", "n.node")
    each = m.join(bits, ["field_name", "level", "node"]).groupBy("field_name", "month", "range").agg(F.bitmap_or_agg("plain").alias("plain"))
    return each.select("field_name", "month", "range", compress("plain").alias("covered"))


def find(spark: SparkSession, refs: DataFrame, keys: DataFrame, versions: DataFrame) -> DataFrame:
    """table_name, field_name, period_month, ref_key, reason: each distinct bad reference per month.

    refs: table_name, field_name, key, at (null: period 190001); keys: field_name, key, entity;
    versions: field_name, entity, start_date, end_date, standing ones only.  Keys are integers or texts,
    alike in refs and keys.  Null, 0 and the empty text refer to nothing.  reason: 'missing' (no such
    key), 'later' (every version of the entity starts after the time) or 'deleted' (no version holds
    then).  No rows give no rows.
    """
    scratch = Scratch(spark)
    by = ["table_name", "field_name", "month"]
    nothing = F.col("key").cast("string").isin("0", "")
    r = refs.select("table_name", "field_name", "key", "at", _month(F.col("at")).alias("month"))
    r = scratch.put(r.filter(F.col("key").isNotNull() & ~nothing))
    k = keys.select("field_name", "key", "entity").filter(F.col("key").isNotNull()).distinct()
    monthly = scratch.put(r.select(*by, "key").distinct())
    codes = scratch.put(encode(monthly.select("field_name", "key").unionByName(k.select("field_name", "key")), ["field_name", "key"]))
    k = scratch.put(k.join(codes, ["field_name", "key"]))
    coded = _joined(monthly, codes, ["field_name", "key"], F.col("month"), "inner")

    span = monthly.agg(F.min("month"), F.max("month")).first()
    lo, hi = (0, 0) if span[0] is None else (span[0], span[1])
    first = F.greatest(_month(F.col("start_date")) + (F.col("start_date") > F.date_trunc("month", "start_date")).cast("int") - lo, F.lit(0)).cast("bigint")
    last = F.least(F.when(F.col("end_date").isNull(), F.lit(hi)).otherwise(_month(F.col("end_date")) - 1) - lo, F.lit(hi - lo)).cast("bigint")
    held = versions.filter((first <= last) & F.col("entity").isNotNull())
    months = monthly.filter(F.col("month").isNotNull()).select("field_name", "month", (F.col("month") - lo).alias("at")).distinct()
    covered = _covered(held, k, months, first, last, levels_for(hi - lo + 1))

    bits = _packed(coded, by, "refs").join(_packed(k, ["field_name"], "known"), ["field_name", "range"], "left")
    bits = bits.join(covered, ["field_name", "month", "range"], "left")
    bits = bits.select(*by, "range", surviving("refs", "known").alias("missing"), surviving("refs", "covered").alias("open"))
    bits = scratch.put(bits.select(*by, "range", "missing", F.array_except("open", "missing").alias("suspect")))

    def decoded(column: str) -> DataFrame:
        d = bits.select(*by, "range", F.explode(column).alias("bit")).select(*by, key_of(F.col("range"), F.col("bit")).alias("code"))
        return d.join(codes.drop("field_name"), "code").select(*by, "key")

    missing = decoded("missing").withColumn("reason", F.lit("missing"))
    suspect = decoded("suspect").filter(F.col("month").isNotNull())
    looked = _joined(r, suspect, [*by, "key"], F.col("at"), "left_semi").distinct()
    looked = scratch.put(_joined(looked, k.select("field_name", "key", "entity"), ["field_name", "key"], F.col("at"), "inner"))
    one = F.concat_ws("\x1f", "field_name", F.col("entity").cast("string")).alias("__sl_entity")
    moments = scratch.put(looked.select(one, "at").distinct())
    v = versions.select(one, "start_date", "end_date")
    found = matches(moments, v, "__sl_entity", "at", F.col("at").cast("string")).select("__sl_entity", "at").distinct()
    starts = v.groupBy("__sl_entity").agg(F.min("start_date").alias("__sl_first"))
    bad = looked.select(*by, "key", "at", one).join(found, ["__sl_entity", "at"], "left_anti").join(starts, "__sl_entity", "left")
    bad = bad.select(*by, "key", F.when(F.col("__sl_first") > F.col("at"), "later").otherwise("deleted").alias("reason"))
    out = missing.unionByName(bad.distinct())
    return out.select("table_name", "field_name", F.coalesce(_period(F.col("month")), F.lit(NO_DATE)).alias("period_month"), F.col("key").alias("ref_key"), "reason")
