"""Mixing sources to target shares of all tokens, by Efraimidis-Spirakis sampling.

Each document gets the key -ln(u) / weight, where u follows from a hash of its id and weight is its
quality; taking documents in the order of keys is weighted sampling without replacement.  A source
gives as many complete epochs as its budget holds, and for the rest the documents with the least
keys until the prefix sum of tokens reaches the budget.  Prefix sums run in buckets of the key, so
the largest source is sorted by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.operators.ordering import running_sum
from starloom.sources.tables import bounded

SEED = 20
ROWS_A_BUCKET = 50_000  #: expected documents in a bucket of keys
LEAST_BUCKETS = 16
LEAST_WEIGHT = 0.05
SOURCES = 100_000  #: most sources whose budgets are broadcast


def quality(text: Column) -> Column:
    """Weight of a text, from LEAST_WEIGHT to 1, by three signals; any other positive column may be given instead.

    The share of letters and blanks; less what template and table markup takes; times a factor from 0.5
    to 1 for the share of distinct words, so that repeated nonsense counts less.
    """
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    letters = F.length(F.regexp_replace(t, r"[^\p{L} ]+", "")) / n
    markup = (n - F.length(F.translate(t, "{}[]|<>=", ""))) / n
    words = F.split(t, " ")
    variety = F.size(F.array_distinct(words)) / F.size(words)
    return F.greatest(F.lit(LEAST_WEIGHT), F.when(F.length(t) > 0, letters * (1 - F.least(3 * markup, F.lit(1.0))) * (0.5 + 0.5 * variety)).otherwise(0.0))


def key(doc_id: Column, weight: Column, seed: int = SEED) -> Column:
    """Exponential variable with rate weight; a fixed function of doc_id and seed."""
    u = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.ln(u) / weight


def budgets(counts: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """A row per source of either table: target_share, max_repeats, available documents and tokens, budget, epochs, rest.

    Without total_tokens the mixture is the largest in which every listed source that has tokens
    reaches its share within its repeats.  With it, a source that can't is cut to its repeats and the
    report shows the share it reached.  Sources that are not listed get no budget; listed
    ones without documents neither.  Null shares and repeats count as 0.  A source listed twice
    has the greater share and repeats.
    """
    have = counts.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("available"))
    want = targets.groupBy("source").agg(F.max(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("max_repeats"))
    b = have.withColumnRenamed("source", "__sl_s").join(want, F.col("__sl_s").eqNullSafe(F.col("source")), "full_outer")
    b = b.select(F.coalesce("source", "__sl_s").alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("available", F.lit(0)).alias("available"))
    most = F.col("available") * F.col("max_repeats")
    if total_tokens is None:
        limit = F.when((F.col("target_share") > 0) & (most > 0), most / F.col("target_share"))
        total_tokens = b.agg(F.min(limit)).first()[0] or 0.0
    b = b.withColumn("budget", F.least(F.floor(F.col("target_share") * F.lit(float(total_tokens)) + 0.5).cast("bigint"), most))
    epochs = F.when(F.col("available") > 0, F.floor(F.col("budget") / F.greatest("available", F.lit(1)))).otherwise(0).cast("bigint")
    return b.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available"))


def _weight_classes(counts: DataFrame) -> DataFrame:
    """Per source the shares and mean weights of its documents by class of weight: eight classes to a factor of two."""
    by = counts.groupBy("source", F.floor(8 * F.log2("weight")).alias("class")).agg(F.count(F.lit(1)).alias("n"), F.avg("weight").alias("mean"))
    every = F.sum("n").over(Window.partitionBy("source"))  # a row per class
    by = by.select("source", F.struct((F.col("n") / every).alias("share"), "mean").alias("c"))
    return by.groupBy("source").agg(F.sort_array(F.collect_list("c")).alias("__sl_classes"))


def mix(spark: SparkSession, counts: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, tokens, copies: each document drawn, and how often.

    counts: doc_id (unique), source, tokens, weight (null or not positive: LEAST_WEIGHT); plan: from budgets.  The document at which a
    budget ends is drawn if at least half of it lies within, so a source misses its budget by at most
    half a document.  Documents without tokens are drawn in complete epochs only.
    """
    buckets = F.greatest(F.lit(LEAST_BUCKETS), F.ceil(F.col("documents") / ROWS_A_BUCKET)).alias("__sl_n")
    w = F.when(F.col("weight") > 0, F.col("weight")).otherwise(LEAST_WEIGHT)
    c = counts.select("doc_id", "source", "tokens", w.cast("double").alias("weight"))
    p = plan.filter(F.col("budget") > 0).select("source", "epochs", "rest", buckets).join(_weight_classes(c), "source")
    p = F.broadcast(p) if bounded(p, SOURCES) else p
    d = c.join(p, "source").withColumn("__sl_key", key(F.col("doc_id"), F.col("weight"), seed))
    # the share of the source's keys that lie below a key: it rises with the key and spreads keys of any weights evenly
    above = F.aggregate("__sl_classes", F.lit(0.0), lambda s, x: s + x["share"] * F.exp(-x["mean"] * F.col("__sl_key")))
    bucket = F.floor((1 - above) * F.col("__sl_n"))
    d = running_sum(d, ["source"], ["__sl_key", "doc_id"], "tokens", "__sl_sum", bucket)
    drawn = (F.col("tokens") > 0) & (F.col("__sl_sum") - F.col("tokens") / 2 <= F.col("rest"))
    d = d.withColumn("copies", (F.col("epochs") + drawn.cast("bigint")).cast("bigint"))
    return d.filter(F.col("copies") > 0).select("doc_id", "source", "tokens", "copies")


def broken(mixture: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source with a budget: documents it has, documents drawn too often, and whether complete epochs precede the fractional one."""
    m = mixture.groupBy(F.col("source").alias("__sl_s")).agg(F.max("copies").alias("most"), F.count(F.lit(1)).alias("drawn"))
    j = plan.filter(F.col("budget") > 0).join(m, F.col("source") == F.col("__sl_s"), "left")
    too_often = F.coalesce(F.col("most") > F.col("max_repeats"), F.lit(False)).cast("int")
    skipped = ((F.col("epochs") > 0) & (F.coalesce("drawn", F.lit(0)) < F.col("documents"))).cast("int")
    return j.select("source", "documents", too_often.alias("drawn_too_often"), skipped.alias("epoch_incomplete"))


def shares(mixture: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source what was wanted, what it has and what it gave: drawn documents, tokens, share and repeats."""
    m = mixture.groupBy(F.col("source").alias("__sl_s")).agg(F.count(F.lit(1)).alias("drawn_documents"), F.max("copies").alias("most_copies"), F.sum(F.col("tokens") * F.col("copies")).alias("drawn_tokens"))
    j = plan.join(m, F.col("source").eqNullSafe(F.col("__sl_s")), "left")
    j = j.withColumn("__sl_total", F.sum("drawn_tokens").over(Window.partitionBy(F.lit(1))))  # a row per source
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return j.select("source", "target_share", "max_repeats", "documents", "available", "budget", zero("drawn_documents"), zero("most_copies"), zero("drawn_tokens"), F.round(F.coalesce(F.col("drawn_tokens") / F.col("__sl_total"), F.lit(0.0)), 6).alias("share"))
