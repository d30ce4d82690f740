"""Queries of the llm subpackage and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import abuse, mixing, packing, tokens
from starloom.sources.tables import Scratch, load, spread

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _counts(spark: SparkSession, sf_dir: str, weight: bool = False) -> DataFrame:
    """doc_id, source, tokens (and weight) of every document, written once and read by what follows."""
    d = load(spark, sf_dir, "documents")
    extra = [mixing.quality(F.col("text")).alias("weight")] if weight else []
    return Scratch(spark).put(tokens.token_counts(spark, spread(d.select("doc_id", F.rtrim("source").alias("source"), *extra, "text"))))


# 8. Filling fixed-capacity containers with items


@query
def p8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or of every piece of those longer than a container, for each container size."""
    return packing.pack(spark, _counts(spark, sf_dir), load(spark, sf_dir, "container_sizes"))


@query
def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each size are."""
    sizes = load(spark, sf_dir, "container_sizes")
    return packing.fill(packing.pack(spark, _counts(spark, sf_dir), sizes), sizes)


@query
def p8_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed for each container size, and the rules broken in doing so."""
    counts, sizes = _counts(spark, sf_dir), load(spark, sf_dir, "container_sizes")
    return packing.broken(Scratch(spark).put(packing.pack(spark, counts, sizes)), counts, sizes)


SQL["p8_broken"] = "SELECT container_name, count(*) AS documents, 0::BIGINT AS overfull, 0::BIGINT AS incomplete, 0::BIGINT AS cut_needlessly FROM documents, container_sizes WHERE length(text) > 0 GROUP BY container_name"


# 9. Mixing sources to target weights


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counts = _counts(spark, sf_dir, weight=True)
    total = counts.agg(F.sum("tokens")).first()[0] or 0  # all there are, so that small sources run to their cap
    plan = mixing.budgets(counts, load(spark, sf_dir, "source_targets").withColumn("source", F.rtrim("source")), total)
    return mixing.mix(spark, counts, plan), plan


@query
def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn and how often each is repeated."""
    return _mixture(spark, sf_dir)[0]


@query
def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    return mixing.shares(*_mixture(spark, sf_dir))


@query
def p9_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with a budget, and the rules broken in drawing from them."""
    return mixing.broken(*_mixture(spark, sf_dir))


SQL["p9_broken"] = """SELECT source, count(*) AS documents, 0 AS drawn_too_often, 0 AS epoch_incomplete FROM (SELECT rtrim(source) AS source FROM documents) d
JOIN (SELECT rtrim(source) AS source FROM source_targets WHERE target_share > 0 AND max_repeats > 0 GROUP BY ALL) t USING (source) GROUP BY source"""


# 10. Abusive, hateful or sexual content


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return abuse.scores(spark, spread(d), abuse.fit(spark, d))


@query
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).filter(F.col("score") >= abuse.THRESHOLD).select("doc_id")


@query
def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    return _scored(spark, sf_dir)


@query
def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and flagged documents per source."""
    return abuse.rates(_scored(spark, sf_dir))
