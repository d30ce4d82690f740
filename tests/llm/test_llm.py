"""Packing, mixing and content scores against exact counts, brute force and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import abuse, mixing, packing, tokens
from starloom.llm.queries import QUERIES, SQL
from starloom.sources.tables import load
from tests.conftest import TESTDATA
from tests.dirty import variant
from tests.llm import unseen
from tests.oracle import compare


# Tokens


def test_token_counts(spark):
    rnd = random.Random(1)
    long = " ".join(rnd.choice(["spring", "Müller's", "12345", "a", "co-op,", "\n\n"]) for _ in range(60_000))
    texts = ["", None, "Hello world", "don't   stop", long, "x" * 30_000, "漢字かな交じり文 и кириллица 🎉"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    n = {r["doc_id"]: r["tokens"] for r in tokens.token_counts(spark, d).collect()}
    path = tokens.vocabulary_path(spark)
    whole = [len(tokens._encoding(path).encode_ordinary(t)) if t else 0 for t in texts]
    assert [n[i] for i in range(len(texts))] == whole
    blanks = "a" + " " * 1_000_000 + "b c"
    assert tokens.count(blanks, path) == sum(len(tokens._encoding(path)._encode_single_piece(p)) for p in ("a", " " * 999_999, " b", " c"))
    for odd in ("\n" * 1_000_000, "a" + "\t " * 300_000 + "b", "!" * 300_000, "\u3000" * 50_000):
        assert tokens.count(odd, path) > 0
    assert len(long) > tokens.LONG_TEXT and "".join(tokens.pieces(long)) == long


# Packing


def exact_check(rows, counts, sizes):
    capacity = dict(sizes)
    used, ranges = {}, {}
    for name, no, doc, piece, start, n in rows:
        used[name, no] = used.get((name, no), 0) + n
        ranges.setdefault((name, doc), []).append((start, n, piece))
    assert all(v <= capacity[k[0]] for k, v in used.items())
    for name in capacity:
        for doc, n in counts:
            if n:
                parts = sorted(ranges[name, doc])
                assert sum(p[1] for p in parts) == n and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
                assert len(parts) == -(-n // capacity[name])  # cut only where it doesn't fit
    return used


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 300), max_size=20))
@settings(max_examples=100, deadline=None)
def test_shortest_pack_first(histogram):
    lengths, counts = (np.array(list(x), np.int64) for x in (histogram.keys(), histogram.values()))
    rules, packs = packing.shortest_pack_first(lengths, counts, 50)
    load_ = np.zeros(packs, np.int64)
    placed = {}
    for length, rank, n, first in rules.tolist():
        load_[first : first + n] += length
        assert placed.get(length, 0) == rank
        placed[length] = rank + n
    assert placed == {k: v for k, v in histogram.items()} and (load_ <= 50).all() and (load_ > 0).all()
    # any two packs that could be one pack were opened for nothing
    assert packs < 2 or sorted(load_)[0] + sorted(load_)[1] > 50


def test_pack(spark):
    rnd = random.Random(5)
    counts = [(i, rnd.choice([7, 7, 7, 0, 1, 64, 65, 130, rnd.randrange(1, 300)])) for i in range(500)]
    sizes = [("s", 64), ("l", 200)]
    c = spark.createDataFrame([(i, n, "x") for i, n in counts], "doc_id bigint, tokens bigint, capacity string")
    z = spark.createDataFrame([*sizes, ("bad", 0), ("none", None)], "container_name string, capacity_tokens int")
    p = packing.pack(spark, c, z)
    used = exact_check([tuple(r) for r in p.select("container_name", "container_no", "doc_id", "piece", "start_token", "tokens").collect()], counts, sizes)
    total = sum(n for _, n in counts)
    for name, size in sizes:
        assert sum(1 for k in used if k[0] == name) <= 1.1 * total / size + 1
    assert got(packing.broken(p, c, z)) == [("l", sum(1 for _, n in counts if n), 0, 0, 0), ("s", sum(1 for _, n in counts if n), 0, 0, 0)]
    assert packing.pack(spark, c.limit(0), z).count() == 0 and packing.pack(spark, c, z.limit(0)).count() == 0


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pack_into_150_sizes(spark):
    """More container sizes than one pass takes, names null and repeated among them."""
    counts = [(i, 1 + i % 37) for i in range(60)]
    sizes = [(f"c{k:03}", 20 + k) for k in range(150)]
    c = spark.createDataFrame(counts, "doc_id bigint, tokens bigint")
    p = packing.pack(spark, c, spark.createDataFrame([*sizes, ("c000", 3), (None, 50)], "container_name string, capacity_tokens int"))
    rows = [tuple(r) for r in p.select("container_name", "container_no", "doc_id", "piece", "start_token", "tokens").collect()]
    exact_check(rows, counts, [*sizes, (None, 50)])


def test_hot_lengths_are_numbered_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_A_BUCKET", 50)
    counts = [(i, 7 if i % 3 else 1 + i % 90) for i in range(900)]  # two thirds have one length
    c, z = spark.createDataFrame(counts, "doc_id bigint, tokens bigint"), spark.createDataFrame([("s", 64)], "container_name string, capacity_tokens int")
    one = packing.pack(spark, c, z)
    exact_check([tuple(r) for r in one.select("container_name", "container_no", "doc_id", "piece", "start_token", "tokens").collect()], counts, [("s", 64)])
    monkeypatch.setattr(packing, "BUCKETS", 0)  # offsets joined by shuffle
    assert got(packing.pack(spark, c.repartition(5), z)) == got(one)


# Mixing


def test_key_buckets_are_even(spark):
    """Also where weights differ by a factor of 20 and a source is light."""
    rows = [(i, "light" if i % 3 else "mixed", 0.05 if i % 3 else (1 + i % 20) / 20) for i in range(30_000)]
    c = spark.createDataFrame(rows, "doc_id bigint, source string, weight double")
    k = c.join(mixing._weight_classes(c), "source").withColumn("k", mixing.key(F.col("doc_id"), F.col("weight")))
    above = F.aggregate("__sl_classes", F.lit(0.0), lambda s, x: s + x["share"] * F.exp(-x["mean"] * F.col("k")))
    n = k.groupBy("source", F.floor((1 - above) * 100).alias("b")).count().groupBy("source").agg(F.max("count").alias("most"), F.sum("count").alias("all"), F.count(F.lit(1)).alias("buckets"))
    for r in n.collect():
        assert r["buckets"] == 100 and r["most"] <= 2 * r["all"] / 100


def test_mix(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choices(["big", "small", "tiny", "extra"], [80, 15, 5, 3])[0], rnd.randrange(1, 40), rnd.uniform(0.1, 1)) for i in range(3000)]
    c = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint, weight double")
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 2), ("tiny", 0.2, 4), ("absent", 0.1, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    plan = mixing.budgets(c, t)
    m = mixing.mix(spark, c, plan)
    s = {r["source"]: r for r in mixing.shares(m, plan).collect()}
    assert s["absent"]["drawn_tokens"] == s["extra"]["drawn_tokens"] == 0
    for name, share in (("big", 0.5), ("small", 0.3), ("tiny", 0.2)):
        assert abs(s[name]["share"] - share) < 0.01 and abs(s[name]["drawn_tokens"] - s[name]["budget"]) <= 20
        assert s[name]["most_copies"] <= s[name]["max_repeats"]
    copies = {r["doc_id"]: r["copies"] for r in m.collect()}
    for name, repeats in (("big", 1), ("small", 2), ("tiny", 4)):
        have = [copies.get(r[0], 0) for r in rows if r[1] == name]
        assert max(have) - min(have) <= 1 and max(have) <= repeats  # complete epochs go before fractional ones
    assert {r["doc_id"]: r["copies"] for r in mixing.mix(spark, c.repartition(7), plan).collect()} == copies
    weights = {r[0]: r[3] for r in rows}
    drawn, left = ([weights[r[0]] for r in rows if r[1] == "big" and (r[0] in copies) == x] for x in (True, False))
    assert np.mean(drawn) > np.mean(left)  # better documents are drawn more often
    fixed = mixing.budgets(c, t, total_tokens=10**9)
    assert {r["source"]: r["budget"] for r in fixed.collect()}["small"] == 2 * sum(r[2] for r in rows if r[1] == "small")
    assert mixing.mix(spark, c.limit(0), mixing.budgets(c.limit(0), t)).count() == 0


# Content scores


def test_disguises():
    r = abuse.Reader()
    said = {
        "fuсkіng іdiоt": ["fucking", "idiot"], "s-t-u-p-i-d I.D.I.O.T": ["stupid", "idiot"], "w h o r e!!!": ["whore"], "a5shole cvnt m1lf5": ["asshole", "cunt", "milfs"],
        "id<!-- -->iot fil''th pi­g bit​ch": ["idiot", "filth", "pig", "bitch"], "s#upid cun* ti.s": ["stupid", "cunt", "tits"], "cocccck sttupid": ["cock", "stupid"],
        "canal analysis classes assess cook 1850": ["canal", "analysis", "classes", "assess", "cook", "0"], "the so-called half-breeds": ["the", "so", "called", "half", "breeds"],
    }
    assert {k: r.words(k) for k in said} == said
    assert r.words("") == [] and len(r.words("x" * 2_000_000)) == 1


@pytest.fixture(scope="module")
def model(spark):
    """Fitted on documents none of which holds a sentence of unseen.py."""
    return abuse.fit(spark, load(spark, str(TESTDATA / "sf0.01"), "documents").select("doc_id", "source", "text"))


def test_long_texts_are_scored_whole(monkeypatch, model):
    rnd = random.Random(4)
    words = ["the", "harbour", "was", "built", "in", "spring", "and", "sold", "again"]
    text = [rnd.choice(words) for _ in range(3000)]
    bad = "you are a complete idiot and everybody knows it".split()
    texts = [" ".join(text[:k] + bad + text[k:]) for k in (0, 95, 100, 105, 1500, 3000)] + [" ".join(text), None, ""]
    whole, worst = abuse.scorer(model)(texts), [abuse.worst_window(abuse.dense(model), (t or "").split()) for t in texts]
    monkeypatch.setattr(abuse, "BLOCK", 100)
    cut, again = abuse.scorer(model)(texts), [abuse.worst_window(abuse.dense(model), (t or "").split()) for t in texts]
    assert np.allclose(whole, cut) and (whole[:6] > whole[6]).all() and list(whole[7:]) == [0, 0]
    assert np.allclose(whole, [w[0] for w in worst], atol=1e-5) and [w[1:] for w in worst] == [w[1:] for w in again]
    assert all("idiot" in texts[i].split()[worst[i][1] : worst[i][2]] for i in range(6))


def test_unseen_sentences(model):
    """At least 50 abusive and 50 harmless sentences in four languages, written apart from the training vocabulary."""
    known = {t for t, _ in abuse.phrases.sentences()}
    assert len(unseen.ABUSIVE) >= 50 and len(unseen.HARMLESS) >= 50 and known.isdisjoint([*unseen.ABUSIVE, *unseen.HARMLESS])
    score = abuse.scorer(model)
    hit, false = (int((score(x) >= abuse.THRESHOLD).sum()) for x in (unseen.ABUSIVE, unseen.HARMLESS))
    assert hit >= 0.8 * len(unseen.ABUSIVE) and hit >= 0.8 * (hit + false)
    assert len(model[0]) < 60_000


def test_training_sentences_are_not_from_the_documents(spark):
    """No written abusive sentence of five or more words stands in a document."""
    reader = abuse.Reader()
    written = {tuple(reader.words(t)) for t, y in abuse.phrases.sentences() if y}
    texts = [tuple(reader.words(r[0])) for r in load(spark, str(TESTDATA / "sf0.01"), "documents").filter("text is not null").select("text").toLocalIterator()]
    for n in (5, 6, 7, 8, 9, 10):
        mine = {w for w in written if len(w) == n}
        assert not any(t[i : i + n] in mine for t in texts for i in range(len(t) - n + 1)), n


def test_planted_sentences_are_found_anywhere(spark, model):
    """Unseen sentences put into documents that the model thinks harmless."""
    d = load(spark, str(TESTDATA / "sf0.01"), "documents").filter("length(text) > 500").select("doc_id", "source", "text").orderBy("doc_id").limit(300).toPandas()
    score = abuse.scorer(model)
    d = d[score(d["text"].tolist()) < 0.2].head(2 * len(unseen.ABUSIVE))
    rnd = random.Random(6)
    planted = []
    for text, said in zip(d["text"], unseen.ABUSIVE * 2, strict=False):
        words = text.split(" ")
        at = rnd.randrange(len(words))
        planted.append(" ".join([*words[:at], said, *words[at:]]))
    assert (score(planted) >= abuse.THRESHOLD).mean() >= 0.8


def test_the_model_decides(spark):
    """A text without listed words keeps the score the model gives it."""
    text = "we will come for your children tonight"
    t = np.array([abuse.token_hash(w) for w in text.split()], np.int64)
    at = np.unique(abuse.features(t, np.arange(len(t)))[:, 0])
    model = at.astype(np.int32), np.full(len(at), 4.0 / len(at), np.float32)
    assert abuse._KNOWN.isdisjoint(text.split())
    d = spark.createDataFrame([(1, "a", text), (2, "a", "the harbour was built in spring")], "doc_id bigint, source string, text string")
    score = {r["doc_id"]: r["score"] for r in abuse.scores(spark, d, model).collect()}
    assert abs(score[1] - 1 / (1 + np.exp(-1))) < 1e-6 and score[2] < 0.1


def test_labels_need_two_models():
    bad, plain = "you filthy liar".split(), "the harbour was sold".split()
    assert abuse.label_of(bad, 0.95, 0.95) == 1 and abuse.label_of(bad, 0.95, 0.5) is None and abuse.label_of(bad, 0.95, 0.1) == 0
    assert abuse.label_of(plain, 0.95, 0.95) is None and abuse.label_of(plain, 0.95, 0.6) == 0


def test_abuse_is_not_trained_as_harmless(spark):
    said = ["you should be dragged out of your home and burned", "people like you should be locked up and left to rot"]
    plain = "the harbour was built in spring and sold again when the mill on the river closed"
    long = " ".join([plain] * 4000)  # more than 300,000 characters are mined like any other text
    assert len(long) > 300_000
    d = spark.createDataFrame([(i, "a", f"{plain} {said[i % 2]}" if i % 3 == 0 else plain) for i in range(60)] + [(99, "a", f"{long} {said[0]} {long}")], "doc_id bigint, source string, text string")
    score = abuse.scorer(abuse.fit(spark, d))([*said, plain, f"{long} {said[0]} {long}"])
    assert (score[[0, 1, 3]] >= abuse.THRESHOLD).all() and score[2] < abuse.THRESHOLD


# Queries


@pytest.mark.parametrize("how", ["empty", "nulls", "extra"])
def test_dirty_tables(spark, tmp_path, how):
    path = variant(TESTDATA / "sf0.001", tmp_path, how)
    for name in ("p8_packing", "p9_mixture", "p9_shares", "p10_rates"):
        n = QUERIES[name](spark, path).count()
        assert n == 0 if how == "empty" else n > 0


def test_scores_cover_all_documents(spark, sf):
    d = QUERIES["p10_scores"](spark, sf)
    assert d.count() == load(spark, sf, "documents").count() and d.filter("score is null or score < 0 or score > 1").count() == 0
    assert QUERIES["p10_found"](spark, sf).columns == ["doc_id"]
    assert QUERIES["p8_fill"](spark, sf).filter(F.col("fill") < 0.9).count() <= 1


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, sf, name):
    assert not compare(spark, name, sf, QUERIES, SQL)


def test_mixture_repeats_small_sources_to_their_cap(spark, sf):
    rows = QUERIES["p9_shares"](spark, sf).collect()
    total = sum(r["available"] for r in rows)
    for r in rows:
        assert abs(r["budget"] - min(int(r["target_share"] * total + 0.5), r["available"] * r["max_repeats"])) <= 1
    assert any(r["most_copies"] == r["max_repeats"] > 0 and r["drawn_tokens"] == r["available"] * r["max_repeats"] for r in rows)
    assert max(r["most_copies"] for r in rows) > 1
