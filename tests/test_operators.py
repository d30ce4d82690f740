"""Operators on small literal inputs: defined results for nulls, ties, repeats, hot keys and cycles."""

from __future__ import annotations

import datetime
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import bitmaps
from starloom.functions.values import coerce, fill_zeros, net_amount
from starloom.operators import asof, changefeed, diff, facts, hierarchy, history, keys, late, orphans, scd, skew
from starloom.operators.ordering import fill_forward, neighbour, rank_within, running_sum
from starloom.operators.standing import OPEN_END, current, live, open_end, standing


def ts(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Hierarchies


def brute(parents: dict[int, int | None]) -> dict[int, tuple]:
    """root, depth, cycle_key of each node by walking."""
    out = {}
    for n in parents:
        seen, at = [n], parents[n]
        while at is not None and at in parents and at not in seen:
            seen.append(at)
            at = parents[at]
        if at is None or at not in parents:
            out[n] = (seen[-1], len(seen) - 1, None)
        else:
            out[n] = (None, None, min(seen[seen.index(at) :]))
    return out


def test_hierarchy(spark):
    rnd = random.Random(7)
    n = 60
    shapes = (
        {i: i - 1 if i else None for i in range(n)},  # a chain
        {i: 0 if i else None for i in range(n)},  # a star
        {i: rnd.choice([None, 10_000_000, *range(n)]) if i > 5 else None for i in range(n)},
        {i: (i // 3 * 3 + (i + 1) % 3) if i < 30 else rnd.randrange(i) for i in range(n)},  # small cycles with trees below
        {i: (i + 1) % n for i in range(n)},  # a ring
        {i: i for i in range(20)},  # own parents
    )
    parents: dict[int, int | None] = {}
    for k, shape in enumerate(shapes):
        parents |= {1000 * k + i: p if p is None or p > n else 1000 * k + p for i, p in shape.items()}
    nodes = spark.createDataFrame(list(parents.items()), "id int, parent int")
    want = brute(parents)
    for every in (1, 10_000):  # all nodes are splitters, and none
        assert {x["id"]: (x["root"], x["depth"], x["cycle_key"]) for x in hierarchy.resolve(spark, nodes, every).collect()} == want
    h = hierarchy.paths(spark, nodes).collect()
    assert {x["id"]: (x["root"], x["depth"], x["cycle_key"]) for x in h} == want
    for x in h:
        if x["path"] is not None:
            assert x["path"][0] == x["root"] and x["path"][-1] == x["id"] and len(x["path"]) == x["depth"] + 1
            assert all(parents[b] == a for a, b in zip(x["path"], x["path"][1:], strict=False))


def test_subtree_sizes(spark, monkeypatch):
    """Trees of several shapes, far ids and a cycle; also with the joins that a large table takes."""
    rnd = random.Random(11)
    parents: dict[int, int | None] = {10 + i: 9 + i if i else None for i in range(40)}  # a chain
    parents |= {1000 + i: 1000 if i else None for i in range(80)}  # a star
    parents |= {2**62 + i: 2**62 + rnd.randrange(i) if i else None for i in range(60)}
    parents |= {-1: -2, -2: -1, -3: -1}
    below = dict.fromkeys(parents, 0)
    for n in parents:
        if n >= 0:
            at = parents[n]
            while at is not None:
                below[at] += 1
                at = parents[at]
    nodes = spark.createDataFrame(list(parents.items()), "id bigint, parent bigint")
    want = {n: k for n, k in below.items() if n >= 0}
    assert {r["id"]: r["descendants"] for r in hierarchy.subtree_sizes(spark, nodes).collect()} == want
    monkeypatch.setattr(hierarchy, "BROADCAST_ROWS", 0)
    told = {r["id"]: (r["root"], r["depth"], r["cycle_key"]) for r in hierarchy.resolve(spark, nodes, 3).collect()}
    assert told == brute(parents)


def test_hierarchy_repeats_and_nulls(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (2, 1), (2, 9), (None, 1), (3, 77)], "id int, parent int")
    assert got(hierarchy.resolve(spark, nodes).select("id", "root", "depth")) == [(1, 1, 0), (2, 1, 1), (3, 3, 0)]
    assert got(hierarchy.descendants(hierarchy.paths(spark, nodes))) == [(1, 2, 1)]


# Change feeds


def _feed(spark, rows):
    c = [(ci, op, lsn, seq, o, p, q) for ci, op, lsn, seq, o, p, q in rows]
    d = spark.createDataFrame(c, "capture_instance string, operation int, start_lsn string, seqval string, order_id int, product_id int, quantity smallint")
    for name, kind in (("unit_price", "decimal(19,4)"), ("discount", "float"), ("freight", "decimal(19,4)"), ("ship_name", "string"), ("order_date", "timestamp_ntz")):
        d = d.withColumn(name, F.lit(None).cast(kind))
    return d


L, O = "dbo_OrderDetails", "dbo_Orders"


def test_change_feed(spark):
    rows = [
        (L, 2, "0x0A", "01", 1, 1, 5), (L, 4, "00:00:0b", "1", 1, 1, 6), (L, 3, "0B", "1", 1, 1, 5),  # insert, update, before-image
        (L, 2, "0a", "2", 1, 2, 1), (L, 1, "0c", "1", 1, 2, 1),  # deleted
        (L, 2, "0a", "3", 2, 1, 1), (O, 1, "0d", "1", 2, None, None), (L, 2, "0e", "1", 2, 1, 9),  # order deleted, line comes back
        (L, 2, "0a", "4", 3, 1, 1), (O, 1, "0d", "2", 3, None, None),  # gone with its order
        (L, 2, "ff", "1", 4, 1, 1),  # beyond the last position
        (L, 1, "0a", "9", 5, 1, 1), (L, 2, "0a", "9", 5, 1, 7),  # delete and insert at one position: there
        (L, 2, None, "1", 6, 1, 1), ("dbo_Other", 2, "01", "1", 7, 1, 1), (L, 2, "0a", "5", None, 1, 1),
    ]
    state = spark.createDataFrame([(L + "  ", "0xF0"), (O, "f0"), ("dbo_Other", None)], "capture_instance string, last_lsn string")
    random.Random(1).shuffle(rows)
    for batches in (1, 3):
        t = changefeed.apply_feed(spark, _feed(spark, rows + rows[:8]), state, batches)
        lines = t.lines().select("order_id", "product_id", "is_deleted", F.ltrim("pos.start_lsn", F.lit("0")), "quantity")
        assert got(lines) == [(1, 1, 0, "b", 6), (1, 2, 1, "c", None), (2, 1, 0, "e", 9), (3, 1, 1, "d", None), (5, 1, 0, "a", 7)]


def test_salted_joins(spark):
    left = spark.createDataFrame([(1, i) for i in range(300)] + [(i, i) for i in range(100)], "k int, i int")
    right = spark.createDataFrame([(i, 10 * i) for i in range(0, 100, 2)] + [(1, 150)], "k int, v int")
    assert skew.hot_values(left, "k") == [1]
    want = sorted((k, i, {**{j: 10 * j for j in range(0, 100, 2)}, 1: 150}.get(k)) for k, i in [tuple(r) for r in left.collect()])
    for most in (1000, 0):  # broadcast, salted
        assert sorted(tuple(r) for r in skew.look_up(left, right, "k", F.col("i"), broadcast_rows=most).select("k", "i", "v").fillna(-1).collect()) == sorted((k, i, -1 if v is None else v) for k, i, v in want)
        rest = skew.anti_join(left, right, "k", F.col("i"), F.col("i") < F.col("v"), lambda: [1], broadcast_rows=most)
        assert sorted(tuple(r) for r in rest.collect()) == sorted((k, i) for k, i, v in want if v is None or i >= v)


# Late events


def test_late_events(spark):
    e = [
        ("a", "2024-01-01 10:05:00", "2024-01-01 10:00:00", None, 2, "t", 0, 1), ("a", "2024-01-01 10:50:00", None, 60_000, 1, "t", 0, 2),
        ("a", "2024-01-01 11:00:00", "2024-01-01 10:59:59", None, 5, "t", 0, 3),  # at the end of the hour: late
        ("a", "2024-01-01 13:00:00", "2024-01-01 10:10:00", None, 7, "t", 0, 4),  # exactly at the cut-off: counts
        ("a", "2024-01-01 13:00:01", "2024-01-01 10:10:00", None, 9, "t", 0, 5),  # past it
        ("a", "2024-01-01 14:00:00", "2024-01-01 10:00:00", None, 2, "t", 0, 1),  # redelivered
        ("a", "2024-01-01 10:00:00", None, None, 2, "t", 0, 6), ("a", None, "2024-01-01 10:00:00", None, 2, "t", 0, 7), ("a", "2024-01-01 10:01:00", "2024-01-01 10:00:30", None, None, None, 0, 1),
    ]
    rows = [(c, a and ts(a), b and ts(b), lag, n, t, p, o, "") for c, a, b, lag, n, t, p, o in e]
    d = spark.createDataFrame(rows, "capture_instance string, event_time timestamp_ntz, source_time timestamp_ntz, lag_ms bigint, rows_written int, topic string, kafka_partition int, kafka_offset bigint, error string")
    store = late.partials(late.first_deliveries(d))
    base = int(ts("2024-01-01 10:00:00").replace(tzinfo=datetime.UTC).timestamp())
    r = late.revisions(store).select("revised_in", "revision", "added_rows_written", "events", "rows_written").orderBy("revision").collect()
    assert [tuple(x) for x in r] == [(None, 0, 3, 3, 3), (base + 3600, 1, 5, 4, 8), (base + 3 * 3600, 2, 7, 5, 15)]
    assert got(late.totals(store).select("events", "rows_written", "late_events", "refused_events")) == [(5, 15, 2, 1)]
    once = late.partials(late.first_deliveries(d).filter("rows_written > 4"))
    rest = late.partials(late.first_deliveries(d).filter("coalesce(rows_written, 0) <= 4"))
    assert got(late.merge(once, rest)) == got(late.merge(rest, once)) == got(store)


def test_store_of_partials_under_redelivery(spark, tmp_path):
    """Copies of one record in different loads, in any order, repeated loads, and compaction: always what all events at once give."""
    rnd = random.Random(9)
    start = ts("2024-01-01")
    minutes = lambda n: datetime.timedelta(minutes=n)
    rows = []
    for offset in range(120):
        happened = start + minutes(rnd.randrange(600))
        for _ in range(rnd.choice([1, 1, 2, 3])):  # deliveries of one record, each with values of its own
            rows.append((rnd.choice("ab"), happened + minutes(rnd.randrange(-5, 200)), rnd.choice([happened, None]), rnd.choice([None, 60_000]), rnd.randrange(9), "t", 0, offset * 100_000, rnd.choice(["", "x"])))
    schema = "capture_instance string, event_time timestamp_ntz, source_time timestamp_ntz, lag_ms bigint, rows_written int, topic string, kafka_partition int, kafka_offset bigint, error string"
    rnd.shuffle(rows)
    frame = lambda x: spark.createDataFrame(x, schema)
    nameless = [("a", start + minutes(5), start, None, 3, None, None, None, "")] * 2
    want = got(late.partials(late.first_deliveries(frame(rows + nameless))))
    store = late.PartialStore(spark, str(tmp_path / "store"))
    assert store.partials().count() == 0
    parts = {"c": rows[150:], "a": rows[:100] + nameless, "b": rows[60:180]}
    for name, part in parts.items():
        store.load(frame(part), name)
    assert got(store.partials()) == want
    store.load(frame(parts["b"]), "b")  # replayed after a failure
    assert got(store.partials()) == want
    store.compact()
    store.load(frame(rows[20:120]), "d")
    store.load(frame([]), "e")
    assert got(store.partials()) == want and len(store.loads) == 3


# Differences


@given(st.dictionaries(st.integers(0, 200), st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", ""]))), st.dictionaries(st.integers(0, 200), st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", ""]))))
@settings(max_examples=5, deadline=None)
def test_differences(spark, a, b):
    schema = "k string, f string, g string"
    left, right = (spark.createDataFrame([(str(k), *v) for k, v in d.items()], schema) for d in (a, b))
    want = [(str(k), "batch only") for k in a.keys() - b.keys()] + [(str(k), "stream only") for k in b.keys() - a.keys()]
    want += [(str(k), "fg"[i]) for k in a.keys() & b.keys() for i in (0, 1) if a[k][i] != b[k][i]]
    d = diff.differences(spark, left, right, "k", {"f": F.col("f"), "g": F.col("g")})
    assert got(d.select("key", "field_name")) == sorted(want, key=repr)
    n = diff.range_counts(left, right, "k", {"f": F.col("f"), "g": F.col("g")}).agg(F.sum("in_both"), F.sum("left_only"), F.sum("right_only")).first()
    assert tuple(x or 0 for x in n) == (len(a.keys() & b.keys()), len(a.keys() - b.keys()), len(b.keys() - a.keys()))


@given(st.sets(st.integers(0, bitmaps.RANGE - 1)), st.sets(st.integers(0, bitmaps.RANGE - 1)), st.integers(0, 30_000), st.integers(0, 2_000))
@settings(max_examples=100, deadline=None)
def test_bitmaps(a, b, start, length):
    a |= set(range(start, min(start + length, bitmaps.RANGE)))
    pa, pb = (bitmaps.pack(np.array(sorted(x), np.int64)) for x in (a, b))
    assert set(bitmaps.bits(pa).tolist()) == a
    assert set(bitmaps.and_not(pa, pb).tolist()) == a - b
    assert set(bitmaps.and_(pa, pb).tolist()) == a & b
    assert len(pa) <= bitmaps.RANGE // 8 + 1


# Histories


def test_history(spark):
    r = [(1, "2024-01-01", "a", 1), (1, "2024-02-01", "a", 2), (1, "2024-02-01", "b", 3), (1, "2024-03-01", None, 1), (1, "2024-04-01", "b", 1), (1, "2024-05-01", "a", 1), (2, "2024-01-01", None, 1), (None, "2024-01-01", "z", 1), (3, None, "z", 1)]
    rows = spark.createDataFrame([(k, t and ts(t), v, ts(f"2024-06-0{n}")) for k, t, v, n in r], "k int, t timestamp_ntz, v string, _loaded_at timestamp_ntz")
    states = history.last_loaded(rows, {"key": F.col("k")}, F.col("t"), {"v": F.col("v")})
    silent = history.intervals(history.attribute_log(states, ["key"], {"v": False}), ["key"], open_end())
    assert got(silent.select("key", "value", F.month("valid_from"), "valid_to")) == [(1, "a", 1, ts("2024-02-01")), (1, "a", 5, OPEN_END), (1, "b", 2, ts("2024-05-01"))]
    spoken = history.intervals(history.attribute_log(states, ["key"], {"v": True}), ["key"], open_end())
    assert got(spoken.select("key", "value", F.month("valid_from"))) == sorted([(1, "a", 1), (1, "b", 2), (1, None, 3), (1, "b", 4), (1, "a", 5), (2, None, 1)], key=repr)


def test_versions_of_several_attributes(spark):
    rows = spark.createDataFrame([(1, ts("2024-01-05"), "a", "x"), (1, ts("2024-01-20"), "a", "y"), (1, ts("2024-03-01"), "b", "y"), (1, ts("2024-04-01"), "b", "y")], "k int, at timestamp_ntz, p string, q string")
    log = history.attribute_log(rows, ["k"], {"p": True, "q": True})
    v = history.versions(log, ["k"], ["p", "q"], open_end()).orderBy("valid_from").select("p", "q", "valid_from", "valid_to").collect()
    assert [tuple(x) for x in v] == [("a", "x", ts("2024-01-05"), ts("2024-01-20")), ("a", "y", ts("2024-01-20"), ts("2024-03-01")), ("b", "y", ts("2024-03-01"), OPEN_END)]


# Orphans and as-of joins


def test_orphans(spark):
    refs = [("t", "f", 1, "2024-01-15"), ("t", "f", 1, "2024-01-15"), ("t", "f", 1, "2023-01-15"), ("t", "f", 1, "2025-03-01"), ("t", "f", 900_000, "2024-01-15"), ("t", "f", 900_000, None), ("t", "f", 1, None), ("t", "f", 0, "2024-01-15"), ("t", "f", None, "2024-01-15"), ("t", "f", 2, "2024-01-15")]
    r = spark.createDataFrame([(a, b, k, d and ts(d)) for a, b, k, d in refs], "table_name string, field_name string, key bigint, at timestamp_ntz")
    k = spark.createDataFrame([("f", 1, "A"), ("f", 2, "A")], "field_name string, key bigint, entity string")
    v = spark.createDataFrame([("f", "A", ts("2024-01-10"), ts("2024-06-01")), ("f", "A", ts("2024-07-01"), ts("2025-02-01"))], "field_name string, entity string, start_date timestamp_ntz, end_date timestamp_ntz")
    assert got(orphans.find(spark, r, k, v)) == [("t", "f", 190001, 900_000, "missing"), ("t", "f", 202301, 1, "later"), ("t", "f", 202401, 900_000, "missing"), ("t", "f", 202503, 1, "deleted")]
    assert orphans.find(spark, r, k.limit(0), v.limit(0)).filter("reason <> 'missing'").count() == 0
    text = lambda d: d.withColumn("key", F.concat(F.lit("k"), F.col("key").cast("string")))
    assert {(x["ref_key"], x["reason"]) for x in orphans.find(spark, text(r.filter("key <> 0")), text(k), v).collect()} == {("k900000", "missing"), ("k1", "later"), ("k1", "deleted")}


def test_orphans_with_a_hot_key(spark, monkeypatch):
    """A third of all references name one key; the shuffled paths are taken."""
    from starloom.sources import tables

    monkeypatch.setattr(tables, "bounded", lambda df, rows: False)
    start = ts("2024-01-01")
    refs = [("t", "f", 7 if i % 3 == 0 else i % 40, start + datetime.timedelta(days=i % 300)) for i in range(900)]
    r = spark.createDataFrame(refs, "table_name string, field_name string, key bigint, at timestamp_ntz")
    k = spark.createDataFrame([("f", i, str(i)) for i in range(1, 35)], "field_name string, key bigint, entity string")
    v = spark.createDataFrame([("f", str(i), start + datetime.timedelta(days=5 * i), start + datetime.timedelta(days=5 * i + 100)) for i in range(1, 35)], "field_name string, entity string, start_date timestamp_ntz, end_date timestamp_ntz")
    want = set()
    for _, _, key, at in refs:
        a = start + datetime.timedelta(days=5 * key)
        if key and (key > 34 or not a <= at < a + datetime.timedelta(days=100)):
            want.add((at.year * 100 + at.month, key, "missing" if key > 34 else "later" if at < a else "deleted"))
    assert {(x["period_month"], x["ref_key"], x["reason"]) for x in orphans.find(spark, r, k, v).collect()} == want


def test_encode(spark):
    d = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("",)], "x string")
    c = orphans.encode(d, ["x"]).collect()
    assert {r["x"] for r in c} == {"a", "b", ""} and len({r["code"] for r in c}) == 3


@given(st.integers(0, 700), st.integers(0, 700), st.integers(1, 4))
@settings(max_examples=25, deadline=None)
def test_cover_is_exact(spark_cover, a, length, levels):
    nodes = spark_cover(a, a + length, levels)
    cells = [c for level, node in nodes for c in range(node << (asof.STRIDE * level), (node + 1) << (asof.STRIDE * level))]
    assert sorted(cells) == list(range(a, a + length))


@pytest.fixture(scope="module")
def spark_cover(spark):
    def run(a, b, levels):
        row = spark.range(1).select(asof.cover(F.lit(a).cast("bigint"), F.lit(b).cast("bigint"), levels).alias("c")).first()
        return [(x["level"], x["node"]) for x in row["c"]]

    return run


def test_as_of(spark):
    rnd = random.Random(3)
    day = datetime.timedelta(days=1)
    start = ts("2023-01-01")
    versions = [(k, start + day * rnd.randrange(700) + datetime.timedelta(seconds=rnd.randrange(86_400)), rnd.randrange(1, 300), i) for i, k in enumerate(rnd.choices([1, 1, 1, 2, 3], k=60))]
    versions = [(k, s, s + day * n if n < 290 else None, i) for k, s, n, i in versions]
    events = [(i, rnd.choice([1, 1, 1, 2, 4, None]), start + datetime.timedelta(seconds=rnd.randrange(700 * 86_400))) for i in range(400)]
    events += [(1000 + i, v[0], v[1]) for i, v in enumerate(versions)] + [(2000 + i, v[0], v[2]) for i, v in enumerate(versions) if v[2]] + [(3000, 1, None)]
    e = spark.createDataFrame(events, "id int, who int, at timestamp_ntz")
    v = spark.createDataFrame([(k, a, b, 1, i) for k, a, b, i in versions], "who int, start_date timestamp_ntz, end_date timestamp_ntz, _version bigint, no int")
    want = {}
    for i, who, at in events:
        hit = [(a, n) for k, a, b, n in versions if who == k and at is not None and a <= at and (b is None or at < b)]
        want[i] = max(hit)[1] if hit else None
    d = asof.as_of(e, v, ["id"], "who", "at", ["no"])
    assert {r["id"]: r["no"] for r in d.collect()} == want


# Windows over buckets


def test_ordering(spark):
    rows = [("hot", i, i % 7) for i in range(300)] + [("cold", 3, 5), (None, 1, None), (None, 2, 4)]
    d = spark.createDataFrame(rows, "k string, i int, v int")
    s = running_sum(d, ["k"], ["i"], "v", "s", F.floor(F.col("i") / 50))
    want = {}
    for k in ("hot", "cold", None):
        total = 0
        for kk, i, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            total += v or 0
            want[kk, i] = total
    assert {(r["k"], r["i"]): r["s"] for r in s.collect()} == want
    r = rank_within(d, ["k"], "i", "r", 8).collect()
    assert sorted(x["r"] for x in r if x["k"] == "hot") == list(range(300))
    d = d.filter("k is not null")
    n = {(x["k"], x["i"]): x["p"] and x["p"]["value"] for x in neighbour(d, ["k"], "i", F.col("v"), "p", F.floor(F.col("i") / 50)).collect()}
    assert n["hot", 0] is None and n["cold", 3] is None and all(n["hot", i] == (i - 1) % 7 for i in range(1, 300))
    f = fill_forward(d.withColumn("v", F.when(F.col("i") % 90 == 0, F.col("v"))), ["k"], "i", ["v"], F.floor(F.col("i") / 50))
    assert {x["i"]: x["v"] for x in f.filter("k = 'hot'").collect()} == {i: (i // 90 * 90) % 7 for i in range(300)}


# Versions, SCD, keys, facts


def test_standing(spark):
    d = spark.createDataFrame([(1, 1, "a", 0), (1, 2, "b", 0), (1, 2, "c", 0), (2, 5, "x", 1), (2, 4, "y", 0), (None, 1, "n", None), (3, None, "z", 0)], "k int, _version bigint, v string, is_deleted int")
    assert got(standing(d, ["k"], ["v"])) == sorted([(1, "c"), (2, "x"), (3, "z"), (None, "n")], key=repr)
    assert got(live(d, ["k"], ["v"])) == sorted([(1, "c"), (3, "z"), (None, "n")], key=repr)


def test_current(spark):
    d = spark.createDataFrame([("a ", ts("2020-01-01"), ts("2021-01-01"), 1, "old"), ("a", ts("2021-01-01"), OPEN_END, 1, "x"), ("a", ts("2021-01-01"), OPEN_END, 2, "y"), ("b", ts("2021-01-01"), OPEN_END, 1, "open"), ("b", ts("2021-01-01"), ts("2022-01-01"), 2, "closed")], "k string, start_date timestamp_ntz, end_date timestamp_ntz, _version bigint, v string")
    assert got(current(d, {"k": F.rtrim("k")}, ["v"]).select("k", "v")) == [("a", "y")]


def test_scd(spark):
    schema = "product_id int, name string, price int"
    now = spark.createDataFrame([(1, 10, "a", 1, 0), (2, 20, "b", 1, 0), (3, 30, None, 1, 0), (4, 40, "", 0, 1), (5, 50, "e", 5, 0)], "product_id int, key int, name string, price int, is_inferred int")
    now = now.withColumns({"start_date": F.lit(ts("2020-01-01")).cast("timestamp_ntz"), "end_date": open_end()})
    new = spark.createDataFrame([(1, "a2", 1), (2, "b2", 2), (3, None, 1), (4, "stub", 9), (6, "new", 1), (5, None, 5)], schema)
    c = scd.classify(new, now, "product_id", ["name"], ["price"])
    assert dict(got(c.select("product_id", "scd_outcome"))) == {1: "type1", 2: "type2", 3: "unchanged", 4: "enriched", 5: "type1", 6: "new"}
    at = F.lit(ts("2024-01-01")).cast("timestamp_ntz")
    w = scd.write_plan(c, "key", "product_id", ["name"], ["price"], [], at, F.lit(7), 50)
    rows = {(r["product_id"], r["action"]): r for r in w.collect()}
    assert set(rows) == {(1, "overwrite"), (2, "close"), (2, "open"), (4, "overwrite"), (5, "overwrite"), (6, "open")}
    assert rows[1, "overwrite"]["key"] == 10 and rows[1, "overwrite"]["name"] == "a2"
    assert rows[2, "close"]["name"] == "b" and rows[2, "close"]["end_date"] == ts("2024-01-01") and rows[2, "open"]["end_date"] == OPEN_END
    assert rows[4, "overwrite"]["key"] == 40 and rows[4, "overwrite"]["price"] == 9
    assert {rows[2, "open"]["key"], rows[6, "open"]["key"]} == {51, 52}


def test_scd_sequence(spark):
    c = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, "a", "y"), (1, 3, "b", "y"), (1, 4, "a", "z"), (2, 1, None, None), (2, 2, None, "q")], "k int, lsn int, t2 string, t1 string")
    c = c.withColumn("at", F.timestamp_add("SECOND", "lsn", F.lit(ts("2024-01-01"))).cast("timestamp_ntz"))
    v = scd.sequence(c, "k", "lsn", "at", ["t1"], ["t2"])
    assert got(v.select("k", "version_no", "t1", "t2", F.second("start_date"))) == sorted([(1, 1, "y", "a", 1), (1, 2, "y", "b", 3), (1, 3, "z", "a", 4), (2, 1, "q", None, 1)], key=repr)


def test_keys(spark):
    d = spark.createDataFrame([(f"k{i}",) for i in range(500)], "n string")
    k = [r["key"] for r in keys.assign_keys(d, "n", "key", 1000).collect()]
    assert sorted(k) == list(range(1001, 1501))
    f = spark.createDataFrame([(1, "DE", ""), (2, "FR", None), (3, None, None)], "i int, country string, city string")
    g = spark.createDataFrame([(7, "DE", None), (8, "FR", "")], "g int, c string, t string")
    assert got(keys.resolve_tuple(f, g, {"country": "c", "city": "t"}, "g", "geo").select("i", "geo")) == [(1, 7), (2, 8), (3, 0)]


def test_facts(spark):
    f = spark.createDataFrame([(1, 1, 5, 0, 1), (1, 2, 6, 0, 1), (2, 1, 7, 0, 1)], "order_id int, product_key int, quantity int, is_deleted int, _version bigint")
    t = facts.tombstones(f, spark.createDataFrame([(1,), (1,), (9,)], "order_id int"), "order_id", F.lit(2))
    once = facts.apply(f, t, ["order_id", "product_key"])
    assert got(once.filter("is_deleted = 0").select("order_id")) == [(2,)] and got(facts.apply(once, t, ["order_id", "product_key"])) == got(once)
    assert facts.snapshot(f, None, "order_id").count() == 3 and facts.snapshot(f, f.limit(0), "order_id").count() == 0


def test_incremental_facts(spark):
    """Inserts, updates, deletes, a line that its order lost, an order changed and then deleted, and a window applied twice."""
    schema = "order_id int, product_key int, quantity int, is_deleted int, _version bigint"
    f = spark.createDataFrame([(1, 1, 5, 0, 1), (1, 2, 6, 0, 1), (2, 1, 7, 0, 1), (3, 1, 1, 0, 1), (4, 1, 1, 0, 1)], schema)
    headers = spark.createDataFrame([(1,), (4,), (5,)], "order_id int")
    lines = spark.createDataFrame([(1, 1, 50), (4, 1, 9), (5, 9, 3)], "order_id int, product_key int, quantity int")  # order 1 lost product 2
    changes = spark.createDataFrame([(1, 4, 10), (5, 2, 10), (2, 4, 10), (2, 1, 11), (6, 2, 10), (6, 1, 11)], "order_id int, operation int, _version int")
    rebuild = lambda h, l: facts.build(h, l, "order_id").withColumns({"is_deleted": F.lit(0), "_version": F.lit(7).cast("bigint")})
    for _ in (1, 2):
        written = facts.incremental(f, changes, headers, lines, "order_id", ["order_id", "product_key"], rebuild, F.lit(7))
        f = facts.apply(f, written, ["order_id", "product_key"])
        assert got(f.filter("is_deleted = 0").select("order_id", "product_key", "quantity")) == [(1, 1, 50), (3, 1, 1), (4, 1, 1), (5, 9, 3)]


def test_next_position(spark):
    from starloom.functions.text import next_position

    p = ["0" * 20, "0" * 10 + "f" * 10, "f" * 20, "00000000aa000000000f"]
    d = spark.createDataFrame([(x,) for x in p], "p string").select(next_position(F.col("p")))
    assert [r[0] for r in d.collect()] == [f"{(int(x, 16) + 1) % 16**20:020x}" for x in p]


def test_values(spark):
    from pyspark.sql import types as T

    d = spark.createDataFrame([("12",), ("x",), ("",), (None,)], "s string")
    assert [r[0] for r in d.select(coerce(F.col("s"), T.IntegerType())).collect()] == [12, 0, 0, 0]
    z = fill_zeros(spark.createDataFrame([(None, None, None, None)], "a int, b string, c date, d decimal(19,4)"), ("c",)).first()
    assert (z["a"], z["b"], z["c"], str(z["d"])) == (0, "", None, "0.0000")
    n = spark.range(1).select(net_amount(F.lit("12.6").cast("decimal(19,4)"), F.lit(4), F.lit(0.05).cast("float"))).first()[0]
    assert str(n) == "47.8800"


def test_whole_transactions(spark):
    """As many as fit the cap, and one longer than the cap whole."""
    from starloom.operators.changefeed import whole_transactions

    d = spark.createDataFrame([(lsn, i) for lsn, n in [(1, 2), (2, 9), (3, 1), (25, 2), (26, 3)] for i in range(n)], "lsn bigint, i int")
    read = lambda last: sorted(r["lsn"] for r in whole_transactions(d, "lsn", last, 5, F.floor(F.col("lsn") / 10)).collect())
    assert read(None) == [1] * 2 and read(1) == [2] * 9 and read(2) == [3, 25, 25] and read(26) == []
