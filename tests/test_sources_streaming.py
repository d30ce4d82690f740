"""Connectors, state, blobs, the contract and the streaming path."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import contract
from starloom.operators import lake, pipeline, quality, telemetry
from starloom.operators.changefeed import EqualityDeleteTable
from starloom.sources import connectors, tables
from starloom.streaming import applier


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_write_table(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.DateType())])
    d = spark.createDataFrame([("x", None, "1", None), ("2", "t", None, None)], "b string, c string, a string, extra string")
    path = str(tmp_path / "t")
    connectors.write_table(d, path, schema, nullable=("c",))
    connectors.write_table(d, path, schema)
    t = spark.read.schema(schema).parquet(path)
    assert t.columns == ["a", "b", "c"] and t.count() == 4 and t.filter("b is null or a is null").count() == 0 and t.filter("c is null").count() == 2
    s = connectors.storage(t, "t").first()
    assert (s["rows"], s["table_name"]) == (4, "t") and s["files"] >= 2 and s["bytes"] > 0
    connectors.truncate(spark, path, schema)
    assert spark.read.schema(schema).parquet(path).count() == 0


def test_state(spark, tmp_path):
    path = str(tmp_path / "state")
    for n, v in ((1, "a"), (3, "c"), (2, "b")):
        spark.createDataFrame([("x", v, n)], "k string, v string, updated_at int").write.mode("append").parquet(path)
    assert got(connectors.read_state(spark, path, "k string, v string, updated_at int", "k").select("k", "v")) == [("x", "c")]
    st = spark.createDataFrame([("a", 1, True), ("b", 2, True)], "k string, seen int, active boolean")
    conf = spark.createDataFrame([("b", False), ("c", True)], "k string, active boolean")
    assert got(connectors.upsert_config(st, conf, "k", ["active"])) == sorted([("a", 1, True), ("b", 2, False), ("c", None, True)], key=repr)


def test_config_and_sources(monkeypatch):
    monkeypatch.setenv("STARLOOM_ROWS_PER_PASS", "7")
    assert connectors.Config.of_environment().rows_per_pass == 7
    assert {s.topic for s in connectors.SOURCES} >= {"rt.orders", "rt.order_details", "rt.employee_territories"} and len(connectors.SOURCES) == 11


def test_envelope(spark):
    d = spark.createDataFrame([(1, 2, "0a", "01", 4, None, "9"), (1, None, "0b", "02", 1, None, None)], "order_id int, product_id int, lsn string, seq string, op int, at timestamp_ntz, quantity string")
    m = connectors.encode(d, connectors.SOURCES[1], "lsn", "seq", "op", "at", ["order_id", "quantity"])
    assert {r["key"] for r in m.collect()} == {"1|2", "1|"}
    bad = spark.createDataFrame([("k", "not json"), ("k", None)], "key string, value string")
    e = connectors.decode(m.unionByName(bad)).orderBy("lsn").collect()
    assert [x["capture_instance"] for x in e] == [None, None, "dbo_OrderDetails", "dbo_OrderDetails"]
    assert e[2]["data"] == {"order_id": "1", "quantity": "9"} and e[3]["data"]["quantity"] is None


def test_order_per_key(spark):
    d = spark.createDataFrame([(f"k{i % 7}", i) for i in range(200)][::-1], "key string, lsn int")
    parts = connectors.in_key_order(d, "key", ["lsn"]).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).orderBy("at").collect()
    of = {}
    for r in parts:
        of.setdefault(r["key"], []).append((r["part"], r["lsn"]))
    assert len(of) == 7 and all(x == sorted(x) and len({p for p, _ in x}) == 1 for x in of.values())


def test_contract(spark):
    d = contract.DIMENSIONS["dim_customer"]
    good = T.StructType([T.StructField("customer_key", T.IntegerType()), T.StructField("customer_alternate_key", T.StringType()), *d.schema.fields] + [T.StructField(c, T.TimestampType()) for c in ("start_date", "end_date")] + [T.StructField("_version", T.LongType())])
    assert d.differences(good) == []
    bad = T.StructType([f for f in good.fields if f.name != "phone"] + [T.StructField("other", T.StringType())])
    assert d.differences(bad) == ["missing in table: phone", "not in contract: other"]
    wrong = T.StructType([T.StructField("fax", T.IntegerType()) if f.name == "fax" else f for f in good.fields])
    assert d.differences(wrong) == ["type of fax: int, not string"]
    src = spark.createDataFrame([(7, "Ann", None, "x")], "employee_id int, first_name string, last_name string, birth_date string")
    r = contract.DIMENSIONS["dim_employees"].rows(src).first()
    assert (r["employee_alternate_key"], r["full_name"], r["birth_date"], r["title"]) == (7, "Ann", None, None)
    assert contract.DIMENSIONS["dim_shippers"].type2 == [] and d.type2 == ["contact_name", "geography_key"]


def test_lake(spark, tmp_path):
    for n in "abc":
        (tmp_path / f"{n}.svg").write_text(n * 3)
    known = tables.Scratch(spark).put(lake.catalogue(lake.read_files(spark, str(tmp_path), "*.svg"), "path"))
    assert known.count() == 3 and {r["size_bytes"] for r in known.collect()} == {3}
    (tmp_path / "a.svg").unlink()
    (tmp_path / "b.svg").write_text("zzz")
    said = lake.verify(known, lake.catalogue(lake.read_files(spark, str(tmp_path), "*.svg"), "path"), "path")
    assert {(r["path"][-5:], r["status"]) for r in said.collect()} == {("a.svg", "missing"), ("b.svg", "modified")}


def test_quality_and_telemetry(spark):
    a = spark.createDataFrame([("x", 2), ("y", 3)], "table_name string, actual bigint")
    e = spark.createDataFrame([("x", 2), ("z", 1)], "table_name string, expected bigint")
    assert got(quality.reconcile(a, e).select("table_name", "status")) == [("x", "OK"), ("y", "MISMATCH"), ("z", "MISMATCH")]
    c = spark.createDataFrame([("s", 1, 10), ("s", 2, 15), ("s", 3, 4), ("s", 3, 7)], "s string, t int, v int")
    assert got(telemetry.counter_rate(c, "s", F.col("t"), "v").select("bucket", "increase")) == sorted([(1, None), (2, 5), (3, 7)], key=repr)
    d = spark.createDataFrame([(x,) for x in "aaabbcd"], "t string")
    assert got(telemetry.top_with_other(d, "t", 2)) == [("Other", 2), ("a", 3), ("b", 2)]


def test_bounded_and_scratch(spark):
    assert tables.bounded(spark.range(5), 5) and not tables.bounded(spark.range(6), 5)
    s = tables.Scratch(spark)
    t = s.put(spark.range(10).repartition(3))
    assert t.count() == 10 and t.schema.names == ["id"]
    s.close()


def test_pipeline(spark, tmp_path):
    c = spark.createDataFrame([("a", "01"), ("a", "05"), ("b", "02")], "source string, lsn string")
    st = spark.createDataFrame([("a", "01"), ("b", None), ("d", "09")], "source string, last string")
    c = c.unionByName(spark.createDataFrame([("c", "03"), ("d", "09")], c.schema))  # c isn't in the state
    w = pipeline.unread(c, st, "source", "lsn", "last")
    assert got(w) == [("a", "05"), ("b", "02")] and pipeline.unread(c.limit(0), st, "source", "lsn", "last").count() == 0
    after = pipeline.read_upto(w, st, "source", "lsn", "last")
    assert got(after) == [("a", "05"), ("b", "02"), ("d", "09")] and pipeline.unread(c, after, "source", "lsn", "last").count() == 0
    c = c.filter("source in ('a', 'b')")
    order = pipeline.load_order()
    assert all(order.index(x) < order.index(t) for t, needed in pipeline.DEPENDS.items() for x in needed)
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    pipeline.logged(spark, "load", log, c, lambda d: d.write.parquet(out))
    with pytest.raises(Exception, match="exists"):
        pipeline.logged(spark, "again", log, c, lambda d: d.write.parquet(out))
    assert got(spark.read.parquet(log).select("step", "rows", "status")) == [("again", None, "failed"), ("load", 3, "success")]
    v = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, _version bigint")
    root = str(tmp_path / "second")
    pipeline.seed({"t": (v, ["k"])}, root)
    assert got(spark.read.parquet(f"{root}/t").select("k", "v")) == [(1, "y")]
    with pytest.raises(FileExistsError):
        pipeline.seed({"t": (v, ["k"])}, root)
    pipeline.seed({"t": (v.limit(0), ["k"])}, root, force=True)


def test_jdbc_round_trip(spark, tmp_path):
    """Tables written to and read from a database through its driver: a whole query, and one read by several tasks."""
    config = connectors.Config(jdbc_url=f"jdbc:derby:{tmp_path}/db;create=true", jdbc_user="app", jdbc_password="app")
    d = spark.createDataFrame([(i, f"n{i}", i % 3) for i in range(100)], "id int, name string, part int")
    connectors.write_jdbc(d, config, "staging", "overwrite")
    connectors.write_jdbc(d.filter("id < 10").withColumn("id", F.col("id") + 100), config, "staging")
    whole = connectors.read_jdbc(spark, config, 'SELECT * FROM staging WHERE "part" = 1')
    assert whole.count() == 36 and whole.schema["id"].dataType == T.IntegerType()
    split = connectors.read_jdbc(spark, config, 'SELECT "id", "name" FROM staging', ("id", 0, 110, 4))
    assert split.rdd.getNumPartitions() == 4 and split.count() == 110
    connectors.write_jdbc(d.limit(0), config, "staging", "overwrite")  # truncates
    assert connectors.read_jdbc(spark, config, 'SELECT "id" FROM staging').count() == 0


def test_loads_in_order(spark, tmp_path):
    ran = []

    def loader(name, fail=False):
        def run():
            ran.append(name)
            return spark.createDataFrame([(1,)], "a int") if not fail else spark.read.parquet(str(tmp_path / "nowhere"))

        return run

    depends = {"a": set(), "b": {"a"}, "c": {"b"}}
    pipeline.run_all(spark, {"c": loader("c"), "a": loader("a"), "b": loader("b")}, str(tmp_path / "w"), str(tmp_path / "log"), depends)
    assert ran == ["a", "b", "c"] and spark.read.parquet(str(tmp_path / "log")).count() == 3
    with pytest.raises(Exception, match="nowhere"):
        pipeline.run_all(spark, {"a": loader("a", True), "b": loader("b")}, str(tmp_path / "w"), str(tmp_path / "log"), depends)
    assert ran[3:] == ["a"]
    pipeline.clone_empty(spark, str(tmp_path / "w" / "a"), str(tmp_path / "w" / "copy"))
    assert spark.read.parquet(str(tmp_path / "w" / "copy")).schema == spark.read.parquet(str(tmp_path / "w" / "a")).schema


# Streaming


def test_dimension_table(spark, tmp_path):
    """Several changes of a key in one batch, an inferred member filled in place, type 1 and 2, replays, and a late older change."""
    from starloom.contract import Dimension
    from starloom.streaming import dimensions

    d = Dimension("dim_x", "x_key", "x_id", "phone string", "name string")
    t = dimensions.DimensionTable(spark, str(tmp_path / "x"), d)
    change = lambda *rows: spark.createDataFrame([(k, n, p, f"2024-01-0{pos}", str(pos)) for k, n, p, pos in rows], "x_id bigint, name string, phone string, at string, position string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    t.ensure(spark.createDataFrame([(1,), (1,), (0,), (None,)], "x_id bigint"), F.lit("2023-01-01").cast("timestamp_ntz"), F.lit(0))
    stub = t.rows().first()
    first = change((1, "a", "p", 1), (1, "b", "p", 3), (2, "c", "q", 1), (None, "z", "z", 1), (1, "b", "r", 4))
    assert got(t.apply(first, F.lit(1))) == [(1, "enriched", 1), (1, "type1", 1), (1, "type2", 1), (2, "new", 1)]
    view = lambda: got(t.rows().select("x_id", "name", "phone", F.month("start_date"), F.dayofmonth("start_date"), F.year("end_date"), "is_inferred"))
    want = [(1, "a", "p", 1, 1, 2024, 0), (1, "b", "r", 1, 3, 2106, 0), (2, "c", "q", 1, 1, 2106, 0)]
    assert view() == want and {r["x_id"] for r in t.rows().filter(F.col("x_key") == stub["x_key"]).collect()} == {1}
    assert t.rows().filter(F.col("x_key") == stub["x_key"]).first()["name"] == "a"  # facts keep the stub's key
    t.apply(first, F.lit(2))
    assert view() == want and t.apply(change((1, "old", "old", 2)), F.lit(3)).count() == 0 and view() == want
    assert got(t.apply(change((2, "c", "q", 5)), F.lit(4))) == [(2, "unchanged", 1)] and view() == want
    assert t.rows().count() == t.rows().select("x_key").distinct().count() == 3


def test_one_writer(spark, tmp_path):
    from starloom.streaming import dimensions

    with dimensions.Lease(spark, str(tmp_path / "t")):
        with pytest.raises(RuntimeError, match="has a writer"), dimensions.Lease(spark, str(tmp_path / "t")):
            pass
    with dimensions.Lease(spark, str(tmp_path / "t")):
        pass


def test_stop_after_the_batch(spark, tmp_path):
    from starloom.streaming import dimensions

    source = tmp_path / "in"
    _write(source, "1.json", [{"key": "a", "value": "1"}])
    seen = []
    q = applier.read_files(spark, str(source)).writeStream.foreachBatch(lambda b, n: seen.append(b.count())).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    dimensions.stop_after_batch(q)
    assert sum(seen) == 1 and not q.isActive


def _message(lsn: int, op: int, order: int, product: int | None, quantity: int | None = None) -> dict:
    source = "dbo_Orders" if product is None else "dbo_OrderDetails"
    data = {"order_id": str(order), "product_id": product and str(product), "quantity": quantity and str(quantity)}
    return {"key": f"{order}|{product or ''}", "value": json.dumps({"capture_instance": source, "operation": str(op), "lsn": f"{lsn:x}", "seqval": "1", "data": data})}


def _write(path, name: str, rows: list[dict]) -> None:
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(map(json.dumps, rows)))
    second = 1_700_000_000 + 10 * len(list(path.iterdir()))  # files are read in the order of their times
    os.utime(path / name, (second, second))


def test_stream_survives_a_failed_batch(spark, tmp_path):
    """Lines before headers, deletes before inserts, a batch that fails half-way and is replayed, and a message that can't be read."""
    source, dead = tmp_path / "in", str(tmp_path / "dead")
    _write(source, "1.json", [_message(5, 4, 1, 1, 8), _message(9, 1, 2, None), {"key": "k", "value": "broken"}])
    _write(source, "2.json", [_message(2, 2, 1, 1, 3), _message(3, 2, 2, 1, 4), _message(10, 2, 2, 2, 6)])
    _write(source, "3.json", [_message(11, 1, 1, 1), _message(12, 2, 1, 1, 9), _message(5, 4, 1, 1, 8)])

    class Failing(EqualityDeleteTable):
        calls = 0

        def append(self, changes):
            super().append(changes)
            Failing.calls += 1
            if Failing.calls == 2:
                raise RuntimeError("lost after the write, before the commit")

    table = Failing(spark, str(tmp_path / "table"))
    run = lambda: applier.apply_orders(spark, applier.read_files(spark, str(source)), table, str(tmp_path / "check"), dead).awaitTermination()
    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert got(table.lines().select("order_id", "product_id", "is_deleted", "quantity")) == sorted([(1, 1, 0, 9), (2, 1, 1, None), (2, 2, 0, 6)], key=repr)
    assert spark.read.json(dead).select("raw").distinct().collect()[0][0] == "broken"


def test_late_events_correct_a_window_until_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    rows = [["2024-01-01 10:10:00", 1.0], ["2024-01-01 12:30:00", 2.0]], [["2024-01-01 10:20:00", 4.0], ["2024-01-02 12:00:00", 8.0]], [["2024-01-02 12:00:01", 0.0]], [["2024-01-01 10:30:00", 16.0], ["2024-01-05 00:00:00", 0.0]]
    for i, part in enumerate(rows):
        _write(source, f"{i}.json", [{"at": a, "k": "x", "v": v} for a, v in part])
    e = applier.read_files(spark, str(source), "at timestamp, k string, v double")
    out = str(tmp_path / "out")
    applier.run_to_end(applier.tumbling(e, "at", "1 hour", "6 hours", ["k"], "v"), lambda b, n: b.withColumn("n", F.lit(n)).write.mode("append").parquet(out), str(tmp_path / "check"))
    r = spark.read.parquet(out)
    ten = r.filter("hour(window_start) = 10").collect()
    assert [(x["events"], x["total"]) for x in ten] == [(2, 5.0)]  # the last event of that hour came after the cut-off
