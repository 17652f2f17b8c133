"""Nested differences, optimistic commits, and the ledger as stream state."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftmill.operators import commits, structure
from siftmill.streaming import remembered


def docs(spark, *values):
    return spark.createDataFrame([(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)], "id int, doc string")


def test_leaves(spark):
    df = docs(spark, {"b": [1, {"x": None, "y": []}], "a": {}, "c": "s"}, "no json", None, 5, [])
    got = {(r["id"], r["path"], r["value"]) for r in structure.leaves(df, "id", "doc").collect()}
    assert got == {(0, "$.b[0]", "1"), (0, "$.b[1].x", "null"), (0, "$.b[1].y", "[]"), (0, "$.a", "{}"), (0, "$.c", '"s"'), (1, "$", "no json"), (3, "$", "5"), (4, "$", "[]")}
    assert structure.leaves(df.limit(0), "id", "doc").count() == 0


def test_differences(spark):
    deep = {"k": [{"n": {"m": [1, 2, {"z": "old"}]}} for _ in range(12)], "t": 1}
    other = json.loads(json.dumps(deep))
    other["k"][10]["n"]["m"][2]["z"] = "new"
    other["k"][2]["n"]["m"].append(3)
    a = docs(spark, deep, {"a": 1, "b": 2}, {"x": 1}, {"x": {"y": 1}}, None, {"same": [1, 2]}, [1, 2])
    b = docs(spark, other, {"b": 2, "a": 1}, {}, {"x": 5}, {"new": 1}, {"same": [1, 2]}, [2, 1])
    got = {(r["id"], r["path"], r["change"], r["was"], r["now"]) for r in structure.differences(a, b, "id", "doc").collect()}
    assert got == {
        (0, "$.k[10].n.m[2].z", "changed", '"old"', '"new"'), (0, "$.k[2].n.m[3]", "added", None, "3"), (2, "$.x", "removed", "1", None), (2, "$", "added", None, "{}"),
        (3, "$.x.y", "removed", "1", None), (3, "$.x", "added", None, "5"), (4, "$.new", "added", None, "1"), (6, "$[0]", "changed", "1", "2"), (6, "$[1]", "changed", "2", "1"),
    }
    first = {r["id"]: r["path"] for r in structure.first_difference(a, b, "id", "doc").collect()}
    assert first == {0: "$.k[2].n.m[3]", 2: "$", 3: "$.x", 4: "$.new", 6: "$[0]"}  # 2 before 10
    v = {(r["rule"], r["entity"], r["field"]) for r in structure.append_only(a, b.where("id != 1"), "id", "doc").collect()}
    assert ("removed", "1", "$") in v and ("changed", "0", "$.k[2].n.m[3]") in v and len(v) == 6


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


def test_two_writers(spark, tmp_path):
    folder = f"file://{tmp_path}/archive"
    empty = commits.snapshot(spark, folder)
    assert empty.version == 0
    one = commits.commit(empty, {"items": frame(spark, 1, 2)}, folder, "r1", {"published": 2})
    with pytest.raises(commits.Conflict):  # a writer that has seen nothing of it
        commits.commit(empty, {"items": frame(spark, 3)}, folder, "r2", {})
    with pytest.raises(commits.Conflict):
        commits.commit(one, {"items": frame(spark, 9)}, folder, "r1", {})
    two = commits.commit(commits.snapshot(spark, folder), {"items": frame(spark, 3), "log": frame(spark, 7)}, folder, "r2", {})
    assert commits.snapshot(spark, folder) == two and two.runs() == ["r1", "r2"] and two.entries[1]["parent"] == one.digest
    rows = {(r["id"], r["run_id"]) for r in commits.committed(spark, folder, "items", two).collect()}
    assert rows == {(1, "r1"), (2, "r1"), (3, "r2")} and commits.committed(spark, folder, "none", two) is None
    assert commits.committed(spark, folder, "none", two, "id int").count() == 0
    bad = frame(spark, 1).select(F.lit("error").alias("severity"))
    with pytest.raises(ValueError, match="rules"):
        commits.commit(two, {"items": frame(spark, 4)}, folder, "r3", {}, bad)


def test_retries_see_what_won(spark, tmp_path):
    folder, seen = f"file://{tmp_path}/archive", []

    def make(snap):
        seen.append(snap.version)
        if len(seen) == 1:  # another writer comes between
            commits.commit(snap, {"items": frame(spark, 1)}, folder, "other", {})
        old = commits.committed(spark, folder, "items", snap, "id int")
        return {"items": old.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).cast("int").alias("id"))}, {}

    out = commits.run_with_retries(spark, folder, "mine", make)
    assert seen == [0, 1] and out.runs() == ["other", "mine"]
    assert {(r["id"], r["run_id"]) for r in commits.committed(spark, folder, "items", out).collect()} == {(1, "other"), (2, "mine")}


def test_a_changed_past_is_an_error(spark, tmp_path):
    folder = f"file://{tmp_path}/archive"
    s = commits.commit(commits.snapshot(spark, folder), {"i": frame(spark, 1)}, folder, "r1", {"n": 1})
    commits.commit(s, {"i": frame(spark, 2)}, folder, "r2", {})
    log = next((tmp_path / "archive/_log").glob("*1.json"))
    log.write_text(log.read_text().replace('"n": 1', '"n": 2'))
    for crc in (tmp_path / "archive/_log").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(ValueError, match="does not follow"):
        commits.snapshot(spark, folder)


def test_ledger_state(spark, tmp_path):
    old = {k: spark.conf.get(k, None) for k in remembered.SETTINGS}
    for k, v in remembered.SETTINGS.items():
        spark.conf.set(k, v)
    schema = "key string, at timestamp, run_id string, code string, verdict string, item_id string"
    t = [datetime(2026, 1, d) for d in range(1, 5)]
    batches = [
        [("a", t[0], "r1", "EV_PASS", "published", "i1"), ("b", t[0], "r1", "NOT_JUDGED", None, None), ("c", t[1], "r1", "EV_LOW", "dropped", None), ("c", t[0], "r1", "EV_PASS", "published", "i2")],
        [("a", t[2], "r2", "EV_LOW", "dropped", None), ("b", t[2], "r2", "EV_LOW", "dropped", None)], [("b", t[3], "r3", "EV_PASS", "published", "i3")],
    ]
    got = []
    try:
        for n, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
            out = remembered.remembered(stream)
            # a replayed run goes on from the state that the one before left
            q = out.writeStream.foreachBatch(lambda df, i, n=n: df.write.mode("append").parquet(f"{tmp_path}/rows{n}")).option("checkpointLocation", f"{tmp_path}/state")
            q.trigger(availableNow=True).start().awaitTermination()
            got.append({(r["key"], r["run_id"], r["verdict"], r["outcome"]) for r in spark.read.parquet(f"{tmp_path}/rows{n}").collect()})
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    assert got[0] == {("a", "r1", "published", "added"), ("b", "r1", None, "left"), ("c", "r1", "published", "added"), ("c", "r1", "published", "known")}
    assert got[1] == {("a", "r1", "published", "known"), ("b", "r2", "dropped", "added")} and got[2] == {("b", "r2", "dropped", "known")}
