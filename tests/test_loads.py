"""Manifest runs, late records, keyed tables and tables that are replaced whole."""

import os
import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from viewloom.operators import merge
from viewloom.sources import files, manifest, versions
from viewloom.streaming import keyed_table, late


# --- files and their manifest ---


def test_listing_has_every_file(spark, tmp_path):
    for name in ("a/x.json", "a/b/c/deep.json", "a/empty.json", "a/_hidden/x.json", "a/.part", "top.txt", "a/b/two words é.json"):
        path = tmp_path / "zone" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("" if "empty" in name else name)
    found = files.list_files(spark, f"{tmp_path}/zone/", f"file://{tmp_path}/nowhere")
    got = {r.path.removeprefix(f"file:{tmp_path}/zone/"): r for r in found.collect()}
    assert sorted(got) == ["a/b/c/deep.json", "a/b/two words é.json", "a/empty.json", "a/x.json", "top.txt"]
    assert got["a/empty.json"].size == 0 and got["a/x.json"].size == 8
    one = os.stat(tmp_path / "zone/top.txt").st_mtime
    assert abs(got["top.txt"].modified_at.timestamp() - one) < 1e-3
    assert sorted(r.content.decode() for r in files.with_content(found).collect())[0] == ""
    assert files.list_files(spark).collect() == []


def test_files_are_written_by_name(spark, tmp_path):
    base = str(tmp_path / "out")
    wanted = [(f"{base}/a/{i}.bin", bytes([i]) * i) for i in range(9)] + [(None, b"x"), (f"{base}/null", None)]
    df = spark.createDataFrame(wanted, "path string, content binary")
    assert files.write_files(df) == {"files": 10, "bytes": 36}
    assert (tmp_path / "out/a/8.bin").read_bytes() == b"\x08" * 8 and (tmp_path / "out/null").read_bytes() == b""
    files.write_files(df.filter(F.col("path").endswith("8.bin")).withColumn("content", F.lit(b"new")))
    assert (tmp_path / "out/a/8.bin").read_bytes() == b"new"
    assert sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == [f"{i}.bin" for i in range(9)] + ["null"]


def test_manifest_follows_the_files(spark, tmp_path):
    zone, state = tmp_path / "zone", str(tmp_path / "state")
    zone.mkdir()

    def put(name, content, at):
        (zone / name).write_bytes(content)
        os.utime(zone / name, (at, at))

    def texts(run):
        return rows(manifest.documents(spark, state, run).select(F.element_at(F.split("source_path", "/"), -1).alias("n"), "document", "state"))

    put("a.json", b"[1]", 100)
    put("b.json", b"[2]", 100)
    put("empty.json", b"", 100)
    put("bytes.json", b"\xff\xfe", 100)
    put("gone.json", b"[0]", 100)
    assert manifest.pull(spark, [str(zone)], state, "1") == {"new": 5}
    assert texts("1") == [("a.json", "[1]", "new"), ("b.json", "[2]", "new"), ("bytes.json", None, "new"), ("empty.json", "", "new"), ("gone.json", "[0]", "new")]
    assert manifest.pull(spark, [str(zone)], state, "2") == {}
    put("a.json", b"[9]", 200)  # overwritten, as long as before
    put("b.json", b"[2]", 200)  # landed again as it was
    put("empty.json", b"{}", 100)  # same time, other size
    (zone / "gone.json").unlink()
    assert manifest.pull(spark, [str(zone)], state, "3") == {"changed": 2, "same": 1, "gone": 1}
    assert texts("3") == [("a.json", "[9]", "changed"), ("empty.json", "{}", "changed")]
    put("gone.json", b"[0]", 100)  # back again: read again
    assert manifest.pull(spark, [str(zone)], state, "4") == {"new": 1}
    assert manifest.known_files(spark, state).count() == 5
    # A run that died before its manifest rows is repeated under its name and does not double.
    put("a.json", b"[10]", 300)
    assert manifest.pull(spark, [str(zone)], state, "5") == {"changed": 1}
    assert manifest.pull(spark, [str(zone)], state, "5") == {}
    assert manifest.pull(spark, [str(zone)], state, "6") == {"changed": 1}  # run 5's rows were replaced by none


# --- late records ---


def pull(spark, zone, found, **how):
    schema = "id int, feed string, ts timestamp, arrived timestamp"
    spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(f"{zone}/in")
    late.pull_stream(spark.readStream.schema(schema).parquet(f"{zone}/in"), "feed", "ts", ["id"], "arrived", f"{zone}/out", **how).awaitTermination()


def test_late_and_untimed_records_are_kept(spark, tmp_path):
    at, came = (lambda d: datetime(2024, 1, d)), (lambda h: datetime(2024, 2, 1, h))
    zone = str(tmp_path)
    pull(spark, zone, [(1, "a", at(5), came(0)), (2, "a", at(3), came(0)), (3, "a", None, came(0)), (4, "b", at(1), came(0)), (1, "a", at(5), came(0)), (5, None, at(9), came(0))])
    pull(spark, zone, [(6, "a", at(5), came(1)), (7, "a", at(4), came(1)), (8, "b", at(2), came(1)), (1, "a", at(5), came(1)), (9, "c", at(1), came(1)), (10, None, at(9), came(1))])
    pull(spark, zone, [(11, "a", at(6), came(2)), (12, "b", None, came(2)), (7, "a", at(4), came(2)), (1, "b", at(3), came(2))])
    assert rows(late.pulled(spark, f"{zone}/out", late=False), "id", "feed") == sorted(
        [(1, "a"), (2, "a"), (4, "b"), (5, None), (8, "b"), (9, "c"), (11, "a"), (1, "b")], key=lambda r: [str(v) for v in r]
    )
    assert rows(late.pulled(spark, f"{zone}/out", late=True), "id", "reason") == [
        (10, "late"), (12, "no time"), (3, "no time"), (6, "late"), (7, "late"),
    ]
    assert rows(late.feed_marks(spark, f"{zone}/out")) == [(None, at(9)), ("a", at(6)), ("b", at(3)), ("c", at(1))]


def test_allowance_and_forgetting(spark, tmp_path):
    at, came = (lambda d: datetime(2024, 1, d)), (lambda h: datetime(2024, 2, 1, h))
    zone, how = str(tmp_path), {"allowance": "2 days", "forget": "1 hour"}
    pull(spark, zone, [(1, "a", at(10), came(0))], **how)
    pull(spark, zone, [(2, "a", at(9), came(5)), (3, "a", at(8), came(5))], **how)
    pull(spark, zone, [(1, "a", at(11), came(9))], **how)  # its first arrival is forgotten by now
    assert rows(late.pulled(spark, f"{zone}/out", late=False), "id") == [(1,), (1,), (2,)]
    assert rows(late.pulled(spark, f"{zone}/out", late=True), "id") == [(3,)]


# --- keyed tables ---


def test_state_equals_the_batch_fold(spark, tmp_path):
    """Random changes in random batches, deletions and old changes included."""
    rnd = random.Random(20)
    schema = "k1 string, k2 int, seq long, op string, v string, w double"
    changes = [(rnd.choice(["a", "b", None]), rnd.randrange(4), seq, rnd.choice(["put", "put", "delete"]), rnd.choice(["x", None]), rnd.random()) for seq in range(200)]
    df = spark.createDataFrame(changes, schema)
    rnd.shuffle(changes)
    for at in range(0, 200, 70):
        found = [*changes[at : at + 70], ("a", 0, None, "put", "no number", 0.0)]
        spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        keyed_table.keep_table(stream, ["k1", "k2"], "seq", f"{tmp_path}/table").awaitTermination()
    want = merge.upsert_last_write(df, ["k1", "k2"], "seq")
    got = keyed_table.kept_table(spark, f"{tmp_path}/table")
    assert rows(got.select(*want.columns)) == rows(want) and got.count() > 3
    # The changed rows of all batches end in the same table.
    changed = spark.read.parquet(f"{tmp_path}/table/changed").drop("batch")
    assert rows(merge.upsert_last_write(changed, ["k1", "k2"], "seq").select(*want.columns)) == rows(want)
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_tombstones_outlive_old_changes(spark, tmp_path):
    schema = "k int, seq long, op string, v string"
    for found in ([(1, 5, "put", "a"), (2, 5, "put", "b")], [(1, 7, "delete", None)], [(1, 6, "put", "late"), (2, 5, "put", "again"), (3, 1, "delete", None)]):
        spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        keyed_table.keep_table(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), ["k"], "seq", f"{tmp_path}/t").awaitTermination()
    assert rows(keyed_table.kept_table(spark, f"{tmp_path}/t"), "k", "seq", "v") == [(2, 5, "b")]


# --- tables replaced whole ---


def test_a_failed_load_is_never_seen(spark, tmp_path):
    root = str(tmp_path)
    one = {"a": spark.range(3), "b": spark.range(5)}
    assert versions.publish(one, root) == 1
    wrong = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("half-way"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(PySparkException, match="half-way"):
        versions.publish({"a": spark.range(100), "b": wrong}, root)
    assert [versions.current(spark, root, n).count() for n in "ab"] == [3, 5]
    assert versions.publish({"a": spark.range(0), "b": spark.range(2)}, root) == 2
    assert [versions.current(spark, root, n).count() for n in "ab"] == [0, 2]
    assert versions.current(spark, root, "b", number=1).count() == 5
    assert versions.publish({"a": spark.range(1)}, root) == 3
    with pytest.raises(LookupError):
        versions.current(spark, root, "b")
    assert rows(versions.superseded(spark, root), "number") == [(1,)]
    with pytest.raises(ValueError):
        versions.publish({}, root)
