import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import flatten, incremental
from viewloom.plans import jobs
from viewloom.sources import catalog, raw_json, sinks, state
from viewloom.streaming import convert


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "zone" / "raw" / "events"
    folder.mkdir(parents=True)
    files = {
        "list.json": '[{"a":1,"n":null,"s":{"x":1,"l":[1,2]}},{"a":2,"s":{"x":2,"l":[]}}]',
        "obj.json": '{\n "a":3,\n "s":{"x":9}\n}',
        "empty.json": "[]",
        "scalar.json": "7",
        "bad.json": "{bad",
        "UPPER.JSON": '{"a":4}',
        "note.txt": "nothing",
    }
    for name, text in files.items():
        (folder / name).write_text(text)
    (folder / "latin.json").write_bytes('{"a":"é"}'.encode("latin-1"))
    (folder / "dir").mkdir()
    return str(tmp_path / "zone")


def test_documents_become_lines(spark, landing):
    lines = raw_json.to_lines(raw_json.read_documents(spark, landing))
    got = sorted(
        (r.target_path.rsplit("/zone/", 1)[1], r.record_no, r.line) for r in lines.collect()
    )
    assert got == [
        ("processed/events/UPPER.jsonl", 0, '{"a":4}'),
        ("processed/events/list.jsonl", 0, '{"a":1,"n":null,"s":{"l":[1,2],"x":1}}'),
        ("processed/events/list.jsonl", 1, '{"a":2,"s":{"l":[],"x":2}}'),
        ("processed/events/obj.jsonl", 0, '{"a":3,"s":{"x":9}}'),
        ("processed/events/scalar.jsonl", 0, "7"),
    ]


def test_lists_of_any_size_keep_types(spark):
    long = "[" + ",".join(['"12"', '"abc"', "null", "7", '{"a":[1,"x"]}'] * 20_000) + "]"
    df = spark.createDataFrame([('["abc","12",null,12,1.5,true,{"b":{"x":null},"a":1},[null]]',), (long,), ("[NaN]",), ("['a']",), ("",), (" [1,",)], "document string")
    parsed = raw_json.parse_documents(df)
    lines = raw_json.explode_records(parsed).select("record_no", raw_json.json_line().alias("line"))
    got = [r.line for r in lines.orderBy("record_no").collect()]
    short = ['"abc"', '"12"', "null", "12", "1.5", "true", '{"a":1,"b":{"x":null}}', "[null]"]
    assert len(got) == 100_008 and set(short) <= set(got)
    assert parsed.filter(raw_json.is_broken()).count() == 4


def test_empty_files_are_quarantined(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "none.json").write_bytes(b"")
    (tmp_path / "raw" / "one.JSON").write_text('{"a":1}')
    counts = raw_json.backfill(raw_json.read_documents(spark, str(tmp_path / "raw")), str(tmp_path / "out"))
    assert counts == {"files": 2, "quarantined": 1, "records": 1}


def line_files(spark, out):
    found = spark.read.option("recursiveFileLookup", "true").text(f"{out}/files").select(F.input_file_name().alias("f"), "value")
    return sorted((r.f.split("/files/")[1], r.value) for r in found.collect())


def test_line_files_keep_names_and_other_runs(spark, tmp_path):
    out = str(tmp_path / "out")
    first = spark.createDataFrame([("/z/raw/a/x.json", "[1,2]"), ("/z/raw/a/y.json", "{"), ("/z/raw/a/e.json", "[]")], "source_path string, document string")
    assert raw_json.write_line_files(first, out) == {"files": 2, "quarantined": 1}
    again = spark.createDataFrame([("/z/raw/b/x.json", '{"k":null}')], "source_path string, document string")
    raw_json.write_line_files(again, out)
    assert line_files(spark, out) == [("z/processed/a/x.jsonl", "1"), ("z/processed/a/x.jsonl", "2"), ("z/processed/b/x.jsonl", '{"k":null}')]
    assert (tmp_path / "out/files/z/processed/a/e.jsonl").read_bytes() == b""
    assert [r.value for r in spark.read.text(f"{out}/quarantine").collect()] == ['{"source_path":"/z/raw/a/y.json","reason":"not a JSON document"}']


def test_line_files_of_two_sources_never_mix(spark, tmp_path):
    """Two prefixes keep their own files; of two documents that would be one file the first has it."""
    out = str(tmp_path / "out")
    found = [("/a/raw/x.json", "[1,2]"), ("/b/raw/x.json", "[3,4]"), ("/a/raw/y.JSON", "[5]"), ("/a/raw/y.json", "[6]"), ("/c/x.json", "[7]"), (None, "[8]")]
    found += [("/a/raw/x.json", "[1,2]"), ("file:/a/raw/two words.json", "[9]")]
    rows = spark.createDataFrame(found, "source_path string, document string")
    assert raw_json.write_line_files(rows, out)["quarantined"] == 2
    assert line_files(spark, out) == [
        ("a/processed/two%20words.jsonl", "9"), ("a/processed/x.jsonl", "1"), ("a/processed/x.jsonl", "2"), ("a/processed/y.jsonl", "5"),
        ("b/processed/x.jsonl", "3"), ("b/processed/x.jsonl", "4"), ("c/x.jsonl", "7"),
    ]
    reasons = sorted(r.value for r in spark.read.text(f"{out}/quarantine").collect())
    assert reasons == ['{"reason":"no path"}', '{"source_path":"/a/raw/y.json","reason":"name is taken"}']


def test_null_times_are_oldest(spark):
    rows_ = [("a", i, datetime(2024, 1, 1, i) if i < 3 else None) for i in range(5)]
    df = spark.createDataFrame(rows_, "feed string, id int, ts timestamp")
    assert incremental.full_load(df, ["feed"], "ts", ["id"], cap=5_000).count() == 5
    assert sorted(r.id for r in incremental.full_load(df, ["feed"], "ts", ["id"], cap=4).collect()) == [0, 1, 2, 3]
    assert sorted(r.id for r in incremental.full_load(df, ["feed"], "ts", ["id"], cap=2).collect()) == [1, 2]


def test_incremental_pull_job(spark, tmp_path):
    landing, marks = str(tmp_path / "landing"), str(tmp_path / "marks")
    df = spark.createDataFrame([("a", 1, datetime(2024, 1, 1)), ("a", 2, datetime(2024, 1, 2)), ("a", 3, None)], "feed string, id int, ts timestamp")
    run = lambda rows_, day, **more: jobs.incremental_pull(rows_, ["feed"], "ts", ["id"], landing, marks, datetime(2024, 2, day), **more)
    assert run(df, 1) == 3
    assert run(df, 2) == 0  # nothing newer
    assert state.load_watermark(spark, marks) == datetime(2024, 1, 2)
    broken = df.withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        run(broken.withColumn("ts", F.lit(datetime(2025, 1, 1))), 3)
    assert state.load_watermark(spark, marks) == datetime(2024, 1, 2)  # a failed write moves nothing
    newer = df.unionByName(spark.createDataFrame([("a", 4, datetime(2024, 1, 3))], df.schema))
    assert run(newer, 3) == 1
    assert state.load_watermark(spark, marks) == datetime(2024, 1, 3)
    assert spark.read.json(landing).count() == 4


def test_backfill_isolates_broken_files(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    counts = raw_json.backfill(raw_json.read_documents(spark, landing), out)
    assert counts == {"files": 7, "quarantined": 2, "records": 5}
    assert spark.read.text(f"{out}/status=converted").count() == 5
    bad = [json.loads(r.value)["source_path"] for r in spark.read.text(f"{out}/status=quarantined").collect()]
    assert sorted(p.rsplit("/", 1)[1] for p in bad) == ["bad.json", "latin.json"]


@pytest.mark.parametrize(
    "path,expected",
    [
        ("raw/x.json", "processed/x.jsonl"),
        ("raw/a/raw/x.json", "processed/a/processed/x.jsonl"),
        ("other/x.tar.json", "other/x.tar.jsonl"),
        ("raw/.json", "processed/.json.jsonl"),
        ("raw/a..json", "processed/a..jsonl"),
        ("raw.d/x", "raw.d/x.jsonl"),
    ],
)
def test_target_path(spark, path, expected):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(raw_json.target_path(F.col("p"))).first()[0] == expected


RECORDS = [
    ("f", "1", '{"created_at":"2024-01-02T00:00:01Z"}'),
    ("f", "2", '{"created_at":"2024-01-02T00:00:00Z"}'),
    ("f", "3", '{"created_at":"2024-01-01T00:00:00Z"}'),
    ("f", "4", '{"received_at":"2024-01-03T00:00:00Z"}'),
    ("f", "5", '{"created_at":"2024-01-01T00:00:00Z","received_at":"2024-01-03T00:00:00Z"}'),
    ("f", "6", '{"created_at":"2024-01-02T02:00:00+02:00"}'),
    ("f", "7", '{"created_at":null,"received_at":"2024-01-03T00:00:00Z"}'),
]


def records(spark):
    df = spark.createDataFrame(RECORDS, "feed string, id string, body string")
    return df.withColumn("ts", incremental.record_time("rec")) if "rec" in df.columns else (
        df.withColumn("rec", F.parse_json("body")).withColumn("ts", incremental.record_time("rec")).drop("rec")
    )


def test_strict_watermark(spark):
    got = incremental.newer_than(records(spark), "ts", "2024-01-02 00:00:00")
    assert [r[0] for r in rows(got, "id")] == ["1", "4"]


def test_no_watermark_keeps_the_newest(spark):
    df = records(spark).filter("ts is not null")
    assert incremental.pull(df, ["feed"], "ts", ["id"], None).count() == 6
    got = incremental.full_load(df, ["feed"], "ts", ["id"], cap=3)
    assert [r[0] for r in rows(got, "id")] == ["1", "2", "4"]


def test_full_load_matches_a_plain_sort(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("feed"),
        "id",
        F.timestamp_seconds(F.hash("id") % 100000).alias("ts"),
    )
    got = {tuple(r) for r in incremental.full_load(df, ["feed"], "ts", ["id"], cap=37).collect()}
    want = set()
    by_feed = {}
    for r in df.collect():
        by_feed.setdefault(r.feed, []).append(tuple(r))
    for group in by_feed.values():
        want.update(sorted(group, key=lambda r: (-r[2].timestamp(), r[1]))[:37])
    assert got == want


def test_watermark_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.load_watermark(spark, path) is None
    df = records(spark).filter("ts is not null")
    state.save_watermark(df, "ts", path)
    mark = state.load_watermark(spark, path)
    assert mark is not None
    assert incremental.newer_than(df, "ts", mark).isEmpty()
    state.save_watermark(df.filter("id = '3'"), "ts", path)
    assert state.load_watermark(spark, path) == mark


def test_flatten_rules(spark):
    df = spark.sql("select 1 as id, named_struct('x', 2, 'y', named_struct('z', 'q')) as s, array(named_struct('v', 1)) as l")
    assert flatten.flatten_structs(df).columns == ["id", "s.x", "s.y.z", "l"]
    assert flatten.has_struct(df) and not flatten.has_struct(df.select("id", "l"))
    assert flatten.flatten_if_nested(df.select("id", "l")).columns == ["id", "l"]


def test_relationalize_nested_arrays(spark):
    df = spark.sql(
        "select 1 as id, array(named_struct('v', 5, 'w', array('a', 'b')), named_struct('v', 6, 'w', array())) as l"
    )
    tables = flatten.relationalize(df, ["id"])
    assert set(tables) == {"root", "root.l", "root.l.value.w"}
    assert tables["root"].columns == ["id"]
    assert rows(tables["root.l"]) == [(1, 0, 5), (1, 1, 6)]
    assert rows(tables["root.l.value.w"]) == [(1, 0, 0, "a"), (1, 0, 1, "b")]


def test_snapshot_rerun(spark, tmp_path):
    df = spark.range(3)
    day = date(2024, 2, 1)
    for replace, expected in ((False, 6), (True, 3)):
        path = str(tmp_path / f"s{replace}")
        for _ in range(2):
            assert sinks.write_snapshot(df, path, day, replace)
        back = spark.read.parquet(path)
        assert back.count() == expected
        assert dict(back.dtypes)["snapshot_date"] == "date"


def test_empty_inputs_write_nothing(spark, tmp_path):
    empty = spark.range(0)
    assert not sinks.append_parquet(empty, str(tmp_path / "a"))
    assert not sinks.write_snapshot(empty, str(tmp_path / "b"), date(2024, 1, 1))
    assert not sinks.write_json_lines(empty, str(tmp_path / "c"))
    assert not any(tmp_path.iterdir())


def test_catalog_reads_lines_with_schema(spark, tmp_path):
    folder = tmp_path / "media_show"
    folder.mkdir()
    (folder / "a.json").write_text('{"hashed_id":"m","duration":2.5}\n{broken\n')
    df = catalog.read_table(spark, "media_show", str(tmp_path), "json").cache()
    assert df.count() == 2
    assert df.filter("_corrupt_record is not null").count() == 1


def test_stream_converts_new_files_only(spark, landing, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    convert.convert_new_files(spark, landing, out, checkpoint).awaitTermination()
    assert spark.read.text(f"{out}/batch=0/status=converted").count() == 5
    with open(f"{landing}/raw/events/more.json", "w") as f:
        f.write('[{"a":10},{"a":11}]')
    convert.convert_new_files(spark, landing, out, checkpoint).awaitTermination()
    assert spark.read.text(f"{out}/batch=1/status=converted").count() == 2
    convert.convert_new_files(spark, landing, out, checkpoint).awaitTermination()
    assert len(list((tmp_path / "out").iterdir())) == 2


def test_stream_bookmark(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = spark.sql("select 1L as id, named_struct('x', 2L) as s").schema
    for start, total in ((0, 3), (3, 6), (6, 9)):
        spark.range(start, start + 3).selectExpr("id", "named_struct('x', id) as s").write.mode("append").json(source)
        convert.flatten_new_files(spark, source, schema, out, checkpoint).awaitTermination()
        back = spark.read.parquet(out)
        assert back.columns == ["id", "s_x"]
        assert back.count() == total


def test_landing_keeps_the_last_upload(spark):
    df = spark.createDataFrame(
        [("m", datetime(2024, 1, 1), "a"), ("m", datetime(2024, 1, 2), "b"), ("n", datetime(2024, 1, 1), "c")],
        "media_id string, at timestamp, body string",
    )
    got = incremental.landing_latest(df, ["media_id"], ["at"])
    assert rows(got, "media_id", "body") == [("m", "b"), ("n", "c")]
