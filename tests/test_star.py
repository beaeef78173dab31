from datetime import date, datetime

import pytest
from conftest import rows

from viewloom.operators import star
from viewloom.plans import jobs

T0 = datetime(2024, 1, 1, 10)
EVENTS = "media_id string, media_url string, received_at timestamp, percent_viewed double, visitor_key string, ip string, country string"
MEDIA = "hashed_id string, name string, created timestamp, duration double, snapshot_date date"
VISITORS = "visitor_key string, created_at timestamp, load_count bigint, play_count bigint"


@pytest.fixture
def tables(spark):
    events = spark.createDataFrame(
        [
            ("m1", "u1", T0, 0.5, "v1", "ip1", "C1"),
            ("m1", "u1", T0, 0.5, "v1", "ip1", "C1"),
            ("m1", "u1", T0, 0.25, "v2", "ip2", "C2"),
            ("m1", "u1", T0, None, "v3", "ip3", "C3"),
            ("m2", "u2", T0, 0.5, "v1", "ip1", "C1"),
            ("zz", "u9", T0, 1.0, "v4", "ip4", "C4"),
        ],
        EVENTS,
    )
    media = spark.createDataFrame(
        [
            ("m1", "One", T0, 100.0, date(2024, 2, 1)),
            ("m1", "One", T0, 200.0, date(2024, 2, 2)),
            ("m2", "Two", T0, None, date(2024, 2, 1)),
            ("m3", "Three", T0, 30.0, date(2024, 2, 1)),
        ],
        MEDIA,
    )
    visitors = spark.createDataFrame(
        [
            ("v1", datetime(2024, 1, 1), 4, 1),
            ("v1", datetime(2024, 1, 2), 4, 2),
            ("v2", datetime(2024, 1, 1), 0, 1),
            ("v3", datetime(2024, 1, 1), None, 1),
            ("v5", datetime(2024, 1, 1), 4, 4),
        ],
        VISITORS,
    )
    return events, media, visitors


TARGETS = ["m1", "m2", "m3"]


def test_dim_media_keeps_media_without_events(tables):
    events, media, _ = tables
    got = rows(star.dim_media(media, events, TARGETS, {"m1": "YouTube"}), "media_id", "url", "channel")
    assert got == [("m1", "u1", "YouTube"), ("m2", "u2", "Facebook"), ("m3", None, "Facebook")]


def test_dim_visitor_is_inner(tables):
    events, _, visitors = tables
    got = rows(star.dim_visitor(visitors, events, TARGETS))
    assert got == [("v1", "ip1", "C1"), ("v2", "ip2", "C2"), ("v3", "ip3", "C3")]


def test_dim_visitor_with_address_on_the_visitor_side(spark, tables):
    events, _, _ = tables
    visitors = spark.createDataFrame([("v1", "a"), ("v9", "b")], "visitor_key string, ip string")
    got = rows(star.dim_visitor(visitors, events.drop("ip"), TARGETS))
    assert got == [("v1", "a", "C1")]


def test_fact_latest_and_parity(tables):
    events, media, visitors = tables
    latest = star.fact_media_engagement(events, media, visitors, TARGETS)
    got = rows(latest, "media_id", "visitor_id", "play_rate", "total_watch_time")
    assert got == [
        ("m1", "v1", 0.5, 100.0),
        ("m1", "v2", 0.0, 50.0),
        ("m1", "v3", 0.0, None),
        ("m2", "v1", 0.5, None),
    ]
    parity = star.fact_media_engagement(events, media, visitors, TARGETS, mode="parity")
    got = rows(parity, "media_id", "visitor_id", "play_rate", "total_watch_time")
    assert got == [
        ("m1", "v1", 0.25, 100.0),
        ("m1", "v1", 0.25, 50.0),
        ("m1", "v1", 0.5, 100.0),
        ("m1", "v1", 0.5, 50.0),
        ("m1", "v2", 0.0, 25.0),
        ("m1", "v2", 0.0, 50.0),
        ("m1", "v3", 0.0, None),
        ("m2", "v1", 0.25, None),
        ("m2", "v1", 0.5, None),
    ]


def test_equal_snapshots_do_not_multiply(tables):
    events, media, visitors = tables
    same = media.withColumn("duration", media.duration * 0 + 10)
    fact = star.fact_media_engagement(events, same, visitors.dropDuplicates(["visitor_key"]), ["m1"], "parity")
    assert fact.count() == 3


def test_target_forms_agree(spark, tables):
    events, _, _ = tables
    as_table = spark.createDataFrame([(t,) for t in TARGETS], "id string")
    long_list = TARGETS + [f"x{i}" for i in range(star.LONGEST_IN_LIST)]
    short = rows(star.keep_targets(events, TARGETS))
    assert short == rows(star.keep_targets(events, as_table))
    assert short == rows(star.keep_targets(events, long_list))


def test_column_on_two_sides_is_refused(tables):
    events, media, visitors = tables
    with pytest.raises(ValueError, match="duration"):
        star.fact_media_engagement(events, media, visitors.withColumn("duration", visitors.load_count))


def test_build_star_replaces_tables(spark, tables, tmp_path):
    events, media, visitors = tables
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for name, df in (("event_stats", events), ("media_show", media), ("visitor_stats", visitors)):
        df.write.parquet(f"{source}/{name}")
    for _ in range(2):
        jobs.build_star(spark, source, out, TARGETS, {"m1": "YouTube"})
    assert spark.read.parquet(f"{out}/fact_media_engagement").count() == 4
    assert spark.read.parquet(f"{out}/dim_media").count() == 3
    assert spark.read.parquet(f"{out}/dim_visitor").columns == star.DIM_VISITOR


def test_target_filter_reaches_the_scan(spark, tables, tmp_path):
    events, media, visitors = tables
    events.write.parquet(str(tmp_path / "e"))
    fact = star.fact_media_engagement(spark.read.parquet(str(tmp_path / "e")), media, visitors, TARGETS)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "In(media_id" in plan
    assert "media_url" not in plan.split("ReadSchema")[1].split("\n")[0]
