import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import merge, ordered


@pytest.fixture(scope="module")
def pages(spark):
    data = [
        ("hot", p, [f"{p}.{i}" for i in range(p % 4)], p, f"L{p}", f"t{p};") for p in range(0, 300, 3)
    ] + [("b", 5, ["x"], None, None, None), ("b", 9, None, 4, "last", "end"), ("c", 1, [], 1, "only", "")]
    return spark.createDataFrame(data, "request string, page_no int, items array<string>, count bigint, label string, text string")


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(merge, "PAGES_PER_BLOCK", 16)


def joined(pages):
    whole = {}
    for r in sorted(pages.collect(), key=lambda r: (r.request, r.page_no)):
        whole.setdefault(r.request, []).extend(r["items"] or [])
    return whole


def test_merge_scalars(pages):
    got = {r.request: r for r in merge.merge_pages(pages, ["request"], "page_no", ["count"], ["label"]).collect()}
    assert got["hot"]["count"] == sum(range(0, 300, 3)) and got["hot"].label == "L0"
    assert got["b"]["count"] == 4 and got["b"].label is None


@pytest.mark.parametrize("segment", [7, 1000])
def test_merge_lists(pages, segment):
    merged = merge.merge_page_items(pages, ["request"], "page_no", "items", segment)
    whole = {}
    for r in sorted(merged.collect(), key=lambda r: (r.request, r.segment)):
        assert len(r["items"]) <= segment
        whole.setdefault(r.request, []).extend(r["items"])
    assert whole == {k: v for k, v in joined(pages).items() if v}


@pytest.mark.parametrize("segment", [5, 100000])
def test_merge_text(pages, segment):
    merged = merge.merge_page_text(pages, ["request"], "page_no", "text", segment)
    whole = {}
    for r in sorted(merged.collect(), key=lambda r: (r.request, r.segment)):
        whole[r.request] = whole.get(r.request, "") + r.text
    assert whole["hot"] == "".join(f"t{p};" for p in range(0, 300, 3))
    assert whole["b"] == "end" and "c" not in whole


@pytest.mark.parametrize("cap", [1, 3, 40, 10_000])
def test_limit_and_resume_cover_everything(pages, cap):
    kept = merge.limit_pages(pages, ["request"], "page_no", "items", cap)
    head = joined(kept)
    whole = joined(pages)
    assert {k: v for k, v in head.items() if v} == {k: v[:cap] for k, v in whole.items() if v}
    positions = merge.resume_position(pages, ["request"], "page_no", "items", cap)
    rest = joined(merge.resume_pages(pages, positions, ["request"], "page_no", "items"))
    assert {k: v for k, v in rest.items() if v} == {k: v[cap:] for k, v in whole.items() if v[cap:]}


def test_resume_again_counts_skipped_items(spark):
    df = spark.createDataFrame([("r", 1, ["a", "b", "c", "d"])], "request string, page_no int, items array<string>")
    first = merge.resume_position(df, ["request"], "page_no", "items", 1)
    assert rows(first) == [("r", 1, 1)]
    rest = merge.resume_pages(df, first, ["request"], "page_no", "items")
    assert rows(merge.resume_position(rest, ["request"], "page_no", "items", 1, "skipped")) == [("r", 1, 2)]


def test_page_boundary_resumes_at_the_next_page(spark):
    df = spark.createDataFrame(
        [("r", 1, ["a", "b"]), ("r", 4, ["c"]), ("s", 1, ["a", "b"])], "request string, page_no int, items array<string>"
    )
    assert rows(merge.resume_position(df, ["request"], "page_no", "items", 2)) == [("r", 4, 0)]


def test_running_sum_matches_a_plain_window(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("k"),
        "id",
        (F.col("id") % 11).alias("v"),
    )
    got = ordered.running_sum(df, ["k"], ["id"], F.col("v"), "s", F.floor(F.col("id") / 64))
    totals, want = {}, set()
    for r in sorted(df.collect(), key=lambda r: r.id):
        totals[r.k] = totals.get(r.k, 0) + r.v
        want.add((r.id, totals[r.k]))
    assert {(r.id, r.s) for r in got.collect()} == want


def test_last_write_wins(spark):
    df = spark.createDataFrame(
        [("k", 1, "put", "a"), ("k", 2, "delete", None), ("k", 3, "put", "b"), ("j", 4, "put", "c"), ("j", 5, "delete", None)],
        "pk string, seq bigint, op string, payload string",
    )
    assert rows(merge.upsert_last_write(df, ["pk"], "seq")) == [("k", 3, "b")]
    assert rows(merge.last_write(df, ["pk"], "seq"), "pk", "op") == [("j", "delete"), ("k", "put")]


def fold(base, extra):
    """Reference fold for the fixture: objects merge, all else replaces."""
    out = dict(base)
    for k, v in extra.items():
        out[k] = fold(out[k] if isinstance(out.get(k), dict) else {}, v) if isinstance(v, dict) else v
    return out


def leaves(value, path=""):
    if isinstance(value, dict) and (value or path == ""):
        return [leaf for k, v in value.items() for leaf in leaves(v, path + "/" + k.replace("~", "~0").replace("/", "~1"))]
    return [(path, json.dumps(value, sort_keys=True, separators=(",", ":")))]


def random_doc(rng, depth=0):
    doc = {}
    for name in rng.sample(["a", "b", "c/d", "e~f"], rng.randint(0 if depth else 1, 3)):
        roll = rng.random()
        if roll < 0.5 and depth < 3:
            doc[name] = random_doc(rng, depth + 1)
        else:
            doc[name] = rng.choice([None, 1, "x", True, [1, {"k": 2}], []])
    return doc


def test_fold_patches_against_plain_merging(spark):
    rng = random.Random(7)
    data, want = [], {}
    for key in range(40):
        state = {}
        for seq in range(rng.randint(1, 9)):
            doc = random_doc(rng)
            data.append((key, seq, json.dumps(doc)))
            state = fold(state, doc)
        want[key] = sorted(leaves(state))
    df = spark.createDataFrame(data, "key int, seq int, doc string")
    got = {}
    for r in merge.fold_patches(df, ["key"], "seq", "doc").collect():
        got.setdefault(r.key, []).append((r.path, r.value))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_append_mode(spark):
    docs = ['{"l":[1,2],"m":[0]}', '{"l":[3]}', '{"l":"no"}', '{"l":[4,"x"]}', '{"n":{"l":[9]}}']
    df = spark.createDataFrame([("k", i, d) for i, d in enumerate(docs)], "key string, seq int, doc string")
    got = sorted((r.path, r.seq, r.pos, r.value) for r in merge.append_list_patches(df, ["key"], "seq", "doc").collect())
    assert got == [("/l", 3, 0, "4"), ("/l", 3, 1, '"x"'), ("/m", 0, 0, "0")]


def test_append_mode_keeps_the_whole_record(spark):
    docs = ['{"l":[1],"s":5,"o":{"x":1},"e":[],"g":[1]}', '{"l":"z"}', '{"l":[2],"o":{"y":[3]}}', '{"g":"end"}', "[1]", "{bad"]
    df = spark.createDataFrame([("k", i, d) for i, d in enumerate(docs)], "key string, seq int, doc string")
    got = sorted((r.path, r.seq, r.pos, r.value) for r in merge.append_patches(df, ["key"], "seq", "doc").collect())
    assert got == [
        ("/e", None, None, "[]"), ("/g", None, None, '"end"'), ("/l", 2, 0, "2"), ("/o/x", None, None, "1"), ("/o/y", None, None, "[3]"), ("/s", None, None, "5"),
    ]
    assert sorted(r.seq for r in merge.broken_patches(df, "doc").collect()) == [4, 5]


@pytest.mark.parametrize("build", [
    lambda p: merge.limit_pages(p, ["request"], "page_no", "items", 3),
    lambda p: merge.merge_page_items(p, ["request"], "page_no", "items"),
])
def test_no_window_carries_the_payload(pages, build):
    plan = build(pages)._jdf.queryExecution().optimizedPlan().toString()
    depth = None
    for line in plan.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if "Window " in line:
            depth = at
        elif depth is not None and "Project [" in line:
            assert "items#" not in line.split("Project [")[1].replace("size(items#", "")


def test_null_requests_and_repeated_pages(spark):
    """Every item of every page is merged once, whatever the request, and a limit counts all of them."""
    pages = spark.createDataFrame(
        [(None, 0, [1, 2]), (None, 1, [3]), ("a", 0, [5]), ("a", 0, [6]), ("a", 1, [7, 8]), ("a", 1, [7, 8]), ("a", 2, None), ("b", 0, [])],
        "r string, p int, i array<int>",
    )
    got = {r.r: r.i for r in merge.merge_page_items(pages, ["r"], "p", "i").collect()}
    assert got[None] == [1, 2, 3] and sorted(got["a"][:2]) == [5, 6] and got["a"][2:] == [7, 8, 7, 8] and set(got) == {None, "a"}
    for most in range(1, 9):
        kept = merge.limit_pages(pages, ["r"], "p", "i", most)
        sizes = {r.r: r.n for r in kept.groupBy("r").agg(F.sum(F.coalesce(F.size("i"), F.lit(0))).alias("n")).collect()}
        assert sizes[None] == min(most, 3) and sizes["a"] == min(most, 6)
    assert rows(merge.resume_position(pages, ["r"], "p", "i", 2)) == [(None, 1, 0), ("a", 1, 0)]
    assert rows(merge.resume_position(pages, ["r"], "p", "i", 5)) == [("a", 1, 3)]
    rest = merge.resume_pages(pages, merge.resume_position(pages, ["r"], "p", "i", 2), ["r"], "p", "i")
    assert rows(rest, "r", "p", "i") == [(None, 1, [3]), ("a", 1, [7, 8]), ("a", 1, [7, 8]), ("a", 2, None)]
