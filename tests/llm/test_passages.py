"""Benchmark passages and repeated passages against brute force."""

import hashlib
import re

from tests.llm.helpers import ODD, by_id, table
from viewloom.llm import phrase_index, super_windows


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_passages(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(str(item) if item is not None else "")
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        yield doc, len(w), len(hit), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


LINE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ITEMS = [(1, LINE), (2, "Short é item!"), (3, None), (4, ""), (5, "alpha alpha alpha alpha alpha alpha alpha alpha alpha alpha alpha"), (None, "lone"), (1, "another text of the same id")]
DOCS = [
    (1, f"before {LINE.upper()} after, {LINE}"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota other"),
    (3, "the short, É item and the short é item"),
    (4, "alpha " * 30),
    (5, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (6, "not lone-ly"),
    (6, "not lone-ly"),
    (None, LINE),
    (8, None),
    (9, "alpha beta x gamma delta epsilon zeta eta theta iota kappa lambda"),
]


def test_passages_against_brute_force(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS words")
    found = phrase_index.find_passages(table(spark, [(i, t, None) for i, t in DOCS] + ODD), items)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in found.collect()), key=str)
    assert got == sorted(brute_passages(DOCS + [(i, t) for i, t, _ in ODD], ITEMS), key=str)


def test_passages_in_blocks_and_proximity(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = table(spark, [(i, t, None) for i, t in DOCS])
    whole = sorted(map(str, phrase_index.find_passages(docs, items).drop("n_near").collect()))
    monkeypatch.setattr(phrase_index, "BLOCK_WORDS", 15)
    assert sorted(map(str, phrase_index.find_passages(docs, items).drop("n_near").collect())) == whole
    monkeypatch.undo()
    near = by_id(phrase_index.find_passages(docs.filter("doc_id = 9"), items, slack=3))[9]
    assert near.n_near >= 1


def test_passages_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = table(spark, ODD)
    assert phrase_index.find_passages(docs, none).filter("contaminated").count() == 0
    assert phrase_index.find_passages(docs, none).count() == len(ODD)
    assert phrase_index.find_passages(table(spark, []), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
    kept = phrase_index.without_passages(table(spark, [(i, t, None) for i, t in DOCS]), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 8, 9]


def brute_repeats(docs, size):
    seen, out = set(), {}
    for doc, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for s in range(len(w) - size + 1):
            window = tuple(w[s : s + size])
            if window in seen:
                gone |= set(range(s, s + size))
            seen.add(window)
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_repeats_against_brute_force(spark, monkeypatch):
    import random

    random.seed(4)
    shared = " ".join(random.choices("abcdefg", k=40))
    docs = [(i, " ".join(random.choices("abc", k=random.randint(0, 60))) + f" \n{shared[: random.randint(0, 80)]} x " + "z " * random.choice([0, 30])) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "one  two"), (103, docs[0][1])]
    random.shuffle(docs)
    want = brute_repeats(sorted(docs), 5)
    monkeypatch.setattr(super_windows, "PIECE", 1500)
    for width, parts in ((5, 3),):
        found = super_windows.remove_repeats(table(spark, [(i, t, None) for i, t in docs]).repartition(parts), width)
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in found.collect()} == want


def test_repeats_equal_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text), (None, text)]
    found = super_windows.remove_repeats(table(spark, [(i, t, None) for i, t in rows]).repartition(4))
    got = sorted((str(r.doc_id), r.n_removed) for r in found.collect())
    assert got == [("1", 30), ("1", 30), ("2", 30), ("None", 0)]  # null ids come first
    alone = super_windows.remove_repeats(table(spark, [(1, text, None), (1, text, None)]).repartition(2))
    assert [r.n_removed for r in alone.collect()] == [0, 0]  # equal rows are one document
    assert super_windows.remove_repeats(table(spark, [])).count() == 0
    assert super_windows.remove_repeats(table(spark, ODD)).count() == len(ODD)
