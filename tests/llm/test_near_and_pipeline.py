"""Near-duplicate classes against all pairs, and the pipeline stage by stage."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.helpers import ODD, table, texts
from viewloom.llm import order_minhash as om
from viewloom.llm import secret_layers
from viewloom.llm.arrays import texts_of


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[j], row[j] + (x == y)))
        row = new
    return row[-1]


def test_banded_alignment_is_exact():
    random.seed(1)
    for _ in range(1500):
        a = [random.randint(0, 9) for _ in range(random.randint(0, 40))]
        b = list(a)
        for _ in range(random.randint(0, 6)):
            if b and random.random() < 0.5:
                b.pop(random.randrange(len(b)))
            else:
                b.insert(random.randint(0, len(b)), random.randint(0, 9))
        common = lcs(a, b)
        want = common / (len(a) + len(b) - common) if a and b else 0.0
        assert om.similarity(a, b) == pytest.approx(want if want >= 0.8 - 1e-12 else 0.0)


def brute_classes(rows):
    """Class of each distinct text and all linked pairs, by aligning the words of all pairs."""
    first = {}
    for i, text in sorted(rows):
        first.setdefault(text, i)
    distinct = list(first)
    hashes, at = om.word_hashes(texts_of(pa.array(distinct)))
    words = [hashes[at[k] : at[k + 1]].tolist() for k in range(len(distinct))]
    sets = [set(w) for w in words]
    parent, links = list(range(len(distinct))), []

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(distinct)):
        for b in range(a):
            if 3 * len(words[a]) >= 2 * len(words[b]) and 3 * len(words[b]) >= 2 * len(words[a]) and 2 * len(sets[a] & sets[b]) >= len(sets[a]) > 0 and om.similarity(words[a], words[b]):
                links.append((distinct[a], distinct[b]))
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    names = {}
    for k, text in enumerate(distinct):
        names.setdefault(root(k), []).append(first[text])
    return {text: min(names[root(k)]) for k, text in enumerate(distinct)}, links


def edited(words, share):
    return [random.choice(["swap", "other", "new"]) + w if random.random() < share else w for w in words]


def test_classes_against_all_pairs(spark, small):
    random.seed(5)
    rows = texts(small)
    family = [f"q{random.randint(0, 400)}" for _ in range(150)]
    for n in range(120):  # a family of near copies at all distances, some cut short
        copy = edited(family, random.choice([0.0, 0.005, 0.01, 0.02, 0.04]))
        rows.append((10_000 + n, " ".join(copy[: random.choice([150, 150, 140, 130])])))
    line = " ".join(f"line{i}" for i in range(12))
    rows += [(20_000 + n, f"{line} " + " ".join(f"u{n}x{i}" for i in range(20))) for n in range(150)]
    want, links = brute_classes(rows)
    got = om.near_duplicates(table(spark, [(i, t, None) for i, t in rows])).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r["class"] for r in got}
    name = {}
    for i, text in rows:  # no class holds texts that links do not connect, and equal texts are one class
        assert name.setdefault(found[i], want[text]) == want[text]
        assert found[i] == found[min(j for j, t in rows if t == text)]
    by_text = {t: i for i, t in rows}
    caught = [found[by_text[a]] == found[by_text[b]] for a, b in links]
    assert len(caught) > 1000 and np.mean(caught) > 0.99


def test_one_word_in_a_dozen_is_near(spark):
    """Exchanged words, wherever they stand, up to one in nine; two texts that share half stay apart."""
    base = [f"n{i}" for i in range(120)]
    changed = lambda every: " ".join(f"x{every}y{i}" if i % every == 5 else w for i, w in enumerate(base))
    half = " ".join(base[:60] + [f"z{i}" for i in range(60)])
    rows = [(1, " ".join(base), None), (2, changed(40), None), (3, changed(20), None), (4, changed(12), None), (5, half, None), (6, changed(6), None)]
    found = {r.doc_id: r["class"] for r in om.near_duplicates(table(spark, rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6}


def test_columns_of_any_name(spark):
    """Columns named as the operators name their own stay what they are."""
    from viewloom.llm import phrase_index

    names = ["_key", "_node", "_id", "_mark", "node", "key", "mark"]
    docs = spark.createDataFrame([(1, "a b c d e f g", *"1234567"), (2, "h i j k l m n", *"1234567"), (1, "a b c d e f g", *"1234567")], ["doc_id", "text", *names])
    kept = om.keep_first(docs)
    assert kept.columns == docs.columns and sorted(tuple(r)[2:] for r in kept.collect()) == [tuple("1234567")] * 2
    items = spark.createDataFrame([("i", "H i, j k l")], "item_id string, text string")
    clean = phrase_index.without_passages(docs, items)
    assert clean.columns == docs.columns and [tuple(r)[2:] for r in clean.collect()] == [tuple("1234567")] * 2


def test_classes_odd_rows(spark):
    rows = om.near_duplicates(table(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    named = {(r.doc_id, r["class"]) for r in rows}
    assert {(1, 1), (5, 1), (2, 2), (3, 2), (4, 4), (8, 8)} <= named  # null counts as empty
    assert (None, None) in named and (None, 2) in named
    assert om.near_duplicates(table(spark, [])).count() == 0
    kept = om.keep_first(table(spark, ODD))
    assert kept.columns == table(spark, ODD).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "4", "6", "7", "8", "9", "None"])


def test_sketches_keep_order_and_occurrences():
    words = [f"w{i}" for i in range(40)]
    turned = words[20:] + words[:20]
    hashes, at = om.kmer_hashes(texts_of(pa.array([" ".join(words), " ".join(turned), " ".join(words)])))
    sketches = om.sketches(om.labelled(hashes, at), at)
    assert (sketches[0] == sketches[2]).all()
    assert (sketches[0] == sketches[1]).mean() < 0.6  # the same k-mers in another order
    again, at = om.kmer_hashes(texts_of(pa.array(["a a a a a a a a"])))
    assert len(np.unique(om.labelled(again, at))) == len(again)


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES][1:3] == ["MinHash near-dedup", "benchmark decontamination"]
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept.append({r.doc_id: r for r in docs.collect()})
        if number < 4:
            assert docs.columns == COLUMNS
    classes, _ = brute_classes([(i, r.text or "") for i, r in kept[0].items()])
    assert set(kept[1]) == set(classes.values())
    masked = {i for i, r in kept[3].items() if r.text != before[i]}
    assert masked == {i for i, r in kept[2].items() if secret_layers.scan(r.text)[1]}
    assert all(not secret_layers.base_spans(r.text) and r.n_chars == len(r.text) for r in kept[3].values())
    assert set(kept[4]) == set(kept[3])
    assert corpus_pipeline.run(spark, small).count() == docs.count()


def test_stages_odd_rows(spark, small):
    for rows in (ODD, []):
        docs = table(spark, rows)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            found = stage(spark, docs, small)
            assert number == 4 or found.columns == COLUMNS
            found.collect()
