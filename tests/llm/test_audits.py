"""Source divergence, quality votes and periodic runs against plain rewrites of their rules."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import ODD, by_id, table, texts
from viewloom.llm import latent_votes, periodic_runs, queries, term_tree
from viewloom.llm.arrays import SPACES, texts_of, words_of

WORD = re.compile("[^\x20\x09-\x0d]+")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


# --- source divergence ---


def plain_audit(rows, least_docs, top=10):
    """The rows (lang, source, part, item, value, rank) from (text, lang, source) rows."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = [w.translate(lower) for w in TERM.findall(text or "")]
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        sources = sorted(s for g, s in groups if g == lang)

        def share(counter, term, total, v=len(kept)):
            return 1 + 10**9 * (counter[term] + 2) // (total + 2 * v)

        whole = sum((counts[lang, s] for s in sources), Counter())
        p = {s: {t: share(counts[lang, s], t, sum(counts[lang, s][k] for k in kept)) for t in kept} for s in sources}
        q = {t: share(whole, t, sum(whole[k] for k in kept)) for t in kept}
        far = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(-sum(far(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-far(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def audited(spark, rows, **how):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    for name in ("term", "n", "p", "absent", "item", "path", "row", "total", "rank"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return sorted(tuple(r) for r in term_tree.audit(df, **how).collect())


@pytest.mark.parametrize("seed", range(3))
def test_audit_equals_all_terms(spark, seed):
    rnd = random.Random(seed)
    words = [*"abcdefgh", "É", "ß", "Zz", "x1y", "中文"]
    rows = []
    for _ in range(120):
        source = rnd.choice(["hot", "hot", "hot", "b", "c", "Ä", None, "quiet"])
        text = "" if source == "quiet" else " ".join(rnd.choices(words, [2**-i for i in range(len(words))], k=rnd.randint(0, 30)))
        rows.append((text, rnd.choice(["en", "en", "fr", None]), source))
    rows += [rows[0]] * 5 + [(None, "en", "none"), ("rare once", "zz", "only"), ("", "zz", "other")]
    for least in (3, 10):
        assert audited(spark, rows, least_docs=least) == plain_audit(rows, least)


def test_audit_of_odd_tables(spark):
    assert audited(spark, []) == []
    assert audited(spark, [(None, None, None)]) == []
    # No kept term: distances of 0, ranked by name.
    assert audited(spark, [("a", "en", "y"), ("b", "en", "x"), (None, "en", None)]) == [
        ("en", "", "pair", "x", 0, 1), ("en", "", "pair", "y", 0, 2),
        ("en", "x", "pair", "", 0, 1), ("en", "x", "pair", "y", 0, 2),
        ("en", "y", "pair", "", 0, 1), ("en", "y", "pair", "x", 0, 2),
    ]


def test_tree_shares_beginnings():
    """Equal beginnings are one node each, and a cut tree has the same sums."""
    paths = [[(0, 5), (1, 7)], [(0, 5), (1, 7), (2, 3)], [(0, 5), (2, 3)], [(1, 7)]]
    absent = np.array([2, 2, 2])

    def built(some, terms):
        flat = [x for p in some for x in p]
        return term_tree.build(
            np.array([len(p) for p in some]), np.array([s for s, _ in flat]), np.array([p for _, p in flat]), np.array(terms)
        )

    levels = built(paths, [1, 2, 3, 4])
    assert [len(level.source) for level in levels] == [2, 2, 1]
    assert sorted(levels[0].terms.tolist()) == [4, 6] and sorted(levels[1].terms.tolist()) == [3, 3]
    whole = dict(zip(zip(*(x.tolist() for x in term_tree.corrections(levels, absent)[:2])), term_tree.corrections(levels, absent)[2].tolist()))
    parts = Counter()
    for i, path in enumerate(paths):
        a, b, total = term_tree.corrections(built([path], [i + 1]), absent)
        parts.update(dict(zip(zip(a.tolist(), b.tolist()), total.tolist())))
    assert whole == dict(parts)


def test_counts_beyond_a_long(spark):
    """The share of a term is exact where the scaled count exceeds 64 bits."""
    df = spark.createDataFrame([(9 * 10**12, 10**13, 7)], "n long, total long, terms long")
    got = df.select(term_tree.share(*(df[c] for c in ("n", "total", "terms"))).alias("p")).first().p
    assert got == 1 + 10**9 * (9 * 10**12 + 2) // (10**13 + 14)


# --- quality ---


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = by_id(queries.op12_latent_votes(spark, folder))
    marks = duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    good = [found[d].predicted for d, q in marks if q == 1 and found[d].held_out]
    bad = [found[d].predicted for d, q in marks if q == 0 and found[d].held_out]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())


def test_votes_equal_a_plain_rewrite(spark):
    """The blocked votes against one document and neighbour at a time."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = latent_votes.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"), references=60)
    assert model.vectors.shape[0] == 60
    got = by_id(latent_votes.score_quality(docs, model=model))
    for doc, text in texts(folder)[::7]:
        if not text:
            assert got[doc].score == round(model.prior, 5)
            continue
        counts = np.concatenate(list(latent_votes.term_counts(texts_of(pa.array([text])))))[0]
        vector = np.sqrt(counts) * model.weights
        vector = vector / np.linalg.norm(vector) @ model.space
        near = sorted(((float(vector @ v) / np.linalg.norm(vector), y) for v, y in zip(model.vectors, model.labels)), reverse=True)
        least = round(near[latent_votes.NEIGHBOURS - 1][0], 5)
        chosen = [(c, y) for c, y in near if round(c, 5) >= least and c > 0]
        want = sum(c**latent_votes.POWER * y for c, y in chosen) / sum(c**latent_votes.POWER for c, _ in chosen)
        assert got[doc].score == pytest.approx(want, abs=2e-3)


def test_terms_of_repetition():
    counts = np.concatenate(list(latent_votes.term_counts(texts_of(pa.array(["a a b a\nx\nx", "", "a", None])))))
    assert (counts[0, latent_votes.GROUPS :] / latent_votes.REPEATED).tolist() == [2, 3, 1]
    assert not counts[1].any() and not counts[3].any()
    # Two spaces before and two after: as many groups as bytes and two more.
    assert counts[2, : latent_votes.GROUPS].sum() == 3


def test_quality_of_odd_rows(spark):
    docs = table(spark, ODD)
    labels = spark.createDataFrame([(i, q) for i in (1, 2, 3, 7, 8) for q in (1, 0)][:7] + [(None, 1), (4, None)], "doc_id long, quality int")
    rows = latent_votes.score_quality(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    alike = {r.score for r in rows if r.doc_id in (1, 5)}
    assert len(alike) == 1
    nothing = labels.limit(0)
    assert {r.score for r in latent_votes.score_quality(docs, nothing).collect()} == {0.5}
    assert latent_votes.score_quality(docs.limit(0), labels).collect() == []


# --- periodic runs ---


def plain_runs(w, least_length, least_repeats):
    """Runs by trying every period at every place."""
    out, seen = [], set()
    for q in range(1, len(w) // least_repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least_length, least_repeats * q) and (i, length) not in seen:
                seen.add((i, length))
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_all_periods():
    rnd = random.Random(13)
    for _ in range(400):
        docs = []
        for _ in range(rnd.randint(1, 5)):
            w = rnd.choices("abcde"[: rnd.randint(1, 5)], k=rnd.choice([0, 1, 5, 6, 7, 20, 60, 150]))
            if len(w) > 10 and rnd.random() < 0.5:
                a = rnd.randrange(len(w))
                p = 1 + rnd.randrange(max(1, (len(w) - a) // 3))
                w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
            docs.append(w)
        how = rnd.choice([(6, 4), (4, 2), (2, 2), (10, 3), (1, 2)])
        words = words_of(texts_of(pa.array([" ".join(w) for w in docs])), ~SPACES)
        got = periodic_runs.runs_of(words, *how) if len(words.codes) else []
        want = [(words.first[i] + s, n, q) for i, w in enumerate(docs) for s, n, q in plain_runs(w, *how)]
        assert [tuple(r) for r in got] == want, (docs, how)


def test_runs_of_the_supplied_texts(spark):
    folder = "/root/testdata/sf0.001"
    found = by_id(queries.op13_periodic_runs(spark, folder))
    some = 0
    for doc, text in texts(folder):
        w = WORD.findall(text)
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if len(w) > 4000:
            continue
        runs = plain_runs(w, 6, 4)
        some += len(runs)
        longest = min(((-n, s, q) for s, n, q in runs), default=None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        first = (None,) * 4 if not runs else (longest[1], -longest[0], longest[2], 1000 * -longest[0] // longest[2])
        want = (doc, len(runs), *first, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
        assert tuple(found[doc]) == want
    assert some


def test_runs_of_odd_rows(spark):
    rows = [*ODD, (20, "a " * 70_000, "en"), (21, "x y " * 40_000 + "z", "en"), (22, "a a a a a", "en"), (23, "b b b b b b", "en")]
    found = periodic_runs.periodic_runs(table(spark, rows)).collect()
    assert len(found) == len(rows)
    one = {r.doc_id: r for r in found}
    assert [tuple(r) for r in one[20].runs] == [(0, 70_000, 1)] and one[20].collapsed == "a"
    assert [tuple(r) for r in one[21].runs] == [(0, 80_000, 2)] and one[21].collapsed == "x y z"
    assert one[22].runs == [] and one[22].collapsed == "a a a a a"
    assert [tuple(r) for r in one[23].runs] == [(0, 6, 1)]
    assert one[2].n_words == 0 and one[2].collapsed == "" and one[2].runs == []
    assert periodic_runs.periodic_runs(table(spark, ODD).limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(table(spark, ODD), least_repeats=1)


def test_places_stay_in_order():
    rnd = random.Random(3)
    order = rnd.sample(range(100_000), 9_000)
    places = periodic_runs.Places(order[0])
    for p in order[1:]:
        places.add(p)
    want = sorted(order)
    assert list(places) == want and places.size == len(want)
    for i in range(0, len(want), 97):
        assert places.around(want[i]) == (want[i - 1] if i else None, want[i + 1] if i + 1 < len(want) else None)
