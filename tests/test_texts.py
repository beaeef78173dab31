import random
import re
import unicodedata
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.functions import texts
from viewloom.operators import encoding, language
from viewloom.plans import registry
from viewloom.streaming import upsert

SAMPLES = [
    "",
    "Hello there, this is a normal text with nothing wrong in it at all.",
    "!!! ??? $$$ ### @@@ +++ ½½ ²²",
    "ÀÉÈ ééé àà ÉÉ èé",
    "été où déjà vu très bien français garçon à l'école",
    "\x01\x02\x03abc\x1a﻿​",
    "aBcÉdEf GhIéJk ÉaÉa5 ÉaÉaÉ",
    "naïve façade — ŷ ǎ ñ",
]


def accented(c):
    return any(f"WITH {a}" in unicodedata.name(c, "") for a in texts.ACCENTS)


def marks(text):
    shown = [c for c in text if c.isprintable()]
    score = 0
    for c, _ in groupby(shown):
        if c in texts.SAFE:
            continue
        kind = unicodedata.category(c)[0]
        if kind == "P":
            score += 1
        elif kind in "SN" and not c.isdigit():
            score += 2
    ratio = score / len(shown) if shown else 0
    return ratio if ratio >= 0.3 else 0.0


def accents(text):
    letters = [c for c in text if c.isalpha()]
    ratio = sum(map(accented, letters)) / len(letters) if letters else 0
    return ratio if len(letters) >= 8 and ratio >= 0.35 else 0.0


def unreadable(text):
    bad = sum(not c.isspace() and not c.isprintable() and c not in "\x1a﻿" for c in text)
    return 8 * bad / (len(text) + 1)


def double_accents(text):
    latin = [c for c in text if c.isalpha() and "LATIN" in unicodedata.name(c, "")]
    base = lambda c: unicodedata.normalize("NFD", c)[0]
    score = 0
    for a, b in zip(latin, latin[1:]):
        if accented(a) and accented(b):
            score += (a.isupper() and b.isupper()) + (base(a) == base(b))
    return 2 * score / len(latin) if latin else 0.0


def case_flips(text):
    total = 0
    for run in re.finditer(r"[^\W\d_]+", text):
        word, after = run.group(), text[run.end() : run.end() + 1]
        if word.isascii() or len(word) > 64 or after.isdigit():
            continue
        flips = "".join("x" if a.isupper() != b.isupper() else " " for a, b in zip(word, word[1:]))
        total += sum(len(chain) // 2 * 2 for chain in flips.split())
    return total / (len(text) + 1)


def test_count_parts_against_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i int, t string")
    got = {r.i: r for r in texts.noise_parts(df, "t").collect()}
    for i, text in enumerate(SAMPLES):
        for part in (marks, accents, unreadable, double_accents, case_flips):
            assert got[i][part.__name__] == pytest.approx(part(text)), (text, part.__name__)


def test_odd_words_and_blocks(spark):
    clean = "one two three four five six seven eight nine ten eleven"
    df = spark.createDataFrame(
        [(0, clean), (1, clean + " éàéà"), (2, clean + " a€ro"), (3, "garçÔn"), (4, "абв hello абвгдеabc кот"), (5, "漢字かな 日本 hello 中")],
        "i int, t string",
    )
    got = {r.i: r for r in texts.noise_parts(df, "t").collect()}
    letters = len(clean.replace(" ", ""))
    assert got[0].odd_words == 0
    assert got[1].odd_words == pytest.approx(4 / (letters + 4))
    assert got[2].odd_words == pytest.approx(4 / (letters + 4))
    assert got[4].mixed_blocks == pytest.approx(2 / 23)
    assert got[5].mixed_blocks == 0


def test_languages_are_told_apart(spark):
    docs = spark.createDataFrame(
        [("en", "the quick brown fox jumps over the lazy dog and then the other dog sleeps near the old tree"),
         ("fr", "le renard brun saute par-dessus le chien paresseux et après cela il dort près du vieux chêne à l'été"),
         ("ru", "съешь же ещё этих мягких французских булок да выпей чаю и ложись спать пораньше сегодня")],
        "lang string, text string",
    )
    table = language.learn_letters(docs, "text", "lang")
    best = language.best_language(language.language_scores(docs, "text", table, ["lang"]), ["lang"])
    assert {(r[0], r[1]) for r in best.collect()} == {("en", "en"), ("fr", "fr"), ("ru", "ru")}
    scores = spark.createDataFrame(
        [("d", "English", 0.5), ("d", "English", 0.7), ("d", "English—", 0.9), ("d", "French", 0.12345)], "k string, language string, score double"
    )
    assert rows(language.merge_scores(scores, ["k"])) == [("d", "English", 0.9), ("d", "French", 0.1235)]


def test_scripts_and_copies(spark):
    df = spark.createDataFrame([(1, "aé\n"), (2, "日本 Ж"), (3, ""), (4, "aé\n")], "i int, t string")
    got = {r.i: r.blocks for r in language.script_profile(df, ["i"], "t").collect()}
    assert got[1] == ["Basic Latin", "Control character", "Latin-1 Supplement"]
    assert got[2] == ["Basic Latin", "Cjk Unified Ideographs", "Cyrillic"] and got[3] == []
    copies = language.copy_groups(df, "i", "t")
    assert sorted((r.copies, r.first_key) for r in copies.collect()) == [(1, 2), (1, 3), (2, 1)]


def test_encodings(spark, tmp_path):
    french = "Le garçon était très étonné par l'été où il déjeunait à l'école près de la forêt. " * 3
    russian = "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 3
    files = {
        "ascii.txt": b"plain text here", "utf8.txt": french.encode(), "bom.txt": b"\xef\xbb\xbf" + french.encode(),
        "latin.txt": french.encode("cp1252"), "utf16.txt": french.encode("utf-16"), "ru.txt": russian.encode("cp1251"),
        "declared.xml": b"<?xml encoding='ISO-8859-1'?>" + french.encode("latin-1"),
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    corpus = encoding.read_corpus(spark, str(tmp_path)).withColumn("name", F.substring_index("path", "/", -1))
    # The file source passes over files without bytes.
    empty = spark.createDataFrame([("empty.txt", bytearray(), "empty.txt")], "path string, content binary, name string")
    corpus = corpus.unionByName(empty)
    table = language.learn_letters(spark.createDataFrame([("fr", french), ("ru", russian)], "lang string, text string"), "text", "lang")
    audit = encoding.encoding_audit(corpus, ["name"], languages=table)
    got = {r.name: r for r in audit.collect()}
    assert {n: r.encoding for n, r in got.items() if n not in ("latin.txt", "declared.xml")} == {
        "ascii.txt": "ascii", "utf8.txt": "utf_8", "bom.txt": "utf_8", "utf16.txt": "utf_16", "ru.txt": "cp1251", "empty.txt": "utf_8",
    }
    assert got["declared.xml"].declared == "iso_8859_1" and got["bom.txt"].bom == "utf_8"
    assert not any(r.binary for r in got.values())
    back = {r.name: r.text for r in encoding.to_utf8(corpus, audit, ["name"]).collect()}
    assert back["ru.txt"] == russian and back["latin.txt"] == french and back["bom.txt"] == french


def test_any_bytes_can_be_audited(spark):
    rng = random.Random(3)
    data = [(i, bytearray(b"\xff\xfe" + rng.randbytes(rng.randint(0, 50)))) for i in range(30)]
    data += [(100 + i, bytearray(rng.randbytes(200))) for i in range(30)]
    data += [
        (200, bytearray(b"# coding: unicode_escape\n\xff\\u0041")),
        (201, bytearray(b'<?xml version="1.0" encoding="koi8-r"?>' + "привет как дела".encode("koi8-r"))),
        (202, bytearray(b'<meta charset=gbk>' + "你好世界".encode("gbk"))),
        (203, None),
    ]
    audit = {r.i: r for r in encoding.encoding_audit(spark.createDataFrame(data, "i int, content binary"), ["i"]).collect()}
    assert len(audit) == len(data)
    assert audit[200].declared == "unicode_escape" and audit[200].encoding != "unicode_escape"
    assert audit[201].encoding == "koi8_r" and audit[202].declared == "gbk"


@pytest.mark.parametrize(
    "head,name",
    [
        (b"<?xml version='1.0' encoding='ISO-8859-1'?>", "iso_8859_1"),
        (b'<html><META http-equiv=x content="text/html; charset=koi8-r">', "koi8_r"),
        (b"<meta charset = 'cp1251' >", "cp1251"),
        (b'@charset "utf-8";', "utf_8"),
        (b"Content-Type: text/plain; charset=Shift_JIS\n", "shift_jis"),
        (b"#!/bin/sh\n# -*- coding: latin-1 -*-", "latin_1"),
        (b"// vim: set fileencoding=cp1250 :", "cp1250"),
        (b"the encoding of life", None),
        (b"x\ny\n# coding: late", None),
    ],
)
def test_charset_declarations(spark, head, name):
    df = spark.createDataFrame([(bytearray(head),)], "content binary")
    assert df.select(encoding.declared_charset(F.col("content"))).first()[0] == name


def test_alphabets_of_any_size(spark):
    import string

    letters = string.ascii_lowercase + "абвгдежзийклмнопрстуфхцчшщъыьэюя"
    df = spark.createDataFrame([("x", letters * 3), ("y", "abc" * 50)], "lang string, text string")
    table = {r.language: r.letters for r in language.learn_letters(df, "text", "lang").collect()}
    assert len(table["x"]) == len(set(letters)) and table["y"] == ["a", "b", "c"]
    many = spark.range(600).selectExpr("concat('l', id) AS language", "array('a', 'b', 'c') AS letters")
    scores = language.language_scores(df.filter("lang = 'y'"), "text", many, ["lang"])
    assert scores.count() == 600


def test_stream_upserts(spark, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    schema = "pk string, seq bigint, op string, payload string"
    for batch in ([("a", 1, "put", "x"), ("a", 2, "put", "y"), ("b", 3, "put", "z")], [("b", 4, "delete", None), ("c", 5, "put", "w")]):
        spark.createDataFrame(batch, schema).write.mode("append").json(source)
        stream = spark.readStream.schema(schema).json(source)
        upsert.collect_changes(stream, ["pk"], "seq", log, checkpoint).awaitTermination()
    assert rows(upsert.current_state(spark, ["pk"], "seq", log), "pk", "payload") == [("a", "y"), ("c", "w")]
    short = str(tmp_path / "short")
    upsert.compact(spark, ["pk"], "seq", short, log)
    assert spark.read.parquet(short).count() == 3  # the deletion stays
    assert rows(upsert.current_state(spark, ["pk"], "seq", short), "pk", "payload") == [("a", "y"), ("c", "w")]


def test_registry_is_consistent():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize(
    "name", ["fact_media_engagement", "dim_media", "recur_lookup", "ip_cidr_join", "merge_pages_items", "script_profile", "text_noise"]
)
def test_plans_have_no_cross_join_and_no_python(spark, small, name):
    plan = registry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan


def test_order_agreement_of_a_large_alphabet(spark):
    """How many letters stand before by both orders, for alphabets of any size, and not in squared time."""
    import random
    import time

    rnd = random.Random(36)
    groups = {name: rnd.sample(range(2 * n), n) for name, n in (("one", 1), ("two", 2), ("five", 5), ("odd", 33), ("large", 3000))}
    pairs = [(name, 3 * r, t) for name, places in groups.items() for r, t in enumerate(places)]
    df = spark.createDataFrame(pairs, "g string, rank int, _there int")
    start = time.time()
    got = {(r.g, r.rank): (r.i, r.j, r.m, r.before) for r in language._before(df, ["g"]).collect()}
    took = time.time() - start
    for name, places in groups.items():
        for i, t in enumerate(places if name != "large" else places[::50]):
            i = i if name != "large" else 50 * i
            assert got[name, 3 * i] == (i, sum(x < t for x in places), len(places), sum(x < t for x in places[:i]))
    rows_made = language._before(df, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in rows_made and took < 60


def test_texts_are_shuffled_as_their_letters_once(spark):
    """One exchange, of a row per text, however many languages; rows of one key count together."""
    text = "the quick brown fox jumps over the lazy dog and sleeps near the old tree"
    df = spark.createDataFrame([(1, text[:30]), (1, text[30:]), (2, text), (None, text), (3, None), (4, "short")], "i int, t string")
    table = spark.createDataFrame([("en", list("etoahnrdsluqickbwfxjmpvzyg")), (None, list("gyzvpmjxfwbkciqulsdrnhaote"))], "language string, letters array<string>")
    scores = language.language_scores(df, "t", table, ["i"])
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan and "Window" not in plan
    got = {(r.i, r.language): r.score for r in scores.collect()}
    # The halves have too few letters by themselves.
    assert got[2, "en"] == got[None, "en"] > 0.5 and got[1, "en"] > 0.5 and {i for i, _ in got} == {1, 2, None}


def test_order_agreement_in_batches(spark):
    rnd = random.Random(3)
    groups = [rnd.sample(range(n), n) for n in (1, 2, 5, 33, 200)]
    ids = np.repeat(np.arange(5), [len(g) for g in groups])
    got = language._earlier(ids, np.concatenate([np.array(g) for g in groups])).tolist()
    assert got == [sum(x < t for x in g[:i]) for g in groups for i, t in enumerate(g)]


def test_a_suspect_word_is_judged_once(spark):
    """Lambdas share no parts, so each part of the judgement stands once in the expression."""
    df = spark.createDataFrame([("éàéà plain word",), ("straße garçon",), ("a$b x",), ("wordÀ Ünder",)], "t string")
    plan = texts._odd_words(df, "t", "o")
    upper = plan._jdf.queryExecution().analyzed().toString().count(r"\p{Lu}")
    assert upper == 3
    # Short texts count only with a foreign word in them, here one that ends in an accented capital.
    assert [r.o for r in plan.select("o").collect()] == [0.0, 0.0, 0.0, 0.5]


def test_letters_are_counted_before_they_are_rows(spark):
    """Labelled text becomes a few rows per batch, not one per letter."""
    data = [("en", "Aab b1"), ("en", "b"), (None, "é"), ("de", "12"), ("fr", None)]
    learned = language.learn_letters(spark.createDataFrame(data, "l string, t string"), "t", "l")
    assert "Generate" not in learned._jdf.queryExecution().executedPlan().toString()
    assert {r.language: r.letters for r in learned.collect()} == {"en": ["b", "a"], None: ["é"]}


def test_noise_has_every_step_of_the_method(spark):
    """Rare ideographs without a list given, blocks pair by pair, kinds of character by their names."""
    clean = "one two three four five six seven eight nine ten eleven "
    cases = [
        ("rare_ideographs", "龘靐齉爨麤鱻灪龖厵", 0.1),
        ("rare_ideographs", "日本国年大十二三中", 0.0),
        ("rare_ideographs", "⼀⼁⼂⼃⼄⼅⼆⼇⼈", 0.0),  # radicals of the Kangxi block are no ideographs
        ("mixed_blocks", "abc🌀def ghij klm", 4 / 16),  # a pictograph is not at home in a word
        ("mixed_blocks", "abc😀def ghij klm", 0.0),  # an emoticon is
        ("mixed_blocks", "ქართულიবাংলা ab", 2 / 15),  # two scripts without a family
        ("mixed_blocks", "日本é 日本a 日本語 日本語", 2 / 15),  # only basic Latin stands by ideographs
        ("mixed_blocks", "ａｂあ ａｂ日 ａｂ ａｂａｂａ", 2 / 16),  # full-width forms do by ideographs, not by kana
        ("isolated_forms", "٠١٢٣٤٥٦٧ﺀﺁ", 0.2),  # Arabic digits are Arabic
        ("accents", "abcdefgh⨣⨣⨣⨣⨣⨣⨣⨣", 0.0),  # operators with an accent are no letters
        ("odd_words", clean + "ab﻿cd", 5 / (len(clean.replace(" ", "")) + 5)),  # of the forms, so a symbol
        ("case_flips", "aBcDe—", 0.0),  # the dash is not of the word
        ("marks", "🪐🪐a🪐a🪐", 0.0),
        ("odd_words", "é" * 40000 + " " + "É$" * 40000, 1.0),
    ]
    df = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r for r in texts.noise_parts(df, "t").collect()}
    assert [(p, t[:30], got[i][p]) for i, (p, t, _) in enumerate(cases)] == [(p, t[:30], pytest.approx(w)) for p, t, w in cases]


def test_blocks_that_may_touch(spark):
    """The one pattern against every pair of characters, one per block."""
    touch = {("Basic Latin", "Latin Extended-B"), ("Basic Latin", "Hangul Syllables"), ("Hiragana", "Katakana"),
             ("Cyrillic", "Cyrillic Supplement"), ("Greek and Coptic", "Halfwidth and Fullwidth Forms")}
    apart = {("Basic Latin", "Cyrillic"), ("Latin-1 Supplement", "CJK Unified Ideographs"), ("Hiragana", "Basic Latin"), ("Thai", "Lao")}
    assert all(texts.may_touch(a, b) and texts.may_touch(b, a) for a, b in touch)
    assert not any(texts.may_touch(a, b) or texts.may_touch(b, a) for a, b in apart)
    quiet = {*texts._points()["quiet"]}
    shown = [next((chr(p) for p in range(a, b) if chr(p).isprintable() and p not in quiet), None) for a, b, _ in texts.BLOCKS]
    named = [(c, name) for c, (_, _, name) in zip(shown, texts.BLOCKS) if c]
    pairs = [(a + b, texts.may_touch(x, y)) for a, x in named for b, y in named]
    df = spark.createDataFrame(pairs, "t string, ok boolean")
    assert df.filter(F.col("t").rlike(texts.touching_pattern()) == F.col("ok")).count() == 0


def test_files_are_decoded_once(spark):
    """Readings are scored and their letters counted where they are decoded; the rest needs narrow rows only."""
    french = "Le garçon était très étonné par l'été où il déjeunait à l'école près de la forêt. " * 3
    data = [(1, french.encode("cp1252")), (1, french.encode("cp1252")), (2, french.encode()), (None, french.encode()), (3, b""), (4, None), (5, "été".encode("utf-16"))]
    files = spark.createDataFrame([(i, c if c is None else bytearray(c)) for i, c in data], "i int, content binary")
    table = language.learn_letters(spark.createDataFrame([("fr", french)], "lang string, text string"), "text", "lang")
    audit = encoding.encoding_audit(files, ["i"], languages=table)
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "decode" not in plan and "content" not in plan
    # Rows of one key are one file's readings twice; a file without a reading, or without a key, keeps its row.
    got = sorted(((r.i or 0), r.encoding, r.language, r.binary) for r in audit.collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3, 4, 5]
    assert got[0] == (0, None, None, True) and got[1] == got[2] == (1, "cp1252", "fr", False) and got[3] == (2, "utf_8", "fr", False)
    assert got[4] == (3, "utf_8", None, False) and got[5][1:3] == (None, None) and got[6][1] == "utf_16"


def test_letters_counted_in_arrays(spark):
    """Against plain counting, also beyond the code points that are counted in an array; scores are the same."""
    samples = ["", "abcab", "éaé", "日本日a", "zyx" * 20, "the quick brown fox jumps over the lazy dog and sleeps near the old tree", "𐐨x𐐨"]
    for text, letter, n, place in zip(samples, *[a.to_pylist() for a in language._counted(pa.array(samples))]):
        assert {chr(c): (k, p) for c, k, p in zip(letter, n, place)} == {c: (text.count(c), text.index(c)) for c in text}
    df = spark.createDataFrame(list(enumerate(samples)), "i int, t string")
    table = spark.createDataFrame([("en", list("etoahnrdsluqickbwfxjmpvzyg"))], "language string, letters array<string>")
    counted = df.withColumn("c", language.letter_counts(F.col("t")))
    plain = rows(language.language_scores(df, "t", table, ["i"]))
    assert len(plain) == 1 and plain == rows(language.language_scores(counted, "c", table, ["i"]))
