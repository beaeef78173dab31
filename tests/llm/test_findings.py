"""Secrets, personal data, fingerprints and languages against plain rewrites of their rules."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, by_id, table, texts
from viewloom.llm import bin_sketch, disclosure, hyper_lang, queries, secret_layers

SECRET = "token=abcdefgh12345678"


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def brute_secrets(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_secret_query(spark, small):
    found = by_id(queries.op2_secret_layers(spark, small))
    for i, text in texts(small):
        want = brute_secrets(text)
        assert found[i].base_sha256 == digest(want)
        assert [found[i][f"n_{k}"] for k in secret_layers.KINDS] == [sum(s[0] == k for s in want) for k in secret_layers.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(found[i].spans.split(","))


def b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize(
    "hidden",
    [
        b64(SECRET.encode()),
        b64(b64(b64(SECRET.encode()).encode()).encode()),
        urllib.parse.quote(SECRET, safe=""),
        "".join(f"%{c:02x}" for c in SECRET.encode()),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        b64(gzip.compress(SECRET.encode())),
        urllib.parse.quote(b64(zlib.compress(b64(SECRET.encode()).encode())), safe=""),
    ],
)
def test_hidden_secrets_are_found_in_place(hidden):
    before = "é 中 plain "
    base, spans, layers = secret_layers.scan(f"{before}{hidden} after")
    assert not base and layers
    kind, start, stop = next(s for s in spans if s[0] == "assign")
    assert len(before) <= start < stop <= len(before) + len(hidden)
    assert stop - start >= 0.85 * len(hidden)  # all but the padding of each layer


def test_layers_end(spark):
    assert secret_layers.scan("%2525252541 " * 5)[2] > 1  # nested escapes end
    # A failing match takes its text with it.
    assert secret_layers.scan("token = secret: password1234")[0] == brute_secrets("token = secret: password1234")
    rows = secret_layers.find_secrets(table(spark, ODD)).collect()
    assert len(rows) == len(ODD) and secret_layers.find_secrets(table(spark, [])).count() == 0
    shown = secret_layers.find_secrets(table(spark, [(1, f"é {SECRET} x {b64(SECRET.encode())} y", None), (2, None, None)]))
    masked = sorted(str(r[0]) for r in shown.select(secret_layers.masked(F.col("text"), F.col("spans"))).collect())
    assert masked == ["None", "é [secret] x [secret]== y"]



@pytest.mark.parametrize("hide", [lambda t: b64(t.encode()), lambda t: "".join(f"%{c:02x}" for c in t.encode()), lambda t: b64(gzip.compress(t.encode(), mtime=0))])
def test_each_copy_of_a_hidden_secret_is_found(hide):
    hidden = hide(SECRET)
    nested = b64(f"{hidden} and {hidden}".encode())
    text = f"{hidden} x\n{hidden} y\n{b64(SECRET.encode())} {nested}"
    spans = secret_layers.scan(text)[1]
    at = [0, len(hidden) + 3, 2 * len(hidden) + 6]
    for place in at:
        assert any(place <= a < b <= place + len(hidden) + 40 for _, a, b in spans)
    inside = [(a, b) for _, a, b in spans if a >= len(text) - len(nested)]
    assert len(set(inside)) == 2


NOISE = " ".join(hashlib.md5(bytes([i])).hexdigest()[:20] for i in range(40))


@pytest.mark.parametrize(
    "text, inside",
    [
        ('"password": "\\u0068unter2hunter2"', "unter2hunter2"),
        ("token = abc%2Bdef12345", "abc%2Bdef12345"),
        ("secret: token%3Aabcdefgh12345", "token%3Aabcdefgh12345"),
        ('token: "password%3A%20hunter2hunter2"', "password%3A%20hunter2hunter2"),
        ("key:\n" + base64.encodebytes(f"{NOISE[:50]} {SECRET} {NOISE[:90]}".encode()).decode(), None),
        ("key:\n" + base64.encodebytes(gzip.compress(f"{NOISE} {SECRET}".encode())).decode() + "\nword", None),
        *[("/x" + "y" * k + "/" + b64(SECRET.encode()), None) for k in range(4)],
        *[("/x" + "y" * k + "/" + b64(gzip.compress(SECRET.encode())), None) for k in range(4)],
    ],
)
def test_secrets_parted_from_their_escapes_are_found(text, inside):
    spans = [s for s in secret_layers.scan(text)[1] if s[0] == "assign"]
    assert spans and all(0 <= a < b <= len(text) for _, a, b in spans)
    assert any(text[a:b].endswith(inside or "") for _, a, b in spans)
    assert "word" not in "".join(text[a:b] for _, a, b in spans if not inside)


def whole_unicode(raw):
    return "".join(f"\\x{b:02x}" for b in raw)


def zstd(raw):
    import zstandard

    return zstandard.ZstdCompressor().compress(raw)


PACKERS = {
    "gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "zstd": zstd,
    "utf-16-le": lambda raw: raw.decode("latin-1").encode("utf-16-le"), "utf-16-be": lambda raw: raw.decode("latin-1").encode("utf-16-be"),
}
WRITERS = {
    "base64": lambda raw: base64.b64encode(raw), "percent": lambda raw: b"".join(b"%%%02X" % b for b in raw),
    "backslash": lambda raw: whole_unicode(raw).encode(), "lines": lambda raw: base64.encodebytes(raw).strip(),
}


@pytest.mark.parametrize(
    "hidden",
    [
        b64(gzip.compress(gzip.compress(SECRET.encode()))),
        b64(bz2.compress(gzip.compress(SECRET.encode()))),
        b64(gzip.compress(bz2.compress(SECRET.encode()))),
        "".join(f"%{b:02x}" for b in gzip.compress(SECRET.encode())),
        whole_unicode(gzip.compress(SECRET.encode())),
        b64(SECRET.encode("utf-16")),
        b64(SECRET.encode("utf-16-be")),
        b64(gzip.compress(SECRET[:12].encode()) + gzip.compress(SECRET[12:].encode())),
        b64(zstd(b"x") + zstd(SECRET.encode())),
        b64(b"\x00\xff" + gzip.compress(b"nothing") + b"\x01" + lzma.compress(SECRET.encode()) + b"\xfe"),
        "".join(f"\\u{b:04x}" for b in SECRET.encode("utf-16-le")),
    ],
    ids=str,
)
def test_layers_of_bytes(hidden):
    """Compressed in compressed, escaped compressed, UTF-16, and all members of a compressed part."""
    before = "é 中 plain "
    base, spans, _ = secret_layers.scan(f"{before}{hidden} after")
    assert not base
    assert any(k == "assign" and len(before) <= a < b <= len(before) + len(hidden) for k, a, b in spans)


def plainly_unwrapped(raw, depth=0):
    """Whether a secret is somewhere in the bytes, by trying every decoder on the whole of them."""
    if re.search(rb"token=[a-z]{8}\d{8}", raw):
        return True
    if depth > 7:
        return False
    tries = [gzip.decompress, zlib.decompress, bz2.decompress, lzma.decompress, lambda r: base64.b64decode(r, validate=False) if re.fullmatch(rb"[A-Za-z0-9+/=\s]+", r) else b""]
    tries += [lambda r: urllib.parse.unquote_to_bytes(r) if b"%" in r else b"", lambda r: re.sub(rb"\\x([0-9a-f]{2})", lambda m: bytes([int(m[1], 16)]), r)]
    tries += [lambda r, c=c: r.decode(c).encode("latin-1") for c in ("utf-16-le", "utf-16-be")]
    for attempt in tries:
        try:
            inner = attempt(raw)
        except Exception:
            continue
        if inner and inner != raw and plainly_unwrapped(inner, depth + 1):
            return True
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        return plainly_unwrapped(zstandard.ZstdDecompressor().decompressobj().decompress(raw), depth + 1)
    return False


def test_random_nestings_reach_the_fixpoint():
    """Any order of all kinds: what plain decoding of the whole reveals, the worklist reports in place."""
    rnd = random.Random(64)
    for _ in range(250):
        raw, kinds = SECRET.encode(), []
        for _ in range(rnd.randrange(1, 5)):
            kinds.append(rnd.choice([*PACKERS, *WRITERS]))
            raw = {**PACKERS, **WRITERS}[kinds[-1]](raw)
        kinds.append(rnd.choice([*WRITERS]))
        raw = WRITERS[kinds[-1]](raw)
        assert plainly_unwrapped(raw), kinds
        hidden = raw.decode()
        _, spans, _ = secret_layers.scan(f"é see: {hidden} end")
        assert any(7 <= a < b <= 7 + len(hidden) for _, a, b in spans), kinds


def test_large_parts_are_scanned_whole(monkeypatch):
    """Secrets on every side of the pieces' borders, and on one; and 65 MiB at the real size."""
    monkeypatch.setattr(secret_layers, "PIECE", 1000)
    monkeypatch.setattr(secret_layers, "OVERLAP", 100)
    for at in (0, 970, 990, 995, 2500, 4980):
        filler = bytearray(b"." * 5000)
        filler[at : at + len(SECRET)] = SECRET.encode()
        for pack in (gzip.compress, bz2.compress, lzma.compress, zstd):
            assert secret_layers.scan(b64(pack(bytes(filler))))[1], (at, pack)
    monkeypatch.undo()
    far = b64(gzip.compress(SECRET.encode() + b"." * (65 << 20) + b" password=hunter2hunter2"))
    spans = secret_layers.scan(f"x {far} y")[1]
    assert len(spans) == 1 and spans[0][0] == "assign" and spans[0][1] == 2


def test_broken_and_cyclic_parts_end():
    whole = gzip.compress(f"{NOISE * 50} {SECRET} {NOISE * 50}".encode())
    assert secret_layers.scan(b64(whole[:-40]))[1]  # what comes before the break counts
    assert secret_layers.scan(b64(whole[:20] + b"junk" + gzip.compress(SECRET.encode())))[1]  # as does what comes after
    assert not secret_layers.scan(b64(b"x^" * 5000))[1] and not secret_layers.scan("x^ BZh9 x\x01 " * 2000)[1]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def brute_personal(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(found)]


PERSONAL = [
    (1, "mail a.b+c@d-e.f.gh, 1.2.3.4.5 999.1.1.1 0255.0.0.1 é 4111 1111 1111 1111x 4111-1111--1111 +1 (234) 567-8901!", None),
    (2, "a@b a@b.c_d@e.f @x.y ++12 34567890 1.2.3 12345678901234567890 99999999999999999999.1.1.1", None),
    (3, "4111111111111111 4111111111111112 " * 3 + "1 " * 3000, None),
]


def test_personal_data_query(spark, small):
    found = by_id(queries.op3_disclosure(spark, small))
    for i, text in texts(small):
        want = brute_personal(text)
        assert found[i].base_sha256 == digest(want)
        assert [found[i][f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in want) for k in PATTERNS]


def test_personal_data_odd_rows(spark):
    found = disclosure.find_personal(table(spark, PERSONAL + ODD)).select("text", disclosure.joined_spans("base").alias("base")).collect()
    assert len(found) == len(PERSONAL) + len(ODD)
    got = {r.text: r.base for r in found}
    for _, text, _ in PERSONAL[1:]:
        assert got[text] == ",".join(f"{k}:{a}:{b}" for k, a, b in brute_personal(text))
    assert disclosure.find_personal(table(spark, [])).count() == 0


def test_words_that_disclose(spark):
    rows = [(i, f"the agent Quuxley wrote to spy@mole.org about lunch {i}", None) for i in range(4)]
    rows += [(100 + i, f"the cook wrote about lunch and dinner {i}", None) for i in range(200)]
    found = disclosure.find_personal(table(spark, rows))
    spans = {r.doc_id: {(s.kind, s.value) for s in r.spans} for r in found.collect()}
    assert spans[0] >= {("remove", "quuxley"), ("remove", "agent")}  # occur with the address only
    assert not {"lunch", "the", "about"} & {v for _, v in spans[0]}  # occur everywhere
    assert not any(spans[100 + i] for i in range(200))
    text = by_id(found.select("doc_id", disclosure.sanitised(F.col("text"), F.col("spans")).alias("t")))
    assert "Quuxley" not in text[0].t and "[email]" in text[0].t and text[100].t == rows[4][1]
    # Neither the address nor its domain reaches the support.
    few = disclosure.find_personal(table(spark, rows[:2] + rows[4:]))
    assert not any(s.kind in disclosure.ADDED for r in few.collect() for s in r.spans)


def test_rare_entities_are_pooled(spark):
    """Entities in one or two documents each are protected by what they share."""
    rows = [(i, f"the agent Quuxley wrote to spy{i}@mole.org about lunch {i}", None) for i in range(4)]
    rows += [(10 + i, f"the guard Zorblatt saw 10.7.9.{i} about lunch", None) for i in range(3)]
    rows += [(20, "only Vexamin wrote to one@rare.org", None)]
    rows += [(100 + i, f"the cook wrote about lunch and dinner {i}", None) for i in range(200)]
    spans = {r.doc_id: {(s.kind, s.value) for s in r.spans} for r in disclosure.find_personal(table(spark, rows)).collect()}
    assert all(("remove", "quuxley") in spans[i] for i in range(4)) and all(("remove", "zorblatt") in spans[10 + i] for i in range(3))
    assert not {"lunch", "the"} & {v for _, v in spans[0]} and {k for k, _ in spans[20]} == {"email"}
    pools = spark.createDataFrame([("email:a.b@x.co.uk",), ("ip:1.2.3.4",), ("card:4111111111111111",), ("phone:442071838750",)], "e string").select(disclosure.pool_of(F.col("e")))
    assert [r[0] for r in pools.collect()] == ["email:@x.co.uk", "ip:1.2.3.*", "card:411111*", "phone:44*"]


def test_words_far_from_an_entity_disclose_too(spark):
    filler = "the cook wrote about lunch and dinner " * 400
    ends = ["Quuxley spy@mole.org", "spy@mole.org", "spy@mole.org"]  # near it in one document only
    rows = [(i, f"Quuxley went. {filler}{e} \xe9\xe8\xe0spy@mole.org {filler}said Quuxley {i}", None) for i, e in enumerate(ends)]
    rows += [(100 + i, filler, None) for i in range(100)]
    found = by_id(disclosure.find_personal(table(spark, rows)))
    for i, text, _ in rows[:3]:
        want = [m.span() for m in re.finditer("Quuxley", text)]
        assert sorted((s.start, s.stop) for s in found[i].spans if s.kind == "remove" and s.value == "quuxley") == want
        assert not {"lunch", "\xe9\xe8\xe0", "cook"} & {s.value for s in found[i].spans}

def jaccard(a, b):
    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_fingerprint_query(spark, small):
    rows, off = texts(small), []
    found = by_id(queries.op4_bin_sketch(spark, small))
    same = {}
    for k, (i, text) in enumerate(rows):
        following, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off += [abs(found[i].near_edited - jaccard(text, edited)), abs(found[i].near_next - jaccard(text, following))]
        assert same.setdefault(text, found[i].fingerprint) == found[i].fingerprint
    assert sum(off) / len(off) < 0.03 and max(off) < 0.2


def test_fingerprint_odd_rows(spark):
    found = bin_sketch.fingerprints(table(spark, ODD))
    rows = found.select("doc_id", "text", "edited", bin_sketch.likeness(F.col("bits"), F.col("next_bits")).alias("near")).collect()
    assert len(rows) == len(ODD)
    order = sorted(((i is not None, i or 0, t or "") for i, t, _ in ODD))
    half = len(order[0][2]) // 2
    assert any(r.text == order[0][2] and r.edited == order[0][2][: len(order[0][2]) - half] + order[1][2][:half] for r in rows)
    assert bin_sketch.fingerprints(table(spark, [])).count() == 0
    alone = bin_sketch.fingerprints(table(spark, [(3, "one two three", None)])).select("edited", bin_sketch.likeness(F.col("bits"), F.col("next_bits")).alias("near")).first()
    assert alone.near == 1.0 and alone.edited == "one two" + "one tw"
    assert bin_sketch.fingerprints(table(spark, [(1, None, None), (2, "", None)])).select(bin_sketch.likeness(F.col("bits"), F.col("next_bits"))).first()[0] == 1.0


def test_language_query_held_out(spark, small):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op6_hyper_lang(spark, small).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.9


def test_language_odd_rows(spark):
    train = [(100 + i, t, x) for i in range(8) for t, x in (("the cat and the dog of the house", "en"), ("der hund und die katze im haus", "de"))]
    found = hyper_lang.identify(table(spark, ODD + train)).collect()
    assert len(found) == len(ODD) + len(train)
    by_text = {r.text: r for r in found}
    assert by_text[None].lang_pred == by_text[""].lang_pred == by_text["   \n\t "].lang_pred == "und"
    assert by_text[None].score == 0 and by_text["é"].lang_pred in ("de", "en", "fr")
    assert by_text["der hund und die katze im haus"].lang_pred == "de"
    assert {r.lang_pred for r in hyper_lang.identify(table(spark, [(1, "no label", None)])).collect()} == {"und"}
    assert hyper_lang.identify(table(spark, [])).count() == 0


def test_vectors_are_equal_everywhere():
    one, other = hyper_lang.Grams(), hyper_lang.Grams()
    gram = (0x20 << 42) | (ord("a") << 21) | ord("é")
    other.bound([12345])
    assert (one.bound([gram]) == other.bound([gram])).all()
    assert set(one.bound([gram]).ravel().tolist()) == {-1, 1}
