"""Text noise: how little a text looks like writing, from 0 (clean) upwards.

Every part is a count of regular-expression matches over the whole text, so a
document is scored in its own row. Python only builds the character classes, on
the driver, from the Unicode database.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions.binding import let
from viewloom.functions.blocks import BLOCKS, COMMON_IDEOGRAPHS

# The accents that count, and punctuation that is normal in markup.
ACCENTS = ("GRAVE", "ACUTE", "CEDILLA", "DIAERESIS", "CIRCUMFLEX", "TILDE", "MACRON", "RING ABOVE")
SAFE = "<>=:/&;{}[],|\"-()"

_BEYOND = r"\x{80}-\x{10FFFF}"

# Families of Unicode blocks, by script.
_LATIN = r"\x{0020}-\x{024F}\x{1E00}-\x{1EFF}\x{2C60}-\x{2C7F}\x{A720}-\x{A7FF}\x{AB30}-\x{AB6F}"
_KANA = r"\x{3040}-\x{30FF}\x{31F0}-\x{31FF}"
_CJK = r"\x{2E80}-\x{2FDF}\x{3000}-\x{303F}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3134F}"
_HANGUL = r"\x{1100}-\x{11FF}\x{3130}-\x{318F}\x{A960}-\x{A97F}\x{AC00}-\x{D7FF}"
_COMBINING = r"\x{0300}-\x{036F}\x{1AB0}-\x{1AFF}\x{1DC0}-\x{1DFF}\x{20D0}-\x{20FF}\x{FE20}-\x{FE2F}"
_FORM_BLOCKS = r"\x{FE30}-\x{FE4F}\x{FF00}-\x{FFEF}"
FAMILIES = {
    "latin": _LATIN,
    "greek": r"\x{0370}-\x{03FF}\x{1F00}-\x{1FFF}",
    "cyrillic": r"\x{0400}-\x{052F}\x{1C80}-\x{1C8F}\x{2DE0}-\x{2DFF}\x{A640}-\x{A69F}",
    "armenian": r"\x{0530}-\x{058F}",
    "hebrew": r"\x{0590}-\x{05FF}",
    "arabic": r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{0870}-\x{08FF}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}",
    "devanagari": r"\x{0900}-\x{097F}\x{A8E0}-\x{A8FF}",
    "thai": r"\x{0E00}-\x{0E7F}",
    "kana": _KANA,
    "cjk": _CJK,
    "hangul": _HANGUL,
    "combining": _COMBINING,
    "forms": _FORM_BLOCKS,
}
def char_class(points: list[int]) -> str:
    """Code points as the inside of a character class, in ranges."""
    ranges: list[list[int]] = []
    for point in sorted(points):
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


# Words in the names of blocks that do not make two blocks related.
_SECONDARY = set(
    "Supplement Extended Extensions Modifier Marks Punctuation Symbols Forms Operators Miscellaneous "
    "Drawing Block Shapes Supplemental Tags".split()
)


def may_touch(a: str, b: str) -> bool:
    """Whether characters of two Unicode blocks are normal next to each other."""
    names = (a, b)

    def one(word: str) -> bool:
        return word in a or word in b

    def both(*allowed: str) -> bool:
        return a in allowed and b in allowed

    if a == b or ("Latin" in a and "Latin" in b) or one("Emoticons") or (one("Latin") and one("Combining")):
        return True
    if (set(a.split()) - _SECONDARY) & set(b.split()):
        return True
    kana = both("Hiragana", "Katakana")
    if kana or (one("CJK") and ({*names} & {"Hiragana", "Katakana"} or one("Hangul"))):
        return True
    if one("Hangul") and "Basic Latin" in names:
        return True
    return one("CJK") and (one("Punctuation") or one("Forms") or "Basic Latin" in names)


# All points with a name of their own; beyond are private and unassigned ones.
_UNIFORM = ("CJK Unified Ideographs", "Hangul Syllables")
_NAMED_POINTS = (range(0x33480), range(0xE0000, 0xE0200))


@lru_cache(maxsize=1)
def _points() -> dict[str, list[int]]:
    """Code points by kind, from the Unicode database: the kinds of character that noise is told by."""
    block_of = np.zeros(0x110000, np.int16)
    for number, (first, after, _) in enumerate(BLOCKS, 1):
        block_of[first:after] = number
    titles = ["", *[name for _, _, name in BLOCKS]]
    marked = ["Punctuation" in t for t in titles]
    shaped = ["Forms" in t for t in titles]
    pictured = ["Emoticons" in t or "Pictographs" in t for t in titles]
    latin_block = ["Latin" in t for t in titles]
    block_numbers = block_of.tolist()
    found: dict[str, list[int]] = {}
    # Characters without a name, ideographs and Hangul are of one kind per block and category.
    alike: dict[tuple[int, str], list[str]] = {}
    for point in (p for span in _NAMED_POINTS for p in span):
        c, block = chr(point), block_numbers[point]
        category = unicodedata.category(c)
        same = (block, category) if category[0] == "C" and point > 0xFF or category == "Lo" and titles[block].startswith(_UNIFORM) else None
        if same in alike:
            for kind in alike[same]:
                found[kind].append(point)
            continue
        name = unicodedata.name(c, "")
        space, shown, digit = c.isspace(), c.isprintable(), c.isdigit()
        letter = category[0] == "L"
        punct = category[0] == "P" or marked[block]
        symbol = category[0] in "SN" or (shaped[block] and category != "Lo")
        accented = any(f"WITH {accent}" in name for accent in ACCENTS)
        latin = letter and "LATIN" in name
        ends = not letter and (space or punct or category[0] == "Z" or c in "\uff5c+<>")
        odd = not letter and not ends and symbol and not digit and c not in "=~|"
        glyph = letter and any(s in name for s in ("CJK", "HANGUL", "KATAKANA", "HIRAGANA", "THAI"))
        quiet = space or punct or c in SAFE
        kinds = dict(
            unreadable=not space and not shown and c not in "\x1a\ufeff",
            hidden=not shown,
            letter=letter,
            punct=punct and c not in SAFE,
            symbol=symbol and not punct and not digit and c not in SAFE and not pictured[block],
            accented=accented and letter,
            accented_upper=accented and letter and c.isupper(),
            latin=latin,
            no_mark=letter and not punct and not symbol,
            # What ends a word, what is passed over in it, and what makes it odd.
            ends=ends,
            passed=not letter and not ends and not odd,
            odd=odd,
            glyph=glyph,
            foreign=letter and not glyph and (accented or not latin),
            upper=c.isupper(),
            cased=category in ("Lu", "Ll"),
            lower=category == "Ll",
            capital=category == "Lu",
            digit=digit,
            quiet=quiet,
            beyond_latin=shown and not quiet and not latin_block[block],
            cjk="CJK" in name,
            arabic="ARABIC" in name,
            isolated="ARABIC" in name and "ISOLATED FORM" in name,
        )
        so = [kind for kind, is_so in kinds.items() if is_so]
        for kind in so:
            found.setdefault(kind, []).append(point)
        if same:
            alike[same] = so
    rest = [range(0x33480, 0xE0000), range(0xE0200, 0x110000)]
    for kind in ("unreadable", "hidden", "passed"):
        found[kind] += [p for span in rest for p in span]
    return found


def search_class(points: list[int], but_not: list[int] | None = None) -> str:
    """Code points as a character class that is quick to test: those below U+0100 one by one, which is a
    bit set to the regex engine, the others as a binary search. With ``but_not``, all code points but those."""
    member = np.full(0x110000, but_not is not None)
    member[but_not or points] = but_not is None
    if not member.any():
        return "(?!)"
    low = "".join(f"\\x{p:02X}" for p in np.flatnonzero(member[:0x100]))
    edges = np.flatnonzero(np.diff(member[0x100:], prepend=False, append=False)) + 0x100
    ranges = list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))

    def tree(ranges: list[tuple[int, int]]) -> str:
        if len(ranges) <= 3:
            return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
        half = len(ranges) // 2
        parts = (ranges[:half], ranges[half:])
        return "".join(f"[\\x{{{p[0][0]:X}}}-\\x{{{p[-1][1]:X}}}&&[{tree(p)}]]" for p in parts)

    return f"[{low}{tree(ranges)}]"


#: The kinds of character in a word, by the letter that stands for them.
_WORD_KINDS = {"plain": "x", "accented": "a", "foreign": "f", "glyph": "g", "odd": "s"}


@lru_cache(maxsize=1)
def _classes() -> dict[str, str]:
    """The kinds of character as classes, and the accents that translate takes off."""
    points = _points()
    names = {kind: search_class(of) for kind, of in points.items()}
    ends, odd = {*points["ends"]}, {*points["odd"]}
    inside = [p for p in range(0x80) if p not in ends and p not in odd]
    # Characters that make a word worth a look: all that stand in words but plain ASCII.
    looked_at = [*ends, *inside]
    telling = {*points["odd"], *points["glyph"], *points["accented_upper"]}
    # The kinds that stand in words are no letters of ASCII but for the first.
    of_kind = {k: {*points[k]} for k in ("accented", "glyph", "foreign", "odd", "letter", "upper")}
    of_kind["foreign"] -= of_kind["accented"]
    of_kind["plain"] = of_kind["letter"] - of_kind["accented"] - of_kind["glyph"] - of_kind["foreign"]
    in_words = {}
    for kind in _WORD_KINDS:
        in_words[f"{kind}_upper"] = search_class(sorted(of_kind[kind] & of_kind["upper"]))
        in_words[f"{kind}_other"] = search_class(sorted(of_kind[kind] - of_kind["upper"]))
    plain = {}
    for point in points["accented"]:
        base = unicodedata.decomposition(chr(point)).split(" ")[0]
        if base and "<" not in base:
            plain[chr(point)] = chr(int(base, 16))
    return {
        **names,
        "not_cjk": search_class([], but_not=points["cjk"]),
        "not_latin": search_class([], but_not=points["latin"]),
        "not_letter": search_class([], but_not=points["letter"]),
        "accented_latin": search_class(sorted({*points["accented"]} & {*points["latin"]})),
        "not_quiet": search_class([], but_not=points["quiet"]),
        "in_word": search_class([], but_not=points["ends"]),
        "plain_in_word": search_class(inside),
        "mark_in_word": search_class([], but_not=looked_at),
        "ends_or_odd": search_class([*ends, *odd]),
        **in_words,
        "telling": search_class(sorted(telling)),
        "telling_or_accented": search_class(sorted(telling | {*points["accented"]})),
        "dull": search_class([], but_not=[*ends, *telling, *points["accented"]]),
        "cased_beyond": search_class([p for p in points["cased"] if p > 0x7F]),
        "with_accent": "".join(plain),
        "without_accent": "".join(plain.values()),
    }


@lru_cache(maxsize=1)
def accented_class() -> str:
    accented = [p for span in _NAMED_POINTS for p in span if any(f"WITH {a}" in unicodedata.name(chr(p), "") for a in ACCENTS)]
    return rf"[{_BEYOND}&&[{char_class(accented)}]]"


def _matches(text: Column, pattern: str) -> Column:
    """Number of matches of a pattern that is rare in text."""
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _share(hits: Column, size: Column) -> Column:
    return F.coalesce(F.try_divide(hits, size.cast("double")), F.lit(0.0))


@lru_cache(maxsize=1)
def touching_pattern() -> str:
    """A character whose neighbour is of a block that is not normal next to its own. Which block a character
    is of is found by a binary search over the blocks."""
    blocks: list[tuple[int, int, str | None]] = []
    at = 0
    for first, after, name in BLOCKS:
        blocks += [(at, first, None)] if at < first else []
        blocks.append((first, after, name))
        at = after

    def leaf(first: int, after: int, name: str | None) -> str:
        friends = [r"\x{%X}-\x{%X}" % (a, b - 1) for a, b, other in blocks if name and other and may_touch(name, other)]
        return rf"[\x{{{first:X}}}-\x{{{after - 1:X}}}]" + (f"(?![{''.join(friends)}])" if friends else "")

    def tree(some: list) -> str:
        if len(some) == 1:
            return leaf(*some[0])
        half = len(some) // 2
        sides = (some[:half], some[half:])
        return "|".join(rf"(?=[\x{{{p[0][0]:X}}}-\x{{{p[-1][1] - 1:X}}}])(?:{tree(p)})" for p in sides)

    # Blocks of Latin may touch each other, so one of the two is of another block.
    names = _classes()
    loud, other = names["not_quiet"], names["beyond_latin"]
    return f"(?={loud}{{2}})(?={other}|{loud}{other})(?:{tree(blocks)})"


def _adjacent_accents(text: Column) -> Column:
    """Weight of accented Latin letters with no Latin letter between them: 1 for two capitals, 1 for one
    letter under two accents or repeated. Runs of ASCII letters may be cut short."""
    names = _classes()
    latin = F.regexp_replace(text, f"{names['not_latin']}+", "")
    runs = F.regexp_extract_all(latin, F.lit(f"{names['accented_latin']}{{2,}}+"), 0)

    def weight(run: Column) -> Column:
        twins = _matches(F.translate(run, names["with_accent"], names["without_accent"]), r"(.)(?=\1)")
        capitals = _matches(run, f"{names['accented_upper']}(?={names['accented_upper']})")
        return twins + capitals

    # All runs in one text, between spaces, which are no accented letters.
    return let(F.array_join(runs, " "), weight)


def _odd_words(df: DataFrame, text: str, out: str, letters: Column | None = None) -> DataFrame:
    """Share of letters that sit in odd words: half accents, a lone glyph, a capital
    accent at the end, symbols inside, or very long with foreign letters. ``letters`` is how many
    letters the text has, if that is known.

    Words of plain ASCII letters cannot be odd. Of the others, those that have what an odd word must
    have are judged one by one.
    """
    names = _classes()
    t = F.col(text)
    if letters is None:
        letters = F.length(F.regexp_replace(t, f"{names['not_letter']}+", ""))
    suspect = t.rlike(rf"[$^`{_BEYOND}]")
    word, a = names["in_word"], names["accented"]
    # Half of four letters or more have accents only if two have.
    telling = f"{names['dull']}*+(?:{names['telling']}|{a}{names['dull']}*+{names['telling_or_accented']})"
    marked = f"(?={names['plain_in_word']}*+{names['mark_in_word']})"
    # Words of less than four letters are odd only by a symbol.
    short = f"(?={word}{{1,2}}{names['odd']})"
    found = F.regexp_extract_all(t, F.lit(f"{marked}(?:(?={telling})(?={word}{{4}})|{short}|(?={word}{{24}})){word}*+"), 0)
    # Without what is passed over and symbols in front of a word.
    kept = F.regexp_replace(F.concat(F.lit(" "), F.array_join(found, " ")), f"{names['passed']}+", "")
    bare = F.trim(F.regexp_replace(kept, f" {names['ends_or_odd']}*", " "))
    # Each character as its kind, a capital one if it is a capital letter: the patterns of the judgement are short.
    for kind, code in _WORD_KINDS.items():
        bare = F.regexp_replace(F.regexp_replace(bare, names[f"{kind}_upper"], code.upper()), names[f"{kind}_other"], code)
    # A symbol, a glyph, an accented capital at the end, three accents, four letters or 24: the others are not odd.
    may_be = "[^ ]*[sSgG]|[^ ]*A(?![^ ])|(?:[^ aA]*+[aA]){3}|[^ ]{4}(?![^ ])|[^ ]{24}"
    suspects = F.regexp_extract_all(bare, F.lit(f"(?<![^ ])(?={may_be})[^ ]++"), 0)

    def judge(word: Column) -> Column:
        n = F.length(word).cast("double")
        upper = _matches(word, r"\p{Lu}")
        foreign = word.rlike("[AaFf]")
        ends_badly = word.rlike("A$") & (upper < n)
        glyphs = _matches(word, "[Gg]")
        half = (n >= 4) & (_matches(word, "[Aa]") / n >= 0.5)

        # Lambdas share no parts, so what is used twice is bound: 2 is odd and foreign, 1 is odd.
        def sort(half: Column) -> Column:
            flagged = ((n >= 4) & ~half & (ends_badly | (glyphs == 1))) | (
                (n >= 24) & foreign & ~((upper > 0) & (upper / n <= 0.3))
            )
            return F.when(flagged, 2).when(half | word.rlike("[Ss]"), 1).otherwise(0)

        return let(
            let(half, sort),
            lambda k: F.struct(
                F.when(k > 0, n).otherwise(0.0).alias("n"),
                (k == 2).alias("foreign"),
                F.regexp_count(word, F.lit("[Ss]")).alias("symbols"),
            ),
        )

    staged = df.withColumn("_judged", F.when(suspect, F.transform(suspects, judge)))
    bad = F.aggregate("_judged", F.lit(0.0), lambda total, w: total + w["n"])
    symbols = F.aggregate("_judged", F.lit(0), lambda total, w: total + w["symbols"])
    staged = staged.withColumn("_bad", bad)
    some_foreign = F.exists("_judged", lambda w: w["foreign"])
    eleven_words = t.rlike(f"\\A(?:{names['not_letter']}*+{names['letter']}{word}*+){{11}}")
    share = F.when(some_foreign | eleven_words, _share(F.col("_bad"), letters + symbols))
    return staged.withColumn(out, F.coalesce(F.when(F.col("_bad") > 0, share), F.lit(0.0))).drop("_judged", "_bad")


def noise_parts(df: DataFrame, text: str, prefix: str = "", common_cjk: str = COMMON_IDEOGRAPHS) -> DataFrame:
    """Add the parts of the noise score, named ``prefix`` + part, 0 when unsuspicious.

    ``common_cjk`` lists ideographs regarded as common. Each part is looked at only in texts that have what
    it counts: most of a text is ASCII letters, which one pass takes out.
    """
    t = F.col(text)
    names = _classes()
    bare, rest, beyond, shown = F.col("_bare"), F.col("_rest"), F.col("_beyond"), F.col("_shown")

    def kept(column: Column, kind: str) -> Column:
        return F.length(column) - F.length(F.regexp_replace(column, f"{names[kind]}+", ""))

    # Marks are among the rest, without most letters, so they are a share of 0.3 only if that is a share of 0.15.
    many_marks = (F.length(rest) - kept(beyond, "no_mark")) * 10 >= F.length(t)
    other_blocks = beyond.rlike(names["beyond_latin"])
    staged = (
        df.withColumn("_runs", F.regexp_replace(t, "[A-Za-z]+", "a"))
        .withColumn("_bare", F.replace("_runs", F.lit("a"), F.lit("")))
        .withColumn("_rest", F.regexp_replace(bare, r"[0-9 <>=:/&;{}\[\],|\"\-()]+", ""))
        .withColumn("_beyond", F.regexp_replace(rest, r"[\x00-\x7F]+", ""))
        .withColumn("_more", kept(beyond, "letter"))
        .withColumn("_shown", F.when(many_marks | other_blocks, F.regexp_replace(t, f"{names['hidden']}+", "")))
        .withColumn("_accents", _matches(beyond, names["accented"]))
        .withColumn("_ideographs", F.regexp_replace(beyond, f"{names['not_cjk']}+", ""))
    )
    plain, size = F.length(t) - F.length(bare), F.length(t) + 1
    letters, latin = plain + F.col("_more"), plain + kept(beyond, "latin")
    staged = _odd_words(staged, text, prefix + "odd_words", letters)
    accents, ideographs, wide = F.col("_accents"), F.col("_ideographs"), beyond != ""
    # A run of one repeated character counts once.
    marks = _share(
        _matches(shown, rf"({names['punct']})(?!\1)") + 2 * _matches(shown, rf"({names['symbol']})(?!\1)"), F.length(shown)
    )
    cased, digit, small, big = names["cased"], names["digit"], names["lower"], names["capital"]
    flips = F.transform(
        F.regexp_extract_all(t, F.lit(rf"(?<!{cased})(?=[A-Za-z]*+{names['cased_beyond']}){cased}{{3,64}}(?!{cased}|{digit})"), 0),
        lambda w: _matches(w, f"{big}(?={small}{big}){small}|{small}(?={big}{small}){big}"),
    )
    flipped = F.aggregate(flips, F.lit(0.0), lambda total, n: total + 2 * n)
    rare = _share(F.length(F.translate(ideographs, common_cjk, "")), F.length(ideographs))
    arabic = _matches(beyond, names["arabic"])
    doubled = _adjacent_accents(F.col("_runs"))
    parts = {
        "marks": F.when(many_marks & (marks >= 0.3), marks).otherwise(0.0),
        # Eight letters and 0.35 of them are three.
        "accents": F.when(accents >= 3, let(letters.cast("double"), lambda n: F.when((n >= 8) & (accents / n >= 0.35), accents / n))),
        "unreadable": _share(8 * _matches(rest, names["unreadable"]), size),
        "double_accents": F.when(accents >= 2, let(doubled, lambda n: F.when(n > 0, _share(2 * n, latin)))),
        "mixed_blocks": F.when(
            other_blocks & (F.length(shown) > 13), _share(2 * _matches(shown, touching_pattern()), F.length(shown))
        ),
        "rare_ideographs": F.when((F.length(ideographs) >= 8) & (rare > 0.5), rare / 10),
        # Three letters in turn small and capital have a capital after a small one.
        "case_flips": F.when(wide & t.rlike(small + big), _share(flipped, size)),
        "isolated_forms": F.when(beyond.rlike(names["arabic"]) & (arabic >= 8), _share(_matches(beyond, names["isolated"]), arabic)),
    }
    return staged.withColumns({prefix + k: F.coalesce(v, F.lit(0.0)) for k, v in parts.items()}).drop(
        "_runs", "_bare", "_rest", "_beyond", "_more", "_shown", "_accents", "_ideographs"
    )


PARTS = [
    "marks",
    "accents",
    "unreadable",
    "double_accents",
    "mixed_blocks",
    "odd_words",
    "rare_ideographs",
    "case_flips",
    "isolated_forms",
]


def noise_score(df: DataFrame, text: str, out: str = "noise", common_cjk: str = COMMON_IDEOGRAPHS) -> DataFrame:
    """Add the noise score: the sum of all parts, rounded to 3 digits. The whole
    text counts; nothing stops early at a threshold. Parts that are there already,
    by :func:`noise_parts`, are summed as they are."""
    have = all(p in df.columns for p in PARTS)
    prefix = "" if have else "_noise_"
    scored = df if have else noise_parts(df, text, prefix, common_cjk)
    total = sum((F.col(prefix + p) for p in PARTS), F.lit(0.0))
    scored = scored.withColumn(out, F.round(total, 3))
    return scored if have else scored.drop(*[prefix + p for p in PARTS])
