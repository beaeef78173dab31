"""Personal data, and the words around it that give it away, in DataFrame functions only.

Fixed patterns find emails, addresses, cards and phone numbers. Each value found is a protected
entity. From all documents the operator counts how often a word occurs with an entity, how often it
occurs at all, and how often the entity does. The disclosure of a word is its pointwise mutual
information with the entity as a share of the entity's information content: 1 if the word occurs
with the entity only, about 0 if it is independent of it. Wherever they stand in a text that holds the
entity, words that exceed a threshold are generalised, those that exceed a higher one are removed.

One or two documents say nothing about a word. So entities that occur in so few are pooled by what they
share (an email's domain, a network, a card's issuer, a phone's country), and the pool is the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions.binding import let
from viewloom.session import scratch_path

#: Fixed patterns. The repeated groups are possessive, which changes no match and needs no stack.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

KINDS = ("email", "ip", "card", "phone")
#: Kinds of the spans that the method adds.
ADDED = ("remove", "generalise")

#: Least length of a word that counts.
SHORTEST = 3
#: Stands for the characters of personal data where words are looked for.
COVER = "\0"
#: Characters after which a text is cut, at a word's end, to find the places of words.
PIECE = 2000


def found_spans(text: Column, pattern: str) -> Column:
    """Leftmost matches as (start, stop, value): what stands between them gives their places."""

    def placed(gaps: Column, values: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(gaps, i))
            stop = start + F.length(F.get(values, i))
            row = F.struct(start.alias("start"), stop.alias("stop"), F.get(values, i).alias("value"))
            return F.struct(stop.alias("at"), F.concat(state["rows"], F.array(row)).alias("rows"))

        none = F.array().cast("array<struct<start: int, stop: int, value: string>>")
        first = F.struct(F.lit(0).alias("at"), none.alias("rows"))
        numbers = F.filter(F.sequence(F.lit(0), F.size(values)), lambda i: i < F.size(values))
        return F.aggregate(numbers, first, step, lambda state: state["rows"])

    both = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")
    )
    return let(both, lambda b: placed(b["gaps"], b["values"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), weighed), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) <= 3) & (F.coalesce(q.try_cast("int"), F.lit(0)) <= 255))
        return F.forall(F.split(value, r"\."), part)
    low, high = (14, 19) if kind == "card" else (10, 15)
    return let(_digits(value), lambda d: F.length(d).between(low, high) & (F.when(F.length(d).between(low, high), _luhn(d)) if kind == "card" else F.lit(True)))


def _guard(kind: str, text: Column) -> Column:
    """A cheap test that a text without matches fails."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){13}")


def _kind_spans(text: Column, rank: int, kind: str, pattern: str) -> Column:
    def row(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop"), F.lit(kind).alias("kind"), s["value"].alias("value"))

    valid = F.filter(found_spans(text, pattern), lambda s: _valid(kind, s["value"]))
    none = F.array().cast("array<struct<start: int, rank: int, stop: int, kind: string, value: string>>")
    return F.when(_guard(kind, text), F.transform(valid, row)).otherwise(none)


def base_spans(text: Column) -> Column:
    """All personal data of a text as (start, rank, stop, kind, value), in order of start, then kind."""
    patterns = (EMAIL, IP, CARD, PHONE)
    return F.sort_array(F.concat(*[_kind_spans(text, i, kind, patterns[i]) for i, kind in enumerate(KINDS)]))


def _uncovered(text: Column) -> Column:
    """The text with a blank for each COVER of its own."""
    return F.replace(text, F.lit(COVER), F.lit(" "))


def _covered(text: Column, spans: Column) -> Column:
    """The text, of equal length, with COVER for the characters of all spans."""

    def step(state: Column, s: Column) -> Column:
        start = F.greatest(state["at"], s["start"])
        between = F.substring(text, state["at"] + 1, start - state["at"])
        shown = F.array(between, F.repeat(F.lit(COVER), s["stop"] - start))
        moved = F.struct(s["stop"].alias("at"), F.concat(state["out"], shown).alias("out"))
        return F.when(s["stop"] > state["at"], moved).otherwise(state)

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text) - state["at"]))
    return F.aggregate(spans, first, step, rest)


def _terms(text: Column) -> Column:
    """The different words of a text, in lower case; letters that touch covered ones are no word."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\x00]+"))
    return F.filter(words, lambda w: (F.length(w) >= SHORTEST) & ~F.contains(w, F.lit(COVER)))


def mentions(docs: DataFrame) -> DataFrame:
    """Rows (row, doc_id, mark, open, entities), one per document with personal data: its entities, and
    its text with them covered."""
    spans = docs.withColumn("spans", base_spans(F.col("text"))).filter(F.size("spans") > 0)
    digits = lambda s: F.when(s["kind"].isin("card", "phone"), _digits(s["value"])).otherwise(F.lower(s["value"]))
    entities = F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], digits(s))))
    return spans.select(F.monotonically_increasing_id().alias("row"), "doc_id", "mark", _covered(_uncovered(F.col("text")), F.col("spans")).alias("open"), entities.alias("entities"))


def _words(text: Column) -> Column:
    """All whole words of a covered text as (start, stop, term). It is cut into pieces that end where a word does."""
    parts = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}+[\p{{L}}\x00]*+"), F.lit(0))

    def step(state: Column, part: Column) -> Column:
        row = F.struct(state["at"].alias("at"), part.alias("part"))
        return F.struct((state["at"] + F.length(part)).alias("at"), F.concat(state["rows"], F.array(row)).alias("rows"))

    def placed(p: Column) -> Column:
        found = F.filter(found_spans(p["part"], r"[\p{L}\x00]+"), lambda w: (F.length(w["value"]) >= SHORTEST) & ~F.contains(w["value"], F.lit(COVER)))
        return F.transform(found, lambda w: F.struct((w["start"] + p["at"]).alias("start"), (w["stop"] + p["at"]).alias("stop"), F.lower(w["value"]).alias("term")))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at: int, part: string>>").alias("rows"))
    return F.flatten(F.transform(F.aggregate(parts, first, step, lambda state: state["rows"]), placed))


def pool_of(entity: Column) -> Column:
    """What an entity shares with others: the domain, the first three numbers of an address, the first
    six digits of a card, the first two of a phone number."""
    kind, value = F.substring_index(entity, ":", 1), F.substr(entity, F.locate(":", entity) + 1)
    shared = (
        F.when(kind == "email", F.concat(F.lit("@"), F.substring_index(value, "@", -1)))
        .when(kind == "ip", F.concat(F.substring_index(value, ".", 3), F.lit(".*")))
        .otherwise(F.concat(F.substring(value, F.lit(1), F.when(kind == "card", 6).otherwise(2)), F.lit("*")))
    )
    return F.concat_ws(":", kind, shared)


def protected(found: DataFrame, support: int) -> DataFrame:
    """Rows (row, entity), distinct: the entities of each document, those of fewer than ``support``
    documents by their pool."""
    each = found.select("row", F.explode("entities").alias("entity"))
    rare = each.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < support).select("entity", F.lit(True).alias("rare"))
    named = each.join(rare, "entity", "left")
    return named.select("row", F.when(F.col("rare"), pool_of(F.col("entity"))).otherwise(F.col("entity")).alias("entity")).distinct()


def disclosures(docs: DataFrame, found: DataFrame, each: DataFrame, support: int) -> DataFrame:
    """Rows (entity, term, n_both, n_term, n_entity, disclosure) for pairs of at least ``support`` documents.

    Counts are of documents, of their whole texts and over the whole corpus, and combine before every
    shuffle. Only entities of ``support`` documents are paired with the words of their documents.
    """
    entities = each.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).filter(F.col("n_entity") >= support)
    shared = each.join(entities, "entity").groupBy("row").agg(F.collect_list("entity").alias("shared"))
    pairs = found.join(shared, "row").select("shared", F.explode(_terms(F.col("open"))).alias("term")).select(F.explode("shared").alias("entity"), "term")
    pairs = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")).filter(F.col("n_both") >= support)
    terms = docs.select(F.explode(_terms(_uncovered(F.col("text")))).alias("term"))
    terms = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    total = docs.agg(F.count(F.lit(1)).alias("n"))
    counted = pairs.join(terms, "term").join(entities, "entity").crossJoin(F.broadcast(total))  # one row
    information = F.log(F.col("n") / F.col("n_entity"))
    mutual = F.log(F.col("n_both") * F.col("n") / (F.col("n_term") * F.col("n_entity")))
    share = F.when(information > 0, mutual / information).otherwise(0.0)
    return counted.select("entity", "term", "n_both", "n_term", "n_entity", share.alias("disclosure"))


def find_personal(docs: DataFrame, generalise: float = 0.8, remove: float = 0.9, support: int = 3) -> DataFrame:
    """Rows (doc_id, text, base, spans), one per document; spans are (start, rank, stop, kind, value).

    ``base`` is the personal data itself; ``spans`` has the disclosing words too, as kinds ``remove``
    and ``generalise``. A word counts only if it occurs with the entity, or with its pool if the entity is
    in fewer, in ``support`` documents, anywhere in them.
    Null text counts as empty; documents with equal ids and texts are counted apart but get the same
    spans, also with null ids; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("mark", F.xxhash64("text"))
    folder = scratch_path(spark, "mentions")
    mentions(base).write.mode("overwrite").parquet(folder)
    found = spark.read.parquet(folder)
    held = scratch_path(spark, "protected")
    protected(found, support).write.mode("overwrite").parquet(held)
    each = spark.read.parquet(held)
    known = disclosures(base, found, each, support).filter(F.col("disclosure") >= generalise)
    sure = F.col("disclosure") >= remove
    known = known.select("entity", "term", F.struct(F.when(sure, len(KINDS)).otherwise(len(KINDS) + 1).alias("rank"), F.when(sure, ADDED[0]).otherwise(ADDED[1]).alias("kind")).alias("k"))
    wanted = each.join(known, "entity").groupBy("row", "term").agg(F.min("k").alias("k"))
    places = found.join(wanted.select("row").distinct(), "row", "left_semi").select("row", "doc_id", "mark", F.explode(_words(F.col("open"))).alias("word")).select("row", "doc_id", "mark", "word.*")
    added = places.join(wanted, ["row", "term"]).groupBy("doc_id", "mark", "start", "stop").agg(F.min("k").alias("k"), F.first("term").alias("term"))
    row = F.struct("start", F.col("k.rank").alias("rank"), "stop", F.col("k.kind").alias("kind"), F.col("term").alias("value"))
    added = added.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_list(row).alias("added"))
    spans = base.select("doc_id", "mark", "text", base_spans(F.col("text")).alias("base"))
    joined = spans.join(added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    both = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return joined.select("doc_id", "text", "base", both.alias("spans"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with personal data as [kind], disclosing words as [word] or gone; of overlapping spans the first counts."""

    def step(state: Column, s: Column) -> Column:
        shown = F.when(s["kind"] == ADDED[0], "").when(s["kind"] == ADDED[1], "[word]").otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        moved = F.struct(s["stop"].alias("at"), F.concat(state["out"], F.array(between, shown)).alias("out"))
        return F.when(s["start"] >= state["at"], moved).otherwise(state)

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text) - state["at"]))
    return F.aggregate(spans, first, step, rest)
