"""Exact token counts of every prefix of a text, by dynamic programming over a BPE vocabulary.

Greedy pair merging has two properties that make a table of prefixes possible: the tokens of a text
without the last one are the tokens of the text before that last token, and a row of tokens is what
the text encodes to exactly if every two neighbours are. So the last token of each prefix is the one
vocabulary entry ending there that may follow the last token of the prefix before it, and the count
is one more than the count there. Pieces never cross the border before a space, so each distinct
word is solved once per batch and the words' tables are added up along the text.

The stored table answers later questions without encoding again: see ``count_at`` and ``cut_for``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.arrays import Texts, encode_slices, mix, pieces, spread, texts_of, with_short_batches
from viewloom.llm.bpe import default_path

#: Distinct words remembered by one worker; beyond it the memory starts anew.
REMEMBERED = 300_000
MARK = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "n_chars long, n_bytes long, n_tokens long, fits_chars long, prefix_counts binary"


class PrefixTable:
    """Prefix counts by a sentencepiece BPE file without text rewriting and with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.pieces = [model.id_to_piece(i) for i in plain]
        self.score = {p: model.get_score(i) for p, i in zip(self.pieces, plain)}
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("pieces that run over a space are not supported")
        self.whole = np.array([len(p) == 1 or self.merged(p) == [p] for p in self.pieces])
        # Pieces by the hash of their characters, one sorted table per length.
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({len(p) for p in self.pieces}):
            ids = [i for i, p in enumerate(self.pieces) if len(p) == n]
            points = np.array([[ord(c) for c in self.pieces[i]] for i in ids], np.uint64)
            hashes = np.zeros(len(ids), np.uint64)
            with np.errstate(over="ignore"):
                for j in range(n):
                    hashes = hashes * BASE + points[:, j]
            order = np.argsort(hashes)
            if len(np.unique(hashes)) < len(hashes):
                raise ValueError("two pieces have one hash")
            self.by_length[n] = hashes[order], np.array(ids, np.int64)[order]
        self.longest = max(self.by_length)
        # A border is allowed between two ASCII bytes that no piece holds side by side.
        self.joined = np.zeros((256, 256), bool)
        self.joined[128:] = self.joined[:, 128:] = True
        for p in self.pieces:
            raw = p.replace(MARK, " ").encode()
            for x, y in zip(raw, raw[1:]):
                self.joined[x, y] = True
        self.pair_keys = np.full(1 << 22, -1, np.int64)
        self.pair_good = np.zeros(1 << 22, bool)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def merged(self, text: str) -> list[str]:
        """Pair merging as the library does it: always the best-scored pair, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two neighbouring tokens stay as they are. A character without a piece (an id beyond
        the pieces) never merges; no token on the left asks whether the right one is whole."""
        known = len(self.pieces)
        good = np.ones(len(left), bool)
        start = (left < 0) & (right < known)
        good[start] = self.whole[right[start]]
        ask = np.flatnonzero((left >= 0) & (left < known) & (right < known))
        if len(ask):
            keys = left[ask] * known + right[ask]
            slots = (mix(keys.astype(np.uint64)) & np.uint64(len(self.pair_keys) - 1)).astype(np.int64)
            new = self.pair_keys[slots] != keys
            found = self.pair_good[slots]
            if new.any():
                missing, back = np.unique(keys[new], return_inverse=True)
                pairs = [(self.pieces[k // known], self.pieces[k % known]) for k in missing.tolist()]
                answers = np.array([self.merged(x + y) == [x, y] for x, y in pairs])[back]
                found[new] = answers
                self.pair_keys[slots[new]] = keys[new]
                # Two keys may want one slot: the key that stayed must keep its own answer.
                stayed = self.pair_keys[slots[new]] == keys[new]
                self.pair_good[slots[new][stayed]] = answers[stayed]
            good[ask] = found
        return good

    def prefixes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of every prefix of every word, joined, and where each word starts."""
        points, lengths = _points(words)
        at = np.concatenate([[0], np.cumsum(lengths)])
        total, known = len(points), len(self.pieces)
        points = np.where(points == 0x20, ord(MARK), points)
        offset = np.arange(total) - np.repeat(at[:-1], lengths)
        # Which piece ends at each place, by length; a character without one counts as its bytes.
        width = np.select([points < 0x80, points < 0x800, points < 0x10000], [1, 2, 3], 4)
        ends: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        hashes = np.zeros(total, np.uint64)
        powers = points.astype(np.uint64)
        with np.errstate(over="ignore"):
            for n in range(1, self.longest + 1):
                # hash of the n characters ending here = hash of the n - 1 ending one before * BASE + this
                hashes = np.concatenate([[np.uint64(0)], hashes[:-1]]) * BASE + powers if total else hashes
                if n not in self.by_length:
                    continue
                table, ids = self.by_length[n]
                here = np.flatnonzero(offset >= n - 1)
                place = np.minimum(np.searchsorted(table, hashes[here]), len(table) - 1)
                hit = table[place] == hashes[here]
                if n == 1:
                    token = np.where(hit, ids[place], known + width[here])
                    ends[1] = here, token
                else:
                    ends[n] = here[hit], ids[place[hit]]
        # Places in the order they can be solved: by distance from the start of their word.
        order = np.argsort(offset, kind="stable")
        bounds = np.searchsorted(offset[order], np.arange(int(lengths.max(initial=0)) + 1))
        ends_by = {n: _dense(total, here, token) for n, (here, token) in ends.items()}
        last = np.full(total, -1, np.int64)
        counts = np.zeros(total, np.int32)
        for j in range(len(bounds) - 1):
            todo = order[bounds[j] : bounds[j + 1]]
            for n in range(min(self.longest, j + 1), 0, -1):
                if n not in ends_by or not len(todo):
                    continue
                token = ends_by[n][todo]
                has = token >= 0
                places, tokens = todo[has], token[has].astype(np.int64)
                if not len(places):
                    continue
                left = last[places - n] if j + 1 > n else np.full(len(places), -1, np.int64)
                good = self.may_follow(left, tokens)
                places, tokens = places[good], tokens[good]
                before = counts[places - n] if j + 1 > n else 0
                counts[places] = before + np.where(tokens < known, 1, tokens - known)
                last[places] = tokens
                taken = has.copy()
                taken[has] = good
                todo = todo[~taken]
        return counts, at

    def _borders(self, texts: Texts) -> np.ndarray:
        """Where words start: between bytes that no piece joins, and at a space after another character."""
        data, n = texts.data, len(texts.data)
        marks = np.zeros(n + 1, bool)
        if n > 1:
            before, here = data[:-1], data[1:]
            marks[1:n] = ~self.joined[before, here]
            marks[1:n] |= (here == 0x20) & (before >= 0x80) & (before != 0x81)
        marks[texts.at] = True
        return np.flatnonzero(marks)

    def tables(self, texts: Texts) -> Iterator[np.ndarray]:
        """For each text the token counts of its prefixes of 1, 2, ... characters."""
        cuts = self._borders(texts)
        codes, distinct = encode_slices(texts.data, cuts)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.forget()
        missing = [w for w in distinct if w not in self.known]
        if missing:
            counts, at = self.prefixes(missing)
            self.known.update(zip(missing, range(len(self.at) - 1, len(self.at) - 1 + len(missing))))
            self.flat = np.concatenate([self.flat, counts])
            self.at = np.concatenate([self.at, self.at[-1] + at[1:]])
        places = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        lengths = (self.at[1:] - self.at[:-1])[places]
        begin = self.at[places]
        totals = self.flat[self.at[places + 1] - 1] if len(places) else np.zeros(0, np.int32)
        first = np.searchsorted(cuts, texts.at)
        # The first word of a text is encoded with a space before it.
        heads = np.flatnonzero(np.diff(first) > 0)
        head_counts, head_at = self.prefixes([b" " + distinct[c] for c in codes[first[heads]]])
        head_of = np.full(len(texts), -1, np.int64)
        head_of[heads] = np.arange(len(heads))
        for i in range(len(texts)):
            mine = codes[first[i] : first[i + 1]]
            if not len(mine):
                yield np.zeros(0, np.int64)
                continue
            h = head_of[i]
            head = head_counts[head_at[h] + 1 : head_at[h + 1]]
            sizes, sums = lengths[mine], totals[mine].astype(np.int64)
            sums[0] = head[-1]
            counts = self.flat[spread(begin[mine], sizes)] + np.repeat(np.cumsum(sums) - sums, sizes)
            counts[: len(head)] = head
            yield counts


def _points(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all words, joined, and how many each has."""
    text = [w.decode() for w in words]
    lengths = np.fromiter(map(len, text), np.int64, len(text))
    return np.frombuffer("".join(text).encode("utf-32-le"), np.uint32).astype(np.int64), lengths


def _dense(total: int, here: np.ndarray, token: np.ndarray) -> np.ndarray:
    out = np.full(total, -1, np.int32)
    out[here] = token
    return out


def store(counts: np.ndarray) -> bytes:
    """Differences between neighbouring prefixes, one byte each where they fit, compressed."""
    steps = np.diff(counts, prepend=0)
    small = not len(steps) or (steps.min() >= -128 and steps.max() <= 127)
    raw = steps.astype(np.int8 if small else "<i4").tobytes()
    return bytes([1 if small else 4]) + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def load(blob: bytes) -> np.ndarray:
    """Token counts of the prefixes of 1, 2, ... characters."""
    raw = pa.decompress(blob[9:], int.from_bytes(blob[1:9], "little"), "zstd", asbytes=True)
    return np.cumsum(np.frombuffer(raw, np.int8 if blob[0] == 1 else "<i4").astype(np.int64))


def longest_within(counts: np.ndarray, budget: int) -> int:
    """The longest prefix, in characters, whose own encoding has at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def _count(path: str, budget: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PrefixTable(path)
        for piece in pieces(batches):
            texts = texts_of(piece.column("text"))
            rows = [(len(c), int(c[-1]) if len(c) else 0, longest_within(c, budget), store(c)) for c in table.tables(texts)]
            chars, tokens, fits, blobs = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").combine_chunks().cast(pa.int64()), pa.array(chars, pa.int64()), pa.array(np.diff(texts.at)), pa.array(tokens, pa.int64()), pa.array(fits, pa.int64()), pa.array(blobs, pa.binary())],
                names=["doc_id", "n_chars", "n_bytes", "n_tokens", "fits_chars", "prefix_counts"],
            )

    return count


def prefix_counts(docs: DataFrame, budget: int = 4096, path: str | None = None) -> DataFrame:
    """Rows (doc_id, n_chars, n_bytes, n_tokens, fits_chars, prefix_counts), one per document.

    ``prefix_counts`` holds the exact count of every prefix, ``fits_chars`` is the longest prefix of
    at most ``budget`` tokens. Null text counts as empty (no tokens); null or repeated ids stay rows
    of their own; other columns are ignored. Nothing is shuffled.
    """
    picked = with_short_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.mapInArrow(_count(path or default_path("piece_bpe_32k.model"), budget), "doc_id long, " + SCHEMA)


def count_at(blob: Column, chars: Column) -> Column:
    """Tokens of the prefix of ``chars`` characters, from a stored table."""

    @F.pandas_udf(T.LongType())
    def at(blobs, places):
        import pandas as pd

        found = [0 if n <= 0 else load(b)[: int(n)][-1:].sum() for b, n in zip(blobs, places)]
        return pd.Series(found, dtype="int64")

    return at(blob, chars)


def cut_for(blob: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from a stored table."""

    @F.pandas_udf(T.LongType())
    def cut(blobs, budgets):
        import pandas as pd

        return pd.Series([longest_within(load(b), int(n)) for b, n in zip(blobs, budgets)], dtype="int64")

    return cut(blob, budget)
