"""Token ids of whole texts from a public tokenizer file, with one encoding per distinct piece.

A text is cut only where its tokens provably end, the distinct pieces of a batch are encoded by the
tokenizers library, and the ids are gathered back. The ids equal those of the whole text.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np

from viewloom.llm.arrays import SPACES, Texts, encode_slices, runs, spread

#: Distinct pieces remembered by one worker; beyond it the memory starts anew.
REMEMBERED = 500_000
#: Text encoded at once: larger pieces repeat fewer words.
ENCODED = 8 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,!?;:")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: First bytes of characters that are never white space, and visible ASCII.
_OPENS = np.zeros(256, bool)
_OPENS[0x21:0x7F] = True
_OPENS[0xC3:0xE0] = True
_OPENS[0xE4:] = True


def default_path(name: str) -> str:
    """Where the installed public tokenizer files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _after_letter(data: np.ndarray) -> np.ndarray:
    """Marks, for every byte but the first, of punctuation right after an ASCII letter: a token
    border in either pattern."""
    return _LETTER[data[:-1]] & _STOP[data[1:]]


def _spaced(texts: Texts) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Codes, distinct pieces, and the first piece of each text, for byte-level files.

    Borders lie before a single space between visible characters, where the space belongs to the
    word after it, and before a mark after a letter. A space at the edge of a text may be tested
    against its neighbour's bytes, which does no harm: the edge is a border anyway.
    """
    data, n = texts.data, len(texts.data)
    marks = np.zeros(n + 1, bool)
    if n > 2:
        space = np.flatnonzero(data == 0x20)
        space = space[(space > 0) & (space < n - 1)]
        before, after = data[space - 1], data[space + 1]
        two = np.where(space > 1, data[space - 2], 0)
        closes = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (two >= 0xC3) & (two < 0xE0))
        marks[1:n] = _after_letter(data)
        marks[space[closes & _OPENS[after]]] = True
    marks[texts.at] = True
    cuts = np.flatnonzero(marks)
    codes, distinct = encode_slices(data, cuts)
    return codes, distinct, np.searchsorted(cuts, texts.at)


def _worded(texts: Texts) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The same for files that drop white space and letter case: pieces are runs of other bytes."""
    data, n = texts.data, len(texts.data)
    if b"<|" not in data.tobytes():  # a special token's string counts in lower case only
        data = _LOWER[data]
    kept = ~SPACES[data]
    first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    starts, ends = runs(kept, texts.at)
    if n > 1:
        first[1:n] = last[1:n] = _after_letter(data)
    first[starts] = True
    last[ends] = True
    edges = texts.at[(texts.at > 0) & (texts.at < n)]
    edges = edges[kept[edges - 1] & kept[edges]]
    last[edges] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    cuts = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=cuts[1:])
    codes, distinct = encode_slices(data[kept], cuts)
    return codes, distinct, np.searchsorted(starts, texts.at)


def _byte_letters() -> dict[int, str]:
    """The printable character by which byte-level files write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Ids of texts by one tokenizer file, byte-level BPE or lower-case BPE with word ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = self.tokenizer.encode_batch_fast(["a b"], add_special_tokens=False)[0].ids != [
            *self.tokenizer.encode_batch_fast(["a"], add_special_tokens=False)[0].ids,
            *self.tokenizer.encode_batch_fast(["b"], add_special_tokens=False)[0].ids,
        ]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def _word(self, piece: str) -> str | None:
        """A piece that is one Latin word, in the model's own writing; None if it may be anything else.

        Such a word is one token group before merging, so the model alone gives its ids.
        """
        space = self.spaced and piece[:1] == " "
        word = piece[1:] if space else piece
        if not word.isalpha() or not (word.isascii() or (max(word) < "\u0250" and "\u0130" not in word)):
            return None
        word = word if self.spaced else word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return self.letters[0x20] + word if space else word

    def _learn(self, missing: list[bytes]) -> None:
        lists: list[list[int]] = [[]] * len(missing)
        others = []
        tokenize, marked = self.model.tokenize, self.letters[0x20] if self.spaced else ""
        for i, raw in enumerate(missing):
            if raw.isalpha():  # ASCII letters alone
                word = raw.decode() if self.spaced else raw.lower().decode()
            elif marked and raw[:1] == b" " and raw[1:].isalpha():
                word = marked + raw[1:].decode()
            else:
                word = self._word(raw.decode())
            if word is None:
                others.append(i)
            else:
                lists[i] = [t.id for t in tokenize(word)]
        found = self.tokenizer.encode_batch_fast([missing[i].decode() for i in others], add_special_tokens=False)
        for i, e in zip(others, found):
            lists[i] = e.ids
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum()))
        base = len(self.at) - 1
        self.ids = np.concatenate([self.ids, flat])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        self.known.update(zip(missing, range(base, base + len(missing))))

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, and where each text starts (one more at the end)."""
        codes, distinct, first = (_spaced if self.spaced else _worded)(texts)
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        missing = [b for b in distinct if b not in self.known]
        if missing:
            self._learn(missing)
        places = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        per_code = (self.at[1:] - self.at[:-1])[places]
        counts = per_code[codes]
        ids = self.ids[spread(self.at[places][codes], counts)]
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(counts, out=ends[1:])
        return ids, ends[first]


@lru_cache(maxsize=2)
def shared_encoder(path: str) -> Encoder:
    """The encoder of this worker process, which keeps what it has learned from task to task."""
    return Encoder(path)


def with_end(ids: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the id ``end`` to each text."""
    return np.insert(ids, at[1:], end).astype(np.uint32), at + np.arange(len(at))
