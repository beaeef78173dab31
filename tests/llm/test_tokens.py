"""Prefix counts, token files and packing against the tokenizer libraries."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import ODD, by_id, table, texts
from viewloom.llm import bpe, pattern_pack, prefix_counts, queries, rans_files
from viewloom.llm.arrays import texts_of

TRICKY = [
    "", " ", "  a", "a  b \n c", "<|endoftext|> x", "x<|endoftext|>y <|startoftext|>", "don't 'tis x.'s", "é è à ",
    "a b c", "ÀÉ.Σας ΟΔΟΣ", "a\tb\r\nc", "é ́a a.́b", "中文 字 テ", "\x00 \x1c a \x7f b", "<|ENDOFTEXT|>", "▁x ▁▁y", "word.Word,1234",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cut_encoding_equals_whole_texts(name, small):
    encoder = bpe.Encoder(bpe.default_path(name))
    sample = TRICKY + [t for _, t in texts(small)]
    ids, at = encoder.encode(texts_of(pa.array(sample)))
    plain = Tokenizer.from_file(bpe.default_path(name))
    for i, text in enumerate(sample):
        assert ids[at[i] : at[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_every_prefix_count_equals_its_own_encoding(small):
    import sentencepiece

    path = bpe.default_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    sample = TRICKY + [t[:200] for _, t in texts(small)[:20]]
    for text, counts in zip(sample, prefix_counts.PrefixTable(path).tables(texts_of(pa.array(sample)))):
        assert counts.tolist() == [len(library.encode(text[: i + 1])) for i in range(len(text))]
        assert prefix_counts.load(prefix_counts.store(counts)).tolist() == counts.tolist()


def test_prefix_query_and_questions(spark, small):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=bpe.default_path("piece_bpe_32k.model"))
    found = by_id(queries.op5_prefix_counts(spark, small))
    for i, text in texts(small):
        n = len(library.encode(text))
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len(text.encode()), n, n > 4096)
    from pyspark.sql import functions as F

    counts = prefix_counts.prefix_counts(table(spark, ODD[:1]), budget=5)
    row = counts.select("fits_chars", prefix_counts.count_at(F.col("prefix_counts"), F.lit(9)).alias("at"), prefix_counts.cut_for(F.col("prefix_counts"), F.lit(5)).alias("cut")).first()
    assert row.fits_chars == row.cut and row["at"] == len(library.encode(ODD[0][1][:9]))
    assert len(library.encode(ODD[0][1][: row.cut])) <= 5 < len(library.encode(ODD[0][1][: row.cut + 1]))


def test_prefix_odd_rows(spark):
    rows = prefix_counts.prefix_counts(table(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    assert sorted(r.n_tokens for r in rows)[:3] == [0, 0, 0]  # two nulls and an empty text
    assert prefix_counts.prefix_counts(table(spark, [])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, rans_files.LANES, rans_files.BLOCK + 7])
def test_token_file_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 49_000).astype(np.uint32)
    blob = rans_files.pack_file(np.array([7]), np.array([True]), np.array([n]), ids)
    assert (rans_files.unpack_file(blob)[3] == ids).all()
    if n > rans_files.BLOCK:  # a block alone, from its checkpoint
        assert (rans_files.unpack_file(blob, range(1, 2))[3] == ids[rans_files.BLOCK :]).all()
        broken = bytearray(blob)
        broken[-3] ^= 1
        with pytest.raises(ValueError):
            rans_files.unpack_file(bytes(broken))


def test_token_files_query(spark, small):
    plain = Tokenizer.from_file(bpe.default_path("word_bpe_49k.json"))
    found, start = by_id(queries.op8_token_files(spark, small)), 0
    for i, text in texts(small):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_odd_rows(spark):
    rows = rans_files.token_files(table(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    ends = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)][:2] == [None, None]
    assert rans_files.token_files(table(spark, [])).count() == 0


def check_packing(rows, size, lengths):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for placed in by_sequence.values():
        end = 0
        for offset, n in sorted(placed):
            assert offset == end
            end += n
        assert end <= size
    for doc, n in lengths.items():
        end = 0
        for i, (piece, start, length) in enumerate(sorted(by_doc[doc])):
            assert (piece, start) == (i, end) and (n > size) == (len(by_doc[doc]) > 1)
            assert not i or length == size
            end += length
        assert end == n
    return len(by_sequence)


def test_packing_query(spark, small):
    plain = Tokenizer.from_file(bpe.default_path("byte_bpe_50k.json"))
    lengths = {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(small)}
    made = check_packing(queries.op9_pattern_packing(spark, small).collect(), 1024, lengths)
    assert made <= -(-sum(lengths.values()) // 1024) * 1.05 + 1


def test_packing_odd_rows(spark):
    rows = pattern_pack.pack(table(spark, ODD), size=64).collect()
    assert sum(r.length for r in rows if r.doc_id == 2) == 1  # the end id only
    assert sum(r.piece == 0 for r in rows) == len(ODD)
    assert pattern_pack.pack(table(spark, [])).count() == 0


def test_plan_uses_each_piece_once():
    rng = np.random.default_rng(3)
    histogram = np.bincount(rng.integers(1, 65, 5000), minlength=65)
    used = np.zeros(65, int)
    made = pattern_pack.plan(histogram, 64)
    for lengths, n in made:
        assert sum(lengths) <= 64
        for v in lengths:
            used[v] += n
    assert (used == histogram).all()
    assert sum(n for _, n in made) <= -(-(np.arange(65) * histogram).sum() // 64) * 1.01 + 1


def test_repeated_short_lengths_fill_open_sequences():
    histogram = np.zeros(1025, int)
    histogram[600], histogram[10] = 1000, 40_000  # 42 tens fit beside each 600
    used = np.zeros(1025, int)
    made = pattern_pack.plan(histogram, 1024)
    for lengths, n in made:
        assert sum(lengths) <= 1024
        np.add.at(used, list(lengths), n)
    assert (used == histogram).all() and sum(n for _, n in made) == 1000
