import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hirelens.llm import bulk_packing as bp
from hirelens.llm.packing import best_fit_decreasing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "piece string, doc_id bigint, text string, sequence_id int, row int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


PARTS = ["a", "b", "Z", "é", "É", "İ", "'", "'s", "'t", " ", "\n", ".", "!", "—", "́", "̇", "ß", "ñ", "日", "1", "²", "<|", "|>", "<|endoftext|>",
         "<|ENDOFTEXT|>", "\x1c", "\x85", "\xa0", "ﬁ", "Ⅳ", "ǰ", "Σ", "ς", "😀", "ɐ", "ƻ", "ͅ", "\x00", "\t", "-"]


def test_words_have_the_ids_of_the_library(library, monkeypatch):
    monkeypatch.setattr(bp, "CACHED_WORDS", 50)
    rng, encoder = random.Random(5), bp.WordEncoder(PATH)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(4000)] + ["word " * 5000, "x" * 20_000, "don't stop, it's 3.14!"]
    for at in range(0, len(texts), 500):
        made = encoder.encode(pa.array(texts[at : at + 500]))
        assert [np.frombuffer(m, "<u4").tolist() + [1] for m in made] == [ids(library, t) for t in texts[at : at + 500]]


def test_words_of_before_are_not_learnt_again(library, monkeypatch):
    monkeypatch.setattr(bp, "CACHED_WORDS", 2)
    encoder, learnt = bp.WordEncoder(PATH), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda stretches: learnt.append(set(stretches)) or learn(stretches))
    texts = ["some words kept", "others", "(some) words, kept. new"]
    for text in texts:
        assert np.frombuffer(encoder.encode(pa.array([text]))[0], "<u4").tolist() + [1] == ids(library, text)
    assert learnt[0] == {b"some", b"words", b"kept"} and b"new" in learnt[2] and not learnt[2] & learnt[0]


def test_bytes_of_slices():
    texts = ["", "é", "two words", "", "日本", ""]
    for array in (pa.array(texts), pa.array(texts).slice(1, 4), pa.array(texts).slice(3, 1), pa.array(["", ""]), pa.array([], pa.string())):
        assert bp.bytes_of(array) == [t.encode() for t in array.to_pylist()]


def check(rows, capacity):
    """Sequences are full from 0 on without gaps, and hold at most ``capacity``; their number."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= capacity
    return len(by_sequence)


TEXTS = [(1, None), (2, ""), (2, ""), (None, "one two"), (3, "<|endoftext|> it's"), (4, "long text " * 60), (5, "x" * 3000), (6, " \n")]


def test_pieces_and_places(spark, library):
    docs = spark.createDataFrame([("x", i, t, 7, 8) for i, t in TEXTS], SCHEMA)
    pieces = bp.encoded_pieces(docs, PATH, capacity=16)
    rows = bp.best_fit_packed(pieces, capacity=16).collect()
    want = []
    for i, t in TEXTS:
        whole = ids(library, t)
        for p in range(0, len(whole), 16):
            want.append((i, p // 16, p, len(whole[p : p + 16]), zlib.crc32(np.array(whole[p : p + 16], "<u4").tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows], key=str) == sorted(want, key=str)
    check(rows, 16)
    joined = {r.sequence_id: r for r in bp.sequences(bp.best_fit_packed(pieces, capacity=16)).collect()}
    for r in rows:
        assert bytes(joined[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)]) == r.ids and r.offset + r.length in joined[r.sequence_id].ends


def packed(spark, lengths, capacity):
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "key bigint, length bigint").repartition(3)
    rows = bp.best_fit_packed(pieces, capacity).collect()
    assert sorted((r.key, r.length) for r in rows) == list(enumerate(lengths))
    return check(rows, capacity)


@pytest.mark.parametrize("low, high, n", [(1, 100, 400), (20, 60, 300), (51, 100, 200), (1, 8, 900), (100, 100, 30), (34, 50, 301), (1, 1, 250)])
def test_as_few_sequences_as_best_fit_decreasing(spark, monkeypatch, low, high, n):
    monkeypatch.setattr(bp, "RANGE_RUNS", 10)
    monkeypatch.setattr(bp, "RANK_CHUNK", 64)
    rng = random.Random(low * 1000 + n)
    lengths = [rng.randint(low, high) for _ in range(n)]
    assert packed(spark, lengths, 100) <= math.ceil(1.02 * len(best_fit_decreasing(lengths, 100)))


def test_hot_length(spark, monkeypatch):
    monkeypatch.setattr(bp, "RANK_CHUNK", 64)
    assert packed(spark, [7] * 500 + [95] * 40 + [3] * 60, 100) <= 78


def test_whole_table_in_as_few_as_possible(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = bp.best_fit_packed(bp.encoded_pieces(docs, PATH), 4096).select("length", "sequence_id", "offset").collect()
    lengths = [r.length for r in rows]
    assert check(rows, 4096) <= max(len(best_fit_decreasing(lengths, 4096)), math.ceil(sum(lengths) / 4096))


def test_empty_table_and_refused_lengths(spark):
    none = bp.best_fit_packed(bp.encoded_pieces(spark.createDataFrame([], SCHEMA), PATH))
    assert none.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"] and none.count() == 0
    with pytest.raises(ValueError, match="allowed"):
        bp.best_fit_packed(spark.createDataFrame([(1, 17)], "key int, length bigint"), 16)
