import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from hirelens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id bigint, text string, ids string, shard int, id int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)


def plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= n]
        if fits:
            max(fits, key=sum).append(n)
        else:
            bins.append([n])
    return sorted(map(sum, bins))  # sequences with equal free space are interchangeable


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_best_fit_decreasing(capacity):
    r = random.Random(capacity)
    for n in (0, 1, 5, 200):
        lengths = [r.randint(1, capacity) for _ in range(n)]
        packed = packing.best_fit_decreasing(lengths, capacity)
        assert sorted(i for own in packed for i in own) == list(range(n))
        assert sorted(sum(lengths[i] for i in own) for own in packed) == plain_best_fit(lengths, capacity)


def test_free_space_finds_the_smallest_that_is_enough():
    r, held = random.Random(2), []
    space = packing.FreeSpace(50)
    for k in range(2000):
        if r.random() < 0.5:
            free = r.randint(0, 50)
            space.add(free, k)
            held.append(free)
        else:
            least = r.randint(0, 50)
            found = space.take(least)
            best = min((f for f in held if f >= least), default=None)
            assert (found and found[0]) == best or (found is None and best is None)
            if found:
                held.remove(found[0])


def rebuilt(rows, tokens):
    """Token arrays by (doc id), pieces joined in order, from packed rows."""
    pieces = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == tokens and r.n_tokens == r.cu_seqlens[-1] and r.cu_seqlens[0] == 0
        assert (ids[r.n_tokens :] == packing.PAD_ID).all()
        assert r.position_resets == [x for x in r.cu_seqlens if x < tokens]
        for k, (doc, piece) in enumerate(zip(r.doc_ids, r.pieces)):
            pieces.setdefault(doc, []).append((piece, r.last_pieces[k], ids[r.cu_seqlens[k] : r.cu_seqlens[k + 1]]))
    return {d: sorted(p, key=lambda x: x[0]) for d, p in pieces.items()}


TEXTS = [(1, None), (2, ""), (3, "one two"), (4, "long text " * 3000), (5, "<|endoftext|> ünïcode 日本"), (None, "no id"),
         (6, "x" * 5000)]


@pytest.mark.parametrize("tokens,shard", [(64, 500), (2048, 1 << 22), (5, 1)])
def test_round_trip_through_files(spark, tmp_path, tokens, shard):
    encode = packing._encoder(PATH)
    docs = docs_of(spark, TEXTS + [(100 + i, "word " * (i % 50)) for i in range(200)]).repartition(3)
    packed = packing.packed_sequences(docs, PATH, tokens, shard).cache()
    files = packing.write_matrices(packed, str(tmp_path), tokens)
    assert files == packed.select("shard").distinct().count() == len(list(tmp_path.glob("*.npz")))
    back = packing.read_matrices(spark, str(tmp_path)).orderBy("shard", "sequence").collect()
    assert back == packed.orderBy("shard", "sequence").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc, pieces in rebuilt(back, tokens).items():
        assert [p[0] for p in pieces] == list(range(len(pieces))) and [p[1] for p in pieces] == [False] * (len(pieces) - 1) + [True]
        assert np.concatenate([p[2] for p in pieces]).tolist() == [*encode(texts[doc] or ""), packing.END_ID]
        texts.pop(doc)
    assert not texts
    one = np.load(next(tmp_path.glob("*.npz")))
    assert one["ids"].shape[1] == tokens and one["ids"].dtype == np.uint16


def test_sequences_are_full(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.packed_sequences(docs, PATH).select("n_tokens").collect()
    assert sum(r.n_tokens for r in rows) / (2048 * len(rows)) > 0.99


def test_repeated_rows_and_empty_tables(spark, tmp_path):
    docs = docs_of(spark, [(3, "one two")] * 3 + [(4, None)])
    got = {r.doc_id: (r.copies, r.n_tokens, r.n_pieces) for r in
           packing.document_digests(packing.packed_sequences(docs, PATH)).collect()}
    assert got == {3: (3, 9, 3), 4: (1, 1, 1)}
    empty = packing.packed_sequences(docs.limit(0), PATH)
    assert empty.count() == 0 and packing.write_matrices(empty, str(tmp_path / "none")) == 0
    assert packing.document_digests(packing.read_matrices(spark, str(tmp_path / "none"))).count() == 0


def test_query_matches_plain_encoding(spark):
    from hirelens.llm import queries

    sf = "/root/testdata/sf0.001"
    docs, encode = pd.read_parquet(f"{sf}/documents.parquet"), packing._encoder(PATH)
    want = {}
    for i, text in zip(docs.doc_id, docs.text):
        ids = np.array([*encode(text), packing.END_ID], "<u2")
        cut = [ids[k : k + 2048].tobytes() for k in range(0, len(ids), 2048)]
        want[i] = (1, len(ids), len(cut), str(sum(zlib.crc32(c) * (k + 1) for k, c in enumerate(cut))))
    got = queries.op5_packed_documents(spark, sf).collect()
    assert {r.doc_id: (r.copies, r.n_tokens, r.n_pieces, r.digest) for r in got} == want
