import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Row, functions as F

from hirelens.llm import quality

DOCS = "doc_id bigint, text string, score string, predicted string, label string, id int"
LABELS = "doc_id bigint, quality int, text string, score int"
GOOD, BAD = "Some plain words of a text, and then more. They go on.", "SOME!! WORDS!! %%% &&& ***"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", 1) for i, t in rows], DOCS)


def labelled(spark, rows):
    return spark.createDataFrame([(i, q, "t", 3) for i, q in rows], LABELS)


def test_terms_of_long_texts_add_up(monkeypatch):
    text = (GOOD + BAD).encode() * 50
    same = np.arange(quality.N_TERMS)
    whole = quality.term_counts(text, same, quality.N_TERMS)
    monkeypatch.setattr(quality, "STEP_CHARS", 17)
    assert np.allclose(quality.term_counts(text, same, quality.N_TERMS), whole)


def test_vote_matches_a_plain_loop():
    r = np.random.default_rng(1)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    known, asked, labels = unit(r.normal(size=(60, 8))), unit(r.normal(size=(20, 8))), r.integers(0, 2, 60).astype(float)
    known[10] = known[11]
    model = quality.Model(None, None, None, known, labels)
    got = quality.vote(np.vstack([asked, np.zeros((1, 8))]), model, neighbours=5)
    for v, score in zip(asked, got):
        cosines = sorted(((float(v @ k), y) for k, y in zip(known, labels)), reverse=True)
        near = [(c, y) for c, y in cosines if c >= cosines[4][0] - 1e-9]
        weights = [max(c, 1e-6) ** 8 for c, _ in near]
        assert abs(score - sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights)) < 1e-6
    assert got[-1] == 0


def test_odd_rows(spark):
    texts = [(None, GOOD), (1, None), (2, ""), (3, " "), (4, GOOD), (4, GOOD), (5, BAD), (6, GOOD * 5000), (7, "\x00日本")]
    docs = table(spark, texts)
    known = labelled(spark, [(i, 1) for i in range(100, 130)] + [(i, 0) for i in range(200, 230)] + [
        (None, 1), (4, None), (100, 1), (101, 0), (999, 0)])
    corpus = docs.unionByName(table(spark, [(i, GOOD + " ab" * (i % 7)) for i in range(100, 130)]
                                    + [(i, BAD * (1 + i % 3)) for i in range(200, 230)]))
    got = [r for r in quality.quality_scores(corpus, known).collect() if r.doc_id is None or r.doc_id < 100]
    assert len(got) == len(texts)
    scores = {r.doc_id: r.score for r in got}
    assert scores[1] == scores[2] == 0 and scores[4] > 0.9 and scores[None] > 0.9 and scores[5] < 0.1 and scores[6] > 0.7
    for r in got:
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(1, GOOD), (2, None)])
    for known in (labelled(spark, []), labelled(spark, [(None, 1), (1, None), (2, 1), (50, 0)])):
        assert [(r.score, r.predicted) for r in quality.quality_scores(docs, known).collect()] == [(0.5, 0)] * 2
    empty = quality.quality_scores(docs.limit(0), labelled(spark, [(1, 1)]))
    assert empty.columns == ["doc_id", "held_out", "score", "predicted"] and empty.count() == 0


def test_bounded_sample_and_same_scores_again(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.fit(docs, known, max_labelled=20, dimensions=4)
    assert model.vectors.shape[0] <= 20 and model.axes.shape[1] == 4
    first, second = (quality.quality_scores(docs.repartition(n), known).orderBy("doc_id").collect() for n in (1, 5))
    assert first == second


def test_labels_without_a_text_do_not_use_up_the_bound(spark):
    docs = table(spark, [(i, GOOD) for i in range(10)] + [(i, None) for i in range(10, 500)])
    model = quality.fit(docs, labelled(spark, [(i, i % 2) for i in range(2000)]), max_labelled=8)
    assert model is not None and len(model.labels) == 8


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    made = quality.quality_scores(docs, known).filter("held_out").join(known, "doc_id").toPandas()
    assert (made.predicted == made.quality).mean() > 0.99
    ranks = pd.Series(made.score).rank()
    good = made.quality == 1
    area = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.98
    assert made[good].predicted.mean() > 0.99


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = known.withColumn("quality", F.when(quality.in_hold_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.quality_scores(docs, known).orderBy("doc_id").collect() == quality.quality_scores(
        docs, turned).orderBy("doc_id").collect()


def plain_terms(text):
    """Weights of a text by plain loops, as ``{name of the term: weight}``."""
    kind = lambda b: (
        "a" if 97 <= b <= 122 or b >= 128 else "A" if 65 <= b <= 90 else "0" if 48 <= b <= 57 else "t" if b in (9, 13)
        else chr(b) if chr(b) in quality._MARKS + " \n" else "other")
    raw, made = text.encode(), {}
    triples = [tuple(map(kind, raw[k : k + 3])) for k in range(len(raw) - 2)]
    for t in triples:
        made[t] = made.get(t, 0) + 1
    made = {t: math.sqrt(n / len(triples)) for t, n in made.items()}
    words = raw.split()
    if words:
        share = sum(a == b for a, b in zip(words, words[1:])) / len(words)
        made["repeats", int(share * 9)] = 0.3
    hashed = {}
    for word in re.findall("[a-z0-9\x80-\U0010ffff]+", text.translate({k: k + 32 for k in range(65, 91)})):
        for part in [word] if word.isascii() or len(word) == 1 else [word[k : k + 2] for k in range(len(word) - 1)]:
            column = "word", zlib.crc32(part.encode()) % quality.WORD_COLUMNS
            hashed[column] = hashed.get(column, 0) + 1
    made |= {c: 0.5 * math.sqrt(n / sum(hashed.values())) for c, n in hashed.items()}
    return made


def plain_scores(texts, labels, dimensions=32):
    """Scores of ``{id: text}`` by a dense decomposition and a loop over all labelled texts."""
    known = [i for i in texts if i in labels and zlib.crc32(str(i).encode()) % 4 != 2]
    bags = {i: plain_terms(t) for i, t in texts.items()}
    names = sorted({n for i in known for n in bags[i]}, key=str)
    idf = [math.log((1 + len(known)) / (1 + sum(n in bags[i] for i in known))) + 1 for n in names]
    vector = lambda i: np.array([bags[i].get(n, 0) * w for n, w in zip(names, idf)])
    axes = np.linalg.svd(np.stack([vector(i) for i in known]), full_matrices=False)[2][:dimensions]
    placed = {i: axes @ vector(i) for i in texts}
    made = {}
    for i, v in placed.items():
        cosines = [(float(v @ placed[k] / np.linalg.norm(v) / np.linalg.norm(placed[k])), labels[k]) for k in known]
        last = sorted((c for c, _ in cosines), reverse=True)[14]
        near = [(max(c, 1e-6) ** 8, y) for c, y in cosines if c >= last - 1e-9]
        made[i] = sum(w * y for w, y in near) / sum(w for w, _ in near)
    return made


def lists_of_words(r, alphabet, n=300):
    return ["".join(r.choices(alphabet, k=5)) for _ in range(n)]


def spoken(r, words):
    return ". ".join(" ".join(r.choices(words, k=r.randint(8, 15))) for _ in range(6))


def told_apart(spark, good, bad, seed=3):
    """Held-out ``(id, score, predicted)`` and all scores of 400 texts of two vocabularies."""
    r = random.Random(seed)
    texts = {i: spoken(r, good if i % 2 else bad) for i in range(400)}
    docs, known = table(spark, list(texts.items())), labelled(spark, [(i, i % 2) for i in texts])
    rows = quality.quality_scores(docs, known).collect()
    return texts, {x.doc_id: x.score for x in rows}, [x for x in rows if x.held_out]


def test_vocabulary_alone_tells_texts_apart(spark):
    r = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    shared = lists_of_words(r, letters, 200)
    texts, scores, held = told_apart(spark, lists_of_words(r, letters) + shared, lists_of_words(r, letters) + shared)
    assert len(held) > 80 and sum(x.predicted == x.doc_id % 2 for x in held) >= 0.95 * len(held)
    want = plain_scores(texts, {i: i % 2 for i in texts})
    differs = [i for i in texts if abs(scores[i] - want[i]) > 1e-3]
    assert scores.keys() == want.keys() and len(differs) <= 0.01 * len(texts)


def test_scripts_without_blanks(spark):
    r = random.Random(2)
    good, bad = (lists_of_words(r, [chr(k) for k in range(a, a + 60)]) for a in (0x4E00, 0x4E80))
    texts, _, _ = told_apart(spark, good, bad)
    joined = {i: t.replace(" ", "") for i, t in texts.items()}
    rows = quality.quality_scores(table(spark, list(joined.items())), labelled(spark, [(i, i % 2) for i in texts])).collect()
    held = [x for x in rows if x.held_out]
    assert sum(x.predicted == x.doc_id % 2 for x in held) >= 0.95 * len(held)


def test_fewer_rows_than_columns():
    r = np.random.default_rng(4)
    for shape in ((12, 40), (40, 12)):
        made = r.random(shape)
        axes = quality._axes(made, 5)
        want = np.linalg.svd(made, full_matrices=False)[2][:5].T
        assert np.allclose(np.abs(axes.T @ want), np.eye(5), atol=1e-8)
    assert quality._axes(np.ones((3, 9)), 5).shape == (9, 1)


def test_leading_vectors_of_a_large_matrix(monkeypatch):
    monkeypatch.setattr(quality, "WHOLE", 10)
    monkeypatch.setattr(quality, "DEPTH", 3)
    monkeypatch.setattr(quality, "BLOCK_CELLS", 700)
    r = np.random.default_rng(6)
    for made in (r.random((90, 300)), r.random((300, 90)), r.random((120, 4)) @ r.random((4, 90)), np.eye(80), np.repeat(np.eye(50), 3, axis=0)):
        at, columns = np.nonzero(made)
        ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(made)))])
        sparse = quality.SparseRows(ends, columns, made[at, columns], made.shape[1])
        assert (sparse[:] == made).all() and (sparse.T[:] == made.T).all()
        for matrix in (made, sparse):
            axes, want = quality._axes(matrix, 5), np.linalg.svd(made, compute_uv=False)[:5]
            assert np.allclose(axes.T @ axes, np.eye(5), atol=1e-8)
            assert np.allclose(np.linalg.norm(made @ axes, axis=0), want, atol=1e-6)


def test_memory_of_the_fit_follows_its_entries(monkeypatch):
    """1,200 texts of 40 terms each out of 20,000: 200 MB as a dense matrix, and more than one was held."""
    r, rows = np.random.default_rng(7), []
    for i in range(1200):
        at = np.unique(r.integers(0, 20_000, 40)).astype(np.float32)
        rows.append(Row(terms=np.concatenate([at, np.ones(len(at), np.float32)]).tobytes(), label=float(i % 2)))
    monkeypatch.setattr(quality, "_sample", lambda *_: rows)
    tracemalloc.start()
    try:
        model = quality.fit(None, None, learn_from=F)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.vectors.shape == (1200, 32) and peak < 128 << 20


def test_memory_of_scoring_does_not_follow_the_texts():
    r = np.random.default_rng(5)
    columns = 12_000
    column_of = np.full(quality.N_TERMS, columns, np.int64)
    column_of[r.permutation(quality.N_TERMS)[:columns]] = np.arange(columns)
    known = r.normal(size=(4096, 32))
    known /= np.linalg.norm(known, axis=1, keepdims=True)
    model = quality.Model(column_of, r.random(columns), r.normal(size=(columns, 32)), known, r.random(4096))
    texts = [(GOOD + BAD * (i % 7)).encode() for i in range(511)] + [b""]
    tracemalloc.start()
    vectors = model.project(texts)
    scores = quality.vote(vectors, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20  # all texts at once: 49 MB of terms twice, 17 MB of similarities twice
    alone = [quality.vote(model.project([t]), model)[0] for t in texts[:20] + texts[-1:]]
    assert np.allclose([*scores[:20], scores[-1]], alone, atol=2e-6) and scores[-1] == 0
    assert model.project([]).shape == (0, 32)
