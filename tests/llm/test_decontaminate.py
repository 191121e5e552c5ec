import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hirelens.llm import decontaminate as dc

DOCS = "doc_id bigint, text string, item_id string, score string, id int, words string"
ITEMS = "item_id bigint, text string, doc_id string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows], DOCS)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], ITEMS)


def plain_score(item, words):
    """Best local alignment, cell by cell."""
    above, best = [0] * (len(words) + 1), 0
    for a in item:
        row = [0]
        for j, b in enumerate(words):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 2, row[j] - 2))
        best, above = max(best, *row), row
    return best / (2 * len(item))


def half_up(score):
    return round(math.floor(score * 1e6 + 0.5) / 1e6, 6)


def plain_leaks(docs, items):
    found = {}
    for i, text in docs:
        words = dc.words_of(text or "")
        for k, item in items:
            item = dc.words_of(item or "")
            n = len(item)
            wanted = [item] if n else []
            if n > 64:
                wanted += [item[a : a + 64] for a in {*range(0, n - 64, 32), n - 64}]
            for part in wanted if words else []:
                score = plain_score(part, words)
                if score >= (1.0 if len(part) < 5 else 0.8 if len(part) <= 10 else 0.6) - 1e-12:
                    found[i, k] = max(found.get((i, k), 0), half_up(score))
    return found


def edited(words, share, r, vocabulary):
    out = []
    for w in words:
        kind = r.random()
        if kind < share / 3:
            out.append(r.choice(vocabulary))
        elif kind < 2 * share / 3:
            out += [w, r.choice(vocabulary)]
        elif kind >= share:
            out.append(w)
    return out


@pytest.mark.parametrize("seed,block_bytes,passage_words", [(1, 8 << 20, 4096), (2, 300, 4096), (3, 8 << 20, 10)])
def test_same_as_aligning_everything(spark, seed, block_bytes, passage_words):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(k, " ".join(r.choices(vocabulary, k=r.randint(1, 40)))) for k in range(25)]
    docs = []
    for i in range(120):
        words = r.choices(vocabulary, k=r.randint(0, 150))
        if i % 2:
            at = r.randint(0, len(words))
            words[at:at] = edited(r.choice(items)[1].split(), r.choice([0, 0.1, 0.2, 0.3, 0.4]), r, vocabulary)
        docs.append((i, " ".join(words).upper() if i % 5 == 0 else ", ".join(words)))
    made = dc.leaks(docs_of(spark, docs), items_of(spark, items), block_bytes=block_bytes, passage_words=passage_words)
    got = {(x.doc_id, x.item_id): x.score for x in made.collect()}
    want = plain_leaks(docs, items)
    assert got == want and len(want) > 20


def test_items_of_one_to_two_hundred_words(spark):
    """Whole items, edited ones, and parts of them in texts of other words, against plain alignment."""
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    sizes = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 20, 63, 64, 65, 66, 96, 97, 130, 200]
    items = [(k, " ".join(r.choices(vocabulary, k=n))) for k, n in enumerate(sizes)]
    docs = []
    for i in range(126):
        item = items[i % len(sizes)][1].split()
        part = edited(item, 0.12, r, vocabulary) if i % 3 else item
        if i % 2 and len(item) > 64:
            at = r.randint(0, len(item) - 64)
            part = part[at : at + 64]
        docs.append((i, " ".join([*r.choices(vocabulary, k=r.randint(0, 40)), *part, *r.choices(vocabulary, k=20)])))
    got = {(x.doc_id, x.item_id): x.score for x in dc.leaks(docs_of(spark, docs), items_of(spark, items)).collect()}
    assert got == plain_leaks(docs, items)
    assert {sizes[k] for _, k in got} == set(sizes)
    # Every text with an unchanged item, or with 64 words of it in a row, is found.
    assert all((i, i % len(sizes)) in got for i in range(0, 126, 3))


def test_parts_short_items_and_text_ids(spark):
    long = [f"u{k}" for k in range(200)]
    short = "one two three four five six seven eight nine ten"
    docs = [(1, " ".join(["x"] * 9 + long[50:150])), (2, short.replace("five", "other")), (3, "so Yes, it is"),
            (4, short.replace("five", "a").replace("two", "b")), (5, " ".join(long[100:130])), (6, "one, two: THREE four")]
    items = spark.createDataFrame([("long", " ".join(long)), ("short", short), ("word", "yes"), ("four", "One two three four")],
                                  "item_id string, text string")
    texts = docs_of(spark, docs).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    found = {(x.doc_id, x.item_id): (x.score, x.first_word, x.last_word) for x in dc.leaks(texts, items).collect()}
    assert found == {("d1", "long"): (1.0, 23, 87), ("d2", "short"): (0.85, 0, 10), ("d3", "word"): (1.0, 1, 2),
                     ("d2", "four"): (1.0, 0, 4), ("d6", "four"): (1.0, 0, 4)}
    assert sorted(x.doc_id for x in dc.without_leaks(texts, dc.leaks(texts, items)).collect()) == ["d4", "d5"]


@pytest.mark.parametrize("shortest,longest,least", [(11, 45, 0.6), (5, 10, 0.8), (1, 4, 1.0)])
def test_every_copy_within_the_threshold_keeps_a_seed(shortest, longest, least):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    for _ in range(400):
        item = r.choices(vocabulary, k=r.randint(shortest, longest))
        copy = edited(item, r.choice([0.05, 0.2, 0.35, 0.5]), r, vocabulary + ["odd"] * 500)
        if not copy or plain_score(item, copy) < least:
            continue
        size = min(3, len(item))
        grams = lambda w: [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
        assert sum(g in set(grams(copy)) for g in grams(item)) >= max(1, dc.kept_grams(len(item)))


def test_alignment_of_padded_windows():
    r = np.random.default_rng(0)
    item = r.integers(0, 5, 12)
    windows = [r.integers(-1, 5, n) for n in (1, 5, 30, 17)]
    got = [score for score, _ in dc.align(item, windows)]
    assert got == [round(plain_score(item.tolist(), w.tolist()) * 24) for w in windows]


def test_spans(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = [(1, "so so so " + item + " end"), (2, item.replace("zeta ", "") + " so " + item), (3, "so " + item[:20])]
    got = dc.leaks(docs_of(spark, docs), items_of(spark, [(7, item)])).collect()
    assert sorted((r.doc_id, r.item_id, r.score, r.first_word, r.last_word) for r in got) == [
        (1, 7, 1.0, 3, 15), (2, 7, 1.0, 12, 24)]


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(None, item), (1, None), (2, ""), (3, item), (3, item), (4, "word " * 200_000 + item), (5, "two " + item[4:])]
    benchmark = items_of(spark, [(1, item), (1, item), (2, None), (None, item), (3, " - "), (4, "twelve one"), (5, "two three four five six")])
    found = dc.leaks(docs_of(spark, docs), benchmark)
    assert sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str) == sorted(
        [(i, k) for i in (None, 3, 4, 5) for k in (1, 5)], key=str)
    kept = dc.without_leaks(docs_of(spark, docs), found)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, None] and kept.columns == DOCS.replace(
        "bigint", "").replace("string", "").replace("int", "").replace(" ", "").split(",")
    for d, b in ((docs_of(spark, docs).limit(0), benchmark), (docs_of(spark, docs), benchmark.limit(0))):
        none = dc.leaks(d, b)
        assert none.columns == ["doc_id", "item_id", "score", "first_word", "last_word"] and none.count() == 0
    with pytest.raises(ValueError):
        dc.leaks(docs_of(spark, docs), benchmark, threshold=0.5)


def test_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = pd.read_parquet(f"{sf}/documents.parquet"), pd.read_parquet(f"{sf}/benchmark.parquet")
    whole = {(i, k) for i, t in zip(docs.doc_id, docs.text) for k, b in zip(items.item_id, items.text)
             if " ".join(dc.words_of(b)) in " ".join(dc.words_of(t))}
    found = dc.leaks(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert {(r.doc_id, r.item_id) for r in found.collect() if r.score == 1} == whole != set()


def test_no_local_table_beside_the_search(spark, capsys):
    dc.leaks(docs_of(spark, [(1, "a b c d e f")]), items_of(spark, [(1, "a b c d e f")])).explain()
    assert "ExistingRDD" not in capsys.readouterr().out
