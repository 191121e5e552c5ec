import math
import random
import re
from collections import Counter

import pytest

from hirelens.llm import ranked_search as rs

DOCS = "score string, doc_id bigint, text string, block int"
ITEMS = "rank string, item_id bigint, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    fold = {c: c + 32 for c in range(65, 91)}
    return TERM.findall((text or "").translate(fold))


def plain(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in wanted if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def found(spark, docs, items, top):
    made = rs.ranked_search(spark.createDataFrame([("x", *d, 1) for d in docs], DOCS), spark.createDataFrame([("y", *i) for i in items], ITEMS), top)
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, made.collect()), key=str)


ODD_DOCS = [(1, None), (2, ""), (3, "..."), (4, "Naïve NAÏVE café"), (4, "Naïve NAÏVE café"), (None, "café one"), (None, "café one"), (5, "one " * 50_000),
            (6, "one"), (7, "one"), (8, "one two"), (9, "Two\x00three\x7ffour"), (10, "日本 one")]
ODD_ITEMS = [(1, "one"), (1, "two"), (2, None), (3, ""), (None, "café ONE"), (4, "zzz"), (5, "日本 four naÏve naïve"), (5, "日本 four naÏve naïve")]


@pytest.mark.parametrize("top", [1, 2, 10])
def test_odd_rows(spark, top):
    assert found(spark, ODD_DOCS, ODD_ITEMS, top) == sorted(plain(ODD_DOCS, ODD_ITEMS, top), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_same_as_scoring_all(spark, monkeypatch, seed):
    """Small blocks and groups, frequent and rare words, many ties; the bundles drop what cannot win, the result is the same."""
    monkeypatch.setattr(rs, "BLOCK_DOCS", 7 + seed)
    monkeypatch.setattr(rs, "GROUP_ITEMS", 5)
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 200}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(13)] + [(99, docs[3][1])]
    assert found(spark, docs, items, 5) == sorted(plain(docs, items, 5), key=str)


def test_many_items_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(rs, "MAX_PAIRS", 3)
    items = [(i, f"one two w{i}") for i in range(6)]
    assert found(spark, ODD_DOCS, items, 3) == sorted(plain(ODD_DOCS, items, 3), key=str)


@pytest.mark.parametrize("docs, items", [([], [(1, "one")]), ([(1, "one")], []), ([], []), ([(1, None)], [(1, "one")]), ([(1, "one")], [(1, None)])])
def test_nothing_to_find(spark, docs, items):
    assert found(spark, docs, items, 10) == []


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one"), ("a", "one"), (None, "one")], "doc_id string, text string")
    made = rs.ranked_search(docs, spark.createDataFrame([("q", "one")], "item_id string, text string"), 3)
    assert [(r.item_id, r["rank"], r.doc_id) for r in made.orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


def test_bundles_drop_what_cannot_win():
    import numpy as np
    import pyarrow as pa

    items = rs.Items([0], [b"rare", b"often"], [np.array([0, 1])])
    owner = np.array([0, rs.OWNERS - 1])
    left = pa.table({"grp": [0], "n_docs": [4], "open": [b"\x01"], "sizes": [b"\x00" * 4], "docs": [b""], "scores": [b""]})
    right = pa.table({
        "terms": [np.array([0, 0], "<i4").tobytes()], "docs": [np.array([1, 2], "<i4").tobytes()], "scores": [np.array([90, 50], "<i8").tobytes()],
        "later_terms": [np.array([1], "<i4").tobytes()], "later_most": [np.array([10], "<i8").tobytes()],
    })
    (_, docs, scores, still_open), = rs._advance(items, owner, 0, 1, left, right)
    assert docs.tolist() == [1] and scores.tolist() == [90] and not still_open
