import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from hirelens.llm import simhash
from hirelens.llm.components import components

SCHEMA = "doc_id bigint, text string, fingerprint string, component_id string, bit int"


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    """Smallest id over links; ``nodes`` maps ids to values."""
    root = {i: i for i in nodes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(nodes)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if linked(nodes[i], nodes[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def within(distance):
    return lambda a, b: (a ^ b).bit_count() <= distance


def test_segments_cover_all_bits():
    for d in (0, 1, 2, 3, 4, 7):
        cut = simhash.segments(d)
        assert sum(w for _, w in cut) == 64 and len(cut) == max(2, d // 2 + 1)


def test_fingerprints(spark):
    texts = [None, "", " \t\n", "One", "a b c d e f g", "a b c d " * 300, "É À ü 日本 x\x0by\x0cz", "A B C D E F G"]
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    got = {r.id: r.fp for r in simhash.fingerprints(spark.createDataFrame(rows, SCHEMA), 4).collect()}
    assert {i: v % 2**64 for i, v in got.items()} == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_steps_of_long_texts_add_up(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefg", k=500))
    whole = simhash.fingerprint(text.encode(), 4)
    monkeypatch.setattr(simhash, "STEP_SHINGLES", 7)
    assert simhash.fingerprint(text.encode(), 4) == whole == plain_fingerprint(text)


def clustered(n, seed):
    """Fingerprints in chains, balls and at random."""
    r = random.Random(seed)
    values = [r.getrandbits(64) for _ in range(n // 4)]
    while len(values) < n:
        v = r.choice(values)
        for b in r.sample(range(64), r.randint(0, 6)):
            v ^= 1 << b
        values.append(v)
    return dict(enumerate(values))


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 6])
@pytest.mark.parametrize("tile", [4, simhash.TILE])
def test_links_join_what_brute_force_joins(spark, distance, tile):
    nodes = {i: v for i, v in clustered(300, distance).items()}
    firsts = {v: i for i, v in reversed(nodes.items())}
    rows = [(i, int(np.uint64(v).view(np.int64))) for v, i in firsts.items()]
    made = simhash.links(spark.createDataFrame(rows, "id bigint, fp bigint"), distance, tile)
    pairs = made.collect()
    assert all(within(distance)(nodes[p.a], nodes[p.b]) for p in pairs)
    roots = {r.node: r.root for r in components(made).collect()}
    want = plain_components({i: v for v, i in firsts.items()}, within(distance))
    assert {i: roots.get(i, i) for i in want} == want


def test_forest_of_large_keys():
    nodes = clustered(400, 9)
    fps = np.array(list(nodes.values()), np.uint64)
    found = simhash.forest_links(fps, 4)
    assert len(found) < len(fps) and all(within(4)(nodes[a], nodes[b]) for a, b in found)
    joined = plain_components(nodes, lambda a, b: False)
    for a, b in found:
        lo, hi = sorted((joined[a], joined[b]))
        joined = {i: lo if r == hi else r for i, r in joined.items()}
    assert joined == plain_components(nodes, within(4))


def test_small_keys_name_every_link(monkeypatch):
    keys, fps = np.array([1, 1, 1, 2, 2, 3]), np.array([0, 1, 2**40 - 1, 0, 0, 0])
    a, b = simhash.small_key_links(keys, fps, 4)
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 1), (3, 4)]


def test_components_of_odd_edges(spark):
    edges = [(5, 4), (4, 5), (4, 4), (1, 9), (9, 7), (7, 3), (None, 3), (3, None)] + [(100, i) for i in range(101, 140)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {5: 4, 4: 4, 1: 1, 9: 1, 7: 1, 3: 1, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(3).shuffle(order)
    chain = spark.createDataFrame(list(zip(order, order[1:])), "a bigint, b bigint")
    assert {r.root for r in components(chain).collect()} == {0}


def test_odd_rows(spark):
    text = "one two three four five six"
    rows = [(3, None), (1, ""), (2, " "), (None, text), (7, text), (7, text), (5, text.upper()), (9, "other words here now")]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    groups = simhash.simhash_groups(docs)
    assert sorted(((r.doc_id, r.component_id) for r in groups.collect()), key=str) == sorted(
        [(3, 1), (1, 1), (2, 1), (None, None), (7, 5), (7, 5), (5, 5), (9, 9)], key=str)
    kept = simhash.keep_first(docs, groups)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 5, 9, None]
    twice = simhash.keep_first(docs.filter("doc_id = 7"), simhash.simhash_groups(docs.filter("doc_id = 7")))
    assert [r.doc_id for r in twice.collect()] == [7]
    empty = simhash.simhash_groups(docs.limit(0))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.count() == 0


def test_repeated_ids_of_unlike_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (7, a), (7, b), (7, b), (8, b), (5, c), (5, b + " end"), (9, c), (9, ""), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for given in (docs, docs.filter("doc_id > 5"), docs.filter("doc_id <> 5")):
        groups = simhash.simhash_groups(given, first_col="first").collect()
        texts = [r.text for r in given.collect()]
        groups = spark.createDataFrame(groups, "doc_id bigint, fingerprint string, component_id bigint, first boolean")
        kept = simhash.keep_first(given, groups, first_col="first").collect()
        # One text of each group of near copies stays; a, b, c and the blank text are unlike.
        kinds = lambda found: sorted({(t or " ")[0] for t in found})
        assert kinds(r.text for r in kept) == kinds(texts) and len(kept) == len(kinds(texts))
    assert simhash.simhash_groups(docs.filter("doc_id = 7")).select("component_id").distinct().count() == 1


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    nodes = {i: plain_fingerprint(t) for i, t in zip(docs.doc_id, docs.text)}
    want = plain_components(nodes, within(4))
    got = simhash.simhash_groups(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{nodes[i]:016x}", want[i]) for i in nodes}
