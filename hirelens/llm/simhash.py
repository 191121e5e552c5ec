"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into so few segments that one of them differs by at most one bit between any two
linked fingerprints.  Each segment is indexed once per bit with that bit wild; linked fingerprints
meet under at least one equal key and are verified there.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from hirelens.llm.common import byte_slices, byte_steps, free_name, stage, table_join
from hirelens.llm.components import components
from hirelens.operators.lookup import fits_broadcast

SEED = 42
BITS = 64
# Members of one key that one task verifies at a time; larger keys are dealt out as tiles.
TILE = 32_768
# Up to this size all pairs of a key are compared at once, beyond it by balls around pivots.
SMALL = 32
# Shingles hashed in one step.
STEP_SHINGLES = 65_536


def segments(distance: int) -> list[tuple[int, int]]:
    """``(shift, width)`` of the fewest segments of which one differs by at most one bit within ``distance``."""
    n = max(2, distance // 2 + 1)  # two at least, so that a segment and its wild bit fit one long
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


# ---- fingerprints ----


def fingerprint(text: bytes | None, shingle_words: int) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and white space is exactly 20 and 09-0D
    if not words:
        return 0
    width = min(shingle_words, len(words))
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts[width - 1 :] + lengths[width - 1 :]
    n, ones, hash64 = len(ends), np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, STEP_SHINGLES):
        spans = zip(starts[at : min(at + STEP_SHINGLES, n)].tolist(), ends[at : at + STEP_SHINGLES].tolist())
        hashes = np.array([hash64(joined[a:b], SEED) for a, b in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_steps(batches, "text"):
            made = [fingerprint(t, shingle_words) for t in part.column("text").cast(pa.binary()).to_pylist()]
            fps = pa.array(np.array(made, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("id"), fps], names=["id", "fp"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(hashed, "id bigint, fp bigint")


# ---- links ----


def _distances(fps: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count((fps ^ other).view(np.uint64))  # of signed numbers it would count the absolute value


def small_key_links(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked rows with equal keys; rows are sorted by key, no key has more than SMALL rows."""
    left, right = [], []
    for off in range(1, SMALL):
        near = np.flatnonzero(keys[off:] == keys[:-off])
        if not len(near):
            break
        near = near[_distances(fps[near], fps[near + off]) <= distance]
        left.append(near)
        right.append(near + off)
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def forest_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join rows exactly as all links within ``distance`` would, fewer than rows.

    Rows near a pivot form a ball and are joined to the pivot.  Two balls are compared only if their pivots
    are within three distances and nothing has joined them yet; one link found is enough.
    """
    links, balls, rest = [], [], np.arange(len(fps))
    while len(rest):
        near = _distances(fps[rest], fps[rest[0]]) <= distance
        balls.append(rest[near])
        links += [(int(rest[0]), int(i)) for i in balls[-1][1:]]
        rest = rest[~near]
    pivots, owner = fps[[b[0] for b in balls]], list(range(len(balls)))

    def root(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for i, ball in enumerate(balls):
        for j in (i + 1 + np.flatnonzero(_distances(pivots[i + 1 :], pivots[i]) <= 3 * distance)).tolist():
            if root(i) == root(j):
                continue
            small, large = sorted((ball, balls[j]), key=len)
            for k in small.tolist():
                near = np.flatnonzero(_distances(fps[large], fps[k]) <= distance)
                if len(near):
                    links.append((k, int(large[near[0]])))
                    owner[root(i)] = root(j)
                    break
    return links


def _linked(distance: int):
    """Arrow function over rows sorted by (key, tile): verified links of every key, as a forest for large ones."""

    def links_of(keys: np.ndarray, fps: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1, append=keys[-1] + 1)) if len(keys) else np.zeros(1, int)
        sizes = np.diff(cuts)
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        at = np.flatnonzero(small)
        a, b = small_key_links(keys[at], fps[at], distance)
        left, right = [ids[at[a]]], [ids[at[b]]]
        for k in np.flatnonzero(sizes > SMALL).tolist():
            found = np.array(forest_links(fps[cuts[k] : cuts[k + 1]], distance), np.int64).reshape(-1, 2) + cuts[k]
            left.append(ids[found[:, 0]])
            right.append(ids[found[:, 1]])
        left, right = np.concatenate(left), np.concatenate(right)
        if len(left):
            left, right = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            rows = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("key", "fp", "id"))]
            if not len(rows[0]):
                continue
            # The last key may go on in the next batch.
            others = np.flatnonzero(rows[0] != rows[0][-1])
            done = int(others[-1]) + 1 if len(others) else 0
            yield links_of(rows[0][:done], rows[1][:done], rows[2][:done])
            held = [r[done:] for r in rows]
        yield links_of(*held)

    return run


def variants(distinct: DataFrame, distance: int) -> DataFrame:
    """``(key, id, fp)``: one row per fingerprint and wild bit; the key holds the bit and the rest of its segment."""
    rows = distinct.select("id", "fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    key = F.lit(None).cast("long")
    for lo, width in segments(distance):  # the last segment that starts at or below the bit holds it
        part = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1))
        wild = F.expr(f"~shiftleft(1L, bit - {lo})")
        key = F.when(F.col("bit") >= lo, _tagged(F.col("bit"), part.bitwiseAND(wild))).otherwise(key)
    return rows.select(key.alias("key"), "id", "fp")


def _tagged(bit, value):
    return F.shiftleft(bit.cast("long"), 57).bitwiseOR(value)


def links(distinct: DataFrame, distance: int, tile: int = TILE) -> DataFrame:
    """``(a, b)``: links between the rows of ``distinct (id, fp)``, enough to join all that are within ``distance``.

    Keys with more than ``tile`` members are cut into blocks that meet pairwise, so no task holds more than
    two blocks.  Whether there are such keys is counted first, on one row per segment.
    """
    keyed = variants(distinct, distance)
    cut = segments(distance)
    parts = F.array(*[
        F.struct(F.lit(lo).alias("lo"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << w) - 1)).alias("v"))
        for lo, w in cut
    ])
    counted = distinct.select(F.explode(parts).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    hot = stage(counted.filter(F.col("n") > tile // 2), "hot_segments")
    if hot.isEmpty():
        tiled = keyed.withColumn("row", F.lit(0)).withColumn("col", F.lit(0))
    else:
        tiled = _tiles(keyed, hot, dict(cut), tile)
    ordered = tiled.repartition("key", "row", "col").sortWithinPartitions("key", "row", "col")
    # One number per key and tile: the function below sees the tiles of a key as keys of their own.
    named = ordered.select(
        F.when((F.col("row") == 0) & (F.col("col") == 0), F.col("key")).otherwise(
            F.xxhash64("key", "row", "col")
        ).alias("key"), "id", "fp",
    )
    return named.mapInArrow(_linked(distance), "a bigint, b bigint").distinct()


def _tiles(keyed: DataFrame, hot: DataFrame, widths: dict[int, int], tile: int) -> DataFrame:
    """Repeat the members of hot keys once per tile of their block; other keys stay as they are."""
    bits = F.explode(F.expr(" ".join(
        ["CASE s.lo"] + [f"WHEN {lo} THEN sequence({lo}, {lo + w - 1})" for lo, w in widths.items()] + ["END"]
    )))
    keys = hot.select("s", "n", bits.alias("bit")).select(
        _tagged(F.col("bit"), F.expr("s.v & ~shiftleft(1L, bit - s.lo)")).alias("key"), "n"
    )
    # A neighbour value below the bound is not listed; it adds half a tile at most.
    blocks = keys.groupBy("key").agg(F.ceil((F.sum("n") + tile // 2) / F.lit(tile / 2)).cast("int").alias("k"))
    small = F.broadcast(blocks) if fits_broadcast(blocks) else blocks
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    cut = keyed.join(small, "key", "left").withColumn("k", F.coalesce("k", F.lit(1))).withColumn("own", own)
    every = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    return cut.withColumn("other", every).select(
        "key", "id", "fp", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col")
    )


# ---- the operator ----


def simhash_groups(docs: DataFrame, shingle_words: int = 4, distance: int = 4, id_col: str = "doc_id",
                   text_col: str = "text", tile: int = TILE, first_col: str | None = None) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links of at most ``distance`` bits.  A
    null or blank text has fingerprint zero and is linked like any other; repeated rows come back as
    often as they are given; a row with a null id joins nothing (null component).  Other columns
    are ignored, an empty table gives an empty result.

    Texts that share nothing but an id are not linked; their components may then have the same smallest id.  With
    ``first_col`` a column tells whether the row has the smallest id and fingerprint of its component.
    """
    fps = stage(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    # Equal fingerprints are one node, named by its smallest id, or by itself where an id is the smallest of several.
    distinct = stage(fps.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("id")), "distinct_fps")
    if distinct.groupBy("id").count().filter("count > 1").isEmpty():
        roots = components(links(distinct, distance, tile))
        named = distinct.join(roots, distinct["id"] == roots["node"], "left").select(
            "fp", F.coalesce("root", "id").alias("component_id"), F.col("fp").alias("first_fp")
        )
    else:
        roots = components(links(distinct.select(F.col("fp").alias("id"), "fp"), distance, tile))
        rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "id", F.coalesce("root", "fp").alias("root")
        )
        rooted = stage(rooted, "rooted_fps")
        firsts = stage(rooted.groupBy("root").agg(F.min(F.struct("id", "fp")).alias("first")), "first_fps")
        named = table_join(rooted.select("fp", "root"), firsts, ["root"]).select(
            "fp", F.col("first.id").alias("component_id"), F.col("first.fp").alias("first_fp")
        )
    component = F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")
    first = (F.col("id") == F.col("component_id")) & (F.col("fp") == F.col("first_fp"))
    return fps.join(named, "fp", "left").select(
        F.col("id").alias(id_col), _hex(F.col("fp")).alias("fingerprint"), component,
        *([first.alias(first_col)] if first_col else []),
    )


def _hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _fingerprint_of(text: Column, shingle_words: int) -> Column:
    def hashed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            made = [fingerprint(t, shingle_words) for part in byte_slices(texts) for t in part.cast(pa.binary()).to_pylist()]
            yield pa.array(np.array(made, np.uint64).view(np.int64))

    return _hex(F.arrow_udf(hashed, "bigint")(text))


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = 4, first_col: str | None = None) -> DataFrame:
    """One row of ``docs`` for every group, one with the smallest id and fingerprint; rows without an id stay.

    ``first_col`` names the column of ``groups`` that tells these rows; without it they are those whose id is that of
    the group.  The ids to drop are broadcast if they fit, otherwise both sides meet by a shuffle.  Repeated ids are
    counted first; only their rows are brought together.  Rows of an id with several fingerprints are told apart
    by the fingerprint (of ``shingle_words``), so one may stay for each.
    """
    first = F.col(first_col) if first_col else F.col(id_col) == F.col("component_id")
    marked = groups.filter(F.col(id_col).isNotNull()).select(F.col(id_col), "fingerprint", first.alias("first"))
    of_id = marked.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n"), (F.min("fingerprint") < F.max("fingerprint")).alias("mixed"))
    repeated = stage(of_id.filter("n > 1").select(id_col, "mixed"), "repeated_ids")
    dropped = stage(marked.filter("NOT first").select(id_col).distinct(), "dropped_ids")
    if repeated.isEmpty():
        return table_join(docs, dropped, [id_col], "left_anti")
    alike = stage(repeated.filter("NOT mixed").select(id_col), "alike_ids")
    mixed = stage(repeated.filter("mixed").select(id_col), "mixed_ids")
    rows = table_join(docs, mixed, [id_col], "left_anti")
    kept = table_join(rows, dropped, [id_col], "left_anti")
    once = table_join(kept, alike, [id_col], "left_semi").dropDuplicates([id_col]).select(*docs.columns)
    kept = table_join(kept, alike, [id_col], "left_anti").unionByName(once)
    if mixed.isEmpty():
        return kept
    name = free_name("_fingerprint", docs.columns)
    firsts = table_join(marked.filter("first"), mixed, [id_col], "left_semi")
    firsts = stage(firsts.select(id_col, F.col("fingerprint").alias(name)).distinct(), "mixed_firsts")
    own = table_join(docs, mixed, [id_col], "left_semi")
    own = own.withColumn(name, _fingerprint_of(own[text_col], shingle_words))
    own = table_join(own, firsts, [id_col, name], "left_semi").dropDuplicates([id_col, name])
    return kept.unionByName(own.select(*docs.columns))
