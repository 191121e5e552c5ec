"""Near-duplicate embeddings by exact tiled comparison in principal-component order.

Vectors are turned so that the leading dimensions carry most of the variance.  Tiles of two blocks of the same
label accumulate the product dimension by dimension group; what the rest can still add is bounded by
the norms of the suffixes, and rows and columns that cannot reach the threshold any more drop out.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hirelens.llm.common import stage
from hirelens.llm.components import components
from hirelens.operators.lookup import fits_broadcast

BLOCK = 2048  # vectors of one side of a tile
SUB = 512  # rows compared at once inside a tile
STEP = 16  # dimensions accumulated between two bounds
SLACK = 1e-9  # the bounds err on the safe side; pairs that pass them are computed again exactly


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, vector)`` with vectors in double precision; null for those that link with nothing.

    These are null, empty or zero vectors, vectors with null, NaN or infinite components or without an id or label.
    """
    wide = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"), wide.alias("vector"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = usable & F.exists("vector", lambda x: x != 0) & F.col("id").isNotNull() & F.col("label").isNotNull()
    return rows.withColumn("vector", F.when(F.coalesce(usable, F.lit(False)), F.col("vector")))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the orthogonal axes by falling variance.

    Each task sums its second moments, the sums of all tasks are added up cell by cell, and one square matrix
    per length comes to the driver: what meets there is bounded by the dimensions, not by the vectors.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, block in _by_length(batch):
                sums[size] = sums.get(size, 0.0) + block.T @ block
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.ravel().tolist() for s in sums.values()], pa.list_(pa.float64()))],
            names=["size", "sums"])

    made = vectors.select("vector").mapInArrow(moments, "size int, sums array<double>")
    cells = made.select("size", F.posexplode("sums").alias("cell", "value")).groupBy("size", "cell").agg(F.sum("value").alias("v"))
    grids: dict[int, np.ndarray] = {}
    for r in cells.collect():
        grids.setdefault(r["size"], np.zeros(r["size"] ** 2))[r.cell] = r.v
    return {n: np.ascontiguousarray(np.linalg.eigh(g.reshape(n, n))[1][:, ::-1]) for n, g in grids.items()}


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, rows, unit vectors)`` for each vector length in a batch."""
    column = batch.column(batch.schema.get_field_index("vector"))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        block = column.take(pa.array(rows)).flatten().to_numpy().reshape(-1, size)
        # Largest component first: no square can overflow or vanish.
        block = block / np.abs(block).max(axis=1, keepdims=True)
        yield int(size), rows, block / np.linalg.norm(block, axis=1, keepdims=True)


# ---- tiles ----


def near_pairs(left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float,
               same: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """``(rows, columns)`` of pairs of unit vectors with cosine of at least ``threshold``, a part at a time.

    With ``same`` both sides are one block: each pair comes once, the smaller row first.
    """
    turned, other = left @ axes, right @ axes
    size = axes.shape[0]
    cuts = list(range(0, size, STEP)) + [size]
    rest_l = np.sqrt(np.cumsum(turned[:, ::-1] ** 2, axis=1)[:, ::-1])
    rest_r = np.sqrt(np.cumsum(other[:, ::-1] ** 2, axis=1)[:, ::-1])
    for top in range(0, len(left), SUB):
        for side in range(top if same else 0, len(right), SUB):
            rows, cols = np.arange(top, min(top + SUB, len(left))), np.arange(side, min(side + SUB, len(right)))
            sums = np.zeros((len(rows), len(cols)))
            for lo, hi in zip(cuts, cuts[1:]):
                sums += turned[rows, lo:hi] @ other[cols, lo:hi].T
                if hi == size:
                    break
                open_ = sums + rest_l[rows, hi][:, None] * rest_r[cols, hi] >= threshold - SLACK
                keep_rows, keep_cols = open_.any(axis=1), open_.any(axis=0)
                if keep_rows.all() and keep_cols.all():
                    continue
                rows, cols, sums = rows[keep_rows], cols[keep_cols], sums[np.ix_(keep_rows, keep_cols)]
                if not len(rows):
                    break
            if len(rows):
                at, to = np.nonzero(sums >= threshold - SLACK)
                at, to = rows[at], cols[to]
                exact = np.einsum("ij,ij->i", left[at], right[to]) >= threshold
                if same:
                    exact &= at < to
                yield at[exact], to[exact]


def tile_links(ids: np.ndarray, other_ids: np.ndarray | None, left: np.ndarray, right: np.ndarray, axes: np.ndarray,
               threshold: float) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Links per vector, and edges that join the vectors of the tile as its links do, fewer than vectors."""
    names = ids if other_ids is None else np.concatenate([ids, other_ids])
    shift = 0 if other_ids is None else len(ids)
    counts, owner = np.zeros(len(names), np.int64), np.arange(len(names))
    edges: list[tuple[int, int]] = []

    def root(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for rows, cols in near_pairs(left, right, axes, threshold, same=other_ids is None):
        cols = cols + shift
        counts += np.bincount(rows, minlength=len(names)) + np.bincount(cols, minlength=len(names))
        while len(rows):
            apart = owner[rows] != owner[cols]
            rows, cols = rows[apart], cols[apart]
            _, first = np.unique(rows, return_index=True)
            for a, b in zip(rows[first].tolist(), cols[first].tolist()):
                x, y = root(a), root(b)
                if x != y:
                    owner[max(x, y)] = min(x, y)
                    edges.append((int(names[a]), int(names[b])))
            owner = _flat(owner)
    linked = np.flatnonzero(counts)
    return dict(zip(names[linked].tolist(), counts[linked].tolist())), edges


def _flat(owner: np.ndarray) -> np.ndarray:
    """All nodes pointing at their roots."""
    while True:
        up = owner[owner]
        if (up == owner).all():
            return owner
        owner = up


def _tiles(vectors: DataFrame, block: int) -> DataFrame:
    """Vectors repeated once per tile: ``(label, size, row, col, id, vector)``.

    Labels are cut into blocks of about ``block`` vectors by a hash of the id; a hot label has more blocks,
    not larger ones.
    """
    sized = vectors.withColumn("size", F.size("vector"))
    counts = sized.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    counts = stage(counts, "label_blocks")
    cut = sized.join(F.broadcast(counts) if fits_broadcast(counts) else counts, ["label", "size"])
    cut = cut.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return cut.withColumn("other", every).select(
        "label", "size", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"),
        (F.col("own") > F.col("other")).alias("second"), "id", "vector",
    )


def links(vectors: DataFrame, threshold: float, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(id, n)`` link counts and ``(a, b)`` joining edges of usable vectors ``(id, label, vector)``, ids unique."""
    axes = vectors.sparkSession.sparkContext.broadcast(principal_axes(vectors))
    keys = ["label", "size", "row", "col"]
    dealt = _tiles(vectors, block).repartition(*keys).sortWithinPartitions(*keys, "second", "id")
    # Labels of any type: a tile is told from its neighbours by a number.
    named = dealt.select(F.xxhash64(*keys).alias("tile"), "second", (F.col("row") == F.col("col")).alias("own"), "id", "vector")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids, second = rows.column("id").to_numpy(), rows.column("second").to_numpy(zero_copy_only=False)
            ((size, _, unit),) = _by_length(rows)
            a, b = np.flatnonzero(~second), np.flatnonzero(second)
            if rows.column("own")[0].as_py():
                counts, edges = tile_links(ids, None, unit, unit, axes.value[size], threshold)
            else:
                counts, edges = tile_links(ids[a], ids[b], unit[a], unit[b], axes.value[size], threshold)
            found = [(i, n, None, None) for i, n in counts.items()] + [(None, None, x, y) for x, y in edges]
            columns = list(zip(*found)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "n", "a", "b"])

        for batch in batches:
            tiles = batch.column("tile").to_numpy()
            for cut in np.split(np.arange(len(tiles)), np.flatnonzero(np.diff(tiles)) + 1):
                if not len(cut):
                    continue
                if held and held[0].column("tile")[0].as_py() != tiles[cut[0]]:
                    yield done()
                    held = []
                held.append(batch.slice(int(cut[0]), len(cut)))
        if held:
            yield done()

    found = stage(named.mapInArrow(compare, "id bigint, n bigint, a bigint, b bigint"), "tile_links")
    counts = found.filter("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n"))
    return counts, found.filter("a IS NOT NULL").select("a", "b")


# ---- the operator ----


def embedding_groups(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row.

    Two vectors of the same label (not null) and length link if their cosine in double precision is at least
    ``threshold`` (over 0).  ``component_id`` is the smallest id that can be reached over links, ``kept`` marks
    it.  Null, empty, zero and non-finite vectors and rows without id or label link with nothing and are kept (null
    ids: null component, not kept).  Repeated ids: equal rows are one vector, reported as often as given; of
    different rows with one id the smallest by label and vector counts.  Other columns are ignored.
    """
    if threshold <= 0:
        raise ValueError("the bounds need a threshold over 0")
    rows = unit_vectors(vectors, id_col, vector_col, label_col)
    usable = rows.filter("vector IS NOT NULL").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("v"))
    usable = stage(usable.select("id", "v.label", "v.vector"), "unit_vectors")
    counts, edges = links(usable, threshold, block)
    roots = components(edges)
    named = rows.select("id").join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("root", "id")
    return named.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
