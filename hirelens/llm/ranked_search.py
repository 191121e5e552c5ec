"""Ranked lexical search by pipelined term partitioning.

Every document is cut into terms once; the terms of the searched items are kept with their counts, in blocks of
neighbouring documents.  Terms have owners: rare terms, which weigh most, the first, frequent ones the last, about
equal numbers of postings each.  A bundle holds a group of items and one block, with the sparse scores of its documents.  It
passes the owners one after another: at each, a cogroup brings it together with that owner's postings of its block, and
the whole-number contributions are added.  After each owner a bundle drops the documents that cannot be among the
best any more: those whose score and all that later owners could add in this block stay below the k-th score so far.
Nothing else is dropped, so the result is exact.  The last owner's bundles give their best to the final selection.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hirelens.llm.common import byte_steps, stage

OWNERS = 4
# A block ends at so many documents or postings; with the group size this bounds a bundle.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 400_000
GROUP_ITEMS = 512
# Terms, and pairs of item and term, that are sent to every task.  A larger set of items takes several passes.
MAX_TERMS, MAX_PAIRS = 500_000, 2_000_000

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The same for UTF-8 bytes: capitals become small, all ASCII signs become blanks.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

BUNDLE = "block bigint, grp int, n_docs int, open binary, sizes binary, docs binary, scores binary"


def terms_of(raw: bytes) -> list[bytes]:
    """All terms of a text in UTF-8, in order, repeats included."""
    return raw.translate(_FOLD).split()


@dataclass
class Items:
    """The searched items: their ids, the terms of all (sorted), and each item's term numbers."""

    ids: list
    terms: list[bytes]
    members: list[np.ndarray]
    group: int = GROUP_ITEMS  # items of one bundle
    dealt: dict = field(default_factory=dict)

    def owned(self, owner: np.ndarray, grp: int) -> list[list[np.ndarray]]:
        """Per owner, the terms of every item of a group that it owns; kept by the worker."""
        if grp not in self.dealt:
            inside = self.members[grp * self.group : (grp + 1) * self.group]
            self.dealt[grp] = [[m[owner[m] == o] for m in inside] for o in range(OWNERS)]
        return self.dealt[grp]

    @property
    def groups(self) -> int:
        return math.ceil(len(self.ids) / self.group)


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term)``, each pair once; rows of one id are one item."""
    folded = F.translate(items[text_col], _UPPER, _LOWER)
    found = F.explode(F.regexp_extract_all(folded, F.lit(_TERM), F.lit(0)))
    return items.select(items[id_col].alias("id"), found.alias("term")).distinct()


def _collected(pairs: DataFrame) -> Items:
    table = pairs.orderBy(F.col("id").asc_nulls_last(), "term").toArrow()
    ids, terms = table.column("id").to_pylist(), table.column("term").to_pylist()
    numbered = {t: i for i, t in enumerate(sorted(set(terms)))}
    members: dict[object, list[int]] = {}
    for i, t in zip(ids, terms):
        members.setdefault(i, []).append(numbered[t])
    return Items(list(members), [t.encode() for t in numbered], [np.array(m, np.int64) for m in members.values()], GROUP_ITEMS)


# ---- the documents as counted terms ----


def counted_terms(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """``(block, at, id, n, terms, tfs)``: every document with a term, its number of terms, and counts of the items' terms."""
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(items.terms)})
    names, block_docs, block_postings = ["block", "at", "id", "n", "terms", "tfs"], BLOCK_DOCS, BLOCK_POSTINGS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, most = known.value.get, max(len(known.value), 1)
        block, at, postings = TaskContext.get().partitionId() << 32, 0, 0
        for part in byte_steps(batches, "text"):
            lengths, found = [], []
            for raw in part.column("text").to_pylist():
                terms = terms_of(raw)
                lengths.append(len(terms))
                found.append(np.array([i for i in map(number, terms) if i is not None], np.int64))
            rows = np.flatnonzero(lengths)
            owners = np.repeat(np.arange(len(found)), [len(f) for f in found])
            keys, tfs = np.unique(owners * most + np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
            doc, term = np.divmod(keys, most)
            ends = np.searchsorted(doc, rows, "right")
            starts = np.searchsorted(doc, rows, "left")
            blocks, places = [], []
            for size in (ends - starts).tolist():
                if at >= block_docs or postings >= block_postings:
                    block, at, postings = block + 1, 0, 0
                blocks.append(block)
                places.append(at)
                at, postings = at + 1, postings + size
            if len(rows):
                # Terms of documents without any are not there, so the kept ones follow one another.
                offsets = pa.array(np.append(starts, ends[-1]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks, pa.int64()), pa.array(places, pa.int32()), part.column("id").take(pa.array(rows)),
                    pa.array(np.array(lengths)[rows], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ], names=names)

    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"block bigint, at int, id {kind}, n bigint, terms array<int>, tfs array<int>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def owners_of(weight: np.ndarray, df: np.ndarray) -> np.ndarray:
    """The owner of every term: in order of falling weight, with about equal numbers of postings."""
    order = np.lexsort((np.arange(len(df)), -weight))
    before = np.cumsum(df[order]) - df[order]
    owner = np.zeros(len(df), np.int64)
    owner[order] = np.minimum(before * OWNERS // max(int(df.sum()), 1), OWNERS - 1)
    return owner


def _postings(counted: DataFrame, shared, stage_no: int, groups: int) -> DataFrame:
    """What one owner holds of every block, once per group of items: its postings sorted by term, the largest
    contribution of every term that later owners hold, and for the last owner the ids of the documents."""
    last = stage_no == OWNERS - 1
    names = ["block", "grp", "terms", "docs", "scores", "later_terms", "later_most", "places", "ids"]
    id_type = to_arrow_type(counted.schema["id"].dataType)
    kind = counted.schema["id"].dataType.simpleString()

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, weight, owner, _ = shared.value
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                norms = np.array([8 * (10 + 90 * n * n_docs // n_terms) for n in part.column("n").to_pylist()], np.int64)
                places = part.column("at").to_numpy()
                sizes = np.diff(part.column("terms").offsets.to_numpy())
                term = part.column("terms").flatten().to_numpy()
                tf = part.column("tfs").flatten().to_numpy().astype(np.int64)
                score = weight[term] * (1_000_000_000 * tf // (1000 * tf + np.repeat(norms, sizes)))
                doc, holder = np.repeat(places, sizes), owner[term]
                here = np.flatnonzero(holder == stage_no)
                here = here[np.argsort(term[here], kind="stable")]
                later = np.flatnonzero(holder > stage_no)
                later_terms, of = np.unique(term[later], return_inverse=True)
                most = np.zeros(len(later_terms), np.int64)
                np.maximum.at(most, of, score[later])
                binary = [term[here].astype("<i4"), doc[here].astype("<i4"), score[here], later_terms.astype("<i4"), most,
                          places.astype("<i4") if last else places[:0]]
                ids = part.column("id").to_pylist() if last else []
                for grp in range(groups):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(blocks[a])], pa.int64()), pa.array([grp], pa.int32()),
                         *[pa.array([x.tobytes()], pa.binary()) for x in binary], pa.array([ids], pa.list_(id_type))], names=names)

    columns = "terms binary, docs binary, scores binary, later_terms binary, later_most binary, places binary"
    return counted.mapInArrow(post, f"block bigint, grp int, {columns}, ids array<{kind}>")


# ---- bundles ----


def _joined(table: pa.Table, column: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype)


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All term numbers one after another, and where each item's begin and end."""
    return np.concatenate([*lists, np.zeros(0, np.int64)]), np.cumsum([0, *map(len, lists)])


def _summed(wanted: list[np.ndarray], terms: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per item the sum over its terms of the largest value of each; a term repeats where a block was read in parts."""
    if not len(terms):
        return np.zeros(len(wanted), np.int64)
    distinct, of = np.unique(terms, return_inverse=True)
    most = np.zeros(len(distinct), np.int64)
    np.maximum.at(most, of, values)
    flat, ends = _flat(wanted)
    at = np.minimum(np.searchsorted(distinct, flat), len(distinct) - 1)
    sums = np.cumsum([0, *np.where(distinct[at] == flat, most[at], 0)])
    return sums[ends[1:]] - sums[ends[:-1]]


def _advance(items: Items, owner: np.ndarray, stage_no: int, top: int, left: pa.Table, right: pa.Table):
    """Add one owner's contributions to a bundle; yields ``(item, documents, scores, open)`` per item of the group.

    ``open`` tells whether a document without a score so far may still be among the best.
    """
    bundle = left.slice(0, 1).to_pylist()[0]
    owned = items.owned(owner, bundle["grp"])
    is_open = np.frombuffer(bundle["open"], bool)
    ends = np.cumsum(np.frombuffer(bundle["sizes"], "<i4"))
    docs, scores = np.frombuffer(bundle["docs"], "<i4"), np.frombuffer(bundle["scores"], "<i8")
    terms, places, added = _joined(right, "terms", "<i4"), _joined(right, "docs", "<i4"), _joined(right, "scores", "<i8")
    if right.num_rows > 1:
        order = np.argsort(terms, kind="stable")
        terms, places, added = terms[order], places[order], added[order]
    later = [np.concatenate([owned[o][i] for o in range(stage_no + 1, OWNERS)] or [np.zeros(0, np.int64)]) for i in range(len(is_open))]
    rest = _summed(later, _joined(right, "later_terms", "<i4"), _joined(right, "later_most", "<i8"))
    total = np.zeros(bundle["n_docs"], np.int64)
    wanted, cuts = _flat(owned[stage_no])
    starts, stops = np.searchsorted(terms, wanted, "left").tolist(), np.searchsorted(terms, wanted, "right").tolist()
    for i in range(len(is_open)):
        a, b = (ends[i - 1] if i else 0), ends[i]
        total[:] = 0
        total[docs[a:b]] = scores[a:b]
        for lo, hi in zip(starts[cuts[i] : cuts[i + 1]], stops[cuts[i] : cuts[i + 1]]):
            total[places[lo:hi]] += added[lo:hi]  # a document stands once among the postings of a term
        held = np.flatnonzero(total) if is_open[i] else docs[a:b]
        still = is_open[i]
        if len(held) >= top:
            least = np.partition(total[held], len(held) - top)[len(held) - top]
            held = held[total[held] + rest[i] >= least]
            still = still and rest[i] >= least
        yield i, held, total[held], still


def _best(found: np.ndarray, scores: np.ndarray, ids: list, top: int) -> list[int]:
    """Places in ``found`` of the best: by falling score, then rising id, nulls last."""
    order = np.argsort(-scores, kind="stable")
    if len(order) > top:
        order = order[scores[order] >= scores[order[top - 1]]]
    ranked = sorted(order.tolist(), key=lambda j: (-scores[j], ids[found[j]] is None, ids[found[j]]))
    return ranked[:top]


def _search(docs: DataFrame, pairs: DataFrame, top: int, id_col: str, text_col: str, item_type) -> DataFrame:
    """``(item, id, score)``: the best of every block for all items of one pass."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    items = _collected(pairs)
    counted = stage(counted_terms(docs, items, id_col, text_col), "counted")
    kind, item_kind = counted.schema["id"].dataType.simpleString(), item_type.simpleString()
    out = f"item {item_kind}, id {kind}, score bigint"
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not items.ids:
        return spark.createDataFrame([], out)
    df = np.zeros(len(items.terms), np.int64)
    seen = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df[seen.column("term").to_numpy()] = seen.column("df").to_numpy()
    weight = weights(n_docs, df)
    owner = owners_of(weight, df)
    shared = sc.broadcast((n_docs, n_terms, weight, owner, items))

    blocks = counted.groupBy("block").agg((F.max("at") + 1).alias("n_docs"))
    groups = blocks.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(items.groups - 1))))
    held = F.least(F.lit(items.group), F.lit(len(items.ids)) - F.col("grp") * items.group).cast("int")
    empty = F.lit(b"")
    bundles = groups.select(
        "block", "grp", F.col("n_docs").cast("int").alias("n_docs"), F.encode(F.repeat(F.lit("\x01"), held), "utf-8").alias("open"),
        F.encode(F.repeat(F.lit("\x00" * 4), held), "utf-8").alias("sizes"), empty.alias("docs"), empty.alias("scores"),
    )

    def step(stage_no: int):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            *_, owner, items = shared.value
            parts = list(_advance(items, owner, stage_no, top, left, right))
            row = left.slice(0, 1).select(["block", "grp", "n_docs"]).to_pylist()[0]
            row["open"] = np.array([p[3] for p in parts], bool).tobytes()
            row["sizes"] = np.array([len(p[1]) for p in parts], "<i4").tobytes()
            row["docs"] = b"".join(p[1].astype("<i4").tobytes() for p in parts)
            row["scores"] = b"".join(p[2].astype("<i8").tobytes() for p in parts)
            return pa.Table.from_pylist([row], schema=bundle_schema)

        return run

    def select(left: pa.Table, right: pa.Table) -> pa.Table:
        *_, owner, items = shared.value
        ids: list = [None] * left.column("n_docs")[0].as_py()
        for place, i in zip(_joined(right, "places", "<i4").tolist(), [i for row in right.column("ids").to_pylist() for i in row]):
            ids[place] = i
        first = left.column("grp")[0].as_py() * items.group
        rows = []
        for i, found, scores, _ in _advance(items, owner, OWNERS - 1, top, left, right):
            rows += [(items.ids[first + i], ids[found[j]], int(scores[j])) for j in _best(found, scores, ids, top)]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema)], schema=out_schema)

    bundle_schema = pa.schema([("block", pa.int64()), ("grp", pa.int32()), ("n_docs", pa.int32()), ("open", pa.binary()),
                               ("sizes", pa.binary()), ("docs", pa.binary()), ("scores", pa.binary())])
    out_schema = pa.schema([("item", to_arrow_type(item_type)), ("id", to_arrow_type(counted.schema["id"].dataType)), ("score", pa.int64())])
    for stage_no in range(OWNERS):
        both = bundles.groupBy("block", "grp").cogroup(_postings(counted, shared, stage_no, items.groups).groupBy("block", "grp"))
        if stage_no == OWNERS - 1:
            return both.applyInArrow(select, out)
        bundles = stage(both.applyInArrow(step(stage_no), BUNDLE), "bundles")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item, rank, id, score)``: the ``top`` documents with the highest scores above 0 for each item.

    A score is the sum over the item's terms, once each, of weight times saturated frequency, in whole numbers
    (see ``weights`` and ``_postings``).  Equal scores rank by rising id, null ids last.  Repeated document rows are
    documents of their own; item rows with equal ids, null included, are one item with the terms of all.  Null and empty texts have no
    terms; an item without terms, or whose terms no document holds, has no rows; empty tables give an empty result.
    Other columns are ignored.  Items whose terms exceed ``MAX_TERMS`` or ``MAX_PAIRS`` are searched in several
    passes, a hashed share of the items each.
    """
    pairs = stage(_item_terms(items, item_col, item_text_col), "items")
    n_pairs, n_terms = pairs.agg(F.count(F.lit(1)), F.count_distinct("term")).first()
    passes = max(math.ceil(n_pairs / MAX_PAIRS), math.ceil(n_terms / MAX_TERMS), 1)
    found = None
    for i in range(passes):
        part = pairs.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == i) if passes > 1 else pairs
        made = _search(docs, part, top, id_col, text_col, pairs.schema["id"].dataType)
        found = made if found is None else found.unionByName(made)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
