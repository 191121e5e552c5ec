"""Mixing sources to target weights by drawing fixed-length blocks of words.

The documents of a source stand one after another, in a pseudorandom order, and are cut into blocks of equal
length.  Every output shard draws how many blocks it takes from each source; the draws of a source are
numbered over all shards, a pseudorandom permutation of the source maps each number to a block, and
the blocks are joined by index.  Every pass over a source uses each block once.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from hirelens.llm.common import STEP_BYTES, byte_steps, free_name, running_total, stage, table_join
from hirelens.operators.ids import dense_ids
from hirelens.operators.lookup import fits_broadcast

# White space is exactly 20 and 09-0D.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 128
SHARD_BLOCKS = 4096
SEED = 20
MAX_PASSES = 3  # a source gives at most this many times its size
# Sources whose draw probabilities are broadcast together.
SOURCE_BLOCK = 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---- sources and targets ----


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``(source, rank, weight, source_size, target)`` of every source of ``sizes (source, size)``.

    Sources by code point, null last, weigh 1, 2, 3, repeating.  Targets share all words by weight and stop at three
    times their source's size; the excess is shared again.  Only totals come to the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = dense_ids(totals, "rank", start=0, order_by=[F.col("source").asc_nulls_last()])
    of_rank = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(ranked.withColumn("weight", of_rank.cast("double")), "sources")
    words = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    most = F.col("source_size") * float(MAX_PASSES)
    rate = -1.0
    while True:  # the rate only grows, so a source once at its limit stays there
        free = F.col("weight") * F.lit(rate) < most if rate >= 0 else F.lit(True)
        fixed, open_weight = table.agg(F.sum(F.when(~free, most)), F.sum(F.when(free, F.col("weight")))).first()
        if not open_weight:
            break
        new = max(rate, (words - (fixed or 0.0)) / open_weight)
        if new == rate:
            break
        rate = new
    return table.withColumn("target", F.least(F.col("weight") * F.lit(max(rate, 0.0)), most))


def quotas(targets: DataFrame, block_words: int) -> DataFrame:
    """What each source gives: ``passes`` whole passes and ``rest`` words of another, as a number of ``draws``."""
    z, wanted = F.col("source_size"), F.round("target").cast("long")
    full = F.col("full_blocks")
    made = targets.withColumn("wanted", F.least(wanted, z * MAX_PASSES))
    made = made.withColumn("passes", F.when(z > 0, F.expr("wanted div source_size")).otherwise(0).cast("long"))
    made = made.withColumn("rest", F.col("wanted") - F.col("passes") * z)
    made = made.withColumn("full_blocks", F.floor(z / block_words).cast("long"))
    made = made.withColumn("blocks", F.ceil(z / block_words).cast("long"))
    last = F.least(F.ceil(F.col("rest") / block_words), full + F.when(F.col("rest") > full * block_words, 1).otherwise(0))
    return made.withColumn("draws", (F.col("passes") * F.col("blocks") + last).cast("long")).drop("wanted")


# ---- draws ----


def shard_draws(table: DataFrame, shards: int, total: int, shard_blocks: int, seed: int) -> DataFrame:
    """``(shard, rank, n)``: multinomial source counts of every output shard, each shard from its own random stream.

    Sources are taken in blocks of bounded number: a shard first draws the counts of the source blocks,
    then, for each of them, those of its sources.
    """
    spark = table.sparkSession
    by_block = table.groupBy(F.floor(F.col("rank") / SOURCE_BLOCK).alias("b")).agg(F.sum("draws").alias("n"))
    shares = np.array([r.n for r in by_block.orderBy("b").collect()], np.float64) / total
    made = None
    for b in range(len(shares)):
        if not shares[b]:
            continue
        rows = table.filter(F.floor(F.col("rank") / SOURCE_BLOCK) == b).orderBy("rank").select("draws").collect()
        own = spark.sparkContext.broadcast(np.array([r.draws for r in rows], np.float64) / (shares[b] * total))

        def draw(batches: Iterator[pa.RecordBatch], b: int = b, own=own) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
                for shard in batch.column("id").to_pylist():
                    slots = min(shard_blocks, total - shard * shard_blocks)
                    first = np.random.Generator(np.random.Philox(key=[seed, shard])).multinomial(slots, shares)
                    stream = np.random.Generator(np.random.Philox(key=[seed + 1 + b, shard]))
                    counts = stream.multinomial(first[b], own.value / own.value.sum())
                    at = np.flatnonzero(counts)
                    for column, values in zip(out, (np.full(len(at), shard), at + b * SOURCE_BLOCK, counts[at])):
                        column.append(values.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["shard", "rank", "n"])

        part = spark.range(shards).mapInArrow(draw, "shard bigint, rank bigint, n bigint")
        made = part if made is None else made.unionByName(part)
    return made


def _slots(table: DataFrame, shards: int, total: int, shard_blocks: int, seed: int) -> DataFrame:
    """``(shard, place, rank, k)``: every place of every shard with the ``k``-th draw of a source.

    Over all shards a source is drawn about as often as its quota says.  Draws beyond the quota are given, in
    order, to the sources that were drawn too rarely; after that all quotas are met exactly.
    """
    drawn = stage(running_total(shard_draws(table, shards, total, shard_blocks, seed), ["rank"], "shard", "n", "first"),
                  "draws")
    one = drawn.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    one = one.select("shard", "rank", (F.col("first") + F.col("i")).alias("k"))
    counts = drawn.groupBy("rank").agg(F.sum("n").alias("drawn"))
    balance = table.select("rank", "draws").join(counts, "rank", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    balance = balance.withColumn("over", F.greatest(F.col("drawn") - F.col("draws"), F.lit(0)))
    balance = balance.withColumn("under", F.greatest(F.col("draws") - F.col("drawn"), F.lit(0)))
    balance = running_total(running_total(balance, [], "rank", "over", "over_base"), [], "rank", "under", "under_base")
    balance = stage(balance, "balance")
    marked = table_join(one, balance.select("rank", "draws", "over_base"), ["rank"])
    surplus = marked.filter(F.col("k") >= F.col("draws")).select(
        "shard", (F.col("over_base") + F.col("k") - F.col("draws")).alias("nth")
    )
    missing = balance.filter("under > 0").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("under") - 1)))
    missing = missing.select("rank", (F.col("drawn") + F.col("i")).alias("k"), (F.col("under_base") + F.col("i")).alias("nth"))
    kept = marked.filter(F.col("k") < F.col("draws")).select("shard", "rank", "k")
    return kept.unionByName(surplus.join(missing, "nth").select("shard", "rank", "k"))


def permuted(index: np.ndarray, domain: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Row by row, the place of ``index`` in the pseudorandom permutation ``key`` of ``0 .. domain - 1``.

    A Feistel network over the next even number of bits; values outside the domain go through it again.
    """
    half = np.ceil(np.log2(np.maximum(domain, 2)) / 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys, value, open_rows = key.astype(np.int64).view(np.uint64), index.astype(np.uint64), np.arange(len(index))
    while len(open_rows):
        h, m = half[open_rows], mask[open_rows]
        left, right = value[open_rows] >> h, value[open_rows] & m
        for step in range(6):
            mixed = (right + keys[open_rows] + np.uint64(step * 0x632BE59BD9B4E019 % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
        value[open_rows] = (left << h) | right
        open_rows = open_rows[value[open_rows] >= domain[open_rows].astype(np.uint64)]
    return value.astype(np.int64)


def _permute(index: pa.Array, domain: pa.Array, key: pa.Array) -> pa.Array:
    return pa.array(permuted(*(a.to_numpy(zero_copy_only=False) for a in (index, domain, key))))


# ---- documents and blocks ----


def _placed(rows: DataFrame) -> DataFrame:
    """Add ``start``: the words of the same source before a document, in a pseudorandom order of its documents.

    Rows are range-partitioned, so a hot source is spread over many tasks, and summed up per task; the
    totals of tasks and sources are summed up on their own.
    """
    ordered = rows.select("row", "id", "rank", "size", F.xxhash64("id").alias("h"))
    order = ["rank", "h", "id", "size", "row"]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ranks, sizes = batch.column("rank").to_numpy(), batch.column("size").to_numpy()
            ends = np.cumsum(sizes)
            firsts = np.flatnonzero(np.diff(ranks, prepend=ranks[0] - 1))
            bases = (ends - sizes)[firsts]
            bases[0] -= held if ranks[0] == rank else 0
            starts = ends - sizes - np.repeat(bases, np.diff(np.append(firsts, len(ranks))))
            rank, held = ranks[-1], int(starts[-1] + sizes[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("rank"), batch.column("size"), pa.array(starts), batch.column("part")],
                names=["row", "rank", "size", "inside", "part"])

    summed = stage(ordered.mapInArrow(sums, "row bigint, rank bigint, size bigint, inside bigint, part int"), "placed")
    parts = summed.groupBy("rank", "part").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("rank", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = table_join(summed, bases, ["rank", "part"])
    return placed.select("row", "rank", "size", (F.col("base") + F.col("inside")).alias("start"))


@dataclass
class Mix:
    rows: DataFrame  # one row per document: row, id, source, size
    targets: DataFrame  # one row per source: source, rank, source_size, target
    pieces: DataFrame  # shard, place, row, pass, from_word, to_word: what the mix takes of each document


def mix(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> Mix:
    """Mix stored rows ``(row, id, source, size)``; ``row`` is unique.  See ``mixed_counts`` for odd rows."""
    targets = stage(quotas(source_targets(rows.select("source", "size"), weights), block_words), "targets")
    rank_of = F.broadcast(targets) if fits_broadcast(targets) else targets
    ranked = rows.join(rank_of.select("source", "rank"), rows["source"].eqNullSafe(rank_of["source"])).drop(rank_of["source"])
    total = targets.agg(F.coalesce(F.sum("draws"), F.lit(0))).first()[0]
    if not total:
        nothing = "shard bigint, place bigint, row bigint, pass bigint, from_word bigint, to_word bigint"
        return Mix(rows, targets, rows.sparkSession.createDataFrame([], nothing))
    placed = _placed(ranked.filter("size > 0"))
    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    blocks = placed.withColumn("block", F.explode(F.sequence(first, last)))

    slots = table_join(_slots(targets, -(-total // shard_blocks), total, shard_blocks, seed),
                    targets.select("rank", "passes", "rest", "blocks", "full_blocks"), ["rank"])
    whole = F.col("k") < F.col("passes") * F.col("blocks")
    slots = slots.withColumn("pass", F.when(whole, F.expr("k div blocks")).otherwise(F.col("passes")))
    slots = slots.withColumn("nth", F.col("k") - F.col("pass") * F.col("blocks"))
    # In the last pass the short block of a source comes last, if at all.
    domain = F.when(whole, F.col("blocks")).otherwise(F.col("full_blocks"))
    permute = F.arrow_udf(_permute, "bigint")
    inside = F.col("nth") < domain
    at = permute(F.when(inside, F.col("nth")).otherwise(F.lit(0)), F.greatest(domain, F.lit(1)),
                 F.xxhash64(F.lit(seed), "rank", "pass"))
    slots = slots.withColumn("block", F.when(inside, at).otherwise(F.col("full_blocks")))
    slots = slots.withColumn("words", F.when(whole, F.lit(block_words)).otherwise(
        F.least(F.lit(block_words), F.col("rest") - F.col("nth") * block_words)))
    slots = slots.select("shard", F.xxhash64(F.lit(seed), "rank", "k").alias("place"), "rank", "pass", "block", "words")

    met = slots.join(blocks, ["rank", "block"])
    low = F.col("block") * block_words
    from_word = F.greatest(low, F.col("start")) - F.col("start")
    to_word = F.least(low + F.col("words"), F.col("start") + F.col("size")) - F.col("start")
    pieces = met.select("shard", "place", "row", "pass", from_word.alias("from_word"), to_word.alias("to_word"))
    return Mix(rows, targets, pieces.filter("from_word < to_word"))


def mixed_counts(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), block_words: int = BLOCK_WORDS,
                 shard_blocks: int = SHARD_BLOCKS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """``(id, size, source_size, target, taken)`` of every row: what a mix of ``docs`` takes of it.

    The words taken of a source are its target, rounded; no document gives more than three times its size.  A
    null source is a source, the last; null and blank texts have size 0 and are not taken; repeated rows
    and null ids are documents of their own; an empty table gives an empty result.
    """
    narrow = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"))
    rows = stage(narrow.withColumn("row", F.monotonically_increasing_id()), "sizes")
    made = mix(rows, weights, block_words, shard_blocks, seed)
    taken = made.pieces.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    of_source = made.targets.select("source", "source_size", "target")
    of_source = F.broadcast(of_source) if fits_broadcast(of_source) else of_source
    counted = made.rows.join(taken, "row", "left")
    return counted.join(of_source, counted["source"].eqNullSafe(of_source["source"])).select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), block_words: int = BLOCK_WORDS,
                    shard_blocks: int = SHARD_BLOCKS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each stretch of a document and each pass that takes it.

    A stretch taken whole keeps its text as it is, a part keeps the white space between its words;
    ``length_col``, if there, is set to the new length.  See ``mixed_counts`` for odd rows.
    """
    import re

    row, spans = free_name("_mix_row", docs.columns), free_name("_mix_spans", docs.columns)
    stored = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mixed_docs")
    narrow = stored.select(F.col(row).alias("row"), stored[id_col].alias("id"), stored[source_col].alias("source"),
                           word_count(stored[text_col]).alias("size"))
    made = mix(stage(narrow, "sizes"), weights, block_words, shard_blocks, seed)
    # As many spans as a document has blocks and passes.
    wanted = made.pieces.groupBy(F.col("row").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("pass", "from_word", "to_word"))).alias(spans)
    )
    kept, find, limit = docs.columns, re.compile(WORD).finditer, STEP_BYTES

    def rows_of(batch: pa.RecordBatch, takes: list[int], texts: list[str]) -> pa.RecordBatch:
        """The taken rows with their new texts; the old texts are not copied."""
        new = pa.array(texts, batch.column(text_col).type)
        changed = {text_col: new}
        if length_col in kept:
            changed[length_col] = pc.utf8_length(new).cast(batch.column(length_col).type)
        at = pa.array(takes, pa.int64())
        return pa.RecordBatch.from_arrays([changed[c] if c in changed else batch.column(c).take(at) for c in kept], names=kept)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_steps(batches, text_col, limit):
            takes, texts, held = [], [], 0
            for at in range(batch.num_rows):
                text, own = batch.column(text_col)[at].as_py(), batch.column(spans)[at].as_py()
                bounds = [m.span() for m in find(text)]
                for first, last in merged(own):
                    whole = first == 0 and last == len(bounds)
                    takes.append(at)
                    texts.append(text if whole else text[bounds[first][0] : bounds[last - 1][1]])
                    held += len(texts[-1])
                    if held > limit:
                        yield rows_of(batch, takes, texts)
                        takes, texts, held = [], [], 0
            if takes:
                yield rows_of(batch, takes, texts)

    return stored.join(wanted, row).mapInArrow(cut, docs.schema)


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Stretches of words of each pass, neighbours joined; ``spans`` are sorted by pass and place."""
    out: list[tuple[int, int, int]] = []
    for s in spans:
        if out and out[-1][0] == s["pass"] and out[-1][2] == s["from_word"]:
            out[-1] = (s["pass"], out[-1][1], s["to_word"])
        else:
            out.append((s["pass"], s["from_word"], s["to_word"]))
    return [(a, b) for _, a, b in out]
