"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them.

Test items are a stated query set.  They are taken in blocks of bounded size, each block against all
documents.  A scan cuts from every document the passages around words that form an n-gram of some
item; per item only the rarest n-grams of the corpus count as seeds, as many as are needed for
any copy that can reach the threshold to hold one; seeded passages are aligned word by word.
Long items are looked for as a whole and in overlapping parts, so a copied part is found as well.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from hirelens.llm.common import byte_steps, stage
from hirelens.operators.lookup import fits_broadcast

# Fixed values of the alignment; the completeness of the seeds rests on them and on the least scores.
MATCH, MISMATCH, GAP = 2, -1, -2
SEED_WORDS = 3
MIN_THRESHOLD = 0.6
# Items of up to EXACT_WORDS words count as exact word sequences, of up to SHORT_WORDS from a stricter score on.
EXACT_WORDS = 4
SHORT_WORDS = 10
SHORT_THRESHOLD = 0.8
# Items of more words are also looked for in parts of so many words, each half a part after the one before.
PART_WORDS = 64
# Bytes of item texts that are broadcast together, and words of a passage that are aligned together.
BLOCK_BYTES = 8 << 20
PASSAGE_WORDS = 4096

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters and digits: case, punctuation and white space do not hide a copy."""
    return _WORD.findall(text.lower())


def least_score(n_words: int, threshold: float = MIN_THRESHOLD) -> float:
    """The score from which an alignment with an item of ``n_words`` words is a copy."""
    least = 1.0 if n_words <= EXACT_WORDS else SHORT_THRESHOLD if n_words <= SHORT_WORDS else MIN_THRESHOLD
    return max(threshold, least)


def seed_words(n_words: int) -> int:
    return min(SEED_WORDS, n_words)


def parts_of(words: list[str]) -> list[list[str]]:
    """The words of an item, and of its parts if it is long; the last part ends with the item."""
    if len(words) <= PART_WORDS:
        return [words] if words else []
    last = len(words) - PART_WORDS
    starts = [*range(0, last, PART_WORDS // 2), last]
    return [words, *(words[k : k + PART_WORDS] for k in starts)]


@dataclass
class Items:
    """A block of test items and their parts as word numbers, and where their n-grams stand."""

    ids: list
    words: list[np.ndarray]  # per item or part
    vocabulary: dict[str, int]
    # Code of an n-gram -> (words to its left, words to its right) that a copy of an item around it may take.
    reach: dict[int, tuple[int, int]] = field(default_factory=dict)
    sizes: set[int] = field(default_factory=set)  # of the n-grams

    @property
    def base(self) -> int:
        return len(self.vocabulary) + 1

    def codes(self, numbers: np.ndarray, size: int) -> np.ndarray:
        """Code of the n-gram at every position, another for each size; negative where a word is unknown."""
        known = numbers >= 0
        made, whole = np.zeros(max(0, len(numbers) - size + 1), np.int64), True
        for k in range(size):
            made = made * self.base + numbers[k : k + len(made)] + 1
            whole = whole & known[k : k + len(made)]
        return np.where(whole, made, -1)


def slack(n_words: int) -> int:
    """Words that a copy within the threshold can have more than its item: each costs one gap."""
    return int((MATCH * n_words * (1 - least_score(n_words))) // -GAP) + 1


def prepare(rows: list[tuple[object, str]]) -> Items:
    cut = [(i, part) for i, t in rows for part in parts_of(words_of(t or ""))]
    vocabulary: dict[str, int] = {}
    numbers = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64) for _, words in cut]
    if len(vocabulary) + 1 > 2_000_000:  # an n-gram code must fit 63 bits
        raise ValueError("a block of test items holds too many different words; lower BLOCK_BYTES")
    items = Items([i for i, _ in cut], numbers, vocabulary)
    for item in numbers:
        extra, size = slack(len(item)), seed_words(len(item))
        items.sizes.add(size)
        for at, code in enumerate(items.codes(item, size).tolist()):
            left, right = items.reach.get(code, (0, 0))
            items.reach[code] = max(left, at + extra), max(right, len(item) - at + extra)
    return items


# ---- passages ----


def passages(numbers: np.ndarray, items: Items, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first word, word numbers, distinct seed codes)`` of the stretches that may hold a copy.

    Stretches that touch are one; long ones are cut so that each possible copy lies whole in one piece.
    """
    hits = []
    for size in items.sizes:
        codes = items.codes(numbers, size)
        known = np.flatnonzero(codes >= 0)
        hits += [(p, p + size, c) for p, c in zip(known.tolist(), codes[known].tolist()) if c in items.reach]
    if not hits:
        return
    hits.sort()
    spans: list[list[int]] = []
    for p, _, code in hits:
        left, right = items.reach[code]
        lo, hi = max(0, p - left), min(len(numbers), p + right)
        while spans and lo <= spans[-1][1]:
            old = spans.pop()
            lo, hi = min(lo, old[0]), max(hi, old[1])
        spans.append([lo, hi])
    first, after, codes = np.array(hits, np.int64).T
    overlap = max(len(w) + slack(len(w)) for w in items.words)
    longest = max(longest, 2 * overlap)
    for lo, hi in spans:
        for start in range(lo, max(lo + 1, hi - overlap), longest - overlap):
            end = min(hi, start + longest)
            own = codes[(first >= start) & (after <= end)]
            if len(own):
                yield start, numbers[start:end], np.unique(own)


def _passages_of(docs: DataFrame, items, longest: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value
        look_up = known.vocabulary.get
        for part in byte_steps(batches, "text"):
            rows = {"id": [], "start": [], "words": [], "seeds": []}
            for i, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                words = words_of(text or "")
                numbers = np.fromiter((look_up(w, -1) for w in words), np.int64, len(words))
                for start, piece, seeds in passages(numbers, known, longest):
                    for name, value in zip(rows, (i, start, piece, seeds)):
                        rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["id"], part.column("id").type), pa.array(rows["start"], pa.int64()),
                 pa.array(rows["words"], pa.list_(pa.int64())), pa.array(rows["seeds"], pa.list_(pa.int64()))],
                names=list(rows))

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"id {kind}, start bigint, words array<bigint>, seeds array<bigint>")


# ---- rare seeds ----


def rare_seeds(items: Items, frequency: dict[int, int]) -> dict[int, list[int]]:
    """Seed code -> items (positions in the block) that it speaks for.

    An edit breaks at most as many n-grams of an item as they have words, and a copy that reaches the threshold has few
    edits.  So it keeps at least ``spare`` n-grams, and any ``total - spare + 1`` of them include one that it keeps: the
    rarest of the corpus are taken.
    """
    seeds: dict[int, list[int]] = {}
    for at, words in enumerate(items.words):
        codes = items.codes(words, seed_words(len(words))).tolist()
        spare = max(1, kept_grams(len(words)))
        by_rarity = sorted(codes, key=lambda c: (frequency.get(c, 0), c))
        for code in set(by_rarity[: len(codes) - spare + 1]):
            seeds.setdefault(code, []).append(at)
    return seeds


def kept_grams(n_words: int) -> int:
    """N-grams that every copy within the threshold keeps.

    Of the score 2n a copy may lose 0.8n, of a short item 0.4n.  Per point lost, a changed word breaks 3 n-grams for 3
    points, a word put in 2 for 2, a word left out 3 for 4, a word cut off an end 1 for 2: never more than one a point.
    """
    return n_words - seed_words(n_words) + 1 - int(MATCH * n_words * (1 - least_score(n_words)) + 1e-9)


# ---- alignment ----


def align(item: np.ndarray, windows: list[np.ndarray]) -> list[tuple[int, int]]:
    """``(score, end)`` of the best local alignment of ``item`` in each window; ``end`` is the word after it."""
    width = max(map(len, windows))
    grid = np.full((len(windows), width), -1, np.int64)
    for row, window in zip(grid, windows):
        row[: len(window)] = window
    steps = -GAP * np.arange(width)
    above = np.zeros((len(windows), width + 1), np.int64)
    best, ends = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
    for word in item:
        reached = np.maximum(above[:, :-1] + np.where(grid == word, MATCH, MISMATCH), above[:, 1:] + GAP)
        np.maximum(reached, 0, out=reached)
        # A gap in the item: the best value to the left, less one gap a word.
        reached = np.maximum.accumulate(reached + steps, axis=1) - steps
        above[:, 1:] = reached
        top = reached.argmax(axis=1)
        value = reached[np.arange(len(windows)), top]
        ends = np.where(value > best, top + 1, ends)
        best = np.maximum(best, value)
    return list(zip(best.tolist(), ends.tolist()))


def span_of(item: np.ndarray, window: np.ndarray, end: int) -> int:
    """First word of the alignment that ends before ``end``: the best one of the reversed sequences, from there."""
    _, length = align(item[::-1], [window[:end][::-1]])[0]
    return end - length


def _scored(found: DataFrame, items, seeds, threshold: float, item_type: DataType) -> DataFrame:
    item_kind = to_arrow_type(item_type)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, speaks_for = items.value, seeds.value
        for batch in batches:
            wanted: dict[int, list[int]] = {}
            words = batch.column("words")
            for row, codes in enumerate(batch.column("seeds").to_pylist()):
                for at in {at for code in codes for at in speaks_for.get(code, ())}:
                    wanted.setdefault(at, []).append(row)
            ids, starts = batch.column("id").to_pylist(), batch.column("start").to_pylist()
            out = {name: [] for name in ("id", "item", "score", "first", "last")}
            for at, rows in wanted.items():
                item = known.words[at]
                own, least = np.unique(item), least_score(len(item), threshold) * MATCH * len(item) - 1e-9
                # Without enough words of the item no alignment can reach the threshold.
                windows = [(r, w) for r in rows if np.isin(w := words[r].values.to_numpy(), own).sum() * MATCH >= least]
                windows.sort(key=lambda x: len(x[1]))
                for k in range(0, len(windows), 64):
                    group = windows[k : k + 64]
                    for (r, window), (best, end) in zip(group, align(item, [w for _, w in group])):
                        if best >= least:
                            first = span_of(item, window, end)
                            for name, value in zip(out, (ids[r], known.ids[at], best / (MATCH * len(item)),
                                                         starts[r] + first, starts[r] + end)):
                                out[name].append(value)
            kinds = (batch.column("id").type, item_kind, pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(score, f"id {kind}, item {item_type.simpleString()}, score double, first bigint, last bigint")


# ---- the operator ----


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The test items, a block of bounded size at a time; a null id or text is no item."""
    rows = benchmark.select(benchmark[item_col].alias("item"), benchmark[text_col].alias("text"))
    rows = rows.filter("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes)
    for block in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield [(r.item, r.text) for r in own.orderBy("item", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = MIN_THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          block_bytes: int = BLOCK_BYTES, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``(id, item, score, first_word, last_word)``: one row per document and test item that it copies.

    ``score`` is the best alignment score over that of a whole exact copy, at least ``threshold``; the words from
    ``first_word`` up to, not including, ``last_word`` of the document (counted from 0) are the best passage.
    Equal scores: the first passage counts.  Items of five to ten words need a score of 0.8 at least, shorter ones must
    stand word for word, those without a word are not looked for.  Items of more than 64 words are also looked for in
    parts of 64 words, every 32 words and at the end; ``score`` is then the best of the item's and its parts' (each over
    a whole copy of it), so 64 words copied in a row are always found.  Ids of any type can be taken.  Null or empty texts copy nothing, null ids are kept as
    null, rows with equal ids count as one document, empty tables give an empty result.
    """
    if threshold < MIN_THRESHOLD:
        raise ValueError(f"seeds find all copies from a score of {MIN_THRESHOLD} on")
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind, item_type = texts.schema["id"].dataType.simpleString(), benchmark.schema[item_col].dataType
    made = []
    for rows in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        items = prepare(rows)
        if not items.ids:
            continue
        shared = spark.sparkContext.broadcast(items)
        found = stage(_passages_of(texts, shared, passage_words), "passages")
        # One row per n-gram of the block: as bounded as the block.
        counts = found.select(F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
        seeds = rare_seeds(items, {r.seed: r.n for r in counts.collect()})
        made.append(_scored(found, shared, spark.sparkContext.broadcast(seeds), threshold, item_type))
    # An empty local table is read by Python workers of its own: only where there is nothing else.
    none = f"id {kind}, item {item_type.simpleString()}, score double, first bigint, last bigint"
    scored = reduce(DataFrame.unionByName, made) if made else spark.createDataFrame([], none)
    first_best = F.struct("score", (-F.col("first")).alias("first"), (-F.col("last")).alias("last"))
    best = F.max(first_best).alias("best")
    return scored.groupBy("id", "item").agg(best).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.round("best.score", 6).alias("score"),
        (-F.col("best.first")).alias("first_word"), (-F.col("best.last")).alias("last_word"),
    )


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id has no row in ``found``; rows without an id stay."""
    ids = stage(found.filter(F.col(id_col).isNotNull()).select(id_col).distinct(), "leaking_ids")
    return docs.join(F.broadcast(ids) if fits_broadcast(ids) else ids, id_col, "left_anti")
