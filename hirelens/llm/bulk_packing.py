"""Bulk-synchronous best-fit packing of token pieces into sequences of one capacity.

Pieces are range-sorted by length, which gives each a rank.  Neighbours of one length are interchangeable, and so
are sequences that were filled alike: a *run* of pieces is ``(length, first rank, count)`` and a run of gaps
``(space, first sequence, count)``, at most ``capacity`` runs of pieces whatever the data.  A round takes the pieces of the
next size band, sorts their runs and the gaps by size into ranges, and sweeps every range in a task of its own: each
run, longest first, goes to the smallest gaps that hold it, and where pieces outnumber gaps the lower ranks
win.  What a range leaves over is swept once more across the ranges, losers open sequences, gaps are updated and sorted
again for the next round.  Each piece then finds its sequence by its rank.  Rounds are staged.
"""

import math
import os
import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from hirelens.llm.common import byte_steps, stage
from hirelens.operators.ids import dense_ids

# Words kept with their ids by a Python worker: so many of late, and so many before.
CACHED_WORDS = 250_000
# New words encoded at once.
LEARNT_WORDS = 10_000
# Texts encoded together, in bytes.
STEP_BYTES = 2 << 20
# Longer stretches without white space are encoded but not kept.
CACHED_BYTES = 64
# Bands of size: pieces that fit 1, 2, ... times in a sequence, and all smaller ones together.
BANDS = 8
# Runs swept by one task, about.
RANGE_RUNS = 1024
# Ranks that one task joins with the places they were given.
RANK_CHUNK = 65_536

# ---- token ids of whole texts ----

# A word of letters up to white space or an ASCII sign, or else all up to white space.  No token of a vocabulary
# that drops white space spans the cut: letters end there, and no normal form joins an ASCII sign to a letter.
_LETTERS = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf])++"
_WORD = re.compile(_LETTERS)
_STRETCH = re.compile(_LETTERS + rb"(?![\x80-\xff])|[^\x20\x09-\x0d]+")
# Begins the special strings, which hold before letters are folded.
_SPECIAL = "<|"


def bytes_of(texts: pa.StringArray) -> list[bytes]:
    """The bytes of every text, none of them null; cut out of the array's own, as ``to_pylist`` makes an object more of each."""
    _, ends, data = texts.buffers()
    if not len(texts) or data is None:
        return [b""] * len(texts)
    cuts = np.frombuffer(ends, np.int32, len(texts) + 1, 4 * texts.offset)
    raw = data.slice(cuts[0], cuts[-1] - cuts[0]).to_pybytes()
    cuts = (cuts - cuts[0]).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


class WordEncoder:
    """Token ids of texts (little-endian unsigned 32-bit) for a lower-casing word vocabulary, word by word.

    Equal words have equal ids, so each is encoded once while it is kept; words met again outlive the others.  New words
    that the model cannot be given as they are, are encoded together and told apart by the token that ends a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.written = [i.to_bytes(4, "little") for i in range(len(self.ends))]
        self.kept: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(self._whole([b" ".join(words).decode()])[0], "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(ids)):  # some word is more than one to the library
            return self._whole([w.decode() for w in words])
        raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, stretches: set[bytes]) -> dict[bytes, bytes]:
        # Small ASCII letters stay as they are until the model itself sees them.
        plain = [s for s in stretches if s.isalpha()]
        tokens = self.tokenizer.model.tokenize
        new = {s: b"".join([self.written[t.id] for t in tokens(s.decode())]) for s in plain}
        rest = stretches.difference(plain)
        words = [s for s in rest if _WORD.fullmatch(s)]
        others = list(rest.difference(words))
        # The library holds a hundred bytes and more for a token, so few are encoded at a time.
        for at in range(0, len(words), LEARNT_WORDS):
            new.update(zip(words[at : at + LEARNT_WORDS], self._words(words[at : at + LEARNT_WORDS])))
        for at in range(0, len(others), LEARNT_WORDS):
            new.update(zip(others[at : at + LEARNT_WORDS], self._whole([s.decode() for s in others[at : at + LEARNT_WORDS]])))
        return new

    def _ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of different stretches between white space, each cut further where that is safe."""
        if len(self.kept) > CACHED_WORDS:
            self.kept, self.before = {}, self.kept
        kept, before = self.kept, self.before
        made, late = list(map(kept.get, chunks)), []
        for i in [i for i, ids in enumerate(made) if ids is None]:
            ids = before.get(chunks[i])
            if ids is None:
                late.append(i)
            else:
                made[i] = kept[chunks[i]] = ids
        cut = {i: _STRETCH.findall(chunks[i]) for i in late if not chunks[i].isalpha()}
        parts = {s for parts in cut.values() for s in parts}.difference(kept)
        again = {s: before[s] for s in parts if s in before}
        kept.update(again)
        new = self._learn(parts.difference(again).union(chunks[i] for i in late if i not in cut))
        kept.update(new)
        for i in late:
            made[i] = b"".join([kept[s] for s in cut[i]]) if i in cut else kept[chunks[i]]
        kept.update((chunks[i], made[i]) for i, parts in cut.items() if len(parts) > 1 and len(chunks[i]) <= CACHED_BYTES)
        for stretch in [s for s in new if len(s) > CACHED_BYTES]:
            del kept[stretch]
        return made

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """Ids of every text.  White space is cut and equal stretches are found by Arrow, only different ones are looked up."""
        special = pc.match_substring(texts, _SPECIAL)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(special, "", texts)))
        coded = lists.flatten().dictionary_encode()
        ids = self._ids_of(bytes_of(coded.dictionary))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        # Every occurrence of a stretch takes the place of its ids in the joined ids of all.
        places = np.repeat((np.cumsum(sizes) - sizes)[at] - ends[:-1], sizes[at]) + np.arange(ends[-1])
        raw = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
        cuts = (4 * ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]).tolist()
        made = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            made[i] = self._whole([texts[i].as_py()])[0]
        return made


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encoded_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids)`` of every document: its ids, ``end_id`` after them, cut only beyond ``capacity``.

    For vocabularies that lower-case and drop white space.  A null text counts as empty: ``end_id`` alone.  Null ids and
    repeated rows are documents of their own; other columns are ignored; an empty table gives no pieces.
    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    names = ["id", "piece", "start", "length", "ids"]
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for part in byte_steps(batches, "text", STEP_BYTES):
            whole = [ids + end for ids in encoder.encode(part.column("text"))]
            owner, piece, ids = [], [], []
            for i, made in enumerate(whole):
                for at in range(0, len(made), step):
                    owner.append(i)
                    piece.append(at // step)
                    ids.append(made[at : at + step])
            numbers = pa.array(piece, pa.int32())
            yield pa.RecordBatch.from_arrays([
                part.column("id").take(pa.array(owner, pa.int64())), numbers, pa.array([p * capacity for p in piece], pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
            ], names=names)

    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, piece int, start bigint, length bigint, ids binary").withColumnRenamed("id", id_col)


# ---- sweeps over runs ----

# ``piece``: (size, first rank, n).  ``gap``: (size, first sequence, n).  ``put``: ranks from ``first`` on, ``per`` in each
# of ``n`` sequences from ``sequence`` on, beginning at ``offset`` in each.
RUNS = "kind string, size bigint, first bigint, n bigint, per bigint, sequence bigint, offset bigint"
_NAMES = [c.split()[0] for c in RUNS.split(", ")]


class Sweep:
    """Best fit of runs of pieces into runs of gaps, longest pieces first, lower ranks first."""

    def __init__(self, capacity: int, gaps: list[tuple[int, int, int]]):
        self.capacity, self.gaps, self.puts = capacity, sorted(gaps), []

    def _gap(self, size: int, first: int, n: int) -> None:
        if size and n:
            insort(self.gaps, (size, first, n))

    def put(self, size: int, rank: int, gap: tuple[int, int, int], n: int) -> int:
        """As many of ``n`` pieces as the sequences of ``gap`` hold, each filled in turn; the number placed."""
        space, sequence, m = gap
        per, offset = space // size, self.capacity - space
        full = min(m, n // per)
        if full:
            self.puts.append((size, rank, full, per, sequence, offset))
            self._gap(space - per * size, sequence, full)
        placed = full * per
        rest = min(n - placed, per) if full < m else 0
        if rest:
            self.puts.append((size, rank + placed, 1, rest, sequence + full, offset))
            self._gap(space - rest * size, sequence + full, 1)
        self._gap(space, sequence + full + bool(rest), m - full - bool(rest))
        return placed + rest

    def place(self, pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Place runs of pieces; what no gap holds comes back."""
        left = []
        for size, rank, n in sorted(pieces, key=lambda p: (-p[0], p[1])):
            while n:
                at = bisect_left(self.gaps, (size,))
                if at == len(self.gaps):
                    left.append((size, rank, n))
                    break
                placed = self.put(size, rank, self.gaps.pop(at), n)
                rank, n = rank + placed, n - placed
        return left

    def open_by_rank(self, pieces: list[tuple[int, int, int]], per: int, sequence: int) -> int:
        """Every ``per`` pieces in order of rank open a sequence; the next free sequence number."""
        for size, rank, n in sorted(pieces, key=lambda p: (-p[0], p[1])):
            taken = self.place([(size, rank, n)])
            for size, rank, n in taken:
                opened = math.ceil(n / per)
                self.put(size, rank, (self.capacity, sequence, opened), n)
                sequence += opened
        return sequence

    def open_by_size(self, pieces: list[tuple[int, int, int]], sequence: int) -> int:
        """The longest pieces open as many sequences as all need at least, the rest is placed; until none is left."""
        while pieces:
            needed, rest = math.ceil(sum(size * n for size, _, n in pieces) / self.capacity), []
            for size, rank, n in sorted(pieces, key=lambda p: (-p[0], p[1])):
                opened = min(n, needed)
                if opened:
                    self.puts.append((size, rank, opened, 1, sequence, 0))
                    self._gap(self.capacity - size, sequence, opened)
                    sequence, needed = sequence + opened, needed - opened
                if n > opened:
                    rest.append((size, rank + opened, n - opened))
            pieces = self.place(rest)
        return sequence


def _swept(capacity: int, finish: Callable[[Sweep, list], object] | None = None):
    """A function over the record batches of one range of runs; ``finish`` opens sequences for what is left over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        runs = {kind: [(r["size"], r["first"], r["n"]) for r in rows if r["kind"] == kind] for kind in ("gap", "piece")}
        sweep = Sweep(capacity, runs["gap"])
        left = sweep.place(runs["piece"])
        if finish is not None:
            finish(sweep, left)
            left = []
        made = [("gap", *g, None, None, None) for g in sweep.gaps] + [("piece", *p, None, None, None) for p in left]
        made += [("put", *p) for p in sweep.puts]
        if made:
            columns = [pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*made))]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return run


def _round(gaps: DataFrame, pieces: DataFrame, capacity: int, finish: Callable[[Sweep, list], object]) -> tuple[DataFrame, DataFrame]:
    """One round: ``(gaps and nothing else, puts)`` after all of ``pieces`` found a place."""
    events = gaps.unionByName(pieces)
    ranges = math.ceil(events.count() / RANGE_RUNS)
    puts = []
    if ranges > 1:
        # One task per range of sizes: pieces and the gaps of their own range.
        swept = stage(events.repartitionByRange(ranges, F.col("size").desc()).mapInArrow(_swept(capacity), RUNS), "swept")
        puts.append(swept.filter("kind = 'put'"))
        events = swept.filter("kind <> 'put'")
    # What is left of all ranges: runs, not rows, so one task holds them whatever the number of pieces.
    swept = stage(events.coalesce(1).mapInArrow(_swept(capacity, finish), RUNS), "swept")
    puts.append(swept.filter("kind = 'put'"))
    return swept.filter("kind = 'gap'"), reduce(DataFrame.unionByName, puts)


def _places(runs: DataFrame, capacity: int) -> DataFrame:
    """All ``put`` runs for the runs of pieces, band by band."""
    spark = runs.sparkSession
    gaps, puts, sequence = runs.filter("kind = 'gap'"), [], 0  # none yet
    for band in range(1, BANDS + 1):
        above = capacity // (band + 1) if band < BANDS else 0
        inside = runs.filter((F.col("size") > above) & (F.col("size") <= capacity // band))
        if inside.isEmpty():
            continue
        if band < BANDS:
            finish = lambda sweep, left, per=band, sequence=sequence: sweep.open_by_rank(left, per, sequence)
        else:
            finish = lambda sweep, left, sequence=sequence: sweep.open_by_size(left, sequence)
        gaps, placed = _round(gaps, inside, capacity, finish)
        puts.append(placed)
        sequence = max(sequence, placed.agg(F.max(F.col("sequence") + F.col("n"))).first()[0])
    return reduce(DataFrame.unionByName, puts) if puts else spark.createDataFrame([], RUNS)


def best_fit_packed(pieces: DataFrame, capacity: int = 4096, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: where each piece stands, sequences without gaps from 0 on.

    Lengths are 1 to ``capacity``, others are refused.  All columns are kept; pieces of equal length take places in the order of the
    input.  Repeated rows are pieces of their own; an empty table gives an empty result.
    """
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(pieces.columns)]
    length = f"c{pieces.columns.index(length_col)}"
    rows = pieces.select(*own, F.monotonically_increasing_id().alias("row"))
    ranked = dense_ids(stage(rows, "pieces"), "rank", start=0, order_by=[F.col(length).desc(), "row"]).drop("row")
    runs = stage(
        ranked.groupBy(F.col(length).cast("long").alias("size")).agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
        .select(F.lit("piece").alias("kind"), "size", "first", "n", *[F.lit(None).cast("long").alias(c) for c in _NAMES[4:]]),
        "runs",
    )
    odd = runs.filter((F.col("size") < 1) | (F.col("size") > capacity) | F.col("size").isNull()).first()
    if odd:
        raise ValueError(f"{odd['n']} pieces of length {odd['size']}, allowed are 1 to {capacity}")
    return _placed(ranked, _places(runs, capacity), pieces.columns)


def _placed(ranked: DataFrame, puts: DataFrame, names: list[str]) -> DataFrame:
    """Each piece with the last put at or before its rank, chunk by chunk of ranks."""
    chunk = lambda rank: F.floor(rank / F.lit(RANK_CHUNK))
    last = F.col("first") + F.col("per") * F.col("n") - 1
    # A put that reaches into further chunks is repeated in each, from the chunk's first rank on.
    cut = puts.select("*", F.explode(F.sequence(chunk(F.col("first")), chunk(last))).alias("chunk"))
    put = F.struct("first", "per", "sequence", "offset", "size")
    marks = cut.select("chunk", F.greatest("first", F.col("chunk") * RANK_CHUNK).alias("rank"), put.alias("put"))
    both = ranked.withColumn("chunk", chunk(F.col("rank"))).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy("chunk").orderBy("rank", F.col("put").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("at", F.last("put", ignorenulls=True).over(order)).filter("put IS NULL")
    nth = F.col("rank") - F.col("at.first")
    sequence = F.col("at.sequence") + F.floor(nth / F.col("at.per"))
    offset = F.col("at.offset") + F.pmod(nth, F.col("at.per")) * F.col("at.size")
    kept = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    return found.select(*kept, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, ends)``: the joined ids of each sequence and where its pieces end; one sequence is the largest group."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(pieces.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return whole.select("sequence_id", joined.alias("ids"), F.transform("p", lambda p: p["offset"] + p["length"]).alias("ends"))
