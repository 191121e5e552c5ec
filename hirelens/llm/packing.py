"""Packed training sequences: best-fit-decreasing, written as binary id matrices.

A task encodes its documents, cuts overlong ones, and packs about ``shard_tokens`` tokens at a time into
sequences of equal length.  Nothing is shuffled.  A sequence names its segments: the documents, the
cumulative lengths, and where positions start again at 0.
"""

import base64
import io
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelens.llm.common import byte_steps
from hirelens.llm.files import make_folder, write_file

SEQUENCE_TOKENS = 2048
SHARD_TOKENS = 4 << 20
END_ID = 50_256  # free in the vocabulary: ends every document
PAD_ID = END_ID
# Shards of one task are numbered below this many bits.
_SHARD_BITS = 24

PACKED = ("shard bigint, sequence int, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "doc_ids array<bigint>, pieces array<int>, last_pieces array<boolean>")
_PACKED_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                 pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
_PACKED_NAMES = [c.split()[0] for c in PACKED.split(", ")]


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Token ids of a text, special strings taken as ordinary text; loaded once per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    made = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made.encode_ordinary


# ---- best fit ----


class FreeSpace:
    """Open sequences by their free tokens; a segment tree finds the smallest free space that is enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, free: int, sequence: int) -> None:
        self.bins[free].append(sequence)
        node = free + self.leaves
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return ``(free, sequence)`` with the smallest free space of at least ``least``."""
        node = least + self.leaves
        if not self.any[node]:
            # Up to the first right sibling that holds something, then down its left side.
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.any[2 * node])
        free = node - self.leaves
        sequence = self.bins[free].pop()
        if not self.bins[free]:
            self.any[node] = 0
            while node > 1 and not self.any[node ^ 1]:
                node >>= 1
                self.any[node] = 0
        return free, sequence


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items of each sequence; longest items first, each into the fullest sequence that it fits."""
    space, packed = FreeSpace(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = space.take(lengths[item])
        if found is None:
            found = capacity, len(packed)
            packed.append([])
        packed[found[1]].append(item)
        space.add(found[0] - lengths[item], found[1])
    return packed


# ---- packing ----


def _shard(number: int, pieces: list, sequence_tokens: int, dtype) -> pa.RecordBatch:
    """The packed sequences of ``pieces (doc id, piece, is last, ids)``."""
    columns = [[] for _ in _PACKED_NAMES]
    for at, items in enumerate(best_fit_decreasing([len(p[3]) for p in pieces], sequence_tokens)):
        own = [pieces[i] for i in items]
        ends = np.cumsum([len(p[3]) for p in own])
        ids = np.full(sequence_tokens, PAD_ID, dtype)
        ids[: ends[-1]] = np.concatenate([p[3] for p in own])
        starts = [0, *ends.tolist()]
        # Padding is a segment of its own for positions, not for attention.
        resets = starts if ends[-1] < sequence_tokens else starts[:-1]
        values = (number, at, int(ends[-1]), ids.tobytes(), starts, resets, *map(list, zip(*[p[:3] for p in own])))
        for column, value in zip(columns, values):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PACKED_TYPES)], names=_PACKED_NAMES)


def packed_sequences(docs: DataFrame, tokenizer_path: str, sequence_tokens: int = SEQUENCE_TOKENS,
                     shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed sequence (schema ``PACKED``); every token of every document is in exactly one.

    ``ids`` holds ``sequence_tokens`` little-endian 16-bit ids.  A document is its tokens and an end id;
    documents longer than a sequence are cut into pieces numbered from 0, the last one marked.  A null or empty text
    is its end id alone; null ids, repeated rows and other columns change nothing; an empty table
    gives an empty result.  Shards follow the input partitions, so equal partitions give equal shards: pass a stored
    table, whose partitions keep their order when a task runs twice.
    """
    dtype = np.dtype("<u2")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << _SHARD_BITS
        number, pieces, held = 0, [], 0
        for part in byte_steps(batches, "text"):
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), END_ID], dtype)
                for at in range(0, len(ids), sequence_tokens):
                    piece = ids[at : at + sequence_tokens]
                    pieces.append((doc, at // sequence_tokens, at + sequence_tokens >= len(ids), piece))
                    held += len(piece)
                    if held >= shard_tokens:
                        yield _shard(base + number, pieces, sequence_tokens, dtype)
                        number, pieces, held = number + 1, [], 0
        if pieces:
            yield _shard(base + number, pieces, sequence_tokens, dtype)

    rows = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(pack, PACKED)


# ---- matrix files ----


def write_matrices(packed: DataFrame, folder: str, sequence_tokens: int = SEQUENCE_TOKENS) -> int:
    """Write one ``.npz`` file per shard to ``folder``; returns the number of files.

    A file holds the id matrix (sequences x tokens), the cumulative segment lengths and position resets of its
    sequences one after another, and where each sequence begins in them.  The rows of a shard must
    stand together in one partition, as ``packed_sequences`` leaves them.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, held, shard = 0, [], None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            for cut in np.split(np.arange(len(shards)), np.flatnonzero(np.diff(shards)) + 1):
                if not len(cut):
                    continue
                if shard is not None and shards[cut[0]] != shard:
                    _write_shard(folder, shard, held, sequence_tokens)
                    files, held = files + 1, []
                shard = int(shards[cut[0]])
                held.append(batch.slice(int(cut[0]), len(cut)))
        if held:
            _write_shard(folder, shard, held, sequence_tokens)
            files += 1
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    make_folder(folder)
    made = packed.mapInArrow(write, "files bigint")
    return made.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def _flat(rows: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after another, and where each row's values begin."""
    column = rows.column(name).combine_chunks()
    lengths = column.value_lengths().to_numpy()
    return column.flatten(), np.concatenate([[0], np.cumsum(lengths)])


def _write_shard(folder: str, shard: int, batches: list[pa.RecordBatch], sequence_tokens: int) -> None:
    rows = pa.Table.from_batches(batches)
    ids = np.frombuffer(b"".join(rows.column("ids").to_pylist()), "<u2").reshape(-1, sequence_tokens)
    cumulative, cumulative_at = _flat(rows, "cu_seqlens")
    resets, resets_at = _flat(rows, "position_resets")
    docs, docs_at = _flat(rows, "doc_ids")
    out = io.BytesIO()
    np.savez(
        out, shard=shard, ids=ids, sequence=rows.column("sequence").to_numpy(), n_tokens=rows.column("n_tokens").to_numpy(),
        cu_seqlens=cumulative.to_numpy(), cu_seqlens_at=cumulative_at, position_resets=resets.to_numpy(),
        position_resets_at=resets_at, doc_ids=docs.fill_null(0).to_numpy(), null_docs=docs.is_null().to_numpy(zero_copy_only=False),
        segments_at=docs_at, pieces=_flat(rows, "pieces")[0].to_numpy(),
        last_pieces=_flat(rows, "last_pieces")[0].to_numpy(zero_copy_only=False),
    )
    write_file(folder, f"shard-{shard:016d}.npz", [out.getbuffer()])


def read_matrices(spark: SparkSession, folder: str) -> DataFrame:
    """The packed sequences of a folder of matrix files, as ``packed_sequences`` gives them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                with np.load(io.BytesIO(content.as_buffer())) as held:
                    yield _rows_of({name: held[name] for name in held.files})

    return files.mapInArrow(parse, PACKED)


def _rows_of(held: dict) -> pa.RecordBatch:
    lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
    segments = held["segments_at"]
    arrays = [
        pa.array(np.full(len(held["ids"]), held["shard"], np.int64)),
        pa.array(held["sequence"], pa.int32()),
        pa.array(held["n_tokens"], pa.int32()),
        pa.array([row.tobytes() for row in held["ids"]], pa.binary()),
        lists(held["cu_seqlens_at"], pa.array(held["cu_seqlens"], pa.int32())),
        lists(held["position_resets_at"], pa.array(held["position_resets"], pa.int32())),
        lists(segments, pa.array(held["doc_ids"], pa.int64(), mask=held["null_docs"])),
        lists(segments, pa.array(held["pieces"], pa.int32())),
        lists(segments, pa.array(held["last_pieces"], pa.bool_())),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=_PACKED_NAMES)


# ---- what became of each document ----


def document_digests(packed: DataFrame) -> DataFrame:
    """``(doc_id, copies, n_tokens, n_pieces, digest)`` of every document of packed sequences.

    Rows with equal ids are reported together; ``copies`` counts them.  ``digest`` is the sum over the pieces
    of (CRC-32 of the piece's ids) x (piece number + 1): equal for equal tokens in equal order.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            names = ("ids", "cu_seqlens", "doc_ids", "pieces", "last_pieces")
            for ids, ends, docs, pieces, last in zip(*[batch.column(n).to_pylist() for n in names]):
                for at, (doc, piece, is_last) in enumerate(zip(docs, pieces, last)):
                    crc = zlib.crc32(ids[2 * ends[at] : 2 * ends[at + 1]])
                    for column, value in zip(out, (doc, ends[at + 1] - ends[at], is_last, crc * (piece + 1))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["doc_id", "n", "last", "d"])

    each = packed.mapInArrow(segments, "doc_id bigint, n int, last boolean, d bigint")
    return each.groupBy("doc_id").agg(
        F.count_if("last").alias("copies"), F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces"),
        F.sum(F.col("d").cast("decimal(38,0)")).cast("string").alias("digest"),
    )
