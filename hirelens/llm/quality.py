"""Quality scores by nearest-neighbour voting among labelled texts.

A text is the bag of its character patterns (runs of three character classes), of its words, hashed to a fixed number
of columns, and of how often its words repeat.  Labelled texts are projected to a latent-semantic space (weighted term matrix, truncated
singular value decomposition); the labelled vectors are broadcast, every document is compared with
all of them by blocked cosine products, and its nearest neighbours vote, weighted by similarity.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hirelens.llm.common import byte_slices, byte_steps, stage, table_join

# ---- terms ----

# Letters of any script are one class, each listed mark has its own, all other marks share one.
_MARKS = ".,!?|$%&*#-/:@()'\"<>=_;"
_CLASSES = 32
_OTHER = _CLASSES - 1
_REPEATS = 10  # terms for the share of words that repeat the word before them
# Columns that words are hashed to, and their part of a text's weight beside the patterns.
WORD_COLUMNS = 2048
WORD_WEIGHT = 0.5
_WORDS_FROM = _CLASSES**3 + _REPEATS
N_TERMS = _WORDS_FROM + WORD_COLUMNS
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
STEP_CHARS = 1 << 20
# Cells of the matrix of labelled texts that are dense at a time.
BLOCK_CELLS = 1 << 21
# Cells of texts by columns, and of texts by labelled texts, that a worker holds at a time: 4 MB.
SCORE_CELLS = 1 << 19
# Square matrices up to this size are decomposed whole; larger ones in so many cycles at most, of bases of so many blocks.
WHOLE, CYCLES, DEPTH = 1024, 100, 8


def _byte_classes() -> np.ndarray:
    classes = np.full(256, _OTHER, np.int32)
    classes[ord("a") : ord("z") + 1] = classes[128:] = 0
    classes[ord("A") : ord("Z") + 1] = 1
    classes[ord("0") : ord("9") + 1] = 2
    classes[[32, 10]] = 3, 4
    classes[[9, 13]] = 5
    for at, mark in enumerate(_MARKS, start=6):
        classes[ord(mark)] = at
    return classes


_CLASS_OF = _byte_classes()


def word_terms(text: bytes) -> np.ndarray:
    """How often each word column occurs: words in lower case; words beyond ASCII by pairs of characters, as scripts
    without blanks need it."""
    words = _WORD.findall(text.lower())
    if not text.isascii():
        words = [part for word in words for part in ((word,) if word.isascii() else _pairs(word))]
    hashes = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    return np.bincount(hashes % WORD_COLUMNS, minlength=WORD_COLUMNS)


def _pairs(word: bytes) -> list[bytes]:
    letters = word.decode("utf-8", "replace")
    return [letters[at : at + 2].encode() for at in range(max(1, len(letters) - 1))]


def term_counts(text: bytes, column_of: np.ndarray, n_columns: int) -> np.ndarray:
    """Weights of a text in ``n_columns`` columns; ``column_of`` maps terms to columns, the last one is dropped."""
    counts = np.zeros(n_columns + 1, np.float64)
    for at in range(0, len(text), STEP_CHARS):
        codes = _CLASS_OF[np.frombuffer(text[at : at + STEP_CHARS + 2], np.uint8)]
        triples = (codes[:-2] * _CLASSES + codes[1:-1]) * _CLASSES + codes[2:]
        counts += np.bincount(column_of[triples], minlength=n_columns + 1)
    total = counts.sum()
    if total:
        counts = np.sqrt(counts / total)
    words = text.split()
    if words:
        repeats = sum(map(bytes.__eq__, words, words[1:])) / len(words)
        counts[column_of[_CLASSES**3 + int(repeats * (_REPEATS - 1))]] += 0.3
    times = word_terms(text)
    at = np.flatnonzero(times)
    if len(at):
        # Several unknown columns fall on the last one, which is dropped.
        counts[column_of[_WORDS_FROM + at]] = WORD_WEIGHT * np.sqrt(times[at] / times.sum())
    return counts[:n_columns]


# ---- model ----


@dataclass
class Model:
    """Projection and labelled vectors, a few MB whatever the corpus: all arrays are bounded by the parameters."""

    column_of: np.ndarray  # term to column
    weights: np.ndarray  # inverse document frequencies of the columns
    axes: np.ndarray  # columns x dimensions
    vectors: np.ndarray  # labelled texts x dimensions, unit length
    labels: np.ndarray  # mean label of each labelled text

    def project(self, texts: list[bytes]) -> np.ndarray:
        """Unit vectors of the texts; zero for texts without any known term."""
        n, axes = len(self.weights), self.weights[:, None] * self.axes
        made, step = np.zeros((len(texts), axes.shape[1])), max(1, SCORE_CELLS // n)
        terms = np.zeros((min(step, len(texts)), n))
        for at in range(0, len(texts), step):
            own = texts[at : at + step]
            for row, text in zip(terms, own):
                row[:] = term_counts(text, self.column_of, n)
            made[at : at + step] = terms[: len(own)] @ axes
        lengths = np.linalg.norm(made, axis=1, keepdims=True)
        return np.divide(made, lengths, out=np.zeros_like(made), where=lengths > 1e-12)


def _sample(docs: DataFrame, labels: DataFrame, learn_from: Column, max_labelled: int, id_col: str, text_col: str,
            label_col: str) -> list:
    """At most ``max_labelled`` labelled texts, the first by a hash of the id: the same rows in every run.

    Only labels of ids that have a text count towards the bound.
    """
    known = labels.filter(learn_from).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    known = known.filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.avg("label").alias("label"))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter("text IS NOT NULL")
    known = table_join(texts.select("id"), stage(known, "labels"), ["id"]).dropDuplicates(["id"])
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    found = texts.join(F.broadcast(known), "id")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = np.arange(N_TERMS)
        for part in byte_steps(batches, "text"):
            sparse = []
            for text in part.column("text").cast(pa.binary()).to_pylist():
                dense = term_counts(text, same, N_TERMS)
                at = np.flatnonzero(dense)
                sparse.append(np.concatenate([at.astype(np.float32), dense[at].astype(np.float32)]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array(sparse, pa.binary())], names=["id", "label", "terms"]
            )

    kind = found.schema["id"].dataType.simpleString()
    made = found.mapInArrow(counted, f"id {kind}, label double, terms binary")
    # Repeated rows of one id are few or many; the order and the bound hold for them as well.
    return made.orderBy(F.xxhash64("id"), "id", "terms").limit(max_labelled).collect()


class SparseRows:
    """A matrix by the columns and values of its rows; a slice of it is dense."""

    def __init__(self, ends: np.ndarray, at: np.ndarray, values: np.ndarray, columns: int):
        self.ends, self.at, self.values = ends, at, values  # row i holds the entries from ends[i] to ends[i + 1]
        self.shape = len(ends) - 1, columns

    def __getitem__(self, rows: slice) -> np.ndarray:
        start, stop, _ = rows.indices(self.shape[0])
        made, inside = np.zeros((stop - start, self.shape[1])), slice(self.ends[start], self.ends[stop])
        made[np.repeat(np.arange(stop - start), np.diff(self.ends[start : stop + 1])), self.at[inside]] = self.values[inside]
        return made

    @property
    def T(self) -> "SparseRows":  # noqa: N802  (as arrays name it)
        order = np.argsort(self.at, kind="stable")
        owner = np.repeat(np.arange(self.shape[0], dtype=np.int32), np.diff(self.ends))
        ends = np.concatenate([[0], np.cumsum(np.bincount(self.at, minlength=self.shape[1]))])
        return SparseRows(ends, owner[order], self.values[order], self.shape[0])


def _blocks(matrix: np.ndarray | SparseRows) -> Iterator[np.ndarray]:
    """The rows of a matrix, about ``BLOCK_CELLS`` cells of it at a time."""
    step = max(1, BLOCK_CELLS // matrix.shape[1])
    for at in range(0, matrix.shape[0], step):
        yield matrix[at : at + step]


def _squares(matrix: np.ndarray | SparseRows) -> np.ndarray:
    """``matrix.T @ matrix``; beside it only blocks are held."""
    n = matrix.shape[1]
    made, step = np.zeros((n, n)), max(1, BLOCK_CELLS // n)
    for block in _blocks(matrix):
        for at in range(0, n, step):
            made[at : at + step, : at + step] += block[:, at : at + step].T @ block[:, : at + step]
    for at in range(0, n, step):
        made[:at, at : at + step] = made[at : at + step, :at].T
    return made


def _leading(square: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix without negative ones, largest first, and their vectors.

    The whole decomposition of a large matrix takes five times its memory.  There a basis of powers of the matrix is
    built from a block of vectors, the best vectors in it begin the next one, until they are exact to rounding.
    """
    n = len(square)
    if n > max(WHOLE, 2 * DEPTH * k):
        block = np.linalg.qr(np.random.default_rng(0).standard_normal((n, 2 * k)))[0]
        for _ in range(CYCLES):
            basis, images = block, square @ block
            for _ in range(DEPTH - 1):
                block = images[:, -2 * k :]
                for _ in range(3):  # rounding errors of one pass go with the next
                    block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
                basis, images = np.hstack([basis, block]), np.hstack([images, square @ block])
            inner = basis.T @ images
            values, turned = np.linalg.eigh((inner + inner.T) / 2)
            values, turned = values[::-1], turned[:, ::-1][:, : 2 * k]
            block = basis @ turned
            if np.linalg.norm(images @ turned[:, :k] - block[:, :k] * values[:k], axis=0).max() <= 1e-13 * values[0]:
                return values[:k], block[:, :k]
            block = np.linalg.qr(block)[0]
    values, vectors = np.linalg.eigh(square)
    return values[::-1][:k], vectors[:, ::-1][:, :k]


def _axes(weighted: np.ndarray | SparseRows, dimensions: int) -> np.ndarray:
    """The first right singular vectors, from the square matrix of rows or of columns, whichever are fewer."""
    rows, columns = weighted.shape
    if columns <= rows:
        return np.ascontiguousarray(_leading(_squares(weighted), dimensions)[1])
    turned = weighted.T
    squares, vectors = _leading(_squares(turned), dimensions)
    some = squares > 1e-12 * max(squares[0], 1e-300)
    return _product(turned, vectors[:, some] / np.sqrt(squares[some]))


def _product(matrix: np.ndarray | SparseRows, right: np.ndarray) -> np.ndarray:
    return np.concatenate([block @ right for block in _blocks(matrix)])


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, max_labelled: int = 4096,
        dimensions: int = 32, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on at most ``max_labelled`` labelled texts; None if there is none with any term.

    ``learn_from`` chooses the label rows to learn from.  Ids with several labels take their mean; null
    ids, labels and texts are left out.
    """
    learn_from = F.lit(True) if learn_from is None else learn_from
    rows = _sample(docs, labels, learn_from, max_labelled, id_col, text_col, label_col)
    sparse = [np.frombuffer(r.terms, np.float32).reshape(2, -1) for r in rows]
    seen = np.concatenate([s[0] for s in sparse]).astype(np.int32) if rows else np.zeros(0, np.int32)
    used, texts = np.unique(seen, return_counts=True)  # a text names a term once
    if not len(used):
        return None
    column_of = np.full(N_TERMS, len(used), np.int64)
    column_of[used] = np.arange(len(used))
    weights = np.log((1 + len(rows)) / (1 + texts)) + 1
    at = column_of[seen].astype(np.int32)
    ends = np.concatenate([[0], np.cumsum([s.shape[1] for s in sparse])])
    weighted = SparseRows(ends, at, np.concatenate([s[1] for s in sparse]) * weights[at], len(used))
    axes = _axes(weighted, dimensions)
    made = _product(weighted, axes)
    lengths = np.linalg.norm(made, axis=1)
    some = lengths > 1e-12
    unit = made[some] / lengths[some, None]
    return Model(column_of, weights, axes, unit, np.array([r.label for r in rows])[some])


def vote(vectors: np.ndarray, model: Model, neighbours: int = 15, power: float = 8.0) -> np.ndarray:
    """Mean label of the ``neighbours`` most similar labelled texts (all that tie with the last one), weighted by
    similarity to ``power``; 0 for zero vectors."""
    step = max(1, SCORE_CELLS // len(model.vectors))
    if len(vectors) > step:
        parts = [vectors[at : at + step] for at in range(0, len(vectors), step)]
        return np.concatenate([vote(part, model, neighbours, power) for part in parts])
    similar = vectors @ model.vectors.T
    k = min(neighbours, similar.shape[1])
    last = np.partition(similar, -k, axis=1)[:, -k][:, None]
    rows, near = np.nonzero(similar >= last - 1e-9)
    weights = np.clip(similar[rows, near], 1e-6, None) ** power
    n = len(vectors)
    scores = np.bincount(rows, weights * model.labels[near], n) / np.bincount(rows, weights, n)
    return np.where(np.abs(vectors).sum(1) > 0, scores, 0.0).round(6)


def scores(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.7, block: int = 512,
           score_col: str = "score", label_col: str = "predicted") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) for every row.

    A text that is null, empty or holds no term the model knows scores 0: nothing speaks for it.  Without a model
    (no labelled text) every score is 0.5.  Repeated rows get equal scores; columns of ``docs`` that have the
    names of the new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in (score_col, label_col)]
    if model is None:
        scored = docs.select(*kept).withColumn(score_col, F.lit(0.5))
        return scored.withColumn(label_col, (F.col(score_col) >= threshold).cast("int"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def voted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            made = [np.zeros(0)]
            for part in byte_slices(texts, rows=block):
                step = [t or b"" for t in part.cast(pa.binary()).to_pylist()]
                made.append(vote(shared.value.project(step), shared.value))
            yield pa.array(np.concatenate(made), pa.float64())

    score = F.arrow_udf(voted, "double")
    scored = docs.select(*kept).withColumn(score_col, score(docs[text_col]))
    return scored.withColumn(label_col, (F.col(score_col) >= threshold).cast("int"))


def in_hold_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether the row belongs to the held-out fold, by the CRC-32 of the id as text; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id") -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row; the held-out fold is never learnt from.

    See ``scores`` for texts without content and tables without labels.
    """
    model = fit(docs, labels, learn_from=~in_hold_out(id_col), id_col=id_col)
    rows = docs.select(docs[id_col].alias(id_col), docs["text"].alias("text"))
    return scores(rows, model, threshold=threshold).select(
        id_col, in_hold_out(id_col).alias("held_out"), "score", "predicted"
    )
