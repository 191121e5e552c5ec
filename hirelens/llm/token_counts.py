"""Token counts of whole texts, without keeping any token.

Texts are encoded in Arrow batches inside ``mapInArrow``; only lengths come back.
Batches are balanced by bytes.  Where no token can span white space, texts are cut into words, and a worker encodes
a word once for as long as it remembers it.
"""

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from hirelens.llm.common import byte_steps

# Longest piece of a text and largest batch that are encoded at once, in characters.
PIECE_CHARS = 32_768
BATCH_CHARS = 262_144
# Words that a worker remembers, and the longest of them, in characters; longer ones are encoded each time.
WORDS, WORD_CHARS = 500_000, 48

# One blank or line end between two ASCII letters or digits: the vocabulary drops white space, normal forms
# never join characters across it, and no special string holds one.
_SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9])[ \n](?=[A-Za-z0-9])")


@lru_cache(maxsize=4)
def _encoder(path: str):
    """A function from texts to token counts, loaded once per Python worker."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def split_safely(text: str, most: int = PIECE_CHARS) -> list[str]:
    """Pieces of ``text`` of at most about ``most`` characters, cut at safe boundaries; the blank cut at is dropped.

    A stretch without a safe boundary stays whole, however long it is.
    """
    pieces, start = [], 0
    while len(text) - start > most:
        cut = None
        for cut in _SAFE_CUT.finditer(text, start + most // 2, start + most):
            pass
        cut = cut or _SAFE_CUT.search(text, start + most)
        if cut is None:
            break
        pieces.append(text[start : cut.start()])
        start = cut.end()
    return [*pieces, text[start:]]


@lru_cache(maxsize=4)
def _known_words(path: str) -> dict[str, int]:
    """Tokens of the words met so far, kept per Python worker."""
    return {}


def _encode_words(words: list[str], path: str) -> dict[str, int]:
    """Tokens of each word, encoded in batches balanced by size."""
    encode, found, batch, held = _encoder(path), {}, [], 0
    for word in words:
        if batch and held + len(word) > BATCH_CHARS:
            found.update(zip(batch, encode(batch)))
            batch, held = [], 0
        batch.append(word)
        held += len(word)
    found.update(zip(batch, encode(batch)))
    return found


def count_words(text: str, path: str) -> int:
    """Tokens of a text as the sum over its words, cut at blanks and line ends."""
    known, total = _known_words(path), 0
    for piece in split_safely(text):
        words = piece.replace("\n", " ").split(" ")
        new = set(words).difference(known)
        if len(known) + len(new) > WORDS:
            known.clear()
            new = set(words)
        if new:
            known.update(_encode_words(list(new), path))
        total += sum(map(known.__getitem__, words))
        for word in new:
            if len(word) > WORD_CHARS:
                del known[word]
    return total


def count_texts(texts: list[str], path: str, splittable: bool) -> list[int]:
    """Tokens of each text; whole texts are encoded together, in batches balanced by size."""
    if splittable:
        return [count_words(text, path) for text in texts]
    encode, counts, owners, batch, held = _encoder(path), [0] * len(texts), [], [], 0

    def flush() -> None:
        for owner, n in zip(owners, encode(batch)):
            counts[owner] += n
        owners.clear()
        batch.clear()

    for i, text in enumerate(texts):
        if batch and held + len(text) > BATCH_CHARS:
            flush()
            held = 0
        owners.append(i)
        batch.append(text)
        held += len(text)
    if batch:
        flush()
    return counts


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row, repeated rows included.

    A null text counts as empty (0 bytes, 0 tokens); a null id stays null; other columns are ignored.
    An empty table gives an empty result.  Texts are cut into words only for tokenizers that drop white
    space (``.json`` word vocabularies); others encode each text whole.
    """
    splittable = tokenizer_path.endswith(".json") and _drops_white_space(tokenizer_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_steps(batches, "text"):
            texts = part.column("text")
            n = count_texts(texts.to_pylist(), tokenizer_path, splittable)
            sizes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), sizes, pa.array(n, pa.int64())], names=names)

    names = ["id", "n_bytes", "n_tokens"]
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


@lru_cache(maxsize=4)
def _drops_white_space(path: str) -> bool:
    """Whether cutting at blanks and line ends leaves the tokens as they are, tried on a sample."""
    from tokenizers import Tokenizer

    if any(" " in t.content or "\n" in t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()):
        return False
    encode = _encoder(path)
    return encode([" ", "\n"]) == [0, 0] and all(
        encode([text])[0] == sum(encode(re.split("[ \n]", text)))
        for text in ("one two 3 four", "It 's, (so)  I'll go.\n\n12 3.4 !! ?", "e \u0301 \u0301x \u3042 \u65e5\u672c \u03a3 \u03b1\u03a3 ", " a\tb \r\nc")
    )
