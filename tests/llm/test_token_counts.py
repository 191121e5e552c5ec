import public_tokenizers
import pytest

from tokenizers import Tokenizer

from hirelens.llm import token_counts as tc

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, n_tokens string"
TEXTS = [
    None, "", " ", "one", "\n\t", "Ünïcode é ́x ΑΣ ςΣ", "a<|endoftext|>b <|startoftext|> c", "don't 12 3.4 !!??",
    "word " * 40_000, "x" * 90_000, "ab ́cd " * 20_000, "日本語 " * 9_000 + "end", "a b " * 30_000,
]

def expected(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)

def test_counts_match_the_library(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(0, "one", None), (None, "two words", "x")]
    got = tc.token_counts(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    key = lambda r: tuple(str(v) for v in r)
    want = [(i, len((t or "").encode()), expected(t), expected(t) > 2048) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)

def test_empty_table(spark):
    made = tc.token_counts(spark.createDataFrame([], SCHEMA), PATH)
    assert made.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and made.count() == 0

@pytest.mark.parametrize("most", [5, 40, 1000])
def test_pieces_are_lossless_but_for_the_blanks_cut_at(most):
    text = "ab cd\nef, gh  ij é kl " * 30
    pieces = tc.split_safely(text, most)
    assert sum(map(len, pieces)) + len(pieces) - 1 == len(text)
    assert sum(len(e) for e in Tokenizer.from_file(PATH).encode_batch(pieces, add_special_tokens=False)) == expected(text)

def test_sentencepiece_models(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    got = tc.token_counts(spark.createDataFrame([(1, "some plain words")], "doc_id bigint, text string"), path).first()
    assert got.n_tokens == len(sentencepiece.SentencePieceProcessor(model_file=path).encode("some plain words"))

def test_whole_table_matches_the_library(spark):
    import pandas as pd

    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    encoded = Tokenizer.from_file(PATH).encode_batch(docs.text.tolist(), add_special_tokens=False)
    got = tc.token_counts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH).toPandas()
    merged = got.set_index("doc_id").n_tokens
    assert [merged[i] for i in docs.doc_id] == [len(e) for e in encoded]

def test_a_word_is_encoded_once_and_few_are_remembered(monkeypatch):
    encoded, encode = [], tc._encoder(PATH)
    monkeypatch.setattr(tc, "_encoder", lambda path: lambda texts: encoded.extend(texts) or encode(texts))
    monkeypatch.setattr(tc, "WORDS", 9)
    tc._known_words(PATH).clear()
    text = "plain words, plain words,\nplain " * 50
    assert tc.count_texts([text, text], PATH, True) == [expected(text)] * 2
    assert sorted(encoded) == ["", "plain", "words,"]
    many = " ".join(f"w{i} {'x' * 60}{i} <|endoftext|>ς ́y" for i in range(200))
    assert tc.count_texts([many, text], PATH, True) == [expected(many), expected(text)]
    assert len(tc._known_words(PATH)) <= 9 and max(map(len, tc._known_words(PATH))) <= tc.WORD_CHARS

def test_random_texts_match_the_library():
    import random

    pick = random.Random(4)
    parts = [" ", " ", " ", "\n", "\t", "\r\n", " ", " ", "\u0085", "\x1c", "​", "a", "Be", "'", "'s", "12", "́", "̧", "é", "Σ", "İ",
             "<|endoftext|>", "<|startoftext|>", "<|", "!?", "日本", "\U0001f600", "하", "ᆫ", "_"]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 30))) for _ in range(3000)]
    assert tc._drops_white_space(PATH)
    assert tc.count_texts(texts, PATH, True) == [expected_many(t) for t in texts]

def expected_many(text, library=Tokenizer.from_file(PATH)):
    return len(library.encode(text, add_special_tokens=False).ids)
