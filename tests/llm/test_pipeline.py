import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F


import corpus_pipeline
from hirelens.llm import decontaminate, packing, quality
from hirelens.llm.common import ARROW_BYTES, STEP_BYTES, read
from test_decontaminate import plain_leaks
from test_mixing import plain_targets
from test_simhash import plain_components, plain_fingerprint, within

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage."""
    docs, made = read(spark, SF, "documents"), []
    for _, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF)
        made.append((docs, out.cache()))
        docs = made[-1][1]
    return made


def test_stages_and_columns(stages):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for docs, out in stages[:-1]:
        assert out.schema == docs.schema and 0 < out.count()


def test_rejected_documents_go(spark, stages):
    docs, out = stages[0]
    scores = quality.quality_scores(docs, read(spark, SF, "labels")).toPandas().set_index("doc_id").score
    assert sorted(r.doc_id for r in out.collect()) == sorted(scores.index[scores >= 0.7])
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in out.collect()}
    assert (labels.doc_id.isin(kept) == (labels.quality == 1)).mean() > 0.97


def test_one_document_of_each_group_stays(stages):
    docs, out = stages[1]
    nodes = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(plain_components(nodes, within(4)).values()))


def test_leaking_documents_go(spark, stages):
    docs, out = stages[2]
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # Aligning all words of all pairs takes long in plain Python: first those that share enough words.
    leaking = set()
    for i, text in rows:
        words = Counter(decontaminate.words_of(text))
        near = [(k, t) for k, t in items if sum((Counter(decontaminate.words_of(t)) & words).values())
                >= 0.6 * len(decontaminate.words_of(t))]
        leaking |= {d for d, _ in plain_leaks([(i, text)], near)}
    assert leaking and sorted(r.doc_id for r in out.collect()) == sorted(i for i, _ in rows if i not in leaking)


def test_mix_meets_its_targets(stages):
    docs, out = stages[3]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += count(r.text)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        taken[r.source] += count(r.text)
        assert r.text in texts[r.doc_id]
    assert all(abs(taken[s] - t) <= 0.5 + 1e-6 for s, t in plain_targets(dict(sizes)).items())


def test_all_tokens_are_packed(stages):
    docs, out = stages[4]
    encode = packing._encoder(packing_path())
    want = Counter()
    for r in docs.collect():
        want[r.doc_id] += len(encode(r.text)) + 1
    got = Counter()
    for r in out.collect():
        for doc, n in zip(r.doc_ids, np.diff(r.cu_seqlens).tolist()):
            got[doc] += n
    assert got == want


def packing_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_run_packs_the_same(spark, stages):
    """Shards follow partitions, which differ between cached and stored stages; what they hold does not."""
    run, cached = (packing.document_digests(d).orderBy("doc_id").collect() for d in (corpus_pipeline.run(spark, SF), stages[-1][1]))
    assert run == cached


def test_without_labels_all_documents_stay(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = read(spark, SF, "documents")
    assert corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_odd_documents(spark, tmp_path):
    """Nulls in every column, empty, long and repeated rows, clashing columns, empty tables."""
    good = "Some plain words of a text, and then more of them. They go on and on. "
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, None, None, None, None, "s"), (1, good, None, None, None, "s"), (1, good, "en", "a", 5, "s"),
            (2, "", "en", "a", 0, "s"), (3, good * 3000 + "end", "en", "b", 1, None), (4, good + item, "en", "b", 1, "s"),
            (5, item.upper() + " and some more words here", "en", None, 1, "s"), (None, good + "x", "en", "c", 1, "s")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    labels = [(i, int(i < 130)) for i in range(100, 160)]
    known = [(i, (good if y else "%%% &&& !!! ***") + " ab" * (i % 5), "en", "a", 1, "s") for i, y in labels]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (rows + known, []):
        docs = spark.createDataFrame(given, schema)
        for _, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, docs, str(tmp_path)).cache()
            assert out.columns == docs.columns
            docs = out
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        left = {r.doc_id for r in docs.collect()}
        assert {d for r in packed for d in r.doc_ids} == left
        assert not left & {2, 4, 5} and not any(i is not None and i >= 130 for i in left)
        assert not given or left


def test_columns_named_like_those_inside_come_back(spark):
    """Extra columns with the names that stages use for themselves keep their values."""
    from hirelens.llm import mixing, simhash
    from hirelens.llm.common import free_name

    assert free_name("_a", ["x"]) == "_a" and free_name("_a", ["_A", "__a"]) == "___a"
    extra = "_mix_row int, _mix_spans string, _fingerprint string, _score double, _accepted int"
    rows = [(i, f"text number {i} " * 9, "en", "s", 1, 7, "spans", "print", 0.5, 3) for i in (1, 2, 2, 3)] + [(2, "other words here", "en", "s", 1, 7, "spans", "print", 0.5, 3)]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")
    names = [c.split()[0] for c in extra.split(", ")]
    mixed = mixing.mixed_documents(docs)
    groups = simhash.simhash_groups(docs, shingle_words=4, distance=4, first_col="first")
    deduped = simhash.keep_first(docs, groups, shingle_words=4, first_col="first")
    scored = corpus_pipeline.quality_classifier(spark, docs, "/root/testdata/sf0.001")
    for made in (mixed, deduped, scored):
        assert made.columns == docs.columns
        assert {tuple(r) for r in made.select(*names).collect()} <= {(7, "spans", "print", 0.5, 3)}
    assert deduped.filter("doc_id = 2").count() == 2


def test_long_stretches_are_written_in_steps(spark, monkeypatch):
    from hirelens.llm import mixing

    monkeypatch.setattr(mixing, "STEP_BYTES", 200)
    docs = spark.createDataFrame([(i, "word " * 100, "en", "s", 500) for i in range(40)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    made = mixing.mixed_documents(docs)
    assert made.selectExpr("sum(size(split(trim(text), ' ')))").first()[0] == 4000
    assert made.filter("length(text) <> n_chars").count() == 0


def test_stages_hand_bounded_batches_to_python(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("abcd "), 500).alias("text"))
    long = spark.range(0, 3, 1, 1).select(F.repeat(F.lit("abcd "), 1 << 20).alias("text"))
    for _, function in corpus_pipeline.STAGES:
        spark.conf.unset(ARROW_BYTES)
        function(spark, read(spark, SF, "documents"), SF)
        got = texts.mapInArrow(sizes, "n bigint, size bigint").collect()
        assert sum(r.n for r in got) == 6000 and max(r.size for r in got) < STEP_BYTES * 1.1
        assert [r.n for r in long.mapInArrow(sizes, "n bigint, size bigint").collect()] == [1, 1, 1]
    try:  # a bound that the user has set stays
        spark.conf.set(ARROW_BYTES, "1m")
        corpus_pipeline.STAGES[0][1](spark, read(spark, SF, "documents"), SF)
        assert spark.conf.get(ARROW_BYTES) in ("1m", "1048576b")
    finally:
        spark.conf.unset(ARROW_BYTES)
