"""The physical plans are the ones meant: what is read, what is shuffled, what is broadcast."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from hirelens.operators.skills import dedupe_gazetteer, extract_skills
from hirelens.operators.staging import stage
from hirelens.plans import enrich, marts, pairs, reports
from hirelens.schemas import JOBS

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in contract.queries().items() if n not in contract.CORPUS_QUERIES}
TOP_K = [
    "report_top_skills", "report_top_trends", "report_top_pairs", "report_salary_by_skill", "report_top_risers",
    "report_top_fallers", "report_salary_trend", "report_country_trend", "country_snapshot", "salary_by_skill_top",
    "top_risers", "top_fallers",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_all_work_stays_in_the_jvm_and_no_join_is_a_product(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for forbidden in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text
    if name in TOP_K:
        assert "TakeOrderedAndProject" in text


@pytest.fixture(scope="module")
def stored(spark):
    """Stored tables, so that scans show what they read."""
    jobs = spark.createDataFrame(
        [(1, "t", "SQL and R", "c", "s", date(2024, 1, 2), "Paris | France", "5k", "u", None)], JOBS
    )
    t = {
        "jobs": jobs,
        "skills": spark.createDataFrame([(1, "SQL", None)], "skill_id long, skill_raw string, skill_norm string"),
        "jobs_skills": spark.createDataFrame([(1, 1)], "job_id long, skill_id long"),
        "compensation": spark.createDataFrame(
            [(1, 1.0, 2.0, "USD", "year", 0.8)],
            "job_id long, min double, max double, currency string, period string, parsed_confidence double"),
        "locations": spark.createDataFrame(
            [(1, "A", None, "B", 1.0, 2.0, 0.6)],
            "job_id long, city string, state string, country string, lat double, lon double, geocode_confidence double"),
    }
    return {name: stage(df, name) for name, df in t.items()}


def test_scans_read_only_what_they_need(stored):
    text = plan(enrich.enrich_compensation(stored["jobs"], stored["compensation"]))
    assert "ReadSchema: struct<job_id:bigint,salary_raw:string>" in text
    assert "Not(EqualTo(salary_raw,))" in text
    assert "ReadSchema: struct<job_id:bigint,post_date:date>" in plan(marts.monthly_skill_counts(stored))
    assert "PushedFilters: [IsNotNull(lat), IsNotNull(lon)]" in plan(reports.geo_points(stored))
    text = plan(marts.monthly_salary_by_skill(stored))
    assert "Or(IsNull(period),EqualTo(period,year))" in text and "IsNotNull(min), IsNotNull(max)" in text


def test_month_range_reaches_the_scan(spark):
    mart = stage(spark.createDataFrame([(date(2024, 1, 1), "A", 1)], "month date, country string, job_count long"), "m")
    text = plan(reports.country_snapshot(mart, date(2024, 1, 1), date(2024, 2, 1), ["A"]))
    assert "GreaterThanOrEqual(month,2024-01-01)" in text and "LessThanOrEqual(month,2024-02-01)" in text
    assert "EqualTo(country,A)" in text


def test_phrase_match_shuffles_nothing_and_cuts_texts_once(spark, stored):
    words = stage(dedupe_gazetteer(spark.createDataFrame([(1, "SQL"), (2, "Power BI")], "pos long, skill string")), "g")
    text = plan(extract_skills(stored["jobs"], words))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "RoundRobin" not in text
    assert text.count("regexp_extract_all(") == 1


def test_pairs_shuffle_links_and_pairs_once(stored):
    text = plan(pairs.pair_counts(stored["jobs_skills"], stored["skills"]))
    assert text.count("Exchange hashpartitioning(job_id") == 1
    assert text.count("Exchange hashpartitioning(skill_id_a") == 1
    assert "REPARTITION" not in text


def test_pairs_of_a_table_bucketed_by_posting_do_not_shuffle_it(spark, stored):
    stored["jobs_skills"].write.mode("overwrite").bucketBy(3, "job_id").saveAsTable("bucketed_links")
    try:
        text = plan(pairs.pair_counts(spark.table("bucketed_links"), stored["skills"]))
        assert "hashpartitioning(job_id" not in text
    finally:
        spark.sql("DROP TABLE bucketed_links")


def test_counts_need_no_distinct_stage(stored):
    text = plan(marts.skill_counts(stored))
    assert "count(1)" in text and "distinct" not in text


def test_spread_only_for_scans_with_few_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    assert enrich.spread_for(spark.range(0, 10, 1, 1)) == 4 * cores
    assert enrich.spread_for(spark.range(0, 10, 1, 2 * cores)) is None


def test_hot_key_is_split_by_the_salt(spark):
    from hirelens.operators.lookup import lookup_join

    facts = spark.range(10000).select("id", F.lit("hot").alias("name"))
    table = spark.createDataFrame([("hot", 1)], "name string, v int")
    joined = lookup_join(facts, table, "name", spread_by=["id"], small=False, salts=16)
    assert "name#" in plan(joined) and "_salt" in plan(joined)
    assert joined.count() == 10000


def test_a_repeated_table_is_never_broadcast(spark):
    from hirelens.operators.lookup import lookup_join

    facts = spark.range(100).select("id", F.concat(F.lit("p"), F.col("id") % 7).alias("name"))
    table = spark.createDataFrame([(f"p{i}", i) for i in range(5)], "name string, v int")
    joined = lookup_join(facts, table, "name", "left", spread_by=["id"], small=False)
    got = {(r["id"], r["v"]) for r in joined.collect()}
    assert "Broadcast" not in plan(joined)
    assert got == {(i, i % 7 if i % 7 < 5 else None) for i in range(100)}


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_key_checks_deal_large_tables_by_key(spark, monkeypatch):
    from hirelens.operators import lookup

    few = QUERIES["pk_violations"](spark, SF_DIR)
    assert "REPARTITION_BY_NUM" not in plan(few)
    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 100)
    many = QUERIES["pk_violations"](spark, SF_DIR)
    assert plan(many).count("Exchange hashpartitioning(job_id") >= 2 and "REPARTITION_BY_NUM" in plan(many)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def test_tables_are_dealt_by_their_rows(spark, monkeypatch):
    from hirelens.operators import lookup

    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 10)
    rows = spark.range(0, 400, 1, 3)
    assert lookup.deal_by_key(rows, 10, "id").rdd.getNumPartitions() == 3
    assert lookup.deal_by_key(rows, 400, "id").rdd.getNumPartitions() == 40
    assert lookup.deal_by_key(rows, 11, "id").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_links_of_wide_postings_are_made_distinct_once(spark, monkeypatch):
    from hirelens.operators import lookup

    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(pairs, "fits_broadcast", lambda df: False)
    links = [(job, skill) for job in range(40) for skill in range(1 + job % 7)] * 2
    got = pairs.pair_counts(
        spark.createDataFrame(links, "job_id long, skill_id long"), spark.range(7).withColumnRenamed("id", "skill_id"), wide_skills=3, block=2
    )
    text = plan(got)
    assert text.count("wide_links-") >= 2 and "REPARTITION_BY_NUM" in text
    want = {}
    for job in range(40):
        for a in range(1 + job % 7):
            for b in range(a + 1, 1 + job % 7):
                want[a, b] = want.get((a, b), 0) + 1
    assert {(r["skill_id_a"], r["skill_id_b"]): r["pair_count"] for r in got.collect()} == want
