"""

Every query reads whole tables of the given directory, derives posting tables
from them (``derived_tables``) and applies one operator of the library.
``oracle_sql`` states the same result in SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from functools import partial, reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F  # noqa: E402

from derived_tables import frames, with_clause  # noqa: E402
from hirelens import schemas  # noqa: E402
from hirelens.functions.dates import infer_format, month_of, parse_post_date  # noqa: E402
from hirelens.functions.location import parse_location  # noqa: E402
from hirelens.functions.salary import parse_salary  # noqa: E402
from hirelens.functions.text import place_name  # noqa: E402
from hirelens.operators import geo, quality, skills, upsert  # noqa: E402
from hirelens.operators.ids import dense_ids  # noqa: E402
from hirelens.operators.lookup import BROADCAST_ROWS, deal_by_key, lookup_join  # noqa: E402
from hirelens.operators.staging import scratch_path, stage  # noqa: E402
from hirelens.plans import enrich, marts, pairs, refresh, reports  # noqa: E402
from hirelens.sources.tables import TableStore  # noqa: E402

# The training-data operators are an optional part, as are the packages they need.
CORPUS_QUERIES, CORPUS_SQL = {}, {}
try:
    from hirelens.llm import queries as corpus_queries
except ImportError as missing:
    print(f"without the training-data operators: {missing}", file=sys.stderr)
else:
    CORPUS_QUERIES |= corpus_queries.QUERIES
    CORPUS_SQL |= corpus_queries.ORACLE_SQL
    try:
        import corpus_pipeline
    except ImportError as missing:
        print(f"without the corpus pipeline: {missing}", file=sys.stderr)
    else:
        CORPUS_QUERIES["pipeline"] = corpus_pipeline.run
        CORPUS_SQL |= {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}

SKILL_TABLES = ("v_jobs", "v_skills", "v_jobs_skills")
PAY_TABLES = SKILL_TABLES + ("v_compensation",)
PLACE_TABLES = ("v_jobs", "v_locations")
MONTHLY_PLACES = ("v_jobs", "v_stored_places")

RANGE = (date(1996, 1, 1), date(2000, 6, 1))
SKILLS = ["red plate", "SMALL RING", "blue bolt", "hot rod"]
COUNTRIES = ["NATION_1", "NATION_3", "NATION_7", "Unknown"]

# ---- dictionary taken from the texts of the benchmark table ----

# Words and what stands between them, in turn.
PIECES = r"\p{L}+|[^\p{L}]+"


def phrase_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dictionary entries: all words of the benchmark texts, and all neighbours with a blank or a comma and a blank between."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    cut = items.select("item_id", F.regexp_extract_all("text", F.lit(PIECES), F.lit(0)).alias("p"))
    near = F.transform("p", lambda x, i: F.when(F.get("p", i + 1).isin(" ", ", "), F.concat(x, F.get("p", i + 1), F.get("p", i + 2))))
    found = F.filter(F.concat("p", near), lambda x: x.rlike(r"^\p{L}+(,? \p{L}+)?$"))
    return cut.select(F.col("item_id").alias("pos"), F.explode(found).alias("skill"))


def _gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary as a stored table: it is measured, listed and joined in separate jobs."""
    return stage(skills.dedupe_gazetteer(phrase_entries(spark, sf_dir)), "gazetteer")


def _matches(spark: SparkSession, sf_dir: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    texts = frames(spark, sf_dir, "v_text")["text"]
    return skills.extract_skills(texts, _gazetteer(spark, sf_dir), spread=enrich.spread_for(texts), max_rows=max_rows)


def _known_skills(entries: DataFrame) -> DataFrame:
    """A skills table that already holds the capitalized single-word entries."""
    words = entries.filter(F.col("skill").rlike(r"^\p{Lu}\p{L}*$"))
    first = words.groupBy(F.lower("skill").alias("skill_norm")).agg(F.min("pos").alias("pos"))
    return dense_ids(first, "skill_id", order_by=["pos", "skill_norm"]).select(
        "skill_id", F.col("skill_norm").alias("skill_raw"), "skill_norm"
    )


def _parsed_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_salary(frames(spark, sf_dir, "v_salary_raw")["salary_raw"])


def _checked_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables with violations: unmerged links, pay rows per customer, keys moved past their parents."""
    t = frames(spark, sf_dir, "v_jobs", "v_skills", "v_links", "v_compensation", "v_locations", "v_salary_raw", "orders")
    rows = t["orders"].count()
    titles = t["salary_raw"].select("job_id", F.col("salary_raw").alias("title_raw"))
    return {
        "jobs": deal_by_key(t["jobs"], rows, "job_id").join(deal_by_key(titles, rows, "job_id"), "job_id"),
        "skills": t["skills"].withColumnRenamed("skill_raw", "_raw").withColumn("skill_raw", F.col("skill_norm")),
        "jobs_skills": t["links"].select((F.col("job_id") * 2).alias("job_id"), (F.col("skill_id") + 5).alias("skill_id")),
        "compensation": t["orders"].select(F.expr("nullif(o_custkey, 7)").alias("job_id")),
        "locations": t["locations"].select(F.expr("CASE WHEN country IS NOT NULL THEN job_id + 1000 END").alias("job_id")),
    }


# ---- queries ----


def _on(names: tuple[str, ...], plan: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plan(frames(spark, sf_dir, *names))


def _monthly_countries(t) -> DataFrame:
    """Some postings have no place: they count as unknown."""
    return marts.monthly_jobs_by_country({"jobs": t["jobs"], "locations": t["stored_places"]})


def _growth(t) -> DataFrame:
    return marts.skill_mom_growth(marts.monthly_skill_counts(t))


ROLLUPS = ("skill_counts", "monthly_skill_counts", "salary_by_skill", "monthly_salary_by_skill")


def _rollup(name: str, t) -> DataFrame:
    return refresh.marts_from_facts(stage(refresh.skill_facts(t), "facts"), t)[name]


def _pair_count(rows: DataFrame) -> DataFrame:
    return rows.groupBy("skill_id_a", "skill_id_b").agg(F.count(F.lit(1)).alias("pair_count"))


def _pairs_wide(t) -> DataFrame:
    """Unmerged links (with repeats); postings of more than three skills take the block plan, others the array plan."""
    return pairs.pair_counts(t["links"], t["skills"], wide_skills=3, block=2)


def _growth_shared_names(t) -> DataFrame:
    """Skills named by the last word of their name, so that several ids share one."""
    last = t["skills"].withColumn("skill_norm", F.substring_index("skill_raw", " ", -1))
    return marts.skill_mom_growth(marts.monthly_skill_counts({**t, "skills": last}))


def _geocode_salted(t) -> DataFrame:
    """The place lookup as it runs for place tables that are too large to broadcast."""
    table = t["places"].select(F.col("place").alias("_place"), F.col("lat").alias("place_lat"))
    named = t["locations"].select("job_id", place_name(F.col("city"), F.col("state"), F.col("country")).alias("_place"))
    return lookup_join(named, table, "_place", "left", spread_by=["job_id"], small=False).select("job_id", "place_lat")


def _twice(texts: DataFrame) -> DataFrame:
    """Every third posting a second time, with another text."""
    more = texts.filter("job_id % 3 = 0 AND location_raw <> ''").withColumn("location_raw", F.concat(F.lit("~"), "location_raw"))
    return texts.unionByName(more)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # marts
        "skill_counts": _on(SKILL_TABLES, marts.skill_counts),
        "monthly_skill_counts": _on(SKILL_TABLES, marts.monthly_skill_counts),
        "skill_cooccurrence": _on(SKILL_TABLES, marts.skill_cooccurrence),
        "salary_by_skill": _on(PAY_TABLES, marts.salary_by_skill),
        "jobs_by_country": _on(PLACE_TABLES, marts.jobs_by_country),
        "monthly_salary_by_skill": _on(PAY_TABLES, marts.monthly_salary_by_skill),
        "monthly_jobs_by_country": _on(MONTHLY_PLACES, _monthly_countries),
        "skill_mom_growth": _on(SKILL_TABLES, _growth),
        # the plans that a refresh runs, and those that large or unusual tables take
        **{f"rollup_{name}": _on(PAY_TABLES, partial(_rollup, name)) for name in ROLLUPS},
        "skill_cooccurrence_min": _on(SKILL_TABLES, lambda t: marts.skill_cooccurrence(t, min_count=5)),
        "pairs_wide": _on(("v_links", "v_skills"), _pairs_wide),
        "pairs_blocks": _on(("v_links",), lambda t: _pair_count(pairs.by_blocks(t["links"], block=2))),
        "growth_shared_names": _on(SKILL_TABLES, _growth_shared_names),
        "geocode_salted": _on(("v_locations", "v_places"), _geocode_salted),
        # reports
        "report_top_skills": _on(SKILL_TABLES, lambda t: reports.report_top_skills(marts.skill_counts(t))),
        "report_top_trends": _on(SKILL_TABLES, lambda t: reports.report_top_trends(marts.monthly_skill_counts(t))),
        "report_top_pairs": _on(SKILL_TABLES, lambda t: reports.report_top_pairs(marts.skill_cooccurrence(t))),
        "report_jobs_by_country": _on(PLACE_TABLES, lambda t: reports.report_jobs_by_country(marts.jobs_by_country(t))),
        "report_salary_by_skill": _on(PAY_TABLES, reports.report_salary_by_skill),
        "report_top_risers": _on(SKILL_TABLES, lambda t: reports.report_top_risers(_growth(t))),
        "report_top_fallers": _on(SKILL_TABLES, lambda t: reports.report_top_fallers(_growth(t))),
        "report_salary_trend": _on(PAY_TABLES, lambda t: reports.report_salary_trend(marts.monthly_salary_by_skill(t))),
        "report_country_trend": _on(
            MONTHLY_PLACES, lambda t: reports.report_country_trend(_monthly_countries(t))
        ),
        "skill_ranking": _on(SKILL_TABLES, lambda t: reports.skill_ranking(marts.skill_counts(t))),
        "country_snapshot": _on(
            MONTHLY_PLACES, lambda t: reports.country_snapshot(_monthly_countries(t), *RANGE, COUNTRIES)
        ),
        "trend_date_range": _on(
            SKILL_TABLES, lambda t: reports.between_months(marts.monthly_skill_counts(t), *RANGE)
        ),
        "trend_month_bounds": _on(SKILL_TABLES, lambda t: reports.trend_month_bounds(marts.monthly_skill_counts(t))),
        "distinct_countries": _on(
            MONTHLY_PLACES, lambda t: reports.distinct_countries(_monthly_countries(t))
        ),
        "skill_trend_selected": _on(
            SKILL_TABLES, lambda t: reports.skill_trend_selected(marts.monthly_skill_counts(t), *RANGE, SKILLS)
        ),
        "salary_by_skill_min_n": _on(PAY_TABLES, lambda t: reports.salary_by_skill_min_n(t, 450)),
        "salary_by_skill_top": _on(PAY_TABLES, lambda t: reports.salary_by_skill_top(t, 3, 20)),
        "salary_bands_long": _on(PAY_TABLES, lambda t: reports.salary_bands_long(reports.salary_by_skill_top(t))),
        "top_risers": _on(SKILL_TABLES, lambda t: reports.top_risers(_growth(t), *RANGE)),
        "top_fallers": _on(SKILL_TABLES, lambda t: reports.top_fallers(_growth(t), *RANGE)),
        "geo_points": _on(PLACE_TABLES, reports.geo_points),
        "geo_labels": _on(PLACE_TABLES, lambda t: reports.geo_labels(t, COUNTRIES)),
        "geo_labels_all": _on(PLACE_TABLES, reports.geo_labels),
        "jobs_count": _on(("v_jobs",), reports.jobs_count),
        # parsers
        "salary_parse": _parsed_pay,
        "salary_parse_thousands": _on(("v_salary_raw",), lambda t: parse_salary(t["salary_raw"], thousands=True)),
        "location_parse": _on(("v_location_raw",), lambda t: parse_location(t["location_raw"])),
        "post_date_parse": _on(("v_dates_raw",), lambda t: parse_post_date(t["dates_raw"])),
        "post_date_inferred": _on(("v_dates_dmy",), lambda t: parse_post_date(t["dates_dmy"], formats=[infer_format(t["dates_dmy"])])),
        # skills
        "gazetteer_dedupe": _on(("v_part_entries",), lambda t: skills.dedupe_gazetteer(t["part_entries"])),
        "skill_extract": _matches,
        # the plan that dictionaries beyond the broadcast bound take
        "skill_extract_bits": partial(_matches, max_rows=0),
        "skill_dictionary": _skill_dictionary,
        "skill_bridge": _skill_bridge,
        "skills_new_only": _skills_new_only,
        "bridge_insert_ignore": _bridge_insert_ignore,
        # keys and merges
        "ingest_assign_ids": _ingest_assign_ids,
        "upsert_compensation": _on(
            ("v_salary_raw", "v_stored_pay"),
            lambda t: enrich.enrich_compensation(t["salary_raw"], t["stored_pay"]),
        ),
        "upsert_locations": _on(
            ("v_location_raw", "v_stored_places"),
            lambda t: enrich.enrich_locations(t["location_raw"], t["stored_places"]),
        ),
        "upsert_locations_places": _on(
            ("v_location_raw", "v_stored_places", "v_places_twice"),
            lambda t: enrich.enrich_locations(_twice(t["location_raw"]), t["stored_places"], t["places_twice"], repeated_ids=True),
        ),
        # stored tables: marts after two loads, pay after a merge of some months
        "refresh_second_load": _second_load,
        "merge_touched_months": _merge_months,
        "geocode_lookup": _on(("v_locations", "v_places"), _geocode_lookup),
        "geocode_fallback": _on(("v_locations", "v_places_coarse"), _geocode_fallback),
        # integrity
        "pk_violations": lambda spark, sf_dir: quality.pk_violations(_checked_tables(spark, sf_dir)),
        "fk_orphans": lambda spark, sf_dir: quality.fk_orphans(_checked_tables(spark, sf_dir)),
        "not_null_violations": lambda spark, sf_dir: quality.not_null_violations(_checked_tables(spark, sf_dir)),
        **CORPUS_QUERIES,
    }


def _no_skills(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.SKILLS)


def _skill_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = skills.new_skills(_matches(spark, sf_dir), _no_skills(spark))
    return made.select("skill_id", "skill_raw", "skill_norm", "extractor_version")


def _skill_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = stage(_matches(spark, sf_dir), "matches")
    made = skills.new_skills(matches, _no_skills(spark))
    return skills.new_links(matches, made, spark.createDataFrame([], schemas.JOBS_SKILLS))


def _skills_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _known_skills(phrase_entries(spark, sf_dir))
    return skills.new_skills(_matches(spark, sf_dir), known).select("skill_id", "skill_raw", "skill_norm")


def _bridge_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the line items without the stored ones, those of the returned items."""
    t = frames(spark, sf_dir, "v_links", "v_part_skills", "lineitem")
    returned = t["lineitem"].filter("l_returnflag = 'R'")
    stored = returned.join(t["part_skills"], F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_orderkey").alias("job_id"), "skill_id"
    )
    return upsert.absent_rows(t["links"], stored, ["job_id", "skill_id"])


def _ingest_assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_post_date(frames(spark, sf_dir, "v_dates_raw")["dates_raw"])
    return dense_ids(rows.withColumnRenamed("job_id", "source_key"), "job_id", start=101, order_by=["source_key"])


def _geocode_lookup(t) -> DataFrame:
    return geo.geocode(t["locations"].drop("lat", "lon", "geocode_confidence"), t["places"])


def _geocode_fallback(t) -> DataFrame:
    return geo.geocode(t["locations"].drop("lat", "lon", "geocode_confidence"), t["places_coarse"], fallback=True)


# Postings of these orders come with a second load: some of the later months, and some undated ones.
_LATER = "o_orderdate >= DATE '1997-03-01' AND o_orderpriority IN ('1-URGENT', '5-LOW')"
# Every mart in one form: two ids, two names, a day, a count, two numbers.
_LONG_FORM = {
    "skill_counts": "skill_id, NULL, skill, NULL, last_seen, job_count, NULL, NULL",
    "monthly_skill_counts": "skill_id, NULL, skill, NULL, month, job_count, NULL, NULL",
    "skill_cooccurrence": "skill_id_a, skill_id_b, skill_a, skill_b, NULL, pair_count, NULL, NULL",
    "salary_by_skill": "skill_id, NULL, skill, NULL, NULL, n, avg_min, avg_max",
    "jobs_by_country": "NULL, NULL, country, NULL, NULL, jobs, NULL, NULL",
    "monthly_salary_by_skill": "NULL, NULL, skill, NULL, month, n, avg_min, avg_max",
    "monthly_jobs_by_country": "NULL, NULL, country, NULL, month, job_count, NULL, NULL",
    "skill_mom_growth": "NULL, NULL, skill, NULL, month, job_count, prev_job_count, mom_growth_pct",
}


def _long_form(mart: str, table: str) -> str:
    kinds = zip(_LONG_FORM[mart].split(", "), ("BIGINT", "BIGINT", "STRING", "STRING", "DATE", "BIGINT", "DOUBLE", "DOUBLE"),
                ("id", "other_id", "name", "other_name", "day", "n", "low", "high"))
    return f"SELECT '{mart}' AS mart, " + ", ".join(f"CAST({c} AS {kind}) AS {name}" for c, kind, name in kinds) + f" FROM {table}"


def _nulls(*columns: str) -> list[Column]:
    return [F.lit(None).alias(c) for c in columns]


def _load(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The posting tables with the month of the posting, and which postings come with the second load."""
    t = frames(spark, sf_dir, *PAY_TABLES, "v_locations", "v_salary_raw", "v_stored_pay", "orders")
    missing = [c for c in schemas.JOBS.fieldNames() if c not in ("job_id", "title_raw", "post_date", "salary_raw")]
    dated = t["jobs"].join(t["salary_raw"], "job_id").withColumn("month", month_of(F.col("post_date")))
    months = dated.select("job_id", "month")
    t["jobs"] = dated.select("*", F.lit("").alias("title_raw"), *_nulls(*missing))
    for name in ("jobs_skills", "compensation", "locations", "stored_pay"):
        t[name] = t[name].join(months, "job_id")
    t["skills"] = t["skills"].select("*", *_nulls("confidence", "extractor_version", "created_at"))
    return t, t["orders"].select(F.col("o_orderkey").alias("job_id"), F.expr(_LATER).alias("later"))


def _second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts of stored tables after two loads, the second of which refreshes only the months it touches."""
    t, is_later = _load(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "store"))
    store.append("skills", t["skills"], new_keys=True)
    for later in (False, True):
        ids = is_later.filter(F.col("later") == later).select("job_id")
        for name in ("jobs", "jobs_skills", "compensation", "locations"):
            store.append(name, t[name].join(ids, "job_id"), new_keys=True)
        made = refresh.refresh_marts(store)
    return reduce(DataFrame.unionByName, [spark.sql(_long_form(mart, "{m}"), m=made[mart]) for mart in refresh.MARTS])


def _merge_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored pay table after a merge of the postings of some months; the other months are not rewritten."""
    t, _ = _load(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "store"))
    store.append("compensation", t["stored_pay"])
    jobs = t["jobs"].filter(_MERGED)
    months = [r["month"] for r in jobs.select("month").distinct().collect()]
    return store.merge("compensation", enrich.parsed_pay(jobs), months)


# Postings of these months are parsed anew.
_MERGED = "post_date >= DATE '1997-03-01' OR post_date IS NULL"


def entry(spark: SparkSession) -> DataFrame:
    """Month-over-month growth of every skill."""
    return queries()["skill_mom_growth"](spark, "/root/testdata/sf0.001")


# ---- the same results in SQL ----

_NAME = "coalesce(skill_norm, skill_raw)"
_MONTH = "CAST(date_trunc('month', post_date) AS DATE)"


def _by_skill_id(values: str, source: str, more: str = "") -> str:
    """Aggregates of the links per skill id; names come after."""
    group = f"skill_id{more}"
    return f"(SELECT {group}, {values} FROM v_jobs_skills JOIN {source} GROUP BY ALL)"


_PAID = "(SELECT * FROM v_compensation WHERE min IS NOT NULL AND max IS NOT NULL) paid USING (job_id)"
_DATED = f"(SELECT job_id, {_MONTH} AS month FROM v_jobs WHERE post_date IS NOT NULL) dated USING (job_id)"

_MARTS = {
    "skill_counts": f"""
        SELECT skill_id, {_NAME} AS skill, job_count, last_seen
        FROM {_by_skill_id("count(DISTINCT job_id) AS job_count, max(post_date) AS last_seen", "v_jobs USING (job_id)")}
        JOIN v_skills USING (skill_id)""",
    "monthly_skill_counts": f"""
        SELECT skill_id, {_NAME} AS skill, month, job_count
        FROM {_by_skill_id("count(DISTINCT job_id) AS job_count", _DATED, ", month")} JOIN v_skills USING (skill_id)""",
    "skill_cooccurrence": """
        SELECT skill_id_a, (SELECT coalesce(skill_norm, skill_raw) FROM v_skills WHERE skill_id = skill_id_a) AS skill_a,
               skill_id_b, (SELECT coalesce(skill_norm, skill_raw) FROM v_skills WHERE skill_id = skill_id_b) AS skill_b, pair_count
        FROM (SELECT one.skill_id AS skill_id_a, other.skill_id AS skill_id_b, count(DISTINCT job_id) AS pair_count
              FROM v_jobs_skills one JOIN v_jobs_skills other USING (job_id)
              WHERE one.skill_id < other.skill_id GROUP BY ALL)""",
    "salary_by_skill": f"""
        SELECT skill_id, {_NAME} AS skill, avg_min, avg_max, n
        FROM {_by_skill_id("avg(min) AS avg_min, avg(max) AS avg_max, count(*) AS n", _PAID)} JOIN v_skills USING (skill_id)""",
    "jobs_by_country": "SELECT coalesce(country, 'Unknown') AS country, count(*) AS jobs FROM v_locations GROUP BY ALL",
    "monthly_salary_by_skill": f"""
        SELECT month, {_NAME} AS skill, sum(lo) / sum(n) AS avg_min, sum(hi) / sum(n) AS avg_max, CAST(sum(n) AS BIGINT) AS n
        FROM {_by_skill_id("sum(min) AS lo, sum(max) AS hi, count(*) AS n",
                           f"{_PAID} JOIN {_DATED} WHERE coalesce(period, 'year') = 'year'", ", month")}
        JOIN v_skills USING (skill_id) GROUP BY ALL""",
    "monthly_jobs_by_country": f"""
        SELECT month, coalesce(country, 'Unknown') AS country, count(DISTINCT job_id) AS job_count
        FROM (SELECT job_id, {_MONTH} AS month FROM v_jobs WHERE post_date IS NOT NULL) dated
        LEFT JOIN v_stored_places USING (job_id) GROUP BY ALL""",
}
# Percent with two decimals in whole numbers, halves away from zero.
_GROWTH = """
    SELECT skill, month, job_count, prev_job_count,
           CASE WHEN prev_job_count IS NULL OR prev_job_count = 0 THEN NULL
                ELSE CAST(sign(job_count - prev_job_count) AS BIGINT)
                     * ((2 * 10000 * abs(job_count - prev_job_count) + prev_job_count) // (2 * prev_job_count))
                     / 100.0 END AS mom_growth_pct
    FROM (SELECT *, CAST(lag(job_count) OVER (PARTITION BY skill ORDER BY month) AS BIGINT) AS prev_job_count
          FROM (SELECT skill, month, CAST(sum(job_count) AS BIGINT) AS job_count FROM monthly_skill_counts GROUP BY ALL))"""

_LO, _HI = (f"DATE '{d.isoformat()}'" for d in RANGE)
_IN_RANGE = f"month BETWEEN {_LO} AND {_HI}"


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _mart(name: str) -> str:
    return with_clause(*PAY_TABLES, *PLACE_TABLES, "v_stored_places") + _MARTS[name]


def _on_mart(name: str, select: str) -> str:
    """``select`` over one mart, or over the growth table."""
    head = with_clause(*PAY_TABLES, *PLACE_TABLES, "v_stored_places")
    base = "monthly_skill_counts" if name == "growth" else name
    head += f", {base} AS ({_MARTS[base]})"
    if name == "growth":
        head += f", growth AS ({_GROWTH})"
    return f"{head}\n{select}"


_PAY_MEANS = f"""
    SELECT {_NAME} AS skill, avg(c.min) AS avg_min, avg(c.max) AS avg_max, count(*) AS n
    FROM v_skills s JOIN v_jobs_skills js ON js.skill_id = s.skill_id JOIN v_compensation c ON c.job_id = js.job_id
    WHERE c.min IS NOT NULL AND c.max IS NOT NULL GROUP BY 1"""

_WS = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
_W = r"[\p{L}\p{N}_]"
# Signs that belong to a word are marked first, and read back after: joins between words (twice: neighbours share
# a word), a dot before a word, and a single plus between words, which does not belong to either.
_JOINS = {"&": chr(0xE000), "-": chr(0xE001), ".": chr(0xE002)}
_LEAD, _APART = chr(0xE003), chr(0xE004)
_NOT_SMALL, _NOT_CAPITAL = r"[\p{Lu}\p{Lt}\p{Lm}\p{Lo}\p{N}_]", r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}\p{N}_]"
_MARKED = "text"
for _left, _sign, _right in (
    (_W, "&", _W), (r"\p{N}", "-", _W), (_W, "-", r"\p{N}"), (_NOT_SMALL, ".", _W), (_W, ".", _NOT_CAPITAL),
) * 2:
    _MARKED = f"regexp_replace({_MARKED}, '({_left})[{_sign}]({_right})', '\\1{_JOINS[_sign]}\\2', 'g')"
_MARKED = rf"regexp_replace({_MARKED}, '(^|[^\p{{L}}\p{{N}}_.)\]])[.](\p{{L}})', '\1{_LEAD}\2', 'g')"
for _ in range(2):
    _MARKED = rf"regexp_replace({_MARKED}, '({_W})[+]({_W})', '\1{_APART}\2', 'g')"
# Initials; words with their marked joins and signs; any other sign.
_TOKEN = (rf"[{_WS}]*(?:\p{{L}}(?:[.{_JOINS['.']}]\p{{L}}){{1,10}}(?:\.|{_W}*)"
          rf"|{_LEAD}?{_W}+(?:[{''.join(_JOINS.values())}]{_W}+){{0,10}}(?:\++|#+)?|[^{_WS}\p{{L}}\p{{N}}_])")
_UNMARK = f"translate(t, '{''.join(_JOINS.values())}{_LEAD}{_APART}', '&-..+')"

_ENTRIES = f"""
    pieces AS (SELECT item_id, regexp_extract_all(text, '{PIECES}') AS p FROM benchmark),
    near AS (SELECT item_id AS pos, unnest(list_concat(p, list_transform(range(1, len(p) - 1),
                        lambda i: CASE WHEN p[i + 1] IN (' ', ', ') THEN p[i] || p[i + 1] || p[i + 2] END))) AS skill
             FROM pieces),
    entries AS (SELECT * FROM near WHERE regexp_full_match(skill, '\\p{{L}}+(,? \\p{{L}}+)?'))"""

_MATCHES = rf"""
    {_ENTRIES},
    phrases AS (SELECT DISTINCT lower(skill) AS skill_key FROM entries),
    cut AS (SELECT doc_id AS job_id, list_transform(regexp_extract_all({_MARKED}, '{_TOKEN}'),
                       lambda t: {_UNMARK}) AS ts FROM documents),
    runs AS (SELECT job_id, unnest(ts) AS run FROM cut
             UNION ALL SELECT job_id, unnest(list_transform(range(1, len(ts)), lambda i: ts[i] || ts[i + 1])) FROM cut
             UNION ALL SELECT job_id, unnest(list_transform(range(1, len(ts) - 1),
                                                            lambda i: ts[i] || ts[i + 1] || ts[i + 2])) FROM cut),
    surfaces AS (SELECT DISTINCT job_id, regexp_replace(run, '^[{_WS}]+', '') AS surface FROM runs),
    matches AS (SELECT job_id, surface, skill_key FROM surfaces JOIN phrases ON lower(surface) = skill_key)"""

_DICTIONARY = """
    firsts AS (SELECT skill_key, job_id, surface,
                      row_number() OVER (PARTITION BY skill_key ORDER BY job_id, surface) AS nth FROM matches),
    dictionary AS (SELECT skill_key, surface, row_number() OVER (ORDER BY job_id, surface) AS skill_id
                   FROM firsts WHERE nth = 1)"""

_KNOWN = r"""
    known AS (SELECT key, row_number() OVER (ORDER BY pos, key) AS skill_id
              FROM (SELECT lower(skill) AS key, min(pos) AS pos FROM entries
                    WHERE regexp_full_match(skill, '\p{Lu}\p{L}*') GROUP BY 1))"""

_CURRENCY_WORD = r"(?:^|[^A-Za-z0-9_])(usd|dollars?|eur|euros?|gbp|inr)(?:$|[^A-Za-z0-9_])"
_PERIOD_WORD = r"\b(?:per)?(year|yr|annum|month|mo|hour|hr)\b"


def _pay(number: str) -> str:
    return rf"""
    raw AS (SELECT job_id, salary_raw, list_transform(regexp_extract_all(salary_raw, '{number}'),
                lambda t: CASE WHEN lower(t) LIKE '%k' THEN CAST(replace(rtrim(t, 'kK'), ',', '') AS DOUBLE) * 1000
                               ELSE CAST(replace(t, ',', '') AS DOUBLE) END)[1:2] AS nums,
                regexp_extract(salary_raw, '[$£€₹]') AS sign,
                lower(regexp_extract(salary_raw, '{_CURRENCY_WORD}', 1, 'i')) AS word,
                lower(regexp_extract(salary_raw, '{_PERIOD_WORD}', 1, 'i')) AS pword
            FROM v_salary_raw),
    read AS (SELECT *,
                CASE WHEN pword IN ('year', 'yr', 'annum') THEN 'year' WHEN pword IN ('month', 'mo') THEN 'month'
                     WHEN pword IN ('hour', 'hr') THEN 'hour' END AS said,
                coalesce(len(nums) > 0 AND regexp_matches(salary_raw, '\bk\b', 'i')
                         AND NOT regexp_matches(salary_raw, '\bhour|hr|mo|month\b', 'i'), false) AS lone_k
            FROM raw),
    pay AS (SELECT job_id, salary_raw, list_min(nums) AS min, list_max(nums) AS max,
                CASE WHEN sign = '$' THEN 'USD' WHEN sign = '£' THEN 'GBP' WHEN sign = '€' THEN 'EUR'
                     WHEN sign = '₹' THEN 'INR' WHEN word IN ('usd', 'dollar', 'dollars') THEN 'USD'
                     WHEN word IN ('eur', 'euro', 'euros') THEN 'EUR' WHEN word = 'gbp' THEN 'GBP'
                     WHEN word = 'inr' THEN 'INR' END AS currency,
                CASE WHEN said IS NULL AND lone_k THEN 'year' ELSE said END AS period,
                CAST(CASE WHEN salary_raw IS NULL OR salary_raw = '' THEN 0.0 WHEN len(nums) = 0 THEN 0.2
                          WHEN len(nums) = 2 THEN 0.8 WHEN said IS NULL AND lone_k THEN 0.7 ELSE 0.6 END
                     AS DOUBLE) AS parsed_confidence
            FROM read)"""


_PAY = _pay(r"\d+(?:\.\d+)?[kK]?")
_PAY_THOUSANDS = _pay(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?[kK]?|\d+(?:\.\d+)?[kK]?")

_TITLE = """array_to_string(list_transform(regexp_extract_all({0}, '[A-Za-z]+|[^A-Za-z]+'),
                lambda t: upper(t[1]) || lower(t[2:])), '')"""

_PLACE = rf"""
    split AS (SELECT job_id, location_raw,
                     list_filter(list_transform(regexp_split_to_array(location_raw, '[,/|-]+'), lambda p: trim(p)),
                                 lambda p: p <> '') AS p FROM v_location_raw),
    parts AS (SELECT *, coalesce(len(p), 0) AS n FROM split),
    named AS (SELECT job_id, location_raw,
                CASE WHEN n >= 2 OR length(p[1]) >= 3 THEN p[1] END AS city,
                CASE WHEN n >= 3 OR (n = 2 AND regexp_full_match(p[2], '[A-Za-z]{{2}}')) THEN p[2]
                     WHEN n = 1 AND regexp_full_match(p[1], '[A-Za-z]{{2}}') THEN p[1] END AS state,
                CASE WHEN n >= 3 THEN p[3] WHEN n = 2 AND NOT regexp_full_match(p[2], '[A-Za-z]{{2}}') THEN p[2] END
                  AS country
              FROM parts),
    places AS (SELECT job_id, location_raw, {_TITLE.format("city")} AS city, {_TITLE.format("state")} AS state,
                {_TITLE.format("country")} AS country,
                coalesce(regexp_matches(location_raw, '\bremote\b', 'i'), false) AS is_remote,
                CAST(CASE WHEN location_raw IS NULL OR location_raw = '' THEN 0.1
                          WHEN coalesce(city, state, country) IS NOT NULL THEN 0.6 ELSE 0.3 END AS DOUBLE) AS confidence
              FROM named)"""

_POINTS = """SELECT job_id, city, state, country, lat, lon{0}
             FROM v_locations WHERE lat IS NOT NULL AND lon IS NOT NULL"""
_LABEL = """, coalesce(nullif(trim(concat(coalesce(city, ''), ', ', coalesce(state, ''), ', ', coalesce(country, '')),
              ', '), ''), 'Unknown') AS label"""

_CHECKED = """,
    c_jobs AS (SELECT v_jobs.job_id, salary_raw AS title_raw FROM v_jobs JOIN v_salary_raw USING (job_id)),
    c_skills AS (SELECT skill_id, skill_norm AS skill_raw FROM v_skills),
    c_links AS (SELECT job_id * 2 AS job_id, skill_id + 5 AS skill_id FROM v_links),
    c_pay AS (SELECT nullif(o_custkey, 7) AS job_id FROM orders),
    c_places AS (SELECT CASE WHEN country IS NOT NULL THEN job_id + 1000 END AS job_id FROM v_locations)
"""
_CHECKED_VIEWS = ("v_jobs", "v_skills", "v_links", "v_locations", "v_salary_raw")


def _duplicates(table: str, cte: str, key: str, group: str) -> str:
    return f"SELECT '{table}' AS \"table\", {key} AS key, count(*) AS n FROM {cte} GROUP BY {group} HAVING count(*) > 1"


def _orphans(table: str, cte: str, col: str, parent: str, parent_col: str) -> str:
    return f"""SELECT '{table}' AS "table", '{col}' AS "column", {col} AS key, count(*) AS n FROM {cte}
               WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {parent_col} FROM {parent}) GROUP BY {col}"""


def oracle_sql() -> dict[str, str]:
    sql = {name: _mart(name) for name in _MARTS}
    sql["skill_mom_growth"] = _on_mart("growth", "SELECT * FROM growth")

    for name in ("skill_counts", "monthly_skill_counts", "salary_by_skill", "monthly_salary_by_skill"):
        sql[f"rollup_{name}"] = sql[name]
    sql["skill_cooccurrence_min"] = _on_mart("skill_cooccurrence", "SELECT * FROM skill_cooccurrence WHERE pair_count >= 5")
    sql["pairs_blocks"] = with_clause("v_links") + """
        SELECT one.skill_id AS skill_id_a, other.skill_id AS skill_id_b, count(DISTINCT job_id) AS pair_count
        FROM v_links one JOIN v_links other USING (job_id) WHERE one.skill_id < other.skill_id GROUP BY ALL"""
    sql["pairs_wide"] = sql["pairs_blocks"]
    sql["growth_shared_names"] = _on_mart("growth", "SELECT * FROM growth").replace(
        f"SELECT skill_id, {_NAME} AS skill, month, job_count", "SELECT skill_id, split_part(skill_raw, ' ', -1) AS skill, month, job_count")
    sql["geocode_salted"] = with_clause("v_locations", "v_places") + """
        SELECT job_id, p.lat AS place_lat FROM v_locations LEFT JOIN v_places p
          ON place = concat_ws(', ', nullif(city, ''), nullif(state, ''), nullif(country, ''))"""

    # reports
    sql["report_top_skills"] = _on_mart("skill_counts", """
        SELECT skill, job_count, last_seen FROM skill_counts ORDER BY job_count DESC, skill, skill_id LIMIT 20""")
    sql["report_top_trends"] = _on_mart("monthly_skill_counts", """
        SELECT strftime(month, '%Y-%m') AS month, skill, job_count FROM monthly_skill_counts m
        ORDER BY m.month DESC, job_count DESC, skill, skill_id LIMIT 50""")
    sql["report_top_pairs"] = _on_mart("skill_cooccurrence", """
        SELECT skill_a, skill_b, pair_count FROM skill_cooccurrence
        ORDER BY pair_count DESC, skill_a, skill_b LIMIT 20""")
    sql["report_jobs_by_country"] = sql["jobs_by_country"]
    sql["report_salary_by_skill"] = with_clause(*PAY_TABLES) + """
        SELECT skill_norm AS skill, round(avg(c.min)) AS avg_min, round(avg(c.max)) AS avg_max, count(*) AS n
        FROM v_jobs_skills js JOIN v_skills s ON s.skill_id = js.skill_id JOIN v_compensation c ON c.job_id = js.job_id
        WHERE c.min IS NOT NULL AND c.max IS NOT NULL
        GROUP BY skill_norm ORDER BY n DESC, skill NULLS LAST LIMIT 20"""
    sql["report_top_risers"] = _on_mart("growth", """
        SELECT * FROM growth WHERE mom_growth_pct IS NOT NULL
        ORDER BY month DESC, mom_growth_pct DESC, skill LIMIT 20""")
    sql["report_top_fallers"] = _on_mart("growth", """
        SELECT * FROM growth WHERE mom_growth_pct IS NOT NULL
        ORDER BY month DESC, mom_growth_pct, skill LIMIT 20""")
    sql["report_salary_trend"] = _on_mart("monthly_salary_by_skill", """
        SELECT strftime(month, '%Y-%m') AS month, skill, round(avg_min) AS avg_min, round(avg_max) AS avg_max, n
        FROM monthly_salary_by_skill m ORDER BY m.month DESC, n DESC, skill LIMIT 50""")
    sql["report_country_trend"] = _on_mart("monthly_jobs_by_country", """
        SELECT strftime(month, '%Y-%m') AS month, country, job_count FROM monthly_jobs_by_country m
        ORDER BY m.month DESC, job_count DESC, country LIMIT 50""")
    sql["skill_ranking"] = _on_mart("skill_counts", "SELECT skill, job_count, last_seen FROM skill_counts")
    sql["country_snapshot"] = _on_mart("monthly_jobs_by_country", f"""
        , wanted AS (SELECT * FROM monthly_jobs_by_country
                     WHERE {_IN_RANGE} AND country IN ({_quoted(COUNTRIES)}))
        SELECT month, country, job_count FROM wanted WHERE month = (SELECT max(month) FROM wanted)
        ORDER BY job_count DESC, country LIMIT 20""")
    sql["trend_date_range"] = _on_mart(
        "monthly_skill_counts", f"SELECT * FROM monthly_skill_counts WHERE {_IN_RANGE}")
    sql["trend_month_bounds"] = _on_mart("monthly_skill_counts", """
        SELECT min(month) AS min_month, max(month) AS max_month FROM monthly_skill_counts""")
    sql["distinct_countries"] = _on_mart(
        "monthly_jobs_by_country", "SELECT DISTINCT country FROM monthly_jobs_by_country")
    sql["skill_trend_selected"] = _on_mart("monthly_skill_counts", f"""
        SELECT month, skill, job_count FROM monthly_skill_counts
        WHERE {_IN_RANGE} AND skill IN ({_quoted(SKILLS)})""")
    sql["salary_by_skill_min_n"] = with_clause(*PAY_TABLES) + f"SELECT * FROM ({_PAY_MEANS}) WHERE n >= 450"
    top = f"SELECT * FROM ({_PAY_MEANS}) WHERE n >= 3 ORDER BY n DESC, skill LIMIT 20"
    sql["salary_by_skill_top"] = with_clause(*PAY_TABLES) + top
    sql["salary_bands_long"] = with_clause(*PAY_TABLES) + f""", top AS ({top})
        SELECT skill, n, 'avg_min' AS band, avg_min AS salary FROM top
        UNION ALL SELECT skill, n, 'avg_max' AS band, avg_max AS salary FROM top"""
    for name, order in (("top_risers", "DESC"), ("top_fallers", "ASC")):
        sql[name] = _on_mart("growth", f"""
            , movers AS (SELECT * FROM growth WHERE mom_growth_pct IS NOT NULL AND {_IN_RANGE})
            SELECT skill, job_count, prev_job_count, mom_growth_pct FROM movers
            WHERE month = (SELECT max(month) FROM movers) ORDER BY mom_growth_pct {order}, skill LIMIT 10""")
    places = with_clause("v_locations")
    sql["geo_points"] = places + _POINTS.format("")
    sql["geo_labels"] = places + _POINTS.format(_LABEL) + f" AND country IN ({_quoted(COUNTRIES)})"
    sql["geo_labels_all"] = places + _POINTS.format(_LABEL)
    sql["jobs_count"] = "SELECT count(*) AS jobs FROM orders"

    # parsers
    sql["salary_parse"] = with_clause("v_salary_raw") + f", {_PAY} SELECT * FROM pay"
    sql["salary_parse_thousands"] = with_clause("v_salary_raw") + f", {_PAY_THOUSANDS} SELECT * FROM pay"
    sql["location_parse"] = with_clause("v_location_raw") + f", {_PLACE} SELECT * FROM places"
    sql["post_date_parse"] = with_clause("v_dates_raw") + """
        SELECT job_id, CAST(try_strptime(post_date, '%Y-%m-%d') AS DATE) AS post_date FROM v_dates_raw"""

    sql["post_date_inferred"] = with_clause("v_dates_dmy") + """
        SELECT job_id, CAST(try_strptime(post_date, '%d/%m/%Y') AS DATE) AS post_date FROM v_dates_dmy"""

    # skills
    sql["gazetteer_dedupe"] = with_clause("v_part_entries") + """
        SELECT skill, lower(skill) AS skill_key, CAST(len(regexp_extract_all(skill, '[A-Za-z]+')) AS INTEGER) AS n_tokens
        FROM (SELECT trim(skill) AS skill,
                     row_number() OVER (PARTITION BY lower(trim(skill)) ORDER BY pos, trim(skill)) AS nth
              FROM v_part_entries WHERE trim(skill) <> '') WHERE nth = 1"""
    sql["skill_extract"] = f"WITH {_MATCHES} SELECT * FROM matches"
    sql["skill_extract_bits"] = sql["skill_extract"]
    sql["skill_dictionary"] = f"""WITH {_MATCHES}, {_DICTIONARY}
        SELECT skill_id, surface AS skill_raw, surface AS skill_norm, 'rule_v1' AS extractor_version FROM dictionary"""
    sql["skill_bridge"] = f"""WITH {_MATCHES}, {_DICTIONARY}
        SELECT DISTINCT job_id, skill_id FROM matches JOIN dictionary USING (skill_key)"""
    sql["skills_new_only"] = f"""WITH {_MATCHES}, {_KNOWN},
        firsts AS (SELECT skill_key, job_id, surface,
                          row_number() OVER (PARTITION BY skill_key ORDER BY job_id, surface) AS nth FROM matches
                   WHERE skill_key NOT IN (SELECT key FROM known))
        SELECT (SELECT max(skill_id) FROM known) + row_number() OVER (ORDER BY job_id, surface) AS skill_id,
               surface AS skill_raw, surface AS skill_norm
        FROM firsts WHERE nth = 1"""
    sql["bridge_insert_ignore"] = with_clause("v_links") + """
        SELECT job_id, skill_id FROM v_links
        EXCEPT SELECT l_orderkey, skill_id FROM lineitem JOIN v_part_skills ON p_partkey = l_partkey
               WHERE l_returnflag = 'R'"""

    # keys and merges
    sql["ingest_assign_ids"] = with_clause("v_dates_raw") + """
        SELECT job_id AS source_key, CAST(try_strptime(post_date, '%Y-%m-%d') AS DATE) AS post_date,
               100 + row_number() OVER (ORDER BY job_id) AS job_id FROM v_dates_raw"""
    sql["upsert_compensation"] = with_clause("v_salary_raw", "v_stored_pay") + f""", {_PAY},
        updates AS (SELECT job_id, min, max, currency, period, parsed_confidence FROM pay WHERE salary_raw <> '')
        SELECT * FROM updates UNION ALL
        SELECT * FROM v_stored_pay WHERE job_id NOT IN (SELECT job_id FROM updates)"""
    sql["merge_touched_months"] = with_clause("v_jobs", "v_salary_raw", "v_stored_pay") + f""", {_PAY},
        updates AS (SELECT job_id, min, max, currency, period, parsed_confidence FROM pay JOIN v_jobs USING (job_id)
                    WHERE salary_raw <> '' AND ({_MERGED}))
        SELECT * FROM updates UNION ALL
        SELECT * FROM v_stored_pay WHERE job_id NOT IN (SELECT job_id FROM updates)"""
    bodies = ", ".join(f"{name} AS ({_MARTS[name]})" for name in _MARTS)
    sql["refresh_second_load"] = with_clause(*PAY_TABLES, *PLACE_TABLES).replace("v_stored_places", "v_locations") + (
        f", {bodies}, skill_mom_growth AS ({_GROWTH})\n".replace("v_stored_places", "v_locations")
        + " UNION ALL ".join(_long_form(mart, mart) for mart in refresh.MARTS))
    sql["upsert_locations"] = with_clause("v_location_raw", "v_stored_places") + f""", {_PLACE},
        updates AS (SELECT job_id, city, state, country, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon,
                           confidence AS geocode_confidence FROM places WHERE location_raw <> '')
        SELECT * FROM updates UNION ALL
        SELECT * FROM v_stored_places WHERE job_id NOT IN (SELECT job_id FROM updates)"""
    sql["upsert_locations_places"] = with_clause("v_location_raw", "v_stored_places", "v_places_twice") + f""", {_PLACE},
        once AS (SELECT place, lat, lon FROM v_places_twice
                 QUALIFY row_number() OVER (PARTITION BY place ORDER BY lat NULLS LAST, lon NULLS LAST) = 1),
        updates AS (SELECT job_id, city, state, country, lat, lon,
                           CASE WHEN place IS NULL THEN confidence ELSE 0.7 END AS geocode_confidence
                    FROM places LEFT JOIN once ON place = concat_ws(', ', nullif(city, ''), nullif(state, ''), nullif(country, ''))
                    WHERE location_raw <> '')
        SELECT * FROM updates UNION ALL
        SELECT * FROM v_stored_places WHERE job_id NOT IN (SELECT job_id FROM updates)"""
    sql["geocode_lookup"] = with_clause("v_locations", "v_places") + """
        SELECT l.job_id, l.city, l.state, l.country, p.lat, p.lon,
               CASE WHEN p.place IS NOT NULL THEN CAST(0.7 AS DOUBLE) END AS geocode_confidence
        FROM v_locations l LEFT JOIN v_places p
          ON p.place = concat_ws(', ', nullif(city, ''), nullif(state, ''), nullif(country, ''))"""

    levels = ["concat_ws(', ', nullif(city, ''), nullif(state, ''), nullif(country, ''))",
              "nullif(city, '') || ', ' || nullif(country, '')", "nullif(state, '') || ', ' || nullif(country, '')", "nullif(country, '')"]
    places = "\n".join(f"LEFT JOIN v_places_coarse p{i} ON p{i}.place = {level}" for i, level in enumerate(levels))
    first = lambda value: "CASE " + " ".join(f"WHEN p{i}.place IS NOT NULL THEN {value.format(i=i)}" for i in range(4)) + " END"
    sql["geocode_fallback"] = with_clause("v_locations", "v_places_coarse") + f"""
        SELECT l.job_id, l.city, l.state, l.country, {first("p{i}.lat")} AS lat, {first("p{i}.lon")} AS lon,
               {first("CAST(0.7 AS DOUBLE)")} AS geocode_confidence, {first("{i}")} AS geocode_level
        FROM v_locations l {places}"""

    # integrity
    checked = with_clause(*_CHECKED_VIEWS) + _CHECKED
    sql["pk_violations"] = checked + " UNION ALL ".join([
        _duplicates("jobs", "c_jobs", "CAST(job_id AS VARCHAR)", "job_id"),
        _duplicates("skills", "c_skills", "CAST(skill_id AS VARCHAR)", "skill_id"),
        _duplicates("jobs_skills", "c_links", "concat(job_id, ',', skill_id)", "job_id, skill_id"),
        _duplicates("compensation", "c_pay", "coalesce(CAST(job_id AS VARCHAR), 'NULL')", "job_id"),
        _duplicates("locations", "c_places", "coalesce(CAST(job_id AS VARCHAR), 'NULL')", "job_id"),
    ])
    sql["fk_orphans"] = checked + " UNION ALL ".join([
        _orphans("jobs_skills", "c_links", "job_id", "c_jobs", "job_id"),
        _orphans("jobs_skills", "c_links", "skill_id", "c_skills", "skill_id"),
        _orphans("compensation", "c_pay", "job_id", "c_jobs", "job_id"),
        _orphans("locations", "c_places", "job_id", "c_jobs", "job_id"),
    ])
    required = {"jobs": ["job_id", "title_raw"], "skills": ["skill_id", "skill_raw"], "links": ["job_id", "skill_id"],
                "pay": ["job_id"], "places": ["job_id"]}
    tables = {"links": "jobs_skills", "pay": "compensation", "places": "locations"}
    sql["not_null_violations"] = checked + "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{tables.get(t, t)}' AS \"table\", '{c}' AS \"column\", count(*) AS n FROM c_{t} WHERE {c} IS NULL"
        for t, cols in required.items() for c in cols) + ") WHERE n > 0"
    return sql | CORPUS_SQL
