"""Command line: ``python -m hirelens [--root DIR] COMMAND``, or the same under spark-submit.

Loading and enrichment commands change the tables under ``--root``.  Ranked reports print
their first ``--k`` rows; every report can be written in full to a folder with ``--out``.
"""

import argparse
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .plans import refresh, reports
from .plans.refresh import load_mart
from .sources.csv import seed_postings
from .sources.tables import TableStore, append_jobs

Report = Callable[[TableStore, argparse.Namespace], DataFrame]


def _range(args: argparse.Namespace) -> tuple[date, date]:
    return args.since or date(1000, 1, 1), args.until or date(9999, 12, 31)


# Reports of a documented number of rows: (default k, plan).
RANKED: dict[str, tuple[int, Report]] = {
    "top-skills": (20, lambda s, a: reports.report_top_skills(load_mart(s, "skill_counts"), a.k)),
    "top-trends": (50, lambda s, a: reports.report_top_trends(load_mart(s, "monthly_skill_counts"), a.k)),
    "top-pairs": (20, lambda s, a: reports.report_top_pairs(load_mart(s, "skill_cooccurrence"), a.k)),
    "salary-by-skill": (20, lambda s, a: reports.report_salary_by_skill(s.tables(), a.k)),
    "top-risers": (20, lambda s, a: reports.report_top_risers(load_mart(s, "skill_mom_growth"), a.k)),
    "top-fallers": (20, lambda s, a: reports.report_top_fallers(load_mart(s, "skill_mom_growth"), a.k)),
    "salary-trend": (50, lambda s, a: reports.report_salary_trend(load_mart(s, "monthly_salary_by_skill"), a.k)),
    "country-trend": (50, lambda s, a: reports.report_country_trend(load_mart(s, "monthly_jobs_by_country"), a.k)),
    "country-snapshot": (20, lambda s, a: reports.country_snapshot(
        load_mart(s, "monthly_jobs_by_country"), *_range(a), a.country, a.k)),
    "salary-min-samples": (20, lambda s, a: reports.salary_by_skill_top(s.tables(), a.min_samples, a.k)),
    "salary-bands": (20, lambda s, a: reports.salary_bands_long(
        reports.salary_by_skill_top(s.tables(), a.min_samples, a.k))),
    "latest-risers": (10, lambda s, a: reports.top_risers(load_mart(s, "skill_mom_growth"), *_range(a), a.k)),
    "latest-fallers": (10, lambda s, a: reports.top_fallers(load_mart(s, "skill_mom_growth"), *_range(a), a.k)),
    "count-jobs": (1, lambda s, a: reports.jobs_count(s.tables())),
}
# Reports with as many rows as the data has: only written, never printed.
WHOLE: dict[str, Report] = {
    "jobs-by-country": lambda s, a: reports.report_jobs_by_country(load_mart(s, "jobs_by_country")),
    "skill-trend": lambda s, a: reports.skill_trend_selected(load_mart(s, "monthly_skill_counts"), *_range(a), a.skill or []),
    "map-points": lambda s, a: reports.geo_labels(s.tables(), a.country),
}


def _places(spark: SparkSession, path: str | None) -> DataFrame | None:
    return spark.read.parquet(path) if path else None


def _written(df: DataFrame, args: argparse.Namespace) -> None:
    writer = df.write.mode("error")
    writer.parquet(args.out) if args.format == "parquet" else writer.option("header", True).csv(args.out)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    store = TableStore(spark, args.root, args.buckets)
    if args.command in RANKED:
        rows = RANKED[args.command][1](store, args)
        # Salary bands have two rows a skill.
        _written(rows, args) if args.out else rows.show(2 * args.k, truncate=False)
    elif args.command in WHOLE:
        _written(WHOLE[args.command](store, args), args)
    elif args.command == "seed":
        append_jobs(store, seed_postings(spark))
    elif args.command == "load":
        done = refresh.load_postings(spark, store, args.csv, args.multiline, args.date_format, args.rejects)
        print(f"{done.postings} postings loaded, {done.unparsed_dates} with a date in none of the formats ({', '.join(done.formats)}); "
              f"{done.malformed} malformed rows")
    elif args.command == "extract-skills":
        refresh.run_skills(store, refresh.gazetteer(spark, args.skills), args.full)
    elif args.command == "enrich-salary":
        refresh.run_compensation(store, args.thousands, args.full)
    elif args.command == "enrich-locations":
        refresh.run_locations(store, _places(spark, args.places), args.full, args.place_fallback)
    elif args.command == "analytics-refresh":
        refresh.refresh_marts(store, args.full)
    elif args.command == "refresh-all":
        refresh.refresh_all(store, args.skills, _places(spark, args.places), args.thousands, args.full)


def _positive(text: str) -> int:
    if int(text) < 1:
        raise argparse.ArgumentTypeError("must be 1 or more")
    return int(text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hirelens", description=__doc__)
    top.add_argument("--root", default="warehouse", help="directory of the stored tables")
    top.add_argument("--buckets", type=int, help="bucket the tables by posting into this many buckets")
    commands = top.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="append postings from a CSV file or folder")
    load.add_argument("csv")
    load.add_argument("--multiline", action="store_true", help="line breaks inside fields: each file is read by one task")
    load.add_argument("--date-format", action="append", help="a pattern of dates, repeatable; default: found from the dates")
    load.add_argument("--rejects", help="folder for rows that do not fit the header; without it they refuse the load")
    commands.add_parser("seed", help="append the seed postings")
    skills = commands.add_parser("extract-skills", help="dictionary match of skills in posting text")
    salary = commands.add_parser("enrich-salary", help="parse salary text")
    places = commands.add_parser("enrich-locations", help="parse location text")
    refreshed = commands.add_parser("analytics-refresh", help="bring the marts up to date")
    every = commands.add_parser("refresh-all", help="all enrichments, then the marts")
    for command in (skills, salary, places, refreshed, every):
        command.add_argument("--full", action="store_true", help="all months, not only those with new postings or changed inputs")
    for command in (skills, every):
        command.add_argument("--skills", help="CSV with a skill column; default: the built-in dictionary")
    for command in (salary, every):
        command.add_argument("--thousands", action="store_true", help="read a comma before three digits as grouping")
    for command in (places, every):
        command.add_argument("--places", help="Parquet table of place, lat, lon")
    places.add_argument("--place-fallback", action="store_true", help="look places not found up by city and country, state and country, country")
    for name in (*RANKED, *WHOLE):
        report = commands.add_parser(name, help="report")
        report.add_argument("--out", required=name in WHOLE, help="folder to write the whole report to")
        report.add_argument("--format", choices=["csv", "parquet"], default="csv")
        if name in RANKED:
            report.add_argument("--k", type=_positive, default=RANKED[name][0], help="rows of the report")
        report.add_argument("--since", type=date.fromisoformat, help="first month of the range, as a date")
        report.add_argument("--until", type=date.fromisoformat, help="last month of the range, as a date")
        report.add_argument("--country", action="append", help="only these countries, repeatable")
        report.add_argument("--skill", action="append", help="the skills of skill-trend, repeatable")
        report.add_argument("--min-samples", type=_positive, default=3, help="least postings behind a mean")
    return top


def main() -> None:
    args = parser().parse_args()
    spark = (
        SparkSession.builder.appName(f"hirelens {args.command}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
