"""Counts of skill pairs that stand in the same posting."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators.lookup import deal_by_key, fits_broadcast
from ..operators.staging import stage

# A posting with more skills than this is wide: it is cut into blocks instead of gathered in one array.
WIDE_SKILLS = 4096
# Skills of one block.
BLOCK_SKILLS = 1024


def pair_counts(
    jobs_skills: DataFrame, skills: DataFrame, wide_skills: int = WIDE_SKILLS, block: int = BLOCK_SKILLS,
    by: Sequence[str] = (), min_count: int = 1,
) -> DataFrame:
    """``(skill_id_a, skill_id_b, pair_count)`` with ``skill_id_a < skill_id_b``.

    ``by`` names columns of the links that are equal for all links of a posting: counts are per their values then.
    Pairs in fewer than ``min_count`` postings are left out; skills in fewer links than that leave before any pair is built.
    Counts distinct postings: repeated links count once, links to skills that are not stored do not count.
    A dictionary of at most ``wide_skills`` skills proves that no posting is wide; otherwise wide
    postings are looked for and take the block plan.  Both plans give the same counts.
    """
    known = skills.select("skill_id").distinct()
    small = F.broadcast(known) if fits_broadcast(known) else known
    links = jobs_skills.select("job_id", "skill_id", *by).join(small, "skill_id", "left_semi").filter("job_id IS NOT NULL")
    if min_count > 1:
        links = frequent(links, min_count)
    if known.limit(wide_skills + 1).count() <= wide_skills:
        return _counted(by_posting(links, by), by, min_count)
    sizes = links.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"))
    seen = Observation()
    sizes = sizes.observe(seen, F.sum("n").alias("links"))
    wide = stage(sizes.filter(F.col("n") > wide_skills).select("job_id"), "wide_postings")
    if wide.isEmpty():
        return _counted(by_posting(links, by), by, min_count)
    if fits_broadcast(wide):
        wide = F.broadcast(wide)
    else:
        links = deal_by_key(links, seen.get["links"], "job_id")
    return _counted(by_posting(links.join(wide, "job_id", "left_anti"), by).unionByName(
        by_blocks(links.join(wide, "job_id", "left_semi"), block, by)
    ), by, min_count)


def frequent(links: DataFrame, min_count: int) -> DataFrame:
    """Links of skills with at least ``min_count`` links; a pair cannot stand in more postings than either skill."""
    often = links.groupBy("skill_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count).select("skill_id")
    often = stage(often, "frequent")  # measured, then joined
    return links.join(F.broadcast(often) if fits_broadcast(often) else often, "skill_id", "left_semi")


def _counted(pairs: DataFrame, by: Sequence[str], min_count: int) -> DataFrame:
    counts = pairs.groupBy(*by, "skill_id_a", "skill_id_b").agg(F.count(F.lit(1)).alias("pair_count"))
    return counts.filter(F.col("pair_count") >= min_count) if min_count > 1 else counts


def by_posting(links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per posting and pair: the skills of a posting gathered as a set, then paired.

    The only shuffle is the one the grouping needs; a table bucketed by posting has none.
    """
    of_posting = [F.first(c).alias(c) for c in by]
    sets = links.groupBy("job_id").agg(F.sort_array(F.collect_set("skill_id")).alias("ids"), *of_posting)
    firsts = sets.filter(F.size("ids") > 1).select(*by, "ids", F.posexplode("ids").alias("at", "skill_id_a"))
    later = F.slice("ids", F.col("at") + 2, F.size("ids"))
    return firsts.select(*by, "skill_id_a", F.explode(later).alias("skill_id_b"))


def by_blocks(links: DataFrame, block: int = BLOCK_SKILLS, by: Sequence[str] = ()) -> DataFrame:
    """One row per posting and pair, postings cut into square blocks.

    A posting with n skills gets k = ceil(n / block) buckets per side and k * k join
    keys, so one task sees about block * block of its pairs.  Pairs go straight into the partial count.
    The distinct links are staged: both sides and the widths read them.
    """
    once = stage(links.dropDuplicates(["job_id", "skill_id"]), "wide_links")
    dealt = deal_by_key(once, once.count(), "job_id")
    widths = dealt.groupBy("job_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("k"))
    cut = dealt.join(widths, "job_id").withColumn("own", F.pmod(F.xxhash64("skill_id"), F.col("k")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("k").cast("long") - 1))
    left = cut.select("job_id", *by, F.col("skill_id").alias("skill_id_a"), F.col("own").alias("row"), every.alias("col"))
    right = cut.select("job_id", F.col("skill_id").alias("skill_id_b"), F.col("own").alias("col"), every.alias("row"))
    met = left.join(right, ["job_id", "row", "col"]).filter(F.col("skill_id_a") < F.col("skill_id_b"))
    return met.select(*by, "skill_id_a", "skill_id_b")
