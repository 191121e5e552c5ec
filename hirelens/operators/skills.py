"""Dictionary match of skills in posting text, skill ids and the bridge table."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import BARE_TOKEN, TOKEN, WS_CHARS, skill_name, squash_ws, strip
from .ids import dense_ids
from .lookup import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast, lookup_join
from .staging import stage
from .upsert import absent_rows

# Fixed value: written to every skill row made here.
EXTRACTOR_VERSION = "rule_v1"

# Up to this many different first tokens, runs are filtered by them before they are built.
PREFILTER_TOKENS = 1000
# Phrases of more tokens are found by their first so many tokens and then compared as a whole.
LONG_TOKENS = 8
# Beyond the broadcast bound, runs are filtered by a bit set of phrase hashes before they are shuffled: 16 bits a
# phrase and more, but never more than 128 MB.
BITS_PER_PHRASE, MAX_BITS = 16, 1 << 30
# Bits of one bitmap of Spark's bitmap functions, and of one word of it.
_BITMAP_BITS, _WORD_BITS = 32_768, 64


def skill_key(name: Column) -> Column:
    """Names that differ only in case and white space are one skill."""
    return F.lower(squash_ws(name))


def dedupe_gazetteer(entries: DataFrame, skill_col: str = "skill", pos_col: str = "pos") -> DataFrame:
    """Dictionary ``(skill, skill_key, n_tokens)`` from raw entries.

    Entries are stripped, blank ones dropped; of spellings that differ only in
    case the one with the lowest position (then code-point order) stays.
    """
    clean = entries.select(strip(F.col(skill_col)).alias("skill"), F.col(pos_col).alias("pos"))
    return (
        clean.filter(F.col("skill") != "")
        .groupBy(F.lower("skill").alias("skill_key"))
        .agg(F.min_by("skill", F.struct("pos", "skill")).alias("skill"))
        .select("skill", "skill_key", F.regexp_count("skill", F.lit(TOKEN)).alias("n_tokens"))
    )


def _first_token() -> Column:
    return F.lower(F.regexp_extract("skill", BARE_TOKEN, 0))


def _first_tokens(gazetteer: DataFrame) -> list[str] | None:
    """Lower-cased first tokens of all phrases, or None when there are many."""
    first = gazetteer.select(_first_token().alias("first")).distinct()
    found = [r["first"] for r in first.limit(PREFILTER_TOKENS + 1).collect()]
    return found if len(found) <= PREFILTER_TOKENS else None


def _runs(texts: DataFrame, id_col: str, lengths: list[int], firsts: list[str] | None) -> DataFrame:
    """One row per text and distinct run of neighbouring tokens, of the given lengths.

    A run is its first token without, and the others with their leading white space.
    With ``firsts`` only runs that begin with one of these tokens are built; the
    others are NULL from their first token on and cost no string work.
    """
    cut = texts.withColumn("_tokens", F.regexp_extract_all("_text", F.lit(TOKEN), F.lit(0)))
    cut = cut.withColumn("_run1", F.transform("_tokens", lambda t: F.ltrim(t, F.lit(WS_CHARS))))
    if firsts is not None:
        cut = cut.withColumn("_run1", F.transform("_run1", lambda t: F.when(F.lower(t).isin(firsts), t)))
    for n in range(2, max(lengths) + 1):
        nth = F.slice("_tokens", n, F.greatest(F.size("_tokens") - (n - 1), F.lit(0)))
        cut = cut.withColumn(f"_run{n}", F.zip_with(f"_run{n - 1}", nth, lambda run, token: F.concat(run, token)))
    # All missing runs of a text become one NULL, which matches nothing.
    runs = F.array_distinct(F.concat(*[F.col(f"_run{n}") for n in lengths]))
    # Exploded as an expression: for a column Spark would add a filter on its size
    # and push it to the scan, where every text would be cut a second time.
    return cut.select(id_col, F.explode(runs).alias("surface"))


def _long_matches(texts: DataFrame, phrases: DataFrame, id_col: str) -> DataFrame:
    """``(id, surface, skill_key, _name)`` for phrases of more than ``LONG_TOKENS`` tokens.

    Runs of ``LONG_TOKENS`` tokens meet the beginnings of the phrases; only where one fits is the rest compared, so
    the length of the longest phrase adds nothing to the work on other texts.
    """
    tokens = F.regexp_extract_all("_text", F.lit(TOKEN), F.lit(0)).alias("_tokens")
    bare = F.regexp_extract_all("_text", F.lit(BARE_TOKEN), F.lit(0)).alias("_bare")
    cut = texts.select(id_col, tokens, bare).filter(F.size("_tokens") > LONG_TOKENS)
    starts = F.transform("_bare", lambda first, i: F.lower(F.concat(first, F.array_join(F.slice("_tokens", i + 2, LONG_TOKENS - 1), ""))))
    begun = cut.select(id_col, "_tokens", F.explode(F.transform(starts, lambda run, i: F.struct(run.alias("run"), i.alias("i")))).alias("s"))
    begins = F.lower(F.array_join(F.slice(F.regexp_extract_all("skill", F.lit(TOKEN), F.lit(0)), 1, LONG_TOKENS), ""))
    small = phrases.select("skill_key", "_name", "n_tokens", begins.alias("_begins"))
    met = begun.join(F.broadcast(small) if fits_broadcast(small) else small, F.col("s.run") == F.col("_begins"))
    whole = strip(F.array_join(F.slice("_tokens", F.col("s.i") + 1, F.col("n_tokens").cast("int")), ""))
    return met.select(id_col, whole.alias("surface"), "skill_key", "_name").filter(F.lower("surface") == F.col("skill_key")).distinct()


def _bit(key: Column, bits: int) -> Column:
    """The bit of a key, from 1 on, as the bitmap functions count."""
    return F.pmod(F.xxhash64(key), F.lit(bits).cast("long")) + 1


def phrase_bits(phrases: DataFrame, bits: int) -> DataFrame:
    """``(bucket, words)``: a bit set of the hashes of all phrases, one row per bitmap that holds any.

    Its size depends on ``bits`` alone.  A word is eight bytes of a bitmap, the first byte the highest.
    """
    bit = _bit(F.col("skill_key"), bits)
    maps = phrases.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("map"))
    word = lambda i: F.conv(F.hex(F.substring("map", i * 8 + 1, 8)), 16, -10).cast("long")
    return maps.select("bucket", F.transform(F.sequence(F.lit(0), F.lit(_BITMAP_BITS // _WORD_BITS - 1)), word).alias("words"))


def maybe_phrases(runs: DataFrame, phrases: DataFrame, rows: int) -> DataFrame:
    """Runs whose ``skill_key`` has its bit set: all phrases, and few others.  Nothing is shuffled."""
    bits = min(MAX_BITS, max(_BITMAP_BITS, 1 << (rows * BITS_PER_PHRASE).bit_length()))
    bit = _bit(F.col("skill_key"), bits)
    at = F.bitmap_bit_position(bit)
    placed = runs.withColumns({"bucket": F.bitmap_bucket_number(bit), "_at": at})
    held = placed.join(F.broadcast(phrase_bits(phrases, bits)), "bucket")
    word = F.get("words", F.floor(F.col("_at") / _WORD_BITS).cast("int"))
    byte, inside = F.floor(F.col("_at") / 8) % 8, F.col("_at") % 8
    shift = ((7 - byte) * 8 + inside).cast("int")
    return held.filter(F.call_function("shiftrightunsigned", word, shift).bitwiseAND(F.lit(1)) == 1).select(*runs.columns)


def extract_skills(
    df: DataFrame,
    gazetteer: DataFrame,
    id_col: str = "job_id",
    text_col: str = "description_raw",
    spread: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows ``(id, surface, skill_key)``: every dictionary phrase in every text.

    A phrase matches whole tokens in any case; matches may overlap; ``surface`` is
    the spelling in the text, each once per posting.  The texts are cut into runs
    of one, two, ... tokens, only for phrase lengths that occur in the dictionary,
    and the runs are looked up by a join, so dictionary size does not add to the
    work per text.  The dictionary is broadcast only when it is measured to have at most ``max_rows`` rows and
    ``max_bytes`` bytes; beyond that a bit set of fixed size is, and only runs that are (almost all) phrases are
    shuffled.  ``spread`` repartitions the texts first, for inputs of few large
    unsplittable files.
    """
    # Stored under one name with single blanks; differs from the key only for entries with odd white space.
    phrases = gazetteer.select("skill_key", "skill", "n_tokens", skill_key(F.col("skill")).alias("_name"))
    rows, size, every_length, openings, odd = phrases.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.octet_length("skill_key") + 32), F.lit(0)),
        F.sort_array(F.collect_set("n_tokens")),
        F.approx_count_distinct(_first_token()),
        F.count_if(F.col("_name") != F.col("skill_key")),
    ).first()
    small = rows <= max_rows and size <= max_bytes

    texts = df.select(F.col(id_col), F.col(text_col).alias("_text")).filter(F.col("_text") != "")
    if spread:
        texts = texts.repartition(spread)
    # The estimate only saves listing them when there are far too many.
    firsts = _first_tokens(gazetteer) if openings <= 2 * PREFILTER_TOKENS else None
    lengths = [n for n in every_length if n <= LONG_TOKENS]
    # Distinct inside one text, so no shuffle is needed to make the result distinct.
    surfaces = _runs(texts, id_col, lengths or [1], firsts)
    # Never NULL, so that the join adds no filter that would lower every run twice.
    keyed = surfaces.withColumn("skill_key", F.coalesce(F.lower("surface"), F.lit("")))
    if not small:
        keyed = maybe_phrases(keyed, phrases, rows)
    found = lookup_join(keyed, phrases.select("skill_key", "_name"), "skill_key", spread_by=[id_col], small=small)
    if len(lengths) < len(every_length):
        found = found.unionByName(_long_matches(texts, phrases.filter(F.col("n_tokens") > LONG_TOKENS), id_col))
    if not odd:
        return found.select(id_col, "surface", "skill_key")
    # Two spellings in one text may differ in white space only.
    return found.select(
        id_col, squash_ws(F.col("surface")).alias("surface"), F.col("_name").alias("skill_key")
    ).distinct()


def skill_keys(skills: DataFrame) -> DataFrame:
    """``(skill_key, skill_id)`` of stored skills, the lowest id per key."""
    return skills.groupBy(skill_key(skill_name()).alias("skill_key")).agg(F.min("skill_id").alias("skill_id"))


def first_matches(matches: DataFrame, id_col: str = "job_id") -> DataFrame:
    """``(skill_key, id, surface)``: of every key the match with the lowest posting id (a NULL first), then spelling.

    Spellings are few: their lowest ids are gathered by hash, without sorting the matches, before spellings are compared.
    """
    lowest = F.when(F.bool_or(F.col(id_col).isNull()), None).otherwise(F.min(id_col)).alias(id_col)
    spelled = matches.groupBy("skill_key", "surface").agg(lowest)
    return spelled.groupBy("skill_key").agg(F.min(F.struct(id_col, "surface")).alias("_first")).select("skill_key", "_first.*")


def new_skills(matches: DataFrame, skills: DataFrame, id_col: str = "job_id") -> DataFrame:
    """Rows for skills not stored yet, in the shape of the skills table.

    Ids continue after the highest stored one, in order of first appearance: by
    posting id, then by spelling in code-point order.  The first spelling names
    the skill.
    """
    # Staged, or Spark would take the anti-join below the grouping and shuffle every match, and once more to sample the order.
    first = stage(first_matches(matches, id_col), "first_matches")
    unknown = first.join(skill_keys(skills), "skill_key", "left_anti").select(id_col, "surface")
    last_id = skills.agg(F.coalesce(F.max("skill_id"), F.lit(0))).first()[0]
    return dense_ids(unknown, "skill_id", last_id + 1, order_by=[id_col, "surface"]).select(
        "skill_id",
        F.col("surface").alias("skill_raw"),
        squash_ws(F.col("surface")).alias("skill_norm"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(EXTRACTOR_VERSION).alias("extractor_version"),
        F.localtimestamp().alias("created_at"),
    )


def new_links(matches: DataFrame, skills: DataFrame, jobs_skills: DataFrame, id_col: str = "job_id") -> DataFrame:
    """``(job_id, skill_id)`` rows of the matches that the bridge does not hold yet."""
    keys = stage(skill_keys(skills), "skill_keys")  # measured, then joined
    linked = lookup_join(matches, keys, "skill_key", spread_by=[id_col])
    return absent_rows(linked.select(F.col(id_col).alias("job_id"), "skill_id"), jobs_skills, ["job_id", "skill_id"])
