"""Repeated runs of lines, found with a suffix array over line numbers.

Equal lines get equal numbers, in the order of their hashes.  The suffixes of all documents are ranked by prefix
doubling: a rank for the first 2k lines comes from the ranks of the first k lines at the line and k lines
on.  Neighbours in the resulting order are compared for their longest common prefix, and stretches
whose common prefix holds enough words are repeated runs.  All steps are DataFrame operations.

A maximal run is found as the union of its shortest parts with enough words: each of its lines lies in the shortest
part from some line on, or in the shortest part up to some line, that is within the run.  Both kinds are prefixes of
suffixes, of at most as many lines as words are asked for, so ranks need not be taken any deeper, however long
a run is.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from hirelens.llm.common import free_name, running_total, stage, table_join
from hirelens.operators.ids import dense_ids
from hirelens.operators.lookup import fits_broadcast

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 10
# A document is told by its id and its text; rows with both equal are one document.
_DOC = ["doc", "text_hash"]
_LINE_HASHES = ["h1", "h2"]


def _pieces(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line that holds a word: document, line number, place among such lines, two hashes, words."""
    bare = lambda x, i: F.struct(i.alias("line_no"), F.btrim(x, F.lit(" \t\x0b\f\r")).alias("line"))
    rows = docs.select(docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("text_hash"),
                       F.filter(F.transform(_pieces(docs[text_col]), bare), lambda s: s["line"] != "").alias("all"))
    each = rows.select(*_DOC, F.posexplode("all").alias("n", "s"))
    return each.select(*_DOC, "n", F.col("s.line_no").alias("line_no"), F.xxhash64("s.line").alias("h1"),
                       F.xxhash64(F.lit("line"), F.col("s.line")).alias("h2"),
                       F.regexp_count("s.line", F.lit(WORD)).cast("long").alias("words"))


def _sequences(lines: DataFrame, min_words: int) -> DataFrame:
    """Line-number sequences that can hold a repeated run: ``(doc, text_hash, piece, n, line_no, rank, least, most)``.

    Only lines that occur again are kept, cut into pieces where a line is missing.  ``least`` is the number of lines
    from here that hold ``min_words`` words, null if the rest of the piece holds fewer.  ``most`` is the number of lines
    whose words after those of this line are fewer than ``min_words``: stretches of ``least`` to ``most`` lines are
    the shortest up to their last lines.
    """
    again = lines.groupBy(*_LINE_HASHES).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    numbers = stage(dense_ids(again.select(*_LINE_HASHES), "rank", order_by=_LINE_HASHES), "line_numbers")
    known = table_join(lines, numbers, _LINE_HASHES).drop(*_LINE_HASHES).dropDuplicates([*_DOC, "n"])
    of_doc = Window.partitionBy(*_DOC).orderBy("n")
    pieces = known.withColumn("piece", F.col("n") - F.row_number().over(of_doc))
    of_piece = Window.partitionBy(*_DOC, "piece")
    before = F.coalesce(F.sum("words").over(of_piece.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = pieces.withColumn("before", before).withColumn("all_words", F.sum("words").over(of_piece))
    counted = counted.filter(F.col("all_words") >= min_words)
    # Every line holds a word, so the words before a line grow strictly: a range over them is a run of lines.
    counted = counted.withColumn("through", F.col("before") + F.col("words"))
    run = F.count(F.lit(1)).over(of_piece.orderBy("before").rangeBetween(0, min_words - 1))
    most = F.count(F.lit(1)).over(of_piece.orderBy("through").rangeBetween(0, min_words - 1))
    enough = F.col("all_words") - F.col("before") >= min_words
    return counted.select(*_DOC, "piece", "n", "line_no", "rank", F.when(enough, run).alias("least"),
                          F.when(enough, F.greatest(run, most)).alias("most"))


def _ranked(sequences: DataFrame, depth: int) -> DataFrame:
    """Prefix doubling: ``rank`` becomes the rank of the first ``depth`` lines or more; beyond a piece comes 0."""
    of_piece = Window.partitionBy(*_DOC, "piece").orderBy("n")
    width = 1
    while width < depth:
        shifted = sequences.withColumn("next", F.lead("rank", width, 0).over(of_piece))
        shifted = stage(shifted, "rank_pairs")
        pairs = dense_ids(shifted.select("rank", "next").distinct(), "new", order_by=["rank", "next"])
        joined = table_join(shifted, stage(pairs, "new_ranks"), ["rank", "next"])
        sequences = joined.drop("rank", "next").withColumnRenamed("new", "rank")
        width *= 2
    return sequences


def _repeated(sequences: DataFrame, depth: int) -> DataFrame:
    """The later copies: ``(doc, text_hash, n, size)``, the most lines from line ``n`` on that stand earlier too.

    Suffixes of equal rank agree in ``depth`` lines, which cover ``most``; they are one entry of the suffix array.
    """
    of_piece = Window.partitionBy(*_DOC, "piece").orderBy("n")
    prefix = F.collect_list("rank").over(of_piece.rowsBetween(0, depth - 1))
    ranked = _ranked(sequences.withColumn("prefix", prefix), depth).filter("least IS NOT NULL")
    ranked = stage(ranked.withColumn("prefix", F.slice("prefix", 1, F.col("most").cast("int"))), "suffixes")
    place = F.struct(*_DOC, "line_no")
    # Equal lines have equal words: an entry has one ``least`` and one ``most``.
    entries = ranked.groupBy("rank").agg(F.min(place).alias("first"), F.min("prefix").alias("prefix"),
                                         F.min("least").alias("least"), F.min("most").alias("most"))
    array = stage(dense_ids(entries, "at", start=0, order_by=["rank"]), "suffix_array")
    before = array.select((F.col("at") + 1).alias("at"), F.col("prefix").alias("other"))
    compared = array.join(before, "at", "left")
    differs = F.array_position(F.zip_with("prefix", "other", lambda a, b: ~a.eqNullSafe(b)), F.lit(True))
    common = F.when(F.col("other").isNull(), 0).when(differs == 0, F.size("prefix")).otherwise(differs - 1)
    sizes = compared.select("at", "rank", "first", common.alias("common"), F.explode(F.sequence("least", "most")).alias("size"))
    # Intervals of each size: a new one begins where the common prefix with the neighbour before is shorter.
    opened = sizes.withColumn("opens", (F.col("common") < F.col("size")).cast("long")).drop("common")
    numbered = running_total(opened, ["size"], "at", "opens", "opened")
    numbered = numbered.select("rank", "first", "size", (F.col("opened") + F.col("opens")).alias("interval"))
    numbered = stage(numbered, "intervals")
    firsts = numbered.groupBy("size", "interval").agg(F.min("first").alias("kept"))
    of_rank = table_join(numbered, stage(firsts, "first_copies"), ["size", "interval"])
    # Sizes of a rank, one row each; a larger size has no fewer lines in later copies.
    kept = of_rank.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("size", "kept")), asc=False).alias("sizes"))
    marked = table_join(ranked.select(*_DOC, "n", "line_no", "rank"), stage(kept, "kept_copies"), ["rank"])
    later = F.filter("sizes", lambda s: ~s["kept"].eqNullSafe(place))
    return marked.select(*_DOC, "n", F.get(later, F.lit(0))["size"].alias("size")).filter("size IS NOT NULL")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, text_hash, deleted)``: the sorted numbers (from 0) of lines in later copies, per document with any."""
    sequences = stage(_sequences(stage(_lines(docs, id_col, text_col), "lines"), min_words), "sequences")
    depth = sequences.agg(F.coalesce(F.max("most"), F.lit(0))).first()[0]
    later = _repeated(sequences, max(1, depth))
    # A line goes if some later copy that starts at it or before it reaches it.
    reach = later.select(*_DOC, "n", (F.col("n") + F.col("size")).alias("reach"))
    same = [sequences[c].eqNullSafe(reach[c]) for c in [*_DOC, "n"]]
    joined = sequences.join(reach, same, "left").select(*[sequences[c] for c in [*_DOC, "piece", "n", "line_no"]], "reach")
    so_far = Window.partitionBy(*_DOC, "piece").orderBy("n")
    gone = joined.withColumn("far", F.max("reach").over(so_far)).filter("far > n")
    return gone.groupBy(*_DOC).agg(F.sort_array(F.collect_list("line_no")).alias("deleted"))


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                           deleted_col: str = "deleted_lines") -> DataFrame:
    """``docs`` with the lines of later copies taken out of ``text_col``, and their numbers (from 0) in ``deleted_col``.

    A run is any number of neighbouring lines that hold at least ``min_words`` words together; of a run that stands in
    several places all its lines go from all places but the first.

    Words are split at blanks, lines at line feeds; lines are equal if they are so without white space at their
    ends.  Lines without a word are not compared, do not interrupt a run, and stay.  The first copy is the one with
    the smallest id (null first), then text hash, then line; all copies in other places go, overlapping ones too.

    Null and empty texts lose nothing.  Rows with equal id and text are one document: none is a copy of the other,
    and each comes back.  A column of the name of ``deleted_col`` is replaced, others stay whatever their names; an
    empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c != deleted_col]
    doc, text_hash, gone = (free_name(c, docs.columns) for c in ("_doc", "_hash", "_gone"))
    deleted = stage(repeated_lines(docs, min_words, id_col, text_col), "deleted_lines")
    deleted = deleted.select(F.col("doc").alias(doc), F.col("text_hash").alias(text_hash), F.col("deleted").alias(gone))
    keyed = docs.select(*kept, docs[id_col].alias(doc), F.xxhash64(docs[text_col]).alias(text_hash))
    small = F.broadcast(deleted) if fits_broadcast(deleted) else deleted
    same = keyed[doc].eqNullSafe(small[doc]) & (keyed[text_hash] == small[text_hash])
    joined = keyed.join(small, same, "left").drop(small[doc], small[text_hash])
    # The array binds the split lines to a name, so that they are split once.
    rest = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    joined_lines = lambda lines: F.array_join(F.transform(rest(lines), lambda i: F.get(lines, i)), "\n")
    left = F.element_at(F.transform(F.array(_pieces(F.col(text_col))), joined_lines), 1)
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(left)
    numbers = F.coalesce(gone, F.array().cast("array<int>"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in kept], numbers.alias(deleted_col))
