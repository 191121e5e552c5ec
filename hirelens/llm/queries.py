"""The registered queries of this package, one per operator, each over its whole table, and their SQL."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelens.llm.bulk_packing import best_fit_packed, encoded_pieces
from hirelens.llm.centroids import cluster_table, cluster_vectors
from hirelens.llm.chat_perspective import perspectives
from hirelens.llm.common import read
from hirelens.llm.decontaminate import leaks
from hirelens.llm.embedding_dedup import embedding_groups
from hirelens.llm.line_dedup import without_repeated_lines
from hirelens.llm.mixing import mixed_counts
from hirelens.llm.packing import document_digests, packed_sequences, read_matrices, write_matrices
from hirelens.llm.quality import quality_scores
from hirelens.llm.ranked_search import ranked_search
from hirelens.llm.shipping import shipped
from hirelens.llm.simhash import simhash_groups
from hirelens.llm.token_counts import token_counts
from hirelens.llm.warc import read_archives, write_archives
from hirelens.operators.staging import scratch_path


@shipped
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@shipped
def op2_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@shipped
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = without_repeated_lines(read(spark, sf_dir, "documents"), min_words=10)
    return made.select("doc_id", F.size("deleted_lines").alias("n_deleted"),
                       F.array_join(F.col("deleted_lines").cast("array<string>"), ",").alias("deleted_lines"),
                       F.md5(F.col("text").cast("binary")).alias("text_md5"))


@shipped
def op4_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(read(spark, sf_dir, "embeddings"), threshold=0.93)


@shipped
def op5_packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the matrix files hold of every document, read back from them."""
    packed = packed_sequences(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    folder = scratch_path(spark, "matrices")
    write_matrices(packed, folder)
    return document_digests(read_matrices(spark, folder))


@shipped
def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = perspectives(read(spark, sf_dir, "conversations"))
    spans = F.transform("loss_spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return made.withColumn("loss_spans", F.array_join(spans, ","))


@shipped
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@shipped
def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents"), shingle_words=4, distance=4)


@shipped
def op9_mixed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_counts(read(spark, sf_dir, "documents"))


@shipped
def op10_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "archives")
    write_archives(read(spark, sf_dir, "pages"), folder, min_bytes=0)
    return read_archives(spark, folder, payloads=False).drop("url", "payload")


@shipped
def op11_ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), top=10)


@shipped
def op12_best_fit_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece stands; the checksum is taken of its ids, which then need not travel."""
    pieces = encoded_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096)
    return best_fit_packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=4096)


def op13_vector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cluster_table(cluster_vectors(read(spark, sf_dir, "embeddings"), k=16, rounds=3))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return made.withColumn("centroid_sha256", digest).drop("centroid")


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_quality_scores,
        op3_line_dedup,
        op4_embedding_groups,
        op5_packed_documents,
        op6_chat_perspectives,
        op7_benchmark_leaks,
        op8_simhash_groups,
        op9_mixed_counts,
        op10_warc_records,
        op11_ranked_documents,
        op12_best_fit_sequences,
        op13_vector_clusters,
    )
}

# A run of lines is told by its text; all but the first place of a run go.  A run with enough words is the union of
# the shortest stretches with enough words from its lines on and up to its lines: these are compared.
_OP3 = r"""
    WITH split AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no FROM documents),
    worded AS (SELECT *, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM split),
    counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
                       row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS n FROM worded WHERE line <> ''),
    placed AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY n) AS through,
                         sum(words) OVER (PARTITION BY doc_id ORDER BY n) - words AS before FROM counted),
    onward AS (SELECT doc_id, n AS start, n + count(*) OVER run AS stop, string_agg(line, chr(10)) OVER run AS body,
                      sum(words) OVER run AS held FROM placed
               WINDOW run AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 9 FOLLOWING)),
    upto AS (SELECT doc_id, n + 1 - count(*) OVER run AS start, n + 1 AS stop, string_agg(line, chr(10)) OVER run AS body,
                    sum(words) OVER run AS held FROM placed
             WINDOW run AS (PARTITION BY doc_id ORDER BY through RANGE BETWEEN 9 PRECEDING AND CURRENT ROW)),
    runs AS (SELECT DISTINCT * FROM (FROM onward UNION ALL FROM upto) WHERE held >= 10),
    copies AS (SELECT doc_id, start, stop, row_number() OVER (PARTITION BY body ORDER BY doc_id, start) AS copy FROM runs),
    later AS (SELECT doc_id, start AS n, max(stop) AS reach FROM copies WHERE copy > 1 GROUP BY ALL),
    gone AS (SELECT doc_id, line_no, coalesce(max(reach) OVER (PARTITION BY doc_id ORDER BY n) > n, false) AS deleted
             FROM placed LEFT JOIN later USING (doc_id, n)),
    by_doc AS (SELECT s.doc_id, count(*) FILTER (deleted) AS n_deleted,
                      coalesce(string_agg(CAST(s.line_no AS VARCHAR), ',' ORDER BY s.line_no) FILTER (deleted), '') AS deleted_lines,
                      coalesce(string_agg(s.raw, chr(10) ORDER BY s.line_no) FILTER (NOT coalesce(deleted, false)), '') AS body
               FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.line_no = s.line_no GROUP BY 1)
    SELECT doc_id, CAST(n_deleted AS INTEGER) AS n_deleted, deleted_lines, md5(body) AS text_md5 FROM by_doc"""

_OP4 = """
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    usable AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
                 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
              WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
    reached AS (SELECT a AS vec_id, a AS other FROM links
                UNION SELECT reached.vec_id, b FROM reached JOIN links ON a = other),
    least AS (SELECT vec_id, min(other) AS root FROM reached GROUP BY 1),
    counts AS (SELECT a AS vec_id, count(DISTINCT b) AS n FROM links GROUP BY 1)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id,
           coalesce(coalesce(root, vec_id) = vec_id, false) AS kept
    FROM v LEFT JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)"""

# Five hexadecimal digits of the SHA-1 are four digits of base 32.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_OP10 = f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    r AS (SELECT *, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS first FROM p)
    SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i:
               substr('{_BASE32}', 1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)),
               '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM r"""

# A conversation is rendered in parts of 256 turns; names are roles with an underscore for white space inside.
_OP6 = r"""
    WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS text, regexp_replace(
                 trim(coalesce(role, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', '_', 'g') AS role
               FROM conversations),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1) // 256 AS part FROM t),
    speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role NOT IN ('system', '')),
    said AS (SELECT p.conv_id, speaker, part, turn, role, text, role = speaker AS own,
                    '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role WHEN role = '' THEN 'user'
                                           ELSE 'user name=' || role END || chr(10) AS head
             FROM placed p JOIN speakers s ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
    pieces AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS piece FROM said),
    set_at AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role, text
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM pieces)
    SELECT conv_id, speaker, CAST(part AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS n_turns,
           string_agg(piece, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
           coalesce(string_agg((pos + length(head)) || '-' || (pos + length(piece) - 1), ',' ORDER BY pos) FILTER (own), '') AS loss_spans,
           CAST(coalesce(sum(length(piece) - length(head) - 1) FILTER (own), 0) AS INTEGER) AS n_loss_chars
    FROM set_at GROUP BY conv_id, speaker, part"""

_OP11 = r"""
    WITH cut AS (SELECT row_number() OVER () AS r, doc_id,
                        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
    held AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM cut WHERE len(ts) > 0),
    whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM held),
    asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    counted AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM held)
                WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weighed AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                FROM counted, whole GROUP BY term, n_docs),
    scored AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms))))) AS BIGINT) AS score
               FROM asked JOIN counted USING (term) JOIN weighed USING (term) JOIN held USING (r), whole GROUP BY ALL),
    ranked AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
               FROM scored JOIN held USING (r) WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


def _op13(rounds: int) -> str:
    """Rounds one after another; sums of a component are floored after division, also below zero."""
    nearest = """(SELECT r, min({'d': d, 'c': c}) AS best FROM (
                   SELECT r, c, list_sum(list_transform(range(1, 65), lambda i: (q.v[i] - k.v[i]) * (q.v[i] - k.v[i]))) AS d
                   FROM q, k%d k) GROUP BY r)"""
    steps = "".join(f"""
    a{i} AS MATERIALIZED (SELECT r, v, best['c'] AS c FROM {nearest % i} JOIN q USING (r)),
    k{i + 1} AS MATERIALIZED (
      SELECT k.c, coalesce(m.v, k.v) AS v FROM k{i} k LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
          SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY c, i)
        GROUP BY c) m USING (c)),""" for i in range(rounds))
    return f"""
    WITH q AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    k0 AS MATERIALIZED (SELECT c, v FROM (
      SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS c, v FROM q) WHERE c < 16),{steps}
    last AS (SELECT r, CAST(best['d'] AS BIGINT) AS distance, best['c'] AS c FROM {nearest % rounds})
    SELECT vec_id, c AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
    FROM last JOIN q USING (r) JOIN k{rounds} k USING (c)"""


ORACLE_SQL: dict[str, str] = {
    "op10_warc_records": _OP10,
    "op11_ranked_documents": _OP11,
    "op13_vector_clusters": _op13(3),
    "op3_line_dedup": _OP3,
    "op4_embedding_groups": _OP4,
    "op6_chat_perspectives": _OP6,
}
