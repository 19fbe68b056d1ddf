"""The registered queries of the numbered operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import (decontamination, embedding_dedup, exact_dedup, html_text, lm, mixing, near_copies,
                           periodic_runs, pii, spelling, token_counts, token_files, toxicity)
from orderflow.llm.base import table
from orderflow.session import scratch_path


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file (never copied into this repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op2(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op3(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each call, so every distinct text is encoded, stored and joined back
    return token_counts.op4(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"),
                            scratch_path(spark, "token-cache"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.op5(table(spark, sf_dir, "embeddings"))


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.op6(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op7(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                           scratch_path(spark, "token-files"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op8(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op9(table(spark, sf_dir, "documents"))


def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op11(table(spark, sf_dir, "documents"))


def op12_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.op12(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.op13(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_mixing, op2_html_text, op3_toxicity, op4_token_counts, op5_embedding_dedup, op6_near_copies,
             op7_token_files, op8_decontamination, op9_pii, op10_log_bilinear, op11_spelling_groups,
             op12_exact_copies, op13_periodic_runs]
    return {f.__name__: f for f in found}


#: Links by a comparison of all pairs, components by their closure.
OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT v.vec_id, coalesce(l.n, 0) AS n_links, least(v.vec_id, coalesce(r.m, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(r.m, v.vec_id) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = v.vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = v.vec_id"""

#: Every window of an item looked up at every word position of every document.
OP8_SQL = """
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), pattern AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
         array_to_string(w[i + 1:i + least(len(w), 10)], ' ') AS words
  FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
), place AS (
  SELECT rid, n, i, array_to_string(w[i + 1:i + n], ' ') AS words
  FROM (SELECT rid, w, n, unnest(range(0, greatest(len(w) - n + 1, 0))) AS i
        FROM doc, (SELECT DISTINCT n FROM pattern))
), hit AS (
  SELECT rid, i, n, item FROM place JOIN pattern USING (n, words)
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid
), found AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)"""


#: CRC-32 in SQL: the table of a byte's remainders, and the sum of the text {s} by it (``t`` is the table).
_CRC_TABLE = """step(b, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8
), crc AS (SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8)"""
_CRC = """xor(4294967295, list_reduce(list_transform(range(1, len(hex(encode({s}))), 2),
    lambda i: CAST('0x' || substr(hex(encode({s})), i, 2) AS BIGINT)),
    lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8), CAST(4294967295 AS BIGINT)))"""

#: Near words by their strings with one letter left out: two words of one length that agree without
#: the letter at the same place, or a word that is another without a letter.
OP11_SQL = f"""
WITH RECURSIVE {_CRC_TABLE}, run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, w AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents)
  WHERE length(w) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, {_CRC.format(s="(id || ':' || run)")} AS h FROM run, crc
), word AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), shorter AS (
  SELECT DISTINCT less.word AS a, less.n AS a_n, word.word AS b, word.n AS b_n FROM less JOIN word ON less.rest = word.word
), near AS (
  SELECT x.word AS a, y.word AS b, y.n AS b_n FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT a, b, b_n FROM shorter UNION SELECT b, a, a_n FROM shorter
), best AS (
  SELECT a, count(*) AS n_near, arg_min(b, (-b_n, b)) AS b, max(b_n) AS b_n FROM near GROUP BY a
), linked AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 10 * n THEN b END AS form,
         CASE WHEN b_n >= 10 * n THEN b_n END AS form_n
  FROM word LEFT JOIN best ON best.a = word.word
), way(word, here) AS (
  SELECT word, word FROM linked
  UNION ALL
  SELECT way.word, linked.form FROM way JOIN linked ON linked.word = way.here WHERE linked.form IS NOT NULL
)
SELECT linked.word, linked.form, way.here AS root, linked.n, linked.n_near, linked.form_n
FROM linked JOIN way ON way.word = linked.word JOIN linked last ON last.word = way.here AND last.form IS NULL"""

OP12_SQL = """
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER best = 1 AS kept, sha AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS points,
             sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS sha FROM documents)
WINDOW best AS (PARTITION BY sha ORDER BY points DESC, doc_id NULLS LAST)"""

#: Every pair of equal words of a document, by distance: stretches of neighbouring pairs are the
#: candidates, and of equal stretches the smallest distance is the period.
OP13_SQL = f"""
WITH RECURSIVE {_CRC_TABLE}, doc AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         {_CRC.format(s="coalesce(CAST(doc_id AS VARCHAR), '')")} AS h
  FROM documents, crc
), dealt AS (
  SELECT rid, len(w) AS n, w, h, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM doc
), word AS (
  SELECT rid, n, i, CASE WHEN i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] ELSE w[i + 1] END AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM dealt)
), same AS (
  SELECT x.rid, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.rid = y.rid AND x.w = y.w AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
), stretch AS (
  SELECT rid, q, min(i) AS s, count(*) + q AS k
  FROM (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM same)
  GROUP BY rid, q, island
), run AS (
  SELECT rid, s, k, min(q) AS q FROM stretch WHERE k >= greatest(12, 2 * q) GROUP BY rid, s, k
), listed AS (
  SELECT rid, count(*) AS n_runs, arg_min({{'s': s, 'k': k, 'q': q}}, (-k, s, q)) AS best,
         string_agg(s || ',' || k || ',' || q || chr(10), '' ORDER BY s, q) AS runs
  FROM run GROUP BY rid
), gone AS (
  SELECT DISTINCT rid, unnest(range(s + q, s + k)) AS i FROM run
), left_over AS (
  SELECT rid, string_agg(w, ' ' ORDER BY i) AS words FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.k AS length, best.q AS period,
       1000 * best.k // best.q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(words, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed USING (rid) LEFT JOIN left_over USING (rid)"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; tests hold the others against plain computations."""
    return {"op5_embedding_dedup": OP5_SQL, "op8_decontamination": OP8_SQL, "op11_spelling_groups": OP11_SQL,
            "op12_exact_copies": OP12_SQL, "op13_periodic_runs": OP13_SQL}
