"""One query for each operator, over whole tables, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.llm import decontaminate, embeddings, langid, licences, lines, mixing, sharding, simhash, substrings, toxicity
from keepsake.llm.common import table
from keepsake.llm.queries_more import QUERIES as MORE

QueryFn = Callable[[SparkSession, str], DataFrame]


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


OP1_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
tpl (template, label, base, grams, length, pos_, gram) AS (VALUES {", ".join(str(x) for x in licences.templates())}),
gram AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT r, w, unnest(range(0, len(w) - 1)) AS i FROM doc WHERE len(w) > 1)),
line AS (SELECT r, template, label, base, grams, length, i - pos_ AS diagonal, list(pos_) AS seen FROM gram JOIN tpl USING (gram) GROUP BY ALL),
exact AS (SELECT r, diagonal AS start_, label, base, 1.0::DOUBLE AS score FROM line WHERE base AND len(seen) = grams),
strong AS (SELECT *, coalesce(CAST(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licences.DRIFT} AS INT), 0) AS far
           FROM line WHERE NOT base AND len(seen) >= least(2, grams)),
run AS (SELECT *, sum(far) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM strong),
merged AS (SELECT r, template, run, label, base, grams, length, min(diagonal + list_min(seen)) AS start_,
                  max(diagonal + list_max(seen)) + {licences.GRAM} AS end_, len(list_distinct(flatten(list(seen)))) AS hits
           FROM run GROUP BY r, template, run, label, base, grams, length),
span AS (SELECT * FROM exact UNION ALL
         SELECT r, start_, label, base, hits::DOUBLE / grams FROM merged
         WHERE hits::DOUBLE / grams >= {licences.COVER} AND end_ - start_ <= length * {licences.STRETCH}),
tot AS (SELECT r, count(*) FILTER (base) AS n_base, min(start_) FILTER (base) AS first_word, max(start_) FILTER (base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM span GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM doc LEFT JOIN tot USING (r)
"""


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = decontaminate.matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return hit.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
phrase AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i + 1:i + 10], ' ') AS p
           FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
size_ AS (SELECT DISTINCT k FROM phrase),
place AS (SELECT r, k, s, array_to_string(w[s + 1:s + k], ' ') AS p
          FROM (SELECT r, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM doc, size_ WHERE len(w) >= k)),
hit AS (SELECT DISTINCT r, place.k, s, item_id FROM place JOIN phrase USING (k, p)),
word AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS pos FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that go, per document, by number."""
    return lines.mark(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = """
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS draw
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows_ GROUP BY source),
ranked AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
                  source_size * 2.0::DOUBLE AS top FROM src),
level AS (
  SELECT 0 AS i, (SELECT sum(source_size) FROM ranked)::DOUBLE * 1.5 / (SELECT sum(w) FROM ranked) AS l
  UNION ALL
  SELECT i + 1, n FROM (
    SELECT i, l, ((SELECT sum(source_size) FROM ranked)::DOUBLE * 1.5 - coalesce((SELECT sum(top) FROM ranked WHERE top <= l * w), 0))
                 / (SELECT sum(w) FROM ranked WHERE top > l * w) AS n FROM level) WHERE n > l),
goal AS (SELECT source, source_size, least(top, (SELECT max(l) FROM level) * w) AS target FROM ranked),
budget AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM goal),
-- the draws of one source in order; a draw is taken whole if over half of it is within the budget
by_draw AS (SELECT source, draw, sum(size) AS size FROM rows_ GROUP BY source, draw),
run AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw) AS upto FROM by_draw),
crossing AS (
  SELECT r.source, min(r.draw) AS draw FROM run r JOIN budget b ON r.source IS NOT DISTINCT FROM b.source
  WHERE r.upto > b.target - b.copies * b.source_size GROUP BY r.source),
edge AS (
  SELECT c.source, c.draw + CASE WHEN ((b.target - b.copies * b.source_size) - (r.upto - r.size)) * 2 >= r.size THEN 1 ELSE 0 END AS threshold
  FROM crossing c JOIN run r ON r.source IS NOT DISTINCT FROM c.source AND r.draw = c.draw
  JOIN budget b ON b.source IS NOT DISTINCT FROM c.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       CAST(d.size * (b.copies + CASE WHEN b.source_size = 0 OR b.target - b.copies * b.source_size <= 0 THEN 0
                                      WHEN e.threshold IS NULL OR d.draw < e.threshold THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rows_ d JOIN budget b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN edge e ON e.source IS NOT DISTINCT FROM d.source
"""


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return sharding.shard(d.withColumn("text_crc32", crc)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = """
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
spot AS (SELECT r, s, array_to_string(w[s + 1:s + 35], ' ') AS p
         FROM (SELECT r, w, unnest(range(0, len(w) - 34)) AS s FROM doc WHERE len(w) >= 35)),
twice AS (SELECT p FROM spot GROUP BY p HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS i FROM spot JOIN twice USING (p)),
word AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM doc),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS body FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    part = toxicity.fold(F.col("doc_id"), 3)
    return toxicity.scored(docs, labels, part != 1).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = toxicity.fold(F.col("doc_id"), 4)
    found = langid.identify(docs, langid.dictionaries(docs, part != 2))
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", "rejected")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp USING (vec_id)
"""


QUERIES: dict[str, tuple[QueryFn, str | None]] = {
    "op1_license_scan": (op1_license_scan, OP1_SQL),
    "op2_decontaminate": (op2_decontaminate, OP2_SQL),
    "op3_line_dedup": (op3_line_dedup, None),
    "op4_mix_sources": (op4_mix_sources, OP4_SQL),
    "op5_shard": (op5_shard, None),
    "op6_substring_dedup": (op6_substring_dedup, OP6_SQL),
    "op7_toxicity": (op7_toxicity, None),
    "op8_language": (op8_language, None),
    "op9_simhash_near_dedup": (op9_simhash_near_dedup, None),
    "op10_embedding_near_dedup": (op10_embedding_near_dedup, OP10_SQL),
    **MORE,
}
