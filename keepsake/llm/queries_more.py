"""Queries of the search, code and url operators, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keepsake.llm import codes, search, urls
from keepsake.llm.common import LOWER, UPPER, table


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP11_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
sized AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM doc WHERE len(w) > 0),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sized),
posting AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM doc) GROUP BY r, t),
spread AS (SELECT t, count(*) AS df FROM posting GROUP BY t),
item AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS w FROM benchmark),
wanted AS (SELECT i, t, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS weight
           FROM (SELECT i, unnest(w) AS t FROM item) JOIN spread USING (t), total),
scored AS (SELECT i, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
           FROM wanted JOIN posting USING (t) JOIN sized USING (r), total GROUP BY i, r),
ranked AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
           FROM scored JOIN sized USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked JOIN item USING (i) WHERE rank <= {search.TOP}
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


def _op12_sql() -> str:
    def near(book: str) -> str:
        """Each part's nearest entry: the least square, then the least index, in one number."""
        return (f"SELECT r, part, min(d * {codes.ENTRIES} + entry) AS best FROM (SELECT r, x.part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d "
                f"FROM x JOIN {book} b ON x.part = b.part AND x.pos = b.pos GROUP BY r, x.part, entry) GROUP BY r, part")

    rounds = []
    for i in range(codes.ROUNDS):
        rounds.append(f"""near{i} AS MATERIALIZED ({near(f"book{i}")}),
mean{i} AS (SELECT part, entry, pos, (s - ((s % n) + n) % n) // n AS c FROM (
  SELECT x.part, CAST(best % {codes.ENTRIES} AS BIGINT) AS entry, x.pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM x JOIN near{i} a ON x.r = a.r AND x.part = a.part GROUP BY ALL)),
book{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN mean{i} m
  ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)""")
    last = f"book{codes.ROUNDS}"
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (
  SELECT r, i // (n // {codes.PARTS}) AS part, i % (n // {codes.PARTS}) AS pos, CAST(floor({codes.SCALE}::DOUBLE * y) AS BIGINT) AS x
  FROM (SELECT r, len(e) AS n, unnest(e) AS y, unnest(range(0, len(e))) AS i FROM v)),
book0 AS MATERIALIZED (SELECT part, r AS entry, pos, x AS c FROM x WHERE r < {codes.ENTRIES}),
{", ".join(rounds)},
final_ AS MATERIALIZED ({near(last)}),
code_ AS (SELECT r, string_agg(lpad(to_hex(CAST(best % {codes.ENTRIES} AS BIGINT)), 2, '0'), '' ORDER BY part) AS code,
                 CAST(sum(best // {codes.ENTRIES}) AS BIGINT) AS error FROM final_ GROUP BY r),
rows_ AS (SELECT vec_id, label, lower(code) AS code, error FROM v JOIN code_ USING (r)),
by_label AS (SELECT label AS l, CAST(sum(error) AS BIGINT) AS label_error FROM rows_ GROUP BY label)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM {last}) AS codebooks_sha256
FROM rows_ JOIN by_label ON label IS NOT DISTINCT FROM l
"""


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def _op13_sql() -> str:
    k = urls.ORDER
    by_length = sorted(urls.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = "".join(f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for _, h, p in by_length)
    verdicts = "".join(f" WHEN '{h}{p}' THEN '{v}'" for v, h, p in by_length)
    orders, models = [], []
    for i in range(k + 1):
        orders.append(f"o{i} AS MATERIALIZED (SELECT right(g, {i + 1}) AS g, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b FROM gram GROUP BY right(g, {i + 1}))")
        lower = (f"SELECT g, a, b, {1 / urls.ALPHABET}::DOUBLE AS qa, {1 / urls.ALPHABET}::DOUBLE AS qb FROM o0" if i == 0 else
                 f"SELECT o.g, o.a, o.b, m.pa AS qa, m.pb AS qb FROM o{i} o JOIN m{i - 1} m ON right(o.g, {i}) = m.g")
        p = {c: f"CASE WHEN n{c} > 0 THEN ({c} + t{c} * q{c}) / (n{c} + t{c}) ELSE q{c} END AS p{c}" for c in "ab"}
        seen = ", ".join(f"CAST(sum({c}) OVER w AS BIGINT) AS n{c}, count(*) FILTER ({c} > 0) OVER w AS t{c}" for c in "ab")
        models.append(f"m{i} AS MATERIALIZED (SELECT g, {p['a']}, {p['b']} FROM (SELECT *, {seen} FROM ({lower}) WINDOW w AS (PARTITION BY left(g, {i}))))")
    return f"""
WITH cut AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, coalesce(strpos(url, '://'), 0) AS sep FROM pages),
named AS (SELECT *, CASE WHEN sep > 0 THEN translate(regexp_extract(substr(url, sep + 3), '^[^/?#]*'), '{UPPER}', '{LOWER}') ELSE '' END AS host,
                 CASE WHEN sep > 0 THEN regexp_extract(substr(url, sep + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM cut),
ruled AS (SELECT *, CASE{fits} END AS rule,
                 CASE WHEN sep > 0 THEN substr(url, 1, sep + 2) || host || substr(url, sep + 3 + length(host)) ELSE url END AS text FROM named),
kinds AS (SELECT *, CASE rule{verdicts} END AS kind FROM ruled),
texts AS (SELECT text, kind, count(*) AS n, kind IS NOT NULL AND CAST('0x' || substr(md5(text), 1, 4) AS BIGINT) % {urls.FOLDS} > 0 AS train FROM kinds GROUP BY text, kind),
place AS MATERIALIZED (SELECT text, kind, train, n, substr(repeat(chr(2), {k}) || text || chr(3), i, {k + 1}) AS g
          FROM (SELECT *, CAST(unnest(range(1, length(text) + 2)) AS BIGINT) AS i FROM texts)),
gram AS MATERIALIZED (SELECT g, coalesce(sum(n) FILTER (train AND kind = '{urls.ALLOW}'), 0) AS a, coalesce(sum(n) FILTER (train AND kind = '{urls.BLOCK}'), 0) AS b FROM place GROUP BY g),
{", ".join(orders)},
{", ".join(models)},
ratio AS (SELECT g, CAST(round((ln(pa) - ln(pb)) * {urls.MICRO}) AS BIGINT) AS v FROM m{k}),
score AS MATERIALIZED (SELECT text, kind, train, any_value(place.n) AS n, CAST(floor(sum(v)::DOUBLE / count(*)) AS BIGINT) AS score
          FROM place JOIN ratio USING (g) GROUP BY text, kind, train),
held AS (SELECT kind, greatest(least(floor(score / {urls.STEP}::DOUBLE), {urls.STEPS}), -{urls.STEPS}) AS step, n FROM score WHERE kind IS NOT NULL AND NOT train),
total AS (SELECT coalesce(sum(n) FILTER (kind = '{urls.ALLOW}'), 0) AS a, coalesce(sum(n) FILTER (kind = '{urls.BLOCK}'), 0) AS b FROM held),
error_ AS (SELECT bound, coalesce(sum(n) FILTER (kind = '{urls.ALLOW}' AND step < bound), 0) * (SELECT b FROM total)
                        + coalesce(sum(n) FILTER (kind = '{urls.BLOCK}' AND step >= bound), 0) * (SELECT a FROM total) AS e
           FROM held, (SELECT unnest(range(-{urls.STEPS}, {urls.STEPS} + 2)) AS bound) GROUP BY bound),
bound AS (SELECT CASE WHEN (SELECT count(DISTINCT kind) FROM texts WHERE train) < 2 THEN NULL
                      WHEN (SELECT a = 0 OR b = 0 FROM total) THEN 0
                      ELSE (SELECT bound FROM error_ ORDER BY e, abs(bound), bound LIMIT 1) * {urls.STEP} END AS bound)
SELECT page_id, host, path, rule,
       CASE WHEN k.kind IS NOT NULL THEN k.kind WHEN bound IS NULL OR s.score >= bound THEN '{urls.ALLOW}' ELSE '{urls.BLOCK}' END AS verdict,
       CASE WHEN k.kind IS NULL AND bound IS NOT NULL THEN s.score END AS score
FROM kinds k JOIN score s ON k.text = s.text AND k.kind IS NOT DISTINCT FROM s.kind, bound
"""


OP12_SQL, OP13_SQL = _op12_sql(), _op13_sql()
QUERIES = {
    "op11_ranked_search": (op11_ranked_search, OP11_SQL),
    "op12_vector_codes": (op12_vector_codes, OP12_SQL),
    "op13_url_filter": (op13_url_filter, OP13_SQL),
}
