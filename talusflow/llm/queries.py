"""The corpus operators over the driver tables, each beside its check SQL where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talusflow.llm import (
    decontamination,
    language_model,
    lexical_search,
    mixing,
    near_duplicates,
    packing,
    personal_data,
    spelling,
    topk_search,
    toxicity,
    url_rules,
    vector_duplicates,
    warc,
)
from talusflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run
    return register


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter(
        "base", lambda s: s["rank"] == personal_data.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[of(k) for k in personal_data.PATTERNS],
        F.sha2(personal_data.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        personal_data.spans_text(F.col("all")).alias("spans"))


@query("op9_url_rules")
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op10_mixing", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce('=' || source, '') AS s FROM documents),
r AS (SELECT *, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size), 1, 13))
             ::BIGINT::DOUBLE / 4503599627370496 AS u FROM d),
t AS (SELECT s, sum(size)::BIGINT AS source_size,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY s = '', s) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM r GROUP BY s),
l AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
             (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
               - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
      FROM t WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / w, s
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT s, source_size, CASE WHEN cap <= level * w THEN cap
             ELSE first_value(CASE WHEN cap > level * w THEN level END IGNORE NULLS) OVER (ORDER BY cap / w, s
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * w END AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM g),
q AS (SELECT r.doc_id, r.size, r.s, p.source_size, p.target, floor(ratio)::BIGINT AS whole,
             floor(target - floor(ratio)::BIGINT * source_size + 0.5)::BIGINT AS due,
             CASE WHEN ratio > floor(ratio) THEN (u / (1 - u))
                  / ((ratio - floor(ratio)) / (1.0::DOUBLE - (ratio - floor(ratio)))) END AS rank
      FROM r JOIN p USING (s)),
c AS (SELECT s, rank, sum(size) AS words, row_number() OVER (PARTITION BY s ORDER BY rank) AS pos
      FROM q WHERE rank IS NOT NULL GROUP BY s, rank),
walk AS (SELECT DISTINCT s, CAST(0 AS BIGINT) AS pos, due AS rest, NULL::DOUBLE AS rank, false AS took FROM q UNION ALL
      SELECT c.s, c.pos, CASE WHEN c.words <= walk.rest THEN walk.rest - c.words ELSE walk.rest END::BIGINT, c.rank,
             c.words <= walk.rest FROM walk JOIN c ON c.s = walk.s AND c.pos = walk.pos + 1),
left_over AS (SELECT s, min(rest) AS rest FROM walk GROUP BY s),
n AS (SELECT q.s, arg_min(q.rank, (abs(q.size - left_over.rest), q.rank)) AS last FROM q JOIN left_over USING (s)
      JOIN walk ON walk.s = q.s AND walk.rank = q.rank AND NOT walk.took WHERE abs(q.size - left_over.rest) < left_over.rest
      GROUP BY q.s)
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * (whole + CASE
         WHEN q.rank IS NULL THEN 0 WHEN walk.took OR q.rank = n.last THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q LEFT JOIN walk ON q.s = walk.s AND q.rank = walk.rank LEFT JOIN n ON q.s = n.s""")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_vector_duplicates")
def op5_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_duplicates.duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_topk_search")
def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op8_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_language_model")
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_language(table(spark, sf_dir, "documents"))


@query("op12_decontamination", r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p + 1:p + least(len(w), 10)], ' ') AS t
        FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT r, p, n, t FROM (SELECT r, p, n, array_to_string(w[p + 1:p + n], ' ') AS t FROM
        (SELECT r, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS p FROM d, sizes)) SEMI JOIN win USING (n, t)),
hit AS (SELECT r, count(DISTINCT p + k) AS n_hit FROM (SELECT r, p, unnest(range(n)) AS k FROM occ) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM
        (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM occ JOIN win USING (n, t)) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)""")
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op13_lexical_search", r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) SEMI JOIN q USING (t) GROUP BY ALL),
v AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
      FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
m AS (SELECT r, doc_id, 100 - 25 + ((25 * len(w) * n_docs) // n_terms) AS m FROM d, s WHERE len(w) > 0),
i AS (SELECT r, doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS impact
      FROM p JOIN v USING (t) JOIN m USING (r)),
f AS (SELECT item_id, r, doc_id, CAST(sum(c * impact) AS BIGINT) AS score FROM q JOIN i USING (t) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank,
       doc_id, score
FROM f WHERE score > 0 QUALIFY rank <= 20""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_spelling", r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
      WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (SELECT run, k, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
             lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + ord(c) // 64, 128 + ord(c) % 64] END)) AS b
      FROM runs),
hashed AS (SELECT run, k, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295),
             4294967295) AS h FROM bytes, crc),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k, CASE WHEN h % 97 = 0 THEN
             substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
del AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM
       (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM del a JOIN del b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM v a JOIN del b ON a.word = b.d
      UNION SELECT b.word, b.n, a.word, a.n FROM v a JOIN del b ON a.word = b.d),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, encode(other))) AS other, max(m) AS m FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form,
             CASE WHEN m >= 2 * n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM f UNION ALL
      SELECT chain.word, f.form FROM chain JOIN f ON chain.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)""")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
