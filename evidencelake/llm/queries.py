"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, clusters, decontaminate, images, langid, licenses, mixing, quality, runs, simhash, token_files, toxicity, url_filter

#: The tokenizer of op6 and the rank file of op11; PUBLIC_TOKENIZER and PUBLIC_RANKS override them.
END_ID = 2


def tokenizer_path() -> str:
    given = os.environ.get("PUBLIC_TOKENIZER")
    if given:
        return given
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def ranks_path() -> str:
    given = os.environ.get("PUBLIC_RANKS")
    if given:
        return given
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op4_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edited copies of the pictures of every fiftieth page, searched for among the pictures of all pages; classes of both."""
    pages = table(spark, sf_dir, "pages")
    return images.copies(images.page_images(pages.where(pages["page_id"] % 50 == 0), copies=True), images.page_images(pages))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_ids(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks_path())


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.assignments(table(spark, sf_dir, "embeddings"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.collapse(runs.looped(table(spark, sf_dir, "documents"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_mixing, op3_url_filter, op4_image_copies, op5_toxicity, op6_token_files, op7_decontamination, op8_simhash, op9_licenses, op10_language, op11_bpe, op12_centroids, op13_runs, pipeline)}


#: Words of a text after A-Z is lower-cased.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _url_sql(prior: float = 0.1, weight: float = 8.0, z: float = 1.96, threshold: float = 0.5) -> str:
    """The url filter in SQL: rules, templates level by level, purity."""
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r[1]), r[1]))
    fits = [(v, r, "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*r.split("/", 1))) for v, r in rules]
    case = lambda k: "CASE " + " ".join(f"WHEN {f[2]} THEN '{f[k]}'" for f in fits) + " END"
    variable = r"regexp_matches(x, '^[0-9]+(\.[A-Za-z]+)?$') OR regexp_matches(x, '^[0-9a-fA-F-]{16,}$') OR (regexp_matches(x, '^[A-Za-z0-9_.-]{12,}$') AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]'))"
    a, b = f"(before_l + {weight})", f"(cl + {weight})"
    p, q = f"((before_b + {weight * prior}) / {a})", f"((cb + {weight * prior}) / {b})"
    pooled = f"(({p} * {a} + {q} * {b}) / ({a} + {b}))"
    differs = f"abs({p} - {q}) > {z} * sqrt({pooled} * (1 - {pooled}) * (1 / {a} + 1 / {b}))"
    upward = f"PARTITION BY host, prefix, cl > 0, seg = '' ORDER BY (cb + {weight * prior}) / (cl + {weight}), cl, cb"
    return f"""WITH RECURSIVE r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM r),
u AS (SELECT *, {case(1)} AS rule, {case(0)} AS told, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: CASE WHEN {variable} THEN '*' ELSE x END) AS segs FROM p),
walk AS (
SELECT host, segs, count(told) AS labelled, count(*) FILTER (told = 'block') AS bad, '' AS prefix, 0 AS level FROM u WHERE host <> '' GROUP BY host, segs
UNION ALL
SELECT host, segs, labelled, bad, CASE WHEN seg = '' THEN prefix WHEN members = 1 THEN prefix || '/' || seg WHEN members = branches THEN prefix || '/*' ELSE prefix || '/*~' || first END, level + 1 FROM (
SELECT *, count(DISTINCT seg) OVER kind AS members, min(seg) OVER kind AS first, count(DISTINCT CASE WHEN seg <> '' THEN seg END) OVER (PARTITION BY host, prefix) AS branches FROM (
SELECT *, sum(cut) OVER ({upward}) AS cluster FROM (
SELECT *, CASE WHEN cl = 0 OR seg = '' THEN 0 ELSE CAST(coalesce({differs}, true) AS INT) END AS cut FROM (
SELECT *, lag(cl) OVER ({upward}) AS before_l, lag(cb) OVER ({upward}) AS before_b FROM (
SELECT *, sum(labelled) OVER (PARTITION BY host, prefix, seg) AS cl, sum(bad) OVER (PARTITION BY host, prefix, seg) AS cb FROM (SELECT *, CASE WHEN len(segs) > level THEN segs[level + 1] ELSE '' END AS seg FROM walk WHERE level <= len(segs))))))
WINDOW kind AS (PARTITION BY host, prefix, cl > 0, seg = '', cluster))),
t AS (SELECT * FROM walk WHERE level = len(segs) + 1),
v AS (SELECT host, prefix, (sum(bad) + {prior * weight}) / (sum(labelled) + {weight}) AS purity FROM t GROUP BY ALL),
w AS (SELECT host, segs, purity FROM t JOIN v USING (host, prefix))
SELECT page_id, host, path, rule, coalesce(told, CASE WHEN purity >= {threshold} THEN 'block' ELSE 'allow' END) AS verdict FROM u LEFT JOIN w USING (host, segs)"""


def _centroid_sql(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024) -> str:
    """Lloyd's rounds one after the other, every vector against every centroid, in exact integers."""
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS k, e FROM (SELECT e, sha256('3:' || vec_id) AS h FROM v) QUALIFY k < {k})",
    ]
    for r in range(rounds + 1):
        parts.append(f"d{r} AS MATERIALIZED (SELECT rid, vec_id, v.e AS e, k, list_sum(list_transform(range(1, {width} + 1), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS d FROM v, c{r} c)")
        parts.append(f"a{r} AS MATERIALIZED (SELECT rid, vec_id, e, k, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)")
        if r < rounds:
            parts.append(f"s{r} AS (SELECT k, i, sum(e[i]) AS s, count(*) AS n FROM a{r}, range(1, {width} + 1) AS g(i) GROUP BY k, i)")
            parts.append(f"m{r} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM s{r} GROUP BY k)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.k AS k, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k)")
    return f"WITH {', '.join(parts)} SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k"


SQL = {
    "op12_centroids": _centroid_sql(),
    "op3_url_filter": _url_sql(),
    "op7_decontamination": f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k : k + 9], ' ') AS win FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, k, n, array_to_string(w[k : k + n - 1], ' ') AS win FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d JOIN (SELECT DISTINCT n FROM bw) ON len(w) >= n)),
hits AS (SELECT rid, k, n, item FROM dw JOIN bw USING (n, win)),
places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)""",
}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL expresses; the others are held against brute force in the tests."""
    return SQL
