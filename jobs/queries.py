"""The jobs as queries: each runs twice into one new folder of the shared directory and gives the output as it stands then."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamella.sources import store

from . import notes, stacks


def job1_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = store.scratch(spark)
    # A pattern that only this path fits: the stream lists it whether it is a file or a folder.
    source = f"{sf_dir}/documents.parque[t]"
    for _ in range(2):
        done = notes.run(spark, source, f"{folder}/notes", f"{folder}/mark")
    return done


JOB1_SQL = r"""
WITH d AS (
    SELECT DISTINCT doc_id, source, text, sha256(text) AS digest,
        list_transform(string_split(text, chr(10)), lambda x: regexp_extract_all(x, '[0-9]+')) AS v,
        list_transform(string_split(text, chr(10)), lambda x: regexp_matches(lower(x), 'resolution|pixel size|version')) AS said
    FROM documents
), r AS (
    SELECT doc_id, source, digest,
        len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::INT AS n_lines,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
        coalesce(list_filter(list_zip(v, said), lambda p: p[2] AND len(p[1]) >= 2)[1][1], CASE WHEN len(v[6]) >= 2 THEN v[6] END) AS n
    FROM d
), o AS (
    SELECT *, CASE WHEN n IS NOT NULL THEN doc_id END AS own, TRY_CAST(n[1] AS INT) AS y, TRY_CAST(n[2] AS INT) AS x FROM r
), f AS (
    SELECT *, last_value(own IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before, first_value(own IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after, min(doc_id) OVER (PARTITION BY source, digest) AS first
    FROM o WINDOW w AS (PARTITION BY source ORDER BY doc_id)
)
SELECT f.doc_id, f.source, f.n_lines, f.n_words, f.digest, CASE WHEN f.first <> f.doc_id THEN f.first END AS copy_of, g.y AS res_y, g.x AS res_x,
    CASE WHEN f.own IS NOT NULL THEN 'own' WHEN f.before IS NOT NULL THEN 'previous' WHEN f.after IS NOT NULL THEN 'next' END AS filled_from, coalesce(f.before, f.after) AS from_id
FROM f LEFT JOIN o g ON g.doc_id = coalesce(f.before, f.after)
"""


def job2_stacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = store.scratch(spark)
    for _ in range(2):
        done = stacks.run(spark, f"{sf_dir}/pages.parquet", folder)
    return done


JOB2_SQL = r"""
WITH p AS (
    SELECT url, regexp_extract(url, '^[a-z]+://([^/?#]+)/([^/?#]+)/(\d+)(?:\.html)?/?(?:[?#].*)?$', ['host', 'stack', 'z']) AS m FROM pages
), n AS (
    SELECT url, regexp_replace(regexp_replace(regexp_replace(m.host, '^www\.', ''), '^m\.', ''), '^blog\.', '') AS dataset, m.stack AS stack, TRY_CAST(m.z AS INT) AS z FROM p WHERE m.z <> ''
), s AS (
    SELECT dataset, z, list_sort(list_distinct(list(stack))) AS m, count(*) AS n_paths, min(url) AS first_path FROM n WHERE z IS NOT NULL GROUP BY dataset, z
), i AS (
    SELECT *, CASE WHEN m IS DISTINCT FROM lag(m) OVER (PARTITION BY dataset ORDER BY z) THEN 1 ELSE 0 END AS new, lead(z) OVER (PARTITION BY dataset ORDER BY z) AS following FROM s
), r AS (
    SELECT *, sum(new) OVER (PARTITION BY dataset ORDER BY z)::BIGINT AS run FROM i
)
SELECT dataset, z, run, CASE WHEN run < 10 THEN '0' ELSE '' END || run || '_' || array_to_string(m, '_') AS name, len(m) > 1 AS combined, array_to_string(m, ',') AS members, n_paths, first_path,
    min(z) OVER (PARTITION BY dataset, run) AS z_start, (max(z) OVER (PARTITION BY dataset, run) + 1)::INT AS z_end, coalesce(following - z - 1, 0)::INT AS gap
FROM r
"""

QUERIES = {f.__name__: f for f in (job1_notes, job2_stacks)}
ORACLES = {"job1_notes": JOB1_SQL, "job2_stacks": JOB2_SQL}
