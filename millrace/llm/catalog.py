"""Registered queries of the subpackage, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import Entry, Query
from millrace.llm import bpe, centroids, codes, jaccard, lines, neighbours, packing, quality, search, substrings, token_counts, toxicity, urls
from millrace.llm.vector_sql import clusters_sql, codes_sql
from millrace.session import new_stage_path

#: Vocabulary of the token operators, the id that closes a packed document, and the one that closes a document in a token file.
VOCABULARY = "word_bpe_49k.json"
PACKED_END, FILE_END = 2, 49407

#: The rules of the url filter.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_shared_lines(table(spark, sf_dir, "documents"), unknown_sites=True)
    return cleaned.select("doc_id", "text", F.col("lines_removed").cast("long").alias("lines_removed"))


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), PACKED_END)


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"), 85, 4)


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_stage_path(spark, "token-files")
    token_counts.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), FILE_END, folder)
    return token_counts.count_tokens(spark, folder, FILE_END)


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0, 10)


def _encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def _substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def _centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def line_dedup_sql(source: str, sites: int = lines.SITES) -> str:
    """What line dedup does to the table ``source``, row by row, with its columns and ``lines_removed``."""
    return f"""
        WITH numbered AS MATERIALIZED (
            SELECT *, row_number() OVER () AS __row FROM {source}
        ), split AS (
            SELECT __row, doc_id, source AS site, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS place
            FROM numbered
        ), trimmed AS (
            SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12) || chr(160)) AS bare FROM split
        ), shared AS (
            SELECT bare, min(doc_id) AS first_id FROM trimmed
            WHERE bare <> '' AND doc_id IS NOT NULL AND site IS NOT NULL
            GROUP BY bare HAVING count(DISTINCT site) > {sites}
        ), marked AS (
            SELECT t.__row, t.line, t.place, s.bare IS NOT NULL AND t.doc_id > s.first_id AS gone
            FROM trimmed t LEFT JOIN shared s ON t.bare = s.bare
        ), cleaned AS (
            SELECT __row, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text,
                   count(*) FILTER (WHERE gone) AS lines_removed
            FROM marked GROUP BY __row
        )
        SELECT d.* EXCLUDE (__row) REPLACE (CASE WHEN c.lines_removed > 0 THEN c.text ELSE d.text END AS text),
               coalesce(c.lines_removed, 0) AS lines_removed
        FROM numbered d LEFT JOIN cleaned c USING (__row)"""


_LINES_SQL = f"SELECT doc_id, text, lines_removed FROM ({line_dedup_sql('documents')})"


_SUBSTRINGS_SQL = r"""
    WITH docs AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), windows AS MATERIALIZED (
        SELECT d.r, d.doc_id, t.i, d.w[t.i : t.i + 12] AS words FROM docs d, unnest(range(1, len(d.w) - 11)) t(i)
    ), firsts AS (SELECT words, min(doc_id) AS first_id FROM windows GROUP BY words),
    covered AS MATERIALIZED (
        SELECT DISTINCT x.r, x.i + t.k AS i FROM windows x JOIN firsts f USING (words), range(13) t(k) WHERE f.first_id < x.doc_id
    ), placed AS (SELECT d.r, unnest(d.w) AS word, generate_subscripts(d.w, 1) AS i FROM docs d),
    kept AS (
        SELECT p.r, string_agg(p.word, ' ' ORDER BY p.i) AS text, count(*) AS n
        FROM placed p LEFT JOIN covered c ON c.r = p.r AND c.i = p.i WHERE c.r IS NULL GROUP BY p.r
    )
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
    FROM docs d LEFT JOIN kept k USING (r)"""


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_RUNS: dict[str, Query] = {
    "op1_toxicity": _toxicity,
    "op2_line_dedup": _lines,
    "op3_nearest_neighbours": _neighbours,
    "op4_packing": _packing,
    "op5_url_filter": _urls,
    "op6_quality": _quality,
    "op7_jaccard_join": _jaccard,
    "op8_token_counts": _token_counts,
    "op9_search": _search,
    "op10_bpe": _encoding,
    "op11_substring_dedup": _substrings,
    "op12_vector_codes": _codes,
    "op13_centroid_clusters": _centroids,
    "pipeline": _pipeline,
}
_SQL = {"op2_line_dedup": _LINES_SQL, "op11_substring_dedup": _SUBSTRINGS_SQL, "op12_vector_codes": codes_sql(), "op13_centroid_clusters": clusters_sql()}
ENTRIES = {name: Entry(run, _SQL.get(name)) for name, run in _RUNS.items()}
