"""The registered queries of the subpackage, and the pipeline."""

from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from conftest import SMALL
from odd_rows import empty, odd  # noqa: F401
from pyspark.sql import functions as F
from test_joins import brute_components
from test_tokens import check_packing, ids_of
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from millrace.llm import lines
from millrace.llm.catalog import ENTRIES, PACKED_END, VOCABULARY

COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op5_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op6_quality": ["doc_id", "held_out", "score", "predicted"],
    "op7_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op11_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op12_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13_centroid_clusters": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}


def test_registered():
    assert set(ENTRIES) <= set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in ENTRIES if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    frame = ENTRIES[name].run(spark, SMALL)
    assert frame.columns[: len(COLUMNS[name])] == COLUMNS[name] and frame.count() > 0


def test_url_filter_is_native(spark):
    plan = ENTRIES["op5_url_filter"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_line_dedup_equals_sql(spark):
    entry = ENTRIES["op2_line_dedup"]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    rows = sorted(tuple(r) for r in entry.run(spark, SMALL).collect())
    assert rows == sorted(connection.execute(entry.sql).fetchall()) and any(r[2] for r in rows)


def test_line_dedup_of_unknown_sites_equals_sql(spark, tmp_path):
    rows = [(i, "shared", f"s{i}") for i in range(1, 7)] + [(7, "shared", None), (8, "own\nshared", None), (0, "shared", None), (None, "shared", None)]
    rows += [(7, "own\nshared", "s1"), (7, "own\nshared", "s1"), (7, "other", "s2"), (9, None, "s1"), (10, "", "s1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    entry = ENTRIES["op2_line_dedup"]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    found = order(entry.run(spark, str(tmp_path)).collect())
    assert found == order(connection.execute(entry.sql).fetchall()) and {(7, "", 1), (8, "own", 1)} <= set(found)
    assert found.count((7, "own", 1)) == 2 and found.count((7, "other", 0)) == 1


def test_pipeline_stages(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs, kept = documents, [documents.count()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == documents.columns, name
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[1] < kept[0] and kept[-1] > kept[0] // 2
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == kept[-1]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    # Where documents are cut depends on how the rows were dealt; what is packed doesn't.
    counts = lambda frame: sorted(tuple(r) for r in frame.select("doc_id", "doc_tokens").distinct().collect())
    assert counts(corpus_pipeline.run(spark, SMALL)) == counts(packed)


def test_stages_on_odd_and_empty_rows(spark, odd, empty):  # noqa: F811
    """Null, empty, blank and repeated rows, rows without an id, and none at all: every stage gives its predecessor's columns."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(columns), empty.select(columns)):
        for name, function in corpus_pipeline.STAGES[:-1]:
            found = function(spark, docs, SMALL)
            assert found.columns == columns, name
            kept = found.collect()
            assert len(kept) <= docs.count() and (name == "near_duplicates" or {tuple(r) for r in kept if r.text} <= {tuple(r) for r in docs.collect()}), name
        packed = corpus_pipeline.pack(spark, docs, SMALL)
        assert packed.agg(F.count_distinct("doc_id").alias("n")).first().n == len({r.doc_id for r in docs.collect()} - {None})


def test_pipeline_equals_plain_python(spark):
    """Line dedup, near duplicates and packing, fed with what the two classifiers kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:2]:
        docs = function(spark, docs, SMALL)
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema)
    trim = lambda line: line.strip(" \t\r\x0b\x0c\xa0")
    sites, first = defaultdict(set), {}
    for r in rows:
        for line in filter(None, map(trim, (r.text or "").split("\n"))):
            if r.source is not None:
                sites[line].add(r.source)
                first[line] = min(first.get(line, r.doc_id), r.doc_id)
    texts = {}
    for r in rows:
        own = (r.text or "").split("\n")
        left = [x for x in own if len(sites[trim(x)]) <= lines.SITES or r.doc_id <= first[trim(x)]]
        if len(left) == len(own) or "\n".join(left).strip(" \t\r\n"):
            texts[r.doc_id] = r.text if len(left) == len(own) else "\n".join(left)
    docs = corpus_pipeline.line_dedup(spark, docs, SMALL)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(texts.items())
    top = brute_components(texts.items(), 80, 5)
    texts = {i: t for i, t in texts.items() if top[i][1] == i}
    docs = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(texts.items())
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    packed = corpus_pipeline.pack(spark, docs, SMALL).collect()
    check_packing(packed, texts, library, PACKED_END)
    assert {r.doc_id for r in packed} == set(texts) and sum(r.length for r in packed) >= sum(len(ids_of(library, t)) + 1 for t in texts.values())
