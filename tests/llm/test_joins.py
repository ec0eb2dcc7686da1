"""Near duplicates, neighbours and search against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from odd_rows import empty, odd  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm import jaccard, neighbours, search
from millrace.llm.components import connected_components
from millrace.session import stage as search_stage


def brute_components(rows, percent, size):
    sets = {}
    for i, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            a, b = sets[x], sets[y]
            if x < y and a and b and 100 * len(a & b) >= percent * len(a | b) and find(x) != find(y):
                top[max(find(x), find(y))] = min(find(x), find(y))
    return {i: (len(sets[i]), find(i)) for i in sets}


def copies(seed=5, groups=6, most=60):
    """Groups of near copies round the limit, and texts that share a passage."""
    draw = random.Random(seed)
    word = lambda: draw.choice("bcdfgh") + draw.choice("aeiou") + draw.choice("klmnp") + draw.choice("aeiou")
    passage = [word() for _ in range(60)]
    rows, number = [], 0
    for g in range(groups):
        base = [word() for _ in range(draw.randint(20, 140))]
        for _ in range(draw.choice([2, 5, most])):
            text = list(base)
            for _ in range(draw.randint(0, 3)):
                text[draw.randrange(len(text))] = word()
            rows.append((number, " ".join(text + (passage if g % 3 == 0 else []))))
            number += 1
    rows += [(number + k, " ".join([word() for _ in range(draw.randint(3, 80))] + passage)) for k in range(60)]
    return rows


@pytest.mark.parametrize(("leaf", "frequent_from", "chunk"), [(192, 64, 4_000_000), (6, 3, 3000)])
def test_components_equal_brute_force(spark, monkeypatch, leaf, frequent_from, chunk):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", frequent_from)
    monkeypatch.setattr(jaccard, "LOCAL", 2)
    monkeypatch.setattr(jaccard, "CHUNK_CHARS", chunk)
    rows = copies()
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(documents).collect()}
    assert found == brute_components(rows, 85, 4)


def test_leaves_meet_once(spark, monkeypatch):
    """The second pass sends no pair of leaves that the first has compared."""
    monkeypatch.setattr(jaccard, "LEAF", 6)
    met, links = [], jaccard._links

    def noted(units, percent):
        sides = {}
        for r in units.select("unit", "side", "digest").collect():
            sides.setdefault(r.unit, (set(), set()))[r.side].add(bytes(r.digest))
        met.append({frozenset((a, b)) for one, two in sides.values() for a in one for b in two})
        return links(units, percent)

    monkeypatch.setattr(jaccard, "_links", noted)
    rows = copies()
    found = {r.doc_id: r.component_id for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: top for i, (_, top) in brute_components(rows, 85, 4).items()}
    assert len(met) == 2 and met[1] and not met[0] & met[1]


def test_components_of_odd_rows(odd, empty):
    found = jaccard.components(odd).collect()
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in found}
    assert len(found) == odd.count() and jaccard.components(empty).count() == 0
    assert {(1, 12, 1), (5, 12, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (6, 1, 6), (7, 1, 6), (8, 1, 8), (None, 2, None)} <= rows
    kept = jaccard.keep_first(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 3, 4, 6, 8, 9]


def test_one_row_of_each_component(odd, empty):
    more = [(None, "a row without an id", "en", "z", 1, 0, 0), (None, "one two", "en", "a", 7, 0, 0)]
    kept = jaccard.keep_one(odd.unionByName(odd.sparkSession.createDataFrame(more, odd.schema)))
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8, 9]
    assert jaccard.keep_one(empty).count() == 0


def test_links_of_two_leaves_equal_brute_force():
    draw = np.random.default_rng(2)
    pool = draw.integers(0, 1 << 62, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([pool[k % 5 * 60 : k % 5 * 60 + 60][draw.random(60) > 0.05], draw.choice(pool, 3)])) for k in range(40)]
    sizes = np.array([len(s) for s in sets])
    labels = np.array([bytes([k]) for k in range(40)])
    close = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
    for pairs, left, right in (
        (jaccard.linked_pairs(sets, sizes, labels, None, 85), range(40), range(40)),
        (jaccard.linked_pairs(sets[:25], sizes[:25], labels[:25], (sets[25:], sizes[25:], labels[25:]), 85), range(25), range(25, 40)),
    ):
        assert all(close(sets[i], sets[j]) for i, j in pairs)
        top = list(range(40))
        find = lambda i: i if top[i] == i else find(top[i])  # noqa: B023, E731
        for i, j in pairs:
            top[find(i)] = find(j)
        assert all(find(i) == find(j) for i in left for j in right if close(sets[i], sets[j]))


def test_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(1, 1), (None, 3)]
    found = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 400)]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_neighbours_recall_and_scores(spark):
    draw = np.random.default_rng(4)
    vectors = draw.standard_normal((900, 24)).round(3)
    vectors[300:420] = vectors[0]  # many equal vectors
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(5000, None, "x"), (5001, [0.0] * 24, "x"), (5002, [float("nan")] + [1.0] * 23, "x"), (5003, [None] + [1.0] * 23, "x"), (None, [1.0] * 24, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, key string").repartition(4)
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()
    original = vectors.astype(np.float32).astype(np.float64)
    recall = []
    for q in range(0, 900, 20):
        scores = original @ original[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(900), -scores))[:20]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and len({r.vec_id for r in own} - {q}) == 20
        assert np.allclose([r.score for r in own], scores[[r.vec_id for r in own]], atol=1e-9)
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        recall.append(sum(r.score >= scores[best[-1]] - 1e-9 for r in own) / 20)
        if q in (0, 300, 320):
            assert [r.vec_id for r in own] == best.tolist(), "ties go to the smaller id"
    assert np.mean(recall) >= 0.95
    assert neighbours.nearest(table.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in neighbours.nearest(few, F.col("vec_id") == 0, 20).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.0)]


@pytest.mark.parametrize(("clusters", "size"), [(2, 10), (60, 12), (40, 20)])
def test_neighbours_of_clusters(spark, clusters, size):
    """Near copies, not equal: lists must lead out of a cluster that holds fewer than k candidates."""
    draw = np.random.default_rng(size)
    vectors = np.repeat(draw.standard_normal((clusters, 32)), size, 0) + 0.02 * draw.standard_normal((clusters * size, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 5 == 0, 20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in range(0, len(vectors), 5):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = np.argsort(-scores)[: min(20, len(vectors) - 1)].tolist()
        assert len(found[q]) == len(best)
        recall.append(len(found[q].intersection(best)) / len(best))
    assert np.mean(recall) >= 0.97


@pytest.mark.parametrize("clusters, size", [(60, 30), (60, 60), (15, 200)])
def test_neighbours_in_dense_clusters(spark, clusters, size):
    """Clusters of near copies, larger than a node's list: members differ by less than one part in a thousand."""
    random_ = np.random.default_rng(size)
    centres = random_.standard_normal((clusters, 32))
    vectors = np.repeat(centres / np.linalg.norm(centres, axis=1)[:, None], size, axis=0) + random_.normal(0, 0.02, (clusters * size, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in range(0, len(vectors), 20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        recall.append(len(found[q].intersection(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.95 and min(recall) >= 0.7


def test_neighbours_of_several_lengths(spark):
    """Shorter vectors count as filled up with zeros; none is lost."""
    random_ = np.random.default_rng(4)
    vectors = [random_.standard_normal(9 if i == 30 else 8).tolist() for i in range(61)]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in neighbours.nearest(table, F.lit(True), 5).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    filled = np.array([v + [0.0] * (9 - len(v)) for v in vectors])
    for q in range(61):
        scores = (filled * filled[q]).sum(1)
        scores[q] = -np.inf
        assert found[q] == np.argsort(-scores)[:5].tolist()


def test_short_queries_are_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "FULL_QUERIES", 7)
    monkeypatch.setattr(neighbours, "FULL_ROWS", 50)
    monkeypatch.setattr(neighbours, "search_graph", lambda queries, *_: queries.selectExpr("query", "vector", "cast(array() as array<struct<id: long>>) as beam"))
    vectors = np.random.default_rng(6).standard_normal((300, 8))
    vectors[50:60] = vectors[3]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 10 == 0, 20).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 300, 10):
        scores = (vectors * vectors[q]).sum(1)
        scores[q] = -np.inf
        assert found[q] == np.lexsort((np.arange(300), -scores))[:20].tolist()


def brute_search(rows, wanted, k):
    counts = [(i, Counter(re.findall(r"[^\W_]+", (t or "").lower()))) for i, t in rows if i is not None]
    mean = sum(sum(c.values()) for _, c in counts) / len(counts)
    df = Counter(w for _, c in counts for w in c)
    out = {}
    for q, query in counts:
        if not wanted(q):
            continue
        scored = []
        for i, c in counts:
            length = 1 - search.B + search.B * sum(c.values()) / mean
            score = sum(n * np.log(1 + (len(counts) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (search.K1 + 1) / (c[w] + search.K1 * length) for w, n in query.items() if w in c)
            if i != q and score > 0:
                scored.append((-round(score, 9), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD", 30)
    monkeypatch.setattr(search, "BLOCK", 4)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", F.substring("text", 1, 600).alias("text"))
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = {}
    for r in search.search(documents.repartition(3), F.col("doc_id") % 10 == 0, 5).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r)
    wanted = brute_search(rows, lambda i: i % 10 == 0, 5)
    assert set(found) == {q for q, best in wanted.items() if best}
    for q, best in found.items():
        assert [r["rank"] for r in best] == list(range(1, len(best) + 1))
        assert np.allclose([r.score for r in best], [s for _, s in wanted[q]], rtol=1e-6)
        assert [r.doc_id for r in best] == [i for i, _ in wanted[q]] or len({s for _, s in wanted[q]}) < len(best)


def test_shards_order_documents_by_their_most_frequent_word(spark):
    texts = [(i, ("der stein der fluss" if i % 2 else "the stone the river") + f" n{i}") for i in range(40)]
    (row,) = search.index_shards(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()
    odd = (np.frombuffer(row["ids"], np.int64) % 2).tolist()
    assert sorted(odd) in (odd, odd[::-1])


@pytest.mark.parametrize(("elements", "together"), [(0, 256), (1, 3), (10**9, 7)])
def test_matrix_and_lists_give_the_same_scores(spark, monkeypatch, elements, together):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 400").select("doc_id", F.substring("text", 1, 400).alias("text"))
    documents = documents.unionByName(documents.where("doc_id < 30").withColumn("doc_id", F.col("doc_id") + 5000)).coalesce(1)
    monkeypatch.setattr(search, "SHARD", 100)
    wanted = sorted(map(tuple, search.search(documents, F.col("doc_id") % 7 == 0, 5).collect()))
    for name, value in {"ELEMENTS": elements, "TOGETHER": together, "BLOCK": 8}.items():
        monkeypatch.setattr(search, name, value)
    assert sorted(map(tuple, search.search(documents, F.col("doc_id") % 7 == 0, 5).collect())) == wanted


def test_search_of_long_texts(spark):
    """Counts beyond 2,048 and 65,504, in whole texts."""
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choice(["river", "stone", "cloud", "grass", "field"]) for _ in range(draw.randint(5, 60)))) for i in range(30)]
    rows += [(100, "river " * 3001 + "stone"), (101, "river " * 70_000 + "cloud"), (102, "river stone " * 2049), (103, "river " * 200_000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = brute_search(rows, lambda i: i % 5 == 0 or i > 99, 10)
    found = {}
    for r in search.search(documents, (F.col("doc_id") % 5 == 0) | (F.col("doc_id") > 99), 10).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(wanted)
    for q, best in found.items():
        assert np.allclose([r.score for r in best], [s for _, s in wanted[q]], rtol=1e-12, atol=1e-8)
        assert [r.doc_id for r in best] == [i for i, _ in wanted[q]] or len({s for _, s in wanted[q]}) < len(best)


def test_search_of_odd_rows(odd, empty):
    found = search.search(odd, F.lit(True), 3).collect()
    assert {(r.query_id, r.doc_id) for r in found} >= {(1, 5), (6, 7), (7, 6)}
    assert not {r.query_id for r in found} & {2, 3, 4, None} and all(r.query_id != r.doc_id for r in found)
    assert search.search(empty, F.lit(True), 3).count() == 0


def test_words_are_runs_of_letters_and_digits():
    texts = ["Ab a_b ÄÖ-x2 ½ ǅ ΑΣ ΑΣ. İi", None, "", "日本 語\x1c٣٤ e\u0301 \U0001d54f \u2028z", "x" * 64 + " " + "x" * 65 + " " + "y" * 300, "a ab\nÄÖ X2"]
    hashes, holder = search._words(texts)
    words = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\W_]+", (t or "").lower())]
    assert holder.tolist() == [i for i, _ in words]
    number = dict(zip([w for _, w in words], hashes.tolist(), strict=True))
    assert [number[w] for _, w in words] == hashes.tolist() and len(set(hashes.tolist())) == len(number)


def mixed_texts(n):
    """Texts of 1 to 200 words of two vocabularies with few words in common, frequent and rare ones."""
    draw = random.Random(4)
    texts = []
    for i in range(n):
        own = [f"{'ab'[i % 2]}{int(draw.paretovariate(0.6)) % 3000}" for _ in range(draw.choice([1, 8, 40, 200]))]
        texts.append((draw.choice([i, i, i, i // 2]), " ".join([*own, "both", "both" if i % 3 else "other"])))
    return texts


def test_clusters_are_of_like_words_and_begin_with_the_longest(spark):
    texts = mixed_texts(400)
    (row,) = search.index_shards(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string").coalesce(1)).collect()
    ids, lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
    assert sorted(ids.tolist()) == list(range(400)) and [len(texts[i][1].split()) for i in ids] == lengths.tolist()
    begin, mixed = 0, 0
    for width in np.frombuffer(row["clusters"], np.int64).tolist():
        own = slice(begin, begin + width)
        assert (np.diff(lengths[own]) <= 0).all()
        long = ids[own][lengths[own] > 20] % 2
        mixed += min((long == 0).sum(), (long == 1).sum())
        begin += width
    assert begin == 400 and mixed <= 8


def test_full_shards_end_early(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_WORDS", 1000)
    rows = search.index_shards(spark.createDataFrame([(i, "one two three " * 100) for i in range(20)], "doc_id long, text string").coalesce(1)).collect()
    assert sorted(i for r in rows for i in np.frombuffer(r["ids"], np.int64).tolist()) == list(range(20))


@pytest.mark.parametrize(("elements", "together", "postings", "again"), [(0, 7, 10, 3), (300, 64, 1000, 16), (10**9, 1000, 10**6, 1)])
def test_shards_in_turn_equal_brute_force(spark, monkeypatch, elements, together, postings, again):
    for name, value in {"ELEMENTS": elements, "TOGETHER": together, "POSTINGS": postings, "AGAIN": again}.items():
        monkeypatch.setattr(search, name, value)
    texts = mixed_texts(300)
    counts = [(i, Counter(search._words([t])[0].tolist())) for i, t in texts]
    df = Counter(w for _, c in counts for w in c)
    mean = sum(sum(c.values()) for _, c in counts) / len(counts)
    asked = {}
    for n, (i, c) in enumerate(counts):
        if n % 3 == 0 and i not in asked:
            terms = np.array(sorted(c), np.int64)
            asked[i] = terms, np.array([c[t] * np.log(1 + (len(counts) - df[t] + 0.5) / (df[t] + 0.5)) for t in terms.tolist()])
    queries = search.Queries(list(asked), [t for t, _ in asked.values()], [f for _, f in asked.values()], 7)
    shards = search.index_shards(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()
    for row in shards:
        search.Shard(row.asDict(), mean, queries).search(queries)
    found = {}
    for q, d, score in zip(*(c.to_pylist() for c in queries.results().columns), strict=True):
        found.setdefault(q, []).append((-score, d))
    for q, (terms, factors) in asked.items():
        scored = []
        for i, c in counts:
            length = search.K1 * (1 - search.B + search.B * sum(c.values()) / mean)
            score = sum(f * c[t] * (search.K1 + 1) / (c[t] + length) for t, f in zip(terms.tolist(), factors.tolist(), strict=True) if t in c)
            if i != q and score > 0:
                scored.append((-round(score, 9), i))
        assert [(round(s, 9), d) for s, d in found.get(q, [])] == sorted(scored)[:7]


def test_terms_of_one_document_are_not_asked_for(spark, monkeypatch):
    """They find nothing but the query itself, and are most of a large corpus's terms."""
    staged = {}
    monkeypatch.setattr(search, "stage", lambda df, label: staged.setdefault(label, search_stage(df, label)))
    texts = [(i, f"common word{i % 4} own{i}") for i in range(40)]
    found = search.search(spark.createDataFrame(texts, "doc_id long, text string"), F.col("doc_id") < 8, 3).collect()
    assert len(found) == 24 and {len(r.term) for r in staged["search-queries"].collect()} == {2}
