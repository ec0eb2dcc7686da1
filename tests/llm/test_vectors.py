"""Vector codes and centroid clusters against SQL and brute force."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from conftest import SMALL

from millrace.llm import centroids, codes
from millrace.llm.catalog import ENTRIES
from millrace.llm.centroids import VantageTree

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, code string, whole string, error long"


def rows_of(spark, vectors, labels=None):
    """Rows with extra columns whose names the operators use."""
    labels = labels or [None] * len(vectors)
    rows = [(i, v, label, 7, "x", "y", 1) for (i, v), label in zip(vectors, labels, strict=True)]
    return spark.createDataFrame(rows, VECTORS).repartition(3)


def floats(values):
    return [float(np.float32(x)) for x in values]


def drawn(n, dimensions, seed, spread=1.0):
    random = np.random.default_rng(seed)
    return [(i, floats(random.normal(0, spread, dimensions))) for i in range(n)]


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_centroid_clusters"])
def test_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    found = ENTRIES[name].run(spark, SMALL)
    wanted = connection.execute(ENTRIES[name].sql)
    assert [c[0] for c in wanted.description] == found.columns
    assert sorted(map(tuple, found.collect())) == sorted(wanted.fetchall()) != []


def brute_codes(vectors, labels, parts, entries, scale, rounds):
    """Codes of vectors of one length by plain loops, keyed by place in ``vectors``."""
    whole = [[math.floor(scale * x) for x in v] for _, v in vectors]
    width = len(whole[0]) // parts
    first = sorted((i, w) for (i, _), w in zip(vectors, whole, strict=True) if i is not None)[:entries]
    books = [[w[p * width : (p + 1) * width] for _, w in first] for p in range(parts)]
    near = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))
    for turn in range(rounds + 1):
        best = [[near(w[p * width : (p + 1) * width], books[p]) for p in range(parts)] for w in whole]
        if turn == rounds:
            break
        for p in range(parts):
            for k in range(len(books[p])):
                own = [w[p * width : (p + 1) * width] for w, b in zip(whole, best, strict=True) if b[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    errors = [sum(d for d, _ in b) for b in best]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    sums = {label: sum(e for e, own in zip(errors, labels, strict=True) if own == label) for label in set(labels)}
    return [(i, "".join(f"{k:02x}" for _, k in b), e, sums[label], digest, label) for (i, _), b, e, label in zip(vectors, best, errors, labels, strict=True)]


@pytest.mark.parametrize("spread", [0.01, 1.0, 30.0])
def test_codes_equal_brute_force(spark, spread):
    """Narrow vectors are full of ties; repeated rows, a null id and null labels among them."""
    vectors = drawn(150, 8, 3, spread)
    vectors += [vectors[5], vectors[5], (vectors[9][0], vectors[10][1]), (None, vectors[0][1])]
    labels = [None if k % 3 == 0 else k % 4 for k in range(len(vectors))]
    found = codes.compress(rows_of(spark, vectors, labels), parts=4, entries=20, scale=256, rounds=4)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_codes(vectors, labels, 4, 20, 256, 4), key=str)


def test_bounds_settle_parts():
    """Most parts of clustered vectors need no second entry, and lists shrink."""
    random = np.random.default_rng(1)
    centres = random.normal(0, 400, (32, 4))
    parts = np.floor(centres[random.integers(0, 32, 2000)] + random.normal(0, 3, (2000, 4)))
    book = np.floor(centres)
    before, _ = codes.begin(parts, book)
    moved = book + random.integers(-2, 3, book.shape)
    after, distances, needed = codes.advance(parts, codes._shortened(before, 4), moved, np.sqrt(((moved - book) ** 2).sum(1)))
    exact = ((parts[:, None] - moved) ** 2).sum(2)
    assert (distances == exact.min(1)).all() and (after.near[:, 0] == exact.argmin(1)).all()
    assert (needed == 1).mean() > 0.9
    assert (after.low <= np.sqrt(np.take_along_axis(exact, after.near[:, 1:], 1)) + 1e-9).all()


def test_codes_of_odd_vectors(spark):
    good = drawn(40, 8, 5)
    longer = [(100 + i, v) for i, v in drawn(30, 16, 6)]
    odd = [(200, None), (201, [1.0] * 7 + [None]), (202, [1.0] * 7 + [math.nan]), (203, [math.inf] * 8)]
    uncoded = [(204, [1.0] * 9), (205, []), (206, [3e38] * 8)]
    found = {r.vec_id: r for r in codes.compress(rows_of(spark, good + longer + odd + uncoded, [1] * 77), parts=4, entries=8, rounds=2).collect()}
    assert set(found) == {i for i, _ in good + longer + uncoded}
    assert all(found[i].code is None and found[i].error is None and found[i].codebooks_sha256 is None for i, _ in uncoded)
    for vectors in (good, longer):
        wanted = brute_codes(vectors, [1] * len(vectors), 4, 8, 256, 2)
        assert [(i, found[i].code, found[i].error, found[i].codebooks_sha256) for i, _ in vectors] == [(r[0], r[1], r[2], r[4]) for r in wanted]
    assert {r.label_error for r in found.values()} == {sum(r.error for r in found.values() if r.error is not None)}
    assert codes.compress(rows_of(spark, uncoded), parts=4).count() == 3


def test_codes_beyond_a_byte(spark):
    vectors = drawn(400, 4, 8)
    found = codes.compress(rows_of(spark, vectors), parts=2, entries=300, rounds=1)
    wanted = brute_codes(vectors, [None] * 400, 2, 300, 256, 1)
    hexes = {r.vec_id: r.code for r in found.collect()}
    assert all(len(c) == 8 for c in hexes.values())
    assert {r[0]: r[2] for r in wanted} == {r.vec_id: r.error for r in found.collect()}


def brute_clusters(vectors, dimensions, scale, clusters, rounds):
    whole = [[math.floor(scale * x) for x in v] for _, v in vectors]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), w) for (i, _), w in zip(vectors, whole, strict=True) if i is not None)
    points = [w for _, w in named[:clusters]]
    for turn in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(w, c, strict=True)), k) for k, c in enumerate(points)) for w in whole]
        if turn < rounds:
            for k in range(len(points)):
                own = [w for w, (_, c) in zip(whole, best, strict=True) if c == k]
                points[k] = [sum(x) // len(own) for x in zip(*own, strict=True)] if own else points[k]
    sums = {k: sum(d for d, c in best if c == k) for k in range(len(points))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in points]
    return [(i, k, d, sums[k], sum(sums.values()), digests[k]) for (i, _), (d, k) in zip(vectors, best, strict=True)]


@pytest.mark.parametrize("spread", [0.02, 1.0])
@pytest.mark.parametrize("clusters", [1, 5, 60])
def test_clusters_equal_brute_force(spark, spread, clusters):
    vectors = drawn(120, 6, 4, spread)
    vectors += [vectors[3], vectors[3], (vectors[7][0], vectors[8][1]), (None, vectors[1][1])]
    found = centroids.cluster(rows_of(spark, vectors), 6, 64, clusters, 3)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_clusters(vectors, 6, 64, clusters, 3), key=str)


@pytest.mark.parametrize("n", [1, 4, 5, 200])
def test_tree_finds_the_nearest(n):
    random = np.random.default_rng(n)
    points, vectors = random.integers(-4, 5, (n, 3)), random.integers(-5, 6, (3000, 3)).astype(float)
    numbers, distances = VantageTree(points).nearest(vectors)
    exact = ((vectors[:, None] - points) ** 2).sum(2)
    assert (numbers == exact.argmin(1)).all() and (distances == exact.min(1)).all()


def test_clusters_of_odd_vectors(spark):
    odd = [(200, None), (201, [1.0] * 7 + [None]), (202, [1.0] * 7 + [math.nan]), (203, [math.inf] * 8), (204, [1.0] * 9), (205, [])]
    good = drawn(20, 8, 2)
    found = centroids.cluster(rows_of(spark, good + odd + [(206, [3e38] * 8)]), 8, 64, 4, 3)
    rows = sorted(map(tuple, found.collect()))
    wanted = sorted(brute_clusters(good, 8, 64, 4, 3))
    assert rows[:-1] == wanted and rows[-1] == (206, None, None, None, wanted[0][4], None)
    only = centroids.cluster(rows_of(spark, [(None, [1.0] * 8)]), 8, 64).collect()
    assert [tuple(r) for r in only] == [(None, None, None, None, None, None)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert codes.compress(none).collect() == [] and centroids.cluster(none).collect() == []
