"""SQL for the operators on integer vectors, with the parameters of their queries."""

from __future__ import annotations


def _kept(scale: int, more: str = "", where: str = "") -> str:
    finite = "len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)"
    whole = f"[floor({scale} * CAST(x AS DOUBLE)) for x in embedding]"
    return f"SELECT vec_id, {more}{whole} AS v FROM embeddings WHERE embedding IS NOT NULL AND {finite}{where}"


def _distance(a: str, b: str) -> str:
    """Squared distance of lists of whole doubles, exact."""
    return f"CAST(list_inner_product({a}, {a}) - 2 * list_inner_product({a}, {b}) + list_inner_product({b}, {b}) AS BIGINT)"


def _floored_mean(x: str) -> str:
    total = f"sum(CAST({x} AS HUGEINT))"
    return f"CAST(({total} - ((({total} % count(*)) + count(*)) % count(*))) // count(*) AS DOUBLE)"


def clusters_sql(dimensions: int = 64, scale: int = 64, clusters: int = 16, rounds: int = 3) -> str:
    steps = [
        f"kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS r, * FROM ({_kept(scale, where=f' AND len(embedding) = {dimensions}')}))",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept ORDER BY sha256('1:' || vec_id), v LIMIT {clusters})",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT k.r, min({{'d': {_distance('k.v', 'c.v')}, 'c': c.c}}) AS best FROM kept k, c{n} c GROUP BY k.r)")
        if n < rounds:
            means = f"""SELECT c, list(m ORDER BY i) AS v FROM (
                    SELECT a.best.c AS c, t.i, {_floored_mean('k.v[t.i]')} AS m
                    FROM a{n} a JOIN kept k USING (r), range(1, {dimensions + 1}) t(i) GROUP BY a.best.c, t.i) GROUP BY c"""
            steps.append(f"c{n + 1} AS MATERIALIZED (SELECT o.c, coalesce(s.v, o.v) AS v FROM c{n} o LEFT JOIN ({means}) s USING (c))")
    return f"""
        WITH {', '.join(steps)}
        SELECT k.vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance,
               CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) for x in c.v], ',')) AS centroid_sha256
        FROM a{rounds} a JOIN kept k USING (r) JOIN c{rounds} c ON c.c = a.best.c"""


def codes_sql(dimensions: int = 64, parts: int = 16, entries: int = 64, scale: int = 256, rounds: int = 2) -> str:
    width = dimensions // parts
    steps = [
        f"kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS r, * FROM ({_kept(scale, 'label, ')}))",
        f"parts AS MATERIALIZED (SELECT r, t.p, v[t.p * {width} + 1 : (t.p + 1) * {width}] AS v FROM kept, range({parts}) t(p))",
        f"b0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {entries})",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT x.r, x.p, min({{'d': {_distance('x.v', 'b.v')}, 'e': b.e}}) AS best FROM parts x JOIN b{n} b USING (p) GROUP BY x.r, x.p)")
        if n < rounds:
            means = f"""SELECT p, e, list(m ORDER BY i) AS v FROM (
                    SELECT a.p, a.best.e AS e, t.i, {_floored_mean('x.v[t.i]')} AS m
                    FROM a{n} a JOIN parts x USING (r, p), range(1, {width + 1}) t(i) GROUP BY a.p, a.best.e, t.i) GROUP BY p, e"""
            steps.append(f"b{n + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(s.v, o.v) AS v FROM b{n} o LEFT JOIN ({means}) s USING (p, e))")
    steps.append(f"coded AS MATERIALIZED (SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)")
    steps.append(f"digest AS (SELECT sha256(string_agg(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) for x in v], ','), ',' ORDER BY p, e)) AS sha FROM b{rounds})")
    return f"""
        WITH {', '.join(steps)}
        SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, digest.sha AS codebooks_sha256, k.label
        FROM coded c JOIN kept k USING (r), digest"""
