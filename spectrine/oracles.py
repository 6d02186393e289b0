"""DuckDB SQL building blocks of the oracles.

They take other roads than the engine: windows and joins for row statistics, a
coefficient table for filters, unrolled NIPALS deflation for PLS, a recursive CTE
for the maximin split. Every fragment is a list of CTEs; :func:`query` joins them.
"""

from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

SPECTRA = (
    "e AS MATERIALIZED (SELECT vec_id AS i, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x, CAST(label AS DOUBLE) AS y FROM embeddings)",
    "l AS MATERIALIZED (SELECT i, u.j AS j, x[u.j] AS v FROM e, unnest(range(1, 65)) AS u(j))",
)


def query(ctes: list[str] | tuple[str, ...], body: str, *, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + body


def r6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def snv(source: str, name: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT i, j, CASE WHEN s > 1e-12 THEN (v - m) / s ELSE 0.0 END AS v FROM "
        f"(SELECT i, j, v, avg(v) OVER (PARTITION BY i) AS m, stddev_pop(v) OVER (PARTITION BY i) AS s FROM {source}))"
    )


def _gram(k: int, s: int, t: int, m: int) -> Fraction:
    """The s-th derivative at t of the Gram polynomial of degree k over -m..m, by its recurrence."""
    if k < 0 or s < 0 or (k == 0 and s > 0):
        return Fraction(0)
    if k == 0:
        return Fraction(1)
    up = Fraction(4 * k - 2, k * (2 * m - k + 1)) * (t * _gram(k - 1, s, t, m) + s * _gram(k - 1, s - 1, t, m))
    return up - Fraction((k - 1) * (2 * m + k), k * (2 * m - k + 1)) * _gram(k - 2, s, t, m)


def _gram_weights(m: int, order: int, deriv: int, t: int) -> list[Fraction]:
    """Exact weights of samples -m..m for the derivative at t of their least-squares polynomial."""
    norm = [Fraction((2 * k + 1) * math.perm(2 * m, k), math.perm(2 * m + k + 1, k + 1)) for k in range(order + 1)]
    at = [_gram(k, deriv, t, m) for k in range(order + 1)]
    return [sum(norm[k] * _gram(k, 0, i, m) * at[k] for k in range(order + 1)) for i in range(-m, m + 1)]


def _padded(width: int, m: int, mode: str) -> list[int | None]:
    """The columns that stand at -m..width + m - 1; None is the constant. For rows of more than m values."""
    row = list(range(width))
    before, after = {
        "mirror": (row[m:0:-1], row[-2 : -m - 2 : -1]),
        "nearest": (row[:1] * m, row[-1:] * m),
        "wrap": (row[-m:], row[:m]),
    }.get(mode, ([None] * m, [None] * m))
    return before + row + after


def savgol(source: str, name: str, width: int, window: int, order: int, deriv: int = 0, mode: str = "interp", cval: float = 0.0) -> str:
    m = window // 2
    at, centre = _padded(width, m, mode), _gram_weights(m, order, deriv, 0)
    table, shift = Counter(), Counter()
    for r in range(width):
        edge = min(max(r, m), width - 1 - m) if mode == "interp" else r
        columns = at[edge : edge + window]
        for c, w in zip(columns, centre if edge == r else _gram_weights(m, order, deriv, r - edge), strict=True):
            if c is None:
                shift[r] += w * Fraction(cval)
            else:
                table[r, c] += w
    cells = ", ".join(f"({r + 1}, {c + 1}, {float(w)!r}::DOUBLE)" for (r, c), w in sorted(table.items()) if w)
    shifts = ", ".join(f"({r + 1}, {float(shift[r])!r}::DOUBLE)" for r in range(width))
    return (
        f"{name} AS MATERIALIZED (SELECT s.i, CAST(o.r AS BIGINT) AS j, sum(o.w * s.v) + any_value(c.c) AS v FROM {source} s "
        f"JOIN (VALUES {cells}) AS o(r, k, w) ON o.k = s.j JOIN (VALUES {shifts}) AS c(r, c) ON c.r = o.r GROUP BY s.i, o.r)"
    )


def kennard_stone(test_size: float) -> list[str]:
    """CTE ``part(i, partition, ord)`` from ``l``."""
    return [
        "dist AS MATERIALIZED (SELECT a.i AS a, b.i AS b, sum((a.v - b.v) * (a.v - b.v)) AS d FROM l a JOIN l b ON a.j = b.j GROUP BY a.i, b.i)",
        "seed AS MATERIALIZED (SELECT least(a, b) AS p, greatest(a, b) AS q FROM dist WHERE a < b ORDER BY d DESC, a, b LIMIT 1)",
        f"size AS MATERIALIZED (SELECT count(*) - greatest(1, CAST(ceil(count(*) * {test_size} - 1e-12) AS BIGINT)) AS n FROM e)",
        """walk(step, i, m, ord) AS (
  SELECT 2, e.i, least(dp.d, dq.d), CASE WHEN e.i = s.p THEN 0 WHEN e.i = s.q THEN 1 END
  FROM e CROSS JOIN seed s JOIN dist dp ON dp.a = s.p AND dp.b = e.i JOIN dist dq ON dq.a = s.q AND dq.b = e.i
  UNION ALL
  SELECT w.step + 1, w.i, least(w.m, d.d), CASE WHEN w.ord IS NULL AND w.i = w.next THEN w.step ELSE w.ord END
  FROM (SELECT *, first_value(i) OVER (ORDER BY (ord IS NOT NULL), m DESC, i) AS next FROM walk) w
  JOIN dist d ON d.a = w.next AND d.b = w.i WHERE w.step < (SELECT n FROM size)
)""",
        """part AS MATERIALIZED (
  SELECT i, CASE WHEN ord IS NULL THEN 'test' ELSE 'train' END AS partition,
         CAST(coalesce(ord, row_number() OVER (PARTITION BY ord IS NULL ORDER BY i) - 1) AS INTEGER) AS ord
  FROM walk WHERE step = (SELECT n FROM size)
)""",
    ]


def grouped_kennard_stone(test_size: float) -> list[str]:
    """CTE ``part(g, i, partition, ord)`` from ``l`` and ``e``: a split of each label's rows, of two train rows or more."""
    return [
        "g AS MATERIALIZED (SELECT i, CAST(y AS INTEGER) AS g FROM e)",
        "pair AS MATERIALIZED (SELECT a.g, a.i AS a, b.i AS b FROM g a JOIN g b ON a.g = b.g)",
        "dist AS MATERIALIZED (SELECT p.g, p.a, p.b, sum((x.v - y.v) * (x.v - y.v)) AS d FROM pair p JOIN l x ON x.i = p.a JOIN l y ON y.i = p.b AND y.j = x.j GROUP BY p.g, p.a, p.b)",
        "seed AS MATERIALIZED (SELECT g, a AS p, b AS q FROM dist WHERE a < b QUALIFY row_number() OVER (PARTITION BY g ORDER BY d DESC, a, b) = 1)",
        f"size AS MATERIALIZED (SELECT g, count(*) - greatest(1, CAST(ceil(count(*) * {test_size} - 1e-12) AS BIGINT)) AS n FROM g GROUP BY g)",
        """walk(step, g, i, m, ord) AS (
  SELECT 2, g.g, g.i, least(dp.d, dq.d), CASE WHEN g.i = s.p THEN 0 WHEN g.i = s.q THEN 1 END
  FROM g JOIN seed s ON s.g = g.g JOIN dist dp ON dp.a = s.p AND dp.b = g.i JOIN dist dq ON dq.a = s.q AND dq.b = g.i
  UNION ALL
  SELECT w.step + 1, w.g, w.i, least(w.m, d.d), CASE WHEN w.ord IS NULL AND w.i = w.next THEN w.step ELSE w.ord END
  FROM (SELECT *, first_value(i) OVER (PARTITION BY g ORDER BY (ord IS NOT NULL), m DESC, i) AS next FROM walk) w
  JOIN size z ON z.g = w.g JOIN dist d ON d.a = w.next AND d.b = w.i WHERE w.step < z.n
)""",
        """part AS MATERIALIZED (
  SELECT w.g, w.i, CASE WHEN w.ord IS NULL THEN 'test' ELSE 'train' END AS partition,
         CAST(coalesce(w.ord, row_number() OVER (PARTITION BY w.g, w.ord IS NULL ORDER BY w.i) - 1) AS INTEGER) AS ord
  FROM walk w JOIN size z ON z.g = w.g WHERE w.step = z.n
)""",
    ]


def pls_weights(k: int) -> list[str]:
    """CTEs ``r<a>(j, v)`` after those of :func:`pls`: the weights by which the standardised columns give each score."""
    out = ["r1 AS MATERIALIZED (SELECT j, w AS v FROM w1)"]
    for a in range(2, k + 1):
        shares = " ".join(
            f"- (SELECT sum(p.p * x.w) FROM p{b} p JOIN w{a} x ON x.j = p.j) * (SELECT r.v FROM r{b} r WHERE r.j = w.j)" for b in range(1, a)
        )
        out.append(f"r{a} AS MATERIALIZED (SELECT w.j, w.w {shares} AS v FROM w{a} w)")
    cells = " UNION ALL ".join(f"SELECT r.j, r.v * q.q AS v FROM r{a} r CROSS JOIN q{a} q" for a in range(1, k + 1))
    out.append(f"slope AS MATERIALIZED (SELECT c.j, sum(c.v) * any_value(sy.s) / any_value(st.s) AS v FROM ({cells}) c JOIN st ON st.j = c.j CROSS JOIN sy GROUP BY c.j)")
    return out


def pls(source: str, k: int, *, split: bool = False) -> list[str]:
    """CTEs ``e<a>``/``f<a>`` of k NIPALS deflations and ``pred<a>(i, y, p)`` for the rows to predict."""
    train = "i IN (SELECT i FROM part WHERE partition = 'train')" if split else "TRUE"
    test = "WHERE i IN (SELECT i FROM part WHERE partition = 'test')" if split else ""
    out = [
        f"st AS MATERIALIZED (SELECT j, avg(v) AS m, CASE WHEN stddev_pop(v) > 1e-12 THEN stddev_pop(v) ELSE 1.0 END AS s FROM {source} WHERE {train} GROUP BY j)",
        f"sy AS MATERIALIZED (SELECT avg(y) AS m, CASE WHEN stddev_pop(y) > 1e-12 THEN stddev_pop(y) ELSE 1.0 END AS s FROM e WHERE {train})",
        f"e0 AS MATERIALIZED (SELECT x.i, x.j, (x.v - st.m) / st.s AS v FROM {source} x JOIN st ON st.j = x.j)",
        "f0 AS MATERIALIZED (SELECT i, (y - m) / s AS y FROM e CROSS JOIN sy)",
    ]
    for a in range(1, k + 1):
        b = a - 1
        out += [
            f"w{a} AS MATERIALIZED (SELECT j, w / sqrt(sum(w * w) OVER ()) AS w FROM (SELECT x.j, sum(x.v * f.y) AS w FROM e{b} x JOIN f{b} f ON f.i = x.i WHERE x.{train if split else 'i = x.i'} GROUP BY x.j))",
            f"t{a} AS MATERIALIZED (SELECT x.i, sum(x.v * w.w) AS t FROM e{b} x JOIN w{a} w ON w.j = x.j GROUP BY x.i)",
            f"p{a} AS MATERIALIZED (SELECT x.j, sum(x.v * t.t) / sum(t.t * t.t) AS p FROM e{b} x JOIN t{a} t ON t.i = x.i WHERE x.{train if split else 'i = x.i'} GROUP BY x.j)",
            f"q{a} AS MATERIALIZED (SELECT sum(f.y * t.t) / sum(t.t * t.t) AS q FROM f{b} f JOIN t{a} t ON t.i = f.i WHERE f.{train if split else 'i = f.i'})",
            f"e{a} AS MATERIALIZED (SELECT x.i, x.j, x.v - t.t * p.p AS v FROM e{b} x JOIN t{a} t ON t.i = x.i JOIN p{a} p ON p.j = x.j)",
            f"f{a} AS MATERIALIZED (SELECT f.i, f.y - q.q * t.t AS y FROM f{b} f JOIN t{a} t ON t.i = f.i CROSS JOIN q{a} q)",
            f"pred{a} AS MATERIALIZED (SELECT e.i, e.y, e.y - f.y * sy.s AS p FROM e JOIN f{a} f ON f.i = e.i CROSS JOIN sy {test.replace('i IN', 'e.i IN')})",
        ]
    return out
