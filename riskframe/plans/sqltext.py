"""Small helpers to write the DuckDB twin queries as plain SQL text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def r6(expr: str, digits: int = 6) -> str:
    """Round to ``digits`` decimals as a DOUBLE; ``+ 0.0`` folds -0.0 to 0.0."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def sig(expr: str, digits: int = 10) -> str:
    """Twin of ``expressions.sig``: round to significant digits."""
    p = f"pow(10.0, floor(log10(abs(CAST({expr} AS DOUBLE)))))"
    return (f"(CASE WHEN CAST({expr} AS DOUBLE) = 0 THEN 0.0 ELSE "
            f"round(CAST({expr} AS DOUBLE) / {p}, {digits - 1}) * {p} END + 0.0)")


def case_map(column: str, mapping: Mapping[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CAST(CASE CAST({column} AS VARCHAR) {whens} END AS INTEGER)"


def tier_case(p: str, tiers: Sequence[tuple[float, float, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {p} >= {lo} AND {p} < {hi} THEN '{name}'" for lo, hi, name in tiers)
    return f"CASE {whens} ELSE '{otherwise}' END"


def tier_histogram(source: str, p: str, tiers, undetermined: str, slots: int = 30) -> str:
    """Twin of ``report.tier_histogram`` over ``source`` with column ``p``."""
    counts = ", ".join(
        f"count(*) FILTER (WHERE {p} >= {lo} AND {p} < {hi}) AS t{i}"
        for i, (lo, hi, _) in enumerate(tiers))
    unions = " UNION ALL ".join(
        f"SELECT {i} AS tier_order, '{name}' AS risk_tier, t{i} AS n, total FROM c"
        for i, (_, _, name) in enumerate(tiers))
    matched = " OR ".join(f"({p} >= {lo} AND {p} < {hi})" for lo, hi, _ in tiers)
    und = f"count(*) FILTER (WHERE NOT coalesce({matched}, false)) AS und"
    return (
        f"WITH c AS (SELECT count(*) AS total, {counts}, {und} FROM {source}), "
        f"u AS ({unions} UNION ALL SELECT {len(tiers)}, '{undetermined}', und, total FROM c) "
        "SELECT CAST(tier_order AS INTEGER) AS tier_order, risk_tier, CAST(n AS BIGINT) AS n, "
        f"CAST(floor(n / greatest(1, floor(total / {slots}))) AS BIGINT) AS bar FROM u")


def _det(m: Sequence[Sequence[str]]) -> str:
    """Determinant of a small symbolic matrix as SQL: the sum over
    permutations of signed products of entries (k! terms; for k <= 5)."""
    from itertools import permutations
    k = len(m)
    terms = []
    for perm in permutations(range(k)):
        inversions = sum(1 for a in range(k) for b in range(a + 1, k) if perm[a] > perm[b])
        prod = " * ".join(m[i][perm[i]] for i in range(k))
        terms.append(("- " if inversions % 2 else "+ ") + f"({prod})")
    return "(0.0 " + " ".join(terms) + ")"


def vif(table: str, columns: Sequence[str]) -> str:
    """Twin of ``profile.vif``: VIF_j = (R^-1)_jj = det(R without row and
    column j) / det(R), R the Pearson matrix over complete rows."""
    k = len(columns)
    name = lambda i, j: "1.0" if i == j else f"r_{min(i, j)}_{max(i, j)}"
    corrs = ", ".join(f"corr({columns[i]}, {columns[j]}) AS r_{i}_{j}"
                      for i in range(k) for j in range(i + 1, k))
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    full = [[name(i, j) for j in range(k)] for i in range(k)]
    rows = []
    for j, c in enumerate(columns):
        keep = [i for i in range(k) if i != j]
        minor = _det([[name(a, b) for b in keep] for a in keep])
        rows.append(f"SELECT '{c}' AS feature, CASE WHEN d = 0 THEN NULL ELSE "
                    f"{r6(minor + ' / d')} END AS vif, d = 0 AS singular FROM m")
    return (f"WITH c AS (SELECT {corrs} FROM {table} WHERE {complete}), "
            f"m AS (SELECT *, {_det(full)} AS d FROM c) " + " UNION ALL ".join(rows))


def lasso(source: str, features: Sequence[str], label: str, alpha: float, sweeps: int = 400) -> str:
    """CTEs (for WITH RECURSIVE) up to ``lasso_b(it, b0, ...)``: coordinate
    descent over complete rows, a row a sweep, on correlations ``lasso_g``."""
    k = range(len(features))
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*features, label])
    r = lambda i, j: f"r_{min(i, j)}_{max(i, j)}"
    sums = ", ".join([f"corr({features[i]}, {features[j]}) AS {r(i, j)}" for i in k for j in k if i < j]
                     + [f"covar_pop({features[i]}, {label}) / stddev_pop({features[i]}) AS c{i}" for i in k])
    step = "SELECT * FROM lasso_b, lasso_g WHERE it < " + str(sweeps)
    for i in k:
        rho = f"c{i}" + "".join(f" - {r(i, j)} * {'n' if j < i else 'b'}{j}" for j in k if j != i)
        step = f"SELECT *, sign({rho}) * greatest(abs({rho}) - {alpha}, 0.0) AS n{i} FROM ({step})"
    zeros = ", ".join("CAST(0 AS DOUBLE)" for _ in k)
    return (f"lasso_g AS (SELECT {sums} FROM {source} WHERE {complete}), "
            f"lasso_b(it, {', '.join(f'b{i}' for i in k)}) AS (SELECT 0, {zeros} UNION ALL "
            f"SELECT it + 1, {', '.join(f'n{i}' for i in k)} FROM ({step}))")


def lasso_rows(features: Sequence[str], sweeps: int = 400) -> str:
    """(feature, coefficient) of the last sweep of ``lasso``."""
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, b{i} AS coefficient FROM lasso_b WHERE it = {sweeps}"
                              for i, c in enumerate(features))


def lasso_pair(source: str, x: str, z: str, label: str, alpha: float) -> str:
    """The lasso of two features in closed form: CTEs up to ``pair(b0, b1)``.
    Both signs are tried; a sign that fits its own solution is the answer,
    else one coefficient is 0."""
    both = []
    for s in (1, -1):
        for t in (1, -1):
            b0, b1 = f"((c0 - {s} * a) - r * (c1 - {t} * a)) / (1 - r * r)", f"((c1 - {t} * a) - r * (c0 - {s} * a)) / (1 - r * r)"
            both.append(f"SELECT {b0} AS b0, {b1} AS b1 FROM g WHERE sign({b0}) = {s} AND sign({b1}) = {t}")
    soft = lambda c: f"sign({c}) * greatest(abs({c}) - a, 0)"
    return (f"g AS (SELECT {alpha} AS a, corr({x}, {z}) AS r, covar_pop({x}, {label}) / stddev_pop({x}) AS c0, "
            f"covar_pop({z}, {label}) / stddev_pop({z}) AS c1 FROM {source}), "
            f"two AS ({' UNION ALL '.join(both)}), "
            f"one AS (SELECT {soft('c0')} AS b0, 0.0 AS b1 FROM g WHERE abs(c1 - r * ({soft('c0')})) <= a "
            f"UNION SELECT 0.0, {soft('c1')} FROM g WHERE abs(c0 - r * ({soft('c1')})) <= a), "
            "pair AS (SELECT * FROM two UNION ALL SELECT * FROM one WHERE NOT EXISTS (SELECT * FROM two))")


def newton(source: str, penalty: float = 1.0, steps: int = 15) -> str:
    """CTEs up to ``newton(b0, b1, b2)``: ``steps`` Newton steps of the
    logistic regression of y on x1, x2 with weights w, each step's 3 x 3
    system solved by Cramer's rule."""
    x = ("1.0", "x1", "x2")
    name = lambda i, j: f"h{min(i, j)}{max(i, j)}"
    ctes = ["b_0 AS (SELECT CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2)"]
    for s in range(steps):
        ridge = lambda i, j: f" + {penalty}" if i == j and i else ""
        sums = ", ".join(
            [f"sum(w * p * (1 - p) * {x[i]} * {x[j]}){ridge(i, j)} AS {name(i, j)}" for i in range(3) for j in range(i, 3)]
            + [f"sum(w * (y - p) * {x[i]})" + (f" - {penalty} * any_value(b{i})" if i else "") + f" AS g{i}" for i in range(3)])
        matrix = [[name(i, j) for j in range(3)] for i in range(3)]
        moved = []
        for k in range(3):
            m = [[f"g{i}" if j == k else matrix[i][j] for j in range(3)] for i in range(3)]
            moved.append(f"b{k} + {_det(m)} / {_det(matrix)} AS b{k}")
        ctes.append(f"b_{s + 1} AS MATERIALIZED (SELECT {', '.join(moved)} FROM (SELECT {sums}, any_value(b0) AS b0, "
                    f"any_value(b1) AS b1, any_value(b2) AS b2 FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p "
                    f"FROM {source}, b_{s})))")
    return ", ".join([*ctes, f"newton AS (SELECT * FROM b_{steps})"])
