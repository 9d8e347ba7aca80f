"""Generalized linear models with a log link as DuckDB SQL.

Newton's method in plain SQL, to check fitted models independently: every step sums
the information matrix and the score over all rows and solves the linear system by
elimination, a recursive query over a matrix held as a list of rows.
"""

from __future__ import annotations

STEPS = 10


def _system(size: int, weight: str, right: list[str]) -> str:
    """The information matrix with further columns on the right, as a list of rows."""
    rows = []
    for i in range(1, size + 1):
        left = [f"sum(({weight}) * x[{i}] * x[{j}])" for j in range(1, size + 1)]
        rows.append("[" + ", ".join([*left, *(r.replace("{i}", str(i)) for r in right)]) + "]")
    return "[" + ", ".join(rows) + "]"


def _solved(name: str, source: str, size: int) -> str:
    """Elimination of one column after the other; the last row holds the reduced matrix."""
    return f"""{name}(k, m) AS (
    SELECT 1, m FROM {source}
    UNION ALL
    SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
        ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)
    FROM {name} WHERE k <= {size}
)"""


def coefficient_table(rows: str, terms: list[str], gamma: bool, settle) -> str:
    """CTEs and the final SELECT. `rows` has a list x (the intercept last), a target y and a volume e per policy."""
    size = len(terms)
    weight = "1.0" if gamma else "mu"
    score = "sum(x[{i}] * (y - mu) / mu)" if gamma else "sum(x[{i}] * (y - mu))"
    start = ", ".join(["0.0"] * (size - 1) + ["ln(sum(y) / sum(e))"])
    parts = [f"design AS MATERIALIZED ({rows})", f"beta0 AS MATERIALIZED (SELECT [{start}] AS b FROM design)"]
    fitted = "SELECT x, y, e * exp(list_inner_product(x, b)) AS mu FROM design, beta{0}"
    for step in range(STEPS):
        parts += [
            f"system{step} AS MATERIALIZED (SELECT {_system(size, weight, [score])} AS m FROM ({fitted.format(step)}))",
            _solved(f"solved{step}", f"system{step}", size),
            f"beta{step + 1} AS MATERIALIZED (SELECT list_transform(b, lambda v, i: v + m[i][{size + 1}]) AS b "
            f"FROM beta{step}, solved{step} WHERE k = {size + 1})",
        ]
    unit = [f"CASE WHEN {{i}} = {j} THEN 1.0 ELSE 0.0 END" for j in range(1, size + 1)]
    spread = f"sum(((y - mu) / mu) * ((y - mu) / mu)) / (count(*) - {size})" if gamma else "1.0"
    parts += [
        f"last AS MATERIALIZED (SELECT {_system(size, weight, unit)} AS m, {spread} AS phi FROM ({fitted.format(STEPS)}))",
        _solved("inverse", "last", size),
        f"""terms AS (
    SELECT unnest({terms!r}) AS Term, unnest(b) AS beta,
           unnest(list_transform(range(1, {size + 1}), lambda i: sqrt(phi * i_m[i][{size} + i]))) AS error
    FROM beta{STEPS}, (SELECT m AS i_m FROM inverse WHERE k = {size + 1}), (SELECT phi FROM last)
)""",
        # 1 - erf(t) for t = |z| / sqrt(2), by a series of positive terms; beyond 6 it is below 1e-16.
        """tested AS (
    SELECT *, beta / error AS z, abs(beta / error) / sqrt(2) AS t FROM terms
)""",
    ]
    series = (
        "list_sum(list_transform(range(0, 200), lambda n: exp((2 * n + 1) * ln(t) + (2 * n + 1) * ln(2)"
        " + lgamma(n + 1) - lgamma(2 * n + 2) - t * t)))"
    )
    p = f"CASE WHEN t >= 6 THEN 0.0 WHEN t = 0 THEN 1.0 ELSE 1 - 2 / sqrt(pi()) * {series} / 2 END"
    digits = {"beta": 6, "error": 6, "z": 3, p: 6, "beta - 1.959963984540054 * error": 5, "beta + 1.959963984540054 * error": 5}
    names = ["Coefficient", "Std_Error", "Z_Value", "P_Value", "Lower_95", "Upper_95"]
    columns = ", ".join(f"{settle(value, d)} AS {name}" for (value, d), name in zip(digits.items(), names))
    return ", ".join(parts) + f" SELECT Term, {columns} FROM tested"
