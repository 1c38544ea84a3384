"""Small SQL text helpers for the DuckDB oracles (oracle side only; Spark plans never go through here)."""

from __future__ import annotations

from collections.abc import Sequence


# The Murmur3 x86 32-bit constants (as in Spark's hash expression, seed 42).
M32 = 4294967295
MURMUR_C1, MURMUR_C2 = 0xCC9E2D51, 0x1B873593
MURMUR_H_ADD, MURMUR_F1, MURMUR_F2 = 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
SPARK_HASH_SEED = 42


class _Chain:
    """Builds a value step by step, one nested SELECT per step, so no step's text is ever repeated."""

    def __init__(self, source: str):
        self.sql, self.n, self.temps = f"SELECT * FROM {source}", 0, []

    def add(self, expr: str) -> str:
        name = f"_mh{self.n}"
        self.n += 1
        self.temps.append(name)
        self.sql = f"SELECT *, {expr} AS {name} FROM ({self.sql})"
        return name


def _mul(a: str, c: int) -> str:
    return f"CAST((CAST({a} AS HUGEINT) * {c}) & {M32} AS BIGINT)"


def _rotl(a: str, r: int) -> str:
    return f"((({a} << {r}) | ({a} >> {32 - r})) & {M32})"


def _mix_k1(ch: _Chain, v: str) -> str:
    a = ch.add(_mul(v, MURMUR_C1))
    b = ch.add(_rotl(a, 15))
    return ch.add(_mul(b, MURMUR_C2))


def _mix_h1(ch: _Chain, h: str, k: str) -> str:
    a = ch.add(f"xor({h}, {k})")
    b = ch.add(_rotl(a, 13))
    return ch.add(f"(({b} * 5 + {MURMUR_H_ADD}) & {M32})")


def _fmix(ch: _Chain, h: str, length: int) -> str:
    a = ch.add(f"xor({h}, {length})")
    b = ch.add(f"xor({a}, {a} >> 16)")
    c = ch.add(_mul(b, MURMUR_F1))
    d = ch.add(f"xor({c}, {c} >> 13)")
    e = ch.add(_mul(d, MURMUR_F2))
    return ch.add(f"xor({e}, {e} >> 16)")


def hashed_sql(source: str, keys: Sequence[tuple[str, str]], seed: int = 42, out: str = "_h") -> str:
    """Subquery over ``source`` adding ``out`` = Spark's ``hash(seed, key1, ...)`` (Murmur3, signed INTEGER),
    the DuckDB twin of ``tabml.functions.hash32``.  ``keys`` are (expression, 'int' | 'bigint') pairs."""
    ch = _Chain(source)
    h = str(SPARK_HASH_SEED)
    for expr, typ in [(str(int(seed)), "int")] + list(keys):
        v = f"CAST({expr} AS BIGINT)"
        if typ == "int":
            h = _fmix(ch, _mix_h1(ch, h, _mix_k1(ch, ch.add(f"({v} & {M32})"))), 4)
        elif typ == "bigint":
            lo = ch.add(f"({v} & {M32})")
            hi = ch.add(f"(({v} >> 32) & {M32})")
            h = _mix_h1(ch, h, _mix_k1(ch, lo))
            h = _fmix(ch, _mix_h1(ch, h, _mix_k1(ch, hi)), 8)
        else:
            raise ValueError(f"no SQL twin for key type {typ!r}")
    signed = f"CAST(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END AS INTEGER)"
    return f"(SELECT * EXCLUDE ({', '.join(ch.temps)}), {signed} AS {out} FROM ({ch.sql}))"


GRID = 1 << 32
EDGE_70, EDGE_80 = round(0.7 * GRID), round(0.8 * GRID)


def unit_sql(col: str, modulus: int = GRID) -> str:
    """``pmod(col, modulus)``."""
    return f"(((({col})::BIGINT) % {modulus} + {modulus}) % {modulus})"


def _det(m: list[list[str]]) -> str:
    n = len(m)
    if n == 1:
        return m[0][0]
    if n == 2:
        return f"(({m[0][0]})*({m[1][1]}) - ({m[0][1]})*({m[1][0]}))"
    terms = []
    for j in range(n):
        minor = [row[:j] + row[j + 1 :] for row in m[1:]]
        sign = "+" if j % 2 == 0 else "-"
        terms.append(f"{sign} ({m[0][j]})*{_det(minor)}")
    return "(" + " ".join(terms) + ")"


def ols_ctes(source: str, features: Sequence[str], target: str, prefix: str = "ols") -> str:
    """CTEs ``{prefix}_s`` (covariances, means) and ``{prefix}_b`` (b_0 intercept, b_1..b_k) solving the
    normal equations on the centred covariance matrix by Cramer's rule (k <= 4)."""
    k = len(features)
    cols = []
    for i, xi in enumerate(features, 1):
        for j, xj in enumerate(features, 1):
            if j >= i:
                cols.append(f"covar_pop({xi}, {xj}) AS s_{i}_{j}")
        cols.append(f"covar_pop({xi}, {target}) AS c_{i}")
        cols.append(f"avg({xi}) AS m_{i}")
    cols.append(f"avg({target}) AS m_y")
    s = [[f"s_{min(i, j)}_{max(i, j)}" for j in range(1, k + 1)] for i in range(1, k + 1)]
    det = _det(s)
    bs = []
    for j in range(k):
        mj = [row[:] for row in s]
        for i in range(k):
            mj[i][j] = f"c_{i + 1}"
        bs.append(f"{_det(mj)} / {det} AS b_{j + 1}")
    b0 = "m_y - (" + " + ".join(f"b_{j}*m_{j}" for j in range(1, k + 1)) + ") AS b_0"
    return (
        f"{prefix}_s AS (SELECT {', '.join(cols)} FROM {source}),\n"
        f"{prefix}_c AS (SELECT *, {', '.join(bs)} FROM {prefix}_s),\n"
        f"{prefix}_b AS (SELECT *, {b0} FROM {prefix}_c)"
    )


def ols_gauss_ctes(source: str, features: Sequence[str], target: str, prefix: str = "ols") -> str:
    """Same output as ``ols_ctes`` for any number of features: Gaussian elimination on the augmented centred
    covariance matrix [S | c], one CTE per pivot step (each cell refers only to the previous step's columns, so
    the SQL grows as k³, not k!), then back substitution.  S is symmetric positive definite, so no pivoting."""
    k = len(features)
    cols = []
    for i, xi in enumerate(features, 1):
        for j, xj in enumerate(features, 1):
            cols.append(f"covar_pop({xi}, {xj}) AS a0_{i}_{j}")
        cols.append(f"covar_pop({xi}, {target}) AS a0_{i}_{k + 1}")
        cols.append(f"avg({xi}) AS m_{i}")
    cols.append(f"avg({target}) AS m_y")
    ctes = [f"{prefix}_g0 AS (SELECT {', '.join(cols)} FROM {source})"]
    keep = [f"m_{i}" for i in range(1, k + 1)] + ["m_y"]
    for step in range(1, k + 1):
        prev = f"a{step - 1}"
        cells = []
        for i in range(1, k + 1):
            for j in range(1, k + 2):
                if i <= step:
                    cells.append(f"{prev}_{i}_{j} AS a{step}_{i}_{j}")
                else:
                    cells.append(
                        f"{prev}_{i}_{j} - {prev}_{i}_{step} / {prev}_{step}_{step} * {prev}_{step}_{j} AS a{step}_{i}_{j}"
                    )
        ctes.append(f"{prefix}_g{step} AS (SELECT {', '.join(cells + keep)} FROM {prefix}_g{step - 1})")
    a = f"a{k}"
    bs = []
    for i in range(k, 0, -1):
        rest = " + ".join(f"{a}_{i}_{j} * b_{j}" for j in range(i + 1, k + 1))
        num = f"{a}_{i}_{k + 1}" + (f" - ({rest})" if rest else "")
        bs.append(f"{prefix}_x{i} AS (SELECT *, ({num}) / {a}_{i}_{i} AS b_{i} FROM "
                  f"{prefix}_x{i + 1 if i < k else 'start'})")
    ctes.append(f"{prefix}_xstart AS (SELECT * FROM {prefix}_g{k})")
    ctes += bs
    b0 = "m_y - (" + " + ".join(f"b_{j}*m_{j}" for j in range(1, k + 1)) + ") AS b_0"
    ctes.append(f"{prefix}_b AS (SELECT *, {b0} FROM {prefix}_x1)")
    return ",\n".join(ctes)


def ols_prediction(features: Sequence[str], prefix: str = "ols") -> str:
    return f"({prefix}_b.b_0 + " + " + ".join(f"{prefix}_b.b_{j}*{x}" for j, x in enumerate(features, 1)) + ")"
