"""Column expressions (all JVM-side, inside whole-stage codegen; no Python UDF anywhere).

* ``parse_duration``  — fixed-offset duration text (``000 days HH:MM:SS``) to integer seconds.
* ``safe_double``     — text to double; unparsable text (or text failing a guard pattern) becomes NULL.
* ``band``            — multi-branch ``when`` banding with labels derived from the bounds.
* ``ratio``           — division that yields NULL for a zero or NULL denominator.
* ``hash32`` / ``hash_unit`` — a repeatable pseudo-random integer from row keys and a seed.
* ``time_parts``      — hour, day of week (1 = Sunday) and month of a timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character offsets (1-based) of hours, minutes and seconds in `000 days HH:MM:SS` text, and the
# guard pattern for numeric text (it admits `1.2.3` and `.`, which try_cast then turns into NULL).
DURATION_OFFSETS = (10, 13, 16)
NUMERIC_TEXT_PATTERN = "^[0-9.]+$"
#: Steps of the hash grid: every value of the 32-bit hash, so that a part of one in a million is not rounded away.
HASH_GRID = 1 << 32


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_duration(c: str | Column, offsets: Sequence[int] = DURATION_OFFSETS) -> Column:
    """Seconds from duration text.  Each two-character part is cast with ``try_cast``; if any part does not
    parse (bad text, other prefix width, NULL) the whole value is 0, as with ``coalesce(h*3600+m*60+s, 0)``."""
    s = _c(c).cast("string")
    h, m, sec = (F.substring(s, pos, 2).try_cast("int") for pos in offsets)
    return F.coalesce(h * 3600 + m * 60 + sec, F.lit(0))


def safe_double(c: str | Column, pattern: str | None = None) -> Column:
    """Double from text.  With ``pattern``, text not matching it is NULL before casting; the cast itself is
    ``try_cast`` so text such as ``1.2.3`` or ``.`` (which a loose pattern admits) is NULL instead of an error."""
    s = _c(c).cast("string")
    val = s.try_cast("double")
    if pattern is None:
        return val
    return F.when(s.rlike(pattern), val)


def band_labels(bounds: Sequence[float]) -> list[str]:
    """Labels for half-open bands split at ``bounds``: ``<b0``, ``[b0,b1)``, ..., ``>=bn`` (true for fractions too)."""
    def fmt(x: float) -> str:
        return str(int(x)) if float(x).is_integer() else str(x)

    labels = [f"<{fmt(bounds[0])}"]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        labels.append(f"[{fmt(lo)},{fmt(hi)})")
    labels.append(f">={fmt(bounds[-1])}")
    return labels


def band(c: str | Column, bounds: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """``when(c < b0, l0).when(c < b1, l1) ... .otherwise(ln)``; NULL input gives NULL."""
    labels = list(labels) if labels is not None else band_labels(bounds)
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    x = _c(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for b, lab in zip(bounds, labels):
        expr = expr.when(x < b, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 or NULL (``try_divide``)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def hash32(keys: Sequence[str | Column], seed: int = 42) -> Column:
    """Spark's 32-bit Murmur3 ``hash(seed, key1, key2, ...)``: one built-in expression inside generated code,
    any key types, and it depends only on the row's values, never on partitioning or row order."""
    return F.hash(F.lit(int(seed)), *[_c(k) for k in keys])


def hash_unit(keys: Sequence[str | Column], seed: int = 42, modulus: int = HASH_GRID) -> Column:
    """Integer in ``[0, modulus)`` from ``hash32`` (by default all its 2^32 values): a split or sample built on it is
    repeatable on any cluster size and needs no shuffle."""
    return F.pmod(hash32(keys, seed).cast("bigint"), F.lit(modulus).cast("bigint"))


def time_parts(ts: str | Column, prefix: str = "") -> dict[str, Column]:
    t = _c(ts)
    return {
        f"{prefix}hour": F.hour(t),
        f"{prefix}day_of_week": F.dayofweek(t),
        f"{prefix}month": F.month(t),
    }
