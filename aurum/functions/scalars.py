"""Column-level scalar helpers.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Text accepted as a number by the strict safe cast: optional sign, digits with an
# optional fraction (or a bare fraction), optional exponent; or NaN / infinity words.
NUMERIC_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_TEXT = r"^(?i)[+-]?(nan|inf|infinity)$"


def col_(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: ColumnOrName) -> Column:
    """SAFE_CAST(text AS FLOAT64): NULL for anything that is not plain numeric text.

    ``try_cast`` alone accepts Java literal suffixes ('1d' -> 1.0, '2f' -> 2.0), so the
    text is checked against a numeric pattern first.
    """
    t = F.trim(col_(c).cast("string"))
    ok = t.rlike(NUMERIC_TEXT) | t.rlike(SPECIAL_TEXT)
    return F.when(ok, t.try_cast("double"))


def safe_long(c: ColumnOrName) -> Column:
    """SAFE_CAST(text AS INT64): integral text only."""
    t = F.trim(col_(c).cast("string"))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))


def round_half_up(c: ColumnOrName, scale: int) -> Column:
    """ROUND(x, n) with halves away from zero (Spark rounds the decimal form of a double)."""
    return F.round(col_(c), scale)


def scaled(c: ColumnOrName, divisor: float, scale: int) -> Column:
    """ROUND(c / divisor, scale) with a double divisor (a bare 10.0 literal would be DECIMAL)."""
    return F.round(col_(c) / F.lit(float(divisor)), scale)


def value_map(c: ColumnOrName, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Simple CASE value map. Without ``default`` an unmatched or NULL operand gives NULL;
    with it, both give the default (CASE x WHEN .. ELSE d END)."""
    src = col_(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(src == F.lit(k), F.lit(v)) if expr is None else expr.when(src == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def guarded_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """CASE WHEN den > 0 THEN ROUND(num / den, scale) ELSE 0 END  (NULL den -> 0)."""
    n, d = col_(num), col_(den)
    return F.when(d > 0, F.round(n.cast("double") / d.cast("double"), scale)).otherwise(F.lit(0.0))


def nullif_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """ROUND(num * 1.0 / NULLIF(den, 0), scale)  (0 or NULL den -> NULL)."""
    n, d = col_(num), col_(den)
    return F.round(n.cast("double") / F.nullif(d, F.lit(0)).cast("double"), scale)


def weighted_sum(terms: list[tuple[ColumnOrName, float]], scale: int | None = 2) -> Column:
    """ROUND(sum(term * weight), scale) with double weights; any NULL term gives NULL."""
    total = None
    for c, w in terms:
        t = col_(c) * F.lit(float(w))
        total = t if total is None else total + t
    return F.round(total, scale) if scale is not None else total


def strict_concat(*parts: ColumnOrName) -> Column:
    """CONCAT(a, ' ', b): NULL when any part is NULL (not concat_ws, which skips NULLs).
    Strings are column names; pass literals as ``F.lit``."""
    return F.concat(*[col_(p) for p in parts])


def lit_concat(c: ColumnOrName, suffix: str) -> Column:
    """CONCAT(c, '<suffix>') with the suffix always a literal."""
    return F.concat(col_(c), F.lit(suffix))


def bands(c: ColumnOrName, rules: list[tuple[str, Any, Any]]) -> Column:
    """Searched CASE over numeric bands, no ELSE: rules are (op, bound, label), op in <=, =, >=, <, >."""
    src = col_(c)
    ops = {"<=": src.__le__, "=": src.__eq__, ">=": src.__ge__, "<": src.__lt__, ">": src.__gt__}
    expr = None
    for op, bound, label in rules:
        cond = ops[op](F.lit(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def is_true(c: ColumnOrName) -> Column:
    """``x = TRUE`` predicate (NULL drops)."""
    return col_(c) == F.lit(True)


def is_false(c: ColumnOrName) -> Column:
    """``x = FALSE`` predicate (NULL drops)."""
    return col_(c) == F.lit(False)


def positive_flag(c: ColumnOrName) -> Column:
    """CASE WHEN x > 0 THEN TRUE ELSE FALSE END (NULL -> FALSE)."""
    return F.when(col_(c) > 0, F.lit(True)).otherwise(F.lit(False))


def coalesce_zero(c: ColumnOrName) -> Column:
    return F.coalesce(col_(c), F.lit(0))


def period_of(ts: ColumnOrName, origin: str = "1995-01-01", days: int = 7) -> Column:
    """1-based period index of a timestamp: whole ``days``-long steps since ``origin``."""
    d = F.datediff(F.to_date(col_(ts)), F.lit(origin).cast("date"))
    return (F.floor(d / F.lit(days)) + F.lit(1)).cast("long")


def ddmmyyyy(c: ColumnOrName) -> Column:
    """Date/timestamp -> 'DDMMYYYY' landing-key text."""
    return F.date_format(col_(c), "ddMMyyyy")


def date_from_name(path: ColumnOrName, pattern: str = r"_([0-9]{8})(\.|/)") -> Column:
    """'<table>_<DDMMYYYY>.json' (or a folder of that name) -> DATE; NULL when absent."""
    part = F.regexp_extract(col_(path), pattern, 1)
    return F.when(part != "", F.try_to_timestamp(part, F.lit("ddMMyyyy")).cast("date"))
