"""Scalar column expressions (F1-F14 of the survey). All JVM-side, inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or null (N6). ANSI-safe: never raises."""
    return F.coalesce(F.try_divide(col_(num).cast("double"), col_(den).cast("double")), F.lit(float(default)))


def offset_div(num: str | Column, den: str | Column, offset: float) -> Column:
    """num / (den + offset), the guarded ratios of the reference (N5): offsets 1e-5, 1, 1e-10."""
    return col_(num).cast("double") / (col_(den).cast("double") + F.lit(float(offset)))


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN 1D ELSE 0D (F1) as a double, not a decimal."""
    return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))


def rate_pct(cond: Column, digits: int = 2) -> Column:
    """ROUND(AVG(CASE WHEN cond THEN 1 ELSE 0 END) * 100, digits) with double arithmetic."""
    return F.round(F.avg(flag(cond)) * F.lit(100.0), digits)


def to_binary(score: str | Column, threshold: float | Column) -> Column:
    """(p >= t) as 0/1 int (F8)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (col_(score) >= t).cast("int")


def clamp(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """min/max clamp."""
    out = col_(c)
    if hi is not None:
        out = F.least(F.lit(float(hi)), out)
    if lo is not None:
        out = F.greatest(F.lit(float(lo)), out)
    return out


def in_band(c: str | Column, lo: float = 0.80, hi: float = 1.25) -> Column:
    """lo <= x <= hi (F9), the four-fifths range."""
    return col_(c).between(lo, hi)


def trunc_int(c: str | Column) -> Column:
    """Truncation toward zero (N9, F5): a double cast to int."""
    return col_(c).cast("int")


def dummy_name(feature: str, value: str | Column, sep: str = "_") -> Column:
    """``feature_value`` column names."""
    return F.concat_ws(sep, F.lit(feature), col_(value))


def second_part(c: str | Column, sep: str = "__") -> Column:
    """``split(name, '__')[1]`` (F11); a name that holds the separator twice is cut like the reference."""
    return F.element_at(F.split(col_(c), sep), 2)


def iso_date(y: str | Column, m: str | Column, d: str | Column) -> Column:
    """Zero-padded ISO date string from parts."""
    return F.date_format(F.make_date(col_(y), col_(m), col_(d)), "yyyy-MM-dd")


def pct_text(c: str | Column, digits: int = 1) -> Column:
    """'12.3%' formatting."""
    return F.format_string(f"%.{digits}f%%", col_(c).cast("double") * F.lit(100.0))


def money_text(c: str | Column) -> Column:
    """'$1,234' formatting."""
    return F.concat(F.lit("$"), F.format_number(col_(c).cast("double"), 0))


def normalise(arr: str | Column) -> Column:
    """p / sum(p) over an array."""
    a = col_(arr)
    total = F.aggregate(a, F.lit(0.0), lambda s, y: s + y)
    return F.transform(a, lambda x: x / total)


def round_all(df, digits: int = 6, cols: Iterable[str] | None = None):
    """Round every double column (for engine-independent comparison)."""
    names = set(cols) if cols is not None else None
    exprs = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and (names is None or f.name in names):
            exprs.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)
