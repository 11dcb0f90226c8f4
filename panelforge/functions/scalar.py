"""Column expressions (PRJ-*): everything here is a native Catalyst expression.

All functions take and return ``Column`` objects so they compose inside one
projection and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_label(year: ColumnOrName, during_start: int, post_start: int,
                 labels: Sequence[str] = ("pre", "during", "post")) -> Column:
    """PRJ-1: ``pre`` before ``during_start``, ``during`` before ``post_start``, else ``post``."""
    y = col(year)
    return (F.when(y < during_start, F.lit(labels[0]))
            .when(y < post_start, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def flag(cond: Column) -> Column:
    """PRJ-2: boolean condition → 0/1 int (NULL condition → 0, like pandas)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0) -> Column:
    """PRJ-3 / PRJ-4: ratio with a zero denominator mapped to NULL."""
    r = F.try_divide(col(num), F.nullif(col(den), F.lit(0)))
    return r * F.lit(scale) if scale != 1.0 else r


def offset_ratio(num: ColumnOrName, den: ColumnOrName, offset: float = 1.0, scale: float = 1.0) -> Column:
    """PRJ-5: ``num / (den + offset)`` to dodge zero denominators."""
    r = F.try_divide(col(num), col(den) + F.lit(offset))
    return r * F.lit(scale) if scale != 1.0 else r


def interaction(*cols: ColumnOrName) -> Column:
    """PRJ-6: product term."""
    out = col(cols[0])
    for c in cols[1:]:
        out = out * col(c)
    return out


def difference(a: ColumnOrName, b: ColumnOrName) -> Column:
    """PRJ-7."""
    return col(a) - col(b)


def rebuild_if_missing(columns: Sequence[str], name: str, total: ColumnOrName,
                       per_unit: ColumnOrName) -> Column:
    """PRJ-8: use the column when present, else total / per-unit."""
    if name in columns:
        return F.col(name)
    return safe_ratio(total, per_unit)


def log1p(c: ColumnOrName) -> Column:
    """PRJ-9: ln(1+x); NULL for x ≤ -1 instead of NaN."""
    x = col(c)
    return F.when(x > -1, F.log1p(x))


def compounded(base: ColumnOrName, rate_pct: ColumnOrName, periods: ColumnOrName) -> Column:
    """PRJ-10: ``base * (1 + g/100) ** i``."""
    return col(base) * F.pow(F.lit(1.0) + col(rate_pct) / 100.0, col(periods))


def year_start(year: ColumnOrName) -> Column:
    """PRJ-11: ``YYYY-01-01`` date from an integer year."""
    return F.make_date(col(year).cast("int"), F.lit(1), F.lit(1))


def recode(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """PRJ-12: value recode by a fixed map (``when`` chain; unmapped → default)."""
    x = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(x == F.lit(k), F.lit(v)) if out is None else out.when(x == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def stars(p: ColumnOrName) -> Column:
    """PRJ-13: significance stars."""
    x = col(p)
    return (F.when(x < 0.001, F.lit("***")).when(x < 0.01, F.lit("**"))
            .when(x < 0.05, F.lit("*")).otherwise(F.lit("")))


def verdict(value: ColumnOrName, threshold: float, below: str = "PASS", above: str = "FAIL",
            strict: bool = True) -> Column:
    """PRJ-13: threshold decision (α = 0.05, MAPE < 15, ...)."""
    x = col(value)
    cond = x < threshold if strict else x <= threshold
    return F.when(cond, F.lit(below)).otherwise(F.lit(above))


def rule_score(growth: ColumnOrName, internet: ColumnOrName, unemployment: ColumnOrName,
               innovation: ColumnOrName | None = None, innovation_default: float = 0.5) -> Column:
    """PRJ-14: fallback score when no model is available.

    Fixed values of the reference heuristic: 2 + 0.8·growth + 0.3·(internet/10)
    − 0.2·unemployment + 3·innovation, innovation defaulting to 0.5.
    """
    inn = F.lit(innovation_default) if innovation is None else F.coalesce(col(innovation), F.lit(innovation_default))
    return F.lit(2.0) + 0.8 * col(growth) + 0.3 * (col(internet) / 10.0) - 0.2 * col(unemployment) + 3.0 * inn


def has_edge_whitespace(c: ColumnOrName) -> Column:
    """PRJ-15: leading or trailing whitespace."""
    return col(c).rlike(r"^\s|\s$")


def is_placeholder_name(c: ColumnOrName, pattern: str = r"^Country_\d+$") -> Column:
    """PRJ-15: placeholder names (fixed pattern of the reference: ``^Country_\\d+$``)."""
    return col(c).rlike(pattern)


def norm_key(c: ColumnOrName) -> Column:
    """PRJ-16: trim + lower for case-insensitive equality."""
    return F.lower(F.trim(col(c)))


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """PRJ-3, WIN-2, FEA-1/2/6: the named columns rounded half up to their number of digits, the others as they are."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})
