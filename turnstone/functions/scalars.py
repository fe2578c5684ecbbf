"""Column expressions.  Everything here stays inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnstone.functions.fixed_values import DAYS_OUT_BUCKETS

Col = Column | str


def col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- rules --------------------------------------------------------------------
def first_match(rules: Iterable[tuple[Column, Any]], default: Any) -> Column:
    """CASE semantics: the first true condition decides."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if out is None else out.otherwise(default)


def last_match(rules: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """Overwrite semantics: rules are applied in order and the last true one stays."""
    return first_match(list(rules)[::-1], default)


def lookup(key: Col, values: Mapping[Any, Any], default: Any = None) -> Column:
    """Value for a key; ``default`` (or null) where the key is absent."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def label_of(key: Col, groups: Mapping[Any, Sequence[Any]], default: Any) -> Column:
    """Label whose list holds the key; on overlap the label stated last wins."""
    return last_match([(col(key).isin(list(v)), k) for k, v in groups.items()], default)


# --- numbers --------------------------------------------------------------------
def ratio(numerator: Col, denominator: Col) -> Column:
    """Double division; null where the denominator is zero."""
    return col(numerator).cast("double") / F.nullif(col(denominator).cast("double"), F.lit(0.0))


def clamp(value: Col, upper: Col, lower: float = 0.0) -> Column:
    return F.least(F.greatest(col(value), F.lit(lower)), col(upper))


def whole_number(value: Col) -> Column:
    """Integer part of anything numeric; null for text that is not a number."""
    return col(value).try_cast("double").try_cast("int")


def finite_or_zero(value: Col) -> Column:
    """Zero for null, NaN and infinities, as after a log of zero."""
    v = col(value)
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(v)


def log_or_zero(value: Col) -> Column:
    v = col(value).cast("double")
    return F.when(v > 0, F.ln(v)).otherwise(F.lit(0.0))


def row_sum(columns: Sequence[Col]) -> Column:
    """Sum across columns; nulls count as zero."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(col(c).cast("double"), F.lit(0.0))
    return total


def row_mean(columns: Sequence[Col]) -> Column:
    """Mean across the non-null columns; null where all are null."""
    n = F.lit(0)
    for c in columns:
        n = n + col(c).isNotNull().cast("int")
    return ratio(row_sum(columns), n)


def cut(value: Col, edges: Sequence[float | None], labels: Sequence[Any], right: bool = True) -> Column:
    """Bins between consecutive edges; outside all bins gives null.

    ``right=True`` makes bins (a, b], ``right=False`` [a, b).  ``None`` is an
    open end.
    """
    v = col(value)
    rules = []
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (v > low if right else v >= low)
        if high is not None:
            inside = inside & (v <= high if right else v < high)
        rules.append((v.isNotNull() & inside, label))
    return first_match(rules, None)


def days_out_bucket(days: Col) -> Column:
    d = col(days)
    rules = []
    for low, high, label in DAYS_OUT_BUCKETS:
        test = F.lit(True)
        if low is not None:
            test = test & (d >= low)
        if high is not None:
            test = test & (d <= high)
        rules.append((d.isNotNull() & test, label))
    return first_match(rules, "Unknown")


# --- dates ------------------------------------------------------------------------
def days_between(start: Col, end: Col) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(col(end), col(start))


def dow0(day: Col) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(col(day)) - 1


def season_of(day: Col, first_month: int = 7) -> Column:
    """'2023-24' style season; a new season starts in ``first_month``."""
    d = col(day)
    start = F.year(d) - (F.month(d) < first_month).cast("int")
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def next_season(season: Col) -> Column:
    start = F.left(col(season), F.lit(4)).cast("int") + 1
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def date_range_text(first: Col, last: Col, pattern: str = "MM/dd/yy") -> Column:
    a, b = F.date_format(col(first), pattern), F.date_format(col(last), pattern)
    return F.when(col(first) == col(last), a).otherwise(F.concat(a, F.lit(" - "), b))


def seat_key(*parts: Col) -> Column:
    return F.concat_ws("-", *[col(p).cast("string") for p in parts])
