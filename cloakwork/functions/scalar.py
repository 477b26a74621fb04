"""Scalar expressions.  Everything here is a plain Column, so it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_number(c: Column | str) -> Column:
    """Text to double, anything unreadable (and NaN) to null."""
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def number_or_zero(c: Column | str) -> Column:
    return F.coalesce(coerce_number(c), F.lit(0.0))


def coerce_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(c))


def year_month(c: Column | str) -> Column:
    return F.date_trunc("month", _c(c))


def first_digits(c: Column | str) -> Column:
    """First run of digits as an int; null when there is none."""
    return F.regexp_extract(_c(c), r"(\d+)", 1).try_cast("bigint")


def all_digits(c: Column | str) -> Column:
    """All digits of the text joined; 0 when there is none."""
    return F.coalesce(F.regexp_replace(_c(c), r"\D", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def log1p_shifted(c: Column | str, lowest: float) -> Column:
    """log1p after moving the column to start at 1 when its minimum is not positive."""
    shift = 1.0 - lowest if lowest <= 0 else 0.0
    return F.log1p(_c(c) + F.lit(shift))


def half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(_c(c), digits)


def clip(c: Column | str, lo: float, hi: float) -> Column:
    c = _c(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def numeric_image(c: Column | str, kind: str) -> Column:
    """Number behind a value: itself, epoch seconds of a datetime, or parsed text."""
    c = _c(c)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_timestamp(c.cast("timestamp")).cast("double")
    return c.try_cast("double") if kind == "string" else c.cast("double")


def number_or_code(c: Column | str, code: Column) -> Column:
    """The number in a text, or the dictionary code where the text is not a number."""
    return F.coalesce(F.trim(_c(c)).try_cast("double"), code.cast("double"))


# --- generalized values -------------------------------------------------------------


def format_interval(lo: Column | str, hi: Column | str, kind: str = "number", sep: str = "~") -> Column:
    """``lo~hi`` text of a class interval, one value when both ends agree.

    ``number`` writes whole numbers and truncates toward zero, ``exact`` keeps the
    full value, ``text`` is for categories, ``datetime`` always writes both ends.
    """
    lo, hi = _c(lo), _c(hi)
    if kind == "datetime":
        fmt = "yyyy-MM-dd HH:mm:ss"
        return F.concat(F.date_format(lo, fmt), F.lit(sep), F.date_format(hi, fmt))
    image = (lambda v: v.cast("bigint").cast("string")) if kind == "number" else (lambda v: v.cast("string"))
    return F.when(lo == hi, image(lo)).otherwise(F.concat(image(lo), F.lit(sep), image(hi)))


def interval_bounds(c: Column | str, sep: str = "~") -> tuple[Column, Column]:
    """``lo~hi`` text to two doubles; both null when either end cannot be read."""
    parts = F.split(_c(c), sep)
    lo, hi = coerce_number(F.trim(parts[0])), coerce_number(F.trim(F.element_at(parts, -1)))
    ok = lo.isNotNull() & hi.isNotNull()
    return F.when(ok, lo), F.when(ok, hi)


def category_list(c: Column | str, sep: str = "~") -> Column:
    """``a~b`` text to a list of trimmed labels, null to ``['missing']``."""
    return F.coalesce(F.transform(F.split(_c(c), sep), lambda x: F.trim(x)), F.array(F.lit("missing")))


def list_key(c: Column | str, sep: str = "|") -> Column:
    """List of labels to one category key; null and empty lists give ``missing``."""
    c = _c(c)
    return F.when(c.isNull() | (F.size(c) == 0), F.lit("missing")).otherwise(F.array_join(c, sep))


def cluster_interval(lo: Column | str, hi: Column | str) -> Column:
    """``[a - b]`` text of a cluster range, the bare value when it has no width."""
    lo, hi = _c(lo), _c(hi)
    return F.when(lo == hi, lo.cast("string")).otherwise(
        F.concat(F.lit("["), lo.cast("string"), F.lit(" - "), hi.cast("string"), F.lit("]"))
    )


def cluster_category(c: Column | str, root: str = "all") -> Column:
    """Root of the hierarchy is written as ``*``."""
    c = _c(c)
    return F.when(c == root, F.lit("*")).otherwise(c)


def numeric_aware_key(c: Column | str) -> Column:
    """Sort key: whole-number texts by value, other texts alphabetically."""
    c = _c(c)
    return F.struct(c.try_cast("bigint").alias("n"), c.alias("s"))
