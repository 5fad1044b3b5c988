"""Pure ``Column`` builders used by every operator.

Nothing here triggers a Spark job: each function returns a Catalyst
expression, so whole-stage codegen sees the complete projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def col(name: str) -> Column:
    """Column by exact name (dots, spaces and backticks in names are safe)."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_blank(c: Column | str) -> Column:
    """NULL or only U+0020 blanks (Spark ``trim`` strips spaces only)."""
    c = col(c) if isinstance(c, str) else c
    return c.isNull() | (F.trim(c) == "")


def normalize_text(c: Column | str) -> Column:
    """Trim spaces; a blank value becomes NULL."""
    c = col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c), F.lit(""))


def safe_cast(c: Column | str, to: str) -> Column:
    """``try_cast``: an invalid value becomes NULL instead of failing the job."""
    c = col(c) if isinstance(c, str) else c
    return c.try_cast(to)


def strip_currency(c: Column | str) -> Column:
    """Remove every ``$`` and ``,`` (``$1,200.50`` -> ``1200.50``)."""
    c = col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"[$,]", "")


def parse_currency(c: Column | str) -> Column:
    return safe_cast(strip_currency(c), "double")


def parse_flag(c: Column | str, true_text: str = "t", false_text: str = "f") -> Column:
    """Case-sensitive ``'t'`` -> true, ``'f'`` -> false, anything else -> NULL."""
    c = col(c) if isinstance(c, str) else c
    return F.when(c == true_text, F.lit(True)).when(c == false_text, F.lit(False))


def digit_only(c: Column | str, pattern: str = r"^[0-9\s.,+-]+$") -> Column:
    c = col(c) if isinstance(c, str) else c
    return c.rlike(pattern)


def null_if_equal(c: Column | str, value) -> Column:
    """Sentinel to NULL (``0`` score means "no score")."""
    c = col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(value))


def null_if_match(c: Column | str, pattern: str) -> Column:
    c = col(c) if isinstance(c, str) else c
    return F.when(c.rlike(pattern), F.lit(None).cast(StringType())).otherwise(c)


def count_if(cond: Column) -> Column:
    """Number of rows where ``cond`` is TRUE (NULL counts as false); never NULL."""
    return F.count(F.when(cond, F.lit(1)))


def pct(part: Column, whole: Column, digits: int) -> Column:
    """``round(100 * part / whole, digits)``; NULL when ``whole`` is 0."""
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), digits)


def text_sample(c: Column | str, length: int = 30) -> Column:
    """Deterministic sample value: smallest non-blank text, newlines to blanks, cut to ``length``."""
    c = col(c) if isinstance(c, str) else c
    return F.substring(F.translate(F.min(normalize_text(c)), "\n", " "), 1, length)
