"""Scalar column functions of the cleaning jobs, all built-in expressions.

Each function takes and returns a ``Column`` so it composes inside one
``select``/``withColumns`` projection and stays in whole-stage codegen.
Lenient parsing goes through ``try_*`` forms: the session runs with ANSI on
and is never switched off.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum.functions.rules import DURATION_UNIT_DAYS

# --- fixed values ------------------------------------------------------------
ACCENTED = "áéíóú"   # only these lower-case vowels fold; ñ and ü stay
PLAIN = "aeiou"
INT_PATTERN = r"^[+-]?[0-9]+$"
EPOCH_2000 = "2000-01-01"
CHECK_DIGIT_FROM = 1_000_000_000   # ids with 10+ digits carry a check digit
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_accents(c) -> Column:
    return F.translate(_c(c), ACCENTED, PLAIN)


def lower_fold(c) -> Column:
    return fold_accents(F.lower(_c(c)))


def blank_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def parse_int_or(c, default: int = 0, decimal: bool = False) -> Column:
    """Delete every '.', trim, parse a 64-bit integer; anything else -> default.

    ``decimal``: a last '.' with one or two digits behind it is a decimal point, and what follows it is cut off.
    """
    text = F.regexp_replace(F.trim(_c(c)), r"\.[0-9]{1,2}$", "") if decimal else _c(c)
    s = F.trim(F.replace(text, F.lit("."), F.lit("")))
    parsed = F.when(s.rlike(INT_PATTERN), s.try_cast("bigint"))
    return F.coalesce(parsed, F.lit(default).cast("bigint"))


def cast_int_strict(c) -> Column:
    """Text -> bigint; bad text raises under ANSI, like the reference's astype."""
    return F.trim(_c(c)).cast("bigint")


def cast_int_lenient(c, bits: int = 64) -> Column:
    """Text -> integer or NULL (over-long or bad values)."""
    return F.trim(_c(c)).try_cast("int" if bits == 32 else "bigint")


def strip_check_digit(c) -> Column:
    n = _c(c)
    return F.when(n >= F.lit(CHECK_DIGIT_FROM), F.call_function("div", n, F.lit(10))).otherwise(n)


def entity_id_clean(c) -> Column:
    """Drop dots and spaces, keep the part before '-', first 9 chars, integer."""
    s = F.translate(_c(c), ". ", "")
    head = F.substring(F.substring_index(s, "-", 1), 1, 9)
    return F.when(head.rlike(INT_PATTERN), head.try_cast("bigint"))


def duration_to_days(n, unit, strict: bool = True) -> Column:
    """n * days(unit); an unknown unit raises (strict) or gives NULL."""
    u = _c(unit)
    factor = None
    for name, days in DURATION_UNIT_DAYS.items():
        factor = F.when(u == name, F.lit(days)) if factor is None else factor.when(u == name, F.lit(days))
    fallback = F.raise_error(F.concat(F.lit("unknown duration unit: "), F.coalesce(u, F.lit("NULL")))) \
        if strict else F.lit(None)
    factor = factor.otherwise(fallback.cast("int"))
    return (_c(n) * factor).cast("bigint")


def contract_duration(signed, start, end) -> Column:
    """Days of the contract: from start, or max(0, from signature) if no start."""
    return F.when(
        _c(start).isNull(), F.greatest(F.lit(0), F.datediff(_c(end), _c(signed)))
    ).otherwise(F.datediff(_c(end), _c(start)))


def effective_start(signed, start, end) -> Column:
    return F.least(_c(end), F.coalesce(_c(start), _c(signed)))


def days_since(c, origin: str | _dt.date = EPOCH_2000) -> Column:
    return F.datediff(_c(c), F.lit(str(origin)).cast("date"))


def day_after(c) -> Column:
    return F.date_add(_c(c), 1)


def make_interval(start, end) -> Column:
    return F.struct(_c(start).alias("start"), _c(end).alias("end"))


def first_of_month(c) -> Column:
    return F.trunc(_c(c), "month")


def clamp_min_zero(c) -> Column:
    return F.greatest(_c(c), F.lit(0))


def case_when_zero(value, fallback) -> Column:
    return F.when(_c(value) == 0, _c(fallback)).otherwise(_c(value))


def parse_date_or_null(c, fmt: str | None = None) -> Column:
    s = blank_to_null(c)
    ts = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return ts.cast("date")


def format_usd(c, rate: float = 4000.0) -> Column:
    return F.concat(F.lit("$"), F.format_number(_c(c) / F.lit(rate), 1))


def concat_text(a, b, sep: str = " ") -> Column:
    """Null-propagating concatenation (a NULL part gives NULL, as pandas '+')."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def recode(c, mapping: dict) -> Column:
    expr = None
    for old, new in mapping.items():
        expr = F.when(_c(c) == old, F.lit(new)) if expr is None else expr.when(_c(c) == old, F.lit(new))
    return _c(c) if expr is None else expr.otherwise(_c(c))
