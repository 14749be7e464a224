"""Scalar column rules.

Every function returns a ``Column`` built from built-in expressions, so it
stays inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
US_PER_SECOND = 1_000_000


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time ----

def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since the epoch of a TIMESTAMP_NTZ (zone independent)."""
    return F.unix_timestamp(_c(ts))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, without any zone."""
    frac = (F.date_part(F.lit("SECOND"), _c(ts)) * US_PER_SECOND).cast("long") % US_PER_SECOND
    return F.unix_timestamp(_c(ts)) * US_PER_SECOND + frac


def epoch_millis(ts: str | Column) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ (truncated)."""
    return F.floor(epoch_micros(ts) / 1000).cast("long")


def days_between_ms(later: str | Column, earlier: str | Column) -> Column:
    """Difference of two epoch-ms stamps in (fractional) days."""
    return (_c(later) - _c(earlier)) / float(MS_PER_DAY)


def fixed_width_bin(later_ms: str | Column, earlier_ms: str | Column, n_days: int) -> Column:
    """Bin index of width ``n_days``, truncated toward zero.

    Integer arithmetic on milliseconds (truncating toward zero like the
    reference's ``int()``), so no 32-bit float can move a row over a bin edge.
    """
    return div_trunc(_c(later_ms) - _c(earlier_ms), n_days * MS_PER_DAY)


def div_trunc(num: Column, den: int) -> Column:
    """Integer division truncating toward zero (Java remainder semantics)."""
    n = num.cast("long")
    return ((n - (n % den)) / den).cast("int")


def floor_bin(t: str | Column, start: str | Column | int, width: int) -> Column:
    """Floor-division bins (``(t - start) // width``) as a long."""
    s = F.lit(start) if isinstance(start, int) else _c(start)
    return F.floor((_c(t) - s) / width).cast("long")


def hour_of_epoch_ms(ms: str | Column) -> Column:
    """Hour of day (UTC) of an epoch-ms stamp, by arithmetic only."""
    return F.pmod(F.floor(_c(ms) / 3_600_000), F.lit(24)).cast("int")


# ---------------------------------------------------------------- text ----

def split_part(c: str | Column, sep: str, i: int) -> Column:
    """The i-th (0-based) piece of ``c`` split on a literal separator."""
    return F.split(_c(c), re.escape(sep)).getItem(i)


def drop_last_chars(c: str | Column, n: int) -> Column:
    """All but the last ``n`` characters."""
    col = _c(c)
    return F.substring(col, F.lit(1), F.greatest(F.length(col) - n, F.lit(0)))


def last_char_number(c: str | Column) -> Column:
    """The last character as an integer, null when it is not a digit."""
    return F.right(_c(c), F.lit(1)).try_cast("int")


def remove_digits(c: str | Column) -> Column:
    """Remove every run of digits (host name -> host class)."""
    return F.regexp_replace(_c(c), r"\d+", "")


# The two account-name patterns and their class names, as the
# reference states them (matched at the start of the string only).
ACCOUNT_PATTERNS = [
    (r"^Comp\d+\$", "Computer account"),
    (r"^User\d+", "User account"),
]


def pattern_class(c: str | Column, patterns: Sequence[tuple[str, str]] = ACCOUNT_PATTERNS) -> Column:
    """First anchored pattern that matches gives the class, else the input."""
    col = _c(c)
    out = None
    for pat, name in patterns:
        out = (F.when(col.rlike(pat), F.lit(name)) if out is None
               else out.when(col.rlike(pat), F.lit(name)))
    return out.otherwise(col) if out is not None else col


def contains_flag(c: str | Column, needle: str) -> Column:
    """1 if ``c`` contains ``needle`` else 0 (null stays null)."""
    return _c(c).contains(needle).cast("int")


def all_but_last(c: str | Column) -> Column:
    """``s[:-1]``."""
    return drop_last_chars(c, 1)


def tens_digit(c: str | Column) -> Column:
    """X08 (first half): first character of the code as int; null if either
    digit fails, so both halves are null together."""
    s = _c(c).cast("string")
    a = F.substring(s, 1, 1).try_cast("int")
    b = F.substring(s, 2, 1).try_cast("int")
    return F.when(a.isNotNull() & b.isNotNull(), a)


def ones_digit(c: str | Column) -> Column:
    """X08 (second half)."""
    s = _c(c).cast("string")
    a = F.substring(s, 1, 1).try_cast("int")
    b = F.substring(s, 2, 1).try_cast("int")
    return F.when(a.isNotNull() & b.isNotNull(), b)


def strip_brackets_split(c: str | Column) -> Column:
    """``"[-1,0]"`` -> ``["-1", "0"]``; ``"[]"`` -> ``[""]``."""
    return F.transform(F.split(F.regexp_replace(_c(c), r"[\[\]]", ""), ","), lambda x: F.trim(x))


def norm_text(c: str | Column) -> Column:
    """Lower-case and trim."""
    return F.lower(F.trim(_c(c)))


def title_label(c: str | Column) -> Column:
    """X11: ``aid_related`` -> ``Aid Related``."""
    return F.initcap(F.replace(_c(c), F.lit("_"), F.lit(" ")))


def log1p(c: str | Column) -> Column:
    """``log(x + 1)``."""
    return F.log1p(_c(c))


def flag(cond: Column) -> Column:
    """Condition -> 0/1 with missing treated as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def normalise_channels(arr: str | Column, means: Sequence[float], stds: Sequence[float]) -> Column:
    """Per-channel ``(x - mean[c]) / std[c]`` over a flat array whose
    channel is ``i % len(means)``."""
    m = F.array(*[F.lit(float(x)) for x in means])
    s = F.array(*[F.lit(float(x)) for x in stds])
    k = len(means)
    return F.transform(_c(arr), lambda x, i: (x - F.element_at(m, (i % k) + 1))
                       / F.element_at(s, (i % k) + 1))


def denormalise_clip(arr: str | Column, means: Sequence[float], stds: Sequence[float]) -> Column:
    """X19 inverse: ``x * std + mean`` clipped to [0, 1]."""
    m = F.array(*[F.lit(float(x)) for x in means])
    s = F.array(*[F.lit(float(x)) for x in stds])
    k = len(means)
    return F.transform(_c(arr), lambda x, i: F.least(F.greatest(
        x * F.element_at(s, (i % k) + 1) + F.element_at(m, (i % k) + 1), F.lit(0.0)), F.lit(1.0)))


# ------------------------------------------------------------- metrics ----

def safe_ratio(num: str | Column, den: str | Column) -> Column:
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def precision(tp: str | Column, fp: str | Column) -> Column:
    return safe_ratio(tp, _c(tp) + _c(fp))


def recall(tp: str | Column, fn: str | Column) -> Column:
    return safe_ratio(tp, _c(tp) + _c(fn))


def f_beta(p: str | Column, r: str | Column, beta: float) -> Column:
    """(1 + b^2) p r / (b^2 p + r); 0 when precision and recall are 0
    (scikit-learn's zero_division=0)."""
    b2 = beta * beta
    return F.coalesce(F.try_divide((1 + b2) * _c(p) * _c(r), b2 * _c(p) + _c(r)), F.lit(0.0))


def accuracy(correct: str | Column, total: str | Column) -> Column:
    return safe_ratio(correct, total)
