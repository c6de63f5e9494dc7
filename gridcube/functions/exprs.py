"""Column -> Column building blocks.

Everything here is a built-in Spark expression: no Python UDF, so it stays
inside whole-stage codegen. All divisions are ``try_divide`` so the library
behaves the same under ANSI mode (Spark 4 default) and legacy mode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# White space as Python's str.strip sees it: ASCII controls, NEL and every Unicode separator.
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def strip(c) -> Column:
    """Both ends without white space of any kind (tabs, line ends and
    no-break spaces too, which ``trim`` leaves in place). Linear in the text: a
    run of white space is looked at once, from its start and without going back."""
    return F.regexp_replace(col(c), rf"\A{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")


def rnd(c, n: int = 2) -> Column:
    """numpy-style rounding: scale by 10**n, round half to even, unscale.

    Spark's ``round`` is half-up (0.125 -> 0.13); numpy gives 0.12.
    """
    s = float(10 ** n)
    return F.rint(col(c) * F.lit(s)) / F.lit(s)


def safe_ratio(num, den, n: int | None = 2) -> Column:
    """``num / den``; a zero, missing or NaN operand below, or a missing or NaN
    one above, gives 0.0; rounded."""
    r = F.try_divide(nan_to_null(col(num).cast("double")), nan_to_null(col(den).cast("double")))
    if n is not None:
        r = rnd(r, n)
    return F.coalesce(r, F.lit(0.0))


def ratio_inf_to_zero(num, den, n: int = 2) -> Column:
    """``num / den`` where x/0 (x != 0) is 0.0 and 0/0 stays NULL."""
    a, b = col(num).cast("double"), col(den).cast("double")
    return (F.when((b == 0) & (a != 0), F.lit(0.0))
            .otherwise(rnd(F.try_divide(a, b), n)))


def pct(num, den, n: int = 2) -> Column:
    """``num / den * 100`` rounded; zero denominator gives NULL."""
    return rnd(F.try_divide(col(num).cast("double"), col(den).cast("double")) * F.lit(100.0), n)


def sum_of_parts(*cols, n: int | None = None, null_as_zero: bool = False) -> Column:
    parts = [F.coalesce(col(c), F.lit(0)) if null_as_zero else col(c) for c in cols]
    s = reduce(lambda a, b: a + b, parts)
    return rnd(s, n) if n is not None else s


def lenient_num(c, n: int = 2) -> Column:
    """Parse text as a number; unparsable or missing becomes 0; rounded. Only
    decimal notation counts: ``NaN``, ``Infinity`` and Java suffixes such as
    ``1d`` are not numbers here, and neither is an overflow."""
    number = F.when(col(c).rlike(NUMBER), F.expr(f"try_cast(trim({_sql_ref(c)}) AS DOUBLE)"))
    return rnd(F.when(F.abs(number) < F.lit(float("inf")), number).otherwise(F.lit(0.0)), n)


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _sql_ref(c) -> str:
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError("lenient_num needs a column name")


def py_title(c) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of
    letters, lower-case the rest. ``initcap`` only restarts after spaces."""
    words = F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                              F.lower(F.substring(w, 2, 1 << 30)))),
        "")


def clean_key(c) -> Column:
    """District key: strip, title-case, en dash -> '-', two spaces -> one.
    NULL stays NULL (routed to the null-key check instead of becoming text)."""
    s = py_title(strip(c))
    s = F.replace(s, F.lit("–"), F.lit("-"))
    return F.replace(s, F.lit("  "), F.lit(" "))


def zfill(c, width: int = 11) -> Column:
    """Python ``str.zfill``: left-pad with zeros, keep a leading sign first,
    never truncate longer strings."""
    s = col(c).cast("string")
    signed = s.startswith("-") | s.startswith("+")
    return (F.when(F.length(s) >= width, s)
            .when(signed, F.concat(F.substring(s, 1, 1),
                                   F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0")))
            .otherwise(F.lpad(s, width, "0")))


def weighted_score(a, b, wa: float = 0.8, wb: float = 0.2, n: int = 3) -> Column:
    """``a*wa + (1-b)*wb`` rounded; inputs are expected already rounded."""
    return rnd(col(a) * F.lit(wa) + (F.lit(1.0) - col(b)) * F.lit(wb), n)


def pair_masked(a, b):
    """Mask each side of a pair to the rows where both are present."""
    a, b = col(a), col(b)
    both = a.isNotNull() & b.isNotNull() & ~F.isnan(a.cast("double")) & ~F.isnan(b.cast("double"))
    return F.when(both, a.cast("double")), F.when(both, b.cast("double"))


def safe_corr(a, b) -> Column:
    """Pearson r over rows where both are present; NULL when either side is
    constant (``F.corr`` raises under ANSI there)."""
    x, y = pair_masked(a, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)
