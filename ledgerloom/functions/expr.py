"""Column-expression helpers (all JVM-side, codegen friendly; no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col_of", "live_rows", "epoch_ts", "epoch_date", "blank_to_null", "div0", "strict_json", "pct", "average",
    "MONEY", "SUM_MONEY", "round_ratio_units", "round_ratio", "evaluated",
]

MONEY = "decimal(18,2)"
SUM_MONEY = "decimal(38,2)"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def live_rows(deleted="_fivetran_deleted") -> Column:
    """Soft-delete predicate: keep rows whose flag is false or null.

    Written as an OR (not ``coalesce``) so Parquet can take it as a pushed filter.
    """
    d = col_of(deleted)
    return d.isNull() | ~d


def epoch_ts(c) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (session zone is UTC); 0 and null give null."""
    c = col_of(c)
    return F.when(c.isNotNull() & (c != 0), F.timestamp_seconds(c)).cast("timestamp_ntz")


def epoch_date(c) -> Column:
    """Epoch seconds -> DATE; 0 and null give null."""
    return epoch_ts(c).cast("date")


def blank_to_null(c) -> Column:
    """``nullif(trim(c), '')``."""
    t = F.trim(col_of(c))
    return F.when(t != F.lit(""), t)


def div0(a, b) -> Column:
    """0 when the divisor is 0, null when either side is null, else a / b (double)."""
    a, b = col_of(a), col_of(b)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b == 0, F.lit(0.0))
            .otherwise(a.cast("double") / b.cast("double")))


def strict_json(text) -> Column:
    """Parse JSON text to VARIANT, null unless the whole text is one JSON value.

    ``try_parse_json`` reads the first value and ignores what follows it, so the text is parsed twice inside something
    else: as the only element of an array, and as the only member of an object.  What follows a first value would have
    to close the array (then the object stays open and fails) or the object (then the array fails), or add an
    element, which the array then shows.  Scalars are values too; the JSON text ``null`` is a value that is not SQL's null.
    Most texts are an array without further square brackets.  Such an array can end only at its last character, so
    nothing follows it and one parse is enough.
    """
    t = col_of(text)
    flat_array = t.rlike(r"\A\[[^\[\]]*+\]\z")
    alone = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}")))
    whole = member.isNotNull() & F.try_variant_get(alone, "$[1]", "variant").isNull()
    return F.when(flat_array, F.try_parse_json(t)).when(whole, F.try_variant_get(alone, "$[0]", "variant"))


def evaluated(df: DataFrame) -> DataFrame:
    """The same rows, each computed once before what follows.  Spark copies the expressions of a projection into a filter
    above it, so a costly column would be computed for the filter and again for the result; it copies none out of a
    generated row."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def _scaled(c, scale: int) -> Column:
    """Decimal (or integer) value -> integral decimal(38,0) in units of 10^-scale."""
    c = col_of(c)
    return (c * (10 ** scale)).cast("decimal(38,0)") if scale else c.cast("decimal(38,0)")


def round_ratio_units(num, den, times: int = 1, digits: int = 1, num_scale: int = 0, den_scale: int = 0) -> Column:
    """round(num / den * times, digits) * 10^digits as an exact integer (half away from zero).

    Inputs with ``num_scale``/``den_scale`` decimals are turned into integers first;
    the division is an integral ``div``, so no intermediate decimal/double rounding
    can move a result across a half-way point.  Null when den <= 0 or null.
    """
    n, d = _scaled(num, num_scale), _scaled(den, den_scale)
    exp = den_scale - num_scale + digits
    mult = times * 10 ** max(exp, 0)
    dd = d * (10 ** max(-exp, 0)) if exp < 0 else d
    q = F.call_function("div", F.abs(n) * (2 * mult) + dd, dd * 2)
    return F.when(d > 0, F.signum(n).cast("long") * q)


def round_ratio(num, den, times: int = 1, digits: int = 1, num_scale: int = 0, den_scale: int = 0) -> Column:
    """``round_ratio_units`` as a double (units / 10^digits)."""
    return round_ratio_units(num, den, times, digits, num_scale, den_scale) / float(10 ** digits)


def pct(num, den, digits: int = 1, num_scale: int = 0, den_scale: int = 0) -> Column:
    """round(num / den * 100, digits) as double when den > 0, else null."""
    return round_ratio(num, den, 100, digits, num_scale, den_scale)


def average(total, count) -> Column:
    """Unrounded average (double) of a sum over a count; null for an empty group."""
    total, count = col_of(total), col_of(count)
    return F.when(count > 0, total.cast("double") / count.cast("double"))
