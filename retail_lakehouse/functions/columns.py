"""Column functions (Column -> Column). All are built-in Catalyst expressions,
so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- cleaning ---------------------------------------------------------------

def blank_to_null(c: ColumnLike) -> Column:
    """``nullif(c, '')``: an empty landing value means "missing"."""
    return F.nullif(_col(c), F.lit(""))


def try_type(c: ColumnLike, data_type: str | T.DataType) -> Column:
    """Tolerant cast: a value that does not parse becomes NULL."""
    return blank_to_null(c).try_cast(data_type)


def default_chain(*cols: ColumnLike, default=None) -> Column:
    parts = [_col(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


# --- keys and fingerprints --------------------------------------------------

def surrogate_key(cols: Sequence[ColumnLike], algo: str = "sha256", sep: str = "||") -> Column:
    """Hash of the raw key parts joined by ``sep``. A blank part, NULL or '',
    hashes as if absent (``concat_ws`` skips NULL)."""
    joined = F.concat_ws(sep, *[blank_to_null(c) for c in cols])
    if algo == "md5":
        return F.md5(joined)
    if algo == "sha256":
        return F.sha2(joined, 256)
    raise ValueError(f"unknown hash algorithm {algo!r}")


# Control characters that Spark escapes with upper-case hex digits.
_UPPER_HEX_ESCAPES = ("000B", "000E", "000F", "001A", "001B", "001C", "001D", "001E", "001F")


def _lower_hex_escapes(json: Column) -> Column:
    """JSON text with its ``\\u00XX`` escapes in lower-case hex; an escape is
    told from an escaped backslash by the even number of backslashes before it."""
    for code in _UPPER_HEX_ESCAPES:
        json = F.regexp_replace(json, rf"(?<!\\)((?:\\\\)*)\\u{code}", rf"$1\\u{code.lower()}")
    return json


def row_hash(cols: Sequence[str], layout: str = "struct") -> Column:
    """Content fingerprint of a row.

    ``struct``: sha256 of the JSON object of the columns (NULL fields are
    omitted by ``to_json``). ``array``: sha256 of the JSON array of the values
    with NULL read as '' and control characters escaped in lower-case hex.
    """
    if layout == "struct":
        payload = F.to_json(F.struct(*[F.col(c) for c in cols]))
    elif layout == "array":
        payload = _lower_hex_escapes(F.to_json(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in cols])))
    else:
        raise ValueError(f"unknown row hash layout {layout!r}")
    return F.sha2(payload, 256)


# --- exact decimal arithmetic -----------------------------------------------

def _integral_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def exact_quotient(num: ColumnLike, den: ColumnLike, scale: int, num_scale: int = 0,
                   precision: int = 38) -> Column:
    """``num / den`` rounded half away from zero to ``scale`` digits, exactly.

    ``num`` is an exact number with at most ``num_scale`` fraction digits and
    ``den`` a positive integer. The work is done on integer units, so there is
    no intermediate rounding (Spark's decimal ``avg`` rounds to 6 digits first,
    and a double average rounds on its binary value). NULL when ``den`` is 0 or
    NULL.
    """
    if num_scale > scale:
        raise ValueError("num_scale must not exceed the result scale")
    den_c = F.nullif(_col(den).cast("decimal(38,0)"), F.lit(0))
    # num has at most `scale` fraction digits, so num * 10^scale is an integer.
    # A whole number is scaled as a decimal: as a long it would pass its range.
    exact = _col(num).cast("decimal(29,0)") if num_scale == 0 else _col(num)
    scaled = (exact * F.lit(10 ** scale)).cast("decimal(38,0)")
    magnitude = _integral_div(F.abs(scaled) * F.lit(2) + den_c, den_c * F.lit(2))
    signed = F.when(scaled < 0, -magnitude).otherwise(magnitude)
    unit = F.lit(1).cast("decimal(1,0)") if scale == 0 else F.expr(f"1E-{scale}BD")
    value = signed.cast("decimal(20,0)") * unit
    return value.cast(T.DecimalType(precision, scale))


def exact_avg(c: ColumnLike, scale: int, input_scale: int = 0, precision: int = 38) -> Column:
    """Aggregate: exact average of non-NULL values, half away from zero."""
    col = _col(c)
    return exact_quotient(F.sum(col), F.count(col), scale, input_scale, precision)


# --- dates -------------------------------------------------------------------

def iso_day_of_week(d: ColumnLike) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(_col(d)) + F.lit(1)


def elapsed_micros(end: ColumnLike, start: ColumnLike) -> Column:
    return F.unix_micros(_col(end)) - F.unix_micros(_col(start))


MICROS_PER_DAY = 86_400_000_000


# --- segments ----------------------------------------------------------------

def rfm_segment(r: ColumnLike, f: ColumnLike, m: ColumnLike) -> Column:
    """First matching segment of the recency, frequency and monetary scores."""
    r, f, m = _col(r), _col(f), _col(m)
    # Segment names and thresholds.
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), F.lit("Champions"))
        .when((r >= 3) & (f >= 3), F.lit("Loyal customers"))
        .when(r >= 4, F.lit("Recent customers"))
        .when((r <= 2) & (f >= 3), F.lit("At risk"))
        .otherwise(F.lit("Needs attention"))
    )
