"""Scalar column expressions (the PRJ-* family).

Every helper maps ``Column -> Column`` using built-in Spark functions only,
so the expressions stay inside whole-stage codegen.  Nothing here touches a
DataFrame or the driver.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Casts
# --------------------------------------------------------------------------

INTEGRAL_TYPES = ("tinyint", "smallint", "int", "bigint")


def uint16_or_null(c: ColumnOrName, integral: bool = False) -> Column:
    """Null-on-failure unsigned 16-bit id: text -> int in [0, 65535] else NULL.

    The value goes through its string form, so 'abc', '-1', '70000' and
    '3.5' all become NULL instead of raising under ANSI mode.  When the
    input is already an integer type (``integral``), the string round trip
    is the identity, so only the range check runs (no per-row formatting).
    """
    if integral:
        x = _c(c)
        return F.when(x.between(0, 65535), x.cast("int"))
    v = _c(c).cast("string").try_cast("int")
    return F.when(v.between(0, 65535), v)


FRACTIONAL_TYPES = ("float", "double")


def id_cast_for(df, column: str):
    """``uint16_or_null`` specialised to the column's type in ``df``.

    Integer columns only need the range check.  For floating-point columns
    the text form of a whole number has no fraction (3.0 reads as 3), so a
    whole value in range converts and anything fractional is NULL.
    """
    t = dict(df.dtypes).get(column)
    if t in FRACTIONAL_TYPES:
        x = F.col(column)
        return F.when((x == F.floor(x)) & x.between(0, 65535), x.cast("int"))
    return uint16_or_null(column, integral=t in INTEGRAL_TYPES)


def smallint_strict(c: ColumnOrName) -> Column:
    """Plain narrowing cast to SMALLINT (raises on overflow under ANSI)."""
    return _c(c).cast("smallint")


def flag_is_yes(c: ColumnOrName) -> Column:
    """'Y'/'N' flag -> boolean; NULL stays NULL."""
    return _c(c) == F.lit("Y")


# --------------------------------------------------------------------------
# Time
# --------------------------------------------------------------------------

def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole seconds since 1970-01-01 for a wall-clock (zone-less) timestamp."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), _c(ts).cast("timestamp_ntz"))


def minute_index(ts: ColumnOrName) -> Column:
    """Floor of epoch seconds / 60: the minute bucket a timestamp falls in."""
    s = epoch_seconds(ts)
    # s - pmod(s, 60) is an exact multiple of 60, so the division is exact
    return ((s - F.pmod(s, F.lit(60))) / F.lit(60)).cast("long")


def minutes_boundary(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minute boundaries crossed between two timestamps (10:59:59 -> 11:00:01 = 1).

    Computed on zone-less epoch seconds, so no session zone can shift it.
    The result is an INT; a negative span stays negative.
    """
    return (minute_index(end) - minute_index(start)).cast("int")


def minutes_elapsed(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole elapsed minutes between two timestamps (truncated toward zero)."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end)).cast("int")


def add_seconds(ts: ColumnOrName, seconds: ColumnOrName) -> Column:
    """Timestamp plus an integral number of seconds (type of ``ts`` kept)."""
    return F.timestamp_add("SECOND", _c(seconds).cast("int"), _c(ts))


def trip_date(ts: ColumnOrName) -> Column:
    return F.to_date(_c(ts))


def month_start(ts: ColumnOrName) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(F.to_date(_c(ts)), "MM")


def iso_weekday(ts: ColumnOrName) -> Column:
    """ISO weekday 1 = Monday .. 7 = Sunday (``dayofweek`` starts on Sunday)."""
    return (F.weekday(_c(ts)) + F.lit(1)).cast("int")


def hour_of_day(ts: ColumnOrName) -> Column:
    return F.hour(_c(ts)).cast("int")


# --------------------------------------------------------------------------
# Arithmetic
# --------------------------------------------------------------------------

def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / nullif(den, 0)``: NULL instead of a division error."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def guarded_pct(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part / whole * 100`` as FLOAT when ``whole > 0``, else 0."""
    return (F.when(_c(whole) > 0, (_c(part) / _c(whole) * 100).cast("float"))
            .otherwise(F.lit(0.0).cast("float")))


def cv_pct(stddev: ColumnOrName, mean: ColumnOrName) -> Column:
    """Coefficient of variation in percent; 0 when the mean is 0 or NULL."""
    m = _c(mean)
    return F.when(m.isNotNull() & (m != 0), _c(stddev) / m * 100).otherwise(F.lit(0.0))


def cv_band(cv: ColumnOrName) -> Column:
    """Consistency band of a CV percentage."""
    v = _c(cv)
    # fixed values: band names and thresholds (percent)
    return (F.when(v < 10, F.lit("consistent"))
            .when(v <= 20, F.lit("acceptable"))
            .otherwise(F.lit("investigate")))


def ride_type(shared_matched: ColumnOrName, shared_requested: ColumnOrName) -> Column:
    """shared_matched / shared_unmatched / solo (a NULL flag counts as false)."""
    return (F.when(_c(shared_matched), F.lit("shared_matched"))
            .when(_c(shared_requested), F.lit("shared_unmatched"))
            .otherwise(F.lit("solo")))


# fixed values: medallion layer order
LAYER_ORDER = ("bronze", "silver", "gold")


def layer_ordinal(layer: ColumnOrName) -> Column:
    """bronze -> 1, silver -> 2, anything else -> 3 (a sort key)."""
    c = _c(layer)
    return F.when(c == "bronze", 1).when(c == "silver", 2).otherwise(3)


# fixed values: binary size units, smallest first
BYTE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB")


def human_bytes(n: ColumnOrName) -> Column:
    """Bytes as text with two decimals and a binary unit, e.g. '1,536.00 KiB'.

    A ``when`` ladder over powers of 1024; the last unit takes everything
    above it.  Pure column expression, no UDF.
    """
    x = _c(n).cast("double")
    out = None
    for i, unit in enumerate(BYTE_UNITS):
        scaled = x / F.lit(float(1024 ** i))
        text = F.concat(F.format_number(scaled, 2), F.lit(" " + unit))
        if i == len(BYTE_UNITS) - 1:
            out = out.otherwise(text) if out is not None else text
        else:
            cond = scaled < 1024
            out = F.when(cond, text) if out is None else out.when(cond, text)
    return F.when(x.isNotNull(), out)


def bench_tag(run_id: ColumnOrName, question: ColumnOrName, layer: ColumnOrName,
              iteration: ColumnOrName) -> Column:
    """Measurement tag ``tcc_bench|run|question|layer|iN``."""
    # fixed values: tag prefix, separator and iteration marker
    return F.concat_ws("|", F.lit("tcc_bench"), _c(run_id), _c(question), _c(layer),
                       F.concat(F.lit("i"), _c(iteration).cast("string")))


def tag_part(tag: ColumnOrName, index: int) -> Column:
    """Field ``index`` (0-based) of a '|'-separated tag."""
    return F.split(_c(tag), r"\|").getItem(index)
