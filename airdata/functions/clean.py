"""Cleaning and normalisation as pure column expressions (C-01 .. C-22).

Everything here is a ``Column -> Column`` built from Spark built-ins, so it
runs inside whole-stage codegen with no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code placeholders treated as missing by the cleanup scripts.
SENTINELS = ("", " ", "NA", "\\N")
# Extra tokens the pandas CSV reader turns into missing values.
PANDAS_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                      "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                      "nan", "null")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x) -> Column:
    """Python ``str.strip()``: all leading/trailing whitespace."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def btrim(x) -> Column:
    """SQL ``BTRIM(x)``: spaces only."""
    return F.btrim(_c(x), F.lit(" "))


def clean_str(x, backslash_n_null: bool = True) -> Column:
    """C-01: strip; empty (or ``\\N``) -> null."""
    s = strip_ws(x)
    out = F.when(s != "", s)
    if backslash_n_null:
        out = F.when(out != "\\N", out)
    return out


def sentinel_to_null(x, sentinels=SENTINELS) -> Column:
    """C-02: value in the placeholder set -> null (tested before trimming)."""
    c = _c(x)
    return F.when(~c.isin(list(sentinels)) | c.isNull(), c)


def trim_upper(x) -> Column:
    """C-03: ``UPPER(BTRIM(x))``."""
    return F.upper(btrim(x))


def clean_code(x, fixpoint: bool = False) -> Column:
    """C-02 then C-03, exactly one pass as the cleanup script runs it
    (``' na '`` becomes ``'NA'``); ``fixpoint=True`` repeats until stable,
    which takes two passes (``' na '`` becomes null)."""
    once = trim_upper(sentinel_to_null(x))
    return trim_upper(sentinel_to_null(once)) if fixpoint else once


def trim_blank_null(x) -> Column:
    """C-04: ``NULLIF(BTRIM(x), '')``."""
    t = btrim(x)
    return F.when(t != "", t)


def initcap_pg(x) -> Column:
    """C-05: PostgreSQL ``INITCAP``: upper-case the first letter of every run
    of letters/digits and lower-case the rest (``o'brien MARY-ANN`` ->
    ``O'Brien Mary-Ann``). Spark's ``initcap`` only starts words after a
    space, so a marker + space is inserted after every non-alphanumeric
    character, ``initcap`` runs, and the markers are removed."""
    marked = F.regexp_replace(_c(x), r"([^\p{L}\p{N}])", "$1\u0001 ")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def initcap_trim(x) -> Column:
    """C-05: ``INITCAP(BTRIM(x))``."""
    return initcap_pg(btrim(x))


def lower_trim(x) -> Column:
    """C-06: ``LOWER(BTRIM(x))``."""
    return F.lower(btrim(x))


def negative_to_null(x) -> Column:
    """C-07: value < 0 -> null (null stays null)."""
    c = _c(x)
    return F.when(c >= 0, c)


def clamp_min(x, lo=0) -> Column:
    """C-08: ``GREATEST(x, lo)``; null stays null."""
    c = _c(x)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))


def null_to_zero(x) -> Column:
    """C-08: null -> 0."""
    return F.coalesce(_c(x), F.lit(0))


def non_positive_to_null(x) -> Column:
    """C-08: value <= 0 -> null."""
    c = _c(x)
    return F.when(c > 0, c)


def clamp(x, lo, hi) -> Column:
    """C-08: ``min(max(x, lo), hi)`` (money clamp 80..900)."""
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


def fill_numeric_zero(x, target="double") -> Column:
    """C-11: coerce to a number (bad text -> null), then null and NaN -> 0."""
    v = _c(x).try_cast("double")
    return F.coalesce(F.when(~F.isnan(v), v).try_cast(target), F.lit(0).cast(target))


def zfill(x, width: int) -> Column:
    """Python ``str.zfill``: left-pad with zeros, never truncate (Spark's
    ``lpad`` truncates longer strings)."""
    s = _c(x).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def snapshot_id(year, month, airline, airport, sep: str = "-") -> Column:
    """C-12: ``YYYY-MM-AIR-APT`` key of a BTS row (loader form ``-``;
    the cleaning script's form uses ``_``). A null part makes a null key."""
    parts = [zfill(_c(year).cast("int"), 4), zfill(_c(month).cast("int"), 2), _c(airline), _c(airport)]
    return F.concat(*[x for p in parts for x in (F.lit(sep), p)][1:])


# Date forms besides ISO text, tried in this order.
DATE_FORMS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "yyyyMMdd")


def parse_timestamp_lenient(x, fmt: str | None = None) -> Column:
    """C-13: text -> timestamp, ISO or one of DATE_FORMS; unparseable -> null."""
    if fmt:
        return F.try_to_timestamp(_c(x), F.lit(fmt))
    eight = btrim(x).rlike("^[0-9]{8}$")   # ISO would take eight digits for a year
    forms = [F.try_to_timestamp(btrim(x), F.lit(f)) for f in DATE_FORMS]
    return F.coalesce(F.when(~eight, F.try_to_timestamp(_c(x))), *forms)


def parse_number_lenient(x, target="double") -> Column:
    """C-13: text -> number, unparseable -> null."""
    return _c(x).try_cast(target)


def map_status(cancelled, fallback: str = "Scheduled") -> Column:
    """C-14: 1 -> Cancelled, 0 -> Arrived, anything else -> fallback."""
    c = _c(cancelled)
    return F.when(c == 1, "Cancelled").when(c == 0, "Arrived").otherwise(F.lit(fallback))


def normalise_enum(x, domain, fallback: str) -> Column:
    """C-14: ``initcap(lower(x))`` if in the domain, else the fallback."""
    v = F.initcap(F.lower(btrim(x)))
    return F.when(v.isin(list(domain)), v).otherwise(F.lit(fallback))


def truncate_code(x, n: int) -> Column:
    """C-15: ``x[:n].upper()``."""
    return F.upper(F.substring(_c(x), 1, n))


def parse_coordinate(x) -> Column:
    """C-16: float text -> decimal(8,5), bad text -> null."""
    return _c(x).try_cast("double").try_cast("decimal(8,5)")


def first_non_blank(*cols) -> Column:
    """C-17: first argument that is non-blank after C-01 cleaning."""
    return F.coalesce(*[clean_str(c) for c in cols])


# Age bands of the customer generator (upper bounds exclusive).
AGE_BANDS = ((26, "18-25"), (36, "26-35"), (46, "36-45"), (61, "46-60"))
AGE_TOP_BAND = "60+"


def age_bucket(x) -> Column:
    """C-19: banding of a numeric column: < 26 -> 18-25, < 36 -> 26-35,
    < 46 -> 36-45, < 61 -> 46-60, else 60+ (null stays null)."""
    c = _c(x)
    out = None
    for hi, label in AGE_BANDS:
        out = F.when(c < hi, label) if out is None else out.when(c < hi, label)
    return out.when(c.isNotNull(), AGE_TOP_BAND)


def flight_number(code, number) -> Column:
    """C-20: carrier code + 4-digit zero-padded number (``AA0042``)."""
    return F.format_string("%s%04d", _c(code), _c(number).cast("int"))


def money(x) -> Column:
    """C-20: round to cents as decimal(10,2)."""
    return F.round(_c(x).cast("decimal(20,6)"), 2).cast("decimal(10,2)")


def actual_times(status, sched_dep, sched_arr, delay_minutes):
    """C-21: actual departure/arrival = scheduled + delay, except that
    cancelled and scheduled flights (status starting with ``cancel`` /
    ``sched``, any case) have no actual times."""
    st = F.lower(_c(status))
    d = F.make_dt_interval(F.lit(0), F.lit(0), F.coalesce(_c(delay_minutes), F.lit(0)))
    flown = ~(st.startswith("cancel") | st.startswith("sched"))
    return (F.when(flown, _c(sched_dep) + d).alias("actual_departure_utc"),
            F.when(flown, _c(sched_arr) + d).alias("actual_arrival_utc"))


def signed_miles(txn_type, miles) -> Column:
    """C-22: redeem/spend/debit transactions are negative, others positive."""
    t = F.lower(_c(txn_type))
    neg = t.contains("redeem") | t.contains("spend") | t.contains("debit")
    m = F.abs(_c(miles))
    return F.when(neg, -m).otherwise(m)


def normalise_headers(df):
    """C-09: lower-case and strip column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])
