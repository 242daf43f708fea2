"""Column-expression builders (scalar functions, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pushback import profile as P


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_hhmm(c: str | Column) -> Column:
    """B1: hour of an HHMM integer (``x // 100``)."""
    return F.floor(col(c) / 100).cast("int")


def hhmm_of_minutes(m: Column) -> Column:
    """Minutes after midnight (any integer) to HHMM within one day."""
    mm = F.pmod(m, F.lit(1440))
    return (F.floor(mm / 60) * 100 + mm % 60).cast("int")


def arrival_day(day: str | Column, dep_hour: str | Column,
                scheduled_minutes: str | Column) -> Column:
    """B2: day + (dep_hour*60 + duration) // 1440; null duration keeps the day."""
    shifted = col(day) + F.floor((col(dep_hour) * 60 + col(scheduled_minutes)) / 1440)
    return F.coalesce(shifted.cast("int"), col(day).cast("int"))


def local_hour_ts(year, month, day, hour) -> Column:
    """Local date-hour as TIMESTAMP_NTZ; an impossible date gives NULL."""
    return F.try_make_timestamp_ntz(col(year), col(month), col(day), col(hour),
                                    F.lit(0), F.lit(0))


def to_eastern(ts: Column, tz: Column, target: str = P.EASTERN_TZ) -> Column:
    """Local wall time in ``tz`` to wall time in ``target``.

    When source and target zone are the same the time is returned unchanged
    (a conversion would move a non-existent DST-gap hour forward).
    """
    return F.when(tz == F.lit(target), ts).otherwise(
        F.convert_timezone(tz, F.lit(target), ts))


def is_all_digits(c: str | Column) -> Column:
    return col(c).rlike("^[0-9]+$")


def delay_category(delay: str | Column, cancelled: str | Column) -> Column:
    """Cancelled first, then <=15 on_time, <=45 minor, >45 major; null delay -> null."""
    d = col(delay)
    return (F.when(col(cancelled) == 1, F.lit("cancelled"))
            .when(d.isNull(), F.lit(None).cast("string"))
            .when(d <= P.ON_TIME_MAX_DELAY, F.lit("on_time"))
            .when(d <= P.MINOR_DELAY_MAX_DELAY, F.lit("minor_delay"))
            .otherwise(F.lit("major_delay")))


def label_ordinal(label: str | Column, order=None) -> Column:
    """Class label to 0..k-1 in the fixed class order."""
    order = order or P.CLASS_ORDER
    expr = None
    for i, name in enumerate(order):
        expr = (F.when(col(label) == name, F.lit(i)) if expr is None
                else expr.when(col(label) == name, F.lit(i)))
    return expr.cast("int")


def departure_bank(hour: str | Column) -> Column:
    """Hour bins [0,6,10,14,18,22,24) closed left; out of range -> NULL."""
    h = col(hour)
    b, names = P.DEPARTURE_BANK_BOUNDS, P.DEPARTURE_BANK_LABELS
    expr = None
    for lo, hi, name in zip(b[:-1], b[1:], names):
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def departure_bank_code(bank: str | Column) -> Column:
    """Bank label to 0..5."""
    return label_ordinal(bank, P.DEPARTURE_BANK_LABELS)


def null_safe_flag(cond: Column) -> Column:
    """A comparison with NULL counts as false (pandas semantics)."""
    return F.coalesce(cond, F.lit(False)).cast("double")


def weather_intensity(prefix: str = "") -> Column:
    """0..4 count of severe-weather conditions."""
    t = P.WEATHER_INTENSITY_THRESHOLDS
    precip = ((F.col(f"{prefix}precipitation_mm") >= t["precipitation_mm"])
              | (F.col(f"{prefix}rain_mm") >= t["rain_mm"]))
    snow = F.col(f"{prefix}snowfall_cm") > t["snowfall_cm"]
    wind = ((F.col(f"{prefix}wind_speed_kmh") >= t["wind_speed_kmh"])
            | (F.col(f"{prefix}wind_gusts_kmh") >= t["wind_gusts_kmh"]))
    cold = F.col(f"{prefix}temperature_c") <= P.FREEZING_C
    return (null_safe_flag(precip) + null_safe_flag(snow) + null_safe_flag(wind)
            + null_safe_flag(cold))


def joined_key(*parts: str | Column) -> Column:
    """``a_b``; NULL in any part gives NULL (unlike concat_ws)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("_"))
        cols.append(col(p).cast("string"))
    return F.concat(*cols)
