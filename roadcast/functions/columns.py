"""Column expressions shared by the jobs.  All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0  # fixed value
METRES_PER_DEGREE_LON = 111320.0  # fixed value, at the equator
METRES_PER_DEGREE_LAT = 110540.0  # fixed value
SINGAPORE_SHIFT_S = 8 * 3600
BIN_SCALE = 200  # cells of 0.005 degrees

WEEKEND_DAYS = (0, 6)  # Sunday = 0
PEAK_HOURS = (7, 8, 9, 17, 18, 19)


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cell_of(value, size: int) -> Column:
    """Whole cells of ``size`` below an integer value (floor, also for negative values)."""
    value = _c(value)
    return F.call_function("div", value - F.pmod(value, F.lit(size)), F.lit(size))


def hour_of(ts, shift_s: int = 0) -> Column:
    return cell_of(F.pmod(_c(ts) + F.lit(shift_s), F.lit(86400)), 3600)


def dow_of(ts, shift_s: int = 0) -> Column:
    """Day of week with Sunday = 0."""
    return F.pmod(cell_of(_c(ts) + F.lit(shift_s), 86400) + F.lit(4), F.lit(7)).cast("bigint")


def midpoint(a, b) -> Column:
    return (_c(a) + _c(b)) / F.lit(2.0)


def space_bin(value, scale: int = BIN_SCALE) -> Column:
    return F.floor(_c(value) * F.lit(scale)).cast("double")


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def flat_m(lat1, lon1, lat2, lon2) -> Column:
    """Flat-earth distance, good at city scale."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dx = (lon2 - lon1) * METRES_PER_DEGREE_LON * F.cos(F.radians((lat1 + lat2) / 2.0))
    dy = (lat2 - lat1) * METRES_PER_DEGREE_LAT
    return F.sqrt(dx * dx + dy * dy)


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dx = (lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2.0))
    return F.pmod(F.degrees(F.atan2(dx, lat2 - lat1)) + 360.0, F.lit(360.0))


def bearing_diff(a, b, undirected: bool = False) -> Column:
    a, b = _c(a), _c(b)

    def one(x, y):
        d = F.pmod(F.abs(x - y), F.lit(360.0))
        return F.least(d, F.lit(360.0) - d)

    if not undirected:
        return one(a, b)
    return F.least(one(a, b), one(a, F.pmod(b + 180.0, F.lit(360.0))))


def in_daily_window(start, end, now) -> Column:
    """"HH:MM" window test, both ends included; a window with start > end goes over midnight."""
    start = F.coalesce(_c(start), F.lit("07:30"))
    end = F.coalesce(_c(end), F.lit("09:00"))
    now = _c(now)
    return F.when(start <= end, (start <= now) & (now <= end)).otherwise((now >= start) | (now <= end))


def clock(ts, shift_s: int = SINGAPORE_SHIFT_S) -> Column:
    """Epoch seconds to "HH:MM"."""
    ts = _c(ts)
    minute = cell_of(F.pmod(ts + F.lit(shift_s), F.lit(3600)), 60)
    return F.concat_ws(":", F.lpad(hour_of(ts, shift_s).cast("string"), 2, "0"), F.lpad(minute.cast("string"), 2, "0"))


def utc_seconds(col: str) -> Column:
    """Epoch seconds of a time written as text, whatever the session's zone: without a zone of its own it is UTC; NULL if unreadable."""
    text = F.trim(F.col(col))
    zoned = F.when(text.rlike(r":\d{2}(\.\d+)?\s*[A-Za-z+-]"), text)
    tries = [zoned, F.concat(text, F.lit("Z")), F.concat(text, F.lit("T00:00:00Z"))]
    return F.unix_seconds(F.coalesce(*[F.try_to_timestamp(t) for t in tries]))
