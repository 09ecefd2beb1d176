from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c, trim: bool = True) -> Column:
    """Case-insensitive comparison key: lower-case, optionally trimmed."""
    lowered = F.lower(col_(c))
    return F.trim(lowered) if trim else lowered


def half_up_div(num, den, scale: int) -> Column:
    """``round(num / den, scale)`` on decimals, HALF_UP, null when den is 0."""
    return F.round(F.try_divide(col_(num), F.nullif(col_(den), F.lit(0))), scale)


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def ymd_text(ts, sep: str = "-", parts: int = 3) -> Column:
    """'yyyy-MM-dd' (or 'yyyy-MM' with parts=2) of a date or TIMESTAMP_NTZ,
    from its fields: independent of the session time zone."""
    c = col_(ts)
    pieces = [_pad(F.year(c), 4), _pad(F.month(c), 2), _pad(F.dayofmonth(c), 2)][:parts]
    out = [pieces[0]]
    for p in pieces[1:]:
        out += [F.lit(sep), p] if sep else [p]
    return F.concat(*out)


def iso_seconds(ts) -> Column:
    """'yyyy-MM-ddTHH:mm:ss' of a TIMESTAMP_NTZ (fraction dropped)."""
    c = col_(ts)
    return F.concat(ymd_text(c), F.lit("T"), _pad(F.hour(c), 2), F.lit(":"), _pad(F.minute(c), 2),
                    F.lit(":"), _pad(F.second(c), 2))


def day_start(ts) -> Column:
    """Midnight of the day of a TIMESTAMP_NTZ, as TIMESTAMP_NTZ."""
    return F.to_date(col_(ts)).cast("timestamp_ntz")


def ntz_lit(value) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal from a datetime (or ISO text),
    never shifted by the session time zone."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")
