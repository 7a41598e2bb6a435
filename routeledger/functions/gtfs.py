"""Scalar rules for timetable text cells. A cell that breaks a rule gives NULL, never a repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"^[\s\x1c-\x1f\x85\p{Z}]*$"
_EDGE_BLANK = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def is_blank(c: Column) -> Column:
    """True for a cell of Unicode blanks only (ideographic space included)."""
    return c.rlike(_BLANK)


def strip(c: Column) -> Column:
    """Remove Unicode blanks at both ends."""
    return F.regexp_replace(c, _EDGE_BLANK, "")


def gtfs_date(c: Column) -> Column:
    """Eight ASCII digits that name a real day, as DATE."""
    well_formed = c.rlike("^[0-9]{8}$") & ~c.startswith("0000")
    iso = F.concat_ws("-", c.substr(1, 4), c.substr(5, 2), c.substr(7, 2))
    return F.when(well_formed, iso.try_cast("date"))


def gtfs_seconds(c: Column) -> Column:
    """``H:MM:SS`` with one to three hour digits, as seconds after the service day starts."""
    colon = F.instr(c, ":")
    # cut by place: splitting by a pattern costs several times as much a row
    hours, minutes, seconds = (
        F.substr(c, F.lit(1), colon - 1), F.substr(c, colon + 1, F.lit(2)), F.substr(c, colon + 4, F.lit(2)))
    seconds = hours.cast("int") * 3600 + minutes.cast("int") * 60 + seconds.cast("int")
    return F.when(c.rlike("^[0-9]{1,3}:[0-5][0-9]:[0-5][0-9]$"), seconds)


def positive_int(c: Column) -> Column:
    """ASCII digits naming a number above zero."""
    n = F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))
    return F.when(n > 0, n)


def weekday_mask(flags: list[Column]) -> Column:
    """Seven '0'/'1' cells, Monday first, packed into one INT (bit 0 = Monday)."""
    mask = F.lit(0)
    for bit, flag in enumerate(flags):
        mask = mask + F.when(flag == "1", 1 << bit).otherwise(0)
    return mask.cast("int")
