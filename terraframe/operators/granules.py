"""Choosing satellite granules from a manifest table.

A manifest has a granule ``name``, its rectangle ``minx, miny, maxx, maxy`` and a
``date``.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box

DATE_FORMAT = "%Y.%m.%d"


def parse_interval(text: str) -> tuple[date, date]:
    """Both ends of ``yyyy.mm.dd..yyyy.mm.dd``."""
    ends = text.split("..")
    if len(ends) != 2:
        raise ValueError(f"an interval looks like 2018.01.01..2018.01.07, got {text!r}")
    first, last = (datetime.strptime(e, DATE_FORMAT).date() for e in ends)
    if last < first:
        raise ValueError(f"the interval {text!r} ends before it starts")
    return first, last


def select_granules(manifest: DataFrame, rect: str | Box, time: str) -> DataFrame:
    """Granules that meet a rectangle ``w,s,e,n`` on a date of the interval (ends included)."""
    box = Box.parse(rect) if isinstance(rect, str) else rect
    first, last = parse_interval(time)
    return manifest.where(
        F.col("date").between(F.lit(first), F.lit(last))
        & (F.col("minx") <= box.maxx) & (F.col("maxx") >= box.minx)
        & (F.col("miny") <= box.maxy) & (F.col("maxy") >= box.miny)
    )


def missing_granules(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Wanted granules whose name is not there yet: what a rerun still has to fetch."""
    return wanted.join(present.select("name"), "name", "left_anti")
