"""Dates and times held as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .shapes import col

OUT_TIME = "yyyy-MM-dd HH:mm:ss"
OUT_DATE = "yyyy-MM-dd"


def wall_clock(c, to_utc: bool = False) -> Column:
    """Text time as `yyyy-MM-dd HH:mm:ss`: the offset is dropped (or, with ``to_utc``, applied), the
    fraction is dropped, text that is not a time stays as it is, blank becomes null."""
    s = col(c)
    t = F.trim(s)
    if to_utc:
        utc = F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(t).cast("timestamp_ntz"))
        return F.when(s != "", F.coalesce(F.date_format(utc, OUT_TIME), s))
    bare = F.regexp_replace(t, r"(?<=\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)\s*(?:Z|[+-]\d{2}:?\d{2})$", "")
    bare = F.regexp_replace(bare, r"^(\d{4}-\d{2}-\d{2})(?:Z|\+\d{2}:?\d{2})$", "$1")
    shaped = bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?)?$")
    plain = F.regexp_replace(F.regexp_replace(bare, r"\.\d+$", ""), "T", " ")
    parsed = F.when(shaped, F.coalesce(
        F.try_to_timestamp(plain, F.lit("yyyy-M-d H:m:s")), F.try_to_timestamp(plain, F.lit("yyyy-M-d"))))
    return F.when(s != "", F.coalesce(F.date_format(parsed, OUT_TIME), s))


def day(c) -> Column:
    """First ten characters as a date; kept as they are when they are no date; blank becomes null."""
    s = col(c)
    head = F.left(s, F.lit(10))
    parsed = F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"),
                    F.to_date(F.try_to_timestamp(head, F.lit("yyyy-M-d"))))
    return F.when(s != "", F.coalesce(F.date_format(parsed, OUT_DATE), head))


def iso_text(c) -> Column:
    """A timestamp column as ISO text; text passes through, blank becomes null."""
    return F.nullif(col(c).cast("string"), F.lit(""))
