"""Repeatable ids and time-zone free time arithmetic.

Ids are ``md5`` of the content identity (never a random UUID), so a replayed
step writes to the same place and changes nothing.  Timestamps are
``timestamp_ntz`` throughout; arithmetic on them never depends on the session
time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = _dt.datetime(1970, 1, 1)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal.  Built from text: a Python ``datetime``
    literal would be read as local time and shifted by the session zone."""
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_ntz() -> Column:
    return ntz_literal(EPOCH)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz``.

    Computed from the day-time interval ``ts - epoch``, which involves no
    zone (``timestamp_diff`` would cast to the session zone and be off by
    the DST shift)."""
    iv = _col(ts) - epoch_ntz()
    part = lambda unit: F.extract(F.lit(unit), iv).cast("long")
    return ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")) * 60_000_000 + \
        (F.extract(F.lit("SECOND"), iv) * 1_000_000).cast("long")


def from_epoch_seconds(secs) -> Column:
    """``timestamp_ntz`` that lies ``secs`` seconds after 1970-01-01."""
    return F.timestamp_add("SECOND", _col(secs), epoch_ntz())


def age_micros(ts, as_of) -> Column:
    """``as_of - ts`` in microseconds."""
    return epoch_micros(as_of_col(as_of)) - epoch_micros(ts)


def as_of_col(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return ntz_literal(as_of)


def content_id(*parts) -> Column:
    """``md5`` over ``#``-joined parts."""
    return F.md5(F.concat_ws("#", *[_col(p).cast("string") for p in parts]))
