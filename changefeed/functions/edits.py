"""Column expressions over one edit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted edit types, and the years 0000 to 9999 in epoch seconds.
EDIT_TYPES = ("edit", "new", "categorize", "log")
FIRST_SECOND = -62167219200
LAST_SECOND = 253402300799


def event_time(seconds: Column) -> Column:
    """Epoch seconds to a timestamp; a value no calendar holds gives null, not a failed job."""
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def wrapped_int(value: Column) -> Column:
    """A 64-bit value as a 32-bit one with wrap-around, so one absurd record cannot fail the job."""
    return (F.pmod(value + 2**31, F.lit(2**32)) - 2**31).cast("int")


def byte_delta(old_length: Column, new_length: Column) -> Column:
    """Size change; a page without an old length counts whole."""
    size = [F.coalesce(length, F.lit(0)).cast("bigint") for length in (new_length, old_length)]
    return wrapped_int(size[0] - size[1])


def reject_reason(
    wiki: Column, title: Column, user: Column, seconds: Column, kind: Column, lossless: bool = False
) -> Column:
    """First rule an edit breaks, or null.

    A null type breaks no rule (`NOT IN` is unknown), nor does a time that no calendar holds,
    unless `lossless` asks for it.
    """
    reason = (
        F.when(wiki.isNull(), "missing_wiki")
        .when(title.isNull(), "missing_title")
        .when(user.isNull(), "missing_user")
        .when(seconds.isNull(), "missing_timestamp")
    )
    if lossless:
        reason = reason.when(event_time(seconds).isNull(), "bad_timestamp").when(kind.isNull(), "missing_type")
    return reason.when(~kind.isin(*EDIT_TYPES), "unknown_type")


def bot_share(bot_edits: Column, edits: Column) -> Column:
    """Percentage of bot edits, rounded half up to two places in decimal arithmetic."""
    return F.round(F.lit(100.0).cast("decimal(4,1)") * bot_edits / edits, 2).cast("double")


def utc_text(moment: Column) -> Column:
    """`2024-01-01 00:00:07`: an instant's UTC wall time, whatever the session's zone; fraction only when there is one."""
    seconds = (F.unix_micros(moment).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (epoch + F.make_dt_interval(secs=seconds)).cast("string")


def wire_timestamp(moment: Column) -> Column:
    """`2024-01-01 00:00:07Z`."""
    return F.concat(utc_text(moment), F.lit("Z"))

