"""Epoch numbers, Beijing wall-clock text and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone of every local stamp in the feeds and the two text patterns they use.
LOCAL_ZONE = "Asia/Shanghai"
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
MINUTE_PATTERN = "yyyy-MM-dd HH:mm"


def _unit(unit: str | None) -> str:
    return (unit or "").upper()


# The seconds of years 1 to 9999. Beyond them Spark cannot hold or print an instant.
MIN_SECOND, MAX_SECOND = -62_135_596_800, 253_402_300_799


def _instant(epoch: Column, unit: str) -> Column:
    """The instant of an epoch number; NULL where it is out of range, which would otherwise end the job."""
    scale = 1000 if _unit(unit) == "MS" else 1
    fits = epoch.between(F.lit((MIN_SECOND + 86_400) * scale), F.lit((MAX_SECOND - 86_400) * scale))
    safe = F.when(fits, epoch)
    return F.timestamp_millis(safe) if scale == 1000 else F.timestamp_seconds(safe)


def local_time(epoch: Column | str, unit: str = "s") -> Column:
    """Beijing wall clock (TIMESTAMP_NTZ, whole seconds) of an epoch number."""
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    instant = _instant(epoch, unit)
    # The two-argument form reads the instant in the session zone, so any session zone gives the same result.
    return F.date_trunc("second", F.convert_timezone(None, F.lit(LOCAL_ZONE), instant)).cast("timestamp_ntz")


def epoch_to_bj(epoch: Column | str, unit: str = "s", pattern: str = SECOND_PATTERN) -> Column:
    """Beijing text of an epoch in seconds (``s``) or milliseconds (``ms``); any other unit gives ''."""
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    if _unit(unit) not in ("S", "MS"):
        return F.lit("")
    return F.date_format(F.convert_timezone(None, F.lit(LOCAL_ZONE), _instant(epoch, unit)), pattern)


def wall_clock_to_epoch_ms(wall: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ that is Beijing wall clock."""
    in_session_zone = F.convert_timezone(F.lit(LOCAL_ZONE), F.current_timezone(), wall)
    return F.unix_millis(in_session_zone.cast("timestamp"))


def bj_to_epoch(text: Column | str, unit: str = "s", pattern: str = SECOND_PATTERN) -> Column:
    """Epoch number of Beijing text; NULL when the text does not fit, 0 for an unknown unit."""
    text = F.col(text) if isinstance(text, str) else text
    if _unit(unit) not in ("S", "MS"):
        return F.lit(0).cast("bigint")
    wall = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    millis = wall_clock_to_epoch_ms(wall)
    return millis if _unit(unit) == "MS" else F.floor(millis / F.lit(1000)).cast("bigint")


def as_of_ms(fixed: int | None = None) -> Column:
    """Run time in epoch ms, cut to the whole second; pass ``fixed`` for a repeatable run."""
    if fixed is not None:
        return F.lit(fixed).cast("bigint")
    return (F.unix_seconds(F.current_timestamp()) * F.lit(1000)).cast("bigint")


def date_head(text: Column | str, separator: str = " ") -> Column:
    """DATE from the part of the text before ``separator`` (a space or ``T``); NULL when it is no date."""
    text = F.col(text) if isinstance(text, str) else text
    return F.substring_index(text, separator, 1).try_cast("date")
