"""Epoch and window arithmetic on columns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F

# An epoch above this is in milliseconds; default window lengths.
MILLIS_ABOVE = 1e10
OBSERVATION = timedelta(days=5)
CHURN_PERIOD = timedelta(days=10)

MICROS_PER_HOUR = 3_600_000_000


def epoch_unit(epoch: Column) -> Column:
    """``milliseconds`` when the number is too large to be seconds, else ``seconds``."""
    return F.when(epoch.isNull(), None).when(epoch > MILLIS_ABOVE, "milliseconds").otherwise("seconds")


def epoch_micros(epoch: Column) -> Column:
    """Microseconds since the epoch; the fraction of the input is kept."""
    number = epoch.cast("double")
    per_unit = F.when(number > MILLIS_ABOVE, F.lit(1_000.0)).otherwise(F.lit(1_000_000.0))
    return F.rint(number * per_unit).cast("bigint")


def epoch_to_timestamp(epoch: Column) -> Column:
    return F.timestamp_micros(epoch_micros(epoch))


def epoch_convert(epoch: Column, target: str) -> Column:
    """Timestamp, whole seconds or whole milliseconds, cut off and not rounded."""
    if target == "datetime":
        return epoch_to_timestamp(epoch)
    if target == "seconds":
        divisor = 1_000_000
    elif target == "milliseconds":
        divisor = 1_000
    else:
        raise ValueError(f"unsupported target: {target}")
    micros = epoch_micros(epoch)
    return ((micros - micros % divisor) / divisor).cast("bigint")


def format_time(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(ts, pattern)


def iso_time(ts: Column) -> Column:
    """ISO text with a ``T``; microseconds are shown only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def interval(length: timedelta) -> Column:
    return F.make_dt_interval(
        F.lit(length.days),
        F.lit(0),
        F.lit(0),
        F.lit(length.seconds + length.microseconds / 1e6).cast("decimal(18,6)"),
    )


def window_bounds(
    start: Column, observation: timedelta = OBSERVATION, churn: timedelta = CHURN_PERIOD
) -> dict[str, Column]:
    """The four ends of the observation and churn windows that begin at ``start``."""
    op_end = start + interval(observation)
    return {
        "op_start": start,
        "op_end": op_end,
        "cp_start": op_end,
        "cp_end": start + interval(observation + churn),
    }


def within_period(ts: Column, start: Column, end: Column) -> Column:
    """Closed at both ends."""
    return ts.between(start, end)


def micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def micros_of(length: timedelta) -> int:
    return round(length.total_seconds() * 1_000_000)
