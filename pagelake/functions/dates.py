"""Dates in page text and in response headers.

All arithmetic is done on the local wall clock of the parser's time zone (a timestamp whose UTC
rendering is the local time), then turned back into an instant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.functions.text import clean_text, find, let


def _month(name: Column, names: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in names]), name)


def _midnight_plus_clock(day: Column, folded: Column) -> Column:
    hour = F.coalesce(find(folded, K.CLOCK, 1).try_cast("int"), F.lit(0))
    minute = F.coalesce(find(folded, K.CLOCK, 2).try_cast("int"), F.lit(0))
    return F.try_make_timestamp(
        F.year(day), F.month(day), F.dayofmonth(day), hour, minute, F.lit(0)
    )


def parse_ru_datetime(value: Column, now: Column, timezone: str = K.DEFAULT_TIMEZONE) -> Column:
    """Instant named by a Russian date text, seen at ``now``; NULL when there is none."""

    def build(b: Column) -> Column:
        folded, local = b["folded"], b["local"]
        month = _month(F.regexp_extract(folded, K.ABSOLUTE_DATE, 2), K.MONTHS_GENITIVE)

        def absolute(d: Column) -> Column:
            def at(year: Column) -> Column:
                return F.try_make_timestamp(
                    year, d["month"], d["day"], d["hour"], d["minute"], F.lit(0)
                )

            this_year = at(F.coalesce(d["year"], F.year(local)))
            ahead = d["year"].isNull() & (
                this_year > local + F.make_dt_interval(F.lit(31), F.lit(0), F.lit(0), F.lit(0))
            )
            return F.when(ahead, at(F.year(local) - 1)).otherwise(this_year)

        parts = F.struct(
            month.cast("int").alias("month"),
            find(folded, K.ABSOLUTE_DATE, 1).try_cast("int").alias("day"),
            find(folded, K.ABSOLUTE_DATE, 3).try_cast("int").alias("year"),
            F.coalesce(find(folded, K.ABSOLUTE_DATE, 4).try_cast("int"), F.lit(0)).alias("hour"),
            F.coalesce(find(folded, K.ABSOLUTE_DATE, 5).try_cast("int"), F.lit(0)).alias("minute"),
        )

        unit = find(folded, K.RELATIVE_DATE, 2)
        seconds = F.lit(None).cast("long")
        for start, size in K.SECONDS_PER_UNIT:
            seconds = F.when(unit.startswith(start), F.lit(size).cast("long")).otherwise(seconds)
        count = find(folded, K.RELATIVE_DATE, 1).try_cast("long")
        micros = F.try_subtract(
            F.unix_micros(local), F.try_multiply(count * seconds, F.lit(1_000_000).cast("long"))
        )
        # Anything before year 1 is no date.
        relative = F.when(micros > -62_135_596_800_000_000, F.timestamp_micros(micros))

        wall = (
            F.when(folded.startswith(K.TODAY_WORD), _midnight_plus_clock(local, folded))
            .when(
                folded.startswith(K.YESTERDAY_WORD),
                _midnight_plus_clock(F.date_sub(local.cast("date"), 1), folded),
            )
            .when(month > 0, let(parts, absolute))
            .otherwise(relative)
        )
        return F.to_utc_timestamp(wall, timezone)

    bound = F.struct(
        F.lower(clean_text(value)).alias("folded"),
        F.from_utc_timestamp(now, timezone).alias("local"),
    )
    return let(bound, build)


HTTP_DATE = r"(\d{1,2})[ -]([A-Za-z]{3})[a-z]*[ -](\d{4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+([+-]\d{4}))?"


def parse_http_date(value: Column) -> Column:
    """Instant of an HTTP ``Date`` header (GMT unless a numeric offset is given)."""
    month = _month(F.lower(F.regexp_extract(value, HTTP_DATE, 2)), K.MONTHS_ENGLISH)
    wall = F.try_make_timestamp(
        find(value, HTTP_DATE, 3).try_cast("int"),
        F.nullif(month, F.lit(0)).cast("int"),
        find(value, HTTP_DATE, 1).try_cast("int"),
        find(value, HTTP_DATE, 4).try_cast("int"),
        find(value, HTTP_DATE, 5).try_cast("int"),
        F.coalesce(find(value, HTTP_DATE, 6).try_cast("int"), F.lit(0)),
    )
    zone = F.coalesce(find(value, HTTP_DATE, 7), F.lit("+0000"))
    minutes = F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int")
    shift = F.when(zone.startswith("-"), -minutes).otherwise(minutes)
    return wall - F.make_dt_interval(F.lit(0), F.lit(0), shift, F.lit(0))


def response_time(date_header: Column, fallback: Column) -> Column:
    """When a page was fetched: its ``Date`` header, else the time it was stored."""
    return F.coalesce(parse_http_date(date_header), fallback)


def parse_retry_after(value: Column, now: Column) -> Column:
    """Seconds to wait: a number or a date, never negative; NULL when it is neither."""
    number = F.when(~value.rlike(r"(?i)[df]\s*$"), value.try_cast("double"))
    until = (F.unix_micros(parse_http_date(value)) - F.unix_micros(now)) / 1_000_000
    seconds = F.coalesce(number, until)
    return F.when(seconds.isNotNull(), F.greatest(seconds, F.lit(0.0)))
