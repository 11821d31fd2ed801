"""Money texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.functions.text import clean_text, find, let, to_decimal


def parse_money(value: Column) -> Column:
    """Amounts, currency and the two "no fixed price" flags of a budget text.

    The currency is decided by presence (RUB, then USD, then EUR).  Amounts are looked for only up
    to the last currency mark, because cards append counters and durations after the price.
    """

    def build(raw: Column) -> Column:
        return let(F.lower(raw), lambda folded: fields(raw, folded))

    def fields(raw: Column, folded: Column) -> Column:
        currency = (
            F.when(raw.contains("₽") | folded.contains("руб"), "RUB")
            .when(raw.contains("$") | folded.contains("usd"), "USD")
            .when(raw.contains("€") | folded.contains("eur"), "EUR")
        )
        priced = F.coalesce(find(raw, K.UP_TO_LAST_CURRENCY, 1), raw)
        amounts = F.regexp_extract_all(priced, F.lit(K.AMOUNT), F.lit(0))
        return let(
            amounts,
            lambda a: F.when(
                raw.isNotNull(),
                F.struct(
                    to_decimal(F.get(a, F.lit(0))).alias("amount_min"),
                    to_decimal(F.coalesce(F.get(a, F.lit(1)), F.get(a, F.lit(0)))).alias("amount_max"),
                    currency.alias("currency"),
                    folded.contains(K.NEGOTIABLE_WORD).alias("negotiable"),
                    folded.contains(K.INTERVIEW_WORD).alias("interview_based"),
                    raw.alias("raw"),
                ),
            ),
        )

    return let(clean_text(value), build)


def representative_amount(money: Column) -> Column:
    """One amount for a range: the minimum, or the maximum when the minimum is zero or missing."""
    low, high = money["amount_min"], money["amount_max"]
    return F.when(low.eqNullSafe(high), low).when(low != 0, low).otherwise(high)
