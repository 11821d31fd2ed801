"""Text and number normalisation."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake import constants as K


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside higher-order functions an inlined expression would be evaluated for every element;
    binding it as a lambda variable keeps it at once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def filled(value: Column) -> Column:
    """``value``, or NULL when it is empty; computed once, also inside higher-order functions, where ``nullif`` computes it twice."""
    return let(value, lambda v: F.when(v != "", v))


def find(value: Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern``; NULL when there is none or when the group is empty."""
    return filled(F.regexp_extract(value, pattern, group))


def clean_text(value: Column) -> Column:
    """Collapse Unicode whitespace, trim, and turn nothing into NULL."""
    return filled(F.trim(F.regexp_replace(value, K.WHITESPACE, " ")))


def parse_int(value: Column) -> Column:
    """First integer; its digits may be grouped by spaces."""
    return F.regexp_replace(find(value, K.INTEGER), "[^0-9]", "").try_cast("long")


def to_decimal(number: Column) -> Column:
    """28 digits before the point and ten behind it; the text it came from stays beside it in records."""
    plain = F.translate(F.regexp_replace(number, K.WHITESPACE, ""), ",", ".")
    return plain.try_cast("decimal(38,10)")


def parse_decimal(value: Column) -> Column:
    """First decimal with either separator, optional minus and space-grouped digits."""
    return to_decimal(find(value, K.DECIMAL))


def label(text: Column, name: str) -> Column:
    """Value behind one of the known labels of a page text."""
    return clean_text(find(text, K.LABELS[name], 1))


def label_int(text: Column, name: str) -> Column:
    return label(text, name).try_cast("long")


def contains_any(folded: Column, words: Iterable[str]) -> Column:
    result = F.lit(False)
    for word in words:
        result = result | folded.contains(word)
    return result


def first_word(text: Column, words: Iterable[tuple[str, str]], default: str | None) -> Column:
    """Value of the first listed word that occurs anywhere in ``text``."""

    def ladder(folded: Column) -> Column:
        result = None
        for word, value in words:
            hit = folded.contains(word)
            result = F.when(hit, value) if result is None else result.when(hit, value)
        return result.otherwise(F.lit(default).cast("string"))

    return let(F.lower(text), ladder)


def kind(text: Column) -> Column:
    """vacancy before contest before order, else unknown."""
    return F.coalesce(first_word(text, K.KIND_WORDS, "unknown"), F.lit("unknown"))


def status(text: Column) -> Column:
    """executor selected before closed before open, else unknown."""
    return F.coalesce(first_word(text, K.STATUS_WORDS, "unknown"), F.lit("unknown"))


def published_text(text: Column) -> Column:
    """The date snippet of a card, by three patterns in order."""
    return clean_text(F.coalesce(*[find(text, p) for p in K.PUBLISHED_PATTERNS]))


def normalize_kind(value: Column) -> Column:
    """Alias in either language, or code, to a kind; NULL when it is not known."""
    entries = [F.lit(x) for pair in K.KIND_ALIASES.items() for x in pair]
    return F.element_at(F.create_map(*entries), F.lower(clean_text(value)))


def title_fields(title: Column, site: str) -> Column:
    """Name, id, role and place held in a profile page title."""

    def build(t: Column) -> Column:
        role = F.lit(None).cast("string")
        for start, name in reversed(K.TITLE_ROLES):
            role = F.when(F.lower(t).startswith(start), name).otherwise(role)
        return F.struct(
            clean_text(find(t, K.TITLE_PERSON, 1)).alias("name"),
            find(t, K.TITLE_PERSON, 2).try_cast("long").alias("user_id"),
            role.alias("role"),
            clean_text(find(t, K.TITLE_PLACE.replace("{site}", site), 1)).alias("location"),
        )

    return let(F.coalesce(clean_text(title), F.lit("")), build)


def split_place(value: Column) -> Column:
    """``name, place`` cut at the first comma."""
    has_comma = value.contains(",")
    return F.struct(
        F.when(has_comma, clean_text(F.regexp_extract(value, r"(?s)^([^,]*),", 1)))
        .otherwise(value).alias("name"),
        F.when(has_comma, clean_text(F.regexp_extract(value, r"(?s)^[^,]*,(.*)$", 1)))
        .alias("location"),
    )


def sentiment(text: Column) -> Column:
    """negative wins over positive; NULL when neither word occurs."""
    result = F.lit(None).cast("string")
    for pattern, name in reversed(K.SENTIMENTS):
        result = F.when(text.rlike(pattern), name).otherwise(result)
    return result


def review_counts(text: Column) -> Column:
    """Positive and negative review counters."""
    found = F.lit(None).cast("struct<positive:bigint,negative:bigint>")
    for pattern in reversed(K.REVIEW_COUNTS):
        found = F.when(
            text.rlike(pattern),
            F.struct(
                F.regexp_extract(text, pattern, 1).try_cast("long").alias("positive"),
                F.regexp_extract(text, pattern, 2).try_cast("long").alias("negative"),
            ),
        ).otherwise(found)
    return found


def longest(texts: Column) -> Column:
    """Longest text of an array, the first one among equals."""
    ranked = F.transform(
        texts, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("x"))
    )
    return F.array_max(ranked)["x"]
