"""Filters, traversal and de-duplication of extracted listing pages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.operators.runs import first_per_key, last_per_key


def normalize_kinds(kinds: str | Iterable[str] | None) -> frozenset[str]:
    """Aliases in either language, or codes, to kinds; an unknown name is an error."""
    if kinds is None:
        return frozenset()
    names = (kinds,) if isinstance(kinds, str) else kinds
    result = set()
    for name in names:
        found = K.KIND_ALIASES.get(name.strip().casefold())
        if found is None:
            raise ValueError(f"unknown type {name!r}; expected one of: {', '.join(K.KINDS)}")
        result.add(found)
    return frozenset(result)


@dataclass(frozen=True)
class ItemFilter:
    """Row filter over items.

    Kinds are compared exactly.  Budgets use overlap: a range matches when any amount of it lies in
    the asked range.
    """

    query: str | None = None
    category: str | None = None
    min_budget: Decimal | int | None = None
    max_budget: Decimal | int | None = None
    kinds: frozenset[str] = field(default_factory=frozenset)
    with_budget: bool | None = None

    def kind_condition(self) -> Column:
        return F.col("kind").isin(*sorted(self.kinds)) if self.kinds else F.lit(True)

    def condition(self) -> Column:
        low, high = F.col("budget.amount_min"), F.col("budget.amount_max")
        result = self.kind_condition()
        if self.query:
            words = F.concat_ws(" ", "title", "description")
            result = result & F.lower(words).contains(self.query.lower())
        if self.category:
            result = result & (
                (F.col("category") == self.category) | (F.col("subcategory") == self.category)
            )
        if self.min_budget is not None:
            result = result & (high >= F.lit(Decimal(self.min_budget)))
        if self.max_budget is not None:
            result = result & (low <= F.lit(Decimal(self.max_budget)))
        if self.with_budget is not None:
            has = low.isNotNull()
            result = result & (has if self.with_budget else ~has)
        return result


def item_filter(types: str | Iterable[str] | None = None, **rest) -> ItemFilter:
    """Filter of the ``projects`` verb: orders only unless types are named; ``[]`` keeps every type."""
    kinds = frozenset({"order"}) if types is None else normalize_kinds(types)
    return ItemFilter(kinds=kinds, **rest)


def page_limit(pages: int | str) -> int | None:
    """``"all"`` or a positive page count."""
    if pages == "all":
        return None
    if isinstance(pages, bool) or not isinstance(pages, int) or pages <= 0:
        raise ValueError('pages must be a positive integer or "all"')
    return pages


def start_of(page: int) -> int:
    if isinstance(page, bool) or not isinstance(page, int) or page <= 0:
        raise ValueError("start_page must be positive")
    return page


def filter_cards(pages: DataFrame, kinds: Iterable[str] = ()) -> DataFrame:
    """Apply the type filter inside listing pages and note what it did.

    Adds ``filtered_count``, ``all_unknown`` (the filter cannot be trusted) and the
    ``filtered_empty`` warning.
    """
    wanted = sorted(kinds)
    if not wanted:
        return pages.select(
            "*", F.col("parsed_count").alias("filtered_count"), F.lit(False).alias("all_unknown")
        )
    kept = F.filter("cards", lambda c: c["kind"].isin(*wanted))
    emptied = (F.col("parsed_count") > 0) & (F.size(kept) == 0)
    return pages.select(
        *[c for c in pages.columns if c not in ("cards", "warnings")],
        kept.alias("cards"),
        F.size(kept).alias("filtered_count"),
        ((F.col("parsed_count") > 0) & (F.col("unknown_kind_count") == F.col("parsed_count"))).alias("all_unknown"),
        F.when(emptied, F.array_append("warnings", F.lit("filtered_empty")))
        .otherwise(F.col("warnings")).alias("warnings"),
    )


def traversal_cut(
    pages: DataFrame,
    max_pages: int | None = None,
    start_page: int = 1,
    crawl_key: str | None = None,
    failed: Column | None = None,
    batch_size: int | None = None,
) -> DataFrame:
    """Pages a crawl would visit: up to the first without a next page, at most ``max_pages``.

    With ``failed`` and ``batch_size`` a failed page ends the crawl at the end of its batch (failed
    pages are left out, later pages of the same batch are kept).
    """
    start = start_of(start_page)
    visited = pages.filter(F.col("page") >= start)
    if max_pages is not None:
        visited = visited.filter(F.col("page") < start + max_pages)
    bad = F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False)
    end = F.min(F.when(~F.col("has_next") & ~bad, F.col("page")))
    if failed is not None:
        size = batch_size or 1
        batch = F.floor((F.col("page") - start) / size)
        end = F.least(end, (F.min(F.when(bad, batch)) + 1) * size + start - 1)
    if crawl_key is None:
        # A single crawl ends at a single number, which stays a subquery of the plan.
        last = visited.agg(end.alias("last")).scalar()
        return visited.filter(~bad & (last.isNull() | (F.col("page") <= last)))
    ends = visited.groupBy(crawl_key).agg(end.alias("__end"))
    return (
        visited.join(ends.withColumnRenamed(crawl_key, "__crawl"), F.col(crawl_key).eqNullSafe(F.col("__crawl")))
        .filter(~bad & (F.col("__end").isNull() | (F.col("page") <= F.col("__end"))))
        .select(*pages.columns)
    )


def dedupe_items(
    items: DataFrame, key: str = "id", order: Sequence[str] = ("page", "pos"), crawl_key: str | None = None
) -> DataFrame:
    """First occurrence of each id in crawl order; of each crawl, if the table holds several."""
    return first_per_key(items, F.struct(crawl_key, key) if crawl_key else F.col(key), order)


def dedupe_people(
    people: DataFrame, order: Sequence[str] = ("page", "pos"), crawl_key: str | None = None
) -> DataFrame:
    """First occurrence of each person (of each crawl): by user name, else link, else name."""
    key = F.coalesce(
        F.nullif("username", F.lit("")), F.nullif("url", F.lit("")), F.col("name"), F.lit("")
    )
    return first_per_key(people, F.struct(crawl_key, key) if crawl_key else key, order)


def last_page_wins(items: DataFrame, keys: Sequence[str] = ("username", "id")) -> DataFrame:
    """Items of a user's pages: the last page's version of an id, at the place it first appeared."""
    placed = items.select("*", F.col("page").alias("first_page"), F.col("pos").alias("first_pos"))
    payload = F.struct(*[F.col(c) for c in items.columns])
    return (
        placed.groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        .agg(
            F.max_by(payload, F.struct("page", "pos")).alias("__row"),
            F.min(F.struct("page", "pos")).alias("__first"),
        )
        .select("__row.*", F.col("__first.page").alias("first_page"), F.col("__first.pos").alias("first_pos"))
    )


def distinct_categories(links: DataFrame, crawl_key: str | None = None) -> DataFrame:
    """Categories behind category links, the first link per URL (of each crawl); needs ``url, name, ord``."""
    slug = F.nullif(F.regexp_extract("url", K.CATEGORY_SLUG, 1), F.lit(""))
    named = links.filter(F.col("url").contains(K.CATEGORY_HREF) & F.col("name").isNotNull())
    keys = [crawl_key] if crawl_key else []
    return first_per_key(named.select(*keys, "name", "url", "ord"), F.struct(*keys, "url"), ["ord"]).select(
        *keys, "name", "url", "ord",
        slug.alias("slug"),
        F.when(slug.contains("/"), F.substring_index(slug, "/", 1)).alias("parent"),
    )


def frontier(sizes: DataFrame, first: str, count: str) -> DataFrame:
    """Page numbers to visit: ``count`` numbers from ``first`` on, one row each."""
    numbers = F.when(F.col(count) > 0, F.sequence(F.col(first), F.col(first) + F.col(count) - 1))
    return sizes.withColumn("page", F.explode(numbers))


__all__ = [
    "ItemFilter", "dedupe_items", "dedupe_people", "distinct_categories", "filter_cards", "frontier",
    "item_filter", "last_page_wins", "last_per_key", "normalize_kinds", "page_limit", "start_of",
    "traversal_cut",
]
