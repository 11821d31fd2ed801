"""Robots rules: text to ordered rules, and the allow decision for a table of URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.text import let
from pagelake.functions.urls import host, path, query


#: Lines that a run of agent names ends at.
RULE_KEYS = ("allow", "disallow", "crawl-delay", "request-rate")


def decoded(value: Column) -> Column:
    """A path with its percent escapes resolved, so that both ways of writing it compare equal."""
    strict = F.regexp_replace(F.replace(value, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(strict), value)


def robots_rules(files: DataFrame) -> DataFrame:
    """Ordered rules of each host: ``host, rules`` with ``agents, ord, allow, prefix, match`` per rule.

    ``files`` holds ``host`` and the robots ``text`` of that host.  A group is a run of user-agent
    lines followed by rules; ``Crawl-delay`` and ``Request-rate`` close that run like rules do, and a
    blank line ends the group.
    """
    lines = F.filter(
        F.transform(
            F.split(F.regexp_replace(F.col("text"), r"\r\n?", "\n"), "\n", -1),
            lambda raw: let(
                F.trim(F.regexp_replace(raw, r"(?s)#.*$", "")),
                lambda line: F.struct(
                    F.when(F.trim(raw) == "", "blank")
                    .otherwise(F.lower(F.trim(F.regexp_extract(line, r"^([^:]*):", 1)))).alias("key"),
                    F.trim(F.regexp_extract(line, r"^[^:]*:(.*)$", 1)).alias("value"),
                ),
            ),
        ),
        lambda l: l["key"].isin("blank", "user-agent", *RULE_KEYS),
    )
    return files.select("host", let(lines, _rules).alias("rules"))


def _rules(lines: Column) -> Column:
    """The rules of a file from its significant lines.

    Blank lines aside, lines form sections of agent names and of rules; a blank line between two rules starts a new
    section too. A section of rules that follows one of agents belongs to them; any other belongs to no one. Sections
    are found from each line's neighbours, so the work grows with the lines.
    """
    marked = F.filter(
        F.transform(lines, lambda l, i: F.struct(
            (l["key"] == "user-agent").alias("agent"), l["key"].alias("key"), l["value"].alias("value"),
            F.coalesce(F.get(lines, i - 1)["key"] == "blank", F.lit(False)).alias("apart"))),
        lambda l: l["key"] != "blank",
    )

    def sections(found: Column) -> Column:
        def begins(l: Column, i: Column) -> Column:
            return (i == 0) | (F.get(found, i - 1)["agent"] != l["agent"]) | (~l["agent"] & l["apart"])

        starts = F.filter(F.transform(found, lambda l, i: F.when(begins(l, i), i)), lambda i: i.isNotNull())
        return let(starts, lambda at: F.transform(at, lambda i, k: F.slice(
            found, i + 1, F.coalesce(F.get(at, k + 1), F.size(found)) - i)))

    def rule(l: Column, names: Column) -> Column:
        # A rule without a path allows everything.
        return F.struct(
            names.alias("agents"), ((l["key"] == "allow") | (l["value"] == "")).alias("allow"),
            l["value"].alias("prefix"), decoded(l["value"]).alias("match"))

    def of_section(section: Column, before: Column) -> Column:
        names = F.transform(before, lambda l: F.lower(F.split(l["value"], "/")[0]))
        return let(names, lambda n: F.transform(F.filter(section, lambda l: l["key"].isin("allow", "disallow")), lambda l: rule(l, n)))

    def rules(found: Column) -> Column:
        own = F.transform(found, lambda section, k: F.when(
            ~F.get(section, F.lit(0))["agent"] & F.coalesce(F.get(F.get(found, k - 1), F.lit(0))["agent"], F.lit(False)),
            of_section(section, F.get(found, k - 1))))
        return F.transform(F.flatten(F.filter(own, lambda r: r.isNotNull())), lambda r, i: F.struct(
            r["agents"].alias("agents"), i.alias("ord"), r["allow"].alias("allow"), r["prefix"].alias("prefix"), r["match"].alias("match")))

    return let(let(marked, sections), rules)


def rule_rows(rules: DataFrame) -> DataFrame:
    """One row per (host, agent, ord, allow, prefix)."""
    return rules.select("host", F.explode("rules").alias("r")).select(
        "host", F.explode("r.agents").alias("agent"), "r.ord", "r.allow", "r.prefix"
    )


def robots_allowed(
    urls: DataFrame, rules: DataFrame, agent: str, url: str = "url", fail_closed: bool = False
) -> DataFrame:
    """Add ``allowed``: the first matching rule decides, no match allows.

    The rules of a host are one row, so the join adds no rows to a hot host.  Groups that name the
    agent are asked first, then ``*``; a host without rules is allowed unless ``fail_closed``.
    """
    name = agent.lower().split("/")[0]
    target = F.concat(
        F.when(path(F.col(url)) == "", "/").otherwise(path(F.col(url))),
        F.when(query(F.col(url)) != "", F.concat(F.lit("?"), query(F.col(url)))).otherwise(""),
    )
    hosted = urls.withColumn("__host", host(F.col(url))).withColumn("__target", decoded(target))
    joined = hosted.join(rules.select(F.col("host").alias("__host"), "rules"), "__host", "left")

    def for_agent(r: Column) -> Column:
        return F.exists(r["agents"], lambda a: (a != "*") & F.lit(name).contains(a))

    def for_all(r: Column) -> Column:
        return F.array_contains(r["agents"], "*")

    named = F.filter("rules", for_agent)
    group = let(named, lambda n: F.when(F.size(n) > 0, n).otherwise(F.filter("rules", for_all)))
    hit = F.get(
        F.filter(group, lambda r: F.col("__target").startswith(r["match"]) | (r["prefix"] == "*")), F.lit(0)
    )
    allowed = F.when(F.col("rules").isNull(), F.lit(not fail_closed)).otherwise(
        F.coalesce(hit["allow"], F.lit(True))
    )
    return joined.withColumn("allowed", allowed).drop("__host", "__target", "rules")


__all__ = ["robots_allowed", "robots_rules", "rule_rows"]
