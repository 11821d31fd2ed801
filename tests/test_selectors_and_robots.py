"""Selectors against a plain matcher, robots rules against a walk over lines, and pages of many rows."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pagelake.functions.urls import split_base
from pagelake.operators import dom, generic, robots, selectors


# ---- selectors -----------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "a >", "> a", "a:hover", "a[", "a,,b", "a + b", "a[b=c d]", "1a", "a b >"])
def test_what_is_outside_the_subset_is_refused(text):
    with pytest.raises(ValueError, match="cannot read the selector"):
        selectors.css(text)


def test_where_single_elements_are_judged_ancestors_are_refused():
    assert selectors.css("a.b, c[d]").plain and not selectors.css("a b").plain
    with pytest.raises(ValueError, match="without ancestors"):
        selectors.test_of("a b")


def random_page(rng):
    made, open_tags = [], []
    for i in range(rng.randint(5, 40)):
        while open_tags and rng.random() < 0.4:
            made.append(f"</{open_tags.pop()}>")
        tag = rng.choice(["div", "section", "span"])
        attrs = "".join(rng.sample([' class="x big"', ' id="one"', ' data-a="Alpha beta"', ' title=""', ' data-a="beta"', ' class="y"'], rng.randint(0, 2)))
        made.append(f"<{tag}{attrs}>{i}")
        open_tags.append(tag)
    return "".join(made) + "".join(f"</{t}>" for t in reversed(open_tags))


TESTS = {
    "div": lambda n: n.tag == "div", ".x": lambda n: " x " in (n.cls or ""), "span.big#one": lambda n: n.tag == "span" and " big " in (n.cls or "") and n.attrs.get("id") == "one",
    "[title]": lambda n: "title" in n.attrs, "[data-a='beta']": lambda n: n.attrs.get("data-a") == "beta", "[data-a~=beta]": lambda n: "beta" in n.attrs.get("data-a", "").split(),
    "[data-a^='ALP' i]": lambda n: n.attrs.get("data-a", "").lower().startswith("alp"), "[data-a$=\"ta\"]": lambda n: n.attrs.get("data-a", "").endswith("ta"),
    "[data-a*=' b']": lambda n: " b" in n.attrs.get("data-a", ""), "[title^='']": lambda n: False, "*": lambda n: True,
}


def plain_select(nodes, chains):
    """Elements in document order that some chain of (test, is child) matches."""
    def matches(n, chain):
        (test, tight), rest = chain[-1], chain[:-1]
        if not TESTS[test](n):
            return False
        if not rest:
            return True
        above = [o for o in nodes if (o.pre == n.parent if tight else o.pre < n.pre <= o.last)]
        return any(matches(o, rest) for o in above)

    return [n.pre for n in nodes if any(matches(n, c) for c in chains)]


def test_selectors_match_a_plain_matcher(spark):
    rng = random.Random(11)
    pages = spark.createDataFrame([(i, random_page(rng)) for i in range(15)], "k int, html string")
    wanted = []
    for _ in range(25):
        chains = [[(rng.choice(list(TESTS)), k > 0 and rng.random() < 0.4) for k in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 2))]
        text = ", ".join("".join((" > " if tight else " " if k else "") + t for k, (t, tight) in enumerate(c)) for c in chains)
        wanted.append((text, chains))
    parsed = dom.parse_html(pages)
    got = parsed.select("k", "nodes", *(F.transform(dom.select(F.col("nodes"), t), lambda n: n["pre"]).alias(f"c{i}") for i, (t, _) in enumerate(wanted))).collect()
    hits = 0
    for row in got:
        for i, (text, chains) in enumerate(wanted):
            assert row[f"c{i}"] == plain_select(row.nodes, chains), text
            hits += len(row[f"c{i}"])
    assert hits > 300


# ---- robots --------------------------------------------------------------------------------------


def plain_rules(text):
    agents, in_rules, rules = [], False, []
    for raw in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        if raw.strip(" ") == "":
            if in_rules:
                agents = []
            in_rules = False
            continue
        line = raw.split("#")[0].strip(" ")
        if ":" not in line:
            continue
        key, value = (x.strip(" ") for x in line.split(":", 1))
        key = key.lower()
        if key == "user-agent":
            agents = [value.lower().split("/")[0]] if in_rules else [*agents, value.lower().split("/")[0]]
            in_rules = False
        elif key in ("allow", "disallow", "crawl-delay", "request-rate") and agents:
            in_rules = True
            if key in ("allow", "disallow"):
                rules.append((agents, len(rules), key == "allow" or value == "", value))
    return rules


def test_robots_rules_match_a_walk_over_lines(spark):
    rng = random.Random(2)
    lines = ["User-agent: A/1", "user-agent: b", "User-Agent: *", "Disallow: /x", "Allow: /y # why", "Disallow:", "Crawl-delay: 3", "", "  ", "Sitemap: z", "# only", "Disallow: /%D0%B0"]
    files = [(f"h{i}", rng.choice(["\n", "\r\n", "\r"]).join(rng.choices(lines, k=rng.randint(0, 25)))) for i in range(120)]
    got = robots.robots_rules(spark.createDataFrame(files, "host string, text string")).collect()
    for row in got:
        assert [(r.agents, r.ord, r.allow, r.prefix) for r in row.rules] == plain_rules(dict(files)[row.host])
    assert robots.robots_rules(spark.createDataFrame([("h", None)], "host string, text string")).first().rules is None


def seconds(df):
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def test_fifty_thousand_rules_of_one_host(spark):
    text = "\n".join(["User-agent: *", *(f"Disallow: /p{i}" for i in range(50_000))])
    found = robots.robots_rules(spark.createDataFrame([("h", text)], "host string, text string"))
    assert found.select(F.size("rules").alias("n")).first().n == 50_000
    assert seconds(found) < 30


# ---- many rows on a page -------------------------------------------------------------------------


def test_nested_tables_and_lists(spark):
    html = ("<table><tr><td>a<table><tr><th>h</th></tr><tr><td></td><td>in</td></tr></table></td></tr><tr></tr></table>"
            "<ul><li>1<ol><li>2</li></ol></li><li> </li><li>3</li></ul><ul></ul>")
    parsed = dom.parse_html(spark.createDataFrame([(html,)], "html string"))
    row = parsed.select(generic.tables(F.col("nodes"), F.col("texts")).alias("t"), generic.lists(F.col("nodes"), F.col("texts")).alias("l")).first()
    # Rows of the inner table are rows of the outer one too.
    assert [(t.headers, t.rows) for t in row.t] == [(["a h in", "h", "", "in"], [["h"], ["", "in"]]), (["h"], [["", "in"]])]
    assert row.l == [["1 2", "3"], ["2"]]


def test_twenty_thousand_rows_items_and_links_of_one_page(spark):
    n = 20_000
    html = ("<table><tr><th>k</th><th>v</th></tr>" + "".join(f"<tr><td>{i}</td><td>v{i}</td></tr>" for i in range(n)) + "</table><ul>"
            + "".join(f"<li><a href='/{i % (n // 2)}'>{i}</a></li>" for i in range(n)) + "</ul>")
    parsed = dom.parse_html(spark.createDataFrame([(html, "https://e.org/")], "html string, url string"), keep=["url"])
    nodes, texts = F.col("nodes"), F.col("texts")
    tables, lists = generic.tables(nodes, texts), generic.lists(nodes, texts)
    links = generic.links(nodes, texts, split_base(F.col("url")))
    found = parsed.select(tables.alias("t"), lists.alias("l"), links.alias("k"))
    row = found.first()
    assert (len(row.t[0].rows), row.t[0].rows[-1], len(row.l[0]), len(row.k)) == (n, [str(n - 1), f"v{n - 1}"], n, n // 2)
    assert [k.text for k in row.k[:3]] == ["0", "1", "2"] and seconds(found) < 30
