"""Operators against plain versions on small tables with nulls, ties, repeats, long texts and extra columns."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pagelake.llm import (
    chat, components, decontaminate, exact_dedup, extract, line_dedup, mixing, ngram_join, quality, toxicity, warc,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id string, bits string"


def docs(spark, rows):
    """Documents from (doc_id, text, source), with columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y") for i, t, s in rows], DOCS)


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def words(n, seed, alphabet="abcdefgh"):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n)]


# ---- 1 n-gram join -----------------------------------------------------------------------------


def plain_sets(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows):
    sets = [(i, plain_sets(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return sorted(((i, len(s), top(i)) for i, s in sets), key=repr)


def near_copies():
    rng = random.Random(5)
    rows, number = [], 0
    for group in range(12):
        base = words(rng.choice([3, 6, 20, 60, 300]), group)
        for _ in range(rng.choice([1, 2, 9, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((number, " ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy), f"s{number % 3}"))
            number += 1
    shared = " ".join(words(40, 99))
    for _ in range(30):
        rows.append((number, f"{shared} {' '.join(words(rng.choice([5, 9, 12]), number))}", "s0"))
        number += 1
    return [*rows, (number, None, "s1"), (number + 1, "", None), (number + 2, " \n\t", "s1"), (number + 3, "one", "s1"), (number + 4, "ONE ", "s2")]


@pytest.mark.parametrize("tile", [2_000, 4])
def test_ngram_join_is_exact(spark, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "CROWDED", 2)
    rows = near_copies()
    got = ngram_join.jaccard_components(docs(spark, rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_components(rows)


@pytest.mark.parametrize("crowded", [2, 8])
def test_ngram_join_returns_every_link(spark, monkeypatch, crowded):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    rows = near_copies()
    sets = {i: frozenset(plain_sets(t)) for i, t, _ in rows}
    similar = {(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y)}
    first = {s: min(i for i, x in sets.items() if x == s) for s in sets.values()}
    got = ngram_join.jaccard_links(docs(spark, rows))[1]
    assert rows_of(got, "a", "b") == sorted({p for p in similar if all(first[sets[i]] == i for i in p)}, key=repr)
    counts = Counter(i for p in similar for i in p)
    assert rows_of(ngram_join.link_counts(docs(spark, rows)), "doc_id", "n_links") == sorted(((i, counts[i]) for i in sets), key=repr)


def test_ngram_join_odd_rows(spark):
    table = docs(spark, [(None, "a b c d e f", "s"), (3, "a b c d e f", "s"), (3, "a b c d e f", "s"), (None, "q", "s")])
    got = rows_of(ngram_join.jaccard_components(table), "doc_id", "n_shingles", "component_id")
    assert got == sorted([(None, 2, 3), (3, 2, 3), (3, 2, 3), (None, 1, None)], key=repr)
    assert ngram_join.jaccard_components(docs(spark, [(1, "x", "s")]).limit(0)).count() == 0
    kept = ngram_join.one_of_each(docs(spark, [(1, "a b c d e", "s"), (2, "A b c d e", "s"), (4, None, "s"), (None, "z", "s")]))
    assert rows_of(kept, "doc_id") == sorted([(1,), (4,), (None,)], key=repr)
    assert kept.columns == table.columns


def test_bound_is_never_below_the_overlap():
    import numpy as np
    import pyarrow as pa

    texts = [" ".join(words(n, n)) for n in (5, 30, 64, 65, 300)] + [" ".join(words(300, 300)[:250])]
    keys, bounds = ngram_join.ngram_sets(pa.array(texts))
    bits = ngram_join.bitmaps(keys, bounds)
    for a in range(len(texts)):
        for b in range(len(texts)):
            x, y = keys[bounds[a]:bounds[a + 1]], keys[bounds[b]:bounds[b + 1]]
            common = len(np.intersect1d(x, y))
            assert ngram_join.overlap(x, y) == common
            assert ngram_join.bound(bits[a], len(x), bits[b], len(y)) >= common


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(rows_of(components.components(spark.createDataFrame(links, "a bigint, b bigint")), "id", "component"))
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}


# ---- 2 and 6 scoring -----------------------------------------------------------------------------


def labelled(spark, n=500):
    rng, texts, labels = random.Random(8), [], []
    for i in range(n):
        text, bad = words(rng.randint(20, 60), rng.randrange(10_000), "abcd"), i % 3 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["rotten", "vile"])
        texts.append((i, " ".join(text), "s"))
        labels.append((i, int(not bad), int(bad)))
    texts += [(n, None, "s"), (n + 1, "", "s"), (None, "x", None)]
    return docs(spark, texts), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")


def test_toxicity_on_held_out_texts(spark):
    table, labels = labelled(spark)
    got = toxicity.score(table, labels).collect()
    assert len(got) == 503 and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["doc_id"] % 3 == 0, r["predicted"] == 1) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 500]
    assert len(held) > 80 and sum(a == b for a, b in held) / len(held) > 0.97
    import zlib

    for r in got:
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == (r["score"] >= 0.3)


def test_toxicity_ignores_held_out_labels(spark):
    from pyspark.sql import functions as F

    from pagelake.llm.common import held_out

    table, labels = labelled(spark, 200)
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity.score(table, labels), "doc_id", "score") == rows_of(toxicity.score(table, turned), "doc_id", "score")


def test_toxicity_counts_all_labelled_texts(spark):
    from pyspark.sql import functions as F

    from pagelake.llm.common import held_out

    table, labels = labelled(spark, 300)
    known = toxicity.labelled_texts(labels, "toxic")
    free = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    assert known.count() == free.count() and known.filter("y = 0").count() > 1.5 * known.filter("y = 1").count()


def test_toxicity_stage_keeps_columns(spark):
    table, labels = labelled(spark)
    kept = toxicity.drop_toxic(table, labels)
    assert kept.columns == table.columns
    left = {r["doc_id"] for r in kept.collect()}
    assert sum(i in left for i in range(500) if i % 3) > 320 and sum(i in left for i in range(0, 500, 3)) < 8


def test_scores_without_labels(spark):
    table, labels = docs(spark, [(1, "a b", "s")]), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert rows_of(toxicity.score(table, labels), "score", "predicted") == [(0.0, 0)]
    assert rows_of(quality.score(table, labels), "score") == [(0.5,)]
    assert toxicity.score(table.limit(0), labels).count() == 0 == quality.score(table.limit(0), labels).count()


def test_quality_on_held_out_texts(spark):
    rng, texts, labels = random.Random(3), [], []
    for i in range(600):
        text, bad = words(rng.randint(10, 60), i), i % 4 == 0
        texts.append((i, "!! ".join(text).upper() if bad else " ".join(text), "s"))
        labels.append((i, int(not bad), 0))
    table = docs(spark, [*texts, (600, None, "s"), (601, "\n" * 5000 + "x " * 200_000, "s")])
    got = quality.score(table, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    held = [(r["doc_id"] % 4 != 0) == (r["predicted"] == 1) for r in got if r["held_out"] and r["doc_id"] < 600]
    assert len(got) == 602 and sum(held) / len(held) > 0.97


def test_statistics_of_known_text():
    import pyarrow as pa

    x = dict(zip(quality.NAMES, quality.statistics(pa.array(["Ab ab!\nAb 12", None]))[0], strict=True))
    assert x["upper"] == pytest.approx(2 / 12) and x["digit"] == pytest.approx(2 / 12) and x["bang"] == pytest.approx(1 / 12)
    assert x["distinct_words"] == pytest.approx(2 / 4) and x["top_word"] == pytest.approx(3 / 4)
    assert not quality.statistics(pa.array([None], pa.string()))[0][:14].any()


def test_flat_trees_equal_walking():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 6))
    y = ((x[:, 1] > 0.2) & (x[:, 3] < 1)).astype(float)
    trees = quality.grow(x, y)

    def walk(row):
        z = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.limit[node] else trees.right[node]
            z += trees.value[node]
        return 1 / (1 + np.exp(-z))

    assert np.allclose(trees.probability(x[:50]), [walk(r) for r in x[:50]])
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.97


# ---- 3 decontamination ---------------------------------------------------------------------------


def plain_hits(rows, items, window):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    grams = defaultdict(set)
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(str(item))
    out = []
    for doc_id, text, _ in rows:
        w, hit, found = split(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), ids, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block_words", "alphabet"), [(10_000, "abcdefgh"), (25, "ab"), (40, "abé")])
def test_decontamination_equals_plain_windows(spark, block_words, alphabet):
    rng = random.Random(4)
    items = [(i, " ".join(words(n, i, alphabet))) for i, n in enumerate([30, 12, 10, 9, 4, 3, 1, 0, 25])]
    items += [(20, items[0][1]), (21, None), (22, " ".join(items[0][1].split()[5:20])), (5, "so so so so so so so so so so so so")]
    rows = [(None, None, "s"), (1, "", "s"), (2, "so " * 40, None), (2, "so " * 40, None)]
    for i in range(3, 60):
        text = words(rng.randint(0, 80), 1000 + i, alphabet)
        for _ in range(rng.randint(0, 3)):
            w = (items[rng.randrange(len(items))][1] or "").split()
            a, b = sorted((rng.randint(0, len(w)), rng.randint(0, len(w))))
            at = rng.randint(0, len(text))
            text[at:at] = w[a:b]
        rows.append((i, rng.choice([" ", ", ", "\n-- "]).join(text).title(), "s"))
    got = decontaminate.contamination(docs(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"), 10, block_words)
    assert rows_of(got, *got.columns) == plain_hits(rows, items, 10)


def test_decontamination_cuts_passages(spark):
    item = " ".join(words(14, 1))
    table = docs(spark, [(1, f"Start here. {item.upper()}! End of it all, with more of the words than were cut away from it now.", "s"),
                         (2, item, "s"), (3, None, "s"), (4, "clean", None)])
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    two = items.union(spark.createDataFrame([(2, " ".join(words(14, 2)))], "item_id bigint, text string"))
    for kept in (decontaminate.decontaminate(table, items), decontaminate.decontaminate(table, two, block_words=14)):
        assert kept.columns == table.columns
        assert rows_of(kept, "doc_id", "text") == [
            (1, "Start here. ! End of it all, with more of the words than were cut away from it now."), (3, None), (4, "clean")]
    none = items.limit(0)
    assert decontaminate.contamination(table, none).filter("contaminated").count() == 0
    assert decontaminate.contamination(table.limit(0), items).count() == 0


# ---- 4 exact deduplication -----------------------------------------------------------------------


def test_exact_dedup_equals_plain_grouping(spark):
    rng = random.Random(2)
    pool = [None, "", " ", "a b", "a  b", "a\n\tb", "A b", "x" * 100_000, "é\u00a0é", "é é"]
    rows = [(i, rng.choice(pool), "s") for i in range(300)] + [(7, "a b", None), (7, "a b", None), (None, "only null", "s"), (None, "a b", "s")]
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, keep, len(ids), i == keep, digest) for i in ids]
    for runs in (1, 50):
        got = exact_dedup.exact_groups(docs(spark, rows), runs)
        assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.exact_groups(docs(spark, rows).limit(0)).count() == 0
    kept = exact_dedup.deduplicate(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    keep = {(i, t) for i, t, _ in rows if i in {w[1] for w in want}} | {(None, "only null")}
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} >= {k for k in keep if k[0] is not None and (k[0], k[1]) in {(i, t) for i, t, _ in rows}}


def test_exact_dedup_merges_sorted_runs(spark):
    rng = random.Random(4)
    table = docs(spark, [(i, rng.choice(["hot", f"t{rng.randrange(90)}"]), "s") for i in range(600)])
    rows = exact_dedup.digest_rows(table, 8)
    first = rows.groupBy(*exact_dedup.KEY, "run").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    level, entries = exact_dedup.sorted_runs(first, 5), first.count()
    for runs in (8, 4, 2, 1):
        found = level.collect()
        assert {r["run"] for r in found} <= set(range(runs)) and len({r["slice"] for r in found}) == 5
        for r in found:
            keys = [(e.digest, e.chars, e.check) for e in r["entries"]]
            # strictly ascending: in order, and each digest once
            assert all(a < b for a, b in zip(keys, keys[1:], strict=False))
            assert all(int(e.digest[:8], 16) * 5 // 2**32 == r["slice"] for e in r["entries"])
        total = [e for r in found for e in r["entries"]]
        assert sum(e.group_size for e in total) == 600 and len(total) <= entries
        entries = len(total)
        level = exact_dedup.merge_round(level)
    assert entries == len({r["text"] for r in table.collect()})
    found = exact_dedup.exact_groups(table, 8, 100)
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    # One order to make the runs, and one per round of merging them.
    assert plan.count("sort_array(") == 4 and "collect_list(entries" in plan and not re.search("Python|Arrow|MapIn", plan)


# ---- 5 WARC --------------------------------------------------------------------------------------

PAGES = [(5, "http://www.B.example.com:80/x?q=1#f", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, "https://b.example.com/x?q=1", "<p>é</p>\r\n\r\nWARC/1.1\r\n"),
         (3, None, None), (4, "http://a.example.org/with blank%20", ""), (6, "http://c.example.com/\n", "z" * 200_000), (7, "http://c.example.com/y", "z")]


def test_warc_round_trip(spark, tmp_path):
    table = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id bigint, url string, html string, offset string")
    got = {r["page_id"]: r for r in warc.captures(table, str(tmp_path / "a")).collect()}
    assert all(r["intact"] for r in got.values()) and len(got) == len(PAGES)
    for page_id, url, html in PAGES:
        payload, r = (html or "").encode(), got[page_id]
        assert (r["url"], r["payload_bytes"]) == (url, len(payload))
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {
        5: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3), 6: ("response", None), 7: ("response", None)}
    import glob
    import gzip

    whole = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/a/part-*"))
    assert whole.count(b"WARC-Record-ID") == len(PAGES)
    large = {r["page_id"]: r["record_type"] for r in warc.captures(table, str(tmp_path / "b"), least_bytes=5).collect()}
    assert large[4] == large[3] == "response" and large[5] == "revisit"
    assert warc.captures(table.limit(0), str(tmp_path / "c")).count() == 0


def test_warc_index_finds_every_capture(spark, tmp_path):
    pages = [(i, f"http://h{i % 7}.example.com/p{i % 50}", f"body {i}") for i in range(400)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    records = warc.captures(table, str(tmp_path / "w"))
    warc.build_index(records, str(tmp_path / "i"), parts=3, block_keys=16)
    asked = spark.createDataFrame([(u,) for u in {p[1] for p in pages}] + [("http://nowhere.example/",), (None,)], "url string")
    hits = warc.lookup(spark, asked, str(tmp_path / "i"))
    assert rows_of(hits, "url", "page_id") == sorted(((u, i) for i, u, _ in pages), key=repr)
    import zlib

    for r in warc.read_ranges(spark, hits.filter("page_id < 20"), str(tmp_path / "w")).collect():
        assert f"body {r['page_id']}".encode() in zlib.decompress(r["record"], 31)


@pytest.mark.parametrize("reachable", [True, False])
def test_warc_query_goes_through_the_index(spark, tmp_path, monkeypatch, reachable):
    if not reachable:
        monkeypatch.setattr(warc, "_reachable", lambda archives: False)
    pages = [*PAGES, (None, "http://a.example.org/x", "<i>"), (8, None, "none"), (9, "https://c.example.com/y", "other")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = warc.indexed_captures(table, str(tmp_path / "w"))
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "intact"]
    assert rows_of(got, *names) == rows_of(warc.captures(table, str(tmp_path / "plain")), *names)
    assert sum(r["n"] for r in spark.read.parquet(str(tmp_path / "w" / "index" / "blocks")).collect()) == len(pages)
    assert warc.indexed_captures(table.limit(0), str(tmp_path / "none")).count() == 0


def test_url_keys():
    assert warc.url_key("HTTP://user@www.Example.com:8080/a/b?c=D#x") == "com,example)/a/b?c=D"
    assert warc.url_key(None) == ")/" and warc.url_key("x.org?q") == "org,x)/?q"


# ---- 7 mixing ------------------------------------------------------------------------------------


def plain_targets(sizes, budget, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = budget * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        shares = {s: rest * weight[s] / sum(weight[o] for o in order if o not in full) for s in order if s not in full}
        over = {s for s, v in shares.items() if v > most * sizes[s] + 1e-9}
        if not over:
            return {**shares, **{s: most * sizes[s] for s in full}}
        full |= over


def test_mixing_meets_targets(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(0.7) * 5)), rng.choice(["a", "b", "é", "B", None, "hot", "hot", "hot"])) for i in range(700)]
    rows += [(1, None, "a"), (2, "", "b"), (None, "x y z", "a"), (None, "x y z", "a"), (8, "q", "empty"), (9, None, "nothing")]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes, 1.5, [3.0, 1.0, 2.0], 2.0)
    table = docs(spark, rows)
    got = mixing.mix(table).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(table.repartition(7)).collect()
    assert sorted((repr(r) for r in got)) == sorted(repr(r) for r in again)
    assert mixing.mix(table.limit(0)).count() == 0


def test_mixing_is_unbiased(spark):
    """Documents of one source are taken alike over many draws: the mean of copies is the rate."""
    rows = [(i, "w " * (1 + i % 9), "a" if i % 2 else "b") for i in range(3_000)]
    got = mixing.mix(docs(spark, rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[r["source"], r["size"]].append((r["copies"], r["target"] / r["source_size"]))
    for kept in by.values():
        assert sum(c for c, _ in kept) / len(kept) == pytest.approx(kept[0][1], abs=0.12)


def test_taking_copies(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(5)), "a" if i else "b") for i in range(9)]
    table = docs(spark, rows)
    plan = mixing.mix(table)
    want = sum(r["taken"] for r in plan.collect())
    texts = mixing.take(table, plan).collect()
    assert sum(len(r["text"].split()) for r in texts) == want


# ---- 8 main text ---------------------------------------------------------------------------------

ODD_PAGES = [
    (None, ""), ("", ""), ("<p>Only &amp; text &#233;", "Only & text é"), ("no markup", "no markup"),
    ("<nav><a href=x>Menu</a></nav><script>var a='<p>no</p>'</script><article><h1>Title</h1><p>First  one.<p>Second<br>line.</article><footer>f</footer>",
     "Title\nFirst one.\nSecond line."),
    ("<main><p>Er.</p><aside>no</aside><form><p>no</p></form><div class='cookie-notice'>no</div><p>To.</p></main>", "Er.\nTo."),
    ("<div class=page><div id=sideBar><p>The side of the page is not for you and not in the text of it at all, as it is.</p></div>"
     "<p>The text of the page is in the middle of it, and that is what we are to have with all of its words.</p><p>Short.</p>"
     "<section class=\"comments\"><p>The first comment is of no use to you and it is not for us to have it in the text.</p></section></div>",
     "The text of the page is in the middle of it, and that is what we are to have with all of its words.\nShort."),
    ("<article><p>a < b &lt;b&gt; <!-- <p>x</p> --> c</p><table><tr><td>1<td>2</table><ul><li>i<li>j</ul></article>",
     "a < b <b> c\n1\n2\ni\nj"),
    ("<article><p>" + "x" * 300_000 + "</p></article>", "x" * 300_000),
    ("<article><p>one</p><div style='display:none'>no</div><p hidden>no</p><p>two</p></article", "one\ntwo"),
]


def test_main_text(spark):
    for html, want in ODD_PAGES:
        assert extract.main_text(html) == want
    table = spark.createDataFrame([(i, None, h, "x") for i, (h, _) in enumerate(ODD_PAGES)], "page_id bigint, url string, html string, text string")
    got = extract.extract(table)
    assert rows_of(got, "page_id", "url", "text", "n_chars") == sorted(((i, None, t, len(t)) for i, (_, t) in enumerate(ODD_PAGES)), key=repr)
    assert extract.extract(table.limit(0)).count() == 0


def test_open_blocks_follow_neighbours():
    good = "The cat of the house and the dog of the yard are in the garden with all of us, as it was. " * 3
    bad = "Buy now cheap offers " * 20
    page = f"<div><p>{good}</p><p>Near the good.</p><p>Still.</p><p>Far.</p><p>{bad}</p><p>Near the bad.</p></div>"
    assert extract.main_text(page).split("\n")[1:] == ["Near the good.", "Still."]


# ---- 9 line dedup --------------------------------------------------------------------------------


def plain_lines(rows, min_sites, min_words):
    norm = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")
    sites, first = defaultdict(set), {}
    for i, t, s in rows:
        for line in map(norm, (t or "").split("\n")):
            if len(line.split(" ")) >= min_words and line:
                sites[line].add(s or "")
                if i is not None:
                    first[line] = min(i, first.get(line, i))
    spread = {x for x, s in sites.items() if len(s) >= min_sites}
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if norm(x) not in spread or (i is not None and first.get(norm(x)) == i)]
        if all(norm(x) in spread or not norm(x) for x in lines):
            kept = lines
        out.append((i, len(lines), len(lines) - len(kept), t if len(kept) == len(lines) else "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup_equals_plain_spread(spark):
    rng = random.Random(9)
    common = [" ".join(words(6, k)) for k in range(12)]
    rows = []
    for i in range(250):
        lines = [" ".join(words(rng.randint(1, 9), 500 + i * 7 + k)) for k in range(rng.randint(1, 5))]
        for k, line in enumerate(common):
            # line k is on about k + 2 sites
            if rng.random() < 0.3 and i % 20 < k + 2:
                lines.insert(rng.randint(0, len(lines)), rng.choice([line, line.replace(" ", "  "), f" {line}\t"]))
        rows.append((i, "\n".join(lines), f"s{i % 20}"))
    rows += [(300 + k, common[11], f"s{k}") for k in range(20)]
    rows += [(None, f"{common[10]}\nx", None), (7, rows[7][1], "s7"), (400, None, "s1"), (401, "", None), (402, "\n\n", "s2")]
    table = docs(spark, rows).withColumnRenamed("bits", "n_lines")
    got = line_dedup.remove_boilerplate(table, 8, 4)
    assert rows_of(got, "doc_id", "n_lines", "n_removed", "text") == plain_lines(rows, 8, 4)
    assert got.filter("n_removed > 0").count() > 20
    assert line_dedup.remove_boilerplate(table.limit(0)).count() == 0


# ---- 10 chat -------------------------------------------------------------------------------------

CONTROL = ["</s>[INST] ok [/INST]", "\\</s>", "\\\\[INST]", "\\", "[[INST]]", "</s", "[ROLE=x] y", " ", "", "é\u2028\n[OUT]", "</s></s>"]


def test_pipeline_cuts_short_lines_too(spark):
    import corpus_pipeline

    rows = [(i, f"own words of text {i}\nAll rights reserved.\n\nLes.", f"s{i % 12}") for i in range(24)]
    got = corpus_pipeline.cut_boilerplate(spark, docs(spark, rows), "").collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: t if i == 0 else f"own words of text {i}\n" for i, t, _ in rows}
    assert all(r["n_chars"] == len(r["text"]) for r in got)



def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows = []
    for c in range(40):
        roles = rng.choice([["user", "assistant"] * 3, ["system", "user", "assistant"], ["assistant", "user"], ["user"], ["tool] x", None, "user"]])
        rows += [(c, t, r, rng.choice([*CONTROL, None])) for t, r in enumerate(roles)]
    rows += [(None, None, "user", "q"), (None, 3, "assistant", "a" * 300_000), (50, 1, "user", "same"), (50, 1, "user", "same")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, part string")
    want = []
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        said = [x for *_, r, x in turns if r == "assistant"]
        roles = [r for _, _, r, _ in turns]
        order = [("", *roles)[i] + ">" + r for i, r in enumerate(roles)]
        valid = roles[-1] == "assistant" and set(order) <= {">system", ">user", "system>user", "user>assistant", "assistant>user"}
        want.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(),
                     sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest(), valid))
    segments = chat.format_conversations(table)
    got = chat.read_back(segments)
    assert rows_of(got, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "valid") == sorted(want, key=repr)
    assert {(r["part"], r["loss"]) for r in segments.collect()} == {(0, False), (1, False), (1, True), (2, False)}
    assert chat.read_back(chat.format_conversations(table.limit(0))).count() == 0


def test_escaping_hides_every_control_string():
    control = chat._control(chat.TEMPLATE)
    for text in CONTROL:
        hidden = chat.escape(text, control)
        assert chat.unescape(hidden, control) == text
        for m in control.finditer(hidden):
            assert m[1]


# ---- identifiers that are texts ------------------------------------------------------------------


def test_text_identifiers_in_joins_and_mixes(spark):
    named = [(f"d{i:03d}", t, s) for i, (_, t, s) in enumerate(near_copies())]
    table = spark.createDataFrame([(i, t, "en", s, 0, "x", "y") for i, t, s in named], DOCS.replace("doc_id bigint", "doc_id string"))
    assert rows_of(ngram_join.jaccard_components(table), "doc_id", "n_shingles", "component_id") == plain_components(named)
    assert ngram_join.link_counts(table).count() == len(named)
    mixed = mixing.mix(table).collect()
    assert sorted(r["doc_id"] for r in mixed) == sorted(i for i, _, _ in named)
