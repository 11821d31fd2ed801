"""Centroid clustering, spelling variants and vector neighbours against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pagelake.llm import centroids, spelling, vector_join

VECTORS = "vec_id bigint, embedding array<float>, label int, node string, cluster string, dims int"


def frame(spark, rows, schema=VECTORS):
    """Embeddings, with columns whose names operators use inside."""
    return spark.createDataFrame([(i, v, 0, "x", "y", 7) for i, v in rows], schema)


# ---- 11 centroid clustering -------------------------------------------------------------------


def plain_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        middle = [[sum(x) // len(own[n]) for x in zip(*own[n], strict=True)] if own[n] else c for n, c in enumerate(middle)]
    placed = [(i, *near(v)) for i, v in kept]
    of = Counter()
    for _, d, n in placed:
        of[n] += d
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted([(i, n, d, of[n], sum(of.values()), marks[n]) for i, d, n in placed], key=repr)


def some_vectors(n, dims, seed, grain=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(rng.choice([-1, 1]), 0.5) for _ in range(dims)]
        rows.append((i, [round(x * grain) / grain for x in v] if grain else v))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * dims, [1.0] * (dims - 1), [None] + [1.0] * (dims - 1), [nan] + [1.0] * (dims - 1), [inf] + [1.0] * (dims - 1)]
    rows += [(n + j, v) for j, v in enumerate(odd)]
    return rows + [(None, rows[0][1]), (3, rows[5][1]), (3, rows[5][1]), (3, rows[6][1])]


NAMES = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@pytest.mark.parametrize("grain, most", [(None, centroids.MOST_ENTRIES), (1, centroids.MOST_ENTRIES), (2, 10)])
def test_clusters_match_a_plain_version(spark, grain, most):
    rows = some_vectors(150, 16, 3, grain)
    got = centroids.clusters(frame(spark, rows), k=5, rounds=4, dims=16, most_entries=most)
    assert sorted((tuple(r[n] for n in NAMES) for r in got.collect()), key=repr) == plain_clusters(rows, 5, 4, 16)


def test_wide_blocks_only_where_their_dictionaries_pay(spark):
    many, few = (centroids.integer_vectors(frame(spark, some_vectors(400, 16, 1, g)).filter("vec_id < 400"), 16) for g in (None, 1))
    two = frame(spark, [(i, [float(i % 2)] * 16) for i in range(400)])
    assert [centroids._width(v, 400, 16, 10**6) for v in (many, few)] == [1, 2]
    assert centroids._width(centroids.integer_vectors(two, 16), 400, 16, 10**6) == 8


def test_ties_go_to_the_smaller_centroid_and_empty_ones_stay(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(40)]
    got = centroids.clusters(frame(spark, rows)).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in got), key=repr) == plain_clusters(rows)
    assert len({r.cluster for r in got}) == 2


def test_clusters_of_few_or_no_rows(spark):
    rows = some_vectors(3, 64, 9)
    got = centroids.clusters(frame(spark, rows[:3]))
    assert sorted((tuple(r[n] for n in NAMES) for r in got.collect()), key=repr) == plain_clusters(rows[:3])
    empty = centroids.clusters(frame(spark, [(1, None)]))
    assert empty.count() == 0 and tuple(empty.columns) == NAMES
    with pytest.raises(ValueError):
        centroids.clusters(frame(spark, [(1, [1e30] * 64)]))


# ---- 12 spelling variants ---------------------------------------------------------------------


def plain_words(rows, every):
    counts = Counter()
    for i, text in rows:
        run = ""
        for c in (text or "") + "\0":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                word = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
                mark = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
                if mark % every == 0:
                    at = mark % len(word)
                    word = word[:at] + word[at + 1:]
                counts[word] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, every):
    words, form, near = plain_words(rows, every), {}, {}
    for w, n in words.items():
        others = [o for o in words if is_near(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted([(w, form[w], root(w), n, near[w], words.get(form[w])) for w, n in words.items()], key=repr)


def misspelt(seed):
    rng = random.Random(seed)
    base = ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abcabcabc", "Éclairs", "éclairs", "letters", "lettres", "straße", "Strasse"]
    base += ["".join(rng.choices("abÿ", k=rng.randint(6, 8))) for _ in range(12)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(40):
            w = base[min(int(rng.expovariate(0.25)), len(base) - 1)]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abz") + w[at:], w[:at] + rng.choice("abz") + w[at + 1:]])
            text.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice(" \n-1").join(text)))
    long_word = "".join(rng.choices("xyz", k=6000))
    rows += [(None, "letters " * 7), (None, None), (61, ""), (62, "short five"), (7, rows[7][1]), (7, rows[7][1])]
    return rows + [(63, f"{long_word} " * 5 + f"{long_word}q " * 30)]


WORDS = "doc_id bigint, text string, word string, rank string, n string"


@pytest.mark.parametrize("every, in_range", [(199, 20_000), (3, 7), (5, 1)])
def test_variants_match_a_plain_version(spark, every, in_range):
    rows = misspelt(every)
    df = spark.createDataFrame([(i, t, "w", "r", "n") for i, t in rows], WORDS)
    got = spelling.variants(df, every=every, in_range=in_range).collect()
    names = ("word", "form", "root", "n", "n_near", "form_n")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == plain_variants(rows, every)


def test_variants_of_an_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], WORDS)).count() == 0


@pytest.mark.parametrize("in_range", [3, 1000])
def test_trie_nodes_name_prefixes(spark, in_range):
    rng = random.Random(in_range)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 7))) for _ in range(300)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = spelling.trie_nodes(df, df["word"], len(words), in_range).collect()
    names = {(r.word[:i], node) for r in got for i, node in enumerate(r.nodes)}
    assert len(names) == len({p for p, _ in names}) == len({n for _, n in names})
    assert [r.word for r in sorted(got, key=lambda r: r["rank"])] == words
    assert sorted(r["rank"] for r in got) == list(range(len(words)))


def test_chains_are_followed_to_the_last(spark):
    steps = spark.createDataFrame([(i, i + 1) for i in range(25)] + [(100, 7), (200, 201)], "rank bigint, form bigint")
    assert dict(map(tuple, spelling.roots(steps).collect())) == {**{i: 25 for i in range(25)}, 100: 25, 200: 201}


# ---- 13 vector neighbours ---------------------------------------------------------------------


def plain_neighbours(rows, threshold):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, np.float32).astype(np.float64)
    n, parent = Counter(), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]):
                x, y = good[a], good[b]
                if (x == y).all() or x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    parent[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted([(i, n[k], least.get(top(k)), i == least.get(top(k))) for k, (i, _) in enumerate(rows)], key=repr)


def near_groups(dims, seed, wide=0.15):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(25):
        middle = rng.standard_normal(dims)
        for _ in range(rng.integers(1, 6)):
            rows.append(((middle + wide * rng.standard_normal(dims)) * rng.uniform(0.1, 9)).tolist())
    hot = rng.standard_normal(dims)
    rows += [(hot + rng.uniform(0, 0.5) * rng.standard_normal(dims)).tolist() for _ in range(70)]
    rows += [hot.tolist()] * 20 + [(-hot).tolist(), (2 * hot).tolist()]
    nan, inf = float("nan"), float("inf")
    rows += [None, [], [0.0] * dims, [0.0] * dims, [nan] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1), [inf] * dims,
             hot[:-1].tolist(), hot[:-1].tolist(), [1.0], [-1.0], [3.0], [1e-30] * dims, [1e30] * dims]
    order = rng.permutation(len(rows)).tolist()
    return [(i, rows[k]) for i, k in enumerate(order)] + [(None, rows[0]), (5, rows[1]), (5, rows[1]), (None, None)]


@pytest.mark.parametrize("dims, block, cell, homes, visitors", [
    (64, 16, 4096, 4096, 16384), (64, 16, 20, 8, 11), (64, 8, 10, 1000, 1000), (6, 2, 8, 5, 7), (3, 16, 30, 9, 1000),
])
def test_neighbours_match_brute_force(spark, dims, block, cell, homes, visitors):
    rows = near_groups(dims, dims + block)
    got = vector_join.near_vectors(frame(spark, rows), 0.9, block, cell, homes, visitors).collect()
    plain = plain_neighbours(rows, 0.9)
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=repr) == plain


def test_neighbours_of_an_empty_table_and_of_text_identifiers(spark):
    got = vector_join.near_vectors(frame(spark, []))
    assert got.count() == 0 and got.columns == ["vec_id", "n_links", "component_id", "kept"]
    named = frame(spark, [("b", [1.0, 0.0]), ("a", [0.99, 0.1]), ("c", [0.0, 1.0])], VECTORS.replace("vec_id bigint", "vec_id string"))
    assert sorted(map(tuple, vector_join.near_vectors(named).collect())) == [
        ("a", 1, "a", True), ("b", 1, "a", False), ("c", 0, "c", True)]


def test_each_pair_meets_once(spark):
    """Every pair within a block's budget is dealt to exactly one tile of that block."""
    rng = np.random.default_rng(4)
    layout = vector_join.Layout.of(16, 0.9, 4)
    v = rng.standard_normal((300, 16))
    layout.split(v[:100], 4)
    layout.homes = np.full((4, 16), 2)
    layout.visitors = np.full((4, 16), 2)
    spread = vector_join.mix(np.arange(300, dtype=np.uint64))
    for b, part in enumerate(layout.parts(layout.rotated(v))):
        tiles = defaultdict(lambda: ([], []))
        for at, cell, piece, unit, side in vector_join._dealt(layout, b, part, spread):
            for p, c, s, u in zip(at, cell, piece, unit, strict=True):
                tiles[c, s, u][side].append(p)
        met = Counter()
        for (_, _, unit), (left, right) in tiles.items():
            met.update(tuple(sorted((x, y))) for x in left for y in right)
            if unit == 0:
                met.update(tuple(sorted((x, y))) for i, x in enumerate(left) for y in left[:i])
        assert max(met.values()) == 1
        d = ((part[:, None] - part[None]) ** 2).sum(2)
        within = {(x, y) for x, y in zip(*np.nonzero(d <= layout.budgets[b]), strict=True) if x < y}
        assert within <= set(met)
