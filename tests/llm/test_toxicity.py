"""The toxicity models against a plain version of the same formulas."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import toxicity
from pagelake.llm.common import IS_BREAK, text_bytes, word_hashes

DOCS = "doc_id bigint, text string, evidence string, row string, score int"
LABELS = "doc_id bigint, toxic int"


def corpus(spark, n=400, seed=8):
    rng, texts, labels = random.Random(seed), [], []
    base = ["".join(rng.choices("abcd", k=rng.randint(2, 5))) for _ in range(150)]
    for i in range(n):
        text, bad = rng.choices(base, k=rng.randint(15, 60)), i % 4 == 0
        text += ["".join(rng.choices("efgh", k=rng.randint(3, 5))) for _ in range(rng.randint(0, 12))]
        if bad:
            for _ in range(rng.randint(1, 3)):
                text[rng.randrange(len(text))] = rng.choice(["rotten", "vile", "Foul"])
        texts.append((i, " ".join(text), "e", "r", 5))
        labels.append((i, int(bad)))
    texts += [(n, None, "e", "r", 5), (n + 1, "", None, "r", 5), (None, "x", "e", None, None), (n + 2, "!!! ---", "e", "r", 5),
              (n + 3, "vile " * 30_000, "e", "r", 5), (7, texts[7][1], "e", "r", 5)]
    return spark.createDataFrame(texts, DOCS), spark.createDataFrame([*labels, (None, 1), (3, None), (5, 7)], LABELS)


def words_of(text):
    return re.findall("[a-z0-9]+", (text or "").lower())


def hashed(word):
    import pyarrow as pa

    return int(word_hashes(*text_bytes(pa.array([word])), IS_BREAK)[0].view(np.int64)[0])


def plain_discounts(counts, half, shared):
    off, total = [0.7, 1.2, 1.5], sum(half.values())
    for _ in range(50):
        given = sum(off[min(n, 3) - 1] for n in half.values() if n) / total
        new = []
        for r in (1, 2, 3):
            own = [w for w in counts if half[w] == r]
            if own:
                extra = [r + given * total * shared[w] - (counts[w] - half[w]) for w in own]
                new.append(min(max(sum(extra) / len(own), 0.0), float(r)))
            else:
                new.append(off[r - 1])
        off = new
    return off


def test_ratios_match_a_plain_version(spark):
    table, labels = corpus(spark)
    known = toxicity.labelled_texts(labels, "toxic").filter("part = 0")
    pairs = toxicity.class_pairs(table.join(known, "doc_id")).collect()
    contexts = toxicity.continuations(table)
    model = toxicity.fit_counts(toxicity.class_words(toxicity.class_pairs(table.join(known, "doc_id"))), contexts)

    seen = defaultdict(set)
    y = {r["doc_id"]: r["y"] for r in known.collect()}
    everywhere = set()
    for r in table.collect():
        w = words_of(r["text"])
        for pair in zip(["", *w], w, strict=False):
            everywhere.add(pair)
            if r["doc_id"] in y:
                seen[y[r["doc_id"]]].add(pair)
    assert sorted(Counter(r["seen"] for r in pairs).items()) == sorted(
        Counter((p in seen[1]) + 2 * (p in seen[0]) for p in seen[0] | seen[1]).items())
    exact = Counter(hashed(w) for _, w in everywhere)
    about = {r["w"]: r["contexts"] for r in contexts.collect()}
    assert about.keys() == exact.keys()
    off = [abs(about[w] - n) / n for w, n in exact.items()]
    assert max(off) < 0.6 and np.mean(off) < 0.05

    shared = {w: (about[w] + 1) / (sum(about.values()) + len(about) + 1) for w in about}
    likelihood = {}
    for y_, bit in ((1, 1), (0, 2)):
        counts = Counter(r["w"] for r in pairs if r["seen"] & bit)
        half = Counter(r["w"] for r in pairs if r["seen"] & bit and r["k"] < 0)
        off, n = plain_discounts(counts, half, shared), sum(counts.values())
        given = max(sum(off[min(c, 3) - 1] for c in counts.values()) / n, 1e-6)
        likelihood[y_] = {r["w"]: max(counts[r["w"]] - off[min(counts[r["w"]], 3) - 1], 0) / n * (counts[r["w"]] > 0) + given * shared[r["w"]] for r in pairs}
        likelihood[y_][None] = given
    got = {r["w"]: r["ratio"] for r in model.table.collect()}
    assert got.keys() == likelihood[1].keys() - {None} and model.words == len(got)
    for w, x in {**got, None: model.unknown}.items():
        assert math.isclose(x, math.log(likelihood[1][w] / likelihood[0][w]), rel_tol=1e-9, abs_tol=1e-9)
    assert got[hashed("vile")] > max(2, np.median(list(got.values())))


def test_counts_are_handed_on_in_small_batches():
    keys, seen = np.arange(2 * toxicity.HANDED + 7, dtype=np.uint64), np.ones(2 * toxicity.HANDED + 7, np.int32)
    parts = list(toxicity._handed([keys, seen], ["k", "seen"]))
    assert [p.num_rows for p in parts] == [toxicity.HANDED, toxicity.HANDED, 7]
    assert np.array_equal(np.concatenate([p["k"].to_numpy() for p in parts]), keys.view(np.int64))
    assert list(toxicity._handed([keys[:0], seen[:0]], ["k", "seen"])) == []


def plain_evidence(ratio):
    n = len(ratio)
    mean = sum(ratio) / max(n, 1)
    best = [max([0.0, *(sum(ratio[i:i + k]) / k for i in range(n))]) for k in toxicity.WINDOWS]
    return [mean, mean * n**0.5, min(max(mean * n, -20), 20), math.log1p(n), *best]


def test_evidence_matches_plain_windows():
    rng = random.Random(1)
    texts = [[rng.gauss(-0.1, 1) for _ in range(n)] for n in (0, 1, 5, 0, 90, 24, 0)]
    bounds = np.cumsum([0, *map(len, texts)])
    got = toxicity.evidence(np.array(sum(texts, [])), bounds)
    assert np.allclose(got, [plain_evidence(t) for t in texts])


@pytest.mark.parametrize("most", [toxicity.MOST_WORDS, 10])
def test_held_out_texts_are_told_apart_either_way(spark, most):
    table, labels = corpus(spark)
    got = toxicity.score(table, labels, most_words=most).collect()
    assert len(got) == 406 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [(r["doc_id"] % 4 == 0, r["predicted"] == 1) for r in got if r["held_out"] and (r["doc_id"] or 999) < 400]
    assert len(held) > 60 and sum(a == b for a, b in held) / len(held) > 0.93
    of = {r["doc_id"]: r["score"] for r in got}
    assert of[400] == of[401] == of[402] < 0.3 <= of[403]


def test_a_model_too_large_to_send_scores_the_same(spark):
    table, labels = corpus(spark, 200)
    sent, joined = ({(r["doc_id"], round(r["score"], 9)) for r in toxicity.score(table, labels, most_words=m).collect()} for m in (10**6, 10))
    assert sent == joined
    stage = [toxicity.drop_toxic(table, labels, most_words=m) for m in (10**6, 10)]
    assert stage[0].columns == stage[1].columns == table.columns
    assert sorted(map(tuple, stage[0].collect()), key=repr) == sorted(map(tuple, stage[1].collect()), key=repr)


def test_too_few_labels_call_nothing_toxic(spark):
    table, labels = corpus(spark, 60)
    for few in (labels.limit(0), labels.filter("doc_id < 8"), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        assert {r["score"] for r in toxicity.score(table, few).collect()} == {0.0}
        assert toxicity.drop_toxic(table, few).count() == table.count()
    assert toxicity.score(table.limit(0), labels).count() == 0 == toxicity.drop_toxic(table.limit(0), labels).count()


def test_scores_do_not_depend_on_the_order_of_rows(spark):
    table, labels = corpus(spark, 200)
    one = toxicity.score(table.repartition(1), labels)
    many = toxicity.score(table.orderBy(F.rand(3)).repartition(7), labels)
    first, second = (sorted([(r["doc_id"] or -1, r["score"]) for r in x.collect()]) for x in (one, many))
    assert [i for i, _ in first] == [i for i, _ in second]
    assert np.allclose([s for _, s in first], [s for _, s in second], atol=1e-9)
