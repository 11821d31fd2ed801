"""Quality classifier: gradient-boosted trees on histograms of document statistics.

A document becomes a row of numbers (lengths, shares of kinds of characters, repetition, stop words),
computed for whole Arrow batches at once. Trees are grown on binned statistics of at most ``MOST_ROWS``
labelled documents and flattened into arrays; scoring walks all documents of a batch down a tree with
one array step per level. All documents are scored on their whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import (
    IS_BREAK, held_out, in_slices, mix, row_of, small_batches, stored, text_bytes, word_hashes,
)
from pagelake.llm.extract import STOP

#: Most labelled documents that trees are grown on.
MOST_ROWS = 20_000
THRESHOLD = 0.7
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_WEIGHT = 100, 4, 64, 0.1, 2.0, 5.0

GROUPS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": [32, 9, 11, 12, 13], "break": [10],
    "stop": b".?", "comma": b",;:", "bang": b"!", "bar": b"|", "symbol": b"#$%&*+<=>@^_~\\/{}[]", "quote": b"\"'`()-",
    "control": [*range(0, 9), *range(14, 32), 127], "lead": range(0xC0, 256), "trail": range(0x80, 0xC0),
}
NAMES = [*GROUPS, "chars", "words", "lines", "word_length", "long_words", "distinct_words", "repeated_pairs", "repeated_lines",
         "stop_words", "line_words", "upper_words", "bang_words", "top_word"]

NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


def _stop_hashes() -> np.ndarray:
    words = sorted(STOP)
    return np.sort(word_hashes(*text_bytes(pa.array(words)), IS_BREAK)[0])


def _repeats(keys: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """How many entries of a row repeat an earlier one, and the size of its most frequent value."""
    if not len(keys):
        return np.zeros(n_rows), np.zeros(n_rows)
    with np.errstate(over="ignore"):
        both = mix(keys + mix(rows.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    both, rows = both[order], rows[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    size = np.diff(np.append(first, len(both)))
    owner = rows[first]
    top = np.zeros(n_rows)
    np.maximum.at(top, owner, size)
    return np.bincount(owner, size - 1, n_rows), top


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text, in the order of NAMES; null counts as empty."""
    raw, offsets = text_bytes(texts)
    n_rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    group = np.full(256, len(GROUPS), np.int64)
    for i, members in enumerate(GROUPS.values()):
        group[list(members)] = i
    rows = np.repeat(np.arange(n_rows), np.diff(offsets))
    counts = np.bincount(rows * (len(GROUPS) + 1) + group[raw], minlength=n_rows * (len(GROUPS) + 1))
    counts = counts.reshape(n_rows, len(GROUPS) + 1)[:, :len(GROUPS)].astype(float)
    shares = counts / size[:, None]

    words, bounds = word_hashes(raw, offsets, IS_BREAK)
    n = np.diff(bounds).astype(float)
    per_word = np.maximum(n, 1)
    word_rows = row_of(bounds)
    letters = counts[:, [0, 1, 2, 12, 13]].sum(axis=1)
    extra, top = _repeats(words, word_rows, n_rows)
    pair_rows = word_rows[1:][word_rows[1:] == word_rows[:-1]]
    with np.errstate(over="ignore"):
        pairs = (words[1:] * np.uint64(3) + mix(words[:-1]))[word_rows[1:] == word_rows[:-1]]
    repeated, _ = _repeats(pairs, pair_rows, n_rows)
    stops = _STOPS[np.minimum(np.searchsorted(_STOPS, words), len(_STOPS) - 1)] == words
    lines, line_bounds = word_hashes(raw, offsets, NEWLINE)
    n_lines = np.diff(line_bounds).astype(float)
    same_lines, _ = _repeats(lines, row_of(line_bounds), n_rows)
    made = [
        np.log1p(np.diff(offsets)), np.log1p(n), np.log1p(n_lines), letters / per_word, np.minimum(size / per_word, 100),
        1 - extra / per_word, repeated / per_word, same_lines / np.maximum(n_lines, 1), np.bincount(word_rows, stops, n_rows) / per_word,
        n / np.maximum(n_lines, 1), counts[:, 0] / per_word, (counts[:, 7] + counts[:, 9]) / per_word, top / per_word,
    ]
    return np.column_stack([shares, *made])


_STOPS = _stop_hashes()


@dataclass
class Trees:
    """All trees in one set of arrays; ``roots`` says where each begins. A leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        everyone = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                low = x[everyone, self.feature[node]] <= self.limit[node]
                node = np.where(low, self.left[node], self.right[node])
            z += self.value[node]
        return 1 / (1 + np.exp(-z))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees of DEPTH levels on the logistic loss; without rows every score is one half."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    feature, limit, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        at = len(feature)
        feature.append(0)
        limit.append(np.inf)
        left.append(at)
        right.append(at)
        value.append(v)
        return at

    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
        z = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            step = np.zeros(len(y))

            def split(rows: np.ndarray, depth: int, g=g, h=h, step=step) -> int:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                best = (1e-6, -1, -1)
                if depth < DEPTH and len(rows) > 1:
                    for j, e in enumerate(edges):
                        if len(e):
                            sg = np.cumsum(np.bincount(binned[j, rows], g[rows], BINS))[:len(e)]
                            sh = np.cumsum(np.bincount(binned[j, rows], h[rows], BINS))[:len(e)]
                            rg, rh = total_g - sg, total_h - sh
                            gain = sg**2 / (sh + RIDGE) + rg**2 / (rh + RIDGE) - total_g**2 / (total_h + RIDGE)
                            gain[(sh < LEAST_WEIGHT) | (rh < LEAST_WEIGHT)] = -1
                            k = int(np.argmax(gain))
                            best = max(best, (float(gain[k]), j, k))
                v = RATE * total_g / (total_h + RIDGE)
                at = leaf(v)
                if best[1] < 0:
                    step[rows] = v
                    return at
                _, j, k = best
                low = binned[j, rows] <= k
                feature[at], limit[at] = j, float(edges[j][k])
                left[at] = split(rows[low], depth + 1)
                right[at] = split(rows[~low], depth + 1)
                return at

            roots.append(split(np.arange(len(y)), 0))
            z += step
    return Trees(*(np.array(a) for a in (roots, feature, limit, left, right, value)), base)


def _stat_rows(rows: DataFrame) -> DataFrame:
    """(y, x): label and statistics of labelled documents."""

    def run(batches):
        for batch in in_slices(batches, "text"):
            x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("h"), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "h", "x"]
            )

    return small_batches(rows).select("text", "y", "h").mapInArrow(run, "y int, h bigint, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = MOST_ROWS) -> Trees:
    """Trees from at most ``most_rows`` labelled documents that are not held out, chosen by hash."""
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .withColumn("h", F.xxhash64("doc_id", F.lit(11))).orderBy("h", "doc_id").limit(most_rows)
    )
    # At most ``most_rows`` identifiers are sent to the texts, and as many rows of statistics come back; ties of
    # repeated identifiers are ordered by what the rows hold, so that equal tables give equal trees.
    got = _stat_rows(docs.select("doc_id", "text").join(F.broadcast(stored(known)), "doc_id")).toArrow()
    if not got.num_rows:
        return grow(np.zeros((0, len(NAMES))), np.zeros(0))
    rank = sorted(range(got.num_rows), key=lambda i: (got["h"][i].as_py(), got["x"][i].as_py()))
    got = got.take(rank)
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
    return grow(x, got.column("y").to_numpy().astype(float))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts are rows of zeros like any other; repeated rows are scored one by one; a null
    doc_id is held out; without labels every score is one half.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label))

    def run(batches):
        for batch in in_slices(batches, "text"):
            p = shared.value.probability(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    rows = small_batches(docs).select("doc_id", "text")
    scored = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
