"""Toxicity by class-conditional Kneser-Ney models of words.

A model of toxic and a model of ordinary texts count after how many different words each word stands in the texts of
the class (continuation counts, so a passage that is copied many times counts once). Each takes an absolute discount
off these counts, one for 1, for 2, and for 3 or more, and gives what it took to one shared distribution of
continuation counts over all documents. The discounts come from deleted estimation: word pairs are dealt to two
halves, and the discount is what one half counts beyond what the other half and the shared distribution bear out. So
what is rare costs nearly its whole count and says little, while a marker word keeps it.

A text is judged by the difference of the two log-likelihoods per word, over the whole text and over the best window of
each of ``WINDOWS`` lengths, since a few toxic words hardly move the mean of a long text. A logistic curve, fitted on
labelled texts that the models have not seen, turns these and the length into a probability; the curve also holds how
much rarer one class is.

Counts take every labelled text of both classes but the held-out ones and the share kept for the curve; only the sample
of the curve is bounded, by ``PER_CLASS`` texts of each class. Everything scored is scored whole. Contexts over all
documents are counted by sketches that merge: one row per word and task, not one per pair. The model is a table of
one ratio per word. Up to ``MOST_WORDS`` it is sent to the tasks; beyond, the words of the texts are joined with it,
with the same scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import (
    IS_BREAK, free_name, held_out, in_slices, mix, row_of, small_batches, stored, text_bytes, word_hashes,
)

#: Most labelled texts of a class that the curve is fitted on. The counts have no bound.
PER_CLASS = 5_000
#: Fewest texts of each class that counts and curve are fitted on; with less nothing is called toxic.
LEAST_COUNTED, LEAST_CURVE = 5, 3
THRESHOLD = 0.3
#: Words of the windows whose best mean is looked at beside that of the whole text.
WINDOWS = (1, 3, 8, 24)
#: Most labelled identifiers that are sent to all tasks; beyond, texts are dealt by identifier instead.
MOST_SENT = 2_000_000
#: Most words of a model that is sent to all tasks (16 bytes each); beyond, words are joined with it.
MOST_WORDS = 4_000_000
#: Distinct pairs or words that a task gathers before it hands them on, and how many it hands on in one Arrow batch.
GATHERED, HANDED = 1_000_000, 50_000
#: Bytes of text that are hashed and judged at a time; every worker holds about a hundred bytes for each of them.
SLICE = 250_000
#: Bitmaps of 64 bits in a sketch; each sees an eighth of what the one before sees.
LEVELS = 6
#: A bitmap with fewer empty places than this is crowded, and the next one counts.
EMPTY = 13
START = np.uint64(1)
CLASSES = ("toxic", "ordinary")


def labelled_texts(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y, part) of every labelled document that is not held out; ``part`` 0 fits counts, 1 the curve.

    Rows without label or identifier are left out; of several labels of one document the larger counts.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    )
    part = F.when(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0, 1).otherwise(0)
    return stored(known.withColumn("part", part))


def curve_sample(known: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, y, weight) of at most ``per_class`` rows of each class; ``weight`` undoes the unequal sampling."""
    rows = known.filter("part = 1")
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    parts = []
    for y in (0, 1):
        weight = sizes.get(y, 0) / max(1, min(per_class, sizes.get(y, 0)))
        own = rows.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        parts.append(own.select("doc_id", "y", F.lit(float(weight)).alias("weight")))
    return stored(parts[0].unionByName(parts[1]))


def _pairs(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word before, word) of every word; a text starts with START."""
    before = np.empty_like(hashes)
    if len(hashes):
        before[1:] = hashes[:-1]
        before[bounds[:-1][np.diff(bounds) > 0]] = START
    return before, hashes


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*text_bytes(batch.column("text")), IS_BREAK)


def _handed(arrays, names: list[str]):
    """Record batches of at most ``HANDED`` entries."""
    for at in range(0, len(arrays[0]), HANDED):
        parts = [x[at:at + HANDED] for x in arrays]
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in parts], names=names)


def _summed(rows: DataFrame, kind: str, each, merge) -> DataFrame:
    """What ``each`` makes of slices of texts, arrays with 64-bit keys first, merged by ``merge`` over a whole task.

    A task merges as it goes and hands on what it has only beyond ``GATHERED`` entries, ``HANDED`` at a time, so that its
    memory and that of the executor that reads from it are bounded.
    """
    names = [c.split()[0] for c in kind.split(", ")]

    def run(batches):
        held, new = [], 0
        for batch in in_slices(batches, "text", SLICE):
            held.append(each(batch))
            new += len(held[-1][0])
            if new >= GATHERED // 4:
                held, new = [merge(*(np.concatenate(x) for x in zip(*held, strict=True)))], 0
                if len(held[0][0]) >= GATHERED:
                    yield from _handed(held.pop(), names)
        if held:
            yield from _handed(merge(*(np.concatenate(x) for x in zip(*held, strict=True))), names)

    return small_batches(rows).mapInArrow(run, kind)


def _merged(keys: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(sorted distinct keys, the others in that order, where each key begins)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], [x[order] for x in others], first


def _ored(bits: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.bitwise_or.reduceat(bits, first) if len(first) else bits[:0]


def class_pairs(texts: DataFrame) -> DataFrame:
    """(k, w, seen): each distinct pair of words in the texts of (text, y); seen has bit 1 for toxic, 2 for ordinary."""

    def merge(keys, w, bits):
        keys, (w, bits), first = _merged(keys, w, bits)
        return keys, w[first], _ored(bits, first)

    def each(batch):
        hashes, bounds = _hashed(batch)
        v, w = _pairs(hashes, bounds)
        y = batch.column("y").to_numpy(zero_copy_only=False)[row_of(bounds)]
        return merge(pair_key(v, w), w, np.where(y == 1, 1, 2).astype(np.int32))

    rows = _summed(texts.select("text", "y"), "k bigint, w bigint, seen int", each, merge)
    return rows.groupBy("k", "w").agg(F.bit_or("seen").alias("seen"))


def class_words(pairs: DataFrame) -> DataFrame:
    """(w, and per class the number of pairs that end with w, and of those in the first half of all pairs)."""
    half = F.col("k") < 0
    seen = {"toxic": F.col("seen").bitwiseAND(1) > 0, "ordinary": F.col("seen").bitwiseAND(2) > 0}
    return pairs.groupBy("w").agg(*(F.count_if(x).alias(c) for c, x in seen.items()), *(F.count_if(x & half).alias(f"{c}_half") for c, x in seen.items()))


def continuations(texts: DataFrame) -> DataFrame:
    """(w, contexts): about after how many different words, or at the start, each word stands in the ``text`` rows.

    Linear counting in the first bitmap that is not crowded: close to exact for a few contexts, off by a tenth or so
    for many. Sketches merge by bitwise or, so what repeats changes nothing.
    """
    kind = "w bigint, " + ", ".join(f"b{i} bigint" for i in range(LEVELS))

    def merge(w, *maps):
        words, maps, first = _merged(w, *maps)
        return words, *(_ored(m, first) for m in maps)

    def each(batch):
        v, w = _pairs(*_hashed(batch))
        keys = pair_key(v, w)
        rest = (keys >> np.uint64(6) & np.uint64((1 << 3 * (LEVELS - 1)) - 1)).astype(np.float64)
        level = (3 * (LEVELS - 1) - np.frexp(rest)[1]) // 3
        words, (level, bit), first = _merged(w, level, np.uint64(1) << (keys & np.uint64(63)))
        return words, *(_ored(np.where(level == i, bit, np.uint64(0)), first) for i in range(LEVELS))

    merged = _summed(texts.select("text"), kind, each, merge).groupBy("w").agg(*(F.bit_or(f"b{i}").alias(f"b{i}") for i in range(LEVELS)))
    empty = [64 - F.bit_count(f"b{i}") for i in range(LEVELS)]
    counts = [64 * F.log(64 / F.greatest(x, F.lit(0.5))) for x in empty]
    found, scale = F.lit(0.0), 8.0 ** (LEVELS - 1)
    contexts = sum(counts[LEVELS - 1:], F.lit(0.0)) * scale
    for i in reversed(range(LEVELS - 1)):
        contexts = F.when(empty[i] >= EMPTY, sum(counts[i:], found) * 8.0**i).otherwise(contexts)
    return merged.select("w", contexts.alias("contexts"))


@dataclass
class Model:
    """Log-likelihood ratios of the words of labelled texts, that of all other words, and the curve."""

    table: DataFrame | None = None
    unknown: float = 0.0
    words: int = 0
    mean: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    curve: tuple[float, ...] | None = None

    def probability(self, evidence: str) -> Column:
        """Score of a row from its evidence; 0 where there was too little to fit a model on."""
        if self.curve is None:
            return F.lit(0.0)
        z = sum((F.col(evidence)[i] - m) * (b / s) for i, (m, s, b) in enumerate(zip(self.mean, self.spread, self.curve[1:], strict=True)))
        return 1 / (1 + F.exp(-F.greatest(F.least(z + self.curve[0], F.lit(30.0)), F.lit(-30.0))))


def evidence(ratio: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """What the curve sees of each text: the ratio per word at several scales, the best windows, and the length."""
    n = np.diff(bounds)
    rows = row_of(bounds)
    mean = np.bincount(rows, ratio, len(n)) / np.maximum(n, 1)
    columns = [mean, mean * np.sqrt(n), np.clip(mean * n, -20, 20), np.log1p(n)]
    some, running = np.flatnonzero(n), np.concatenate([[0.0], np.cumsum(ratio)])
    start = np.arange(len(ratio))
    for k in WINDOWS:
        best = np.zeros(len(n))
        if len(some):
            inside = running[np.minimum(start + k, bounds[1:][rows])] - running[start]
            best[some] = np.maximum(np.maximum.reduceat(inside, bounds[:-1][some]) / k, 0)
        columns.append(best)
    return np.stack(columns, axis=1)


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(v * np.uint64(0x9E3779B97F4A7C15) + w)


def find(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``out``, with ``values`` wherever ``asked`` is among the sorted ``keys``."""
    if len(keys) and len(asked):
        at = np.searchsorted(keys, asked)
        at[at == len(keys)] = 0
        good = keys[at] == asked
        out[good] = values[at[good]]
    return out


def _discounted(count: Column, off: list[float]) -> Column:
    return F.greatest(count - F.when(count == 1, off[0]).when(count == 2, off[1]).otherwise(off[2]), F.lit(0.0))


def discounts(stats: dict[int, tuple[float, float, float]], of_three: float, total: float) -> list[float]:
    """Discounts for counts of 1, 2 and 3 or more, by deleted estimation between two halves.

    ``stats`` has per count in one half the number of words, the sum of their shared probabilities, and of their counts
    in the other half; ``of_three`` words have 3 or more, and ``total`` is the sum of all counts of the half. What the
    discounts take is what backs off, and what backs off says how much the shared distribution bears out, so both
    are found in turns.
    """
    off = [0.7, 1.2, 1.5]
    for _ in range(50):
        given = (off[0] * stats[1][0] + off[1] * stats[2][0] + off[2] * of_three) / max(total, 1)
        off = [min(max((r * n + given * total * shared - other) / n, 0.0), float(r)) if n else float(off[r - 1])
               for r, (n, shared, other) in stats.items()]
    return off


def fit_counts(words: DataFrame, contexts: DataFrame) -> Model:
    """The models from the counts of the words of labelled texts, and from ``continuations`` over all documents."""
    everything = contexts.agg(F.sum("contexts").alias("n"), F.count(F.lit(1)).alias("types")).first()
    shared = (F.coalesce("contexts", F.lit(0.0)) + 1) / float((everything["n"] or 0) + everything["types"] + 1)
    words = words.join(contexts, "w", "left").select("w", *CLASSES, *(f"{c}_half" for c in CLASSES), shared.alias("shared"))
    asked = [F.count(F.lit(1)).alias("words")]
    for c in CLASSES:
        half, other = F.col(f"{c}_half"), F.col(c) - F.col(f"{c}_half")
        asked += [F.sum(c).alias(c), F.sum(half).alias(f"{c}_half"), F.count_if(half >= 3).alias(f"{c}_three")]
        asked += [F.count_if((F.col(c) >= 3) if r == 3 else F.col(c) == r).alias(f"{c}_all{r}") for r in (1, 2, 3)]
        for r in (1, 2, 3):
            asked += [F.count_if(half == r).alias(f"{c}_n{r}"), F.sum(F.when(half == r, F.col("shared"))).alias(f"{c}_q{r}"),
                      F.sum(F.when(half == r, other)).alias(f"{c}_o{r}")]
    got = {k: float(v or 0) for k, v in words.agg(*asked).first().asDict().items()}
    likelihood, given = {}, {}
    for c in CLASSES:
        off = discounts({r: tuple(got[f"{c}_{x}{r}"] for x in "nqo") for r in (1, 2, 3)}, got[f"{c}_three"], got[f"{c}_half"])
        n = max(got[c], 1.0)
        given[c] = max(sum(d * got[f"{c}_all{r}"] for r, d in zip((1, 2, 3), off, strict=True)) / n, 1e-6)
        likelihood[c] = _discounted(F.col(c), off) / n + given[c] * F.col("shared")
    ratio = F.log(likelihood["toxic"] / likelihood["ordinary"])
    return Model(stored(words.select("w", ratio.alias("ratio"))), float(np.log(given["toxic"] / given["ordinary"])), int(got["words"]))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Weighted logistic regression by Newton steps; one class alone gives its smoothed share."""
    beta = np.zeros(x.shape[1])
    share = (np.sum(weight * y) + 0.5) / (np.sum(weight) + 1)
    beta[0] = np.log(share / (1 - share))
    if len(y) and 0 < y.sum() < len(y):
        weight = weight * len(y) / weight.sum()
        penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ beta)
            beta += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break
    return tuple(beta)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, most_words: int = MOST_WORDS) -> Model:
    """Models and curve from labelled documents; a model without curve where there are too few of a class."""
    known, texts = labelled_texts(labels, label), docs.select("doc_id", "text")
    counted = known.filter("part = 0")
    counted = texts.join(F.broadcast(counted) if counted.count() <= MOST_SENT else counted, "doc_id")
    sizes = {r["y"]: r["count"] for r in counted.groupBy("y").count().collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0)) < LEAST_COUNTED:
        return Model()
    model = fit_counts(stored(class_words(class_pairs(counted))), stored(continuations(texts)))
    sample = texts.join(F.broadcast(curve_sample(known, per_class)), "doc_id")
    got = judged(sample.select("text", "y", "weight"), model, ["y", "weight"], "evidence", most_words).toArrow()
    order = sorted(range(got.num_rows), key=lambda i: (got["evidence"][i].as_py(), got["y"][i].as_py()))
    y, weight = (got.column(c).to_numpy().astype(float)[order] for c in ("y", "weight"))
    if min((y == 0).sum(), (y == 1).sum()) < LEAST_CURVE:
        return Model()
    x = np.array(got["evidence"].to_pylist())[order]
    mean, spread = x.mean(0), x.std(0) + 1e-9
    model.mean, model.spread = tuple(map(float, mean)), tuple(map(float, spread))
    model.curve = tuple(map(float, fit_curve(np.column_stack([np.ones(len(x)), (x - mean) / spread]), y, weight)))
    return model


def judged(rows: DataFrame, model: Model, keep: list[str], name: str, most_words: int = MOST_WORDS) -> DataFrame:
    """The columns ``keep`` of ``rows``, and ``evidence`` of their text as an array under ``name``."""
    if model.words > most_words:
        return _judged_by_join(rows, model, keep, name)
    data = model.table.toArrow()
    keys = data["w"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = rows.sparkSession.sparkContext.broadcast((keys[order], data["ratio"].to_numpy()[order], model.unknown))
    kinds = dict(rows.dtypes)
    ddl = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"`{name}` array<double>"])

    def run(batches):
        known, ratio, unknown = shared.value
        for batch in in_slices(batches, "text", SLICE):
            hashes, bounds = _hashed(batch)
            yield _with_evidence([batch.column(c) for c in keep], keep, name,
                                 evidence(find(known, ratio, hashes, np.full(len(hashes), unknown)), bounds))

    return small_batches(rows.select(*dict.fromkeys([*keep, "text"]))).mapInArrow(run, ddl)


def _with_evidence(columns, names, name, x: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=[*names, name])


def _judged_by_join(rows: DataFrame, model: Model, keep: list[str], name: str) -> DataFrame:
    """``judged`` where the model is too large to send: every word meets its ratio in a join, texts are put together again."""
    row = free_name(rows, "row")
    rows = stored(rows.withColumn(row, F.monotonically_increasing_id()))

    def words(batches):
        for batch in in_slices(batches, "text", SLICE):
            hashes, bounds = _hashed(batch)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(row), lists], names=["row", "words"])

    def put_together(batches):
        row, ratio = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            row = np.concatenate([row, batch.column("row").to_numpy()])
            ratio = np.concatenate([ratio, batch.column("ratio").to_numpy()])
            whole = np.searchsorted(row, row[-1]) if len(row) else 0  # the last text may go on
            if whole:
                yield texts(row[:whole], ratio[:whole])
                row, ratio = row[whole:], ratio[whole:]
        if len(row):
            yield texts(row, ratio)

    def texts(row, ratio):
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        return _with_evidence([pa.array(row[first])], ["row"], "evidence", evidence(ratio, np.append(first, len(row))))

    met = (
        small_batches(rows.select(row, "text")).mapInArrow(words, "row bigint, words array<bigint>")
        .select("row", F.posexplode("words").alias("place", "w")).join(model.table, "w", "left")
        .select("row", "place", F.coalesce("ratio", F.lit(model.unknown)).alias("ratio"))
        .repartition("row").sortWithinPartitions("row", "place")
    )
    found = met.select("row", "ratio").mapInArrow(put_together, "row bigint, evidence array<double>")
    found = found.select(F.col("row").alias(row), F.col("evidence").alias(free_name(rows, name)))
    none = F.lit([0.0] * (4 + len(WINDOWS)))
    return rows.join(found, row, "left").select(*(F.col(f"`{c}`") for c in keep), F.coalesce(free_name(rows, name), none).alias(name))


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts, and texts without words, get the score of a text without evidence. Repeated rows are scored
    one by one; very long texts are scored whole. A null doc_id is held out. Without ``LEAST_COUNTED`` texts of
    each class for the counts and ``LEAST_CURVE`` for the curve every score is 0. Empty tables give no rows; other
    columns are not looked at.
    """
    model = fit(docs, labels, label, **options)
    rows = docs.select("doc_id", "text")
    if model.curve is not None:
        rows = judged(rows, model, ["doc_id"], "evidence", options.get("most_words", MOST_WORDS))
    scored = rows.select("doc_id", model.probability("evidence").alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, all columns as they were, whatever their names.

    Too few labelled texts to fit a model, an empty ``labels`` table among them, leave every row. Otherwise as ``score``.
    """
    model = fit(docs, labels, **options)
    if model.curve is None:
        return docs
    name = free_name(docs, "evidence")
    rows = judged(docs, model, docs.columns, name, options.get("most_words", MOST_WORDS))
    return rows.filter(model.probability(name) < threshold).select(*docs.columns)
