"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

Items are normalised to word numbers and fed to one automaton per block of items, built once in a task and stored; a
block is bounded in words, so what is sent at once is bounded too, and more items mean more blocks, not larger ones.
Documents stream through: at each word the automaton holds the longest match that ends there. Words
inside a match of at least ``window`` words are hit; an item shorter than the window is one window
by itself. Stretches that cannot hold a match, because a pair of neighbours occurs in no item, are
skipped beforehand with whole-array operations.
"""

from __future__ import annotations

import pickle
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import IS_BREAK, free_name, in_slices, row_of, small_batches, stored, text_bytes, word_hashes

BLOCK_WORDS = 200_000
WINDOW = 10


class Automaton:
    """Suffix automaton of several word sequences: transitions, suffix links, lengths, items per window."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # For windows: the state that stands for the last ``window`` words, and the items that pass it.
        self.at_window: dict[int, set[int]] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        self.ids = [item_id for item_id, _ in items]
        for number, (_, words) in enumerate(items):
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.at_window.setdefault(self.shorten(state), set()).add(number)
            if 0 < len(words) < window:
                self.whole.setdefault(state, []).append((len(words), number))
        self.short_above = self._short_above()
        self.shortest = min([window, *(n for hits in self.whole.values() for n, _ in hits)])

    def _extend(self, last: int, word: int) -> int:
        """The state of the longest string that ends with ``word`` after ``last``; generalised to many strings."""
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
            return new
        target = self.next[at][word]
        self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
        return new

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        part = self._state(self.length[at] + 1, dict(self.next[target]))
        self.link[part] = self.link[target]
        self.link[target] = part
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = part
            at = self.link[at]
        return part

    def shorten(self, state: int) -> int:
        """The state of the last ``window`` words of a longer match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _short_above(self) -> dict[int, int]:
        """For each state the nearest one on its suffix path, itself included, that is a whole short item."""
        out: dict[int, int] = {}
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            if state in self.whole:
                out[state] = state
            elif self.link[state] in out:
                out[state] = out[self.link[state]]
        return out

    def run(self, words: list[int], spans: list[tuple[int, int]], items: set[int], offset: int) -> None:
        """Feed ``words``; add spans (from, to) of hit words, counted from ``offset``, and the items found."""
        moves, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in moves[state]:
                state = link[state]
                matched = length[state]
            after = moves[state].get(word)
            if after is None:
                state = matched = 0
                continue
            state, matched = after, matched + 1
            if matched >= window:
                spans.append((offset + i + 1 - matched, offset + i + 1))
                items |= self.at_window[self.shorten(state)]
            at = self.short_above.get(state)
            while at is not None:
                for n, number in self.whole[at]:
                    if n <= matched:
                        spans.append((offset + i + 1 - n, offset + i + 1))
                        items.add(number)
                at = self.short_above.get(link[at])


def stored_blocks(benchmark: DataFrame, window: int, block_words: int) -> tuple[DataFrame, list[int]]:
    """((block, data), block numbers): items dealt to blocks of about ``block_words`` words, each built once into a ``Matcher``.

    A block is built in one task, from as many words as a block has; no item passes the driver.
    """
    def count(batches):
        for batch in in_slices(batches, "text"):
            hashes, bounds = word_hashes(*text_bytes(batch.column("text")), IS_BREAK)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], names=["item_id", "words"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    words = stored(small_batches(items).mapInArrow(count, "item_id string, words array<bigint>"))
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))

    def build(rows: pa.Table) -> pa.Table:
        block = [(i, np.array(w, np.int64).view(np.uint64)) for i, w in zip(rows["item_id"].to_pylist(), rows["words"].to_pylist(), strict=True)]
        block.sort(key=lambda x: (x[0], x[1].tolist()))
        return pa.table({"block": rows["block"].slice(0, 1), "data": [pickle.dumps(Matcher(block, window))]})

    dealt = words.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)).cast("int"))
    built = stored(dealt.groupBy("block").applyInArrow(build, "block int, data binary"))
    return built, sorted(r["block"] for r in built.select("block").collect())


class Matcher:
    """What a task needs of one block: sorted word hashes, known neighbours, the automaton."""

    def __init__(self, block: list[tuple[str, np.ndarray]], window: int):
        self.vocabulary = np.unique(np.concatenate([w for _, w in block])) if block else np.zeros(0, np.uint64)
        items = [(i, np.searchsorted(self.vocabulary, w)) for i, w in block]
        pairs = [w[:-1] * len(self.vocabulary) + w[1:] for _, w in items if len(w) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.automaton = Automaton([(i, w.tolist()) for i, w in items], window)
        # A small table answers most words at once: the low bits of a hash that some item word has.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.vocabulary & np.uint64((1 << 20) - 1)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words of no item."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[hashes & np.uint64((1 << 20) - 1)])
        if len(maybe) and len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            good = self.vocabulary[at] == hashes[maybe]
            out[maybe[good]] = at[good]
        return out

    def match(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[dict[int, list], dict[int, set]]:
        """Spans and items by row, for the words of all rows of a slice."""
        words, rows = self.numbers(hashes), row_of(bounds)
        spans: dict[int, list] = {}
        found: dict[int, set] = {}
        least = self.automaton.shortest
        if len(words) == 0:
            return spans, found
        if least == 1:
            joined = (words[1:] >= 0) & (words[:-1] >= 0) & (rows[1:] == rows[:-1])
        else:
            near = np.flatnonzero((words[1:] >= 0) & (words[:-1] >= 0) & (rows[1:] == rows[:-1]))
            keys = words[near] * len(self.vocabulary) + words[near + 1]
            at = np.minimum(np.searchsorted(self.pairs, keys), max(len(self.pairs) - 1, 0))
            joined = np.zeros(len(words) - 1, bool)
            joined[near[self.pairs[at] == keys] if len(self.pairs) else near[:0]] = True
        # runs of words joined to their neighbours; only runs of the least window length matter
        edges = np.flatnonzero(~joined) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(words)]])
        long = (ends - starts >= least) & (words[starts] >= 0)
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            row = int(rows[a])
            self.automaton.run(words[a:b].tolist(), spans.setdefault(row, []), found.setdefault(row, set()),
                               a - int(bounds[row]))
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPANS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def with_spans(
    docs: DataFrame, blocks: DataFrame, numbers: list[int], window: int = WINDOW
) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with three new columns, and their names: spans of hit words (half open, merged), items, number of words.

    ``blocks`` and their ``numbers`` come from ``stored_blocks``.

    One block at a time is held by the driver and sent to the tasks. A benchmark of one block is one pass over the
    documents; with more, each pass keeps what it hits, which is put together per document at the end.
    """
    names = docs.columns
    made = tuple(free_name(docs, n) for n in ("_spans", "_items", "_words"))
    docs = small_batches(docs)
    if len(numbers) <= 1:
        return _one_block(docs, _load(blocks, numbers, window), made), made
    row = free_name(docs, "row")
    docs = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    found, counted = [], None
    for number in numbers:
        shared = _load(blocks, [number], window)
        hits = _one_block(docs.select(F.col(row).alias("row"), "text"), shared).drop("text")
        if counted is None:
            hits = stored(hits)
            counted = hits.select(F.col("row").alias(row), F.col("_words").alias(made[2]))
            found.append(hits.filter(F.size("_spans") > 0))
        else:
            found.append(stored(hits.filter(F.size("_spans") > 0)))
        shared.unpersist()
    # The spans of a document are bounded by its words, whatever the number of blocks.
    met = reduce(DataFrame.unionByName, found).groupBy("row").agg(F.collect_list("_spans").alias("spans"), F.collect_list("_items").alias("items"))
    hits = met.mapInArrow(_put_together, "row bigint, _spans array<struct<start: bigint, stop: bigint>>, _items array<string>")
    hits = hits.select(F.col("row").alias(row), F.col("_spans").alias(made[0]), F.col("_items").alias(made[1]))
    none = F.array()
    return docs.join(counted, row).join(hits, row, "left").select(
        *names, F.coalesce(made[0], none.cast("array<struct<start: bigint, stop: bigint>>")).alias(made[0]),
        F.coalesce(made[1], none.cast("array<string>")).alias(made[1]), made[2]), made


def _put_together(batches):
    """Rows of (row, lists of spans, lists of items) of several blocks, as merged spans and distinct items."""
    for batch in batches:
        spans = [merged([(s["start"], s["stop"]) for some in lists for s in some]) for lists in batch.column("spans").to_pylist()]
        items = [sorted({i for some in lists for i in some}) for lists in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array([[{"start": a, "stop": b} for a, b in x] for x in spans], SPANS_TYPE),
             pa.array(items, pa.list_(pa.string()))], names=["row", "_spans", "_items"])


def _load(blocks: DataFrame, numbers: list[int], window: int):
    """The stored matcher of a block, sent to all tasks; an empty one without blocks."""
    rows = blocks.filter(F.col("block").isin(numbers)).collect() if numbers else []
    data = rows[0]["data"] if rows else pickle.dumps(Matcher([], window))
    return blocks.sparkSession.sparkContext.broadcast(bytes(data))


def _one_block(docs: DataFrame, shared, made: tuple[str, str, str] = ("_spans", "_items", "_words")) -> DataFrame:
    """``docs`` with the spans, items and words of one block, under the names ``made``."""
    names = docs.columns
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)

    def run(batches):
        matcher = pickle.loads(shared.value)
        for batch in in_slices(batches, "text"):
            hashes, bounds = word_hashes(*text_bytes(batch.column("text")), IS_BREAK)
            spans, found = matcher.match(hashes, bounds)
            rows = range(batch.num_rows)
            columns = [
                pa.array([[{"start": a, "stop": b} for a, b in merged(spans.get(i, []))] for i in rows], SPANS_TYPE),
                pa.array([[matcher.automaton.ids[k] for k in found.get(i, ())] for i in rows], pa.list_(pa.string())),
                pa.array(np.diff(bounds), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, *made])

    types = ("array<struct<start: bigint, stop: bigint>>", "array<string>", "bigint")
    return docs.mapInArrow(run, ", ".join([kinds, *(f"`{n}` {t}" for n, t in zip(made, types, strict=True))]))


def _hit(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of digits, letters a to z after lower-casing A-Z, and everything beyond ASCII.
    Null texts have no words; items without words never occur; items with one id count once; repeated
    rows are answered one by one; a null item_id counts as the empty id. An empty benchmark hits nothing.
    """
    found, (spans, items, n) = with_spans(docs.select("doc_id", "text"), *stored_blocks(benchmark, window, block_words), window)
    items = F.array_sort(F.array_distinct(items))
    return found.select(
        "doc_id", F.col(n).alias("n_words"), _hit(spans).alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size(spans) > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without benchmark passages: spans are cut, and rows hit for more than ``most_coverage`` go.

    Null texts stay, and so does every row without an item. Repeated rows stay or go together; very long texts are
    read whole. Cutting removes everything from the first to the last character of a span. Other columns pass as
    they are, whatever their names; an empty table gives no rows.
    """
    blocks, numbers = stored_blocks(benchmark, window, block_words)
    if len(numbers) <= 1:
        # Matching and cutting in one pass, so that a task needs one Python worker.
        shared = _load(blocks, numbers, window)

        def run(batches):
            matcher = pickle.loads(shared.value)
            for batch in in_slices(batches, "text"):
                hashes, bounds = word_hashes(*text_bytes(batch.column("text")), IS_BREAK)
                hits, _ = matcher.match(hashes, bounds)
                spans = [merged(hits.get(i, [])) for i in range(batch.num_rows)]
                kept = [sum(b - a for a, b in own) <= n * most_coverage for own, n in zip(spans, np.diff(bounds).tolist(), strict=True)]
                yield _cut_texts(batch, spans).filter(pa.array(kept, pa.bool_()))

        return small_batches(docs).mapInArrow(run, docs.schema)
    found, (hit, _, n) = with_spans(docs, blocks, numbers, window)
    kept = found.filter(_hit(hit) <= F.col(n) * F.lit(most_coverage))

    def cut_all(batches):
        for batch in in_slices(batches, "text"):
            yield _cut_texts(batch, [[(s["start"], s["stop"]) for s in own] for own in batch.column(hit).to_pylist()])

    return kept.mapInArrow(cut_all, kept.schema).select(*docs.columns)


def _cut_texts(batch: pa.RecordBatch, spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    """``batch`` with the words in ``spans`` cut from its texts; a text that nothing hits is not touched."""
    texts = batch.column("text")
    if any(spans):
        texts = pa.array([cut(t, own) if own else t for t, own in zip(texts.to_pylist(), spans, strict=True)], pa.string())
    return pa.RecordBatch.from_arrays([texts if n == "text" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)], names=batch.schema.names)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words in ``spans`` and what stands between them."""
    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return "".join([*out, text[at:]])


SQL = r"""
WITH norm AS (
  SELECT 'd' AS kind, row_number() OVER () AS k, doc_id AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), lens AS (
  SELECT DISTINCT least(10, len(w)) AS n FROM norm WHERE kind = 'b' AND len(w) > 0
), item_windows AS (
  SELECT DISTINCT id AS item_id, least(10, len(w)) AS n,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM norm WHERE kind = 'b' AND len(w) > 0)
), doc_windows AS (
  SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM norm, lens WHERE kind = 'd' AND len(w) >= n)
), hits AS (
  SELECT k, d.n, i, item_id FROM doc_windows d JOIN item_windows USING (n, g)
), words_hit AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k
), items AS (
  SELECT k, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS s FROM hits) GROUP BY k
)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM norm LEFT JOIN words_hit USING (k) LEFT JOIN items USING (k) WHERE kind = 'd'
"""
