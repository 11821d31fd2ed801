"""Similarity join of documents on word n-grams: size-banded tiles, bitmap bounds, exact intersections.

A document is the set of its word 5-grams. Sets are put into one order (n-grams in crowded buckets last,
then by hash), so that two sets with Jaccard similarity of at least ``PERCENT`` share one of their first
n - ceil(n * PERCENT / 100) + 1 members; these are the keys under which sets meet. Under a key, sets are
ordered by size and cut into tiles; only tiles whose sizes can reach the similarity meet. Every set
carries a bitmap of parities of hashed members: the bits in which two bitmaps differ are members that
only one set has, which bounds the overlap from above. What the bound lets pass is decided by the exact
intersection of the sorted member arrays.

Copies with the same set are one representative from the start. The join, ``jaccard_links``, compares all
pairs that meet under a key in tiles; no pair is left out. Components alone need fewer links: there, sets are
first compared with the smallest identifier of each of their keys; what that connects is not compared
again, so a group of thousands of near copies costs one comparison per member and key, not one per
pair, and only pairs that are not connected yet meet in tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.common import IS_SPACE, in_slices, mix, row_of, small_batches, stored, text_bytes, word_hashes
from pagelake.llm.components import components

WORDS, PERCENT = 5, 80
#: Buckets that n-grams are counted in, and how many times the mean makes one crowded.
BUCKETS, CROWDED = 1 << 20, 8
#: Parts that copies of one set are dealt to.
PARTS = 256
#: How much wider the bitmaps of sets with crowded keys are.
WIDE = 8
#: Most sets of a key in one tile.
TILE = 2_000
#: Most identifiers that are sent to all tasks; beyond, texts are dealt by identifier instead.
MOST_SENT = 2_000_000
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def ngram_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all rows, one after the other, and the bounds of the rows."""
    words, bounds = word_hashes(*text_bytes(texts), IS_SPACE)
    n_rows, counts = len(bounds) - 1, np.diff(bounds)
    with np.errstate(over="ignore"):
        sums = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for i in range(WORDS if len(sums) else 0):
            sums += words[i:len(words) - WORDS + 1 + i] * FACTORS[i]
        rows = row_of(bounds)
        inside = rows[:len(sums)] == rows[WORDS - 1:] if len(sums) else np.zeros(0, bool)
        keys, owner = mix(sums[inside]), rows[:len(sums)][inside]
        few = np.flatnonzero((counts > 0) & (counts < WORDS))
        whole = np.zeros(len(few), np.uint64)
        for i in range(WORDS - 1):
            has = counts[few] > i
            whole[has] += words[bounds[few[has]] + i] * FACTORS[i]
        whole = mix(whole + counts[few].astype(np.uint64))
    keys, owner = np.concatenate([keys, whole]), np.concatenate([owner, few])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[fresh], owner[fresh]
    return keys, np.searchsorted(owner, np.arange(n_rows + 1))


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def widths(sizes: np.ndarray) -> np.ndarray:
    """Bits of the bitmap of a set: the power of two from its size on, 64 at least."""
    return 1 << np.maximum(np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), 6)


def bitmaps(keys: np.ndarray, bounds: np.ndarray, scale: int = 1) -> list[bytes]:
    """For each row the parities of its members by their low bits, in ``scale`` times the usual width."""
    size = np.diff(bounds)
    width = widths(size) * scale
    start = np.concatenate([[0], np.cumsum(width)])
    rows = row_of(bounds)
    places = start[rows] + (keys & (width[rows] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits(np.bincount(places, minlength=int(start[-1])).astype(np.uint8) & 1, bitorder="little").tobytes()
    return [packed[a // 8:b // 8] for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]


def _crowding(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: (doc_id, n, d1, d2) of documents, and (bucket, count) of buckets that a task finds crowded."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        types = [pa.int64()] * 5
        for batch in in_slices(batches, "text"):
            keys, bounds = ngram_sets(batch.column("text"))
            counts += np.bincount((keys & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(_row_sums(keys, bounds)),
                 pa.array(_row_sums(mix(keys ^ FACTORS[0]), bounds)), pa.nulls(n, types[4]), pa.nulls(n, types[4])],
                names=["doc_id", "n", "d1", "d2", "bucket", "count"],
            )
        # A bucket crowded overall is crowded in some task; the last row has what was counted here.
        full = np.flatnonzero(counts >= max(CROWDED, CROWDED * counts.sum() / BUCKETS / 2))
        numbers = np.append(full, -1)
        amounts = np.append(counts[full], counts.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(numbers), batch_type[0]), *[pa.nulls(len(numbers), pa.int64())] * 3, pa.array(numbers), pa.array(amounts)],
            names=["doc_id", "n", "d1", "d2", "bucket", "count"],
        )

    batch_type = [pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()]
    rows = small_batches(docs).select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, d1 bigint, d2 bigint, bucket bigint, count bigint")


def _sets(docs: DataFrame, crowded: np.ndarray) -> DataFrame:
    """(doc_id, n, d1, d2, bits, wide, keys, late): per document its bitmap and the keys it meets others under.

    ``late`` is the number of keys, from the end, that lie in crowded buckets; sets that have some get a
    second bitmap, ``wide``, because many sets will meet there.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(crowded))

    def run(batches):
        crowded = np.unpackbits(shared.value).astype(bool)
        for batch in in_slices(batches, "text"):
            keys, bounds = ngram_sets(batch.column("text"))
            n, rows = np.diff(bounds), row_of(bounds)
            late = crowded[(keys & np.uint64(BUCKETS - 1)).astype(np.int64)]
            order = np.argsort(rows * 2 + late, kind="stable")
            place = np.arange(len(keys)) - bounds[rows]
            first = n - (PERCENT * n + 99) // 100 + 1
            chosen = order[place < first[rows]]
            lists = np.concatenate([[0], np.cumsum(np.where(n > 0, first, 0))])
            late_in = np.bincount(rows[chosen], late[chosen], len(n)).astype(np.int64)
            some = np.flatnonzero(late_in)
            sizes = np.concatenate([[0], np.cumsum(n[some])])
            own = np.concatenate([keys[bounds[k]:bounds[k + 1]] for k in some]) if len(some) else keys[:0]
            wide = dict(zip(some.tolist(), bitmaps(own, sizes, WIDE), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(_row_sums(keys, bounds)), pa.array(_row_sums(mix(keys ^ FACTORS[0]), bounds)),
                 pa.array(bitmaps(keys, bounds), pa.binary()), pa.array([wide.get(k) for k in range(len(n))], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(keys[chosen].view(np.int64))), pa.array(late_in)],
                names=["doc_id", "n", "d1", "d2", "bits", "wide", "keys", "late"],
            )

    rows = small_batches(docs).select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, d1 bigint, d2 bigint, bits binary, wide binary, keys array<bigint>, late bigint")


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    while len(bits) > width:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def enough(overlap, n_a, n_b):
    """Whether an overlap, or a bound of it, reaches the similarity."""
    return 100 * overlap >= PERCENT * (n_a + n_b - overlap)


def bound(bits_a: bytes, n_a: int, bits_b: bytes, n_b: int) -> int:
    """Most members that two sets can have in common, by the bits in which their bitmaps differ."""
    a, b = np.frombuffer(bits_a, np.uint8), np.frombuffer(bits_b, np.uint8)
    width = min(len(a), len(b))
    apart = int(np.bitwise_count((_fold(a, width) ^ _fold(b, width)).view(np.uint64)).sum())
    return (n_a + n_b - apart) // 2


def _passing(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b, n_a, n_b) whose sizes and bitmaps allow the similarity."""
    sized = pairs.filter(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    both = sized.join(bits.select(F.col("rep").alias("b"), F.col("bits").alias("bits_b")), "b").join(
        bits.select(F.col("rep").alias("a"), F.col("bits").alias("bits_a")), "a"
    )

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("bits_a", "n_a", "bits_b", "n_b")), strict=True)
            good = pa.array([bool(enough(bound(x, n, y, m), n, m)) for x, n, y, m in rows], pa.bool_())
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(good)

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, sized.select("a", "b", "n_a", "n_b").schema)


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of stored ``pairs`` whose sets have the similarity, by intersecting sorted members."""
    ids = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    n_ids = ids.count()
    wanted = docs.select("doc_id", "text").join(F.broadcast(ids) if n_ids <= MOST_SENT else ids, "doc_id", "left_semi")

    def members(batches):
        for batch in in_slices(batches, "text"):
            keys, bounds = ngram_sets(batch.column("text"))
            made = [keys[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], names=["doc_id", "members"])

    kind = dict(docs.dtypes)["doc_id"]
    sets = stored(small_batches(wanted).mapInArrow(members, f"doc_id {kind}, members binary").dropDuplicates(["doc_id"]))
    both = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("members").alias("m_b")), "b").join(
        sets.select(F.col("doc_id").alias("a"), F.col("members").alias("m_a")), "a"
    )

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("m_a"), batch.column("m_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                good.append(bool(enough(overlap(x, y), len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "m_a", "m_b").mapInArrow(run, pairs.select("a", "b").schema)


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common members of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _first_meetings(meetings: DataFrame) -> DataFrame:
    """(key, rep, n, late, leader, n_leader) of keys that several sets have; the leader is the smallest of them.

    Keys in crowded buckets take minima before the shuffle and a join that splits; the others, which
    are bounded by what makes a bucket crowded, need one shuffle.
    """
    own = F.struct("rep", "n")
    by_key = Window.partitionBy("key")
    cold = meetings.filter("NOT late").withColumn("low", F.min(own).over(by_key)).withColumn("high", F.max("rep").over(by_key))
    late = meetings.filter("late")
    ends = late.groupBy("key").agg(F.min(own).alias("low"), F.max("rep").alias("high"))
    hot = late.join(ends.filter(F.col("low.rep") < F.col("high")), "key")
    names = ["key", "rep", "n", "late", F.col("low.rep").alias("leader"), F.col("low.n").alias("n_leader")]
    return cold.filter(F.col("low.rep") < F.col("high")).select(*names).unionByName(hot.select(*names))


def _tiles(rows: DataFrame) -> DataFrame:
    """``rows`` (key, rep, n, component) with tile pairs (i, j, second) that their sizes allow to meet."""
    ranked = rows.withColumn("tile", F.floor((F.row_number().over(Window.partitionBy("key").orderBy("n", "rep")) - 1) / TILE))
    ranked = stored(ranked)
    ends = ranked.groupBy("key", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    i, j = ends.alias("i"), ends.alias("j")
    meet = stored(
        i.join(j, "key").filter("i.tile <= j.tile AND 100 * i.high >= %d * j.low" % PERCENT)
        .select("key", F.col("i.tile").alias("i"), F.col("j.tile").alias("j"))
    )
    first = ranked.join(meet.withColumn("tile", F.col("i")), ["key", "tile"]).withColumn("second", F.lit(False))
    second = ranked.join(meet.filter("i < j").withColumn("tile", F.col("j")), ["key", "tile"]).withColumn("second", F.lit(True))
    return first.unionByName(second).drop("tile")


def _tile_pairs(key: int, rows: list[tuple]) -> Iterator[tuple]:
    """Pairs of different components in one tile pair (second, n, rep, component, bits, keys) that the bound lets pass.

    Under a crowded key, rows have all their crowded ``keys``: a pair counts under the first one they
    share, not under each. Rows come in the order of size. Bitmaps of one width stand in one matrix; a set meets all sets of a
    width at once.
    """
    n = np.array([r[1] for r in rows])
    part = np.array([r[3] for r in rows])
    second = np.array([r[0] for r in rows])
    length = np.array([len(r[4]) for r in rows])
    matrices = {w: np.stack([np.frombuffer(rows[k][4], np.uint8) for k in np.flatnonzero(length == w)]) for w in np.unique(length)}
    members = {w: np.flatnonzero(length == w) for w in matrices}
    two_tiles = second.any()
    keys = [frozenset(r[5] or ()) for r in rows]
    for x in range(len(rows)):
        if two_tiles and not second[x]:
            continue
        mine = np.frombuffer(rows[x][4], np.uint8)
        for w, where in members.items():
            if two_tiles:
                ok = ~second[where]
            else:
                ok = where < x
            ok &= (part[where] != part[x]) & (100 * np.minimum(n[where], n[x]) >= PERCENT * np.maximum(n[where], n[x]))
            if not ok.any():
                continue
            width = min(w, len(mine))
            others = matrices[w][ok]
            while others.shape[1] > width:
                others = others[:, :others.shape[1] // 2] ^ others[:, others.shape[1] // 2:]
            apart = np.bitwise_count(np.ascontiguousarray(others ^ _fold(mine, width)).view(np.uint64)).sum(axis=1).astype(np.int64)
            m = n[where[ok]]
            for k in where[ok][enough((m + n[x] - apart) // 2, m, n[x])]:
                if keys[x] and min(keys[x] & keys[int(k)]) != key:
                    continue
                a, b = sorted((x, int(k)), key=lambda r: rows[r][2])
                yield rows[a][2], rows[b][2], int(n[a]), int(n[b])


def _meet_in_tiles(tiles: DataFrame, bits: DataFrame) -> DataFrame:
    """Candidate pairs (a, b, n_a, n_b) of ``tiles``; a task holds one tile pair at a time."""
    kind = dict(tiles.dtypes)["rep"]
    rows = tiles.join(bits.select("rep", F.col("bits").alias("narrow"), "wide", "late_keys"), "rep")
    rows = rows.withColumn("bits", F.when(F.col("late"), F.col("wide")).otherwise(F.col("narrow"))).withColumn(
        "keys", F.when(F.col("late"), F.col("late_keys"))
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "rep")

    def pairs_of(batches):
        at, held = None, []
        for batch in batches:
            for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, i, j) != at:
                    yield from _tile_pairs(at[0], held) if held else ()
                    at, held = (key, i, j), []
                held.append(tuple(row))
        yield from _tile_pairs(at[0], held) if held else ()

    def run(batches):
        out: list[tuple] = []
        for pair in pairs_of(batches):
            out.append(pair)
            if len(out) == 10_000:
                yield _pair_batch(out, id_type)
                out = []
        if out:
            yield _pair_batch(out, id_type)

    id_type = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}.get(kind, pa.int64())
    return ordered.select("key", "i", "j", "second", "n", "rep", "component", "bits", "keys").mapInArrow(
        run, f"a {kind}, b {kind}, n_a bigint, n_b bigint"
    ).distinct()


def _pair_batch(pairs: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    a, b, n_a, n_b = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, id_type), pa.array(b, id_type), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64())],
                                      names=["a", "b", "n_a", "n_b"])


def jaccard_links(docs: DataFrame, every: bool = True) -> tuple[DataFrame, DataFrame]:
    """(members, links). ``members`` has doc_id, n and rep of every row; ``links`` has pairs of representatives.

    The links are all similar pairs, each once, ``a`` below ``b``. With ``every`` off they only connect all sets that a
    chain of similar pairs connects; pairs that other links connect already are then not all among them.
    """
    first = stored(_crowding(docs))
    counted = first.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("count").alias("count"))
    total = counted.filter("bucket = -1").agg(F.sum("count")).collect()[0][0] or 0
    # A crowded bucket has several times the mean, which bounds how many there are.
    full = counted.filter((F.col("bucket") >= 0) & (F.col("count") >= max(64, CROWDED * total / BUCKETS))).select("bucket").toArrow()
    crowded = np.zeros(BUCKETS, bool)
    crowded[full.column("bucket").to_numpy()] = True

    each = first.filter("bucket IS NULL").select("doc_id", "n", "d1", "d2")
    # Classes of equal sets: minima of dealt parts, then of parts, and the same way back, so that a text
    # that makes up a third of all rows is one row per part where classes meet.
    each = each.withColumn("part", F.pmod(F.xxhash64("doc_id", "n"), F.lit(PARTS)))
    of_part = each.filter("n > 0").groupBy("n", "d1", "d2", "part").agg(F.min("doc_id").alias("low"))
    classes = of_part.groupBy("n", "d1", "d2").agg(F.min("low").alias("rep"))
    known = of_part.join(classes, ["n", "d1", "d2"]).select("n", "d1", "d2", "part", "rep")
    members = each.join(known, ["n", "d1", "d2", "part"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))

    # Equal sets have equal bitmaps and keys, so any of the class will do.
    reps = stored(
        _sets(docs, crowded).filter("n > 0").groupBy("n", "d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits"), F.first("wide").alias("wide"), F.first("keys").alias("keys"), F.first("late").alias("late"))
        .filter("rep IS NOT NULL").select("rep", "n", "bits", "wide", "keys", "late")
    )
    own_late = F.when(F.col("late") > 0, F.slice("keys", F.size("keys") - F.col("late").cast("int") + 1, F.col("late").cast("int")))
    bits = reps.select("rep", "bits", "wide", own_late.alias("late_keys"))
    meetings = reps.select("rep", "n", "late", F.size("keys").alias("n_keys"), F.posexplode("keys").alias("place", "key")).select(
        "key", "rep", "n", (F.col("place") >= F.col("n_keys") - F.col("late")).alias("late")
    )
    shared = stored(_first_meetings(meetings))

    if every:
        tiles = _tiles(shared.select("key", "rep", "n", "late", F.col("rep").alias("component")))
        return members, stored(_verified(stored(_meet_in_tiles(tiles, bits)), docs))

    starred = shared.filter("rep <> leader").select(
        F.col("leader").alias("a"), F.col("rep").alias("b"), F.col("n_leader").alias("n_a"), F.col("n").alias("n_b")
    ).distinct()
    asked = stored(_passing(starred, bits))
    star_links = stored(_verified(asked, docs))

    labels = components(star_links)
    labelled = shared.select("key", "rep", "n", "late").join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    tiles = _tiles(labelled.join(open_keys.select("key"), "key", "left_semi"))
    more = stored(_meet_in_tiles(tiles, bits).join(asked.select("a", "b"), ["a", "b"], "left_anti"))
    return members, star_links.unionByName(stored(_verified(more, docs)))


def link_counts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, n_links (how many other rows are similar to it).

    Equal copies are counted by the size of their class, not expanded. Rows with the empty set have no
    links; rows whose class has no doc_id at all get null.
    """
    members, links = jaccard_links(docs.select("doc_id", "text"))
    members = stored(members)
    sizes = members.filter("n > 0 AND rep IS NOT NULL").groupBy("rep").agg(F.count(F.lit(1)).alias("size"))
    both = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("rep"), F.col("a").alias("other"))
    )
    others = both.join(sizes.withColumnRenamed("rep", "other"), "other").groupBy("rep").agg(F.sum("size").alias("others"))
    counts = sizes.join(others, "rep", "left").select("rep", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return members.join(counts, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, 0).otherwise(F.col("n_links")).alias("n_links")
    )


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id that links reach).

    Null, empty and blank texts have the empty set and are alone. A null doc_id is nobody's smallest:
    such a row gets the component of its copies, or null. Repeated rows get one component. Texts of any
    length are read whole. An empty table gives no rows; other columns are not looked at.
    """
    members, links = jaccard_links(docs.select("doc_id", "text"), every=False)
    of_rep = components(links).withColumnRenamed("id", "rep")
    return members.join(of_rep, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component; rows without doc_id stay."""
    kept = jaccard_components(docs).filter("doc_id = component_id OR doc_id IS NULL").select(F.col("doc_id").alias("_kept"))
    kept = kept.distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), r AS (
  SELECT doc_id AS id, doc_id AS c FROM documents
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.id WHERE r.c < l.b
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(c) FROM r WHERE id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""
