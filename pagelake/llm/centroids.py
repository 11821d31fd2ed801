"""Centroid clustering in integers, by dictionaries of distinct subvectors.

The dimensions are cut into blocks of equal width. Every block of every vector is replaced, without loss, by the
number of its subvector among the distinct ones of that block. A round computes the squared distance of each
distinct subvector to the same block of each centroid once; the distance of a vector is the sum of what its codes
point at, so all arithmetic is exact and no coordinate is read again. The sums of new centroids come from
histograms of codes in the same way: a task hands on one row per cluster and dimension, however many vectors it saw.

The width is the largest whose dictionaries pay (at most a quarter of the blocks they replace) and stay below
``MOST_ENTRIES``; only such dictionaries are sent to tasks. Where even single dimensions have more distinct values,
vectors stay apart in rows of blocks and meet their distances in a join, with the same results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import small_batches, stored

#: Most entries of all dictionaries together that are held by the driver and by each task.
MOST_ENTRIES = 1 << 18
WIDTHS = (8, 4, 2, 1)
#: Vectors that a task looks up at a time.
AT_ONCE = 1 << 15
#: Components from here on could make a sum of squares that does not fit a long.
LARGEST = 1 << 27

RESULT = "vec_id {id}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def integer_vectors(rows: DataFrame, dims: int = 64, scale: int = 1024) -> DataFrame:
    """(vec_id, v) of the rows with exactly ``dims`` components, none null or non-finite; v is floor(scale * x)."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    good = (F.size("embedding") == dims) & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return rows.filter(good).select("vec_id", F.transform(wide, lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))


def _blocks(width: int, dims: int):
    return F.transform(F.sequence(F.lit(0), F.lit(dims // width - 1)), lambda b: F.struct(
        b.alias("block"), F.slice("v", b * width + 1, F.lit(width)).alias("sub")))


def _width(vectors: DataFrame, n: int, dims: int, most: int) -> int:
    """The widest block whose dictionaries pay, from sketches of the distinct subvectors of every block."""
    widths = [w for w in WIDTHS if dims % w == 0]
    counted = vectors.agg(*(
        F.approx_count_distinct(F.xxhash64(F.slice("v", b * w + 1, w)), 0.05).alias(f"w{w}_{b}")
        for w in widths for b in range(dims // w)
    )).first()
    for w in widths:
        entries = sum(counted[f"w{w}_{b}"] for b in range(dims // w))
        if entries <= min(most, n * (dims // w) / 4):
            return w
    return 1


class Dictionaries:
    """The distinct subvectors of each block, in the order of their codes."""

    def __init__(self, subs: list[np.ndarray]):
        self.subs = subs
        self.width = subs[0].shape[1]
        self.starts = np.concatenate([[0], np.cumsum([len(s) for s in subs])])

    @staticmethod
    def packed(sub: np.ndarray) -> np.ndarray:
        """One sortable key per subvector."""
        raw = np.ascontiguousarray((sub + LARGEST).astype(">u4"))
        return raw.view(f"S{4 * sub.shape[1]}").ravel()

    def codes(self, v: np.ndarray) -> np.ndarray:
        """The codes of each vector, as positions in all dictionaries laid end to end."""
        out = np.empty((len(v), len(self.subs)), np.int32)
        for b, sub in enumerate(self.subs):
            own = np.ascontiguousarray(v[:, b * self.width:(b + 1) * self.width])
            out[:, b] = self.starts[b] + np.searchsorted(self.packed(sub), self.packed(own))
        return out

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """(entries, centroids): squared distance of every entry to its block of every centroid."""
        parts = centroids.reshape(len(centroids), len(self.subs), self.width)
        return np.concatenate([
            ((sub[:, None, :] - parts[None, :, b, :]) ** 2).sum(2) for b, sub in enumerate(self.subs)
        ])

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """(clusters, dimensions): sums of vectors from how often each entry stands in each cluster."""
        return np.concatenate([counts[:, a:z] @ sub for sub, a, z in zip(self.subs, self.starts, self.starts[1:])], axis=1)


def _dictionaries(vectors: DataFrame, width: int, dims: int, most: int) -> Dictionaries | None:
    """The dictionaries, if they have at most ``most`` entries together."""
    found = stored(vectors.select(F.explode(_blocks(width, dims)).alias("x")).select("x.*").distinct())
    if found.count() > most:
        return None
    data = found.toPandas()
    subs = []
    for b in range(dims // width):
        sub = np.array(data.loc[data["block"] == b, "sub"].tolist(), np.int64).reshape(-1, width)
        subs.append(sub[np.argsort(Dictionaries.packed(sub))])
    return Dictionaries(subs)


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def encode(vectors: DataFrame, known: Dictionaries, dims: int) -> DataFrame:
    """(vec_id, codes) of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            codes = shared.value.codes(_matrix(batch.column("v"), dims, np.int64))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), codes.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), flat.cast(pa.list_(pa.int32()))], names=["vec_id", "codes"])

    kind = dict(vectors.dtypes)["vec_id"]
    return small_batches(vectors).select("vec_id", "v").mapInArrow(run, f"vec_id {kind}, codes array<int>")


def _gathered(batches):
    """Record batches joined until they hold ``AT_ONCE`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _nearest(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, distance): partial distances summed by code; the smaller number wins a tie."""
    total = np.zeros((len(codes), table.shape[1]), np.int64)
    for b in range(codes.shape[1]):
        total += table[codes[:, b]]
    cluster = total.argmin(1)
    return cluster.astype(np.int32), total[np.arange(len(total)), cluster]


class _ByCode:
    """Rounds over codes; what tasks are sent is bounded by the dictionaries."""

    def __init__(self, vectors: DataFrame, known: Dictionaries, dims: int):
        self.rows, self.known, self.dims = stored(encode(vectors, known, dims)), known, dims
        self.context = vectors.sparkSession.sparkContext
        self.subs = self.context.broadcast(known)

    def totals(self, centroids: np.ndarray) -> DataFrame:
        """(cluster, dim, total, n) once all vectors are with their nearest centroid."""
        table, subs, n_blocks = self.context.broadcast(self.known.distances(centroids)), self.subs, len(self.known.subs)

        def run(batches):
            near, known = table.value, subs.value
            counts = np.zeros((near.shape[1], len(near)), np.int64)
            sizes = np.zeros(near.shape[1], np.int64)
            for rows in _gathered(batches):
                codes = _matrix(rows.column("codes").chunk(0), n_blocks, np.int64)
                cluster, _ = _nearest(codes, near)
                at = cluster[:, None].astype(np.int64) * len(near) + codes
                counts += np.bincount(at.ravel(), minlength=counts.size).reshape(counts.shape)
                sizes += np.bincount(cluster, minlength=len(sizes))
            sums, met = known.sums(counts), np.flatnonzero(sizes)
            k, d = np.meshgrid(met, np.arange(sums.shape[1]), indexing="ij")
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.ravel().astype(np.int32)), pa.array(d.ravel().astype(np.int32)),
                 pa.array(sums[met].ravel()), pa.array(sizes[k.ravel()])], names=["cluster", "dim", "total", "n"])

        each = small_batches(self.rows).select("codes").mapInArrow(run, "cluster int, dim int, total bigint, n bigint")
        return each.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """(vec_id, cluster, distance) of every vector."""
        table, n_blocks = self.context.broadcast(self.known.distances(centroids)), len(self.known.subs)

        def run(batches):
            for rows in _gathered(batches):
                cluster, distance = _nearest(_matrix(rows.column("codes").chunk(0), n_blocks, np.int64), table.value)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id").chunk(0), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])

        kind = dict(self.rows.dtypes)["vec_id"]
        return small_batches(self.rows).mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


class _ByJoin:
    """Rounds where the dictionaries are too large to send: each block of a vector joins its row of distances."""

    def __init__(self, vectors: DataFrame, dims: int):
        self.rows = stored(vectors.withColumn("row", F.monotonically_increasing_id()))
        self.cells = self.rows.select("row", F.posexplode("v").alias("dim", "x"))
        self.entries = stored(self.cells.select("dim", "x").distinct())

    def _with_cluster(self, centroids: np.ndarray) -> DataFrame:
        own = F.element_at(F.lit([[int(c) for c in column] for column in centroids.T]), F.col("dim") + 1)
        entries = self.entries.withColumn("near", F.transform(own, lambda c: (F.col("x") - c) * (F.col("x") - c)))
        total = F.array(*(F.sum(F.col("near")[k]) for k in range(len(centroids))))
        met = self.cells.join(entries, ["dim", "x"]).groupBy("row").agg(total.alias("near"))
        best = met.select("row", (F.array_position("near", F.array_min("near")) - 1).cast("int").alias("cluster"),
                          F.array_min("near").alias("distance"))
        return self.rows.join(best, "row")

    def totals(self, centroids: np.ndarray) -> DataFrame:
        placed = self._with_cluster(centroids).select("cluster", F.posexplode("v").alias("dim", "x"))
        return placed.groupBy("cluster", "dim").agg(F.sum("x").alias("total"), F.count(F.lit(1)).alias("n"))

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        return self._with_cluster(centroids).select("vec_id", "cluster", "distance")


def cluster(rows: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3",
            most_entries: int = MOST_ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` rounds; see ``clusters`` for what is kept."""
    vectors = stored(integer_vectors(rows, dims, scale))
    n, far = vectors.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    if not n:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, dims), np.int64)
    if far >= LARGEST:
        raise ValueError(f"components of {far} in units of 1/{scale}: squared distances do not fit a long")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(order, "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], np.int64)
    known = _dictionaries(vectors, _width(vectors, n, dims, most_entries), dims, most_entries)
    job = _ByCode(vectors, known, dims) if known else _ByJoin(vectors, dims)
    for _ in range(rounds):
        # One row per cluster and dimension comes back.
        for r in job.totals(centroids).collect():
            centroids[r["cluster"], r["dim"]] = r["total"] // r["n"]
    return job.assigned(centroids), centroids


def clusters(rows: DataFrame, **options) -> DataFrame:
    """One row per kept row: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Rows whose embedding is null, has another number of components, or holds a null or non-finite one are left
    out; other columns are not looked at. Repeated rows and repeated identifiers count as often as they stand
    there. A null identifier counts as empty text where the first centroids are chosen; of rows with one identifier
    the smaller vector comes first. With fewer kept rows than centroids there are that many centroids; an empty
    table gives no rows. Components of 2**27 / 1024 and more raise an error.
    """
    placed, centroids = cluster(rows, **options)
    spark, kind = rows.sparkSession, dict(rows.dtypes)["vec_id"]
    if not len(centroids):
        return spark.createDataFrame([], RESULT.format(id=kind))
    placed = stored(placed)
    own = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    marks = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame(
        [(i, own.get(i, 0), sum(own.values()), marks[i]) for i in range(len(marks))],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(k: int = 8, rounds: int = 10) -> str:
    """The same in SQL, one table of assignments and one of centroids per round."""
    steps = [f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INT AS c, x FROM v
  ORDER BY sha256('3:' || vec_id) LIMIT {k}
)"""]
    near = """, a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(x) AS x, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT vec_id, v.x, c, (list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, k.x) + list_inner_product(k.x, k.x))::BIGINT AS d
    FROM v, c{r} AS k) GROUP BY vec_id
)"""
    move = """, c{n} AS MATERIALIZED (
  SELECT c, coalesce(m.x, k.x) AS x FROM c{r} AS k LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS x FROM (
      SELECT best.c AS c, i, sum(x[i]::BIGINT)::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) AS t(i) GROUP BY ALL
    ) GROUP BY c) AS m USING (c)
)"""
    for r in range(rounds):
        steps += [near.format(r=r), move.format(r=r, n=r + 1)]
    steps.append(near.format(r=rounds))
    steps.append(f"""
SELECT vec_id, best.c AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, mark AS centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(array_to_string(list_transform(x, lambda e: e::BIGINT), ',')) AS mark FROM c{rounds}) AS m ON m.c = best.c
""")
    return "".join(steps)


SQL = sql()
