"""What several operators share: written tables, text patterns, and the hashes of words."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.session import ensure_checkpoint_dir

#: White space as the contracts define it: blank, and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends, columns stay prunable."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the Arrow batches that its session hands to Python by rows and by bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with as many underscores before it as make it a new column name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def words_count(text: Column) -> Column:
    """Number of words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACES)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of rows that no model may learn from; a null identifier is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


# ---- word hashes over whole Arrow batches: no per-word Python -----------------------------------

_RNG = np.random.default_rng(20240607)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys so that any of their bits can serve as a bucket."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; a worker keeps the longest run of them it has needed."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(max(n, 1 << 20), np.uint64(base), dtype=np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes below 128 that are no digit or lower-case letter; larger bytes always belong to words.
IS_BREAK = np.ones(256, bool)
IS_BREAK[48:58] = False
IS_BREAK[97:123] = False
IS_BREAK[128:] = False


def word_hashes(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all rows after lower-casing A-Z, and where each row's words start.

    ``raw`` and ``offsets`` come from ``text_bytes``; a word ends at a byte in ``breaks`` and at the
    end of its row. The hash is a polynomial in an odd base over random byte codes, from one running
    sum over the batch, so the cost is a few passes over the bytes.
    """
    n_rows = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n_rows + 1, np.int64)
    low = LOWER[raw]
    inside = ~breaks[low]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    # a row boundary inside a run of word bytes cuts it
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    starts[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        up, down = powers(int(BASE), len(raw)), powers(_inverse(int(BASE)), len(raw))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE_CODE[low] * up, out=total[1:])
        hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(first, offsets)


def row_of(bounds: np.ndarray) -> np.ndarray:
    """Row number of each entry, from the bounds of the rows."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def in_slices(batches, text: str, most_bytes: int = 1_000_000):
    """Cut record batches so that the texts of a slice stay near ``most_bytes``; one row is never cut.

    Hashing holds about ten arrays of eight bytes per byte of text, in every worker of an executor.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // most_bytes
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
