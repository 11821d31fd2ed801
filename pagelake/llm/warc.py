"""WARC archives of pages and a two-level capture index over them.

Archives are WARC 1.1 files, one gzip member per record, that Spark's text writer lays down in any file
system; its line separator is an empty gzip member, which readers of gzip pass over. Payloads seen before become ``revisit``
records. The archives are read back with Spark's binary reader, and the records found there fill the
index: keys of reversed hosts, sorted, cut into compressed blocks, with a sparse directory of first
keys. A lookup finds the part by the parts' bounds, the block by binary search in the directory of that
part, the captures by binary search in the block, and then reads the byte range at its place in the archive.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm.common import in_slices, small_batches, stored
from pagelake.session import ensure_checkpoint_dir

DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: A gzip member that holds nothing. Fixed value.
NOTHING = bytes.fromhex("1f8b0800000000000003" "0300" "0000000000000000")
LEVEL = 3
ARCHIVE_BYTES = 16 << 20
BLOCK_KEYS = 500

RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string,"
    " offset bigint, length bigint, intact boolean, archive string"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_digests(pages: DataFrame) -> DataFrame:
    """(page_id, digest, size) of each payload; null html is the empty payload."""

    def run(batches):
        for batch in batches:
            payloads = [(h or "").encode() for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), pa.array(map(sha1_base32, payloads), pa.string()),
                 pa.array(map(len, payloads), pa.int64())], names=["page_id", "digest", "size"],
            )

    rows = small_batches(pages).select("page_id", "html")
    return rows.mapInArrow(run, "page_id bigint, digest string, size bigint")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. The length of the full payload is kept in revisits too."""
    body = b"" if revisit else payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=SAFE)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(head).encode() + END + body + END, LEVEL, mtime=0)


#: A target is stored as it is but for blanks, control characters and the percent sign that marks them.
SAFE = "!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~"


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write every page as one record into WARC files under ``path``.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the smallest page_id
    is the response. Null identifiers come last; of repeated rows with one identifier the smallest is
    one of several, and all rows with that identifier are responses. Null html is an empty payload.
    """
    digests = page_digests(pages)
    total = digests.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()[0]
    files = max(1, -(-((total["bytes"] or 0) + 500 * total["rows"]) // archive_bytes))
    first = digests.filter(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    again = (
        digests.filter(F.col("size") >= least_bytes).join(first, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("_id"), F.col("first_id").alias("refers_to"), F.lit(True).alias("revisit"))
        .distinct()
    )
    # Both sides are dealt to the archives by identifier, so that payloads move once.
    at = F.coalesce("page_id", F.lit(-(2**63))).alias("_at")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    base = small_batches(base).select("*", at).repartition(int(files), "_at")
    again = again.withColumnRenamed("_id", "page_id").select(at, "refers_to", "revisit").repartition(int(files), "_at")
    rows = base.join(again, "_at", "left").drop("_at")

    def run(batches):
        for batch in in_slices(batches, "html"):
            made = []
            for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                made.append(record(page_id, url, payload, sha1_base32(payload), refers_to, bool(revisit)))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    records = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("encoding", "ISO-8859-1").option("lineSep", NOTHING.decode("latin-1")).text(path)


HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def members_in(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of one archive that hold something."""
    at = 0
    while at < len(data):
        if data.startswith(NOTHING, at):
            at += len(NOTHING)
            continue
        reader = zlib.decompressobj(31)
        content, left = [], memoryview(data)[at:]
        size = 0
        while not reader.eof:
            piece = left[size:size + (1 << 16)]
            if not piece:
                raise ValueError("an archive ends inside a record")
            content.append(reader.decompress(piece))
            size += len(piece)
        size -= len(reader.unused_data)
        yield at, size, b"".join(content)
        at += size


def records_in(data: bytes) -> Iterator[tuple]:
    """The records of one archive, in the columns of ``RECORD`` but for the archive's name."""
    for at, length, content in members_in(data):
        stop = content.index(END)
        head = {k.lower(): v for k, v in HEADER.findall(content, 0, stop + 2)}
        size = int(head[b"content-length"])
        body = content[stop + 4:stop + 4 + size]
        digest = head[b"warc-payload-digest"].decode().removeprefix("sha1:")
        kind = head[b"warc-type"].decode()
        full = int(head[b"warc-payload-length"]) if kind == "revisit" else size
        url = head.get(b"warc-target-uri")
        yield (
            _page(head[b"warc-record-id"]), None if url is None else unquote(url.decode()), kind,
            _page(head[b"warc-refers-to"]) if kind == "revisit" else None, full, digest, at, length,
            content[stop + 4 + size:] == END and (kind == "revisit" or sha1_base32(body) == digest),
        )


def _page(name: bytes) -> int | None:
    number = name.decode().removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; ``intact`` tells whether its digest holds."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path"), batch.column("content"), strict=True):
                rows = [(*r, name.as_py()) for r in records_in(data.as_py())]
                for i in range(0, len(rows), 10_000):
                    part = list(zip(*rows[i:i + 10_000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types, strict=True)], names=names)

    return small_batches(_archives(spark, path)).select("path", "content").mapInArrow(run, RECORD)


def captures(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives (in the shared folder unless ``path`` names one) and read them back."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    return read_archives(spark, path)


# ---- the index ------------------------------------------------------------------------------------


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``com,example)/a?b``. Scheme, port, user and fragment do not count."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", (url or "").split("#")[0], flags=re.I)
    host, slash, path = re.match(r"([^/?]*)([/?]?)(.*)", rest, re.S).groups()
    host = host.rpartition("@")[2].split(":")[0].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + ("/" if slash != "?" else "/?") + path


def build_index(records: DataFrame, path: str, parts: int | None = None, block_keys: int = BLOCK_KEYS) -> None:
    """Write the index of ``records``: ``path``/blocks and ``path``/directory, sorted within parts."""
    spark = records.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.pandas_udf(lambda s: s.map(url_key), "string")
    lines = records.select(
        key("url").alias("key"), F.coalesce("page_id", F.lit(-(2**63))).alias("page_id"), "archive", "offset", "length"
    )
    ordered = lines.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    ordered = ordered.withColumn("part", F.spark_partition_id())

    def run(batches):
        held: list[tuple] = []
        number = 0
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= block_keys:
                yield _block(held[:block_keys], number)
                held, number = held[block_keys:], number + 1
        if held:
            yield _block(held, number)

    blocks = ordered.mapInArrow(run, "part int, block int, first string, last string, n int, data binary")
    blocks.write.parquet(f"{path}/blocks")
    spark.read.parquet(f"{path}/blocks").select("part", "block", "first", "last").write.parquet(f"{path}/directory")


def _block(rows: list[tuple], number: int) -> pa.RecordBatch:
    text = "\n".join(f"{quote(k, safe=SAFE)} {p} {quote(a, safe='/:')} {o} {n}" for k, p, a, o, n, _ in rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[0][5]], pa.int32()), pa.array([number], pa.int32()), pa.array([rows[0][0]]),
         pa.array([rows[-1][0]]), pa.array([len(rows)], pa.int32()), pa.array([zlib.compress(text.encode())], pa.binary())],
        names=["part", "block", "first", "last", "n", "data"],
    )


def lookup(spark: SparkSession, urls: DataFrame, path: str) -> DataFrame:
    """(url, page_id, archive, offset, length) of every capture of the ``url`` values in ``urls``.

    The bounds of the parts, one row each, are all the driver sees. Directory rows of a part meet its
    queries in one group; queries spread over the parts as the keys do.
    """
    directory = spark.read.parquet(f"{path}/directory")
    bounds = directory.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect()
    bounds = sorted((b["first"].encode(), b["last"].encode(), b["part"]) for b in bounds)
    key = F.pandas_udf(lambda s: s.map(url_key), "string")

    def parts_of(keys):
        return keys.map(lambda k: [p for a, b, p in bounds[:bisect.bisect_right(bounds, (k.encode(), b"\xff" * 9, 0))] if b >= k.encode()])

    asked = urls.select("url").distinct().withColumn("key", key("url"))
    asked = asked.withColumn("part", F.explode(F.pandas_udf(parts_of, "array<int>")("key")))

    def blocks_of(left, right):
        import pandas as pd

        right = right.assign(f=right["first"].str.encode("utf-8"), l=right["last"].str.encode("utf-8")).sort_values("block")
        first, last, block = right["f"].tolist(), right["l"].tolist(), right["block"].tolist()
        out = []
        for url, k, part in zip(left["url"], left["key"], left["part"], strict=True):
            i = bisect.bisect_right(first, k.encode()) - 1
            while i >= 0 and last[i] >= k.encode():
                out.append((url, k, part, block[i]))
                i -= 1
        return pd.DataFrame(out, columns=["url", "key", "part", "block"])

    wanted = asked.groupBy("part").cogroup(directory.groupBy("part")).applyInPandas(
        blocks_of, "url string, key string, part int, block int"
    )
    # A block is unpacked once for all that ask for it.
    asked = wanted.groupBy("part", "block").agg(F.collect_list(F.struct("url", "key")).alias("asked"))
    found = asked.join(spark.read.parquet(f"{path}/blocks").select("part", "block", "data"), ["part", "block"])

    def search(batches):
        for batch in batches:
            out = []
            for wanted, data in zip(batch.column("asked").to_pylist(), batch.column("data"), strict=True):
                lines = [x.split(" ") for x in zlib.decompress(data.as_py()).decode().split("\n")]
                keys = [unquote(x[0]).encode() for x in lines]
                for w in wanted:
                    k = w["key"].encode()
                    for x in lines[bisect.bisect_left(keys, k):bisect.bisect_right(keys, k)]:
                        page_id = int(x[1])
                        out.append((w["url"], None if page_id == -(2**63) else page_id, unquote(x[2]), int(x[3]), int(x[4])))
            if out:
                types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["url", "page_id", "archive", "offset", "length"])

    return found.select("asked", "data").mapInArrow(search, "url string, page_id bigint, archive string, offset bigint, length bigint")


def _open(archive: str):
    """A file of any system Arrow knows, for reads at a place."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", archive)))
    return system.open_input_file(name)


def _reachable(archives: DataFrame) -> bool:
    """Whether Python can read at a place in the archives; if not, Spark's reader has to hand them over."""
    some = archives.limit(1).collect()
    try:
        for r in some:
            _open(r["archive"]).close()
    except (OSError, ValueError, ImportError):
        return False
    return True


def read_ranges(spark: SparkSession, hits: DataFrame, path: str) -> DataFrame:
    """``hits`` of ``lookup`` with the bytes of their records.

    Hits are grouped by archive, which is opened once; each record is read at its offset, and nothing else.
    In a file system that only Spark can reach, its reader has no such reads: there the archives are scanned.
    """
    if not _reachable(hits.select("archive")):
        data = _archives(spark, path).select(F.col("path").alias("archive"), "content")
        return hits.join(data, "archive").select(
            *hits.columns, F.substring("content", F.col("offset").cast("int") + 1, F.col("length").cast("int")).alias("record")
        )
    schema = hits.withColumn("record", F.lit(b"")).schema
    names = [*hits.columns, "record"]

    def run(batches):
        at, file = None, None
        for batch in batches:
            for some in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                made = []
                for archive, offset, length in zip(*(some.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                    if archive != at:
                        if file is not None:
                            file.close()
                        at, file = archive, _open(archive)
                    file.seek(offset)
                    made.append(file.read(length))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(made, pa.binary())], names=names)
        if file is not None:
            file.close()

    # A hit is small but pulls a whole record: as many tasks as archives, whatever the hits themselves weigh.
    archives = hits.select("archive").distinct().count()
    return hits.repartition(max(1, archives), "archive").sortWithinPartitions("archive", "offset").mapInArrow(run, schema)


def indexed_captures(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives and index them, look every page up, and read the records found by their ranges."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, f"{path}/archives", least_bytes)
    records = read_archives(spark, f"{path}/archives").select("url", "page_id", "archive", "offset", "length")
    build_index(stored(records), f"{path}/index")
    # One address of each key finds all captures of the key.
    key = F.pandas_udf(lambda s: s.map(url_key), "string")
    urls = pages.select("url").distinct().groupBy(key("url").alias("key")).agg(F.min("url").alias("url"))
    hits = stored(lookup(spark, urls, f"{path}/index").select("archive", "offset", "length"))
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def run(batches):
        for batch in batches:
            rows = []
            for archive, offset, data in zip(*(batch.column(c) for c in ("archive", "offset", "record")), strict=True):
                for *row, at, length, intact in records_in(data.as_py()):
                    rows.append((*row, at + offset.as_py(), length, intact, archive.as_py()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return small_batches(read_ranges(spark, hits, f"{path}/archives")).mapInArrow(run, RECORD)


SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (
  SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex
), b AS (
  SELECT *, list_transform(range(1, 41), lambda i: strpos('0123456789abcdef', substr(hex, i, 1)) - 1) AS h
  FROM p JOIN g USING (hex)
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((h[(5 * i) // 4 + 1] * 16 + coalesce(h[(5 * i) // 4 + 2], 0)) >> (3 - (5 * i) % 4)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to, true AS intact
FROM b
"""
