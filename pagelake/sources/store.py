"""Keyed Parquet tables under one folder, made visible by one commit log.

A commit writes a folder per table, cut into buckets by the hash of the key, and then one manifest that names the live
folders of all tables. Readers follow the newest manifest, so a batch is seen in all its tables or in none, also when
its writer dies half way. A batch committed again replaces its own folders.

Lookups read only the buckets that hold asked keys. Reads do not regroup what is already one row per key: the largest
folder is passed through, less the keys that newer folders replace.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

#: Rows of a bucket that a folder aims at, and most buckets of a folder.
BUCKET_ROWS, MOST_BUCKETS = 250_000, 8192
ATTEMPTS = 20


@dataclass(frozen=True)
class Folder:
    """One written batch of a table: where it is, and how many buckets and rows it has."""

    path: str
    batch: int
    buckets: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, list[Folder]]

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "tables": {k: [asdict(f) for f in v] for k, v in self.tables.items()}})

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["version"], {k: [Folder(**f) for f in v] for k, v in raw["tables"].items()})


class CommitConflict(RuntimeError):
    """Another writer changed what this commit was built on."""


def bucket_of(key: str, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def latest(rows: DataFrame, key: str, version: str) -> DataFrame:
    """Latest row per key; partially aggregated before the shuffle, so a hot key is no problem."""
    payload = F.struct(*[F.col(c) for c in rows.columns if c not in (key, version)])
    return rows.groupBy(key).agg(F.max_by(payload, version).alias("v")).select(key, "v.*")


class Store:
    """The commit log of a folder of keyed tables. One manifest is one state of all of them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._log = f"{self.path}/_log"

    # -- files of the log, through the file system of the path --

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        log = self._path(self._log)
        if not self._files().exists(log):
            return []
        names = (f.getPath().getName() for f in self._files().listStatus(log))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or an earlier one that is still there."""
        versions = self._versions()
        if not versions and version is None:
            return Manifest(0, {})
        stream = self._files().open(self._path(f"{self._log}/{version or versions[-1]:020d}.json"))
        try:
            return Manifest.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: Manifest) -> None:
        """Make ``manifest`` the newest; fails if its version is taken, so two writers cannot both win."""
        draft, final = f"{self._log}/.{uuid.uuid4().hex}", f"{self._log}/{manifest.version:020d}.json"
        out = self._files().create(self._path(draft), False)
        out.write(bytearray(manifest.to_json().encode()))
        out.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        none = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        none[0] = getattr(hadoop, "Options$Rename").NONE
        context = hadoop.FileContext.getFileContext(self._path(self._log).toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._path(draft), self._path(final), none)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                self._files().delete(self._path(draft), False)
                raise CommitConflict(f"version {manifest.version} was written meanwhile") from None
            raise

    def _change(self, change) -> Manifest:
        """Publish ``change`` of the newest manifest, again if another writer was first."""
        for _ in range(ATTEMPTS):
            now = self.manifest()
            new = replace(change(now), version=now.version + 1)
            try:
                self._publish(new)
                return new
            except CommitConflict:
                continue
        raise CommitConflict(f"{ATTEMPTS} attempts to commit to {self.path} met other writers")

    # -- what users call --

    def table(self, name: str, schema: str, key: str) -> KeyedTable:
        return KeyedTable(self, name, schema, key)

    def commit(self, batch: int, rows: dict[KeyedTable, DataFrame]) -> Manifest:
        """Write ``rows`` (one row per key each) and make all of them visible at once, in place of an earlier try of ``batch``."""
        written = {table.name: table.write(df, batch) for table, df in rows.items()}

        def add(now: Manifest) -> Manifest:
            tables = {**now.tables}
            for name, folder in written.items():
                tables[name] = [f for f in tables.get(name, []) if f.batch != batch] + [folder]
            return replace(now, tables=tables)

        return self._change(add)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the newest ``keep`` manifests names, and older manifests; returns what went.

        Run it when no commit is under way: a folder that is written but not yet committed is not named either.
        """
        versions = self._versions()
        kept = [self.manifest(v) for v in versions[-max(1, keep):]]
        named = {f.path for m in kept for folders in m.tables.values() for f in folders}
        files, gone = self._files(), []
        for name in {n for m in kept for n in m.tables}:
            for found in files.globStatus(self._path(f"{self.path}/{name}/batch=*/commit=*")) or []:
                relative = "/".join(found.getPath().toString().split("/")[-3:])
                if not any(path.startswith(relative + "/") for path in named):
                    files.delete(found.getPath(), True)
                    gone.append(relative)
        for version in versions[:-max(1, keep)]:
            files.delete(self._path(f"{self._log}/{version:020d}.json"), False)
        return sorted(gone)


class KeyedTable:
    """One table of a store; the last batch wins per key."""

    def __init__(self, store: Store, name: str, schema: str, key: str) -> None:
        self.store, self.name, self.schema, self.key = store, name, schema, key
        self.spark = store.spark

    def folders(self, before: int | None = None) -> list[Folder]:
        """Live folders, of batches below ``before`` if given, in the order of their batches."""
        live = self.store.manifest().tables.get(self.name, [])
        return sorted((f for f in live if before is None or f.batch < before), key=lambda f: f.batch)

    def write(self, rows: DataFrame, batch: int) -> Folder:
        """Write a folder that no manifest names yet. ``rows`` are read twice: to count them, and to write them."""
        names = t.StructType.fromDDL(self.schema).names
        n = rows.count()
        buckets = min(MOST_BUCKETS, 1 << max(0, (n - 1) // BUCKET_ROWS).bit_length())
        path = f"{self.name}/batch={batch}/commit={uuid.uuid4().hex}/buckets={buckets}"
        dealt = rows.select(*names, bucket_of(self.key, buckets).alias("bucket"))
        dealt.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.store.path}/{path}")
        return Folder(path, batch, buckets, n)

    def _load(self, folders: list[Folder], touched: dict[int, list[int]] | None) -> DataFrame:
        """Rows of some folders with their batch, only of the touched buckets if given."""
        names = t.StructType.fromDDL(self.schema).names
        folders = [f for f in folders if f.rows]
        if not folders:
            return self.spark.createDataFrame([], f"{self.schema}, batch bigint")
        full = t.StructType.fromDDL(f"{self.schema}, batch bigint, commit string, buckets int, bucket int")
        root = f"{self.store.path}/{self.name}"
        found = self.spark.read.schema(full).option("basePath", root).parquet(*[f"{self.store.path}/{f.path}" for f in folders])
        if touched is not None:
            some = F.lit(False)
            for buckets in {f.buckets for f in folders}:
                some = some | ((F.col("buckets") == buckets) & F.col("bucket").isin(touched.get(buckets, [])))
            found = found.filter(some)
        return found.select(*names, "batch")

    def _current(self, folders: list[Folder], touched: dict[int, list[int]] | None) -> DataFrame:
        """The newest row of each key, without regrouping the largest folder."""
        if not folders:
            return self._load([], None).drop("batch")
        largest = max(range(len(folders)), key=lambda i: folders[i].rows)

        def newest(some: list[Folder]) -> DataFrame:
            rows = self._load(some, touched)
            return rows.drop("batch") if len(some) == 1 else latest(rows, self.key, "batch")

        old, new = folders[:largest + 1], folders[largest + 1:]
        if not new:
            return newest(old)
        changed = newest(new)
        kept = newest(old).join(changed.select(F.col(self.key).alias("__key")), F.col(self.key).eqNullSafe(F.col("__key")), "left_anti")
        return kept.unionByName(changed)

    def read(self, before: int | None = None) -> DataFrame:
        """All current rows; as they were before a batch, if one is given."""
        return self._current(self.folders(before), None)

    def _touched(self, keys: DataFrame, folders: list[Folder]) -> dict[int, list[int]]:
        """The buckets that hold some key, for each number of buckets in use; no more than there are buckets."""
        sizes = sorted({f.buckets for f in folders if f.buckets > 1})
        touched = {1: [0]}
        if sizes:
            row = keys.agg(*[F.collect_set(bucket_of(self.key, n)).alias(f"b{n}") for n in sizes]).first()
            touched |= {n: sorted(row[f"b{n}"]) for n in sizes}
        return touched

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Stored rows of the given keys, NULL where there are none. ``keys`` are read twice."""
        folders = self.folders(before)
        return keys.join(self._current(folders, self._touched(keys, folders)), self.key, "left")

    def contains(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The given keys that are stored. ``keys`` are read twice."""
        folders = self.folders(before)
        stored = self._load(folders, self._touched(keys, folders)).select(self.key)
        return keys.join(stored, self.key, "left_semi")

    def upsert(self, rows: DataFrame, batch: int) -> None:
        """Commit one row per key to this table alone."""
        self.store.commit(batch, {self: rows})

    def compact(self) -> None:
        """Merge all folders but the newest batch's into one with buckets for their rows, in place.

        The newest batch stays apart, so that it can still be replayed. What is merged stays on disk for
        readers under way until ``vacuum``.
        """
        merged = self.folders()[:-1]
        if len(merged) < 2:
            return
        folder = self.write(self._current(merged, None), merged[-1].batch)

        def swap(now: Manifest) -> Manifest:
            live = now.tables.get(self.name, [])
            if not set(merged) <= set(live):
                raise PySparkException(f"{self.name}: folders were replaced while they were compacted")
            return replace(now, tables={**now.tables, self.name: [f for f in live if f not in merged] + [folder]})

        self.store._change(swap)
