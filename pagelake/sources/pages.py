"""Page tables, HTML folders, event logs, baselines, and the quarantine sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake import schemas
from pagelake.functions.urls import failure_key
from pagelake.operators.metrics import safe_events


def read_pages(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet table of collected pages."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_html_folder(spark: SparkSession, path: str) -> DataFrame:
    """One row per HTML file; the file name is the URL key."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("url"),
        F.col("value").alias("html"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
    )


def stream_pages(spark: SparkSession, path: str, schema: str = schemas.PAGES, files_per_trigger: int = 100) -> DataFrame:
    """Pages as they arrive in a folder of Parquet files."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def raw_html(pages: DataFrame) -> DataFrame:
    return pages.select("url", "html")


def read_events(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.EVENT).format(fmt).load(path)


def write_events(events: DataFrame, path: str, batch: int = 0) -> None:
    """Sanitised events as JSON lines under ``batch=<id>``; writing a batch again replaces it."""
    safe_events(events).write.mode("overwrite").json(f"{path.rstrip('/')}/batch={batch}")


def read_baseline(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.BASELINE).format(fmt).load(path)


def export_json(records: DataFrame, path: str) -> None:
    """Records as JSON lines with NULL fields spelled out."""
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def to_json(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})


def safe_headers(headers: Column) -> Column:
    """Headers without credentials."""
    sensitive = F.array(*[F.lit(h) for h in K.SENSITIVE_HEADERS])
    return F.map_filter(headers, lambda k, v: ~F.array_contains(sensitive, F.lower(k)))


def blocked_records(pages: DataFrame, max_bytes: int = K.BLOCKED_BODY_BYTES) -> DataFrame:
    """What is kept of a blocked response: body bytes up to the limit and harmless headers."""
    body = F.encode("html", "utf-8")
    columns = [
        "url", F.substring(body, 1, max_bytes).alias("body"), F.octet_length("html").alias("body_bytes")
    ]
    if "status_code" in pages.columns:
        columns.append("status_code")
    if "headers" in pages.columns:
        columns.append(safe_headers(F.col("headers")).alias("headers"))
    return pages.select(*columns)


def quarantine(failed: DataFrame, path: str, batch: int = 0) -> None:
    """Failed pages, by kind of failure, under a file-safe key; writing a batch again replaces it."""
    failed.withColumn("failure_key", failure_key(F.col("url"))).write.mode("overwrite").partitionBy(
        "error_kind"
    ).parquet(f"{path.rstrip('/')}/batch={batch}")
