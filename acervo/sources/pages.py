"""Raw pages: JSON folders, page tables, and the page store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acervo.functions.urls import document_type
from acervo.operators.links import latest_per_storage_key
from acervo.schemas import RAW_PAGES, STORED_PAGES
from acervo.sources import manifest

PAGE_BUCKETS = 256
BUCKET_SPLITS = 4  # tasks, and so files, that a rewritten bucket is spread over


def read_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.json`` below ``folder``, one object per file; a malformed file fails the job."""
    return (
        spark.read.schema(RAW_PAGES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .json(folder)
    )


def scan_page_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """``(url, text, type, file, reason)``: one row per file below ``folder``, with why it is no page.

    ``reason`` is null for a page. Malformed and blank files, and pages that lack
    a field, do not stop the others (files of no byte at all are no input to Spark's readers); ``page_rows`` and ``file_rejects`` part the two.
    """
    files = (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    read = files.select("file", "value", F.from_json("value", f"{RAW_PAGES.toDDL()}, _corrupt string", options).alias("page"))
    broken = F.col("page").isNull() | F.col("page._corrupt").isNotNull()
    lacking = F.array_compact(F.array(*(F.when(F.col(f"page.{c}").isNull(), F.lit(c)) for c in RAW_PAGES.names)))
    reason = (
        F.when(F.col("value").rlike(r"^\s*$"), F.lit("empty file"))
        .when(broken, F.lit("malformed JSON"))
        .when(F.size(lacking) > 0, F.concat(F.lit("missing "), F.array_join(lacking, ", ")))
    )
    fields = (F.when(~broken, F.col(f"page.{c}")).alias(c) for c in RAW_PAGES.names)
    return read.select(*fields, "file", reason.alias("reason"))


def page_rows(scanned: DataFrame) -> DataFrame:
    return scanned.filter("reason is null").select("url", "text", "type")


def file_rejects(scanned: DataFrame) -> DataFrame:
    return scanned.filter("reason is not null").select("file", "reason")


def read_page_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table ``(page_id, url, html)`` as raw pages, its id kept."""
    return spark.read.parquet(path).select(
        F.col("page_id").alias("doc_id"),
        "url",
        F.col("html").alias("text"),
        document_type(F.col("url")).alias("type"),
    )


def write_pages(pages: DataFrame, path: str, seq: str = "seq", file_format: str = "parquet", buckets: int = PAGE_BUCKETS) -> None:
    """Put pages into the store at ``path``: one page per storage key, later pages replace earlier ones.

    Pages lie in buckets of their key's hash. A save merges the new pages with the
    stored ones of the buckets that it touches, writes those buckets to a new folder and
    then publishes where each bucket lies, so other buckets are not rewritten, a failed
    save changes nothing, and saving the same pages twice changes nothing either. A
    later page is one with a higher ``seq``, whichever crawl brought it; among equal
    ones the highest URL. A page without a URL or sequence number fails the save.
    ``buckets`` and ``file_format`` are fixed by a store's first save.
    """
    spark = pages.sparkSession
    before = manifest.latest(spark, path)
    if before:
        buckets, file_format = before[0]["buckets"], before[0]["format"]
    lacking = F.raise_error(F.concat(F.lit("page without URL or sequence number: "), F.coalesce("url", F.lit("no URL"))))
    checked = pages.select(
        F.when(F.col("url").isNotNull() & F.col(seq).isNotNull(), F.col("url")).otherwise(lacking).alias("url"),
        "text",
        "type",
        F.col(seq).cast("long").alias("seq"),
    )
    new = latest_per_storage_key(checked).withColumn("bucket", _bucket(buckets))
    folder = manifest.new_folder(path)
    _write(new, f"{folder}/new", file_format)
    fresh = _read(spark, [f"{folder}/new"], file_format)
    touched = [row["bucket"] for row in fresh.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
    places = {row["bucket"]: row["folder"] for row in before if row["bucket"] is not None}
    old = [f"{places[b]}/bucket={b}" for b in touched if b in places]
    if old:
        stored = spark.read.schema(STORED_PAGES).format(file_format).load(old)
        columns = ["url", "text", "type", "seq"]
        merged = latest_per_storage_key(fresh.select(*columns).unionByName(stored.select(*columns)))
        _write(merged.withColumn("bucket", _bucket(buckets)), f"{folder}/pages", file_format)
    places |= dict.fromkeys(touched, f"{folder}/pages" if old else f"{folder}/new")
    rows = [{"bucket": b, "folder": f, "buckets": buckets, "format": file_format} for b, f in sorted(places.items())]
    # A store without pages is published too, under a bucket that no key has.
    rows = rows or [{"bucket": None, "folder": None, "buckets": buckets, "format": file_format}]
    manifest.publish(spark, path, rows, "bucket long, folder string, buckets long, format string", before)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets).cast("long"))


def _write(pages: DataFrame, path: str, file_format: str) -> None:
    """Each bucket from a few tasks, so that a large one is in no single task and a small one in few files."""
    split = F.pmod(F.xxhash64("url", "seq"), F.lit(BUCKET_SPLITS).cast("long"))
    columns = [*STORED_PAGES.names, "bucket"]
    pages.select(*columns).repartition("bucket", split).write.partitionBy("bucket").format(file_format).save(path)


def _read(spark: SparkSession, folders: list[str], file_format: str) -> DataFrame:
    return spark.read.schema(f"{STORED_PAGES.toDDL()}, bucket long").format(file_format).load(folders)


def read_pages_back(spark: SparkSession, path: str) -> DataFrame:
    """``(url, text, type)`` of the newest version of the store."""
    rows = [row for row in manifest.latest(spark, path) if row["bucket"] is not None]
    if not rows:
        return spark.createDataFrame([], RAW_PAGES)
    folders = [f"{row['folder']}/bucket={row['bucket']}" for row in rows]
    return spark.read.schema(STORED_PAGES).format(rows[0]["format"]).load(folders).select("url", "text", "type")
