"""Landing CSV batches to bronze: all columns as text, file metadata, each content once a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from covelake.functions.semantics import batch_number
from covelake.sources.storage import Lake

#: Metadata columns of bronze tables: the file, its batch, when it came, and the hash of its content.
FILE, BATCH, AT, CONTENT = "_source_file", "_batch_id", "_ingested_at", "_content"


def scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV rows with a header, every column as text (no inference), and _source_file, _batch_id."""
    header = spark.read.option("header", True).csv(paths[0]).columns
    schema = StructType([StructField(c, StringType()) for c in header])
    rows = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(paths)
    return rows.withColumn(FILE, F.col("_metadata.file_name")).withColumn(BATCH, batch_number(F.col("_metadata.file_name")))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_name, sha256) of a folder's CSV files, hashed on the executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.sha2("content", 256).alias("sha256"))


def loaded(lake: Lake, table: str) -> DataFrame | None:
    """(content, file, batch, rows) of what a bronze table holds: the log of its loads, read from the table itself."""
    name = f"bronze/{table}"
    return lake.read(name).groupBy(CONTENT, FILE, BATCH).agg(F.count(F.lit(1)).alias("rows"), F.min(AT).alias("ingested_at")) if lake.exists(name) else None


def ingest(lake: Lake, table: str, folder: str, batch: int | None = None) -> list[str]:
    """Loads files whose content the table doesn't hold; returns their names. A name without a batch number is an error.

    Each file is one append, data and its hash together, so a crash leaves it loaded or not. Of a batch with a bad name, nothing is loaded.
    """
    found = digests(lake.spark, folder).withColumn("batch", batch_number(F.col("file_name")))
    if batch is not None:
        found = found.where(F.col("batch") == batch)
    held = loaded(lake, table)
    if held is not None:
        found = found.join(held.select(F.col(CONTENT).alias("sha256")), "sha256", "left_anti")
    new = found.groupBy("sha256").agg(F.min(F.struct("file_name", "path", "batch")).alias("f")).select("sha256", "f.*").orderBy("file_name").collect()  # one row a file
    bad = [r.file_name for r in new if r.batch is None]
    if bad:
        raise ValueError(f"no batch number in {bad}")
    for r in new:
        # the same content under one tag: loads that race leave it once
        lake.append(f"bronze/{table}", scan(lake.spark, [r.path]).withColumn(AT, F.current_timestamp()).withColumn(CONTENT, F.lit(r.sha256)), r.sha256[:16])
    return [r.file_name for r in new]


def ingest_all(lake: Lake, folders: dict[str, str], batch: int | None = None) -> dict[str, list[str]]:
    """``ingest`` for each table and its folder."""
    return {table: ingest(lake, table, folder, batch) for table, folder in folders.items()}


def inferred(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV rows with types inferred from all rows of the files, dates and timestamps included; empty fields are null."""
    return spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", 1.0).option("preferDate", True).csv(paths)


def typed(spark: SparkSession, paths: list[str], schema: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV rows by a given schema: unreadable values and lines fail the read, empty fields are null."""
    return spark.read.option("header", True).option("mode", "FAILFAST").option("dateFormat", date_format).option("nullValue", "").schema(schema).csv(paths)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV folder with headers, empty fields for nulls; replaces what is there."""
    df.write.option("header", True).option("nullValue", "").option("dateFormat", "yyyy-MM-dd").mode("overwrite").csv(path)


def stream_csv(spark: SparkSession, folder: str, schema: StructType, rescue: str | None = None) -> DataFrame:
    """The same rows as a file stream; each file is read once by its checkpoint.

    With ``rescue``, a line that doesn't fit the schema (more or fewer fields) keeps its text in that column instead of losing it.
    """
    wanted = schema if rescue is None else StructType([*schema.fields, StructField(rescue, StringType())])
    reader = spark.readStream.option("header", True).option("enforceSchema", True).schema(wanted)
    rows = (reader if rescue is None else reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescue)).csv(folder)
    return rows.withColumn(FILE, F.col("_metadata.file_name")).withColumn(BATCH, batch_number(F.col("_metadata.file_name"))).withColumn(AT, F.current_timestamp())


def widened(spark: SparkSession, folder: str) -> StructType:
    """All columns of a folder's files as text, in the order they are first met by file name: what a stream restarts with after a new column came."""
    names: dict[str, None] = {}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path").orderBy("path").collect()  # one row a file
    for r in files:
        names.update(dict.fromkeys(spark.read.option("header", True).csv(r.path).columns))
    return StructType([StructField(c, StringType()) for c in names])


def write_available(df: DataFrame, target: str, checkpoint: str) -> None:
    """Appends what is there and stops."""
    df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
