"""Reading pages and responses, writing results, and keeping parsed pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from webgrove.schema import PAGES_SCHEMA, RESPONSES_SCHEMA


def read_pages(
    spark: SparkSession, path: str, *, format: str = "parquet", schema: T.StructType | None = PAGES_SCHEMA
) -> DataFrame:
    """``page_id, url, html``; only these columns are read.

    A known schema saves the job that looks into the files for one; pass None to
    take the files' own types.
    """
    reader = spark.read.format(format)
    return (reader.schema(schema) if schema else reader).load(path).select("page_id", "url", "html")


def read_responses(spark: SparkSession, path: str, *, format: str = "parquet") -> DataFrame:
    """``url, headers, body`` and, where present, the override columns."""
    df = spark.read.format(format).load(path)
    names = [f.name for f in RESPONSES_SCHEMA.fields if f.name in df.columns]
    return df.select(*(["page_id"] if "page_id" in df.columns else []), *names)


def read_response_files(spark: SparkSession, path: str, *, glob: str | None = None) -> DataFrame:
    """One response per stored file: its path is the URL, its bytes are the body."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    no_headers = F.create_map().cast(RESPONSES_SCHEMA["headers"].dataType)
    return reader.load(path).select(F.col("path").alias("url"), no_headers.alias("headers"), F.col("content").alias("body"))


def stream_pages(
    spark: SparkSession, path: str, *, schema: T.StructType = PAGES_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """Pages as files arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RESPONSES_SCHEMA).parquet(path)


def write_table(df: DataFrame, path: str, *, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    A session that is one process (``local[..]``) may leave the setting out:
    ``configure`` then names a folder for it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.__dict__.get("_own_folder")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


def store_table(df: DataFrame, name: str) -> DataFrame:
    """Write to a new shared folder and read back: made once, and it survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_docs(docs: DataFrame, path: str | None = None, *, mode: str = "errorifexists") -> DataFrame:
    """Write parsed pages and read them back: many selections, one parse.

    Unlike a cached table this survives lost executors, and a read of a few node
    fields (``nodes.tag``) scans only those columns.  Without a path a new folder
    below the shared one is used.
    """
    path = path or new_folder(docs.sparkSession, "docs")
    docs.write.mode(mode).parquet(path)
    return docs.sparkSession.read.parquet(path)


def write_stream(df: DataFrame, path: str, *, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append a stream to parquet; every row is written once, also after a restart."""
    checkpoint = checkpoint or f"{shared_folder(df.sparkSession)}/{path.strip('/').replace('/', '_')}"
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
