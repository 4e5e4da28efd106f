"""Batch and streaming readers. Each takes a declared schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas

CORRUPT = "_corrupt_record"


def _with_corrupt(reader, schema: str, keep_corrupt: bool):
    """The reader with its schema; ``keep_corrupt`` keeps a malformed line's text in a column."""
    reader = reader.option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = f"{schema}, {CORRUPT} STRING"
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema)


def read_csv(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """Headered CSV. With ``keep_corrupt`` a malformed line keeps its text in a column."""
    return _with_corrupt(spark.read.option("header", True), schema, keep_corrupt).csv(path)


def read_json(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines. With ``keep_corrupt`` a malformed line keeps its text in a column."""
    return _with_corrupt(spark.read, schema, keep_corrupt).json(path)


def line_counts(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """(lines): records that a text source has, blank lines and each file's header left out."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # Spark takes a file's first line that is not blank for its header.
    per_file = lines.filter(F.trim("value") != "").groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.coalesce(F.sum(F.col("n") - (1 if header else 0)), F.lit(0)).alias("lines")
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_orders(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.ORDERS, keep_corrupt)


def read_order_items(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.ORDER_ITEMS, keep_corrupt)


def read_customers(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.CUSTOMERS, keep_corrupt)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path)


def read_or_empty(read, spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``read(spark, path)``, or no rows of ``schema`` when the path does not exist.

    Any other failure is raised. The path is looked up while the frame is
    analysed, so a missing one shows at once.
    """
    try:
        return read(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stream_json(
    spark: SparkSession,
    path: str,
    schema: str = schemas.ORDER_EVENT,
    files_per_trigger: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON files as they arrive, oldest first; sources are kept for other readers.

    All that is there is one batch, so a backlog's result does not depend on how its
    files are cut: files written in parallel carry no order in time, and in small batches
    an early slice of the past would count as late. ``files_per_trigger`` is for inputs
    whose files arrive in the order of their events. ``keep_corrupt`` keeps a malformed line's
    text in a column.
    """
    reader = _with_corrupt(spark.readStream, schema, keep_corrupt)
    reader = reader.option("latestFirst", False).option("cleanSource", "off")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: str = schemas.ORDER_EVENT,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Events of a Kafka topic: the fields of ``kafka_messages``."""
    return decode_kafka(
        kafka_messages(spark, servers, topic, starting_offsets, fail_on_data_loss), schema
    )


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Messages of a Kafka topic (needs Spark's Kafka connector on the classpath).

    Offsets that expired unread stop the query, unless ``fail_on_data_loss`` is off; then
    ``streaming.kafka`` names the gaps.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", fail_on_data_loss)
        .load()
    )


def decode_kafka(messages: DataFrame, schema: str) -> DataFrame:
    """Fields of the JSON value; works on static and streaming frames."""
    return messages.select(
        F.col("key").cast("string"), F.from_json(F.col("value").cast("string"), schema).alias("data")
    ).select("data.*")


POSITION = ("topic", "partition", "offset", "timestamp")


def decode_kafka_kept(messages: DataFrame, schema: str) -> DataFrame:
    """Each message with its position, text, decoded ``data`` and what is wrong with it.

    ``decode_error`` is null, ``no_value`` (a null or blank value), ``no_object`` (JSON that is
    not an object) or ``malformed`` (no JSON, or a field that does not fit its type).
    """
    text = F.col("value").cast("string")
    data = F.from_json(text, f"{schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})
    decoded = messages.select(
        *POSITION, F.col("key").cast("string").alias("key"), text.alias("value"), data.alias("data")
    )
    error = (
        F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "no_value")
        .when(F.col("data").isNull(), "no_object")
        .when(F.col("data")[CORRUPT].isNotNull(), "malformed")
    )
    return decoded.withColumn("decode_error", error)


def decoded_events(decoded: DataFrame) -> DataFrame:
    """Fields of the messages that could be decoded, with their position in the log."""
    fields = [f.name for f in decoded.schema["data"].dataType.fields if f.name != CORRUPT]
    return decoded.filter(F.col("decode_error").isNull()).select(
        *[F.col("data")[f].alias(f) for f in fields],
        *[F.col(c).alias(f"_kafka_{c}") for c in POSITION],
    )


def undecodable(decoded: DataFrame) -> DataFrame:
    """Messages that could not be decoded, as they came."""
    return decoded.filter(F.col("decode_error").isNotNull()).drop("data")


def only_events(stream: DataFrame, event_type: str) -> DataFrame:
    """Drop events of other kinds that share the input folder."""
    return stream.filter(F.col("event_type") == event_type)
