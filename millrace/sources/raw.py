"""The raw topic: frames, decoding by schema version, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.settings import INT_FIELDS, LONG_FIELDS, STRING_FIELDS

#: The columns of a topic's rows, as the Kafka source names them.
TOPIC = "value binary, topic string, partition int, offset bigint, timestamp timestamp"
#: Fields of the first version of the wire schema; the rest came later and is null in its messages.
FIRST_VERSION = ["event_id", "timestamp", "runner_ip", "project", "event_type", "hostname", "severity", "reason", "command", "exit_code"]


def fields() -> list[str]:
    return [*STRING_FIELDS, *INT_FIELDS, *LONG_FIELDS]


def payload_schema(names: list[str] | None = None) -> T.StructType:
    kinds = {c: T.StringType() for c in STRING_FIELDS} | {c: T.IntegerType() for c in INT_FIELDS} | {c: T.LongType() for c in LONG_FIELDS}
    return T.StructType([T.StructField(c, kinds[c]) for c in names or fields()])


VERSIONS = {1: FIRST_VERSION, 2: None}


def kafka_stream(spark: SparkSession, servers: str, topic: str, group: str = "millrace") -> DataFrame:
    """The topic as a stream; needs the Kafka connector on the class path. Offsets are the checkpoint's."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "latest").option("groupIdPrefix", group).option("failOnDataLoss", "false")
    return reader.load().select("value", "topic", "partition", "offset", "timestamp")


def file_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """The same columns from Parquet files that land in a folder."""
    return spark.readStream.schema(TOPIC).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def kafka_range(spark: SparkSession, servers: str, topic: str, start_ms: int, end_ms: int) -> DataFrame:
    """The messages appended in [start, end), as a batch."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingTimestamp", str(start_ms)).option("endingTimestamp", str(end_ms)).load()


def appended_between(df: DataFrame, start_ms: int | Column, end_ms: int | Column, column: str = "appended_ms") -> DataFrame:
    """The file form of a read by time: rows appended in [start, end)."""
    at = F.col(column)
    return df.filter((at >= start_ms) & (at < end_ms))


def split_frame(df: DataFrame, value: str = "value") -> DataFrame:
    """df with schema_id and payload: a zero byte, four bytes of schema id (big endian), the rest. wire_error otherwise."""
    v = F.col(value)
    framed = F.coalesce((F.length(v) >= 5) & (F.hex(F.substring(v, 1, 1)) == "00"), F.lit(False))
    return df.withColumns(
        {
            "wire_error": F.when(~framed, "not_avro_framed"),
            "schema_id": F.when(framed, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long")),
            "payload": F.when(framed, F.expr(f"substring(`{value}`, 6)")),
        }
    )


def decode(df: DataFrame, versions: dict[int, list[str] | None] | None = None) -> DataFrame:
    """Frames to events: the fields of the message's version, null for those it lacks; wire_error where that fails.

    JSON payloads. An Avro payload takes the same place with from_avro where that module is on the class path.
    """
    versions = versions or VERSIONS
    out = df if "payload" in df.columns else split_frame(df)
    known = F.col("schema_id").isin(list(versions))
    # one parse with every field; what a version lacks is taken out again
    parsed = F.when(F.coalesce(known, F.lit(False)), F.from_json(F.decode("payload", "UTF-8"), payload_schema(), {"mode": "PERMISSIVE"}))
    has = {f: [v for v, names in versions.items() if names is None or f in names] for f in fields()}
    field = {f: F.col(f"_event.{f}") if len(v) == len(versions) else F.when(F.col("schema_id").isin(v), F.col(f"_event.{f}")) for f, v in has.items()}
    error = F.coalesce(
        F.col("wire_error"),
        F.when(~known, "unknown_schema_version"),
        F.when(F.col("_event.event_id").isNull(), "undecodable_payload"),
    )
    taken = set(fields())
    kept = [F.col(f"`{c}`") for c in out.columns if c not in taken and c not in ("wire_error", "payload", "timestamp")]
    at = [F.col("timestamp").alias("appended_at")] if "timestamp" in out.columns else []
    one = F.struct(*kept, *at, error.alias("wire_error"), *[c.alias(f) for f, c in field.items()])
    # a generator keeps later filters and checks from being pushed below the parse and repeating it
    return out.withColumn("_event", parsed).select(F.inline(F.array(one)))


def dead_letters(rejected: DataFrame, raw: str = "value", at: str = "appended_at") -> DataFrame:
    """The stored form of refused messages: bytes as base64, no schema id where there was no frame."""
    return rejected.select(
        "reject_reason",
        F.when(F.col("reject_reason") != "not_avro_framed", F.col("schema_id")).alias("schema_id"),
        F.base64(F.coalesce(F.col(raw), F.lit(b""))).alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS").alias("kafka_timestamp"),
    )


def sink_rows(lines: DataFrame, schema: T.StructType, required: list[str], line: str = "line") -> DataFrame:
    """JSON lines to rows; sink_error is sink_parse_error where a line or a required value cannot be read."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    out = lines.withColumn("_row", F.from_json(line, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("_row").isNull() | F.col("_row._corrupt").isNotNull()
    for c in required:
        bad = bad | F.col(f"_row.{c}").isNull()
    rest = [F.col(f"`{c}`") for c in lines.columns]
    return out.select(*rest, *[F.col(f"_row.{f.name}").alias(f.name) for f in schema], F.when(bad, "sink_parse_error").alias("sink_error"))
