"""The event table: envelope, payloads, ingest and slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow import schemas
from recordflow.functions.dates import from_epoch_day
from recordflow.sources.codec import decode, encode
from recordflow.sources.tables import read_table, write_partitioned

EVENT_PARTITIONS = ("tenant_id", "partition_id", "logical_date")


def domain_partition(customer_id: Column | str) -> Column:
    """The part of a customer id before its first underscore."""
    return F.substring_index(F.col(customer_id) if isinstance(customer_id, str) else customer_id, "_", 1)


def flatten_envelope(df: DataFrame, value: str = "value", codec: str = "json") -> DataFrame:
    """Encoded envelopes to flat event rows; the payload is unwrapped here, once."""
    event = decode(F.col(value), "envelope", schemas.EVENT_ENVELOPE, codec)
    # The decoded struct is a column of its own so that the text is parsed once per row.
    header = F.col("_event.header")
    customer = header["entity_id"]
    return df.select(event.alias("_event")).select(
        header["tenant_id"].cast("string").alias("tenant_id"),
        domain_partition(customer).alias("partition_id"),
        customer.alias("customer_id"),
        header["event_timestamp"].alias("event_timestamp"),
        header["logical_date"].alias("logical_date"),
        header["event_type"].alias("event_type"),
        F.col("_event.payload").alias("payload"),
    )


def readable(df: DataFrame, value: str = "value", codec: str = "json") -> DataFrame:
    """``flatten_envelope`` without the rows whose envelope cannot be read; ``rejected`` has those.

    They are dropped by a generator: a filter would be pushed below the decoding and decode every envelope twice.
    """
    flat = flatten_envelope(df, value, codec)
    row = F.when(F.col("customer_id").isNotNull(), F.array(F.struct(*flat.columns)))
    return flat.select(F.inline(row))


def rejected(df: DataFrame, value: str = "value", codec: str = "json") -> DataFrame:
    """The rows whose envelope cannot be read, with their raw bytes; ``flatten_envelope`` has NULLs there."""
    event = decode(F.col(value), "envelope", schemas.EVENT_ENVELOPE, codec)
    return df.where(event["header"]["entity_id"].isNull())


def encode_event(
    df: DataFrame, payloads: dict[str, Column], codec: str = "json", name: str = "value"
) -> DataFrame:
    """Add the encoded envelope of each row.

    ``payloads`` maps event type to the payload struct of rows of that type. The frame brings
    the header columns (event_timestamp, logical_date, event_type, tenant_id, customer_id).
    """
    body = F.lit(None).cast("binary")
    for kind, struct in payloads.items():
        body = F.when(F.col("event_type") == kind, encode(struct, kind, codec)).otherwise(body)
    header = F.struct(
        F.col("event_timestamp").cast("bigint").alias("event_timestamp"),
        F.col("logical_date").cast("date").alias("logical_date"),
        F.col("event_type"),
        F.col("tenant_id").cast("int").alias("tenant_id"),
        F.col("customer_id").alias("entity_id"),
    )
    return df.withColumn("payload", body).withColumn(
        name, encode(F.struct(header.alias("header"), F.col("payload")), "envelope", codec)
    )


def decode_payload(df: DataFrame, codec: str = "json", payload: str = "payload") -> DataFrame:
    """Add one typed struct per event type; rows of unknown type keep three NULLs.

    Every payload names its customer. One that does not was not readable (a text that is not
    JSON parses to NULL fields) and gives NULL, so that it cannot overwrite anything.

    ``known`` tells recognised types apart, ``event_key`` closes the order of events that share
    a timestamp.
    """
    kind, raw = F.col("event_type"), F.col(payload)

    def of(name: str, struct: T.StructType) -> Column:
        return F.when(kind == name, decode(raw, name, struct, codec))

    out = df.withColumns(
        {
            "_name": of("NAME", schemas.NAME_PAYLOAD),
            "_address": of("ADDRESS", schemas.ADDRESS_PAYLOAD),
            "_ident": of("IDENTIFICATION", schemas.IDENTIFICATION_PAYLOAD),
        }
    )
    name, address, ident = F.col("_name"), F.col("_address"), F.col("_ident")
    out = out.withColumns(
        {
            "name": F.when(
                name["customer_id"].isNotNull(),
                F.struct(
                    name["first"].alias("firstName"), name["middle"].alias("middleName"), name["last"].alias("lastName")
                ),
            ),
            "address": F.when(
                address["customer_id"].isNotNull(), F.struct(*[address[f].alias(f) for f in schemas.ADDRESS.fieldNames()])
            ),
            "identification": F.when(
                ident["customer_id"].isNotNull(), F.struct(*[ident[f].alias(f) for f in schemas.IDENTIFICATION.fieldNames()])
            ),
            "known": kind.isin(list(schemas.EVENT_TYPES)),
        }
    ).drop("_name", "_address", "_ident")
    return out if "event_key" in df.columns else out.withColumn("event_key", raw)


def read_events(
    spark: SparkSession, root: str, tenant: str | None = None, date: str | None = None, schema: T.StructType = schemas.EVENT
) -> DataFrame:
    """Slice of the event table. Both filters are on partition columns, so folders are pruned."""
    events = read_table(spark, root, schema)
    if tenant is not None:
        events = events.where(F.col("tenant_id") == tenant)
    if date is not None:
        events = events.where(F.col("logical_date") == F.lit(date).cast("date"))
    return events


def date_text(df: DataFrame, col: str = "logical_date") -> DataFrame:
    """Replace an epoch-day integer by its ``yyyy-MM-dd`` text under the same name."""
    return df.withColumn(col, F.date_format(from_epoch_day(col), "yyyy-MM-dd"))


def ingest_files(df: DataFrame, path: str, col: str = "logical_date") -> None:
    """Lay out file-delivered events by tenant, domain partition and day."""
    write_partitioned(date_text(df, col), path, EVENT_PARTITIONS)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schemas.SNAPSHOT, fmt)
