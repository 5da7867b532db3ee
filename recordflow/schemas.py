"""Fixed record shapes of the customer data and of the reporting inputs."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types, object kinds and address types of the record format.
EVENT_TYPES = ("NAME", "ADDRESS", "IDENTIFICATION")
ADDRESS_TYPES = ("HOME", "WORK")


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


NAME = _strings("firstName", "middleName", "lastName")
ADDRESS = _strings("type", "street", "city", "postal_code", "country")
IDENTIFICATION = _strings("type", "number", "issuer")

NAME_PAYLOAD = _strings("customer_id", "first", "middle", "last")
ADDRESS_PAYLOAD = _strings("customer_id", "type", "street", "city", "postal_code", "country")
IDENTIFICATION_PAYLOAD = _strings("customer_id", "type", "number", "issuer")

EVENT_HEADER = T.StructType(
    [
        T.StructField("event_timestamp", T.LongType(), False),
        T.StructField("logical_date", T.DateType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("tenant_id", T.IntegerType(), False),
        T.StructField("entity_id", T.StringType(), False),
    ]
)
EVENT_ENVELOPE = T.StructType(
    [
        T.StructField("header", EVENT_HEADER, False),
        T.StructField("payload", T.BinaryType(), True),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("partition_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("logical_date", T.DateType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("partition_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("logical_date", T.DateType()),
        T.StructField("name", NAME),
        T.StructField("addresses", T.ArrayType(ADDRESS)),
        T.StructField("identifications", T.ArrayType(IDENTIFICATION)),
    ]
)

CHANGE_RECORD = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("partition_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("oldName", NAME),
        T.StructField("newName", NAME),
        T.StructField("oldAddress", ADDRESS),
        T.StructField("newAddress", ADDRESS),
        T.StructField("oldId", IDENTIFICATION),
        T.StructField("newId", IDENTIFICATION),
    ]
)


def ddl(struct: T.StructType) -> str:
    """DDL text of a struct, e.g. for ``from_json``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct.fields)
