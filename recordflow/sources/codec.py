"""Event and payload encodings.

JSON is built in. Avro uses Spark's own ``from_avro``/``to_avro``, which need the external
spark-avro module on the class path.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow import schemas

CODECS = ("json", "avro")


def _record(name: str, fields: list) -> dict:
    return {"type": "record", "name": name, "fields": [{"name": n, "type": t} for n, t in fields]}


# The Avro wire format of events and payloads.
AVRO = {
    "envelope": _record(
        "CustomerEvent",
        [
            (
                "header",
                _record(
                    "EventHeader",
                    [
                        ("event_timestamp", "long"),
                        ("logical_date", {"type": "int", "logicalType": "date"}),
                        ("event_type", "string"),
                        ("tenant_id", "int"),
                        ("entity_id", "string"),
                    ],
                ),
            ),
            ("payload", "bytes"),
        ],
    ),
    "NAME": _record(
        "NamePayload",
        [("customer_id", "string"), ("first", "string"), ("middle", ["null", "string"]), ("last", "string")],
    ),
    "ADDRESS": _record(
        "AddressPayload",
        [
            ("customer_id", "string"),
            ("type", {"type": "enum", "name": "AddressType", "symbols": list(schemas.ADDRESS_TYPES)}),
            ("street", "string"),
            ("city", "string"),
            ("postal_code", "string"),
            ("country", "string"),
        ],
    ),
    "IDENTIFICATION": _record(
        "IdentificationPayload",
        [("customer_id", "string"), ("type", "string"), ("number", "string"), ("issuer", "string")],
    ),
}

PAYLOADS = {
    "NAME": schemas.NAME_PAYLOAD,
    "ADDRESS": schemas.ADDRESS_PAYLOAD,
    "IDENTIFICATION": schemas.IDENTIFICATION_PAYLOAD,
}


def avro_schema(kind: str) -> str:
    return json.dumps(AVRO[kind])


def _avro(call: str, *args) -> Column:
    from pyspark.sql.avro import functions as avro

    try:
        return getattr(avro, call)(*args)
    except Exception as err:
        raise RuntimeError("the avro codec needs the spark-avro module on the class path") from err


def decode(col: Column, kind: str, struct: T.StructType, codec: str) -> Column:
    """Bytes to struct; fields that cannot be read become NULL."""
    if codec == "json":
        return F.from_json(col.cast("string"), struct)
    if codec == "avro":
        return _avro("from_avro", col, avro_schema(kind), {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown codec {codec!r}, expected one of {CODECS}")


def encode(struct: Column, kind: str, codec: str) -> Column:
    """Struct to bytes."""
    if codec == "json":
        return F.to_json(struct).cast("binary")
    if codec == "avro":
        return _avro("to_avro", struct, avro_schema(kind))
    raise ValueError(f"unknown codec {codec!r}, expected one of {CODECS}")
