"""Change records: the old and the new value of every item an event touches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.operators.latest import lag_carried
from recordflow.plans.customers.merge import Handler, default_handlers, event_items
from recordflow.sources.events import domain_partition

# Sorts before every event: the snapshot's items stand first in their history.
_BEFORE_ALL = -(1 << 62)


def _snapshot_items(snapshot: DataFrame, like: DataFrame) -> DataFrame:
    """Items of the snapshot in the shape of event items."""
    kinds = {f.name: f.dataType for f in like.schema["item"].dataType.fields}

    def item(**given: Column) -> Column:
        return F.struct(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])

    def row(kind: str, item_type: Column, value: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.coalesce(item_type, F.lit("")).alias("item_type"), value.alias("item")
        )

    name = F.array(row("name", F.lit(""), item(name=F.col("name"))))
    addresses = F.transform(
        F.coalesce("addresses", F.array()), lambda a: row("address", a["type"], item(address=a))
    )
    ids = F.transform(
        F.coalesce("identifications", F.array()), lambda i: row("identification", i["type"], item(identification=i))
    )
    rows = F.concat(F.when(F.col("name").isNotNull(), name).otherwise(F.slice(name, 1, 0)), addresses, ids)
    return snapshot.select("tenant_id", "customer_id", F.inline(rows)).withColumns(
        {
            "event_timestamp": F.lit(_BEFORE_ALL).cast("bigint"),
            "event_key": F.lit(None).cast(like.schema["event_key"].dataType),
            "event_type": F.lit(None).cast("string"),
        }
    )


def change_records(
    snapshot: DataFrame,
    events: DataFrame,
    handlers: Mapping[str, Handler] | None = None,
) -> DataFrame:
    """One row per recognised event with the item before and after it.

    The old value is the previous item of the same (tenant, customer, kind, type), found over snapshot
    and events together. Histories are cut into ranges, and a range hands its last item on
    (``lag_carried``, which runs when called), so one customer, or one moment, with a large share of
    all events is worked on by many tasks.
    """
    items = event_items(events, handlers)
    # Only the ids and types are needed to see which customers take part; no payload is decoded.
    registry = default_handlers() if handlers is None else handlers
    ids = events.where(F.col("event_type").isin(list(registry))).select("tenant_id", "customer_id").distinct()
    touched = snapshot.join(ids, ["tenant_id", "customer_id"], "left_semi")
    history = _snapshot_items(touched, items).unionByName(items)
    chained = lag_carried(
        history, ["tenant_id", "customer_id", "kind", "item_type"], ["event_timestamp", "event_key"], "item", "old"
    )
    return chained.where(F.col("event_type").isNotNull()).select(
        "tenant_id",
        domain_partition("customer_id").alias("partition_id"),
        "customer_id",
        "event_timestamp",
        "event_type",
        "event_key",
        F.col("old.name").alias("oldName"),
        F.col("item.name").alias("newName"),
        F.col("old.address").alias("oldAddress"),
        F.col("item.address").alias("newAddress"),
        F.col("old.identification").alias("oldId"),
        F.col("item.identification").alias("newId"),
    )


def _shown(item: Column, fields: list[str]) -> Column:
    text = F.concat_ws(",", *[F.coalesce(item[f], F.lit("null")) for f in fields])
    return F.when(item.isNull(), F.lit("<none>")).otherwise(text)


def change_report(updates: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Readable change text, one row per line: (customer_id, event_timestamp, line_nbr, line).

    Lines are made per change record, so the report is written by all tasks; order by the key
    columns and the line number to print it.
    """
    kinds = [
        ("Name", "oldName", "newName"),
        ("Address", "oldAddress", "newAddress"),
        ("Identification", "oldId", "newId"),
    ]
    lines = F.array(F.concat(F.lit("Customer ID: "), F.col("customer_id")))
    for label, old, new in kinds:
        fields = updates.schema[old].dataType.fieldNames()
        block = F.array(
            F.lit(f"  {label} change:"),
            F.concat(F.lit("    From: "), _shown(F.col(old), fields)),
            F.concat(F.lit("    To:   "), _shown(F.col(new), fields)),
        )
        changed = F.col(old).isNotNull() | F.col(new).isNotNull()
        lines = F.concat(lines, F.when(changed, block).otherwise(F.slice(block, 1, 0)))
    lines = F.concat(lines, F.array(F.lit("-" * 50)))
    return updates.select(
        "customer_id", "event_timestamp", *keep, F.posexplode(lines).alias("line_nbr", "line")
    ).withColumn("line_nbr", F.col("line_nbr").cast("bigint"))


def change_total(updates: DataFrame) -> DataFrame:
    """The header of the report: how many changes it lists."""
    count = F.count(F.lit(1)).cast("string")
    return updates.agg(F.concat(F.lit("Total Updates: "), count).alias("line"))


def write_change_report(updates: DataFrame, path: str) -> None:
    """Write the report as text files that follow each other in customer order.

    The files are made by a range sort, one task each; the total goes to ``<path>-total``.
    """
    order = ["customer_id", "event_timestamp", "event_key", "line_nbr"]
    lines = change_report(updates, keep=("event_key",))
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)
    change_total(updates).write.mode("overwrite").text(f"{path}-total")
