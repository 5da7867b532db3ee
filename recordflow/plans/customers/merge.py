"""Fold events onto the snapshot.

Each event replaces one item of a customer: the name, the address of one type, or the
identification of one type. The state after all events is therefore the newest item per
(customer, kind, type), which partial aggregation finds without bringing the events of a
customer together; a customer with very many events costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.sources.buckets import KEY, key_text, to_buckets
from recordflow.sources.events import domain_partition
from recordflow.sources.tables import stage, write_dated


@dataclass(frozen=True)
class Handler:
    """How events of one type change a customer: which kind of item, and the item's key."""

    kind: str
    item: str
    key: Column


def default_handlers() -> dict[str, Handler]:
    """Registry by event type. Types that are not registered are ignored."""
    return {
        "NAME": Handler("name", "name", F.lit("")),
        "ADDRESS": Handler("address", "address", F.col("address.type")),
        "IDENTIFICATION": Handler("identification", "identification", F.col("identification.type")),
    }


ITEM_COLS = ("name", "address", "identification")


def event_items(events: DataFrame, handlers: Mapping[str, Handler] | None = None) -> DataFrame:
    """Recognised events as (customer, kind, item_type, order columns, item).

    The type list is a plain predicate that reaches the scan. Rows whose payload could not be
    read are dropped by a generator instead of a filter: the planner would push a filter below
    the decoding and so decode every payload twice.
    """
    registry = default_handlers() if handlers is None else handlers
    found = F.lit(None)
    for event_type, handler in registry.items():
        row = F.array(
            F.struct(
                F.lit(handler.kind).alias("kind"),
                F.coalesce(handler.key, F.lit("")).alias("item_type"),
                F.struct(*ITEM_COLS).alias("item"),
            )
        )
        hit = (F.col("event_type") == event_type) & F.col(handler.item).isNotNull()
        found = F.when(hit, row).otherwise(found)
    return events.where(F.col("event_type").isin(list(registry))).select(
        "tenant_id", "customer_id", "event_timestamp", "event_key", "event_type", F.inline(found)
    )


KEYS = ("tenant_id", "customer_id")


def newest_items(items: DataFrame) -> DataFrame:
    """The newest item per (tenant, customer, kind, type), with its event time.

    A partial aggregation; applying it to parts and then to their union gives the same.
    """
    return (
        items.groupBy(*KEYS, "kind", "item_type")
        .agg(
            F.max_by(
                F.struct("item", "event_timestamp", "event_key"), F.struct("event_timestamp", "event_key")
            ).alias("_top")
        )
        .select(*KEYS, "kind", "item_type", "_top.*")
    )


def _by_customer(newest: DataFrame) -> DataFrame:
    """One row per customer with events: its newest items."""

    def items(kind: str, field: str) -> Column:
        return F.collect_list(F.when(F.col("kind") == kind, F.col("item")[field]))

    # At most one row per item type remains here, so the lists are as short as the record.
    return newest.groupBy(*[F.col(k).alias(f"_{k}") for k in KEYS]).agg(
        F.max(F.when(F.col("kind") == "name", F.col("item")["name"])).alias("_name"),
        items("address", "address").alias("_addresses"),
        items("identification", "identification").alias("_ids"),
    )


def _upsert(old: Column, new: Column) -> Column:
    """Items of ``new`` replace those of ``old`` of the same type; ordered by type."""
    kept = F.filter(F.coalesce(old, F.array()), lambda a: ~F.exists(new, lambda b: b["type"].eqNullSafe(a["type"])))
    return F.array_sort(F.concat(kept, new))


def merge_customers(
    snapshot: DataFrame, events: DataFrame, run_date: str, handlers: Mapping[str, Handler] | None = None
) -> DataFrame:
    """Snapshot after the events, with ``was_modified``.

    ``events`` come from ``decode_payload``. Customers, known by tenant and id, pass through untouched
    without events; those only known from events are created, with the domain partition of their id.
    Changed rows are dated ``run_date``.
    """
    return merge_items(snapshot, newest_items(event_items(events, handlers)), run_date)


def merge_items(snapshot: DataFrame, newest: DataFrame, run_date: str) -> DataFrame:
    """The same from the newest items of the events."""
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    return _merged(snapshot, _by_customer(newest), same, run_date)


def merge_in_buckets(snapshot: DataFrame, newest: DataFrame, run_date: str, n: int) -> DataFrame:
    """The same for a snapshot read from a ``BucketTable`` of ``n`` buckets, with ``bucket_key``.

    The snapshot stays where it is: only the customers with events are shuffled, to its buckets, and the
    result lies in the same buckets again (write it with ``placed=True``).
    """
    changes = _by_customer(newest).withColumn("_key", key_text([f"_{k}" for k in KEYS]))
    changes = to_buckets(changes, n, "_key")
    return _merged(snapshot, changes, [F.col(KEY) == F.col("_key")], run_date, F.coalesce(KEY, "_key").alias(KEY))


def _merged(snapshot: DataFrame, changes: DataFrame, same: list[Column], run_date: str, *keep: Column) -> DataFrame:
    joined = snapshot.withColumn("_old", F.lit(True)).join(changes.withColumn("_new", F.lit(True)), same, "full")
    touched, known = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    tenant, customer = (F.when(known, F.col(k)).otherwise(F.col(f"_{k}")) for k in KEYS)
    addresses = F.col("addresses")
    ids = F.col("identifications")
    return joined.select(
        *keep,
        tenant.alias("tenant_id"),
        F.coalesce(F.col("partition_id"), domain_partition(customer)).alias("partition_id"),
        customer.alias("customer_id"),
        F.when(touched, F.lit(run_date).cast("date")).otherwise(F.col("logical_date")).alias("logical_date"),
        F.coalesce("_name", "name").alias("name"),
        F.when(touched, _upsert(addresses, F.col("_addresses"))).otherwise(addresses).alias("addresses"),
        F.when(touched, _upsert(ids, F.col("_ids"))).otherwise(ids).alias("identifications"),
        touched.alias("was_modified"),
    )


def split_outputs(merged: DataFrame, mode: str = "modified") -> dict[str, DataFrame]:
    """``full``, ``modified`` or ``both`` outputs of a merge."""
    if mode not in ("full", "modified", "both"):
        raise ValueError(f"unknown mode {mode!r}")
    out = {}
    if mode in ("full", "both"):
        out["full"] = merged.drop("was_modified")
    if mode in ("modified", "both"):
        out["modified"] = merged.where("was_modified").drop("was_modified")
    return out


def write_outputs(merged: DataFrame, mode: str, date: str, full_root: str | None = None, delta_root: str | None = None) -> None:
    """Write the outputs of a merge as the slice of one day below separate roots.

    With ``both`` the merge is staged once and read twice instead of being computed twice.
    """
    roots = {"full": full_root, "modified": delta_root}
    source = stage(merged, "merged") if mode == "both" else merged
    for name, frame in split_outputs(source, mode).items():
        if roots[name] is None:
            raise ValueError(f"no folder given for the {name} output")
        write_dated(frame, roots[name], date)
