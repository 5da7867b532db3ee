"""Customer records: events, snapshot, merge, changes, extract, reconciliation.

Customers and suppliers are the base snapshot (ids ``C_<key>`` and ``S_<key>``). Every event is
for the customer or, when its value is small, the supplier with the number of its user. Some
base rows therefore have no events and some events have no base row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow import schemas
from recordflow.catalog.registry import Inputs, query
from recordflow.catalog.roles import with_roles
from recordflow.plans.customers import changes, extract, merge, reconcile, snapshot
from recordflow.session import scratch_path
from recordflow.sources import buckets, events, tables
from recordflow.streaming import ingest, store

RUN_DATE = "2024-02-01"


def encoded(t: Inputs) -> DataFrame:
    """The event rows with their encoded envelopes."""
    text = F.col("id_text")
    payloads = {
        "NAME": F.struct(
            F.col("customer_id"),
            F.concat(F.lit("F"), text).alias("first"),
            F.when(F.col("event_timestamp") > 1705000000000, F.lit("M")).alias("middle"),
            F.concat(F.lit("L"), text).alias("last"),
        ),
        "ADDRESS": F.struct(
            F.col("customer_id"),
            F.col("item_type").alias("type"),
            F.concat(F.lit("Street "), text).alias("street"),
            F.lit("Newtown").alias("city"),
            text.alias("postal_code"),
            F.lit("XX").alias("country"),
        ),
        "IDENTIFICATION": F.struct(
            F.col("customer_id"),
            F.col("item_type").alias("type"),
            F.concat(F.lit("P"), text).alias("number"),
            F.lit("Office").alias("issuer"),
        ),
    }
    return events.encode_event(t.event_rows, payloads)


def flat_events(t: Inputs) -> DataFrame:
    """Encoded, then unwrapped again: what ingest delivers."""
    return events.flatten_envelope(encoded(t).select("value"))


def ingested(t: Inputs) -> DataFrame:
    """The event table as ingest leaves it: laid out by tenant, domain and day."""
    path = scratch_path(t.spark, "event-table")
    tables.write_partitioned(flat_events(t), path, events.EVENT_PARTITIONS)
    return events.read_events(t.spark, path, tenant="42")


def decoded(t: Inputs) -> DataFrame:
    return events.decode_payload(ingested(t))


def base_snapshot(t: Inputs) -> DataFrame:
    p = t.party_rows
    home = F.struct(F.lit("HOME").alias("type"), "street", "city", "postal_code", "country")
    ids = F.struct(F.lit("passport").alias("type"), F.col("id_number").alias("number"), F.lit("base").alias("issuer"))
    no_address = F.array().cast(schemas.SNAPSHOT["addresses"].dataType)
    return p.select(
        F.lit("42").alias("tenant_id"),
        "partition_id",
        "customer_id",
        F.lit("2024-01-01").cast("date").alias("logical_date"),
        F.struct(
            F.col("first_name").alias("firstName"),
            F.lit(None).cast("string").alias("middleName"),
            F.col("last_name").alias("lastName"),
        ).alias("name"),
        F.when(F.col("street").isNotNull(), F.array(home)).otherwise(no_address).alias("addresses"),
        F.array(ids).alias("identifications"),
    )


def item_text(df: DataFrame, *keep: str) -> DataFrame:
    """Nested items as text, one row per customer."""

    def flat(col: str) -> F.Column:
        return F.array_join(F.transform(col, lambda a: F.concat_ws("/", a["type"], *[a[f] for f in fields[col]])), ";")

    fields = {"addresses": ["street", "city", "postal_code", "country"], "identifications": ["number", "issuer"]}
    name = F.concat_ws("/", *[F.coalesce(F.col(f"name.{f}"), F.lit("")) for f in ("firstName", "middleName", "lastName")])
    return df.select(
        *keep,
        "customer_id",
        F.when(F.col("name").isNotNull(), name).alias("name_text"),
        flat("addresses").alias("address_text"),
        flat("identifications").alias("id_text"),
    )


# Items of the base rows and of the events, in one shape, for the SQL twins.
_ITEMS = (
    with_roles("event_rows", "party_rows")
    + """, event_items AS (SELECT customer_id, event_type AS kind, item_type, event_timestamp, event_id,
    CASE event_type WHEN 'NAME' THEN concat_ws('/', 'F' || id_text, CASE WHEN event_timestamp > 1705000000000 THEN 'M' ELSE '' END, 'L' || id_text)
     WHEN 'ADDRESS' THEN concat_ws('/', item_type, 'Street ' || id_text, 'Newtown', id_text, 'XX')
     ELSE concat_ws('/', item_type, 'P' || id_text, 'Office') END AS item FROM event_rows WHERE event_type <> 'OTHER'),
  base_items AS (SELECT customer_id, 'NAME' AS kind, '' AS item_type, -1 AS event_timestamp, -1 AS event_id, concat_ws('/', first_name, '', last_name) AS item FROM party_rows
    UNION ALL SELECT customer_id, 'ADDRESS', 'HOME', -1, -1, concat_ws('/', 'HOME', street, city, postal_code, country) FROM party_rows WHERE street IS NOT NULL
    UNION ALL SELECT customer_id, 'IDENTIFICATION', 'passport', -1, -1, concat_ws('/', 'passport', id_number, 'base') FROM party_rows),
  all_items AS (SELECT * FROM event_items UNION ALL SELECT * FROM base_items),
  newest AS (SELECT customer_id, kind, item_type, max_by(item, CAST(event_timestamp AS HUGEINT) * 100000000 + event_id) AS item, max(event_id) >= 0 AS hit FROM all_items GROUP BY ALL),
  merged AS (SELECT customer_id, max(item) FILTER (WHERE kind = 'NAME') AS name_text,
    coalesce(string_agg(item, ';' ORDER BY item_type) FILTER (WHERE kind = 'ADDRESS'), '') AS address_text,
    coalesce(string_agg(item, ';' ORDER BY item_type) FILTER (WHERE kind = 'IDENTIFICATION'), '') AS id_text, bool_or(hit) AS was_modified
    FROM newest GROUP BY customer_id)"""
)

_FLAT = """SELECT tenant_id, split_part(customer_id, '_', 1) AS partition_id, customer_id, CAST(event_timestamp AS BIGINT) AS event_timestamp, logical_date, event_type"""


@query("flatten_struct", with_roles("event_rows") + " " + _FLAT + " FROM event_rows")
def _(t):
    return flat_events(t).drop("payload")


@query(
    "encode_roundtrip",
    with_roles("event_rows")
    + """ SELECT customer_id, CAST(event_timestamp AS BIGINT) AS event_timestamp, event_type, event_type <> 'OTHER' AS has_payload FROM event_rows""",
)
def _(t):
    return flat_events(t).select(
        "customer_id", "event_timestamp", "event_type", F.col("payload").isNotNull().alias("has_payload")
    )


@query(
    "decode_by_type",
    with_roles("event_rows")
    + """ SELECT customer_id, event_type, CASE WHEN event_type = 'NAME' THEN 'F' || id_text END AS first_name,
    CASE WHEN event_type = 'ADDRESS' THEN item_type END AS address_type, CASE WHEN event_type = 'IDENTIFICATION' THEN 'P' || id_text END AS id_number,
    event_type <> 'OTHER' AS known FROM event_rows""",
)
def _(t):
    return decoded(t).select(
        "customer_id",
        "event_type",
        F.col("name.firstName").alias("first_name"),
        F.col("address.type").alias("address_type"),
        F.col("identification.number").alias("id_number"),
        "known",
    )


@query(
    "stream_ingest",
    with_roles("event_rows") + " " + _FLAT + " FROM event_rows",
)
def _(t):
    """The encoded events as a stream: drained once, started again, read back."""
    raw, out, checkpoint = (scratch_path(t.spark, n) for n in ("raw", "ingested", "checkpoint"))
    encoded(t).select("value").write.parquet(raw)
    for _round in range(2):
        stream = ingest.ingest_stream(ingest.read_event_stream(t.spark, raw))
        ingest.drain(ingest.write_event_stream(stream, out, checkpoint))
    return events.read_events(t.spark, out).drop("payload")


def _damaged(t: Inputs) -> DataFrame:
    """Encoded events, every tenth of which is no envelope at all and every tenth cut short."""
    rows = encoded(t)
    text = F.concat(F.lit("junk-"), F.col("event_id").cast("string")).cast("binary")
    ones = F.col("event_id") % 10
    broken = F.when(ones == 3, text).when(ones == 4, F.substring("value", 1, 9)).otherwise(F.col("value"))
    return rows.select("event_id", broken.alias("value"))


@query(
    "rejected_events",
    """SELECT event_id, CASE event_id % 10 WHEN 3 THEN 'junk-' || event_id ELSE '{"header"' END AS raw FROM events WHERE event_id % 10 IN (3, 4)""",
)
def _(t):
    """Envelopes that cannot be read, with their bytes."""
    return events.rejected(_damaged(t)).select("event_id", F.col("value").cast("string").alias("raw"))


@query(
    "reject_counts",
    """SELECT count(*) AS sent, count(*) FILTER (WHERE event_id % 10 NOT IN (3, 4)) AS loaded,
    count(*) FILTER (WHERE event_id % 10 IN (3, 4)) AS rejected, CAST(0 AS BIGINT) AS missing FROM events""",
)
def _(t):
    """A stream with unreadable envelopes: readable ones to the event table, the others to a table of rejects."""
    raw, out, bad, cp1, cp2 = (scratch_path(t.spark, n) for n in ("raw", "events", "rejects", "cp1", "cp2"))
    _damaged(t).select("value").write.parquet(raw)
    ingest.drain(ingest.write_event_stream(ingest.ingest_stream(ingest.read_event_stream(t.spark, raw)), out, cp1))
    rejects = ingest.reject_stream(ingest.read_event_stream(t.spark, raw))
    ingest.drain(ingest.write_event_stream(rejects, bad, cp2, parts=()))
    loaded = events.read_events(t.spark, out)
    return reconcile.account_for(t.spark.read.parquet(raw), loaded, t.spark.read.schema("value binary").parquet(bad))


@query(
    "scan_snapshot",
    with_roles("party_rows")
    + """ SELECT customer_id, concat_ws('/', first_name, '', last_name) AS name_text, CASE WHEN street IS NULL THEN ''
    ELSE concat_ws('/', 'HOME', street, city, postal_code, country) END AS address_text, concat_ws('/', 'passport', id_number, 'base') AS id_text FROM party_rows""",
)
def _(t):
    path = scratch_path(t.spark, "snapshot")
    base_snapshot(t).write.parquet(path)
    return item_text(events.read_snapshot(t.spark, path))


def _dated_deltas(t: Inputs) -> DataFrame:
    """One delta row per customer and day with name events: the last name of that day."""
    named = decoded(t).where(F.col("name").isNotNull())
    last = named.groupBy("tenant_id", "partition_id", "customer_id", "logical_date").agg(
        F.max_by("name", F.struct("event_timestamp", "event_key")).alias("name")
    )
    empty = {c: F.array().cast(schemas.SNAPSHOT[c].dataType) for c in ("addresses", "identifications")}
    return last.withColumns(empty)


_ASOF_SQL = (
    with_roles("event_rows", "party_rows")
    + """, d AS (SELECT customer_id, logical_date, max_by(concat_ws('/', 'F' || id_text, CASE WHEN event_timestamp > 1705000000000 THEN 'M' ELSE '' END, 'L' || id_text),
       CAST(event_timestamp AS HUGEINT) * 100000000 + event_id) AS name_text FROM event_rows WHERE event_type = 'NAME' AND logical_date < DATE '2024-01-20' GROUP BY ALL),
    u AS (SELECT customer_id, DATE '2024-01-01' AS logical_date, concat_ws('/', first_name, '', last_name) AS name_text, 0 AS k FROM party_rows
      UNION ALL SELECT customer_id, logical_date, name_text, 1 FROM d)
    SELECT customer_id, logical_date, name_text FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY logical_date DESC, k DESC) AS rn FROM u) WHERE rn = 1"""
)


@query("snapshot_asof", _ASOF_SQL)
def _(t):
    now = snapshot.current_snapshot(base_snapshot(t), _dated_deltas(t), before="2024-01-20")
    return item_text(now, "logical_date").drop("address_text", "id_text")


def _bucket_table(t: Inputs, name: str, part: str | None = None) -> buckets.BucketTable:
    return buckets.BucketTable(t.spark, scratch_path(t.spark, name), base_snapshot(t).schema, merge.KEYS, 8, part)


@query("snapshot_bucketed", _ASOF_SQL)
def _(t):
    """Base and daily deltas as bucketed tables, the deltas written by several runs."""
    base, deltas = _bucket_table(t, "base-buckets"), _bucket_table(t, "delta-buckets", "logical_date")
    base.write(base_snapshot(t))
    rows = _dated_deltas(t)
    for low, high in (("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2024-03-01")):
        deltas.write_days(rows.where((F.col("logical_date") >= low) & (F.col("logical_date") < high)))
    now = snapshot.snapshot_in_buckets(base.read(), deltas.read(), before="2024-01-20")
    return item_text(now, "logical_date").drop("address_text", "id_text")


@query(
    "dedup_latest",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def _(t):
    from recordflow.operators.latest import dedup_latest

    newest = dedup_latest(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.select("user_id", "event_id", "event_type")


@query("merge_full", _ITEMS + " SELECT * FROM merged")
def _(t):
    return item_text(merge.merge_customers(base_snapshot(t), decoded(t), RUN_DATE), "was_modified")


@query("merge_bucketed", _ITEMS + " SELECT customer_id, name_text, address_text, id_text FROM merged")
def _(t):
    """Two days' runs: each folds its events onto the last snapshot, in buckets, and writes the next one."""
    now = _bucket_table(t, "day0")
    now.write(base_snapshot(t))
    todays = decoded(t)
    middle = F.col("event_timestamp") < 1705000000000
    for day, part in (("2024-01-31", middle), (RUN_DATE, ~middle)):
        newest = merge.newest_items(merge.event_items(todays.where(part)))
        merged = merge.merge_in_buckets(now.read(), newest, day, now.n)
        now = _bucket_table(t, f"day-{day}")
        now.write(merged.drop("was_modified"), placed=True)
    return item_text(now.read())


@query(
    "merge_modified",
    _ITEMS + " SELECT customer_id, name_text, address_text, id_text FROM merged WHERE was_modified",
)
def _(t):
    merged = merge.merge_customers(base_snapshot(t), decoded(t), RUN_DATE)
    return item_text(merge.split_outputs(merged, "modified")["modified"])


#: Rows of one file of a stream's batch.
FILE_ROWS = 250_000


def write_batches(rows: DataFrame, path: str, part: str) -> int:
    """One folder per value of ``part``, one after the other, with as many files each as is returned.

    A stream takes the oldest files first, so that many at a time are the rows of one value. They are dealt
    over the files without a sort, so the memory of a task does not grow with the rows.
    """
    fixed = tables.stage(rows, "batch-rows")
    fixed.limit(0).write.partitionBy(part).parquet(path)  # the folder, also of no rows
    counts = fixed.groupBy(part).count().orderBy(F.asc_nulls_last(part)).collect()
    files = max([1, *[r["count"] // FILE_ROWS for r in counts]])
    for n, r in enumerate(counts):
        own = fixed.where(F.col(part).eqNullSafe(F.lit(r[part]))).drop(part)
        own.repartition(files).write.parquet(f"{path}/{n}")
    return files


@query("stream_merge", _ITEMS + " SELECT customer_id, name_text, address_text, id_text FROM merged")
def _(t):
    """The events as a stream of batches, folded onto the base into deltas.

    A batch holds every third minute of all days, so each one brings events older than the last. Items
    are compacted after every second batch; items and base are read by bucket.
    """
    table, deltas, items, checkpoint, laid_out = (
        scratch_path(t.spark, n) for n in ("event-stream", "deltas", "items", "checkpoint", "base")
    )
    flat = flat_events(t)
    files = write_batches(flat.withColumn("_part", F.floor(F.col("event_timestamp") / 60_000) % 3), table, "_part")
    schema = T.StructType([*schemas.SNAPSHOT.fields, T.StructField("batch", T.LongType())])
    base = base_snapshot(t)
    store.write_bucketed_folders(base, laid_out, merge.KEYS, 8)

    def earlier(batch: int) -> DataFrame:
        return tables.read_if_exists(t.spark, deltas, schema).where(F.col("batch") < batch)

    stream = t.spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", files).parquet(f"{table}/*")
    by_bucket = T.StructType([*base.schema.fields, T.StructField(store.BUCKET, T.IntegerType())])
    ingest.drain(
        ingest.merge_stream(
            stream, lambda: t.spark.read.schema(by_bucket).parquet(laid_out), deltas, items, checkpoint, 8, compact_every=2
        )
    )
    return item_text(snapshot.current_snapshot(base, earlier(1 << 40), tie=("batch",)))


_WITH_OTHER = _ITEMS.replace(
    "FROM event_rows WHERE event_type <> 'OTHER')",
    "FROM event_rows WHERE event_type <> 'OTHER' UNION ALL SELECT customer_id, 'ADDRESS', 'MAIL', event_timestamp, event_id, "
    "concat_ws('/', 'MAIL', 'At ' || CAST(CAST(event_timestamp AS BIGINT) AS VARCHAR), 'Newtown', '0', 'XX') FROM event_rows WHERE event_type = 'OTHER')",
)


@query("merge_new_handler", _WITH_OTHER + " SELECT * FROM merged")
def _(t):
    """A fourth event type, registered by its handler: it replaces the customer's mailing address."""
    mail = {
        "type": F.lit("MAIL"),
        "street": F.concat(F.lit("At "), F.col("event_timestamp").cast("string")),
        "city": F.lit("Newtown"),
        "postal_code": F.lit("0"),
        "country": F.lit("XX"),
    }
    made = F.struct(*[mail[f].alias(f) for f in schemas.ADDRESS.fieldNames()])
    rows = decoded(t).withColumn("address", F.when(F.col("event_type") == "OTHER", made).otherwise(F.col("address")))
    handlers = merge.default_handlers() | {"OTHER": merge.Handler("address", "address", F.col("address.type"))}
    return item_text(merge.merge_customers(base_snapshot(t), rows, RUN_DATE, handlers), "was_modified")


_CHAIN = """, chain AS (SELECT *, lag(item) OVER (PARTITION BY customer_id, kind, item_type ORDER BY event_timestamp, event_id) AS old FROM all_items)"""


@query(
    "change_records",
    _ITEMS
    + _CHAIN
    + """ SELECT customer_id, CAST(event_timestamp AS BIGINT) AS event_timestamp, kind AS event_type, old AS old_item, item AS new_item FROM chain WHERE event_id >= 0""",
)
def _(t):
    records = changes.change_records(base_snapshot(t), decoded(t))

    def shown(name: str, address: str, ident: str) -> F.Column:
        n, a, i = F.col(name), F.col(address), F.col(ident)
        parts = [
            F.when(n.isNotNull(), F.concat_ws("/", *[F.coalesce(n[f], F.lit("")) for f in n_fields])),
            F.when(a.isNotNull(), F.concat_ws("/", *[a[f] for f in schemas.ADDRESS.fieldNames()])),
            F.when(i.isNotNull(), F.concat_ws("/", *[i[f] for f in schemas.IDENTIFICATION.fieldNames()])),
        ]
        return F.coalesce(*parts)

    n_fields = schemas.NAME.fieldNames()
    return records.select(
        "customer_id",
        "event_timestamp",
        "event_type",
        shown("oldName", "oldAddress", "oldId").alias("old_item"),
        shown("newName", "newAddress", "newId").alias("new_item"),
    )


@query(
    "change_report",
    _ITEMS
    + _CHAIN
    + """, lines AS (SELECT *, replace(CASE WHEN kind = 'NAME' AND split_part(item, '/', 2) = '' THEN replace(item, '//', '/null/') ELSE item END, '/', ',') AS new_text,
      coalesce(replace(CASE WHEN kind = 'NAME' AND split_part(old, '/', 2) = '' THEN replace(old, '//', '/null/') ELSE old END, '/', ','), '<none>') AS old_text,
      CASE kind WHEN 'NAME' THEN 'Name' WHEN 'ADDRESS' THEN 'Address' ELSE 'Identification' END AS label FROM chain WHERE event_id >= 0)
    SELECT customer_id, CAST(event_timestamp AS BIGINT) AS event_timestamp, CAST(n AS BIGINT) AS line_nbr,
    CASE n WHEN 0 THEN 'Customer ID: ' || customer_id WHEN 1 THEN '  ' || label || ' change:' WHEN 2 THEN '    From: ' || old_text
     WHEN 3 THEN '    To:   ' || new_text ELSE '--------------------------------------------------' END AS line FROM lines, range(5) r(n)""",
)
def _(t):
    return changes.change_report(changes.change_records(base_snapshot(t), decoded(t)))


@query(
    "change_total",
    with_roles("event_rows") + " SELECT 'Total Updates: ' || count(*) AS line FROM event_rows WHERE event_type <> 'OTHER'",
)
def _(t):
    return changes.change_total(changes.change_records(base_snapshot(t), decoded(t)))


_EXTRACT = """ SELECT '42' AS tenant_id, '1|' || customer_id || '|' || split_part(name_text, '/', 1) || '|' || split_part(name_text, '/', 2) || '|' || split_part(name_text, '/', 3) AS line FROM {0}
    UNION ALL SELECT '42', '2|' || customer_id || '|' || replace(x, '/', '|') FROM (SELECT customer_id, unnest(string_split(address_text, ';')) AS x FROM {0} WHERE address_text <> '')
    UNION ALL SELECT '42', '3|' || customer_id || '|' || replace(x, '/', '|') FROM (SELECT customer_id, unnest(string_split(id_text, ';')) AS x FROM {0} WHERE id_text <> '')"""


@query(
    "extract_lines",
    _ITEMS + ", named AS (SELECT customer_id, coalesce(name_text, '//') AS name_text, address_text, id_text FROM merged)" + _EXTRACT.format("named"),
)
def _(t):
    """Full extract after the merge, through the text files."""
    path = scratch_path(t.spark, "extract")
    merged = merge.merge_customers(base_snapshot(t), decoded(t), RUN_DATE).drop("was_modified")
    tables.write_text_extract(extract.extract_lines(merged), path)
    return t.spark.read.schema("value string, tenant_id string").text(path).select("tenant_id", F.col("value").alias("line"))


@query(
    "extract_delta",
    _ITEMS
    + """, d AS (SELECT customer_id, logical_date, max_by('F' || id_text || '|' || CASE WHEN event_timestamp > 1705000000000 THEN 'M' ELSE '' END || '|L' || id_text,
      CAST(event_timestamp AS HUGEINT) * 100000000 + event_id) AS n FROM event_rows WHERE event_type = 'NAME' AND logical_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY ALL)
    SELECT '42' AS tenant_id, '1|' || customer_id || '|' || n AS line FROM d""",
)
def _(t):
    rows = extract.extract_source(base_snapshot(t), _dated_deltas(t), "delta", "2024-01-10", "2024-01-12")
    return extract.extract_lines(rows)


@query(
    "reconcile_counts",
    with_roles("event_rows")
    + """ SELECT split_part(customer_id, '_', 1) AS partition_id, logical_date, count(*) AS expected, count(*) AS loaded, CAST(0 AS BIGINT) AS delta
    FROM event_rows GROUP BY ALL""",
)
def _(t):
    """What was sent against the table that ingest left."""
    return reconcile.reconcile(flat_events(t), ingested(t), ["partition_id", "logical_date"])


def _two_tenants(t: Inputs) -> DataFrame:
    """The flat events, every other one under a second tenant with the same customer ids."""
    odd = F.floor(F.col("event_timestamp") / 1000) % 2 == 1
    return flat_events(t).withColumn("tenant_id", F.when(odd, "43").otherwise("42"))


@query(
    "scan_tenant_day",
    with_roles("event_rows")
    + """ SELECT customer_id, CAST(event_timestamp AS BIGINT) AS event_timestamp, event_type FROM event_rows
    WHERE (event_timestamp // 1000) % 2 = 1 AND logical_date = (SELECT min(logical_date) + 3 FROM event_rows)""",
)
def _(t):
    """One tenant and day of a table of two tenants; both filters prune folders."""
    path = scratch_path(t.spark, "event-table")
    flat = _two_tenants(t)
    tables.write_partitioned(flat, path, events.EVENT_PARTITIONS)
    day = t.event_rows.agg(F.date_add(F.min("logical_date"), 3)).first()[0]
    slice_ = events.read_events(t.spark, path, tenant="43", date=str(day))
    return slice_.select("customer_id", "event_timestamp", "event_type")


@query(
    "merge_two_tenants",
    with_roles("event_rows")
    + """ SELECT CASE WHEN (event_timestamp // 1000) % 2 = 1 THEN '43' ELSE '42' END AS tenant_id, customer_id,
    max_by('F' || id_text, CAST(event_timestamp AS HUGEINT) * 100000000 + event_id) AS first_name
    FROM event_rows WHERE event_type = 'NAME' GROUP BY ALL""",
)
def _(t):
    """Customers of two tenants with equal ids stay apart."""
    none = base_snapshot(t).where("false")
    named = events.decode_payload(_two_tenants(t)).where(F.col("event_type") == "NAME")
    merged = merge.merge_customers(none, named, RUN_DATE)
    return merged.select("tenant_id", "customer_id", F.col("name.firstName").alias("first_name"))




def _topic(t: Inputs) -> DataFrame:
    """A topic-shaped table: the domain is the partition, the event number the offset."""
    return encoded(t).select(
        events.domain_partition("customer_id").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("customer_id").alias("key"),
        "value",
    )


@query(
    "offset_summary",
    with_roles("event_rows")
    + """ SELECT split_part(customer_id, '_', 1) AS partition, max(event_id) + 1 AS next_offset, count(*) AS records FROM event_rows GROUP BY 1""",
)
def _(t):
    return reconcile.topic_offsets(_topic(t))


@query(
    "first_per_partition",
    with_roles("event_rows")
    + """ SELECT split_part(customer_id, '_', 1) AS partition, min(event_id) AS "offset", min_by(customer_id, event_id) AS key,
    min_by(event_type, event_id) AS event_type FROM event_rows GROUP BY 1""",
)
def _(t):
    first = reconcile.first_per_partition(_topic(t))
    decoded_first = first.select("partition", "offset", "key", F.from_json(F.col("value").cast("string"), schemas.EVENT_ENVELOPE).alias("e"))
    return decoded_first.select("partition", "offset", "key", F.col("e.header.event_type").alias("event_type"))
