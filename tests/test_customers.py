"""Snapshot, merge, change records, extract: small records with every edge in them."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from recordflow import schemas
from recordflow.plans.customers import changes, extract, merge, reconcile, snapshot
from recordflow.session import scratch_path
from recordflow.sources import codec, events

DAY = datetime.date(2025, 4, 3)
BASE_DAY = datetime.date(2025, 3, 1)


def person(cid, name=("A", None, "Z"), addresses=(), ids=(), day=BASE_DAY):
    return ("42", cid.split("_")[0], cid, day, name, list(addresses), list(ids))


def event(cid, ts, kind, **payload):
    body = json.dumps({"customer_id": cid, **payload}).encode() if payload else b"not json"
    return ("42", cid.split("_")[0], cid, ts, DAY, kind, bytearray(body))


HOME = ("HOME", "Old Street", "Town", "1", "XX")
WORK = ("WORK", "Office Street", "City", "2", "XX")


@pytest.fixture(scope="module")
def base(spark):
    rows = [
        person("1_1", addresses=[HOME], ids=[("passport", "P1", "Gov")]),
        person("1_2", name=None),
        person("2_3", addresses=[HOME, WORK]),
        person("2_4"),
    ]
    return spark.createDataFrame(rows, schemas.SNAPSHOT)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        event("1_1", 10, "NAME", first="B", last="Y"),
        event("1_1", 30, "NAME", first="D", middle="M", last="W"),
        event("1_1", 20, "NAME", first="C", last="X"),
        event("1_1", 40, "ADDRESS", type="WORK", street="S", city="C", postal_code="9", country="YY"),
        event("1_2", 10, "NAME", first="same", last="1"),
        event("1_2", 10, "NAME", first="same", last="2"),
        event("2_3", 10, "ADDRESS", type="HOME", street="H1", city="C", postal_code="9", country="YY"),
        event("2_3", 11, "ADDRESS", type="WORK", street="W1", city="C", postal_code="9", country="YY"),
        event("2_3", 12, "LOGIN", anything="x"),
        event("2_4", 12, "LOGIN", anything="x"),
        event("2_4", 13, "NAME"),  # payload cannot be read
        event("3_9", 5, "IDENTIFICATION", type="licence", number="L1", issuer="Gov"),
        event("3_9", 6, "IDENTIFICATION", type="passport", number="P9", issuer="Gov"),
        event("3_9", 7, "IDENTIFICATION", type="licence", number="L2", issuer="Gov"),
    ]
    return spark.createDataFrame(rows, schemas.EVENT)


def fold(base_rows, event_rows):
    """Plain sequential fold, the rule the distributed merge must equal."""
    people = {r.customer_id: {"name": r.name, "a": {x["type"]: x for x in r.addresses}, "i": {x["type"]: x for x in r.identifications}} for r in base_rows}
    trail = []
    for e in sorted(event_rows, key=lambda e: (e.event_timestamp, bytes(e.payload))):
        try:
            body = json.loads(bytes(e.payload))
        except ValueError:
            continue
        if e.event_type not in schemas.EVENT_TYPES:
            continue
        who = people.setdefault(e.customer_id, {"name": None, "a": {}, "i": {}})
        if e.event_type == "NAME":
            old, new = who["name"], (body["first"], body.get("middle"), body["last"])
            who["name"] = new
        else:
            slot, fields = ("a", schemas.ADDRESS) if e.event_type == "ADDRESS" else ("i", schemas.IDENTIFICATION)
            new = tuple(body[f] for f in fields.fieldNames())
            old = who[slot].get(body["type"])
            who[slot][body["type"]] = new
        trail.append((e.customer_id, e.event_timestamp, None if old is None else tuple(old), tuple(new)))
    return people, trail


def shape(row):
    return (
        None if row.name is None else tuple(row.name),
        [tuple(a) for a in row.addresses],
        [tuple(i) for i in row.identifications],
    )


def test_merge_equals_sequential_fold(base, raw):
    merged = {r.customer_id: r for r in merge.merge_customers(base, events.decode_payload(raw), str(DAY)).collect()}
    people, _ = fold(base.collect(), raw.collect())
    assert set(merged) == set(people)
    for cid, want in people.items():
        name, addresses, ids = shape(merged[cid])
        assert name == (None if want["name"] is None else tuple(want["name"]))
        assert sorted(addresses) == sorted(tuple(a) for a in want["a"].values())
        assert sorted(ids) == sorted(tuple(i) for i in want["i"].values())
    assert {c for c, r in merged.items() if r.was_modified} == {"1_1", "1_2", "2_3", "3_9"}
    new = merged["3_9"]
    assert (new.tenant_id, new.partition_id, new.logical_date) == ("42", "3", DAY)
    assert merged["2_4"].logical_date == BASE_DAY
    assert [a["type"] for a in merged["2_3"].addresses] == ["HOME", "WORK"]


def test_merge_in_two_batches_equals_one(base, raw):
    decoded = events.decode_payload(raw)
    whole = merge.merge_customers(base, decoded, str(DAY)).drop("was_modified")
    early = merge.merge_customers(base, decoded.where("event_timestamp < 12"), str(DAY)).drop("was_modified")
    late = merge.merge_customers(early, decoded.where("event_timestamp >= 12"), str(DAY)).drop("was_modified")
    assert sorted(map(str, whole.collect())) == sorted(map(str, late.collect()))


def test_change_records_equal_the_fold(base, raw):
    got = []
    for r in changes.change_records(base, events.decode_payload(raw)).collect():
        old = r.oldName or r.oldAddress or r.oldId
        new = r.newName or r.newAddress or r.newId
        got.append((r.customer_id, r.event_timestamp, None if old is None else tuple(old), tuple(new)))
    _, trail = fold(base.collect(), raw.collect())
    assert sorted(got, key=repr) == sorted(trail, key=repr)


def test_changes_chain(base, raw):
    """The old value of the next change is the new value of the one before."""
    records = changes.change_records(base, events.decode_payload(raw)).where("event_type = 'NAME' AND customer_id = '1_1'")
    rows = records.orderBy("event_timestamp").collect()
    assert [r.newName for r in rows[:-1]] == [r.oldName for r in rows[1:]]


def test_change_report(base, raw):
    records = changes.change_records(base, events.decode_payload(raw))
    lines = [r.line for r in changes.change_report(records.where("customer_id = '3_9' AND event_timestamp = 5")).orderBy("line_nbr").collect()]
    assert lines == ["Customer ID: 3_9", "  Identification change:", "    From: <none>", "    To:   licence,L1,Gov", "-" * 50]
    assert changes.change_total(records).first().line == f"Total Updates: {records.count()}"


def test_split_outputs(base, raw):
    merged = merge.merge_customers(base, events.decode_payload(raw), str(DAY))
    assert set(merge.split_outputs(merged)) == {"modified"}
    both = merge.split_outputs(merged, "both")
    assert both["full"].count() == 5 and both["modified"].count() == 4
    with pytest.raises(ValueError):
        merge.split_outputs(merged, "other")


def test_outputs_are_written_by_day(spark, base, raw):
    full, delta = scratch_path(spark, "full"), scratch_path(spark, "delta")
    merged = merge.merge_customers(base, events.decode_payload(raw), str(DAY))
    merge.write_outputs(merged, "both", str(DAY), full, delta)
    merge.write_outputs(merged, "modified", str(DAY), delta_root=delta)  # a repeated run replaces the day
    assert spark.read.parquet(full).count() == 5 and spark.read.parquet(delta).count() == 4
    again = snapshot.current_snapshot(base, spark.read.schema(schemas.SNAPSHOT).parquet(delta))
    assert again.count() == 5
    with pytest.raises(ValueError):
        merge.write_outputs(merged, "full", str(DAY))


def test_change_report_files(spark, base, raw):
    path = scratch_path(spark, "report")
    records = changes.change_records(base, events.decode_payload(raw))
    changes.write_change_report(records, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 5 * records.count() and lines.count("-" * 50) == records.count()
    assert spark.read.text(path + "-total").first().value == f"Total Updates: {records.count()}"


def test_custom_handler(base, raw):
    """A registry with one type only: the others are ignored."""
    names = {"NAME": merge.default_handlers()["NAME"]}
    merged = merge.merge_customers(base, events.decode_payload(raw), str(DAY), names)
    assert {r.customer_id for r in merged.where("was_modified").collect()} == {"1_1", "1_2"}


def test_snapshot_with_deltas(spark, base):
    assert sorted(map(str, snapshot.current_snapshot(base, base.limit(0)).collect())) == sorted(map(str, base.collect()))
    deltas = spark.createDataFrame(
        [
            person("1_1", name=("one", None, "d1"), day=datetime.date(2025, 4, 1)),
            person("1_1", name=("two", None, "d2"), day=datetime.date(2025, 4, 2)),
            person("1_1", name=("today", None, "d3"), day=DAY),
            person("2_4", name=("tie", None, "base"), day=BASE_DAY),
        ],
        schemas.SNAPSHOT,
    )
    now = {r.customer_id: r.name for r in snapshot.current_snapshot(base, deltas, before=str(DAY)).collect()}
    assert len(now) == 4 and now["1_1"][0] == "two" and now["2_4"][0] == "tie"


def test_extract(spark, base):
    lines = [r.line for r in extract.extract_lines(base).collect()]
    assert len(lines) == sum(1 + len(r.addresses) + len(r.identifications) for r in base.collect())
    assert "1|1_1|A||Z" in lines and "1|1_2|||" in lines
    assert "2|1_1|HOME|Old Street|Town|1|XX" in lines and "3|1_1|passport|P1|Gov" in lines
    deltas = base.withColumn("logical_date", F.lit("2025-04-01").cast("date"))
    full = extract.extract_source(base, deltas.where("customer_id = '1_1'"), "full", "2025-04-01", "2025-04-02")
    assert full.count() == 4
    assert extract.extract_source(base, deltas, "delta", "2025-04-02", "2025-04-03").count() == 0
    with pytest.raises(ValueError):
        extract.extract_source(base, deltas, "some", "2025-04-02", "2025-04-03")


def test_reconcile_lists_slices_of_both_sides(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), ("z",)], "k string")
    assert rows(reconcile.reconcile(a, b, ["k"])) == [("x", 2, 1, 1), ("y", 1, 0, 1), ("z", 0, 1, -1)]


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        codec.decode(F.lit(b"x"), "NAME", schemas.NAME_PAYLOAD, "xml")


def test_avro_says_what_is_missing(spark):
    assert json.loads(codec.avro_schema("ADDRESS"))["fields"][1]["type"]["symbols"] == ["HOME", "WORK"]
    df = spark.createDataFrame([(bytearray(b"x"),)], "payload binary")
    with pytest.raises(Exception, match="(?i)avro"):
        df.select(codec.decode(F.col("payload"), "NAME", schemas.NAME_PAYLOAD, "avro")).collect()


def test_merge_plan_has_no_python_and_no_product(base, raw):
    text = merge.merge_customers(base, events.decode_payload(raw), str(DAY))._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "CartesianProduct", "NestedLoop"):
        assert bad not in text


def test_batches_of_a_stream_are_several_files(spark, monkeypatch):
    from recordflow.catalog import customers

    monkeypatch.setattr(customers, "FILE_ROWS", 100)
    path = scratch_path(spark, "batches")
    rows = spark.range(900).select("id", F.when(F.col("id") >= 3, F.col("id") % 2).alias("part"))
    assert customers.write_batches(rows, path, "part") == 4
    files = spark.read.parquet(f"{path}/*").select("id", F.input_file_name().alias("f")).collect()
    values = [{None if r.id < 3 else r.id % 2 for r in files if f"/{n}/" in r.f} for n in range(3)]
    assert values == [{0}, {1}, {None}] and sorted(r.id for r in files) == list(range(900))
    assert [len({r.f for r in files if f"/{n}/" in r.f}) for n in range(2)] == [4, 4]
    assert customers.write_batches(rows.where("false"), scratch_path(spark, "batches"), "part") == 1
