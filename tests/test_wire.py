"""Payloads, envelopes, typed rows, quarantine."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cdcmart.functions.wire import json_valid
from cdcmart.operators.bronze import typed_bronze, typed_with_status
from cdcmart.operators.quarantine import quarantine, quarantine_summary
from cdcmart.operators.state import current_state
from cdcmart.sources.changes import LOG_SCHEMA, capture_raw, drop_sensitive, protect, unwrap_envelope
from cdcmart.sources.specs import FOREIGN_KEYS, REQUIRED_COLUMNS, SENSITIVE, TABLES, UNIQUE_COLUMNS

COMPLETE = '{"__op":"c","__table":"t","__source_ts_ms":1}'
REASONS = {
    "{bad": "invalid_json",
    "": "invalid_json",
    "NaN": "invalid_json",
    "{'a':1}": "invalid_json",
    '{"a":01}': "invalid_json",
    '{"__op":"c",}': "invalid_json",
    '{"a":1} x': "invalid_json",
    '{"a":1},{"b":2}': "invalid_json",
    '{"a":1}],[{"b":2}': "invalid_json",
    "{}": "missing_op",
    "1": "missing_op",
    "null": "missing_op",
    '"text"': "missing_op",
    f"[{COMPLETE}]": "missing_op",
    '{"__op":"x"}': "invalid_op",
    '{"__op":null}': "invalid_op",
    '{"__op":1}': "invalid_op",
    '{"__op":"c"}': "missing_table",
    '{"a":1,"a":2,"__op":"u"}': "missing_table",
    '{"__op":"c","__table":null}': "missing_source_ts",
    '{"__op":"d","__table":"t"}': "missing_source_ts",
    COMPLETE: None,
    f"  {COMPLETE}\n": None,
    '{"__op":"r","__table":null,"__source_ts_ms":null}': None,
}


def log(spark, payloads, table="orderdetails"):
    records = [(TABLES[table].topic, 0, n, payload) for n, payload in enumerate(payloads)]
    return spark.createDataFrame(records, LOG_SCHEMA)


def test_quarantine_reasons(spark):
    events = quarantine(capture_raw(log(spark, REASONS)))
    found = {r.payload: r.reason for r in events.collect()}
    assert found == {payload: reason for payload, reason in REASONS.items() if reason}
    counts = {r.reason: r.event_count for r in quarantine_summary(events).collect()}
    assert counts == {"invalid_json": 9, "missing_op": 5, "invalid_op": 3, "missing_table": 2, "missing_source_ts": 2}


def test_json_valid_agrees_with_a_strict_parser(spark):
    def strict(text):
        try:
            json.loads(text, parse_constant=lambda _: 1 / 0)
            return True
        except (ValueError, ZeroDivisionError):
            return False

    frame = log(spark, REASONS).select("payload", json_valid(F.col("payload")).alias("valid"))
    assert {r.payload: r.valid for r in frame.collect()} == {payload: strict(payload) for payload in REASONS}


def test_there_are_22_tables():
    assert len(TABLES) == 22
    assert all(column in dict(TABLES[table].fields) for table, column in REQUIRED_COLUMNS)
    assert len({spec.topic for spec in TABLES.values()}) == 22
    assert len(FOREIGN_KEYS) == 27 and len(UNIQUE_COLUMNS) == 13
    undated = {name for name, spec in TABLES.items() if "created_at" not in dict(spec.fields)}
    assert undated == {"ads_campaigns", "discounts"}


def test_no_table_keeps_a_sensitive_column(spark):
    for table, hidden in SENSITIVE.items():
        assert not set(hidden) & {name for name, _ in TABLES[table].fields}
    frame = spark.createDataFrame([(1, "a", "b")], "id int, email string, username string")
    assert drop_sensitive(frame, "users").columns == ["id", "username"]


SAMPLES = {
    "id": (5, 5), "id?": (6, 6), "int": (7, 7), "str": ("x", "x"), "str?": ("y", "y"), "money": ("1.25", D("1.25")),
    "money?": ("2.50", D("2.50")), "float?": ("21.5", 21.5), "flag+": (False, 0),
    "time": (1704128400500, dt.datetime(2024, 1, 1, 17)), "time?": (1704128400500, dt.datetime(2024, 1, 1, 17)),
}
DEFAULTS = {
    "id": 0, "id?": None, "int": 0, "str": "", "str?": None, "money": D("0.00"), "money?": None, "float?": None,
    "flag+": 1, "time": dt.datetime(1970, 1, 1), "time?": None,
}


def value(row, name):
    found = row[name]
    return found.astimezone(dt.timezone.utc).replace(tzinfo=None) if isinstance(found, dt.datetime) else found


@pytest.mark.parametrize("table", sorted(TABLES))
def test_typed_table(spark, table):
    """A full row, a row of nulls, a delete with only its key, a row with an unknown field."""
    spec = TABLES[table]
    full = {name: SAMPLES[kind][0] for name, kind in spec.fields}
    nulls = {name: None for name in full}
    payloads = [
        {**full, "__op": "c"}, {**nulls, "__op": "u"}, {"id": 5, "__op": "d", "__deleted": "true"}, {**full, "new": [1]},
    ]
    typed = typed_bronze(log(spark, [json.dumps(p) for p in payloads], table), spec).orderBy("_version").collect()
    assert [(r._version, r._deleted) for r in typed] == [(0, 0), (1, 0), (2, 1), (3, 0)]
    for name, kind in spec.fields:
        assert value(typed[0], name) == value(typed[3], name) == SAMPLES[kind][1]
        assert value(typed[1], name) == DEFAULTS[kind]
        assert value(typed[2], name) == (5 if name == "id" else DEFAULTS[kind])


def test_unusable_values(spark):
    payloads = [
        '{"id":1,"product_price":"abc","unit_cost_at_order":"abc","__op":"c"}',
        '{"id":"2","product_price":12.30,"quantity":"3","__op":"c"}',
        '{"id":"n/a"}', '{"id":1.5}', '{"id":1,"quantity":"many"}', '{"id":1,"created_at":"today"}', "[1]", "{bad",
        '{"id":1} tail',
    ]
    typed = typed_with_status(log(spark, payloads), TABLES["orderdetails"]).orderBy("_version").collect()
    assert [r._broken for r in typed] == [False, False, *[True] * 7]
    assert (typed[0].product_price, typed[0].unit_cost_at_order) == (D("0.00"), None)
    assert (typed[1].id, typed[1].product_price, typed[1].quantity) == (2, D("12.30"), 3)


def test_flag_values(spark):
    payloads = [f'{{"id":1,"status":{text}}}' for text in ("true", "false", "0", "1", "null")] + ['{"id":1}']
    typed = typed_bronze(log(spark, payloads, "transactions"), TABLES["transactions"]).orderBy("_version")
    assert [r.status for r in typed.collect()] == [1, 0, 0, 1, 1, 1]


def test_envelopes(spark):
    row = {"id": 1, "username": "ann", "password": "p", "email": "e", "score": 1.5, "note": None}
    source = {"table": "users", "ts_ms": 9}
    messages = [
        json.dumps({"before": None, "after": row, "op": "c", "source": source}),
        json.dumps({"before": row, "after": None, "op": "d", "source": source}),
        None,
        "{bad",
    ]
    flat = [r.payload for r in unwrap_envelope(log(spark, messages, "users")).orderBy("offset").collect()]
    kept = {"id": 1, "username": "ann", "score": 1.5, "note": None, "__table": "users", "__source_ts_ms": 9}
    assert json.loads(flat[0]) == {**kept, "__op": "c", "__deleted": "false"}
    assert json.loads(flat[1]) == {**kept, "__op": "d", "__deleted": "true"}
    assert flat[2:] == ["{bad"]


def test_odd_envelopes_stop_nothing_and_leak_nothing(spark):
    source = '"source":{"table":"users","ts_ms":9}'
    messages = [
        f'{{"after":{{"id":1,"username":"a","username":"b","password":"S3CRET"}},"op":"u",{source}}}',
        f'{{"after":{{"id":1,"__op":"own","__deleted":1}},"op":"u",{source}}}',
        '{"after":{"id":1,"password":"S3CRET"},"op":"u"}',
        f'{{"after":{{"id":1,"email":"S3CRET"}},"op":"u",{source}}} tail',
        '{"id":1,"password":"S3CRET","mobile":"S3CRET","__op":"c"}',
        '{"id":1,"password":"S3CRET',
        '{"id":1,"pass\\u0077ord":"S3CRET","username":"x"}',
        '{"id":1,"username":"my password"}',
    ]
    found = [r.payload for r in unwrap_envelope(log(spark, messages, "users")).orderBy("offset").collect()]
    assert not any("S3CRET" in payload for payload in found)
    assert json.loads(found[0])["username"] == "b"
    assert (json.loads(found[1])["__op"], json.loads(found[1])["__deleted"]) == ("u", "false")
    assert json.loads(found[2])["__table"] == "users"
    assert found[3].endswith(" tail") and json.loads(found[4]) == {"id": 1, "__op": "c"}
    assert json.loads(found[6]) == {"id": 1, "username": "x"} and found[7] == messages[7]
    stored = protect(log(spark, messages, "users")).collect()
    assert not any("S3CRET" in r.payload for r in stored)
    # A topic of no known table may hold anybody's columns.
    odd = spark.createDataFrame([("other", 0, 1, messages[4]), ("shop.public.brands", 0, 1, messages[4])], LOG_SCHEMA)
    assert ["S3CRET" in r.payload for r in protect(odd).collect()] == [False, True]


def test_type_errors_are_reported_on_request(spark):
    complete = '"__op":"c","__table":"t","__source_ts_ms":1}'
    raw = capture_raw(log(spark, [f'{{"id":1,{complete}', f'{{"id":"n/a",{complete}', '{"id":"n/a"}']))
    assert [r.reason for r in quarantine(raw).collect()] == ["missing_op"]
    found = quarantine(raw, type_errors=True).orderBy("kafka_offset").collect()
    assert [(r.kafka_offset, r.reason) for r in found] == [(1, "type_error"), (2, "missing_op")]


def test_changes_of_several_partitions(spark):
    """The same key on two partitions: source time decides, not the offset."""
    def payload(name, time):
        return json.dumps({"id": 1, "username": name, "__op": "u", "__source_ts_ms": time})

    topic = TABLES["users"].topic
    records = [(topic, 0, 900, payload("old", 10)), (topic, 1, 3, payload("new", 20))]
    order = ("_source_ts_ms", "partition")
    typed = typed_bronze(spark.createDataFrame(records, LOG_SCHEMA), TABLES["users"], keep=order)
    assert current_state(typed, "id", [*order, "_version"]).first().username == "new"
