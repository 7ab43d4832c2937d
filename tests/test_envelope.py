import base64
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidelog.operators import envelope as E

# payload, reason (None = accepted), record id, table, operation, commit time
GOLDEN = [
    ('{"op":"c","after":{"id":"a","status":"paid"},"source":{"table":"orders"},"ts_ms":1780615647656}',
     None, "a", "orders", "c", datetime(2026, 6, 4, 23, 27, 27, 656000)),
    ('{"op":"d","before":{"id":"a"},"after":null,"source":{"table":"orders"},"ts_ms":1}',
     None, "a", "orders", "d", datetime(1970, 1, 1, 0, 0, 0, 1000)),
    ('{"op":"c","after":{"id":7},"ts_ms":1}', None, "7", "unknown", "c", None),
    ('{"op":"c","after":{"id":""},"ts_ms":0}', None, "", "unknown", "c", datetime(1970, 1, 1)),
    ('{"op":"c","after":{"id":"a"},"ts_ms":"5"}', None, "a", "unknown", "c",
     datetime(1970, 1, 1, 0, 0, 0, 5000)),
    ('{"op":"u","after":{"id":"a"},"ts_ms":1}', "unknown_op", None, None, None, None),
    ('{"after":{"id":"a"},"ts_ms":1}', "unknown_op", None, None, None, None),
    ('{"op":"c","after":null,"ts_ms":1}', "empty_row", None, None, None, None),
    ('{"op":"c","after":{},"ts_ms":1}', "empty_row", None, None, None, None),
    ('{"op":"d","after":{"id":"a"},"ts_ms":1}', "empty_row", None, None, None, None),
    ('{"op":"c","after":{"status":"x"},"ts_ms":1}', "missing_id", None, None, None, None),
    ('{"op":"c","after":{"id":null},"ts_ms":1}', "missing_id", None, None, None, None),
    ('{"op":"c","after":{"id":"a"}}', "missing_ts", None, None, None, None),
    ('{"op":"c","after":{"id":"a"},"ts_ms":"abc"}', "bad_ts", None, None, None, None),
    ('{"op":"c","after":{"id":"a"},"ts_ms":5.7}', "bad_ts", None, None, None, None),
    ("{bad", "undecodable", None, None, None, None),
    (None, "undecodable", None, None, None, None),  # sent as @@@, not base64
    ("[1]", "not_object", None, None, None, None),
    ('{"op":"c","after":"text","ts_ms":1}', "row_not_object", None, None, None, None),
    ('{"op":"c","after":{"id":"a"},"source":null,"ts_ms":1}', None, "a", "unknown", "c", None),
    ('{"op":"c","after":{"id":"a","id":"b"},"ts_ms":1}', None, "b", "unknown", "c", None),
    # beyond the shared fixture
    ('{"op":"c","after":[],"ts_ms":1}', "empty_row", None, None, None, None),
    ('{"op":"c","after":[null],"ts_ms":1}', "row_not_object", None, None, None, None),
    ('{"op":"c","after":0,"ts_ms":1}', "empty_row", None, None, None, None),
    ('{"op":"c","after":false,"ts_ms":1}', "empty_row", None, None, None, None),
    ('{"op":1,"after":{"id":"a"},"ts_ms":1}', "unknown_op", None, None, None, None),
    ('{"op":"c","after":{"id":"a"},"ts_ms":99999999999999999}', "bad_ts", None, None, None, None),
    ('{"op":"c","after":{"id":"a","v":NaN},"ts_ms":1}', "undecodable", None, None, None, None),
    ('"text"', "not_object", None, None, None, None),
    ("null", "not_object", None, None, None, None),
]


def encoded(payload):
    return "@@@" if payload is None else base64.b64encode(payload.encode()).decode()


def records(spark, payloads):
    rows = [(str(i), encoded(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "arrival_id string, data string")


@pytest.fixture(scope="module")
def golden(spark):
    decoded = E.decode(records(spark, [g[0] for g in GOLDEN]))
    rows = decoded.withColumn("event_data", F.to_json("event_data")).collect()
    return sorted(rows, key=lambda r: int(r.arrival_id))


@pytest.mark.parametrize("n", range(len(GOLDEN)))
def test_golden(golden, n):
    _, reason, record_id, table, operation, commit = GOLDEN[n]
    row = golden[n]
    assert row.reason == reason
    if reason is None:
        assert (row.record_id, row.source_table, row.operation) == (record_id, table, operation)
        if commit:
            assert row.commit_timestamp == commit


def test_one_arrival_time_per_batch(golden):
    assert len({r.ingested_at for r in golden}) == 1


def test_dispositions_echo_every_id(spark):
    decoded = E.decode(records(spark, [g[0] for g in GOLDEN]))
    verdicts = {r.arrival_id: r.result for r in E.dispositions(decoded, "arrival_id").collect()}
    assert len(verdicts) == len(GOLDEN)
    for n, g in enumerate(GOLDEN):
        assert verdicts[str(n)] == ("Ok" if g[1] is None else "Dropped")
    counts = decoded.agg(*E.counters()).first()
    assert counts.processed == sum(g[1] is None for g in GOLDEN)
    assert counts.processed + counts.skipped == len(GOLDEN)


def test_updates_as_an_operation_of_their_own(spark):
    rows = records(spark, ['{"op":"u","after":{"id":"a"},"ts_ms":1}'])
    decoded = E.decode(rows, ops={**E.ROW_MEMBER, "u": "after"}).first()
    assert (decoded.reason, decoded.operation, decoded.record_id) == (None, "u", "a")


def test_raw_bytes_need_no_base64(spark):
    payload = GOLDEN[0][0].encode()
    rows = spark.createDataFrame([(bytearray(payload),), (bytearray(b"\xff\xfe"),)], "data binary")
    assert sorted(r.reason or "ok" for r in E.decode(rows).collect()) == ["ok", "undecodable"]


def test_archive_text_is_canonical(spark):
    a = '{"op":"c","after":{"id":"a","n":1.50,"b":"é"},"ts_ms":1}'
    b = '{"ts_ms":1, "after": {"b": "\\u00e9", "n": 1.5, "id": "a"}, "op": "c"}'
    log = E.accepted(E.decode(records(spark, [a, b])))
    rows = E.archived(log).collect()
    assert rows[0].event_data == rows[1].event_data == '{"b":"é","id":"a","n":1.5}'
    assert rows[0].event_key == rows[1].event_key


def test_input_columns_must_not_collide(spark):
    rows = spark.createDataFrame([("a", "b")], "record_id string, data string")
    with pytest.raises(ValueError):
        E.decode(rows)


def test_parsing_is_not_repeated_by_later_filters(spark):
    plan = E.accepted(E.decode(records(spark, ["{}"])))._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.count("parseJson") == 1
