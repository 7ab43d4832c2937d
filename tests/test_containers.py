"""Containers of records: both forms, refusals, replies in order."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from tests.logs import BASE
from tidelog.operators import containers as C
from tidelog.operators import envelope as E


def data(text):
    return base64.b64encode(text.encode()).decode()


def envelope(n):
    return data(json.dumps({"op": "c", "after": {"id": n, "é": [1.50, None]}, "ts_ms": n, "source": {"table": "t"}}))


def frame(spark, *bodies):
    rows = [(i, b if isinstance(b, (str, type(None))) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "container int, body string").repartition(3)


def record(n, payload):
    return {"recordId": f"r{n}", "data": payload}


def test_replies_keep_order_and_judge_each_record(spark):
    payloads = [envelope(1), "@@@", data('{"op":"x"}'), envelope(4), None, 17]
    body = {"records": [record(9 - n, p) for n, p in enumerate(payloads)], "more": 1}
    without_data = {"records": [{"recordId": "q"}]}
    received = C.unwrap(frame(spark, body, without_data, body))
    answered = C.answer(E.decode(received, ingested_at=BASE))
    made = {r.container: json.loads(r.reply)["records"] for r in C.replies(answered, "container").collect()}
    assert set(made) == {0, 1, 2} and made[0] == made[2]
    assert [r["recordId"] for r in made[0]] == [f"r{9 - n}" for n in range(6)]
    assert [r["result"] for r in made[0]] == ["Ok", "Dropped", "Dropped", "Ok", "Dropped", "Dropped"]
    assert made[1] == [{"recordId": "q", "result": "Dropped"}]
    line = base64.b64decode(made[0][3]["data"])
    assert line.endswith(b"\n")
    row = json.loads(line)
    assert json.loads(row.pop("event_data")) == {"id": 4, "é": [1.5, None]}
    micros = 1_704_067_200_000_000
    assert row == {"source_table": "t", "operation": "c", "record_id": "4", "commit_timestamp": 4000, "ingested_at": micros}
    assert list(row) == ["source_table", "operation", "record_id", "commit_timestamp", "ingested_at"]


def test_a_bad_container_is_refused_whole(spark):
    good = record(1, envelope(1))
    bodies = [
        {"records": [good]},
        '{"records":[' + json.dumps(good),
        {"records": [good, {"data": envelope(2)}]},
        {"records": {"0": good}},
        {"records": None},
        [good],
        None,
        "",
        {"records": []},
        {"other": [good]},
        {"records": [good, 5]},
    ]
    made = frame(spark, *bodies)
    assert [r.container for r in C.unwrap(made).collect()] == [0]
    assert {r.container: r.reason for r in C.refused(made).collect()} == {
        1: "undecodable",
        2: "missing_record_id",
        3: "not_array",
        4: "not_array",
        5: "not_object",
        6: "undecodable",
        7: "undecodable",
        10: "missing_record_id",
    }


def test_the_stream_form_has_no_ids(spark):
    body = {"Records": [{"kinesis": {"data": envelope(3)}}, {"kinesis": {}}, 5, {"data": envelope(4)}]}
    made = frame(spark, body, {"Records": 5})
    rows = C.unwrap(made, form=C.STREAM).orderBy("position").collect()
    assert [(r.position, r.arrival_id, r.data is None) for r in rows] == [
        (0, None, False), (1, None, True), (2, None, True), (3, None, True),
    ]
    reasons = [r.reason for r in E.decode(C.unwrap(made, form=C.STREAM)).orderBy("position").collect()]
    assert reasons == [None, "undecodable", "undecodable", "undecodable"]
    assert [r.reason for r in C.refused(made, form=C.STREAM).collect()] == ["not_array"]


def test_names_that_unwrap_adds_are_refused(spark):
    with pytest.raises(ValueError, match="position"):
        C.unwrap(spark.createDataFrame([("{}", 1)], "body string, position int"))


def test_binary_bodies_and_bytes_that_are_no_text(spark):
    made = spark.createDataFrame([(b'{"records":[{"recordId":"a","data":"x"}]}',), (b"\xff{}",)], "body binary")
    assert [r.arrival_id for r in C.unwrap(made).collect()] == ["a"]
    assert [r.reason for r in C.refused(made).collect()] == ["undecodable"]


def test_replies_send_one_row_per_container(spark):
    """Partial aggregates below the only exchange."""
    received = C.unwrap(frame(spark, {"records": [record(1, envelope(1))]}))
    made = C.replies(C.answer(E.decode(received)), "container")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(delivery") == 1
    assert "partial_collect_list" in plan
    assert made.select(F.count("*")).first()[0] == 1
