"""What crosses the exchange of a ranking."""

import pytest
from pyspark.sql import functions as F

from tests.compare import DATA, differences, duck
from tests.logs import log
from tests.test_scale import large, plan  # noqa: F401
from tidelog.catalog import QUERIES
from tidelog.operators.state import current_state
from tidelog.schemas import ORDERS

SF_DIR = f"{DATA}/sf0.001"


def test_a_ranking_moves_fields_and_not_payloads(spark):
    """of a VARIANT payload only what is asked for is shuffled, and the
    key's hash in half its bytes."""
    text = plan(current_state(log(spark, ("c", "a", 1, "paid")), ORDERS).select("order_id", "status"))
    below = text.split("Exchange hashpartitioning(source_table", 1)[1]
    assert "unhex(event_key" in below and "field_status" in below
    assert "field_customer_id" not in text
    top = text.split("Exchange hashpartitioning(source_table", 1)[0]
    assert "event_data" not in top


def test_keys_of_another_form_still_rank(spark):
    events = log(spark, ("c", "a", 1, "paid"), ("c", "a", 1, "shipped")).withColumn(
        "event_key", F.when(F.get_json_object(F.to_json("event_data"), "$.status") == "paid", "z-2").otherwise("z-1")
    )
    assert [r.status for r in current_state(events, ORDERS).collect()] == ["paid"]
    assert current_state(events, ORDERS, carry=("event_key",)).first().event_key == "z-2"


@pytest.mark.parametrize("name", ["orders_unified", "order_items_unified"])
def test_an_archive_is_not_written_out_from_variants(spark, name):
    """the archive's text is the one its keys are made from."""
    optimised = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json(variant" not in optimised.lower() and "to_json(event_data" not in optimised
    assert optimised.count("to_variant_object") <= 2  # of the hot store alone
    assert differences(spark, duck(SF_DIR), SF_DIR, name) == []


def test_a_whole_log_does_not_meet_keys_before_its_ranking(large):  # noqa: F811
    """the items' log crosses one exchange, that of its ranking."""
    text = plan(QUERIES["demand_surge"](large, SF_DIR))
    assert "Exchange hashpartitioning(record_id" not in text
    assert differences(large, duck(SF_DIR), SF_DIR, "demand_surge") == []
