import random
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.logs import at, log
from tidelog.operators.state import (
    create_views,
    current_state,
    live_rows,
    naming,
    state_as_of,
)
from tidelog.operators.unify import one_copy, unified_log
from tidelog.plans.business import conversion_funnel
from tidelog.schemas import CUSTOMERS, ORDERS


def states(df):
    return {r.order_id: r.status for r in df.collect()}


CASES = {
    "update": ([("c", "a", 1, "paid"), ("c", "a", 2, "shipped")], {"a": "shipped"}),
    "out of order": ([("c", "a", 2, "shipped", 3), ("c", "a", 1, "paid", 4)], {"a": "shipped"}),
    "delete last": ([("c", "a", 1, "paid"), ("d", "a", 2, None)], {}),
    "re-create": ([("d", "a", 1, None), ("c", "a", 2, "paid")], {"a": "paid"}),
    "duplicate": ([("c", "a", 1, "paid"), ("c", "a", 1, "paid", 9)], {"a": "paid"}),
    "same instant": ([("c", "a", 5, "paid", 6), ("d", "a", 5, None, 5)], {}),
    "same instant, other order": ([("c", "a", 5, "paid", 5), ("d", "a", 5, None, 6)], {}),
    "same instant as an update": ([("d", "a", 5, None, 5), ("u", "a", 5, "paid", 6)], {}),
    "same instant, redelivered": (
        [("c", "a", 5, "paid", 5), ("d", "a", 5, None, 6), ("c", "a", 5, "paid", 9)],
        {},
    ),
    "late delete": ([("c", "a", 2, "paid", 2), ("d", "a", 1, None, 3)], {"a": "paid"}),
    "future update operation": ([("c", "a", 1, "paid"), ("u", "a", 2, "shipped")], {"a": "shipped"}),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("text", [False, True])
def test_cases(spark, name, text):
    events, expected = CASES[name]
    assert states(current_state(log(spark, *events, text=text), ORDERS)) == expected


def test_as_of_between(spark):
    events = log(spark, ("c", "a", 1, "paid"), ("c", "a", 3, "shipped"))
    assert states(state_as_of(events, ORDERS, at(2))) == {"a": "paid"}
    assert states(state_as_of(events, ORDERS, at(9))) == states(current_state(events, ORDERS))


def test_other_tables_are_left_out(spark):
    mixed = log(spark, ("c", "a", 1, "paid")).union(
        log(spark, ("c", "a", 2, "x"), table="customers")
    )
    assert states(current_state(mixed, ORDERS)) == {"a": "paid"}
    assert current_state(mixed, CUSTOMERS).first().last_change_at == at(2)


def test_fields_missing_or_of_another_type_are_null(spark):
    row = current_state(log(spark, ("c", "a", 1, "paid")), ORDERS).first()
    assert (row.total_cents, row.customer_id) == (100, None)


EVENTS = st.lists(
    st.tuples(
        st.sampled_from("ccd"),
        st.sampled_from("abc"),
        st.integers(0, 6),
        st.sampled_from(["paid", "shipped"]),
        st.integers(0, 60),
    ),
    min_size=1,
    max_size=12,
)


def brute_force(events):
    """Plain Python: the greatest commit minute per key, a delete winning ties."""
    winners = {}
    for operation, record, minute, status, *_ in events:
        best = winners.setdefault(record, [(-1, ""), set()])
        if (minute, operation) > best[0]:
            best[0], best[1] = (minute, operation), set()
        if (minute, operation) == best[0]:
            best[1].add(status)
    return {r: s for r, (k, s) in winners.items() if k[1] != "d"}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=EVENTS, seed=st.integers(0, 99))
def test_arrival_and_tiering_do_not_change_state(spark, events, seed):
    rng = random.Random(seed)
    plain = states(current_state(log(spark, *events), ORDERS))
    expected = brute_force(events)
    assert plain.keys() == expected.keys()
    assert all(plain[r] in expected[r] for r in plain)

    again = events + rng.sample(events, len(events) // 2)
    rng.shuffle(again)
    again = [(*e[:4], rng.randrange(99)) for e in again]
    assert states(current_state(log(spark, *again), ORDERS)) == plain

    hot = [e for e in again if rng.random() < 0.6] or again[:1]
    cold = [e for e in again if e not in hot] + again[:2]
    both = unified_log(
        log(spark, *hot), log(spark, *cold, text=True), at(9), mode="full", payload="stored"
    )
    assert states(current_state(both, ORDERS)) == plain


def test_changed_since_equals_filtering_the_state(spark):
    rng = random.Random(3)
    events = [
        (rng.choice("ccd"), f"k{rng.randrange(40)}", rng.randrange(500), "paid")
        for _ in range(400)
    ]
    events = log(spark, *events)
    full = current_state(events, ORDERS)
    for minute in (0, 120, 499, 900):
        cut = current_state(events, ORDERS, changed_since=at(minute))
        expected = sorted(r for r in full.collect() if r.last_change_at >= at(minute))
        assert sorted(cut.collect()) == expected


def test_split_and_full(spark):
    as_of, day = at(60 * 48), timedelta(hours=24)
    hot = log(spark, ("c", "only-hot-old", 5, "paid"), ("c", "both", 60 * 47, "paid"))
    cold = log(
        spark,
        ("c", "only-cold-new", 60 * 47, "paid"),
        ("c", "both", 60 * 47, "paid", 60 * 48),
        ("c", "old", 3, "paid"),
        text=True,
    )
    split = states(current_state(unified_log(hot, cold, as_of, day), ORDERS))
    assert split.keys() == {"both", "old"}
    full = unified_log(hot, cold, as_of, day, mode="full")
    assert states(current_state(full, ORDERS)).keys() == {
        "only-hot-old", "only-cold-new", "both", "old",
    }
    both = [r for r in full.collect() if r.record_id == "both"]
    assert [r.source_store for r in both] == ["cold"]  # the copy that arrived last
    with pytest.raises(ValueError):
        unified_log(hot, cold, as_of, mode="other")


def test_one_copy_is_exact(spark):
    copies = log(spark, *[("c", "a", 1, "paid", n) for n in range(20)], ("c", "b", 1, "paid"))
    assert {(r.record_id, r.ingested_at) for r in one_copy(copies).collect()} == {
        ("a", at(19)),
        ("b", at(1)),
    }


def test_views_answer_sql(spark):
    events = log(
        spark, ("c", "a", 1, "paid"), ("c", "b", 2, "paid"), ("c", "c", 3, "shipped")
    )
    create_views(events, [ORDERS])
    by_sql = spark.sql(
        """
        SELECT status, COUNT(*) AS orders, CAST(SUM(total_cents) AS DOUBLE) / 100 AS dollars,
               CAST(ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS DOUBLE) AS pct_of_total
        FROM orders_current GROUP BY status ORDER BY orders DESC
        """
    )
    by_function = conversion_funnel(current_state(events, ORDERS), at(10))
    assert by_sql.collect() == by_function.collect()


def test_live_rows_of_every_table_in_one_ranking(spark):
    mixed = log(spark, ("c", "a", 1, "paid")).union(
        log(spark, ("d", "a", 2, None), table="customers")
    )
    assert [(r.source_table, r.record_id) for r in live_rows(mixed).collect()] == [("orders", "a")]


def test_keys_of_wanted_values_keep_their_whole_history(spark):
    """An item that moved to or from a wanted order is ranked, a deleted one goes."""
    rows = [
        ("c", "stays", 1, "w"), ("c", "moves-in", 1, "x"), ("c", "moves-in", 2, "w"),
        ("c", "moves-out", 1, "w"), ("c", "moves-out", 2, "x"),
        ("c", "gone", 1, "w"), ("d", "gone", 2, None), ("c", "other", 1, "x"),
    ]
    events = log(spark, *rows)
    wanted = spark.createDataFrame([("w",)], "status string")
    found = current_state(naming(events, ORDERS, "status", wanted), ORDERS)
    assert {r.order_id: r.status for r in found.collect()} == {
        "stays": "w",
        "moves-in": "w",
        "moves-out": "x",
    }
    full = current_state(events, ORDERS).where("status = 'w'").collect()
    assert sorted(found.where("status = 'w'").collect()) == sorted(full)


def test_keys_and_times_do_not_depend_on_the_session_zone(spark):
    """Also at wall clocks that a zone has twice or not at all, and before 1970."""
    from tidelog.functions import payload, times

    moments = ["2024-03-10 02:30:00.5", "2024-11-03 01:30:00", "1969-12-31 23:59:59.999999", "1883-11-18 12:01:02", "9999-12-31 23:59:59"]
    found = []
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = spark.sql("SELECT inline(array(" + ",".join(f"struct(timestamp_ntz'{m}' AS t)" for m in moments) + "))")
            one, t = F.lit("x"), F.col("t")
            us, ms = times.epoch_us(t), times.epoch_ms(t)
            found.append(
                rows.select(
                    us, ms, payload.event_key(one, one, one, t, one), times.from_epoch_us(us) == t,
                    times.epoch_ms(times.from_epoch_ms(ms)) == ms,
                ).collect()
            )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found[0] == found[1] == found[2]
    assert all(r[3] and r[4] for r in found[0])
    assert [r[0] for r in found[0]][2] == -1 and found[0][2][1] == -1
