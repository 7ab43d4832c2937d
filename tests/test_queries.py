"""Every registered query against its SQL, values and types."""

import pytest

from oracles import SQL
from tests.compare import DATA, differences, duck
from tidelog.catalog import QUERIES

SF_DIR = f"{DATA}/sf0.001"

# the others run a job before they return
LAZY = [
    n
    for n in QUERIES
    if not n.startswith("streamed")
    and not n.endswith(("beside_stream", "after_compact"))
    and n not in ("pruned_store", "compacted_archive")
]

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_values(spark, con, name):
    assert differences(spark, con, SF_DIR, name) == []


@pytest.mark.parametrize("name", LAZY)
def test_types(spark, con, name):
    mine = {f.name: TYPES[f.dataType.simpleString()] for f in QUERIES[name](spark, SF_DIR).schema}
    described = con.execute(f"DESCRIBE {SQL[name]}").fetchall()
    assert mine == {row[0]: row[1] for row in described}


ORDERED = ("top_products", "demand_surge", "low_stock", "abandoned_carts", "ltv_by_country")


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_the_order_of_the_sql(spark, name):
    sf_dir = f"{DATA}/sf0.01"
    answer = QUERIES[name](spark, sf_dir)
    cursor = duck(sf_dir).execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert [tuple(r[c] for c in columns) for r in answer.collect()] == expected and expected


def test_answers_are_the_same_on_written_logs(spark, con, monkeypatch):
    from tidelog.sources import bindings

    monkeypatch.setattr(bindings, "_WRITTEN", {})
    bindings.materialise(spark, SF_DIR)
    for name in ("orders_current", "unified_full", "uncovered_rows", "status_mix_at_version"):
        assert differences(spark, con, SF_DIR, name) == []
        assert "/part-" in QUERIES[name](spark, SF_DIR).inputFiles()[0]


def test_a_log_repeated_has_other_events(spark):
    from tidelog.sources import bindings

    once = bindings.event_log(spark, SF_DIR)
    made = bindings.repeated_log(spark, SF_DIR, 3)
    assert made.count() == made.select("event_key").distinct().count() == 3 * once.count()
    assert made.columns == once.columns
