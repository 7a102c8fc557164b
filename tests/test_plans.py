"""Physical plans keep the properties that matter at scale."""

import re

import pytest

from bindings.binding import Binding
from starloom.operators import cdc, fact

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def b(spark):
    return Binding(spark, SF)


def test_latest_event_is_reduced_before_the_shuffle(b):
    text = plan(cdc.latest_event(b.log("sales_order_lines"), ["sales_order_line_id"]))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert text.count("Exchange") == 1


def test_net_changes_aggregate_before_the_shuffle(b):
    text = plan(cdc.net_changes(b.log("log"), ["user_id"], ["seq"]))
    assert "partial_max_by" in text[text.index("Exchange"):] and text.count("Exchange") == 1


def test_history_has_no_join_and_two_shuffles(b):
    text = plan(b.customer_history())
    joins_in_binding = 2  # the change log itself joins customers to nations, once per branch of its union
    assert len(re.findall(r"\w+Join", text)) == joins_in_binding
    assert text.count("Exchange hashpartitioning") == 2


def test_models_read_only_their_columns(b):
    text = plan(b.silver["slv_canales"])
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "o_totalprice" not in columns and "o_orderpriority" in columns


@pytest.mark.parametrize("make", [
    lambda b: b.fact(), lambda b: b.gold["cliente"], lambda b: b.silver["slv_ventas"]])
def test_no_cross_joins_and_no_python(b, make):
    text = plan(make(b))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "SinglePartition"):
        assert node not in text


def test_header_attributes_are_looked_up_before_lines_meet_their_headers(b, monkeypatch):
    seen = {}
    for name in ("scd1_lookup", "scd2_lookup"):
        def spied(rows, dim, natural, *rest, look=getattr(fact, name), **options):
            seen[natural] = fact.LINE_KEY in rows.columns
            return look(rows, dim, natural, *rest, **options)
        monkeypatch.setattr(fact, name, spied)
    b.fact()
    assert seen == {"cliente_id": False, "canal_id": False, "sucursal_id": False, "producto_id": True}
