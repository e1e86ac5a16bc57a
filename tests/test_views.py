"""The views as Spark builds them against their plain texts, on rows with nulls, repeats and unmatched keys."""

import datetime as dt

import pytest
from catalog import views
from catalog.views import VIEWS, Views
from clinspark.session import drop_stages

SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string",
    "customer": "c_custkey long, c_name string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double",
}


@pytest.fixture
def folder(spark, tmp_path):
    days = [dt.datetime(2020, 1, day) for day in (1, 1, 2, 5)] + [None]
    rows = {
        "orders": [(i % 11 or None, i % 4 or None, "O", 1.0, days[i % 5], "1") for i in range(24)],
        "customer": [(1, "c1"), (2, "c2"), (2, "c2 again"), (None, "nobody"), (9, "idle")],
        "part": [(k, f"part {k}", "b", "t") for k in (0, 1, 2, 2, 3)] + [(None, "none", "b", "t")],
        "lineitem": [(i % 12 or None, i % 5, i % 3 or None, i % 4, float(i) if i % 7 else None) for i in range(90)],
    }
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    yield str(tmp_path)
    drop_stages(spark)


def plain(spark, folder: str, name: str):
    """The view straight from the texts, nothing stored."""
    if name not in VIEWS:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    text = VIEWS[name]
    return spark.sql(text, **{n: plain(spark, folder, n) for n in set(views._REFERENCE.findall(text))})


@pytest.mark.parametrize("name", ["dosing", "lb", "vs", "eg", "ex", "cm"])
def test_built_views_have_the_rows_of_their_texts(spark, folder, name):
    built, wanted = getattr(Views(spark, folder), name), plain(spark, folder, name)
    assert built.schema.simpleString() == wanted.schema.simpleString()
    found = sorted(map(str, built.collect()))
    assert found == sorted(map(str, wanted.collect()))
    assert len(found) > 10


def test_all_doses_come_from_one_stored_table(spark, folder):
    v = Views(spark, folder)
    files = {tuple(getattr(v, name).inputFiles()) for name in ("dosing", "lb", "vs", "eg", "ex", "cm")}
    assert len(files) == 1


def test_lines_of_an_order_are_stored_side_by_side(spark, folder):
    """The widest rows are joined last, and stages are packed more tightly than tables that last."""
    v = Views(spark, folder)
    plan = v.sql(views.BUILT["doses"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and "l_partkey" not in joins[0]
    assert all(".zstd." in name for name in v.doses.inputFiles())
