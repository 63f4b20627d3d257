import pytest
from pyspark.sql import functions as F

from talusflow.operators import quality as qc
from talusflow.operators.regions import assign_region, filter_region, occurrence_grid
from talusflow.schemas import REGIONS, RULES, Region, TableRules

ASIA, AMERICA = REGIONS


def points(spark, rows):
    return spark.createDataFrame(rows, "id long, longitude decimal(11,8), latitude decimal(11,8)")


@pytest.fixture(scope="module")
def some_points(spark):
    from decimal import Decimal as D
    return points(spark, [
        (1, D(70), D(25)), (2, D(100), D(0)), (3, D(-145), D(-55)), (4, D(0), D(0)),
        (5, D(160), D("-13.00000001"))])


def ids(df):
    return sorted(r.id for r in df.collect())


def test_edges_are_out_when_open_and_in_when_closed(some_points):
    assert ids(filter_region(some_points, ASIA, inclusive=False)) == [2]
    assert ids(filter_region(some_points, ASIA)) == [1, 2]


def test_routing_drops_or_keeps_points_outside(some_points):
    routed = assign_region(some_points)
    assert sorted((r.id, r.region) for r in routed.collect()) == [
        (1, "asia_pacific"), (2, "asia_pacific"), (3, "america")]
    kept = assign_region(some_points, keep_unmatched=True)
    assert sorted(r.id for r in kept.where("region is null").collect()) == [4, 5]


def test_overlapping_boxes_give_a_row_each(some_points):
    boxes = [*REGIONS, Region("all", -180, 180, -90, 90)]
    assert assign_region(some_points, boxes).count() == 3 + 5


def test_routing_needs_no_join(some_points):
    assert "Join" not in assign_region(some_points)._jdf.queryExecution().executedPlan().toString()


def test_grid_floors_negative_cells(some_points):
    cells = {(r.cell_x, r.cell_y): r.n_points for r in occurrence_grid(some_points).collect()}
    assert cells[(-15, -6)] == 1 and cells[(0, 0)] == 1 and sum(cells.values()) == 5


RULE = TableRules(primary_key=("id",), not_null=("a",), ranges={"h": (0, 100)},
                  max_length={"t": 3})


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(
        [(1, 1, 50, "abc"), (2, None, 101, "abcd"), (3, 1, None, None), (3, 1, 0, "é")],
        "id long, a int, h int, t string")


def test_reports_count_each_rule(dirty):
    assert [tuple(r) for r in qc.check_ranges(dirty, RULE).collect()] == [("h", "range", 4, 1)]
    assert [tuple(r) for r in qc.check_not_null(dirty, RULE).collect()] == [("a", "not_null", 4, 1)]
    assert [tuple(r) for r in qc.check_varchar_length(dirty, RULE).collect()] == [
        ("t", "length", 4, 1)]


def test_quarantine_is_complete_and_names_the_rules(dirty):
    good, bad = qc.split_quarantine(dirty, RULE)
    assert good.count() == 3 and bad.count() == 1
    assert bad.first().violations == ["h:range", "a:not_null", "t:length"]


def test_keys(spark, dirty):
    assert [tuple(r) for r in qc.check_primary_key(dirty, ["id"]).collect()] == [(3, 2)]
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    assert [tuple(r) for r in qc.check_foreign_key(dirty, "id", parent, "k").collect()] == [(3, 2)]
    nullable = dirty.withColumn("id", F.lit(None).cast("long"))
    assert qc.check_foreign_key(nullable, "id", parent, "k").count() == 0


def test_every_warehouse_rule_names_a_column():
    from talusflow.schemas import STAGED_HOUR, WAREHOUSE
    for table, rules in RULES.items():
        columns = set((WAREHOUSE.get(table) or STAGED_HOUR).fieldNames())
        named = {*rules.primary_key, *rules.not_null, *rules.ranges, *rules.max_length,
                 *rules.foreign_keys}
        assert named <= columns, table
