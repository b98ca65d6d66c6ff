import pytest
from sf_data import DATA

from orbitframe.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_its_sql(name, spark, duck, same):
    got, want = catalogue.QUERIES[name](spark, str(DATA)).toPandas(), duck.sql(catalogue.ORACLE_SQL[name]).df()
    assert same(got, want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_gives_rows(name, spark):
    assert catalogue.QUERIES[name](spark, str(DATA)).count() > 0


def test_the_entry_query(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_a_season_becomes_pushed_ranges(spark):
    plan = catalogue.QUERIES["season_filter"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(" in plan or "PushedFilters: [IsNotNull" in plan and "1996-06-01" in plan
    assert "html" not in plan and "l_tax" not in plan


def test_a_coverage_join_is_no_nested_loop(spark):
    plan = catalogue.QUERIES["footprint_coverage"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_polygons_are_taken_apart_once_before_the_join(spark):
    plan = catalogue.QUERIES["footprint_polygons"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    (join,) = [x for x in plan.splitlines() if "Join [__row" in x]
    assert "zip_with" not in join and "transform" not in join
    assert join.index("b_minx") < join.index("b_maxy") < join.index("exists(")  # the boxes' test comes first


def test_yearly_windows_are_ranges_of_the_scan(spark):
    plan = catalogue.QUERIES["yearly_windows"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "GreaterThanOrEqual(o_orderdate,1995-02-01" in plan


def test_grids_are_cut_without_python(spark):
    for name in ("grid_intersect", "grid_within", "grid_area", "footprint_polygons"):
        assert "ArrowEvalPython" not in catalogue.QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()


def test_every_tile_has_a_masked_band(spark):
    tiles = spark.read.parquet(str(DATA / "embeddings.parquet"))
    assert catalogue.QUERIES["masked_band"](spark, str(DATA)).count() == 64 * tiles.count()


def test_every_cell_is_in_a_batch(spark):
    assert sum(r.n for r in catalogue.QUERIES["batch_geometries"](spark, str(DATA)).collect()) == 42 * 44


def test_every_scene_has_a_storage_text(spark):
    rows = catalogue.QUERIES["storage_text"](spark, str(DATA))
    assert rows.count() == catalogue.QUERIES["storage_by_scene"](spark, str(DATA)).count()
    assert rows.filter("text like '%~0 B additional%'").count() > 0
