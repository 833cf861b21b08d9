"""Queries on tables with keys and rows as larger copies of the given tables have them."""

import datetime
import os

from tilework.plans import registry

from .compare import TABLES, rows_of, rows_of_sql


def tables(spark, sf_dir, tmp_path, name, kinds, rows):
    """A folder of the given tables in which one is replaced."""
    for t in TABLES:
        if t != name:
            os.symlink(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(str(tmp_path / "made"))
    os.rename(next(f for f in (tmp_path / "made").iterdir() if f.name.startswith("part-")), tmp_path / f"{name}.parquet")
    return str(tmp_path)


PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def test_seeds_of_trees_beyond_64_bits(spark, sf_dir, tmp_path):
    import math

    keys = [4, 1_164_740, 1_199_996, 7_199_996]
    at = tables(spark, sf_dir, tmp_path, "part", PART, [(k, "n", "b", "ECONOMY", 7, 1.0) for k in keys])
    got = {r["id"]: r["qw"] for r in registry.QUERIES["placed_instances"](spark, at).collect()}
    assert got == {k: round(math.cos(k * 7919 * 1_000_000_007 / 2**64 * math.pi) * math.sqrt(0.5), 6) for k in keys}


def test_days_of_six_digits_are_labelled_as_in_sql(spark, sf_dir, tmp_path):
    rows = [(k, 1, "O", 1.0, datetime.datetime(2024, 1, 1), "1") for k in (0, 9, 10, 999_979, 999_990, 1_000_000, 8_999_999)]
    at = tables(spark, sf_dir, tmp_path, "orders", ORDERS, rows)
    assert rows_of(registry.QUERIES["incident_days"](spark, at)) == rows_of_sql(registry.ORACLES["incident_days"], at)


def test_exploded_footprints_are_not_broadcast(spark):
    from tilework.operators import polygons as P

    footprints = spark.range(9).selectExpr("id % 3 as tile", "id as r", "id as c", "id as footprint").distinct()
    members = spark.range(9).selectExpr("id % 3 as tile", "id as r", "id as c", "string(id) as component")
    assert "Broadcast" not in P.component_matches(footprints, members)._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_what_is_multiplied_grow_in_number(spark):
    from tilework.checkpoints import DEALT
    from tilework.operators import polygons as P

    rows = spark.range(DEALT // 32).coalesce(1).selectExpr("id", "0 as part", "array(array(struct(id as x, 0L as y), struct(id + 9 as x, 0L as y), struct(id as x, 9L as y))) as rings")
    assert P.edges(rows).rdd.getNumPartitions() == P.CELLS_OF // 32
