"""Every registered query of the library against its SQL twin; the others must run and give rows."""

import pytest

from tilework.plans import registry

from .compare import rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert rows_of(registry.QUERIES[name](spark, sf_dir)) == rows_of_sql(registry.ORACLES[name], sf_dir)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    from tilework.operators import grids as G
    from tilework.plans.views import cells

    grid = cells(spark, sf_dir)
    a = rows_of(G.fingerprint(grid, "tile", ["r", "c", "mnt_mm", "mns_mm"]))
    b = rows_of(G.fingerprint(grid.repartition(7, "c").orderBy("mns_mm"), "tile", ["r", "c", "mnt_mm", "mns_mm"]))
    assert a == b
