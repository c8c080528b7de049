"""Every registered query against its SQL."""

import subprocess
import sys
import tempfile

import pytest
from pyspark import SparkFiles, cloudpickle

import __spark_entry__ as entry
from gridmend.plans import catalog
from compare import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    problem, rows = differences(spark, con, SMALL, name)
    assert problem is None and rows > 0


def test_whole_tables_are_read(spark, con):
    """No status, attribute or variable is left out of the queries as a group."""
    cells = {f + s for f, s in con.execute("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem").fetchall()}
    days = con.execute("""SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS day FROM lineitem)
        WHERE NOT (month(day) = 2 AND day(day) = 29)""").fetchone()[0]
    for name in ("sim_quantile_both", "sim_quantile_same_doy_both", "nearest_node_both"):
        rows = catalog.QUERIES[name](spark, SMALL).select("cell").collect()
        assert len(rows) == days and {r.cell for r in rows} == cells
    assert {r.cell for r in catalog.QUERIES["doy_window_pool_both"](spark, SMALL).select("cell").distinct().collect()} == cells
    for name in ("merge_attrs_all", "carry_attrs_all"):
        keys = " ".join(r.key for r in catalog.QUERIES[name](spark, SMALL).collect())
        assert "first_day" in keys and 'last "day"' in keys and "n" in keys.split()
    assert {"validate", "validate_pr", "validate_tasmax"} <= set(catalog.QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).columns == ["cell", "date", "v", "sim_q"]


def test_workers_import_the_package_by_name(spark):
    """Tasks that cannot see the repository find the shipped package, and a worker keeps its tables between them."""
    from gridmend.functions import kernels
    from gridmend.shipping import ship

    assert b"dynamic_subimport" not in cloudpickle.dumps(kernels.centres)
    ship(spark)
    code = "import sys; sys.path[:] = [p for p in sys.path if p] + sys.argv[1:]; from gridmend.functions import kernels; print(kernels.centres(0, 800, 0, kernels.PoolSpec())[2].shape)"
    archive = SparkFiles.get("gridmend-package.zip")
    with tempfile.TemporaryDirectory() as folder:
        out = subprocess.run([sys.executable, "-c", code, archive], cwd=folder, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "(3, 122)"
