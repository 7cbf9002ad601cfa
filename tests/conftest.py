import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldline.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="fieldline-tests", shuffle_partitions=8,
                      extra_conf={"spark.driver.memory": "6g"})
    # Tests own their checkpoint folder; on a cluster spark.checkpoint.dir is already set.
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="fl-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def nothing_stays_cached():
    """A frame that one test caches would stand in for the scans of the next test's plans."""
    yield
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()


@pytest.fixture()
def tmp_table_dir():
    return tempfile.mkdtemp(prefix="fl-tables-", dir="/tmp")


DAY = "TIMESTAMP_NTZ '1999-05-0{} 00:00:00'"


@pytest.fixture()
def tables(spark, tmp_path):
    """400 games of two days, three pitches each, for 10 batters, 4 pitchers and 3 teams."""
    made = {
        "nation": "SELECT CAST(id AS INT) n_nationkey, concat('T', id) n_name FROM range(25)",
        "customer": "SELECT id c_custkey, concat('C', id) c_name, CAST(id % 3 AS INT) c_nationkey, id * 1000.0D c_acctbal FROM range(10)",
        "supplier": "SELECT id s_suppkey, concat('S', id) s_name, CAST(id % 3 AS INT) s_nationkey, id * 3000.0D s_acctbal FROM range(4)",
        "orders": f"SELECT id o_orderkey, id % 10 o_custkey, if(id % 2 = 0, 'F', 'O') o_orderstatus, id * 1.0D o_totalprice, "
                  f"if(id % 2 = 0, {DAY.format(1)}, {DAY.format(2)}) o_orderdate, '1' o_orderpriority FROM range(400)",
        "lineitem": f"SELECT id DIV 3 l_orderkey, id l_partkey, id % 4 l_suppkey, CAST(id % 3 + 1 AS INT) l_linenumber, id % 50 * 1.0D l_quantity, "
                    f"id * 1.0D l_extendedprice, 0.02D l_discount, 0.03D l_tax, if(id % 5 = 0, 'N', 'R') l_returnflag, "
                    f"if(id % 2 = 0, 'O', 'F') l_linestatus, {DAY.format(3)} l_shipdate FROM range(1200)",
    }
    for name, text in made.items():
        spark.sql(text).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
