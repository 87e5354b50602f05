"""Queries on executors that are processes of their own, which share nothing with the driver but the checkpoint folder."""

import subprocess
import sys
from pathlib import Path

import pytest
from tests.test_queries import SF, SQL, rows_of

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no driver tables")
REPO = str(Path(__file__).resolve().parent.parent)
CODE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "600m").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
    .config("spark.driver.host", "127.0.0.1").config("spark.local.dir", "{place}/local").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", "file://{place}/shared").getOrCreate())
from freightlens.plans.queries import QUERIES
QUERIES[{name!r}](spark, {sf!r}).repartition(4).write.parquet("{place}/out")
spark.stop()
"""


def on_cluster(name, place):
    import duckdb

    done = subprocess.run([sys.executable, "-c", CODE.format(repo=REPO, place=place, name=name, sf=SF)], cwd=place, capture_output=True, text=True, timeout=600, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    c = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found, want = c.sql(f"SELECT * FROM '{place}/out/*.parquet'"), c.sql(SQL[name])
    assert rows_of(found.columns, found.fetchall()) == rows_of(want.columns, want.fetchall())


def test_jdbc_scan(tmp_path):
    on_cluster("jdbc_scan", tmp_path)


def test_jdbc_scope(tmp_path):
    on_cluster("jdbc_scope", tmp_path)
