import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrameWriter

from segmill.operators.staging import _check_shared, drop_staged, stage, staging_root


def session(configured, master="spark://host:7077", files="file:///"):
    hadoop = SimpleNamespace(hadoopConfiguration=lambda: SimpleNamespace(get=lambda key, default: files))
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, _jsc=hadoop)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_folder_comes_from_the_session(spark):
    assert staging_root(session("hdfs://shared/staging/")) == "hdfs://shared/staging"
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_root(session(None))


def test_staged_table_is_cut_from_its_plan(spark):
    df = spark.range(10).repartition(3).distinct()
    staged = stage(df, "t")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()
    assert staged.count() == 10


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[3,2,1024]", "yarn"])
def test_local_folder_is_refused_on_a_cluster(master):
    with pytest.raises(ValueError, match="local to each machine"):
        staging_root(session("/tmp/staging", master))
    assert staging_root(session("file:///shared/staging", master)) == "file:///shared/staging"
    assert staging_root(session("/staging", master, "hdfs://name")) == "/staging"


def test_staged_files_are_dropped_and_others_are_not(spark, tmp_path):
    staged = stage(spark.range(5), "gone")
    files = staged.inputFiles()
    drop_staged(staged)
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)
    spark.range(5).write.parquet(str(tmp_path / "table"))
    drop_staged(spark.read.parquet(str(tmp_path / "table")))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 5


ON_A_CLUSTER = """
import sys
from pyspark.sql import SparkSession
from segmill.operators.staging import Scope, stage

conf = {
    "spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "600m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1",
    "spark.checkpoint.dir": sys.argv[1] + "/kept", "spark.sql.warehouse.dir": sys.argv[1] + "/warehouse", "spark.sql.shuffle.partitions": "2",
}
spark = SparkSession.builder.config(map=conf).getOrCreate()
with Scope():
    print("rows", stage(spark.range(1000), "t").count())
spark.stop()
"""


def test_folder_without_a_scheme_serves_a_cluster_that_shares_it(tmp_path):
    (tmp_path / "kept").mkdir()
    root = str(Path(__file__).resolve().parent.parent)
    ran = subprocess.run([sys.executable, "-c", ON_A_CLUSTER, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=180)
    assert "rows 1000" in ran.stdout, ran.stderr[-2000:]
    assert not [*(tmp_path / "kept").glob("t-*"), *(tmp_path / "kept").glob("shared-*")]


def test_trial_refuses_a_folder_that_shows_too_few_rows_or_cannot_be_written(spark, tmp_path, monkeypatch):
    _check_shared(spark, str(tmp_path))
    assert not list(tmp_path.iterdir())
    (tmp_path / "file").write_text("")
    with pytest.raises(ValueError, match="local to each machine"):
        _check_shared(spark, str(tmp_path / "file"))
    written = DataFrameWriter.parquet
    # As if the files of one task were on another machine.
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: written(self._df.where("id > 0").write, path))
    with pytest.raises(ValueError, match="local to each machine"):
        _check_shared(spark, str(tmp_path / "apart"))
