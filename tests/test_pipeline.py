import os

import pytest

from folioflow.__main__ import all_queries, main
from folioflow.plans import pipeline
from folioflow.session import shared_folder

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def test_run_writes_all_tables_and_metrics(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    assert pipeline.run(spark, DATA, out) == {}
    assert spark.read.parquet(f"{out}/forest").count() > 0
    assert spark.read.parquet(f"{out}/graph/edges").select("edge_type").distinct().count() > 3
    assert spark.read.json(f"{out}/metrics/coverage").count() > 0


def test_command_line(spark, capsys):
    assert main(["list"]) == 0
    assert "p1_found" in capsys.readouterr().out
    assert all(q.__doc__ for q in all_queries().values())
    with pytest.raises(SystemExit):
        main(["query", "no_such_query", "--input", DATA])


def test_shared_folder_follows_the_session(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://x:7077")
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        assert shared_folder(spark)
    else:
        with pytest.raises(RuntimeError):
            shared_folder(spark)
