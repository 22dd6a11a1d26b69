from __future__ import annotations

import types

import pytest

from rarespark import session


def fake(master, conf=None):
    context = types.SimpleNamespace(master=master, getConf=lambda: {})
    return types.SimpleNamespace(conf=dict(conf or {}), sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_no_local_scratch_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake(master))
    assert session.shared_folder(fake(master, {"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"


def test_stages_are_measured_and_deleted(spark):
    stage = session.cut_lineage(spark.range(1000), "t")
    assert stage.count() == 1000 and session.stage_bytes(stage) > 1000
    session.drop_stage(stage)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(stage.stage_path).count()


def test_package_is_shipped_once(spark):
    session.ship_package(spark)
    session.ship_package(spark)
    assert sum("rarespark.zip" in f for f in spark.sparkContext.listFiles) <= 1

    def imports(batches):
        import rarespark.functions.ranks  # noqa: F401

        for batch in batches:
            yield batch.assign(ok=True)[["ok"]]

    assert spark.range(1).mapInPandas(imports, "ok boolean").first()["ok"]
