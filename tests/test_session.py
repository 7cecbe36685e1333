import os

import pytest

from clickwatch import session
from clickwatch.session import drop_staged, new_path, shared_folder, stage, use_all_cores


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    conf = _Conf()

    class sparkContext:
        master = "yarn"


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session())


def test_local_mode_may_use_a_folder_of_its_own(monkeypatch):
    monkeypatch.setattr(_Session.sparkContext, "master", "local[2]")
    monkeypatch.setattr(session, "_local_root", None)
    assert os.path.isdir(shared_folder(_Session()))


def test_only_inputs_of_few_pieces_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert use_all_cores(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    assert use_all_cores(spark.range(0, 100, 1, cores - 1)).rdd.getNumPartitions() == cores - 1


def test_stage_keeps_rows_and_schema_and_can_be_dropped(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    df = spark.range(10).selectExpr("id", "id % 3 AS part")
    staged = stage(df, "t", ["part"])
    assert staged.schema.fieldNames() == ["id", "part"] and staged.exceptAll(df).count() == 0
    drop_staged(spark)
    assert not os.path.exists(tmp_path / "clickwatch" / spark.sparkContext.applicationId)
