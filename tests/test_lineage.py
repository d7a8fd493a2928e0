"""The checkpoint folder and the spreading of small inputs."""

from types import SimpleNamespace

import pytest

from ebbtide.operators import lineage


class Context(SimpleNamespace):
    folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, **conf):
    return SimpleNamespace(
        sparkContext=Context(master=master), conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default))
    )


def test_folder_of_the_session_is_used():
    assert lineage.checkpoint_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"


def test_folder_set_before_is_kept():
    s = session("yarn", **{"spark.checkpoint.dir": "other"})
    s.sparkContext.setCheckpointDir("hdfs:///first")
    assert lineage.checkpoint_dir(s) == "hdfs:///first"


def test_a_session_without_a_folder_uses_the_shared_warehouse():
    s = session("spark://host:7077", **{"spark.sql.warehouse.dir": "hdfs:///warehouse"})
    assert lineage.checkpoint_dir(s) == "hdfs:///warehouse/_checkpoints"


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_local_warehouse_is_no_shared_folder(master):
    for warehouse in ("spark-warehouse", "/data/warehouse", "file:/data/warehouse", "file:///data"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            lineage.checkpoint_dir(session(master, **{"spark.sql.warehouse.dir": warehouse}))


def test_on_one_machine_any_folder_will_do():
    for master in ("local", "local[4]"):
        assert lineage.checkpoint_dir(session(master, **{"spark.sql.warehouse.dir": "here"})) == "here/_checkpoints"


def test_cut_keeps_the_rows(spark):
    assert sorted(r[0] for r in lineage.cut(spark.range(5)).collect()) == [0, 1, 2, 3, 4]


def test_rows_are_spread_only_where_the_session_says_so(spark):
    one = spark.range(100).coalesce(1)
    assert lineage.spread(one) is one
    spark.conf.set(lineage.SPREAD, "3")
    try:
        assert lineage.spread(one).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(lineage.SPREAD)
