from types import SimpleNamespace

import pytest

from clickmart.session import MB, input_bytes, is_local, scale_conf, shared_root


def test_scale_conf_bounds():
    assert scale_conf(10 * MB)["spark.sql.shuffle.partitions"] == "200"
    assert int(scale_conf(100 * 10**12)["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 * MB))
    assert scale_conf(100 * 10**12, max_partitions=50_000)["spark.sql.shuffle.partitions"] == "50000"
    mid = int(scale_conf(1000 * 256 * MB)["spark.sql.shuffle.partitions"])
    assert mid == 1000


def test_shared_root_comes_from_session(spark):
    root = shared_root(spark)
    assert root and spark.sparkContext.getCheckpointDir().rstrip("/").endswith(root.split(":")[-1].rstrip("/"))


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(ValueError):
        shared_root(SimpleNamespace(sparkContext=context, conf=conf))
    assert is_local("local[4]") and is_local("local") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")


def test_input_bytes_counts_files_under_globs(spark, tmp):
    for i in range(3):
        with open(f"{tmp}/f{i}.txt", "w") as f:
            f.write("x" * 100)
    assert input_bytes(spark, tmp) >= 300
    assert input_bytes(spark, f"{tmp}/f*.txt", None) == 300
    assert input_bytes(spark, f"{tmp}/none") == 0
