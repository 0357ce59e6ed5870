import types

import pytest

from lanelux.session import scratch_path, scratch_root, settle


def fake(master, **conf):
    return types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)),
        sparkContext=types.SimpleNamespace(master=master),
    )


def test_the_folder_of_the_cluster_is_used():
    assert scratch_root(fake("spark://m", spark_checkpoint_dir="hdfs:///scratch/")) == "hdfs:///scratch"
    assert scratch_root(fake("local[2]", spark_checkpoint_dir="/shared")) == "/shared"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        scratch_root(fake("yarn"))


def test_settle_gives_the_same_rows(spark):
    df = spark.range(5).withColumnRenamed("id", "n")
    kept = settle(df, "t")
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert sorted(r["n"] for r in kept.collect()) == [0, 1, 2, 3, 4]
    assert scratch_path(spark, "t") != scratch_path(spark, "t")
    assert settle(df.limit(0), "leeg").count() == 0
