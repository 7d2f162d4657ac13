import pytest

from pyspark import SparkConf

from tillwise.session import BASE_CONF, conf_for_cores, get_session, is_object_store, most_cores, object_store_conf
from tillwise.sinks import scratch


def test_object_store_paths():
    assert is_object_store("s3://b/x") and is_object_store("s3a://b/x")
    assert not is_object_store("/data/s3") and not is_object_store("hdfs:///x")


def test_keys_and_endpoint_only_when_given():
    plain = object_store_conf({})
    assert set(plain) == {"spark.hadoop.fs.s3a.impl"}
    full = object_store_conf(
        {"S3_ENDPOINT": "http://h:1", "AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b"}
    )
    assert full["spark.hadoop.fs.s3a.endpoint"] == "http://h:1"
    assert full["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert full["spark.hadoop.fs.s3a.secret.key"] == "b"


def test_partitions_follow_the_largest_cluster():
    conf = SparkConf(loadDefaults=False)
    assert most_cores(conf, 2) == 2
    conf.set("spark.dynamicAllocation.enabled", "true")
    conf.set("spark.dynamicAllocation.maxExecutors", "1000").set("spark.executor.cores", "4")
    assert most_cores(conf, 2) == 4000
    sizes = conf_for_cores(4000)
    assert sizes["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "32000"


def test_what_the_user_set_stays(spark):
    changed = {
        "spark.sql.files.maxPartitionBytes": "64m",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "5000",
    }
    before = dict(spark.conf.getAll)
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        session = get_session("again", conf={"spark.sql.adaptive.skewJoin.enabled": "false"})
        assert {k: session.conf.get(k) for k in changed} == changed
        assert session.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert session.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    finally:
        for key in {*BASE_CONF, *conf_for_cores(1)}:
            if key in before:
                spark.conf.set(key, before[key])
            else:
                spark.conf.unset(key)


def test_scratch_is_in_the_named_folder(spark):
    assert scratch.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session())
