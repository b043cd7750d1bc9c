from datetime import datetime

import pytest

from tidemark.__main__ import main
from tidemark.config import JdbcTarget, PipelineConfig
from tidemark.session import new_run_folder, shared_folder
from tidemark.sizing import (
    broadcast_limit,
    estimated_bytes,
    fits_broadcast,
    parse_bytes,
)
from tidemark.sources.kafka import topic_options
from tidemark.sources.tables import partition_options, snapshot_in_order
from tidemark.streaming.jobs import jdbc_writer


def test_defaults():
    config = PipelineConfig.from_env({}).validate()
    assert config.topics["orders"] == "pg.public.orders"
    assert config.trigger_interval == "10 seconds"
    assert config.shuffle_partitions is None
    assert not config.debug
    assert config.jdbc.url == "jdbc:clickhouse://clickhouse:8123/default"


def test_environment():
    config = PipelineConfig.from_env(
        {
            "KAFKA_SERVERS": "a:1,b:2",
            "DEBUG_MODE": "TRUE",
            "SPARK_SHUFFLE_PARTITIONS": "400",
            "CHECKPOINT_LOCATION": "/shared/ckpt/",
            "CLICKHOUSE_PASSWORD": "secret",
            "STARTING_OFFSETS": "latest",
            "MAX_OFFSETS_PER_TRIGGER": "5000",
            "MIN_PARTITIONS": "16",
            "CHECKPOINT_VERSION": "3",
            "LONG_IDS": "true",
            "CHANGE_SINK": "jdbc",
            "COMPACT_EVERY": "60",
            "DROP_FOLDED": "true",
            "TOMBSTONE_DAYS": "14",
        }
    )
    assert (config.bootstrap_servers, config.debug, config.shuffle_partitions) == ("a:1,b:2", True, 400)
    assert config.checkpoint_for("orders", "/elsewhere") == "/shared/ckpt/orders/v3"
    assert topic_options(config, ["a"])["startingOffsets"] == "latest"
    assert (config.max_offsets_per_trigger, config.min_partitions) == (5000, 16)
    assert config.validate().sink == "jdbc"
    assert (config.compact_every, config.drop_folded, config.tombstone_days) == (60, True, 14)
    assert config.spec("orders").record["id"].dataType.simpleString() == "bigint"
    assert "secret" not in repr(config)
    assert config.jdbc.options()["password"] == "secret"


@pytest.mark.parametrize(
    "broken",
    [
        {"bootstrap_servers": ""},
        {"app_name": ""},
        {"compact_every": 0},
        {"jdbc": JdbcTarget(url="", driver="d")},
        {"topics": {"carts": "pg.public.carts"}},
        {"checkpoint_version": 0},
        {"sink": "file"},
        {"sink": "jdbc"},
    ],
)
def test_validation(broken):
    with pytest.raises(ValueError):
        PipelineConfig(**broken).validate()


def test_unknown_table():
    with pytest.raises(ValueError, match="carts"):
        PipelineConfig().spec("carts")
    with pytest.raises(SystemExit):
        main(["--table", "carts", "--root", "/shared/shop"])
    with pytest.raises(SystemExit):
        main(["--table", "orders"])
    with pytest.raises(ValueError):
        jdbc_writer(PipelineConfig(), "orders_cdc")


def test_topic_options():
    config = PipelineConfig(min_partitions=32)
    options = topic_options(config, ["a", "b"])
    assert options["subscribe"] == "a,b"
    assert options["startingOffsets"] == "earliest"
    assert options["minPartitions"] == "32"
    assert topic_options(config, ["a"], "latest")["startingOffsets"] == "latest"
    since = topic_options(config, ["a"], since=datetime(1970, 1, 1, 0, 0, 5))
    assert since["startingTimestamp"] == "5000"
    assert "startingOffsets" not in since


def test_parallel_reads_of_a_table():
    assert partition_options("id", 1, 100, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        partition_options("id", 5, 1, 4)


def test_snapshot_comes_in_key_order(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "id int")
    assert [r["id"] for r in snapshot_in_order(df).collect()] == [1, 2, 3]


def test_sizes(spark):
    assert parse_bytes("10MB") == parse_bytes("10485760b") == parse_bytes("10485760") == 10 << 20
    assert parse_bytes("-1") == -1
    with pytest.raises(ValueError):
        parse_bytes("much")
    assert broadcast_limit(spark) == 10 << 20
    assert estimated_bytes(spark.range(1000)) == 8000
    assert fits_broadcast(spark.range(1000))
    assert not fits_broadcast(spark.range(10**9))


def test_run_folders_are_new_and_shared(spark):
    folder = shared_folder(spark)
    assert new_run_folder(spark, "x").startswith(folder)
    assert new_run_folder(spark, "x") != new_run_folder(spark, "x")
