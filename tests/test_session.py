from callpay.session import scratch_path, shared_folder, shuffle_partitions


def test_partitions_follow_the_input():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(1024**4) == 4096
    assert shuffle_partitions(100 * 1024**4) == 60_000


def test_scratch_goes_below_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(folder + "/")


def test_without_the_setting_the_shared_warehouse_is_used():
    class Settings:
        def get(self, key, default=None):
            return "hdfs:///warehouse" if key == "spark.sql.warehouse.dir" else default

    class Context:
        def getConf(self):
            return Settings()

    class Session:
        conf, sparkContext = Settings(), Context()

    assert shared_folder(Session()).startswith("hdfs:///warehouse/")
