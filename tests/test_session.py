"""The shared folder comes from the session."""

from tierwell import new_shared_path, session, shared_folder, staged


class Session:
    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})


def test_folder_of_the_session(spark):
    assert shared_folder(Session("yarn", "s3a://lake/tmp/")) == "s3a://lake/tmp"
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_shared_path(spark, "a") != new_shared_path(spark, "a")


def test_without_the_setting_the_warehouse_serves():
    session = Session("yarn")
    session.conf.get = lambda key, default="s3a://lake/warehouse/": None if "checkpoint" in key else default
    assert shared_folder(session) == "s3a://lake/warehouse"


def test_staged_table_is_the_same(spark):
    df = spark.range(100).selectExpr("id", "cast(null as string) s", "rand() r")
    once = staged(df)
    assert once.dtypes == df.dtypes
    assert once.collect() == once.collect() and once.count() == 100


def test_session_settings(spark):
    assert session("tests") is not None
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
