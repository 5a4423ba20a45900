import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The folder that a cluster would name in spark.checkpoint.dir."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
