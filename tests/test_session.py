import pytest

from footfall.session import shared_folder


class FakeSession:
    """The settings that ``shared_folder`` reads."""

    def __init__(self, master, base=""):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = {"spark.checkpoint.dir": base}


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_folder(FakeSession("spark://host:7077"), "x")


def test_a_local_session_may_use_its_own_folder():
    assert "footfall-x-" in shared_folder(FakeSession("local[2]"), "x")


def test_folders_are_new_and_below_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", "")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second
    assert first.startswith(base.rstrip("/"))
