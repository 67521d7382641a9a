import pytest

from helixframe import storage


class Session:
    """What shared_folder reads of a session."""

    def __init__(self, master, named):
        conf = {"spark.checkpoint.dir": named} if named else {}
        self.conf = type("C", (), {"get": staticmethod(lambda k, d=None: conf.get(k, d))})
        self.sparkContext = type("S", (), {"master": master, "applicationId": "app", "getConf": staticmethod(lambda: self.conf)})


def test_folder_is_the_named_one_or_private_on_one_machine(spark):
    assert storage.shared_folder(Session("spark://h:7077", "/mnt/shared")) == "/mnt/shared"
    assert storage.shared_folder(Session("local[2]", None)) == storage.shared_folder(Session("local[2]", None)) != ""
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session("spark://h:7077", None))
    assert storage.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_small_tables_only_are_marked_for_broadcast(spark):
    few = storage.checkpointed(spark.range(10))
    assert "broadcast" in storage.small(few, 10)._jdf.queryExecution().toString().lower() and "broadcast" not in storage.small(few, 9)._jdf.queryExecution().toString().lower()
