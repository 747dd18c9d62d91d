"""Where intermediate tables go."""

import pytest

from postlake.session import shared_folder


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    """The two attributes that decide the folder."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})()


def test_named_folder_is_used():
    session = Session("spark://cluster:7077", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = (shared_folder(session, "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_folder(Session("spark://cluster:7077"), "x")


def test_local_session_keeps_one_folder():
    session = Session("local[4]")
    first = shared_folder(session, "x")
    assert first.rsplit("/", 1)[0] == session.conf["spark.checkpoint.dir"]
    assert shared_folder(session, "y").rsplit("/", 1)[0] == session.conf["spark.checkpoint.dir"]
