"""JDBC calls as options, recorded without a database."""

import pytest

from tierwell import append_jdbc, read_jdbc


class Recorder:
    """Stands in for a session, reader, frame and writer; notes what it is told."""

    def __init__(self):
        self.told = {}
        self.read = self.write = self

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **values):
        self.told.update(values)
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def load(self):
        return self.told

    def save(self):
        self.told["saved"] = True


def test_query_is_run_by_the_database():
    told = read_jdbc(Recorder(), "jdbc:x", "SELECT 1", {"user": "u"})
    assert told == {"format": "jdbc", "user": "u", "url": "jdbc:x", "query": "SELECT 1"}


def test_partitioned_read():
    told = read_jdbc(
        Recorder(), "jdbc:x", "SELECT * FROM t", partition_column="ID", bounds=(0, 99),
        partitions=4,
    )
    assert told["dbtable"] == "(SELECT * FROM t) source" and "query" not in told
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"]) == ("ID", "0", "99")
    assert told["numPartitions"] == 4
    with pytest.raises(ValueError):
        read_jdbc(Recorder(), "jdbc:x", "SELECT 1", partition_column="ID")


def test_append_in_batches():
    frame = Recorder()
    append_jdbc(frame, "jdbc:x", "RAW.JOB", {"user": "u"}, writers=8)
    assert frame.told == {
        "format": "jdbc",
        "user": "u",
        "url": "jdbc:x",
        "dbtable": "RAW.JOB",
        "batchsize": 1000,
        "numPartitions": 8,
        "mode": "append",
        "saved": True,
    }
