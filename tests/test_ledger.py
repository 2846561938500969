import pytest

from slotstream.sinks import ledger


class Database:
    """Statements and rows of one target, kept in lists."""

    def __init__(self):
        self.told, self.done, self.rows = [], {}, []

    def execute(self, statement, values):
        self.told.append((statement.split()[0], values))
        if statement.startswith("SELECT"):
            return [(self.done[tuple(values)],)] if tuple(values) in self.done else []
        if statement.startswith("DELETE"):
            self.rows = [r for r in self.rows if r["dw_batch_id"] != values[0]]
        else:
            self.done[tuple(values[:2])] = values[2]
        return []

    def append(self, df, table):
        self.rows += [r.asDict() for r in df.collect()]

    def counted(self, spark):
        rows = spark.createDataFrame(self.rows, "a int, dw_batch_id int, dw_attempt string")
        done = [(*key, attempt) for key, attempt in self.done.items()]
        table = spark.createDataFrame(done, "target string, batch_id int, attempt string")
        return sorted(r.a for r in ledger.counted(rows, table, "t").collect())


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(1,), (2,)], "a int")


def test_a_repeated_batch_adds_nothing(spark, batch):
    db = Database()
    assert ledger.append_once(batch, db.execute, db.append, "t", 7)
    assert not ledger.append_once(batch, db.execute, db.append, "t", 7)
    assert [x[0] for x in db.told] == ["SELECT", "DELETE", "INSERT", "SELECT"]
    assert db.counted(spark) == [1, 2]


def test_a_broken_attempt_is_replaced(spark, batch):
    db = Database()

    def half(df, table):
        db.append(df.limit(1), table)
        raise ConnectionError

    with pytest.raises(ConnectionError):
        ledger.append_once(batch, db.execute, half, "t", 7)
    assert len(db.rows) == 1 and not db.done
    assert ledger.append_once(batch, db.execute, db.append, "t", 7)
    assert len(db.rows) == 2 and db.counted(spark) == [1, 2]


def test_stragglers_and_other_targets_do_not_count(spark, batch):
    db = Database()
    ledger.append_once(batch, db.execute, db.append, "t", 7)
    ledger.append_once(batch, db.execute, db.append, "other", 8)
    db.rows.append({"a": 9, "dw_batch_id": 7, "dw_attempt": "an earlier one"})
    assert db.counted(spark) == [1, 2]
