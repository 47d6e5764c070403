"""Streams that keep late rows, and models fitted by partial states."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators.custom import LinearModel, custom_learner, merged_state
from tidepanel.sources.batches import BatchTable
from tidepanel.streaming.upsert import DailyTables

NOON = datetime(2024, 1, 10, 12)


def events(spark, rows):
    """(id, series, hours after noon, value)"""
    data = [(i, k, NOON + timedelta(hours=h), float(v)) for i, k, h, v in rows]
    return spark.createDataFrame(data, "id long, unique_id string, ts timestamp, value double")


def cells(df):
    return sorted((r.unique_id, r.ds.day, r.y, r.n) for r in df.collect())


def test_late_rows_are_set_aside_and_copies_left_out(spark, tmp_path):
    tables = DailyTables(str(tmp_path / "t"), "6 hours")
    first = events(spark, [(1, "a", 0, 1), (2, "a", 1, 2), (2, "a", 1, 2), (3, "b", 11, 4)])
    tables.take(first, 0)
    tables.take(first, 0)  # repeated after it was finished
    assert cells(tables.days(spark)) == [("a", 10, 3.0, 2), ("b", 10, 4.0, 1)] and cells(tables.late(spark)) == []
    # the mark is now 17 o'clock: a row before it is late, one at it is not; a copy of an earlier micro-batch goes
    tables.take(events(spark, [(2, "a", 1, 2), (4, "a", 4, 8), (5, "a", 5, 16), (6, "a", 30, 32)]), 1)
    assert cells(tables.days(spark)) == [("a", 10, 19.0, 3), ("a", 11, 32.0, 1), ("b", 10, 4.0, 1)]
    assert cells(tables.late(spark)) == [("a", 10, 8.0, 1)]
    tables.take(events(spark, []), 2)
    tables.take(events(spark, [(4, "a", 4, 8)]), 3)  # a copy of a late row
    assert cells(tables.late(spark)) == [("a", 10, 8.0, 1)]


@pytest.mark.parametrize("stops", [0, 1, 2, 3])
def test_a_stop_between_tables_is_made_up_for(spark, tmp_path, monkeypatch, stops):
    tables = DailyTables(str(tmp_path / "t"), "6 hours")
    tables.take(events(spark, [(1, "a", 0, 1), (2, "b", 12, 2)]), 0)
    more = events(spark, [(1, "a", 0, 1), (3, "a", 1, 4), (4, "b", 13, 8)])
    append, done = BatchTable.append, []

    def fails(self, rows, batch):
        if len(done) == stops:
            raise OSError("lost")
        done.append(batch)
        return append(self, rows, batch)

    monkeypatch.setattr(BatchTable, "append", fails)
    with pytest.raises(OSError):
        tables.take(more, 1)
    monkeypatch.setattr(BatchTable, "append", append)
    tables.take(more, 1)
    assert cells(tables.days(spark)) == [("a", 10, 1.0, 1), ("b", 11, 10.0, 2)]
    assert cells(tables.late(spark)) == [("a", 10, 4.0, 1)]


def test_partial_states_merge_to_the_whole_fit(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 2))
    y = 3 + x @ [1.5, -2.0] + rng.normal(size=500)
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)] + [(1.0, 1.0, None)]
    table = spark.createDataFrame(rows, "x1 double, x2 double, y double")
    want = np.linalg.lstsq(np.column_stack([np.ones(500), x]), y, rcond=None)[0]
    model = LinearModel()
    for parts, fan_in in ((1, 16), (7, 2), (40, 3)):  # with empty partitions too
        state = merged_state(table.repartition(parts), ["x1", "x2"], model, fan_in)
        assert model.finish(state) == pytest.approx(want)
    scorer = custom_learner(model)(table, ["x1", "x2"], [])
    got = scorer(table.withColumn("other", F.lit("o"))).orderBy("x1").select("x1", "x2", "y_hat").collect()
    assert all(r.y_hat == pytest.approx(want[0] + want[1] * r.x1 + want[2] * r.x2) for r in got) and len(got) == 501
    none = custom_learner(model)(table.limit(0), ["x1", "x2"], [])
    assert none(table).filter("y_hat IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="labels"):
        custom_learner(model)(table, ["x1"], ["kind"])
