"""Learning curves: a fit reads the rows of its own training set, and small fits run beside each other."""

import threading
import time

from pyspark.sql import functions as F

from habiflow.operators import model as M


class _Spy:
    def __init__(self, pipe):
        self.pipe, self.seen = pipe, []

    def fit(self, train):
        self.seen.append((train, train.storageLevel.useMemory))
        return self.pipe.fit(train)


def test_a_fit_holds_its_own_rows_while_it_runs(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"), (F.col("id") % 5).cast("int").alias("fold"),
                                 (F.col("id") * 0.5).alias("x"), (F.col("id") % 3 == 0).cast("int").alias("occurrence"))
    spy = _Spy(M.random_forest(["x"], trees=2, depth=2))
    curve = {r["step"]: r["n_train"] for r in M.learning_curve(df, spy, "k", steps=2).collect()}
    assert curve == {1: 80, 2: 160} and len(spy.seen) == 10
    assert all(held for _, held in spy.seen)
    assert not any(train.storageLevel.useMemory for train, _ in spy.seen)


def test_fits_at_a_time_follow_the_share_they_take(spark, monkeypatch):
    monkeypatch.setattr(M, "HELD_ROWS", 10)
    lock, now, most = threading.Lock(), [0], {}

    def run(s):
        with lock:
            now[0] += 1
            most[s] = max(most.get(s, 0), now[0])
        time.sleep(0.2)
        with lock:
            now[0] -= 1
        return s

    fits = [0.1] * 8 + [1.0] * 3
    assert M._each(spark.range(10), fits, run, lambda s: s) == fits
    assert most[0.1] == M.SIDE_BY_SIDE and most[1.0] == 1
