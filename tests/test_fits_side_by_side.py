"""Fits that each keep a copy of the training rows: side by side on a small table, one at a time on a large one."""

import threading
import time

import pytest

from habiflow.operators import model as M


@pytest.mark.parametrize("held, most", [(4_000_000, M.SIDE_BY_SIDE), (25, 2), (9, 1)])
def test_fits_at_a_time_follow_the_rows_they_hold(spark, monkeypatch, held, most):
    monkeypatch.setattr(M, "HELD_ROWS", held)
    lock, now, seen = threading.Lock(), [0], []

    def run(x):
        with lock:
            now[0] += 1
            seen.append(now[0])
        time.sleep(0.2)
        with lock:
            now[0] -= 1
        return x * x

    assert M._each(spark.range(10), range(9), run) == [x * x for x in range(9)]
    assert max(seen) == most


def test_no_rows_fit_side_by_side(spark):
    assert M._each(spark.range(0), [1, 2], lambda x: -x) == [-1, -2]
