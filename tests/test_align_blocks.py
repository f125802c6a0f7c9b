"""Cubes dealt by time block are aligned where they lie: the rows of the merge join, and no cell is shuffled."""

import random
import re

import pytest
from pyspark.sql import functions as F

from habiflow.operators import raster as R
from habiflow.plans import fixtures as FX

KEYS = ["itime", "ilat", "ilon"]


def _bag(df, cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_blocks_give_the_rows_of_the_merge_join(spark):
    rng = random.Random(11)
    pick = lambda n: None if rng.random() < 0.1 else rng.randrange(n)
    cells = [[(pick(40), pick(3), pick(3), rng.random(), [rng.randrange(9)]) for _ in range(n)] for n in (400, 250)]
    a = spark.createDataFrame(cells[0], "itime int, ilat int, ilon int, v double, tags array<int>")
    b = spark.createDataFrame(cells[1], "itime int, ilat int, ilon int, w double, marks array<int>")
    cols = [*KEYS, "v", "tags", "w", "marks"]
    want = R.align_inner(a, b, KEYS)
    blocked = [x.withColumn("block", F.floor(F.col("itime") / 7)) for x in (a, b)]
    got = R.align_inner(*blocked, KEYS, block="block")
    assert got.columns == want.columns == cols and got.dtypes == want.dtypes
    assert _bag(got, cols) == _bag(want, cols) and want.count() > 100


@pytest.mark.parametrize("steps", [40, 2000])
def test_no_cell_is_shuffled(spark, sf_small, monkeypatch, steps):
    import __spark_entry__ as E
    monkeypatch.setattr(FX, "STEPS_PER_TASK", steps)
    plan = E.queries()["join_align_inner"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (.*)", plan)
    assert len(exchanges) == 2 and all("REPARTITION_BY_NUM" in x for x in exchanges)
    assert plan.index("Generate") < plan.index("Exchange") and plan.count("Generate") == 2


@pytest.mark.parametrize("shift", [0, 1, 60])
def test_a_cube_dealt_by_block_has_the_cubes_rows(spark, sf_small, shift):
    a, b = FX.cube_by_block(spark, sf_small, shift), FX.cube(spark, sf_small).drop("tblock")
    assert a.filter(F.col("block") != F.floor((F.col("itime") - shift) / FX.TIME_BLOCK)).isEmpty()
    a = a.select(b.columns)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()
