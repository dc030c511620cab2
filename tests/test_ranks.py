"""Exact ranks, medians and places over many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import documents as D
from tallymark.operators import ranks
from tallymark.operators import review as R
from tallymark.tables import Store


@pytest.fixture(params=["true", "false"])
def ranges(spark, request):
    """Ranges merged by adaptive execution, or left as many as they are dealt."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": request.param, "spark.sql.shuffle.partitions": "11"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield request.param == "false"
    for k, v in old.items():
        spark.conf.set(k, v)


def test_ranks_are_exact(spark, ranges):
    values = spark.range(5000).select((F.col("id") * 7919 % 613).alias("v"), F.when(F.col("id") % 5 < 4, "often").alias("g")).repartition(9)
    placed = ranks.ranked(values, [F.asc("g"), F.asc("v")], Store(spark, "t").put, ("g",))
    got = placed.collect()
    for g in (None, "often"):
        mine = sorted((r["rank"], r.v) for r in got if r.g == g)
        assert [k for k, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)
    assert ranks.ranked(values.where("v < 0"), [F.asc("v")], Store(spark, "t").put).collect() == []


def test_median_and_anomalies(spark, ranges):
    r = random.Random(1)
    for n in (1, 2, 501):
        values = [r.randrange(1, 60) / 100 for _ in range(n)]
        frame = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(5)
        placed = ranks.ranked(frame, [F.asc("v")], Store(spark, "t").put)
        mid = sorted(values)[n // 2]
        assert ranks.upper_median(placed, "v").first().mid == mid
        got = {x.id for x in D.anomalies(frame, "v", 0.1, 0.5).collect()}
        assert got == {i for i, v in enumerate(values) if mid >= 0.1 and v < mid * 0.5}
    assert D.anomalies(frame.where("v > 5"), "v", 0.1, 0.5).collect() == []


def test_cells_of_equal_risk_share_no_task(spark, ranges):
    cells = spark.range(30_000).select((F.col("id") % 97).cast("string").alias("scenario_id"), F.col("id").cast("string").alias("point"), F.when(F.col("id") % 1000 == 0, 0.9).otherwise(0.0).alias("risk"))
    out = R.places(cells)
    assert out.columns == ["scenario_id", "point", "risk", "place"]
    got = sorted((x.place, -x.risk, x.scenario_id, x.point) for x in out.collect())
    assert [g[0] for g in got] == list(range(1, 30_001)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    if ranges:
        written = []
        ranks.ranked(cells, [F.desc("risk"), F.asc("scenario_id"), F.asc("point")], lambda f: written.append(Store(spark, "t").put(f)) or written[0])
        held = written[0].groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()
        assert held[1] >= 8 and held[0] < 3 * 30_000 / held[1]
