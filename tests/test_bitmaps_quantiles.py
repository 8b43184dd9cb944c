"""Mergeable distinct counts and refined percentiles against the plain aggregates."""

import random

import pytest
from pyspark.sql import functions as F

from aerolake.operators import bitmaps as B
from aerolake.operators.quantiles import exact_percentiles
from aerolake.session import fresh_path

rng = random.Random(2)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_bitmap_counts_equal_distinct_counts(spark):
    rows = [(rng.choice("ab"), rng.randrange(4), rng.choice([None, *(f"id{k}" for k in range(70_000))])) for _ in range(3000)]
    df = spark.createDataFrame(rows + [("z", 9, None)], "g string, h int, id string")
    numbers = B.dictionary(df, "id")
    n = df.select("id").distinct().where("id is not null").count()
    assert sorted(r.number for r in numbers.collect()) == list(range(1, n + 1))
    leaves = B.group_bitmaps(df, ["g", "h"], "id", numbers)
    for by in (["g", "h"], ["g"], ["h"], []):
        wanted = df.groupBy(*by).agg(F.count_distinct("id").alias("c"))
        assert _rows(B.distinct_counts(leaves, by, "c")) == _rows(wanted.select(*by, "c"))


def test_bitmaps_reach_over_buckets(spark):
    df = spark.range(100_000).selectExpr("id % 2 AS g", "concat('x', id) AS id")
    got = B.distinct_counts(B.group_bitmaps(df, ["g"], "id", B.dictionary(df, "id")), ["g"], "n")
    assert _rows(got) == [(0, 50_000), (1, 50_000)]


def test_a_retried_batch_adds_nothing(spark):
    folder = fresh_path(spark, "dict")
    ids = lambda *x: spark.createDataFrame([(v,) for v in x], "id string")      # noqa: E731
    first = {r.id: r.number for r in B.batch_dictionary(spark, folder, ids("a", "b"), "id", 0).collect()}
    second = {r.id: r.number for r in B.batch_dictionary(spark, folder, ids("b", "c"), "id", 1).collect()}
    again = {r.id: r.number for r in B.batch_dictionary(spark, folder, ids("b", "c"), "id", 1).collect()}
    assert sorted(first.values()) == [1, 2] and second == again == first | {"c": 3}


@pytest.mark.parametrize("bins", [4096, 64])
def test_percentiles_equal_the_aggregate(spark, bins):
    rows = [("few", float(rng.randrange(5))) for _ in range(300)] + [("wide", rng.lognormvariate(0, 8)) for _ in range(400)]
    rows += [("one", 3.5), ("same", 7.0), ("same", 7.0), ("null", None), (None, -2.0), (None, 4.0), ("neg", -1e300), ("neg", 1e-300)]
    df = spark.createDataFrame(rows, "g string, v double")
    if bins == 64:
        df = df.where("g is null or g in ('few', 'one', 'same', 'null')")
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    wanted = df.where("v is not null").groupBy("g").agg(*[F.percentile("v", p).alias(f"p{round(100 * p)}") for p in ps])
    assert _rows(exact_percentiles(df, ["g"], "v", ps, bins)) == _rows(wanted)


def test_no_values_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_percentiles(df, ["g"], "v", [0.5]).count() == 0


def test_the_profile_holds_no_values(spark):
    from aerolake.plans import build, questions
    plan = questions.altitude_profile(build.gold_star(spark, "/root/testdata/sf0.001", "aircrafts"))._jdf.queryExecution().toString()
    assert "percentile(" not in plan
