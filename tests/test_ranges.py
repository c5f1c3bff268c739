"""Windows over divided groups equal windows over whole ones, and no group sits in one task."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditora.operators import audit, ranges


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(4)
    out = [(k, draw.choice(("big", "big", "big", "small", None)), draw.choice((1, 2)), draw.choice((None, *range(400))), draw.choice((None, 1.0, 2.5, float(draw.randrange(300))))) for k in range(4000)]
    out += [(5000, "alone", 1, 7, 1.0), (5001, "nulls", 1, None, None), (5002, "nulls", 1, None, None)]
    return spark.createDataFrame(out, "id long, emit string, serie int, number long, price double")


def test_lag_equals_the_window(rows):
    got = ranges.lagged(rows, ("emit", "serie"), "number", "before", least_rows=100)
    want = rows.withColumn("before", F.lag("number").over(W.partitionBy("emit", "serie").orderBy(F.col("number").asc_nulls_last())))
    # Which of several rows of one number comes first is open, what they see together is not.
    key = lambda df: sorted(map(str, df.select("emit", "serie", "number", "before").collect()))
    assert key(got) == key(want)
    assert got.columns == want.columns


def test_ranks_equal_the_window(rows):
    got = rows.join(ranges.ranks_by_value(rows, "emit", "price", least_rows=20).withColumnsRenamed({"emit": "e", "price": "p"}), F.col("emit").eqNullSafe(F.col("e")) & F.col("price").eqNullSafe(F.col("p")))
    group = W.partitionBy("emit")
    want = rows.select("id", (F.rank().over(group.orderBy(F.col("price").asc_nulls_last())) - 1).alias("r"), F.count("*").over(group).alias("n"))
    assert {(r.id, r["__rank"], r["__size"]) for r in got.collect()} == {(r.id, r.r, r.n) for r in want.collect()}


def test_one_emitter_is_spread_over_tasks(spark):
    heads = spark.range(20_000).select(F.lit("one").alias("cnpj_emit"), F.lit(1).alias("serie"), F.lit("55").alias("modelo"), (F.col("id") + F.col("id").cast("int").bitwiseAND(0) + F.floor(F.col("id") / 1000)).alias("numero"), F.col("id").cast("string").alias("chave_acesso"))
    gaps = audit.numbering_gaps(heads, least_rows=1000)
    assert sorted(r.numero for r in gaps.collect()) == [1000 * k + k for k in range(1, 20)]
    held = ranges.with_range(heads, ("cnpj_emit", "serie"), "numero", 1000).groupBy("__range").count().collect()
    assert len(held) == ranges.RANGES and max(r["count"] for r in held) < 1000


def test_outliers_of_a_divided_code_equal_the_window(rows):
    got = audit.price_outliers(rows, by="emit", price="price", pattern=None, low=0.05, high=0.9, least_rows=10)
    group = W.partitionBy("emit")
    want = rows.withColumns({"n_ncm": F.count("*").over(group), "pct": F.percent_rank().over(group.orderBy(F.col("price").asc_nulls_last()))}).filter("n_ncm >= 30 AND (pct > 0.9 OR pct < 0.05)")
    assert sorted(map(str, got.select("id", "n_ncm", "pct").collect())) == sorted(map(str, want.select("id", "n_ncm", "pct").collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "percent_rank" not in plan
