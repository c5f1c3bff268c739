"""Nearest texts through pruned lists equal all similarities; cross-validation in one pass equals one model a fold."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditora.operators import classify, neighbours


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(12)
    common, rare = [f"comum{k}" for k in range(6)], [f"raro{k}" for k in range(40)]
    rows = []
    for k in range(120):
        words = [draw.choice(common) for _ in range(draw.randrange(1, 9))] + [draw.choice(rare) for _ in range(draw.choice((0, 0, 1, 3)))]
        rows.append((f"i{k:03d}", " ".join(words), f"c{k % 3}"))
    rows += [("dup1", rows[3][1], "c9"), ("dup2", rows[3][1], "c8"), ("blank", "", "c0"), ("alone", "zzzzzz yyyyyy", "c0")]
    return spark.createDataFrame(rows, "id string, text string, label string"), rows


def grams_of(text):
    words = [w for w in text.split() if len(w) > 1]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)])


def brute(asked, train, k):
    seen = Counter(g for _, t, _ in train for g in grams_of(t))
    idf = {g: math.log((1 + len(train)) / (1 + n)) + 1 for g, n in seen.items()}

    def vector(text):
        v = {g: (1 + math.log(n)) * idf[g] for g, n in grams_of(text).items() if g in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / norm for g, x in v.items()}

    vectors = [(i, vector(t)) for i, t, _ in train]
    out = {}
    for q, text, _ in asked:
        v = vector(text)
        sims = [(-round(sum(x * w.get(g, 0) for g, x in v.items()), 9), i) for i, w in vectors if v.keys() & w.keys()]
        out[q] = [(i, -s) for s, i in sorted(sims)[:k]]
    return out


@pytest.mark.parametrize("longest, k", [(1, 5), (4, 1), (25, 5), (1000, 5)])
def test_neighbours_equal_all_similarities(texts, longest, k):
    frame, rows = texts
    model = classify.KnnText(frame.filter("id NOT LIKE 'i%5'"), "word", k, longest)
    got = {}
    for r in model.neighbours(frame.filter("id LIKE 'i%5' OR id IN ('blank', 'alone')")).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append((r.id, round(r.sim, 9)))
    train = [r for r in rows if not (r[0].startswith("i") and r[0].endswith("5"))]
    want = brute([r for r in rows if (r[0].startswith("i") and r[0].endswith("5")) or r[0] in ("blank", "alone")], train, k)
    assert got == {q: [(i, pytest.approx(s, abs=1e-8)) for i, s in found] for q, found in want.items() if found}


def test_a_long_list_is_divided_and_can_be_left_out(spark):
    train = spark.range(5000).select(F.lit(0).alias("block"), F.col("id"), F.explode(F.array(F.lit("all"), F.concat(F.lit("own"), (F.col("id") / 10).cast("int").cast("string")))).alias("gram"))
    train = train.withColumn("w", F.when(F.col("gram") == "all", 0.1).otherwise(0.9949))
    index = {r.gram: r for r in neighbours.lists(train, 100).collect()}
    assert index["all"].parts == 50 and index["own7"].parts == 1
    asked = spark.createDataFrame([(0, 1, "all", 0.1), (0, 1, "own7", 0.9949)], "block int, query long, gram string, v double")
    found = neighbours.nearest(asked, train, 5, 100)
    assert [r.id for r in found.orderBy("rank").collect()] == [70, 71, 72, 73, 74]
    assert max(r["count"] for r in neighbours._with_part(train, neighbours.lists(train, 100), 100).groupBy("part").count().collect()) < 200


def test_cross_validation_equals_a_model_for_each_fold(texts):
    frame, _ = texts
    got = {r.analyzer: (r.media, r.desvio) for r in classify.cross_validation(frame, k=3).collect()}
    dealt = classify.folds(frame, k=3)
    for analyzer in ("word",):
        hits = []
        for fold in range(3):
            model = classify.KnnText(dealt.filter(F.col("fold") != fold), analyzer)
            test = dealt.filter(F.col("fold") == fold)
            guess = test.select("id", F.col("label").alias("truth")).join(classify.best(model.votes(test)).withColumnRenamed("query", "id"), "id", "left")
            hits.append(guess.agg(F.avg(F.coalesce(F.col("label") == F.col("truth"), F.lit(False)).cast("double"))).first()[0])
        mean = sum(hits) / 3
        assert got[analyzer] == pytest.approx((mean, math.sqrt(sum((h - mean) ** 2 for h in hits) / 3)))
    assert set(classify.compare_analyzers(frame, 3)) == {"char_wb", "word"}


def test_draws_of_divided_classes_equal_the_window(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 5 > 0, "a").when(F.col("id") % 2 == 0, "b").alias("label"))
    order = W.partitionBy("label").orderBy(F.md5(F.concat_ws(":", F.lit(42), F.col("id").cast("string"))), "id")
    want = rows.withColumns({"fold": (F.row_number().over(order) - 1) % 5, "is_test": F.row_number().over(order) <= F.floor(F.count("*").over(W.partitionBy("label")) * 0.3 + 0.5)})
    key = lambda df, c: {(r.id, r[c]) for r in df.collect()}
    assert key(classify.folds(rows, least_rows=100), "fold") == key(want, "fold")
    assert key(classify.stratified_split(rows, least_rows=100), "is_test") == key(want, "is_test")
