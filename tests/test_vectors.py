"""Nearest vectors by cells equal all similarities; grams counted by distinct words equal those of all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditora.functions import text
from auditora.operators import vectors


@pytest.mark.parametrize("cell", [30, 5000])
def test_cells_equal_all_pairs(spark, cell):
    draw = np.random.default_rng(5)
    held = draw.normal(size=(200, 8))
    held[120:150] = held[3]  # copies: ties go to the smaller id
    rows = [(k, v.tolist(), str(k % 3)) for k, v in enumerate(held)]
    got = {}
    for r in vectors.nearest(spark.createDataFrame(rows, "id long, v array<double>, label string"), 5, cell).orderBy("query", "rank").collect():
        assert r.label == str(r.id % 3)
        got.setdefault(r.query, []).append(r.id)
    unit = held / np.linalg.norm(held, axis=1)[:, None]
    keys = np.round(unit @ unit.T, 9)
    assert got == {q: sorted((i for i in range(200) if i != q), key=lambda i: (-keys[q, i], i))[:5] for q in range(200)}


def test_vectors_without_direction_come_last(spark):
    rows = [(1, [1.0, 0.0], None), (2, None, "a"), (3, [0.0, 0.0], "b"), (4, [1.0, 1.0], "c"), (5, [None, 1.0], "d")]
    got = {}
    for r in vectors.nearest(spark.createDataFrame(rows, "id long, v array<double>, label string"), 3).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append((r.id, None if r.sim is None else round(r.sim, 6)))
    assert got[1] == [(4, 0.707107), (2, None), (3, None)] and got[2] == [(1, None), (3, None), (4, None)]


def test_pairs_are_made_in_cells(spark):
    plan = vectors.nearest(spark.range(10).select("id", F.array(F.col("id") + 1.0, F.lit(2.0)).alias("v"), F.lit("a").alias("label")), 5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_grams_of_distinct_words(spark):
    rows = spark.createDataFrame([("a casa da casa",), ("casa  x1",), ("",), (None,)], "text string")
    counted = text.char_wb_counts(rows)
    want = rows.select(F.explode(text.char_wb_ngrams(F.col("text"))).alias("gram")).groupBy("gram").count()
    assert {tuple(r) for r in counted.select("gram", "n").collect()} == {tuple(r) for r in want.collect()}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2


def test_decomposition_is_sliced(monkeypatch):
    seen, whole = [], text.pc.utf8_normalize
    monkeypatch.setattr(text.pc, "utf8_normalize", lambda part, form: seen.append(len(part)) or whole(part, form))
    out = text._plain.func(text.pa.array(["é", None, "ﬁ"] * text.SLICE))
    assert out.to_pylist() == ["e", None, "fi"] * text.SLICE and max(seen) == text.SLICE
    assert text._plain.func(text.pa.array([], text.pa.string())).to_pylist() == []


@pytest.mark.parametrize("strip", [2, 8])
def test_floors_of_strips_leave_out_nothing(strip, monkeypatch):
    monkeypatch.setattr(vectors, "STRIP", strip)
    draw = np.random.default_rng(7)
    for copies in (0, 90):
        sims = draw.normal(size=(20, 101)) / 9
        sims[:, 5 : 5 + copies] = 0.5
        rows, columns = vectors._best(sims, 5)
        keys = np.floor(sims * 1e9 + 0.5)
        assert {(r, c) for r, c in zip(rows.tolist(), columns.tolist(), strict=True)} == {(r, c) for r in range(20) for c in sorted(range(101), key=lambda c: (-keys[r, c], c))[:5]}
