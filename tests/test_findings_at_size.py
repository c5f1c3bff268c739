"""Findings move their rows once for each key: what grows with the tables is not shuffled again, sketched or carried unread."""

import re
from datetime import date

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditora import queries
from auditora.operators import audit, dashboard
from auditora.plans import engine
from auditora.plans.catalog import CatalogoRegras
from auditora.plans.engine import RuleEngine, summary
from auditora.plans.schema import FINDINGS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def merged(spark):
    """Spark as it plans for large tables: nothing is broadcast unless the code says so."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_a_note_move_once_until_they_meet_orders(merged):
    orders = queries.read(merged, SMALL, "orders")
    joined = queries.items(merged, SMALL).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    assert plan(joined).count("Exchange hashpartitioning") == 2


def test_totals_move_items_and_headers_once(merged):
    rows = audit.divergent_totals(queries.header(merged, SMALL), queries.silver_item(merged, SMALL))
    assert plan(rows).count("Exchange hashpartitioning") == 2


def test_gaps_of_small_emitters_are_not_sketched(merged):
    rows = audit.numbering_gaps(queries.header(merged, SMALL))
    assert "SortMergeJoin" not in plan(rows)
    rows.collect()
    # Once run, the plan shows that the sketch of large groups was found empty and left out.
    assert "percentile_approx" not in rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("slots", [1, 7, audit.SLOTS])
def test_outliers_are_exact_whatever_codes_share_a_slot(spark, monkeypatch, slots):
    monkeypatch.setattr(audit, "SLOTS", slots)
    price = F.when(F.col("id") % 101 == 0, None).when(F.col("id") % 103 == 0, F.lit(float("nan"))).otherwise(F.pmod(F.xxhash64("id"), F.lit(700)).cast("double") * (1 + F.col("id") % 11))
    rows = spark.range(6000).select("id", F.concat(F.lit("1000000"), (F.col("id") % 11 % 10).cast("string")).alias("ncm"), price.alias("vl_unit"))
    got = audit.price_outliers(rows, low=0.02, high=0.99, least_rows=200)
    group = W.partitionBy("ncm")
    want = rows.withColumns({"n_ncm": F.count("*").over(group), "pct": F.percent_rank().over(group.orderBy(F.col("vl_unit").asc_nulls_last()))}).filter("n_ncm >= 30 AND (pct > 0.99 OR pct < 0.02)")
    key = lambda df: sorted(map(str, df.select("id", "ncm", "n_ncm", "pct").collect()))
    assert key(got) == key(want) and got.columns == want.columns


def test_rows_between_the_ends_are_dropped_before_they_move(merged):
    rows = merged.range(4000).select("id", F.concat(F.lit("1000000"), (F.col("id") % 2).cast("string")).alias("ncm"), F.col("id").cast("double").alias("vl_unit"))
    assert "BroadcastHashJoin [pmod(hash(ncm" in plan(audit.price_outliers(rows))


@pytest.mark.parametrize("read", [summary, dashboard.top_clients])
def test_columns_nobody_reads_are_not_made(spark, tmp_path, read):
    queries.fact(spark, SMALL).write.parquet(str(tmp_path / "fact"))
    rules = CatalogoRegras(regras=[r for r in queries.catalog().regras if r.tipo == "sql"])
    found = RuleEngine(rules, {"fact": spark.read.parquet(str(tmp_path / "fact"))}).executar(date(2026, 1, 1))
    assert "chave_acesso" not in plan(read(found))


@pytest.mark.parametrize("most", [1000, 2])
def test_what_a_rule_says_stays_behind_when_its_findings_are_scored(merged, monkeypatch, most):
    monkeypatch.setattr(engine, "KINDS", most)
    rows = [(f"R{k % 3}" if k % 5 else None, f"nome {k % 3}", ("ALTA", "BAIXA", None)[k % 3], "C", str(k), k, str(k % 7), float(k), float(k % 40)) for k in range(200)]
    found = engine.scored(merged.createDataFrame(rows, FINDINGS))
    exchanges = re.findall(r"\) Exchange\nInput.*: \[(.*)\]", found._jdf.queryExecution().explainString(merged._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    moved = [e for e in exchanges if "vl_base" in e]
    assert moved and any("nome_regra" in e for e in moved) == (most == 2)
    got = found.collect()
    key = lambda r: tuple(str(x) for x in r[:9])
    assert sorted(map(key, got)) == sorted(map(key, rows))
    assert {(r.severidade, r.peso_sev) for r in got} == {("ALTA", 0.7), ("BAIXA", 0.1), (None, 0.1)}
