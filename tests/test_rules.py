from datetime import date

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditora.operators import audit
from auditora.plans.catalog import CatalogoRegras, Regra, validar_arquivo, validar_catalogo, validar_condicao
from auditora.plans.engine import RuleEngine, percent_ranks, registrar_handlers_padrao, scored
from auditora.plans.schema import FACT, FINDINGS, names


def fact_rows(spark, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in names(FACT)) for r in rows], FACT)


def test_shipped_catalogue_is_clean(spark):
    assert validar_arquivo(spark=spark) == []
    assert CatalogoRegras.load().ids() == {f"R{k:03d}" for k in range(1, 13)}


@pytest.mark.parametrize("condition, word", [("coluna_que_nao_existe = 1", "desconhecida"), ("1=1 OR DROP TABLE x", "proibida"), ("SELECT SELECT FROM WHERE", "invalido"), ("reflect('a', 'b') = '1'", "permitida"), ("ncm IN (SELECT 1)", "subconsulta"), ("vl_produto + 1", "invalido")])
def test_linter(spark, condition, word):
    assert any(word in p for p in validar_condicao(condition, spark))


def test_bad_rules_are_named(spark, tmp_path):
    good = {"id": "R901", "nome": "x", "categoria": "CALCULO", "severidade": "ALTA", "condicao": "1=1"}
    for change, word in (({"id": "X1"}, "id"), ({"severidade": "GRAVE"}, "severidade"), ({"aliquota_risco": 2}, "aliquota_risco"), ({"ativa": "sim"}, "ativa"), ({"vigencia_fim": "ontem"}, "vigencia_fim"), ({"outro": 1}, "outro")):
        with pytest.raises(ValueError, match=word):
            Regra(**(good | change))
    with pytest.raises(ValueError, match="falta nome"):
        Regra(**{k: v for k, v in good.items() if k != "nome"})
    rules = CatalogoRegras([good, good, good | {"id": "R902", "vigencia_fim": "1999-01-01"}, good | {"id": "R903", "campo_valor": "nada"}, good | {"id": "R904", "aliquota_risco": 0.1}])
    found = validar_catalogo(rules, spark)
    assert [f[:4] for f in found] == ["R902", "R903", "R904", "R901"] and "2 regras" in found[-1]
    (tmp_path / "r.yaml").write_text("regras:\n- id: R1\n")
    assert "ilegivel" in validar_arquivo(tmp_path / "r.yaml", spark)[0]


def test_rules_in_force_and_lookup():
    catalog = CatalogoRegras.load()
    assert "R001" not in {r.id for r in catalog.vigentes(date(2007, 6, 30))}
    assert "R001" in {r.id for r in catalog.vigentes(date(2007, 7, 1))}
    with pytest.raises(KeyError):
        catalog.por_id("R999")
    assert not Regra(id="R900", nome="x", categoria="CALCULO", severidade="ALTA", condicao="1=1", ativa=False).vigente_em(date(2026, 1, 1))


@pytest.mark.parametrize(
    "rule, row",
    [
        ("R001", {"is_simples": True, "cst_icms": "00"}),
        ("R002", {"ncm": "9999"}),
        ("R002", {"ncm": "22021000\n"}),
        ("R003", {"cfop": "6102", "uf_emit": "SP", "uf_dest": "SP"}),
        ("R005", {"tipo_nf": "0", "cfop": "5102"}),
        ("R006", {"csosn": "102", "vl_icms": 5.0}),
        ("R007", {"status": "CANCELADA"}),
        ("R011", {"is_simples": False, "csosn": "102"}),
    ],
)
def test_sql_rules_fire_alone(spark, rule, row):
    clean = {"chave_acesso": "k", "n_item": 1, "ncm": "22021000", "cfop": "5102", "uf_emit": "SP", "uf_dest": "RJ", "tipo_nf": "1", "status": "AUTORIZADA", "vl_produto": 10.0, "vl_icms": 0.0}
    catalog = CatalogoRegras(regras=[r for r in CatalogoRegras.load().regras if r.tipo == "sql"])
    assert RuleEngine(catalog, {"fact": fact_rows(spark, clean)}).executar(date(2026, 1, 1)).count() == 0
    found = RuleEngine(catalog, {"fact": fact_rows(spark, clean | row)}).executar(date(2026, 1, 1)).collect()
    assert [f.id_regra for f in found] == [rule]


def test_no_rule_in_force_and_missing_handler(spark):
    engine = RuleEngine(CatalogoRegras.load(), {"fact": fact_rows(spark)})
    empty = engine.executar(date(1999, 1, 1))
    assert empty.count() == 0 and empty.columns == names(FINDINGS)
    with pytest.raises(KeyError, match="duplicidade_chave"):
        engine.executar(date(2026, 1, 1))


def test_gap_inactive_divergent(spark):
    heads = spark.createDataFrame([("A", "111", "1", 1, "55", date(2026, 1, 1), 10.0), ("B", "111", "1", 2, "55", date(2026, 1, 2), 10.0), ("C", "111", "1", 5, "55", date(2026, 3, 1), 10.0), ("D", "222", "1", 1, "65", date(2026, 1, 1), 9.0)], "chave_acesso string, cnpj_emit string, serie string, numero long, modelo string, dt_emissao date, valor_total double")
    assert [(r.chave_acesso, r.gap) for r in audit.numbering_gaps(heads).collect()] == [("C", 2)]
    assert [r.cnpj_emit for r in audit.inactive_emitters(heads).collect()] == ["222"]
    items = spark.createDataFrame([("A", 10.0), ("B", 4.0), ("B", 5.0)], "chave_acesso string, vl_produto double")
    assert [(r.chave_acesso, r.diferenca) for r in audit.divergent_totals(heads, items).collect()] == [("B", 1.0)]


def test_price_outliers_keep_ties_and_small_groups(spark):
    rows = spark.range(40).select(F.lit("22021000").alias("ncm"), F.col("id").cast("double").alias("vl_unit")).unionByName(spark.range(5).select(F.lit("17049020").alias("ncm"), F.col("id").cast("double").alias("vl_unit")))
    assert sorted(r.vl_unit for r in audit.price_outliers(rows).collect()) == [0.0, 39.0]


def test_percent_ranks_equal_the_window(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 17 != 0, F.pmod(F.xxhash64("id"), F.lit(500)).cast("double")).alias("v"))
    got = percent_ranks(rows, "v", "p").groupBy("v", "p").count().collect()
    from pyspark.sql import Window as W

    want = rows.withColumn("p", F.percent_rank().over(W.orderBy(F.col("v").asc_nulls_last()))).groupBy("v", "p").count().collect()
    assert {(r.v, round(r.p, 12), r["count"]) for r in got} == {(r.v, round(r.p, 12), r["count"]) for r in want}


def test_score_orders_by_severity(spark):
    rows = [(f"R00{k}", "n", s, "CALCULO", "k", 1, "e", 1.0, 1.0) for k, s in enumerate(("CRITICA", "ALTA", "MEDIA", "BAIXA"))]
    got = scored(spark.createDataFrame(rows, FINDINGS)).orderBy(F.desc("score")).collect()
    assert [r.severidade for r in got] == ["CRITICA", "ALTA", "MEDIA", "BAIXA"] and got[0].recorrencia == 4


def test_handlers_are_registered(spark):
    engine = registrar_handlers_padrao(RuleEngine(CatalogoRegras.load(), {}))
    assert {r.condicao for r in engine.catalog.regras if r.tipo == "python"} == set(engine.handlers)


def test_ranked_rows_are_not_joined_by_value(spark):
    rows = spark.range(3000).select((F.col("id") * 7 % 900).cast("double").alias("v")).unionByName(spark.range(900).select(F.lit(0.0).alias("v"))).unionByName(spark.sql("SELECT CAST(NULL AS DOUBLE) AS v FROM range(40)"))
    got = percent_ranks(rows, "v", "p")
    want = rows.withColumn("p", F.percent_rank().over(W.orderBy(F.col("v").asc_nulls_last())))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The only joins are those of the few totals of ranges.
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == plan.count("Join")
