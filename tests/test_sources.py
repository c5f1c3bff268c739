import pytest
from pyspark.sql import functions as F

from auditora import cli, obs
from auditora.operators import classify, layers
from auditora.functions.text import normalizar, rotear, word_ngrams
from auditora.plans.engine import scored
from auditora.sources import bronze, nfe, synthetic
from auditora.streaming import bronze as streaming

KEY = "".join(str(7 * k % 10) for k in range(44))


def note(key=KEY, ncm="39172900", cfop="5101", dest="<CNPJ>12345678000199</CNPJ>", n_item="1", root=True, **more):
    item = synthetic.item_xml(n_item, cProd="a", xProd="b", NCM=ncm, CFOP=cfop, qCom=2, vUnCom=5, vProd=10)
    return synthetic.note_xml(key, item, number=7, issued="2026-03-15T22:30:00-03:00", emitter="11111111000111", dest=dest, dest_state="SP", total=10, wrapped=root, **more)


def parsed(spark, *texts):
    return nfe.parse(spark.createDataFrame([(f"{k}.xml", t) for k, t in enumerate(texts)], "nome string, content string"))


def test_parse_good_notes(spark):
    rows = parsed(spark, note(), note(root=False), note(dest="<CPF>98765432100</CPF>"))
    heads = nfe.headers(rows).collect()
    assert [h.chave_acesso for h in heads] == [KEY] * 3 and heads[2].cnpj_dest == "98765432100"
    items = nfe.items(rows).collect()
    assert {(i.csosn, i.cst_icms, i.vl_produto, i.valido) for i in items} == {("102", None, 10.0, True)}
    silver = layers.silver_header(nfe.headers(rows)).collect()
    assert len(silver) == 1 and str(silver[0].dt_emissao) == "2026-03-15" and str(silver[0].competencia) == "2026-03-01" and silver[0].is_simples


@pytest.mark.parametrize("text, error", [("<nota><item></nota>", "malformado"), ("", "vazio"), (None, "vazio"), ("<resumo><chave>1</chave></resumo>", "infNFe"), (note(key=KEY[:-1] + "z"), "chave_acesso"), (note(n_item="x"), "n_item"), (note(namespace=None), "infNFe")])
def test_parse_failures(spark, text, error):
    rows = nfe.quarantine(parsed(spark, text, note())).collect()
    assert len(rows) == 1 and error in rows[0].erro


# One character short, one too many, one that is no digit, none; and the groups beside the first and the last.
@pytest.mark.parametrize("bad", [{"ncm": c} for c in ("3917290", "391729001", "3917290X", " ", "3917.290")] + [{"cfop": c} for c in ("510", "51010", "51O1", "0999", "8000")])
def test_bad_items_stay(spark, bad):
    items = nfe.items(parsed(spark, note(**bad))).collect()
    assert len(items) == 1 and not items[0].valido


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder, base = tmp_path_factory.mktemp("xml"), tmp_path_factory.mktemp("lake")
    answer = synthetic.gerar(120, folder, 0.3, 10, 8)
    counts = cli.processar(spark, str(folder), str(base))
    return folder, base, answer, counts, cli.auditar(spark, str(base))


def test_answer_key(spark, lake):
    _, base, answer, counts, found = lake
    assert counts["cabecalhos"] == 130 and counts["falhas"] == 0
    for rule, name in (("R001", "simples_com_cst"), ("R002", "ncm_invalido"), ("R003", "cfop_uf_incoerente"), ("R004", "duplicatas")):
        assert sorted({r.chave_acesso for r in found.filter(F.col("id_regra") == rule).collect()}) == answer[name], rule
    assert found.filter(F.col("id_regra").isin("R005", "R006", "R007", "R008", "R011", "R012")).count() == 0
    assert scored(found).filter("score IS NULL").count() == 0


def test_bronze_is_idempotent_and_streams(spark, lake, tmp_path):
    folder = str(lake[0])
    assert bronze.ingest(spark, folder, str(tmp_path / "b")) == {"novos": 120, "repetidos": 10, "total_bronze": 120}
    assert bronze.ingest(spark, folder, str(tmp_path / "b"))["novos"] == 0
    for _ in range(2):
        streaming.stream(spark, folder, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "s")).count() == 120
    indexed = bronze.index(spark.read.parquet(str(tmp_path / "b")))
    assert bronze.undecoded(indexed).count() == 0
    bronze.export(indexed, str(tmp_path / "e"))
    want = indexed.filter("month(dt_emissao) = 3").groupBy("cnpj_emit").agg(F.round(F.sum("valor_total"), 2).alias("total"))
    assert sorted(map(tuple, bronze.pruned_totals(spark, str(tmp_path / "e"), 2026, 3).collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bronze.ingest(spark, str(tmp_path / "none"), str(tmp_path / "b"))


def test_undecodable_files_are_counted(spark):
    rows = spark.createDataFrame([("x", "no note")], "nome string, conteudo string")
    assert bronze.undecoded(bronze.index(rows)).count() == 1


def test_classifier(spark, lake):
    rows = classify.training_rows(spark.read.parquet(f"{lake[1]}/fct_item_fiscal"))
    split = classify.stratified_split(rows)
    test = split.filter("is_test")
    votes = classify.KnnText(split.filter("NOT is_test")).votes(test)
    truth = test.select(F.col("id").alias("query"), F.col("label").alias("truth"))
    assert classify.evaluate(classify.best(votes), truth).first().acuracia > 0.95
    assert abs(votes.groupBy("query").agg(F.sum("proba").alias("p")).agg(F.max("p")).first()[0] - 1) < 1e-9


def test_text_functions(spark):
    row = spark.createDataFrame([("Água  CX-12, 750mg pç!",)], "t string").select(normalizar(F.col("t"))).first()[0]
    assert row == "agua caixa 12 750mg peca"
    got = spark.createDataFrame([(0.95,), (0.9,), (0.7,), (0.1,)], "c double").select(rotear(F.col("c"))).collect()
    assert [r[0] for r in got] == ["AUTO", "REVISAO", "REVISAO", "ESPECIALISTA"]


def test_stage_metrics(spark, tmp_path):
    obs.METRIC_ROWS.clear()
    obs._saved[0] = 0
    with obs.etapa("a"):
        pass
    with pytest.raises(ValueError), obs.etapa("b"):
        raise ValueError("x")
    obs.gravar_metricas(spark, str(tmp_path / "m"))
    obs.salvar_log_jsonl(str(tmp_path / "m.jsonl"))
    assert {(r.etapa, r.status) for r in spark.read.parquet(str(tmp_path / "m")).collect()} == {("a", "OK"), ("b", "ERRO")}


def test_plain_texts_equal_the_standard_library(spark):
    import random
    import unicodedata

    draw = random.Random(1)
    texts = ["".join(chr(draw.choice((draw.randrange(0x20, 0x250), draw.randrange(0x300, 0x600), draw.randrange(0x900, 0x3000), draw.randrange(0xAC00, 0xD7A0), 0x20DD, 0xFB01))) for _ in range(30)) for _ in range(300)] + [None, ""]
    from auditora.functions.text import _plain

    got = [r[1] for r in spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", _plain(F.col("t"))).orderBy("k").collect()]
    assert got == [None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]


def test_word_pairs_of_a_long_text(spark):
    text = " ".join(f"w{k}" for k in range(30000))
    grams = spark.createDataFrame([(text,), ("a bc",), ("",), (None,)], "t string").select(word_ngrams(F.col("t")).alias("g")).collect()
    assert len(grams[0].g) == 59999 and grams[0].g[30000] == "w0 w1" and [g.g for g in grams[1:]] == [["bc"], [], None]
