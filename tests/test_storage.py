"""Indexes, exports and views over stored tables: same rows, and only the files that can matter are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditora import scratch
from auditora.operators import audit, dashboard
from auditora.plans import views
from auditora.plans.schema import FINDINGS
from auditora.sources import bronze, trigrams


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("bronze") / "t")
    rows = [(k, f"file {k // 10} row {k} " + ("ñandú" if k == 17 else "")) for k in range(60)] + [(60, None), (61, ""), (62, "ab")]
    spark.createDataFrame(rows, "k int, conteudo string").repartitionByRange(7, "k").write.parquet(at)
    index = at + "-index"
    trigrams.write_index(spark, at, index)
    return at, index


@pytest.mark.parametrize("pattern", ["%row 17 %", "%ñandú%", "%ow_17%", "%", "a_", "%nowhere%", "file 3%", "", "%row 1\\_%", "%r%o%"])
def test_like_reads_what_can_match(spark, table, pattern):
    at, index = table
    want = sorted(r.k for r in spark.read.parquet(at).filter(F.col("conteudo").like(pattern)).collect())
    found = trigrams.like_rows(spark, at, index, pattern)
    assert sorted(r.k for r in found.collect()) == want
    if pattern == "%ñandú%":
        assert len(found.inputFiles()) == 1 < len(spark.read.parquet(at).inputFiles())
    if pattern == "%nowhere%":
        assert trigrams.files_that_can_match(spark, at, index, pattern) == []


def test_files_beyond_the_index_are_read(spark, table):
    at, index = table
    spark.createDataFrame([(99, "row nowhere")], "k int, conteudo string").write.mode("append").parquet(at)
    assert [r.k for r in trigrams.like_rows(spark, at, index, "%nowhere%").collect()] == [99]
    before = spark.read.parquet(index).count()
    trigrams.write_index(spark, at, index)
    assert spark.read.parquet(index).count() > before
    assert len(trigrams.files_that_can_match(spark, at, index, "%nowhere%")) == 1
    trigrams.write_index(spark, at, index)


def test_positions_are_of_every_trigram():
    data = np.frombuffer(b"abcabcd", np.uint8)
    parts = {int(p) for k in range(5) for p in trigrams.positions(data[k : k + 3])}
    assert parts == set(trigrams.positions(data).tolist()) and len(parts) == 4
    assert max(parts) < trigrams.PARTS * trigrams.PART_BITS


def test_contents_of_new_files_are_not_shuffled_while_few(spark):
    files = spark.createDataFrame([(f"p{k}", f"p{k}", 1, bytes([k % 5])) for k in range(20)], "path string, nome string, tamanho long, content binary")
    stored = files.filter("path = 'p3'").select(F.sha2("content", 256).alias("sha256"))
    few, many = bronze.new_files(files, stored), bronze.new_files(files, stored, few=0)
    assert sorted(r.nome for r in few.collect()) == sorted(r.nome for r in many.collect()) == ["p0", "p1", "p12", "p14"]
    assert "Exchange hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()


def test_keys_are_read_by_bucket_and_mended(spark, tmp_path):
    at = str(tmp_path / "bronze")
    files = lambda *texts: spark.createDataFrame([(f"{k}.xml", f"{k}.xml", len(t), t.encode()) for k, t in enumerate(texts)], "path string, nome string, tamanho long, content binary")
    many = [f"text {k}" for k in range(40)]
    assert bronze.append_new(files(*many, "text 0"), at) == 40
    assert bronze.append_new(files("text 3", "text 40", "text 40"), at) == 1
    keys = bronze.stored_keys(spark, at)
    assert keys.count() == 41 and keys.filter(F.col("balde") != F.left("sha256", F.lit(2))).count() == 0
    plan = keys.filter(F.col("balde").isin("00", "ff"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [balde" in plan
    # A run that ended before its keys were written.
    spark.createDataFrame([("f" * 64, "x", "lost", 4, None)], "sha256 string, nome string, conteudo string, tamanho long, dh_ingestao timestamp_ntz").write.mode("append").parquet(at)
    assert bronze.stored_keys(spark, at).filter(F.col("sha256") == "f" * 64).count() == 1
    assert bronze.append_new(files(*many), at) == 0


def test_export_statistics_have_six_fields(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2026-01-31", 1.0), ("a", "2026-02-01", 2.0), ("b", None, 4.0)], "cnpj_emit string, d string, valor_total double").withColumn("dt_emissao", F.col("d").cast("date"))
    bronze.export(rows, str(tmp_path / "e"))
    row = bronze.export_stats(rows, target=str(tmp_path / "e")).first()
    assert (row.linhas, row.emitentes, str(row.primeira), str(row.ultima), row.soma, row.particoes) == (3, 2, "2026-01-31", "2026-02-01", 7.0, 2)


def test_kpis_count_without_doubling_rows(spark):
    rows = [(f"R{k % 7:03d}", "n", ("ALTA", "BAIXA")[k % 2], "CALCULO", "k", 1, None if k % 11 == 0 else f"c{k % 13}", 1.0, 0.1 * k) for k in range(200)]
    found = spark.createDataFrame(rows, FINDINGS)
    for levels in (None, ("ALTA",), ("NADA",)):
        kept = found.filter(F.col("severidade").isin(*levels)) if levels else found
        want = kept.agg(F.count("*"), F.countDistinct("cnpj_emit"), F.coalesce(F.sum(F.col("impacto_rs").cast("decimal(18,6)")).cast("double"), F.lit(0.0)), F.countDistinct("id_regra")).first()
        got = dashboard.kpis(found, levels)
        assert tuple(got.first()) == tuple(want)
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_views_are_known_by_name_in_order(spark):
    head = spark.createDataFrame([("A", "1", 1, "1", "55", "x", "2026-01-01", "2026-01-01", 10.0, "AUTORIZADA"), ("B", "1", 4, "1", "55", "x", "2026-03-01", "2026-03-01", 20.0, "AUTORIZADA")], "chave_acesso string, cnpj_emit string, numero long, serie string, modelo string, cnpj_dest string, dt_emissao string, competencia string, valor_total double, status string")
    head = head.withColumns({c: F.col(c).cast("date") for c in ("dt_emissao", "competencia")})
    item = spark.createDataFrame([("A", 10.0), ("B", 19.0)], "chave_acesso string, vl_produto double")
    fact = head.select("chave_acesso", "cnpj_emit").withColumns({"ncm": F.lit("1"), "cfop": F.lit("6102"), "uf_emit": F.lit("SC"), "uf_dest": F.lit("SC"), "vl_produto": F.lit(1.0), "vl_unit": F.lit(1.0)})
    findings = spark.createDataFrame([("R001", "n", "ALTA", "CALCULO", "A", 1, "1", 1.0, 1.0)], FINDINGS)
    names = views.register(spark, dict(zip(views.LAYERS, (head, head, item, fact), strict=True)), findings)
    assert names[-1] == views.CONSOLIDATED and len([n for n in names if n.startswith("v_")]) == 12
    got = {tuple(r) for r in spark.sql("SELECT regra, chave_acesso FROM v_achados_sql").collect()}
    assert got == {tuple(r) for r in audit.consolidated(head, head, item, fact).select("regra", "chave_acesso").collect()}
    assert got == {("GAP_NUMERACAO", "B"), ("NCM_INVALIDO", "A"), ("NCM_INVALIDO", "B"), ("CFOP_UF", "A"), ("CFOP_UF", "B"), ("TOTAL_DIVERGENTE", "B")}
    assert spark.sql("SELECT score FROM v_achados_priorizados").count() == 1 and spark.sql("SELECT * FROM v_queda_faturamento").count() == 0
    views.forget(spark, names)
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_released_tables_are_gone(spark):
    held = scratch.written(spark.range(3).toDF("k"), "held", keep=True)
    path = held.inputFiles()[0]
    assert held.count() == 3
    scratch.release(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_results_live_for_a_span(spark):
    now, asked = [0.0], []

    def rows():
        asked.append(1)
        return spark.range(len(asked))

    results = dashboard.Results(300, lambda: now[0])
    assert len(results.get("a", rows)) == len(results.get("a", rows)) == 1
    now[0] = 299.9
    assert len(results.get("a", rows)) == 1
    now[0] = 300.0
    assert len(results.get("a", rows)) == 2 and len(asked) == 2


def test_kpis_hold_few_bytes_a_client(spark):
    rows = [(f"R{k:03d}", "n", "ALTA", "CALCULO", "k", 1, "c", 1.0, 0.5) for k in (0, 1, 63, 64, 511, 998, 999, 999)]
    got = dashboard.kpis(spark.createDataFrame(rows, FINDINGS))
    assert got.first().regras == 7
    # A bitmap of Spark has 4,096 bytes, whatever it holds.
    assert "bitmap_construct_agg" not in got._jdf.queryExecution().optimizedPlan().toString()
