"""Every command through main, one after the other over one lake."""

import pytest

from auditora import cli, obs, scratch


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("cli")
    base, xml = str(at / "lake"), str(at / "xml")
    assert cli.main(["gerar", "--qtd", "60", "--destino", xml, "--duplicatas", "4", "--emitentes", "6"]) == 0
    (at / "xml" / "ruim.xml").write_text("<nota>")
    for command in (["ingerir", "--pasta", xml], ["processar", xml], ["auditar", "--top", "3", "--min-severidade", "ALTA"]):
        assert cli.main(["--base", base, *command]) == 0
    return base, xml, at


def test_tables_and_quarantine(spark, lake):
    base, xml, at = lake
    assert {p.name for p in (at / "lake").iterdir()} >= {"bronze_arquivo", "achados", "pipeline_metricas", *cli.TABLES}
    assert [r.arquivo for r in spark.read.json(f"{base}/quarentena").collect()] == ["ruim.xml"]
    (at / "xml" / "ruim.xml").unlink()
    assert cli.processar(spark, xml, base)["falhas"] == 0
    assert not (at / "lake" / "quarentena").exists()
    assert cli.processar(spark, xml, base)["cabecalhos"] == spark.read.parquet(f"{base}/silver_cabecalho_raw").count() == 64


def test_metrics_are_written_by_commands(spark, lake, capsys):
    rows = spark.read.parquet(f"{lake[0]}/pipeline_metricas")
    stages = {r.etapa for r in rows.collect()}
    assert stages >= {"parse_lote", "motor_regras", "gravar_fct_item_fiscal", "gravar_achados"}
    assert rows.filter("etapa = 'motor_regras'").count() == 1
    assert cli.main(["--base", lake[0], "saude"]) == 0 and "motor_regras" in capsys.readouterr().out


def test_export_compares(lake, capsys):
    base, xml, at = lake
    assert cli.main(["--base", base, "exportar", "--destino", str(at / "out"), "--origem", xml, "--comparar"]) == 0
    out = capsys.readouterr().out
    assert "bytes XML" in out and "particao:" in out and "texto:" in out and "particoes" in out and "arquivos:" in out


def test_classifier_and_linter(lake, capsys, tmp_path):
    assert cli.main(["--base", lake[0], "classificar"]) == 0
    assert "acuracia" in capsys.readouterr().out
    assert cli.main(["validar"]) == 0
    (tmp_path / "r.yaml").write_text("regras:\n- {id: R900, nome: x, categoria: CALCULO, severidade: ALTA, condicao: nada = 1}\n")
    assert cli.main(["validar", str(tmp_path / "r.yaml")]) == 1
    assert "desconhecida: nada" in capsys.readouterr().out
    assert scratch._kept == []


def test_rows_are_counted_while_written(spark, tmp_path):
    assert obs.written_with_count(spark.range(7), str(tmp_path / "sete")) == 7
    assert obs.METRIC_ROWS[-1]["etapa"] == "gravar_sete" and obs.METRIC_ROWS[-1]["status"] == "OK"
