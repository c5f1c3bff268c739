"""Command line: gerar, ingerir, exportar, processar, auditar, validar, classificar, saude.

python -m auditora.cli --base DIR COMMAND ...; tables are Parquet folders below DIR.
"""

from __future__ import annotations

import argparse
import sys
import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import rotear
from .obs import etapa, gravar_metricas, written_with_count
from .operators import classify, dashboard, layers
from .plans.catalog import DEFAULT_CATALOG, CatalogoRegras, validar_arquivo
from .plans.engine import RuleEngine, registrar_handlers_padrao, scored, summary, top_findings
from .scratch import deleted, passing, release, written
from .sources import bronze, nfe, synthetic

TABLES = ("silver_cabecalho_raw", "silver_item_raw", "silver_cabecalho", "silver_item", "fct_item_fiscal", "quarentena")
METRICS_TABLE = "pipeline_metricas"


def session() -> SparkSession:
    return SparkSession.builder.appName("auditora").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def processar(spark: SparkSession, folder: str, base: str) -> dict[str, int]:
    """XML folder to silver tables, fact and quarantine; returns their row counts, taken while they are written."""
    at = dict(zip(TABLES, (f"{base}/{name}" for name in TABLES), strict=True))
    read = lambda name: spark.read.parquet(at[name])
    with passing(spark):
        with etapa("parse_lote", pasta=folder):
            headers, items, failures = nfe.process_folder(spark, folder)
        counts = {"cabecalhos": written_with_count(headers, at[TABLES[0]]), "itens": written_with_count(items, at[TABLES[1]])}
        written_with_count(layers.silver_header(read(TABLES[0])), at[TABLES[2]])
        written_with_count(layers.silver_item(read(TABLES[1])), at[TABLES[3]])
        counts["fato"] = written_with_count(layers.fact(read(TABLES[3]), read(TABLES[2])), at[TABLES[4]])
        # A quarantine of before goes; a new one is written only where a file failed.
        deleted(spark, [at[TABLES[5]]])
        counts["falhas"] = 0 if failures.isEmpty() else written_with_count(failures, at[TABLES[5]], "json")
    gravar_metricas(spark, f"{base}/{METRICS_TABLE}")
    return counts


def auditar(spark: SparkSession, base: str, rules: str = str(DEFAULT_CATALOG), day: date | None = None) -> DataFrame:
    """Findings of the rules in force, written and reread."""
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    tables = {"fact": read("fct_item_fiscal"), "silver_cabecalho": read("silver_cabecalho"), "silver_cabecalho_raw": read("silver_cabecalho_raw"), "silver_item": read("silver_item")}
    with etapa("motor_regras"):
        written_with_count(registrar_handlers_padrao(RuleEngine(CatalogoRegras.load(rules), tables)).executar(day), f"{base}/achados")
    gravar_metricas(spark, f"{base}/{METRICS_TABLE}")
    return read("achados")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--base", default="data/lake")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("gerar")
    for name, kind, default in (("qtd", int, 5000), ("destino", str, "data/xml"), ("taxa-erro", float, 0.08), ("duplicatas", int, 20), ("emitentes", int, 40), ("seed", int, 42)):
        p.add_argument(f"--{name}", type=kind, default=default)
    p = sub.add_parser("ingerir")
    p.add_argument("--pasta", default="data/xml")
    p = sub.add_parser("exportar")
    p.add_argument("--destino", required=True)
    p.add_argument("--origem")
    p.add_argument("--comparar", action="store_true")
    p = sub.add_parser("processar")
    p.add_argument("pasta")
    p = sub.add_parser("auditar")
    p.add_argument("--regras", default=str(DEFAULT_CATALOG))
    p.add_argument("--competencia", help="AAAA-MM")
    p.add_argument("--min-severidade", default="BAIXA")
    p.add_argument("--top", type=int, default=20)
    p = sub.add_parser("validar")
    p.add_argument("regras", nargs="?", default=str(DEFAULT_CATALOG))
    p = sub.add_parser("classificar")
    p.add_argument("--comparar", action="store_true")
    sub.add_parser("saude")
    a = parser.parse_args(argv)
    if a.command == "gerar":
        print({k: len(v) for k, v in synthetic.gerar(a.qtd, a.destino, a.taxa_erro, a.duplicatas, a.emitentes, a.seed).items()})
        return 0
    spark = session()
    try:
        return run(spark, a)
    finally:
        release(spark)


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.command == "ingerir":
        print(bronze.ingest(spark, a.pasta, f"{a.base}/bronze_arquivo"))
    elif a.command == "exportar":
        indexed = bronze.index(bronze.ensure(spark, f"{a.base}/bronze_arquivo"))
        if failed := bronze.undecoded(indexed).count():
            print(f"aviso: {failed} arquivos sem chave ou data")
        bronze.export(indexed, a.destino)
        bronze.export_stats(indexed, target=a.destino).show(truncate=False)
        print("arquivos:", len(spark.read.parquet(a.destino).inputFiles()))
        if a.comparar:
            if a.origem:
                print("bytes XML:", bronze.folder_bytes(spark, a.origem), "bytes Parquet:", bronze.folder_bytes(spark, a.destino))
            for name, query in (("texto", bronze.like_count(indexed, "%<CFOP>6102</CFOP>%")), ("particao", bronze.pruned_totals(spark, a.destino, 2026, 3))):
                began = time.perf_counter()
                query.collect()
                print(f"{name}: {(time.perf_counter() - began) * 1000:.0f} ms")
    elif a.command == "processar":
        print(processar(spark, a.pasta, a.base))
    elif a.command == "auditar":
        day = date(*map(int, a.competencia.split("-")), 1) if a.competencia else None
        found = auditar(spark, a.base, a.regras, day)
        summary(found).show(truncate=False)
        top_findings(scored(found), a.top, a.min_severidade).show(a.top, truncate=False)
    elif a.command == "validar":
        problems = validar_arquivo(a.regras, spark)
        print("\n".join(problems) or "catalogo valido")
        return 1 if problems else 0
    elif a.command == "classificar":
        rows = written(classify.training_rows(spark.read.parquet(f"{a.base}/fct_item_fiscal")), "training-rows", keep=True)
        if a.comparar:
            classify.cross_validation(rows).show()
        split = written(classify.stratified_split(rows), "split", keep=True)
        test = split.filter("is_test")
        votes = written(classify.KnnText(split.filter("NOT is_test")).votes(test), "votes", keep=True)
        truth = test.select(F.col("id").alias("query"), F.col("label").alias("truth"))
        classify.evaluate(classify.best(votes), truth).show()
        classify.calibration(classify.best(votes), truth).show()
        classify.predict(votes).withColumn("fila", rotear(F.col("confianca"))).show(10, truncate=False)
    elif a.command == "saude":
        dashboard.pipeline_health(spark.read.parquet(f"{a.base}/{METRICS_TABLE}")).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
