"""Stage timing, rows observed while they are written, metrics table and JSON lines."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .plans.schema import METRICS, names

RUN_ID = uuid.uuid4().hex[:12]
METRIC_ROWS: list[dict] = []
# How many of them the metrics table has.
_saved = [0]
log = logging.getLogger("auditora")


class JsonFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        extra = {k: v for k, v in vars(record).items() if k in ("etapa", "duracao_s", "campos")}
        return json.dumps({"nivel": record.levelname, "mensagem": record.getMessage(), "dh": datetime.fromtimestamp(record.created).isoformat()} | extra, ensure_ascii=False)


@contextmanager
def etapa(nome: str, **campos: object) -> Iterator[dict]:
    """Times a stage; an error is logged, kept in the metrics and raised again.  What the block puts in the dict is logged with its end."""
    began, status, error = time.perf_counter(), "OK", None
    log.info("inicio", extra={"etapa": nome, "campos": campos})
    try:
        yield campos
    except Exception as caught:
        status, error = "ERRO", f"{type(caught).__name__}: {caught}"
        raise
    finally:
        spent = round(time.perf_counter() - began, 3)
        METRIC_ROWS.append({"execucao_id": RUN_ID, "etapa": nome, "duracao_s": spent, "status": status, "erro": error})
        log.log(logging.ERROR if error else logging.INFO, "erro" if error else "fim", extra={"etapa": nome, "duracao_s": spent, "campos": campos})


def written_with_count(rows: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> int:
    """Writes rows as a stage of its own and returns how many, counted in the same pass."""
    seen = Observation()
    name = path.rstrip("/").rsplit("/", 1)[-1]
    with etapa(f"gravar_{name}") as fields:
        getattr(rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode), kind)(path)
        fields["linhas"] = seen.get["n"]
    return seen.get["n"]


def gravar_metricas(spark: SparkSession, table: str) -> None:
    """Appends the stages since the last call to the metrics table."""
    rows = spark.createDataFrame([tuple(m[n] for n in names(METRICS)[:-1]) for m in METRIC_ROWS[_saved[0] :]], "execucao_id string, etapa string, duracao_s double, status string, erro string")
    _saved[0] = len(METRIC_ROWS)
    rows.withColumn("dh", F.current_timestamp().cast("timestamp_ntz")).select(*names(METRICS)).write.mode("append").parquet(table)


def salvar_log_jsonl(path: str) -> None:
    with open(path, "a", encoding="utf-8") as out:
        out.writelines(json.dumps(m, ensure_ascii=False) + "\n" for m in METRIC_ROWS)
