"""The audit views over headers, items and the fact, as DataFrame functions.

Column names are parameters where another table may stand in.  Sums of money
run over decimals and come out as DOUBLE, so their order cannot matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import ranges

VALID_NCM = r"^[0-9]{8}\z"
PLACEHOLDERS = ("00000000", "99999999")
SLOTS = 1 << 16


def money_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(18,6)")).cast("double")


def numbering_gaps(headers: DataFrame, by: tuple[str, ...] = ("cnpj_emit", "serie"), number: str = "numero", model: str | None = "55", least_rows: int = ranges.LEAST_ROWS) -> DataFrame:
    """Documents whose number leaves a gap to the one before, and its size; an emitter of least_rows documents or more is divided by number."""
    rows = headers.filter(F.col("modelo") == model) if model else headers
    rows = ranges.lagged(rows, by, number, "__previous", least_rows)
    return rows.withColumn("gap", F.col(number) - F.col("__previous") - 1).drop("__previous").filter("gap > 0")


def duplicate_keys(raw: DataFrame, key: tuple[str, ...] = ("chave_acesso",), emitter: str = "cnpj_emit") -> DataFrame:
    return raw.groupBy(*key).agg(F.min(emitter).alias(emitter), F.count("*").alias("ocorrencias")).filter("ocorrencias > 1")


def duplicate_numbers(headers: DataFrame, by: tuple[str, ...] = ("cnpj_emit", "serie", "numero"), key: str = "chave_acesso") -> DataFrame:
    return headers.groupBy(*by).agg(F.countDistinct(key).alias("chaves_distintas"), F.min(key).alias(key)).filter("chaves_distintas > 1")


def economic_duplicates(headers: DataFrame, by: tuple[str, ...] = ("cnpj_emit", "cnpj_dest", "dt_emissao", "valor_total"), value: str = "valor_total", least: float = 100.0, key: str = "chave_acesso") -> DataFrame:
    return headers.filter(F.col(value) > least).groupBy(*by).agg(F.count("*").alias("ocorrencias"), F.min(key).alias(key)).filter("ocorrencias > 1")


def invalid_ncm(fact: DataFrame, code: str = "ncm", pattern: str = VALID_NCM, placeholders: tuple[str, ...] = PLACEHOLDERS) -> DataFrame:
    return fact.filter(F.col(code).isNull() | ~F.col(code).rlike(pattern) | F.col(code).isin(*placeholders))


def interstate_same_state(fact: DataFrame) -> DataFrame:
    return fact.filter((F.left("cfop", F.lit(1)) == "6") & (F.col("uf_emit") == F.col("uf_dest")))


def price_outliers(rows: DataFrame, by: str = "ncm", price: str = "vl_unit", least: int = 30, low: float = 0.005, high: float = 0.995, pattern: str | None = VALID_NCM, least_rows: int = ranges.LEAST_ROWS) -> DataFrame:
    """Rows at the ends of their code's prices by percent rank (nulls last), with pct and n_ncm.

    Prices are ranked as distinct values, a code of many divided by price.  Codes fall into SLOTS slots; rows between a slot's ends are
    dropped where they are read, and only the others, a few in a hundred, meet the values at the ends."""
    valid = rows.filter(F.col(by).rlike(pattern)) if pattern else rows
    ranks = ranges.ranks_by_value(valid, by, price, least_rows).filter(F.col("__size") >= least)
    pct = F.when(F.col("__size") > 1, F.col("__rank") / (F.col("__size") - 1)).otherwise(F.lit(0.0))
    ends = ranks.select(F.col(by).alias(f"__{by}"), F.col(price).alias(f"__{price}"), F.col("__size").alias("n_ncm"), pct.alias("pct")).filter((F.col("pct") > high) | (F.col("pct") < low))
    slot = lambda code: F.pmod(F.hash(code), F.lit(SLOTS))
    cheap, dear = F.when(F.col("pct") < low, F.col(f"__{price}")), F.when(F.col("pct") > high, F.col(f"__{price}"))
    bounds = ends.groupBy(slot(F.col(f"__{by}")).alias("__slot")).agg(F.max(cheap).alias("__cheap"), F.min(dear).alias("__dear"))
    # SLOTS rows at most.  Missing prices come last in their code and are left to the join with the ends.
    outer = F.col(price).isNull() | (F.col(price) <= F.col("__cheap")) | (F.col(price) >= F.col("__dear"))
    near = valid.join(F.broadcast(bounds), slot(F.col(by)) == F.col("__slot")).filter(outer).drop("__slot", "__cheap", "__dear")
    return near.join(ends, ranges.same((by, price))).drop(f"__{by}", f"__{price}")


def revenue_drops(headers: DataFrame, emitter: str = "cnpj_emit", month: str = "competencia", value: str = "valor_total", status: tuple[str, str] = ("status", "AUTORIZADA"), ratio: float = 0.4) -> DataFrame:
    """Months whose revenue fell below ratio of the emitter's previous month with any; the window holds a row a month, however many documents an emitter has."""
    monthly = headers.filter(F.col(status[0]) == status[1]).groupBy(emitter, month).agg(money_sum(value).alias("faturamento"))
    before = F.lag("faturamento").over(W.partitionBy(emitter).orderBy(month))
    share = F.try_divide("faturamento", "anterior")
    rows = monthly.withColumn("anterior", before).filter((F.col("anterior") > 0) & (share < ratio))
    return rows.withColumn("variacao", F.floor((share - 1) * 10000 + 0.5) / 10000)


def divergent_totals(headers: DataFrame, items: DataFrame, key: str = "chave_acesso", emitter: str = "cnpj_emit", total: str = "valor_total", value: str = "vl_produto", tolerance: float = 0.05) -> DataFrame:
    """Headers whose total differs from the sum of their items, which is taken before the join."""
    sums = items.groupBy(key).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("soma"))
    off = F.abs(F.col(total).cast("decimal(18,2)") - F.col("soma"))
    rows = headers.select(key, emitter, total).join(sums, key).withColumn("diferenca", off.cast("double")).filter(F.col("diferenca") > tolerance)
    return rows.select(key, emitter, total, F.col("soma").cast("double").alias("soma_itens"), "diferenca")


def inactive_emitters(headers: DataFrame, emitter: str = "cnpj_emit", day: str = "dt_emissao", days: int = 45) -> DataFrame:
    last = headers.groupBy(emitter).agg(F.max(day).alias("ultima_nf"))
    # One row: the latest day of all.
    latest = headers.agg(F.max(day).alias("referencia"))
    return last.crossJoin(F.broadcast(latest)).withColumn("dias_sem_emitir", F.datediff("referencia", "ultima_nf").cast("long")).filter(F.col("dias_sem_emitir") > days)


# Name and severity of each consolidated view, the view, and its value.
CONSOLIDATED = (
    ("GAP_NUMERACAO", "MEDIA", "v_gap_numeracao", "0"),
    ("DUP_CHAVE", "CRITICA", "v_duplicidade_chave", "0"),
    ("DUP_NUMERACAO", "CRITICA", "v_duplicidade_numeracao", "0"),
    ("DUP_ECONOMICA", "MEDIA", "v_duplicidade_economica", "valor_total"),
    ("NCM_INVALIDO", "ALTA", "v_ncm_invalido", "vl_produto"),
    ("CFOP_UF", "ALTA", "v_cfop_uf_incoerente", "vl_produto"),
    ("PRECO_OUTLIER", "BAIXA", "v_preco_outlier", "vl_produto"),
    ("TOTAL_DIVERGENTE", "ALTA", "v_total_divergente", "diferenca"),
)


def consolidated(raw: DataFrame, headers: DataFrame, items: DataFrame, fact: DataFrame) -> DataFrame:
    """regra, severidade, chave_acesso, cnpj_emit, vl_base of the eight consolidated views."""
    made = (numbering_gaps(headers), duplicate_keys(raw), duplicate_numbers(headers), economic_duplicates(headers), invalid_ncm(fact), interstate_same_state(fact), price_outliers(fact), divergent_totals(headers, items))
    parts = [rows.select(F.lit(name).alias("regra"), F.lit(severity).alias("severidade"), "chave_acesso", "cnpj_emit", F.expr(value).cast("double").alias("vl_base")) for (name, severity, _, value), rows in zip(CONSOLIDATED, made, strict=True)]
    return reduce(DataFrame.unionByName, parts)
