"""Rule engine: one fused scan for all SQL rules, a branch for each handler, and the score."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import audit
from ..scratch import written
from .catalog import CatalogoRegras, Regra, validar_condicao
from .conditions import Builder, read
from .schema import FINDINGS, OTHER_WEIGHT, SEVERITY_WEIGHTS, names

Handler = Callable[[dict[str, DataFrame], Regra], DataFrame]
QUANTILES = 64
# Columns that a rule's findings share, and rules up to which they are told apart by number.
KIND, KINDS = ("id_regra", "nome_regra", "severidade", "categoria"), 1000


def round_half_up(value: Column, digits: int) -> Column:
    """Rounds as floor(x * 10^d + 1/2) / 10^d, the same in every engine."""
    return F.floor(value * 10.0**digits + 0.5) / 10.0**digits


def bounds_of(df: DataFrame, *columns: str) -> list[list[float]]:
    """Values that cut each column into QUANTILES ranges of about equal sizes, found in one pass; one that repeats is common."""
    points = [k / QUANTILES for k in range(1, QUANTILES)]
    row = df.agg(*[F.percentile_approx(c, points, 10000).alias(f"__{k}") for k, c in enumerate(columns)]).first()
    return [list(bounds or []) for bounds in row]


def rank_table(df: DataFrame, column: str, name: str, bounds: list[float], weight: Column | None = None) -> DataFrame:
    """__value and its global percent rank (nulls last) for every value of column, without sorting all in one task; a row stands for weight rows.

    Rows are counted by value; bounds cut the values into ranges, whose few totals are added up in
    order, and ranks within a range follow from a window over it."""
    cuts = sorted(set(bounds))
    counts = df.groupBy(column).agg((F.count("*") if weight is None else F.sum(weight)).alias("__n"))
    above = reduce(lambda t, c: t + (F.col(column) > F.lit(float(c))).cast("int"), cuts, F.lit(0))
    counts = counts.withColumn("__range", F.when(F.col(column).isNull(), F.lit(len(cuts) + 1)).otherwise(above))
    totals = counts.groupBy("__range").agg(F.sum("__n").alias("__total"))
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumns({"__before": F.coalesce(F.sum("__total").over(before), F.lit(0)), "__all": F.sum("__total").over(W.partitionBy(F.lit(0)))})
    inside = W.partitionBy("__range").orderBy(F.col(column).asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    rank = F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    share = F.when(F.col("__all") > 1, rank / (F.col("__all") - 1)).otherwise(F.lit(0.0))
    # Totals are QUANTILES + 1 rows at most.
    return counts.join(F.broadcast(totals), "__range").select(F.col(column).alias("__value"), share.alias(name))


def percent_ranks(df: DataFrame, column: str, name: str, bounds: list[float] | None = None) -> DataFrame:
    """df with the global percent rank of column (nulls last).  Rows are dealt out once, by ranges of bounds, and ranked inside theirs.

    Common values, fewer than QUANTILES, and null have a rank each, so their rows stay where they are."""
    bounds = bounds_of(df, column)[0] if bounds is None else bounds
    common = sorted({v for v, w in zip(bounds, bounds[1:], strict=False) if v == w})
    cuts = sorted(set(bounds))
    value = F.col(column)
    # Between cuts k - 1 and k lies range 2 k; a common value, which is a cut, has the next odd number for itself, null the last.
    place = reduce(lambda t, c: t + (value > F.lit(float(c))).cast("int"), cuts, F.lit(0)) * 2 + value.isin(common).cast("int")
    ranged = df.withColumn("__range", F.when(value.isNull(), F.lit(2 * len(cuts) + 1)).otherwise(place))
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("__range").agg(F.count("*").alias("__total"))
    totals = totals.withColumns({"__before": F.coalesce(F.sum("__total").over(before), F.lit(0)), "__all": F.sum("__total").over(W.partitionBy(F.lit(0)))}).drop("__total")
    held = value.isNull() | value.isin(common)
    few = ranged.filter(held).withColumn("__inside", F.lit(0))
    rest = ranged.filter(~held).withColumn("__inside", F.rank().over(W.partitionBy("__range").orderBy(column)) - 1)
    # Totals are 2 QUANTILES + 1 rows at most.
    ranked = few.unionByName(rest).join(F.broadcast(totals), "__range")
    share = F.when(F.col("__all") > 1, (F.col("__before") + F.col("__inside")) / (F.col("__all") - 1)).otherwise(F.lit(0.0))
    return ranked.withColumn(name, share).drop("__range", "__before", "__all", "__inside")


class RuleEngine:
    """tables: fact, silver_cabecalho, silver_cabecalho_raw, silver_item."""

    def __init__(self, catalog: CatalogoRegras, tables: dict[str, DataFrame], lint: bool = True) -> None:
        self.catalog, self.tables, self.lint = catalog, tables, lint
        self.handlers: dict[str, Handler] = {}

    def registrar(self, name: str) -> Callable[[Handler], Handler]:
        def keep(handler: Handler) -> Handler:
            self.handlers[name] = handler
            return handler

        return keep

    def _sql_findings(self, rules: list[Regra]) -> DataFrame:
        """All SQL rules over one scan of the fact: each row yields the place of every rule that holds, from which the other columns
        follow, so that those nobody reads are never made."""
        hits, build = [], Builder(self.tables["fact"].sparkSession)
        for k, rule in enumerate(rules):
            if self.lint and (problems := validar_condicao(rule.condicao)):
                raise ValueError(f"Regra {rule.id}: " + "; ".join(problems))
            hits.append(F.when(build.column(read(rule.condicao)), F.lit(k)))
        rows = self.tables["fact"].withColumn("__rule", F.explode(F.array(*hits))).filter(F.col("__rule").isNotNull())
        value = F.lit(0.0)
        for column in sorted({r.campo_valor for r in rules if r.campo_valor}):
            value = F.when(F.col("__rule").isin([k for k, r in enumerate(rules) if r.campo_valor == column]), F.col(column).cast("double")).otherwise(value)
        of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("__rule") + 1)
        own = [of([getattr(r, field) for r in rules]) for field in ("id", "nome", "severidade", "categoria")]
        fields = [*own, F.col("chave_acesso"), F.col("n_item").cast("long"), F.col("cnpj_emit"), value, value * of([float(r.aliquota_risco) for r in rules])]
        return rows.select(*[f.alias(n) for f, n in zip(fields, names(FINDINGS), strict=True)])

    def executar(self, competencia: date | None = None) -> DataFrame:
        """Findings of the rules in force on the day (today by default); empty and typed if there are none."""
        rules = self.catalog.vigentes(competencia or date.today())
        parts = [self._sql_findings(sql)] if (sql := [r for r in rules if r.tipo == "sql"]) else []
        for rule in rules:
            if rule.tipo == "python":
                if rule.condicao not in self.handlers:
                    raise KeyError(f"Regra {rule.id}: handler '{rule.condicao}' nao registrado")
                parts.append(finding(self.handlers[rule.condicao](self.tables, rule), rule))
        if not parts:
            return SparkSession.getActiveSession().createDataFrame([], FINDINGS)
        return reduce(DataFrame.unionByName, parts)


def finding(rows: DataFrame, rule: Regra) -> DataFrame:
    """Rows of a handler in the canonical columns; what it lacks is null, and values it lacks are 0."""
    have = set(rows.columns)
    kinds = dict(f.split() for f in FINDINGS.split(", "))
    own = {"id_regra": F.lit(rule.id), "nome_regra": F.lit(rule.nome), "severidade": F.lit(rule.severidade), "categoria": F.lit(rule.categoria)}
    missing = {"vl_base": F.lit(0.0), "impacto_rs": F.lit(0.0)}
    return rows.select(*[own.get(n, F.col(n) if n in have else missing.get(n, F.lit(None))).cast(kind).alias(n) for n, kind in kinds.items()])


def registrar_handlers_padrao(engine: RuleEngine) -> RuleEngine:
    @engine.registrar("duplicidade_chave")
    def _(tables: dict[str, DataFrame], rule: Regra) -> DataFrame:
        return audit.duplicate_keys(tables["silver_cabecalho_raw"])

    @engine.registrar("gap_numeracao")
    def _(tables: dict[str, DataFrame], rule: Regra) -> DataFrame:
        return audit.numbering_gaps(tables["silver_cabecalho"], model=None).select("chave_acesso", "cnpj_emit")

    @engine.registrar("sem_emissao")
    def _(tables: dict[str, DataFrame], rule: Regra) -> DataFrame:
        return audit.inactive_emitters(tables["silver_cabecalho"], days=rule.parametros.get("dias", 45)).select("cnpj_emit")

    @engine.registrar("preco_outlier")
    def _(tables: dict[str, DataFrame], rule: Regra) -> DataFrame:
        rows = audit.price_outliers(tables["fact"], least=rule.parametros.get("min_amostra", 30), pattern=rule.parametros.get("padrao", audit.VALID_NCM))
        return rows.select("chave_acesso", "n_item", "cnpj_emit", F.col("vl_produto").alias("vl_base"), (F.col("vl_produto") * F.lit(rule.aliquota_risco)).alias("impacto_rs"))

    @engine.registrar("total_divergente")
    def _(tables: dict[str, DataFrame], rule: Regra) -> DataFrame:
        rows = audit.divergent_totals(tables["silver_cabecalho"], tables["silver_item"], tolerance=rule.parametros.get("tolerancia", 0.05))
        return rows.select("chave_acesso", "cnpj_emit", F.col("diferenca").alias("vl_base"), (F.col("diferenca") * F.lit(rule.aliquota_risco)).alias("impacto_rs"))

    return engine


def _by_kind(findings: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """findings with the number __kind in place of KIND, and the table of at most KINDS rows that says what each number stands for.

    With more kinds than that, findings as they are and no table."""
    spark = findings.sparkSession
    kinds = findings.select(*KIND).distinct().limit(KINDS + 1).collect()
    if len(kinds) > KINDS:
        return findings, None
    ddl = ", ".join(f"{c} {kind}" for c, kind in findings.dtypes if c in KIND)
    table = spark.createDataFrame([(*[r[c] for c in findings.columns if c in KIND], k) for k, r in enumerate(kinds)], f"{ddl}, __kind int")
    same = reduce(lambda t, c: t & findings[c].eqNullSafe(table[c]), KIND, F.lit(True))
    # KINDS rows at most.
    return findings.join(F.broadcast(table), same).select(*[findings[c] for c in findings.columns if c not in KIND], table["__kind"]), table


def scored(findings: DataFrame) -> DataFrame:
    """Findings with severity weight, recurrence of the emitter and score by impact, severity and recurrence.

    Findings and the emitters' counts are written in the shared folder, as several steps read them; scratch.release() deletes them.
    Ranks by recurrence follow from those counts, so findings meet them once, and are dealt out once more by impact; what a rule says of
    all of its findings stays behind, and its number travels."""
    findings = written(findings, "findings", keep=True)
    weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in SEVERITY_WEIGHTS.items() for x in pair]), F.col("severidade")), F.lit(OTHER_WEIGHT))
    often = written(findings.groupBy("cnpj_emit").agg(F.count("*").alias("recorrencia")), "recurrence", keep=True)
    times = rank_table(often, "recorrencia", "__pr", bounds_of(often, "recorrencia")[0], F.col("recorrencia"))
    often = often.join(times, F.col("recorrencia") == F.col("__value")).select(F.col("cnpj_emit").alias("__emit"), "recorrencia", "__pr")
    rows, table = _by_kind(findings)
    base = percent_ranks(rows, "impacto_rs", "__pi").join(often, F.col("cnpj_emit").eqNullSafe(F.col("__emit")))
    base = base if table is None else base.join(F.broadcast(table), "__kind")
    base = base.withColumn("peso_sev", F.coalesce(weight, F.lit(OTHER_WEIGHT)))
    score = round_half_up(0.5 * F.col("__pi") + 0.3 * F.col("peso_sev") + 0.2 * F.col("__pr"), 4)
    return base.withColumn("score", score).select(*findings.columns, "recorrencia", "peso_sev", "score")


def summary(findings: DataFrame) -> DataFrame:
    total = audit.money_sum("impacto_rs").alias("impacto_rs")
    return findings.groupBy("severidade", "categoria").agg(F.count("*").alias("qtd"), F.countDistinct("cnpj_emit").alias("clientes"), total).orderBy(F.desc_nulls_last("impacto_rs"), "severidade", "categoria")


def top_findings(scored_rows: DataFrame, n: int = 20, least: str = "BAIXA") -> DataFrame:
    """The n findings of highest score at a severity of least or more; an unknown level keeps all."""
    levels = list(SEVERITY_WEIGHTS)
    kept = levels[: levels.index(least) + 1] if least in levels else levels
    rows = scored_rows.filter(F.col("severidade").isin(*kept))
    return rows.orderBy(F.desc_nulls_last("score"), "id_regra", "chave_acesso", "n_item", "cnpj_emit").limit(n)
