"""Electronic invoices: XML text to headers, items and quarantine.

A scan that resolves namespaces cuts out the first infNFe of the invoice
namespace, whatever stands around it, and Spark parses that part once; every
leaf is text and cast afterwards.  A bad item stays as it is; a bad header,
malformed or empty XML, or no infNFe in the invoice namespace puts the file in
quarantine.
"""

from __future__ import annotations

from xml.parsers import expat
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import written

NAMESPACE = "http://www.portalfiscal.inf.br/nfe"
_INF = (
    "struct<_Id:string, ide:struct<nNF:string,serie:string,mod:string,dhEmi:string,dEmi:string,tpNF:string>, "
    "emit:struct<CNPJ:string,CPF:string,enderEmit:struct<UF:string>,CRT:string>, dest:struct<CNPJ:string,CPF:string,enderDest:struct<UF:string>>, "
    "det:array<struct<_nItem:string,prod:struct<cProd:string,xProd:string,NCM:string,CFOP:string,qCom:string,vUnCom:string,vProd:string>,"
    "imposto:struct<ICMS:map<string,struct<CST:string,CSOSN:string,vICMS:string>>>>>, total:struct<ICMSTot:struct<vNF:string>>>"
)
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "ignoreNamespace": "true", "attributePrefix": "_"}


SLICE = 256
_NAME = f"{NAMESPACE} infNFe"
EMPTY, MALFORMED, ABSENT = "ParseError: arquivo vazio", "ParseError: XML malformado", "ParseError: infNFe ausente"


def first_note(data: bytes, encoding: str | None = None) -> tuple[str | None, str | None]:
    """The first infNFe of the invoice namespace at any depth, inside an element that declares the prefixes it may use; or what is wrong.

    encoding stands above the one that the text names."""
    if not data.strip():
        return None, EMPTY
    parser = expat.ParserCreate(encoding, " ")
    parser.buffer_text = True
    scope: dict[str | None, list[str | None]] = {}
    own: list[str | None] = []
    found: dict[str, int] = {}
    around: dict[str | None, str | None] = {}
    declared = ["utf-8"]

    def xml_decl(version: str, named: str | None, standalone: int) -> None:
        declared[0] = named or "utf-8"

    def opened(prefix: str | None, uri: str | None) -> None:
        scope.setdefault(prefix, []).append(uri)
        own.append(prefix)

    def closed(prefix: str | None) -> None:
        scope[prefix].pop()

    def start(name: str, _: dict[str, str]) -> None:
        if name == _NAME and "start" not in found:
            found["start"] = parser.CurrentByteIndex
            # Its own declarations stand in its tag.
            around.update({p: uris[-1 - own.count(p)] for p, uris in scope.items() if len(uris) > own.count(p)})
            parser.EndElementHandler = end
            parser.StartElementHandler = None
        own.clear()

    def end(name: str) -> None:
        # Elements of that name do not nest.
        if name == _NAME:
            found["end"] = parser.CurrentByteIndex
            parser.EndElementHandler = parser.StartNamespaceDeclHandler = parser.EndNamespaceDeclHandler = None

    parser.XmlDeclHandler, parser.StartElementHandler = xml_decl, start
    parser.StartNamespaceDeclHandler, parser.EndNamespaceDeclHandler = opened, closed
    try:
        parser.Parse(data, True)
    except (expat.ExpatError, LookupError):
        return None, MALFORMED
    finally:
        # Handlers hold the parser that holds them; its buffers go at once.
        parser.XmlDeclHandler = parser.StartElementHandler = parser.EndElementHandler = parser.StartNamespaceDeclHandler = parser.EndNamespaceDeclHandler = None
    if "start" not in found:
        return None, ABSENT
    names = "".join(f" xmlns{':' + p if p else ''}={quoteattr(uri)}" for p, uri in around.items() if uri)
    # An element without content ends where it starts.
    stop = data.index(b">", found["end"]) + 1 if found["end"] > found["start"] else None
    try:
        inside = data[found["start"] : stop].decode(encoding or declared[0]) if stop else "<infNFe/>"
    except (UnicodeDecodeError, LookupError):
        return None, MALFORMED
    return f"<nota{names}>{inside}</nota>", None


@F.arrow_udf(T.StructType([T.StructField("nota", T.StringType()), T.StructField("erro", T.StringType())]))
def _note(column: pa.Array) -> pa.Array:
    """Notes of a batch, SLICE rows at a time: what Python holds beside the batch does not grow with it."""
    encoding = None if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "utf-8"
    parts = []
    for at in range(0, max(len(column), 1), SLICE):
        rows = [first_note((v.encode("utf-8") if encoding else v) if v is not None else b"", encoding) for v in column.slice(at, SLICE).to_pylist()]
        parts.append(pa.StructArray.from_arrays([pa.array([note for note, _ in rows], pa.string()), pa.array([error for _, error in rows], pa.string())], ["nota", "erro"]))
    return pa.concat_arrays(parts)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, nome, tamanho, content of every .xml below folder; Spark raises if the folder is missing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("nome"), F.col("length").alias("tamanho"), "content")


def _text(column: str, default: str | None = None) -> Column:
    value = F.nullif(F.trim(F.col(column)), F.lit(""))
    return F.coalesce(value, F.lit(default)) if default is not None else value


def _number(column: str) -> Column:
    return F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))


def parse(files: DataFrame, content: str = "content", least_number: int = 1) -> DataFrame:
    """files with inf (the parsed note) and erro (null if the file is readable and its header valid; a note's number is least_number or more)."""
    rows = files.withColumn("__n", _note(F.col(content)))
    # An explode of one element is not merged with what reads it: otherwise every field would parse the file again.
    rows = rows.select("*", F.explode(F.array(F.from_xml("__n.nota", f"infNFe {_INF}, _bad string", _OPTIONS))).alias("__r")).withColumn("inf", F.col("__r.infNFe"))
    rows = rows.withColumn("__h", header_struct())
    h = lambda c: F.col(f"__h.{c}")
    bad = F.concat_ws(
        ", ",
        F.when(~F.coalesce(h("chave_acesso"), F.lit("")).rlike(r"^[0-9]{44}\z"), "chave_acesso"),
        F.when(F.coalesce(h("numero"), F.lit(least_number - 1)) < least_number, "numero"),
        F.when(F.coalesce(h("serie"), F.lit(-1)) < 0, "serie"),
        F.when(~h("modelo").isin("55", "65", "57"), "modelo"),
        F.when(h("dh_emissao").try_cast("timestamp_ntz").isNull(), "dh_emissao"),
        F.when(~h("tipo_nf").isin("0", "1"), "tipo_nf"),
        F.when(h("cnpj_emit").isNull(), "cnpj_emit"),
        F.when(F.length(F.coalesce(h("uf_emit"), F.lit(""))) != 2, "uf_emit"),
        F.when(~F.coalesce(h("crt"), F.lit("1")).isin("1", "2", "3", "4"), "crt"),
        F.when(h("valor_total") < 0, "valor_total"),
        # An item number that is no integer leaves the item without a key.
        F.when(F.exists(F.coalesce("inf.det", F.array()), lambda d: d["_nItem"].try_cast("long").isNull()), "n_item"),
    )
    error = (
        F.when(F.col("__n.erro").isNotNull(), F.col("__n.erro"))
        .when(F.col("__r._bad").isNotNull(), MALFORMED)
        .when(F.col("inf").isNull(), ABSENT)
        .when(bad != "", F.concat(F.lit("ParseError: cabecalho invalido: "), bad))
    )
    return rows.withColumn("erro", error).drop("__n", "__r")


def header_struct() -> Column:
    """The header fields of inf, as they stand."""
    fields = {
        "chave_acesso": F.regexp_replace("inf._Id", "^NFe", ""),
        "numero": F.coalesce(_text("inf.ide.nNF"), F.lit("0")).try_cast("long"),
        "serie": F.coalesce(_text("inf.ide.serie"), F.lit("0")).try_cast("long"),
        "modelo": _text("inf.ide.mod", "55"),
        "dh_emissao": F.coalesce(_text("inf.ide.dhEmi"), _text("inf.ide.dEmi")),
        "tipo_nf": _text("inf.ide.tpNF", "1"),
        # The emitter's own CPF stands in for its CNPJ.
        "cnpj_emit": F.coalesce(_text("inf.emit.CNPJ"), _text("inf.emit.CPF")),
        "uf_emit": _text("inf.emit.enderEmit.UF"),
        "cnpj_dest": F.coalesce(_text("inf.dest.CNPJ"), _text("inf.dest.CPF")),
        "uf_dest": _text("inf.dest.enderDest.UF"),
        "crt": _text("inf.emit.CRT"),
        "valor_total": _number("inf.total.ICMSTot.vNF"),
        "status": F.lit("AUTORIZADA"),
    }
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def headers(parsed: DataFrame) -> DataFrame:
    return parsed.filter("erro IS NULL").select("__h.*")


def items(parsed: DataFrame) -> DataFrame:
    """Items of readable notes, with valido: whether the item's own fields hold."""
    rows = parsed.filter("erro IS NULL").select("__h.chave_acesso", F.explode("inf.det").alias("d"))
    tax = F.col("d.imposto.ICMS")
    first = F.when(F.size(tax) > 0, F.element_at(F.map_values(tax), 1))
    rows = rows.withColumn("t", first)
    out = rows.select("chave_acesso", F.col("d._nItem").try_cast("long").alias("n_item"), _text("d.prod.cProd", "").alias("c_prod"), _text("d.prod.xProd", "").alias("descricao"), _text("d.prod.NCM", "").alias("ncm"), _text("d.prod.CFOP", "").alias("cfop"), _number("d.prod.qCom").alias("qtd"), _number("d.prod.vUnCom").alias("vl_unit"), _number("d.prod.vProd").alias("vl_produto"), _number("t.vICMS").alias("vl_icms"), _text("t.CST").alias("cst_icms"), _text("t.CSOSN").alias("csosn"))
    positive = [F.col(c) >= 0 for c in ("qtd", "vl_unit", "vl_produto", "vl_icms")] + [~F.isnan(c) for c in ("qtd", "vl_unit", "vl_produto", "vl_icms")]
    valid = F.col("ncm").rlike(r"^[0-9]{8}\z") & F.col("cfop").rlike(r"^[1-7][0-9]{3}\z") & (F.col("n_item") >= 1)
    for check in positive:
        valid &= check
    return out.withColumn("valido", valid)


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter("erro IS NOT NULL").select(F.col("nome").alias("arquivo"), "erro")


def process_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, items, failures) of a folder, parsed in one scan whose result is written in the shared folder; an empty folder is an error."""
    files = read_files(spark, folder)
    if files.isEmpty():
        raise FileNotFoundError(f"nenhum XML em {folder}")
    parsed = written(parse(files).drop("content"), "notes")
    return headers(parsed), items(parsed).drop("valido"), quarantine(parsed)
