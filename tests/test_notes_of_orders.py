"""Orders as notes: those numbered 0 are notes as any other, and what is not readable is cut short."""

import gc
from datetime import datetime

import pyarrow as pa
import pytest

from auditora import scratch
from auditora.operators import layers
from auditora.queries import Q
from auditora.sources import nfe


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("orders"))
    orders = [(k, 5 + k % 2, "FOP"[k % 3], 100.5 + k, datetime(2001, 2, 3, 4, 5, 6), "1-URGENT") for k in range(7)]
    lines = [(k, 50 * (k % 2) + n, 9, n, 2.0, 10.25, "R", "FO"[n % 2]) for k in range(6) for n in (1, 2, 6)] + [(3, 0, 9, 7, 1.0, 2.5, None, "F")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string").write.parquet(f"{at}/lineitem.parquet")
    return at


def test_the_note_of_number_0_is_read(spark, folder):
    heads = {h.numero: h for h in Q["nfe_headers"](spark, folder).collect()}
    assert sorted(heads) == [0, 1, 3, 4, 6] and heads[0].chave_acesso == "0" * 44
    assert {r.arquivo for r in Q["nfe_quarantine"](spark, folder).collect()} == {"2.xml", "5.xml"}
    items = Q["nfe_items"](spark, folder).collect()
    assert len(items) == 3 * 4 + 1 and len([i for i in items if i.chave_acesso == "0" * 44]) == 3


def test_a_number_below_1_is_refused_elsewhere(spark):
    text = f'<infNFe xmlns="{nfe.NAMESPACE}" Id="NFe{"1" * 44}"><ide><nNF>0</nNF><dhEmi>2026-03-01T10:00:00</dhEmi></ide><emit><CNPJ>1</CNPJ><enderEmit><UF>SC</UF></enderEmit></emit></infNFe>'
    rows = spark.createDataFrame([("a", text)], "nome string, content string")
    assert "numero" in nfe.quarantine(nfe.parse(rows)).first().erro
    assert nfe.headers(nfe.parse(rows, least_number=0)).first().numero == 0


def test_texts_of_notes_are_not_shuffled(spark, folder):
    plan = Q["bronze_index"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and plan.index("<infNFe") < plan.index("Exchange")
    # Items travel as numbers and become text behind their exchange.
    assert plan.rindex("<prod>") < plan.rindex("Exchange")


def test_a_view_of_the_fact_writes_the_notes_only(spark, folder):
    before = len(scratch._kept)
    found = Q["invalid_ncm"](spark, folder).collect()
    assert len(scratch._kept) == before + 1
    assert [(r.chave_acesso, r.n_item, r.ncm) for r in found] == [("3".rjust(44, "0"), 7, "00000000")]


def test_the_scan_of_notes_is_sliced():
    many = pa.array([b"", b"<a/>"] * (nfe.SLICE + 3))
    assert nfe._note.func(many).field("erro").to_pylist() == [nfe.EMPTY, nfe.ABSENT] * (nfe.SLICE + 3)
    assert nfe._note.func(pa.array([], pa.binary())).to_pylist() == []
    gc.collect()
    gc.disable()
    try:
        before = len(gc.get_objects())
        for _ in range(200):
            nfe.first_note(b"<a/>")
        assert len(gc.get_objects()) - before < 200
    finally:
        gc.enable()


def test_items_of_one_price_are_chosen_by_product_and_description(spark):
    names = ["chave_acesso", "n_item", "vl_produto", "c_prod", "descricao"]
    rows = [(f"{k:044d}", 1, 5.0, c, d) for k in range(20) for c, d in (("b", "x"), ("a", "z"), ("a", "y"))] + [("9" * 44, 1, 5.0, "a", "x"), ("9" * 44, 1, 6.0, "c", "x")]
    best = layers.silver_item(spark.createDataFrame(rows, names)).collect()
    assert {(r.c_prod, r.descricao) for r in best if r.chave_acesso != "9" * 44} == {("a", "y")} and len(best) == 21
    assert [r.c_prod for r in best if r.chave_acesso == "9" * 44] == ["c"]
