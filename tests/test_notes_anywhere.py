"""The first infNFe of the invoice namespace counts, wherever it stands and however it is named."""

import pytest

from auditora.sources import nfe

INSIDE = '<{p}infNFe Id="NFe{key}"><{p}ide><{p}nNF>7</{p}nNF><{p}mod>55</{p}mod><{p}dhEmi>2026-03-01T10:00:00-03:00</{p}dhEmi></{p}ide><{p}emit><{p}CNPJ>11222333000181</{p}CNPJ><{p}enderEmit><{p}UF>SC</{p}UF></{p}enderEmit></{p}emit><{p}det nItem="1"><{p}prod><{p}xProd>café &amp; {uri}</{p}xProd></{p}prod></{p}det></{p}infNFe>'


def note(key, prefix=""):
    return INSIDE.format(p=prefix, key=str(key) * 44, uri=nfe.NAMESPACE)


NS = nfe.NAMESPACE
GOOD = {
    "root": f'<infNFe xmlns="{NS}"' + note(1)[len("<infNFe") :],
    "processed": f'<nfeProc xmlns="{NS}"><NFe>{note(1)}</NFe></nfeProc>',
    "batch": f'<?xml version="1.0" encoding="UTF-8"?>\n<!-- c --><enviNFe xmlns="{NS}"><idLote>1</idLote><NFe>{note(1)}</NFe><NFe>{note(2)}</NFe></enviNFe>',
    "prefixed": f'<n:enviNFe xmlns:n="{NS}" xmlns:d="urn:d"><d:x/><n:NFe>{note(1, "n:")}</n:NFe></n:enviNFe>',
    "deep": f'<a xmlns="urn:a"><b><c xmlns="{NS}"><NFe>{note(1)}</NFe></c></b></a>',
    "foreign first": f'<a><infNFe Id="NFe9"/><o:infNFe xmlns:o="urn:o"/><NFe xmlns="{NS}">{note(1)}</NFe></a>',
    "redeclared": f'<p:a xmlns:p="urn:o"><p:NFe xmlns:p="{NS}">{note(1, "p:")}</p:NFe></p:a>',
    "declaration with quotes": f"<a xmlns:q='urn:\"&lt;q'><NFe xmlns='{NS}'>{note(1)}</NFe></a>",
}
BAD = {
    "other namespace": (f'<NFe xmlns="urn:o">{note(1)}</NFe>', nfe.ABSENT),
    "no namespace": (f"<NFe>{note(1)}</NFe>", nfe.ABSENT),
    "undeclared by the inner default": (f'<NFe xmlns="{NS}"><x xmlns="">{note(1)}</x></NFe>', nfe.ABSENT),
    "cut short": (f'<NFe xmlns="{NS}">{note(1)}', nfe.MALFORMED),
    "text behind": (f'<NFe xmlns="{NS}">{note(1)}</NFe>x', nfe.MALFORMED),
    "undeclared prefix": (f"<NFe>{note(1, 'n:')}</NFe>", nfe.MALFORMED),
    "blank": (" \n\t", nfe.EMPTY),
    "empty element": (f'<NFe xmlns="{NS}"><infNFe/></NFe>', "cabecalho invalido"),
}


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_notes_are_found_at_any_depth(spark, kind):
    rows = [(name, text if kind == "string" else text.encode("utf-8")) for name, text in GOOD.items()]
    if kind == "binary":
        rows.append(("latin", f'<?xml version="1.0" encoding="ISO-8859-1"?><NFe xmlns="{NS}">{note(1)}</NFe>'.encode("latin-1")))
    parsed = nfe.parse(spark.createDataFrame(rows, f"nome string, content {kind}"))
    assert nfe.quarantine(parsed).collect() == []
    heads = nfe.headers(parsed).collect()
    assert len(heads) == len(rows) and {(h.chave_acesso, h.numero, h.uf_emit) for h in heads} == {("1" * 44, 7, "SC")}
    assert {i.descricao for i in nfe.items(parsed).collect()} == {f"café & {NS}"}


def test_what_is_no_note_is_quarantined(spark):
    rows = [(name, text) for name, (text, _) in BAD.items()] + [("null", None)]
    found = {r.arquivo: r.erro for r in nfe.quarantine(nfe.parse(spark.createDataFrame(rows, "nome string, content string"))).collect()}
    for name, (_, error) in BAD.items():
        assert error in found[name], name
    assert found["null"] == nfe.EMPTY
    assert nfe.first_note(f'<?xml version="1.0" encoding="nada"?><NFe xmlns="{NS}">{note(1)}</NFe>'.encode()) == (None, nfe.MALFORMED)
