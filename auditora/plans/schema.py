"""Explicit schemas of the layers, and severity weights."""

from __future__ import annotations

# Names, order and types of the columns of each layer.
HEADER_COLUMNS = ("chave_acesso", "numero", "serie", "modelo", "dh_emissao", "tipo_nf", "cnpj_emit", "uf_emit", "cnpj_dest", "uf_dest", "crt", "valor_total", "status")
ITEM_COLUMNS = ("chave_acesso", "n_item", "c_prod", "descricao", "ncm", "cfop", "qtd", "vl_unit", "vl_produto", "vl_icms", "cst_icms", "csosn")
FACT_FROM_HEADER = ("cnpj_emit", "uf_emit", "uf_dest", "tipo_nf", "status", "is_simples", "dt_emissao", "competencia", "serie", "numero", "valor_total")
FACT_COLUMNS = (*ITEM_COLUMNS, *FACT_FROM_HEADER, "grupo_cfop", "cod_tributacao")

# Columns of the archive, of findings, of stage metrics and of the fact.
BRONZE = "sha256 string, nome string, conteudo string, tamanho long, dh_ingestao timestamp_ntz"
FINDINGS = "id_regra string, nome_regra string, severidade string, categoria string, chave_acesso string, n_item long, cnpj_emit string, vl_base double, impacto_rs double"
METRICS = "execucao_id string, etapa string, duracao_s double, status string, erro string, dh timestamp_ntz"
FACT = (
    "chave_acesso string, n_item long, c_prod string, descricao string, ncm string, cfop string, qtd double, vl_unit double, vl_produto double, vl_icms double, "
    "cst_icms string, csosn string, cnpj_emit string, uf_emit string, uf_dest string, tipo_nf string, status string, is_simples boolean, dt_emissao date, "
    "competencia date, serie long, numero long, valor_total double, grupo_cfop string, cod_tributacao string"
)

# Weight of each severity, and the rest.
SEVERITY_WEIGHTS = {"CRITICA": 1.0, "ALTA": 0.7, "MEDIA": 0.4, "BAIXA": 0.1}
OTHER_WEIGHT = 0.1


def names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]
