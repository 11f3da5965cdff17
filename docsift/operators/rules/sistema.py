"""Rule bank for system screens (labels containing ``sistema``).

Fixed values: every regex, keyword and the product exclusion list below must
equal the reference's. Patterns are in Python ``re`` notation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.operators.rules.bank import Alt, Extractor, Rule, RuleBank, both, name_has_all, name_has_any, whole_word

# --- fixed values -----------------------------------------------------------
CITY = r"Cidade:\s+([A-Za-zÀ-úç\s]+?)\s+U\.F"
SEARCH_BY = r"Pesquisar por:.*?Buscar\s+(CLIENTE|parente|prestador|outro)"
SEARCH_KIND = r"Tipo:.*?Buscar\s+\w+\s+(CPF|CNPJ|Nome|email)"
PRODUCT_LABELLED = r"Produto\s+([A-Z]+(?:\s+[A-Z]+)*?)(?:\s+[A-Z][a-z]|\s*$|\s+\d)"
UPPER_RUN = r"\b([A-Z]{2,}(?:\s+[A-Z]{2,})*)\b"
PRODUCT_EXCLUDED = ("CONSIGNADO", "VENCIDAS", "SISTEMA", "CLIENTE", "BUSCAR", "TODOS")
PRODUCT_MIN_LEN = 4
COUNT_LABELLED = r"Qtd\.?\s*Parcelas?\s+(\d+)"
COUNT_NEAR = r"(?:parcelas?|parcel\w*)[:\s]+(\d+)"
SELECTION_LABELLED = r"Seleção de parcelas:\s+([A-Za-zÀ-úç]+)"
SELECTION_NEAR = r"parcelas[:\s]+.*?(Vencidas|pago|pendente)"
SYSTEM_WITH_VALUE = r"Sistema\s+([A-Z]+)\s+VIr\.\s*Parc\."
SYSTEM_PLAIN = r"Sistema\s+([A-Z]+)"
OPERATION_LABELLED = r"Tipo\s+Operação:\s+([A-Za-zÀ-úç]+)"
OPERATION_WORD = (r"\b(Renegociação|Renegociacao|Empréstimo|Emprestimo|Refinanciamento|"
                  r"Consignação|Consignacao)\b")
SYSTEM_KIND_LABELLED = r"Tipo\s+Sistema:\s+([A-Za-zÀ-úç]+)"
SYSTEM_KIND_NEAR = r"Sistema[:\s]+.*?(Consignado|Consignacao|Crédito|Credito|Débito|Debito)"
TOTAL_LABELLED = r"Total:\s+(\d+(?:\.\d+)?,\d+)"
TOTAL_GENERAL = r"Total\s+Geral\s+(\d+(?:\.\d+)?,\d+)"
INSTALMENT_VALUE = r"VIr\.?\s*Parc\.\s+(\d+(?:\.\d+)?,\d+)"
# ---------------------------------------------------------------------------

# For Java (see Alt.java): words of a run are whole, so a run never gives back part of itself, and the
# labelled product is the shortest run after which its ending holds.
_PRODUCT_END = r"(?:\s+[A-Z][a-z]|\s*$|\s+\d)"
PRODUCT_JAVA = r"Produto\s++([A-Z]++(?:(?!%s)\s++[A-Z]++)*+)(?=%s)" % (_PRODUCT_END, _PRODUCT_END)
UPPER_RUN_JAVA = r"(?=[A-Z])(?<!\w)([A-Z]{2,}+(?!\w)(?:\s++[A-Z]{2,}+(?!\w))*+)"


def pick_product(runs: Column) -> Column:
    """First upper-case run that is not excluded and is long enough (no strip)."""
    excluded = F.array(*[F.lit(w) for w in PRODUCT_EXCLUDED])
    return F.get(F.filter(runs, lambda w: ~F.array_contains(excluded, w)
                          & (F.length(w) >= PRODUCT_MIN_LEN)), 0)


EXTRACTORS = {
    "sis_cidade": Extractor((Alt(CITY, "i", strip=True),)),
    "sis_pesquisa_por": Extractor((Alt(SEARCH_BY, "is"),)),
    "sis_pesquisa_tipo": Extractor((Alt(SEARCH_KIND, "is"),)),
    "sis_produto": Extractor((Alt(PRODUCT_LABELLED, strip=True, java=PRODUCT_JAVA),
                              Alt(UPPER_RUN, many=True, finish=pick_product, java=UPPER_RUN_JAVA))),
    "sis_quantidade_parcelas": Extractor((Alt(COUNT_LABELLED, "i"), Alt(COUNT_NEAR, "i"))),
    "sis_selecao_parcelas": Extractor((Alt(SELECTION_LABELLED, "i"), Alt(SELECTION_NEAR, "is"))),
    "sis_sistema": Extractor((Alt(SYSTEM_WITH_VALUE), Alt(SYSTEM_PLAIN))),
    "sis_tipo_operacao": Extractor((Alt(OPERATION_LABELLED, "i"), Alt(OPERATION_WORD, "i", java=whole_word(OPERATION_WORD)))),
    "sis_tipo_sistema": Extractor((Alt(SYSTEM_KIND_LABELLED, "i"), Alt(SYSTEM_KIND_NEAR, "is"))),
    "sis_total_parcelas": Extractor((Alt(TOTAL_LABELLED, "i"), Alt(TOTAL_GENERAL, "i"))),
    "sis_valor_parcela": Extractor((Alt(INSTALMENT_VALUE, "i"),)),
}

# Trigger cascade, in priority order (fixed keywords).
BANK = RuleBank(
    family="sistema",
    label_keyword="sistema",
    rules=(
        Rule("cidade", name_has_any("cidade"), "sis_cidade"),
        Rule("pesquisa_por", name_has_any("pesquisa_por"), "sis_pesquisa_por"),
        Rule("pesquisa_tipo", name_has_any("pesquisa_tipo"), "sis_pesquisa_tipo"),
        Rule("produto", name_has_any("produto"), "sis_produto"),
        Rule("quantidade_parcelas", name_has_all("quantidade", "parcela"), "sis_quantidade_parcelas"),
        Rule("selecao_parcelas", both(name_has_any("selecao", "seleção"), name_has_all("parcela")),
             "sis_selecao_parcelas"),
        Rule("sistema", name_has_all("sistema", without=("tipo",)), "sis_sistema"),
        Rule("tipo_operacao", name_has_all("tipo", "operacao"), "sis_tipo_operacao"),
        Rule("tipo_sistema", name_has_all("tipo", "sistema", without=("operacao",)), "sis_tipo_sistema"),
        Rule("total_parcelas", name_has_all("total", "parcela"), "sis_total_parcelas"),
        Rule("valor_parcela", name_has_all("valor", "parcela"), "sis_valor_parcela"),
    ),
)
