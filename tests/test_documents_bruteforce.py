"""Spark rule engine vs a brute-force Python ``re`` evaluation on the driver's documents.

The documents are prose in four languages with accents, odd whitespace and junk:
exactly where DuckDB's RE2 knows too little, so this query has no SQL twin.
Here every document's full text goes through the reference semantics written out
plainly with Python's ``re`` (one field at a time, first trigger wins, generic bank
for fields still null) and must match the Spark output field for field.
"""

import re

import pytest

from docsift import catalog
from docsift.sources import tables as T

from sf_paths import SF_MID

# The expected patterns, written out here so that a wrong one in the product shows.


class G:
    CPF_DIGITS = r"\b(\d{11})\b"
    CPF_FORMATTED = r"\b(\d{3}\.\d{3}\.\d{3}-\d{2})\b"
    CPF_MASK = r"XXX.XXX.XXX-X"
    DATE_LONG = r"\b(\d{2}/\d{2}/\d{4})\b"
    DATE_SHORT = r"\b(\d{2}/\d{2}/\d{2})\b"
    PHONE_AREA = r"\(\d{2}\)\s*\d{4,5}-\d{4}"
    PHONE_DIGITS = r"\b\d{10,11}\b"
    PHONE_SPACED = r"\b\d{2}\s+\d{4,5}-\d{4}\b"
    PHONE_WORD = r"TELEFONE"


class O:
    ADDRESS = r"ENDERE[CÇ]O\s+Profissional\s*\n([A-ZÀ-Ú0-9][^\n]+)\n([A-ZÀ-Ú][^\n]+)\n(\d+)"
    CATEGORY = r"\b(ADVOGADO|ADVOGADA|SUPLEMENTAR|ESTAGIARIO|ESTAGIARIA)\b"
    COUNCIL_CODE = r"CONSELHO SECCIONAL[\s\-]+([A-Z]{2})\b"
    NAME = r"\b([A-ZÀ-Ú]+(?:[\s'][A-ZÀ-Ú]+)*)\b"
    REGISTRATION = r"\b(\d{6})\b"
    SECTION_WORD = r"Seccional"
    STATE_CODE = r"\b(AC|AL|AP|AM|BA|CE|DF|ES|GO|MA|MT|MS|MG|PA|PB|PR|PE|PI|RJ|RN|RS|RO|RR|SC|SP|SE|TO)\b"
    STATUS = r"SITUA[CÇ](?:A[OÃ]|Ã[OÃ])\s+([A-ZÀ-Ú]+)"
    SUBSECTION_DASH = r"CONSELHO\s+SECCIONAL\s*[-–]\s*([A-ZÀ-Ú\s]+?)(?=\n)"
    SUBSECTION_PLAIN = r"CONSELHO\s+SECCIONAL\s+([A-ZÀ-Ú\s]+?)(?=\n)"


class S:
    CITY = r"Cidade:\s+([A-Za-zÀ-úç\s]+?)\s+U\.F"
    COUNT_LABELLED = r"Qtd\.?\s*Parcelas?\s+(\d+)"
    COUNT_NEAR = r"(?:parcelas?|parcel\w*)[:\s]+(\d+)"
    INSTALMENT_VALUE = r"VIr\.?\s*Parc\.\s+(\d+(?:\.\d+)?,\d+)"
    OPERATION_LABELLED = r"Tipo\s+Operação:\s+([A-Za-zÀ-úç]+)"
    OPERATION_WORD = r"\b(Renegociação|Renegociacao|Empréstimo|Emprestimo|Refinanciamento|Consignação|Consignacao)\b"
    PRODUCT_EXCLUDED = ('CONSIGNADO', 'VENCIDAS', 'SISTEMA', 'CLIENTE', 'BUSCAR', 'TODOS')
    PRODUCT_LABELLED = r"Produto\s+([A-Z]+(?:\s+[A-Z]+)*?)(?:\s+[A-Z][a-z]|\s*$|\s+\d)"
    PRODUCT_MIN_LEN = 4
    SEARCH_BY = r"Pesquisar por:.*?Buscar\s+(CLIENTE|parente|prestador|outro)"
    SEARCH_KIND = r"Tipo:.*?Buscar\s+\w+\s+(CPF|CNPJ|Nome|email)"
    SELECTION_LABELLED = r"Seleção de parcelas:\s+([A-Za-zÀ-úç]+)"
    SELECTION_NEAR = r"parcelas[:\s]+.*?(Vencidas|pago|pendente)"
    SYSTEM_KIND_LABELLED = r"Tipo\s+Sistema:\s+([A-Za-zÀ-úç]+)"
    SYSTEM_KIND_NEAR = r"Sistema[:\s]+.*?(Consignado|Consignacao|Crédito|Credito|Débito|Debito)"
    SYSTEM_PLAIN = r"Sistema\s+([A-Z]+)"
    SYSTEM_WITH_VALUE = r"Sistema\s+([A-Z]+)\s+VIr\.\s*Parc\."
    TOTAL_GENERAL = r"Total\s+Geral\s+(\d+(?:\.\d+)?,\d+)"
    TOTAL_LABELLED = r"Total:\s+(\d+(?:\.\d+)?,\d+)"
    UPPER_RUN = r"\b([A-Z]{2,}(?:\s+[A-Z]{2,})*)\b"


I, IS = re.IGNORECASE, re.IGNORECASE | re.DOTALL


def grp(p, text, flags=0):
    m = re.search(p, text, flags)
    return m.group(1) if m else None


def whole(p, text, flags=0):
    m = re.search(p, text, flags)
    return m.group(0) if m else None


def either(*vals):
    for v in vals:
        if v is not None:
            return v
    return None


def strip(v):
    return None if v is None else v.strip()


def phone(t):
    if not re.search(G.PHONE_WORD, t, I):
        return None
    return strip(either(whole(G.PHONE_AREA, t), whole(G.PHONE_SPACED, t), whole(G.PHONE_DIGITS, t)))


def address(t):
    m = re.search(O.ADDRESS, t, I)
    return "\n".join([m.group(1), m.group(2), m.group(3)]).strip() if m else None


def section(t):
    v = grp(O.COUNCIL_CODE, t, I)
    if v is None and re.search(O.SECTION_WORD, t, I):
        v = grp(O.STATE_CODE, t)
    return strip(v)


def product(t):
    v = grp(S.PRODUCT_LABELLED, t)
    if v is not None:
        return v.strip()
    for w in re.findall(S.UPPER_RUN, t):
        if w not in S.PRODUCT_EXCLUDED and len(w) >= S.PRODUCT_MIN_LEN:
            return w
    return None


def has(f, *words):
    return any(w in f for w in words)


def oab_value(f, t):
    f = f.lower()
    if has(f, "nome"):
        return strip(grp(O.NAME, t))
    if has(f, "inscricao", "inscriçao", "inscriçâo", "oab"):
        return strip(grp(O.REGISTRATION, t))
    if has(f, "seccional"):
        return section(t)
    if has(f, "subsec", "subseç"):
        return strip(either(grp(O.SUBSECTION_DASH, t, I), grp(O.SUBSECTION_PLAIN, t, I)))
    if has(f, "categoria"):
        return strip(grp(O.CATEGORY, t, I))
    if has(f, "endereco", "endereço"):
        return address(t)
    if has(f, "telefone"):
        return phone(t)
    if has(f, "situacao", "situação"):
        return strip(grp(O.STATUS, t, I))
    return None


def sistema_value(f, t):
    f = f.lower()
    if "cidade" in f:
        return strip(grp(S.CITY, t, I))
    if "pesquisa_por" in f:
        return grp(S.SEARCH_BY, t, IS)
    if "pesquisa_tipo" in f:
        return grp(S.SEARCH_KIND, t, IS)
    if "produto" in f:
        return product(t)
    if "quantidade" in f and "parcela" in f:
        return either(grp(S.COUNT_LABELLED, t, I), grp(S.COUNT_NEAR, t, I))
    if has(f, "selecao", "seleção") and "parcela" in f:
        return either(grp(S.SELECTION_LABELLED, t, I), grp(S.SELECTION_NEAR, t, IS))
    if "sistema" in f and "tipo" not in f:
        return either(grp(S.SYSTEM_WITH_VALUE, t), grp(S.SYSTEM_PLAIN, t))
    if "tipo" in f and "operacao" in f:
        return either(grp(S.OPERATION_LABELLED, t, I), grp(S.OPERATION_WORD, t, I))
    if "tipo" in f and "sistema" in f and "operacao" not in f:
        return either(grp(S.SYSTEM_KIND_LABELLED, t, I), grp(S.SYSTEM_KIND_NEAR, t, IS))
    if "total" in f and "parcela" in f:
        return either(grp(S.TOTAL_LABELLED, t, I), grp(S.TOTAL_GENERAL, t, I))
    if "valor" in f and "parcela" in f:
        return grp(S.INSTALMENT_VALUE, t, I)
    return None


def generic_value(f, d, t):
    if "CPF" in f.upper() or "CPF" in d.upper() or G.CPF_MASK in d:
        return strip(either(grp(G.CPF_FORMATTED, t), grp(G.CPF_DIGITS, t)))
    if "TELEFONE" in f.upper() or "TELEFONE" in d.upper():
        return phone(t)
    if "DATA" in f.upper() or "DD/MM/YYYY" in d.upper() or "DATE" in d.upper():
        return strip(either(grp(G.DATE_LONG, t), grp(G.DATE_SHORT, t)))
    return None


def brute_force(label, text, request):
    low = label.lower()
    bank = oab_value if "oab" in low else sistema_value if "sistema" in low else None
    out = {}
    for f, d in request.items():
        v = bank(f, text) if bank else None
        out[f] = v if v is not None else generic_value(f, d, text)
    return out


@pytest.fixture(scope="module")
def spark_rows(spark):
    return catalog.rules_documents(spark, SF_MID).collect()


def test_documents_match_bruteforce(spark, spark_rows):
    docs = T.documents_jobs(spark, SF_MID).collect()
    requests = {i: r for i, r in enumerate(T.CARD_REQUESTS + T.SCREEN_REQUESTS)}
    got = {}
    for r in spark_rows:
        got.setdefault(r["job_id"], {})[r["field"]] = r["value"]
    mismatches = []
    hits = 0
    for d in docs:
        req = requests[d["doc_id"] % len(requests)]
        want = brute_force(d["label"], d["text"], req)
        hits += sum(v is not None for v in want.values())
        if got.get(d["job_id"]) != want:
            mismatches.append((d["job_id"], want, got.get(d["job_id"])))
    assert not mismatches, mismatches[:3]
    assert len(docs) == 1000 and hits > 0
