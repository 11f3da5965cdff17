"""Generic rule bank: runs for every label, only on fields the label bank left null.

Its triggers look at the field name *and* the description. Fixed values: every
regex and keyword below must equal the reference's.
"""

from __future__ import annotations

from pyspark.sql import Column

from docsift.operators.rules.bank import Alt, Extractor, FieldView, Rule, RuleBank, whole_word

# --- fixed values -----------------------------------------------------------
CPF_FORMATTED = r"\b(\d{3}\.\d{3}\.\d{3}-\d{2})\b"
CPF_DIGITS = r"\b(\d{11})\b"
CPF_MASK = "XXX.XXX.XXX-X"
PHONE_WORD = r"TELEFONE"
PHONE_AREA = r"\(\d{2}\)\s*\d{4,5}-\d{4}"
PHONE_SPACED = r"\b\d{2}\s+\d{4,5}-\d{4}\b"
PHONE_DIGITS = r"\b\d{10,11}\b"
DATE_LONG = r"\b(\d{2}/\d{2}/\d{4})\b"
DATE_SHORT = r"\b(\d{2}/\d{2}/\d{2})\b"
# ---------------------------------------------------------------------------

EXTRACTORS = {
    "gen_cpf": Extractor((Alt(CPF_FORMATTED, strip=True, java=whole_word(CPF_FORMATTED, r"\d")),
                          Alt(CPF_DIGITS, strip=True, java=whole_word(CPF_DIGITS, r"\d")))),
    # shared by the card bank and the generic bank: same gate, same alternatives
    "telefone": Extractor((Alt(PHONE_AREA, group=0, strip=True), Alt(PHONE_SPACED, group=0, strip=True, java=whole_word(PHONE_SPACED, r"\d")),
                           Alt(PHONE_DIGITS, group=0, strip=True, java=whole_word(PHONE_DIGITS, r"\d"))), gate=(PHONE_WORD, "i")),
    "gen_data": Extractor((Alt(DATE_LONG, strip=True, java=whole_word(DATE_LONG, r"\d")),
                           Alt(DATE_SHORT, strip=True, java=whole_word(DATE_SHORT, r"\d")))),
}


def _cpf_trigger(f: FieldView) -> Column:
    return f.upper.contains("CPF") | f.desc_upper.contains("CPF") | f.desc.contains(CPF_MASK)


def _phone_trigger(f: FieldView) -> Column:
    return f.upper.contains("TELEFONE") | f.desc_upper.contains("TELEFONE")


def _date_trigger(f: FieldView) -> Column:
    return f.upper.contains("DATA") | f.desc_upper.contains("DD/MM/YYYY") | f.desc_upper.contains("DATE")


BANK = RuleBank(
    family="generic",
    label_keyword=None,
    rules=(
        Rule("cpf", _cpf_trigger, "gen_cpf"),
        Rule("telefone", _phone_trigger, "telefone"),
        Rule("data", _date_trigger, "gen_data"),
    ),
)
