"""Rule bank for lawyer ID cards (labels containing ``oab``).

Fixed values: every regex, keyword and the state list below must equal the
reference's for identical results. Patterns are in Python ``re`` notation; the
dialect prefix is added by :func:`docsift.functions.regex.rx`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions.regex import rx, strip
from docsift.operators.rules.bank import Alt, Extractor, Rule, RuleBank, name_has_any, whole_word

# --- fixed values -----------------------------------------------------------
NAME = r"\b([A-ZÀ-Ú]+(?:[\s'][A-ZÀ-Ú]+)*)\b"
REGISTRATION = r"\b(\d{6})\b"
COUNCIL_CODE = r"CONSELHO SECCIONAL[\s\-]+([A-Z]{2})\b"
SECTION_WORD = r"Seccional"
STATE_CODE = r"\b(AC|AL|AP|AM|BA|CE|DF|ES|GO|MA|MT|MS|MG|PA|PB|PR|PE|PI|RJ|RN|RS|RO|RR|SC|SP|SE|TO)\b"
SUBSECTION_DASH = r"CONSELHO\s+SECCIONAL\s*[-–]\s*([A-ZÀ-Ú\s]+?)(?=\n)"
SUBSECTION_PLAIN = r"CONSELHO\s+SECCIONAL\s+([A-ZÀ-Ú\s]+?)(?=\n)"
CATEGORY = r"\b(ADVOGADO|ADVOGADA|SUPLEMENTAR|ESTAGIARIO|ESTAGIARIA)\b"
ADDRESS = r"ENDERE[CÇ]O\s+Profissional\s*\n([A-ZÀ-Ú0-9][^\n]+)\n([A-ZÀ-Ú][^\n]+)\n(\d+)"
STATUS = r"SITUA[CÇ](?:A[OÃ]|Ã[OÃ])\s+([A-ZÀ-Ú]+)"
# ---------------------------------------------------------------------------

# NAME for Java (see Alt.java). A match is the longest chain of upper-case words, cut at its last word
# boundary. A step leads from one such boundary to the next: over signs that are in the class but are no
# letters (U+00D7) up to a word character, or over a whole run of letters.
_LETTER, _SIGN = r"[A-ZÀ-ÖØ-Ú]", r"[\s']?+×"
NAME_JAVA = (r"(?=[A-ZÀ-Ú])\b((?=%s|×)(?:(?:%s)++(?=\w)|(?:%s)*+[\s']?+%s++\b)++)" % (_LETTER, _SIGN, _SIGN, _LETTER))


def address_lines(span: Column) -> Column:
    """The three address groups joined by newlines, read from the (short) matched span.

    One scan of the whole text finds the match; the groups are then re-read from
    the span instead of scanning the text three times.
    """
    parts = [F.regexp_extract(span, rx(ADDRESS, "i"), i) for i in (1, 2, 3)]
    return F.when(span.isNotNull(), strip(F.concat_ws("\n", *parts)))


EXTRACTORS = {
    "oab_nome": Extractor((Alt(NAME, strip=True, java=NAME_JAVA),)),
    "oab_inscricao": Extractor((Alt(REGISTRATION, strip=True, java=whole_word(REGISTRATION, r"\d")),)),
    # the bare state code is only searched when the word "Seccional" is present
    "oab_seccional": Extractor((Alt(COUNCIL_CODE, "i", strip=True),
                                Alt(STATE_CODE, gate=(SECTION_WORD, "i"), strip=True,
                                    java=whole_word(STATE_CODE, "[A-Z]")))),
    "oab_subsecao": Extractor((Alt(SUBSECTION_DASH, "i", strip=True), Alt(SUBSECTION_PLAIN, "i", strip=True))),
    "oab_categoria": Extractor((Alt(CATEGORY, "i", strip=True, java=whole_word(CATEGORY)),)),
    "oab_endereco": Extractor((Alt(ADDRESS, "i", group=0, finish=address_lines),)),
    "oab_situacao": Extractor((Alt(STATUS, "i", strip=True),)),
}

# Trigger cascade, in priority order (fixed keywords).
BANK = RuleBank(
    family="oab",
    label_keyword="oab",
    rules=(
        Rule("nome", name_has_any("nome"), "oab_nome"),
        Rule("inscricao", name_has_any("inscricao", "inscriçao", "inscriçâo", "oab"), "oab_inscricao"),
        Rule("seccional", name_has_any("seccional"), "oab_seccional"),
        Rule("subsecao", name_has_any("subsec", "subseç"), "oab_subsecao"),
        Rule("categoria", name_has_any("categoria"), "oab_categoria"),
        Rule("endereco", name_has_any("endereco", "endereço"), "oab_endereco"),
        Rule("telefone", name_has_any("telefone"), "telefone"),
        Rule("situacao", name_has_any("situacao", "situação"), "oab_situacao"),
    ),
)
