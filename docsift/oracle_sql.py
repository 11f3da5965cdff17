"""DuckDB SQL twins of the registered queries (the correctness oracle).

Independent of the Spark code path: the fixture texts, the rule cascade, the
fallback answers and the statistics are written out again in plain SQL over the
driver's tables. Regexes run on RE2 here, so they are written in RE2 form
(lookahead consumed instead, since the first match is all that is read); the
fixtures keep non-ASCII letters away from ``\\b`` so both dialects agree.
"""

from __future__ import annotations

from docsift.operators.fallback import PROMPT_HEAD, PROMPT_MID, PROMPT_TAIL
from docsift.sources import tables as T


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _requests_values() -> str:
    rows = []
    for rid, req in enumerate(T.CARD_REQUESTS + T.SCREEN_REQUESTS):
        for ord_, (k, v) in enumerate(req.items()):
            rows.append(f"({rid}, {ord_}, {_q(k)}, {_q(v)})")
    return "req(request_id, ord, field, description) AS (VALUES " + ", ".join(rows) + ")"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _money(c: str) -> str:
    u = f"(({c}) // 100)"
    return (f"(CASE WHEN {u} >= 1000 THEN CAST({u} // 1000 AS VARCHAR) || '.' || "
            f"lpad(CAST({u} % 1000 AS VARCHAR), 3, '0') ELSE CAST({u} AS VARCHAR) END || ',' || "
            f"lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))")


CARDS = f"""
cards_base AS (
  SELECT c_custkey AS k, c_mktsegment AS seg,
         {_list(T.STATE_CODES)}[c_nationkey % 5 + 1] AS code,
         {_list(T.STATE_NAMES)}[c_nationkey % 5 + 1] AS state,
         lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded,
         lpad(CAST((c_custkey * 7919) % 100000000000 AS VARCHAR), 11, '0') AS cpfd,
         lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS tail4
  FROM customer),
cards AS (
  SELECT k * 2 AS job_id, k * 2 AS doc_id, 'carteira_oab' AS label,
         CASE WHEN k % 7 < 2 THEN 0 WHEN k % 7 < 4 THEN 1 WHEN k % 7 < 6 THEN 2 ELSE 3 END AS request_id,
         concat_ws(chr(10),
           'MARIA ' || translate(padded, '0123456789', 'ABCDEFGHIJ'),
           'Inscrição', 'Seccional', 'Subseção', padded, code,
           'CPF ' || CASE WHEN k % 2 = 0 THEN substr(cpfd, 1, 3) || '.' || substr(cpfd, 4, 3) || '.' ||
                          substr(cpfd, 7, 3) || '-' || substr(cpfd, 10, 2) ELSE cpfd END,
           CASE WHEN k % 8 = 3 THEN 'CONSELHO SECCIONAL - ' || code
                WHEN k % 4 <> 3 THEN 'CONSELHO SECCIONAL - ' || state END,
           CASE seg WHEN 'BUILDING' THEN 'ADVOGADO' WHEN 'HOUSEHOLD' THEN 'ADVOGADA'
                    WHEN 'MACHINERY' THEN 'SUPLEMENTAR' WHEN 'FURNITURE' THEN 'estagiario' END,
           'Endereço Profissional',
           'RUA DAS FLORES, ' || CAST(k % 997 AS VARCHAR),
           'CENTRO - ' || code,
           lpad(CAST(k * 7 AS VARCHAR), 8, '0'),
           'Telefone Profissional',
           CASE WHEN k % 5 = 0 THEN '(11) 9' || tail4 || '-4321' WHEN k % 5 = 1 THEN '11 3456-' || tail4 END,
           CASE WHEN k % 6 <> 5 THEN 'Situação ' || CASE WHEN k % 2 = 0 THEN 'REGULAR' ELSE 'Suspensa' END END
         ) AS text
  FROM cards_base)"""

SCREENS = f"""
screens_base AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus AS st, o_orderdate AS od,
         CAST(floor(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders),
screens AS (
  SELECT k * 2 + 1 AS job_id, k * 2 + 1 AS doc_id, 'tela_sistema' AS label,
         {len(T.CARD_REQUESTS)} + ck % 3 AS request_id,
         concat_ws(chr(10),
           'Pesquisar por: Buscar ' || {_list(T.SEARCH_BY)}[k % 4 + 1] || ' Tipo: x Buscar y ' ||
             {_list(T.SEARCH_KIND)}[k % 4 + 1],
           'Data Base: ' || strftime(od, '%d/%m/%Y'),
           'Qtd. Parcelas ' || CAST(1 + ck % 96 AS VARCHAR),
           CASE WHEN k % 3 <> 2 THEN 'Produto ' || {_list(T.PRODUCTS)}[k % 2 + 1] || ' Qtd' END,
           'Sistema CONSIGNADO VIr. Parc. ' || {_money('cents % 1000000')},
           'Cidade: ' || {_list(T.CITIES)}[k % 3 + 1] || ' U.F: GO',
           CASE st WHEN 'F' THEN 'Total: ' || {_money('cents')} WHEN 'O' THEN 'Total Geral ' || {_money('cents')} END,
           CASE WHEN k % 5 <> 4 THEN 'Tipo Operação: ' || {_list(T.OPERATIONS)}[k % 3 + 1] END,
           CASE WHEN k % 7 <> 6 THEN 'Tipo Sistema: ' || {_list(T.SYSTEM_KINDS)}[k % 2 + 1] END,
           CASE WHEN k % 4 <> 1 THEN 'Seleção de parcelas: ' || {_list(T.SELECTIONS)}[k % 3 + 1] END
         ) AS text
  FROM screens_base)"""

DOCS = "docs AS (SELECT * FROM cards UNION ALL SELECT * FROM screens)"

DOC_JOBS = f"""
doc_jobs AS (
  SELECT doc_id AS job_id, doc_id, text, lang,
         doc_id % {len(T.CARD_REQUESTS + T.SCREEN_REQUESTS)} AS request_id,
         CASE WHEN doc_id % {len(T.CARD_REQUESTS + T.SCREEN_REQUESTS)} < {len(T.CARD_REQUESTS)}
              THEN 'carteira_oab' ELSE 'tela_sistema' END AS label
  FROM documents)"""


def _nz(e: str) -> str:
    return f"NULLIF({e}, '')"


def _g(pattern: str, idx: int = 1) -> str:
    return _nz(f"regexp_extract(text, {_q(pattern)}, {idx})")


def _strip(e: str) -> str:
    return f"trim({e}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


_STATES = "AC|AL|AP|AM|BA|CE|DF|ES|GO|MA|MT|MS|MG|PA|PB|PR|PE|PI|RJ|RN|RS|RO|RR|SC|SP|SE|TO"
_ADDR = r"(?i)ENDERE[CÇ]O\s+Profissional\s*\n([A-ZÀ-Ú0-9][^\n]+)\n([A-ZÀ-Ú][^\n]+)\n(\d+)"

# extractor id -> SQL expression over column ``text`` (RE2 dialect)
EXTRACTOR_SQL: dict[str, str] = {
    "oab_nome": _strip(_g(r"\b([A-ZÀ-Ú]+(?:[\s'][A-ZÀ-Ú]+)*)\b")),
    "oab_inscricao": _strip(_g(r"\b(\d{6})\b")),
    "oab_seccional": _strip(f"coalesce({_g(r'(?i)CONSELHO SECCIONAL[\s\-]+([A-Z]{2})\b')}, "
                            f"CASE WHEN regexp_matches(text, '(?i)Seccional') THEN {_g(r'\b(' + _STATES + r')\b')} END)"),
    "oab_subsecao": _strip(f"coalesce({_g(r'(?i)CONSELHO\s+SECCIONAL\s*[-–]\s*([A-ZÀ-Ú\s]+?)\n')}, "
                           f"{_g(r'(?i)CONSELHO\s+SECCIONAL\s+([A-ZÀ-Ú\s]+?)\n')})"),
    "oab_categoria": _strip(_g(r"(?i)\b(ADVOGADO|ADVOGADA|SUPLEMENTAR|ESTAGIARIO|ESTAGIARIA)\b")),
    "oab_endereco": (f"CASE WHEN regexp_matches(text, {_q(_ADDR)}) THEN "
                     + _strip(f"regexp_extract(text, {_q(_ADDR)}, 1) || chr(10) || regexp_extract(text, {_q(_ADDR)}, 2)"
                              f" || chr(10) || regexp_extract(text, {_q(_ADDR)}, 3)") + " END"),
    "oab_situacao": _strip(_g(r"(?i)SITUA[CÇ](?:A[OÃ]|Ã[OÃ])\s+([A-ZÀ-Ú]+)")),
    "sis_cidade": _strip(_g(r"(?i)Cidade:\s+([A-Za-zÀ-úç\s]+?)\s+U\.F")),
    "sis_pesquisa_por": _g(r"(?is)Pesquisar por:.*?Buscar\s+(CLIENTE|parente|prestador|outro)"),
    "sis_pesquisa_tipo": _g(r"(?is)Tipo:.*?Buscar\s+\w+\s+(CPF|CNPJ|Nome|email)"),
    "sis_produto": (f"coalesce({_strip(_g(r'Produto\s+([A-Z]+(?:\s+[A-Z]+)*?)(?:\s+[A-Z][a-z]|\s*$|\s+\d)'))}, "
                    r"list_filter(regexp_extract_all(text, '\b([A-Z]{2,}(?:\s+[A-Z]{2,})*)\b', 1), "
                    "lambda w: w NOT IN ('CONSIGNADO', 'VENCIDAS', 'SISTEMA', 'CLIENTE', 'BUSCAR', 'TODOS') "
                    "AND length(w) >= 4)[1])"),
    "sis_quantidade_parcelas": f"coalesce({_g(r'(?i)Qtd\.?\s*Parcelas?\s+(\d+)')}, "
                               f"{_g(r'(?i)(?:parcelas?|parcel\w*)[:\s]+(\d+)')})",
    "sis_selecao_parcelas": f"coalesce({_g(r'(?i)Seleção de parcelas:\s+([A-Za-zÀ-úç]+)')}, "
                            f"{_g(r'(?is)parcelas[:\s]+.*?(Vencidas|pago|pendente)')})",
    "sis_sistema": f"coalesce({_g(r'Sistema\s+([A-Z]+)\s+VIr\.\s*Parc\.')}, {_g(r'Sistema\s+([A-Z]+)')})",
    "sis_tipo_operacao": f"coalesce({_g(r'(?i)Tipo\s+Operação:\s+([A-Za-zÀ-úç]+)')}, "
                         f"{_g(r'(?i)\b(Renegociação|Renegociacao|Empréstimo|Emprestimo|Refinanciamento|Consignação|Consignacao)\b')})",
    "sis_tipo_sistema": f"coalesce({_g(r'(?i)Tipo\s+Sistema:\s+([A-Za-zÀ-úç]+)')}, "
                        f"{_g(r'(?is)Sistema[:\s]+.*?(Consignado|Consignacao|Crédito|Credito|Débito|Debito)')})",
    "sis_total_parcelas": f"coalesce({_g(r'(?i)Total:\s+(\d+(?:\.\d+)?,\d+)')}, "
                          f"{_g(r'(?i)Total\s+Geral\s+(\d+(?:\.\d+)?,\d+)')})",
    "sis_valor_parcela": _g(r"(?i)VIr\.?\s*Parc\.\s+(\d+(?:\.\d+)?,\d+)"),
    "gen_cpf": _strip(f"coalesce({_g(r'\b(\d{3}\.\d{3}\.\d{3}-\d{2})\b')}, {_g(r'\b(\d{11})\b')})"),
    "telefone": ("CASE WHEN regexp_matches(text, '(?i)TELEFONE') THEN " + _strip(
        f"coalesce({_g(r'\(\d{2}\)\s*\d{4,5}-\d{4}', 0)}, {_g(r'\b\d{2}\s+\d{4,5}-\d{4}\b', 0)}, "
        f"{_g(r'\b\d{10,11}\b', 0)})") + " END"),
    "gen_data": _strip(f"coalesce({_g(r'\b(\d{2}/\d{2}/\d{4})\b')}, {_g(r'\b(\d{2}/\d{2}/\d{2})\b')})"),
}


def _has(col: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains(lower({col}), {_q(w)})" for w in words) + ")"


def _hasnt(col: str, word: str) -> str:
    return f"NOT contains(lower({col}), {_q(word)})"


# (rule name, extractor id, condition) in cascade order, written out in SQL
OAB_ARMS = [
    ("nome", "oab_nome", _has("field", "nome")),
    ("inscricao", "oab_inscricao", _has("field", "inscricao", "inscriçao", "inscriçâo", "oab")),
    ("seccional", "oab_seccional", _has("field", "seccional")),
    ("subsecao", "oab_subsecao", _has("field", "subsec", "subseç")),
    ("categoria", "oab_categoria", _has("field", "categoria")),
    ("endereco", "oab_endereco", _has("field", "endereco", "endereço")),
    ("telefone", "telefone", _has("field", "telefone")),
    ("situacao", "oab_situacao", _has("field", "situacao", "situação")),
]
SIS_ARMS = [
    ("cidade", "sis_cidade", _has("field", "cidade")),
    ("pesquisa_por", "sis_pesquisa_por", _has("field", "pesquisa_por")),
    ("pesquisa_tipo", "sis_pesquisa_tipo", _has("field", "pesquisa_tipo")),
    ("produto", "sis_produto", _has("field", "produto")),
    ("quantidade_parcelas", "sis_quantidade_parcelas", f"{_has('field', 'quantidade')} AND {_has('field', 'parcela')}"),
    ("selecao_parcelas", "sis_selecao_parcelas", f"{_has('field', 'selecao', 'seleção')} AND {_has('field', 'parcela')}"),
    ("sistema", "sis_sistema", f"{_has('field', 'sistema')} AND {_hasnt('field', 'tipo')}"),
    ("tipo_operacao", "sis_tipo_operacao", f"{_has('field', 'tipo')} AND {_has('field', 'operacao')}"),
    ("tipo_sistema", "sis_tipo_sistema",
     f"{_has('field', 'tipo')} AND {_has('field', 'sistema')} AND {_hasnt('field', 'operacao')}"),
    ("total_parcelas", "sis_total_parcelas", f"{_has('field', 'total')} AND {_has('field', 'parcela')}"),
    ("valor_parcela", "sis_valor_parcela", f"{_has('field', 'valor')} AND {_has('field', 'parcela')}"),
]
GEN_ARMS = [
    ("cpf", "gen_cpf", "(contains(upper(field), 'CPF') OR contains(upper(description), 'CPF') "
                       "OR contains(description, 'XXX.XXX.XXX-X'))"),
    ("telefone", "telefone", "(contains(upper(field), 'TELEFONE') OR contains(upper(description), 'TELEFONE'))"),
    ("data", "gen_data", "(contains(upper(field), 'DATA') OR contains(upper(description), 'DD/MM/YYYY') "
                         "OR contains(upper(description), 'DATE'))"),
]


def _case(arms, what: str, prefix: str) -> str:
    parts = []
    for name, x, cond in arms:
        val = _q(f"{prefix}.{name}") if what == "name" else _q(x)
        parts.append(f"WHEN {cond} THEN {val}")
    return "CASE " + " ".join(parts) + " END"


FAMILY = ("CASE WHEN contains(lower(label), 'oab') THEN 'oab' "
          "WHEN contains(lower(label), 'sistema') THEN 'sistema' END")


def label_rule(what: str) -> str:
    return (f"CASE WHEN {FAMILY} = 'oab' THEN {_case(OAB_ARMS, what, 'oab')} "
            f"WHEN {FAMILY} = 'sistema' THEN {_case(SIS_ARMS, what, 'sistema')} END")


def generic_rule(what: str) -> str:
    return _case(GEN_ARMS, what, "generic")


def _value_of(xcol: str) -> str:
    return "CASE " + " ".join(f"WHEN {xcol} = {_q(x)} THEN {e}" for x, e in EXTRACTOR_SQL.items()) + " END"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Field-level rule values and fallback answers for every card and screen job.
FIELD_VALUES = f"""
jf AS (
  SELECT d.job_id, d.doc_id, d.label, d.text, r.ord, r.field, r.description
  FROM docs d JOIN req r ON d.request_id = r.request_id),
planned AS (
  SELECT *, {label_rule('x')} AS lx, {generic_rule('x')} AS gx FROM jf),
valued AS (
  SELECT job_id, doc_id, label, ord, field, description,
         {_value_of('lx')} AS lv, {_value_of('gx')} AS gv FROM planned),
ruled AS (
  SELECT *, coalesce(lv, gv) AS rv,
         CASE WHEN lv IS NOT NULL THEN 'label_rules' WHEN gv IS NOT NULL THEN 'generic_rules' END AS rsrc
  FROM valued),
per_job AS (
  SELECT job_id, doc_id, label, bool_and(rv IS NOT NULL) AS found_all, count(*) AS n_fields,
         min(CASE WHEN rv IS NULL THEN ord END) AS first_missing_ord,
         string_agg(CASE WHEN rv IS NOT NULL THEN field END, ',' ORDER BY ord) AS found_rules,
         string_agg(CASE WHEN rv IS NULL THEN field END, ',' ORDER BY ord) AS missing_fields
  FROM ruled GROUP BY job_id, doc_id, label),
jobs_out AS (
  SELECT *, NOT found_all AND doc_id % 10 NOT IN (8, 9) AS llm_ok,
         CASE WHEN NOT found_all AND doc_id % 10 IN (8, 9) THEN 'fallback response is not a JSON object' END AS llm_error
  FROM per_job),
final AS (
  SELECT r.job_id, r.ord, r.field,
         CASE WHEN r.rv IS NOT NULL THEN r.rv
              WHEN j.llm_ok AND NOT (r.doc_id % 10 = 7 AND r.ord = j.first_missing_ord)
                THEN CASE WHEN r.doc_id % 3 = 0 THEN CAST(r.doc_id AS VARCHAR)
                          ELSE r.field || '-' || CAST(r.doc_id AS VARCHAR) END END AS value,
         CASE WHEN r.rv IS NOT NULL THEN r.rsrc
              WHEN j.llm_ok AND NOT (r.doc_id % 10 = 7 AND r.ord = j.first_missing_ord) THEN 'fallback' END AS source
  FROM ruled r JOIN jobs_out j ON r.job_id = j.job_id)"""

FIXTURE_CTES = _with(_requests_values(), CARDS, SCREENS, DOCS, FIELD_VALUES)

STATS_PER_JOB = """
stats AS (
  SELECT j.job_id, j.label, j.n_fields AS total_fields,
         CASE WHEN j.found_all OR NOT j.llm_ok THEN j.n_fields
              ELSE coalesce(len(string_split(j.found_rules, ',')), 0) END AS heuristics,
         CASE WHEN j.llm_ok THEN coalesce(len(string_split(j.missing_fields, ',')), 0) ELSE 0 END AS llm,
         f.found, j.n_fields - f.found AS missing,
         coalesce(len(string_split(j.found_rules, ',')), 0) AS rules_found,
         f.llm_found
  FROM jobs_out j JOIN (SELECT job_id, count(value) AS found,
                               count(CASE WHEN source = 'fallback' THEN 1 END) AS llm_found
                        FROM final GROUP BY job_id) f ON j.job_id = f.job_id)"""


MISSING = FIXTURE_CTES + """
, miss AS (
  SELECT r.doc_id, r.label, d.text,
         string_agg(r.field, ',' ORDER BY r.ord) AS missing_fields,
         '{' || chr(10) || string_agg('  ' || to_json(r.field) || ': ' || to_json(r.description),
                                       ',' || chr(10) ORDER BY r.ord) || chr(10) || '}' AS block
  FROM ruled r JOIN docs d ON r.job_id = d.job_id WHERE r.rv IS NULL GROUP BY r.doc_id, r.label, d.text)"""
PROMPT = f"{_q(PROMPT_HEAD)} || block || {_q(PROMPT_MID)} || text || {_q(PROMPT_TAIL)}"


def _pct(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100.0, 0.0)"


def _rule_sql(which: str, x: str) -> str:
    src = {"cards": "cards", "screens": "screens", "both": "docs"}[which]
    return (_with(_requests_values(), CARDS, SCREENS, DOCS)
            + f"SELECT doc_id, {EXTRACTOR_SQL[x]} AS value FROM {src}")


def oracle_sql() -> dict[str, str]:
    from docsift.catalog import RULE_QUERIES

    out = {name: _rule_sql(w, x) for name, (w, x) in RULE_QUERIES.items()}
    all_jobs = _with(_requests_values(), CARDS, SCREENS, DOCS, DOC_JOBS,
                     "all_jobs AS (SELECT 'fixtures' AS source, job_id, label, request_id FROM docs "
                     "UNION ALL SELECT 'documents', job_id, label, request_id FROM doc_jobs)")
    out["rule_plan"] = all_jobs + f"""
SELECT label, field, description, {label_rule('name')} AS label_rule, {generic_rule('name')} AS generic_rule
FROM (SELECT DISTINCT a.label, r.field, r.description FROM all_jobs a JOIN req r ON a.request_id = r.request_id)"""
    out["extract_found_all"] = FIXTURE_CTES + """
SELECT job_id, found_all, n_fields, CAST(count(rv) AS BIGINT) AS n_found,
       CAST(count(CASE WHEN rsrc = 'generic_rules' THEN 1 END) AS BIGINT) AS n_generic
FROM per_job JOIN ruled USING (job_id) GROUP BY job_id, found_all, n_fields"""
    out["extract_long"] = FIXTURE_CTES + "SELECT job_id, CAST(ord AS INTEGER) AS ord, field, value, source FROM final"
    out["stream_extract"] = out["extract_long"]          # stream = batch
    out["extract_jobs"] = FIXTURE_CTES + """
SELECT job_id, label, false AS cache_hit, true AS heuristics_used, llm_ok AS llm_used, llm_error,
       coalesce(found_rules, '') AS found_by_heuristics,
       CASE WHEN llm_ok THEN missing_fields END AS found_by_llm
FROM jobs_out"""
    out["result_json"] = FIXTURE_CTES + """
SELECT job_id, '{' || string_agg(to_json(field) || ':' ||
                     CASE WHEN source = 'fallback' AND doc_id % 3 = 0 THEN value      -- answered as a number
                          ELSE coalesce(to_json(value), 'null') END, ',' ORDER BY ord) || '}'
       AS result_json
FROM final JOIN jobs_out USING (job_id) GROUP BY job_id"""
    out["missing_requests"] = MISSING + f"""
SELECT doc_id, label, missing_fields, sha256({PROMPT}) AS prompt_sha256,
       'gpt-5-mini' AS model, CAST(2 AS BIGINT) AS n_messages
FROM miss"""
    out["stats_per_doc"] = FIXTURE_CTES + ", " + STATS_PER_JOB.strip() + f"""
SELECT job_id, CAST(job_id AS VARCHAR) AS file, label, total_fields, heuristics, llm, found, missing,
       {_pct('found', 'total_fields')} AS coverage, {_pct('heuristics', 'total_fields')} AS heuristics_coverage,
       printf('%.1f', {_pct('found', 'total_fields')}) AS coverage_shown,
       rules_found, llm_found
FROM stats"""
    out["stats_overall"] = FIXTURE_CTES + ", " + STATS_PER_JOB.strip() + f"""
, t AS (SELECT count(*) AS total_files, sum(total_fields) AS total_fields, sum(heuristics) AS total_heuristics,
               sum(llm) AS total_llm FROM stats)
SELECT CAST(total_files AS BIGINT) AS total_files, CAST(total_fields AS BIGINT) AS total_fields,
       CAST(total_heuristics AS BIGINT) AS total_heuristics, CAST(total_llm AS BIGINT) AS total_llm,
       CAST(0 AS BIGINT) AS cache_hits, CAST(total_files AS BIGINT) AS cache_misses,
       {_pct('total_heuristics + total_llm', 'total_fields')} AS overall_coverage,
       {_pct('total_heuristics', 'total_fields')} AS heuristics_coverage,
       {_pct('total_llm', 'total_fields')} AS llm_pct,
       CASE WHEN total_llm > 0 THEN {_pct('total_heuristics', 'total_heuristics + total_llm')} END AS savings_pct,
       CASE WHEN total_llm > 0 THEN CAST(total_fields AS DOUBLE) / CAST(total_llm AS DOUBLE) END AS reduction_factor,
       CASE WHEN total_llm > 0 THEN CAST(total_heuristics AS BIGINT) END AS calls_saved
FROM t"""
    out["stats_by_type"] = FIXTURE_CTES + ", " + STATS_PER_JOB.strip() + f"""
SELECT label, count(*) AS files, CAST(sum(total_fields) AS BIGINT) AS total_fields,
       CAST(sum(heuristics) AS BIGINT) AS heuristics, CAST(sum(llm) AS BIGINT) AS llm,
       {_pct('sum(heuristics)', 'sum(total_fields)')} AS heuristics_pct,
       CAST(sum(llm) AS DOUBLE) / NULLIF(CAST(sum(total_fields) AS DOUBLE), 0) * 100.0 AS llm_pct
FROM stats GROUP BY label"""
    out["manifest_fields"] = all_jobs + """
SELECT r.field, count(*) AS n_jobs FROM all_jobs a JOIN req r ON a.request_id = r.request_id GROUP BY r.field"""
    out["labels_multi"] = all_jobs + """
, fs AS (SELECT request_id, string_agg(field, ',' ORDER BY field) AS field_set FROM req GROUP BY request_id)
SELECT label, count(*) AS n_jobs, count(DISTINCT field_set) AS n_field_sets
FROM all_jobs JOIN fs USING (request_id) GROUP BY label HAVING count(*) > 1"""
    out["content_hash"] = "SELECT doc_id, sha256(text) AS content_hash FROM documents"
    schema_hash = _with(_requests_values(), DOC_JOBS, """
sh AS (SELECT request_id, sha256('[' || string_agg('{"k":' || to_json(field) || ',"v":' || to_json(description) || '}',
                                  ',' ORDER BY field, description) || ']') AS schema_hash
       FROM req GROUP BY request_id)""")
    out["cache_key"] = schema_hash + """
SELECT job_id, schema_hash, sha256(text) || ':' || schema_hash AS cache_key FROM doc_jobs JOIN sh USING (request_id)"""
    out["schema_key_order"] = all_jobs + """
SELECT a.source, a.job_id, true AS order_free, CAST(count(*) AS BIGINT) AS n_fields
FROM all_jobs a JOIN req r ON a.request_id = r.request_id GROUP BY a.source, a.job_id"""
    out["cache_first_writer"] = _with(DOC_JOBS) + """
SELECT job_id, job_id <> min(job_id) OVER (PARTITION BY text, request_id) AS cache_hit FROM doc_jobs"""
    out["stream_replay"] = _with(DOC_JOBS) + """
SELECT job_id, hit AS cache_hit, hit AS no_rules
FROM (SELECT job_id, job_id <> min(job_id) OVER (PARTITION BY text, request_id) AS hit FROM doc_jobs)"""
    run2 = _with(DOC_JOBS, """
prior AS (SELECT DISTINCT text, request_id FROM doc_jobs WHERE lang = 'en'),
run2 AS (
  SELECT d.job_id,
         (p.text IS NOT NULL) OR d.job_id <> min(d.job_id) OVER (PARTITION BY d.text, d.request_id) AS cache_hit,
         p.text IS NOT NULL AS in_prior, d.text, d.request_id
  FROM doc_jobs d LEFT JOIN prior p ON d.text = p.text AND d.request_id = p.request_id)""")
    out["cache_split"] = run2 + "SELECT job_id, cache_hit, NOT cache_hit AS heuristics_used FROM run2"
    out["cache_stats"] = run2 + """
SELECT 'hits' AS metric, CAST(count(*) FILTER (WHERE cache_hit) AS BIGINT) AS value FROM run2
UNION ALL SELECT 'misses', CAST(count(*) FILTER (WHERE NOT cache_hit) AS BIGINT) FROM run2
UNION ALL SELECT 'distinct_keys', CAST(count(DISTINCT sha256(text) || ':' || CAST(request_id AS VARCHAR)) AS BIGINT)
          FROM run2
UNION ALL SELECT 'new_cache_rows',
          CAST(count(DISTINCT sha256(text) || ':' || CAST(request_id AS VARCHAR)) FILTER (WHERE NOT in_prior) AS BIGINT)
          FROM run2"""
    out["jobs_jsonl"] = _with(_requests_values(), DOC_JOBS) + """
SELECT j.job_id, j.label, count(*) AS n_fields, string_agg(r.field, ',' ORDER BY r.ord) AS field_names,
       'doc_' || CAST(j.doc_id AS VARCHAR) || '.pdf' AS pdf_path
FROM doc_jobs j JOIN req r ON j.request_id = r.request_id GROUP BY j.job_id, j.label, j.doc_id"""
    out["request_parse"] = _with(_requests_values(), DOC_JOBS) + """
SELECT j.job_id, CASE WHEN j.doc_id % 13 < 5 THEN NULL ELSE count(*) END AS n_fields,
       CASE WHEN j.doc_id % 13 < 5 THEN 'SCHEMA_ERROR' END AS error_class
FROM doc_jobs j JOIN req r ON j.request_id = r.request_id GROUP BY j.job_id, j.doc_id"""
    words = "(c_custkey * 97 % 40 * 50 + 1)"
    out["rules_long_runs"] = f"""
SELECT c_custkey AS doc_id, CAST({words} * 11 - 1 AS INTEGER) AS n_nome,
       sha256(rtrim(repeat('JOAO SILVA ', CAST({words} AS INTEGER)))) AS nome_sha256,
       CAST({words} * 8 - 1 AS INTEGER) AS n_produto
FROM customer"""
    # by sign: what a word character, a space or neither makes of the name and the number
    out["rules_unicode"] = """
SELECT c_custkey AS doc_id,
       CASE c_custkey % 9 WHEN 0 THEN 'JOS' WHEN 1 THEN NULL WHEN 2 THEN NULL
            WHEN 3 THEN 'JOS' || chr(28) || 'E' || chr(28) || 'SILVA'
            WHEN 4 THEN 'JOS' || chr(160) || 'E' || chr(160) || 'SILVA' WHEN 5 THEN NULL
            WHEN 6 THEN 'JOS' || chr(215) || 'E' || chr(215) || 'SILVA'
            WHEN 7 THEN 'JOS' || chr(8232) || 'E' || chr(8232) || 'SILVA' ELSE 'JOS' END AS nome,
       CASE WHEN c_custkey % 9 IN (1, 2, 5) THEN '654321' ELSE '123456' END AS inscricao
FROM customer"""
    out["extract_errors"] = _with(_requests_values(), DOC_JOBS, """
n AS (SELECT request_id, count(*) AS n FROM req GROUP BY request_id),
e AS (SELECT job_id, doc_id, n, CASE doc_id % 11 WHEN 0 THEN 'SCHEMA_ERROR' WHEN 1 THEN 'FILE_NOT_FOUND'
                                             WHEN 2 THEN 'ZERO_PAGES' END AS error_class
      FROM doc_jobs JOIN n USING (request_id))""") + """
SELECT e.job_id, error_class, error_class IS NULL AS keyed,
       CAST(CASE WHEN doc_id % 11 IN (0, 3) THEN 0 ELSE n END AS BIGINT) AS total_fields,
       CASE error_class WHEN 'SCHEMA_ERROR' THEN 'invalid request'
            WHEN 'FILE_NOT_FOUND' THEN 'document not found: ' || CAST(doc_id AS VARCHAR)
            WHEN 'ZERO_PAGES' THEN 'document has 0 pages: ' || CAST(doc_id AS VARCHAR) END AS error
FROM e"""
    out["empty_result_hit"] = _with(_requests_values(), DOC_JOBS, """
n AS (SELECT request_id, count(*) AS n FROM req GROUP BY request_id)""") + """
SELECT job_id, CASE doc_id % 11 WHEN 0 THEN 'SCHEMA_ERROR' WHEN 1 THEN 'FILE_NOT_FOUND' WHEN 2 THEN 'ZERO_PAGES' END AS error_class,
       CASE WHEN doc_id % 11 > 2 THEN true END AS cache_hit,
       CASE WHEN doc_id % 11 = 3 THEN CAST(0 AS BIGINT) WHEN doc_id % 11 > 3 THEN n END AS n_fields
FROM doc_jobs JOIN n USING (request_id)"""
    out["jobs_to_documents"] = """
SELECT doc_id AS job_id, CASE WHEN doc_id % 17 = 0 THEN -doc_id - 1 ELSE doc_id END AS doc_id,
       CASE WHEN doc_id % 17 <> 0 THEN CAST(length(text) AS BIGINT) END AS n_chars
FROM documents"""
    out["manifest_jobs"] = _with(_requests_values(), DOC_JOBS) + """
SELECT row_number() OVER (ORDER BY j.job_id) AS job_id, j.label, n.n AS n_fields,
       'doc_' || CAST(j.doc_id AS VARCHAR) AS pdf_path
FROM doc_jobs j JOIN (SELECT request_id, count(*) AS n FROM req GROUP BY request_id) n USING (request_id)"""
    files = """
SELECT file, CAST(strlen(v) AS BIGINT) AS length, sha256(v) AS content_hash{more}
FROM (SELECT doc_id // 50 AS file, string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id) AS v FROM documents GROUP BY 1)"""
    out["file_ledger"] = files.format(more=", file % 2 AS run_id")
    out["file_stream"] = files.format(more="")
    out["stream_report_overall"], out["stream_report_by_type"] = out["stats_overall"], out["stats_by_type"]
    out["stream_first_arrivals"] = "SELECT event_id, user_id, event_type FROM events"
    out["manifest_indented"] = out["manifest_jobs"]
    out["results_in_order"] = f"SELECT row_number() OVER (ORDER BY job_id) AS position, * FROM ({out['result_json']})"
    out["cache_keys_of_all"] = all_jobs + """
, pairs AS (
  SELECT d.label, sha256(d.text) AS c, r.request_id AS s
  FROM doc_jobs d JOIN (SELECT DISTINCT label, request_id FROM all_jobs) r ON d.label = r.label)
SELECT label, count(DISTINCT c) AS n_contents, count(DISTINCT s) AS n_schemas, count(DISTINCT c || ':' || CAST(s AS VARCHAR)) AS n_keys
FROM pairs GROUP BY label"""
    out["fallback_workers"] = MISSING + f"""
SELECT doc_id, CAST(least(doc_id % 4 + 1, 3) AS INTEGER) AS attempts,
       CASE WHEN doc_id % 4 < 3 THEN '{{"doc_id": ' || CAST(doc_id AS VARCHAR) || ', "prompt_chars": ' ||
         CAST(length({PROMPT}) AS VARCHAR) || '}}' END AS response_json
FROM miss"""
    out["nested_request_hash"] = "SELECT doc_id, true AS same, false AS other FROM documents"
    out["cache_cleared"] = _with(DOC_JOBS) + """
SELECT 'before' AS state, count(*) AS n_rows FROM (SELECT DISTINCT text, request_id FROM doc_jobs)
UNION ALL SELECT 'after', CAST(0 AS BIGINT)"""
    out["custom_bank"] = r"""
SELECT doc_id AS job_id, CAST(0 AS INTEGER) AS ord, 'palavra' AS field,
       NULLIF(regexp_extract(text, '([A-Za-z]+)', 1), '') AS value,
       CASE WHEN regexp_matches(text, '[A-Za-z]') THEN 'label_rules' END AS source
FROM documents"""
    out["first_page"] = "SELECT conv_id, arg_min(text, turn) AS first_text FROM conversations GROUP BY conv_id"
    out["zero_pages"] = """
SELECT DISTINCT d.doc_id AS conv_id, 'ZERO_PAGES' AS error_class,
       'document has 0 pages: ' || CAST(d.doc_id AS VARCHAR) AS error_message
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id)"""
    return out
