"""Rule banks, one case per row: (label, text, request, expected values, found_all).

They cover each rule's boundaries, Unicode and the cascades. All cases run in one Spark job.
"""

import json

import pytest
from pyspark.sql import functions as F

from docsift.operators.engine import apply_rules, extractor_values
from docsift.operators.rules import DEFAULT, Alt, Extractor, RuleBank
from docsift.sources.files import parse_request

OAB, SIS = "carteira_oab", "tela_sistema"
ADDR = "Endereço Profissional\nLARGO DO MOINHO, 18\nLAGES - SC\n88501200"

CASES = [
    # generic CPF
    ("cpf_basic", OAB, "titular 402.318.775-21, ramal 55667788",
     {"cpf": "o cpf do titular"}, {"cpf": "402.318.775-21"}, True),
    ("cpf_field_name", OAB, "cartao 530.771.204-08 de 1998", {"meu_cpf": "do cadastro"},
     {"meu_cpf": "530.771.204-08"}, True),
    ("cpf_mask_in_description", OAB, "ficha 618.045.932-70", {"documento": "escrito XXX.XXX.XXX-X"},
     {"documento": "618.045.932-70"}, True),
    ("cpf_absent", OAB, "nove algarismos 204060801 e nada mais", {"cpf": "CPF"}, {"cpf": None}, False),
    ("cpf_first_of_two", OAB, "pai 700.111.300-44, filho 800.222.400-55", {"cpf": "CPF"},
     {"cpf": "700.111.300-44"}, True),
    ("cpf_eleven_digits", OAB, "cpf 40231877521 fim", {"cpf": "CPF"}, {"cpf": "40231877521"}, True),
    # registration
    ("insc_basic", OAB, "reg 284617 lote 9081726", {"inscricao": "o registro"},
     {"inscricao": "284617"}, True),
    ("insc_exactly_six", OAB, "70707 808080 9090909 10101010", {"inscricao": "x"},
     {"inscricao": "808080"}, True),
    ("insc_circumflex_key", OAB, "livro 365214", {"inscriçâo": "x"}, {"inscriçâo": "365214"}, True),
    ("insc_oab_key", OAB, "folha 552233", {"num_oab": "x"}, {"num_oab": "552233"}, True),
    ("insc_unknown_label", "recibo", "folha 552233", {"campo_x": "livre"},
     {"campo_x": None}, False),
    ("insc_none", OAB, "curto 70707, longo 9090909", {"inscricao": "x"}, {"inscricao": None}, False),
    ("insc_long_number", OAB, "codigo 98765432109876", {"inscricao": "x"}, {"inscricao": None}, False),
    ("insc_after_accent", OAB, "ç552233", {"inscricao": "x"}, {"inscricao": None}, False),
    ("insc_correct_spelling_not_trigger", OAB, "y 552233", {"inscrição": "Número"}, {"inscrição": None}, False),
    # category
    ("cat_suplementar", OAB, "vale como SUPLEMENTAR ate hoje", {"categoria": "x"},
     {"categoria": "SUPLEMENTAR"}, True),
    ("cat_keeps_case", OAB, "ocupa: Advogado", {"categoria": "x"}, {"categoria": "Advogado"}, True),
    ("cat_whole_word", OAB, "SUPLEMENTARES? um SUPLEMENTAR", {"categoria": "x"},
     {"categoria": "SUPLEMENTAR"}, True),
    ("cat_estagiaria", OAB, "ela: ESTAGIARIA", {"categoria": "x"}, {"categoria": "ESTAGIARIA"}, True),
    ("cat_none", OAB, "nenhum tipo escrito", {"categoria": "x"}, {"categoria": None}, False),
    # status
    ("sit_accented", OAB, "hoje SITUAÇÃO REGULAR", {"situacao": "x"}, {"situacao": "REGULAR"}, True),
    ("sit_plain", OAB, "hoje SITUACAO REGULAR", {"situacao": "x"}, {"situacao": "REGULAR"}, True),
    ("sit_lower", OAB, "situação regular", {"situacao": "x"}, {"situacao": "regular"}, True),
    ("sit_accent_value", OAB, "SITUAÇÃO ÓTIMA", {"situacao": "x"}, {"situacao": "ÓTIMA"}, True),
    ("sit_none", OAB, "nada sobre isso", {"situacao": "x"}, {"situacao": None}, False),
    # dates
    ("date_long", OAB, "feito em 07/09/2019", {"data_base": "data do feito"},
     {"data_base": "07/09/2019"}, True),
    ("date_short", OAB, "ate 30/06/18", {"data_vencimento": "x"}, {"data_vencimento": "30/06/18"}, True),
    ("date_long_wins", OAB, "de 02/02/17 a 28/11/2018", {"data": "Data"}, {"data": "28/11/2018"}, True),
    ("date_desc_mask", OAB, "visto 14/04/2016", {"campo": "como DD/MM/YYYY"},
     {"campo": "14/04/2016"}, True),
    ("date_no_calendar_check", OAB, "dia 45/77/2020", {"data": "Data"}, {"data": "45/77/2020"}, True),
    ("date_first_of_two", OAB, "de 03/03/2015 a 04/04/2015", {"data": "Data"}, {"data": "03/03/2015"}, True),
    ("date_in_description_word", OAB, "visto 19/10/2014", {"campo": "validate"}, {"campo": "19/10/2014"}, True),
    ("date_none", OAB, "sem dia, lote 552233", {"data": "Data"}, {"data": None}, False),
    # names
    ("name_apostrophe", OAB, "dona: TEREZA D'AVILA", {"nome": "x"}, {"nome": "TEREZA D'AVILA"}, True),
    ("name_two_words", OAB, "dono: IRIS BENTO", {"nome": "x"}, {"nome": "IRIS BENTO"}, True),
    ("name_long", OAB, "dono: CAIO TULIO PRADO NERI", {"nome": "x"},
     {"nome": "CAIO TULIO PRADO NERI"}, True),
    ("name_accents", OAB, "INÊS DO VALE ARAÚJO\nregistro 284617",
     {"nome": "de quem", "inscricao": "registro"},
     {"nome": "INÊS DO VALE ARAÚJO", "inscricao": "284617"}, True),
    ("name_lowercase", OAB, "dono: ana lima ou Ana Lima", {"nome": "x"}, {"nome": None}, False),
    ("name_single_word", OAB, "dono: IVO", {"nome": "x"}, {"nome": "IVO"}, True),
    ("name_first_of_two", OAB, "dela: RITA LOBO, dele: OTTO BRAZ", {"nome": "x"}, {"nome": "RITA LOBO"}, True),
    ("name_nbsp", OAB, "JOÃO SILVA x", {"nome": "x"}, {"nome": "JOÃO SILVA"}, True),
    ("name_umlaut_outside_range", OAB, "KÜHNE", {"nome": "x"}, {"nome": None}, False),
    # subsection
    ("subsec_dash", OAB, "CONSELHO SECCIONAL - CEARÁ\nCategoria", {"subsecao": "x"}, {"subsecao": "CEARÁ"}, True),
    ("subsec_accented_key", OAB, "CONSELHO SECCIONAL - GOIÁS DO SUL\n", {"subseção": "x"},
     {"subseção": "GOIÁS DO SUL"}, True),
    ("subsec_no_dash", OAB, "CONSELHO SECCIONAL BARRA DO NORTE\nCategoria", {"subsecao": "x"},
     {"subsecao": "BARRA DO NORTE"}, True),
    ("subsec_en_dash", OAB, "CONSELHO SECCIONAL – CEARÁ\nCategoria", {"subsecao": "x"}, {"subsecao": "CEARÁ"}, True),
    ("subsec_needs_newline", OAB, "CONSELHO SECCIONAL - CEARÁ", {"subsecao": "x"}, {"subsecao": None}, False),
    ("subsec_blank_counts", OAB, "CONSELHO SECCIONAL -\n\n\nX", {"subsecao": "x"}, {"subsecao": ""}, True),
    ("subsec_none", OAB, "dono: IVO\nregistro 284617", {"subsecao": "x"},
     {"subsecao": None}, False),
    # phone
    ("phone_area", OAB, "Telefone do local\n(48) 3322-1100\nfim", {"telefone_profissional": "x"},
     {"telefone_profissional": "(48) 3322-1100"}, True),
    ("phone_spaced", OAB, "telefone 48 93322-1100", {"telefone": "x"}, {"telefone": "48 93322-1100"}, True),
    ("phone_digits", OAB, "telefone 48933221100", {"telefone_profissional": "x"},
     {"telefone_profissional": "48933221100"}, True),
    ("phone_no_space", OAB, "telefone (48)93322-1100", {"telefone": "x"}, {"telefone": "(48)93322-1100"}, True),
    ("phone_keyword_no_number", OAB, "Telefone do local\nnenhum", {"telefone_profissional": "x"},
     {"telefone_profissional": None}, False),
    ("phone_gate", OAB, "dono: IVO\n(48) 93322-1100", {"telefone": "x"}, {"telefone": None}, False),
    ("phone_by_description", OAB, "telefone (62) 94411-2200", {"contato": "o telefone de casa"},
     {"contato": "(62) 94411-2200"}, True),
    ("phone_cpf_not_phone", OAB, "telefone 77\n402.318.775-21\n284617", {"telefone": "x"},
     {"telefone": None}, False),
    ("phone_takes_11_digit_cpf", OAB, "telefone\n40231877521", {"telefone": "x"}, {"telefone": "40231877521"}, True),
    # address
    ("addr_three_lines", OAB, ADDR, {"endereco_profissional": "x"},
     {"endereco_profissional": "LARGO DO MOINHO, 18\nLAGES - SC\n88501200"}, True),
    ("addr_unaccented_label", OAB, "Endereco Profissional\nRUA A, 1\nCENTRO - PR\n123", {"endereco": "x"},
     {"endereco": "RUA A, 1\nCENTRO - PR\n123"}, True),
    ("addr_none", OAB, "sem lugar", {"endereco": "x"}, {"endereco": None}, False),
    ("addr_oab_word_captured", OAB, ADDR + "\n284617", {"endereco_oab": "x"}, {"endereco_oab": "284617"}, True),
    # section
    ("sec_code", OAB, "na Seccional CE desde", {"seccional": "x"}, {"seccional": "CE"}, True),
    ("sec_council", OAB, "CONSELHO SECCIONAL - PR", {"seccional": "x"}, {"seccional": "PR"}, True),
    ("sec_lowercase", OAB, "Seccional ce pequena", {"seccional": "x"}, {"seccional": None}, False),
    ("sec_none", OAB, "nenhum estado", {"seccional": "x"}, {"seccional": None}, False),
    ("sec_not_a_code", OAB, "Seccional XYZ toda", {"seccional": "x"}, {"seccional": None}, False),
    ("sec_gate_missing", OAB, "PR only", {"seccional": "x"}, {"seccional": None}, False),
    ("subseccional_goes_to_seccional", OAB, "CONSELHO SECCIONAL - PR\nX", {"subseccional": "x"},
     {"subseccional": "PR"}, True),
    # mixed / edge
    ("multi_partial", OAB, "ficha 530.771.204-08, Seccional PI",
     {"cpf": "CPF", "inscricao": "x", "seccional": "y"},
     {"cpf": "530.771.204-08", "inscricao": None, "seccional": "PI"}, False),
    ("case_insensitive_keys", OAB, "ficha 402.318.775-21 reg 284617 Seccional PI",
     {"CPF": "x", "Inscricao": "y", "SECCIONAL": "z"},
     {"CPF": "402.318.775-21", "Inscricao": "284617", "SECCIONAL": "PI"}, True),
    ("empty_text", OAB, "", {"cpf": "CPF"}, {"cpf": None}, False),
    ("empty_request", OAB, "qualquer", {}, {}, True),
    ("unknown_field", OAB, "lote 70707", {"campo_y": "livre"}, {"campo_y": None}, False),
    # screens
    ("city", SIS, "Cidade: Itapuã U.F: BA rua", {"cidade": "x"}, {"cidade": "Itapuã"}, True),
    ("city_words", SIS, "Cidade: Vila Nova das Flores U.F: MS", {"cidade": "x"}, {"cidade": "Vila Nova das Flores"}, True),
    ("city_english", SIS, "Town: Itapuã", {"cidade": "x"}, {"cidade": None}, False),
    ("city_isolated_to_screens", OAB, "Cidade: Itapuã U.F: BA", {"cidade": "x"}, {"cidade": None}, False),
    ("search_by", SIS, "Pesquisar por: agora Buscar CLIENTE", {"pesquisa_por": "x"}, {"pesquisa_por": "CLIENTE"}, True),
    ("search_by_text_between", SIS, "Pesquisar por: entre linhas Buscar parente", {"pesquisa_por": "x"},
     {"pesquisa_por": "parente"}, True),
    ("search_by_english", SIS, "look for: owner", {"pesquisa_por": "x"}, {"pesquisa_por": None}, False),
    ("search_kind", SIS, "Tipo: Buscar parente CNPJ", {"pesquisa_tipo": "x"}, {"pesquisa_tipo": "CNPJ"}, True),
    ("search_kind_email", SIS, "Tipo: Buscar outro email", {"pesquisa_tipo": "x"}, {"pesquisa_tipo": "email"}, True),
    ("search_kind_cpf_by_generic", SIS, "ficha 402.318.775-21", {"pesquisa_tipo": "ou por cpf"},
     {"pesquisa_tipo": "402.318.775-21"}, True),
    ("product_stops_at_capitalised", SIS, "Produto SEGURO RURAL Banco", {"produto": "x"},
     {"produto": "SEGURO RURAL"}, True),
    ("product_single", SIS, "Produto FIANCA Banco", {"produto": "x"}, {"produto": "FIANCA"}, True),
    ("product_before_qtd", SIS, "Produto POUPANCA Qtd 3", {"produto": "x"},
     {"produto": "POUPANCA"}, True),
    ("product_table_layout", SIS, "FIADOR ZW CONSIGNADO POUPANCA 7", {"produto": "x"},
     {"produto": "FIADOR ZW CONSIGNADO POUPANCA"}, True),
    ("product_table_skip_excluded", SIS, "SISTEMA x QW x CASA", {"produto": "x"}, {"produto": "CASA"}, True),
    ("product_lowercase", SIS, "item: fianca", {"produto": "x"}, {"produto": None}, False),
    ("product_isolated", OAB, "Produto POUPANCA", {"produto": "x"}, {"produto": None}, False),
    ("count_labelled", SIS, "Qtd. Parcelas 37 fim", {"quantidade_parcelas": "x"},
     {"quantidade_parcelas": "37"}, True),
    ("count_singular", SIS, "Qtd. Parcela 8", {"quantidade_parcelas": "x"}, {"quantidade_parcelas": "8"}, True),
    ("count_near", SIS, "parcelas: 45", {"quantidade_parcelas": "x"}, {"quantidade_parcelas": "45"}, True),
    ("count_english", SIS, "paid 37 times", {"quantidade_parcelas": "x"},
     {"quantidade_parcelas": None}, False),
    ("selection", SIS, "Seleção de parcelas: Abertas fim", {"selecao_de_parcelas": "x"},
     {"selecao_de_parcelas": "Abertas"}, True),
    ("selection_accented_key", SIS, "Seleção de parcelas: Abertas", {"seleção_de_parcelas": "x"},
     {"seleção_de_parcelas": "Abertas"}, True),
    ("selection_near", SIS, "parcelas:\nvarias linhas\npendente", {"selecao_parcelas": "x"},
     {"selecao_parcelas": "pendente"}, True),
    ("system_with_value", SIS, "Sistema FIANCA Sistema RURAL VIr. Parc. 9,00", {"sistema": "x"},
     {"sistema": "RURAL"}, True),
    ("system_plain", SIS, "Sistema PORTAL agora", {"sistema": "x"}, {"sistema": "PORTAL"}, True),
    ("system_lowercase", SIS, "program: rural", {"sistema": "x"}, {"sistema": None}, False),
    ("operation", SIS, "Tipo Operação: Quitação depois", {"tipo_de_operacao": "x"},
     {"tipo_de_operacao": "Quitação"}, True),
    ("operation_lower_label", SIS, "tipo operação: Troca", {"tipo_de_operacao": "x"},
     {"tipo_de_operacao": "Troca"}, True),
    ("operation_keyword", SIS, "contrato EMPRESTIMO pessoal", {"tipo_de_operacao": "x"},
     {"tipo_de_operacao": "EMPRESTIMO"}, True),
    ("operation_english", SIS, "kind: exchange", {"tipo_de_operacao": "x"},
     {"tipo_de_operacao": None}, False),
    ("system_kind", SIS, "Tipo Sistema: Próprio", {"tipo_de_sistema": "x"}, {"tipo_de_sistema": "Próprio"}, True),
    ("system_kind_near", SIS, "Sistema: x y Crédito", {"tipo_de_sistema": "x"}, {"tipo_de_sistema": "Crédito"}, True),
    ("total", SIS, "Total: 8.205,17", {"total_de_parcelas": "x"}, {"total_de_parcelas": "8.205,17"}, True),
    ("total_lower", SIS, "total: 61,30", {"total_de_parcelas": "x"}, {"total_de_parcelas": "61,30"}, True),
    ("total_general", SIS, "Total Geral 7.450,09", {"total_de_parcelas": "x"}, {"total_de_parcelas": "7.450,09"}, True),
    ("total_dot_decimal", SIS, "Total em R$ 8205.17", {"total_de_parcelas": "x"},
     {"total_de_parcelas": None}, False),
    ("total_two_groups", SIS, "Total: 4.321.098,76", {"total_de_parcelas": "x"}, {"total_de_parcelas": None}, False),
    ("value", SIS, "depois VIr. Parc. 3.918,45", {"valor_parcela": "x"},
     {"valor_parcela": "3.918,45"}, True),
    ("value_lower", SIS, "vir. parc. 82,10", {"valor_parcela": "x"}, {"valor_parcela": "82,10"}, True),
    ("value_isolated", OAB, "VIr. Parc. 3.918,45", {"valor_parcela": "x"}, {"valor_parcela": None}, False),
    ("same_date_for_all_date_fields", SIS, "em 05/06/2013\nate 07/08/2014",
     {"data_base": "x", "data_verncimento": "y"}, {"data_base": "05/06/2013", "data_verncimento": "05/06/2013"}, True),
    # routing
    ("unknown_label_generic_only", "conta_luz",
     "dono Ivo\n402.318.775-21\nate 30/06/2018",
     {"cpf_dono": "do dono", "data_fim": "o fim"},
     {"cpf_dono": "402.318.775-21", "data_fim": "30/06/2018"}, True),
    ("unknown_label_isolation", "conta_luz",
     "INÊS DO VALE\nCidade: Itapuã U.F: BA",
     {"nome": "x", "cidade": "y"}, {"nome": None, "cidade": None}, False),
    ("both_keywords_go_to_oab", "oab_sistema", "Cidade: Lins U.F: SP\nMARIA", {"cidade": "x", "nome": "y"},
     {"cidade": None, "nome": "U"}, False),   # first all-caps run is the U of U.F
    ("label_case_insensitive", "CARTEIRA_OAB", "dono: RUI BRAGA", {"nome": "x"}, {"nome": "RUI BRAGA"}, True),
]


@pytest.fixture(scope="module")
def results(spark):
    # Requests travel as JSON text, as from a manifest: parsing keeps their order.
    rows = [(c[0], c[1], c[2], json.dumps(c[3], ensure_ascii=False)) for c in CASES]
    df = spark.createDataFrame(rows, "case string, label string, text string, request string")
    fields, _err = parse_request(F.col("request"))
    out = apply_rules(df.withColumn("fields", fields))
    return {r["case"]: r for r in out.select("case", "rule_values", "found_all").collect()}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_rule_case(results, case):
    name, _label, _text, request, expected, found_all = case
    row = results[name]
    got = {v["field"]: v["value"] for v in row["rule_values"]}
    assert [v["field"] for v in row["rule_values"]] == list(request)   # request order kept
    assert got == expected
    assert row["found_all"] is found_all


def test_cases_are_unique():
    assert len({c[0] for c in CASES}) == len(CASES)


def test_custom_bank_for_a_new_document_type(spark):
    """A new document type is a new bank in a new rule set; the engine is not edited."""
    from docsift.operators.rules import DEFAULT, Alt, Extractor, Rule, RuleBank
    from docsift.operators.rules.bank import name_has_any

    invoice = RuleBank("fatura", "fatura", (
        Rule("valor", name_has_any("valor"), "fat_valor"),
        Rule("numero", name_has_any("numero"), "oab_inscricao"),      # reuse a built-in extractor
    ))
    rules = DEFAULT.with_bank(invoice, {"fat_valor": Extractor((Alt(r"Valor:\s*R\$\s*([\d.,]+)", "i"),))})
    rows = [("fatura_nova", "Fatura 123456\nVALOR: R$ 1.500,00\nVencimento 10/01/2025",
             json.dumps({"valor_total": "Valor", "numero": "Número", "data_vencimento": "Vencimento"}))]
    df = spark.createDataFrame(rows, "label string, text string, request string")
    fields, _ = parse_request(F.col("request"))
    out = apply_rules(df.withColumn("fields", fields), rules=rules).collect()[0]
    got = {v["field"]: (v["value"], v["source"]) for v in out["rule_values"]}
    assert got == {"valor_total": ("1.500,00", "label_rules"), "numero": ("123456", "label_rules"),
                   "data_vencimento": ("10/01/2025", "generic_rules")}
    # the default rule set still treats the label as unknown
    plain = apply_rules(df.withColumn("fields", fields)).collect()[0]
    assert {v["field"]: v["value"] for v in plain["rule_values"]}["valor_total"] is None


def test_very_long_upper_case_runs_do_not_overflow(spark):
    """Java's engine would recurse once per repetition of a greedy group and overflow the task's stack; the
    patterns written for it (``Alt.java``) loop, with the same matches."""
    import re

    from docsift.operators.rules import oab, sistema

    texts = ["Produto " + "ABC " * 3000 + "Qtd", "Nome: " + "MARIA SILVA " * 10000 + "fim", "MARIA x"]
    rows = [(OAB if i else SIS, t, json.dumps({"nome": "x"} if i else {"produto": "y"})) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "label string, text string, request string")
    fields, _ = parse_request(F.col("request"))
    got = [r["rule_values"][0]["value"] for r in apply_rules(df.withColumn("fields", fields)).collect()]
    assert got[0] == re.search(sistema.PRODUCT_LABELLED, texts[0]).group(1).strip()
    assert got[1] == re.search(oab.NAME, texts[1]).group(1).strip()
    assert got[2] == "MARIA"


@pytest.mark.parametrize("seed", range(3))
def test_java_patterns_match_as_python_re(spark, seed):
    """Every alternative on generated Unicode text: Spark's match is that of Python's ``re``."""
    import random
    import re

    from docsift.operators.engine import _raw
    from docsift.operators.rules import DEFAULT

    rng = random.Random(seed)
    signs = [" ", "  ", "\n", "'", "-", ":", ".", "_", "\u0301", "\u00b2", "\u00bd", "\x1c", "\u00a0", "\u00d7", "\u2028", "", ""]
    parts = ["JOSÉ", "E", "Produto", "Sistema", "SISTEMA", "Qtd", "123456", "12", "parcelas", "Vencidas", "CPF", "Tipo",
             "Buscar", "CLIENTE", "Á×B", "×", "a", "Seccional", "PR", "CONSELHO SECCIONAL", "Total", "1.234,56", "١٢٣٤٥٦",
             "(11) 98765-4321", "01/02/2023", "ß", "ﬁ", "Operação", "SITUAÇÃO", "VIr", "Parc", "Cidade", "U.F"]
    texts = ["".join(rng.choice(parts) + rng.choice(signs) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(8)
    alts = {f"{x}_{k}": a for x, e in DEFAULT.extractors.items() for k, a in enumerate(e.alts)}
    rows = df.select("i", *[_raw(a, F.col("text")).alias(c) for c, a in alts.items()]).collect()
    for row in rows:
        for c, a in alts.items():
            flags = (re.I if "i" in a.flags else 0) | (re.S if "s" in a.flags else 0)
            if a.many:
                expected = [m.group(a.group) for m in re.finditer(a.pattern, texts[row["i"]], flags)]
            else:
                m = re.search(a.pattern, texts[row["i"]], flags)
                expected = m.group(a.group) if m else ""
            assert row[c] == expected, (c, texts[row["i"]])


def test_all_alternatives_in_one_projection(spark):
    """No row is copied from one alternative to the next, and each pattern stands in the plan once."""
    df = spark.range(3).selectExpr("'oab' AS label", "array(struct(0 AS ord, 'nome' AS field, 'x' AS description)) AS fields",
                                   "concat('JOSE ', id) AS text")
    plan = apply_rules(df)._jdf.queryExecution().optimizedPlan().toString()
    with_rules = [step for step in plan.split("Project [") if "regexp_extract" in step or "RLIKE" in step]
    assert len(with_rules) == 1
    assert with_rules[0].count("Seleção de parcelas") == 1


def test_alternatives_in_order(spark):
    """The first that matches wins; a shut gate ends the search; ``many`` hands over an empty array too."""
    joined = lambda runs: F.array_join(runs, "+")
    rules = DEFAULT.with_bank(RuleBank("none", "none", ()), {
        "plain": Extractor((Alt(r"a(\d)"), Alt(r"b(\d)"), Alt(r"c( +)", strip=True))),
        "gated": Extractor((Alt(r"a(\d)"), Alt(r"b(\d)", gate=("open", "")), Alt(r"c(\d)"))),
        "outer": Extractor((Alt(r"a(\d)"), Alt(r"b(\d)")), gate=("open", "")),
        "many": Extractor((Alt(r"a(\d)"), Alt(r"b(\d)", many=True, finish=joined)))})
    rows = {"b1 a2": ("2", "2", None, "2"), "b1 b3": ("1", None, None, "1+3"), "open b1 c4": ("1", "1", "1", "1"),
            "c5": (None, None, None, ""), "c  ": ("", None, None, ""), "open c6": (None, "6", None, ""), None: (None,) * 4}
    names = ["plain", "gated", "outer", "many"]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    assert {r["text"]: tuple(r[n] for n in names) for r in extractor_values(df, names, rules=rules).collect()} == rows
