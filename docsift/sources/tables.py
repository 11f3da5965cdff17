"""Driver tables and the document fixtures derived from them.

The driver's ``documents`` table holds invented prose: it exercises hashing,
caching and the negative side of every rule, but contains no card or screen
layout. So two fixtures derive such documents from the relational tables, one
per row, with Spark built-ins only - their size grows with the tables:

* **cards** (``customer``): ID-card text, label ``carteira_oab``;
* **screens** (``orders``): system-screen text, label ``tela_sistema``.

The same texts are rebuilt byte for byte in DuckDB SQL for the oracle, so
every formatting step avoids engine-specific behaviour: money comes from
integer cents, dates from ``dd/MM/yyyy``, and words next to a ``\\b`` stay ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.plans.partitioning import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- fixed values: the field names; the texts beside them are ours and keep the trigger words -----------------
OAB_FIELDS_FULL = {
    "nome": "de quem é o cartão",
    "inscricao": "o registro de seis algarismos",
    "seccional": "a sigla do conselho",
    "subsecao": "a divisão local do conselho",
    "categoria": "o tipo de inscrito",
    "endereco_profissional": "onde a pessoa trabalha, em três linhas",
    "telefone_profissional": "o telefone do escritório",
    "situacao": "se o registro está em dia",
}
OAB_NO_PHONE = {k: v for k, v in OAB_FIELDS_FULL.items() if k != "telefone_profissional"}
OAB_NO_ADDRESS = {k: v for k, v in OAB_FIELDS_FULL.items() if k != "endereco_profissional"}
SISTEMA_A = {
    "data_base": "data em que a conta foi feita",
    "data_verncimento": "data limite para pagar",
    "quantidade_parcelas": "em quantas vezes se paga",
    "produto": "o que foi contratado",
    "sistema": "em que programa a conta corre",
    "tipo_de_operacao": "que operação é",
    "tipo_de_sistema": "que programa é",
}
SISTEMA_B = {
    "pesquisa_por": "quem se procura",
    "pesquisa_tipo": "procura por cpf, cnpj ou outra chave",
    "sistema": "em que programa a conta corre",
    "valor_parcela": "quanto custa cada vez",
    "cidade": "o lugar na tela",
}
SISTEMA_C = {
    "data_referencia": "data a que os saldos se referem",
    "selecao_de_parcelas": "quais delas estão marcadas",
    "total_de_parcelas": "a soma de todas",
}
# Ours: a card request that only the generic bank can answer beyond the name.
CARD_REGISTRY = {
    "nome": "Nome do titular",
    "cpf": "CPF do titular",
    "contato": "Telefone de contato",
    "data_emissao": "Data de emissão (DD/MM/YYYY)",
}
CARD_REQUESTS = (OAB_FIELDS_FULL, OAB_NO_PHONE, OAB_NO_ADDRESS, CARD_REGISTRY)
SCREEN_REQUESTS = (SISTEMA_A, SISTEMA_B, SISTEMA_C)
# ---------------------------------------------------------------------------

# Fixture vocabulary (ours; ASCII wherever a word boundary can touch it).
STATE_CODES = ("PR", "SP", "RJ", "MG", "BA")
STATE_NAMES = ("PARANÁ", "SÃO PAULO", "RIO DE JANEIRO", "MINAS GERAIS", "BAHIA")
SEGMENT_CATEGORY = {"BUILDING": "ADVOGADO", "HOUSEHOLD": "ADVOGADA", "MACHINERY": "SUPLEMENTAR",
                    "FURNITURE": "estagiario"}
SEARCH_BY = ("CLIENTE", "parente", "prestador", "outro")
SEARCH_KIND = ("CPF", "CNPJ", "Nome", "email")
PRODUCTS = ("REFINANCIAMENTO", "EMPRESTIMO PESSOAL")
CITIES = ("Centro Velho", "Campo Grande", "Boa Vista")
OPERATIONS = ("Renegociacao", "Refinanciamento", "Emprestimo")
SYSTEM_KINDS = ("Consignado", "Credito")
SELECTIONS = ("Vencidas", "Todas", "Pagas")


def _pick(values, idx: Column) -> Column:
    """``values[idx]`` for a 0-based integer Column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def request_map(request: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in request.items() for x in kv])


def _pick_request(requests, idx: Column) -> Column:
    return F.element_at(F.array(*[request_map(r) for r in requests]), idx.cast("int") + 1)


def money(cents: Column) -> Column:
    """Integer cents as ``d.ddd,dd`` (one thousands group; Brazilian separators)."""
    units = F.floor(cents / F.lit(100))
    rest = F.pmod(cents, F.lit(100))
    whole = F.when(units >= 1000, F.concat(F.floor(units / F.lit(1000)).cast("string"), F.lit("."),
                                           F.lpad(F.pmod(units, F.lit(1000)).cast("string"), 3, "0"))) \
        .otherwise(units.cast("string"))
    return F.concat(whole, F.lit(","), F.lpad(rest.cast("string"), 2, "0"))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ID-card document per customer: ``job_id, doc_id, label, request, text``."""
    c = spread(load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"))
    key = F.col("c_custkey")
    padded = F.lpad(key.cast("string"), 6, "0")
    st = F.pmod(F.col("c_nationkey"), F.lit(5))
    code, state = _pick(STATE_CODES, st), _pick(STATE_NAMES, st)
    cpf_digits = F.lpad(F.pmod(key * F.lit(7919), F.lit(100000000000)).cast("string"), 11, "0")
    cpf = F.when(F.pmod(key, F.lit(2)) == 0, F.concat(
        F.substring(cpf_digits, 1, 3), F.lit("."), F.substring(cpf_digits, 4, 3), F.lit("."),
        F.substring(cpf_digits, 7, 3), F.lit("-"), F.substring(cpf_digits, 10, 2))).otherwise(cpf_digits)
    category = F.col("c_mktsegment")
    cat = None
    for seg, word in SEGMENT_CATEGORY.items():
        cat = F.when(category == seg, F.lit(word)) if cat is None else cat.when(category == seg, F.lit(word))
    council = (F.when(F.pmod(key, F.lit(8)) == 3, F.concat(F.lit("CONSELHO SECCIONAL - "), code))
               .when(F.pmod(key, F.lit(4)) != 3, F.concat(F.lit("CONSELHO SECCIONAL - "), state)))
    tail4 = F.lpad(F.pmod(key, F.lit(10000)).cast("string"), 4, "0")
    phone = (F.when(F.pmod(key, F.lit(5)) == 0, F.concat(F.lit("(11) 9"), tail4, F.lit("-4321")))
             .when(F.pmod(key, F.lit(5)) == 1, F.concat(F.lit("11 3456-"), tail4)))
    status = F.when(F.pmod(key, F.lit(6)) != 5, F.concat(
        F.lit("Situação "), F.when(F.pmod(key, F.lit(2)) == 0, F.lit("REGULAR")).otherwise(F.lit("Suspensa"))))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("MARIA "), F.translate(padded, "0123456789", "ABCDEFGHIJ")),
        F.lit("Inscrição"), F.lit("Seccional"), F.lit("Subseção"),
        padded, code,
        F.concat(F.lit("CPF "), cpf),
        council, cat,
        F.lit("Endereço Profissional"),
        F.concat(F.lit("RUA DAS FLORES, "), F.pmod(key, F.lit(997)).cast("string")),
        F.concat(F.lit("CENTRO - "), code),
        F.lpad((key * F.lit(7)).cast("string"), 8, "0"),
        F.lit("Telefone Profissional"), phone, status,
    )
    sel = F.pmod(key, F.lit(7))
    req_idx = F.when(sel < 2, 0).when(sel < 4, 1).when(sel < 6, 2).otherwise(3)
    return c.select(
        (key * 2).alias("job_id"), (key * 2).alias("doc_id"),
        F.lit("carteira_oab").alias("label"),
        _pick_request(CARD_REQUESTS, req_idx).alias("request"),
        text.alias("text"))


def screens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One system-screen document per order: ``job_id, doc_id, label, request, text``."""
    o = spread(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                    "o_orderdate"))
    key = F.col("o_orderkey")
    cents = F.floor(F.col("o_totalprice") * F.lit(100))
    k4, k3, k2 = F.pmod(key, F.lit(4)), F.pmod(key, F.lit(3)), F.pmod(key, F.lit(2))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Pesquisar por: Buscar "), _pick(SEARCH_BY, k4), F.lit(" Tipo: x Buscar y "),
                 _pick(SEARCH_KIND, k4)),
        F.concat(F.lit("Data Base: "), F.date_format("o_orderdate", "dd/MM/yyyy")),
        F.concat(F.lit("Qtd. Parcelas "), (F.lit(1) + F.pmod(F.col("o_custkey"), F.lit(96))).cast("string")),
        F.when(k3 != 2, F.concat(F.lit("Produto "), _pick(PRODUCTS, k2), F.lit(" Qtd"))),
        F.concat(F.lit("Sistema CONSIGNADO VIr. Parc. "), money(F.pmod(cents, F.lit(1000000)))),
        F.concat(F.lit("Cidade: "), _pick(CITIES, k3), F.lit(" U.F: GO")),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Total: "), money(cents)))
         .when(F.col("o_orderstatus") == "O", F.concat(F.lit("Total Geral "), money(cents))),
        F.when(F.pmod(key, F.lit(5)) != 4, F.concat(F.lit("Tipo Operação: "), _pick(OPERATIONS, k3))),
        F.when(F.pmod(key, F.lit(7)) != 6, F.concat(F.lit("Tipo Sistema: "), _pick(SYSTEM_KINDS, k2))),
        F.when(k4 != 1, F.concat(F.lit("Seleção de parcelas: "), _pick(SELECTIONS, k3))),
    )
    return o.select(
        (key * 2 + 1).alias("job_id"), (key * 2 + 1).alias("doc_id"),
        F.lit("tela_sistema").alias("label"),
        _pick_request(SCREEN_REQUESTS, F.pmod(F.col("o_custkey"), F.lit(3))).alias("request"),
        text.alias("text"))


def documents_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per driver document: real prose, requests rotating over all seven."""
    d = spread(load(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    requests = CARD_REQUESTS + SCREEN_REQUESTS
    idx = F.pmod(F.col("doc_id"), F.lit(len(requests)))
    label = F.when(idx < len(CARD_REQUESTS), F.lit("carteira_oab")).otherwise(F.lit("tela_sistema"))
    return d.select(F.col("doc_id").alias("job_id"), "doc_id", label.alias("label"),
                    _pick_request(requests, idx).alias("request"), "text", "lang")
