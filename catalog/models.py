"""Staging, intermediates, dimensions and facts, with the SQL they are compared to."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.registry import MODEL_SQL, query
from emporio.plans import facts
from emporio.plans.staging import build_staging
from emporio.registry import TABLES_BY_NAME


def md5_of(*columns: str) -> str:
    return f"md5(concat_ws('-', {', '.join(f'coalesce(CAST({c} AS VARCHAR), $$NULL$$)' for c in columns)}))"


def hash_of(*columns: str) -> str:
    return f"md5(concat_ws('|', {', '.join(f'coalesce(CAST({c} AS VARCHAR), $$$$)' for c in columns)}))"


def key_or(default: str, column: str) -> str:
    """Surrogate key of a left-joined natural key, or the sentinel."""
    return f"CASE WHEN {column} IS NULL THEN '{default}' ELSE md5(CAST({column} AS VARCHAR)) END"


def round4(x: str) -> str:
    return f"floor(({x}) * 10000.0 + 0.5) / 10000.0"


def as_double(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


DATE_KEY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"
CALENDAR = "BETWEEN DATE '1995-02-01' AND DATE '2024-01-25'"


def date_or_unknown(day: str) -> str:
    return f"CASE WHEN {day} {CALENDAR} THEN {DATE_KEY.format(day)} ELSE -1 END"


MODEL_SQL["mod_itens"] = """
    SELECT * FROM src_vendas__itens_pedido
    QUALIFY row_number() OVER (PARTITION BY id_item_pedido ORDER BY updated_at DESC, id_pedido DESC, id_produto DESC,
        qtd_vendida DESC, preco_unitario DESC, custo_unitario DESC, desconto_item DESC, valor_liquido_item DESC) = 1"""

MODEL_SQL["mod_pedidos"] = f"""
    SELECT o.* EXCLUDE (status), CAST(dt_pedido AS DATE) AS dia, coalesce(linhas, 0) AS qtd_itens,
        coalesce(unidades, 0) AS qtd_total_produtos, coalesce(custo, 0) AS custo_total,
        valor_liquido - coalesce(custo, 0) AS margem_bruta,
        CASE WHEN valor_bruto > 0 THEN {round4(div('valor_desconto', 'valor_bruto'))} ELSE 0 END AS taxa_desconto,
        coalesce(devolucoes, 0) AS qtd_devolucoes, coalesce(devolvido, 0) AS valor_devolvido_total,
        CASE WHEN o.status <> 'cancelado' AND coalesce(devolucoes, 0) > 0 THEN 'devolvido' ELSE o.status END AS status
    FROM src_vendas__pedidos o
    LEFT JOIN (SELECT id_pedido, count(*) AS linhas, sum(qtd_vendida) AS unidades,
                 sum(qtd_vendida * custo_unitario) AS custo FROM mod_itens GROUP BY ALL) i USING (id_pedido)
    LEFT JOIN (SELECT id_pedido, count(*) AS devolucoes, sum(valor_devolvido) AS devolvido
               FROM src_vendas__devolucoes WHERE status = 'aprovada' GROUP BY ALL) d USING (id_pedido)"""


def score(column: str, sign: str, cuts: list[tuple[int, int]]) -> str:
    whens = " ".join(f"WHEN {column} {sign} {limit} THEN {points}" for limit, points in cuts)
    return f"CASE {whens} ELSE 1 END"


MODEL_SQL["mod_clientes"] = f"""
    SELECT *, {score("coalesce(recencia_dias, 999)", "<=", [(30, 5), (90, 4), (180, 3), (365, 2)])} AS score_recencia,
        {score("qtd_pedidos", ">=", [(20, 5), (10, 4), (5, 3), (2, 2)])} AS score_frequencia,
        {score("ltv", ">=", [(10000, 5), (5000, 4), (2000, 3), (800, 2)])} AS score_monetario,
        CASE WHEN ltv >= 15000 OR qtd_pedidos >= 15 THEN 'Platinum' WHEN ltv >= 6000 OR qtd_pedidos >= 8 THEN 'Gold'
             WHEN ltv >= 2000 OR qtd_pedidos >= 3 THEN 'Silver' ELSE 'Bronze' END AS nivel_fidelidade
    FROM (
        SELECT c.id_cliente, c.cpf, c.email, c.telefone, c.primeiro_nome, c.nome_completo,
            coalesce(e.cep, c.cep) AS cep, coalesce(e.cidade, c.cidade) AS cidade, coalesce(e.uf, c.uf) AS uf,
            c.data_cadastro, c.canal_origem, coalesce(n, 0) AS qtd_pedidos, coalesce(total, 0) AS ltv, ultima_compra,
            primeira_compra, date_diff('day', ultima_compra, DATE '2001-08-01') AS recencia_dias,
            coalesce(t.saldo_pontos, 0) AS saldo_techpoints, c.ativo
        FROM (SELECT * FROM src_clientes__clientes WHERE cpf <> ''
              QUALIFY row_number() OVER (PARTITION BY cpf ORDER BY data_cadastro, id_cliente) = 1) c
        LEFT JOIN (SELECT id_cliente, count(*) AS n, sum(valor_liquido) AS total, max(CAST(dt_pedido AS DATE)) AS ultima_compra,
                     min(CAST(dt_pedido AS DATE)) AS primeira_compra
                   FROM src_vendas__pedidos WHERE status <> 'cancelado' GROUP BY ALL) p USING (id_cliente)
        LEFT JOIN src_clientes__techpoints t USING (id_cliente)
        LEFT JOIN (SELECT * FROM src_clientes__enderecos WHERE tipo = 'principal'
                   QUALIFY row_number() OVER (PARTITION BY id_cliente ORDER BY updated_at DESC, id_endereco) = 1) e
             USING (id_cliente)) base"""

MODEL_SQL["mod_catalogo"] = f"""
    SELECT p.id_produto, p.sku, p.nome AS nome_produto, p.marca, p.peso_kg, p.ativo, c.id_categoria,
        c.nome AS categoria, c.subcategoria, f.id_fornecedor, f.nome_fornecedor, f.cnpj AS cnpj_fornecedor,
        f.pais_origem, f.prazo_entrega_dias, v.preco_venda AS preco_venda_vigente, v.custo_unitario AS custo_vigente,
        {round4(div('v.preco_venda - v.custo_unitario', 'v.preco_venda'))} AS margem_pct_vigente
    FROM src_produtos__produtos p
    LEFT JOIN src_produtos__categorias c ON c.id_categoria = p.id_categoria
    LEFT JOIN src_produtos__fornecedores f ON f.id_fornecedor = p.id_fornecedor
    LEFT JOIN (SELECT * FROM src_produtos__precos WHERE dt_vigencia_fim IS NULL OR dt_vigencia_fim >= DATE '2001-08-01'
               QUALIFY row_number() OVER (PARTITION BY id_produto ORDER BY dt_vigencia_inicio DESC) = 1) v
         ON v.id_produto = p.id_produto"""

SEGMENT = """CASE
    WHEN score_recencia = 5 AND score_frequencia >= 4 THEN 'Campeoes'
    WHEN score_recencia >= 4 AND score_frequencia >= 3 THEN 'Clientes_Fieis'
    WHEN score_recencia = 5 AND score_frequencia <= 2 THEN 'Novos_Clientes'
    WHEN least(score_recencia, score_frequencia, score_monetario) >= 3 THEN 'Potencial_Fidelizacao'
    WHEN score_recencia >= 4 AND greatest(score_frequencia, score_monetario) <= 2 THEN 'Promissores'
    WHEN score_recencia <= 2 AND least(score_frequencia, score_monetario) >= 4 THEN 'Em_Risco'
    WHEN score_recencia <= 2 AND score_frequencia >= 3 THEN 'Hibernando'
    WHEN greatest(score_recencia, score_frequencia, score_monetario) = 1 THEN 'Perdidos'
    ELSE 'Regulares' END"""

MODEL_SQL["mod_dim_cliente"] = f"""
    SELECT *, md5(CAST(id_cliente AS VARCHAR)) AS sk_cliente, {SEGMENT} AS segmento_rfm FROM mod_clientes"""

MODEL_SQL["mod_venda"] = f"""
    SELECT {md5_of('o.id_pedido', 'i.id_item_pedido')} AS sk_venda,
        {key_or('DESCONHECIDO', 'c.id_cliente')} AS sk_cliente, {key_or('DESCONHECIDO', 'p.id_produto')} AS sk_produto,
        {key_or('DESCONHECIDO', 'l.id_loja')} AS sk_loja, {date_or_unknown('o.dia')} AS sk_tempo,
        md5(o.canal_venda) AS sk_canal_venda, {key_or('SEM_CAMPANHA', 'm.id_campanha')} AS sk_campanha,
        o.id_pedido AS id_pedido_dg, i.id_item_pedido AS id_item_pedido_dg, o.dia AS dt_pedido_data,
        i.qtd_vendida, i.preco_unitario, i.custo_unitario, i.desconto_item, i.valor_liquido_item,
        i.valor_liquido_item - i.qtd_vendida * i.custo_unitario AS margem_bruta_item,
        {round4(div('i.desconto_item', 'i.desconto_item + i.valor_liquido_item'))} AS taxa_desconto_item,
        o.valor_bruto AS valor_bruto_pedido, o.valor_desconto AS valor_desconto_pedido,
        o.valor_frete AS valor_frete_pedido, o.valor_liquido AS valor_liquido_pedido, o.qtd_itens AS qtd_itens_pedido,
        o.parcelas, o.metodo_pagamento, o.status, o.status <> 'cancelado' AND o.status <> 'devolvido' AS fl_venda_valida,
        o.status = 'cancelado' AS fl_cancelado, o.status = 'devolvido' OR o.qtd_devolucoes > 0 AS fl_devolvido,
        o.canal_venda <> 'loja_fisica' AS fl_online, coalesce(k.comissao, 0) AS valor_comissao, o.canal_venda,
        i.id_produto, o.id_loja, o.id_cliente
    FROM mod_pedidos o JOIN mod_itens i ON i.id_pedido = o.id_pedido
    LEFT JOIN mod_clientes c ON c.id_cliente = o.id_cliente
    LEFT JOIN src_produtos__produtos p ON p.id_produto = i.id_produto
    LEFT JOIN src_rh__lojas l ON l.id_loja = o.id_loja
    LEFT JOIN src_marketing__campanhas m ON m.id_campanha = o.id_campanha
    LEFT JOIN (SELECT id_pedido, sum(valor_comissao) AS comissao FROM src_rh__comissoes GROUP BY ALL) k
         ON k.id_pedido = o.id_pedido"""

MODEL_SQL["mod_saldo"] = """
    SELECT * FROM src_estoque__saldo_estoque
    QUALIFY row_number() OVER (PARTITION BY id_produto, id_loja, dt_ultima_atualizacao
        ORDER BY updated_at DESC, id_saldo DESC, qtd_disponivel DESC, qtd_reservada DESC) = 1"""

MODEL_SQL["mod_estoque"] = f"""
    SELECT {md5_of('s.id_produto', 's.id_loja', 's.dt_ultima_atualizacao')} AS sk_estoque,
        {key_or('DESCONHECIDO', 'p.id_produto')} AS sk_produto, {key_or('DESCONHECIDO', 'l.id_loja')} AS sk_loja,
        {date_or_unknown('s.dt_ultima_atualizacao')} AS sk_tempo, s.id_produto AS id_produto_nk, s.id_loja AS id_loja_nk,
        s.dt_ultima_atualizacao, qtd_disponivel, qtd_reservada, qtd_minima, qtd_disponivel + qtd_reservada AS qtd_total,
        qtd_disponivel <= qtd_minima AS fl_estoque_critico, qtd_disponivel = 0 AS fl_ruptura,
        coalesce(entrada, 0) AS qtd_entrada_dia, coalesce(saida, 0) AS qtd_saida_dia, coalesce(pedidos, 0) AS qtd_pedidos_movs
    FROM mod_saldo s
    LEFT JOIN (SELECT id_produto, id_loja, CAST(dt_movimentacao AS DATE) AS dia, sum(greatest(qtd, 0)) AS entrada,
                 -sum(least(qtd, 0)) AS saida, count(DISTINCT id_pedido) AS pedidos
               FROM src_estoque__movimentacoes GROUP BY ALL) v
         ON v.id_produto = s.id_produto AND v.id_loja = s.id_loja AND v.dia = s.dt_ultima_atualizacao
    LEFT JOIN src_produtos__produtos p ON p.id_produto = s.id_produto
    LEFT JOIN src_rh__lojas l ON l.id_loja = s.id_loja"""

MODEL_SQL["mod_entrega"] = f"""
    SELECT md5(CAST(e.id_entrega AS VARCHAR)) AS sk_entrega, {key_or('DESCONHECIDO', 'c.id_cliente')} AS sk_cliente,
        {key_or('DESCONHECIDO', 'l.id_loja')} AS sk_loja, {key_or('DESCONHECIDO', 't.id_transportadora')} AS sk_transportadora,
        {key_or('DESCONHECIDO', 'm.id_modalidade')} AS sk_modalidade_entrega,
        coalesce({date_or_unknown('e.dt_postagem')}, -1) AS sk_tempo_postagem, e.id_entrega AS id_entrega_dg,
        e.id_pedido AS id_pedido_dg, e.codigo_rastreio, e.dt_postagem, e.dt_promessa, e.dt_efetiva,
        date_diff('day', e.dt_postagem, e.dt_promessa) AS lead_time_prometido_dias,
        date_diff('day', e.dt_postagem, e.dt_efetiva) AS lead_time_real_dias,
        date_diff('day', e.dt_promessa, e.dt_efetiva) AS atraso_dias, e.fl_sla_atendido,
        e.status = 'entregue' AS fl_entregue, e.status, o.canal_venda, t.nome AS transportadora, l.tipo_loja
    FROM src_logistica__entregas e LEFT JOIN src_vendas__pedidos o ON o.id_pedido = e.id_pedido
    LEFT JOIN mod_clientes c ON c.id_cliente = o.id_cliente
    LEFT JOIN src_rh__lojas l ON l.id_loja = e.id_loja_origem
    LEFT JOIN src_logistica__transportadoras t ON t.id_transportadora = e.id_transportadora
    LEFT JOIN src_logistica__modalidades m ON m.id_modalidade = e.id_modalidade"""


def ledger_sql(receivables: str) -> str:
    return f"""
    SELECT md5(CAST(x.id_lancamento AS VARCHAR)) AS sk_lancamento, {key_or('DESCONHECIDO', 'l.id_loja')} AS sk_loja,
        {date_or_unknown('x.dt_competencia')} AS sk_tempo_competencia, x.id_lancamento AS id_lancamento_dg,
        x.id_pedido AS id_pedido_dg, x.tipo, x.valor, x.dt_lancamento, x.dt_competencia, x.descricao,
        CASE WHEN x.tipo = 'receita' THEN x.valor ELSE -x.valor END AS valor_sinal, r.status AS status_cr,
        r.dt_pagamento, r.valor_pago, r.status = 'pago' AS fl_pago
    FROM src_financeiro__lancamentos x LEFT JOIN ({receivables}) r ON r.id_pedido = x.id_pedido
    LEFT JOIN src_rh__lojas l ON l.id_loja = x.id_loja"""


MODEL_SQL["mod_financeiro"] = ledger_sql("""SELECT * FROM src_financeiro__contas_receber
    QUALIFY row_number() OVER (PARTITION BY id_pedido ORDER BY dt_vencimento DESC, id_conta DESC) = 1""")

MODEL_SQL["mod_sessao"] = f"""
    SELECT md5(CAST(s.id_sessao AS VARCHAR)) AS sk_sessao, {key_or('ANONIMO', 'c.id_cliente')} AS sk_cliente,
        {date_or_unknown('CAST(s.dt_inicio AS DATE)')} AS sk_tempo, s.id_sessao AS id_sessao_dg, s.id_pedido AS id_pedido_dg,
        s.canal_origem, s.device_type, s.paginas_visitadas,
        (epoch_us(s.dt_fim) - epoch_us(s.dt_inicio)) / 60000000.0::DOUBLE AS duracao_min, s.converteu,
        coalesce(produtos, 0) AS qtd_produtos_vistos, coalesce(adds, 0) AS qtd_add_cart,
        coalesce(removes, 0) AS qtd_remove_cart, coalesce(compras, 0) AS qtd_compras,
        adds > 0 AND NOT s.converteu AS fl_abandono_carrinho, CAST(s.dt_inicio AS DATE) AS dt_sessao
    FROM src_web_analytics__sessoes s
    LEFT JOIN (SELECT id_sessao, count(DISTINCT id_produto) AS produtos,
                 count(*) FILTER (tipo_evento = 'add_to_cart') AS adds,
                 count(*) FILTER (tipo_evento = 'remove_from_cart') AS removes,
                 count(*) FILTER (tipo_evento = 'purchase') AS compras
               FROM src_web_analytics__eventos_carrinho GROUP BY ALL) v ON v.id_sessao = s.id_sessao
    LEFT JOIN mod_clientes c ON c.id_cliente = s.id_cliente"""

MODEL_SQL["mod_orcamento"] = f"""
    SELECT *, {round4(div('receita_realizada', 'valor_meta_receita') + ' - 1')} AS var_receita_pct,
        {round4(div('margem_realizada', 'valor_meta_margem') + ' - 1')} AS var_margem_pct,
        receita_realizada >= valor_meta_receita AS fl_meta_receita_atingida,
        qtd_pedidos_realizados >= qtd_meta_pedidos AS fl_meta_pedidos_atingida
    FROM (SELECT md5(CAST(b.id_orcamento AS VARCHAR)) AS sk_orcamento, {key_or('DESCONHECIDO', 'l.id_loja')} AS sk_loja,
            {date_or_unknown('make_date(b.ano, b.mes, 1)')} AS sk_tempo, b.id_orcamento AS id_orcamento_dg,
            b.id_loja AS id_loja_nk, b.canal_venda, b.ano, b.mes, make_date(b.ano, b.mes, 1) AS dt_inicio_mes,
            b.valor_meta_receita, b.valor_meta_margem, b.qtd_meta_pedidos, coalesce(receita, 0) AS receita_realizada,
            coalesce(margem, 0) AS margem_realizada, coalesce(pedidos, 0) AS qtd_pedidos_realizados
          FROM src_financeiro__orcamentos b
          LEFT JOIN (SELECT id_loja, canal_venda, year(dt_pedido_data) AS ano, month(dt_pedido_data) AS mes,
                       sum(valor_liquido_item) AS receita, sum(margem_bruta_item) AS margem,
                       count(DISTINCT id_pedido_dg) AS pedidos
                     FROM mod_venda WHERE fl_venda_valida AND sk_loja <> 'DESCONHECIDO' GROUP BY ALL) r
               USING (id_loja, canal_venda, ano, mes)
          LEFT JOIN src_rh__lojas l ON l.id_loja = b.id_loja) t"""


# -- staging -----------------------------------------------------------------

_items = TABLES_BY_NAME["vendas.itens_pedido"].widened()
_balances = TABLES_BY_NAME["estoque.saldo_estoque"].widened()
_people = TABLES_BY_NAME["clientes.clientes"].widened()


@query(
    "stg_dedup_latest",
    "id_item_pedido:l id_pedido:l id_produto:l qtd_vendida:l preco_unitario:d custo_unitario:d desconto_item:d "
    "valor_liquido_item:d",
    "SELECT * FROM mod_itens",
)
def stg_dedup_latest(m):
    return build_staging(m.source("vendas.itens_pedido"), _items)


@query(
    "stg_dedup_composite",
    "id_saldo:l id_produto:l id_loja:l qtd_disponivel:l qtd_reservada:l qtd_minima:l dt_ultima_atualizacao:s",
    """SELECT * FROM src_estoque__saldo_estoque QUALIFY row_number() OVER (PARTITION BY id_produto, id_loja
       ORDER BY updated_at DESC, id_saldo DESC, qtd_disponivel DESC, qtd_reservada DESC) = 1""",
)
def stg_dedup_composite(m):
    return build_staging(m.source("estoque.saldo_estoque"), _balances)


@query(
    "stg_typed_projection",
    "id_cliente:l cpf:s email:s telefone:s nome_completo:s cidade:s uf:s data_cadastro:s ativo:b",
    """SELECT c_custkey AS id_cliente, lower(trim('  X' || CAST(c_custkey AS VARCHAR) || ' ')) AS cpf,
         lower(c_name) AS email, 'x' AS telefone, c_name AS nome_completo, c_mktsegment AS cidade, 'SP' AS uf,
         DATE '1995-01-01' AS data_cadastro, c_acctbal > 0 AS ativo FROM customer""",
)
def stg_typed_projection(m):
    """Text clean-up and casts of the customer table, ids arriving as double as after a NULL in a batch."""
    raw = m["customer"].select(
        F.col("c_custkey").cast("double").alias("id_cliente"),
        F.concat(F.lit("  X"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("cpf"),
        F.concat(F.lit(" "), F.upper("c_name")).alias("email"),
        F.lit(" x ").alias("telefone"),
        F.lit("Cliente").alias("primeiro_nome"),
        F.concat("c_name", F.lit("  ")).alias("nome_completo"),
        F.lit("1").alias("cep"),
        F.concat(F.lit(" "), "c_mktsegment").alias("cidade"),
        F.lit(" sp ").alias("uf"),
        F.lit("1995-01-01").alias("data_cadastro"),
        F.lit(None).cast("string").alias("canal_origem"),
        F.lit("Bronze").alias("nivel_fidelidade"),
        (F.col("c_acctbal") > 0).alias("ativo"),
        F.lit("1995-01-01 00:00:00").alias("created_at"),
        F.lit("1995-01-01 00:00:00").alias("updated_at"),
        F.lit("1995-01-02 00:00:00").alias("_ingested_at"),
    )
    return build_staging(raw, _people)


# -- silver and dimensions ---------------------------------------------------


@query(
    "order_unified",
    "id_pedido:l id_cliente:l id_loja:l canal_venda:s status:s dt_pedido_data:s valor_bruto:d valor_desconto:d "
    "valor_frete:d valor_liquido:d qtd_itens:l qtd_total_produtos:l custo_total:d margem_bruta:d taxa_desconto:d "
    "parcelas:l metodo_pagamento:s cupom:s id_campanha:l qtd_devolucoes:l valor_devolvido_total:d",
    "SELECT *, dia AS dt_pedido_data FROM mod_pedidos",
)
def order_unified(m):
    return m["int_vendas__pedidos_unificados"]


@query(
    "customer_unified_rfm",
    "id_cliente:l cpf:s email:s nome_completo:s cep:s cidade:s uf:s data_cadastro:s canal_origem:s nivel_fidelidade:s "
    "qtd_pedidos:l ltv:d ultima_compra:s primeira_compra:s recencia_dias:l score_recencia:l score_frequencia:l "
    "score_monetario:l saldo_techpoints:l ativo:b",
    "SELECT * FROM mod_clientes",
)
def customer_unified_rfm(m):
    return m["int_clientes__unificados"]


PRODUCT = ("sku:s nome_produto:s marca:s peso_kg:d ativo:b id_categoria:l categoria:s subcategoria:s nome_fornecedor:s "
           "cnpj_fornecedor:s pais_origem:s prazo_entrega_dias:l preco_venda_vigente:d custo_vigente:d "
           "margem_pct_vigente:d")


@query("product_catalog", f"id_produto:l id_fornecedor:l {PRODUCT}", "SELECT * FROM mod_catalogo")
def product_catalog(m):
    return m["int_produtos__catalogo"]


VERSION = "valid_from:s valid_to:s fl_current:b hash_row:s"
VERSION_SQL = "DATE '9999-12-31' AS valid_to, true AS fl_current"


@query(
    "dim_product",
    f"sk_produto:s id_produto_nk:l {PRODUCT} {VERSION}",
    f"""SELECT *, md5(CAST(id_produto AS VARCHAR)) AS sk_produto, id_produto AS id_produto_nk,
        DATE '2001-07-31' AS valid_from, {VERSION_SQL},
        {hash_of('preco_venda_vigente', 'custo_vigente', 'ativo')} AS hash_row FROM mod_catalogo""",
)
def dim_product(m):
    return m["dim_produto"]


@query(
    "dim_customer_scd",
    "sk_cliente:s id_cliente_nk:l cpf:s uf:s nivel_fidelidade:s qtd_pedidos:l ltv:d segmento_rfm:s saldo_techpoints:l "
    "ativo:b " + VERSION,
    f"""SELECT *, id_cliente AS id_cliente_nk, data_cadastro AS valid_from, {VERSION_SQL},
        {hash_of('nivel_fidelidade', 'CAST(ltv AS DECIMAL(22,2))', 'qtd_pedidos', 'uf')} AS hash_row
        FROM mod_dim_cliente""",
)
def dim_customer_scd(m):
    return m["dim_cliente"]


@query(
    "dim_store_flags",
    "sk_loja:s id_loja_nk:l codigo:s nome_loja:s tipo_loja:s regiao:s uf:s gerente:s capacidade_m2:l dt_abertura:s "
    "fl_loja_fisica:b fl_ecommerce:b pedidos:l " + VERSION,
    f"""SELECT l.*, md5(CAST(l.id_loja AS VARCHAR)) AS sk_loja, l.id_loja AS id_loja_nk,
        l.tipo_loja = 'fisica' AS fl_loja_fisica, l.tipo_loja = 'ecommerce' AS fl_ecommerce,
        l.dt_abertura AS valid_from, {VERSION_SQL}, {hash_of('l.gerente', 'l.ativo', 'l.nome_loja')} AS hash_row,
        coalesce(p.pedidos, 0) AS pedidos
        FROM src_rh__lojas l
        LEFT JOIN (SELECT id_loja, count(*) AS pedidos FROM src_vendas__pedidos GROUP BY ALL) p ON p.id_loja = l.id_loja""",
)
def dim_store_flags(m):
    """Stores with the orders each received."""
    orders = m["stg_vendas__pedidos"].groupBy("id_loja").agg(F.count(F.lit(1)).alias("pedidos"))
    stores = m["dim_loja"].join(orders, F.col("id_loja_nk") == F.col("id_loja"), "left")
    return stores.withColumn("pedidos", F.coalesce("pedidos", F.lit(0)))


@query(
    "dim_seller",
    "sk_vendedor:s id_vendedor_nk:l nome:s cargo:s data_admissao:s ativo:b id_loja:l nome_loja:s regiao:s uf:s " + VERSION,
    f"""SELECT v.*, md5(CAST(id_vendedor AS VARCHAR)) AS sk_vendedor, id_vendedor AS id_vendedor_nk, l.nome_loja,
        l.regiao, l.uf, data_admissao AS valid_from, {VERSION_SQL},
        {hash_of('v.cargo', 'v.ativo', 'v.id_loja')} AS hash_row
        FROM src_rh__vendedores v LEFT JOIN src_rh__lojas l ON l.id_loja = v.id_loja""",
)
def dim_seller(m):
    return m["dim_vendedor"]


@query(
    "dim_supplier",
    "sk_fornecedor:s id_fornecedor_nk:l nome_fornecedor:s cnpj:s pais_origem:s prazo_entrega_dias:l ativo:b fl_importado:b",
    """SELECT *, md5(CAST(id_fornecedor AS VARCHAR)) AS sk_fornecedor, id_fornecedor AS id_fornecedor_nk,
        NOT pais_origem = 'Brasil' AS fl_importado FROM src_produtos__fornecedores""",
)
def dim_supplier(m):
    return m["dim_fornecedor"]


@query(
    "dim_carrier_avg",
    "sk_transportadora:s id_transportadora_nk:l nome:s prazo_dias_min:l prazo_dias_max:l prazo_medio_dias:d ativo:b",
    """SELECT *, md5(CAST(id_transportadora AS VARCHAR)) AS sk_transportadora, id_transportadora AS id_transportadora_nk,
        (prazo_dias_min + prazo_dias_max) * 0.5 AS prazo_medio_dias FROM src_logistica__transportadoras""",
)
def dim_carrier_avg(m):
    return m["dim_transportadora"]


@query(
    "dim_delivery_mode",
    "sk_modalidade_entrega:s id_modalidade_nk:l codigo:s nome_modalidade:s tipo:s prazo_dias:l frete_base:d "
    "nome_transportadora:s fl_retirada_loja:b entregas:l",
    """SELECT md5(CAST(m.id_modalidade AS VARCHAR)) AS sk_modalidade_entrega, m.id_modalidade AS id_modalidade_nk,
        m.codigo, m.nome AS nome_modalidade, m.tipo, m.prazo_dias, m.frete_base, t.nome AS nome_transportadora,
        m.tipo = 'loja' AND m.frete_base = 0 AS fl_retirada_loja, coalesce(e.n, 0) AS entregas
        FROM src_logistica__modalidades m
        LEFT JOIN src_logistica__transportadoras t ON t.id_transportadora = m.id_transportadora
        LEFT JOIN (SELECT id_modalidade, count(*) AS n FROM src_logistica__entregas GROUP BY ALL) e
             ON e.id_modalidade = m.id_modalidade""",
)
def dim_delivery_mode(m):
    """Delivery modes with the deliveries made by each."""
    used = m["stg_logistica__entregas"].groupBy("id_modalidade").agg(F.count(F.lit(1)).alias("entregas"))
    modes = m["dim_modalidade_entrega"].join(used, F.col("id_modalidade_nk") == F.col("id_modalidade"), "left")
    return modes.withColumn("entregas", F.coalesce("entregas", F.lit(0)))


@query(
    "dim_campaign_days",
    "sk_campanha:s id_campanha_nk:l nome:s dt_inicio:s dt_fim:s duracao_dias:l orcamento:d ano_campanha:l " + VERSION,
    f"""SELECT *, md5(CAST(id_campanha AS VARCHAR)) AS sk_campanha, id_campanha AS id_campanha_nk,
        date_diff('day', dt_inicio, dt_fim) + 1 AS duracao_dias, year(dt_inicio) AS ano_campanha,
        dt_inicio AS valid_from, {VERSION_SQL}, {hash_of('nome', 'ativo', 'orcamento')} AS hash_row
        FROM src_marketing__campanhas""",
)
def dim_campaign_days(m):
    return m["dim_campanha"]


# -- facts -------------------------------------------------------------------

SALES_COLUMNS = (
    "sk_venda:s sk_cliente:s sk_produto:s sk_loja:s sk_tempo:l sk_canal_venda:s sk_campanha:s id_pedido_dg:l "
    "id_item_pedido_dg:l dt_pedido_data:s qtd_vendida:l preco_unitario:d custo_unitario:d desconto_item:d "
    "valor_liquido_item:d margem_bruta_item:d taxa_desconto_item:d valor_bruto_pedido:d valor_desconto_pedido:d "
    "valor_frete_pedido:d valor_liquido_pedido:d qtd_itens_pedido:l parcelas:l metodo_pagamento:s status:s "
    "fl_venda_valida:b fl_cancelado:b fl_devolvido:b fl_online:b valor_comissao:d canal_venda:s"
)


@query("fact_sales", SALES_COLUMNS, "SELECT * FROM mod_venda")
def fact_sales(m):
    return m["fato_venda"]


@query(
    "fact_stock",
    "sk_estoque:s sk_produto:s sk_loja:s sk_tempo:l id_produto_nk:l id_loja_nk:l dt_ultima_atualizacao:s "
    "qtd_disponivel:l qtd_reservada:l qtd_minima:l qtd_total:l fl_estoque_critico:b fl_ruptura:b qtd_entrada_dia:l "
    "qtd_saida_dia:l qtd_pedidos_movs:l",
    "SELECT * FROM mod_estoque",
)
def fact_stock(m):
    return m["fato_estoque"]


@query(
    "fact_delivery",
    "sk_entrega:s sk_cliente:s sk_loja:s sk_transportadora:s sk_modalidade_entrega:s sk_tempo_postagem:l "
    "id_entrega_dg:l id_pedido_dg:l codigo_rastreio:s dt_postagem:s dt_promessa:s dt_efetiva:s "
    "lead_time_prometido_dias:l lead_time_real_dias:l atraso_dias:l fl_sla_atendido:b fl_entregue:b status:s canal_venda:s",
    "SELECT * FROM mod_entrega",
)
def fact_delivery(m):
    return m["fato_entrega"]


LEDGER_COLUMNS = (
    "sk_lancamento:s sk_loja:s sk_tempo_competencia:l id_lancamento_dg:l id_pedido_dg:l tipo:s valor:d dt_lancamento:s "
    "dt_competencia:s descricao:s valor_sinal:d status_cr:s dt_pagamento:s valor_pago:d fl_pago:b"
)


@query("fact_ledger", LEDGER_COLUMNS, "SELECT * FROM mod_financeiro")
def fact_ledger(m):
    return m["fato_financeiro"]


@query("fact_ledger_fan_out", LEDGER_COLUMNS, ledger_sql("SELECT * FROM src_financeiro__contas_receber"))
def fact_ledger_fan_out(m):
    return facts.build_ledger(m, replace(m.cfg, fan_out=True))


@query(
    "fact_session",
    "sk_sessao:s sk_cliente:s sk_tempo:l id_sessao_dg:l id_pedido_dg:l canal_origem:s device_type:s paginas_visitadas:l "
    "duracao_min:d converteu:b qtd_produtos_vistos:l qtd_add_cart:l qtd_remove_cart:l qtd_compras:l "
    "fl_abandono_carrinho:b dt_sessao:s",
    "SELECT * FROM mod_sessao",
)
def fact_session(m):
    return m["fato_cliente_interacao"]


@query(
    "fact_budget",
    "sk_orcamento:s sk_loja:s sk_tempo:l id_orcamento_dg:l id_loja_nk:l canal_venda:s ano:l mes:l dt_inicio_mes:s "
    "valor_meta_receita:d valor_meta_margem:d qtd_meta_pedidos:l receita_realizada:d margem_realizada:d "
    "qtd_pedidos_realizados:l var_receita_pct:d var_margem_pct:d fl_meta_receita_atingida:b fl_meta_pedidos_atingida:b",
    "SELECT * FROM mod_orcamento",
)
def fact_budget(m):
    return m["fato_orcamento"]
