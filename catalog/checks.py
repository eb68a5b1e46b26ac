"""Quality rules, freshness, reconciliation and privacy jobs."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from emporio import privacy
from emporio.quality import freshness, reconcile, rules


def _bad(rule: str, table: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) AS violations FROM {table} WHERE {condition}"


def _repeated(column: str, table: str) -> str:
    return (f"SELECT 'unique:{column}' AS rule, count(*) AS violations FROM (SELECT {column} FROM {table} "
            f"WHERE {column} IS NOT NULL GROUP BY ALL HAVING count(*) > 1) u")


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


ORDER_CHECKS = " UNION ALL ".join(
    [_bad(f"not_null:{c}", "src_vendas__pedidos", f"{c} IS NULL")
     for c in ("id_pedido", "id_cliente", "id_loja", "canal_venda", "status", "valor_liquido", "updated_at")]
    + [_repeated("id_pedido", "src_vendas__pedidos"),
       _bad("accepted:canal_venda", "src_vendas__pedidos", f"canal_venda NOT IN ({_in(rules.CHANNELS)})"),
       _bad("accepted:status", "src_vendas__pedidos", f"status NOT IN ({_in(rules.ORDER_STATUS)})")]
)
# Un-deduplicated rows, so uniqueness really fails.
RETURN_CHECKS = " UNION ALL ".join(
    [_bad("not_null:id_devolucao", "src_vendas__devolucoes", "id_devolucao IS NULL"),
     _repeated("id_devolucao", "src_vendas__devolucoes"),
     _bad("not_null:id_pedido", "src_vendas__devolucoes", "id_pedido IS NULL"),
     _bad("accepted:status", "src_vendas__devolucoes", "status NOT IN ('aprovada', 'em_analise', 'rejeitada')")]
)
ITEM_CHECKS = " UNION ALL ".join(
    [_bad(f"not_null:{c}", "mod_itens", f"{c} IS NULL")
     for c in ("id_item_pedido", "id_pedido", "id_produto", "qtd_vendida", "valor_liquido_item")]
    + [_repeated("id_item_pedido", "mod_itens")]
)


@query(
    "quality_rules",
    "tabela:s rule:s violations:l passed:b",
    f"""SELECT *, violations = 0 AS passed FROM (
          SELECT 'stg_vendas__pedidos' AS tabela, * FROM ({ORDER_CHECKS}) a
          UNION ALL SELECT 'stg_vendas__devolucoes', * FROM ({RETURN_CHECKS}) b
          UNION ALL SELECT 'stg_vendas__itens_pedido', * FROM ({ITEM_CHECKS}) c) t""",
)
def quality_rules(m):
    names = ("stg_vendas__pedidos", "stg_vendas__devolucoes", "stg_vendas__itens_pedido")
    return rules.check_models({n: m[n] for n in names}).withColumnRenamed("table", "tabela")


@query(
    "quality_batches",
    "lote:s linhas:l passed:b",
    """SELECT CAST(o_orderdate AS DATE) AS lote, count(*) AS linhas, count(*) % 7 <> 0 AS passed FROM orders GROUP BY ALL""",
)
def quality_batches(m):
    """Orders as daily batches whose recorded size is wrong when it is a multiple of seven."""
    daily = m["orders"].groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n"))
    batches = m["orders"].join(daily, "o_orderdate").select(
        F.lit("vendas").alias("_source_schema"),
        F.lit("pedidos").alias("_source_table"),
        F.col("o_orderdate").alias("_ingested_at"),
        F.when(F.col("n") % 7 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("_row_count_batch"),
    )
    return rules.check_batches(batches).select(
        F.to_date("_ingested_at").alias("lote"), F.col("rows").alias("linhas"), "passed"
    )


@query(
    "freshness",
    "check:s severity:s observed:s expected:s passed:b",
    """SELECT 'gold:' || f AS "check", 'error' AS severity, CAST(k AS VARCHAR) AS observed, '>= 20010730' AS expected,
         k >= 20010730 AS passed
       FROM (SELECT 'fato_venda' AS f, max(sk_tempo) AS k FROM mod_venda
             UNION ALL SELECT 'fato_entrega', max(sk_tempo_postagem) FROM mod_entrega
             UNION ALL SELECT 'fato_financeiro', max(sk_tempo_competencia) FROM mod_financeiro
             UNION ALL SELECT 'fato_cliente_interacao', max(sk_tempo) FROM mod_sessao) t""",
)
def gold_freshness(m):
    names = ("fato_venda", "fato_entrega", "fato_financeiro", "fato_cliente_interacao")
    return freshness.gold_freshness({n: m[n] for n in names}, datetime(2001, 8, 1, 1, 0))


@query(
    "volume_range",
    "dia:s linhas:l faixa:s",
    """SELECT CAST(ts AS DATE) AS dia, count(*) AS linhas, CASE WHEN count(*) < 300 THEN 'abaixo'
         WHEN count(*) > 350 THEN 'acima' ELSE 'ok' END AS faixa FROM events GROUP BY ALL""",
)
def volume_range(m):
    """Events per day against an expected range."""
    n = F.count(F.lit(1))
    days = m["events"].groupBy(F.to_date("ts").alias("dia")).agg(n.alias("linhas"))
    return days.withColumn("faixa", freshness.volume_verdict(F.col("linhas"), 300, 350))


RECONCILE_SQL = """
    SELECT *, CASE WHEN source_value IS NULL OR source_value = 0
                     THEN CASE WHEN gold_value IS NULL OR gold_value = 0 THEN 0 ELSE CAST('inf' AS DOUBLE) END
                   WHEN gold_value IS NULL THEN CAST('inf' AS DOUBLE)
                   ELSE abs(gold_value - source_value) / abs(source_value) END AS deviation
    FROM (
      SELECT 'fato_venda.max_data' AS "check", (SELECT CAST(strftime(max(dt_pedido_data), '%Y%m%d') AS DOUBLE) FROM mod_venda WHERE fl_venda_valida) AS gold_value,
        (SELECT CAST(strftime(max(dt_pedido), '%Y%m%d') AS DOUBLE) FROM src_vendas__pedidos WHERE status NOT IN ('cancelado', 'devolvido')) AS source_value, 0.0 AS tolerance
      UNION ALL SELECT 'fato_estoque.count', (SELECT CAST(count(*) AS DOUBLE) FROM mod_estoque WHERE sk_tempo = (SELECT max(sk_tempo) FROM mod_estoque)),
        (SELECT CAST(count(*) AS DOUBLE) FROM src_estoque__saldo_estoque WHERE qtd_disponivel >= 0), 0.0
      UNION ALL SELECT 'fato_entrega.count', (SELECT CAST(count(*) AS DOUBLE) FROM mod_entrega WHERE dt_postagem >= DATE '2001-07-29'),
        (SELECT CAST(count(*) AS DOUBLE) FROM src_logistica__entregas WHERE dt_postagem >= DATE '2001-07-29'), 0.0
      UNION ALL SELECT 'fato_financeiro.count', (SELECT CAST(count(*) AS DOUBLE) FROM mod_financeiro WHERE dt_lancamento >= DATE '2001-07-29'),
        (SELECT CAST(count(*) AS DOUBLE) FROM src_financeiro__lancamentos WHERE dt_lancamento >= DATE '2001-07-29'), 0.0
      UNION ALL SELECT 'fato_financeiro.valor', (SELECT CAST(sum(valor) AS DOUBLE) FROM mod_financeiro WHERE dt_lancamento >= DATE '2001-07-29'),
        (SELECT CAST(sum(valor) AS DOUBLE) FROM src_financeiro__lancamentos WHERE dt_lancamento >= DATE '2001-07-29'), 0.001
      UNION ALL SELECT 'fato_cliente_interacao.count_sessoes', (SELECT CAST(count(*) AS DOUBLE) FROM mod_sessao WHERE dt_sessao >= DATE '2001-07-29'),
        (SELECT CAST(count(*) AS DOUBLE) FROM src_web_analytics__sessoes WHERE dt_inicio >= TIMESTAMP '2001-07-29'), 0.0
      UNION ALL SELECT 'fato_orcamento.count', (SELECT CAST(count(*) AS DOUBLE) FROM mod_orcamento), (SELECT CAST(count(*) AS DOUBLE) FROM src_financeiro__orcamentos), 0.0
      UNION ALL SELECT 'fato_orcamento.receita_meta', (SELECT CAST(sum(valor_meta_receita) AS DOUBLE) FROM mod_orcamento),
        (SELECT CAST(sum(valor_meta_receita) AS DOUBLE) FROM src_financeiro__orcamentos), 0.001) t"""


@query(
    "reconcile",
    "check:s gold_value:d source_value:d tolerance:d deviation:d passed:b",
    f"SELECT *, deviation <= tolerance AS passed FROM ({RECONCILE_SQL}) r",
)
def reconcile_all(m):
    """All eight checks; the stock count fails, as a history has more rows than its newest day."""
    facts = ("fato_venda", "fato_estoque", "fato_entrega", "fato_financeiro", "fato_cliente_interacao", "fato_orcamento")
    sources = ("vendas.pedidos", "estoque.saldo_estoque", "logistica.entregas", "financeiro.lancamentos",
               "web_analytics.sessoes", "financeiro.orcamentos")
    return reconcile.reconcile({n: m[n] for n in facts}, {n: m.source(n) for n in sources}, date(2001, 7, 31))


PERSON = "00000000048"


@query(
    "erasure",
    "id_cliente:l cpf:s email:s nome_completo:s cep:s uf:s data_cadastro:s",
    f"""SELECT * REPLACE (
          CASE WHEN cpf = '{PERSON}' THEN '[REMOVIDO]' ELSE email END AS email,
          CASE WHEN cpf = '{PERSON}' THEN '[REMOVIDO]' ELSE nome_completo END AS nome_completo,
          CASE WHEN cpf = '{PERSON}' THEN '[REMOVIDO]' ELSE cep END AS cep,
          CASE WHEN cpf = '{PERSON}' THEN '[REMOVIDO]' ELSE cpf END AS cpf) FROM src_clientes__clientes""",
)
def erasure(m):
    """One person (two customer rows) blanked, everyone else unchanged."""
    tables = {"clientes": m["stg_clientes__clientes"]}
    return privacy.erase(tables, PERSON, dry_run=False)["clientes"]


@query(
    "retention_cut",
    "id_pedido:l dia:s",
    """SELECT id_pedido, CAST(dt_pedido AS DATE) AS dia FROM src_vendas__pedidos WHERE dt_pedido >= TIMESTAMP '1998-07-31'""",
)
def retention_cut(m):
    orders = m["stg_vendas__pedidos"].select("id_pedido", F.to_date("dt_pedido").alias("dia"))
    return privacy.cut_retention(orders, "dia", 3, date(2001, 7, 31))


@query(
    "subject_export",
    "id_pedido:l id_cliente:l valor_liquido:d",
    f"""SELECT id_pedido, id_cliente, valor_liquido FROM src_vendas__pedidos
        WHERE id_cliente IN (SELECT id_cliente FROM src_clientes__clientes WHERE cpf = '{PERSON}')""",
)
def subject_export(m):
    """Every order of one person."""
    people = m["stg_clientes__clientes"]
    return privacy.subject_rows({"pedidos": m["stg_vendas__pedidos"]}, people, PERSON)["pedidos"]


SECRET = "a test key, not a secret"


def hmac_sql(value: str, key: str = SECRET) -> str:
    """HMAC-SHA256 of a text in hex, by its definition."""
    padded = key.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in padded).hex() for x in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({value}))))"


@query(
    "pseudonymise",
    "id_cliente:l cpf:s email:s uf:s",
    f"SELECT id_cliente, {hmac_sql('cpf')} AS cpf, {hmac_sql('email')} AS email, uf FROM src_clientes__clientes",
)
def pseudonymise(m):
    """Person numbers and addresses replaced by keyed digests."""
    return privacy.pseudonymise(m["stg_clientes__clientes"], ["cpf", "email"], SECRET)


# People with an order that was given back: every one of them asks to be forgotten.
ERASED_SQL = """SELECT DISTINCT cpf FROM src_clientes__clientes JOIN src_vendas__pedidos USING (id_cliente) WHERE status = 'devolvido'"""
TOMBSTONE_SQL = f"'[REMOVIDO:' || left({hmac_sql('cpf')}, 16) || ']'"


def _erased_keys(m):
    people = m["stg_clientes__clientes"].join(m["stg_vendas__pedidos"].filter("status = 'devolvido'").select("id_cliente"), "id_cliente", "left_semi")
    frames = {n: m.source(n) for n in ("clientes.clientes", "vendas.pedidos", "web_analytics.sessoes")}
    return privacy.subject_keys(frames, people.select("cpf"), SECRET)


@query(
    "erasure_closure",
    "tabela:s id:l cpf:s cep:s cidade:s",
    f"""WITH pessoas AS (SELECT id_cliente, cpf, {TOMBSTONE_SQL} AS lapide FROM src_clientes__clientes WHERE cpf IN ({ERASED_SQL}))
        SELECT 'clientes' AS tabela, id_cliente AS id, lapide AS cpf, CASE WHEN c.cep IS NOT NULL THEN '[REMOVIDO]' END AS cep,
          CASE WHEN c.cidade IS NOT NULL THEN '[REMOVIDO]' END AS cidade
        FROM src_clientes__clientes c JOIN (SELECT id_cliente, lapide FROM pessoas) p USING (id_cliente)
        UNION ALL
        SELECT 'enderecos', id_endereco, NULL, CASE WHEN e.cep IS NOT NULL THEN '[REMOVIDO]' END, CASE WHEN e.cidade IS NOT NULL THEN '[REMOVIDO]' END
        FROM src_clientes__enderecos e JOIN (SELECT id_cliente FROM pessoas) p USING (id_cliente)""",
)
def erasure_closure(m):
    """People and their addresses, which know the customer only, blanked; each person keeps a tombstone of their own."""
    frames = {"clientes": m.source("clientes.clientes"), "enderecos": m.source("clientes.enderecos")}
    done = privacy.erase_subjects(frames, _erased_keys(m))
    people = done["clientes"].select(F.lit("clientes").alias("tabela"), F.col("id_cliente").alias("id"), "cpf", "cep", "cidade")
    homes = done["enderecos"].select(F.lit("enderecos").alias("tabela"), F.col("id_endereco").alias("id"), F.lit(None).cast("string").alias("cpf"), "cep", "cidade")
    return people.unionByName(homes)


@query(
    "subject_closure",
    "tabela:s pessoa:s linhas:l",
    f"""WITH pessoas AS (SELECT DISTINCT id_cliente, {TOMBSTONE_SQL} AS pessoa FROM src_clientes__clientes WHERE cpf IN ({ERASED_SQL})),
          pedidos AS (SELECT DISTINCT id_pedido, pessoa FROM src_vendas__pedidos JOIN pessoas USING (id_cliente)),
          sessoes AS (SELECT DISTINCT id_sessao, pessoa FROM src_web_analytics__sessoes JOIN pessoas USING (id_cliente))
        SELECT 'itens' AS tabela, pessoa, count(*) AS linhas FROM src_vendas__itens_pedido JOIN pedidos USING (id_pedido) GROUP BY ALL
        UNION ALL SELECT 'entregas', pessoa, count(*) FROM src_logistica__entregas JOIN pedidos USING (id_pedido) GROUP BY ALL
        UNION ALL SELECT 'eventos', pessoa, count(*) FROM src_web_analytics__eventos_carrinho JOIN sessoes USING (id_sessao) GROUP BY ALL
        UNION ALL SELECT 'vendas', pessoa, count(*) FROM mod_venda JOIN (SELECT md5(CAST(id_cliente AS VARCHAR)) AS sk_cliente, pessoa FROM pessoas) p
          USING (sk_cliente) GROUP BY ALL""",
)
def subject_closure(m):
    """Rows of each erased person in tables that know orders, sessions or surrogate keys only."""
    frames = {
        "itens": m.source("vendas.itens_pedido"), "entregas": m.source("logistica.entregas"),
        "eventos": m.source("web_analytics.eventos_carrinho"), "vendas": m["fato_venda"],
    }
    found = privacy.rows_of_subjects(frames, _erased_keys(m))
    rows = [df.groupBy(F.col("subject").alias("pessoa")).agg(F.count(F.lit(1)).alias("linhas")).withColumn("tabela", F.lit(n)) for n, df in found.items()]
    return reduce(DataFrame.unionByName, rows)
