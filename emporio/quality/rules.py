"""Declarative column rules (Q1-Q4, Q11)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporio.operators.joins import orphans


@dataclass(frozen=True)
class Rule:
    """One assertion on a column: ``not_null``, ``unique`` or ``accepted``."""

    column: str
    kind: str
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def rules(
    not_null: Iterable[str] = (), unique: Iterable[str] = (), accepted: Mapping[str, Iterable] | None = None
) -> list[Rule]:
    """Rules of one model."""
    listed = [Rule(c, "accepted", tuple(v)) for c, v in (accepted or {}).items()]
    return [*[Rule(c, "not_null") for c in not_null], *[Rule(c, "unique") for c in unique], *listed]


def check_rules(df: DataFrame, checks: Iterable[Rule], table: str = "") -> DataFrame:
    """Violations per rule.

    All NULL and accepted-value rules of a table share one scan and one
    aggregate.  Uniqueness counts keys per value, combined before the shuffle.
    NULL passes ``accepted`` and ``unique``.
    """
    checks = list(checks)
    in_pass = [c for c in checks if c.kind != "unique"]
    frames: list[DataFrame] = []
    if in_pass:
        def violations(rule: Rule):
            column = F.col(rule.column)
            bad = column.isNull() if rule.kind == "not_null" else ~column.isin(*rule.values)
            return F.count_if(bad)

        counts = df.agg(*[violations(r).alias(f"r{i}") for i, r in enumerate(in_pass)])
        pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(in_pass)]
        frames.append(counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.rule", "p.violations"))
    for rule in checks:
        if rule.kind == "unique":
            repeated = df.filter(F.col(rule.column).isNotNull()).groupBy(rule.column).count().filter("count > 1")
            frames.append(repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule.name).alias("rule"), "violations"))
    merged = reduce(DataFrame.unionByName, frames)
    return merged.select(F.lit(table).alias("table"), "rule", "violations", (F.col("violations") == 0).alias("passed"))


def check_orphans(facts: Mapping[str, tuple[DataFrame, DataFrame, str, str]]) -> DataFrame:
    """Orphan foreign keys per relationship: name -> (fact, dimension, fact key, dimension key) (Q4)."""
    frames = [
        orphans(fact, dim, fact_key, dim_key).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("rule"), "violations"
        )
        for name, (fact, dim, fact_key, dim_key) in facts.items()
    ]
    return reduce(DataFrame.unionByName, frames).withColumn("passed", F.col("violations") == 0)


def check_batches(bronze: DataFrame) -> DataFrame:
    """Batches whose recorded size differs from their rows (Q11)."""
    batches = bronze.groupBy("_source_schema", "_source_table", "_ingested_at").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("_row_count_batch").alias("least"),
        F.max("_row_count_batch").alias("most"),
    )
    return batches.withColumn(
        "passed", (F.col("rows") == F.col("least")) & (F.col("rows") == F.col("most"))
    )


# Accepted texts.
CHANNELS = ("loja_fisica", "site_proprio", "marketplace_ml", "marketplace_amazon", "marketplace_shopee")
ORDER_STATUS = ("em_processamento", "confirmado", "enviado", "entregue", "cancelado", "devolvido")
LEVELS = ("Bronze", "Silver", "Gold", "Platinum")
LEDGER_TYPES = ("receita", "custo_produto", "frete_custo", "desconto", "comissao")
STORE_TYPES = ("fisica", "ecommerce", "cd")
SEGMENTS = ("Campeoes", "Clientes_Fieis", "Novos_Clientes", "Potencial_Fidelizacao", "Promissores", "Em_Risco",
            "Hibernando", "Perdidos", "Regulares")
SCORES = (1, 2, 3, 4, 5)

# Which columns of each model must be filled, unique, or hold one of a list.
MODEL_RULES: dict[str, list[Rule]] = {
    "stg_vendas__pedidos": rules(
        not_null=["id_pedido", "id_cliente", "id_loja", "canal_venda", "status", "valor_liquido", "updated_at"],
        unique=["id_pedido"],
        accepted={"canal_venda": CHANNELS, "status": ORDER_STATUS},
    ),
    "stg_vendas__itens_pedido": rules(
        not_null=["id_item_pedido", "id_pedido", "id_produto", "qtd_vendida", "valor_liquido_item"],
        unique=["id_item_pedido"],
    ),
    "stg_vendas__devolucoes": rules(
        not_null=["id_devolucao", "id_pedido"],
        unique=["id_devolucao"],
        accepted={"status": ("aprovada", "em_analise", "rejeitada")},
    ),
    "stg_clientes__clientes": rules(
        not_null=["id_cliente", "cpf", "email", "data_cadastro"],
        unique=["id_cliente", "cpf", "email"],
    ),
    "stg_clientes__enderecos": rules(
        not_null=["id_endereco", "id_cliente"],
        unique=["id_endereco"],
        accepted={"tipo": ("principal", "entrega", "cobranca")},
    ),
    "stg_clientes__techpoints": rules(
        not_null=["id_techpoints", "id_cliente"],
        unique=["id_techpoints", "id_cliente"],
        accepted={"nivel_fidelidade": LEVELS},
    ),
    "stg_produtos__produtos": rules(
        not_null=["id_produto", "sku", "id_categoria", "id_fornecedor"],
        unique=["id_produto", "sku"],
    ),
    "stg_produtos__categorias": rules(not_null=["id_categoria", "nome"], unique=["id_categoria", "nome"]),
    "stg_produtos__fornecedores": rules(not_null=["id_fornecedor", "nome_fornecedor"], unique=["id_fornecedor"]),
    "stg_produtos__precos": rules(
        not_null=["id_preco", "id_produto", "preco_venda", "custo_unitario"],
        unique=["id_preco"],
    ),
    "stg_estoque__saldo_estoque": rules(not_null=["id_saldo", "id_produto", "id_loja"], unique=["id_saldo"]),
    "stg_estoque__movimentacoes": rules(
        not_null=["id_movimentacao"],
        unique=["id_movimentacao"],
        accepted={"tipo_mov": ("entrada", "saida", "transferencia", "ajuste", "devolucao")},
    ),
    "stg_logistica__entregas": rules(not_null=["id_entrega", "id_pedido"], unique=["id_entrega", "id_pedido"]),
    "stg_logistica__transportadoras": rules(not_null=["id_transportadora", "nome"], unique=["id_transportadora"]),
    "stg_logistica__modalidades": rules(not_null=["id_modalidade", "codigo"], unique=["id_modalidade", "codigo"]),
    "stg_financeiro__lancamentos": rules(
        not_null=["id_lancamento"],
        unique=["id_lancamento"],
        accepted={"tipo": LEDGER_TYPES},
    ),
    "stg_financeiro__parcelas": rules(
        not_null=["id_parcela", "id_lancamento"],
        unique=["id_parcela"],
        accepted={"status": ("pendente", "pago", "atrasado")},
    ),
    "stg_financeiro__contas_receber": rules(
        not_null=["id_conta"],
        unique=["id_conta"],
        accepted={"status": ("pendente", "pago", "atrasado", "cancelado")},
    ),
    "stg_financeiro__orcamentos": rules(not_null=["id_orcamento", "id_loja"], unique=["id_orcamento"]),
    "stg_marketing__campanhas": rules(
        not_null=["id_campanha"],
        unique=["id_campanha"],
        accepted={"tipo": ("black_friday", "natal", "volta_aulas", "dia_maes", "dia_pais", "dia_namorados",
            "dia_criancas", "liquidacao")},
    ),
    "stg_marketing__leads": rules(not_null=["id_lead", "id_campanha"], unique=["id_lead"]),
    "stg_marketing__atribuicao": rules(not_null=["id_atribuicao"], unique=["id_atribuicao"]),
    "stg_rh__lojas": rules(
        not_null=["id_loja", "codigo"],
        unique=["id_loja", "codigo"],
        accepted={"tipo_loja": STORE_TYPES},
    ),
    "stg_rh__vendedores": rules(
        not_null=["id_vendedor", "cpf"],
        unique=["id_vendedor", "cpf"],
        accepted={"cargo": ("vendedor", "supervisor", "gerente")},
    ),
    "stg_rh__metas": rules(not_null=["id_meta"], unique=["id_meta"]),
    "stg_rh__comissoes": rules(
        not_null=["id_comissao"],
        unique=["id_comissao"],
        accepted={"status": ("pendente", "pago", "estornado")},
    ),
    "stg_web_analytics__sessoes": rules(
        not_null=["id_sessao"],
        unique=["id_sessao"],
        accepted={"device_type": ("desktop", "mobile", "tablet")},
    ),
    "stg_web_analytics__eventos_carrinho": rules(
        not_null=["id_evento", "id_sessao"],
        unique=["id_evento"],
        accepted={"tipo_evento": ("add_to_cart", "remove_from_cart", "checkout_start", "purchase")},
    ),
    "int_vendas__pedidos_unificados": rules(
        not_null=["id_pedido", "status", "valor_liquido", "taxa_desconto"],
        unique=["id_pedido"],
        accepted={"status": ORDER_STATUS},
    ),
    "int_clientes__unificados": rules(
        not_null=["id_cliente", "cpf", "score_recencia", "score_frequencia", "score_monetario"],
        unique=["id_cliente", "cpf"],
        accepted={"nivel_fidelidade": LEVELS, "score_recencia": SCORES, "score_frequencia": SCORES,
            "score_monetario": SCORES},
    ),
    "int_produtos__catalogo": rules(
        not_null=["id_produto", "sku", "categoria", "preco_venda_vigente"],
        unique=["id_produto", "sku"],
    ),
    "dim_tempo": rules(
        not_null=["sk_tempo", "data_full", "ano", "mes"],
        unique=["sk_tempo", "data_full"],
        accepted={"mes": range(1, 13)},
    ),
    "dim_cliente": rules(
        not_null=["sk_cliente", "id_cliente_nk", "cpf", "nivel_fidelidade", "segmento_rfm", "fl_current"],
        accepted={"nivel_fidelidade": LEVELS, "segmento_rfm": SEGMENTS},
    ),
    "dim_produto": rules(not_null=["sk_produto", "id_produto_nk", "sku", "categoria", "fl_current"]),
    "dim_loja": rules(not_null=["sk_loja", "id_loja_nk", "codigo", "tipo_loja"], accepted={"tipo_loja": STORE_TYPES}),
    "dim_vendedor": rules(not_null=["sk_vendedor", "id_vendedor_nk"]),
    "dim_canal_venda": rules(
        not_null=["sk_canal_venda", "canal_venda"],
        unique=["sk_canal_venda", "canal_venda"],
        accepted={"tipo_canal": ("Físico", "Digital"), "plataforma": ("Próprio", "Marketplace")},
    ),
    "dim_campanha": rules(not_null=["sk_campanha", "id_campanha_nk"]),
    "dim_transportadora": rules(
        not_null=["sk_transportadora", "id_transportadora_nk", "nome"],
        unique=["sk_transportadora", "id_transportadora_nk"],
    ),
    "dim_fornecedor": rules(
        not_null=["sk_fornecedor", "id_fornecedor_nk"],
        unique=["sk_fornecedor", "id_fornecedor_nk"],
    ),
    "dim_modalidade_entrega": rules(
        not_null=["sk_modalidade_entrega", "id_modalidade_nk", "codigo"],
        unique=["sk_modalidade_entrega", "id_modalidade_nk"],
    ),
    "fato_venda": rules(
        not_null=["sk_venda", "sk_cliente", "sk_produto", "sk_loja", "sk_tempo", "sk_canal_venda", "qtd_vendida",
            "valor_liquido_item", "fl_venda_valida"],
        unique=["sk_venda"],
    ),
    "fato_estoque": rules(not_null=["sk_estoque", "sk_produto", "sk_loja", "qtd_disponivel"], unique=["sk_estoque"]),
    "fato_entrega": rules(
        not_null=["sk_entrega", "sk_transportadora", "sk_modalidade_entrega"],
        unique=["sk_entrega"],
    ),
    "fato_financeiro": rules(
        not_null=["sk_lancamento", "sk_loja", "tipo"],
        unique=["sk_lancamento"],
        accepted={"tipo": LEDGER_TYPES},
    ),
    "fato_cliente_interacao": rules(not_null=["sk_sessao", "canal_origem"], unique=["sk_sessao"]),
    "fato_orcamento": rules(not_null=["sk_orcamento", "sk_loja", "valor_meta_receita"], unique=["sk_orcamento"]),
    "feriados_nacionais": rules(
        not_null=["data", "nome_feriado", "tipo"],
        unique=["data"],
        accepted={"tipo": ("fixo", "movel")},
    ),
}


def check_models(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules of all given models, one row per rule."""
    return reduce(
        DataFrame.unionByName,
        [check_rules(df, MODEL_RULES[name], name) for name, df in tables.items() if name in MODEL_RULES],
    )
