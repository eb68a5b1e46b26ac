"""The 28 source tables: key, watermark column and typed columns.

One entry drives extraction, the Bronze schema, the staging projection and the
upsert of its table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_SIMPLE = {
    "int": T.IntegerType(),
    "str": T.StringType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
}

# Columns the Bronze writer adds to every row.
METADATA = T.StructType(
    [
        T.StructField("_source_schema", T.StringType()),
        T.StructField("_source_table", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_row_count_batch", T.LongType()),
    ]
)


def _type(token: str) -> T.DataType:
    if token.startswith("dec"):
        precision, scale = token[3:].split(".")
        return T.DecimalType(int(precision), int(scale))
    return _SIMPLE[token]


@dataclass(frozen=True)
class Column:
    """One column: name, type and text clean-up (``trim``, ``lower``, ``upper`` or none)."""

    name: str
    dtype: T.DataType
    clean: str | None = None

    @classmethod
    def parse(cls, spec: str) -> Column:
        name, token = spec.split(":")
        token, _, clean = token.partition("~")
        return cls(name, _type(token), clean or None)


@dataclass(frozen=True)
class TableEntry:
    """A source table.  ``columns`` are staged; ``source_only`` stop at Bronze."""

    schema: str
    table: str
    natural_key: tuple[str, ...]
    columns: tuple[Column, ...] = field(default=(), repr=False)
    source_only: tuple[Column, ...] = field(default=(), repr=False)
    watermark_col: str = "updated_at"

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.table}"

    @property
    def watermark_key(self) -> str:
        return f"{self.schema}__{self.table}"

    @property
    def staging_name(self) -> str:
        return f"stg_{self.watermark_key}"

    def widened(self) -> TableEntry:
        """The same table with 64-bit ids, for sources whose keys outgrow 32 bits."""

        def wide(column: Column) -> Column:
            if column.name.startswith("id_") and column.dtype == T.IntegerType():
                return replace(column, dtype=T.LongType())
            return column

        return replace(self, columns=tuple(map(wide, self.columns)), source_only=tuple(map(wide, self.source_only)))

    @property
    def source_schema(self) -> T.StructType:
        """Columns as the operational table has them."""
        return T.StructType([T.StructField(c.name, c.dtype) for c in self.columns + self.source_only])

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType(self.source_schema.fields + METADATA.fields)

    @property
    def staging_schema(self) -> T.StructType:
        fields = [T.StructField(c.name, c.dtype) for c in self.columns]
        return T.StructType([*fields, METADATA["_ingested_at"]])


def _entry(name: str, key: str, columns: str, source_only: str = "") -> TableEntry:
    schema, table = name.split(".")
    return TableEntry(
        schema,
        table,
        tuple(key.split()),
        tuple(Column.parse(c) for c in [*columns.split(), "updated_at:ts"]),
        tuple(Column.parse(c) for c in source_only.split()),
    )


# The source schema (name, key, column types, text clean-up).
TABLES: tuple[TableEntry, ...] = (
    _entry("clientes.clientes", "id_cliente",
           "id_cliente:int cpf:str~lower email:str~lower telefone:str~trim primeiro_nome:str~trim "
           "nome_completo:str~trim cep:str~trim cidade:str~trim uf:str~upper data_cadastro:date "
           "canal_origem:str nivel_fidelidade:str ativo:bool created_at:ts"),
    _entry("clientes.enderecos", "id_endereco",
           "id_endereco:int id_cliente:int logradouro:str~trim numero:str~trim complemento:str~trim "
           "bairro:str~trim cep:str~trim cidade:str~trim uf:str~upper tipo:str", "created_at:ts"),
    _entry("clientes.techpoints", "id_techpoints",
           "id_techpoints:int id_cliente:int pontos_acumulados:int pontos_resgatados:int "
           "saldo_pontos:int nivel_fidelidade:str"),
    _entry("estoque.movimentacoes", "id_movimentacao",
           "id_movimentacao:int id_produto:int id_loja:int tipo_mov:str qtd:int dt_movimentacao:ts "
           "id_pedido:int custo_unitario:dec12.2 observacao:str"),
    _entry("estoque.saldo_estoque", "id_produto id_loja",
           "id_saldo:int id_produto:int id_loja:int qtd_disponivel:int qtd_reservada:int "
           "qtd_minima:int dt_ultima_atualizacao:date"),
    _entry("financeiro.contas_receber", "id_conta",
           "id_conta:int id_pedido:int valor_original:dec12.2 valor_pago:dec12.2 dt_vencimento:date "
           "dt_pagamento:date status:str"),
    _entry("financeiro.lancamentos", "id_lancamento",
           "id_lancamento:int id_pedido:int id_loja:int tipo:str valor:dec12.2 dt_lancamento:date "
           "dt_competencia:date descricao:str"),
    _entry("financeiro.orcamentos", "id_orcamento",
           "id_orcamento:int id_loja:int canal_venda:str ano:int mes:int valor_meta_receita:dec14.2 "
           "valor_meta_margem:dec14.2 qtd_meta_pedidos:int"),
    _entry("financeiro.parcelas", "id_parcela",
           "id_parcela:int id_lancamento:int numero_parcela:int valor_parcela:dec12.2 "
           "dt_vencimento:date dt_pagamento:date status:str"),
    _entry("logistica.entregas", "id_entrega",
           "id_entrega:int id_pedido:int id_transportadora:int id_modalidade:int id_loja_origem:int "
           "codigo_rastreio:str~trim dt_postagem:date dt_promessa:date dt_efetiva:date "
           "fl_sla_atendido:bool status:str"),
    _entry("logistica.modalidades", "id_modalidade",
           "id_modalidade:int id_transportadora:int nome:str~trim codigo:str~trim prazo_dias:int "
           "frete_base:dec10.2 tipo:str"),
    _entry("logistica.transportadoras", "id_transportadora",
           "id_transportadora:int nome:str~trim cnpj:str~trim prazo_dias_min:int prazo_dias_max:int "
           "ativo:bool"),
    _entry("marketing.atribuicao", "id_atribuicao",
           "id_atribuicao:int id_pedido:int id_campanha:int canal_atribuicao:str tipo_atribuicao:str "
           "peso:dec5.4"),
    _entry("marketing.campanhas", "id_campanha",
           "id_campanha:int nome:str~trim tipo:str canal:str dt_inicio:date dt_fim:date "
           "orcamento:dec12.2 objetivo:str ativo:bool"),
    _entry("marketing.leads", "id_lead",
           "id_lead:int id_campanha:int id_cliente:int canal:str dt_lead:date convertido:bool"),
    _entry("produtos.categorias", "id_categoria",
           "id_categoria:int nome:str~trim subcategoria:str~trim"),
    _entry("produtos.fornecedores", "id_fornecedor",
           "id_fornecedor:int nome_fornecedor:str~trim cnpj:str~trim categoria_principal:str~trim "
           "pais_origem:str~trim prazo_entrega_dias:int ativo:bool"),
    _entry("produtos.precos", "id_produto dt_vigencia_inicio",
           "id_preco:int id_produto:int preco_venda:dec12.2 custo_unitario:dec12.2 "
           "dt_vigencia_inicio:date dt_vigencia_fim:date"),
    _entry("produtos.produtos", "id_produto",
           "id_produto:int id_categoria:int id_fornecedor:int sku:str~trim nome:str~trim "
           "marca:str~trim peso_kg:dec8.3 ativo:bool created_at:ts"),
    _entry("rh.comissoes", "id_comissao",
           "id_comissao:int id_vendedor:int id_pedido:int valor_venda:dec12.2 "
           "percentual_comissao:dec5.4 valor_comissao:dec10.2 dt_competencia:date status:str"),
    _entry("rh.lojas", "id_loja",
           "id_loja:int codigo:str~trim nome_loja:str~trim tipo_loja:str regiao:str cidade:str~trim "
           "uf:str~upper gerente:str~trim capacidade_m2:int dt_abertura:date ativo:bool",
           "created_at:ts"),
    _entry("rh.metas", "id_meta",
           "id_meta:int id_vendedor:int ano:int mes:int meta_valor:dec12.2 meta_qtd_pedidos:int"),
    _entry("rh.vendedores", "id_vendedor",
           "id_vendedor:int id_loja:int nome:str~trim cpf:str~trim email:str~trim cargo:str "
           "data_admissao:date ativo:bool", "created_at:ts"),
    _entry("vendas.devolucoes", "id_devolucao",
           "id_devolucao:int id_pedido:int id_produto:int dt_devolucao:date motivo:str "
           "qtd_devolvida:int valor_devolvido:dec12.2 status:str"),
    _entry("vendas.itens_pedido", "id_item_pedido",
           "id_item_pedido:int id_pedido:int id_produto:int qtd_vendida:int preco_unitario:dec12.2 "
           "custo_unitario:dec12.2 desconto_item:dec10.2 valor_liquido_item:dec12.2"),
    _entry("vendas.pedidos", "id_pedido",
           "id_pedido:int id_cliente:int id_loja:int canal_venda:str status:str dt_pedido:ts "
           "dt_confirmacao:ts dt_cancelamento:ts valor_bruto:dec12.2 valor_desconto:dec12.2 "
           "valor_frete:dec10.2 valor_liquido:dec12.2 parcelas:int metodo_pagamento:str cupom:str "
           "id_campanha:int created_at:ts"),
    _entry("web_analytics.eventos_carrinho", "id_evento",
           "id_evento:int id_sessao:int id_produto:int tipo_evento:str dt_evento:ts qtd:int "
           "preco_na_epoca:dec12.2"),
    _entry("web_analytics.sessoes", "id_sessao",
           "id_sessao:int id_cliente:int canal_origem:str device_type:str dt_inicio:ts dt_fim:ts "
           "paginas_visitadas:int converteu:bool id_pedido:int"),
)

TABLES_BY_NAME: dict[str, TableEntry] = {t.full_name: t for t in TABLES}

# Lookup tables that may have no file yet; they read as empty.
OPTIONAL_TABLES: tuple[str, ...] = (
    "clientes.clientes", "clientes.enderecos", "clientes.techpoints", "estoque.saldo_estoque",
    "financeiro.orcamentos", "logistica.modalidades", "logistica.transportadoras",
    "marketing.campanhas", "produtos.categorias", "produtos.fornecedores", "produtos.precos",
    "produtos.produtos", "rh.lojas", "rh.metas", "rh.vendedores",
)


def find(names: Iterable[str] | None = None) -> tuple[TableEntry, ...]:
    """Entries for ``names`` (all when empty); unknown names raise before any work starts."""
    wanted = list(names or [])
    unknown = [n for n in wanted if n not in TABLES_BY_NAME]
    if unknown:
        raise KeyError(f"unknown tables {unknown}; known: {sorted(TABLES_BY_NAME)}")
    return tuple(TABLES_BY_NAME[n] for n in wanted) if wanted else TABLES
