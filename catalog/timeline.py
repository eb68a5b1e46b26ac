"""Backdated changes, facts at the version of their date, ranges without an end, and sums that follow changed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.models import hash_of
from catalog.operators import VERSIONS_SQL, customer_versions
from catalog.registry import query
from emporio.operators.distinct import member_count, members, merged
from emporio.operators.joins import interval_join
from emporio.operators.scd2 import OPEN_END
from emporio.operators.timeline import at_version, merge_timeline, moved_segments, repointed
from emporio.plans.aggregates import GROUP, ROWS, UNTIL, Sums
from emporio.sinks.tables import month_partition

TRACKED = ("segmento", "pais")

# An order tells, from its date on, the segment and country of its customer; urgent orders that ended close the customer.
CHANGES_SQL = """
    SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS dia, o_orderkey AS ordem, o_orderpriority AS segmento,
        length(o_orderpriority) % 4 AS pais, o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS fim FROM orders"""

MERGED_SQL = f"""
    SELECT id, segmento, pais, valid_from, valid_to, valid_to = DATE '9999-12-31' AS fl_current, hash_row FROM (
      SELECT *, CAST(coalesce(lead(valid_from) OVER (PARTITION BY id ORDER BY valid_from) - 1, DATE '9999-12-31') AS DATE) AS valid_to
      FROM (
        SELECT *, lag(hash_row) OVER (PARTITION BY id ORDER BY valid_from) AS antes FROM (
          SELECT id, dia AS valid_from, segmento, pais, CASE WHEN NOT fim THEN {hash_of('segmento', 'pais')} END AS hash_row FROM (
            SELECT id, valid_from AS dia, segmento, pais, false AS fim, 1 AS tipo, 0 AS ordem FROM ({VERSIONS_SQL}) a
            UNION ALL
            SELECT id, CAST(valid_to + 1 AS DATE), NULL, NULL, true, 0, 0 FROM ({VERSIONS_SQL}) b WHERE valid_to < DATE '9999-12-31'
            UNION ALL
            SELECT id, dia, segmento, pais, fim, 2, ordem FROM ({CHANGES_SQL}) c) e
          QUALIFY row_number() OVER (PARTITION BY id, dia ORDER BY tipo DESC, ordem DESC) = 1) d) f
      WHERE hash_row IS DISTINCT FROM antes) g
    WHERE hash_row IS NOT NULL"""

SHIPPED_SQL = """
    SELECT l_orderkey, l_linenumber, o_custkey AS id, CAST(l_shipdate AS DATE) AS dia FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""


def _version(v: str) -> str:
    key = f"md5(CAST(s.id AS VARCHAR) || '-' || CAST({v}.valid_from AS VARCHAR))"
    return f"CASE WHEN {v}.valid_from IS NULL THEN 'DESCONHECIDO' ELSE {key} END"


def _in_force(versions: str, v: str) -> str:
    return f"LEFT JOIN ({versions}) {v} ON {v}.id = s.id AND s.dia BETWEEN {v}.valid_from AND {v}.valid_to"


LINKED_SQL = f"""
    SELECT l_orderkey, l_linenumber, dia, {_version('v')} AS sk_versao
    FROM ({SHIPPED_SQL}) s {_in_force(MERGED_SQL, 'v')}"""


def _merged(m):
    day, status, priority = F.to_date("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    changes = m["orders"].select(
        F.col("o_custkey").alias("id"), day.alias("dia"), F.col("o_orderkey").alias("ordem"), priority.alias("segmento"),
        (F.length(priority) % 4).alias("pais"), ((status == "F") & (priority == "1-URGENT")).alias("fim"),
    )
    return merge_timeline(customer_versions(m), changes, "id", TRACKED, "dia", "ordem", gone="fim")


def _shipped(m):
    orders = m["orders"].select("o_orderkey", F.col("o_custkey").alias("id"))
    items = m["lineitem"].select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("dia"))
    return items.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).drop("o_orderkey")


@query("timeline_merge", "id:l segmento:s pais:l valid_from:s valid_to:s fl_current:b hash_row:s", MERGED_SQL)
def timeline_merge(m):
    """Customer versions after every order, in no order, told what the customer was like on its day."""
    return _merged(m)


@query("facts_at_version", "l_orderkey:l l_linenumber:l dia:s sk_versao:s", LINKED_SQL)
def facts_at_version(m):
    """Items with the version of their customer on the day they were shipped."""
    return at_version(_shipped(m), _merged(m), "id", "id", "dia", "sk_versao", spread_by="l_orderkey")


@query(
    "facts_repointed",
    "l_orderkey:l l_linenumber:l dia:s sk_versao:s",
    f"{LINKED_SQL} {_in_force(VERSIONS_SQL, 'w')} WHERE {_version('v')} <> {_version('w')}",
)
def facts_repointed(m):
    """Only the items whose version is another one once the backdated changes are known."""
    before = customer_versions(m)
    stored = at_version(_shipped(m), before, "id", "id", "dia", "sk_versao", spread_by="l_orderkey")
    return repointed(stored, moved_segments(before, _merged(m), "id"), "id", "id", "dia", "sk_versao")


@query(
    "open_range_join",
    "id_pedido:l id_campanha_ativa:l dia:s dt_fim:s",
    """SELECT id_pedido, c.id_campanha AS id_campanha_ativa, CAST(dt_pedido AS DATE) AS dia, c.dt_fim
       FROM src_vendas__pedidos p JOIN (SELECT id_campanha, dt_inicio,
         CASE WHEN canal = 'email' THEN DATE '9999-12-31' ELSE dt_fim END AS dt_fim FROM src_marketing__campanhas) c
         ON CAST(p.dt_pedido AS DATE) BETWEEN c.dt_inicio AND c.dt_fim""",
)
def open_range_join(m):
    """Campaigns running on the day of each order, those by mail without an end."""
    orders = m["stg_vendas__pedidos"].select("id_pedido", F.to_date("dt_pedido").alias("dia"))
    end = F.when(F.col("canal") == "email", F.lit(OPEN_END)).otherwise(F.col("dt_fim"))
    runs = m["stg_marketing__campanhas"].select(F.col("id_campanha").alias("id_campanha_ativa"), "dt_inicio", end.alias("dt_fim"))
    return interval_join(orders, runs, "dia", "dt_inicio", "dt_fim")


@query(
    "sums_by_retraction",
    "canal:s ano:l mes:l receita:d unidades:l pedidos:l",
    """SELECT canal, year(dia) AS ano, month(dia) AS mes, sum(valor) AS receita, sum(qtd) AS unidades, count(DISTINCT l_orderkey) AS pedidos
       FROM (SELECT l_linestatus AS canal, l_orderkey, CAST(l_quantity AS BIGINT) AS qtd, CAST(l_extendedprice AS DECIMAL(12,2)) AS valor,
               CAST(CASE WHEN l_linenumber = 1 THEN l_shipdate + INTERVAL 45 DAY ELSE l_shipdate END AS DATE) AS dia
             FROM lineitem WHERE l_returnflag <> 'R') v GROUP BY ALL""",
)
def sums_by_retraction(m):
    """Sales per line status and month, kept through two commits: first lines are shipped 45 days later, then items come back."""
    stored = m["lineitem"].select(
        F.col("l_linestatus").alias("canal"), "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("bigint").alias("qtd"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("valor"), F.to_date("l_shipdate").alias("dia"), F.lit(True).alias("valida"),
    )
    day, whole = F.col("dia"), F.struct(*stored.columns)

    def image(before, after):
        return before.select(whole.alias("before"), after.alias("after"))

    later = stored.filter("l_linenumber = 1")
    postponed = image(later, F.struct(*[F.date_add("dia", 45).alias(c) if c == "dia" else F.col(c) for c in stored.columns]))
    after_first = stored.withColumn("dia", F.when(F.col("l_linenumber") == 1, F.date_add("dia", 45)).otherwise(day))
    returned = image(after_first.filter("l_returnflag = 'R'"), F.struct(*[F.lit(False).alias(c) if c == "valida" else F.col(c) for c in stored.columns]))
    now = after_first.withColumn("valida", F.col("l_returnflag") != "R")
    spec = Sums(
        "", "", {"canal": F.col("canal"), "ano": F.year(day), "mes": F.month(day)}, {"receita": F.col("valor"), "unidades": F.col("qtd")},
        month_partition(day), F.col("valida"), {"pedidos": F.col("l_orderkey")},
    )
    held = spec.whole(stored, 0)
    changed = spec.changed(spec.moved([(1, postponed), (2, returned)]), held, now)
    same = held.join(changed.select(GROUP), GROUP, "left_anti")
    return same.unionByName(changed).filter(F.col(ROWS) > 0).drop(GROUP, ROWS, UNTIL)


# -- distinct members from stored days ---------------------------------------

_BUYERS = """SELECT id_cliente, canal_venda, year(dt_pedido) AS ano, month(dt_pedido) AS mes FROM src_vendas__pedidos"""


@query(
    "distinct_rollup",
    "nivel:s canal_venda:s ano:l mes:l clientes:l",
    f"""SELECT 'mes_canal' AS nivel, canal_venda, ano, mes, count(DISTINCT id_cliente) AS clientes FROM ({_BUYERS}) a GROUP BY ALL
        UNION ALL SELECT 'mes', NULL, ano, mes, count(DISTINCT id_cliente) FROM ({_BUYERS}) b GROUP BY ALL
        UNION ALL SELECT 'canal', canal_venda, NULL, NULL, count(DISTINCT id_cliente) FROM ({_BUYERS}) c GROUP BY ALL
        UNION ALL SELECT 'tudo', NULL, NULL, NULL, count(DISTINCT id_cliente) FROM ({_BUYERS}) d""",
)
def distinct_rollup(m):
    """Customers per month and channel, per month, per channel and in all, merged from the members of each day."""
    orders = m["stg_vendas__pedidos"].select("id_cliente", "canal_venda", F.to_date("dt_pedido").alias("dia"))
    days = members(orders, ["dia", "canal_venda"], "id_cliente")
    months = merged(days.withColumns({"ano": F.year("dia"), "mes": F.month("dia")}), ["ano", "mes", "canal_venda"])
    levels = {"mes_canal": ["canal_venda", "ano", "mes"], "mes": ["ano", "mes"], "canal": ["canal_venda"], "tudo": []}
    out = None
    for name, keys in levels.items():
        level = member_count(months, keys, "clientes").withColumn("nivel", F.lit(name))
        out = level if out is None else out.unionByName(level, allowMissingColumns=True)
    return out
