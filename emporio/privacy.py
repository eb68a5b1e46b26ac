"""Personal data: pseudonyms, erasure, access export, retention.

A person is found by number, but most tables know customers, orders or sessions
only.  :func:`subject_keys` follows a person's keys from table to table into one
small index, and every job joins it on whichever key a table has.  Erased people
get a tombstone each, so that two of them never become one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporio.functions.keys import surrogate_key
from emporio.sinks.tables import Warehouse

REMOVED = "[REMOVIDO]"
# Columns that identify a person, blanked by an erasure.
IDENTIFYING = ("cpf", "email", "telefone", "primeiro_nome", "nome_completo", "cep", "cidade", "logradouro", "numero",
               "complemento", "bairro")
_BLOCK = 64


def hmac_sha256(value: Column, key: str) -> Column:
    """Keyed HMAC-SHA256 of a text column in hex, from built-in functions only.

    The key is known when the plan is built, so its two padded forms are
    literals and each row costs two digests.
    """
    raw = key.encode()
    raw = hashlib.sha256(raw).digest() if len(raw) > _BLOCK else raw
    padded = raw.ljust(_BLOCK, b"\0")
    inner_pad, outer_pad = (bytes(b ^ x for b in padded) for x in (0x36, 0x5C))
    inner = F.sha2(F.concat(F.lit(inner_pad), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(outer_pad), F.unhex(inner)), 256)


def pseudonymise(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Replace the columns by keyed hashes; NULL stays NULL."""
    if not key:
        raise ValueError("a key is required")
    return df.withColumns({c: hmac_sha256(F.col(c).cast("string"), key) for c in columns})


def find_subject(frames: Mapping[str, DataFrame], cpf: str) -> dict[str, DataFrame]:
    """The person's rows in each table that has a ``cpf`` column."""
    return {n: df.filter(F.col("cpf") == cpf) for n, df in frames.items() if "cpf" in df.columns}


def erase(
    frames: Mapping[str, DataFrame], cpf: str, dry_run: bool = True, columns: Sequence[str] = IDENTIFYING
) -> dict[str, DataFrame]:
    """Blank the identifying text of one person, everyone else and all measures unchanged.

    A dry run returns the person's rows instead of rewritten tables.
    """
    if dry_run:
        return find_subject(frames, cpf)
    person = F.col("cpf") == cpf

    def blank(df: DataFrame) -> DataFrame:
        hit = [c for c in columns if c in df.columns]
        # The condition must see the original cpf, so all columns are replaced in one projection.
        return df.select(
            *[F.when(person, F.lit(REMOVED)).otherwise(F.col(c)).alias(c) if c in hit else F.col(c) for c in df.columns]
        )

    return {name: blank(df) for name, df in frames.items() if "cpf" in df.columns}


def erasure_audit(frames: Mapping[str, DataFrame], cpf: str, at: datetime, dry_run: bool) -> DataFrame:
    """Rows affected per table, with a digest in place of the person's number."""
    who = hashlib.sha256(cpf.encode()).hexdigest()
    out = None
    for name, df in find_subject(frames, cpf).items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(at).alias("at"), F.lit(name).alias("table"), F.lit(who).alias("subject"), "rows",
            F.lit(dry_run).alias("dry_run"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def cut_retention(df: DataFrame, date_col: str, years: int, as_of: date) -> DataFrame:
    """Rows not older than ``years`` before ``as_of``; rows without a date stay."""
    cut = F.add_months(F.lit(as_of), -12 * years)
    return df.filter(F.col(date_col).isNull() | (F.col(date_col) >= cut))


def subject_rows(frames: Mapping[str, DataFrame], customers: DataFrame, cpf: str, key: str = "id_cliente") -> dict[str, DataFrame]:
    """Every row of one person in tables keyed by customer id or cpf."""
    ids = customers.filter(F.col("cpf") == cpf).select(key)
    out = {}
    for name, df in frames.items():
        if key in df.columns:
            out[name] = df.join(ids, key, "left_semi")
        elif "cpf" in df.columns:
            out[name] = df.filter(F.col("cpf") == cpf)
    return out


def export_subject(frames: Mapping[str, DataFrame], customers: DataFrame, cpf: str, path: str) -> list[str]:
    """Write the person's rows as CSV, one directory per table."""
    written = []
    for name, df in subject_rows(frames, customers, cpf).items():
        df.write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/{name}")
        written.append(name)
    return written


# Where one key of a person leads to another: table, known key, key found there.  Later links start from earlier ones.
LINKS = (
    ("clientes.clientes", "cpf", "id_cliente"),
    ("vendas.pedidos", "id_cliente", "id_pedido"),
    ("web_analytics.sessoes", "id_cliente", "id_sessao"),
)
# Columns by which a table names a person, most direct first, and the kind of key they hold.
KEY_COLUMNS = {
    "cpf": "cpf", "id_cliente": "id_cliente", "id_cliente_nk": "id_cliente", "sk_cliente": "sk_cliente", "id_pedido": "id_pedido",
    "id_pedido_dg": "id_pedido", "id_sessao": "id_sessao", "id_sessao_dg": "id_sessao",
}
TOMBSTONES = "lgpd_tombstones"


def tombstone(cpf: Column, key: str) -> Column:
    """What stays of a person's number: the same for every row of the person, different for every person."""
    return F.concat(F.lit(REMOVED[:-1] + ":"), F.substring(hmac_sha256(cpf, key), 1, 16), F.lit("]"))


def subject_keys(frames: Mapping[str, DataFrame], people: DataFrame, key: str) -> DataFrame:
    """``(subject, kind, value)``: all keys of ``people`` (a column ``cpf``), reached through :data:`LINKS`.

    ``frames`` are the operational tables by full name.  A step is a semi-join of a large table with the keys so far, which
    are as many as the people's own rows.
    """
    cpf = F.col("cpf").cast("string")
    found = {"cpf": people.select(tombstone(cpf, key).alias("subject"), cpf.alias("value")).filter("value IS NOT NULL").distinct()}
    for table, known, new in LINKS:
        rows = frames[table].select(F.col(known).cast("string").alias("value"), F.col(new).cast("string").alias("new"))
        found[new] = found[known].join(rows, "value").select("subject", F.col("new").alias("value")).filter("value IS NOT NULL").distinct()
    # The surrogate of a customer is a function of the id, so it needs no table.
    found["sk_cliente"] = found["id_cliente"].select("subject", surrogate_key("value").alias("value"))
    kinds = [df.select("subject", F.lit(kind).alias("kind"), "value") for kind, df in found.items()]
    return reduce(DataFrame.unionByName, kinds)


def _key_column(df: DataFrame) -> str | None:
    return next((c for c in KEY_COLUMNS if c in df.columns), None)


def rows_of_subjects(frames: Mapping[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    """The people's rows of every table that names a person by any key, with their ``subject``."""
    out = {}
    for name, df in frames.items():
        column = _key_column(df)
        if column:
            side = keys.filter(F.col("kind") == KEY_COLUMNS[column]).select("subject", F.col("value").alias("__value"))
            out[name] = df.join(side, F.col(column).cast("string") == F.col("__value")).drop("__value")
    return out


def erase_subjects(frames: Mapping[str, DataFrame], keys: DataFrame, columns: Sequence[str] = IDENTIFYING) -> dict[str, DataFrame]:
    """The people's rows with their identifying text blanked and the number replaced by the tombstone.

    Only tables that hold such text are given, and only the rows that change.
    """
    out = {}
    for name, rows in rows_of_subjects(frames, keys).items():
        hit = [c for c in frames[name].columns if c in columns]
        if hit:
            blank = {c: F.col("subject") if c == "cpf" else F.when(F.col(c).isNotNull(), REMOVED) for c in hit}
            out[name] = rows.select(*[blank[c].alias(c) if c in blank else F.col(c) for c in frames[name].columns])
    return out


def erase_stored(
    warehouse: Warehouse, tables: Mapping[str, Sequence[str]], keys: DataFrame, at: datetime, partitions: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Erase people in stored tables (name to unique key) and keep their tombstones; rows changed by table.

    A partitioned table has only the partitions rewritten that hold one of the rows.
    """
    names = list(tables)
    blanked = erase_subjects({n: warehouse.read(n) for n in names}, keys)
    changed = {}
    for name, rows in blanked.items():
        changed[name] = rows.count()
        if changed[name]:
            warehouse.upsert(rows, name, list(tables[name]), partition=(partitions or {}).get(name))
    people = keys.select("subject").distinct().withColumn("erased_at", F.lit(at))
    warehouse.upsert(people, TOMBSTONES, ["subject"])
    return changed


def keep_erased(df: DataFrame, tombstones: DataFrame, key: str, columns: Sequence[str] = IDENTIFYING) -> DataFrame:
    """Rows that land again for erased people (known by number) blanked once more, all others unchanged."""
    gone = tombstones.select(F.col("subject").alias("__gone")).distinct()
    marked = df.join(gone, tombstone(F.col("cpf").cast("string"), key) == F.col("__gone"), "left")
    erased = F.col("__gone").isNotNull()
    blank = {c: F.when(erased, F.col("__gone") if c == "cpf" else F.when(F.col(c).isNotNull(), REMOVED)).otherwise(F.col(c)) for c in columns}
    return marked.select(*[blank[c].alias(c) if c in blank else F.col(c) for c in df.columns])


def drop_expired(warehouse: Warehouse, name: str, years: int, as_of: date) -> list[int]:
    """Drop the months of a stored table that ended ``years`` or more ago, without reading a row; the months dropped."""
    cut = (as_of.year - years) * 100 + as_of.month
    return warehouse.drop_partitions(name, lambda month: 0 < month < cut)
