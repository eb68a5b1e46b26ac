import hashlib
import hmac
from datetime import date

import pytest

from pyspark.sql import functions as F

from conftest import at, day
from emporio import privacy
from emporio.sinks.tables import Warehouse, month_partition


@pytest.mark.parametrize("key", ["k", "chave com acentos é", "x" * 200])
def test_hmac_matches_the_standard_library(spark, key):
    values = ["123.456.789-09", "", "ação"]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "cpf string")
    got = [r[0] for r in privacy.pseudonymise(df, ["cpf"], key).collect()]
    assert got == [hmac.new(key.encode(), v.encode(), hashlib.sha256).hexdigest() for v in values] + [None]
    with pytest.raises(ValueError):
        privacy.pseudonymise(df, ["cpf"], "")


@pytest.fixture
def tables(spark):
    people = spark.createDataFrame([(1, "111", "a@x", 5), (2, "222", "b@x", 6)], "id_cliente int, cpf string, email string, pontos int")
    orders = spark.createDataFrame([(10, 1, 9.5), (11, 2, 1.0), (12, 1, 2.0)], "id_pedido int, id_cliente int, valor double")
    return {"dim_cliente": people, "fato": orders}


def test_erasure_blanks_one_person_and_keeps_measures(tables):
    found = privacy.erase(tables, "111")
    assert set(found) == {"dim_cliente"} and [r["email"] for r in found["dim_cliente"].collect()] == ["a@x"]
    done = privacy.erase(tables, "111", dry_run=False)["dim_cliente"].collect()
    assert sorted(map(tuple, done)) == [(1, "[REMOVIDO]", "[REMOVIDO]", 5), (2, "222", "b@x", 6)]
    audit = privacy.erasure_audit(tables, "111", at("2026-07-20"), True).first()
    assert (audit["table"], audit["rows"], audit["dry_run"]) == ("dim_cliente", 1, True) and "111" != audit["subject"]


def test_subject_export(spark, tables, tmp_path):
    rows = privacy.subject_rows(tables, tables["dim_cliente"], "111")
    assert sorted(r["id_pedido"] for r in rows["fato"].collect()) == [10, 12]
    assert privacy.export_subject(tables, tables["dim_cliente"], "111", str(tmp_path)) == ["dim_cliente", "fato"]
    assert spark.read.option("header", True).csv(str(tmp_path / "fato")).count() == 2


def test_retention_cut(spark):
    df = spark.createDataFrame([(day("2023-07-19"),), (day("2023-07-20"),), (None,)], "d date")
    kept = {r["d"] for r in privacy.cut_retention(df, "d", 3, date(2026, 7, 20)).collect()}
    assert kept == {date(2023, 7, 20), None}


KEY = "k"


@pytest.fixture
def shop(spark):
    people = [(1, "111", "a@x"), (2, "222", "b@x"), (3, "333", None), (4, "111", "c@x"), (5, None, "d@x")]
    return {
        "clientes.clientes": spark.createDataFrame(people, "id_cliente int, cpf string, email string"),
        "clientes.enderecos": spark.createDataFrame([(7, 1, "rua", None), (8, 2, "rua", "c"), (9, 3, None, "c")], "id_endereco int, id_cliente int, logradouro string, cidade string"),
        "vendas.pedidos": spark.createDataFrame([(10, 1), (11, 2), (12, 4), (13, None)], "id_pedido int, id_cliente int"),
        "vendas.itens_pedido": spark.createDataFrame([(100, 10), (101, 12), (102, 11), (103, None)], "id_item_pedido int, id_pedido int"),
        "web_analytics.sessoes": spark.createDataFrame([(20, 3), (21, 1), (22, None)], "id_sessao int, id_cliente int"),
    }


def keys_of(spark, shop, *cpfs):
    return privacy.subject_keys(shop, spark.createDataFrame([(c,) for c in cpfs], "cpf string"), KEY)


def test_keys_of_a_person_are_followed_through_the_tables(spark, shop):
    keys = keys_of(spark, shop, "111", "333", "999", None)
    names = {c: f"[REMOVIDO:{hmac.new(KEY.encode(), c.encode(), hashlib.sha256).hexdigest()[:16]}]" for c in ("111", "333", "999")}
    found = {(r["subject"], r["kind"], r["value"]) for r in keys.collect()}
    md5 = lambda n: hashlib.md5(str(n).encode()).hexdigest()
    assert found == {
        (names[c], kind, str(v)) for c, kind, values in [
            ("111", "cpf", ["111"]), ("333", "cpf", ["333"]), ("999", "cpf", ["999"]), ("111", "id_cliente", [1, 4]), ("333", "id_cliente", [3]),
            ("111", "id_pedido", [10, 12]), ("111", "id_sessao", [21]), ("333", "id_sessao", [20]),
            ("111", "sk_cliente", [md5(1), md5(4)]), ("333", "sk_cliente", [md5(3)]),
        ] for v in values
    }
    rows = privacy.rows_of_subjects(shop, keys)
    assert sorted(r["id_item_pedido"] for r in rows["vendas.itens_pedido"].collect()) == [100, 101]
    facts = spark.createDataFrame([(md5(1), 5), (md5(2), 6)], "sk_cliente string, valor int")
    assert [r["valor"] for r in privacy.rows_of_subjects({"fato": facts}, keys)["fato"].collect()] == [5]


def test_two_erased_people_stay_two_and_stay_erased(spark, shop, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    part = F.floor(F.col("id_cliente") / 2).cast("int")
    w.upsert(shop["clientes.clientes"], "clientes", ["id_cliente"], partition=part)
    w.upsert(shop["clientes.enderecos"], "enderecos", ["id_endereco"])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "clientes").rglob("*.parquet") if "particao" in str(p)}
    keys = keys_of(spark, shop, "111", "333")
    changed = privacy.erase_stored(w, {"clientes": ["id_cliente"], "enderecos": ["id_endereco"]}, keys, at("2026-07-20"), {"clientes": part})
    assert changed == {"clientes": 3, "enderecos": 2}
    people = {r["id_cliente"]: (r["cpf"], r["email"]) for r in w.read("clientes").collect()}
    assert people[2] == ("222", "b@x") and people[5] == (None, "d@x") and people[3][1] is None and people[1][1] == "[REMOVIDO]"
    assert people[1][0] == people[4][0] != people[3][0] and all(people[k][0].startswith("[REMOVIDO:") for k in (1, 3, 4))
    homes = {r["id_endereco"]: (r["logradouro"], r["cidade"]) for r in w.read("enderecos").collect()}
    assert homes == {7: ("[REMOVIDO]", None), 8: ("rua", "c"), 9: (None, "[REMOVIDO]")}
    assert w.read(privacy.TOMBSTONES).count() == 2
    assert not any(p.exists() and "particao=0" in str(p) and p.stat().st_mtime_ns == files[p] for p in files)  # customer 1 lay there
    again = {r["id_cliente"]: (r["cpf"], r["email"]) for r in privacy.keep_erased(shop["clientes.clientes"], w.read(privacy.TOMBSTONES), KEY).collect()}
    assert again == people


def test_retention_drops_whole_months(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, day("2020-01-05")), (2, day("2023-06-30")), (3, day("2023-07-01")), (4, None)], "id int, dia date")
    w.upsert(rows, "fato", ["id"], partition=month_partition(F.col("dia")))
    assert privacy.drop_expired(w, "fato", 3, date(2026, 7, 20)) == [202001, 202306]
    assert sorted(r["id"] for r in w.read("fato").collect()) == [3, 4]
    assert privacy.drop_expired(w, "fato", 3, date(2026, 7, 20)) == []
