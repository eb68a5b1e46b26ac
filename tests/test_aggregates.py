"""Sums that follow the images of changed rows equal sums made anew."""

import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from emporio.plans.aggregates import MaintainedSums, Sums
from emporio.sinks.tables import Warehouse, micros, month_partition

SCHEMA = "id int, loja string, pedido int, dia date, valor decimal(12,2), ok boolean"


def spec():
    return Sums(
        "por_mes", "venda", {"loja": F.col("loja"), "mes": F.month("dia")}, {"valor": F.col("valor")},
        month_partition(F.col("dia")), F.col("ok"), {"pedidos": F.col("pedido")},
    )


def batch_of(rng, n):
    """New rows, returns (ok goes) and moved dates of old ones; a NULL store, day, order or value now and then."""
    rows = []
    for i in rng.sample(range(120), n):
        day = rng.choice([None, *[date(2024, 1, 1) + timedelta(days=k) for k in range(0, 200, 9)]])
        rows.append((i, rng.choice(["a", "b", None]), rng.choice([None, *range(8)]), day, rng.choice([None, Decimal(rng.randrange(999))]), rng.random() < 0.7))
    return rows


def expected(rows):
    groups = {}
    for _, store, order, day, value, ok in rows.values():
        if ok:
            total, orders = groups.setdefault((store, day.month if day else None), [Decimal(0), set()])
            groups[store, day.month if day else None][0] = total + (value or 0)
            orders.update([order] if order is not None else [])
    return {k: (v, len(o)) for k, (v, o) in groups.items()}


def content(df):
    return {(r["loja"], r["mes"]): (r["valor"], r["pedidos"]) for r in df.collect()}


def test_kept_sums_equal_a_rebuild(spark, tmp_path):
    w, rng, rows = Warehouse(spark, str(tmp_path)), random.Random(2), {}
    sums = MaintainedSums(w, spec())
    for n in range(5):
        batch = batch_of(rng, 50 if n == 0 else 15)
        rows |= {r[0]: r for r in batch}
        w.upsert(spark.createDataFrame(batch, SCHEMA), "venda", ["id"], partition=month_partition(F.col("dia")), images=True)
        if n == 2:
            continue  # two commits are followed at once
        assert content(sums.refresh()) == expected(rows)
        assert content(sums.refresh()) == expected(rows)  # nothing new
    before = w.marks("por_mes")
    w.upsert(spark.createDataFrame([], SCHEMA), "venda", ["id"], partition=month_partition(F.col("dia")), images=True)
    assert content(sums.refresh()) == expected(rows) and w.marks("por_mes") != before
    w.overwrite(w.read("venda").filter("id < 50"), "venda", partition=month_partition(F.col("dia")))
    assert w.images_since("venda", before["venda"]) is None  # a rebuild has no images
    assert content(sums.refresh()) == expected({i: r for i, r in rows.items() if i < 50})


def test_a_repeated_run_adds_nothing_twice(spark, tmp_path):
    """Groups that hold a commit pass over it, whichever of them were written before a run died."""
    w, rng = Warehouse(spark, str(tmp_path)), random.Random(5)
    first, second = batch_of(rng, 60), batch_of(rng, 40)
    rows = {r[0]: r for r in first + second}
    s = spec()
    w.upsert(spark.createDataFrame(first, SCHEMA), "venda", ["id"], partition=month_partition(F.col("dia")))
    held = s.whole(w.read("venda"), 0)
    held = spark.createDataFrame(held.collect(), held.schema)
    w.upsert(spark.createDataFrame(second, SCHEMA), "venda", ["id"], partition=month_partition(F.col("dia")), images=True)
    images = [(micros(at), df) for at, df in w.images_since("venda", w.last_commit("venda") - timedelta(microseconds=1))]
    done = s.changed(s.moved(images), held, w.read("venda"))
    whole = held.join(done.select("__grupo"), "__grupo", "left_anti").unionByName(done)
    half = held.filter("mes % 2 = 0 or mes is null").join(done.select("__grupo"), "__grupo", "left_anti").unionByName(
        done.filter("mes % 2 = 0 or mes is null")).unionByName(held.filter("mes % 2 = 1"))
    for state in (whole, half):
        again = s.changed(s.moved(images), state, w.read("venda"))
        merged = state.join(again.select("__grupo"), "__grupo", "left_anti").unionByName(again).filter("__linhas > 0")
        assert content(merged) == expected(rows)


def test_only_touched_months_are_read_and_written(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    rows = [(i, "a", i, date(2024, 1 + i % 6, 3), Decimal(i), True) for i in range(30)]
    w.upsert(spark.createDataFrame(rows, SCHEMA), "venda", ["id"], partition=month_partition(F.col("dia")))
    sums = MaintainedSums(w, spec())
    sums.refresh()
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "por_mes").rglob("*.parquet") if "particao" in str(p)}
    moved = [(0, "a", 0, date(2024, 2, 3), Decimal(5), True), (6, "a", 6, date(2024, 1, 3), Decimal(6), False)]
    w.upsert(spark.createDataFrame(moved, SCHEMA), "venda", ["id"], partition=month_partition(F.col("dia")), images=True)
    # Months without a change are gone from the fact: a read of them would fail or change the sums.
    for month in ("202403", "202404", "202405", "202406"):
        for p in (tmp_path / "venda" / "snapshot=1" / f"particao={month}").glob("*"):
            p.unlink()
    got = content(sums.refresh())
    assert got["a", 1] == (Decimal(12 + 18 + 24), 3) and got["a", 2] == (Decimal(1 + 7 + 13 + 19 + 25 + 5), 6) and len(got) == 6
    unchanged = {p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]}
    assert {str(p).split("particao=")[1][:6] for p in unchanged} == {"202403", "202404", "202405", "202406"}
