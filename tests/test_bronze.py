import random
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import at, day, source_rows
from emporio.jobs.ingest import ingest
from emporio.plans.staging import refresh_staging
from emporio.quality.rules import check_batches
from emporio.registry import TABLES_BY_NAME
from emporio.sinks.bronze import append_bronze
from emporio.sinks.control import WatermarkLog, resolve_mode
from emporio.sinks.tables import Warehouse
from emporio.sources import bronze
from emporio.sources.jdbc import EPOCH, JdbcConf, histogram_query, reader_options, slices
from emporio.streaming.staging import stream_staging

STORES = TABLES_BY_NAME["rh.lojas"]
PRICES = TABLES_BY_NAME["produtos.precos"]


def stores(spark, *rows):
    return source_rows(spark, "rh.lojas", [dict(id_loja=i, codigo=c, updated_at=at(u)) for i, c, u in rows])


def land(spark, root, when, *rows):
    df = stores(spark, *rows)
    return append_bronze(df, STORES, str(root), at(when), df.count())


def codes(df):
    return {r["id_loja"]: r["codigo"] for r in df.collect()}


def test_partition_path_is_zero_padded():
    entry = TABLES_BY_NAME["vendas.pedidos"]
    path = bronze.partition_path(entry, "/b/", date(2026, 4, 3))
    assert path == "/b/vendas/pedidos/year=2026/month=04/day=03"


def test_append_and_read(spark, tmp_path):
    land(spark, tmp_path, "2026-04-03 10:00", (1, "A", "2026-04-01"), (2, "B", "2026-04-02"))
    land(spark, tmp_path, "2026-04-03 10:00", (3, "C", "2026-04-03"))
    land(spark, tmp_path, "2026-05-01 09:00", (1, "A2", "2026-04-30"))
    assert (tmp_path / "rh/lojas/year=2026/month=04/day=03").is_dir()
    df = bronze.read_bronze(spark, STORES, str(tmp_path))
    assert df.schema.names == STORES.bronze_schema.names and df.count() == 4
    assert bronze.read_bronze(spark, STORES, str(tmp_path), since=at("2026-04-03 10:00")).count() == 1
    assert bronze.batch_rows(spark, STORES, str(tmp_path), date(2026, 4, 3)) == 3
    assert bronze.batch_rows(spark, STORES, str(tmp_path), date(2026, 4, 4)) is None
    assert bronze.newest_file(spark, STORES, str(tmp_path)) is not None
    batches = {r["_ingested_at"]: r["passed"] for r in check_batches(df).collect()}
    assert sorted(batches.values()) == [False, True]  # two batches of one second share a key


def test_later_batches_prune_directories(spark, tmp_path):
    for when in ("2026-04-01", "2026-04-02", "2026-06-05"):
        land(spark, tmp_path, when, (1, "A", when))
    plan = bronze.read_bronze(spark, STORES, str(tmp_path), since=at("2026-05-01"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "year" in text[text.index("PartitionFilters"):][:200]


def test_missing_table_reads_empty(spark, tmp_path):
    assert bronze.read_bronze(spark, PRICES, str(tmp_path)).count() == 0
    assert bronze.missing_tables(spark, [PRICES], str(tmp_path)) == ["produtos.precos"]
    assert bronze.newest_file(spark, PRICES, str(tmp_path)) is None


def test_tolerant_read_of_drifted_files(spark, tmp_path):
    base = tmp_path / "produtos/precos/year=2026/month=01"

    def write(d, sql):
        spark.sql(sql).write.parquet(str(base / f"day={d:02d}"))

    write(1, "SELECT 1 AS id_preco, 7 AS id_produto, CAST(10.50 AS DECIMAL(4,2)) AS preco_venda, "
             "TIMESTAMP '2026-01-01 00:00:00' AS updated_at, '2026-01-01T10:00:00+00:00' AS _ingested_at")
    write(2, "SELECT 2D AS id_preco, 2.5D AS id_produto, CAST(1000.5 AS DECIMAL(5,1)) AS preco_venda, "
             "'2026-01-02' AS updated_at, '2026-01-02T10:00:00+00:00' AS _ingested_at, 'x' AS extra")
    write(3, "SELECT CAST(NULL AS INT) AS id_preco, 9L AS id_produto WHERE false")
    df = bronze.read_bronze_tolerant(spark, PRICES, str(tmp_path))
    assert df.schema.names == PRICES.bronze_schema.names
    rows = {r["id_preco"]: r for r in df.collect()}
    assert set(rows) == {1, 2}
    assert rows[2]["id_produto"] == 2  # half to even
    assert [str(rows[i]["preco_venda"]) for i in (1, 2)] == ["10.50", "1000.50"]
    assert rows[1]["custo_unitario"] is None and rows[1]["_ingested_at"] is not None


def test_watermark_log(spark, tmp_path):
    log = WatermarkLog(spark, str(tmp_path))
    assert log.read(STORES) == EPOCH
    log.touch(STORES, at("2026-01-01"))
    assert log.read(STORES) == EPOCH  # checked, nothing extracted yet
    log.commit(STORES, at("2026-04-21 12:00"), at("2026-04-22"))
    assert log.read(STORES) == at("2026-04-21 12:00")
    log.touch(STORES, at("2026-04-23"))
    assert log.read(STORES) == at("2026-04-21 12:00")
    row = log.current().select(F.date_format("last_checked_at", "yyyy-MM-dd"), F.date_format("updated_at_utc", "yyyy-MM-dd")).first()
    assert list(row) == ["2026-04-23", "2026-04-22"]
    assert log.read(PRICES) == EPOCH


def test_modes(spark, tmp_path):
    assert resolve_mode(spark, STORES, "smart", str(tmp_path)) == "full"
    land(spark, tmp_path, "2026-04-03", (1, "A", "2026-04-01"))
    assert resolve_mode(spark, STORES, "smart", str(tmp_path)) == "incremental"
    assert resolve_mode(spark, STORES, "full", str(tmp_path)) == "full"
    with pytest.raises(ValueError):
        resolve_mode(spark, STORES, "other", str(tmp_path))


def test_ingest_moves_the_mark_and_isolates_failures(spark, tmp_path):
    rows = [(1, "A", "2026-01-01"), (2, "B", "2026-02-01")]

    def extract(entry, mark):
        if entry.full_name == "produtos.precos":
            raise RuntimeError("source down")
        return stores(spark, *rows).filter(F.col("updated_at") > F.lit(mark))

    names = ["rh.lojas", "produtos.precos"]
    first = ingest(spark, str(tmp_path), extract, "smart", names, at("2026-03-01"))
    assert [(r.name, r.ok) for r in first] == [("rh.lojas", True), ("produtos.precos", False)]
    assert first[0].value["rows"] == 2 and "source down" in first[1].error
    assert ingest(spark, str(tmp_path), extract, "smart", ["rh.lojas"], at("2026-03-02"))[0].value["status"] == "skip"
    rows += [(3, "C", "2026-02-15"), (4, "late", "2026-01-15")]
    again = ingest(spark, str(tmp_path), extract, "incremental", ["rh.lojas"], at("2026-03-03"))
    assert again[0].value["rows"] == 1  # the late row is below the mark and never extracted
    assert codes(bronze.read_bronze(spark, STORES, str(tmp_path))) == {1: "A", 2: "B", 3: "C"}


def test_jdbc_options_slice_the_watermark_range():
    conf = JdbcConf("jdbc:postgresql://h/db", user="u", password="secret")
    options = reader_options(STORES, conf, EPOCH, EPOCH + timedelta(days=10), partitions=4)
    assert options["dbtable"] == "rh.lojas" and options["fetchsize"] == "50000"
    assert options["partitionColumn"] == "updated_at" and options["numPartitions"] == "4"
    assert "secret" not in repr(conf) and "driver" not in options
    assert "partitionColumn" not in reader_options(STORES, conf, EPOCH, EPOCH, partitions=4)


def test_staging_keeps_the_newest_version_over_batches(spark, tmp_path):
    root, w = tmp_path / "bronze", Warehouse(spark, str(tmp_path / "w"))
    land(spark, root, "2026-04-03", (1, " A ", "2026-04-01"), (2, "B", "2026-04-02"), (2, "B0", "2026-04-01"))
    assert codes(refresh_staging(spark, STORES, str(root), w)) == {1: "A", 2: "B"}
    land(spark, root, "2026-04-04", (1, "old", "2026-03-01"), (2, "B2", "2026-04-03"), (9_000_000, "far", "2026-04-04"))
    assert codes(refresh_staging(spark, STORES, str(root), w)) == {1: "A", 2: "B2", 9_000_000: "far"}
    assert codes(refresh_staging(spark, STORES, str(root), w)) == {1: "A", 2: "B2", 9_000_000: "far"}
    full = refresh_staging(spark, STORES, str(root), w, full_refresh=True)
    assert codes(full) == {1: "A", 2: "B2", 9_000_000: "far"}
    assert full.schema.names == STORES.staging_schema.names


def test_stream_catches_up_and_equals_batch(spark, tmp_path):
    root, w = tmp_path / "bronze", Warehouse(spark, str(tmp_path / "w"))

    def content(w, name):
        return spark.read.parquet(f"{w.root}/{name}/_commits").where("batch_id IS NOT NULL").count()

    def run(checkpoint="cp"):
        query = stream_staging(spark, STORES, str(root), w, str(tmp_path / checkpoint), files_per_trigger=1)
        assert query.awaitTermination(120)
        return codes(w.read(STORES.staging_name))

    land(spark, root, "2026-04-03", (1, "A", "2026-04-01"), (2, "B", "2026-04-02"))
    land(spark, root, "2026-04-04", (2, "B2", "2026-04-03"))
    assert run() == {1: "A", 2: "B2"}
    before = content(w, STORES.staging_name)
    assert run() == {1: "A", 2: "B2"} and content(w, STORES.staging_name) == before
    land(spark, root, "2026-04-05", (2, "late", "2026-04-01"), (3, "C", "2026-04-05"))
    assert run() == {1: "A", 2: "B2", 3: "C"}
    # A checkpoint that starts anew numbers its batches from 0 and still brings every row.
    land(spark, root, "2026-04-06", (4, "D", "2026-04-06"))
    assert run("moved") == {1: "A", 2: "B2", 3: "C", 4: "D"}
    land(spark, root, "2026-04-07", (5, "E", "2026-04-07"))
    assert run("moved") == {1: "A", 2: "B2", 3: "C", 4: "D", 5: "E"}


def test_partitioned_upsert_moves_rows_and_touches_only_their_months(spark, tmp_path):
    from emporio.sinks.tables import month_partition

    w = Warehouse(spark, str(tmp_path))
    part = month_partition(F.col("d"))

    def frame(*rows):
        return spark.createDataFrame([(k, day(d), v) for k, d, v in rows], "k int, d date, v string")

    w.upsert(frame((1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-05", "c")), "t", ["k"], part)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t/snapshot=1/particao=202403").iterdir()}
    w.upsert(frame((2, "2024-01-09", "b2"), (4, "2024-04-01", "d")), "t", ["k"], part)
    got = sorted((r["k"], str(r["d"]), r["v"]) for r in w.read("t").collect())
    assert got == [(1, "2024-01-05", "a"), (2, "2024-01-09", "b2"), (3, "2024-03-05", "c"), (4, "2024-04-01", "d")]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t/snapshot=1/particao=202403").iterdir()} == before
    assert not (tmp_path / "t/snapshot=1/particao=202402").exists()
    window = w.read_range("t", "d", date(2024, 1, 6), date(2024, 4, 1))
    assert sorted(r["k"] for r in window.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(particao" in window._jdf.queryExecution().executedPlan().toString()


def test_snapshot_replaces_columns_and_survives_an_abandoned_write(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), "t", ["k"])
    (tmp_path / "t/snapshot=2").mkdir()  # a run that died before its commit
    (tmp_path / "t/snapshot=2/junk.parquet").write_text("junk")
    w.upsert(spark.createDataFrame([(2, 5)], "k int, w int"), "t", ["k"])
    assert sorted(map(tuple, w.read("t").collect())) == [(1, None), (2, 5)]
    with pytest.raises(FileNotFoundError):
        w.read("other")


def test_slices_cover_every_row_once_and_have_equal_sizes(spark):
    """Skewed days, rows before the first and after the last counted day, NULL marks, a day larger than a slice."""
    rng = random.Random(4)
    first = datetime(1997, 3, 1, tzinfo=timezone.utc)
    rows = []
    for i in range(2000):
        day = 400 if rng.random() < 0.5 else int(rng.expovariate(0.01))
        rows.append((i, None if i % 97 == 0 else first + timedelta(days=day, seconds=rng.randrange(86_400))))
    df = spark.createDataFrame(rows, "id_loja int, updated_at timestamp")
    df.createOrReplaceTempView("lojas_cortadas")
    entry = replace(STORES, schema="x", table="y")
    for mark in (EPOCH, first + timedelta(days=50)):
        counted = spark.sql(histogram_query(entry, mark).replace("x.y", "lojas_cortadas")).collect()
        cut = slices(entry, [(r[0], r[1]) for r in counted], mark, rows=100)
        wanted = [i for i, t in rows if mark == EPOCH or (t is not None and t > mark)]
        # Rows that change after the count, before and after all days it knows.
        late = df.unionByName(spark.createDataFrame([(9001, first - timedelta(days=900)), (9002, first + timedelta(days=9999))], df.schema))
        late.createOrReplaceTempView("lojas_depois")
        parts = [[r[0] for r in spark.sql(f"SELECT id_loja FROM lojas_depois WHERE {p}").collect()] for p in cut]
        assert sorted(i for p in parts for i in p) == sorted([*wanted, 9002] + ([9001] if mark == EPOCH else []))
        assert max(map(len, parts)) <= 160 and len(parts) >= len(wanted) / 160
    assert slices(entry, [], EPOCH) == ["updated_at IS NOT NULL", "updated_at IS NULL"]
    assert slices(entry, [], first) == ["updated_at > TIMESTAMP '1997-03-01 00:00:00'"]


def test_a_batch_is_extracted_once_and_rows_without_a_mark_land(spark, tmp_path):
    rows = stores(spark, (1, "A", "2026-01-01")).unionByName(stores(spark, (2, "B", "2026-01-01")).withColumn("updated_at", F.lit(None).cast("timestamp")))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    extract = lambda entry, mark: rows.mapInArrow(counted, rows.schema)
    done = ingest(spark, str(tmp_path), extract, "full", ["rh.lojas"], at("2026-03-01"))
    assert done[0].value["rows"] == 2 and seen.value == 2
    assert codes(bronze.read_bronze(spark, STORES, str(tmp_path))) == {1: "A", 2: "B"}
    assert not list((tmp_path / "_extracted").iterdir())
