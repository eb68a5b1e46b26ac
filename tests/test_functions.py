import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from emporio.config import WarehouseConfig
from emporio.functions import rfm
from emporio.functions.keys import date_key, row_hash, surrogate_key
from emporio.functions.numeric import round_ratio, safe_divide
from emporio.plans.dimensions import build_calendar, build_channel
from emporio.sources.reference import HOLIDAY_SCHEMA, holidays, read_seed


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_surrogate_key_and_row_hash(spark):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    row = one(
        spark,
        surrogate_key(F.lit(12), F.lit(None).cast("int")),
        row_hash(F.lit("a"), F.lit(None).cast("string"), F.lit(True)),
        surrogate_key(F.lit("12.30").cast("decimal(12,2)"), F.lit(date(2024, 2, 29))),
        date_key(F.lit(date(2024, 2, 9))),
    )
    assert list(row) == [md5("12-NULL"), md5("a||true"), md5("12.30-2024-02-29"), 20240209]


def test_division_and_rounding(spark):
    row = one(
        spark,
        safe_divide(F.lit(1), F.lit(0)),
        safe_divide(F.lit(1), F.lit(None).cast("int")),
        round_ratio(F.lit(0.12345), 4),
        round_ratio(F.lit(-0.5), 0),
    )
    assert list(row) == [None, None, 0.1235, 0.0]


@pytest.mark.parametrize(
    "function,cases",
    [
        (rfm.rfm_recency, {30: 5, 31: 4, 90: 4, 91: 3, 180: 3, 181: 2, 365: 2, 366: 1, 999: 1, -3: 5}),
        (rfm.rfm_frequency, {0: 1, 1: 1, 2: 2, 4: 2, 5: 3, 10: 4, 19: 4, 20: 5}),
        (rfm.rfm_monetary, {0: 1, 799: 1, 800: 2, 2000: 3, 4999: 3, 5000: 4, 10000: 5}),
    ],
)
def test_scores_at_thresholds(spark, function, cases):
    df = spark.createDataFrame([(k,) for k in cases], "v int").select("v", function(F.col("v")).alias("s"))
    assert {r["v"]: r["s"] for r in df.collect()} == cases


def test_segments_cover_all_scores(spark):
    def expected(r, f, m):
        if r == 5 and f >= 4:
            return "Campeoes"
        if r >= 4 and f >= 3:
            return "Clientes_Fieis"
        if r == 5 and f <= 2:
            return "Novos_Clientes"
        if min(r, f, m) >= 3:
            return "Potencial_Fidelizacao"
        if r >= 4 and f <= 2 and m <= 2:
            return "Promissores"
        if r <= 2 and f >= 4 and m >= 4:
            return "Em_Risco"
        if r <= 2 and f >= 3:
            return "Hibernando"
        return "Perdidos" if r == f == m == 1 else "Regulares"

    grid = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(grid, "r int, f int, m int")
    got = df.select("r", "f", "m", rfm.rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert all(x["s"] == expected(x["r"], x["f"], x["m"]) for x in got)


def test_loyalty_levels(spark):
    cases = {(14999, 14): "Gold", (15000, 0): "Platinum", (0, 15): "Platinum", (6000, 0): "Gold", (0, 8): "Gold",
             (2000, 0): "Silver", (0, 3): "Silver", (1999, 2): "Bronze"}
    df = spark.createDataFrame(list(cases), "v int, n int")
    got = df.select("v", "n", rfm.loyalty_level(F.col("v"), F.col("n")).alias("l")).collect()
    assert {(r["v"], r["n"]): r["l"] for r in got} == cases


def test_calendar(spark):
    rows = {r["data_full"]: r for r in build_calendar(spark, WarehouseConfig(), extras=True).collect()}
    assert len(rows) == 1826
    black_fridays = sorted(d for d, r in rows.items() if r["fl_black_friday"])
    # The last Friday of November whose next Friday is in December.
    assert black_fridays == [date(2023, 11, 24), date(2024, 11, 29), date(2025, 11, 28), date(2026, 11, 27), date(2027, 11, 26)]
    leap = rows[date(2024, 2, 29)]
    assert (leap["sk_tempo"], leap["nome_mes"], leap["nome_dia_semana"], leap["ano_trimestre"]) == (
        20240229, "Fevereiro", "Quinta-feira", "2024-Q1")
    assert rows[date(2023, 1, 1)]["semana_iso"] == 52 and rows[date(2027, 1, 1)]["semana_iso"] == 53
    assert rows[date(2023, 1, 1)]["dia_semana_num"] == 0 and rows[date(2023, 1, 1)]["fl_feriado_nacional"]
    assert rows[date(2024, 7, 1)]["semestre"] == 2 and rows[date(2024, 7, 1)]["fl_dia_util"]
    assert not rows[date(2024, 2, 13)]["fl_dia_util"]


def test_holidays_by_rule_and_from_seed(spark, tmp_path):
    found = {(r["data"], r["tipo"]) for r in holidays(spark, 2023, 2027).collect()}
    assert len(found) == 59
    assert (date(2024, 2, 13), "movel") in found and (date(2026, 6, 4), "movel") in found
    assert (date(2023, 11, 20), "fixo") not in found and (date(2024, 11, 20), "fixo") in found
    seed = tmp_path / "seed.csv"
    seed.write_text("data,nome_feriado,tipo\n2024-01-02,Ponte,fixo\n")
    df = read_seed(spark, str(seed))
    assert df.schema == HOLIDAY_SCHEMA
    cal = build_calendar(spark, WarehouseConfig(calendar_end=date(2024, 1, 2)), df).filter("fl_feriado_nacional")
    assert [r["data_full"] for r in cal.collect()] == [date(2024, 1, 2)]


def test_channels(spark):
    rows = {r["canal_venda"]: r for r in build_channel(spark).collect()}
    assert len(rows) == 5
    assert rows["marketplace_ml"]["descricao_canal"] == "Mercado Livre"
    assert rows["site_proprio"]["plataforma"] == "Próprio" and rows["site_proprio"]["tipo_canal"] == "Digital"
