"""Small reference data: calendar days, holidays, sales channels, CSV seeds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporio.functions.calendar import easter

HOLIDAY_SCHEMA = T.StructType(
    [
        T.StructField("data", T.DateType()),
        T.StructField("nome_feriado", T.StringType()),
        T.StructField("tipo", T.StringType()),
    ]
)

# National holidays on a fixed date (month, day, name, first year).
FIXED_HOLIDAYS = (
    (1, 1, "Confraternização Universal (Ano Novo)", 1),
    (4, 21, "Tiradentes", 1),
    (5, 1, "Dia do Trabalhador", 1),
    (9, 7, "Independência do Brasil", 1),
    (10, 12, "Nossa Senhora Aparecida", 1),
    (11, 2, "Finados", 1),
    (11, 15, "Proclamação da República", 1),
    (11, 20, "Dia da Consciência Negra", 2024),
    (12, 25, "Natal", 1),
)
# National holidays by days from Easter Sunday.
MOVABLE_HOLIDAYS = (
    (-47, "Carnaval (Terça-Feira Gorda)"),
    (-2, "Paixão de Cristo (Sexta-Feira Santa)"),
    (60, "Corpus Christi"),
)
# Sales channels with label, kind and platform.
CHANNELS = (
    ("loja_fisica", "Loja Física", "Físico", "Próprio"),
    ("site_proprio", "Site Próprio", "Digital", "Próprio"),
    ("marketplace_ml", "Mercado Livre", "Digital", "Marketplace"),
    ("marketplace_amazon", "Amazon", "Digital", "Marketplace"),
    ("marketplace_shopee", "Shopee", "Digital", "Marketplace"),
)


def read_seed(spark: SparkSession, path: str, schema: T.StructType = HOLIDAY_SCHEMA) -> DataFrame:
    """A typed CSV with a header."""
    return spark.read.schema(schema).option("header", True).csv(path)


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """National holidays of the years, from their rules; same columns as the CSV seed."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").alias("year"))
    fixed = [
        F.when(
            F.col("year") >= since,
            F.struct(
                F.make_date(F.col("year").cast("int"), F.lit(month), F.lit(day)).alias("data"),
                F.lit(name).alias("nome_feriado"),
                F.lit("fixo").alias("tipo"),
            ),
        )
        for month, day, name, since in FIXED_HOLIDAYS
    ]
    movable = [
        F.struct(
            F.date_add(easter(F.col("year")), offset).alias("data"),
            F.lit(name).alias("nome_feriado"),
            F.lit("movel").alias("tipo"),
        )
        for offset, name in MOVABLE_HOLIDAYS
    ]
    return years.select(F.explode(F.array_compact(F.array(*fixed, *movable))).alias("h")).select("h.*")


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("data_full")
    )


def channels(spark: SparkSession) -> DataFrame:
    """The sales channels as inline rows."""
    return spark.createDataFrame(CHANNELS, "canal_venda string, descricao_canal string, tipo_canal string, plataforma string")
