"""Recency, frequency and monetary scores, segment and loyalty level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score cut points, best score first; anything else scores 1.
RECENCY_DAYS = ((30, 5), (90, 4), (180, 3), (365, 2))
FREQUENCY_ORDERS = ((20, 5), (10, 4), (5, 3), (2, 2))
MONETARY_VALUE = ((10000, 5), (5000, 4), (2000, 3), (800, 2))
# Level, least lifetime value, least number of orders.
LOYALTY_LEVELS = (("Platinum", 15000, 15), ("Gold", 6000, 8), ("Silver", 2000, 3))
LOWEST_LEVEL = "Bronze"
# Recency given to customers who never bought.
NEVER_BOUGHT_DAYS = 999


def _first_match(cases: list[tuple[Column, object]], default: object) -> Column:
    out = F.lit(default)
    for condition, value in reversed(cases):
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def rfm_recency(days: Column) -> Column:
    return _first_match([(days <= limit, score) for limit, score in RECENCY_DAYS], 1)


def rfm_frequency(orders: Column) -> Column:
    return _first_match([(orders >= limit, score) for limit, score in FREQUENCY_ORDERS], 1)


def rfm_monetary(value: Column) -> Column:
    return _first_match([(value >= limit, score) for limit, score in MONETARY_VALUE], 1)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment from the three scores; the first rule that holds wins."""
    return _first_match(
        [
            ((r == 5) & (f >= 4), "Campeoes"),
            ((r >= 4) & (f >= 3), "Clientes_Fieis"),
            ((r == 5) & (f <= 2), "Novos_Clientes"),
            ((r >= 3) & (f >= 3) & (m >= 3), "Potencial_Fidelizacao"),
            ((r >= 4) & (f <= 2) & (m <= 2), "Promissores"),
            ((r <= 2) & (f >= 4) & (m >= 4), "Em_Risco"),
            ((r <= 2) & (f >= 3), "Hibernando"),
            ((r == 1) & (f == 1) & (m == 1), "Perdidos"),
        ],
        "Regulares",
    )


def loyalty_level(lifetime_value: Column, orders: Column) -> Column:
    return _first_match(
        [((lifetime_value >= v) | (orders >= n), level) for level, v, n in LOYALTY_LEVELS], LOWEST_LEVEL
    )
