import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import day
from emporio.operators.dedup import latest_per_key
from emporio.operators.distinct import member_count, members, merged
from emporio.operators.incremental import between, high_water, last_days, newer_than
from emporio.operators.joins import Lookup, having_any, interval_join, orphans, star_lookup, tiles
from emporio.operators.periods import cohort, last_value, period_shifts, rolling_sums, trailing
from emporio.operators.ranking import cumulative_share, dense_rank_by, running_totals, share_of_total, top_n_per_group
from emporio.operators.scd2 import scd2_apply, scd2_as_of, scd2_columns
from emporio.operators.upsert import align, union_by_name, upsert


def test_latest_per_key_breaks_ties_by_content(spark):
    rows = [(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, None, "x"), (2, 5, "y"), (3, None, "n")]
    for n in (1, 4):
        df = spark.createDataFrame(rows, "k int, updated_at int, v string").repartition(n)
        assert sorted(map(tuple, latest_per_key(df, ["k"]).collect())) == [(1, 20, "c"), (2, 5, "y"), (3, None, "n")]


def test_latest_per_key_drops_losers_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("updated_at"))
    plan = latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_increments(spark):
    df = spark.createDataFrame([(day("2024-01-01"),), (day("2024-01-04"),), (day("2024-01-05"),)], "d date")
    assert high_water(df, "d") == date(2024, 1, 5) and high_water(None) is None
    assert newer_than(df, "d", None).count() == 3 and newer_than(df, "d", date(2024, 1, 4)).count() == 1
    assert last_days(df, "d", date(2024, 1, 5), 3).count() == 2
    assert between(df, "d", date(2024, 1, 1), date(2024, 1, 5)).count() == 2


def lookup(dim, **options):
    return Lookup(dim, "fk", "nk", options.pop("surrogate", "sk"), "MISS", "out", **options)


@pytest.mark.parametrize("spread", [None, "id"])
@pytest.mark.parametrize("surrogate", ["sk", lambda key: F.concat(F.lit("S"), key.cast("string"))])
def test_star_lookup(spark, spread, surrogate):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 10)], "id int, fk int")
    dim = spark.createDataFrame([(10, "S10", True), (99, "S99", False)], "nk int, sk string, fl_current boolean")
    got = star_lookup(fact, lookup(dim, surrogate=surrogate, spread_nulls_by=spread)).collect()
    assert {r["id"]: r["out"] for r in got} == {1: "S10", 2: "MISS", 3: "MISS", 4: "S10"}


def test_a_lookup_tells_the_natural_key_it_found(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 11)], "id int, fk int")
    dim = spark.createDataFrame([(10,), (10,), (None,)], "nk int")
    found = star_lookup(fact, lookup(dim, surrogate=lambda key: key.cast("string"), natural_alias="found"))
    assert sorted(map(tuple, found.collect())) == [(1, 10, "10", 10), (2, None, "MISS", None), (3, 11, "MISS", None)]


def test_hot_key_of_a_lookup_is_split(spark):
    """A third of the rows on one key, and a dimension too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spread = F.pmod(F.hash("id"), F.lit(20_000))
        fact = spark.range(0, 400_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(spread).alias("fk"))
        dim = spark.range(30_000).select(F.col("id").cast("int").alias("nk"))
        found = star_lookup(fact, lookup(dim, surrogate=lambda k: k.cast("string"), spread_nulls_by="id"))
        result = found.groupBy("out").count()
        assert result.filter("out = '7'").first()["count"] > 400_000 / 3
        result.collect()
        assert "SortMergeJoin(skew=true)" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_unused_lookup_leaves_the_plan(spark):
    fact = spark.range(10).select("id", F.col("id").alias("fk"))
    dim = spark.range(5).select(F.col("id").alias("nk"))
    used = star_lookup(fact, lookup(dim, surrogate=lambda k: k.cast("string"), spread_nulls_by="id"))
    plan = used.groupBy().sum("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_orphans_and_having_any(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "b"), (1, "b")], "k int, v string")
    dim = spark.createDataFrame([(1,)], "k int")
    assert [r["k"] for r in orphans(fact, dim, "k").collect()] == [2]
    both = having_any(fact.filter("k is not null"), "k", F.col("v") == "a", F.col("v") == "b")
    assert [r["k"] for r in both.collect()] == [1]


def test_interval_join_matches_brute_force(spark):
    rng = random.Random(1)
    start = date(2024, 1, 1)
    points = [(i, start + timedelta(days=rng.randrange(60))) for i in range(50)]
    ranges = [(i, start + timedelta(days=a), start + timedelta(days=a + rng.randrange(-1, 20)))
              for i, a in enumerate(rng.randrange(60) for _ in range(15))]
    expected = sorted((p, r) for p, d in points for r, lo, hi in ranges if lo <= d <= hi)
    p = spark.createDataFrame(points, "p int, d date")
    r = spark.createDataFrame(ranges, "r int, lo date, hi date")
    got = interval_join(p, r, "d", "lo", "hi")
    assert sorted((x["p"], x["r"]) for x in got.collect()) == expected
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_interval_join_with_open_ends_and_odd_ranges(spark):
    """Blocks of days stay few for open ends; NULL, backward, one-day and first-day ranges; left join keeps all rows."""
    rng = random.Random(3)
    first, last = date(1, 1, 1), date(9999, 12, 31)
    days = [first, date(1, 1, 2), date(1969, 12, 31), date(1970, 1, 1), date(2024, 2, 29), last, None]
    days += [date(2020, 1, 1) + timedelta(days=rng.randrange(2000)) for _ in range(40)]
    ranges = [(0, first, last), (1, last, last), (2, first, first), (3, None, last), (4, first, None), (5, date(2021, 1, 1), date(2020, 1, 1))]
    ranges += [(k, lo := rng.choice(days[7:]), rng.choice([last, lo, lo + timedelta(days=rng.randrange(900))])) for k in range(6, 40)]
    p = spark.createDataFrame(list(enumerate(days)), "p int, d date")
    r = spark.createDataFrame(ranges, "r int, lo date, hi date")
    expected = {(i, k) for i, d in enumerate(days) for k, lo, hi in ranges if None not in (d, lo, hi) and lo <= d <= hi}
    rows = interval_join(p, r, "d", "lo", "hi").collect()
    assert {(x["p"], x["r"]) for x in rows} == expected and len(rows) == len(expected)
    left = interval_join(p, r, "d", "lo", "hi", how="left").collect()
    assert {x["p"] for x in left} == set(range(len(days))) and len(left) == len(expected) + len(days) - len({i for i, _ in expected})
    sizes = [len(x["t"]) for x in r.filter("hi >= lo").select(tiles("lo", "hi").alias("t")).collect()]
    assert max(sizes) <= 2 * 22 and min(sizes) >= 1


def test_period_shifts_keep_gaps(spark):
    rows = [("a", day("2024-01-01"), 1), ("a", day("2024-02-01"), 2), ("a", day("2024-04-01"), 4),
            (None, day("2024-02-01"), 9), (None, day("2024-03-01"), 8)]
    df = spark.createDataFrame(rows, "k string, m date, v int")
    got = {(r["k"], r["m"].month): r["p"] for r in period_shifts(df, "m", "v", {"p": (1, 0)}, ["k"]).collect()}
    assert got == {("a", 1): None, ("a", 2): 1, ("a", 4): None, (None, 2): None, (None, 3): 9}


def test_trailing_rolling_and_last(spark):
    rows = [("p", day("2024-01-01"), 5), ("p", day("2024-01-10"), 7), ("p", day("2024-02-05"), 2), ("q", day("2024-01-10"), None)]
    df = spark.createDataFrame(rows, "k string, d date, v int")
    assert trailing(df, "d", date(2024, 1, 30), 30).count() == 3
    got = {(r["k"], r["d"]): r["s"] for r in rolling_sums(df, "d", {"s": F.col("v")}, 30, ["k"]).collect()}
    assert got[("p", date(2024, 1, 10))] == 12 and got[("p", date(2024, 2, 5))] == 9
    assert {r["k"]: r["x"] for r in last_value(df, ["k"], "v", F.col("d"), "x").collect()} == {"p": 2}


def test_cohort(spark):
    rows = [("a", day("2024-01-05")), ("a", day("2024-01-06")), ("a", day("2024-03-01")), ("b", day("2024-01-31")),
            ("c", day("2024-02-01"))]
    got = {(r["cohort"].month, r["offset"]): (r["active"], r["base"])
           for r in cohort(spark.createDataFrame(rows, "who string, d date"), "who", "d").collect()}
    assert got == {(1, 0): (2, 2), (1, 2): (1, 2), (2, 0): (1, 1)}


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_distributed_orderings_match_brute_force(spark, hot):
    """Running sums and ranks are exact for any share of tied rows."""
    rng = random.Random(7)
    rows = [(i, 50 if rng.random() < hot else rng.randrange(100)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(5)
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    total, running, expected = sum(v for _, v in rows), 0, {}
    for i, v in ordered:
        running += v
        expected[i] = running / total
    got = {r["id"]: r["cum_share"] for r in cumulative_share(df, "v", "id", parts=6).collect()}
    assert got == pytest.approx(expected)
    ranks = {v: k + 1 for k, v in enumerate(sorted({v for _, v in rows}, reverse=True))}
    got = {r["id"]: r["rank"] for r in dense_rank_by(df, "v", parts=6).collect()}
    assert got == {i: ranks[v] for i, v in rows}


def test_distributed_ordering_has_no_single_task_over_the_rows(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("v"))
    for plan in (running_totals(df, "v", "id", {"s": F.col("v")}), cumulative_share(df, "v", "id"), dense_rank_by(df, "v")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in text and text.count("Range (0, 5000") == 1  # one copy of the input


@pytest.mark.parametrize("values", [[None] * 40, [3] * 40, [None, 1] * 30, list(range(50)), [], [7]])
def test_orderings_whatever_the_ties(spark, values):
    """Runs of equal values, NULL among them, that go on over several parts, and empty parts."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int").repartition(3)
    known = sorted({v for v in values if v is not None}, reverse=True)
    ranks = {v: k + 1 for k, v in enumerate(known)} | {None: len(known) + 1}
    for parts in (1, 7):
        assert {r["id"]: r["rank"] for r in dense_rank_by(df, "v", parts=parts).collect()} == {i: ranks[v] for i, v in enumerate(values)}
        counted = running_totals(df, "v", "id", {"n": F.lit(1)}, parts=parts)
        order = sorted(range(len(values)), key=lambda i: (values[i] is None, -(values[i] or 0), i))
        assert {r["id"]: r["n"] for r in counted.collect()} == {i: k + 1 for k, i in enumerate(order)}


def test_running_totals_keep_rows_without_a_value(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, None), (5, 5)], "id int, v int")
    got = {r["id"]: r["s"] for r in running_totals(df, "v", "id", {"s": F.col("v")}, parts=3).collect()}
    assert got == {3: 7, 1: 12, 5: 17, 2: 17, 4: 17}


def test_period_shifts_clamp_at_month_ends(spark):
    days = ["2024-01-28", "2024-01-29", "2024-01-30", "2024-01-31", "2024-02-28", "2024-02-29", "2024-03-28", "2024-03-29", "2024-03-30", "2024-03-31"]
    df = spark.createDataFrame([(day(d), i, "x") for i, d in enumerate(days)], "d date, v int, other string")
    shifts = {"m": (1, 0), "w": (0, 7), "both": (2, 1)}
    got = {r["d"]: (r["m"], r["w"], r["both"]) for r in period_shifts(df, "d", "v", shifts).collect()}
    value = dict(zip(map(day, days), range(len(days))))
    joined = {r["d"]: tuple(value.get(r[c]) for c in ("m", "w", "b")) for r in df.select(
        "d", F.add_months("d", -1).alias("m"), F.date_sub("d", 7).alias("w"), F.date_sub(F.add_months("d", -2), 1).alias("b")).collect()}
    assert got == joined and len(got) == len(days)


def test_dense_rank_puts_missing_values_last(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 9), ("d", 5)], "k string, v int")
    assert {r["k"]: r["rank"] for r in dense_rank_by(df, "v").collect()} == {"c": 1, "a": 2, "d": 2, "b": 3}


def test_share_and_top_n(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 3), ("y", "c", 0)], "g string, k string, v int")
    assert {r["k"]: r["s"] for r in share_of_total(df, "v", "s").collect()} == {"a": 0.25, "b": 0.75, "c": 0.0}
    assert {r["k"]: r["s"] for r in share_of_total(df, "v", "s", ["g"]).collect()} == {"a": 0.25, "b": 0.75, "c": None}
    assert {r["k"] for r in top_n_per_group(df, ["g"], [F.desc("v")], 1).collect()} == {"b", "c"}


def test_upsert_is_idempotent_and_aligns(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = upsert(target, batch, ["k"])
    expected = [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, upsert(once, batch, ["k"]).collect())) == expected
    wide = union_by_name(target, spark.createDataFrame([(9, 1.5)], "k int, w double"))
    assert sorted(align(wide, ["w", "k"]).collect(), key=str)[0].__fields__ == ["w", "k"]


def test_upsert_by_time_keeps_the_newest(spark):
    target = spark.createDataFrame([(1, 20, "new")], "k int, t int, v string")
    late = spark.createDataFrame([(1, 10, "old"), (2, 1, "x")], "k int, t int, v string")
    assert sorted(map(tuple, upsert(target, late, ["k"], order_by=["t"]).collect())) == [(1, 20, "new"), (2, 1, "x")]


def test_scd2_history(spark):
    def source(rows):
        return spark.createDataFrame(rows, "nk int, uf string, nome string")

    first = scd2_columns(source([(1, "SP", "a"), (2, "RJ", "b"), (3, "MG", "c")]), F.lit(date(2024, 1, 1)), ["uf"])
    second = scd2_apply(first, source([(1, "PR", "a"), (2, "RJ", "B"), (4, "BA", "d")]), "nk", ["uf"], date(2024, 2, 1))
    got = sorted((r["nk"], r["uf"], r["nome"], r["valid_from"], r["valid_to"], r["fl_current"]) for r in second.collect())
    end, opened, closed = date(9999, 12, 31), date(2024, 2, 1), date(2024, 1, 31)
    assert got == [
        (1, "PR", "a", opened, end, True),
        (1, "SP", "a", date(2024, 1, 1), closed, False),
        (2, "RJ", "B", date(2024, 1, 1), end, True),  # untracked change updates in place
        (3, "MG", "c", date(2024, 1, 1), closed, False),
        (4, "BA", "d", opened, end, True),
    ]
    again = scd2_apply(second, source([(1, "SC", "a"), (2, "RJ", "B"), (4, "BA", "d")]), "nk", ["uf"], date(2024, 2, 1))
    ones = sorted((r["uf"], r["valid_to"]) for r in again.filter("nk = 1").collect())
    assert ones == [("SC", end), ("SP", closed)]
    facts = spark.createDataFrame([(1, day("2024-01-31")), (1, day("2024-02-01")), (3, day("2024-03-01"))], "nk int, d date")
    found = {(r["nk"], r["d"]): r["uf"] for r in scd2_as_of(facts, second, "nk", "d").collect()}
    assert found == {(1, date(2024, 1, 31)): "SP", (1, date(2024, 2, 1)): "PR", (3, date(2024, 3, 1)): None}


def test_members_of_days_merge_to_exact_distinct_counts(spark):
    """Ids in several ranges, negative and missing ones, late rows for a stored day, groups without members."""
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(5), rng.choice([None, -3, 0, 1, 32767, 32768, 32769, 10**9, *range(40)])) for _ in range(400)]
    schema = "loja string, dia int, quem long"
    first, late = rows[:300], rows[300:]
    stored = members(spark.createDataFrame(first, schema), ["loja", "dia"], "quem")
    state = merged([stored, members(spark.createDataFrame(late, schema), ["loja", "dia"], "quem")], ["loja", "dia"])
    for keys, of in ((["loja", "dia"], lambda r: r[:2]), (["loja"], lambda r: r[:1]), ([], lambda r: ())):
        want = {}
        for r in rows:
            if r[2] is not None:
                want.setdefault(of(r), set()).add(r[2])
        got = {tuple(r[k] for k in keys): r["n"] for r in member_count(state, keys, "n").collect()}
        assert got == {k: len(v) for k, v in want.items()}
    plan = member_count(stored, ["loja"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_members_far_apart_cost_a_row_each_not_a_range(spark):
    """Eight bytes per group and 64 ids, kept in a hash table; ids at the ends of the whole numbers count too."""
    far = [n * 10**6 for n in range(300)] + [2**63 - 1, -(2**63)]
    rows = [("longe", n) for n in far] + [("perto", n) for n in range(-640, 640)] * 2
    state = members(spark.createDataFrame(rows, "loja string, quem long"), ["loja"], "quem")
    assert state.schema["__bits"].dataType.simpleString() == "bigint"
    assert {r["loja"]: r["count"] for r in state.groupBy("loja").count().collect()} == {"longe": 302, "perto": 20}
    counted = member_count(merged([state, state], ["loja"]), ["loja"], "n")
    assert {r["loja"]: r["n"] for r in counted.collect()} == {"longe": 302, "perto": 1280}
    assert "SortAggregate" not in counted._jdf.queryExecution().executedPlan().toString()
