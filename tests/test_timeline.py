"""Timelines from backdated changes against brute force over days, and facts that follow them."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from emporio.functions.keys import row_hash
from emporio.operators.scd2 import OPEN_END
from emporio.operators.timeline import at_version, merge_timeline, moved_segments, repointed, version_key
from emporio.plans.versions import VersionLink, VersionLinks
from emporio.sinks.tables import Warehouse

START = date(2024, 1, 1)
DAYS = [START + timedelta(days=n) for n in range(60)]
CHANGES = "nk int, uf string, nivel int, dia date, ordem long, fim boolean"
VERSIONS = "nk int, uf string, nivel int, valid_from date, valid_to date, fl_current boolean"


def changes_of(rng, n, keys=6):
    return [(rng.randrange(keys), rng.choice("ABC"), rng.choice([1, None]), rng.choice(DAYS[:50]), k, rng.random() < 0.15) for k in range(n)]


def state_by_day(rows):
    """Entity and day to ``(state, since)`` of versions, by looking at every day."""
    out = {}
    for r in rows:
        for d in DAYS:
            if r["valid_from"] <= d <= r["valid_to"]:
                assert (r["nk"], d) not in out, "versions overlap"
                out[r["nk"], d] = ((r["uf"], r["nivel"]), r["valid_from"])
    return out


def told(before, changes, keys):
    """State on each day after the changes: the last event up to the day decides."""
    out = {}
    for nk in keys:
        events = {}
        for r in before:
            if r["nk"] == nk:
                events.setdefault(r["valid_from"], []).append(((1, 0), (r["uf"], r["nivel"])))
                if r["valid_to"] < OPEN_END:
                    events.setdefault(r["valid_to"] + timedelta(days=1), []).append(((0, 0), None))
        for k, uf, nivel, d, order, gone in changes:
            if k == nk and d is not None:
                events.setdefault(d, []).append(((2, order), None if gone else (uf, nivel)))
        state = None
        for d in DAYS:
            if d in events:
                state = max(events[d], key=lambda e: e[0])[1]
            if state is not None:
                out[nk, d] = state
    return out


@pytest.fixture(scope="module")
def first(spark):
    rows = [(k, "A", 1, DAYS[5], OPEN_END, True) for k in range(4)] + [(4, "B", None, DAYS[3], DAYS[9], False), (4, "C", 1, DAYS[20], OPEN_END, True)]
    return spark.createDataFrame(rows, VERSIONS).withColumn("hash_row", row_hash("uf", "nivel"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_is_what_each_day_was_told(spark, first, seed):
    rng = random.Random(seed)
    changes = changes_of(rng, 40) + [(None, "A", 1, DAYS[1], 99, False), (1, "A", 1, None, 98, False)]
    merged = merge_timeline(first, spark.createDataFrame(changes, CHANGES), "nk", ["uf", "nivel"], "dia", "ordem", "fim")
    rows = merged.collect()
    assert {k: s for k, (s, _) in state_by_day(rows).items()} == told(first.collect(), changes, range(6))
    for a in rows:  # neighbours differ, and only the last one is current
        assert a["fl_current"] == (a["valid_to"] == OPEN_END)
        assert not any(b["nk"] == a["nk"] and b["valid_from"] == a["valid_to"] + timedelta(days=1) and b["hash_row"] == a["hash_row"]
                       for b in rows if a["valid_to"] < OPEN_END)


def test_order_of_arrival_does_not_matter(spark, first):
    changes = changes_of(random.Random(8), 50)
    once = merge_timeline(first, spark.createDataFrame(changes, CHANGES), "nk", ["uf", "nivel"], "dia", "ordem", "fim")
    random.Random(9).shuffle(changes)
    again = merge_timeline(first, spark.createDataFrame(changes, CHANGES).repartition(5), "nk", ["uf", "nivel"], "dia", "ordem", "fim")
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_no_changes_and_no_versions(spark, first):
    none = spark.createDataFrame([], CHANGES)
    same = merge_timeline(first, none, "nk", ["uf", "nivel"], "dia", "ordem", "fim")
    assert sorted(map(str, same.collect())) == sorted(map(str, first.collect()))
    changes = spark.createDataFrame([(9, "A", 1, DAYS[4], 1, False)], CHANGES)
    new = merge_timeline(first.limit(0), changes, "nk", ["uf", "nivel"], "dia", "ordem").collect()
    assert [(r["nk"], r["valid_from"], r["valid_to"]) for r in new] == [(9, DAYS[4], OPEN_END)]


def test_moved_segments_and_repointed_facts(spark, first):
    changes = spark.createDataFrame(changes_of(random.Random(4), 30), CHANGES)
    after = merge_timeline(first, changes, "nk", ["uf", "nivel"], "dia", "ordem", "fim")
    was, now = state_by_day(first.collect()), state_by_day(after.collect())
    moved = {(nk, d) for nk in range(6) for d in DAYS if (was.get((nk, d)) or (0, 0))[1] != (now.get((nk, d)) or (0, 0))[1]}
    segments = moved_segments(first, after, "nk")
    got = {(r["nk"], d): r["valid_from"] for r in segments.collect() for d in DAYS if r["from_day"] <= d <= r["to_day"]}
    assert got == {k: now[k][1] if k in now else None for k in moved}
    facts = spark.createDataFrame([(n, n % 7 if n % 11 else None, DAYS[n % 60], "x") for n in range(300)], "id int, cliente int, dia date, outro string")
    stored = at_version(facts, first, "cliente", "nk", "dia", "sk", spread_by="id")
    wanted = {r["id"]: r["sk"] for r in at_version(facts, after, "cliente", "nk", "dia", "sk").collect()}
    before = {r["id"]: r["sk"] for r in stored.collect()}
    news = repointed(stored, segments, "cliente", "nk", "dia", "sk")
    assert news.columns == stored.columns
    assert {r["id"]: r["sk"] for r in news.collect()} == {i: k for i, k in wanted.items() if k != before[i]}
    assert moved_segments(after, after, "nk").count() == 0


def test_either_timeline_is_read_once(spark):
    """Its steps stand in the plan one time, and nothing is sorted to be grouped; rows without a key take no part."""

    def versions(n, start):
        nk = F.when(F.col("id") != 2, F.col("id")).alias("nk")
        return spark.range(n).select(nk, F.lit(start).alias("valid_from"), F.lit(OPEN_END).alias("valid_to"))

    segments = moved_segments(versions(4, DAYS[3]), versions(5, DAYS[5]), "nk")
    plan = segments._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 2 and "SortAggregate" not in plan
    gone = {(k, DAYS[3], DAYS[4], None) for k in (0, 1, 3)}
    assert {tuple(r) for r in segments.collect()} == gone | {(k, DAYS[5], OPEN_END, DAYS[5]) for k in (0, 1, 3, 4)}


def test_stored_links_follow_the_dimension(spark, first, tmp_path):
    """Batches of facts and of backdated changes in turn: the stored links equal links made anew, other months stay as they are."""
    w = Warehouse(spark, str(tmp_path))
    links = VersionLinks(w, "venda_versao", "id", "dia", [VersionLink("dim", "cliente", "nk", "sk_versao")])
    rng, facts, dim = random.Random(12), {}, first
    schema = "id int, cliente int, dia date"
    for n in range(3):
        batch = {i: (i, rng.choice([*range(6), None]), rng.choice(DAYS)) for i in rng.sample(range(200), 60)}
        facts |= batch
        changes = spark.createDataFrame(changes_of(rng, 6), CHANGES)
        after = merge_timeline(dim, changes, "nk", ["uf", "nivel"], "dia", "ordem", "fim")
        after = spark.createDataFrame(after.collect(), after.schema)
        stored = links.refresh(spark.createDataFrame(list(batch.values()), schema), {"dim": dim} if n else {}, {"dim": after})
        dim = after
        whole = at_version(spark.createDataFrame(list(facts.values()), schema), dim, "cliente", "nk", "dia", "sk_versao")
        assert sorted(map(str, stored.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    rebuilt = VersionLinks(Warehouse(spark, str(tmp_path / "b")), "venda_versao", "id", "dia", links.links)
    full = rebuilt.refresh(spark.createDataFrame(list(facts.values()), schema), {}, {"dim": dim})
    assert sorted(map(str, full.collect())) == sorted(map(str, w.read("venda_versao").collect()))


def test_only_months_of_moved_facts_are_rewritten(spark, first, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    links = VersionLinks(w, "v", "id", "dia", [VersionLink("dim", "cliente", "nk", "sk_versao")])
    facts = spark.createDataFrame([(1, 0, date(2024, 1, 20)), (2, 0, date(2024, 2, 20)), (3, 1, date(2024, 2, 21))], "id int, cliente int, dia date")
    links.refresh(facts, {}, {"dim": first})
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "v").rglob("*.parquet") if "snapshot" in str(p)}
    changes = spark.createDataFrame([(0, "C", 1, date(2024, 2, 1), 1, False)], CHANGES)
    after = merge_timeline(first, changes, "nk", ["uf", "nivel"], "dia", "ordem", "fim")
    links.refresh(facts.limit(0), {"dim": first}, {"dim": after})
    kept = {p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]}
    assert kept == {p for p in files if "particao=202401" in str(p)} and kept
    keys = {r["id"]: r["sk_versao"] for r in w.read("v").collect()}
    expected = spark.createDataFrame([(1, 0, DAYS[5]), (2, 0, date(2024, 2, 1)), (3, 1, DAYS[5])], "id int, nk int, d date")
    assert keys == {r["id"]: r["k"] for r in expected.select("id", version_key("nk", "d").alias("k")).collect()}
