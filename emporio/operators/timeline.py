"""Versions from changes that arrive in any order, and facts that point at the version of their date.

A change says what an entity looked like from a day on.  It may be learnt long after that day, between two versions
already there, or more than once.  :func:`merge_timeline` turns versions and changes into versions that do not overlap,
:func:`moved_segments` tells on which days another version is in force than before, and :func:`repointed` returns just
the facts of those days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporio.functions.keys import UNKNOWN, row_hash, surrogate_key
from emporio.operators.joins import spread_nulls
from emporio.operators.scd2 import OPEN_END

def _last() -> Column:
    return F.lit(OPEN_END)


def _turns(versions: DataFrame, key: str, opened: Column, ended: Column) -> DataFrame:
    """The first day of each version, and the first day after each that has an end, in one pass over the versions."""
    first = F.struct(F.col("valid_from").alias("day"), opened.alias("state"))
    after = F.when(F.col("valid_to") < _last(), F.struct(F.date_add("valid_to", 1).alias("day"), ended.alias("state")))
    turns = versions.select(F.col(key).alias("key"), F.explode(F.array_compact(F.array(first, after))).alias("turn"))
    return turns.select("key", "turn.day", "turn.state")


def merge_timeline(
    versions: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], day: str, order: str, gone: str | None = None
) -> DataFrame:
    """Versions of ``versions`` after ``changes`` (D2, D3, D5), as ``key``, ``tracked`` and the version columns.

    ``changes`` has ``key``, ``tracked``, the ``day`` the state holds from, and ``order``, by which the later of two
    changes of one day wins, also over a version that starts there.  A change whose ``gone`` is true ends the entity
    until its next change.  A state holds until the next known one, so a backdated change leaves later versions as they
    are; a change that repeats the state before it starts no version.  Only entities with changes are sorted anew, and a
    day's changes are reduced to the last one before the sort, so that an entity sorts at most one row per day.  Changes
    without a key or day are left out.
    """
    known = changes.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    touched = known.select(F.col(key).alias("__touched")).distinct()
    out = [key, *tracked, "valid_from", "valid_to", "fl_current", "hash_row"]
    meets = F.col(key) == F.col("__touched")
    old, rest = versions.join(touched, meets, "left_semi"), versions.join(touched, meets, "left_anti")

    present = F.struct(row_hash(*tracked).alias("hash_row"), *tracked)
    absent = F.lit(None).cast(versions.select(present.alias("s")).schema["s"].dataType)
    nothing = F.lit(None).cast(known.schema[order].dataType)

    def event(rows: DataFrame, kind: Column, at: Column) -> DataFrame:
        # A wrapped state, as max_by would pass over a bare NULL state's fields alike.
        rank = F.struct(kind.alias("kind"), at.alias("order"), F.col("state.hash_row").alias("hash"))
        return rows.select("key", "day", F.struct("state").alias("held"), rank.alias("rank"))

    left = F.col(gone).eqNullSafe(F.lit(True)) if gone else F.lit(False)
    typed = [F.col(c).cast(versions.schema[c].dataType).alias(c) for c in tracked]
    told = known.select(F.col(key).alias("key"), F.col(day).alias("day"), F.col(order).alias("order"), left.alias("left"), *typed).select(
        "key", "day", "order", F.when(~F.col("left"), present).alias("state")
    )
    held_before = event(_turns(old, key, present, absent), F.col("state").isNotNull().cast("int"), nothing)
    events = held_before.union(event(told, F.lit(2), F.col("order")))
    daily = events.groupBy("key", "day").agg(F.max_by("held", "rank").alias("held"))
    line = Window.partitionBy("key").orderBy("day")
    before = F.lag("held").over(line)
    starts = daily.withColumn("__before", before["state"]["hash_row"]).filter(~F.col("held.state.hash_row").eqNullSafe(F.col("__before")))
    spans = starts.withColumn("valid_to", F.coalesce(F.date_sub(F.lead("day").over(line), 1), _last())).filter("held.state IS NOT NULL")
    merged = spans.select(
        F.col("key").alias(key), *[F.col(f"held.state.{c}").alias(c) for c in tracked], F.col("day").alias("valid_from"),
        "valid_to", (F.col("valid_to") == _last()).alias("fl_current"), F.col("held.state.hash_row").alias("hash_row"),
    )
    return rest.select(*out).unionByName(merged)


def version_key(entity: Column | str, valid_from: Column | str) -> Column:
    """Surrogate key of one version of an entity."""
    return surrogate_key(entity, valid_from)


def moved_segments(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Days on which another version is in force than before, or one instead of none, or none.

    ``(key, from_day, to_day, valid_from)``: closed ranges that do not overlap within a key, and the start of the version
    now in force, NULL where there is none.  Versions are the same if they start on the same day.  Both timelines are cut
    at every start and end of either, and each piece looks back to the last event of each side.  Either timeline is read
    once; a start is its own day, so an event is a day and a flag.  Versions without a key are left out.
    """

    def side(versions: DataFrame, n: int) -> DataFrame:
        turns = _turns(versions.filter(F.col(key).isNotNull()), key, F.lit(True), F.lit(False))
        opens = [F.col("state") if k == n else F.lit(None).cast("boolean") for k in (0, 1)]
        return turns.select("key", "day", *[c.alias(f"m{k}") for k, c in enumerate(opens)])

    # A start outdoes an end on the same day.
    events = side(before, 0).union(side(after, 1)).groupBy("key", "day").agg(F.max("m0").alias("m0"), F.max("m1").alias("m1"))
    line = Window.partitionBy("key").orderBy("day")
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    since = [F.when(F.col(f"m{k}").isNotNull(), F.struct(F.when(F.col(f"m{k}"), F.col("day")).alias("day"))) for k in (0, 1)]
    held = [F.last(c, ignorenulls=True).over(so_far)["day"] for c in since]
    pieces = events.select(
        F.col("key").alias(key), F.col("day").alias("from_day"), F.coalesce(F.date_sub(F.lead("day").over(line), 1), _last()).alias("to_day"),
        held[0].alias("__was"), held[1].alias("valid_from"),
    )
    return pieces.filter(~F.col("__was").eqNullSafe(F.col("valid_from"))).drop("__was")


def at_version(
    fact: DataFrame, versions: DataFrame, on: str, key: str, day: str, alias: str, default: str = UNKNOWN, spread_by: str | None = None
) -> DataFrame:
    """``fact`` with the key of the version of ``on`` in force on ``day``; ``default`` where there is none.

    Versions of an entity do not overlap, so a row meets at most one.  ``spread_by`` deals out rows without a key, which
    match nothing, when ``on`` is a number.
    """
    side = versions.select(F.col(key).alias("__key"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))
    equal = F.col(on) == F.col("__key")
    if spread_by:
        equal = spread_nulls(F.col(on), spread_by) == F.col("__key").cast("long")
    found = fact.join(side, equal & F.col(day).between(F.col("__from"), F.col("__to")), "left")
    link = F.when(F.col("__from").isNotNull(), version_key(on, "__from"))
    return found.select(*fact.columns, F.coalesce(link, F.lit(default)).alias(alias))


def followed(
    fact: DataFrame, segments: DataFrame, on: str, key: str, day: str, alias: str, hit: str, default: str = UNKNOWN
) -> DataFrame:
    """All facts, ``alias`` set to the version now in force and the flag ``hit`` raised on moved days."""
    side = segments.select(F.col(key).alias("__key"), "from_day", "to_day", F.col("valid_from").alias("__from"))
    rows = fact.join(side, (F.col(on) == F.col("__key")) & F.col(day).between(F.col("from_day"), F.col("to_day")), "left")
    moved = F.col("from_day").isNotNull()
    link = F.coalesce(F.when(F.col("__from").isNotNull(), version_key(on, "__from")), F.lit(default))
    new = {alias: F.when(moved, link).otherwise(F.col(alias)), hit: F.col(hit) | moved}
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in fact.columns])


def repointed(fact: DataFrame, segments: DataFrame, on: str, key: str, day: str, alias: str, default: str = UNKNOWN) -> DataFrame:
    """The facts on moved days only, ``alias`` set to the version now in force."""
    side = segments.select(F.col(key).alias("__key"), "from_day", "to_day", F.col("valid_from").alias("__from"))
    hit = fact.join(side, (F.col(on) == F.col("__key")) & F.col(day).between(F.col("from_day"), F.col("to_day")))
    link = F.coalesce(F.when(F.col("__from").isNotNull(), version_key(on, "__from")), F.lit(default))
    return hit.select(*[link.alias(c) if c == alias else F.col(c) for c in fact.columns])
