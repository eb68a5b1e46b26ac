"""Mixing sources to target weights by pivotal dependent rounding.

The words of all documents are shared among the sources by weight; a target above ``MOST`` times its source's words
stops there and the rest is shared again.  A document of a source is to be taken ``target / words`` times: the whole
part for certain, the fraction ``p`` by dependent rounding.  Two documents with fractions left are paired; mass moves
from one to the other, in units of words, until one fraction is 0 or 1.  The direction is drawn so that each fraction
keeps its mean, and the words of a source stay what they were.  Each chunk of a source leaves at most one open
fraction; these meet in a tree of fan-in ``FAN_IN`` until one per source is left, decided by a last draw.  So each
source misses its target by less than one document.

Chunks are set by a hash of the document, and draws by a hash of the ids, so a rerun, on any number of executors, gives
the same mix.  Rows equal in id, source and text are rounded as one and share its copies.  A hot source is many chunks.  Nothing is gathered but three numbers per round of sharing.

Defined cases: NULL text has size 0; documents without words are never taken; NULL source is a source of its own, the
last; repeated rows each get the same copies; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import mix, stored

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
MOST = 3  # copies of a document at most, and the cap of a target
CHUNK_DOCS = 8192
FAN_IN = 64
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"

_STATE = "source string, times long, chunk long, row long, doc_id long, size long, base int, p double"


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``rank`` (from 0) of each source by code point, NULL last: ranges are sorted apart, counts give their offsets."""
    ordered = stored(
        sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    before = ordered.groupBy("part").count().withColumn(
        "before", F.sum("count").over(Window.orderBy("part")) - F.col("count")
    )  # one row per range
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return ordered.withColumn("inside", inside).join(before, "part").withColumn("rank", F.col("before") + F.col("inside") - 1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``: shares by weight, none above ``most`` sizes."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stored(ranked_sources(sizes).select("source", "source_size", weight.cast("long").alias("weight")), "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # Sources above their cap at a level stay above it as the level rises, so the level alone says which are capped.
    level = (0, 1)
    while True:
        capped = F.lit(level[0]).cast("decimal(38,0)") * F.col("weight") > F.lit(most * level[1]).cast("decimal(38,0)") * F.col("source_size")
        held, open_weight = table.agg(
            F.sum(F.when(capped, most * F.col("source_size")).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))
        ).first()
        rest = total - (held or 0)
        if not open_weight or (rest, open_weight) == level:
            break
        level = (rest, open_weight)
    share = F.lit(level[0]).cast("double") * F.col("weight") / F.lit(level[1]).cast("double")
    return table.select("source", "source_size", F.when(capped, (most * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def _uniform(a: int, b: int, salt: int) -> float:
    x = np.array([(a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + salt) & 0xFFFFFFFFFFFFFFFF], np.uint64)
    return float(mix(x)[0] >> np.uint64(11)) / (1 << 53)


def _pivot(level: int, seed: int):
    """Pairs the open fractions of a group until at most one is left."""

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row", "doc_id", "size"], kind="stable", ignore_index=True)
        p, ids = group["p"].to_numpy(float), group["row"].to_numpy()
        sizes = (group["size"] * group["times"]).to_numpy()
        p = p.copy()
        left = -1
        for j in np.flatnonzero((p > 0) & (p < 1)):
            if left < 0:
                left = j
                continue
            i, a, b = left, float(sizes[left]), float(sizes[j])
            up, down = min((1 - p[i]) * a, p[j] * b), min(p[i] * a, (1 - p[j]) * b)  # words that may move to i, and to j
            to_i = _uniform(int(ids[i]), int(ids[j]), seed + level) * (up + down) < down
            moved = up if to_i else -down
            pi, pj = p[i] + moved / a, p[j] - moved / b
            # the fraction that set the bound is integral exactly
            if to_i:
                pi, pj = (1.0, pj) if (1 - p[i]) * a <= p[j] * b else (pi, 0.0)
            else:
                pi, pj = (0.0, pj) if p[i] * a <= (1 - p[j]) * b else (pi, 1.0)
            p[i], p[j] = min(max(pi, 0.0), 1.0), min(max(pj, 0.0), 1.0)
            left = next((k for k in (i, j) if 0 < p[k] < 1), -1)
        group["p"] = p
        return group

    return reduce


def content(docs: DataFrame):
    return F.xxhash64(docs["doc_id"], docs["source"], docs["text"])


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, chunk_docs: int = CHUNK_DOCS
) -> DataFrame:
    """``(row, times, doc_id, source, size, source_size, target, copies, taken)`` per distinct row of ``docs``.

    ``row`` hashes the content, ``times`` counts the rows that have it, ``copies`` and ``taken`` are of each of them.
    """
    sized = docs.select(
        content(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size"),
    )
    sized = stored(sized.groupBy("row", "doc_id", "source", "size").agg(F.count("*").alias("times")), "sizes")
    facts = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("docs"))
    targets = stored(
        source_targets(facts.select("source", "source_size"), weights, most)
        .join(facts.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s"),
        "targets",
    )
    most_docs = targets.agg(F.max("docs")).first()[0] or 0
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # The chunk count is a power of two set by the largest source, whatever the cluster.
    chunks = 1 << max(0, math.ceil(math.log2(max(1, most_docs / chunk_docs))))
    state = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        F.col("d.source").alias("source"), "d.times", F.pmod(F.xxhash64("d.row", F.lit(seed)), F.lit(chunks)).alias("chunk"),
        "d.row", "d.doc_id", "d.size", F.least(F.floor(wanted), F.lit(most)).cast("int").alias("base"),
        F.when((F.col("d.size") > 0) & (F.floor(wanted) < most), wanted - F.floor(wanted)).otherwise(0.0).alias("p"),
    )
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    level, decided = 0, None
    while True:
        state = stored(state.groupBy("source", "chunk").applyInPandas(_pivot(level, seed), _STATE), f"pivot{level}")
        closed = state if chunks == 1 else state.where(~open_)
        decided = closed if decided is None else decided.unionByName(closed)
        if chunks == 1:
            break
        level, chunks = level + 1, -(-chunks // FAN_IN)
        state = state.where(open_).withColumn("chunk", F.floor(F.col("chunk") / FAN_IN).cast("long"))
    coin = F.pmod(F.xxhash64("row", F.lit(seed + 1)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    last = F.when(F.col("p") >= 1, 1).when(F.col("p") <= 0, 0).otherwise((coin < F.col("p")).cast("int"))
    copies = F.when(F.col("size") > 0, F.col("base") + last).otherwise(0)
    return decided.withColumn("copies", copies).alias("m").join(targets.alias("t"), F.col("m.source").eqNullSafe(F.col("t.source"))).select(
        "m.row", "m.times", "m.doc_id", "m.source", "m.size", "t.source_size", "t.target", F.col("m.copies").cast("int").alias("copies"),
        (F.col("m.copies") * F.col("m.size")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, one row each with ``size``, ``target``, ``copies`` and ``taken``.

    These four replace columns of ``docs`` that have their names.
    """
    made = ["size", "target", "copies", "taken"]
    added = mix_sources(docs, **options).where("copies > 0").select("row", F.struct(*made).alias("mix"))
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), content(docs).alias("row")).join(added, "row")
    return own.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in made], *[F.col(f"mix.{c}").alias(c) for c in made])


def op7(docs: DataFrame) -> DataFrame:
    each = mix_sources(docs).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return each.select("doc_id", "size", "source_size", "target", "taken")
