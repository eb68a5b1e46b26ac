"""Personal data: candidate spans, boosted trees, calibrated thresholds; DataFrame operations and Spark's own trees only.

Base spans come from fixed patterns and checks, and always stay.  High-recall generators propose further spans, which
may overlap one another: numbers in groups, telephone cores without a plus, mail addresses spelled out.  Gradient
boosted trees (``GBTClassifier``) score each by its format and the text around it.  They learn from at most ``SAMPLE``
candidates of the corpus, labelled by whether they touch a base span, and from a list of made-up examples; the threshold
is the lowest score above which held-out examples are right ``PRECISION`` of the time.  Accepted spans that touch no base
span and no better span are added.

Positions come from the pieces between matches, which the same pattern cuts.  Patterns are possessive and guarded so
that each text is scanned in linear time and without deep recursion, with the matches of the plain patterns.

One pass over the texts makes spans and candidates, which are small; texts are never shuffled.

Defined cases: NULL texts are empty; rows equal in id and text are scored alike; a corpus without candidates trains on
the made-up examples alone; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import given_id, identified, stored

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, written so that a long run of digits or letters is scanned once.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9](?:[\x20-]?[0-9]){13})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+"}  # a text without it has no match
NUMBER = r"(?<![A-Za-z0-9])[(+]?[0-9](?:[ ().\-/]{0,2}[0-9]){7,24}(?![A-Za-z0-9])"
CORE = r"(?<![A-Za-z0-9])\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}(?![A-Za-z0-9])"
SPELLED = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at |@) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]{2,63}){1,4}"
)
GENERATORS = (NUMBER, CORE, SPELLED)
BEFORE, AFTER = 24, 8  # characters around a candidate that its features see
SAMPLE = 6000  # candidates of each label that the trees learn from, at most
PRECISION = 0.95
TREES, DEPTH = 15, 3

_SPANS = "array<struct<start:int,end:int,m:string>>"


def found(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, m>>`` of the leftmost matches that do not overlap, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.split(text, pattern, -1), matches, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(done: Column, part: Column) -> Column:
        at, end = done["at"] + part["gap"], done["at"] + part["gap"] + F.length(part["m"])
        span = F.struct(at.alias("start"), end.alias("end"), part["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    return F.aggregate(F.filter(parts, lambda p: p["m"].isNotNull()), start, step, lambda done: done["out"])


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    back = F.reverse(number)
    places = F.sequence(F.lit(1), F.length(number))
    values = F.transform(places, lambda i: F.substring(back, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2))
    total = F.aggregate(F.transform(values, lambda v: F.when(v > 9, v - 9).otherwise(v)), F.lit(0), lambda a, v: a + v)
    return (F.length(number) > 0) & (total % 10 == 0)


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        short = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (F.coalesce(F.substring(p, 1, 3).cast("int"), F.lit(999)) <= 255))
    if kind == "card":
        return F.length(digits(m)).between(14, 19) & luhn(F.substring(digits(m), 1, 20))
    return F.length(digits(m)).between(10, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """``array<struct<start, kind, end>>`` of the base kinds, by start and then kind (its place in ``KINDS``)."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def of(k: int, kind: str) -> Column:
        valid = F.filter(found(text, BASE[kind]), lambda s: _valid(kind, s["m"]))
        spans = F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))
        return F.when(text.contains(NEEDS[kind]) if kind in NEEDS else text.rlike("[0-9]"), spans).otherwise(none)

    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)]))


def candidate_spans(text: Column) -> Column:
    """All generators' spans with the text around them."""
    each = [F.when(text.rlike("[0-9]") if g is not SPELLED else text.rlike("@|[ (\\[]at[ )\\]]"), found(text, g)).otherwise(F.array().cast(_SPANS)) for g in GENERATORS]
    return F.transform(
        F.array_distinct(F.concat(*each)),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m"),
            F.substring(text, F.greatest(F.lit(1), s["start"] + 1 - BEFORE), F.least(F.lit(BEFORE), s["start"])).alias("before"),
            F.substring(text, s["end"] + 1, F.lit(AFTER)).alias("after"),
        ),
    )


def _count(m: Column, what: str) -> Column:
    return F.length(m) - F.length(F.regexp_replace(m, what, ""))


def features() -> dict[str, Column]:
    """Numbers that describe a candidate ``(m, before, after)``."""
    m, before = F.col("m"), F.lower("before")
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")
    near = {
        "phone": "tel|phone|call|fax|mobil|whatsapp|handy|cel", "card": "card|visa|master|amex|credit|karte|carte|tarjeta",
        "mail": "mail|contact|write|reach|kontakt|correo|courriel", "other": "isbn|issn|date|price|total|version|order|page|\\$|€|no\\.",
    }
    made = {
        "digits": F.length(digits(m)), "length": F.length(m), "groups": F.size(groups),
        "first": F.length(F.coalesce(F.get(groups, F.lit(0)), F.lit(""))), "last": F.length(F.coalesce(F.try_element_at(groups, F.lit(-1)), F.lit(""))),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "spaces": _count(m, " "), "hyphens": _count(m, "-"), "dots": _count(m, r"\."), "slashes": _count(m, "/"),
        "parens": _count(m, "[()]"), "plus": m.startswith("+").cast("int"), "letters": _count(m, "[A-Za-z]"),
        "at_mark": m.rlike(r"@|\(at\)|\[at\]").cast("int"), "dot_mark": m.rlike(r"\(dot\)|\[dot\]| dot ").cast("int"),
        "tight": m.rlike(r"[A-Za-z0-9]\.[A-Za-z]{2,6}$").cast("int"), "year": m.rlike(r"^(19|20)[0-9]{2}[-/. ]").cast("int"),
        "luhn": (F.length(digits(m)).between(13, 19) & luhn(F.substring(digits(m), 1, 20))).cast("int"),
        "fits": F.col("after").rlike(r"^($|[\s,;.)])").cast("int"),
    }
    return made | {f"near_{k}": before.rlike(v).cast("int") for k, v in near.items()}


def _digits_from(seed: Column, n: int) -> Column:
    """``n`` digits, the same for the same seed."""
    return F.lpad(F.substring(F.regexp_replace(F.sha2(seed.cast("string"), 256), "[a-f]", ""), 1, n), n, "7")


def examples(spark: SparkSession, n: int = 40) -> DataFrame:
    """Made-up candidates with labels: ``n`` of each form."""
    d = lambda salt, k: _digits_from(F.concat(F.col("id"), F.lit(salt)), k)
    c = F.concat
    name = F.translate(d("n", 8), "0123456789", "aeiounrstl")
    forms = [
        (1, c(F.lit("("), d("a", 3), F.lit(") "), d("b", 3), F.lit("-"), d("c", 4)), "call me on "), (1, c(d("a", 3), F.lit("-"), d("b", 3), F.lit("-"), d("c", 4)), "phone: "),
        (1, c(d("a", 3), F.lit("."), d("b", 3), F.lit("."), d("c", 4)), "and "), (1, c(F.lit("0"), d("a", 3), F.lit(" "), d("b", 7)), "tel "),
        (1, c(d("a", 4), F.lit(" "), d("b", 4), F.lit(" "), d("c", 4), F.lit(" "), d("e", 4)), "card "), (1, c(name, F.lit(" (at) "), name, F.lit(" (dot) com")), "mail "),
        (1, c(name, F.lit("[at]"), name, F.lit("[dot]org")), "reach "), (1, c(F.lit("+"), d("a", 2), F.lit(" "), d("b", 3), F.lit(" "), d("c", 6)), "at "),
        (0, c(F.lit("2"), F.lit("0"), d("a", 2), F.lit("-"), d("b", 2), F.lit("-"), d("c", 2), F.lit(" "), d("e", 2)), "date "), (0, d("a", 9), "order no. "),
        (0, c(d("a", 3), F.lit("."), d("b", 3), F.lit("."), d("c", 3)), "total "), (0, c(F.lit("19"), d("a", 2), F.lit("-20"), d("b", 2)), "in "),
        (0, c(F.lit("978-"), d("a", 1), F.lit("-"), d("b", 4), F.lit("-"), d("c", 4), F.lit("-"), d("e", 1)), "isbn "), (0, d("a", 18), "and "),
        (0, c(name, F.lit(" at "), name, F.lit(". "), name), "was "), (0, c(d("a", 1), F.lit("."), d("b", 2), F.lit("."), d("c", 4), F.lit("."), d("e", 2)), "version "),
        (0, c(name, F.lit(" at "), name, F.lit(". "), name), "he "), (0, c(d("a", 2), F.lit("/"), d("b", 2), F.lit("/20"), d("c", 2)), "on "),
    ]
    rows = F.array(*[F.struct(F.lit(y).alias("label"), m.alias("m"), F.lit(b).alias("before"), F.lit(" and").alias("after")) for y, m, b in forms])
    return spark.range(n).select(F.col("id").cast("string").alias("id")).select(F.explode(rows).alias("r")).select("r.*")


@dataclass
class Scorer:
    """Fitted trees and the score from which a span is taken."""

    model: object
    threshold: float

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score``."""
        made = self.model.transform(rows.withColumns({f"f_{k}": v.cast("double") for k, v in features().items()}))
        return made.select(*rows.columns, vector_to_array("probability")[1].alias("score"))


def fit(labelled: DataFrame) -> Scorer:
    """Trees over ``labelled (label, m, before, after)``, a fifth of it held out for the threshold."""
    names = [f"f_{k}" for k in features()]
    rows = labelled.withColumns({f"f_{k}": v.cast("double") for k, v in features().items()})
    rows = rows.withColumn("label", F.col("label").cast("double")).withColumn("fold", F.pmod(F.xxhash64("m", "before"), F.lit(5)))
    rows = stored(rows.repartition(1).sortWithinPartitions("m", "before", "after"), "labelled")
    steps = [VectorAssembler(inputCols=names, outputCol="features"), GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, stepSize=0.3)]
    scorer = Scorer(Pipeline(stages=steps).fit(rows.where("fold > 0")), 1.0)
    bins = scorer.score(rows.where("fold = 0").select("m", "before", "after", "label")).groupBy(F.round("score", 2).alias("score")).agg(
        F.sum("label").alias("right"), F.count("*").alias("n")
    )
    right = n = 0
    for row in sorted(bins.collect(), key=lambda r: -r["score"]):  # at most 101 rows
        right, n = right + row["right"], n + row["n"]
        if right >= PRECISION * n and row["score"] >= 0.5:
            scorer.threshold = float(row["score"]) - 0.005
    return scorer


def all_spans(docs: DataFrame) -> DataFrame:
    """``(did, tkey, base, added)``: base spans, and accepted candidates as ``struct<start, kind, end>``."""
    spark = docs.sparkSession
    spans = stored(
        identified(docs).select("did", "tkey", base_spans(F.col("text")).alias("base"), candidate_spans(F.col("text")).alias("proposed")), "spans"
    )
    each = spans.where(F.size("proposed") > 0).select("did", "tkey", "base", F.explode("proposed").alias("p"))
    touches = F.exists("base", lambda b: (b["start"] < F.col("p.end")) & (F.col("p.start") < b["end"]))
    each = stored(each.select("did", "tkey", "p.*", touches.cast("int").alias("label")).dropDuplicates(), "proposed")
    order = F.xxhash64("did", "start", "m")
    part = [
        each.where(F.col("label") == y).select("label", "m", "before", "after", order.alias("o")).orderBy("o").limit(SAMPLE).drop("o") for y in (0, 1)
    ]
    # Unlabelled candidates are negatives only as far as the made-up ones say so: forms that look like those are no guide.
    scorer = fit(examples(spark).unionByName(part[1]))
    taken = scorer.score(each.where("label = 0")).where(F.col("score") >= scorer.threshold)
    n_digits = F.length(digits(F.col("m")))
    kind = (
        F.when(F.col("m").rlike("[A-Za-z]"), 0).when(F.col("m").rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), 1).when(n_digits >= 13, 2).otherwise(3)
    )
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), (F.col("start") - F.col("end")).alias("l"), "start", kind.alias("kind"), "end")))

    def keep(done: Column, s: Column) -> Column:
        clash = F.exists(done, lambda d: (d["start"] < s["end"]) & (s["start"] < d["end"]))
        span = F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        return F.when(clash, done).otherwise(F.concat(done, F.array(span)))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    added = taken.groupBy("did", "tkey").agg(best.alias("best")).select("did", "tkey", F.aggregate("best", none, keep).alias("added"))
    return spans.select("did", "tkey", "base").join(added, ["did", "tkey"], "left").withColumn("added", F.coalesce("added", none))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of personal data in ``text`` replaced by its kind in angle brackets."""
    spans = all_spans(docs).select("did", "tkey", F.array_sort(F.concat("base", "added")).alias("spans")).dropDuplicates(["did", "tkey"])
    own = identified(docs.select("doc_id", "text")).distinct().join(spans, ["did", "tkey"])
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring("text", done["at"] + 1, s["start"] - done["at"])
        covered = s["end"] <= done["at"]
        return F.when(covered, done).otherwise(F.struct(s["end"].alias("at"), F.concat(done["out"], gap, F.get(names, s["kind"])).alias("out")))

    text = F.aggregate("spans", start, step, lambda done: F.concat(done["out"], F.substring("text", done["at"] + 1, F.length("text"))))
    return own.select(given_id(F.col("did")).alias("doc_id"), text.alias("text"))


def op3(docs: DataFrame) -> DataFrame:
    def count(k: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}")

    counts = [count(k, kind) for k, kind in enumerate(KINDS)]
    return all_spans(docs).select(
        given_id(F.col("did")).alias("doc_id"), *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
