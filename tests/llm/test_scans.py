"""Archives, personal data, secrets, decontamination, quality and mixing against brute force, and odd tables."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm.decontaminate import clean, op4, proximity_matches
from llm.mixing import mixed, op7, source_targets
from llm.pii import op3, redacted
from llm.quality import Band, accepted, op9
from llm.secret_scan import RECALL, fitted, op6, scan_secrets
from llm.warc import MAGIC, op2, read_warc, write_warc
from tests.llm.corpus import SCHEMA, corpus, plain_words, spaced, text


@pytest.fixture(scope="module")
def rows():
    return corpus(2, 40)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(t: str) -> str:
    return hashlib.sha256(t.encode()).hexdigest()


# Archives


def pages(spark):
    fake = f"<p>{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n</p>"
    greedy = f"{MAGIC}Content-Length: 99999999\r\n\r\n"
    rows = [
        (1, "u1", "same"), (2, "u2\r\nX: y", "same"), (3, None, fake), (4, "u4", None), (5, "u5", ""), (6, "u6", fake), (7, "u7", greedy),
        (8, "é", "é" * 3000), (9, "u9", MAGIC * 3 + "end\r\n\r\n"), (2, "u2", "same"),
    ]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, file string")


def test_archives_round_trip(spark):
    rows, df = pages(spark)
    best = defaultdict(int)
    for i, _, h in rows:
        best[h or ""] = max(best[h or ""], i)
    want = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        top = best[h or ""]
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == top else "revisit", None if i == top else top)] += 1
    assert Counter(tuple(r) for r in op2(df).collect()) == want


def test_payloads_come_back_and_magic_inside_is_no_record(spark, tmp_path):
    rows, df = pages(spark)
    write_warc(df.coalesce(1), str(tmp_path / "w"))
    back = {r.page_id: r for r in read_warc(spark, str(tmp_path / "w"), payloads=True).where("record_type = 'response'").collect()}
    assert set(back) == {2, 5, 6, 7, 8, 9}
    assert all(back[i].payload == h for i, _, h in rows if i in back and h)
    assert 999 not in back


def test_large_uncompressed_archives_come_back(spark, tmp_path):
    df = spark.range(400).selectExpr("id AS page_id", "concat('u', id) AS url", "repeat(concat('x', id), 2000) AS html").coalesce(1)
    write_warc(df, str(tmp_path / "w"), "none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        back = read_warc(spark, str(tmp_path / "w"), payloads=True).select("page_id", "payload").collect()
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "300k"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.page_id, r.payload) for r in back) == [(k, f"x{k}" * 2000) for k in range(400)]
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "a.warc").write_bytes(b"WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    with pytest.raises(Exception, match="does not begin with"):
        read_warc(spark, str(tmp_path / "old"))


def test_no_pages(spark):
    assert op2(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# Personal data and secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def personal(t: str) -> list[tuple]:
    digits = lambda m: re.sub("[^0-9]", "", m)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def noisy(rng: random.Random, alphabet: str, n: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(n))


def written(spans, kinds) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans))


def test_personal_data_base_is_plain_patterns(spark):
    rng = random.Random(6)
    texts = [noisy(rng, "0123456789 -.+()a@", 300) for _ in range(60)] + [noisy(rng, "a.b@-%1 é", 200) for _ in range(60)]
    texts += ["é 4963780161091446, mail ünï x.y@a.b-c.de. +1 (736) 555-2678 or 25.86.162.211", "1" * 5000, "1 " * 3000, "a." * 4000 + "@" + "b." * 3000 + "c", None, ""]
    texts += ["0300.001.2.3 1.2.3.4.5.6.7.8 256.1.1.1", "4111 1111-1111 1111", "+1" + "(" * 2000, "\U0001f600 a@b.co"]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, base string").repartition(3)
    kinds = ("email", "ip", "card", "phone")
    got = {r.doc_id: r for r in op3(df).collect()}
    for k, t in enumerate(texts):
        base = personal(t or "")
        assert got[k].base_sha256 == sha(written(base, kinds)), t
        assert [got[k][f"n_{x}"] for x in kinds] == [sum(s[1] == i for s in base) for i in range(4)]
        assert set(filter(None, written(base, kinds).split(","))) <= set(got[k].spans.split(","))


def test_trees_add_spans_and_leave_prose_alone(spark):
    texts = ["please call me on (367) 555-7441 today", "reach anna [at] posteo [dot] org soon", "The prose at hand. Nothing in 1990-2005 here", "order no. 20240105"]
    got = {r.doc_id: r.spans for r in op3(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == "phone:18:32" and got[1].startswith("email:") and got[2] == "" and got[3] == ""
    df = spark.createDataFrame([(1, "a@b.co and +1 (736) 555-2678."), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in redacted(df).collect()} == {1: "<email> and <phone>.", 2: ""}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(t: str) -> list[tuple]:
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def test_secret_base_is_plain_patterns(spark):
    rng = random.Random(8)
    parts = ["token", "Secret", "password", "api_key", "=", ": ", "'", '"', "AKIA", "ABCDEFGH01234567", "0a1b2c3d4e5f", " ", "é", "x", "deadbeef", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(60)) for _ in range(120)] + ["é token = \"fc930bb8c5a78ce2d5\"", None, "", "AKIAAKIA" + "Q" * 30]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, n_hex int").repartition(3)
    got = {r.doc_id: r for r in op6(df).collect()}
    kinds = ("assign", "access", "hex")
    for k, t in enumerate(texts):
        base = secrets(t or "")
        assert got[k].base_sha256 == sha(written(base, kinds)), t
        assert [got[k][f"n_{x}"] for x in kinds] == [sum(s[1] == i for s in base) for i in range(3)]
        assert set(filter(None, written(base, kinds).split(","))) <= set(got[k].spans.split(","))


def test_network_finds_keys_it_has_no_pattern_for(spark):
    rng = random.Random(9)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = [f"use ghp_{noisy(rng, alnum, 36)} here" for _ in range(20)] + [text(rng, 60) for _ in range(20)]
    got = {r.doc_id: r.n_model for r in op6(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(got[k] > 0 for k in range(20)) >= 18 and sum(got[k] for k in range(20, 40)) == 0


def test_keys_late_in_a_run_or_beside_a_finding(spark):
    rng = random.Random(10)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    path = "artifacts/internal/build/config/prod/stable/v2/"
    texts = [f"see {path}ghp_{noisy(rng, alnum, 36)} here" for _ in range(20)]
    texts += [f"see {noisy(rng, '0123456789abcdef', 24)}/ghp_{noisy(rng, alnum, 36)} here" for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    net = fitted(df)
    got = {r.doc_id: r for r in scan_secrets(df, net).collect()}
    assert sum(got[k].n_model > 0 for k in range(20)) >= 18 and sum(got[k].n_model > 0 for k in range(20, 40)) >= 18
    assert all(got[k].n_hex == 1 for k in range(20, 40)) and net.recall >= RECALL and net.false_positives < 0.1


# Decontamination


def phrase_rows(rows, items) -> Counter:
    windows = defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(str(i))
    longs = {len(w) for w in windows}
    out = Counter()
    for r in rows:
        w, hit, found = plain_words(r[1]), set(), set()
        for n in longs:
            for k in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= ids
        out[(r[0], len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


def benchmark(rows):
    cut = lambda k, a, b: " ".join(plain_words(rows[k][1])[a:b])
    return [(1, cut(2, 3, 40)), (2, cut(4, 0, 13)), (3, cut(9, 5, 11)), (10, cut(2, 20, 60)), (5, None), (6, ""), (7, "Ba"), (8, "not there at all"), (2, cut(12, 1, 30).upper())]


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_phrase_matches_are_brute_force(spark, docs, rows, most, monkeypatch):
    monkeypatch.setattr("llm.decontaminate.BROADCAST_TERMS", most)
    items = benchmark(rows)
    bench = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, item string")
    got = Counter(tuple(r) for r in op4(docs, bench).collect())
    assert got == phrase_rows(rows, items)
    assert sum(k[5] for k in got) > 3
    bad = {k[0] for k in got if k[5]}
    kept = clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {k[0] for k in got} - bad


def test_proximity_allows_slack(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta gamma"), (2, "alpha beta gamma"), (3, "beta gamma alpha " + "x " * 30)], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "alpha beta")], "item_id string, text string")
    assert {r.doc_id for r in proximity_matches(docs, bench, slack=2).collect()} == {1, 2}


def test_no_benchmark(spark, docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in op4(docs, none).collect()} == {0} and clean(docs, none).count() == len(rows)


# Quality


def quality(t: str | None) -> tuple:
    w, t = spaced(t), t or ""
    seen, dup = set(), 0
    for line in t.split("\n"):
        if spaced(line):
            dup += line in seen
            seen.add(line)
    triples = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    count = Counter(triples)
    covered = {p for k, x in enumerate(triples) if count[x] > 1 for p in range(k, k + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_quality_counts_are_brute_force(docs, rows):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = op9(docs).collect()
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in got) == Counter((x[0], *quality(x[1])) for x in rows)
    assert all(not r.kept or not r.base_failed for r in got) and any(r.kept for r in got)


def test_fertility_is_that_of_whole_texts(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    t = "These words are plain 漢字 and ☃ snow " * 20
    ids = model.encode(t.strip())
    got = op9(spark.createDataFrame([(1, t, "en")], "doc_id long, text string, lang string")).first()
    assert math.isclose(got.byte_share, sum(model.is_byte(i) for i in ids) / len(ids), rel_tol=1e-9)


def test_bands_reject_by_language_or_script(spark):
    rng = random.Random(3)
    prose = "The old house by the river had a garden where many children used to play during the long summer days " * 1
    good = " ".join(f"{w}{rng.choice(['', ',', ''])}" for w in (prose + " and nobody knew who had planted the tall trees that stood around it, though some people in the village said that an old woman had done so many years before the war came to this quiet part of the country and changed it").split())
    noise = " ".join("".join(rng.choice("☃☄★۝ஃ፡ꭷ") for _ in range(5)) for _ in range(80))
    df = spark.createDataFrame([(1, good, "en", 1), (2, noise, "en", 1), (3, noise, None, 1)], "doc_id long, text string, lang string, kept int")
    got = {r.doc_id: r for r in op9(df).collect()}
    assert got[1].kept and not got[2].kept and not got[2].base_failed
    kept = accepted(df)
    assert kept.columns == df.columns and 1 in {r.doc_id for r in kept.collect()}
    strict = accepted(df, language_bands={"en": Band(9, 10, 0, 1)})
    assert 1 not in {r.doc_id for r in strict.collect()}


def test_bands_of_the_corpus_reject_junk_and_keep_prose(spark):
    """Letters that break into many tokens, in a language and in a table large enough for quartiles."""
    rng = random.Random(12)
    known = "the old house by river had garden where many children used to play during long summer days nobody knew who planted tall trees that stood around it".split()
    prose = [" ".join(rng.choice(known) + str(rng.randrange(10) or "") for _ in range(120)) for _ in range(150)]
    junk = [" ".join(rng.choice(known) + rng.choice(["***", "%%%", "&&&"]) + str(rng.randrange(10)) + "xq" for _ in range(120)) for _ in range(12)]
    rows = [(k, t, "en" if k % 10 else None, "x") for k, t in enumerate(prose + junk)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, by_lang string").repartition(3)
    got = {r.doc_id: r for r in op9(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[k].kept for k in range(150)) and not any(got[k].kept for k in range(150, 162) if k % 10)
    kept = accepted(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


# Mixing


def shares(sizes: dict) -> dict:
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [5, 2, 1] * len(sizes)))
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in sizes if s not in capped]
        target = {s: 3.0 * sizes[s] for s in capped} | {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("chunk", [8192, 2])
def test_mix_meets_targets(spark, docs, rows, chunk, monkeypatch):
    monkeypatch.setattr("llm.mixing.FAN_IN", 4)
    from llm.mixing import mix_sources

    each = mix_sources(docs, chunk_docs=chunk).collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in each:
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        sizes[r.source] += r["size"] * r.times
        taken[r.source] += r.taken * r.times
        largest[r.source] = max(largest[r.source], r["size"] * r.times)
    want = shares(sizes)
    for r in each:
        assert math.isclose(r.target, want[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    key = lambda rs: sorted((r.row, r.copies) for r in rs)
    assert key(each) == key(mix_sources(docs.repartition(7), chunk_docs=chunk).collect())


def test_mix_returns_every_row_and_keeps_means(spark, docs, rows):
    got = op7(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    kept = mixed(docs)
    assert set(kept.columns) == {*docs.columns, "size", "target", "copies", "taken"}
    assert kept.agg(F.sum("taken")).first()[0] == sum(r.taken for r in got)


def test_targets_of_many_sources(spark):
    rng = random.Random(2)
    sizes = {f"s{k:03d}": rng.choice([1, 5, 50, 4000]) for k in range(90)} | {None: 7}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got.keys() == sizes.keys() and all(math.isclose(got[s], t) for s, t in shares(sizes).items())


def test_empty_tables(empty, spark):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for out in (op3(empty), op4(empty, bench), op6(empty), op7(empty), op9(empty), accepted(empty), mixed(empty), clean(empty, bench), redacted(empty)):
        assert out.count() == 0
