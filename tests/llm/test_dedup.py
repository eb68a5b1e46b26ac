"""Dedup operators against brute force, and odd tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from llm.edits import within_limits
from llm.lines import SIMILARITY, normal_line, op8, simhashes, within, without_repeats, word_edits
from llm.ngram_join import fewest_agreements, one_of_each, op5
from llm.substring import op10, packed_places, places_of
from llm.suffix import op1, suffix_array
from tests.llm.corpus import SCHEMA, corpus, later_words, plain_words, repeats_of_bytes, shingles, text


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_suffix_dedup_is_brute_force(docs, rows):
    want = Counter({(i, n, r, s, sha(b)): c for (i, n, r, s, b), c in repeats_of_bytes(rows).items()})
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op1(docs).collect())
    assert got == want
    assert sum(k[2] > 0 for k in got) > 15


def test_suffix_array_sorts_suffixes_of_stretches():
    import numpy as np

    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 3, 300).astype(np.uint64)
    ends = np.repeat([100, 101, 250, 300], [100, 1, 149, 50])
    suffixes = [symbols[i : ends[i]].tolist() for i in suffix_array(symbols, ends)]
    assert suffixes == sorted(suffixes) and len(suffixes) == 300


def test_places_in_order_pack_to_less_than_a_byte_and_a_half():
    import zlib

    import numpy as np

    rng = np.random.default_rng(4)
    for places in (np.cumsum(rng.integers(1, 90, 5000)), rng.integers(0, 1 << 32, 300), np.zeros(0, np.int64), np.array([2**32 - 1, 0, 7])):
        assert places_of(packed_places(places)).tolist() == places.tolist()
    places = np.concatenate([np.cumsum(rng.integers(1, 90, 5000)), np.cumsum(rng.integers(1, 90, 5000))])  # two documents
    assert len(zlib.compress(packed_places(places), 1)) < 1.5 * len(places)


def test_substring_dedup_is_brute_force(docs, rows):
    want = Counter({(i, n, r, sha(t.encode())): c for (i, n, r, t), c in later_words(rows).items()})
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op10(docs).collect())
    assert got == want
    assert sum(k[2] > 0 for k in got) > 10


def near_classes(rows) -> dict[int, tuple[int, int]]:
    """Row number to (smallest id of its class, links)."""
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def find(a):
        return a if up[a] == a else find(up[a])

    links = Counter()
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                up[find(a)] = find(b)
    last = 1 << 62
    best = {}
    for k, r in enumerate(rows):
        best[find(k)] = min(best.get(find(k), last), last if r[0] is None else r[0])
    return {k: (None if best[find(k)] == last else best[find(k)], links[k]) for k in range(len(rows))}


def test_jaccard_join_is_brute_force(docs, rows):
    want = near_classes(rows)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in op5(docs).collect())
    assert got == Counter((rows[k][0], c, n) for k, (c, n) in want.items())
    assert max(n for _, _, n in got) > 5


def test_one_document_of_each_class_stays(docs, rows):
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= set(rows)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    classes = near_classes(rows)
    alone = {(rows[k][0], rows[k][1]) for k, (_, n) in classes.items() if not n}
    assert alone <= set(got)
    assert len(got) == len({c if n else ("alone", rows[k][0], rows[k][1]) for k, (c, n) in classes.items()})


def test_pruning_keeps_pairs_at_the_threshold():
    least = fewest_agreements()
    assert all(0 < m < 0.8 * 16 * (k + 1) for k, m in enumerate(least))


def lev(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_within_is_edit_distance():
    rng = random.Random(4)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(14)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(14)))
        d = lev(a, b)
        assert within(a, b, d) and not (d and within(a, b, d - 1))


def test_distances_in_batches_are_edit_distances():
    """Strings of any length and script, limits around the true distance, mixed lengths in one batch."""
    rng, pairs, limits, want = random.Random(9), [], [], []
    for _ in range(200):
        a = [rng.choice("abcdé漢") for _ in range(rng.choice([0, 1, 5, 30, 63, 64, 65, 129, 200]))]
        b = list(a)
        for _ in range(rng.randrange(0, max(2, len(a) // 5))):
            p = rng.randrange(len(b) + 1)
            b[p : p + rng.randrange(2)] = rng.choice(["", "x", "é"])
        a, b = "".join(a), "".join(b)
        d = lev(a, b)
        for limit in {max(0, d - 1), d, d + 1, len(a) // 10}:
            pairs.append((a, b))
            limits.append(limit)
            want.append(d <= limit)
    assert within_limits(pairs, limits, within) == want
    for a, b in pairs[:100]:
        assert word_edits(a.split(" "), b.split(" ")) >= lev(a, b)


def test_edit_distances_of_many_steps_go_together(monkeypatch):
    """Lines that share nine tenths of their words and are not similar: their pairs are put to edit distance in few batches."""
    import numpy as np

    from llm import lines as module

    rng, calls = random.Random(8), []
    same = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(54)) for _ in range(5)]
    lines = []
    for k in range(40):
        w = same[k % 5].split()
        for at in rng.sample(range(54), 8):  # more than a tenth of the letters
            w[at] = "".join(rng.choice("stuvwxyz") for _ in range(6 + k % 2))
        lines.append(" ".join(w))
    lines.append(lines[0].replace("a", "b", 3))
    monkeypatch.setattr(module, "within_limits", lambda pairs, *a: calls.append(len(pairs)) or within_limits(pairs, *a))
    n = len(lines)
    found = module.similar_pairs(np.zeros(n, np.int64), np.ones((n, 2), np.uint64), np.arange(n), lines, SIMILARITY)
    up = list(range(n))
    for a in range(n):
        for b in range(a):
            if within(lines[a], lines[b], int((1 - SIMILARITY) * max(len(lines[a]), len(lines[b])) + 1e-9)):
                up = [up[b] if x == up[a] else x for x in up]
    assert all((found.find(a) == found.find(b)) == (up[a] == up[b]) for a in range(n) for b in range(n))
    assert sum(calls) > 50 and len(calls) <= 3


def test_pieces_of_a_block_meet_where_lengths_are_similar(monkeypatch):
    """Every pair of similar lengths is in one task or more, a line goes to few pieces, and joint tasks compare the same pairs."""
    import numpy as np
    import pandas as pd

    from llm import lines as module

    monkeypatch.setattr(module, "RUN", 16)
    rng = np.random.default_rng(6)
    length = rng.integers(60, 1200, 700)
    key, block = rng.permutation(700).astype(np.uint64), np.zeros(700, np.uint32)
    # One block that all lines have, and five that most of them have.
    low, key, size = (np.concatenate([x] + [y] * 5) for x, y in ((block, block[:600]), (key, key[:600]), (length, length[:600])))
    low[700:] += 1 + np.arange(3000, dtype=np.uint32) // 600
    payload = low.tobytes() + key.tobytes() + size.astype(np.uint16).tobytes()
    out = module._shared(SIMILARITY)(pd.DataFrame({"bucket": [0], "payload": [payload]}))
    assert len(out) == 3700
    of = dict(zip(key.tolist(), size.tolist()))
    rows = [(r.least, min(r.own, k), max(r.own, k), r.meet, r.own, r.id) for r in out.itertuples() for k in range(r.low, r.high + 1)]
    assert (out["high"] - out["low"] + 1).mean() < 0.4 * (out["own"].max() + 1)
    table = pd.DataFrame(rows, columns=["least", "bi", "bj", "meet", "own", "id"]).sort_values(["least", "bi", "bj", "id"], kind="stable").reset_index(drop=True)
    lists = table.groupby(["least", "bi", "bj", "id"], sort=True).ngroup().to_numpy()
    one = table.groupby(["least", "bi", "bj", "id"], sort=True).first().reset_index()
    group = one.groupby(["least", "bi", "bj"], sort=True).ngroup().to_numpy()
    task, has, row = module.shared_tasks(group, one["bi"].to_numpy(), one["bj"].to_numpy(), lists, table["meet"].to_numpy(), table["own"].to_numpy())
    assert len(row) < len(table)
    got, ids = set(), one["id"].to_numpy()[row]
    for t in np.unique(task):
        at = np.flatnonzero(task == t)
        for x, y in zip(*np.nonzero((has[at][:, None] & has[at][None, :, ::-1] != 0).any(axis=2))):
            got.add((int(ids[at[x]]), int(ids[at[y]])))
    similar = {(a, b) for a in of for b in of if a != b and abs(of[a] - of[b]) <= 0.1 * max(of[a], of[b])}
    assert similar <= got


def test_texts_go_to_tasks_in_shares(spark, monkeypatch):
    """Lines to compare are stored before they are exchanged, compressed, and a share of the tasks goes after another."""
    from llm import lines as module

    names, real = [], module.stored

    def noted(df, name, *a, **b):
        names.append((name, b.get("compression")))
        return real(df, name, *a, **b)

    monkeypatch.setattr(module, "stored", noted)
    rng = random.Random(2)
    rows = []
    for k in range(12):
        line = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(20))
        rows += [(2 * k, line), (2 * k + 1, line[:-4] + "wxyz")]
    got = {r.doc_id: r.n_removed for r in op8(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k % 2 for k in range(24)}
    assert ("tasks", "zstd") in names and sum(n == "edges" for n, _ in names) > 1


def test_equal_and_close_lines_go(spark):
    rng = random.Random(5)
    long = " ".join(plain_words(text(rng, 80)))
    near = long.replace(" ", "  ", 3) + "!"  # equal once normalised
    edited = long + " x"
    rows = [(2, f"{long}\nshort one\n{long}"), (1, f"first of all these lines here\n{near}"), (3, f"{edited}\nshort one"), (4, None), (5, ""), (1, f"first of all these lines here\n{near}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in without_repeats(docs).collect())
    assert got[(1, rows[1][1])] == 2 and got[(2, "short one")] == 1 and got[(5, "")] == 1 and got[(4, None)] == 1
    digest = {r.doc_id: r for r in op8(docs).collect()}
    assert digest[2].n_removed == 2 and digest[2].removed_lines == "0,2" and digest[2].n_lines == 3
    assert within(normal_line(long), normal_line(edited), int((1 - SIMILARITY) * len(edited)))


def test_exact_lines_are_kept_once(docs, rows):
    """Without close lines, the result is that of exact matching of normalised lines."""
    seen, want = {}, Counter()
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    gone = Counter()
    for last, i, t in order:
        for k, line in enumerate(t.split("\n")):
            key = re.sub("[0-9]", "0", " ".join(plain_words(line)))
            if key:
                here = (last, i, k)
                if seen.setdefault(key, here) != here:
                    gone[(last, i, t)] += 1
    for r in rows:
        want[(r[0], gone[(r[0] is None, r[0] or 0, r[1] or "")])] += 1
    got = Counter((r.doc_id, r.n_removed) for r in op8(docs).collect())
    assert sum(n for _, n in got) >= sum(n for _, n in want) > 0


def changed(rng: random.Random, line: str, kind: int) -> str:
    """The line with edits of a kind: one word, several words, or characters all over, within the similarity."""
    w, most = line.split(), int((1 - SIMILARITY) * len(line))
    if kind == 2:
        out = list(line)
        for _ in range(most):
            out[rng.randrange(len(out))] = rng.choice("abcdefghijklmnop")
        return "".join(out)
    for _ in range(1 if kind == 0 else 3):
        k = rng.randrange(len(w))
        if len(w[k]) <= most:
            most -= len(w[k])
            w[k] = "".join(rng.choice("abcdefghijklmnop") for _ in w[k])
    return " ".join(w)


def test_similar_lines_of_all_lengths_meet(spark):
    """Recall against edit distance on lines of 2 to 50 words, by length: near all pairs of five words and more."""
    rng = random.Random(15)
    word = lambda: "".join(rng.choice("aeioubcdfghlmnprstvwé") for _ in range(rng.randrange(3, 9)))
    rows, pairs = [], []
    for n in (2, 3, 5, 7, 10, 15, 20, 30, 50):
        for k in range(24):
            a = " ".join(word() for _ in range(n))
            b = changed(rng, a, k % 3)
            if a != b and lev(normal_line(a), normal_line(b)) <= int((1 - SIMILARITY) * max(len(a), len(b)) + 1e-9):
                rows += [(2 * len(pairs), a), (2 * len(pairs) + 1, b)]
                pairs.append(len(a))
    got = {r.doc_id: r.n_removed for r in op8(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    found = [got[2 * k + 1] for k in range(len(pairs))]
    assert len(pairs) > 120 and not any(got[2 * k] for k in range(len(pairs)))
    short = [f for f, n in zip(found, pairs) if n < 40]
    print("recall", sum(found) / len(found), "of short lines", sum(map(bool, short)) / len(short), len(short))
    assert sum(found) >= 0.97 * len(pairs) and sum(map(bool, short)) >= 0.95 * len(short)


def test_groups_and_kept_lines_are_brute_force(spark):
    """Every pair of distinct lines by Levenshtein, groups by search, the first occurrence kept; chains and copies among them."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("aeioubcdfghlmnprstvwé") for _ in range(rng.randrange(3, 9)))
    lines = []
    for k in range(25):
        at = " ".join(word() for _ in range(rng.choice([4, 9, 14, 25])))
        for _ in range(rng.randrange(1, 5)):  # a chain: its ends need not be similar
            lines.append(at)
            at = changed(rng, at, 0)
    lines += ["", "...", "One two", "one  TWO!", "x"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    rows = [(i if i % 13 else None, t) for i, t in enumerate(texts)] + [(7, texts[7])]
    spots = sorted({(i is None, i or 0, t) for i, t in rows}, key=lambda r: r[:2])
    occurrences = [(last, i, t, k, normal_line(line)) for last, i, t in spots for k, line in enumerate(t.split("\n")) if normal_line(line)]
    kinds = sorted({o[4] for o in occurrences})
    up = {x: x for x in kinds}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if abs(len(a) - len(b)) <= 0.1 * max(len(a), len(b)) and lev(a, b) <= int((1 - SIMILARITY) * max(len(a), len(b)) + 1e-9):
                up[find(a)] = find(b)
    seen, gone = set(), {}
    for last, i, t, k, line in occurrences:  # NULL ids are last, their ties by text hash are not tested: texts differ in order only there
        if find(line) in seen:
            gone.setdefault((last, i, t), []).append(k)
        seen.add(find(line))
    got = {}
    for r in op8(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("doc_id is not null").collect():
        got.setdefault(r.doc_id, set()).add(r.removed_lines)
    want = {i: {",".join(map(str, gone.get((last, i, t), [])))} for last, i, t in spots if not last}
    assert got == want and sum(bool(x) for v in want.values() for x in v) > 30


def test_simhash_is_the_majority_of_bits():
    import numpy as np

    grams = np.random.default_rng(2).integers(0, 1 << 63, 60).astype(np.uint64)
    low, high = np.array([0, 5, 7, 20]), np.array([60, 6, 22, 35])
    for value, a, b in zip(simhashes(grams, low, high).tolist(), low, high):
        bits = [sum(int(g) >> k & 1 for g in grams[a:b]) * 2 > b - a for k in range(32)]
        assert value == sum(1 << k for k, bit in enumerate(bits) if bit)


def test_one_very_long_line_and_text(spark):
    """A line of 60,000 characters in a text of 3,000 lines: nothing is cut off, the copy with an edit far back goes."""
    rng = random.Random(3)
    long = " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(10_000))
    many = "\n".join(f"line {rng.random()} of a long text, words {rng.random()}".replace("0.", "").translate(str.maketrans("0123456789", "qwertyuiop")) for _ in range(3_000))
    rows = [(1, long + "\n" + many), (2, long[:-3] + "zzz"), (3, many[-60:].split("\n")[-1])]
    got = {r.doc_id: r.removed_lines for r in op8(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == "0" and got[3] == "0" and got[1] == ""


def test_short_lines_go_too(spark):
    rows = [(1, "Menu\n---\nread more"), (2, "menu\n---\nRead more!"), (3, "漢字漢字漢字漢字漢字漢字漢"), (4, "漢字漢字漢字漢字漢字漢字漢。"), (5, "漢字漢字漢字漢字漢字漢字字")]
    got = {r.doc_id: r.removed_lines for r in op8(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "0,2", 3: "", 4: "0", 5: "0"}


def test_empty_tables(empty):
    for fn in (op1, op5, op8, op10):
        assert fn(empty).count() == 0
    assert one_of_each(empty).columns == empty.columns and one_of_each(empty).count() == 0
    assert without_repeats(empty).columns == empty.columns and without_repeats(empty).count() == 0
