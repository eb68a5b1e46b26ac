"""A small made-up corpus with copies, edits, odd rows and clashing column names, and brute-force versions."""

from __future__ import annotations

import random
import re
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, did string, row int, places string, n int"


def words(rng: random.Random, n: int, kinds: int = 400) -> list[str]:
    return ["".join(rng.choice(["ba", "té", "lo", "mi", "ru", "Zu", "ße"]) for _ in range(1 + rng.randrange(kinds) % 4)) for _ in range(n)]


def text(rng: random.Random, n: int) -> str:
    out = ""
    for k, w in enumerate(words(rng, n)):
        out += w + (".\n" if k % 17 == 16 else "  " if k % 29 == 28 else " ")
    return out


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows of ``SCHEMA``: prose, exact and near copies, shared passages, repeats inside a text, and odd texts."""
    rng = random.Random(seed)
    passage = text(rng, 90)
    texts: list[str | None] = [text(rng, rng.choice([30, 80, 150, 300])) for _ in range(n)]
    for k in range(0, n, 6):
        texts[k] = texts[(k + 1) % n]
    for k in range(3, n, 9):
        w = (texts[1] or "").split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts[k] = " ".join(w)
    for k in range(5, n, 11):
        texts[k] = (texts[k] or "")[:120] + " " + passage + (texts[k] or "")[120:]
    texts[7] = passage + passage
    texts[8], texts[10], texts[13] = None, "", " \n\t"
    texts[22] = "wh " * 250 + texts[2]  # repeats without cuts, in a text without other repeats
    texts[14] = "abcdefghij klmnopqrst uvwxyz 0123456789 " * 40
    texts[20] = "ab " * 120
    texts[21] = " ".join(words(rng, 9000))
    rows = [
        (k, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "é", None]), len(t or ""), "x", 1, None, 2)
        for k, t in enumerate(texts)
    ]
    rows += [rows[3], rows[3], (None, texts[4], "en", "s1", 0, None, None, "p", None), (rows[5][0], "same id", "en", "s1", 7, None, None, None, None)]
    return rows


def plain_words(t: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def spaced(t: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def covered(n: int, starts: list[int], length: int) -> list[bool]:
    mark = [False] * n
    for s in starts:
        for p in range(s, min(n, s + length)):
            mark[p] = True
    return mark


def repeats_of_bytes(rows: list[tuple], length: int = 400) -> Counter:
    """``(doc_id, n_bytes, n_removed, n_spans, kept bytes)`` of each row."""
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = Counter()
    for i, b in raw:
        mark = covered(len(b), [k for k in range(len(b) - length + 1) if count[b[k : k + length]] > 1], length)
        spans = sum(m and (k == 0 or not mark[k - 1]) for k, m in enumerate(mark))
        out[(i, len(b), sum(mark), spans, bytes(x for x, m in zip(b, mark) if not m))] += 1
    return out


def later_words(rows: list[tuple], length: int = 20) -> Counter:
    """``(doc_id, n_words, n_removed, kept text)`` of each row; rows equal in id and text are one."""
    split = [(r[0], r[1], spaced(r[1])) for r in rows]
    first: dict[tuple, tuple] = {}
    place = lambda i, k: (i is None, i or 0, k)
    for i, _, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, place(i, k)), place(i, k))
    out = Counter()
    for i, _, w in split:
        mark = covered(len(w), [k for k in range(len(w) - length + 1) if first[tuple(w[k : k + length])] != place(i, k)], length)
        out[(i, len(w), sum(mark), " ".join(x for x, m in zip(w, mark) if not m))] += 1
    return out


def shingles(t: str | None, size: int = 5) -> frozenset:
    w = plain_words(t)
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
