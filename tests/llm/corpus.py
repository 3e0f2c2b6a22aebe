"""Small tables for the tests, and the brute-force forms of what the operators do."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, x0 string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Copies, near copies, shared passages, periodic and very long texts, empty ones and nulls."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéü") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage, base = say(70), say(120)
    out: list[str | None] = [None, "", "   \n", "one", "ONE", "two words", "a" * 350, "ab " * 90, say(3000)]
    while len(out) < n:
        kind = r.randrange(6)
        if kind == 0:
            out.append(r.choice([x for x in out if x]))
        elif kind == 1:
            out.append(f"{say(r.randint(0, 30))} {passage}\t{say(r.randint(0, 30))}")
        elif kind == 2:
            words = base.split()
            for _ in range(r.randint(1, 6)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            out.append(" ".join(words))
        elif kind == 3:
            out.append(say(3) + "\r\n" + say(r.randint(40, 90)) * r.randint(1, 2))
        else:
            out.append(say(r.randint(1, 200)).title())
    r.shuffle(out)
    return out


def table(spark, rows: list[tuple]):
    """Rows (doc_id, text, lang, source) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, lang, src, None, "x", None) for i, t, lang, src in rows], SCHEMA)


def documents(spark, seed: int = 1, n: int = 60, null_id: bool = True):
    rows = [(k * 3, t, ["en", "fr", None][k % 3], f"s{k % 4}" if k % 7 else None) for k, t in enumerate(texts(seed, n))]
    if null_id:
        rows.append((None, rows[20][1], "en", None))
    return table(spark, rows), rows


def order(rows):
    return sorted(rows, key=lambda x: -(2**63) if x[0] is None else x[0])


def _digest(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def byte_dedup(rows) -> dict:
    seen: set[bytes] = set()
    out = {}
    for i, text, *_ in order(rows):
        b = (text or "").encode()
        covered = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                covered[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        kept = bytes(c for c, g in zip(b, covered) if not g)
        out[i] = (len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(covered))), _digest(kept))
    return out


def word_dedup(rows) -> dict:
    seen: set[tuple] = set()
    out = {}
    for i, text, *_ in order(rows):
        w = WORD.findall(text or "")
        own = [tuple(w[p : p + 50]) for p in range(len(w) - 49)]
        covered = [False] * len(w)
        for p, x in enumerate(own):
            if x in seen:
                covered[p : p + 50] = [True] * 50
        seen.update(own)
        kept = [x for x, g in zip(w, covered) if not g]
        out[i] = (len(w), len(w) - len(kept), _digest(" ".join(kept).encode()))
    return out


def near_groups(rows) -> dict:
    sets, parent, at = {}, {}, defaultdict(list)
    for i, text, *_ in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    key = lambda x: -(2**63) if x is None else x
    for i, own in sets.items():
        for j, n in Counter(j for s in own for j in at[s]).items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)), key=key)
                parent[b] = a
        for s in own:
            at[s].append(i)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def best_edits(item: str, text: str) -> int:
    row = list(range(0, 1)) + [0] * len(text)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
