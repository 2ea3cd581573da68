"""Small corpora with the odd cases, and plain Python versions of the operators' results."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Texts that trip naive code: nulls, empties, other Unicode spaces, control characters, wide characters.
ODD_TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "one", "a b", "A B c", "x y z w", "\x1c\x1d\x1e\x85 q",
    "\U0001f600 ́combining é ﻿bom", "İstanbul ſecret Kelvin", "<|endoftext|>glued <|endoftext|>",
    "word " * 300, "a" * 5000, "tab\tand\nline\r\nbreaks\n\n\nend",
]


def words(text):
    return WORD.findall(text or "")


def prose(n: int, seed: int, variety: int = 400) -> str:
    draw = random.Random(seed)
    parts = []
    for i in range(n):
        parts.append("w" + str(draw.randrange(variety)))
        parts.append("\n" if draw.random() < 0.05 else " ")
    return "".join(parts).strip()


def edited(text: str, edits: int, seed: int) -> str:
    draw, out = random.Random(seed), words(text)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


def documents(n: int = 40, seed: int = 0) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): prose, exact and near copies, shared passages, odd texts."""
    draw = random.Random(seed)
    texts = [prose(draw.choice([5, 30, 60, 120, 400]), seed * 1000 + i) for i in range(n)]
    passage = prose(70, seed + 77)
    for i in range(0, n, 3):
        kind = draw.randrange(4)
        base = texts[draw.randrange(n)]
        texts[i] = (
            base if kind == 0
            else edited(base, 1 + len(words(base)) // 60, i) if kind == 1
            else base + " " + passage + " " + prose(9, i) if kind == 2
            else passage + "\n" + texts[i]
        )
    texts += ODD_TEXTS
    sources = ["s1", "s2", "s2", "s2", None, "ü", "B"]
    return [
        (i, t, ["en", "de", None][i % 3], sources[i % len(sources)], None if t is None else len(t))
        for i, t in enumerate(texts)
    ]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# ---- plain versions ------------------------------------------------------------------------------


def plain_repeats(rows: list[tuple]) -> dict:
    """{(doc_id, text): (n_words, n_removed, kept_sha256)}"""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - 49):
            if doc is not None:
                key = tuple(w[i : i + 50])
                first[key] = min(doc, first.get(key, doc))
    result = {}
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - 49):
            if doc is not None and first[tuple(w[i : i + 50])] < doc:
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        result[doc, text] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return result


def shingles(text, k: int) -> frozenset:
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def plain_components(rows: list[tuple], k: int, num: int, den: int) -> dict:
    """{doc_id: smallest reachable doc_id}; rows that share an id are one document."""
    sets = [(d, shingles(t, k)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and den * len(x & y) >= num * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {d: root(d) for d in parent}


BASE = [
    ("assign", re.compile(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
        r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def plain_secrets(text) -> list[tuple[str, int, int]]:
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def plain_measures(text) -> dict:
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def plain_targets(sizes: dict, weights=(3, 1, 2), share=1.5, limit=2) -> dict:
    """Water filling step by step: targets by weight, those over their limit stop, the rest share again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_sources, target = share * sum(sizes.values()), set(order), {}
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        over = [s for s in open_sources if left * weight[s] / total > limit * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_sources}
            break
        for s in over:
            target[s] = limit * sizes[s]
            open_sources.remove(s)
        left = share * sum(sizes.values()) - sum(target.values())
    return target
