"""Secret scans through a trigram index.

Each rule's regular expression is turned into a Boolean query over the trigrams that any match must
contain. A block of texts is indexed once: the trigrams the rules ask for, each with the ascending list
of the texts that hold it. The queries intersect and unite these lists, and only the texts that come
out are searched with the expression itself. A rule without mandatory trigrams searches every text.

Blocks are what a task has in hand, so the index needs no shuffle and no memory beyond a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType, LongType, StringType, StructField, StructType,
)


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and non-overlapping; those whose `group` is shorter than `least` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules. A run of hexadecimal digits, or of an access key, is always taken
# whole, so the least length may stand in the pattern: shorter runs hold no other match.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further credentials with a public, recognisable form.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/@]{1,64}@"),
)
RULES = BASE_RULES + MORE_RULES

# ---- trigram queries ---------------------------------------------------------------------------
# A query is True (any text), a trigram, or ("and" | "or", parts).

MOST_STRINGS = 64
MOST_CLASS = 12


def conjunction(parts) -> object:
    kept = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not kept else kept[0] if len(kept) == 1 else ("and", tuple(kept))


def disjunction(parts) -> object:
    kept = list(dict.fromkeys(parts))
    if not kept or True in kept:
        return True
    return kept[0] if len(kept) == 1 else ("or", tuple(kept))


def trigrams(strings: set[str]) -> object:
    """What a text must hold if it holds one of the strings."""
    return disjunction(
        conjunction(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)
    )


def query_of(pattern: str) -> object:
    """The trigram query of a regular expression, over texts with ASCII letters in lower case."""
    exact, asked = _walk(_parser.parse(pattern, re.ASCII))
    return conjunction([asked, trigrams(exact)] if exact else [asked])


def _walk(items) -> tuple[set[str] | None, object]:
    """The strings a sequence can match, if few (else None), and what its matches must hold besides."""
    current, asked, whole = {""}, [], True
    for op, value in items:
        strings, more, goes_on = _item(op, value)
        asked.append(more)
        if strings is not None and len(current) * len(strings) <= MOST_STRINGS:
            current = {a + b for a in current for b in strings}
        else:
            asked.append(trigrams(current))
            whole, current = False, strings or {""}
        if goes_on:
            asked.append(trigrams(current))
            whole, current = False, {""}
    if not whole:
        asked.append(trigrams(current))
    return (current if whole else None), conjunction(asked)


def _item(op, value) -> tuple[set[str] | None, object, bool]:
    """The strings an item begins with, if few, what it must hold besides, and whether more may follow."""
    if op is sre.LITERAL and value < 128:
        return {chr(value).lower()}, True, False
    if op is sre.AT:
        return {""}, True, False
    if op is sre.IN and all(kind is sre.LITERAL and v < 128 for kind, v in value):
        chars = {chr(v).lower() for _, v in value}
        return (chars if len(chars) <= MOST_CLASS else None), True, False
    if op is sre.SUBPATTERN:
        return *_walk(value[-1]), False
    if op is sre.BRANCH:
        ways = [_walk(way) for way in value[1]]
        if all(strings is not None for strings, _ in ways):
            return set().union(*(strings for strings, _ in ways)), True, False
        return None, disjunction(
            conjunction([asked, trigrams(strings)] if strings else [asked])
            for strings, asked in ways
        ), False
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = value
        strings, asked = _walk(body)
        if least == 0:
            return (strings | {""} if strings is not None and most == 1 else None), True, False
        if strings is not None and len(strings) == 1:
            return {next(iter(strings)) * min(least, 32)}, True, most > min(least, 32)
        if strings is not None:
            return strings, True, most > 1
        return None, asked, False
    return None, True, False


def asked_trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(asked_trigrams, query[1]))


class TrigramIndex:
    """Postings of the asked trigrams over one block of texts."""

    def __init__(self, asked: set[str]):
        self.asked = sorted(asked)
        self.table = np.zeros(1 << 24, np.uint16)
        for i, gram in enumerate(self.asked, 1):
            a, b, c = gram.encode()
            self.table[(a << 16) | (b << 8) | c] = i
        self.lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

    def build(self, texts: list[bytes]) -> None:
        self.size = len(texts)
        # A NUL after each text keeps trigrams from reaching into the next one; no rule asks for NUL.
        block = np.frombuffer(b"\0".join(texts).translate(self.lower) + b"\0\0", np.uint8)
        codes = block[:-2].astype(np.int32) << 16
        codes |= block[1:-1].astype(np.int32) << 8
        codes |= block[2:]
        found = self.table[codes]
        at = np.flatnonzero(found)
        ends = np.cumsum([len(t) + 1 for t in texts])
        pairs = np.unique(found[at].astype(np.int64) * self.size + np.searchsorted(ends, at, "right"))
        gram, text = pairs // max(self.size, 1), pairs % max(self.size, 1)
        cuts = np.searchsorted(gram, np.arange(1, len(self.asked) + 2))
        self.postings = {g: text[a:b] for g, a, b in zip(self.asked, cuts, cuts[1:])}

    def texts(self, query: object) -> np.ndarray:
        """The texts that satisfy a query, ascending."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings[query]
        kind, parts = query
        lists = sorted((self.texts(p) for p in parts), key=len)
        result = lists[0]
        for other in lists[1:]:
            result = (
                np.intersect1d(result, other, assume_unique=True)
                if kind == "and"
                else np.union1d(result, other)
            )
        return result


# ---- scanning ----------------------------------------------------------------------------------

BLOCK_BYTES = 4 << 20


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII), query_of(r.pattern)) for r in rules]
        self.index = TrigramIndex(set().union(*(asked_trigrams(q) for _, _, q in self.rules)))

    def block(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, rule number, end) by start, then rule."""
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        self.index.build([t.encode() for t in texts])
        for number, (rule, compiled, query) in enumerate(self.rules):
            for i in self.index.texts(query).tolist():
                for m in compiled.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[i].append((m.start(), number, m.end()))
        for found in spans:
            found.sort()
        return spans


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Slices of the texts of about BLOCK_BYTES; a longer text is a block of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def find_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id and `found`, an array of (kind, start, end) by start, then rule order.

    Positions are code points, ends exclusive. Null and empty texts have an empty array. Rows are
    searched one by one, so ties, repeated rows and null doc_ids need no care; other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    span = StructType(
        [StructField("kind", StringType()), StructField("start", LongType()),
         StructField("end", LongType())]
    )
    schema = StructType(
        [StructField("doc_id", docs.schema[id_col].dataType), StructField("found", ArrayType(span))]
    )
    arrow_span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts):
                found = [
                    [{"kind": rules[n].kind, "start": s, "end": e} for s, n, e in spans]
                    for spans in scanner.block(texts[a:b])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(found, pa.list_(arrow_span))],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(scan, schema)


def redact(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    mark: str = "[{kind}]",
) -> DataFrame:
    """`docs` with each secret replaced by its kind in brackets; `length_col` follows the new text.

    Overlapping secrets are replaced as one span, named after the first. Texts without a secret, nulls
    among them, stay as they are; all columns keep name, type and order.
    """
    names, at = docs.columns, docs.columns.index(text_col)
    count_at = names.index(length_col) if length_col in names else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            plain = [t or "" for t in texts]
            for a, b in blocks(plain):
                for i, spans in zip(range(a, b), scanner.block(plain[a:b])):
                    if spans:
                        texts[i] = _replaced(plain[i], spans, rules, mark)
            columns = list(batch.columns)
            if count_at is not None:
                was = columns[count_at].to_pylist()
                changed = [len(t) if t is not None and t != p else n
                           for t, p, n in zip(texts, plain, was)]
                columns[count_at] = pa.array(changed, columns[count_at].type)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(scan, docs.schema)


def _replaced(text: str, spans, rules, mark: str) -> str:
    out, done, k = [], 0, 0
    while k < len(spans):
        start, number, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[done:start], mark.format(kind=rules[number].kind)]
        done = end
    return "".join([*out, text[done:]])
