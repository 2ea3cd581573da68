"""Fill-in-middle transformation with content-defined chunks and memoized token counts.

A text is cut into prefix, middle and suffix between tokens, and the three are written in another order
behind markers, so that a model learns to fill gaps. A token is a word with the white space before it, or
the white space that ends the text. The cuts are drawn from a hash of the document's id.

To place a cut the tokens must be counted. A rolling hash over the last 32 bytes divides a text into
chunks whose borders depend on the content alone, so a passage that many documents share is divided
alike wherever it stands. A chunk's *summary* (where words end in it, whether it begins and ends with white
space, its code points) is computed once and then found again by the chunk's bytes: the cache compares
contents, not just hashes. Summaries combine: a word also ends where a chunk that ends in a word meets one
that begins with white space. Prefix sums over the chunks' counts give the chunk that holds a
cut, and its summary the place in it.

Each task keeps its own cache, bounded in bytes; nothing is shuffled, and a lost task starts anew.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import by_bytes

# The markers, and the shares of transformed and of suffix-first texts in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED, SUFFIX_FIRST = 50, 80

CHUNK_BITS = 9  # a border every 512 bytes on average
LEAST, MOST = 64, 8192
SEGMENT = 1 << 20
CACHE_BYTES = 16 << 20

_draw = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_draw = (_draw ^ (_draw >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
GEAR = (_draw ^ (_draw >> np.uint64(27))).astype(np.uint32)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def rolling(raw: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the 32 bytes that end there: byte i - j shifted left by j, summed."""
    h = GEAR[raw]
    for step in (1, 2, 4, 8, 16):
        before = np.zeros_like(h)
        before[step:] = h[:-step] << np.uint32(step)
        h = h + before
    return h


def borders(raw: bytes) -> list[int]:
    """The ends of a text's chunks: the first border at least LEAST bytes on, or MOST bytes on."""
    found: list[np.ndarray] = []
    for at in range(0, len(raw), SEGMENT):
        lead = min(at, 31)
        piece = np.frombuffer(raw, np.uint8, min(SEGMENT, len(raw) - at) + lead, at - lead)
        hits = np.flatnonzero(rolling(piece) >> np.uint32(32 - CHUNK_BITS) == 0)
        found.append(hits[hits >= lead] + (at - lead + 1))
    marks = np.concatenate(found).tolist() if found else []
    ends, last = [], 0
    for mark in [*marks, len(raw)]:
        while mark - last > MOST:
            last += MOST
            ends.append(last)
        if mark - last >= LEAST:
            last = mark
            ends.append(last)
    if raw and last < len(raw):
        ends.append(len(raw))
    return ends


class Summary(NamedTuple):
    """What a chunk adds to the counts of a text, whatever stands around it."""

    ends: np.ndarray  # the places inside the chunk where a word has just ended
    points: int
    opens_white: bool
    closes_white: bool


def code_points(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def summarise(chunk: bytes) -> Summary:
    raw = np.frombuffer(chunk, np.uint8)
    white = WHITE[raw]
    ends = (np.flatnonzero(white[1:] & ~white[:-1]) + 1).astype(np.int32)
    return Summary(ends, code_points(raw), bool(white[0]), bool(white[-1]))


class Summaries:
    """Summaries by chunk content, at most about CACHE_BYTES of it in two generations.

    A full young generation becomes the old one; what is asked for in the old one moves on, so chunks
    that keep recurring stay.
    """

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held = limit // 2, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.hits = 0

    def __call__(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            found = summarise(chunk)
        else:
            self.hits += 1
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[chunk] = found
        self.held += len(chunk) + found.ends.nbytes + 300
        return found


class Tokens:
    """The token ends of one text, from the summaries of its chunks."""

    def __init__(self, raw: bytes, summary: Summaries):
        self.raw, self.parts, self.at = raw, [], []
        self.through = []  # words ended up to and including each chunk
        self.joint = []  # whether a word ends just where the chunk begins
        last, closed, total = 0, True, 0
        for end in borders(raw):
            part = summary(raw[last:end])
            joint = not closed and part.opens_white
            total += len(part.ends) + joint
            self.parts.append(part)
            self.at.append(last)
            self.through.append(total)
            self.joint.append(joint)
            last, closed = end, part.closes_white
        # The end of a text always ends a token: its last word or the white space behind that.
        self.n = total + 1 if raw else 0

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points before the cut that follows `k` tokens."""
        if k == 0:
            return 0, 0
        if k == self.n:
            return len(self.raw), sum(p.points for p in self.parts)
        i = bisect_left(self.through, k)
        before = self.through[i - 1] if i else 0
        nth = k - before - 1 - self.joint[i]
        offset = 0 if nth < 0 else int(self.parts[i].ends[nth])
        here = np.frombuffer(self.raw, np.uint8, offset, self.at[i]) if offset else np.empty(0, np.uint8)
        return self.at[i] + offset, sum(p.points for p in self.parts[:i]) + code_points(here)


def draws(seed: int, doc_id: object) -> tuple[int, int, int, int]:
    """Four 32-bit integers of a document: the head of the SHA-256 of `seed:doc_id`, a null id being empty."""
    head = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(head[i : i + 8], 16) for i in (0, 8, 16, 24))


def fill_in_middle(
    docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    `form` is "psm" (prefix, suffix, middle), "spm" (suffix first) or "plain"; a plain text is its own
    output and has null prefix_chars and middle_chars. Plain are empty texts, texts that hold a
    marker, and by lot those that are not to be transformed. A null text counts as empty, a null id is drawn for
    as the empty string. Rows that share an id share the draw, repeated rows give equal rows; other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    schema = StructType([
        StructField("doc_id", docs.schema[id_col].dataType), StructField("n", LongType()),
        StructField("form", StringType()), StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()), StructField("output", StringType()),
    ])
    p_mark, s_mark, m_mark = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

    def transformed(doc_id: object, raw: bytes, summary: Summaries):
        h1, h2, h3, h4 = draws(seed, doc_id)
        tokens = Tokens(raw, summary)
        if not raw or h3 % 100 >= TRANSFORMED or p_mark in raw or s_mark in raw or m_mark in raw:
            return tokens.n, "plain", None, None, raw
        first, second = sorted((h1 % (tokens.n + 1), h2 % (tokens.n + 1)))
        (a, a_points), (b, b_points) = tokens.cut(first), tokens.cut(second)
        prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
        if h4 % 100 < SUFFIX_FIRST:
            form, output = "spm", b"".join((s_mark, suffix, p_mark, prefix, m_mark, middle))
        else:
            form, output = "psm", b"".join((p_mark, prefix, s_mark, suffix, m_mark, middle))
        return tokens.n, form, a_points, b_points - a_points, output

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summaries()
        for batch in batches:
            for piece in by_bytes(batch, 1):
                texts = piece.column(1).cast(pa.binary()).to_pylist()
                rows = [
                    transformed(i, t or b"", summary) for i, t in zip(piece.column(0).to_pylist(), texts)
                ]
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     pa.array(output, pa.binary()).cast(pa.string())],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed text was made of; transformed texts hold each marker once."""
    parts = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(parts, i) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )
