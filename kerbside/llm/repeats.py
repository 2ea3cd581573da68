"""Substring deduplication with prefix-partitioned suffix trees.

A word goes if it lies in a window of `WINDOW` words that also starts in a document with a smaller id.
The suffixes of all documents are divided by prefix, each division small enough for memory, and each
becomes a subtree whose internal nodes at a depth of at least `WINDOW` words are the repeats.

Prefix lengths vary with the text. A suffix's prefix ends with the *anchor* of its first window, the
8-gram of words with the least hash in it. Equal windows have equal anchors at equal places, so all
occurrences of a repeat fall into one division. Neighbouring suffixes mostly share their anchor, so
a division gets them as one *entry*: the words from the first of these windows to the last, sent once.
Anchors thin the suffixes out to one entry per about 22 words.

Most text never reaches a tree. An anchor found in one document only is dropped after counting. Equal
entries are represented by the one in the smallest document; the other documents' copies are covered
whole. Trees are built where an anchor has different entries. A division of more than `TREE_ENTRIES`
entries is divided further by longer prefixes: its windows are halved by how far into them the anchor
lies, and all windows of a half share a longer run of words around the anchor, which is the new prefix.
Halves that are equal are again represented by one. At the latest when a half is a single window its
prefix is the whole window, and nothing is left to divide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, LongType, StringType, StructField, StructType,
)

from .common import by_bytes, written

WINDOW = 50
GRAM = 8
TREE_ENTRIES = 1000
HASHED_BYTES = 1 << 18
BATCH_BYTES = 1 << 20
STRIDE = 20_000
U = np.uint64


def _longs(*names: str) -> list[StructField]:
    return [StructField(n, LongType()) for n in names]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def row_key(text: str) -> int:
    """Tells the texts of one doc_id apart."""
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end, if single blanks join them."""
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    return np.r_[0, blanks + 1], np.r_[blanks, len(joined)]


def word_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, worked out for about HASHED_BYTES of text at once."""
    result, at = np.empty(len(starts), U), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASHED_BYTES, "right")))
        first = int(starts[at])
        raw = np.frombuffer(joined, np.uint8, int(ends[to - 1]) - first, first)
        # A byte counts by its place in its word; the blank behind a word adds nothing.
        place = np.arange(len(raw)) - np.repeat(starts[at:to] - first, np.diff(np.r_[starts[at:to] - first, len(raw)]))
        worth = mixed((raw.astype(U) << U(32)) + place.astype(U)) * (raw != 0x20)
        result[at:to] = np.add.reduceat(worth, starts[at:to] - first)
        at = to
    return result


class Anchors:
    """Cuts a document's windows into runs with one anchor each."""

    def __init__(self):
        self.steps = mixed(np.arange(1, GRAM + 1, dtype=U)) | U(1)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each run, in order: anchor hash, first window, number of windows, words before the anchor."""
        joined = b" ".join(words)
        return self.runs(word_hashes(joined, *word_bounds(joined)) if words else np.empty(0, U))

    def runs(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As above, from the words' hashes."""
        n = len(hashes) - WINDOW + 1
        if n <= 0:
            return np.empty(0, U), *[np.empty(0, np.int64)] * 3
        count = len(hashes) - GRAM + 1
        grams = np.zeros(count, U)
        for i in range(GRAM):
            grams += hashes[i : i + count] * self.steps[i]
        grams = mixed(grams)
        held = WINDOW - GRAM + 1
        place = np.empty(n, np.int64)
        for at in range(0, n, STRIDE):
            view = np.lib.stride_tricks.sliding_window_view(grams[at : at + STRIDE + held - 1], held)
            view = view[: n - at]
            place[at : at + len(view)] = at + np.arange(len(view)) + view.argmin(axis=1)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        return grams[place[first]], first, np.diff(np.r_[first, n]), place[first] - first


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document (anchor null; n_words, sha256 of all words) and one per run of windows."""
    schema = StructType(
        _longs("doc_id", "row", "n_words")
        + [StructField("sha", BinaryType())]
        + _longs("anchor", "digest", "lo", "windows", "mark")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            for piece in by_bytes(batch, 1, BATCH_BYTES):
                ids = piece.column(0).cast(pa.int64())
                heads, runs = [], []
                for doc, text in zip(ids.to_pylist(), piece.column(1)):
                    raw = text.as_py() or ""
                    joined = b" ".join(raw.encode().split())
                    row = row_key(raw)
                    starts, ends = word_bounds(joined) if joined else (np.empty(0, np.int64),) * 2
                    heads.append((row, len(starts), hashlib.sha256(joined).digest()))
                    if doc is None or len(starts) < WINDOW:
                        continue
                    anchor, lo, windows, mark = anchors.runs(word_hashes(joined, starts, ends))
                    digests = [
                        xxhash.xxh3_64_intdigest(joined[a:b])
                        for a, b in zip(starts[lo].tolist(), ends[lo + windows + WINDOW - 2].tolist())
                    ]
                    runs.append((np.full(len(lo), doc), np.full(len(lo), row), anchor,
                                 np.array(digests, U), lo, windows, mark))
                row, n, sha = zip(*heads)
                none = pa.nulls(len(heads), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(row, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
                     none, none, none, none, none],
                    names=schema.names,
                )
                if runs:
                    doc, row, anchor, digest, lo, windows, mark = map(np.concatenate, zip(*runs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc), pa.array(row), pa.nulls(len(doc), pa.int64()),
                         pa.nulls(len(doc), pa.binary()), pa.array(anchor.view(np.int64)),
                         pa.array(digest.view(np.int64)), pa.array(lo), pa.array(windows), pa.array(mark)],
                        names=schema.names,
                    )

    return docs.select(id_col, text_col).mapInArrow(scan, schema)


def entries(firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """(anchor, digest, doc, mark, words): the words of each entry, cut from the document it is first in.

    A document's entries come as one list, which is no longer than the document.
    """
    schema = StructType(_longs("anchor", "digest", "doc", "mark") + [StructField("words", StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_bytes(batch, batch.schema.get_field_index("text"), BATCH_BYTES):
                rows = []
                for r in piece.to_pylist():
                    words = r["text"].encode().split()
                    for e in r["found"]:
                        part = words[e["lo"] : e["lo"] + e["windows"] + WINDOW - 1]
                        rows.append((e["anchor"], e["digest"], r["doc_id"], e["mark"], b" ".join(part).decode()))
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(next(columns), pa.int64()) for _ in range(4)]
                    + [pa.array(next(columns), pa.string())],
                    names=schema.names,
                )

    listed = firsts.groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("anchor", "digest", "lo", "windows", "mark")).alias("found")
    )
    return texts.join(listed, ["doc_id", "row"]).select("doc_id", "text", "found").mapInArrow(cut, schema)


def common_words(a: bytes, b: bytes) -> int:
    """How many words two suffixes have in common at their start, words being four bytes each."""
    low, high = 0, min(len(a), len(b)) // 4
    while low < high:
        middle = (low + high + 1) // 2
        if a[4 * low : 4 * middle] == b[4 * low : 4 * middle]:
            low = middle
        else:
            high = middle - 1
    return low


def internal_nodes(depths: list[int]) -> list[tuple[int, int, int, int]]:
    """(depth, first leaf, end, depth of the parent) of the inner nodes of a suffix tree.

    `depths` holds, for each leaf but the first in sorted order, the words it has in common with the one
    before. A stack holds the path to the last leaf; a leaf that has less in common closes the nodes below.
    """
    nodes, path = [], [(0, 0)]
    for leaf, depth in enumerate([*depths, 0], 1):
        first = leaf - 1
        while path[-1][0] > depth:
            closed, first = path.pop()
            nodes.append((closed, first, leaf, max(depth, path[-1][0])))
        if path[-1][0] < depth:
            path.append((depth, first))
    return nodes


def subtree_repeats(group: list[tuple[int, list[bytes]]]) -> list[tuple[int, int]]:
    """(entry, window) of each window of a group of entries that starts in a smaller document as well.

    The suffixes are sorted, and the words that neighbours have in common give the inner nodes of their
    tree. The highest nodes of depth WINDOW or more stand for the repeats of that length and, with the
    nodes below them, of any greater one; the smallest document among a node's leaves owns its text.
    """
    ids: dict[bytes, int] = {}
    leaves = []
    for entry, (_, words) in enumerate(group):
        coded = np.array([ids.setdefault(w, len(ids)) for w in words], ">u4").tobytes()
        leaves += [(coded[4 * s :], entry, s) for s in range(len(words) - WINDOW + 1)]
    leaves.sort()
    depths = [common_words(a[0], b[0]) for a, b in zip(leaves, leaves[1:])]
    found = []
    for depth, first, end, above in internal_nodes(depths):
        if depth >= WINDOW > above:
            owner = min(group[entry][0] for _, entry, _ in leaves[first:end])
            found += [(e, s) for _, e, s in leaves[first:end] if group[e][0] > owner]
    return found


_COVERED = StructType(_longs("prefix", "entry", "from", "to"))


def tree_repeats(given: DataFrame) -> DataFrame:
    """(prefix, entry, from, to): words that repeat a smaller document, by one tree per prefix.

    `given` holds the different entries (prefix, entry, doc, words), few enough per prefix for memory.
    """

    def solve(group: list[tuple[int, int, int, list[bytes]]]) -> list[tuple[int, int, int, int]]:
        found: dict[int, list[int]] = {}
        for entry, window in subtree_repeats([(doc, words) for _, _, doc, words in group]):
            found.setdefault(entry, []).append(window)
        rows = []
        for entry, windows in found.items():
            windows = np.unique(windows)
            cuts = np.flatnonzero(np.diff(windows) > 1)
            for a, b in zip(windows[np.r_[0, cuts + 1]], windows[np.r_[cuts, len(windows) - 1]]):
                rows.append((*group[entry][:2], int(a), int(b) + WINDOW))
        return rows

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list = []
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 1000):
                for r in batch.slice(at, 1000).to_pylist():
                    if group and group[0][0] != r["prefix"]:
                        rows += solve(group)
                        group = []
                    group.append((r["prefix"], r["entry"], r["doc"], r["words"].encode().split()))
            yield _covered_batch(rows)
        if group:
            yield _covered_batch(solve(group))

    placed = given.select("prefix", "entry", "doc", "words").repartition("prefix")
    return placed.sortWithinPartitions("prefix").mapInArrow(scan, _COVERED)


def _covered_batch(rows) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 4
    return pa.RecordBatch.from_arrays(columns, names=_COVERED.names)


def halved(given: DataFrame) -> DataFrame:
    """The two halves of each entry's windows, with a `prefix` and an `entry` (digest) of their own.

    `near` and `far` bound how many words lie before the anchor in a window (`near` included), `mark` is
    how many do so in the entry; `at` counts words from the start of the entry (anchor, digest)
    that the half goes back to. The prefix is what all windows between the bounds have in common.
    """
    names = ["prefix", "entry", "anchor", "digest", "at", "doc", "mark", "near", "far"]
    schema = StructType(_longs(*names) + [StructField("words", StringType())])

    def key(words: list[bytes], *bounds: int) -> int:
        return xxhash.xxh3_64_intdigest(repr(bounds).encode() + b" ".join(words)) - (1 << 63)

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = []
                for r in batch.slice(at, 1000).to_pylist():
                    words, mark = r["words"].encode().split(), r["mark"]
                    middle = (r["near"] + r["far"] + 1) // 2
                    for near, far in ((r["near"], middle), (middle, r["far"])):
                        a = max(0, mark - far + 1)
                        b = min(len(words) - WINDOW, mark - near)
                        if near < far and a <= b:
                            part = words[a : b + WINDOW]
                            prefix = words[mark - near : mark - far + 1 + WINDOW]
                            rows.append((key(prefix, near, far), key(part, near, far), r["anchor"], r["digest"],
                                         r["at"] + a, r["doc"], mark - a, near, far, b" ".join(part).decode()))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())],
                    names=schema.names,
                )

    return given.select(*names[2:], "words").mapInArrow(halve, schema)


def divided_repeats(given: DataFrame) -> list[DataFrame]:
    """(anchor, digest, from, to) tables for entries of large divisions."""
    found, key = [], ["prefix", "entry"]
    while not given.isEmpty():
        halves = written(halved(given), "halves")
        owner = written(halves.groupBy(*key).agg(F.min("doc").alias("owner")), "owners")
        both = halves.join(owner, key)
        size = F.size(F.split("words", " "))
        found.append(both.where("owner < doc").select(
            "anchor", "digest", F.col("at").alias("from"), (F.col("at") + size).alias("to")
        ))
        mine = written(both.where("owner = doc").drop("owner"), "own_halves")
        counts = written(
            owner.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "divisions"
        )
        sized = mine.join(counts, "prefix")
        small = sized.where(F.col("n") <= TREE_ENTRIES)
        covered = tree_repeats(small.dropDuplicates(key))
        found.append(small.join(covered, key).select(
            "anchor", "digest", (F.col("at") + F.col("from")).alias("from"), (F.col("at") + F.col("to")).alias("to")
        ))
        given = sized.where(F.col("n") > TREE_ENTRIES)
    return found


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256.

    kept_sha256 is of the kept words joined by one space. A null text has no words. Rows that share a
    doc_id are one document with several texts; none of them is smaller than the other, so they remove
    nothing from each other. A row without doc_id has no place in the order: it removes nothing and
    loses nothing. Other columns are ignored; an empty table gives no rows. Ids are integers.
    """
    found = written(scanned(docs, id_col, text_col), "scan")
    heads = found.where("anchor is null").select("doc_id", "row", "n_words", "sha")
    runs = found.where("anchor is not null").drop("n_words", "sha")

    # Counts are written before they are joined: a join of two plain shuffles can split a hot anchor.
    ends = runs.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    shared = written(ends.where("a < b").select("anchor"), "shared")
    runs = written(runs.join(shared, "anchor"), "runs")
    own = F.struct("doc_id", "row", "lo", "windows", "mark")
    firsts = written(
        runs.groupBy("anchor", "digest").agg(F.min(own).alias("f")).select("anchor", "digest", "f.*"),
        "firsts",
    )
    per_anchor = written(
        firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "divisions"
    )

    ids = runs.select("doc_id").distinct()
    numbered = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    texts = written(_keyed(numbered.join(ids, "doc_id", "left_semi")), "texts")

    given = written(
        entries(firsts.join(per_anchor, "anchor").drop("n"), texts).join(per_anchor, "anchor"), "entries"
    )
    trees = tree_repeats(
        given.where(F.col("n") <= TREE_ENTRIES).withColumnsRenamed({"anchor": "prefix", "digest": "entry"})
    ).withColumnsRenamed({"prefix": "anchor", "entry": "digest"})
    bounds = {"at": 0, "near": 0, "far": WINDOW - GRAM + 1}
    large = given.where(F.col("n") > TREE_ENTRIES).withColumns(
        {name: F.lit(value).cast("bigint") for name, value in bounds.items()}
    )
    inside = written(reduce(DataFrame.unionByName, [trees, *divided_repeats(large)]), "repeats")

    first = F.col("doc_id") == F.col("first_doc")
    owned = runs.join(
        firsts.select("anchor", "digest", F.col("doc_id").alias("first_doc")), ["anchor", "digest"]
    )
    copied = owned.where(~first).select(
        "doc_id", "row", F.col("lo").alias("from"), (F.col("lo") + F.col("windows") + WINDOW - 1).alias("to")
    )
    partly = owned.where(first).join(inside, ["anchor", "digest"]).select(
        "doc_id", "row", (F.col("lo") + F.col("from")).alias("from"), (F.col("lo") + F.col("to")).alias("to")
    )
    spans = reduce(DataFrame.unionByName, [copied, partly]).groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("from", "to")).alias("spans")
    )
    changed = _cut(texts.join(spans, ["doc_id", "row"])).distinct()
    sha = F.coalesce("kept_sha", "sha")
    return heads.join(changed, ["doc_id", "row"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.lower(F.hex(sha)).alias("kept_sha256"),
    )


def _keyed(texts: DataFrame) -> DataFrame:
    """(doc_id, text) plus `row`."""
    schema = StructType(
        _longs("doc_id") + [StructField("text", StringType())] + _longs("row")
    )

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row_key(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.int64())], names=schema.names
            )

    return texts.mapInArrow(key, schema)


def _cut(covered: DataFrame) -> DataFrame:
    """(doc_id, row, n_removed, kept_sha) of texts with the spans of words to remove."""
    schema = StructType(
        _longs("doc_id", "row", "n_removed") + [StructField("kept_sha", BinaryType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_bytes(batch, batch.schema.get_field_index("text"), BATCH_BYTES):
                removed, shas = [], []
                for text, spans in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist()):
                    words = text.encode().split()
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, [s["from"] for s in spans], 1)
                    np.add.at(edges, [s["to"] for s in spans], -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
                    removed.append(int(gone.sum()))
                    shas.append(hashlib.sha256(b" ".join(kept)).digest())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("row"), pa.array(removed, pa.int64()),
                     pa.array(shas, pa.binary())],
                    names=schema.names,
                )

    return covered.mapInArrow(cut, schema)
