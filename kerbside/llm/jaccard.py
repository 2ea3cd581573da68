"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Every shingle flips one bit of a sketch, so a bit holds the parity
of the shingles that fell on it; a shingle that two sets share cancels out, and the Hamming distance of two
sketches is at most the size of the sets' symmetric difference.

Two sets with Jaccard similarity of at least t differ in at most (a + b) (1 - t) / (1 + t) shingles, so a
set of size a differs from whatever it is linked with in at most d, given by its own size. Sizes are cut
into bands so that linked sets lie in the same or in neighbouring bands. A set is at home in the group of its
own band and visits the group of the next one; a pair meets in the group of its larger set's band, where at least
one of the two is at home.

Within a group the sketch has more parts than any d: by the pigeonhole principle at least `parts - d` parts of a
linked pair are equal. The parts are 2^64 bits wide, so that sets agree in a part only if they hold the same
shingles there, and are kept as what such a sparse bit string hashes to by XOR. A part with few shingles says
little and may be shared by many (a common line is enough), so a set offers its d + 1 fullest parts, ties by place.
That loses nothing: take the fullest part in which a linked pair agrees. Both hold the same shingles in it, so it
has the same rank for both, and what either holds fuller is among the at most d parts that differ.

Equal sets need no sketch; one document stands for them. Offers are range-partitioned by (part value, document),
so that a value shared by a third of all documents is spread over tasks. Candidates are verified in steps, and verified
links are merged to components after each. A star comes first: each shared value links its documents with one of them.
Then all pairs that share a value and are still in different components have their sketches compared, in blocks
of bounded size within the tasks: at first every document takes its nearest one alone, which joins what is left of a
family by few rows, and then every pair that still may be linked becomes a row and is verified. So no link between
components is missed, and no pair inside a component is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, LongType, StructField, StructType,
)

from .common import components, discard, split_words, written

CACHED_WORDS = 200_000
STAR_ROWS = 4096
SKETCH_WORDS = 16
# The members of a key that are compared with each other at once; more are dealt over a triangle of cells.
CELL = 2048
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingler:
    """The set of a text's shingles as sorted 64-bit hashes.

    Words are taken with A-Z in lower case. With fewer words than `k` the whole sequence is the one
    shingle; without words the set is empty.
    """

    def __init__(self, k: int):
        self.k = k
        self.known: dict[bytes, int] = {}
        self.steps = mixed(np.arange(1, k + 1, dtype=U)) | U(1)

    def __call__(self, text: str | None) -> np.ndarray:
        words = [w.lower() for w in split_words(text)]
        if not words:
            return np.empty(0, U)
        known = self.known
        missing = set(words).difference(known)
        if missing:
            if len(known) + len(missing) > CACHED_WORDS:
                known.clear()
                missing = set(words)
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w in missing)
        hashes = np.fromiter((known[w] for w in words), U, len(words))
        n = min(self.k, len(words))
        total = np.full(len(words) - n + 1, U(n), U)
        for i in range(n):
            total += hashes[i : len(words) - n + 1 + i] * self.steps[i]
        return np.unique(mixed(total))


class Bands:
    """Size bands, and each group's largest symmetric difference and number of parts."""

    def __init__(self, num: int, den: int, largest: int = 1 << 40):
        edges = [1]
        while edges[-1] <= largest:
            edges.append(edges[-1] * den // num + 1)
        self.edges = np.array(edges, np.int64)
        self.num, self.den = num, den
        # Group g holds the bands g - 1 and g, so its sets are smaller than edges[g + 1]. A third more
        # parts than the largest difference leaves enough strong ones.
        differ = [2 * (e - 1) * (den - num) // (den + num) for e in edges[1:]]
        self.parts = [d + 1 + (max(2, -(-7 * d // 20)) if d else 0) for d in differ]

    def difference(self, size: int, group: int) -> int:
        """How far a set of this size may be from any set of the group that it is linked with."""
        partner = min(size * self.den // self.num, int(self.edges[group + 1]) - 1)
        return (size + partner) * (self.den - self.num) // (self.den + self.num)

    def groups(self, size: int) -> tuple[int, int]:
        """The groups of a set: the one it closes and the one it opens."""
        band = int(np.searchsorted(self.edges, size, "right")) - 1
        return band, band + 1


def parity(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The parity sketch of a set in `parts` words of 64 bits."""
    sketch = np.zeros(parts, U)
    np.bitwise_xor.at(sketch, (hashes % U(parts)).astype(np.int64), U(1) << (hashes >> U(58)))
    return sketch


def offers(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys under which a set meets every other set it may be linked with; odd ones where it is at home.

    A set too small to be linked with any but its equals has none.
    """
    keys = [np.empty(0, U)]
    for g, home in zip(bands.groups(len(hashes)), (1, 0)):
        parts, differ = bands.parts[g], bands.difference(len(hashes), g)
        if not differ:
            continue
        at = (hashes % U(parts)).astype(np.int64)
        digests = np.zeros(parts, U)
        np.bitwise_xor.at(digests, at, mixed(hashes))
        shown = np.argsort(-np.bincount(at, minlength=parts), kind="stable")[: differ + 1]
        place = mixed((U(g) << U(40)) + shown.astype(U) + U(1))
        keys.append(mixed(digests[shown] ^ place) >> U(1) << U(1) | U(home))
    return np.concatenate(keys)


def signed(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, set_hash, s0.., keys) of every row: its set's size, digest, sketch and offers."""
    sketch_names = [f"s{i}" for i in range(SKETCH_WORDS)]
    schema = StructType(
        [StructField("doc_id", LongType()), StructField("n_shingles", LongType()),
         StructField("set_hash", BinaryType())]
        + [StructField(s, LongType()) for s in sketch_names]
        + [StructField("keys", ArrayType(LongType()))]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands = Shingler(k), Bands(num, den)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                sizes, digests, sketches, keys = [], [], [], []
                for text in piece.column(1).to_pylist():
                    found = shingles(text)
                    sizes.append(len(found))
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                    sketches.append(parity(found, SKETCH_WORDS).view(np.int64))
                    keys.append(offers(found, bands) if len(found) else found)
                ends = np.cumsum([0, *map(len, keys)])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(digests, pa.binary())]
                    + [pa.array(c) for c in np.array(sketches).T.copy()]
                    + [pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(sign, schema)


def shared_offers(offered: DataFrame) -> DataFrame:
    """(key, doc, home) for every key that several documents offer, one of them at home.

    The rows arrive range-partitioned and sorted. A key may go on in the next partition, so the first
    and the last key of a partition are returned even if only one document shows here.
    """
    schema = StructType([StructField("key", LongType()), StructField("doc", LongType())])

    def shared(keys, docs, edge_from, edge_to) -> pa.RecordBatch:
        new = np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])]
        keys, docs = keys[new], docs[new]
        group_key = keys >> 1
        starts = np.flatnonzero(np.r_[True, group_key[1:] != group_key[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        keep = (sizes > 1) & (np.bitwise_or.reduceat(keys, starts) & 1 == 1)
        keep[0] |= edge_from
        keep[-1] |= edge_to
        rows = np.repeat(keep, sizes)
        return pa.RecordBatch.from_arrays([pa.array(x[rows]) for x in (keys, docs)], names=schema.names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, first = np.empty(0, np.int64), np.empty(0, np.int64), True
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            docs = np.concatenate([docs, batch.column(1).to_numpy()])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys >> 1, keys[-1] >> 1, "left"))  # the last key may go on
            if cut:
                yield shared(keys[:cut], docs[:cut], first, False)
                keys, docs, first = keys[cut:], docs[cut:], False
            elif len(keys) > STAR_ROWS:
                # A very common key: kept whatever follows.
                yield shared(keys, docs, True, True)
                keys, docs, first = keys[:0], docs[:0], True
        if len(keys):
            yield shared(keys, docs, first, True)

    placed = offered.repartitionByRange("key", "doc").sortWithinPartitions("key", "doc")
    return placed.mapInArrow(scan, schema).select(
        F.shiftright("key", 1).alias("key"), F.col("doc").alias("rep"), (F.col("key") % 2 != 0).alias("home")
    )


def star(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member of a key with the key's centre, a document at home there.

    Two orders of the documents give a family few centres, but not just one.
    """
    order = F.xxhash64("rep", F.col("key") % 2)
    centre = members.where("home").groupBy("key").agg(
        F.min_by(F.struct("rep", "component"), order).alias("centre")
    )
    pairs = members.join(centre, "key").where(
        (F.col("rep") != F.col("centre.rep")) & (F.col("component") != F.col("centre.component"))
    )
    return pairs.select(
        F.least("rep", "centre.rep").alias("a"), F.greatest("rep", "centre.rep").alias("b")
    ).distinct()


def across(members: DataFrame, features: DataFrame, num: int, den: int, nearest: bool = False) -> DataFrame:
    """All pairs (a, b) of members of a key, in different components and one at home, that may be linked.

    With `nearest` only those of a member with the one in its cell whose sketch is relatively closest, so that
    there are no more pairs than members in cells.

    `features` gives each document's set size and sketch. A key with more than CELL members deals them over blocks,
    and each pair of blocks is a cell of its own, so a task never holds more than about two blocks of a key.
    """
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > CELL)
    blocks = F.coalesce(F.ceil(F.col("_c") / CELL).cast("int"), F.lit(1))
    dealt = members.join(counts, "key", "left").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    cell = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.least("block", j) * F.col("blocks") + F.greatest("block", j),
    )
    celled = dealt.select("key", "rep", "home", "component", "block", "blocks", F.explode(cell).alias("cell"))
    celled = celled.withColumn("alone", F.col("cell") == F.col("block") * (F.col("blocks") + 1))
    names = ["key", "cell", "component", "rep", "block", "alone", "home", "n", *[f"s{i}" for i in range(SKETCH_WORDS)]]
    rows = celled.join(features, "rep").select(*names)

    def compare(columns: list[np.ndarray]) -> pa.RecordBatch:
        key, cell, component, rep, block, alone, home, n = columns[:8]
        sketch = np.stack(columns[8:], 1).view(U)
        size = len(key)
        new = np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]
        end = np.r_[np.flatnonzero(new)[1:], size][np.cumsum(new) - 1]
        new |= np.r_[True, component[1:] != component[:-1]]
        # The first row behind the own component: all from there to the end of the cell are other components.
        other = np.r_[np.flatnonzero(new)[1:], size][np.cumsum(new) - 1]
        found, step = [], 0
        best, partner = np.full(size, np.inf), np.full(size, -1)
        left = np.flatnonzero(other < end)
        while len(left):
            right = other[left] + step
            ok = (home[left] | home[right]) & (rep[left] != rep[right])
            ok &= (n[left] * num <= n[right] * den) & (n[right] * num <= n[left] * den)
            ok &= (block[left] != block[right]) | alone[left]
            a, b = left[ok], right[ok]
            distance = np.zeros(len(a), np.int64)
            for words in (slice(0, 4), slice(4, SKETCH_WORDS)):
                distance += np.bitwise_count(sketch[a, words] ^ sketch[b, words]).sum(1, dtype=np.int64)
                ok = (den + num) * distance <= (den - num) * (n[a] + n[b])
                a, b, distance = a[ok], b[ok], distance[ok]
            if nearest:
                apart = distance / (n[a] + n[b])
                order = np.argsort(-apart, kind="stable")  # of several at one row the closest is written last
                for x, y in ((a[order], b[order]), (b[order], a[order])):
                    closer = apart[order] < best[x]
                    best[x[closer]], partner[x[closer]] = apart[order][closer], y[closer]
            else:
                found.append(np.stack([rep[a], rep[b]], 1))
            step += 1
            left = left[other[left] + step < end[left]]
        if nearest:
            having = np.flatnonzero(partner >= 0)
            found.append(np.stack([rep[having], rep[partner[having]]], 1))
        pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        pairs = np.unique(np.sort(pairs, 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=schema.names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
            # The last cell may go on in the next batch.
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1])) if len(held[0]) else ()
            if len(last):
                yield compare([c[: last[-1] + 1] for c in held])
                held = [c[last[-1] + 1 :] for c in held]
        if held is not None and len(held[0]):
            yield compare(held)

    placed = rows.repartition("key", "cell").sortWithinPartitions("key", "cell", "component")
    return placed.mapInArrow(scan, schema).distinct()


def _may_link(num: int, den: int, a: str, b: str):
    """Sizes and sketches allow the similarity: a cheap, never too strict test of two rows."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    distance = reduce(
        add,
        [F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(SKETCH_WORDS)],
    )
    return (
        (na * num <= nb * den) & (nb * num <= na * den)
        & ((den + num) * distance <= (den - num) * (na + nb))
    )


def verified(
    pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str
) -> DataFrame:
    """The pairs (a, b) whose sets have den * |intersection| >= num * |union|."""
    schema = StructType([StructField(n, LongType()) for n in ("a", "b")])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, of_last = Shingler(k), None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                text = left[i].as_py()
                if text != last:
                    last, of_last = text, shingles(text)
                other = shingles(right[i].as_py())
                both = len(np.intersect1d(of_last, other, assume_unique=True))
                keep[i] = den * both >= num * (len(of_last) + len(other) - both) > 0
            yield batch.select([0, 1]).filter(pa.array(keep))

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    needed = written(texts.join(ids, "id"), "candidate_texts")
    a = needed.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = needed.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    links = written(joined.mapInArrow(check, schema).distinct(), "links")
    discard(needed)
    return links


def near_copies(
    docs: DataFrame,
    k: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    Documents are linked when 100 * intersection >= 80 * union of their shingle sets (`num`, `den`);
    component_id is the smallest doc_id reachable by links, the document itself included. Texts without
    words (null, empty, white space) have no shingles and are linked with nothing. Rows that share a
    doc_id are one document with several texts; a row without doc_id has no component. Other
    columns are ignored; an empty table gives no rows. Ids are integers.
    """
    sets = written(signed(docs, k, num, den, id_col, text_col), "sets")
    full = sets.where("n_shingles > 0 and doc_id is not null")
    # Equal sets are linked with the smallest document that has the set, which alone offers anything.
    # Written before it is joined: a join of two plain shuffles can split the copies of a common text.
    firsts = written(
        full.groupBy("set_hash", "n_shingles").agg(F.min("doc_id").alias("rep")), "first_of_set"
    )
    narrow = full.select("doc_id", "set_hash", "n_shingles")
    equal = written(
        narrow.join(firsts, ["set_hash", "n_shingles"]).where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(),
        "equal",
    )
    # A document with several texts may stand for one set and not for another.
    standing = full.withColumnRenamed("doc_id", "rep").join(
        firsts, ["rep", "set_hash", "n_shingles"], "left_semi"
    )
    chosen = written(standing, "chosen")
    # The offers take most of the disk, so what holds them goes as soon as the next table is written.
    sizes = written(sets.select("doc_id", "n_shingles"), "sizes")
    discard(sets, firsts)
    offered = chosen.select(F.explode("keys").alias("key"), F.col("rep").alias("doc"))
    shared = written(shared_offers(offered), "shared")
    sketches = [f"s{i}" for i in range(SKETCH_WORDS)]
    features = written(chosen.select("rep", F.col("n_shingles").alias("n"), *sketches), "features")
    discard(chosen)

    def plausible(pairs: DataFrame) -> DataFrame:
        both = pairs.join(features.alias("x"), F.col("a") == F.col("x.rep")).join(
            features.alias("y"), F.col("b") == F.col("y.rep")
        )
        return both.where(_may_link(num, den, "x", "y")).select("a", "b").distinct()

    members, links, tried = shared.withColumn("component", F.col("rep")), [], []
    for step in ("star", "nearest", "all"):
        if step == "star":
            pairs = written(plausible(star(members)), "candidates")
        else:
            # Written first: a pair is found under many keys, and the anti join would be moved below the distinct.
            found = written(across(members, features, num, den, step == "nearest"), "found")
            untried = reduce(lambda left, former: left.join(former, ["a", "b"], "left_anti"), tried, found)
            pairs = written(untried, "candidates")
            discard(found, members)
        tried.append(pairs)
        links.append(verified(pairs, docs, k, num, den, id_col, text_col))
        if step != "all":
            label = components(reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "rep")
            members = _open_members(shared, label)
    discard(shared, features, *tried)

    label = components(reduce(DataFrame.unionByName, [*links, equal]))
    return (
        sizes.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def _open_members(shared: DataFrame, label: DataFrame) -> DataFrame:
    """The members of keys that more than one component shares, with their components."""
    labelled = written(
        shared.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "labelled"
    )
    ends = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    found = written(labelled.join(ends.where("lo <> hi").select("key"), "key", "left_semi"), "open_members")
    discard(labelled)
    return found


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """`docs` without the near copies: of each component the document with the smallest id stays.

    Rows without doc_id stay; of rows that share one, the one with the smallest text.
    """
    found = near_copies(docs, id_col=id_col, text_col=text_col, **options)
    copies = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_copy")).distinct()
    kept = docs.join(copies, docs[id_col] == F.col("_copy"), "left_anti")
    first = F.row_number().over(Window.partitionBy(id_col).orderBy(text_col))
    return kept.withColumn("_nth", first).where(
        F.col(id_col).isNull() | (F.col("_nth") == 1)
    ).drop("_nth")
