"""Operators over whole corpora: repeats, near copies, top-k, mixing, components."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from corpus import (
    SCHEMA, documents, edited, plain_components, plain_repeats, plain_targets, prose, shingles, words,
)
from kerbside.llm import jaccard, mixing, repeats, topk
from kerbside.llm.common import components


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


# ---- connected components ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)]
    links += [(100 + i, 101 + i) for i in range(20)] + [(5, 5), (200, 200)]
    parent = {n: n for pair in links for n in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    got = {r.node: r.component for r in components(frame(spark, links, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for a, b in links if a != b for n in (a, b)}


def test_components_of_nothing(spark):
    assert components(frame(spark, [], "a bigint, b bigint")).collect() == []


# ---- substring repeats ---------------------------------------------------------------------------


def repeat_rows():
    passage = prose(64, 901)
    rows = [(d, t) for d, t, *_ in documents(30, seed=4)]
    rows += [
        (100, passage), (101, prose(20, 1) + " " + passage + " " + prose(20, 2)), (102, passage + " " + passage),
        (90, prose(10, 3) + "\n" + passage), (103, "same " * 130), (104, "same " * 70 + "end"), (105, "same " * 49),
        (106, prose(50, 5)), (107, prose(50, 5)), (108, prose(49, 6)), (109, prose(49, 6)),
        (110, edited(prose(300, 7), 4, 1)), (111, prose(300, 7)), (112, edited(prose(300, 7), 5, 2)),
        (None, passage), (100, prose(80, 8) + " " + passage), (113, prose(80, 8)), (113, prose(80, 8)),
        (114, passage.replace("\n", " ") + " x"), (-5, prose(60, 9)), (115, prose(60, 9)),
    ]
    return rows


def check_repeats(spark, rows):
    got = repeats.without_repeats(frame(spark, rows)).collect()
    want = plain_repeats(rows)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(
        ((d, *want[d, t]) for d, t in rows), key=str)
    assert sum(r.n_removed for r in got) > 0


def test_repeats_equal_brute_force(spark):
    check_repeats(spark, repeat_rows())


def test_large_divisions_give_the_same(spark, monkeypatch):
    """The bound is read on the driver, so a low one sends every division through longer and longer prefixes."""
    monkeypatch.setattr(repeats, "TREE_ENTRIES", 1)
    check_repeats(spark, repeat_rows())


def naive_nodes(suffixes):
    """(depth, leaves below, depth of the parent) of a suffix tree, from all common prefixes of all suffixes."""
    prefixes = {}
    for i, suffix in enumerate(suffixes):
        for n in range(len(suffix) + 1):
            prefixes.setdefault(tuple(suffix[:n]), set()).add(i)
    branching = {p for p, below in prefixes.items() if p and len(below) > 1 and all(
        prefixes.get((*p, w)) != below for w in {suffixes[i][len(p)] for i in below if len(suffixes[i]) > len(p)})}
    found = []
    for p in branching:
        above = max((n for n in range(len(p)) if p[:n] in branching), default=0)
        found.append((len(p), frozenset(prefixes[p]), above))
    return sorted(found, key=str)


def test_nodes_equal_those_of_a_naive_suffix_tree():
    draw = random.Random(7)
    for _ in range(60):
        words_of = [[draw.choice("abc") for _ in range(draw.randint(1, 14))] for _ in range(draw.randint(1, 4))]
        suffixes = sorted(
            (np.array([ord(c) for c in w[i:]], ">u4").tobytes(), w[i:]) for w in words_of for i in range(len(w)))
        depths = [repeats.common_words(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
        got = [(d, frozenset(range(a, b)), up) for d, a, b, up in repeats.internal_nodes(depths)]
        assert sorted(got, key=str) == naive_nodes([x for _, x in suffixes])


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    text = ("aa b aa ccc " + "é" * 40 + " b a a aa").encode()
    words_of = text.split()
    want = None
    for size in (1 << 18, 5, 1):
        monkeypatch.setattr(repeats, "HASHED_BYTES", size)
        got = repeats.word_hashes(text, *repeats.word_bounds(text)).tolist()
        want = want or got
        assert got == want
        assert [got[i] == got[j] for i in range(9) for j in range(9)] == [
            words_of[i] == words_of[j] for i in range(9) for j in range(9)]


def test_anchors_depend_on_the_window_alone():
    """Equal windows have their anchor at the same place, whatever surrounds them."""
    anchors = repeats.Anchors()
    common = prose(120, 33).encode().split()
    marks = []
    for before, after in ((0, 0), (7, 90), (61, 3)):
        around = prose(before, 5).encode().split() + common + prose(after, 6).encode().split()
        found = {}
        for anchor, lo, windows, mark in zip(*anchors(around)):
            for w in range(lo, lo + windows):
                found[w - before] = (anchor, lo + mark - w)
        assert sorted(found) == list(range(-before, len(around) - before - 49))
        marks.append([found[w] for w in range(len(common) - 49)])
    assert marks[0] == marks[1] == marks[2]


def test_subtree_repeats_by_hand():
    a = [b"%d" % i for i in range(60)]
    group = [(9, a), (4, a[5:]), (9, a[:50]), (2, [b"x"] * 52)]
    got = sorted(repeats.subtree_repeats(group))
    assert got == [(0, s) for s in range(5, 11)]


def test_repeats_of_an_empty_table_and_clashing_columns(spark, no_docs):
    assert repeats.without_repeats(no_docs).collect() == []
    rows = [(1, prose(60, 1), 5, "x"), (2, prose(60, 1), 6, None)]
    df = frame(spark, rows, "doc_id bigint, text string, row int, anchor string")
    assert sorted((r.doc_id, r.n_removed) for r in repeats.without_repeats(df).collect()) == [(1, 0), (2, 60)]


# ---- Jaccard join --------------------------------------------------------------------------------


def near_rows():
    rows = [(d, t) for d, t, *_ in documents(30, seed=6)]
    base, other = prose(200, 50, 5000), prose(90, 51, 5000)
    rows += [(200 + i, edited(base, 1 + i % 4, i)) for i in range(25)]
    rows += [(300 + i, edited(other, i % 3, i)) for i in range(12)]
    rows += [(400 + i, " ".join(words(base)[: 200 - 3 * i])) for i in range(12)]
    rows += [(500, "A b C"), (501, "a B c"), (502, "a b"), (503, "A B"), (504, "a"), (505, "a b c d")]
    rows += [(None, base), (200, other), (506, base), (506, base)]
    return rows


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_near_copies_equal_brute_force(spark, k, num, den):
    rows = near_rows()
    want = plain_components(rows, k, num, den)
    got = jaccard.near_copies(frame(spark, rows), k, num, den).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(
        ((d, len(shingles(t, k)), None if d is None else want[d]) for d, t in rows), key=str)
    assert len(set(want.values())) < len(want) - 20


def test_common_offers_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "STAR_ROWS", 2)
    rows = near_rows()
    want = plain_components(rows, 3, 90, 100)
    got = jaccard.near_copies(frame(spark, rows), 3, 90, 100).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want


def family(n, seed, base=60):
    """n texts that differ from a common one in one word each."""
    words_of = words(prose(base, seed, 10**6))
    return [" ".join(w if j != i % base else f"x{i}" for j, w in enumerate(words_of)) for i in range(n)]


def with_features(spark, reps, sketch=lambda r: 0, size=lambda r: 50):
    names = [f"s{i}" for i in range(jaccard.SKETCH_WORDS)]
    rows = [(r, size(r), *[sketch(r)] * len(names)) for r in reps]
    return spark.createDataFrame(rows, "rep bigint, n bigint, " + ", ".join(f"{x} bigint" for x in names))


MEMBERS = "key bigint, rep bigint, home boolean, component bigint"


def test_an_outsider_under_the_key_of_a_large_family_makes_no_square(spark):
    """2,000 near copies and one other document share a key: only pairs with the outsider are formed."""
    n = 2000
    members = spark.createDataFrame(
        [(1, i, True, 0) for i in range(n)] + [(1, n, True, n), (2, 1, True, 0), (2, 2, False, 0), (3, 5, False, 0), (3, n, False, n)],
        MEMBERS,
    )
    pairs = jaccard.across(members, with_features(spark, range(n + 1)), 90, 100)
    assert sorted(map(tuple, pairs.collect())) == [(i, n) for i in range(n)]


@pytest.mark.parametrize("cell", [2048, 3])
def test_pairs_across_components_are_complete(spark, monkeypatch, cell):
    """Also where a key's members are dealt over many cells."""
    monkeypatch.setattr(jaccard, "CELL", cell)
    draw = random.Random(5)
    rows = list({(draw.randrange(8), draw.randrange(40)) for _ in range(150)})
    home = {row: draw.random() < 0.6 for row in rows}
    members = frame(spark, [(k, r, home[k, r], r % 7) for k, r in rows], MEMBERS)
    # Every third sketch is far from the others, and every eleventh set too large.
    features = with_features(spark, range(40), lambda r: -1 if r % 3 == 0 else 0, lambda r: 70 if r % 11 == 0 else 50)
    want = {tuple(sorted((a, b))) for k, a in rows for j, b in rows
            if k == j and a % 7 != b % 7 and (home[k, a] or home[j, b])
            and (a % 3 == 0) == (b % 3 == 0) and (a % 11 == 0) == (b % 11 == 0)}
    assert sorted(map(tuple, jaccard.across(members, features, 90, 100).collect())) == sorted(want)


def test_what_the_star_leaves_of_a_family_takes_few_pairs(spark):
    """300 members in components of their own make 22,350 pairs; nearest ones are one a member, and none is left out."""
    sketches = with_features(spark, range(300), lambda r: r % 2)
    members = spark.createDataFrame([(1, i, True, i) for i in range(300)], MEMBERS)
    assert jaccard.across(members, sketches, 80, 100).count() == 2 * 150 * 149 // 2
    pairs = [tuple(p) for p in jaccard.across(members, sketches, 80, 100, nearest=True).collect()]
    assert len(pairs) <= 300 and {i for p in pairs for i in p} == set(range(300))
    assert all(a % 2 == b % 2 for a, b in pairs)


def test_large_families_equal_brute_force(spark):
    rows = list(enumerate(family(120, 1) + family(90, 2) + [prose(60, 3)]))
    # Two families that share a passage, joined by nothing; and a chain from one family to a third text.
    rows += [(1000 + i, t + " " + prose(14, 9)) for i, t in enumerate(family(60, 4) + family(60, 5))]
    for num in (90, 80):
        want = plain_components(rows, 3, num, 100)
        got = jaccard.near_copies(frame(spark, rows), 3, num, 100).collect()
        assert {r.doc_id: r.component_id for r in got} == want


def test_linked_sets_always_share_an_offer():
    """The pigeonhole argument, on sets at the very threshold and of all small sizes."""
    draw = random.Random(1)
    for num, den in ((90, 100), (80, 100)):
        bands = jaccard.Bands(num, den, 5000)
        for _ in range(400):
            size = draw.choice([1, 2, 5, 9, 10, 11, 19, 20, 30, 50, 100, 300, 1000])
            union = [draw.getrandbits(64) for _ in range(size)]
            spare = size * (den - num) // den
            cut = draw.randint(0, spare)
            a = np.unique(np.array(union[: size - cut], np.uint64))
            b = np.unique(np.array(union[spare - cut :], np.uint64))
            both = len(np.intersect1d(a, b))
            assert den * both >= num * (len(a) + len(b) - both)
            # Equal sets are linked before any offer; of others that meet, one is at home (an odd key).
            mine, theirs = (set(jaccard.offers(x, bands).tolist()) for x in (a, b))
            met = {x >> 1 for x in mine} & {x >> 1 for x in theirs}
            assert list(a) == list(b) or any(x % 2 and x >> 1 in met for x in mine | theirs)


def test_hamming_distance_is_a_lower_bound():
    draw = np.random.default_rng(2)
    for _ in range(100):
        a, b = (np.unique(draw.integers(0, 400, 200).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in "ab")
        for parts in (1, 4, 37):
            distance = sum(bin(int(x)).count("1") for x in jaccard.parity(a, parts) ^ jaccard.parity(b, parts))
            assert distance <= len(np.setxor1d(a, b))


def test_one_of_each(spark, no_docs):
    rows = near_rows()
    df = frame(spark, [(d, t, "n", 1) for d, t in rows], "doc_id bigint, text string, component_id string, n int")
    want = plain_components(rows, 5, 80, 100)
    got = jaccard.one_of_each(df, k=5, num=80, den=100)
    assert got.columns == df.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(
        [d for d, c in want.items() if d == c] + [None], key=str)
    assert jaccard.one_of_each(no_docs).collect() == []
    assert jaccard.near_copies(no_docs).collect() == []


# ---- top-k ---------------------------------------------------------------------------------------


def plain_top(rows, k, every):
    usable = []
    for i, (vec, x) in enumerate(rows):
        if vec is not None and x and all(v is not None and math.isfinite(v) for v in x):
            usable.append((i, vec, [math.floor(64 * v) for v in x]))
    result = []
    for i, q, x in usable:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for j, v, y in usable if j != i and len(x) == len(y))
            result += [(q, n + 1, v, -s) for n, (s, v) in enumerate(scored[:k])]
    return sorted(result)


@pytest.mark.parametrize("n, block", [(90, 8192), (700, 300)])
def test_top_k_equals_brute_force(spark, n, block):
    draw = random.Random(n)
    rows = [(i, [struct_float(draw.gauss(0, 0.4)) for _ in range(12)]) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(20, rows[3][1]), (20, rows[3][1]), (1000, None), (1020, []), (None, [0.5] * 12),
             (1040, [0.1, None] + [0.0] * 10), (1060, [math.nan] * 12), (1080, [math.inf] + [0.0] * 11),
             (1100, [0.0] * 12), (1120, [0.3, -0.2]), (1121, [0.1, 0.9])]
    df = spark.createDataFrame(
        [(v, x, "c") for v, x in rows], "vec_id bigint, embedding array<float>, rank string").repartition(4)
    got = topk.top_k(df, k=5, every=20, block_rows=block).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == plain_top(rows, 5, 20)


def struct_float(x):
    return float(np.float32(x))


def test_survivors_hold_the_best():
    draw = np.random.default_rng(3)
    values = draw.integers(-40, 40, (3000, 16))
    values[:5] = 30
    lists = topk.SortedLists(np.arange(3000), values)
    queries = np.array([values[0], values[9], -values[0], np.eye(16, dtype=np.int64)[3], np.zeros(16, np.int64)])
    skip = np.array([0, 9, -1, -1, -1])
    for q, out, kept in zip(queries, skip, lists.survivors(queries, 10, skip)):
        scores = values @ q
        bar = np.sort(np.delete(scores, out) if out >= 0 else scores)[-10]
        assert set(np.flatnonzero(scores >= bar)) - {out} <= set(kept)
        assert len(kept) < 3000 or not q.any()
    huge = topk.SortedLists(np.arange(300), draw.integers(-(2**30), 2**30, (300, 4)))
    assert all(len(kept) == 300 for kept in huge.survivors(huge.values[:2], 3, np.array([-1, -1])))


def test_top_k_of_an_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []


def test_top_k_sends_no_vectors_to_the_driver(spark):
    """The queries, once per block of vectors, were broadcast: dictionary pages made their files look small."""
    df = spark.range(4000).selectExpr("id AS vec_id", "transform(sequence(1, 12), i -> float(cos(id * i))) AS embedding")
    found = topk.top_k(df.repartition(5), k=3, every=4, block_rows=50)
    text = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = [x for x in text.split("\n\n") if "BroadcastExchange" in x.partition("\n")[0]]
    assert not any("values" in x for x in sent), sent


def test_cells_hold_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELLS_PER_CORE", 1)
    df = spark.range(1500).selectExpr(
        "id AS vec_id", "transform(sequence(1, IF(id < 100, 2, 3)), i -> float(sin(id * i))) AS embedding")
    held = topk.blocks(df.repartition(3), "vec_id", "embedding", 40)
    held = topk.written(held, "blocks")
    asked = topk.written(topk._questions(held, 2), "questions")
    given, met, _ = topk._cells(held, asked, 40)
    pairs = Counter((r.block, r.q_blocks, r.q_rows) for r in given.join(met, topk.CELL).collect())
    blocks, questions = Counter(r.dims for r in held.collect()), Counter(r.dims for r in asked.collect())
    assert set(pairs.values()) == {1} and len(pairs) == sum(blocks[d] * questions[d] for d in blocks)
    sizes = given.groupBy(*topk.CELL).count().agg({"count": "max"}).first()[0]
    assert 1 < sizes <= topk.CELL_BLOCKS


# ---- mixing --------------------------------------------------------------------------------------


def check_mix(rows, got):
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    targets = plain_targets(sizes)
    assert len(got) == len(rows)
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=str) == sorted(rows, key=str)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6


def mix_rows(n, seed):
    draw = random.Random(seed)
    rows = [(i, draw.choice(["s0"] * 6 + ["s1", "s2", "é", "", None, "B"]), draw.choice([0, 1, 3, 20, 20, 300]))
            for i in range(n)]
    return rows + [(7, "s1", 20)] * 3 + [(None, "s1", 20), (None, "s1", 20), (n, "alone", 11), (n + 1, "wordless", 0)]


@pytest.mark.parametrize("bucket", [256, 4])
def test_mix_comes_near_its_targets(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    rows = mix_rows(400, 1)
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").repartition(3)
    got = mixing.mix_sizes(df).collect()
    check_mix(rows, got)
    again = mixing.mix_sizes(df.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_is_unbiased(spark):
    """Over seeds, a document is taken about as often as its source's rate says."""
    rows = [(i, "a" if i < 40 else "b", 10 + i % 5) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").coalesce(1)
    total, runs = {}, 3
    for seed in range(runs):
        for r in mixing.mix_sizes(df, seed=seed).collect():
            total[r.doc_id] = total.get(r.doc_id, 0) + r.copies
    rate = {s: t / sum(z for _, x, z in rows if x == s) for s, t in
            plain_targets({"a": sum(z for _, s, z in rows if s == "a"), "b": sum(z for _, s, z in rows if s == "b")}).items()}
    for s in "ab":
        mean = np.mean([total[d] / runs for d, x, _ in rows if x == s])
        assert abs(mean - rate[s]) < 0.05
        assert len({total[d] for d, x, _ in rows if x == s}) > 1 or rate[s] == round(rate[s])


def test_mix_of_documents(spark, docs, no_docs):
    rows = [(d, s, len(words(t))) for d, t, _, s, _ in documents()]
    check_mix(rows, mixing.mix(docs).collect())
    copies = {}
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] = r.copies
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    counts = {}
    for r in got.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {d: c for d, c in copies.items() if c}
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_targets_equal_water_filling(spark):
    draw = random.Random(4)
    for n in (1, 2, 5, 9):
        sizes = {f"s{i}": draw.choice([0, 1, 50, 1000, 10**6]) for i in range(n)} | {None: 40}
        rows = [(s, z) for s, z in sizes.items()]
        got = mixing.source_targets(spark.createDataFrame(rows, "source string, size bigint")).collect()
        want = plain_targets(sizes)
        for r in got:
            assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)


def test_mixing_runs_no_python(docs):
    for df in (mixing.mix(docs), mixing.mixed(docs)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text


def test_schema_is_that_of_documents(docs):
    assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
