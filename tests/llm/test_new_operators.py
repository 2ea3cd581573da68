"""Merkle manifest, fill-in-middle and license scan against plain versions, and their odd inputs."""

import hashlib
import random
import re
import time
import zlib

import pytest
from corpus import SCHEMA, documents, prose
from kerbside.llm import fill_middle, licenses, merkle, queries
from pyspark.sql import functions as F


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def lowered(text):
    return None if text is None else text.translate({i: i + 32 for i in range(65, 91)})


# ---- Merkle manifest -----------------------------------------------------------------------------


def plain_leaf(doc, text, lang, source, n_chars):
    values = (doc, source, lang, n_chars, text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_levels(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain_path(levels, i):
    """[(siblings before, siblings after)] from a leaf's run upwards."""
    path = []
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        path.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return path


def plain_manifest(rows):
    """Sorted rows of (id, leaf, subroot, proof, folded, verified), and the root."""
    groups = {}
    for row in rows:
        doc, text, lang, source, n_chars = row
        third = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        now = plain_leaf(doc, lowered(text) if third else text, lang, source, n_chars)
        groups.setdefault(lang, []).append((doc, plain_leaf(*row), now))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        trees[g] = plain_levels([leaf for _, leaf, _ in groups[g]])
    top = plain_levels([trees[g][-1][0] for g in order])
    found = []
    for at, g in enumerate(order):
        for i, (doc, leaf, now) in enumerate(groups[g]):
            path = plain_path(trees[g], i) + plain_path(top, at)
            folded = now
            for before, after in path:
                folded = h(*before, folded, *after)
            proof = ["".join(a + b) for a, b in path]
            found.append((doc, leaf, trees[g][-1][0], proof, folded, folded == top[-1][0]))
    return sorted(found, key=str), top[-1][0]


def manifest_of(spark, rows):
    text = F.col("text")
    now = F.when(merkle.every_third(F.col("doc_id")), merkle.lower_ascii(text)).otherwise(text)
    return merkle.build(spark.createDataFrame(rows, SCHEMA).repartition(3), now={"text": now})


def check_manifest(spark, rows):
    built = manifest_of(spark, rows)
    want, root = plain_manifest(rows)
    got = [(r.id, r.leaf, r.subroot, r.proof, r.folded_root, r.verified) for r in merkle.proofs(built).collect()]
    assert built.root == root and sorted(got, key=str) == want


def test_manifest_equals_brute_force(spark):
    rows = documents(60, seed=8)
    rows += [(i, "Same Text", "fr", None, 9) for i in range(200, 350)]  # three levels
    rows += [(7, "again", "en", "s", 1), (7, "again", "en", "s", 1), (None, "A", "en", "s", 1), (None, None, None, None, None)]
    check_manifest(spark, rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_manifest_of_one_group_of_any_size(spark, n):
    check_manifest(spark, [(i, f"Text {i}", "en", "s", i) for i in range(n)])


def test_manifest_of_single_leaves_and_many_groups(spark):
    check_manifest(spark, [(i, "T", f"l{i}" if i else "", "s", i) for i in range(70)])


def test_a_hot_run_is_joined_in_blocks(spark, monkeypatch):
    """With tiny blocks the top runs have a row for each block, and the proofs stay the same."""
    monkeypatch.setattr(merkle, "BLOCK_BITS", 2)
    rows = [(i, f"Text {i}", "en" if i % 4 else "de", "s", i) for i in range(150)]
    built = manifest_of(spark, rows)
    keys = built.leaves.groupBy("up_tree", "up_level", "up_node", "block").count().agg(F.max("count")).first()[0]
    assert keys <= 4 and built.runs.where("up_tree is null").count() == 38
    check_manifest(spark, rows)


def test_manifest_of_nothing(spark, no_docs):
    built = merkle.build(no_docs)
    assert built.root is None and merkle.proofs(built).collect() == []


def test_manifest_ignores_other_columns(spark):
    rows = spark.createDataFrame([(1, "a", "en", "s", 1, 9, "x", "y")], SCHEMA + ", tree int, leaf string, grp string")
    assert merkle.proofs(merkle.build(rows)).first().verified


def test_manifest_of_a_long_text(spark):
    check_manifest(spark, [(0, "Ab " * 400_000, "en", "s", 1), (1, None, "en", None, None)])


# ---- fill in the middle --------------------------------------------------------------------------

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    head = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(head[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_brute_force(spark):
    rows = [(d, t) for d, t, *_ in documents(120, seed=3)]
    rows += [(i, "  lead and \n trail \t ") for i in range(300, 330)] + [(i, " \n ") for i in range(330, 345)]
    rows += [(400, "has <P> in it"), (401, "has <M>"), (402, "half < P>"), (None, "no id"), (7, "twice"), (7, "twice")]
    rows += [(500 + i, "é😀 ü\n" * 3000) for i in range(6)]
    made = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    made = made.withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made]
    want = [(d, *plain_fim(d, t)) for d, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sorted(r.again for r in made) == sorted(t or "" for _, t in rows)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_every_cut_of_a_text_is_a_token_end():
    draw = random.Random(4)
    summary = fill_middle.Summaries()
    for _ in range(200):
        text = "".join(draw.choice(["a", "bé ", "\n", " ", "xyz", "😀", "word "]) for _ in range(draw.choice([0, 1, 5, 60, 900])))
        tokens = TOKEN.findall(text)
        found = fill_middle.Tokens(text.encode(), summary)
        assert found.n == len(tokens)
        for k in {0, len(tokens), *(draw.randrange(len(tokens) + 1) for _ in range(5))}:
            head = "".join(tokens[:k])
            assert found.cut(k) == (len(head.encode()), len(head))


def test_borders_depend_on_the_content_alone():
    """A passage is divided alike, once past its first border, wherever it stands."""
    passage = prose(3000, 5).encode()
    one, other = (fill_middle.borders(lead + passage) for lead in (b"", prose(100, 6).encode()))
    shift = len(prose(100, 6).encode())
    assert len({e - shift for e in other} & set(one)) > 0.8 * len(one)
    assert all(b - a <= fill_middle.MOST for a, b in zip([0, *one], one)) and one[-1] == len(passage)


def test_shared_chunks_are_summarised_once_and_memory_is_bounded():
    summary, passage = fill_middle.Summaries(limit=1 << 20), prose(2000, 5).encode()
    fill_middle.Tokens(passage, summary)
    before = summary.hits
    fill_middle.Tokens(prose(50, 9).encode() + b" " + passage, summary)
    assert summary.hits - before > 0.7 * len(fill_middle.borders(passage))
    for seed in range(60):
        fill_middle.Tokens(prose(20_000, seed).encode(), summary)
        assert sum(map(len, [*summary.young, *summary.old])) < 2 << 20


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "a " * 500_000, "😀" * 300_000, "\n\n" * 500_000])
def test_long_texts_take_little_time(text):
    start = time.time()
    found = fill_middle.Tokens(text.encode(), fill_middle.Summaries())
    assert found.n == len(TOKEN.findall(text)) and time.time() - start < 2


def test_fill_in_middle_of_nothing_and_clashing_columns(spark, no_docs):
    assert fill_middle.fill_in_middle(no_docs).collect() == []
    odd = spark.createDataFrame([(1, "a b", "f", "o")], "doc_id bigint, text string, form string, output string")
    assert fill_middle.fill_in_middle(odd).select("doc_id", "n").collect() == [(1, 2)]


# ---- licenses ------------------------------------------------------------------------------------

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LINES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "MIT\n  License and Apache--License",
    "GNU general\tpublic LICENSE gnu General Public License", "permit license", "cc byte", "apachelicense", "mit licenses",
    "cc by cc by", "Ünder the ＭＩＴ License", "mit licenseé", "SPDX-License-Identifier: GPL-2.0-or-later", "",
]


def plain_base(text):
    words = LICENSE_WORD.findall(lowered(text) or "")
    found = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(found)


def license_rows():
    draw = random.Random(2)
    rows = [(d, t) for d, t, *_ in documents(30, seed=6)] + list(enumerate(LINES, 100))
    for i in range(200, 240):
        rows.append((i, "\n".join(draw.choice([prose(12, i * 9 + j), draw.choice(LINES)]) for j in range(8))))
    return rows + [(None, LINES[0]), (100, LINES[1])]


def test_base_places_equal_brute_force(spark):
    rows = license_rows()
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    have = sorted(
        ((r.doc_id, r.n_words, sorted((d.start, d.label) for d in r.detections if d.base)) for r in got), key=str)
    assert have == sorted(((d, *plain_base(t)) for d, t in rows), key=str)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.detections) for r in got)


def plain_rules(text):
    """Every rule on every text, no prefilter; then each detection compared with all others."""
    words = [w.encode() for w in LICENSE_WORD.findall(lowered(text) or "")]
    flat = b" " + b" ".join(words) + b" "
    hits = []
    for order, rule in enumerate(licenses.rules()):
        if rule.keywords <= {w.decode() for w in words}:
            for m in rule.pattern.finditer(flat):
                hits.append((flat[: m.start()].count(b" ") - 1, flat[: m.end()].count(b" "), rule.label, order, rule.priority))
    kept = []
    for a in hits:
        inside = any(
            b[0] <= a[0] and a[1] <= b[1] and b is not a
            and (b[4] > a[4] or b[4] == a[4] and ((b[0], b[1]) != (a[0], a[1]) or b[3] < a[3])) for b in hits)
        if not inside:
            kept.append(a[:3])
    return sorted(kept)


def test_rules_and_suppression_equal_brute_force():
    scanner = licenses.Scanner()
    for _, text in license_rows():
        _, hits = scanner(licenses.words_of((text or "").encode()))
        assert sorted(x[:3] for x in hits) == plain_rules(text), text


def test_keywords_never_hide_a_match():
    """Where a rule's expression matches, another rule of that expression has its keywords in the match."""
    by_pattern = {}
    for rule in licenses.rules():
        by_pattern.setdefault((rule.label, rule.kind, rule.pattern), []).append(rule.keywords)
    texts = [" ".join(LICENSE_WORD.findall(lowered(t))) for t in LINES]
    texts += ["released to the public domain", "gnu affero general public license v3", "creative commons attribution sharealike 4 0"]
    for (_, _, pattern), options in by_pattern.items():
        for text in texts:
            for m in pattern.finditer(f" {text} ".encode()):
                assert any(k <= set(m[0].decode().split()) for k in options), (pattern, text)


@pytest.mark.parametrize(("text", "labels"), [
    (LINES[0], {"apache-2.0"}), (LINES[1], {"mit"}), (LINES[2], {"cc-by-nc-4.0"}), (LINES[3], {"gpl-3.0"}),
    ("SPDX-License-Identifier: MIT", {"mit"}), ("CC BY-SA 3.0", {"cc-by-sa-3.0"}),
    ("Creative Commons Attribution 4.0 International", {"cc-by-4.0"}), ("under the LGPL v2.1", {"lgpl-2.1"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", {"mit"}),
    ("nothing of the kind", set()),
])
def test_known_license_lines(text, labels):
    _, hits = licenses.Scanner()(licenses.words_of(text.encode()))
    assert {x[2] for x in hits} >= labels and (labels or not hits)


def test_hundreds_of_rules_in_order():
    found = licenses.rules()
    assert len(found) >= 300 and [r.priority for r in found] == sorted((r.priority for r in found), reverse=True)


@pytest.mark.parametrize("text", [
    "licensed under " * 70_000, "gnu gpl licensed terms public " * 35_000, "neither the name of " * 50_000 + "contributors endorse",
    "released to the " * 60_000 + "public domain", "a" * 1_000_000, " " * 1_000_000, "mit license " * 50_000,
])
def test_long_texts_are_scanned_in_little_time(text):
    scanner, start = licenses.Scanner(), time.time()
    scanner(licenses.words_of(text.encode()))
    assert time.time() - start < 3


def test_license_scan_of_nothing_and_clashing_columns(spark, no_docs):
    assert licenses.scan(no_docs).collect() == []
    odd = spark.createDataFrame([(1, None, "x", 2.0)], "doc_id bigint, text string, detections string, score double")
    assert licenses.scan(odd).collect() == [(1, 0, [], 0.0)]


def test_license_query_digests_the_detections(spark):
    rows = queries.queries()["op13_license_scan"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert any(r.n_base for r in rows)
    for r in rows:
        n_words, base = plain_base(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n_words, len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        method = {x[2] for x in licenses.Scanner()(licenses.words_of((texts[r.doc_id] or "").encode()))[1]}
        assert r.labels == ",".join(sorted({x for _, x in base} | method))
