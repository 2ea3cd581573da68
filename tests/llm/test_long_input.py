"""Hostile long texts: each operator's work on one of them ends soon, with the right result."""

import time

import numpy as np
import public_tokenizers
import pytest
from kerbside.llm import extraction, html_blocks, jaccard, langid, token_counts
from pyspark.sql import functions as F

MB = 1_000_000
TEXTS = {
    "lines": "\n" * MB, "blanks": " " * MB, "one word": "a" * MB, "short words": "a " * (MB // 2),
    "wide": "é" * (MB // 2), "numbers": " ".join(map(str, range(MB // 7))), "emoji": "😀 " * (MB // 5),
}
PAGES = {
    "open tags": "<a " * 100_000, "nested": "<div>x" * 60_000, "open quotes": '<a b="' * 50_000, "declarations": "<!" * 200_000,
    "paragraphs": "<p>" * 100_000, "nested paragraphs": "<div><p>x" * 20_000, "closing": "</div>" * 100_000,
    "items": "<ul><li>x" * 20_000, "fenced": "<p><button>" + "<div>z" * 10_000, "comments": "<!--" * 100_000,
    "tables": "<table><tr><td>x" * 10_000,
}


@pytest.mark.parametrize("name", PAGES)
def test_markup_is_read_in_little_time(name):
    start = time.time()
    html_blocks.leaf_blocks(PAGES[name])
    assert time.time() - start < 2


def test_text_after_the_last_tag_and_open_comments():
    def texts(page):
        return [b.text for b in html_blocks.leaf_blocks(page)]

    assert texts("<p>a</p>b < c <d") == ["a", "b < c <d"]
    assert texts("<p>a</p>b <!-- c <p") == ["a", "b"]
    assert texts("<p>a<!-- > -->b<!-- open > </p>c") == ["ab"]
    assert texts("<" + "div>" + "<div>" * 200 + "deep</div>up") == ["deep", "up"]
    assert len(html_blocks.leaf_blocks("<div>" * 200 + "deep")[0].path) == html_blocks.DEPTH


@pytest.fixture(scope="module")
def encoder():
    return token_counts.SpanEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.mark.parametrize("name", TEXTS)
def test_tokens_of_long_texts(encoder, name):
    text, start = TEXTS[name], time.time()
    starts, ends = encoder.spans(text)
    assert time.time() - start < 2
    assert starts[0] == 0 and ends[-1] == len(text) and (np.diff(starts) >= 0).all()


def test_long_runs_of_white_space_encode_as_ever(encoder):
    draw = np.random.default_rng(3)
    for _ in range(60):
        text = "".join(
            str(draw.choice(["a", " b", "x1", "é", " ", "\n"])) if draw.random() < 0.5
            else str(draw.choice([" ", "\n", "　", " \n", "\x85"])) * int(draw.integers(1, 2500))
            for _ in range(int(draw.integers(1, 8))))
        whole = encoder.encoding.encode_to_numpy(text, disallowed_special=())
        assert list(encoder.ids(text)) == list(whole)


@pytest.mark.parametrize("text", ["½ ²³ ①", "Ⅷ", "1 2 3", "!?", "٣ ४"])
def test_numbers_are_no_letters(text):
    assert [langid.letters_of(w.encode()) for w in text.split()] == [""] * len(text.split())


@pytest.mark.parametrize("name", TEXTS)
def test_other_operators_take_little_time(name):
    text = TEXTS[name]
    shingles, bands = jaccard.Shingler(3), jaccard.Bands(90, 100)
    for work in (lambda: jaccard.offers(shingles(text), bands),):
        start = time.time()
        work()
        assert time.time() - start < 2


def test_sampled_pages_are_the_only_ones_fetched(spark):
    """At most SAMPLED_PAGES pages reach the driver, chosen by hash, copies of one page included."""
    rows = [(i, f"<html><article><p>text {i % 150}</p></article><div>menu</div></html>") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id int, html string")
    model = extraction.trained(pages)
    assert model.weights
    assert extraction.trained(pages.where(F.lit(False))).weights
