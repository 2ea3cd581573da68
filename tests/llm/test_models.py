"""Operators with a trained model: language id and HTML extraction; the pipeline."""

import random

import pytest
from corpus import ODD_TEXTS, documents, plain_components, plain_secrets, words

import corpus_pipeline
from kerbside.llm import extraction, html_blocks, langid, mixing, packing, quality, queries

# ---- language id ---------------------------------------------------------------------------------

SYLLABLES = {
    "aa": ["ka", "to", "mi", "re", "lu"], "bb": ["sch", "ung", "keit", "ver", "äu"], "cc": ["ión", "que", "ñar", "los", "ez"],
    "gr": ["αλ", "ος", "εί", "τη"], "ru": ["ов", "ст", "ни", "пр"],
}


def sentence(lang, n, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(sentence(lang, 60, i), lang) for lang in SYLLABLES for i in range(20)]
    rows += [(None, "aa"), ("x", None), ("", "bb")]
    return langid.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_languages_and_scripts_are_learned(model):
    assert model.languages == tuple(sorted(SYLLABLES))
    assert set(model.scripts) == {"latin", "greek", "cyrillic"}
    assert [a for a, ok in zip(model.languages, model.scripts["greek"]) if ok] == ["gr"]


def test_held_out_texts_are_recognised(spark, model):
    rows = [(i, sentence(lang, 12, 1000 + i), lang) for i, lang in enumerate(list(SYLLABLES) * 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang_pred string")
    got = langid.identify(df, model).collect()
    right = sum(r.lang_pred == rows[r.doc_id][2] for r in got)
    assert right >= 0.98 * len(rows) and all(0 <= r.score <= 1 for r in got)


def test_mixed_texts_fall_into_spans(spark, model):
    parts = [("aa", 30), ("cc", 12), ("gr", 9), ("bb", 25)]
    text = " 12 \n".join(sentence(lang, n, 7) for lang, n in parts)
    row = langid.identify(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    assert [s.lang for s in row.spans] == [lang for lang, _ in parts]
    place = 0
    for s, (_, n) in zip(row.spans, parts):
        assert s.first_word == place and abs(s.n_words - n) <= 3
        place += s.n_words
    assert place == len(words(text))


def test_one_odd_word_breaks_no_span(spark, model):
    text = f"{sentence('aa', 20, 1)} keit {sentence('aa', 20, 2)}"
    row = langid.identify(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    assert [s.lang for s in row.spans] == ["aa"] and row.score == 1.0


def test_odd_texts_have_a_defined_language(spark, model, no_docs):
    odd = [*ODD_TEXTS, "123 !?", "漢字 かな", "漢字 " + sentence("ru", 9, 1)]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    for i, text in enumerate(odd):
        letters = any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred == "und") == (not letters), text
        assert got[i].lang_pred in (*SYLLABLES, "und")
    assert got[len(odd) - 2].score == 0.0 and got[len(odd) - 1].lang_pred == "ru"
    assert langid.identify(no_docs, model).collect() == []
    nothing = langid.learn(no_docs)
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def test_a_rare_script_of_the_sample_is_nobodys(spark):
    rows = [(sentence(lang, 60, i), lang) for lang in ("aa", "bb", "cc") for i in range(20)]
    rows += [(f"{sentence('aa', 20, 99)} {sentence('gr', 2, 1)} слово 漢字", "aa")]
    rare = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert {s for s, ok in rare.scripts.items() if not any(ok)} == {"greek", "cyrillic", "han"}
    assert rare.word_scores("λόγος") == (0.0, 0.0, 0.0)
    texts = [f"{sentence('bb', 9, 1)} λόγος {sentence('bb', 9, 2)}", "слово 漢字"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in langid.identify(df, rare).collect()}
    assert got[0].lang_pred == "bb" and [s.lang for s in got[0].spans] == ["bb"]
    assert got[1].lang_pred in rare.languages and got[1].score == 0.0


def test_copies_take_one_place_of_the_sample(spark):
    rows = [(c * 4, "aa") for c in "pqxyz" for _ in range(10)] + [("pppp", "bb")]
    df = spark.createDataFrame(rows, "text string, lang string")
    learned = langid.learn(df, texts=5)
    assert {c for c in "pqxyz" if f"={c * 4}" in learned.likelihood} == set("pqxyz")
    assert learned.likelihood["=xxxx"][0] == learned.likelihood["=zzzz"][0]
    assert sum(f"={c * 4}" in langid.learn(df.where("lang = 'aa'"), texts=3).likelihood for c in "pqxyz") == 3


def test_a_run_has_the_script_of_most_letters(spark):
    for word, want in {"api接口返回数据": "han", "latinа": "latin", "äu": "latin", "webで検索するには東京": "kana",
                       "abcde漢字東かなか": "han", "слово": "cyrillic"}.items():
        assert langid.script(word) == want, word
    draw = random.Random(5)
    run = lambda n: "".join(draw.choices("接口返回的数据格式说明文中国人大学生", k=n))
    rows = [(sentence("aa", 60, i), "aa") for i in range(20)] + [(f"{run(20)} {run(30)}", "zh") for _ in range(20)]
    both = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    df = spark.createDataFrame([(1, f"API{run(25)}"), (2, f"Kato {run(9)}")], "doc_id bigint, text string")
    assert [r.lang_pred for r in langid.identify(df, both).orderBy("doc_id").collect()] == ["zh", "zh"]


def test_viterbi_equals_trying_everything(model):
    import itertools

    labeller = langid.Labeller(model, 3.0)
    text = "kato verung losque mi los 7 keit"
    rows = labeller.number(text)
    (labels,) = labeller.label([rows])

    def total(path):
        score = sum(labeller.scores[w][p] for w, p in zip(rows, path))
        return score - 3.0 * sum(a != b for a, b in zip(path, path[1:]))

    best = max(total(p) for p in itertools.product(range(len(model.languages)), repeat=len(rows)))
    assert total(labels) == pytest.approx(best, abs=1e-4)


def test_language_query_on_the_test_tables(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.queries()["op2_language_id"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert held and sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)


# ---- HTML extraction -----------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site, please accept them all.</p></div>
<article class="post"><h1>A  title &amp;
 more</h1><p><b>First paragraph of the story<br>goes on here, with some words.<p>Second&nbsp;one &lt;here&gt; is also a paragraph of it.
<div class="ad">Buy now, this is an advert with a long sentence in it.</div>
<ul><li>One point of the list.<li>Another point of the list.</ul>
<p>Third paragraph, <a href="#">linked</a> and ended &#233;.</p></article>
<div class="comments"><h3>Comments</h3><div class="comment"><p>I think this is a very nice story, thanks.</p></div></div>
<aside><p>Related stories that you may like to read next time.</p></aside>
<form><p>Sign up for our letter right here.</p><button>Go</button></form>
<footer>&copy; The site, all rights reserved.</footer><script>if (a < b) { x("</p>"); }</script></body></html>"""


@pytest.fixture(scope="module")
def field():
    return extraction.train([extraction.laid_out(i) for i in range(250)])


def test_leaf_blocks_of_a_page():
    texts = [b.text for b in html_blocks.leaf_blocks(PAGE)]
    assert texts[:2] == ["Home", "News"]
    assert "A title & more" in texts
    assert "First paragraph of the story goes on here, with some words." in texts
    assert "Second one <here> is also a paragraph of it." in texts
    assert not any("x(" in t or "p{}" in t for t in texts)


@pytest.mark.parametrize("html", [None, "", "   ", "<p>", "<", "<!-- x", "<script>var a", "a < b", "<a href='x>y", "<p/>" * 500,
                                  "<div>" * 3000 + "deep", "&#0; &#xD800; &nosuch; &amp", "<b" + " a" * 2000, "</p></div>text"])
def test_broken_html_is_read(html, field):
    blocks = html_blocks.leaf_blocks(html)
    assert all(b.text == " ".join(b.text.split()) and b.text for b in blocks)
    assert len(field.decode(blocks)) == len(blocks)


def test_article_text_only(spark, field):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "y"), (3, "v", "", "z"), (1, "u", PAGE, "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(extraction.main_text(df, field).collect(), key=lambda r: r.page_id)
    want = "\n".join([
        "A title & more", "First paragraph of the story goes on here, with some words.",
        "Second one <here> is also a paragraph of it.", "One point of the list.", "Another point of the list.",
        "Third paragraph, linked and ended é."])
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [
        (1, "u", want, len(want)), (1, "u", want, len(want)), (2, None, "", 0), (3, "v", "", 0)]
    assert extraction.main_text(df.limit(0), field).collect() == []


def test_new_layouts_are_decoded(field):
    right = total = 0
    for seed in range(5000, 5150):
        blocks, labels = extraction.laid_out(seed)
        right += sum(a == b for a, b in zip(field.decode(blocks), labels))
        total += len(labels)
    assert right >= 0.98 * total


def test_a_late_copyright_phrase_counts():
    (block,) = html_blocks.leaf_blocks(f"<div>{'Example Press, Main Street 1, Town. ' * 9}All rights reserved.</div>")
    assert "copyright" in extraction.text_features(block)


def test_training_climbs_the_likelihood():
    """The gradient of the field is that of its likelihood, by finite differences."""
    import numpy as np

    draw = np.random.default_rng(0)
    scores, follows = draw.normal(size=5), draw.normal(size=(2, 2))

    def log_total(s, f):
        import itertools

        sums = []
        for path in itertools.product((0, 1), repeat=5):
            sums.append(sum(s[i] * y for i, y in enumerate(path)) + sum(f[a, b] for a, b in zip(path, path[1:])))
        return np.log(np.sum(np.exp(sums)))

    alone, pairs = extraction._marginals(scores, follows)
    for i in range(5):
        step = np.zeros(5)
        step[i] = 1e-6
        assert alone[i] == pytest.approx((log_total(scores + step, follows) - log_total(scores - step, follows)) / 2e-6, abs=1e-5)
    for a in (0, 1):
        for b in (0, 1):
            step = np.zeros((2, 2))
            step[a, b] = 1e-6
            change = (log_total(scores, follows + step) - log_total(scores, follows - step)) / 2e-6
            assert pairs[a, b] == pytest.approx(change, abs=1e-5)


def test_decoding_finds_the_best_labelling(field):
    import itertools

    for seed in (1, 2, 3):
        blocks = extraction.laid_out(seed)[0][:9]
        scores, follows = field.scores(blocks), field.follows

        def total(path):
            return sum(s * y for s, y in zip(scores, path)) + sum(follows[a][b] for a, b in zip(path, path[1:]))

        best = max(map(total, itertools.product((0, 1), repeat=len(blocks))))
        assert total(field.decode(blocks)) == pytest.approx(best)


def test_pages_of_the_test_tables(spark):
    """Pages that name their article: all of its blocks, nothing else."""
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.queries()["op1_html_extraction"](spark, sf).collect():
        blocks, labels = extraction.labelled_by_markup(pages[r.page_id])
        assert r.text == "\n".join(b.text for b, y in zip(blocks, labels) if y)


# ---- the pipeline --------------------------------------------------------------------------------


def test_stages_one_by_one(spark, docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) in (4, 5) and len(set(names)) == len(names)
    stages = dict(corpus_pipeline.STAGES)
    verdict = {r.doc_id: r.kept for r in quality.verdicts(docs).collect()}
    good = stages["quality_rules"](spark, docs, "").cache()
    assert good.columns == docs.columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(d for d, k in verdict.items() if k)

    texts = [(r.doc_id, r.text) for r in good.collect()]
    groups = plain_components(texts, 5, 80, 100)
    single = stages["jaccard_join"](spark, good, "").cache()
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, c in groups.items() if d == c)

    clean = stages["secret_scan"](spark, single, "").cache()
    assert clean.columns == docs.columns and clean.count() == single.count()

    mixed = stages["source_mix"](spark, clean, "").cache()
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(d for d, c in copies.items() for _ in range(c))

    packed = stages["packing"](spark, mixed, "")
    ids = sum(r.doc_tokens for r in packed.where("starts_document").collect())
    assert ids == sum(r.length for r in packed.collect())


def test_secrets_leave_the_texts(spark):
    rows = [(1, 'a token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" b', "en", "s", 58), (2, "plain", "en", "s", 5), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["secret_scan"](spark, df, "").collect()}
    assert not plain_secrets(got[1].text) and got[1].n_chars == len(got[1].text) and got[1].text.startswith("a ")
    assert got[2].text == "plain" and got[3].text is None


def test_run_equals_its_stages(spark, tmp_path):
    df = spark.createDataFrame(documents(24, seed=9), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    want = packing.pack(docs, queries.tokenizer_file("word_bpe_49k.json")).collect()

    def by_doc(rows):
        return sorted((r.doc_id, r.doc_tokens) for r in rows if r.starts_document)

    assert by_doc(got) == by_doc(want)


def test_pipeline_of_an_empty_table(spark, no_docs, tmp_path):
    no_docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
