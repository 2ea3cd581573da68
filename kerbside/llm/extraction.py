"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is a sequence of leaf blocks; each is main text or not. The field scores a labelling by features
of the single blocks (their tag, the tags and the class, id and role words of their ancestors, their
length, links, punctuation) and by which label follows which. The weights are learned by maximising the
conditional likelihood of labelled pages, and the best labelling of a page is found by Viterbi.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .html_blocks import Block, leaf_blocks

# Bounds of the labelled pages the field is trained on.
SAMPLED_PAGES = 60
LAID_OUT_PAGES = 400
EPOCHS = 6
CACHED_PATHS = 50_000

STRUCTURE = frozenset(
    "article main section nav header footer aside form figure figcaption table ul ol dl blockquote pre "
    "details dialog button label select fieldset address menu".split()
)
# Words in class, id and role values, by what they usually say about the element. Whole words and
# word beginnings as in `comment-list`, `sidebarLeft`, `adBox`.
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar topbar",
    "head": "header masthead banner branding logo hero sitename",
    "foot": "footer copyright legal colophon bottom contentinfo",
    "side": "sidebar side widget widgets aside rail complementary related recommended trending popular more",
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay message toast dialog",
    "advert": "ad ads advert advertisement advertising adbox sponsor sponsored promo promotion banner teaser",
    "form": "form login signin signup register subscribe subscription newsletter search contact",
    "talk": "comment comments reply replies respond discussion disqus review reviews feedback thread",
    "share": "share sharing social follow tags tag meta byline author date",
    "main": "content article post entry story main body text articlebody maincontent page prose",
}
_WORDS = {w: kind for kind, words in HINTS.items() for w in words.split()}
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def path_features(path: tuple[tuple[str, str], ...]) -> list[str]:
    found = [f"tag:{path[-1][0]}"] if path else ["tag:none"]
    inside = set()
    for depth, (tag, attrs) in enumerate(reversed(path)):
        if tag in STRUCTURE:
            inside.add(f"in:{tag}")
        for pair in attrs.split() if attrs else ():
            for word in _SPLIT.split(pair.partition("=")[2] or pair):
                kind = _WORDS.get(word)
                if kind is None:
                    kind = next((k for w, k in _WORDS.items() if len(w) > 4 and word.startswith(w)), None)
                if kind:
                    inside.add(f"hint:{kind}")
                    if depth < 2:
                        inside.add(f"near:{kind}")
    # The nearest structural ancestor decides more than those further out.
    nearest = next((tag for tag, _ in reversed(path) if tag in STRUCTURE), "none")
    return [*found, *sorted(inside), f"nearest:{nearest}"]


def text_features(block: Block) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    found = ["words:" + ("1" if words == 1 else "2-4" if words < 5 else "5-14" if words < 15 else "15-39"
                         if words < 40 else "40+")]
    share = block.linked / max(1, len(text))
    found.append("links:" + ("0" if share == 0 else "some" if share < 0.5 else "most"))
    if text[-1] in ".!?:;\"')”»。！？…":
        found.append("ends")
    if "©" in text or "all rights" in text.lower():
        found.append("copyright")
    return found


@dataclass
class Field:
    """Weights per feature for main text against the rest, and of label pairs; label 1 is main text."""

    weights: dict[str, float] = field(default_factory=dict)
    follows: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])
    paths: dict = field(default_factory=dict)

    def scores(self, blocks: list[Block]) -> list[float]:
        """How much each block alone speaks for main text."""
        result = []
        for block in blocks:
            base = self.paths.get(block.path)
            if base is None:
                if len(self.paths) > CACHED_PATHS:
                    self.paths.clear()
                base = sum(self.weights.get(f, 0.0) for f in path_features(block.path))
                self.paths[block.path] = base
            result.append(base + sum(self.weights.get(f, 0.0) for f in text_features(block)))
        return result

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best labelling (Viterbi); on a tie a block is not main text."""
        if not blocks:
            return []
        scores = self.scores(blocks)
        (oo, om), (mo, mm) = self.follows
        other, main, came = 0.0, scores[0], []
        for s in scores[1:]:
            from_main = (main + mo > other + oo, main + mm > other + om)
            other, main = max(other + oo, main + mo), max(other + om, main + mm) + s
            came.append(from_main)
        label = int(main > other)
        labels = [label]
        for back in reversed(came):
            label = int(back[label])
            labels.append(label)
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, seed: int = 5) -> Field:
    """Stochastic gradient ascent (AdaGrad) on the conditional log likelihood, with a small L2 pull."""
    model = Field()
    names = [[path_features(b.path) + text_features(b) for b in blocks] for blocks, _ in pages]
    squares: dict = {}
    order = list(range(len(pages)))
    shuffle = random.Random(seed)

    def step(key, gradient: float) -> float:
        squares[key] = squares.get(key, 1e-3) + gradient * gradient
        return 0.3 * gradient / squares[key] ** 0.5

    for _ in range(epochs):
        shuffle.shuffle(order)
        for p in order:
            found, labels = names[p], pages[p][1]
            if not found:
                continue
            scores = np.array([sum(model.weights.get(f, 0.0) for f in fs) for fs in found])
            alone, pairs = _marginals(scores, np.array(model.follows))
            gradient: dict = {}
            for fs, y, m in zip(found, labels, alone):
                for f in fs:
                    gradient[f] = gradient.get(f, 0.0) + y - m
            for f, g in gradient.items():
                w = model.weights.get(f, 0.0)
                model.weights[f] = w + step(f, g - 1e-3 * w)
            seen = np.zeros((2, 2))
            for a, b in zip(labels, labels[1:]):
                seen[a, b] += 1
            for a in (0, 1):
                for b in (0, 1):
                    model.follows[a][b] += step((a, b), seen[a, b] - pairs[a, b] - 1e-3 * model.follows[a][b])
    return model


def _marginals(scores: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(label 1) of each block and expected counts of label pairs (forward and backward sums)."""
    n = len(scores)
    local = np.stack([np.zeros(n), scores], axis=1)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = local[0]
    for t in range(1, n):
        ahead[t] = local[t] + np.logaddexp(ahead[t - 1, 0] + follows[0], ahead[t - 1, 1] + follows[1])
        back[n - 1 - t] = np.logaddexp(
            follows[:, 0] + local[n - t, 0] + back[n - t, 0], follows[:, 1] + local[n - t, 1] + back[n - t, 1]
        )
    total = np.logaddexp(*ahead[-1])
    pairs = np.zeros((2, 2))
    for t in range(1, n):
        pairs += np.exp(ahead[t - 1][:, None] + follows + local[t] + back[t] - total)
    return np.exp(ahead[:, 1] + back[:, 1] - total), pairs


# ---- labelled pages ----------------------------------------------------------------------------


def labelled_by_markup(page: str) -> tuple[list[Block], list[int]] | None:
    """A page that names its main text itself (one article or main element); others give None."""
    if len(re.findall(r"<(?:article|main)[\s>]", page, re.I)) != 1:
        return None
    blocks = leaf_blocks(page)
    labels = []
    for b in blocks:
        tags = [tag for tag, _ in b.path]
        root = next((i for i, t in enumerate(tags) if t in ("article", "main")), None)
        apart = root is None or any(
            t in ("nav", "aside", "footer", "form", "header") or "hint:main" not in kinds and kinds & _AWAY
            for t, kinds in ((t, set(path_features(((t, a),)))) for t, a in b.path[root + 1 :])
        )
        labels.append(int(not apart))
    return blocks, labels


_AWAY = {f"hint:{k}" for k in ("menu", "foot", "side", "notice", "advert", "form", "talk", "share")}


def laid_out(seed: int) -> tuple[list[Block], list[int]]:
    """A page in one of many common layouts, its main text marked with `data-keep`, then labelled by it."""
    draw = random.Random(seed)
    pick = draw.choice

    def words(n: int) -> str:
        return " ".join("".join(draw.choices("aeioulnrst", k=draw.randint(2, 9))) for _ in range(n))

    def sentence() -> str:
        return words(draw.randint(3, 18)).capitalize() + pick("...?!")

    def sentences(n: int) -> str:
        return " ".join(sentence() for _ in range(n))

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(draw.randint(1, 3))}</a></li>' for i in range(n))

    def named(tags: str, names: str) -> tuple[str, str]:
        tag, name = pick(tags.split()), pick(names.split())
        return f'<{tag} {pick(["class", "id", "class"])}="{name}">', f"</{tag}>"

    def around(pair: tuple[str, str], inner: str) -> str:
        return pair[0] + inner + pair[1]

    def menu() -> str:
        return pick([
            lambda: f"<nav><ul>{links(draw.randint(3, 8))}</ul></nav>",
            lambda: around(named("div ul", "menu navbar main-nav breadcrumbs pagination"), links(5)),
        ])()

    def site_head() -> str:
        inner = f"<h1>{words(2)}</h1><p>{sentence()}</p>" if draw.random() < 0.5 else f"<div>{words(3)}</div>"
        return pick([f"<header>{inner}</header>", around(named("div", "header masthead site-header banner"), inner)])

    def advert() -> str:
        inner = pick([sentence(), f"<p>{sentences(2)}</p>"])
        return around(named("div aside section", "ad ads advert sponsored promo ad-box advertisement"), inner)

    def notice() -> str:
        inner = f"<p>{sentences(draw.randint(1, 2))}</p>" + pick(["", f"<button>{words(1)}</button>"])
        return around(named("div section", "notice cookie-notice cookie-consent alert gdpr popup"), inner)

    def side() -> str:
        inner = f"<h3>{words(2)}</h3>" + pick([f"<ul>{links(4)}</ul>", f"<p>{sentences(2)}</p>"])
        return pick([f"<aside>{inner}</aside>", around(named("div", "sidebar widget related side-column"), inner)])

    def form() -> str:
        inner = f"<label>{words(2)}</label><input><button>{words(1)}</button>"
        return pick([f"<form>{pick(['', f'<p>{sentence()}</p>'])}{inner}</form>",
                     around(named("div", "newsletter subscribe login search-form"), f"<p>{sentence()}</p>{inner}")])

    def talk() -> str:
        one = named("div li article", "comment reply comment-body")
        inner = f"<h3>{words(2)}</h3>" + "".join(
            around(one, f"<p>{sentences(draw.randint(1, 4))}</p>") for _ in range(draw.randint(1, 5)))
        return around(named("section div ol", "comments comment-list discussion respond"), inner)

    def foot() -> str:
        inner = pick([f"&copy; {words(2)} &middot; {sentence()}", f"<p>&copy; {words(4)}</p><p>{sentence()}</p>",
                      f"<ul>{links(4)}</ul><p>{sentence()}</p>"])
        return pick([f"<footer>{inner}</footer>", around(named("div", "footer site-footer copyright"), inner)])

    def article() -> str:
        parts = [f"<h1>{pick([words(4), sentence()])}</h1>"] if draw.random() < 0.9 else []
        for _ in range(draw.randint(1, 12)):
            parts.append(pick([
                lambda: f"<p>{sentences(draw.randint(1, 6))}</p>", lambda: f"<p>{sentences(3)}</p>",
                lambda: f"<p>{sentences(2)}</p>", lambda: f"<p>{words(1).capitalize()}.</p>",
                lambda: f"<p>{words(draw.randint(1, 6))}</p>",
                lambda: f'<p><b>{words(3)}<br><p data-keep="yes">{sentences(2)}</p>',
                lambda: f"<p>{sentence()} <a href='#'>{words(3)}</a> {sentence()}</p>",
                lambda: f"<h2>{words(3)}</h2>",
                lambda: "<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(3)) + "</ul>",
                lambda: f"<blockquote>{sentences(2)}</blockquote>", lambda: f"<pre>{words(8)}</pre>",
                lambda: f"<table><tr><td>{words(2)}</td><td>{words(1)}</td></tr></table>",
            ])())
        marked = [f'<div data-keep="yes">{p}</div>' if draw.random() < 0.2 else
                  re.sub(r"^<(\w+)", r'<\1 data-keep="yes"', p) for p in parts]
        # Adverts and the like also stand inside the article, between its paragraphs.
        for maker in draw.sample([advert, side, form, notice, menu, talk], draw.choice([0, 0, 1, 1, 2, 3])):
            marked.insert(draw.randint(0, len(marked)), maker())
        inner = "".join(marked)
        wrap = pick([
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"),
            ('<div class="content">', "</div>"), ('<div class="post-body entry">', "</div>"),
            ('<section id="article">', "</section>"), ('<main><article class="story">', "</article></main>"),
            ("<div>", "</div>"), ('<div id="main-content">', "</div>"),
        ])
        return around(wrap, inner)

    def some(*makers) -> str:
        return "".join(m() for m in draw.sample(makers, draw.randint(0, len(makers))))

    page = (
        "<html><body>" + some(notice, site_head, menu, advert, form) + article()
        + some(talk, side, advert, form, menu, notice) + (foot() if draw.random() < 0.9 else "")
    )
    blocks = leaf_blocks(page)
    labels = [int(any("data-keep=" in attrs for _, attrs in b.path)) for b in blocks]
    bare = [
        Block(tuple((t, re.sub(r" ?data-keep=\S+", "", a)) for t, a in b.path), b.text, b.linked)
        for b in blocks
    ]
    return bare, labels


def trained(pages: DataFrame, html_col: str = "html") -> Field:
    """A field trained on LAID_OUT_PAGES made layouts and at most SAMPLED_PAGES pages of the table.

    The sampled pages are those with the least hash that name their own main text.
    """
    named = pages.select(F.xxhash64(html_col).alias("h"), F.col(html_col).alias("html")).where(
        F.col("html").rlike("(?i)<(article|main)[ >]")
    )
    # The hashes are chosen first, so that no task sends pages that are not among them.
    hashes = [r["h"] for r in named.select("h").orderBy("h").limit(SAMPLED_PAGES).collect()]
    found = named.where(F.col("h").isin(*hashes)).groupBy("h").agg(F.min("html").alias("html"))
    page_of = dict(found.collect()) if hashes else {}
    marked = [labelled_by_markup(page_of[h]) for h in hashes]
    made = [laid_out(seed) for seed in range(LAID_OUT_PAGES)]
    return train([p for p in marked if p] + made)


def main_text(
    pages: DataFrame, model: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_kept.

    `text` joins the blocks labelled main text by a line break, in page order. A null, empty or
    text-free page has an empty text. Pages are read one by one, so repeated rows need no care;
    other columns are ignored; an empty table gives no rows.
    """
    schema = StructType(
        [StructField("page_id", pages.schema[id_col].dataType),
         StructField("url", pages.schema[url_col].dataType), StructField("text", StringType()),
         StructField("n_chars", LongType()), StructField("n_blocks", LongType()),
         StructField("n_kept", LongType())]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200)
                texts, sizes, kept = [], [], []
                for html in piece.column(2).to_pylist():
                    blocks = leaf_blocks(html)
                    chosen = [b.text for b, y in zip(blocks, model.decode(blocks)) if y]
                    texts.append("\n".join(chosen))
                    sizes.append(len(blocks))
                    kept.append(len(chosen))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(kept, pa.int64())],
                    names=schema.names,
                )

    return pages.select(id_col, url_col, html_col).mapInArrow(extract, schema)
