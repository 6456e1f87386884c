"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read once into leaf blocks: the text between two block-level tags, with the open elements
above it. Scripts, styles, titles and other contents that are never shown are no blocks. The field
labels the sequence of blocks as article or not: a block's features are the tags, roles and words of
classes and ids of its ancestors, and shape, length and share of links of its text; pairs of
neighbours have weights of their own where they share their container. It is trained by exact
likelihood on labelled pages and decoded by Viterbi. Labelled pages are drawn by ``labelled_pages``:
layouts with semantic tags, with classes and with neither, and adverts, notices, forms and reader
comments beside and inside the article.

The text is all of every article block: character references decoded, white space turned into one
space, blocks joined by one space in page order.

Defined results: null or empty html, and pages without an article, give an empty text; rows are
extracted one by one, so repeated rows and null ids or urls come back as they are; unclosed and stray
tags are read as browsers do for blocks (a paragraph ends where the next block starts, an end tag
closes what is open inside, a head ends at the first tag or text that it can't hold). Only id, url and html are read.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import arrow_map, strings

# Element names of HTML by their role in layout.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
UNSEEN = frozenset("head svg math canvas object audio video select option datalist button".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul caption".split())
TELLING = frozenset(
    "article main nav header footer aside form fieldset menu address blockquote pre h1 h2 h3 h4 h5 h6 p li ul ol dl dt dd "
    "table td th figure figcaption dialog details search label section".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
LIST_SCOPE = frozenset("ul ol dl table menu dir".split())
IN_HEAD = frozenset("base link meta noframes noscript script style template title".split())

# Names and values together, as browsers read them; a name may stand without a value. A quote opens a
# value only after an equals sign, and only if the page closes it; any other is a character like others.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))"""
_ATTR = re.compile(rf"([^\s/>][^\s/>=]*)(?:{_VALUE})?")
_MARK = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)"
    rf"((?>[\s/]+|[^\s/>][^\s/>=]*(?:{_VALUE.replace('([', '(?:[')})?)*)>")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    tag: str
    features: tuple[str, ...]     # of this element alone
    all: frozenset                # with those of its ancestors
    seen: bool
    number: int


@dataclass
class Block:
    text: str
    linked: int                   # characters inside links
    features: frozenset
    container: int


def _element(tag: str, attributes: str, above: Element | None, number: int) -> Element:
    own = [tag] if tag in TELLING else []
    seen = tag not in UNSEEN
    if attributes and tag not in ("html", "body"):
        for name, a, b, c in _ATTR.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id", "role", "aria-label"):
                words = dict.fromkeys(w.lower() for w in _PARTS.findall(value))
                own += [f"{'role' if name == 'role' else 'is'}:{w}" for w in words]
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                seen = False
            elif name == "aria-hidden" and value == "true":
                own.append("hidden")
            elif name == "hidden":
                seen = False
    up = above.all if above else frozenset()
    if tag in ("header", "footer", "ul", "h1", "h2") and up & {"article", "main"}:
        own.append(f"{tag} in article")
    return Element(tag, tuple(own), up.union(own) if own else up, seen and (above is None or above.seen), number)


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page, in page order, without empty ones."""
    out: list[Block] = []
    stack: list[Element] = []
    text: list[str] = []
    linked = links = number = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                around = [e.number for e in stack if e.tag in BLOCK]
                # Paragraphs, headings and items are neighbours in what holds them.
                out.append(Block(whole, linked, stack[-1].all if stack else frozenset(), around[-2] if len(around) > 1 else 0))
            text.clear()
        linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if stack and stack[-1].tag == "head" and piece.strip():
            close(len(stack) - 1)
        if piece and (not stack or stack[-1].seen):
            piece = html_lib.unescape(piece)
            text.append(piece)
            if links:
                linked += len(piece)

    def close(down_to: int) -> None:
        nonlocal links
        if any(e.tag in BLOCK for e in stack[down_to:]):
            flush()
        links -= sum(e.tag == "a" for e in stack[down_to:])
        del stack[down_to:]

    at = 0
    while (m := _MARK.search(html, at)) is not None:
        say(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            found = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), None)
            # An inline end tag doesn't close blocks around it.
            if found is not None and (tag in BLOCK or tag in UNSEEN or not any(e.tag in BLOCK for e in stack[found + 1 :])):
                close(found)
            elif tag == "p":
                flush()
            continue
        if stack and stack[-1].tag == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag in _RAW_END:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag == "br":
            say(" ")
        if tag in BLOCK:
            flush()
            paragraph = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == "p"), None)
            if paragraph is not None and not any(e.tag in BLOCK for e in stack[paragraph + 1 :]):
                close(paragraph)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in CLOSES.get(tag, ()):
                    close(k)
                    break
                if stack[k].tag in LIST_SCOPE:
                    break
        if tag not in VOID and not m[3].endswith("/"):
            number += 1
            stack.append(_element(tag, m[3], stack[-1] if stack else None, number))
            links += tag == "a"
    say(html[at:])
    flush()
    return out


def text_features(b: Block) -> list[str]:
    n = len(b.text)
    share = b.linked / n
    last = b.text[-1]
    return [
        f"length {min(n.bit_length(), 10)}", "links all" if share > 0.9 else "links many" if share > 0.4 else "links few" if share else "links none",
        "ends a sentence" if last in ".!?…:;\"”»" else "ends bare", *(["copyright"] if "©" in b.text else []),
        *(["words many"] if b.text.count(" ") > 15 else [])]


@dataclass(frozen=True)
class Field:
    """Weights towards article: per feature, and of neighbours' labels (in one container or not)."""

    weights: dict[str, float]
    bias: float
    pairs: np.ndarray             # [same container][label before][label]

    def labels(self, found: list[Block], memo: dict[frozenset, float]) -> list[int]:
        """Viterbi: the most likely labels of a page's blocks."""
        if not found:
            return []
        w, pairs = self.weights, self.pairs.tolist()
        no = yes = 0.0
        back = []
        last = None
        for b in found:
            path = memo.get(b.features)
            if path is None:
                if len(memo) > 100_000:
                    memo.clear()
                path = memo[b.features] = sum(w.get(f, 0.0) for f in b.features)
            score = self.bias + path + sum(w.get(f, 0.0) for f in text_features(b))
            if last is None:
                no, yes = 0.0, score
            else:
                p = pairs[b.container == last]
                a, c = no + p[0][0], yes + p[1][0]
                d, e = no + p[0][1], yes + p[1][1]
                back.append((c > a, e > d))
                no, yes = max(a, c), max(d, e) + score
            last = b.container
        label = int(yes > no)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


@dataclass(frozen=True)
class FieldParams:
    pages: int = 1500       # labelled pages
    steps: int = 150
    rate: float = 0.15
    decay: float = 5e-5
    seed: int = 17


def train(pages: list[tuple[list[Block], list[int]]], p: FieldParams = FieldParams()) -> Field:
    """Maximum likelihood of the labels given the blocks, by forward-backward and Adam."""
    names: dict[str, int] = {}
    longest = max(len(b) for b, _ in pages)
    shape = (len(pages), longest)
    valid, label, same = np.zeros(shape, bool), np.zeros(shape, int), np.zeros(shape, int)
    entries = []
    for i, (found, y) in enumerate(pages):
        for t, b in enumerate(found):
            valid[i, t], label[i, t] = True, y[t]
            same[i, t] = t > 0 and found[t - 1].container == b.container
            entries += [(i, t, names.setdefault(f, len(names))) for f in (*b.features, *text_features(b))]
    rows, cols, feats = np.array(entries).T
    cells = rows * longest + cols
    pair, before = valid[:, 1:], label[:, :-1]
    theta = np.zeros(len(names) + 1 + 8)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, p.steps + 1):
        node = np.zeros((*shape, 2))
        node[..., 1] = np.bincount(cells, theta[feats], minlength=valid.size).reshape(shape) + theta[len(names)]
        moves = theta[-8:].reshape(2, 2, 2)
        # Forward and backward sums in logarithms; padding passes them on.
        ahead, behind = np.zeros((*shape, 2)), np.zeros((*shape, 2))
        ahead[:, 0] = node[:, 0]
        for t in range(1, longest):
            s = ahead[:, t - 1, :, None] + moves[same[:, t]]
            ahead[:, t] = np.where(valid[:, t, None], np.logaddexp(s[:, 0], s[:, 1]) + node[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            s = moves[same[:, t + 1]] + (node[:, t + 1] + behind[:, t + 1])[:, None, :]
            behind[:, t] = np.where(valid[:, t + 1, None], np.logaddexp(s[..., 0], s[..., 1]), 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        belief = np.exp(ahead + behind - total[:, None, None])[..., 1]
        wrong = np.where(valid, belief - label, 0)
        grad = np.zeros_like(theta)
        grad[: len(names)] = np.bincount(feats, wrong.ravel()[cells], minlength=len(names))
        grad[len(names)] = wrong.sum()
        joint = np.exp(ahead[:, :-1, :, None] + moves[same[:, 1:]] + (node[:, 1:] + behind[:, 1:])[:, :, None, :]
                       - total[:, None, None, None])
        for k in range(2):
            use = pair & (same[:, 1:] == k)
            for a in range(2):
                for b in range(2):
                    real = (before == a) & (label[:, 1:] == b)
                    grad[len(names) + 1 + 4 * k + 2 * a + b] = (joint[..., a, b][use]).sum() - real[use].sum()
        grad = grad / len(pages) + p.decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - p.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field({f: float(theta[k]) for f, k in names.items()}, float(theta[len(names)]), theta[-8:].reshape(2, 2, 2))


# Words that classes and ids of page parts commonly hold.
PART_WORDS = {
    "article": "article content post entry story main body text page single blog news prose markdown document".split(),
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topbar tabs toc pagination pager sitemap links".split(),
    "header": "header masthead banner branding logo site top hero tagline".split(),
    "footer": "footer copyright legal bottom colophon credits imprint".split(),
    "sidebar": "sidebar aside widget related recommended trending popular rail recent archive tags categories teaser more".split(),
    "notice": "cookie consent notice gdpr alert popup modal overlay paywall warning message privacy toast disclaimer".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner adsense commercial dfp outbrain".split(),
    "form": "form newsletter subscribe signup search login contact feedback subscription register".split(),
    "comment": "comment comments reply replies discussion disqus respond commentlist responses thread reader".split(),
    "share": "share social sharing buttons toolbar follow like print".split(),
}
ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "sidebar": "complementary", "form": "search"}
TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comment": "section",
        "notice": "div", "advert": "div", "share": "div"}


def labelled_pages(count: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    """Pages of many layouts with the label of each leaf block: 1 for the article."""
    rng = random.Random(seed)
    return [_labelled(_drawn(rng)) for _ in range(count)]


_YES = "\ue000"  # private mark in front of each labelled article text


def _labelled(page: str) -> tuple[list[Block], list[int]]:
    found, labels = [], []
    for b in blocks(page):
        label = int(_YES in b.text)
        text = b.text.replace(_YES, "").strip()
        if text:
            found.append(Block(text, b.linked, b.features, b.container))
            labels.append(label)
    return found, labels


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join("".join(rng.choice("aeiounrstldmhéü") for _ in range(rng.randrange(1, 10))) for _ in range(rng.randrange(low, high)))


def _prose(rng: random.Random) -> str:
    """Text as articles hold it: sentences, single words, shouting, tables in one line, signs."""
    kind = rng.random()
    if kind < 0.15:
        return _words(rng, 1, 4) + rng.choice([".", "", "!"])
    if kind < 0.25:
        return _words(rng, 4, 40).upper() + rng.choice(["!!", "."])
    if kind < 0.3:
        return " | ".join(_words(rng, 1, 2) for _ in range(rng.randrange(3, 20)))
    if kind < 0.35:
        return " ".join(w + rng.choice(["###", "&&&", "$$$", "***"]) for w in _words(rng, 5, 40).split())
    return ". ".join(_words(rng, 3, 25).capitalize() for _ in range(rng.randrange(1, 6))) + "."


def _attrs(rng: random.Random, part: str, sure: bool) -> str:
    if not sure and rng.random() < 0.4:
        return ""
    words = rng.sample(PART_WORDS[part], min(len(PART_WORDS[part]), rng.choice([1, 1, 1, 2])))
    extra = rng.choice(["", "", "-box", "_block", " wide", "-wrapper", " col-md-8"])
    out = f' {rng.choice(["class", "class", "id"])}="{rng.choice(["", "", "site-", "page-"])}{"-".join(words)}{extra}"'
    if part in ROLES and rng.random() < 0.1:
        out += f' role="{ROLES[part]}"'
    return out


def _other(rng: random.Random, part: str) -> str:
    """A part of a page that is no article."""
    tag = TAGS[part] if part in ("menu", "header", "footer", "sidebar", "form") and rng.random() < 0.4 else rng.choice(["div", "div", "section"])
    attrs = _attrs(rng, part, tag in ("div", "section"))
    items = [f'<a href="/x">{_words(rng, 1, 4)}</a>' for _ in range(rng.randrange(2, 9))]
    inner = {
        "menu": lambda: f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>" if rng.random() < 0.8 else " ".join(items),
        "header": lambda: f"<h1>{_words(rng, 1, 4)}</h1>" + (f"<p>{_words(rng, 2, 8)}</p>" if rng.random() < 0.5 else ""),
        "footer": lambda: rng.choice(["&copy; ", "", "Copyright "]) + _words(rng, 1, 5) + rng.choice([" &middot; ", ". "]) + _prose(rng),
        "sidebar": lambda: f"<h3>{_words(rng, 1, 4)}</h3>" + rng.choice([f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>", f"<p>{_prose(rng)}</p>"]),
        "notice": lambda: f"<p>{_prose(rng)}</p>" + rng.choice(["", f"<a href='#'>{_words(rng, 1, 3)}</a>"]),
        "advert": lambda: rng.choice([_prose(rng), f"<p>{_prose(rng)}</p>", f"<a href='/y'>{_words(rng, 2, 12)}</a>"]),
        "form": lambda: f"<label>{_words(rng, 1, 4)}</label><input name=q><p>{_prose(rng)}</p>",
        "comment": lambda: "".join(f"<div><b>{_words(rng, 1, 3)}</b><p>{_prose(rng)}</p></div>" for _ in range(rng.randrange(1, 5))),
        "share": lambda: " ".join(items),
    }[part]()
    return f"<{tag}{attrs}>{inner}</{tag}>"


def _drawn(rng: random.Random) -> str:
    """A page with the mark in front of each text of its article."""
    say = lambda: _YES + " " + _prose(rng)
    body = [f"<h1>{_YES} {_words(rng, 2, 12)}</h1>"] if rng.random() < 0.8 else []
    if body and rng.random() < 0.15:
        body = [f"<header>{body[0]}<p>{say()}</p></header>"]
    for _ in range(rng.randrange(1, 14)):
        kind = rng.random()
        if kind < 0.62:
            body.append(f"<p>{say()}</p>" if rng.random() < 0.85 else f"<p><b>{say()}<br>")
        elif kind < 0.68:
            body.append(f"<h{rng.choice('234')}>{_YES} {_words(rng, 1, 8)}</h{rng.choice('234')}>")
        elif kind < 0.74:
            body.append("<ul>" + "".join(f"<li>{say()}</li>" for _ in range(rng.randrange(1, 5))) + "</ul>")
        elif kind < 0.78:
            body.append(rng.choice([f"<blockquote><p>{say()}</p></blockquote>", f"<pre>{say()}</pre>", f"<figure><figcaption>{say()}</figcaption></figure>"]))
        elif kind < 0.81:
            body.append("<table>" + "".join(f"<tr><td>{say()}</td><td>{say()}</td></tr>" for _ in range(rng.randrange(1, 4))) + "</table>")
        elif kind < 0.85:
            body.append(f'<p><a href="/z">{_YES} {_words(rng, 1, 6)}</a> {_prose(rng)}</p>')
        elif kind < 0.94:
            body.append(f"<div>{say()}</div>")
        else:
            body.append(_other(rng, rng.choice(["advert", "share", "sidebar", "form", "notice", "comment"])))
    tag = rng.choice(["article", "article", "main", "div", "section", "none"])
    inside = "".join(body)
    if tag != "none":
        inside = f"<{tag}{_attrs(rng, 'article', tag in ('div', 'section'))}>{inside}</{tag}>"
    if rng.random() < 0.2:
        inside = f"<main>{inside}</main>"
    ahead = [_other(rng, k) for k in ("header", "menu", "notice", "advert", "sidebar", "form") if rng.random() < 0.5]
    after = [_other(rng, k) for k in ("share", "comment", "sidebar", "advert", "form", "notice", "menu", "footer") if rng.random() < 0.5]
    rng.shuffle(ahead)
    return f"<!DOCTYPE html><html><head><title>{_words(rng, 1, 9)}</title></head><body>{''.join(ahead)}{inside}{''.join(after)}</body></html>"


@lru_cache(maxsize=2)
def trained(p: FieldParams = FieldParams()) -> Field:
    return train(labelled_pages(p.pages, p.seed), p)


def page_text(html: str | None, field: Field, memo: dict[frozenset, float]) -> str:
    found = blocks(html) if html else []
    return " ".join(b.text for b, y in zip(found, field.labels(found, memo)) if y)


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(field or trained())
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    id_type = slim.schema["id"].dataType.simpleString()

    def extracted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[frozenset, float] = {}
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                texts = [page_text(h, shared.value, memo) for h in strings(some.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, type=pa.string()),
                     pa.array([len(t) for t in texts], type=pa.int64())], names=["id", "url", "text", "n_chars"])

    return slim.transform(arrow_map, extracted, f"id {id_type}, url string, text string, n_chars long").toDF(id_col, url_col, "text", "n_chars")
