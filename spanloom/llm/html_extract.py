"""Main text of web pages by the maximum-scoring run of tokens.

A page is a sequence of words and tags. A word scores by a linear model of where it stands: the elements around it, their class, id and
role words, whether it is linked, and the shape of its block. Tags score negative. One linear scan finds the contiguous run of the
greatest sum, which is the content region.

All weights come from labelled pages. The word model is a logistic regression, so ordinary words of content score positive and
words of menus, adverts or legal lines negative. An element whose own features alone make words negative is a boilerplate
container: the scan passes it as a single tag, at one price within the content (in an article, or after prose of the element it
stands in) and at another elsewhere, and what it holds is left out of the text. So boilerplate in mid-article does not part the
region, whatever its length. The prices of tags are negative by construction, -exp(t), and t is fitted by a structured
perceptron until the best run of the labelled pages is their region.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.labelled_pages import labelled_pages

RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "button", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "select", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CONTENT = {"article", "main"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
PARTS = {"ul", "ol", "li", "dl", "dd", "dt", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "blockquote", "section", "figure", "details"}  # of an element that holds prose
CLOSE_P = PROSE | {"address", "article", "aside", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "search", "section", "summary", "table", "ul", "li", "dd", "dt"}
ROWS, CELLS = {"tbody", "thead", "tfoot"}, {"td", "th"}
#: What an opening tag closes without an end tag, and the elements beyond which it doesn't look.
CLOSES = (
    {t: ({"p"}, {"table", "caption", "button", "object", "html"} | CELLS) for t in CLOSE_P}
    | {"option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": (CELLS, {"table"}), "th": (CELLS, {"table"})}
    | {t: (ROWS, {"table"}) for t in ROWS}
)
ITEMS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"})}
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>")
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LEGAL = re.compile(r"©|&copy;|copyright|rights reserved", re.I)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, "") or ("open" / "close", tag name, attributes) of a page; comments, raw elements and declarations are skipped."""
    at, n = 0, len(page)
    while at < n:
        tag = page.find("<", at)
        if tag < 0:
            yield "text", page[at:], ""
            return
        if tag > at:
            yield "text", page[at:tag], ""
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = n if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), tag):
            end = page.find(">", tag)
            at = n if end < 0 else end + 1
        elif (m := TAG.match(page, tag)) or (m := LOOSE.match(page, tag)):
            name = m[2].lower()
            at = m.end()
            if m[1]:
                yield "close", name, ""
            elif name in RAW and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = n if end is None else end.end()
            else:
                yield "open", name, m[3]
        else:
            yield "text", "<", ""
            at = tag + 1


@lru_cache(maxsize=8192)
def element_features(name: str, attributes: str, inside: bool) -> tuple[str, ...]:
    """What an element tells of the words in it: its tag (told apart within articles for headers), and the words of its class, id and role."""
    if name in ("html", "body"):
        return ()
    found = [] if name in INLINE and name not in ("button", "label", "select") else [f"t:{name}@in" if inside and name in ("header", "footer") else f"t:{name}"]
    for m in NAMED.finditer(attributes) if attributes else ():
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            found.append(f"r:{value.lower()}")
        else:
            found += [f"n:{part.lower()}" for part in NAME_PART.findall(value)]
    return tuple(dict.fromkeys(found))


class Part:
    """A run of words, or a tag: ``text``; ``breaks`` is the tag if it ends a block; ``tag`` names its price; ``active`` are the features around it."""

    __slots__ = ("active", "breaks", "hidden", "linked", "tag", "text")

    def __init__(self, text: str, breaks: str, tag: str, active: frozenset, linked: bool, hidden: bool) -> None:
        self.text, self.breaks, self.tag, self.active, self.linked, self.hidden = text, breaks, tag, active, linked, hidden


Model = tuple[dict[str, float], dict[str, float]]  # weights of word features, prices of tags


def page_parts(page: str, words: dict[str, float] | None = None) -> list[Part]:
    """The runs of words and the tags of a page, in order. With the word model, what boilerplate containers hold is hidden."""
    parts: list[Part] = []
    stack: list[list] = []  # name, whether it is a boilerplate container, whether prose has stood directly in it, features it adds
    root = ["", False, False, ()]
    away = content = links = 0
    names: Counter = Counter()
    counts: Counter = Counter()
    active: frozenset = frozenset()

    def pop(depth: int) -> None:
        nonlocal away, content, links, active
        closed = stack[depth:]
        for name, was, _, features in closed:
            away, content, links = away - was, content - (name in CONTENT), links - (name == "a")
            names[name] -= 1
            counts.subtract(features)
        del stack[depth:]
        if any(features for *_, features in closed):
            active = frozenset(f for f, n in counts.items() if n > 0)

    def close_open(which: set[str], barrier: set[str]) -> None:
        if not any(names[name] for name in which):
            return
        found = None
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in which:
                found = depth
            elif stack[depth][0] in barrier:
                break
        if found is not None:
            pop(found)

    for kind, value, attributes in tokens(page):
        if kind == "text":
            parts.append(Part(value, "", "", active, links > 0, away > 0))
            continue
        breaks = "" if value in INLINE - {"br"} else value
        if kind == "open":
            for rules in (ITEMS, CLOSES):
                if value in rules:
                    close_open(*rules[value])
            if value in CONTENT:
                close_open({"nav", "menu"}, {"aside", "footer"})  # these hold no articles, so one left open ends here
            parent = next((e for e in reversed(stack) if e[0] not in INLINE), root)
            features = element_features(value, attributes, content > 0)
            gone = words is not None and bool(features) and value not in CONTENT and words["bias"] + sum(words.get(f, 0.0) for f in features) < 0
            tag = ("" if away else "away@in" if content or parent[2] else "away") if away or gone else value
            parts.append(Part("", breaks, tag, active, False, away > 0 or gone))
            if not away:
                parent[2] |= value in PROSE and not gone
            if value not in VOID and not attributes.endswith("/"):
                stack.append([value, gone, parent[2] and value in PARTS, features])
                away, content, links = away + gone, content + (value in CONTENT), links + (value == "a")
                names[value] += 1
                if features:
                    counts.update(features)
                    active = active.union(features)
        else:
            hidden = away > 0
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == value:
                    pop(depth)
                    break
            parts.append(Part("", "" if value in INLINE else value, "" if hidden else f"/{value}", active, False, hidden))
    return parts


def _shapes(parts: list[Part]) -> Iterator[tuple[Part, tuple[str, ...]]]:
    """Each run of words with the shape of its block: number of words, whether it ends like a sentence, is linked throughout, or legal."""
    block: list[Part] = []

    def out() -> Iterator[tuple[Part, tuple[str, ...]]]:
        text = " ".join(p.text for p in block)
        n, linked = len(text.split()), sum(len(p.text.split()) for p in block if p.linked)
        shape = [f"s:{1 if n < 2 else 4 if n < 5 else 12 if n < 13 else 13}"]
        legal = "s:legal@in" if block[0].active & {"t:article", "t:main"} else "s:legal"  # what an article says of rights is its own
        shape += [f for f, holds in (("s:end", text.rstrip()[-1:] in tuple(".!?:;…\"'»”")), ("s:links", 2 * linked > n), (legal, n < 40 and LEGAL.search(text) is not None)) if holds]
        for p in block:
            yield p, (*shape, "s:linked") if p.linked else tuple(shape)
        block.clear()

    for p in parts:
        if p.text:
            if not p.hidden and not p.text.isspace():
                block.append(p)
        elif p.breaks and block:
            yield from out()
    if block:
        yield from out()


def scores(parts: list[Part], model: Model) -> list[float]:
    words, prices = model
    shaped = {id(p): shape for p, shape in _shapes(parts)}
    around: dict[frozenset, float] = {}
    out = []
    for p in parts:
        if p.text:
            shape = shaped.get(id(p))
            if shape is None:
                out.append(0.0)
                continue
            base = around.get(p.active)
            if base is None:
                base = around[p.active] = words["bias"] + sum(words.get(f, 0.0) for f in p.active)
            out.append(len(p.text.split()) * (base + sum(words.get(f, 0.0) for f in shape)))
        else:
            out.append(-prices.get(p.tag, prices["other"]) if p.tag else 0.0)
    return out


def best_run(values: list[float]) -> tuple[int, int]:
    """The contiguous run [i, j) of the greatest sum; the first and longest such. (0, 0) if none is positive."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for k, value in enumerate(values):
        if total < 0:
            total, start = 0.0, k
        total += value
        if total > 0 and total >= best:
            best, at = total, (start, k + 1)
    return at


def _marked(page: str) -> tuple[str, list[bool], list[bool]]:
    """A labelled page without its marks, and for each of its characters whether it is in the region, and whether it is content."""
    plain, region, content = [], [], []
    inside, out = False, 0
    k = 0
    while k < len(page):
        mark = page[k : k + 2]
        if mark in ("[[", "]]", "{{", "}}"):
            inside, out = (mark == "[[", out) if mark in ("[[", "]]") else (inside, out + (1 if mark == "{{" else -1))
            k += 2
            continue
        plain.append(page[k])
        region.append(inside)
        content.append(inside and not out)
        k += 1
    return "".join(plain), region, content


def _places(page: str) -> list[int]:
    """Where each part of a page begins."""
    places, at = [], 0
    for kind, value, attributes in tokens(page):
        at = page.index(value, at) if kind == "text" else at
        if kind == "text":
            places.append(at)
            at += len(value)
        else:
            at = page.index("<", at)
            places.append(at)
            at = page.index(">", at + len(value) + len(attributes)) + 1
    return places


def fit_words(pages: list[tuple[str, list[bool], list[bool]]], prior: float = 2.0, shrink: float = 0.03, shape_shrink: float = 1.0, rounds: int = 25) -> dict[str, float]:
    """Logistic regression, by Newton's method, of whether words are content on the features around them; a run of words counts by its root.

    Words of no features are content with log odds ``prior``, so what is learned is what speaks against that. Shapes of blocks are shrunk
    more than elements and names, which tell more where both would do.
    """
    rows, labels, weight = [], [], []
    for page, _, content in pages:
        parts = page_parts(page)
        at = {id(p): place for p, place in zip(parts, _places(page), strict=True)}
        for p, shape in _shapes(parts):
            first = at[id(p)] + len(p.text) - len(p.text.lstrip())
            rows.append([*p.active, *shape])
            labels.append(content[first])
            weight.append(math.sqrt(len(p.text.split())))
    names = sorted({f for row in rows for f in row})
    number = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for k, row in enumerate(rows):
        x[k, [number[f] for f in row]] = 1
    y, w, theta = np.array(labels, float), np.array(weight), np.zeros(len(names))
    held = np.array([shape_shrink if f.startswith("s:") else shrink for f in names])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(prior + x @ theta, -30, 30)))
        slope = x.T @ (w * (y - p)) - held * theta
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(held)
        theta += np.linalg.solve(curve, slope)
    return {"bias": prior} | {f: float(theta[i]) for f, i in number.items()}


def fit_prices(pages: list[tuple[str, list[bool], list[bool]]], words: dict[str, float], start: float = 0.2, rate: float = 0.05, rounds: int = 40) -> dict[str, float]:
    """Prices of tags, all ``start`` at first, then corrected wherever the best run is not the region: up for tags it took wrongly, down for tags it missed."""
    known = []
    t: dict[str, float] = {"other": math.log(start)}
    for page, region, content in pages:
        parts = page_parts(page, words)
        places = _places(page)
        shown = [bool(p.text) and not p.hidden and not p.text.isspace() for p in parts]
        want = {k for k, p in enumerate(parts) if shown[k] and content[places[k] + len(p.text) - len(p.text.lstrip())]}
        fixed = scores(parts, (words, {"other": 0.0}))
        known.append((fixed, [p.tag for p in parts], shown, want, [region[place] for place in places]))
        t |= {p.tag: math.log(start) for p in parts if p.tag}
    for _ in range(rounds):
        wrong = False
        price = {tag: math.exp(v) for tag, v in t.items()}
        for fixed, tags, shown, want, region in known:
            i, j = best_run([v - price[tag] if tag else v for v, tag in zip(fixed, tags, strict=True)])
            if {k for k in range(i, j) if shown[k]} == want:
                continue
            wrong = True
            for k, tag in enumerate(tags):
                if tag and (i <= k < j) != region[k]:
                    t[tag] += rate if i <= k < j else -rate
                    price[tag] = math.exp(t[tag])
        if not wrong:
            break
    return {tag: math.exp(v) for tag, v in t.items()}


@lru_cache(maxsize=1)
def learned_model() -> Model:
    pages = [_marked(p) for p in labelled_pages()]
    words = fit_words(pages)
    return words, fit_prices(pages, words)


def main_text(page: str | None, model: Model, whole: bool = False) -> str:
    """Blocks of the content region, each with white space made one space, joined by newlines; ``whole`` takes the page for its region."""
    parts = page_parts(page or "", model[0])
    i, j = (0, len(parts)) if whole else best_run(scores(parts, model))
    blocks: list[str] = []
    current: list[str] = []
    for p in parts[i:j]:
        if p.text:
            if not p.hidden:
                current.append(p.text)
        elif p.breaks == "br":
            current.append(" ")
        elif p.breaks:
            blocks.append("".join(current))
            current = []
    blocks.append("".join(current))
    return "\n".join(b for b in (" ".join(entities.unescape(x).split()) for x in blocks) if b)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``; text is empty where nothing scores.

    A null or empty page has an empty text. Pages are read whole; unclosed tags, quotes and elements end with the page.
    Only the named columns are read.
    """
    model = learned_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, model) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col), F.col(url_col).cast("string"), F.col(html_col).alias("__html")).mapInArrow(run, f"{id_col} {kind}, {url_col} string, text string, n_chars long")
