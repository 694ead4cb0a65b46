"""Labelled pages for the HTML extractor: made from layouts, container names and a few sentences, by a seeded rule.

In a page ``[[`` and ``]]`` stand around the content region and ``{{`` and ``}}`` around boilerplate within it. Names, layouts and texts are
drawn apart from each other, boilerplate and content from the same sentences, so that a name is told by nothing but what it holds.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

PAGES = 297
AWAY_NAMES = (
    "ad ads advert advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar side-bar footer header masthead comment comments disqus reply replies "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login related recommended share sharing social widget pagination pager skip toolbar topbar copyright"
).split()
AWAY_TAGS = "nav nav header footer footer aside aside form menu dialog select button fieldset label".split()
AWAY_ROLES = "navigation banner contentinfo complementary search dialog alert menu menubar".split()
CONTENT_NAMES = "content post entry story body text main article page-content post-body entry-content article-text share-price header-image story-header related-work comment-policy main-text section column row wrapper container page".split()
LAYOUT_WORDS = "box site block wide inner outer left".split()

SHORT = ("No.", "It ends in May.", "Bread", "So he said it.", "Then it rained", "The river", "Most of all", "One more time.", "Read on", "Home again, in the end.")
LONG = (
    "We went to the sea and it was a fine day for all of us.", "Work starts soon on the long road by the river, the council said.", "Mix the flour and the water, then wait until the dough has risen to twice its size.",
    "First note of many that follow here in this text, all of them on birds.", "She asked why the bridge was closed; nobody in the office could tell her.", "Prices rose by four per cent in the spring and fell again in the summer.",
    "Buy two of these now and get one more for free.", "I made this twice and my whole family liked it a lot!", "It took the two of them, with help from friends and a good deal of luck, until the end of the week to find out what had happened to the boat.",
)
LEGAL = ("&copy; 2020 the site, all rights reserved", "Copyright 2020 all rights reserved", "Copyright the authors. All rights reserved.", "&copy; 2019 &middot; Rivers and lakes")


def _text(draw: random.Random) -> str:
    return draw.choice(SHORT) if draw.random() < 0.4 else " ".join(draw.choice(LONG) for _ in range(draw.choice((1, 1, 2, 3))))


def _prose(draw: random.Random) -> str:
    """A block of content."""
    kind = draw.randrange(9)
    one, two = _text(draw), _text(draw)
    if kind == 0:
        return f"<ul><li>{one}</li><li>{two}</li></ul>"
    if kind == 1:
        return f"<blockquote>{one}</blockquote>"
    if kind == 2:
        return f'<p>{one} <a href="/x">{draw.choice(SHORT)}</a> {two}</p>'
    return (f"<h2>{draw.choice(SHORT)}</h2>", f"<p>{one}<br>{two}</p>", f"<p><b>{draw.choice(SHORT)}</b> {one}</p>", f"<p>{one}</p>", f"<p>{one}</p>", f"<p>{two}</p>")[kind - 3]


def _noise(draw: random.Random) -> str:
    """What a boilerplate container holds: links, prose, a heading with prose, or a bare text."""
    kind = draw.randrange(5)
    if kind < 2:
        links = [f'<a href="/{i}">{draw.choice(SHORT)}</a>' for i in range(draw.randrange(1, 6))]
        return " ".join(links) if kind else "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>"
    if kind == 2:
        return _prose(draw)
    return f"<h3>{draw.choice(SHORT)}</h3><p>{_text(draw)}</p>" if kind == 3 else _text(draw)


def _shown(draw: random.Random, name: str) -> str:
    """A name as it is, or with a word of layout."""
    word = draw.choice(LAYOUT_WORDS)
    return draw.choice((name, name, f"{name}-{word}", f"{word}-{name}", f"{name}{word.title()}", f"{name} {word}"))


def _away(draw: random.Random, within: bool = False) -> str:
    """A boilerplate container by tag, role, class or id; a header within an article would be the article's own."""
    noise, kind = _noise(draw), draw.random()
    if kind < 0.25:
        tag = draw.choice([t for t in AWAY_TAGS if not (within and t == "header")])
        return f"<{tag}>{noise}</{tag}>"
    if kind < 0.32:
        return f'<div role="{draw.choice(AWAY_ROLES)}">{noise}</div>'
    tag = draw.choice(("div", "div", "section", "ul", "p", "span")) if not noise.startswith("<") else draw.choice(("div", "section"))
    return f'<{tag} {draw.choice(("id", "class", "class"))}="{_shown(draw, draw.choice(AWAY_NAMES))}">{noise}</{tag}>'


def labelled_pages(n: int = PAGES, seed: int = 11) -> Iterator[str]:
    for k in range(n):
        draw = random.Random(seed * 100_003 + k)
        blocks = [f"<h1>{draw.choice(SHORT)}</h1>" if draw.random() < 0.7 else _prose(draw), *(_prose(draw) for _ in range(draw.randrange(1, 7)))]
        before, after, aside = ("".join(_away(draw) for _ in range(draw.choice((0, 1, 1, 2)))) for _ in range(3))
        at = draw.randrange(1, len(blocks) + 1)
        inner = "".join(blocks[:at]) + "".join(f"{{{{{_away(draw, True)}}}}}" for _ in range(draw.choice((0, 1, 1)))) + "".join(blocks[at:])
        if at == len(blocks):
            inner = "".join(blocks)
        name, plain = _shown(draw, draw.choice(CONTENT_NAMES)), draw.choice(LAYOUT_WORDS)
        legal = draw.choice(LEGAL)
        layout = k % 9
        if layout == 0:
            own = f"<p>{legal}</p>" if draw.random() < 0.3 else ""
            yield f"<html><head><title>T</title></head><body>{before}[[<article>{inner}{own}</article>]]{after}<footer>{legal}</footer></body></html>"
        elif layout == 1:
            yield f'<body>{before}<div class="{plain}">[[<div class="{name}">{inner}</div>]]{after}</div>{aside}</body>'
        elif layout == 2:
            yield f"<body><header><h1>{_text(draw)}</h1></header>{before}[[<main><article><header>{blocks[0]}<p>{_text(draw)}</p></header>{inner}</article></main>]]{after}</body>"
        elif layout == 3:
            yield f"{before}<table><tr><td>[[{inner}]]</td><td>{aside}</td></tr></table>{after}"
        elif layout == 4:  # no names and no semantic elements
            links = " ".join(f'<a href="/{i}">{draw.choice(SHORT)}</a>' for i in range(draw.randrange(2, 7)))
            yield f"<body><div>{links}</div><div>[[{''.join(blocks)}]]</div><div>{legal}</div></body>"
        elif layout == 5:
            links = "".join(f'<div><a href="/{i}">{draw.choice(SHORT)}</a></div>' for i in range(draw.randrange(2, 7)))
            yield f"<body><div>{links}</div><div><div>{before}</div>[[{inner}]]</div><div><div>{legal}</div><div>{links}</div></div></body>"
        elif layout == 6:
            yield f'<body>{before}[[<div id="{name}"><div class="{plain}">{inner}</div></div>]]<p>{legal}</p>{after}</body>'
        elif layout == 7:
            yield f'<body>{before}[[<main><div class="{name}">{inner}</div></main>]]<div>{legal}</div></body>'
        else:
            yield f'<body>{before}<section class="{plain}">[[{blocks[0]}<div class="{name}">{inner}</div>]]</section>{after}</body>'
