"""Pages made around a known article: its text has to come back exactly, whatever stands beside it."""

from __future__ import annotations

import random

import pytest

from newslens.llm.html_text import main_text

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


def _text(rng, n):
    out = ""
    while len(out) < n:
        out += " ".join(rng.choice(WORDS) for _ in range(rng.randrange(4, 12))).capitalize() + ". "
    return out[: max(n, 1)].strip() or "x"


def _article(rng, size):
    """Blocks of text and their HTML: a heading, paragraphs, now and then a subheading, a list, a quotation or a list of sources."""
    blocks, html, left = ["Of " + _text(rng, 12)], [], size
    html.append(f"<h1>{blocks[0]}</h1>")
    while left > 0:
        text = _text(rng, min(left, rng.randrange(60, 500)))
        left -= len(text) + 1
        kind = rng.random()
        if kind < 0.7 or len(blocks) == 1:
            cut = rng.randrange(len(text) + 1)
            html.append(f"<p>{text[:cut]}<span hidden>not <b>this</b></span>{text[cut:]}</p>" if rng.random() < 0.2 else f"<p>{text}</p>")
            blocks.append(text)
        elif kind < 0.8:
            html.append(f"<h2>Part</h2><blockquote>{text}</blockquote>")
            blocks += ["Part", text]
        else:
            items = [_text(rng, 30) for _ in range(3)]
            html.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            blocks += items
    if size > 200 and rng.random() < 0.4:
        links = [_text(rng, 20) for _ in range(rng.randrange(2, 5))]
        html.append("<h2>Sources</h2><ol>" + "".join(f"<li><a href='{k}'>{x}</a></li>" for k, x in enumerate(links)) + "</ol>")
        blocks += ["Sources", *links]
    return "\n\n".join(" ".join(x.split()) for x in blocks), "".join(html)


def _spoken(rng, size):
    out, total = [], 0
    while total < size:
        text = _text(rng, rng.randrange(20, 400))
        total += len(text)
        out.append(text)
    return out


SPEECH = (
    lambda parts: "<section class='comments'>" + "".join(f"<p>{x}</p>" for x in parts) + "</section>",
    lambda parts: "<div id='comments'><h1>Comments</h1>" + "".join(f"<div class='comment'><p>{x}</p></div>" for x in parts) + "</div>",
    lambda parts: "<section class='comments'>" + "".join(f"<article class='comment-body'><p>{x}</p></article>" for x in parts) + "</section>",
    lambda parts: "<ol class='comment-list'>" + "".join(f"<li>{x}</li>" for x in parts) + "</ol>",
    lambda parts: "<div class='discussion'>" + "".join(f"<div class='entry'><p>{x}</p></div>" for x in [*parts, "Yes."]) + "</div>",
    lambda parts: "<div class='sidebar'>" + "".join(f"<p>{x}</p>" for x in parts) + "</div>",
    lambda parts: "<div class='footer'>" + "".join(f"<p>{x}</p>" for x in parts) + "</div>",
    lambda parts: "<form><input name='q'>" + "".join(f"<p>{x}</p>" for x in parts) + "</form>",
)
BESIDE = (
    "<div class='cc-window'>This website uses cookies. <a class='cc-btn'>Got it</a></div>",
    "<div role='alert'>Your session has expired, please log in again.</div>",
    "<div class='zz'><p>We and our partners use cookies to show you adverts.</p><button>Accept</button></div>",
    "<nav><a href='/'>Home</a> <a href='/x'>World</a></nav>",
    "<div style='visibility: hidden'><p>Not shown at all, although there is some text in here.</p></div>",
)


@pytest.mark.parametrize("times", [0.1, 1, 5, 50])
@pytest.mark.parametrize("size", [20, 100, 240, 1500, 8000])
def test_the_article_comes_back_exactly(size, times):
    rng = random.Random(f"{size} {times}")
    for k in range(24):
        want, html = _article(rng, size)
        wrapped = rng.choice([f"<article>{html}</article>", f"<main><article>{html}</article></main>", f"<main>{html}</main>"])
        beside = rng.sample(BESIDE, 2)
        page = f"<html><body>{beside[0]}{wrapped}{beside[1]}{SPEECH[k % len(SPEECH)](_spoken(rng, size * times))}<footer>Copyright</footer></body></html>"
        assert main_text(page) == want, page


def test_parts_of_the_article_that_only_look_like_others():
    rng = random.Random(1)
    a, b = _text(rng, 500), _text(rng, 700)
    assert main_text(f"<article><h1>H</h1><p>{a}</p><section id='discussion'><h2>Discussion</h2><p>{b}</p><p>{a}</p></section></article>") == f"H\n\n{a}\n\nDiscussion\n\n{b}\n\n{a}"
    assert main_text(f"<form id='all'><input type='hidden'><div><h1>H</h1><p>{a}</p><p>{b}</p></div></form>") == f"H\n\n{a}\n\n{b}"
    assert main_text(f"<article><h1>H</h1><p>{a}</p><p>A button on cookies.</p><button>x</button><p>{b}</p></article>") == f"H\n\n{a}\n\nA button on cookies.\n\n{b}"
    related = "<h3>Related articles</h3><ul><li><a href='1'>One</a></li><li><a href='2'>Two</a></li></ul>"
    assert "One" not in main_text(f"<article><h1>H</h1><p>{a}</p><p>{b}</p>{related}</article>")
    assert main_text(f"<div class='comments'><p>{a}</p><p>{b}</p></div>") == f"{a}\n\n{b}"
