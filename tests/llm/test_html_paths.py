"""Main text by tag-path ratios: pages of many makes, a plain twin, and hostile pages."""

from __future__ import annotations

import math
import random
import re
import time
from xml.etree import ElementTree

import pytest

from wordloom.llm import html_paths as H
from wordloom.llm.html_paths import extract_text

PARAS = [f"This is paragraph {i}, with some real prose in it, and it goes on. It has sentences." for i in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in PARAS)
TEXT = "\n\n".join(PARAS)


@pytest.mark.parametrize(
    "page,want",
    [
        ('<div class="site has-sidebar"><article>{}</article></div>', TEXT),
        ('<div class="article ad-free">{}</div>', TEXT),
        ('<div id="page" class="no-comments"><main>{}</main></div>', TEXT),
        ('<form id="aspnetForm"><div>{}</div></form>', TEXT),
        ('<form id="f"><nav><a href=x>Home</a></nav><div class="widget"><h1>Head</h1>{}</div><footer>The end, really. Yes.</footer></form>', "Head\n\n" + TEXT),
        ('<article><div class="post-header"><h1>Title</h1></div>{}</article>', "Title\n\n" + TEXT),
        ('<div class="post"><div class="post-header"><h1>Title</h1><div>By A</div></div>{}</div>', "Title\n\nBy A\n\n" + TEXT),
        ('<body><div><a href=x>Home</a> <a href=y>About</a></div><div class="content"><h2>Sub</h2>{}<ul><li>one<li>two</ul></div><div>Imprint</div>', f"Sub\n\n{TEXT}\n\none\n\ntwo"),
        ('<body><div class="intro"><p>An opening of some length, which says much. Really, it does.</p></div><div class="body">{}</div>', f"An opening of some length, which says much. Really, it does.\n\n{TEXT}"),
        ('<body><div class="content">{}</div><div class="site-footer"><p>We, the makers, are great. Yes, we are.</p></div><div id="comments"><p>I agree, wholly. I do, I do.</p></div>', TEXT),
        ('<body><div class="teaser"><p>Some other text, of a teaser. It is long, and has commas.</p></div><article>{}<ul><li><a href=a>Share it</a><li><a href=b>Print it</a></ul></article>', TEXT),
        ("<article>{}<p><a href=x>All of this paragraph, every word, is a link. Yes.</a></p><table><tr><td>12<td>13</table></article>", f"{TEXT}\n\nAll of this paragraph, every word, is a link. Yes.\n\n12\n\n13"),
        ("<article></article><div class=ad>Buy this, buy that. Buy it now, and here. Do!</div><footer>x</footer>", ""),
        ("<article><p>a b.</p></article><div class=ad>Buy this, buy that. Buy it now, and here. Do!</div>", "a b."),
        ("<p>1 < 2 & 3 &lt; 4 &#99999999999; &#0000000065;</p>", "1 < 2 & 3 < 4 � A"),
        ("<p>cut <b", "cut"),
    ],
)
def test_pages_of_many_makes(page, want):
    assert extract_text(page.replace("{}", BODY)) == want


def test_the_scores_decide(monkeypatch):
    page = f'<body><div class="links"><div>Short one</div><div>Short two</div></div><div class="content">{BODY}</div><div class="x">Made by us</div>'
    assert extract_text(page) == TEXT
    monkeypatch.setattr(H, "path_scores", lambda elements, blocks: {e.path: 1.0 for e in elements})
    assert extract_text(page) == f"Short one\n\nShort two\n\n{TEXT}\n\nMade by us"


def test_names_count_as_a_whole():
    furniture = "site-footer main-nav cookie-notice ad-slot comment-list comments-area sidebar-left left-sidebar nav-menu widget-area social-links"
    assert all(H._named(x, False) for x in furniture.split())
    others = "has-sidebar no-comments ad-free post-header article-header navy adverse article content story download header-image-caption"
    assert not any(H._named(x, False) for x in others.split())


# --- a plain twin: paths as strings, ancestors by climbing, every rule by its sentence


def twin(page: str) -> str:
    root = ElementTree.fromstring(f"<root>{page}</root>")
    up, blocks, order = {root: None}, [], []

    def walk(e, link):
        order.append(e)
        held, linked = [e.text or ""], len("".join((e.text or "").split())) if link else 0

        def flush():
            nonlocal held, linked
            text = " ".join("".join(held).split())
            if text:
                blocks.append((e, text, linked))
            held, linked = [], 0

        for child in e:
            if child.tag == "a":
                held.append(child.text or "")
                linked += len("".join((child.text or "").split()))
            else:
                flush()
                up[child] = e
                walk(child, link)
            held.append(child.tail or "")
        flush()

    walk(root, False)

    def above(e):
        while e is not None:
            yield e
            e = up[e]

    names = {e: "/".join(f"{x.tag}.{re.sub('[0-9]+', '0', x.get('class', ''))}" for x in above(e)) for e in order}
    furniture = {"nav", "footer"}
    out = {e: any(x.tag in furniture or (x.tag not in ("main", "body") and x.get("class") in ("ad", "comments")) for x in above(e)) for e in order}
    ratio = {}
    for path in {names[e] for e, _, _ in blocks}:
        mine = [(t, n) for e, t, n in blocks if names[e] == path]
        ratio[path] = math.log1p(sum(max(0, len(t) - n) for t, n in mine) / len(mine)) * math.log1p(1 + sum(len(re.findall("[.,;:!?]", t)) for t, _ in mine) / len(mine))
    rows = [ratio[names[e]] for e, _, _ in blocks]
    padded = rows[:1] + rows + rows[-1:]
    smooth = [(padded[i] + 4 * padded[i + 1] + padded[i + 2]) / 6 for i in range(len(rows))]
    score = {p: [x for (e, _, _), x in zip(blocks, smooth) if names[e] == p] for p in ratio}
    score = {p: sum(x) / len(x) for p, x in score.items()}
    free = [(e, t, n) for e, t, n in blocks if not out[e]]
    size = sum(max(0, len(t) - n) for _, t, n in free)
    if not size:
        return ""
    least = sum(score[names[e]] * max(0, len(t) - n) for e, t, n in free) / size / 2
    passed = {p for p in score if score[p] >= least}
    seed = lambda e, t, n: names[e] in passed and len(t) > n and not out[e]
    total, inside = sum(len(t) - n for e, t, n in free if seed(e, t, n)), None
    for tag in ("article", "main"):
        held = sum(len(t) - n for e, t, n in free if seed(e, t, n) and any(x.tag == tag for x in above(e)))
        if inside is None and held and 2 * held >= total:
            inside = tag
    here = [not out[e] and (inside is None or any(x.tag == inside for x in above(e))) for e, _, _ in blocks]
    seeds = [i for i, b in enumerate(blocks) if here[i] and seed(*b)]
    path_size = lambda p: sum(len("".join(t.split())) for e, t, _ in blocks if names[e] == p)
    menu = {p for p in score if sum(n for e, _, n in blocks if names[e] == p) > path_size(p) / 2}
    holds = {x for i in seeds for x in above(blocks[i][0])}
    parents = {x for i in seeds for x in (blocks[i][0], up[blocks[i][0]])}
    kept = []
    for i, (e, _, _) in enumerate(blocks):
        x = i in seeds
        if here[i] and not x and seeds and names[e] not in menu:
            near = next((a for a in above(e) if a in holds), root)
            x = inside is not None or (near in parents and (near.tag not in ("root", "body") or seeds[0] < i < seeds[-1]))
        kept.append(x)
    for i in reversed(range(len(blocks))):
        kept[i] = kept[i] or (here[i] and blocks[i][0].tag in ("h1", "h2") and any(kept[i + 1 : i + 4]))
    return "\n\n".join(t for (_, t, _), x in zip(blocks, kept) if x)


def made_page(rng: random.Random) -> str:
    def words(n):
        return " ".join(rng.choice(["so", "it", "goes,", "on.", "then", "more"]) for _ in range(n))

    def node(depth):
        tag = rng.choice(["div", "div", "p", "section", "ul", "h2", "article", "main", "nav", "footer", "blockquote"])
        cls = rng.choice(["", "", "", ' class="x1"', ' class="x2"', ' class="lead"', ' class="ad"', ' class="comments"'])
        if tag in ("p", "h2") or depth == 0:
            tag = tag if tag in ("p", "h2") else "p"
            link = f'<a href="x">{words(rng.randint(1, 6))}</a>' if rng.random() < 0.4 else ""
            return f"<{tag}{cls}>{words(rng.choice([0, 1, 2, 8, 40]))} {link}</{tag}>"
        return f"<{tag}{cls}>{words(3) if rng.random() < 0.1 else ''}{''.join(node(depth - 1) for _ in range(rng.randint(1, 4)))}</{tag}>"

    return "<body>" + "".join(node(rng.randint(0, 4)) for _ in range(rng.randint(1, 6))) + "</body>"


def test_extraction_equals_a_plain_twin():
    rng, told = random.Random(11), 0
    for _ in range(1500):
        page = made_page(rng)
        got = extract_text(page)
        assert got == twin(page), page
        told += bool(got)
    assert told > 1000


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000, "<div>" * 100_000 + "</section>" * 50_000, '<a ">" ' * 140_000, "<ul>" + "<div>" * 70_000 + "<li></li>" * 70_000, "<p>" * 300_000,
        "<!" * 500_000, "<div>x" * 150_000, "<form>x. y" * 100_000, "&#" + "9" * 1_000_000, "<p " + "class " * 160_000 + ">x", "<p class" + " " * 1_000_000 + ">x",
        "<table><td>" * 90_000, "<" * 1_000_000, "<p>" + "word, more. " * 80_000,
    ],
)
def test_pages_of_a_megabyte_take_linear_time(page):
    began = time.perf_counter()
    extract_text(page)
    assert time.perf_counter() - began < 5
