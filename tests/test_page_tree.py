"""What the tree decides, against definitions that compare every pair of elements."""

from __future__ import annotations

import random
import time

from presswork.functions.dom import Tree
from presswork.operators import extraction as E
from presswork.functions.selectors import Selectors

TAGS = ["div", "p", "a", "article", "figure", "figcaption", "li", "h2", "blockquote", "nav", "aside", "span", "body", "section"]
CLASSES = ["", "", "x", "caption", "photo-box", "banner", "ads", "detail-content", "expEdit", "link-inline-content", "seo-suggest-link", "Caption-y"]
OWN = {
    "content": [("section", "", [], "", None), ("", "", ["x"], "", None), ("div", "", [], "data-k", "1")],
    "exclude": [("", "cut", [], "", None)], "unwrap": [("span", "", ["x"], "", None)],
}


def random_page(rnd):
    out, depth = [], []
    for _ in range(rnd.randrange(5, 60)):
        roll = rnd.random()
        if roll < 0.5:
            tag = rnd.choice(TAGS)
            name = rnd.choice(CLASSES)
            extra = rnd.choice(["", "", " id=cut", " id=mainContent", " data-k=1"])
            out.append(f'<{tag} class="{name} z"{extra}>')
            depth.append(tag)
        elif roll < 0.65:
            out.append(rnd.choice(['<img src="a.jpg" alt="b">', '<img data-src=c srcset="d 1x">', "<video></video>", "<br>"]))
        elif roll < 0.8 and depth:
            out.append(f"</{depth.pop()}>")
        elif roll < 0.85:
            out.append(f"</{rnd.choice(TAGS)}>")
        else:
            out.append(f"text {rnd.randrange(1000)} ")
    return "".join(out).encode()


def settings(own):
    names = ("tag", "id", "cls", "attr", "value")
    return {k: [dict(zip(names, s)) for s in rows] for k, rows in own.items()}


def matches(tree, n, s):
    tag, ident, classes, attr, value = s
    return (
        tag in ("", tree.tags[n]) and ident in ("", tree.ids[n]) and all(c in tree.classes[n] for c in classes)
        and (not attr or attr in tree.attrs[n] and value in (None, tree.attrs[n][attr]))
    )


def parts(selector):
    tag, _, rest = selector.partition(".")
    tag, _, ident = tag.partition("#")
    return (tag, ident, [rest] if rest else [], "", None)


def plain(payload, own):
    tree = Tree(payload)
    every = range(len(tree.tags))
    inside = lambda a, b: b < a <= tree.ends[b]
    hit = lambda n, rows: next((i for i, s in enumerate(rows, 1) if matches(tree, n, s)), None)
    fixed = lambda names: [parts(s) for s in names]
    media = [n for n in every if tree.tags[n] in E.MEDIA_TAGS]
    gone = {n for n in every if hit(n, fixed(E.UNWRAP_SELECTORS) + own["unwrap"]) and not any(inside(m, n) for m in media)}
    left = [n for n in every if n not in gone]
    unwanted = [n for n in left if hit(n, fixed(E.EXCLUDE_SELECTORS) + own["exclude"])]
    cuts = [n for n in unwanted if not any(inside(n, o) for o in unwanted)]
    alive = [n for n in left if not any(n == c or inside(n, c) for c in cuts)]
    cut_text = {t for c in cuts for t in range(tree.t0[c], tree.t1[c])}
    text = lambda n: " ".join(tree.texts[t] for t in range(tree.t0[n], tree.t1[n]) if t not in cut_text and tree.texts[t])
    place = {n: p for n in alive if (p := hit(n, own["content"] or fixed(E.CONTENT_SELECTORS)))}
    homes = sorted((p, n) for n, p in place.items() if not any(inside(n, o) and q <= p for o, q in place.items()))
    if not place:
        homes = [(0, n) for n in alive if tree.tags[n] == "body"][:1]
    marks = [n for n in left if "caption" in " ".join(tree.classes[n]).lower()]
    blocks = []
    for _, home in homes:
        mine = [n for n in alive if tree.tags[n] in E.BLOCK_TAGS and inside(n, home)]
        for n in mine:
            if not any(inside(n, o) for o in mine):
                kind = E.BLOCK_KINDS.get(tree.tags[n])
                caption = tree.tags[n] == "figcaption" or any(m == n or inside(n, m) for m in marks)
                blocks.append((kind or ("caption" if caption else "paragraph"), text(n)))
    contexts = [
        n for n in left
        if tree.tags[n] == "figure" or any(m in " ".join(tree.classes[n]).lower() for m in E.CONTEXT_MARKERS)
    ]
    images = []
    for _, home in homes:
        for n in alive:
            if tree.tags[n] == "img" and inside(n, home):
                tries = []
                for c in [c for c in contexts if inside(n, c)][::-1][: E.MAX_CONTEXTS]:
                    for s in E.CAPTION_SELECTORS:
                        tries += [text(p) for p in alive if inside(p, c) and matches(tree, p, parts(s))][:1]
                    tries.append(text(c))
                images.append(([tree.attrs[n].get(a, "") for a in E.IMAGE_SOURCES], tree.attrs[n].get("alt"), tries))
    remaining = " ".join(t for i, t in enumerate(tree.texts) if i not in cut_text and t)
    return homes, [(tree.tags[n], text(n)) for _, n in homes], blocks, images, (len(cuts), remaining)


def test_pages_match_pairwise_rules():
    rnd = random.Random(7)
    for i in range(400):
        payload, own = random_page(rnd), OWN if i % 2 else {k: [] for k in OWN}
        rules = E._Rules(settings(own))
        homes, home_texts, blocks, images, shown = plain(payload, own)
        got = E._content(payload, rules)
        assert [(b["type"], b["text"]) for b in got["blocks"]] == blocks, payload
        assert [
            (x["sources"], x["alt"], [got["captions"][t] for t in x["tries"]]) for x in got["images"]
        ] == images, payload
        found = E._homes(payload, rules)
        assert [(h["place"], h["tag"], h["text"]) for h in found] == [(p, *t) for (p, _), t in zip(homes, home_texts)], payload
        assert tuple(E._shown(payload, rules).values()) == shown, payload


def test_no_rules_and_no_page():
    got = E._content(None, E._Rules(None))
    assert got == {"head": {"title": None, "metas": [], "links": []}, "blocks": [], "images": [], "captions": []}


def test_long_pages_take_linear_time():
    item = "<p class=x>text <b>bold</b></p><figure><img src=a.jpg><figcaption>cap</figcaption></figure>"
    pages = [
        "<article class=photo>" + item * 4000 + "</article>", "<div>" * 20_000 + "<p>x</p>", "<p>" * 20_000, "<a " * 20_000,
        "<div class=photo>" * 10_000 + "<img src=a.jpg>" * 10_000, "<i>" + "</b>" * 20_000, "<div class=banner>" * 20_000,
    ]
    for page in pages:
        start = time.process_time()
        E._content(page.encode(), E._Rules(None))
        assert time.process_time() - start < 5, page[:40]


def test_selector_places():
    some = Selectors.fixed(("article", ".a", "#b", "a.c.d"))
    assert some.first("article", "b", ["a"], {}) == 1
    assert some.first("p", "b", ["a", "z"], {}) == 2
    assert some.first("p", "b", [], {}) == 3
    assert some.first("a", "", ["d", "c"], {}) == 4
    assert some.first("a", "", ["d"], {}) is None


def test_block_texts_leave_the_walk_normalised():
    """Every kind of white space that norm_text() knows, inside a block and around it."""
    codes = [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    odd = "".join(map(chr, codes))
    page = f"<article><p>{odd}one{odd}two&nbsp;&#x3000;<b>{odd}three</b>\u200bfour</p></article>"
    blocks = E._content(page.encode(), E._Rules(None))["blocks"]
    assert blocks == [{"type": "paragraph", "text": "one two three \u200bfour"}]
