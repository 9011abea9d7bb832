"""Labelled pages for the block model: page layouts as found on the web, filled with invented words.

Texts that belong to the article start with ``KEEP``. The texts say nothing about their
label, so that the model has to go by where a block stands, its links and its neighbours.
"""

from __future__ import annotations

import random

KEEP = "\ue000"
SYLLABLES = "an be co da el fi go hu in jo ka le mi no or pa qui ra se ti un ver wo za ção é ü ñ ый".split()

# Names that pages give to parts that are not the article, by kind of part.
NAMES = {
    "nav": ["nav", "navbar", "navigation", "menu", "main-menu", "topnav", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc"],
    "header": ["header", "site-header", "masthead", "topbar", "branding", "banner", "page-header"],
    "footer": ["footer", "site-footer", "copyright", "legal", "colophon", "foot", "page-footer"],
    "aside": ["sidebar", "side", "aside", "widget", "related", "recommended", "popular", "trending", "rail", "more-stories"],
    "notice": ["notice", "cookie", "cookie-banner", "consent", "alert", "gdpr", "notification", "message", "disclaimer", "popup", "modal", "paywall"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "promotion", "ad-slot", "banner-ad", "sponsor", "adsbox"],
    "form": ["form", "newsletter", "subscribe", "signup", "login", "search", "search-form", "contact-form"],
    "comments": ["comments", "comment", "comment-list", "discussion", "responses", "replies", "reader-comments", "disqus"],
    "share": ["share", "social", "sharing", "tools", "actions", "tags", "meta", "byline", "author-box"],
    "main": ["content", "post", "entry", "entry-content", "article", "article-body", "main", "story", "text", "post-body", "page-content"],
}


def words(rng: random.Random, low: int, high: int) -> str:
    made = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    style = rng.random()
    if style < 0.08:
        made = [w + rng.choice(["###", "%%%", "!!", " |"]) for w in made]
    elif style < 0.12:
        made = [w.upper() for w in made]
    text = " ".join(made)
    return text.capitalize() + rng.choice([".", ".", ".", "", "!", "?"]) if style >= 0.12 else text


def _links(rng: random.Random, mark: str = "") -> str:
    rows = [f'<li><a href="/{rng.randint(1, 99)}">{mark}{words(rng, 1, 4)}</a></li>' for _ in range(rng.randint(2, 8))]
    return "<ul>" + "".join(rows) + "</ul>"


def _tagged(rng: random.Random, kind: str, tags: list[str], inner: str) -> str:
    tag = rng.choice(tags)
    named = rng.random() < 0.75 or tag in ("div", "section", "p", "ul")
    name = f' {rng.choice(["class", "class", "id"])}="{rng.choice(NAMES[kind])}"' if named else ""
    return f"<{tag}{name}>{inner}</{tag}>"


def _paragraph(rng: random.Random, mark: str = "") -> str:
    text = mark + words(rng, *rng.choice([(1, 3), (5, 12), (12, 40), (40, 120)]))
    if rng.random() < 0.25:
        cut = text.split(" ")
        at = rng.randrange(len(cut))
        cut[at] = f'<a href="/x">{cut[at]}</a>' if rng.random() < 0.5 else f"<b>{cut[at]}</b>"
        text = " ".join(cut) if not cut[at].startswith("<a") or at else text
    shape = rng.random()
    return f"<p>{text}</p>" if shape < 0.8 else f"<p>{text}" if shape < 0.9 else f"<p><b>{text}<br>"


def _article(rng: random.Random) -> str:
    out = [f"<h1>{KEEP}{words(rng, 2, 9)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 9)):
        part = rng.random()
        if part < 0.72:
            out.append(_paragraph(rng, KEEP))
        elif part < 0.78:
            out.append(f"<h2>{KEEP}{words(rng, 1, 6)}</h2>")
        elif part < 0.83:
            out.append("<ul>" + "".join(f"<li>{KEEP}{words(rng, 2, 15)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif part < 0.87:
            tag = rng.choice(["blockquote", "pre", "div"])
            out.append(f"<{tag}>{KEEP}{words(rng, 5, 40)}</{tag}>")
        elif part < 0.89:
            cells = "".join(f"<td>{KEEP}{words(rng, 1, 3)}</td>" for _ in range(3))
            out.append(f"<table><tr>{cells}</tr></table>")
        else:
            out.append(_boilerplate(rng, rng.choice(["ad", "notice", "share", "aside", "form"])))
    return "".join(out)


def _boilerplate(rng: random.Random, kind: str) -> str:
    if kind == "nav":
        return _tagged(rng, "nav", ["nav", "nav", "div", "ul"], _links(rng))
    if kind == "header":
        return _tagged(rng, "header", ["header", "header", "div"], rng.choice([f"<h1>{words(rng, 1, 4)}</h1>", words(rng, 1, 5), f"<p>{words(rng, 2, 8)}</p>"]))
    if kind == "footer":
        start = rng.choice(["&copy; ", "Copyright 2024 ", ""])
        return _tagged(rng, "footer", ["footer", "footer", "div"], rng.choice([start + words(rng, 2, 12), f"<p>{start}{words(rng, 2, 12)}</p>", _links(rng)]))
    if kind == "aside":
        return _tagged(rng, "aside", ["aside", "aside", "div", "section"], rng.choice([_links(rng), f"<h3>{words(rng, 1, 3)}</h3>" + _paragraph(rng), _paragraph(rng), words(rng, 3, 25)]))
    if kind == "form":
        inner = f"<label>{words(rng, 1, 3)}</label><input type=text><button>{words(rng, 1, 2)}</button>"
        return rng.choice([f"<form>{inner}</form>", f"<form><p>{words(rng, 3, 12)}</p>{inner}</form>", _tagged(rng, "form", ["div", "section"], f"<p>{words(rng, 3, 15)}</p>" + inner)])
    if kind == "comments":
        each = [f'<{t} class="comment">{_paragraph(rng)}</{t}>' for t in rng.choices(["div", "li", "article"], k=rng.randint(1, 4))]
        return _tagged(rng, "comments", ["section", "div", "ol"], (f"<h3>{words(rng, 1, 3)}</h3>" if rng.random() < 0.5 else "") + "".join(each))
    role = rng.choice(['role="alert"', 'role="complementary"', 'role="dialog"']) if kind == "notice" and rng.random() < 0.3 else ""
    if role:
        return f"<div {role}>{_paragraph(rng)}</div>"
    return _tagged(rng, kind, ["div", "div", "section", "p"], rng.choice([words(rng, 2, 25), words(rng, 2, 25), f"<span>{words(rng, 2, 9)}</span>"]))


def page(rng: random.Random) -> str:
    before = [k for k in ("header", "nav", "notice", "ad", "form") if rng.random() < 0.55]
    after = [k for k in ("share", "comments", "aside", "ad", "form", "notice", "footer") if rng.random() < 0.5]
    rng.shuffle(before)
    body = _article(rng)
    shape = rng.random()
    if shape < 0.5:
        main = f"<article>{body}</article>"
    elif shape < 0.65:
        main = f"<main>{body}</main>"
    elif shape < 0.9:
        main = f'<div {rng.choice(["class", "id"])}="{rng.choice(NAMES["main"])}">{body}</div>'
    else:
        main = body
    if rng.random() < 0.25:
        side = _boilerplate(rng, "aside")
        main = f"<div>{side}{main}</div>" if rng.random() < 0.5 else f"<div>{main}{side}</div>"
    head = f"<html><head><title>{words(rng, 1, 5)}</title></head><body>"
    end = "</body></html>" if rng.random() < 0.9 else ""
    return head + "".join(_boilerplate(rng, k) for k in before) + main + "".join(_boilerplate(rng, k) for k in after) + end


def pages(n: int, seed: int = 2) -> list[str]:
    rng = random.Random(seed)
    return [page(rng) for _ in range(n)]
