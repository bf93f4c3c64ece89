"""Labelled pages for training: layouts of common sites filled with invented words.

A page is a list of parts, each an HTML fragment whose blocks carry one label. Names of classes
and elements are those that public style guides and site builders use; the words mean nothing,
so a model can learn from structure and shape of text only.
"""

from __future__ import annotations

import random

#: Fixed: names that mark a part of a page, by what it is; each may be a class or an id.
MAIN_NAMES = (
    "article body content entry-content post-content article-body main main-content story "
    "story-body post-body text articleBody page-content single-post blog-post prose"
).split()
OTHER_NAMES = {
    "menu": (
        "nav menu navbar navigation main-menu site-nav breadcrumb breadcrumbs pagination pager "
        "tabs toolbar tag-list tags categories skip-link dropdown sitemap links"
    ).split(),
    "header": "header site-header masthead topbar page-header logo branding top banner".split(),
    "footer": "footer site-footer page-footer copyright colophon legal bottom foot".split(),
    "sidebar": (
        "sidebar side-bar aside widget widgets rail right-rail left-column related "
        "related-posts recommended trending popular more-stories archive"
    ).split(),
    "notice": (
        "notice cookie cookies cookie-banner consent gdpr alert modal popup overlay newsletter "
        "subscribe subscription signup paywall message disclaimer warning announcement toast"
    ).split(),
    "advert": (
        "ad ads advert advertisement adsbox ad-slot ad-banner banner-ad sponsor sponsored "
        "promo promotion promoted dfp outbrain taboola commercial partner"
    ).split(),
    "form": "form search search-form login login-form contact-form comment-form signin".split(),
    "comments": (
        "comments comment comment-list commentlist comment-body replies reply responses "
        "discussion disqus thread user-comments reader-comments feedback"
    ).split(),
    "share": "share social social-links share-buttons follow sharing".split(),
}
_SYLLABLES = "an be co da el fi ga ho in ju ka lo mi no or pa qui re sa to un ve wa xe yo zu".split()


def _sentence(rng: random.Random, low: int, high: int) -> str:
    words = [
        "".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))
    ]
    return " ".join(words).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])


def _text(rng: random.Random) -> str:
    if rng.random() < 0.25:
        return _sentence(rng, 1, 6)
    return " ".join(_sentence(rng, 3, 18) for _ in range(rng.randint(1, 8)))


def _named(rng: random.Random, name: str) -> str:
    extra = rng.choice(["", "", " " + rng.choice(["row", "col", "inner", "box", "wrap"])])
    return rng.choice([f'class="{name}{extra}"', f'id="{name}"', f"class='x1 {name}'"])


def _links(rng: random.Random) -> str:
    rows = "".join(
        f'<li><a href="/{i}">{_sentence(rng, 1, 4)}</a></li>' for i in range(rng.randint(2, 7))
    )
    return f"<ul>{rows}</ul>"


def _blocks(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randint(1, 6)):
        text = _text(rng)
        kind = rng.random()
        if kind < 0.52:
            out.append(f"<p>{text}</p>")
        elif kind < 0.57:
            out.append(f"<div>{text}</div>")
        elif kind < 0.62:
            out.append(f"{text}<br><br>{_text(rng)}")
        elif kind < 0.72:
            level = rng.randint(2, 4)
            out.append(f"<h{level}>{_sentence(rng, 2, 8)}</h{level}>")
        elif kind < 0.80:
            out.append(f"<ul><li>{text}</li><li>{_text(rng)}</li></ul>")
        elif kind < 0.85:
            out.append(f"<blockquote>{text}</blockquote>")
        elif kind < 0.90:
            out.append(f"<table><tr><td>{_sentence(rng, 1, 4)}</td><td>{text}</td></tr></table>")
        elif kind < 0.95:
            out.append(f'<p>{text} <a href="#">{_sentence(rng, 1, 3)}</a> {_sentence(rng, 2, 9)}')
        else:
            out.append(f"<figure><figcaption>{_sentence(rng, 3, 10)}</figcaption></figure>")
    return "".join(out)


def _other(rng: random.Random, kind: str) -> str:
    name = _named(rng, rng.choice(OTHER_NAMES[kind]))
    short = f"{_sentence(rng, 2, 10)}"
    tags = {
        "menu": ["nav", "div", "ul"],
        "header": ["header", "div"],
        "footer": ["footer", "div"],
        "sidebar": ["aside", "div", "section"],
        "notice": ["div", "section", "p"],
        "advert": ["div", "aside", "ins", "p"],
        "form": ["form", "div"],
        "comments": ["section", "div", "ol"],
        "share": ["div", "ul"],
    }[kind]
    tag = rng.choice(tags)
    # A semantic element needs no name to say what it is.
    bare = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5
    name = "" if bare else f" {name}"
    if kind in ("menu", "share"):
        body = _links(rng)
    elif kind == "footer":
        body = rng.choice([f"&copy; {short}", f"<p>{short}</p>", _links(rng) + short])
    elif kind == "comments":
        body = "".join(f"<div><b>{_sentence(rng, 1, 2)}</b><p>{_text(rng)}</p></div>" for _ in "ab")
    elif kind == "form":
        body = f"<label>{_sentence(rng, 1, 3)}</label><input><button>{_sentence(rng, 1, 2)}</button>"
    elif kind in ("sidebar", "notice"):
        body = rng.choice([f"<p>{_text(rng)}</p>", short, f"<h3>{short}</h3>" + _links(rng)])
    else:
        body = rng.choice([short, f"<p>{short}</p>", f"<h1>{short}</h1>", f"<a href='/'>{short}</a>"])
    if kind == "form" and tag == "div":
        body = f"<form>{body}</form>"
    return f"<{tag}{name}>{body}</{tag}>"


def labelled_page(rng: random.Random) -> list[tuple[str, bool | None]]:
    """A page as fragments with the label of their blocks; None: markup without own blocks."""
    kinds = list(OTHER_NAMES)
    parts: list[tuple[str, bool | None]] = [("<html><body>", None)]

    def others(low: int, high: int) -> None:
        for _ in range(rng.randint(low, high)):
            parts.append((_other(rng, rng.choice(kinds)), False))

    others(0, 4)
    wrapped = rng.random() < 0.3
    if wrapped:
        parts.append((rng.choice(["<div>", '<div class="container">', "<section>"]), None))
    style = rng.random()
    if style < 0.45:
        tag = rng.choice(["article", "article", "main"])
        start, end = f"<{tag}>", f"</{tag}>"
    elif style < 0.85:
        tag = rng.choice(["div", "section", "article", "main"])
        start, end = f"<{tag} {_named(rng, rng.choice(MAIN_NAMES))}>", f"</{tag}>"
    else:
        start, end = "", ""
    parts.append((start, None))
    if rng.random() < 0.7:
        title = f"<h1>{_sentence(rng, 3, 10)}</h1>"
        inside = end == "</article>" and rng.random() < 0.2
        parts.append((f"<header>{title}</header>" if inside else title, True))
    for _ in range(rng.randint(1, 4)):
        parts.append((_blocks(rng), True))
        if rng.random() < 0.3:
            parts.append((_other(rng, rng.choice(kinds)), False))
    parts.append((end, None))
    if wrapped:
        parts.append(("</div>", None))
    others(0, 4)
    parts.append(("</body></html>", None))
    return parts


def labelled_pages(count: int, seed: int) -> list[list[tuple[str, bool | None]]]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(count)]
