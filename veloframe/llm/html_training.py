"""Labelled pages for the content model, made by rule.

Each page puts an article into one of several usual containers and surrounds,
and breaks it with the usual other parts. Elements carry data-content="1" or
"0"; elements without it share their parent's label.
"""

from __future__ import annotations

import random

SYLLABLES = "an be co da el fi go ha in ju ka lo me no or pa qui ro su ta un ve wo ex yo za".split()
CONTAINERS = ("<article>", "<article>", "<article>", "<article>", "<article>", "<main>", "<main>", '<div class="content">', '<div id="content">', '<div class="post">',
              '<div class="article-body">', '<section class="entry">', '<div class="story text">',
              '<div id="main" role="main">', '<div class="entry-content">', "<section>", "<div>")
LINK_PARTS = ("<nav>", '<div class="menu">', '<ul class="nav">', '<div id="navigation" role="navigation">',
              '<div class="breadcrumbs">', '<div class="related">', '<div class="share social">',
              '<div class="tags">', '<menu>', '<div class="pagination">', '<div class="toolbar">')
TEXT_PARTS = ("<header>", "<footer>", "<aside>", '<div class="sidebar">', '<div id="sidebar" role="complementary">',
              '<div class="cookie-notice">', '<div class="cookie banner">', '<div class="notice">',
              '<p class="notice">', '<div class="alert" role="alert">', '<div class="ad">', '<div class="advert">',
              '<div class="ads">', '<div class="advertisement">', '<div class="sponsored">', '<div class="promo">',
              '<div class="banner">', '<div id="footer">', '<div class="footer" role="contentinfo">',
              '<div id="header" role="banner">', '<div class="header">', '<div class="newsletter">',
              '<div class="widget">', '<div class="popup modal">', "<noscript>", '<div class="copyright">',
              '<div class="subscribe">', '<section class="teaser">', '<ins class="ads">', '<div class="consent">')
COMMENT_PARTS = ('<section class="comments">', '<div id="comments">', '<ol class="comment-list">',
                 '<div class="comment">', '<div class="replies">', '<section id="discussion" class="comments">',
                 '<div class="user-comments">', '<div class="reader-comments">', '<article class="comment">')


def sentence(r: random.Random, least: int, most: int) -> str:
    words = ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(least, most))]
    return " ".join(words).capitalize() + r.choice((".", ".", "!", "?", ""))


def closing(tag: str) -> str:
    return f"</{tag[1:-1].split()[0]}>"


def labelled(tag: str, content: bool) -> str:
    return f'{tag[:-1]} data-content="{int(content)}">'


def links(r: random.Random) -> str:
    items = [f'<a href="/{k}">{sentence(r, 1, 3)}</a>' for k in range(r.randint(2, 7))]
    if r.random() < 0.7:
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    return " | ".join(items)


def paragraph(r: random.Random) -> str:
    text = sentence(r, 1, 4) if r.random() < 0.2 else " ".join(sentence(r, 3, 18) for _ in range(r.randint(1, 5)))
    kind = r.random()
    if kind < 0.1:
        return f"<p><b>{text}<br><p>{sentence(r, 3, 12)}</p>"
    if kind < 0.2:
        return f'<p>{text} <a href="/x">{sentence(r, 1, 3)}</a> {sentence(r, 2, 8)}</p>'
    return f"<p>{text}</p>"


def article(r: random.Random) -> str:
    out = [f"<h1>{sentence(r, 2, 9)}</h1>"] if r.random() < 0.8 else []
    for _ in range(r.randint(1, 9)):
        kind = r.random()
        if kind < 0.62:
            out.append(paragraph(r))
        elif kind < 0.72:
            out.append(f"<h2>{sentence(r, 1, 6)}</h2>{paragraph(r)}")
        elif kind < 0.78:
            out.append("<ul>" + "".join(f"<li>{sentence(r, 2, 14)}</li>" for _ in range(3)) + "</ul>")
        elif kind < 0.83:
            out.append(f"<blockquote>{paragraph(r)}</blockquote>")
        elif kind < 0.87:
            out.append("<table><tr>" + "".join(f"<td>{sentence(r, 1, 5)}</td>" for _ in range(3)) + "</tr></table>")
        elif kind < 0.9:
            out.append(f"<figure><img src=x><figcaption>{sentence(r, 3, 9)}</figcaption></figure>")
        elif kind < 0.93:
            out.append(f"<pre>{sentence(r, 3, 12)}</pre>")
        else:
            out.append(other(r))
    return "".join(out)


def other(r: random.Random) -> str:
    kind = r.random()
    if kind < 0.3:
        tag, inner = r.choice(LINK_PARTS), links(r)
    elif kind < 0.75:
        tag = r.choice(TEXT_PARTS)
        inner = r.choice((lambda: sentence(r, 3, 16), lambda: f"<p>{sentence(r, 3, 25)}</p>",
                          lambda: f"<h3>{sentence(r, 1, 4)}</h3>{links(r)}", lambda: paragraph(r) + links(r),
                          lambda: f"<h1>{sentence(r, 1, 4)}</h1><nav>{links(r)}</nav>",
                          lambda: f"<h2>{sentence(r, 1, 5)}</h2><p>{sentence(r, 2, 9)}</p>"))()
    elif kind < 0.83:
        tag = "<form>"
        inner = f"<label>{sentence(r, 1, 3)}</label><input name=q><select><option>{sentence(r, 1, 2)}</select>" \
                f"<p>{sentence(r, 2, 9)}</p><button>{sentence(r, 1, 2)}</button>"
    else:
        tag = r.choice(COMMENT_PARTS)
        inner = "".join(r.choice(("<p>{}</p>", '<div class="comment"><p>{}</p></div>', "<div>{}</div>"))
                        .format(" ".join(sentence(r, 3, 20) for _ in range(r.randint(1, 3))))
                        for _ in range(r.randint(1, 4)))
    return labelled(tag, False) + inner + closing(tag)


def labelled_pages(n: int = 300, seed: int = 5) -> list[str]:
    """``n`` pages; the same ones for the same arguments."""
    r, pages = random.Random(seed), []
    for _ in range(n):
        container = r.choice(CONTAINERS)
        main = labelled(container, True) + article(r) + closing(container)
        if (kind := r.random()) < 0.2:
            text = f"<p>{sentence(r, 2, 9)}</p>" if kind < 0.1 else article(r)
            pages.append(labelled(container, True) + text + closing(container))
            continue
        body = [*(other(r) for _ in range(r.randint(1, 4))), main, *(other(r) for _ in range(r.randint(1, 4)))]
        if kind < 0.4:
            body = ["<div>", *body, "</div>"]
        pages.append(f'<!DOCTYPE html><html><head data-content="0"><title>{sentence(r, 2, 8)}</title>'
                     f"<style>p{{}}</style></head><body>{''.join(body)}</body></html>")
    return pages
