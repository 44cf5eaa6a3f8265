"""Labelled pages on which the extraction model is trained.

Each page is laid out from hand-labelled regions: what stands in an article region is content, what
stands in a menu, header, footer, sidebar, notice, advert, form or reader-comment region is not. The
regions differ in markup (semantic elements, classes, ids, plain tables) and in text, so that the
model learns from ancestors and from text alike. Seeded: every call gives the same pages.
"""

from __future__ import annotations

import random

# fixed values: words of the labelled texts
WORDS = """the of and a to in is was he for it with as his on be at by had not are but from or have an they which one you
were her all she there would their we him been has when who will more no if out so said what up its about into than them can
only other new some could time these two may then do first any my now such like our over man me even most made after also did
many before must through back years where much your way well down should because each just those people how too little state
good very make world still own see men work long here get both between life being under never day same another know while last
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
le la les de des et un une du en que est pour qui dans ce il sur par plus ne pas au avec son se el los las y que en por con""".split()

ARTICLES = [
    ("<article>", "</article>"), ("<main><article class='post'>", "</article></main>"), ("<main>", "</main>"),
    ("<div class='content'>", "</div>"), ("<div id='content'><div class='entry-content'>", "</div></div>"),
    ("<div class='article-body'>", "</div>"), ("<div class='post-content'>", "</div>"), ("<section class='story'>", "</section>"),
    ("<div id='main'><div class='text'>", "</div></div>"), ("<table><tr><td class='body'>", "</td></tr></table>"),
    ("<div itemprop='articleBody' class='article'>", "</div>"), ("<div>", "</div>"), ("<div class='wrapper'><div class='page'>", "</div></div>"),
]
MENUS = [("<nav>", "</nav>"), ("<div class='menu'>", "</div>"), ("<div id='navigation'>", "</div>"), ("<ul class='nav navbar'>", "</ul>"),
         ("<div class='breadcrumbs'>", "</div>"), ("<div role='navigation'>", "</div>"), ("<div class='top-bar'>", "</div>"),
         ("<div class='pagination'>", "</div>"), ("<menu>", "</menu>"), ("<div class='tabs'>", "</div>")]
HEADERS = [("<header>", "</header>"), ("<div id='header'>", "</div>"), ("<div class='masthead'>", "</div>"), ("<div class='site-header'>", "</div>"),
           ("<div role='banner'>", "</div>"), ("<div class='logo'>", "</div>")]
FOOTERS = [("<footer>", "</footer>"), ("<div id='footer'>", "</div>"), ("<div class='site-footer copyright'>", "</div>"), ("<div class='legal'>", "</div>"),
           ("<div role='contentinfo'>", "</div>")]
ASIDES = [("<aside>", "</aside>"), ("<div class='sidebar'>", "</div>"), ("<div id='sidebar' class='widget'>", "</div>"), ("<div class='related-posts'>", "</div>"),
          ("<div class='social share'>", "</div>"), ("<div class='ad'>", "</div>"), ("<div class='ads advert'>", "</div>"), ("<div class='banner-ad'>", "</div>"),
          ("<div class='sponsor promo'>", "</div>"), ("<div class='advertisement'>", "</div>"), ("<div class='notice'>", "</div>"),
          ("<div class='cookie-notice'>", "</div>"), ("<div id='cookie-consent' class='popup'>", "</div>"), ("<div class='alert warning'>", "</div>"),
          ("<div role='alert'>", "</div>"), ("<div class='newsletter subscribe'>", "</div>"), ("<div class='recommended'>", "</div>"),
          ("<section class='promo'>", "</section>"), ("<aside class='ad-slot'>", "</aside>"), ("<div class='gdpr consent banner'>", "</div>"),
          ("<div class='disclaimer'>", "</div>"), ("<div class='toolbar'>", "</div>"), ("<div class='meta tags'>", "</div>"), ("<div hidden>", "</div>"),
          ("<dialog class='modal'>", "</dialog>"), ("<div class='author-bio'>", "</div>"), ("<section class='notice'>", "</section>"),
          ("<p class='notice'>", "</p>"), ("<div class='advert'>", "</div>"), ("<p class='ad'>", "</p>"), ("<div class='teaser'>", "</div>"),
          ("<div class='signup paywall'>", "</div>"), ("<div id='banner'>", "</div>"), ("<section class='sidebar'>", "</section>"),
          ("<div class='notification message'>", "</div>"), ("<div class='side'>", "</div>"), ("<div class='sponsored-links'>", "</div>")]
FORMS = ["<form action='/s'><label>{0}</label><input name=q><button>{1}</button><p>{2}</p></form>",
         "<div class='search'><form><p>{0}</p><fieldset><legend>{1}</legend><div>{2}</div></fieldset></form></div>",
         "<form class='login'><div>{0}</div><div>{1}</div><button type=submit>{2}</button></form>", "<div><button>{0}</button></div>"]
COMMENTS = [("<section id='comments'>", "</section>"), ("<div class='comments'>", "</div>"), ("<div class='comment-list'><div class='comment'>", "</div></div>"),
            ("<ol class='discussion'>", "</ol>"), ("<div id='disqus' class='replies'>", "</div>"), ("<div class='reader-comments'>", "</div>"),
            ("<section class='comment-section responses'>", "</section>"), ("<div class='user-reviews reviews'>", "</div>"),
            ("<div class='comment'>", "</div>"), ("<ul class='comments'>", "</ul>"), ("<div id='respond' class='feedback'>", "</div>"),
            ("<section id='reader-comments'>", "</section>"), ("<div class='thread'><div class='reply'>", "</div></div>"), ("<article class='comment'>", "</article>"),
            ("<div class='user-comment'>", "</div>")]
SHORT = ["Home", "About us", "Contact", "Privacy policy", "Terms", "Login", "Subscribe now", "Share this", "Read more", "Next page", "Archive",
         "RSS", "Follow us", "Advertisement", "Sponsored", "We use cookies to improve this site.", "Accept all", "Search", "Sign up for our newsletter",
         "Leave a comment", "Reply", "Related articles", "Back to top", "Menu"]


def labelled_pages(n: int = 600, seed: int = 11) -> list[tuple[str, set[str]]]:
    """(html, texts of the content blocks) of ``n`` pages; no boilerplate block has a content block's text."""
    rng = random.Random(seed)
    return [_page(rng) for _ in range(n)]


def _sentence(rng: random.Random, low: int = 3, high: int = 18) -> str:
    words = [rng.choice(WORDS) for _ in range(rng.randint(low, high))]
    text = " ".join(w + ("," if rng.random() < 0.08 else "") for w in words).rstrip(",")
    return text[0].upper() + text[1:] + rng.choice(".........!?")


def _odd(rng: random.Random) -> str:
    """Content that is no prose: a word or row repeated, a table in text, shouting, no full stop."""
    kind, word = rng.randint(0, 3), rng.choice(WORDS)
    if kind == 0:
        return " ".join([word.title()] + [w for x in rng.sample(WORDS, rng.randint(1, 6)) for w in [x] * rng.randint(4, 14)])
    if kind == 1:
        return " | ".join(_sentence(rng, 1, 1).rstrip(".!?") for _ in range(rng.randint(3, 25)))
    if kind == 2:
        return " ".join(w.upper() + "!!" for w in rng.choices(WORDS, k=rng.randint(3, 30)))
    return _sentence(rng, 1, 25).rstrip(".!?")


def _paragraph(rng: random.Random) -> str:
    return " ".join(_sentence(rng) for _ in range(rng.choice([1, 1, 1, 2, 3, 5, 8])))


def _page(rng: random.Random) -> tuple[str, set[str]]:
    content: set[str] = set()

    def article() -> str:
        start, end = rng.choice(ARTICLES)
        out, title = [], _sentence(rng, 2, 10)
        if rng.random() < 0.2:
            title = _odd(rng)
        content.add(title)
        heading = f"<{(h := rng.choice(['h1', 'h1', 'h2']))}>{title}</{h}>"
        out.append(rng.choice([heading, heading, f"<header>{heading}</header>"]))
        for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            kind = rng.random()
            pick = rng.random()
            text = _paragraph(rng) if pick < 0.75 else _sentence(rng, 1, 4) if pick < 0.85 else _odd(rng)
            if kind < 0.16:
                items = [_sentence(rng, 1, 12).rstrip(rng.choice([".!?", ""])) for _ in range(rng.randint(2, 5))]
                content.update(items)
                out.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
                continue
            content.add(text)
            if kind < 0.20:
                out.append(f"<h2>{text}</h2>")
            elif kind < 0.23:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.26:
                out.append(f"<pre>{text}</pre>")
            elif kind < 0.31:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.36:
                out.append(f"<div>{text}</div>")
            elif kind < 0.40:
                out.append(f"<table><tr><td>{text}</td></tr></table>")
            else:
                out.append(f"<p>{text}</p>")
            if rng.random() < 0.25:
                out.append(rng.choice([lambda: region(ASIDES), lambda: region(ASIDES), lambda: region(COMMENTS), lambda: region(COMMENTS), form])())
        return start + "".join(out) + end

    def fill(links: bool) -> str:
        out = []
        for _ in range(rng.randint(1, 6)):
            text = rng.choice(SHORT) if rng.random() < 0.4 else _sentence(rng, 1, 4).rstrip(".!?") if rng.random() < 0.5 else _paragraph(rng)
            if text in content:
                continue
            if links:
                out.append(rng.choice(["<li><a href='/x'>{0}</a></li>", "<a href='/y'>{0}</a>", "<div><a href='/z'>{0}</a></div>"]).format(text))
            else:
                out.append(rng.choice(["<p>{0}</p>", "<div>{0}</div>", "{0}", "<h3>{0}</h3>", "<h1>{0}</h1>", "<h2>{0}</h2>", "<p>{0}</p>"]).format(text))
        return rng.choice(["<ul>{0}</ul>", "{0}"]).format("".join(out)) if links else "".join(out)

    def region(kinds: list[tuple[str, str]], links: bool = False) -> str:
        start, end = rng.choice(kinds)
        return start + fill(links) + end

    def form() -> str:
        return rng.choice(FORMS).format(*(rng.choice(SHORT) if rng.random() < 0.5 else _sentence(rng, 1, 8) for _ in range(3)))

    body = [article()]
    before = [lambda: region(HEADERS), lambda: region(MENUS, True), lambda: region(ASIDES), form]
    after = [lambda: region(ASIDES), lambda: region(COMMENTS), lambda: region(COMMENTS), lambda: region(FOOTERS), form, lambda: region(MENUS, True)]
    head = [f() for f in before if rng.random() < 0.6]
    tail = [f() for f in after if rng.random() < 0.6]
    if rng.random() < 0.5:
        tail.append(f"<footer>&copy; {_sentence(rng, 1, 3)} &middot; {_paragraph(rng)}</footer>")
    html = "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join(head + body + tail) + "</body></html>"
    return html, content
