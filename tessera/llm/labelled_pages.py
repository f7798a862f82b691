"""Labelled pages for the HTML model: layouts with a label on each element whose part of the page changes.

``y`` labels an element and all below it down to the next ``y``: ``m`` holds several parts, ``c`` is the
article, ``b`` is anything else.  Pages are put together from the parts below by a seeded generator.
"""

from __future__ import annotations

import random
import re

# Words of the sentences, and the names that pages give to their parts.
_WORDS = ("river stone winter market letter garden engine paper forest window music teacher morning bridge water "
          "la casa del mundo und der weg nach haus le temps des fleurs sur").split()
_ARTICLE = ["<article y=c>{}</article>", "<main y=c>{}</main>", '<div id="content" y=c>{}</div>', '<div class="post entry-content" y=c>{}</div>',
            '<section class="article-body story" y=c>{}</section>', '<main y=m><article y=c>{}</article></main>', '<div class="main" y=m><div class="text" y=c>{}</div></div>',
            '<div itemprop="articleBody" class="article" y=c>{}</div>', "<div y=c>{}</div>", '<td class="body" y=c>{}</td>', '<article class="page hentry" y=c>{}</article>']
_BEFORE = ['<nav y=b>{links}</nav>', '<div class="menu" y=b>{links}</div>', '<ul id="nav" class="navbar" y=b>{links}</ul>', '<header y=b><a href="/">{name}</a>{links}</header>',
           '<div class="header top" y=b><span>{name}</span></div>', '<div id="masthead" y=b><h2>{name}</h2><p>{short}</p></div>', '<div class="breadcrumb breadcrumbs" y=b>{links}</div>',
           '<div class="cookie notice" y=b><p>{sentence}</p><button>{word}</button></div>', '<div role="alert" class="alert banner" y=b>{sentence}</div>', '<div class="notice" y=b><p>{sentence}</p></div>',
           '<p class="notice" y=b>{sentence}</p>', '<div class="consent gdpr popup modal overlay" y=b>{sentence} <a href="/x">{word}</a></div>', '<form class="search" y=b><input name="q"><button>{word}</button></form>',
           '<header class="site-header" role="banner" y=b><h1>{name}</h1></header>', '<div class="ad" y=b>{sentence}</div>', '<div id="banner" class="ads advert advertisement" y=b><a href="/y">{sentence}</a></div>']
_AFTER = ['<footer y=b>{sentence} {links}</footer>', '<footer y=b>&copy; {name} &middot; {sentence}</footer>', '<div class="footer" y=b><p>{sentence}</p></div>', '<div id="footer" class="copyright legal" y=b>{sentence}</div>',
          '<aside y=b><h3>{short}</h3>{links}</aside>', '<aside class="sidebar" y=b><p>{sentence}</p><p>{sentence}</p></aside>', '<div id="sidebar" class="widget" y=b><h4>{short}</h4>{teasers}</div>',
          '<div class="related recommended more" y=b><h3>{short}</h3>{teasers}</div>', '<section class="comments" id="comments" y=b><h3>{short}</h3>{comments}</section>', '<div id="disqus" class="comment-list discussion" y=b>{comments}</div>',
          '<ol class="commentlist replies" y=b><li class="comment">{sentence} {sentence}</li><li class="comment"><p>{sentence}</p></li></ol>', '<div class="share social" y=b>{links}</div>',
          '<form class="newsletter subscribe signup" y=b><p>{sentence}</p><label>{word}</label><input><button>{word}</button></form>', '<form action="/login" class="login" y=b><label>{word}</label><select><option>{word}</option><option>{word}</option></select></form>',
          '<div class="pagination pager" y=b>{links}</div>', '<div class="sponsor sponsored promo" y=b><p>{sentence}</p></div>', '<div class="author-box tags" y=b>{links}</div>', '<div class="bottom contact" y=b>{sentence}</div>',
          '<div class="ad-slot advert" y=b><p>{sentence}</p></div>', '<div class="comment" y=b><b>{name}</b><p>{sentence} {sentence}</p></div>', '<ul class="menu" y=b>{links}</ul>']
_INSIDE = ['<div class="ad" y=b>{sentence}</div>', '<aside y=b><p>{sentence}</p></aside>', '<div class="advert sponsored" y=b><p>{sentence}</p></div>', '<form y=b><label>{word}</label><input><button>{word}</button></form>',
           '<nav class="toc" y=b>{links}</nav>', '<div class="share" y=b>{links}</div>', '<div class="related" y=b>{teasers}</div>', '<div class="newsletter" y=b><p>{sentence}</p><button>{word}</button></div>',
           '<section class="comments" y=b>{comments}</section>', '<div class="notice" y=b>{sentence}</div>', '<footer y=b>{links}</footer>', '<div class="promo banner" y=b>{sentence}</div>', '<div id="comments" y=b>{comments}</div>']


def _fill(part: str, r: random.Random) -> str:
    word = lambda: r.choice(_WORDS)
    sentence = lambda a=5, z=18: " ".join(word() for _ in range(r.randint(a, z))).capitalize() + r.choice([".", ".", ".", ".", "!", "?", "", ""])
    link = lambda: f'<a href="/{word()}">{" ".join(word() for _ in range(r.randint(1, 3)))}</a>'
    make = {
        "{links}": lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 8))) + "</ul>" if r.random() < 0.7 else " | ".join(link() for _ in range(r.randint(2, 6))),
        "{teasers}": lambda: "".join(f"<li><a href='/{word()}'>{sentence(4, 9)}</a></li>" for _ in range(r.randint(2, 5))),
        "{comments}": lambda: "".join(f'<div class="comment"><span class="user">{word()}</span><p>{sentence()} {sentence()}</p></div>' for _ in range(r.randint(1, 4))),
        "{sentence}": sentence, "{short}": lambda: " ".join(word() for _ in range(r.randint(1, 3))), "{name}": lambda: f"{word()}.example.com", "{word}": word}
    for name, value in make.items():
        while name in part:
            part = part.replace(name, value(), 1)
    return part


def _article(r: random.Random) -> str:
    def paragraph() -> str:
        text = " ".join(_fill("{sentence}", r) for _ in range(r.choice([1, 1, 2, 3, 5, 9])))
        for _ in range(r.choice([0, 0, 0, 1, 1, 3])):
            words = text.split(" ")
            k, z = r.randrange(len(words)), r.randint(1, 4)
            words[k:k + z] = [r.choice(["<a href='/in'>{}</a>", "<a href='/in'>{}</a>", "<b>{}</b>", "<em>{}</em>", "<code>{}</code>", "<span>{}</span>"]).format(" ".join(words[k:k + z]))]
            text = " ".join(words)
        return f"<p>{'<b>' if r.random() < 0.1 else ''}{text}</p>"

    parts = [r.choice(["<h1>{short} {short}</h1>", "<header><h1>{short} {short}</h1></header>", "<h2>{short} {short}</h2>", "<h1>{sentence}</h1>"])] * (r.random() < 0.9)
    for _ in range(r.randint(1, 8)):
        kind = r.random()
        parts.append(paragraph() if kind < 0.75 else r.choice([
            "<h2>{short}</h2>", "<ul><li>{sentence}</li><li>{sentence}</li></ul>", "<blockquote><p>{sentence}</p></blockquote>", "<div>{sentence} {sentence}</div>", "<p>{word}.</p>",
            "<table><tr><td>{word}</td><td>{word}</td></tr></table>", "<figure><img src='x.png'><figcaption>{sentence}</figcaption></figure>", "<pre>{sentence}</pre>", "<ol><li>{sentence}</li><li>{short}</li></ol>"]))
    if r.random() < 0.4:
        parts.insert(r.randint(1, len(parts)), r.choice(_INSIDE))
    if r.random() < 0.25:  # wrapped once more
        parts = [r.choice(["<div>", "<section>", "<div><div>"]) + "".join(parts)]
    return "".join(_fill(p, r) for p in parts)


def labelled_pages(n: int = 400, seed: int = 7) -> list[str]:
    """``n`` pages whose elements carry the labels."""
    r, pages = random.Random(seed), []
    for k in range(n):
        before = [_fill(p, r) for p in r.sample(_BEFORE, r.randint(0, 5))]
        after = [_fill(p, r) for p in r.sample(_AFTER, r.randint(0, 6))]
        middle = r.choice(_ARTICLE).format(_article(r))
        if r.random() < 0.15:  # an article without an element of its own
            middle = re.sub(r"<(h1|h2|p|ul|ol|div|blockquote|pre)(?=>)", r"<\1 y=c", _fill("<h1>{short}</h1>" + "<p>{sentence}</p>" * r.randint(1, 6), r))
        if r.random() < 0.4:
            beside = [_fill(p, r) for p in r.sample(_AFTER, r.randint(0, 2))]
            middle = r.choice(['<div class="wrapper" y=m>{}</div>', '<div id="container" class="row" y=m>{}</div>', "<div y=m>{}</div>", '<section y=m>{}</section>']).format(middle + "".join(beside))
        if k % 20 == 0:  # hardly any markup
            pages.append("".join(f"<p y=c>{_fill('{sentence}', r)}" for _ in range(r.randint(1, 4))) if k % 40 else _fill("{sentence} {sentence}", r))
            continue
        pages.append(f"<html y=m><head y=b><title>{_fill('{short}', r)}</title></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>")
    return pages
