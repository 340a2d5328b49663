"""Labelled pages for training: data-content="1" opens content, "0" what is not, down to the next mark."""

from __future__ import annotations

import random

_P = "The river rose again in the night, and by morning the lower road was under water from the mill to the bridge."
_Q = "Nobody was surprised. The council had been warned in spring, and the repairs were put off until the money came."
_R = "Short note."
_LONG = " ".join([_P, _Q] * 4)

PAGES = (
    f"""<html><head><title>t</title></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact us</a></li></ul></nav>
<div class="ad">Buy two, get one free, only this week.</div>
<article data-content="1"><h1>High water</h1><p>{_P}</p><p><b>{_Q}</b></p><p>{_LONG}</p><p>{_R}</p></article><footer>&copy; 2020 The Paper. All rights reserved.</footer></body></html>""",
    f"""<html><body><header><a href="/">The Paper</a><p>News since 1890</p></header><nav class="menu"><a href="/a">Sport</a><a href="/b">Arts</a></nav>
<div class="cookie-banner"><p>We use cookies to improve your visit. By going on you agree.</p><button>Accept</button></div>
<main data-content="1"><article><h1>Bridge closed</h1><h2>Repairs begin</h2><p>{_P} <a href="/x">map</a></p><ul><li>{_R}</li><li>{_Q}</li></ul><blockquote><p>{_Q}</p></blockquote><p>{_LONG}</p></article></main>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Storm warning for the coast tonight</a></li><li><a href="/2">Council votes again</a></li></ul><p>Sign up for our letter.</p></aside>
<section class="comments" id="comments"><h2>Comments</h2><div class="comment"><p class="author">Ann</p><p>I live there and it was worse than this says, believe me, much worse.</p></div><div class="comment"><p>Thanks for the report, it was a help to all of us here.</p></div></section>
<footer class="footer"><p>Imprint and privacy. All rights reserved by the publisher and its partners.</p><a href="/p">Privacy</a></footer></body></html>""",
    f"""<html><body><div id="header"><div class="logo">Blog</div></div><div id="nav" class="navigation"><ul><li><a href="/">Start</a></li><li><a href="/ab">About</a></li></ul></div>
<div id="wrapper"><div id="content" class="post" data-content="1"><h1>On walking</h1><div class="entry"><p>{_P}</p><p>{_LONG}</p><p>{_Q}</p></div></div>
<div id="sidebar" class="widget"><h3>Archive</h3><ul><li><a href="/m">May</a></li><li><a href="/j">June</a></li></ul></div>
<div class="share social"><a href="#">Share</a><a href="#">Like</a></div><div class="related"><h3>Related posts</h3><a href="/r">On running</a></div></div>
<div id="footer"><p>Powered by a blog engine.</p></div></body></html>""",
    f"""<html><body><div class="top-bar notice"><p>Our office is closed on Monday. Please read the notice for visitors before you come.</p></div>
<div class="breadcrumb"><a href="/">Home</a> / <a href="/k">Kitchen</a></div>
<div class="main-content" data-content="1"><h1>Bread</h1><p>{_Q}</p><h2>You need</h2><ol><li>Flour</li><li>Water and salt</li></ol><table><tr><th>Step</th><th>Time</th></tr><tr><td>Rest</td><td>Two hours</td></tr></table><pre>bake 40
cool 20</pre><p>{_LONG}</p></div>
<form class="newsletter subscribe" action="/s"><label>Your mail address</label><input name="m"><p>Get new recipes every week, free of charge.</p><button>Subscribe</button></form>
<div class="advert banner"><p>The best ovens of the year at half the price, this week only in our shop.</p></div>
<div class="copyright"><p>All rights reserved.</p></div></body></html>""",
    f"""<html><body><header><h1>Site name</h1><nav role="navigation"><a href="/1">One</a> <a href="/2">Two</a></nav></header>
<div class="alert"><p>Please switch on scripts in your browser to see all of this page as it is meant.</p></div>
<section class="article-body" data-content="1"><h2>Part one</h2><p>{_LONG}</p><p>{_R}</p><figure><img src="a"><figcaption>The mill at noon</figcaption></figure><h3>Part two</h3><p>{_P}</p><div class="ad" data-content="0"><p>Advertisement: shoes for every weather, order now and save.</p></div><p>{_Q}</p></section>
<div id="disqus" class="responses"><ul class="comment-list"><li><p>First! And I think the second part is far better than the first.</p></li><li><p>Agreed with the above, but the first part has its moments too.</p></li></ul>
<form class="reply"><textarea>Write a reply here</textarea><button>Send</button></form></div>
<footer role="contentinfo"><ul><li><a href="/t">Terms</a></li></ul></footer></body></html>""",
    f"""<html><body><table><tr><td class="left menu"><a href="/1">Physics</a><br><a href="/2">Chemistry</a></td>
<td class="text" data-content="1"><p>{_P}<p>{_LONG}<p>{_Q}</td><td class="right promo"><p>Sponsored: lessons by mail, ask for a free sample today.</p></td></tr></table>
<div class="legal disclaimer"><p>No warranty is given for anything on these pages, see the terms for details.</p></div></body></html>""",
    f"""<html><body><nav><ul><li><a href="/a">A</a></li></ul></nav><article data-content="1"><header><h1>Night trains</h1></header><p>{_LONG}</p><h2>Prices</h2><p>{_Q}</p>
<aside data-content="0"><p>Read also: <a href="/o">how to sleep on a train</a></p></aside><p>{_P}</p><footer data-content="0"><p>Filed under travel</p></footer></article>
<section id="reader-comments" class="reader comments"><article class="comment"><p>We took this train last year and slept very well indeed, thank you.</p></article><article class="comment"><p>{_R}</p></article></section>
<div class="popup modal overlay"><p>Do you like this? Become a member today and read without adverts.</p></div><footer><p>Made by us</p></footer></body></html>""",
    f"""<html><body><div class="page"><div class="head masthead"><p>The Daily</p></div><div class="story" data-content="1"><h1>Title</h1><p>{_Q}</p><p>{_P}</p><p>{_LONG}</p><div><p>{_R}</p><p>{_Q}</p></div></div>
<div class="side column sponsor ads"><p>Hot deals near you, click to see them all before they are gone.</p></div><div class="pagination pager"><a href="/2">Next</a></div><div class="tags meta"><a href="/t">water</a></div></div></body></html>""",
    f"""<html><body><header class="site-header"><h1>Gardens</h1><p>Welcome to our pages about gardens.</p></header><main data-content="1"><h1>Roses</h1><p>{_LONG}</p><section><h2>Soil</h2><p>{_P}</p></section><section><h2>Water</h2><p>{_Q}</p><dl><dt>Spring</dt><dd>Often</dd></dl></section></main>
<aside><p>About the author: a gardener for thirty years, with a book to come this winter.</p></aside>
<div class="consent gdpr cookie notice"><p>This site stores data on your device. Choose what you allow before you go on.</p></div><form><p>Ask a question</p><select><option>Roses</option></select></form><footer><p>Contact and imprint</p></footer></body></html>""",
    f"""<html><body><nav><a href="/">Home</a></nav><article data-content="1"><h1>Note</h1><p>{_R}</p></article><footer>&copy; x &middot; Some closing words of the host.</footer></body></html>""",
    f"""<html><body><header class="site"><h1>The Observer</h1><p>All the news of the valley, every day of the week</p></header><div class="menu"><ul><li><a href="/1">Today</a></li></ul></div>
<h1 data-content="1">Harvest</h1><p data-content="1">{_P}</p><p data-content="1">{_LONG}</p><ul data-content="1"><li>{_R}</li></ul><p data-content="1">{_Q}</p>
<div class="footer"><p>Printed in the valley.</p></div></body></html>""",
    f"""<html><body><header><h1>Valley pages</h1><h2>Since 1950</h2></header><header class="banner top"><h1>Shop</h1></header><div data-content="1"><h2>Honey</h2><p>{_LONG}</p><p>{_Q}</p></div>
<div class="notification bar"><p>New: our pages now work on your phone as well.</p></div><footer><h2>Contact</h2><p>Write to us at any time.</p></footer></body></html>""",
    f"{_P} {_Q}",
    _R,
    _LONG,
)


_WORDS = (
    "water road village council winter repair bridge morning people market paper garden letter engine summer number reason "
    "teacher window harbour question answer river stone history machine evening measure school doctor family ticket "
    "old new long early quiet narrow public open simple heavy found built moved asked wrote began carried showed kept sold "
    "the the the of of and and in to a was with for on by from that had were not but after before between"
).split()


def _text(rng: random.Random, words: int) -> str:
    out = []
    while words > 0:
        n = min(words, rng.randint(6, 18))
        out.append(" ".join(rng.choices(_WORDS, k=n)).capitalize() + rng.choice("....?!"))
        words -= n
    return " ".join(out)


def _article(rng: random.Random) -> str:
    """The inner HTML of an article: paragraphs of very different lengths, lists, quotes, tables, parts, pictures."""
    parts = [f"<h1>{_text(rng, rng.randint(2, 8))}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice([1, 2, 3, 5, 8])):
        short = _text(rng, rng.randint(3, 12))
        whole = _text(rng, rng.choice([8, 20, 40, 80, 200, 600]))
        parts.append(rng.choice([
            f"<p>{whole}</p>", f"<p>{whole}</p>", f"<p>{whole}</p>", f"<p>{whole} <a href='/x'>{_text(rng, 2)}</a> {short}</p>",
            f"<p><b>{short}</b> {whole}</p>", f"<h2>{short}</h2><p>{whole}</p>", f"<ul><li>{short}</li><li>{whole}</li></ul>",
            f"<ol><li>{short}</li><li>{short}</li></ol>", f"<blockquote><p>{whole}</p></blockquote>", f"<section><h3>{short}</h3><p>{whole}</p></section>",
            f"<table><tr><th>{_text(rng, 1)}</th><th>{_text(rng, 2)}</th></tr><tr><td>{short}</td><td>{_text(rng, 3)}</td></tr></table>",
            f"<figure><img src='p'><figcaption>{short}</figcaption></figure>", f"<pre>{short}</pre>", f"<div><p>{whole}</p></div>", f"<p>{short}</p>",
        ]))
        if rng.random() < 0.08:
            parts.append(f"<div class='{rng.choice(['ad', 'promo', 'newsletter'])}' data-content='0'><p>{_text(rng, 8)}</p></div>")
    return "\n".join(parts)


def _named(rng: random.Random, tag: str, names: str, inner: str, share: float = 0.6) -> str:
    """An element with a class or id of one of ``names``, or without any."""
    name = f' {rng.choice(["class", "id"])}="{rng.choice(names.split())}"' if names and rng.random() < share else ""
    return f"<{tag}{name}>{inner}</{tag}>"


def _links(rng: random.Random, least: int = 2) -> str:
    return "".join(f"<li><a href='/{k}'>{_text(rng, rng.randint(1, 6))}</a></li>" for k in range(rng.randint(least, 7)))


def _before(rng: random.Random) -> list[str]:
    say = lambda n: _text(rng, rng.randint(3, n))
    return [
        _named(rng, "nav", "menu navigation top-nav", f"<ul>{_links(rng)}</ul>"),
        _named(rng, "header", "site-header header masthead", rng.choice([f"<a href='/'>{say(4)}</a><p>{say(9)}</p>", f"<h1>{say(4)}</h1>", f"<p>{say(8)}</p>"])),
        _named(rng, "div", "navbar menu nav breadcrumb", f"<ul>{_links(rng)}</ul>", 0.9),
        _named(rng, "div", "cookie-notice alert notice banner consent", f"<p>{say(16)}</p><button>{say(3)}</button>", 1),
        _named(rng, "div", "advert ad ads sponsored promo banner", f"<p>{say(14)}</p>", 1),
    ]


def _behind(rng: random.Random) -> list[str]:
    say = lambda n: _text(rng, rng.randint(3, n))
    remark = lambda: _text(rng, rng.choice([5, 12, 30, 80]))
    title = rng.choice(["Comments", "Reader comments", "3 comments", "Leave a comment", "Responses", "Discussion", "What readers say"])
    kind = rng.choice(["div", "article", "li"])
    remarks = "".join(_named(rng, kind, "comment reply response", f"<p>{remark()}</p>") for _ in range(rng.randint(1, 5)))
    remarks = f"<ul>{remarks}</ul>" if kind == "li" else remarks
    plain = "".join(f"<p>{remark()}</p>" for _ in range(rng.randint(1, 4)))
    heading = rng.choice(["h2", "h3", "h4"])
    more = rng.choice(["Related", "Related articles", "Most read", "More stories", "Read next", "Recent posts", "Popular", "Archive", "Categories"])
    return [
        _named(rng, rng.choice(["section", "div"]), "comments discussion comment-list", f"<{heading}>{title}</{heading}>{rng.choice([remarks, plain])}"),
        _named(rng, "section", "comments responses", remarks, 1),
        _named(rng, "aside", "sidebar related widget", f"<{heading}>{more}</{heading}><ul>{_links(rng)}</ul>"),
        _named(rng, "aside", "sidebar widget", f"<p>{say(16)}</p>"),
        _named(rng, "div", "related sidebar recommended widget", f"<{heading}>{more}</{heading}><ul>{_links(rng)}</ul>"),
        _named(rng, "form", "newsletter subscribe search contact", f"<{heading}>{rng.choice(['Subscribe', 'Newsletter', 'Sign up', 'Search', 'Contact'])}</{heading}><label>{say(4)}</label><p>{say(9)}</p><button>Go</button>"),
        _named(rng, "div", "share social tags pagination", f"<ul>{_links(rng)}</ul>", 0.9),
        _named(rng, "div", "legal copyright disclaimer footer popup modal", f"<p>{say(14)}</p>", 1),
    ]


def written_pages(n: int, seed: int = 5) -> tuple[str, ...]:
    """``n`` labelled pages written by rules: whole pages and fragments, with and without names that tell what is what."""
    rng, pages = random.Random(seed), []
    for k in range(n):
        inner = _article(rng)
        body = rng.choice([
            f'<article data-content="1">{inner}</article>', f'<main data-content="1">{inner}</main>',
            f'<main data-content="1"><article>{inner}</article></main>', f'<div class="{rng.choice(["content", "post", "entry", "story", "article"])}" data-content="1">{inner}</div>',
            f'<div data-content="1">{inner}</div>', f'<div id="content"><article data-content="1">{inner}</article></div>',
        ])
        if k % 6 == 0:
            # a fragment, or text without any element, or in the body alone
            alone = _text(rng, rng.choice([3, 30, 300]))
            pages.append(body if k % 12 else rng.choice([alone, f"<html><body data-content='1'>{alone}</body></html>"]))
            continue
        before = rng.sample(_before(rng), rng.randint(0, 3))
        behind = rng.sample(_behind(rng), rng.randint(0, 4))
        end = [_named(rng, "footer", "footer site-footer", f"<p>{_text(rng, 8)}</p><ul>{_links(rng)}</ul>")] if rng.random() < 0.7 else []
        page = "\n".join([*before, body, *behind, *end])
        if k % 6 == 1:
            pages.append(page)
        elif k % 6 == 3:
            pages.append(f"<html><body><form method='post' id='main-form'>{page}</form></body></html>")  # a form around a whole page
        elif k % 6 == 2:
            pages.append(f"<html><head><title>{_text(rng, 3)}</title></head><body><div class='wrapper'>{page}</div></body></html>")
        else:
            pages.append(f"<!DOCTYPE html><html><head><title>{_text(rng, 3)}</title></head><body>{page}</body></html>")
    return tuple(pages)
