"""Labelled pages from which the block model of ``html_extract`` is trained.

``data-content="1"`` marks an element and what it holds as main text, ``"0"`` as the rest of
the page, until an inner mark says otherwise. The pages are written for this purpose; ``T``,
``S`` and ``L`` stand for a paragraph, a short text and a list of links.
"""

T = ("The long paragraph of an article tells what happened, where it happened and why it matters, in "
     "whole sentences with commas, numbers such as 1914, and now and then a <a href='/x'>link</a> to more. "
     "It goes on for some lines, as the text of articles does, and it ends with a full stop.")
M = "A paragraph of middle length, with one or two sentences in it. This is the second one."
S = "Short words."
L = "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(6))
CARDS = "".join(f"<div class='card'><a href='/{i}'>Another story to read, number {i}</a></div>" for i in range(4))

PAGES = [
    f"""<html><body data-content="0"><nav><ul>{L}</ul></nav><div class="ad">{M}</div>
    <article data-content="1"><h1>{S}</h1><p>{T}</p><p>{S}</p><p>{T}</p><p>{M}</p><p>{S}</p></article>
    <footer>&copy; example.org. {M}</footer></body></html>""",
    f"""<html><body data-content="0"><header><h1>{S}</h1><nav>{L}</nav></header><main data-content="1">
    <h2>{S}</h2><p>{T}</p><ul><li>{M}</li><li>{S}</li><li>{T}</li></ul><blockquote>{M}</blockquote><p>{S}</p>
    <div class="ad" data-content="0">{S}</div><p>{T}</p></main><aside class="sidebar"><h3>{S}</h3><p>{M}</p>
    <ul>{L}</ul></aside><footer><p>{M}</p><ul>{L}</ul></footer></body></html>""",
    f"""<html><body data-content="0"><div id="header"><a href="/">Home</a></div><div id="menu"><ul>{L}</ul></div>
    <div id="content" data-content="1"><h1>{S}</h1><div class="post"><p>{T}</p><p>{T}</p><p>{M}</p></div>
    <div class="share social" data-content="0"><a href="#">Share</a> <a href="#">Like</a></div></div>
    <div id="comments"><h3>3 comments</h3><div class="comment"><p>{T}</p></div><div class="comment"><p>{M}</p></div>
    <ol><li><p>{M}</p></li><li><p>{S}</p></li></ol></div>
    <div id="footer"><p>{S}</p></div></body></html>""",
    f"""<html><body data-content="0"><div class="cookie-notice banner"><p>{M}</p><button>OK</button></div>
    <div class="wrapper"><div class="breadcrumb"><a href="/">Home</a> / <a href="/n">News</a></div>
    <div class="article-body entry" data-content="1"><h1>{S}</h1><p>{T}</p><h2>{S}</h2><p>{T}</p>
    <table><tr><td>{S}</td><td>{M}</td></tr><tr><td>1</td><td>2</td></tr></table><pre>{M}</pre><p>{T}</p></div>
    <div class="related"><h3>Read more</h3>{CARDS}</div><form class="newsletter"><p>{M}</p><label>Mail</label></form>
    </div><footer><div>{M}</div></footer></body></html>""",
    f"""<html><body data-content="0"><header><div class="logo">{S}</div></header><section class="promo"><h2>{S}</h2>
    <p>{M}</p></section><article data-content="1"><header><h1>{S}</h1></header><section><p>{T}</p><p>{M}</p>
    </section><section><h2>{S}</h2><p>{T}</p><figure><figcaption>{M}</figcaption></figure><p>{S}</p></section>
    <aside data-content="0"><p>{M}</p></aside><footer data-content="0"><p>{S}</p></footer>
    <section class="comments" data-content="0"><h2>{S}</h2><article><p>{T}</p></article><article><p>{M}</p></article>
    </section></article><footer><p>{M}</p></footer></body></html>""",
    f"""<html><body data-content="0"><form action="/search"><input><label>{S}</label><p>{S}</p></form>
    <table class="layout"><tr><td class="menu"><a href="/1">One</a><br><a href="/2">Two</a></td>
    <td class="content text" data-content="1"><h1>{S}</h1><p>{T}</p><p>{T}</p><dl><dt>{S}</dt><dd>{M}</dd></dl></td>
    <td class="sponsored"><p>{M}</p></td></tr></table><div class="copyright">{M}</div></body></html>""",
    f"""<html><body data-content="0"><nav class="navbar"><div>{S}</div><ul>{L}</ul></nav><div class="alert notice">{T}</div>
    <div class="story" data-content="1"><p>{T}</p><p>{T}</p><p>{M}</p><div class="advert" data-content="0"><p>{M}</p></div>
    <p>{T}</p></div><div class="sidebar widget"><p>{T}</p><ul>{L}</ul></div><div class="subscribe popup"><p>{M}</p></div>
    <div class="disqus discussion"><div class="reply"><p>{T}</p></div><div class="reply"><p>{S}</p></div></div>
    <div class="legal terms">{T}</div></body></html>""",
    f"""<html><body data-content="1"><h1>{S}</h1><p>{T}</p><p>{M}</p><p>{T}</p><p>{S}</p><ul><li>{M}</li></ul><p>{T}</p>
    <div data-content="0"><ul>{L}</ul></div></body></html>""",
    f"""<html><body data-content="0"><header>{S}<nav>{L}</nav></header><article data-content="1"><h1>{S}</h1><p>{S}</p>
    <p>{M}</p></article><aside>{CARDS}</aside><footer>{S}</footer></body></html>""",
    f"""<html><body data-content="0"><div class="page"><div class="main" data-content="1"><div><p>{T}</p></div><div><p>{T}</p>
    </div><div><h3>{S}</h3><p>{M}</p></div></div><div class="tags"><a href="/t">tag</a></div><div class="author-bio">
    <p>{M}</p></div><div class="pagination"><a href="/2">Next</a></div></div></body></html>""",
]
