"""Page texts against a brute-force builder, and the part that a host's recurring subtrees play."""

import random

import pytest

from clickloom.llm import html_text

P = "<p>Hello there</p>"
KEPT = [
    '<div class="content has-sidebar"><article>%s</article></div>',
    '<div id="wrapper" class="no-sidebar">%s</div>',
    '<article><section class="widget-guide">%s</section></article>',
    '<article><div class="notice-of-meeting">%s</div></article>',
    '<main><div class="search-results">%s</div></main>',
    '<article><div class="article-header">%s</div></article>',
    '<div class="sponsored-story-card">%s</div>',
    "<article>teaser</article><main>%s</main>",
    "<main>%s</main><article>a longer teaser than the text itself</article>",
    "<article>a</article><article>%s</article><article>b</article>",
    '<div class="sidebar"><article>%s</article></div>',
    "<div>" * 3000 + "%s",
    "<nav>" + "<div>" * 3000 + "x" + "</div>" * 3000 + "</nav>%s",
]
GONE = [
    '<article class="comment">%s</article>',
    "<div hidden>%s</div>",
    '<div style="color:red; display : none">%s</div>',
    '<div aria-hidden="true">%s</div>',
    '<section class="reader-comments">%s</section>',
    '<article>%s</article>'.replace("%s", '<div id="cookie_bar">%s</div>'),
    "<form>" + "<div>" * 3000 + "%s" + "</div>" * 3000 + "</form>",
    "<script>%s</script>",
    *(f'<div class="{c}">%s</div>' for c in ("related-articles", "newsletter-signup", "ad-300x250", "ad-slot-1", "adsbygoogle", "comment-42", "sidebar2", "legal-notice", "site-header", "signup-box", "relatedArticles")),
    *(f'<article><div id="{c}">%s</div></article>' for c in ("related-articles", "ad-slot-1", "comment-42", "sidebar2", "legal-notice")),
]


@pytest.mark.parametrize("page", KEPT)
def test_kept(page):
    assert html_text.main_text(page.replace("%s", P)) == "Hello there"


@pytest.mark.parametrize("page", GONE)
def test_gone(page):
    assert html_text.main_text(page.replace("%s", P)) == ""


def test_white_space_and_references():
    assert html_text.main_text("<p> a&nbsp;\n b &amp;&#x41;<br>c </p><p>&nbsp;</p>d") == "a b &A c\n\nd"


def random_page(rng):
    """(html, blocks): a page built from blocks whose fate is known."""
    word = lambda: rng.choice(["alpha", "beta", "&lt;b&gt;", "caf&eacute;", "delta\n", "<b>bold</b>", "x<br>y"])
    clear = {"&lt;b&gt;": "<b>", "caf&eacute;": "café", "delta\n": "delta", "<b>bold</b>": "bold", "x<br>y": "x y"}
    said = lambda: [word() for _ in range(rng.randint(1, 6))]
    noise = ["<nav><ul><li>%s<li>home</ul></nav>", "<footer>%s</footer>", '<div class="ad">%s</div>', "<!-- %s -->", "<script>var a = '<p>%s</p>'</script>", '<aside><p>%s</aside>', "<form>%s</form>", '<ol class="comment-list"><li>%s</ol>']
    out, blocks = [], []
    for _ in range(rng.randint(0, 8)):
        w = said()
        if rng.random() < 0.5:
            out.append(rng.choice(noise) % " ".join(w))
        else:
            out.append(rng.choice(["<p>%s</p>", "<div>%s</div>", "<section><h2>%s</h2></section>", "<ul><li>%s</ul>", "<blockquote><p>%s</blockquote>"]) % " ".join(w))
            blocks.append(" ".join(clear.get(x, x) for x in w))
    around = rng.choice(["%s", "<html><body>%s</body></html>", "<body><header>top</header><article>%s</article><p>outside", '<div class="sidebar-wrapper"><main>%s</main></div>'])
    return around % "".join(out), "\n\n".join(blocks)


def test_random_pages():
    rng = random.Random(5)
    for _ in range(2000):
        html, text = random_page(rng)
        assert html_text.main_text(html) == text, html


def rows_of(pages):
    return [(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(pages)]


def test_recurring_subtrees_decide(spark):
    """Pages without tags or classes that tell: only recurrence on the host can."""
    rng = random.Random(6)
    side, notice = "<div><ul><li>Home<li>News</ul></div>", "<div><p>We moved to a new office.</p></div>"
    pages, texts = [], []
    for i in range(40):
        own = [f"text {rng.random()} of page {i}" for _ in range(3)]
        inner = f"<p>{own[0]}</p>{notice if i % 3 == 0 else ''}<p>{own[1]}</p>"
        body = f"<article>{inner}</article>{side}" if i % 2 else f"{side}<div>{inner}<p>{own[2]}</p></div>"
        pages.append(("a.org", f"<body>{body}</body>"))
        texts.append("\n\n".join(own[: 2 if i % 2 else 3]))
    pages += [("b.org", f"<body>{side}<p>alone</p></body>")] + [("c.org", f"<body>{side}<p>copy</p></body>")] * 30
    texts += ["Home\n\nNews\n\nalone"] + ["Home\n\nNews\n\ncopy"] * 30  # one page, or copies of one, show no recurrence
    df = spark.createDataFrame(rows_of(pages), "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert [got[i] for i in range(len(texts))] == texts
    joined = {r.page_id: r.text for r in html_text.extract(df, most_broadcast=0).collect()}
    assert joined == got
    hashes = {r.host: set(r.hashes) for r in html_text.templates(df).collect()}
    counted = {}
    for host, html in set(pages):
        for h in set(html_text.subtree_hashes(html_text.parse(html))[1].values()):
            counted[host, h] = counted.get((host, h), 0) + 1
    distinct = {host: len({html for h, html in set(pages) if h == host}) for host in ("a.org", "b.org", "c.org")}
    brute = {}
    for (host, h), n in counted.items():
        if n >= 5 and n >= 0.1 * distinct[host]:
            brute.setdefault(host, set()).add(h)
    assert hashes == brute and set(brute) == {"a.org"}


def test_several_parts_of_one_text_stay():
    assert html_text.main_text("<article><p>one part</p></article><article><p>another</p></article><article>x</article>") == "one part\n\nanother"


def test_boxes_with_other_words_on_each_page_go_where_they_recur(spark):
    """The method decides: a name that is marked in part alone stays on one page and goes where its place recurs, whatever its words."""
    rng = random.Random(9)
    pages, texts = [], []
    for i in range(30):
        box = f'<div class="sponsored-story-card n{i}"><p>buy {rng.random()}</p></div>'
        pages.append(("a.org", f"<body><article><p>text {i}</p>{box}<p>more {i}</p></article></body>"))
        texts.append(f"text {i}\n\nmore {i}")
    pages += [("b.org", '<body><article><p>alone</p><div class="sponsored-story-card"><p>kept here</p></div></article></body>')]
    texts += ["alone\n\nkept here"]
    pages += [("c.org", f'<body><article><p class="social-history">part {i} {rng.random()}</p></article></body>') for i in range(20)]
    texts += [html_text.main_text(html) for host, html in pages if host == "c.org"]  # pieces of a text never are boxes
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows_of(pages), "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(len(texts))] == texts
    assert all(html_text.main_text(html) != text for (host, html), text in zip(pages, texts) if host == "a.org")  # tags and names alone leave the box
