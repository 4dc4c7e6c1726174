import html as htmllib
import random
import re
import time

from wardflow.llm import htmltext

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><header>Site name</header><nav><ul><li><a href="/a">menu one</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<article><h1>Head &eacute;</h1><p>First <b>bo</b>ld&nbsp; text<br>next&#33;</p><!-- c --><div class="ad">buy now</div>
<p>Second a<i>b</i>c &amp</p><form>name <input> <button>send</button></form><ul><li>item</li></ul>
<section class="comments"><p>I agree so much with this article, thank you.</p></section></article>
<aside>related things</aside><footer>&copy; us</footer></body></html>"""


def test_hand_marked_page():
    w = htmltext.fit([])
    assert htmltext.extract(PAGE, w) == "Head é First bold text next! Second abc & item"
    # learned from pages that mark themselves: the same
    assert htmltext.extract(PAGE, htmltext.fit([PAGE] * 20)) == "Head é First bold text next! Second abc & item"


def test_odd_pages():
    w = htmltext.fit([])
    for page in (None, "", "   ", "<script>var a='<p>x</p>'", "<!-- only", "<nav>menu</nav>", "<"):
        assert htmltext.extract(page, w) in ("", "<")
    assert htmltext.extract("<p>a<p>b", w) == "a b"
    assert htmltext.extract("plain &lt;b&gt; text", w) == "plain <b> text"
    assert htmltext.extract('<p title="x>y">in</p><a href=\'>\'>link</a>', w) == "in link"
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    assert htmltext.extract(long, w) == " ".join(["word"] * 20_000)


def test_query_against_the_marked_articles(spark, sf_small):
    blocks = "|".join(htmltext.BLOCKS)

    def truth(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        parts = re.split(rf"</?(?:{blocks})\b[^>]*>", inner)
        texts = [" ".join(htmllib.unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split()) for p in parts]
        return " ".join(t for t in texts if t)
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    for r in htmltext.op5_htmltext(spark, sf_small).collect():
        assert r["text"] == truth(pages.pop(r["page_id"])) and r["n_chars"] == len(r["text"])
    assert not pages


def test_odd_rows(spark):
    rows = [(1, None, None, "c"), (None, "u", PAGE, "c"), (None, "u", PAGE, "c"), (3, "u", "", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.main_text(df, htmltext.train(df)).collect()
    assert sorted(r["text"] for r in got)[:2] == ["", ""] and len(got) == 4
    assert htmltext.main_text(df.limit(0), htmltext.train(df.limit(0))).count() == 0


BODY = ("The old mill stood by the river for two hundred years. People came from far to see its wheel turn, "
        "and children played on the stones below.")


def test_class_words_of_wrappers_condemn_no_article():
    w = htmltext.fit([])
    wraps = [f'<html class="no-js has-sidebar"><body class="has-sidebar">@{BODY}@</body></html>',
             f'<body class="has-sidebar"><nav>menu</nav>@{BODY}@<footer>us</footer></body>',
             f'<div class="layout sidebar-right"><div>@{BODY}@</div><div class="sidebar">related things to read</div></div>',
             f'<div class="layout sidebar-right"><main class="with-comments">@{BODY}@</main></div>']
    for page in wraps:
        assert htmltext.extract(page.replace("@", "<article>", 1).replace("@", "</article>"), w) == BODY, page
        assert htmltext.extract(page.replace("@", '<article class="post legal">', 1).replace("@", "</article>"), w) == BODY, page
        assert htmltext.extract(page.replace("@", "<p>", 1).replace("@", "</p>"), w) == BODY, page
    # nor is a labelled page of that kind taken for boilerplate
    page = f'<body class="has-sidebar"><div class="menu-left"><article class="legal"><div class="lead">{BODY}</div></article></div></body>'
    learned = htmltext.fit([page] * 20)
    assert learned.words["lead"] > 0 and htmltext.extract(page, learned) == BODY


def test_boilerplate_beside_and_in_the_article_stays_out():
    w = htmltext.fit([])
    said = "I agree so much with this article, thank you for it, and do write more."
    for inner in (f'<section class="comments"><article class="comment"><div class="content">{said}</div></article></section>',
                  f'<div class="comment-list"><div class="content">{said}</div></div>', f'<div class="ad slot top right">{said}</div>',
                  f'<article class="comment">{said}</article>', f'<footer><div class="content">{said}</div></footer>'):
        assert htmltext.extract(f'<body class="has-sidebar"><article><p>{BODY}</p>{inner}</article></body>', w) == BODY, inner
        assert htmltext.extract(f'<body><div class="with-menu"><article><p>{BODY}</p></article>{inner}</div></body>', w) == BODY, inner


def test_a_class_word_needs_evidence():
    page = f'<body><p class="lead">two words</p><article><p>{BODY}</p></article></body>'
    other = f'<body><article><div class="lead">{BODY}</div></article></body>'
    assert htmltext.extract(other, htmltext.fit([page])) == BODY
    assert htmltext.extract(other, htmltext.fit([page] * 4)) == BODY
    # many pages that show a word outside only
    strip = f'<body><div class="strip">{"buy one now " * 10}</div><article><p>{BODY}</p></article></body>'
    inner = f'<body><article><p>{BODY}</p><div class="strip">buy one now</div></article></body>'
    assert htmltext.extract(inner, htmltext.fit([strip] * 20)) == BODY


def test_deep_and_open_elements():
    w = htmltext.fit([])
    page = "<div>" * 50_000 + f'<form class="menu"><div class="sidebar"><article>{BODY}</article></div></form>' + "</div>" * 20
    assert htmltext.extract(page, w) == BODY
    assert htmltext.extract(f'<nav><ul><li>menu<div class="sidebar"><article>{BODY}</article></div>', w) == BODY


def test_reader_comments_are_no_main_text_without_an_article():
    said = " ".join(f"<p>I agree so much with this number {i}, thank you for it, and do write more.</p>" for i in range(12))
    for w in (htmltext.fit([]), htmltext.fit([PAGE] * 20)):
        page = f'<body><div id=main><h1>Title</h1><p>{BODY}</p></div><div class="comments">{said}</div></body>'
        assert htmltext.extract(page, w) == f"Title {BODY}"
        page = f'<body><div id="text"><h1>Title</h1><p>Few words.</p></div><div class="comments">{said}</div></body>'
        assert htmltext.extract(page, w) == "Title Few words."
        page = f'<body><div class="page with-comments"><p>{BODY}</p></div><div class="comment-list">{said}</div></body>'
        assert htmltext.extract(page, w) == BODY


def test_text_behind_a_long_list_of_links_is_kept():
    links = "<ul>" + "".join(f'<li><a href="/{i}">link</a></li>' for i in range(40)) + "</ul>"
    first, second = BODY[:70].rsplit(" ", 1)[0], BODY[70:].split(" ", 1)[1]
    for w in (htmltext.fit([]), htmltext.fit([PAGE] * 20)):
        for around in ("<body>@</body>", '<body><div id="page">@</div></body>'):
            got = htmltext.extract(around.replace("@", f"<p>{first}</p>{links}<p class='last'>{second}</p>"), w)
            assert got.startswith(first) and got.endswith(second)
        # another element's text is not joined
        page = f"<body><div><p>{BODY}</p></div><div>{links}</div><div><p>{first}</p></div></body>"
        assert htmltext.extract(page, w) == BODY or "link" in htmltext.extract(page, w)


def test_time_is_linear_in_open_elements():
    w = htmltext.fit([PAGE] * 20)
    for start in ('<div class="box">', "<nav><div>", '<div class="a"></nav>', "<nav><article><div>", "<p>word<div class='sidebar'>"):
        begin = time.process_time()
        htmltext.extract(start * 100_000 + f"<article>{BODY}</article>", w)
        assert time.process_time() - begin < 12, start
    page = '<div class="box">' * 100_000 + f"<article>{BODY}</article>"
    assert htmltext.extract(page, w) == BODY


def test_stretches_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        scores = [rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randint(0, 14))]

        def best(lo, hi):  # the highest-scoring stretch, the shortest and then the first of equals; then the same beside it
            of = [(-sum(scores[i:j]), j - i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)]
            if not of or min(of)[0] >= 0:
                return []
            score, _, i, j = min(of)
            return [*best(lo, i), (-score, i, j), *best(j, hi)]
        assert htmltext.stretches(scores) == best(0, len(scores))
