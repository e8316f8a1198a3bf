from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import html_text as H


def page(body):
    return f"<html><head><title>t</title></head><body>{body}</body></html>"


def text(body):
    return "\n".join(t for t, _, kind, _ in H.lines(page(body)) if not kind)


def test_dropped_parts():
    body = """<nav><a>Menu</a></nav><header>Top</header><div class="cookie-notice">We use</div><article><header><h1>Title</h1></header><p>One&nbsp;two &amp;
    three<p>Four <b>bold</b>x<br>five<ul><li>a<li>b</ul><div id="comments"><p>nice!</div><form>f</form><aside>s</aside></article><footer>&copy;</footer><script>var a = "</p>";</script><!-- x --><style>p{}</style>"""
    assert H.main_text(H.lines(page(body)), None)[0] == "Title\nOne two & three\nFour boldx five\na\nb"


def test_heads_of_articles_stay():
    assert text('<div class="site-header">x</div><article class="post no-sidebar"><div class="post-header"><h1>T</h1></div><div class="share-bar">s</div><p>a</article>') == "T\na"


def test_names_that_only_hold_such_a_word_stay():
    own = lambda body: H.main_text(H.lines(page(body)), None)[0]
    assert own('<article><div class="entry-content no-sidebar"><p>text</p></div></article>') == "text"
    assert own('<article><h2 id="related-work">Related work</h2><p id="share">x</p><div class="alert-history">y</div><div id="share-of-voice">z</div></article>') == "Related work\nx\ny\nz"
    assert own('<article><p>much longer text</p><div class="related-posts">r</div><div class="ad">a</div><div class="comment-list main">c</div></article>') == "much longer text"
    assert own('<div class="widget"><p>all of the text of the page</p></div><p>end</p>') == "all of the text of the page\nend"
    assert own("<article><p>teaser</p></article><div><p>the text of the page is outside of it, and longer</p></div>") == "teaser\nthe text of the page is outside of it, and longer"


def test_template_paths_go():
    menu = lambda own: f"<div><ul><li>Home<li>News<li>{own}</ul></div>"
    a, b = (H.lines(page(menu(x) + f"<div><p>text {x}</p></div><div><div>Imprint</div></div>")) for x in ("one", "two"))
    assert H.main_text(a, b) == ("text one", 4) or H.main_text(a, b)[0] == "text one"


def test_malformed():
    assert text("<p>a<p>b</div></p>c") == "a\nb\nc"
    assert text("a < b and c > d") == "a < b and c > d"
    assert text('<p title="a>b">x</p><foo') == "x"
    assert text("<div hidden>no</div><p>yes") == "yes"
    assert text("<script>a") == "" and text("<!-- a") == ""
    assert text("<table><tr><td>u<td>v<tr><td>w</table>") == "u v\nw"


def lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            n[i + 1][j + 1] = n[i][j] + 1 if a[i] == b[j] else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_shared_is_a_longest_common_subsequence(a, b):
    got = sorted(H.shared(a, b))
    assert len(got) == lcs(a, b)
    rest = iter(b)
    assert all(a[i] in rest for i in got)
    halved = sorted(H._halved(a, b, 0))
    rest = iter(b)
    assert len(halved) == len(got) and all(a[i] in rest for i in halved)


def test_many_equal_lines_end():
    a = ["x", "y"] * 20_000
    assert len(H.shared(["p", *a, "q"], ["r", *a[1:], "s"])) >= 39_000


ROWS = [(1, "http://h.x/a/1", page("<p>Menu line<p>text one<p>Bottom")), (2, "http://h.x/a/2", page("<p>Menu line<p>text two<p>Bottom")), (3, "http://h.x/b", page("<p>Menu line<article><p>article stays<p>Bottom</article>")),
        (4, "http://other.x/a", page("<p>alone")), (5, "http://h.x/a/2", page("<p>Menu line<p>text two<p>Bottom")), (6, None, None), (None, "", ""), (7, "http://h.x/a/1?q#f", page("x" * 200_000))]


def test_differencing(spark):
    df = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, lines string")
    got = {r.page_id: r for r in H.extract(df).collect()}
    assert len(got) == 8
    assert got[3].text == "article stays\nBottom" and got[4].text == "alone" and got[6].text == "" and got[None].text == ""
    assert got[2].text == got[5].text == "Menu line\ntext two\nBottom"  # copies of each other: nothing to tell apart
    assert got[1].text == "text one" or got[1].n_shared == 0
    assert got[7].n_chars == 200_000
    assert H.extract(df.limit(0)).count() == 0


def test_buckets_do_not_change_pairs(spark):
    rows = [(i, f"http://h{i % 3}.x/p/{i:05d}", page(f"<p>Same top<p>own {i}<p>Same end")) for i in range(1500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in H.extract(df).collect()} == {f"own {i}" for i in range(1500)}


def test_query_is_that_of_brute_force(spark):
    """All pages sorted, each beside the nearer of its neighbours on its host, by plain loops; repeated rows too."""
    import random

    rnd = random.Random(4)
    rows = [(i, f"http://h{rnd.randrange(3)}.x/{rnd.choice('abc')}/{rnd.randrange(40):02d}", page("".join(f"<div><p>{rnd.choice(['Top', 'Menu', 'Tail'])}{k}</p></div>" for k in range(rnd.randrange(4))) + f"<p>own {i}</p>" + rnd.choice(["", "<article><p>art</p></article>"]))) for i in range(150)]
    rows += rows[:5] + [(900, None, None), (901, "http://h1.x/a", None)]
    rows.sort(key=lambda r: ("\x01".join([(r[1] or "").split("/")[2] if r[1] else "", "/" + (r[1] or "").split("/", 3)[-1] if r[1] else "", r[1] or "", f"{r[0]:020d}"])))
    host = lambda r: (r[1] or "").split("/")[2] if r[1] else ""
    path = lambda r: "/" + r[1].split("/", 3)[-1] if r[1] else ""
    want = []
    for i, r in enumerate(rows):
        near = [x for x in (rows[i + 1] if i + 1 < len(rows) else None, rows[i - 1] if i else None) if x and host(x) == host(r)]
        near.sort(key=lambda x: -next((k for k, (a, b) in enumerate(zip(path(x), path(r))) if a != b), min(len(path(x)), len(path(r)))))
        want.append((r[0], H.main_text(H.lines(r[2] or ""), H.lines(near[0][2] or "") if near else None)))
    got = [(r.page_id, (r.text, r.n_shared)) for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()]
    assert sorted(got) == sorted(want) and sum(n for _, (_, n) in want) > 40


#: Class names of comments, adverts, forms and menus as sites use them; and names that only hold such a word.
GO = """user-comments reader-comments fb-comments comments-area comment-list comments_wrapper comment-section disqus-thread post-comments article-comments ad-300x250 ad-728x90 ad-leaderboard google-ads dfp-ad ad-slot ad-container
 sidebar-ad adsense advertisement advert-box sponsored-links promo-box banner-ad mpu-ad cookie-law-banner cookie-banner cookie-consent gdpr-notice newsletter-signup-form newsletter-form email-signup mailing-newsletter-box subscribe-form login-form breadcrumb-trail
 breadcrumbs nav-links navbar-top pagination-links related-posts related-stories recommended-articles share-buttons social-icons outbrain taboola-widget sidebar-widget mobile-menu sticky-banner popup-overlay""".split()
STAY = "share-of-voice related-work no-sidebar has-sidebar commentary header-image-caption advanced adaptive social-science cookie-recipe notice-of-motion menu-planning text content entry-content article-body post-text message-body".split()


def test_names_of_templates():
    for name in GO:
        assert H.main_text(H.lines(page(f'<article><p>the text of the page</p><div class="{name}">zzz</div></article>')), None)[0] == "the text of the page", name
    for name in STAY:
        assert H.main_text(H.lines(page(f'<article><p>the text of the page</p><div class="{name}">zzz</div></article>')), None)[0] == "the text of the page\nzzz", name
    assert len(GO) >= 40
