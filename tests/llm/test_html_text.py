import random

from sensorfold.llm.op9_html_text import LEAST_PAGES, main_text

SHAPE = "page_id bigint, url string, html string"
PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
    "<nav><ul><li><a href='/x'>menu</a></li></ul></nav><!-- ad --><div class=\"ad\">buy</div>"
    "<article><h1>Head &amp; tail</h1><p><b>First.<br><p>Second\n  line &eacute;&#233;.</p>"
    "<form><button>Send</button></form><aside>side</aside><div class='comments'><p>me too</p></div><ul><li>one<li>two</ul></article>"
    "<footer>&copy; host</footer>"
)


def texts(spark, rows):
    return {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in main_text(spark.createDataFrame(rows, SHAPE)).collect()}


def test_article(spark):
    got = texts(spark, [(1, "http://h/a", PAGE)])
    want = "Head & tail\n\nFirst.\n\nSecond line éé.\n\none\n\ntwo"
    assert got == {1: ("http://h/a", want, len(want))}


def test_template_of_pages_without_an_article(spark):
    def page(k):
        return (f"<html><body><div id=top>Site name</div><div class=x><p>Always the same words</p></div>"
                f"<div class=content><p>{'alpha ' * (k + 5)}</p><p>Text {k} of its own</p></div><div id=low>Terms of use</div></body></html>")

    rows = [(k, f"https://Host.example/p{k}", page(k)) for k in range(2 * LEAST_PAGES)]
    for k, (_, text, _) in texts(spark, rows).items():
        assert text == ("alpha " * (k + 5)).strip() + f"\n\nText {k} of its own"


def test_constant_text_inside_an_article_stays(spark):
    html = "<html><body><nav>m</nav><article><p>Same everywhere</p></article></body></html>"
    got = texts(spark, [(k, f"http://h/{k}", html) for k in range(10)])
    assert {t for _, t, _ in got.values()} == {"Same everywhere"}


def test_nulls_empties_deep_long_and_broken_pages(spark, crowded):
    deep = "<div>" * 3_000 + "deep down" + "</div>" * 3_000
    rows = [
        (1, None, None), (2, "not a url", ""), (3, "http://h/", deep), (4, "http://i/", "<article><p>" + "long " * 40_000),
        (5, "http://j/", "</p></b><<>< plain & text &unknown; &#0;"), (6, "http://k/", "<article><p>x</article></article><p>y"),
        (6, "http://k/", "<article><p>x"), (None, "http://l/", "<article>z"), (7, "http://m/", "<!-- never closed <p>x"),
    ]
    df = crowded(spark.createDataFrame(rows, SHAPE))
    got = main_text(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[7] == "" and by[3] == "deep down" and by[None] == "z" and by[6] == "x"
    assert len(by[4]) == 5 * 40_000 - 1 and by[5].endswith("plain & text &unknown; �")
    assert main_text(spark.createDataFrame([], SHAPE)).count() == 0


LOST = [
    ('<body class="has-sidebar"><article><p>All of it</p></article></body>', "All of it"),
    ('<article class="post comments-open"><h1>Title</h1><p>All of it</p></article>', "Title\n\nAll of it"),
    ("<body><form><div><article><p>In a form</p><button>Send</button></article></div></form></body>", "In a form"),
    ("<body><form><p>Most of the page stands here</p><input></form><p>rest</p></body>", "Most of the page stands here"),
    ('<article><p>See <a class="related">this page</a> for more</p></article>', "See this page for more"),
    ('<article><h2 class="banner-title">Flags</h2><p class="notice-period">Two weeks</p></article>', "Flags\n\nTwo weeks"),
    ("<article><p>As <math><mi>x</mi><mo>=</mo><mn>1</mn></math> shows</p></article>", "As x=1 shows"),
    ('<article><p>Text <span class="social">media</span></p><div class="social-share">Share it</div></article>', "Text media"),
    ('<article><p>Body of the text</p><p class="notice">We use cookies</p><div class="comments"><p>me too</p></div></article>', "Body of the text"),
    ('<article><p>Body of the text</p><form><p>Your mail</p><input></form></article>', "Body of the text"),
    ('<main><div class="widget-area"><article><p>Kept</p></article><div class="ad">buy</div></div></main>', "Kept"),
]


def test_words_are_hints_only(spark):
    got = texts(spark, [(k, f"http://h{k}/", html) for k, (html, _) in enumerate(LOST)])
    assert {k: text for k, (_, text, _) in got.items()} == {k: text for k, (_, text) in enumerate(LOST)}


def brute_text(main, template):
    """What a page built from known blocks should give."""
    return "\n\n".join(t for t in main if t not in template)


def test_planted_pages_against_known_text(spark):
    """Pages built from known parts: what is no boilerplate and no template, in page order."""
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta été größe ñu".split()) for _ in range(n))
    rows, want = [], {}
    for host in range(6):
        fixed = [f"Read more of host {host}", f"All rights of host {host}"]
        wrap, inner = rng.choice([("article", ""), ("main", ""), ("div", ' class="story"')]), rng.randint(0, 3)
        for k in range(3 * LEAST_PAGES):
            main = [f"{words(rng.randint(20, 60))} {host} {k} {j}" for j in range(rng.randint(2, 5))]
            mixed = [*main[:1], fixed[0], *main[1:], fixed[1]]
            body = "".join(f"<p class=c{rng.randint(0, 1)}>{t}</p>" for t in mixed)
            noise = f'<nav>{words(4)}</nav><div class="sidebar-{host}">{words(5)}</div><script>{words(3)}</script>'
            rows.append((100 * host + k, f"http://host{host}/{k}", f"<html><body>{noise}" + "<div>" * inner + f"<{wrap[0]}{wrap[1]}>{body}</{wrap[0]}>"
                         + "</div>" * inner + f"<footer>{words(4)}</footer></body></html>"))
            want[100 * host + k] = brute_text(mixed, fixed)
    for order in (rows, rows[::-1]):
        assert {k: text for k, (_, text, _) in texts(spark, order).items()} == want


def test_template_and_teasers_of_pages_with_an_article(spark):
    def page(k):
        return (f"<html><body><article class=teaser><p>Teaser {k}</p></article><article class=story><h1>Title {k}</h1>"
                f"<div class=x>Read it in our app</div><p>{'words ' * (30 + k)}<b>Note:</b> own {k}</p></article></body></html>")

    rows = [(k, f"http://h/{k}", page(k)) for k in range(2 * LEAST_PAGES)]
    for k, (_, text, _) in texts(spark, rows).items():
        assert text == f"Title {k}\n\n{'words ' * (30 + k)}Note: own {k}"
    # equal copies are one page, also where scripts or attributes differ
    few = [(k, f"http://h/{k}", f"<article id=a{k}><script>{k}</script><p>Read it in our app</p></article>") for k in range(10)]
    assert {t for _, t, _ in texts(spark, few).values()} == {"Read it in our app"}


def test_more_kinds_of_siblings_and_levels_than_any_bound(spark):
    def page(k):
        own = "".join(f"<div id=post-{k}-{j}><p>Post {k} {j}</p><p>Thanks for reading</p></div>" for j in range(30))
        return f"<html><body>{own}<div class=low>Terms of use</div></body></html>"

    rows = [(k, f"http://h/{k}", page(k)) for k in range(2 * LEAST_PAGES)]
    got = [texts(spark, r) for r in (rows, rows[::-1])]
    assert got[0] == got[1]
    for k, (_, text, _) in got[0].items():
        assert text == "\n\n".join(f"Post {k} {j}" for j in range(30))

    def deep(k):
        kinds = "".join(f"<div class=k{j}></div>" for j in range(60))
        return (f"<html><body><div class=by>By writer {k}</div>{kinds}" + "<div>" * 40
                + f"<article id=slug{chr(97 + k)}><p>{'alpha ' * (k + 5)}</p></article>" + "</div>" * 40)

    rows = [(k, f"http://i/{k}", deep(k)) for k in range(2 * LEAST_PAGES)]
    for k, (_, text, _) in texts(spark, rows).items():
        assert text == ("alpha " * (k + 5)).strip()
