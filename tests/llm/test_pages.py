"""HTML extraction against a plain version and hand-made pages."""

import html
import re

import pytest

from lakeledger.llm import html_text
from lakeledger.llm.queries import QUERIES
from tests.llm import helpers as h


def plain(page):
    """The article of the given pages, whose markup is simple."""
    body = page[page.index("<article>") : page.index("</article>")]
    parts = re.split(r"</?(?:p|h1|article|div)\b[^>]*>", body)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in parts]
    return "\n".join(x for x in parts if x)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query(spark, sf):
    want = {i: (u, plain(p)) for i, u, p in h.rows_of("pages", "page_id, url, html", sf)}
    rows = QUERIES["op7_html_extraction"](spark, sf).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def text_of(page):
    return html_text.extract(html_text.parse(page), set())


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""), ("<", "<"), ("a <b>c</b>&amp;&#233;&nbsp; d", "a c&é d"), ("<p>a<p>b</div>c", "a\nbc"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a\nb\n1\n2"), ("<script>x='<p>y'</script>z", "z"),
        ("<nav>n</nav><article><header><h1>T</h1></header><p>x<br>y</p><div id='comments'>c</div><aside>s</aside></article>o", "T\nx y"),
        ("<div class='cookie-notice'>c</div><form>f</form><p hidden>h</p><div class='adage'>t</div>", "t"),
        ("<!-- c --><p>t<!-- <p>d -->u</p><!-- open", "tu"), ("<b>" * 3000 + "deep", "deep"), ("<P CLASS=Sidebar>s</P><P>t", "t"),
    ],
)
def test_markup(page, want):
    assert text_of(page) == want


LONG = "Long words of the main text. " * 5


@pytest.mark.parametrize(
    "page",
    [
        "<div class='content no-sidebar'><nav>n</nav><article>{}</article>o</div>",
        "<div class='post with-comments'><article>{}</article></div>",
        "<div class='wrap sidebar-left'><article>{}</article></div>",
        "<body><form><a>Skip</a><main>{}</main></form></body>",
        "<main><div class='columns widget'><article>{}</article></div></main>",
        "<div>{}</div><aside><article>teaser</article></aside>",
        "<div>{}</div><div class='comments'><article>first</article><article>second</article></div>",
        "<main>{}</main><div class='comments'><article>first</article></div>",
    ],
)
def test_main_text_stays_whole(page):
    assert text_of(page.format(LONG)) == LONG.strip()


def test_template_by_recurrence(spark):
    def page(k, body):
        return f"<html><body><div><p>Welcome to our site</p></div>{body}<table><tr><td>Call us</td></tr></table></body></html>"

    same = "<article><p>the same article everywhere</p></article>"
    rows = [(k, f"http://a.example/{k}", page(k, f"<div><p>Text of page {k}</p></div>"), "x") for k in range(8)]
    rows += [(20 + k, f"https://B.example:80/{k}", page(k, same), "x") for k in range(8)]
    rows += [(40, "http://c.example/", page(1, "<p>alone</p>"), "x"), (41, None, None, "x"), (42, "no url", "", "x"), (0, "http://a.example/0", rows[0][2], "x")]
    rows += [(None, "http://a.example/9", page(9, "<p>nine</p>"), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    found = html_text.extract_pages(df)
    assert found.columns == df.columns
    texts = [(r["page_id"], r["main_text"]) for r in found.collect()]
    want = [(k, f"Text of page {k}") for k in range(8)] + [(20 + k, "the same article everywhere") for k in range(8)]
    want += [(40, "Welcome to our site\nalone\nCall us"), (41, ""), (42, ""), (0, "Text of page 0"), (None, "nine")]
    assert sorted(texts, key=str) == sorted(want, key=str)
    assert html_text.extract_pages(df.where("false")).count() == 0


@pytest.mark.parametrize("most", [0, 10**6])
def test_articles_are_whole(spark, monkeypatch, most):
    """What recurs in articles stays; pages of a host without main elements lose what recurs; clashing columns."""
    monkeypatch.setattr(html_text, "BROADCAST_DIGESTS", most)

    def page(k, body, note="<p>A sentence that closes every article</p>"):
        return f"<html><body><p>Top</p><article><h1>Title</h1><p>{body}</p>{note}</article></body></html>"

    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(k, f"http://a.example/{k}", page(k, words(k))) for k in range(6)]
    # On the same host a page without an article: its top is template by the other pages.
    rows += [(7, "http://a.example/7", f"<body><p>Top</p><div>{words(7)}</div></body>")]
    # What recurs on few pages of a large host, and a repeated id that counts once.
    rows += [(100 + k, f"http://c.example/{k}", f"<div>{words(k)}</div>" + "<div>five of sixty</div>" * (k < 5)) for k in range(60)]
    rows += [(200, "http://d.example/", "<div>said five times by one page</div><div>own</div>")] * 5
    rows += [(300, "http://e.example/", "<p>" + "long page " * 200_000 + "</p>")]
    clash = ["id", "host", "held_id", "held_digests", "told", "digest", "kept", "page_key"]
    df = spark.createDataFrame([(*r, *clash) for r in rows], "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in clash))
    found = html_text.extract_pages(df)
    assert found.columns == [*df.columns, "main_text"]
    want = {k: f"Title\n{words(k)}\nA sentence that closes every article" for k in range(6)} | {7: words(7)}
    want |= {100 + k: words(k) for k in range(60)} | {200: "said five times by one page\nown"}
    want |= {300: ("long page " * 200_000).strip()}
    assert {r["page_id"]: r["main_text"] for r in found.collect()} == want and found.count() == len(rows)
