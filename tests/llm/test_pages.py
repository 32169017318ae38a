"""Archives, page text and the URL filter."""

from __future__ import annotations

import hashlib
import random

import pytest

from msgloom.llm import html_text, url_filter, warc
from msgloom.session import shared_dir

BIG = "<p>" + "payload " * 30
PAGES = [
    (3, "https://a.example.com/x?q=1#top", BIG), (1, "https://a.example.com/x", BIG), (2, None, BIG),
    (4, "http://b.example.org/", "short"), (5, "http://b.example.org/\r\nX-Page-ID: 9", "short"),
    (6, "ftp://c%0A/", None), (7, "", ""), (8, "no address", "x\r\n\r\nWARC/1.1\r\n" * 20), (None, "https://a.example.com/x", BIG),
    (9, "https://É.example/", "é" * 50), (10, "https://a.example.com/x", "é" * 50), (11, "u", "y" * 99),
    (12, "u", "y" * 99), (13, "u", "z" * 100), (13, "u", "z" * 100), (14, "long", "w" * 3_000_000),
]


def test_archives_round_trip(spark):
    docs = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, digest string, n int")
    folder = shared_dir(spark, "warc-test")
    archives = warc.write_archives(docs.repartition(4), folder)
    captures = warc.merge_captures(warc.read_archives(archives), rows_per_task=4)
    rows = captures.collect()
    order = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in rows]
    assert order == sorted(order) and len(rows) == len(PAGES)
    first = {}
    for page, _, html in PAGES:
        data = (html or "").encode()
        if page is not None and len(data) >= 100:
            first[data] = min(page, first.get(data, page))
    want = []
    for page, url, html in PAGES:
        data = (html or "").encode()
        refers = first.get(data)
        refers = None if refers == page else refers
        want.append((page, url, len(data), hashlib.sha256(data).hexdigest(),
                     "response" if refers is None else "revisit", refers))
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in rows:
        found = warc.read_record(r.archive, r.offset, r.length)
        payload = next((h or "").encode() for p, u, h in PAGES if (p, u) == (r.page_id, r.url))
        assert found["payload"] == (payload if r.record_type == "response" else b"")
    assert warc.round_trip(docs.limit(0)).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(50),) for _ in range(rng.choice([0, 1, 30]))) for _ in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"),
    ("<title>t</title><p>One <b>bold</b>, <i>it</i>alic<p>Two<div>Three</div>four", "One bold, italic\n\nTwo\n\nThree\nfour"),
    ("<p>a<script>x<y</script>b<!-- c --><style>p{}</style></p>", "ab"),
    ("<div hidden>no</div><div style='color:red; DISPLAY : none'>no</div><p>yes", "yes"),
    ("<h1>Head</h1><ul><li>one<li>two<ol start=3><li>x</li><li value=7>y</ol><li>three</ul>end",
     "Head\n\n- one\n- two\n\n  3. x\n  7. y\n- three\n\nend"),
    ("<table><tr><th>Name<th>N<tr><td>Ann<td>10<tr><td>Bo B<td>7</table>", "Name  N\nAnn   10\nBo B  7"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>wide cell<tr><td>d<td>e</table>",
     "a  b\n   c\nwide cell\nd  e"),
    ("<table><tr><td>x<td><table><tr><td>in<td>ner</table><td>z</table>", "x  in  ner  z"),
    ("a<br>b<br><br>c", "a\nb\nc"), ("<pre>  two\n    four\n\nend</pre>", "  two\n    four\n\nend"),
    ("&lt;b&gt; &amp; &eacute;&nbsp;x", "<b> & é\xa0x"), ("<p>a</p></div></b>b", "a\n\nb"),
    ("<table>stray<tr>row<td>cell</table>", "stray row\ncell"),
    ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n  d1\n  d2"), ("<blockquote>q</blockquote>", "  q"),
])
def test_page_text(html, text):
    assert html_text.page_text(html) == text


def test_no_text_is_lost_in_deep_or_broken_pages():
    deep = "".join(f"<div>w{i} " for i in range(5000)) + "<ul><li>x<table><tr><td>end"
    words = html_text.page_text(deep).replace("-", " ").split()
    assert words == [f"w{i}" for i in range(5000)] + ["x", "end"]
    rng = random.Random(4)
    tags = ["p", "div", "ul", "li", "table", "tr", "td", "b", "br", "span", "ol", "h2", "dl", "dd", "pre", "select", "option"]
    for _ in range(300):
        page, want = "", []
        for i in range(40):
            tag = rng.choice(tags)
            page += f"</{tag}>" if rng.random() < 0.4 else f"<{tag}>"
            if rng.random() < 0.5:
                page += f" q{i}q "
                want.append(f"q{i}q")
        assert sorted(w for w in html_text.page_text(page).split() if w[0] == "q") == sorted(want), page


def test_extract_rows(spark):
    rows = [(1, "<p>a", "x"), (None, None, "y"), (1, "<p>a", "x")]
    docs = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert sorted(map(tuple, html_text.extract_text(docs).collect()), key=str) == [(1, "a"), (1, "a"), (None, "")]
    assert html_text.extract_text(docs.limit(0)).count() == 0


def verdicts(spark, urls, **settings):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: tuple(r)[1:] for r in url_filter.filter_urls(pages, **settings).collect()}


def test_rules_and_parts_of_urls(spark):
    urls = ["https://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://example.org/en/2", "x://notexample.org/es/",
            "https://b.com/fr/", "https://com/de/x", "https://b.com/es/", None, "", "no scheme", "a://b://c/d",
            "s://h?q://z", "s://h#f", "https://example.org", "https://x.net/" + "a/" * 3000, "s://HÉ.org/"]
    got = verdicts(spark, urls)
    assert [got[i][:3] for i in range(len(urls) - 2)] == [
        ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"),
        ("example.org", "/en/2", "org/"), ("notexample.org", "/es/", "org/"), ("b.com", "/fr/", "com/fr/"),
        ("com", "/de/x", "com/de/"), ("b.com", "/es/", None), ("", "", None), ("", "", None), ("", "", None),
        ("b:", "//c/d", None), ("h", "", None), ("h", "", None), ("example.org", "", None)]
    assert got[15][:3] == ("hÉ.org", "/", "org/")
    rule = {"org/": "allow", "com/fr/": "allow", "com/de/": "block", "example.org/es/": "block", "example.org/en/1": "block"}
    assert all(v[3] == rule[v[2]] if v[2] else v[3] in ("allow", "block") for v in got.values())


def labelled_urls(seed, n):
    rng, out = random.Random(seed), []
    for _ in range(n):
        bad = rng.random() < 0.4
        host = rng.choice(["win-cash", "free-bets"] if bad else ["news", "library", "school"]) + f"{rng.randrange(9)}.example.net"
        path = f"/{rng.randrange(10**8)}-{rng.randrange(10**6)}" if bad else "/" + "/".join(rng.choice(["a", "about", "team"]) for _ in range(3))
        out.append((f"https://{host}{path}" + ("?a=1&b=2&c=3" if bad else ""), float(bad)))
    return out


def test_trees_on_held_out_urls(spark):
    train = spark.createDataFrame(labelled_urls(1, 600), "url string, label double")
    test = labelled_urls(2, 300)
    got = verdicts(spark, [u for u, _ in test], labelled=train, rules=())
    right = sum((got[i][3] == "block") == bool(label) for i, (_, label) in enumerate(test))
    assert right / len(test) > 0.95


def test_labels_of_one_kind_or_none(spark):
    one = spark.createDataFrame([("https://a.net/", 1.0), (None, 0.0)], "url string, label double")
    assert verdicts(spark, ["https://b.net/", "https://b.org/"], labelled=one) == {
        0: ("b.net", "/", None, "block"), 1: ("b.org", "/", "org/", "allow")}
    assert verdicts(spark, ["https://b.net/"])[0][3] == "allow"
    pages = spark.createDataFrame([(1, "u")], "page_id long, url string").limit(0)
    assert url_filter.filter_urls(pages).count() == 0


def test_sample_has_both_labels(spark):
    # One url fills the sample by its rows; blocked ones are rare; both labels must get in.
    rows = [("https://hot.example.net/about", 0.0)] * 400 + [(f"https://n{i}.example.net/team", 0.0) for i in range(60)]
    rows += [(f"https://win-cash.example.net/{i}77-{i}3?a=1&b=2", 1.0) for i in range(6)]
    known = spark.createDataFrame(rows, "url string, label double")
    got = {(r.url, r.label): r.weight for r in url_filter.sample_of(known, 20).collect()}
    assert len(got) == 20 and sum(label for _, label in got) == 6
    for label in (0.0, 1.0):
        whole = sum(x == label for _, x in rows)
        assert abs(sum(w for (_, x), w in got.items() if x == label) - whole) < 1e-6
    everything = {(r.url, r.label): r.weight for r in url_filter.sample_of(known, 1000).collect()}
    assert len(everything) == 67 and everything["https://hot.example.net/about", 0.0] == 400.0
    assert url_filter.sample_of(known.filter("label = 0"), 20) is None
    judged = verdicts(spark, ["https://n99.example.net/team"], labelled=known, rules=(), fit_rows=20)
    assert judged[0][3] == "allow"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>a<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> b</p>", "ax=2 b"),
        ("<map><p>mapped</p></map><svg><title>t</title><desc>d</desc><text>lbl</text></svg>", "mapped\n\nlbl"),
        ("<input type=email value=a@b><input type=search value=q> <input type=number value=3><input type=password value=p>", "a@bq 3"),
        ('<div style="visibility:hidden">no<span style="visibility:visible">yes</span>no</div>', "yes"),
        ('<div style="color:red; Visibility : HIDDEN">no<b>no</b></div>on', "on"),
        ('<div style="display:none">no<span style="display:block">no</span></div>on', "on"),
    ],
)
def test_all_visible_text(html, want):
    assert html_text.page_text(html) == want


def test_visible_words_against_a_walk_over_the_tree():
    """Each word of a random page comes out once if no element around it hides it, else not."""
    rng = random.Random(12)
    plain = ["b", "div", "ul", "section", "svg", "math", "map", "q", "h2", "span"]  # none closes another

    def element(depth, shown, drawn):
        out, words = "", []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if depth > 5 or kind < 0.4:
                word = f"w{rng.randrange(10**9)}"
                out += f" {word} "
                words += [word] if shown and drawn else []
                continue
            style, sees, draws = "", shown, drawn
            if kind < 0.5:
                style, sees = rng.choice([(' style="visibility:hidden"', False), (' style="visibility:visible"', True)])
            elif kind < 0.55:
                style, draws = rng.choice([' style="display: none"', " hidden"]), False
            tag = rng.choice(plain if style else [*plain, "script", "div"])
            if tag == "script":
                out += f"<script>s{rng.randrange(10**9)}</script>"
                continue
            inner, found = element(depth + 1, sees, draws)
            out, words = out + f"<{tag}{style}>{inner}</{tag}>", words + found
        return out, words

    for _ in range(200):
        html, words = element(0, True, True)
        got = [w for w in html_text.page_text(html).replace('"', " ").split() if w[0] in "ws"]
        assert sorted(got) == sorted(words), html
