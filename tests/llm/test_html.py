import html
import re

from tidewell.llm import html_text
from tidewell.llm.common import read_table
from tidewell.llm.q09_html import op9_html

SF = "/root/testdata/sf0.01"


def page(k, body, extra=""):
    return (
        f'<!DOCTYPE html><html><head><title>T{k}</title><style>p{{}}</style><script>var a="</p>";x({k})</script></head><body><nav><ul><li><a href=/>Home {k}</a></li></ul></nav>'
        f'<div class="ad">Buy {k}</div>{body}<aside>Side</aside><form><p>Name</p></form><section id="comments"><p>First! {k}</p></section><footer>&copy; me</footer>{extra}</body></html>'
    )


def test_semantic_and_plain_pages(spark):
    rows = [(k, f"http://a.org/{k}", page(k, f"<article><h1>Head &amp; {k}</h1><p><b>One {k}.<br>two\n  three<br><p>Next&nbsp;{k}</p><ul><li>x</li></ul></article>")) for k in range(5)]
    rows += [(10 + k, f"https://b.org/{k}", page(k, f"<div class=content><div class=text><p>Story {k} is long enough.</p><p>More {k} of it.</p></div><div class=box>Fixed words</div></div>")) for k in range(5)]
    rows += [(20, "nonsense", "<p>Only &lt;this&gt;"), (21, None, None), (22, "http://c.org/", ""), (23, "http://d.org", "a < b <p>c")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, blocks string")
    got = {r["id"]: r["text"] for r in html_text.main_text(df).collect()}
    for k in range(5):
        assert got[k] == f"Head & {k}\n\nOne {k}. two three\n\nNext {k}\n\nx"
        assert got[10 + k] == f"Story {k} is long enough.\n\nMore {k} of it."
    assert got[20] == "Only <this>" and got[21] == "" and got[22] == "" and got[23] == "a < b\n\nc"


def test_tables_articles(spark):
    """Against a plain reading of the article element, which all pages of these tables have."""
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in op9_html(spark, SF).collect()}
    for r in read_table(spark, SF, "pages").collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"]] == (want, len(want))


def test_empty_table(spark):
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_text_beside_the_largest_container(spark):
    """A headline and lead outside of the body's container, and sibling containers, stay; page by page."""
    rows = [(k, f"http://e.org/{k}", f"<body><article><h1>Head {k}</h1><p>Lead {k}</p><div class=entry><p>{f'Body {k} ' * 20}</p></div></article></body>") for k in range(5)]
    rows += [(10 + k, f"http://f.org/{k}", f"<body><div class=one><p>{f'first {k} ' * 6}</p></div><div class=two><p>{f'other {k} ' * 4}</p></div></body>") for k in range(5)]
    rows += [(20 + k, f"http://g.org/{k}", f"<body><article><p>{f'text {k} ' * (200 if k else 1)}</p></article><div class=rest><p>{f'rest {k} ' * 9}</p></div></body>") for k in range(5)]
    got = {r["id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(5):
        assert got[k] == f"Head {k}\n\nLead {k}\n\n" + (f"Body {k} " * 20).strip()
        assert got[10 + k] == (f"first {k} " * 6).strip() + "\n\n" + (f"other {k} " * 4).strip()
        assert f"text {k}" in got[20 + k] and (k == 0 or "rest" not in got[20 + k])


def test_copies_are_no_template(spark):
    """A page that is given three times, or mirrored under other urls, keeps its text."""
    plain = "<body><div><p>A story.</p><p>Its end.</p></div></body>"
    rows = [(1, "http://h.org/1", plain)] * 3 + [(k, f"http://i.org/{k}", plain if k < 7 else f"<body><p>Other {k}</p></body>") for k in range(2, 10)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 11 and all(r["text"] == ("A story.\n\nIts end." if r["id"] < 7 else f"Other {r['id']}") for r in got)


def neutral(host, k, rnd):
    """A page of a host without article elements or telling names, and its article's text."""
    say = lambda n: " ".join(f"{host}{rnd.randrange(4000)}" for _ in range(n))
    head, lead = say(6), say(12)
    body = [say(rnd.randrange(15, 60)) for _ in range(rnd.randrange(2, 6))]
    menu = "".join(f"<a href=/{rnd.randrange(99)}>{say(2)}</a> " for _ in range(6))
    notes = "".join(f"<div class=y{j % 2}>{say(rnd.randrange(4, 12))}</div>" for j in range(rnd.randrange(2, 6)))
    inner = f"<h1>{head}</h1><p>{lead}</p><div class=q3>{''.join(f'<p>{b}</p>' for b in body)}</div>"
    html = f"<html><body><div class=q1>{menu}</div><div class=q2>We use cookies on {host}.</div><div class=q4>{inner}</div><div class=q5>{notes}</div><div class=q6>Made by {host}</div></body></html>"
    return html, "\n\n".join([head, lead, *body])


def test_neutral_hosts(spark):
    """Menus, notices and comments in plain containers go by the classes and slots alone."""
    import random

    rnd = random.Random(1)
    pages = [(100 * h + k, f"http://h{h}.org/{k}", *neutral(f"h{h}x", k, rnd)) for h in range(8) for k in range(12)]
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    for lists in (True, False):
        got = {r["id"]: r["text"] for r in html_text.main_text(df, lists=lists).collect()}
        right = sum(got[p[0]] == p[3] for p in pages)
        assert right >= 0.95 * len(pages), (right, got[pages[0][0]], pages[0][3])


def test_tables_without_lists(spark):
    """On hosts with enough pages the template alone gives the article, without names of elements or boxes."""
    from collections import Counter

    rows = read_table(spark, SF, "pages").collect()
    host = lambda u: re.sub(r"^[a-z]+://([^/:]*).*", r"\1", (u or "").lower())
    size = Counter(host(r["url"]) for r in rows)
    got = {r["id"]: r["text"] for r in html_text.main_text(read_table(spark, SF, "pages"), lists=False).collect()}
    checked = right = 0
    for r in rows:
        if size[host(r["url"])] >= 8:
            article = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
            blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
            checked += 1
            right += got[r["page_id"]] == "\n\n".join(b for b in blocks if b)
    assert checked > 30 and right >= 0.95 * checked, (right, checked)


def test_nothing_of_an_article_is_lost(spark):
    """Stray end tags, and containers named like boxes that hold the article's own text."""
    rows = [(k, f"http://k.org/{k}", f"<body><article><p>one {k} two</style> three</p><div class=legal-analysis><p>law {k}</p></div><div class=related><p>kin {k}</p></div></article></body>") for k in range(5)]
    rows += [(9, "http://l.org/", rows[0][2])]
    got = {r["id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(5):
        assert got[k] == f"one {k} two three\n\nlaw {k}\n\nkin {k}"
    assert got[9] == got[0]
