import collections
import html
import os
import re

import pytest

from bitext.llm import htmltext as H

SCHEMA = "page_id long, url string, html string, text string, host string"


def text(page):
    return H.text_of(H.parse(page), set())


def test_blocks_references_and_marked_parts():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x";</script></head>
    <body class="has-sidebar"><nav><ul><li>Menu</li></ul></nav><div class="ad">Buy</div><div id="cookie-notice">Cookies</div>
    <article><h1>Head &amp;amp; &lt;b&gt;</h1><p><b>One\n\t two</b> three<br>four<p>Next &eacute;&#233;&#x1F600;
    <ul><li>a<li>b</ul><form><input>Sign</form><aside>Side</aside><!-- no <p>x</p> --><div class="comments"><p>Reader</p></div>
    <blockquote>Q</blockquote></article><footer>&copy; F</footer></body></html>"""
    assert text(page) == "Head &amp; <b>\nOne two three four\nNext éé😀\na\nb\nQ"


def test_pages_without_an_article():
    assert text("<body><nav>m</nav><main><p>x</p></main><p>y</p></body>") == "x"
    assert text("<p>x</p>plain<div>z</div>") == "x\nplain\nz"
    assert text("") == "" and text("no markup & none") == "no markup & none"
    assert text("<article><p>open") == "open" and text("</div></p><p>x</article>") == "x"
    assert text("<article>1 < 2 and <3</article>") == "1 < 2 and <3"


def test_templates_go_and_shared_passages_stay(spark):
    pages = []
    quote = "<p>A passage that every page of the site quotes in full.</p>"
    for i in range(12):
        body = f"<div><p>Start of {i}</p>{quote}</div>" if i % 2 else f"<p>Own words {i}</p>{quote}"
        pages.append((i, f"http://Site.example/{i}", f'<body><div class="x1"><a href="/">Home</a> Top</div><div><h1>T{i}</h1>{body}</div><div>Bottom line</div></body>', "t", "h"))
    pages.append((50, "http://other.example/1", '<body><div class="x1"><a href="/">Home</a> Top</div><p>z</p></body>', None, None))
    # copies of one page are one page: its text isn't template
    pages += [(100 + i, f"http://copies.example/{i}", "<body><div><span>Lone text</span></div><p>p</p></body>", None, None) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(pages, SCHEMA).repartition(4)).collect()}
    assert got[0] == "T0\nOwn words 0\nA passage that every page of the site quotes in full."
    assert got[1] == "T1\nStart of 1\nA passage that every page of the site quotes in full."
    assert got[50] == "Home Top\nz"
    assert {got[100 + i] for i in range(30)} == {"Lone text\np"}


def test_article_pages_are_untouched_by_templates(spark):
    pages = [(i, f"http://a.example/{i}", f"<body><nav>N</nav><article><h1>H</h1><p>Same paragraph.</p><p>{i}</p></article></body>", "", "") for i in range(20)]
    got = H.extract(spark.createDataFrame(pages, SCHEMA)).collect()
    assert all(r["text"] == f"H\nSame paragraph.\n{r['page_id']}" and r["n_chars"] == len(r["text"]) for r in got)


def test_boxes_with_prose_that_recur_in_articles_go(spark, monkeypatch):
    """Also where each of many layouts has less than a third of the host's pages; bare passages stay."""
    box = "<div class='x1'><p>We use cookies, version {}.</p></div>"
    quote = "<p>A passage that many pages quote.</p><blockquote><div><p>Another one.</p></div></blockquote>"
    pages = [(i, f"http://hot.example/{i}", f"<body><article><h1>H{i}</h1>{box.format(i % 5)}<p>Own {i}</p>{quote}</article></body>", "", "") for i in range(25)]
    pages += [(100 + i, f"http://rare.example/{i}", f"<body><article><p>Own {i}</p>{box.format(0)}</article></body>", "", "") for i in range(3)]
    docs = spark.createDataFrame(pages, SCHEMA).repartition(4)
    want = {i: f"H{i}\nOwn {i}\nA passage that many pages quote.\nAnother one." for i in range(25)}
    want |= {100 + i: f"Own {i}\nWe use cookies, version 0." for i in range(3)}
    assert {r["page_id"]: r["text"] for r in H.extract(docs).collect()} == want
    monkeypatch.setattr(H, "BROADCAST_HASHES", 0)
    assert {r["page_id"]: r["text"] for r in H.extract(docs).collect()} == want


def test_shuffled_lists_give_the_same(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://s/{i}", f"<body><div>Top</div><p>{i}</p></body>", "", "") for i in range(9)], SCHEMA)
    one = sorted(map(tuple, H.extract(pages).collect()))
    monkeypatch.setattr(H, "BROADCAST_HASHES", 0)
    assert sorted(map(tuple, H.extract(pages).collect())) == one and one[0][2] == "0"


def test_edges_of_the_input(spark):
    rows = [(1, None, "<p>x</p>", "a", "b"), (2, "http://h", None, None, None), (2, "http://h", None, None, None), (None, "http://h", "", "", ""), (5, "bad", "<div>" * 3000 + "deep", "", ""), (6, "u", "<" * 2000 + "&" * 50, "", "")]
    got = H.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == "x" and by[2] == "" and by[None] == "" and by[5] == "deep"
    assert H.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def plain_extract(pages):
    """Templates and texts of (page_id, url, html) rows by whole strings and dictionaries."""

    def shape(node):  # markup and text of a subtree, spelled out
        inner = [shape(x) if isinstance(x, H.Node) else re.sub(r"\s+", " ", x).strip() for x in node.parts]
        return f"<{node.tag} {re.sub(r'[ ]+', ' ', re.sub(chr(92) + 's', ' ', node.attrs)).strip()}>" + "\1".join(x for x in inner if x) + "\2"

    def inside_of(node, tops):
        while node is not None:
            if any(node is t for t in tops):
                return True
            node = node.parent
        return False

    def removable(node, tops):
        if node.parent is None or node.tag in H.VOID or any(inside_of(t, [node]) for t in tops if t is not node):
            return False
        if any(node is t for t in tops):
            return len(tops) > 1 and node.tag in H.BLOCKS - H.PROSE
        if not inside_of(node, tops):
            return True
        up = node.parent
        while up is not None and inside_of(up, tops):
            if up.tag == "blockquote":
                return False
            up = up.parent
        return node.tag in H.BLOCKS and node.tag not in H.PROSE

    def walk(node):
        yield node
        for x in node.parts:
            if isinstance(x, H.Node):
                yield from walk(x)

    def write(node, recurs, hinted, inside, out):
        if node.parent is not None and (recurs(node) or H.is_marked(node)):
            return
        if node.tag == "br":
            out.append((inside, " "))
            return
        inside = inside or any(node is t for t in hinted)
        edge = [(inside, None)] if node.tag in H.BLOCKS else []
        out += edge
        for x in node.parts:
            if isinstance(x, H.Node):
                write(x, recurs, hinted, inside, out)
            else:
                out.append((inside, x))
        out += edge

    seen, trees = collections.defaultdict(set), []
    for page_id, url, page in pages:
        host = re.split(r"[/?#]", url.split("://", 1)[1])[0].lower() if url and "://" in url else ""
        root = H.parse(page or "")
        tops = H.main_nodes(root)
        own = {id(x): shape(x) for x in walk(root) if removable(x, tops)}
        trees.append((page_id, host, root, own))
        for x in own.values():
            seen[host, x].add("\3".join(shape(t) for t in tops))
    result, deleted = [], 0
    for page_id, host, root, own in trees:
        gone = {k for k, x in own.items() if len(seen[host, x]) >= H.MIN_PAGES}
        deleted += len(gone)
        out = []
        write(root, lambda node: id(node) in gone, H.hinted_nodes(root), False, out)
        lines, now = [], []
        for inside, x in [*out, (False, None)]:
            if x is None:
                line = re.sub(r"\s+", " ", html.unescape("".join(t for _, t in now))).strip()
                if line:
                    lines.append((any(i for i, _ in now), line))
                now = []
            else:
                now.append((inside, x))
        of_hint = [x for inside, x in lines if inside]
        if H.hinted_nodes(root) and H.HINT_SHARE * sum(map(len, of_hint)) >= sum(len(x) for _, x in lines):
            lines = [(True, x) for x in of_hint]
        result.append((page_id, "\n".join(x for _, x in lines)))
    return sorted(result), deleted


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_tables_as_a_plain_recount_has_them(spark, folder):
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    want, deleted = plain_extract([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
    assert sorted((r["page_id"], r["text"]) for r in H.extract(pages).collect()) == want
    if folder.endswith("0.01"):
        assert deleted > 0


def site(i, own):
    """A page without article, class or semantic tags: removal alone can tell its text."""
    return (
        "<table><tr><td><div><a href='/'>Start</a> <a href='/about'>About us</a></div></td></tr></table>"
        f"<div><div>Subscribe for three coins a month</div>{own}<div><div><span>Most read</span><p>Ten things</p></div></div></div>"
        f"<div>All rights reserved by us {i % 3}</div>"
    )


def test_a_host_without_any_marks(spark, monkeypatch):
    pages = [(i, f"http://plain.example/{i}", f"<html><body>{site(i, f'<div><h2>Title {i}</h2><p>Words of page {i}.</p></div>')}</body></html>", "", "") for i in range(24)]
    want = {i: f"Title {i}\nWords of page {i}." for i in range(24)}
    docs = spark.createDataFrame(pages, SCHEMA).repartition(3)
    assert {r["page_id"]: r["text"] for r in H.extract(docs).collect()} == want
    assert plain_extract([p[:3] for p in pages])[0] == sorted(want.items())
    monkeypatch.setattr(H, "BROADCAST_HASHES", 0)
    assert {r["page_id"]: r["text"] for r in H.extract(docs).collect()} == want


def test_an_article_tag_is_a_hint_only(spark):
    long = "<div><p>{} is a long story that the page tells in a plain box, far longer than the teasers beside it are.</p></div>"
    teasers = "<article>Teaser {}</article>"
    pages = [(i, f"http://t.example/{i}", f"<body>{long.format(i)}{teasers.format(i)}</body>", "", "") for i in range(5)]
    # one of two articles recurs: it is the site's, the other the page's
    pages += [(10 + i, f"http://two.example/{i}", f"<body><article><p>Support us now, all of you</p></article><article><p>Own {i}</p></article><div>Odd {i}</div></body>", "", "") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert all(got[i].startswith(f"{i} is a long story") for i in range(5))
    assert [got[10 + i] for i in range(5)] == [f"Own {i}" for i in range(5)]
    assert plain_extract([p[:3] for p in pages])[0] == sorted(got.items())


def test_many_templates_are_joined_by_shuffle_not_through_the_driver(spark, monkeypatch):
    pages = [(i, f"http://plain.example/{i}", f"<html><body>{site(i, f'<div><h2>Title {i}</h2><p>Words of page {i}.</p></div>')}</body></html>", "", "") for i in range(24)]
    want = {i: f"Title {i}\nWords of page {i}." for i in range(24)}
    docs = spark.createDataFrame(pages, SCHEMA).repartition(3)
    monkeypatch.setattr(H, "BROADCAST_HASHES", 0)
    plan = H.extract(docs)._jdf.queryExecution().executedPlan().toString()
    # the one table that is broadcast are the templates on more than HOT_PAGES pages
    assert plan.count("BroadcastExchange") == 1 and f"GreaterThan(pages,{H.HOT_PAGES})" in plan and "explode" not in plan
    monkeypatch.setattr(H, "HOT_PAGES", 6)  # some recur on 8 pages, others on all 24
    assert {r["page_id"]: r["text"] for r in H.extract(docs).collect()} == want
    monkeypatch.setattr(H, "HOT_PAGES", 12)
    assert {r["page_id"]: r["text"] for r in H.extract(docs).collect()} == want


def test_template_keys_come_as_bytes(spark):
    found = spark.range(0, 200_000, 1, 3).selectExpr("concat('h', id % 7) AS host", "xxhash64(id) AS hash", "4L AS pages")
    keys = H._keys(found)
    assert sorted(r[0] for r in found.selectExpr("xxhash64(host, hash)").collect()) == keys.tolist()
    assert len(H._keys(found.limit(0))) == 0
