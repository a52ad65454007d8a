"""Wrapper induction: parsing, tree matching, templates, awkward pages."""

import html
import random
import re
import time

from conftest import SF0001
from ledgerlens.llm import html_wrapper as W


def test_simple_tree_matching_counts_the_largest_ordered_matching():
    a = ["body", [["p", []], ["div", [["p", []], ["p", []]]], ["ul", []]]]
    b = ["body", [["div", [["p", []]]], ["ul", []], ["p", []]]]
    assert W.match(a, b, {}) == 4  # body, div, its p, ul
    assert W.match(a, ["html", []], {}) == 0
    assert W.match(a, a, {}) == 6


def test_blocks_entities_and_excluded_elements():
    page = (
        "<html><head><title>T</title></head><body><nav>menu</nav><div class='ad box'>buy</div>"
        "<article><h1>A &amp;  b</h1><p>one<br>two <b>three</b><p>x &lt; y&nbsp;z"
        "<form>field</form><div id=comments><p>me too</div></article><p>outside</p>"
        "<script>var t='</p>'; if (a<b) {}</script><footer>&copy;</footer>"
    )
    assert W.extract(page, None) == "A & b\none two three\nx < y z"


def test_pages_without_markup_or_with_broken_markup():
    assert W.extract(None, None) == ""
    assert W.extract("", None) == ""
    assert W.extract("just  text", None) == "just text"
    assert W.extract("a < b and c > d", None) == "a < b and c > d"
    assert W.extract("<p>one<p>two</div></p><!-- open", None) == "one\ntwo"
    assert W.extract("<p title='a>b'>x</p><script>never closed", None) == "x"
    assert len(W.extract("<div>" * 300 + "deep" + "<p>w</p>" * 20_000, None).split("\n")) == 20_001


def brute_matching(a, b):
    """Largest ordered matching by trying every way to pair up the children."""
    if (a is None) != (b is None) or (a is not None and a[0] != b[0]):
        return 0
    if a is None:
        return 1

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), best(xs[1:], ys[1:]) + brute_matching(xs[0], ys[0]))

    return 1 + best(a[1], b[1])


def random_tree(rng, depth):
    if depth and rng.random() < 0.3:
        return None
    return [rng.choice("pq"), [random_tree(rng, depth + 1) for _ in range(rng.randrange(4) if depth < 3 else 0)]]


def test_matching_against_all_ways():
    rng = random.Random(6)
    for _ in range(300):
        a, b = random_tree(rng, 0), random_tree(rng, 0)
        assert W.match(a, b) == brute_matching(a, b)
        if a[0] == b[0]:
            memo, total = W.Matching(), 1
            found = W.pairs(a[1], b[1], memo)
            for i, j in found:
                if i is not None and j is not None:
                    total += W.match(a[1][i], b[1][j])
            assert total == brute_matching(a, b)
            assert [i for i, _ in found if i is not None] == list(range(len(a[1])))
            assert [j for _, j in found if j is not None] == list(range(len(b[1])))


def test_deep_nesting_keeps_text_order_and_marks():
    for n in (50, 99, 100, 101, 2_000, 100_000):
        page = "<div>" * n + "in<p>deep</p>after" + "".join(f"<b>{i}</b></div>" for i in range(3)) + "</div>" * (n - 3) + "<p>end</p>"
        assert W.extract(page, None) == "in\ndeep\nafter0\n1\n2\nend", n
    inside = "<div>" * 300 + "<nav>menu<div>of<div>it</div></nav>text<div class='ad'>buy<div>now</div></div>tail is longer"
    assert W.extract(inside, None) == "text\ntail is longer"
    mixed = "".join(f"<div>t{i}" for i in range(400)) + "".join(f"</div>u{i}" for i in range(400))
    assert W.extract(mixed, None) == "\n".join([f"t{i}" for i in range(400)] + [f"u{i}" for i in range(400)])
    unclosed = "<li><div>" * 5_000 + "x" + "</section>" * 5_000
    assert W.extract(unclosed, None) == "x"


def test_deep_and_wide_pages_in_a_job(spark):
    pages = [(i, "http://deep.example/", "<div>" * 3_000 + f"<p>body {i}</p>") for i in range(3)]
    pages += [(10 + i, "http://wide.example/", "<div>same</div>" + "".join(f"<{t}>{i} {k}</{t}>" for k, t in enumerate(["p", "h2"] * 1_500)))
              for i in range(3)]
    got = texts_of(spark, pages)
    assert got[1] == "body 1" and got[11].split("\n") == [f"1 {k}" for k in range(3_000)]


def tag_free_corpus():
    """(id, url, html, expected text): hosts of their own layout, without a tag or class that tells content."""
    rng = random.Random(2)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    rows = []
    for h in range(12):
        top, menu, legal, box = words(3), [words(1) for _ in range(4)], words(6), words(5)
        for k in range(2 + h % 5 * 4):
            title, paragraphs = words(4), [words(rng.randrange(8, 30)) for _ in range(rng.randrange(1, 6))]
            links = "".join(f"<li>{m}</li>" for m in menu)
            body = "".join(f"<p>{p}</p>" for p in paragraphs)
            layout = h % 4
            if layout == 0:
                page = f"<div>{top}</div><ul>{links}</ul><div><h2>{title}</h2>{body}</div><div>{legal}</div>"
            elif layout == 1:
                page = (f"<table><tr><td><p>{top}</p><p>{box}</p></td><td><h1>{title}</h1>{body}</td></tr></table>"
                        f"<center>{legal}</center>")
            elif layout == 2:
                page = f"<div class=c1><div class=c2>{top}<ul>{links}</ul></div><div class=c3><div>{title}</div><div>{body}</div></div><div class=c2>{legal}</div></div>"
            else:
                page = f"<h3>{top}</h3><div><div><h1>{title}</h1>{body}<p>{box}</p></div></div><dl><dt>{legal}</dt></dl>"
            url = f"http://host{h}.example/{k}"
            rows.append((len(rows), url, f"<html><body>{page}</body></html>", "\n".join([title, *paragraphs])))
    return rows


def test_induction_alone_finds_the_text_of_tag_free_pages(spark):
    rows = tag_free_corpus()
    got = texts_of(spark, [r[:3] for r in rows])
    assert got == {i: want for i, _, _, want in rows}
    # without its host's wrapper every page keeps its template
    assert all(W.extract(page, None) != want for _, _, page, want in rows)


def test_large_trees_are_matched_quickly():
    def wide(k, n):
        return ["body", [["div", [["p", [None]], [("h2", "h3")[(i * k) % 7 < 3], [None]]]] for i in range(n)]]

    start = time.time()
    assert W.match(wide(3, 1_600), wide(5, 1_600)) > 3_200
    W.merge(W.fill(wide(3, 800), iter([{"n": 1, "lo": [1] * 3, "hi": [1] * 3}] * 1_600)),
            W.fill(wide(5, 800), iter([{"n": 1, "lo": [2] * 3, "hi": [2] * 3}] * 1_600)))
    assert time.time() - start < 5


def test_constant_slots_are_template_and_varying_ones_content(spark):
    pages = [
        (i, f"http://Shop.example.com/{i}", f"<body><div>Our shop</div><div><p>Item {i}</p><p>costs {i * 3}</p></div>"
         + ("<p>Sale</p>" if i % 2 else "") + "<div>All rights reserved</div></body>")
        for i in range(12)
    ]
    pages += [(99, "http://alone.example.com/", "<body><div>Only page</div></body>"), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in W.main_text(df).collect()}
    assert W.main_text(df).count() == len(pages)
    # "Sale" stands on fewer than MIN_PAGES pages: not yet known to be template
    assert got[2] == "Item 2\ncosts 6" and got[3] == "Item 3\ncosts 9\nSale"
    assert got[99] == "Only page" and got[None] == ""


def test_copies_of_one_page_keep_their_text(spark):
    df = spark.createDataFrame(
        [(i, f"http://a.example/{i}", "<body><article><p>Same text</p></article></body>") for i in range(20)],
        "page_id long, url string, html string",
    )
    assert {r["text"] for r in W.main_text(df).collect()} == {"Same text"}
    assert W.main_text(df.limit(0)).count() == 0


def test_wrapper_does_not_depend_on_partitions(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    one = sorted(map(tuple, W.induce(pages.coalesce(1)).collect()))
    assert one == sorted(map(tuple, W.induce(pages.repartition(7)).collect()))


def test_pages_of_the_table_against_a_plain_reading_of_their_articles(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    for r in W.main_text(pages).collect():
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def test_large_hosts_are_aligned_in_bounded_groups(spark, monkeypatch):
    sizes = []
    pages = [
        (i, "http://big.example/", "<body><div>Our shop</div>" + "".join(f"<{t}>{i}{t}</{t}>" for b, t in
         enumerate("p ul h2 pre dl address h3 table".split()) if i >> b & 1) + "<div>Rights</div></body>")
        for i in range(256)
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    scratch = W.scratch

    def looked_at(table, name):
        out = scratch(table, name)
        if name == "wrappers":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(W, "scratch", looked_at)
    wrappers = W.induce(df).collect()
    assert len(wrappers) == 1 and sizes[0] == 256 and sizes[-1] == 1
    assert all(b >= a / W.GROUP_SIZE and b < a for a, b in zip(sizes, sizes[1:])) and len(sizes) > 2


def test_large_wrappers_fold_nodes_that_vary():
    def slot(lo, hi):
        return {"n": 9, "lo": [lo] * 3, "hi": [hi] * 3}

    wrapper = ["body", [slot(1, 1), ["div", [slot(1, 2), ["p", [slot(3, 4)]], ["hr", []]]], ["p", [slot(5, 5)]]]]
    folded = W.fold(wrapper)
    assert folded == ["body", [slot(1, 1), ["div", W.FOLDED], ["p", [slot(5, 5)]]]]
    assert W.varies(folded) and W.fold(folded) == folded and W.slots_in(folded) == [slot(1, 1), slot(5, 5)]
    merged = W.merge(folded, wrapper)
    assert merged[1][1] == ["div", W.FOLDED] and merged[1][0]["n"] == 18
    shape = ["body", [None, ["div", [None, ["p", [None]], ["hr", []]]], ["p", [None]]]]
    want = [(known,) * 3 for known in (True, False, False, True)]
    assert W.template_slots(shape, merged, 18) == W.template_slots(shape, wrapper, 9) == want


def texts_of(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in W.main_text(df).collect()}


def test_copies_count_as_one_page(spark):
    copied = "<body><div>Our shop</div><p>Copied</p><ul><li>its own list</li></ul></body>"
    pages = [(i, f"http://c.example/{i}", copied) for i in range(10)]
    pages += [(i, f"http://c.example/{i}", f"<body><div>Our shop</div><p>Item {i}</p></body>") for i in range(10, 13)]
    got = texts_of(spark, pages)
    assert got[0] == got[9] == "Copied\nits own list" and got[12] == "Item 12"


def test_fixed_first_and_last_of_repeated_nodes_are_template(spark):
    pages = [
        (i, f"http://r.example/{i}", f"<body><div>menu</div><div>article {i}</div><div>copyright</div>"
         f"<section><p>one {i}</p>{'<p>more</p>' * (i % 3)}<p>fixed notice</p></section></body>")
        for i in range(12)
    ]
    got = texts_of(spark, pages)
    assert got[3] == "article 3\none 3" and got[5] == "article 5\none 5\nmore\nmore"


def test_small_hosts_are_compared_from_two_pages_on(spark):
    pages = [(i, "http://two.example/", f"<body><div>Our shop</div><p>Item {i}</p></body>") for i in range(2)]
    assert texts_of(spark, pages) == {0: "Item 0", 1: "Item 1"}


def test_names_are_whole_classes_and_hints_of_small_nodes():
    body = "<h1>Title</h1><p>A long body of the page, much longer than what stands beside it.</p>"
    want = "Title\nA long body of the page, much longer than what stands beside it."
    for around in (
        "<div class='site has-sidebar'>{}</div>",
        "<div class='content no-comments'>{}</div>",
        "<section id='related-work'>{}</section>",
        "<form>{}</form>",
        "<form><div class='widget'>{}</div><div class='sidebar'>links</div></form>",
        "<div class='login'><article>{}</article></div>",
        "<aside><main>{}</main></aside><p>outside</p>",
        "<div class='related'><article>Other</article></div><aside><article>x</article></aside><article>{}</article>",
    ):
        assert W.extract(f"<html><body>{around.format(body)}</body></html>", None) == want, around
    assert W.extract(f"<div>{body}</div><div class='a comments'>me too</div><form>field</form>", None) == want
    assert W.extract(f"<div hidden><article>{body}</article></div><p>seen</p>", None) == "seen"
