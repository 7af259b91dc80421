"""Vector operators and HTML extraction against plain versions."""
import math

import numpy as np
import pytest

from estatelens.llm import ann, embed_dedup, html_extract

INF, NAN = float("inf"), float("nan")
ODD = [(9000, None), (9001, [0.0] * 8), (9002, [NAN] + [1.0] * 7), (9003, [INF] + [1.0] * 7), (9004, [None] + [1.0] * 7), (9005, []), (None, [1.0] * 8)]


def points(n=600, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, 8))
    x = centres[r.integers(0, 12, n)] + r.normal(scale=0.25, size=(n, 8)) * r.choice([0.2, 1.0], (n, 1))
    x[50:90] = x[10]
    return x.astype("f4").astype(float)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, node int, cell int, vec int")


@pytest.mark.parametrize("block,cell", [(4096, 8192), (50, 60), (7, 1000)])
def test_embed_dedup_equals_all_pairs(spark, block, cell):
    x = points()
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + ODD
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(frame(spark, rows), block=block, cell_rows=cell).collect()}
    x = np.vstack([x, np.ones((1, 8))])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.9
    up = np.arange(len(x))
    while True:
        new = np.array([up[near[k]].min() for k in range(len(x))])
        if (new == up).all():
            break
        up = new
    ids = [*range(len(x) - 1), None]
    assert len(got) == len(rows)
    for k in range(len(x)):
        first = min((i for i in (ids[j] for j in np.nonzero(up == up[k])[0]) if i is not None), default=None)
        r = got[ids[k]]
        assert (r.n_links, r.component_id, r.kept) == (near[k].sum() - 1, first, ids[k] is not None and ids[k] == first)
    assert all(tuple(got[i])[1:] == (0, i, True) for i, _ in ODD if i is not None)


def test_reach_loses_no_link():
    x = embed_dedup.unit(points(800, 5))
    pivots = embed_dedup.choose_pivots(x[:200], 9)
    home, visits = embed_dedup.reach(x, pivots, math.sqrt(0.2))
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    for i, j in zip(a, b):
        i, j = (i, j) if home[i] <= home[j] else (j, i)
        assert home[i] == home[j] or visits[i, home[j]]


def test_vector_operators_without_rows(spark):
    for rows in ([], ODD[:6]):
        assert embed_dedup.near_duplicates(frame(spark, rows)).count() == len(rows)
        assert ann.search(frame(spark, rows)).count() == 0


def exact(x, ids, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    d[ids == ids[q]] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[j]), float(d[j])) for j in order if np.isfinite(d[j])]


def test_ann_small_is_exact_with_ties(spark):
    x, ids = points(300), np.arange(300) * 20
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)] + [(int(ids[0]), x[0].tolist())] + ODD
    got = {}
    for r in ann.search(frame(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    for q, found in got.items():
        want = exact(x, ids, int(np.nonzero(ids == q)[0][0]), 10)
        assert [v for _, v, _ in sorted(found)] == [v for v, _ in want] and [s for *_, s in sorted(found)] == pytest.approx([s for _, s in want], abs=1e-12)
        assert sorted(f[0] for f in found) == list(range(1, 11))
    few = ann.search(frame(spark, [(0, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [0.0, 1.0])])).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 2), (0, 2, 3)]


def test_ann_recall(spark):
    r = np.random.default_rng(1)
    x, ids = r.normal(size=(3000, 16)).astype("f4").astype(float), np.arange(3000)
    got = {}
    for row in ann.search(frame(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)]), every=20).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    recall = np.mean([len(got[q] & {v for v, _ in exact(x, ids, q, 10)}) / 10 for q in got])
    assert len(got) == 150 and recall >= 0.9


def test_parts_are_balanced():
    x = points(500)
    part = ann.balanced_parts(ann.neighbour_graph(x), 5)
    assert np.bincount(part, minlength=5).max() <= 105 + 1 and part.min() >= 0


def text_of(source):
    p = html_extract.Page(source)
    main = any(v == 1 for *_, v in p.blocks)
    return "\n".join(t for _, t, _, v in p.blocks if v == (1 if main else 0))


@pytest.mark.parametrize("source,want", [
    ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b <b>c</b>d<br>e", "a\nb cd e"),
    ("<nav>m</nav><article><h1>T</h1><p>x &lt; y&nbsp; z</p></article><footer>f</footer>", "T\nx < y z"),
    ("<article><p>one</p><aside>side</aside><div class='ad'>ad</div><p>two</p><section id=comments><article class=comment>hi</article></section></article>", "one\ntwo"),
    ("<script>var t='</p><article>';</script><style>p{}</style><div>x</div>", "x"), ("<article><p>cut off &am", "cut off &am"),
    ("<article><p>a</p><form><p>name</p></form><p>b</p>", "a\nb"), ("<article>x<!-- <p>no</p> -->y</article>z", "xy"),
    ("<div class='cookie-notice'>c</div><div class=sidebar>s</div><div role=banner>b</div><div>real</div>", "real"),
    ('<div title="a > b">x</div>', "x"), ("<main><header><h1>H</h1></header><p>p</p></main><header>site</header>", "H\np"),
    ("<p>a < b and c</p>", "a < b and c"), ("<article><p>x", "x"), ("<div hidden>h</div><p>v</p>", "v"),
    ("<html><head><title>t</title></head><body><header>top</header><p>body text</p></body></html>", "body text"),
    ("<article><p>a</p><p class=ad>buy<p>b</p><p hidden>h</p><p class='lead'>c</p></article>", "a\nb\nc"),
    ("<ol><li class='comment x'>hi<p>there</p></li><li>item</ol><p>end</p>", "item\nend"),
    ("<table><tr><td class=newsletter>n<td>cell</table><p class='notice'>n<div>d</div>", "cell\nd")])
def test_page_blocks(source, want):
    assert text_of(source) == want


STORY = "<article><h1>T</h1><p>A story of some length.</p></article>"


@pytest.mark.parametrize("source,want", [
    *[(f"{start}<nav>menu</nav>{STORY}<footer>f</footer>", "T\nA story of some length.") for start in
      ("<form id=aspnetForm>", "<div class='layout has-sidebar'>", "<div class='no-comments'>", "<section class=social>", "<form><div class=widget>")],
    ("<div class=social><p>All of the page stands in here.</p></div><p>end</p>", "All of the page stands in here.\nend"),
    ("<div class=sidebar><article>teaser</article></div><div>The long text of this page.</div>", "The long text of this page."),
    ("<div class=sidebar><article>a teaser that is longer than the story</article></div><article>story</article>", "story"),
    ("<div class=menu><a href=/>a long list of links to other pages</a></div><p>text</p>", "text"),
    ("<p>A short story.</p><div class=comments><p>first of many words by readers</p><p>more of them</p></div>", "A short story."),
    ("<article><section id=comments><article>a comment</article></section><p>p</p></article>", "p"),
    ("<article><div class='article-header'><h1>T</h1></div><p>p</p></article>", "T\np"), ("<div class=entry-header><h1>T</h1></div><p>text</p>", "T\ntext"),
    ("<html><head><meta charset=utf-8><title>t</title><p>a<p>b", "a\nb"), ("<head><title>t</title><div class=x>a</div>", "a"),
    ("<p>a</p><svg><path d=x><p>b</p>", "a\nb"), ("<p>a</p><select><p>b</p><select><option>no</select><p>c</p>", "a\nb\nc"),
    ("<p>a</p><object><p>b</p>", "a\nb"), ("<svg><svg>no</svg>no</svg><p>a</p>", "a")])
def test_marks_and_open_elements_lose_no_text(source, want):
    assert text_of(source) == want


def test_template_of_a_host(spark):
    def page(k, host="h.example"):
        return f"http://{host}/{k}", (f"<html><body><div><a href=/a>Home</a> <a href=/{k}>Next page {k}</a></div><div><p>We are a company.</p><p>Story {k} is told here.</p>"
                                      f"<p>And ends {k % 2}.</p></div></body></html>")
    rows = [(k, *page(k)) for k in range(10)] + [(50, *page(50, "single.example")), (51, None, None), (52, "http://x/", ""), (None, "::bad[", "<article>ok</article>"), (3, *page(3))]
    df = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "page_id long, url string, html string, host int, text string, token int")
    got = html_extract.main_text(df).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    by_id = {}
    for r in got:
        by_id.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for k in range(10):
        ends = f"\nAnd ends {k % 2}." if k % 2 == 0 else ""            # the other ending stands on half of the host's pages: template
        assert by_id[k] == [f"Story {k} is told here.{ends}"] * (2 if k == 3 else 1)
    assert by_id[51] == by_id[52] == [""] and by_id[None] == ["ok"] and "We are a company." in by_id[50][0]
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_repeated_article_text_stays(spark):
    html = "<nav>Menu</nav><article><h1>Same</h1><p>Copied story.</p></article><footer>(c)</footer>"
    df = spark.createDataFrame([(k, f"http://h/{k}", html) for k in range(8)], "page_id long, url string, html string")
    assert {r.text for r in html_extract.main_text(df).collect()} == {"Same\nCopied story."}


def extract(spark, sources, host="h.example"):
    df = spark.createDataFrame([(k, f"http://{host}/{k}", x) for k, x in enumerate(sources)], "page_id long, url string, html string")
    return [r.text for r in sorted(html_extract.main_text(df).collect(), key=lambda r: r.page_id)]


def test_template_text_goes_from_articles_too(spark):
    got = extract(spark, [f"<html><body><article><h1>Title {k}</h1><p>Share this story now</p><p>Story {k} has more words than the template.</p><p>Thanks for reading</p></article></body></html>"
                          for k in range(8)])
    assert got == [f"Title {k}\nStory {k} has more words than the template." for k in range(8)]


def test_copies_are_no_template(spark):
    copies = [f"<html><body><div class=ad>Buy {k}</div><div><p>A story told many times.</p><p>It ends well.</p></div></body></html>" for k in range(12)]
    others = [f"<html><body><div><p>Story {k}.</p></div></body></html>" for k in range(6)]
    assert extract(spark, copies + others) == ["A story told many times.\nIt ends well."] * 12 + [f"Story {k}." for k in range(6)]


def test_near_copies_of_an_article_stay(spark):
    got = extract(spark, [f"<article><p>A long story that is told on all pages of the host.</p><p>Part {k}.</p></article>" for k in range(6)])
    assert got == [f"A long story that is told on all pages of the host.\nPart {k}." for k in range(6)]


def test_texts_without_a_fixed_place_or_enough_words_are_no_template(spark):
    moving = [[f"First words of {k}.", "This moves about the page.", "It has no fixed place."] for k in range(8)]
    pages = ["<html><body><p>Always in front here.</p>" + "".join(f"<p>{x}</p>" for x in (m if k % 2 else [m[0], m[2], m[1]])) + "<p>Yes.</p>" * (k % 2) + f"<p>End {k}.</p></body></html>"
             for k, m in enumerate(moving)]
    got = extract(spark, pages)
    for k, (text, m) in enumerate(zip(got, moving)):
        assert text.split("\n") == [*(m if k % 2 else [m[0], m[2], m[1]]), *["Yes."] * (k % 2), f"End {k}."]


def test_vectors_of_every_length_are_compared_with_their_own(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0]), (4, [3.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.1]), (100, [1.0, 0.0, 0.1]), (200, [1.0, 0.05]), (7, [1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 100: (2, 1), 3: (3, 3), 4: (3, 3), 6: (3, 3), 200: (3, 3), 5: (0, 5), 7: (0, 7)}
    found = {}
    for r in ann.search(frame(spark, rows)).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: [v for _, v in sorted(x)] for q, x in found.items()} == {100: [1, 2], 200: [3, 6, 5, 4]}


@pytest.mark.parametrize("page,text", [
    ('<article data-title="The hidden valley"><p>Kept.</p></article>', "Kept."),
    ('<article alt=\'class="nav" hidden\'><p>Kept.</p></article>', "Kept."),
    ('<main data-role="navigation"><p>Kept.</p></main>', "Kept."),
    ('<article><section data-id="comments"><p>Kept.</p></section></article>', "Kept."),
    ('<article><div data-hidden="false"><p>Kept.</p></div></article>', "Kept."),
    ('<article><div hidden="until-found"><p>Kept.</p></div><div hidden>gone</div><div HIDDEN="">gone</div></article>', "Kept."),
    ('<article><div class="social-policy"><p>A</p></div><div class="foot-anatomy"><p>B</p></div><div class="notice-of-motion"><p>C</p></div><p class="search-theory">D</p></article>', "A\nB\nC\nD"),
    ('<article><p>Kept.</p><div class="social-links">gone</div><div class="cookie-notice">gone</div><p class="ad-slot">gone</p></article>', "Kept."),
    ('<article class="a" class="nav"><p>Kept.</p></article>', "Kept."),
])
def test_attributes_and_class_names_are_read_whole(page, text):
    assert "\n".join(t for _, t, _, v in html_extract.Page(page).blocks if v == 1) == text
