import hashlib
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import jaccard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadframe.llm import extraction, neighbours, pagetext, spots


def spot_lists(texts):
    found, cuts = spots.spot_sets(pa.array(texts, pa.string()))
    return [found[cuts[i]:cuts[i + 1]] for i in range(len(texts))]


def test_spots_are_chains_after_anchors():
    one, same, other, none, bare, single = spot_lists(
        ["the quick brown fox", "The QUICK, brown cats", "a quick brown fox", "...", "quick brown fox", "fox"])
    assert one.tolist() == same.tolist() and len(one) == 1  # the third content word is not in the chain
    assert other.tolist() != one.tolist() and len(none) == 0
    assert len(bare) == 2 and len(single) == 1


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.sampled_from([0.0, 0.3, 0.8]))
def test_pruned_jaccard(a, b, floor):
    got = spots.pruned_jaccard(np.array(sorted(a), np.uint32), np.array(sorted(b), np.uint32), floor)
    exact = jaccard(a, b)
    assert got == pytest.approx(exact) or (exact < floor and got == 0.0)


@pytest.mark.parametrize("which", ["odd", "table"])
def test_edited_fingerprints(odd_docs, table, which):
    docs = odd_docs if which == "odd" else table("documents")
    if which == "odd":  # rows of equal ids stand in hash order: each is there, and one of them is compared
        whole = spots.edited_fingerprints(docs).collect()
        assert Counter((r.doc_id, r.n_chars) for r in whole) == Counter((r.doc_id, len(r.text or "")) for r in docs.collect())
        docs = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = spots.edited_fingerprints(docs).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: -r[0])
    assert len(rows) == len(texts)
    sets = [set(x.tolist()) for x in spot_lists([t for _, t in texts])]
    by_id = {r.doc_id: r for r in rows}
    for k, (doc_id, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        r = by_id[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        [changed] = spot_lists([edited])
        assert r.fingerprint == spots.as_text(spot_lists([text])[0]) and r.edited_fingerprint == spots.as_text(changed)
        assert r.near_edited == pytest.approx(jaccard(sets[k], set(changed.tolist())))
        assert r.near_next == pytest.approx(jaccard(sets[k], sets[(k + 1) % len(texts)]))


def test_a_common_id_is_split(spark):
    """Rows of one id, and those without, go to several tasks and keep their order."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} of many") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = spots.with_next(docs, parts=9).where("not tail")
    sizes = [r["count"] for r in dealt.groupBy("part").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 250 and len(sizes) >= 6
    got = spots.edited_fingerprints(docs).collect()
    tie = {r.text: r.t for r in docs.select("text", F.xxhash64("text").alias("t")).collect()}
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], tie[r[1]]), reverse=True)
    wanted = Counter()
    for (i, own), (_, following) in zip(order, order[1:] + order[:1]):
        k = len(own) // 3
        wanted[i, hashlib.sha256((own[:len(own) - k] + following[:k]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == wanted


def test_edited_fingerprints_of_few(spark, no_docs):
    assert spots.edited_fingerprints(no_docs).collect() == []
    [only] = spots.edited_fingerprints(spark.createDataFrame([(5, "abcdefghi")], "doc_id long, text string")).collect()
    assert only.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest() and only.near_next == 1.0


def test_similar_pairs_equal_brute_force(table):
    docs = table("documents")
    sets = {}
    for r in docs.orderBy("doc_id").collect():
        [own] = spot_lists([r.text])
        if len(own):
            sets.setdefault(frozenset(own.tolist()), r.doc_id)
    items = [(i, s) for s, i in sets.items()]
    wanted = {(min(a, b), max(a, b)) for k, (a, x) in enumerate(items) for b, y in items[:k] if jaccard(x, y) >= 0.6}
    assert {(r.a, r.b) for r in spots.similar_pairs(docs, 0.6).collect()} == wanted and wanted


def test_blocks():
    page = ('<html><body class="with-sidebar"><div class="cookie-notice">We use</div><header>Top</header><main><header>'
            "<h1>T &amp; x</h1></header><p>a<br>b<i>c</i>d&nbsp;e<p>second<table><tr><td>1<td>2<tr><td>3</table>"
            '<div id="comments"><p>nice</p></div><!-- c <p> --><form>f</form><script>if (a < b) "</p>"</script></main>'
            "<aside>x</aside><footer>z</footer>")
    assert pagetext.page_blocks(page) == [(True, t) for t in ("T & x", "a bcd e", "second", "1 2", "3")]
    assert pagetext.page_blocks(None) == pagetext.page_blocks("") == []
    assert pagetext.page_blocks("a < b &lt;") == [(False, "a < b <")]
    assert pagetext.page_blocks("<p>un<b>closed <p>next") == [(False, "unclosed"), (False, "next")]
    assert pagetext.page_blocks('<div class="ad">x<article><p>y</p></article>') == [(True, "y")]


BODY = "<p>" + "the body of this page has many words of its own " * 12 + "</p>"


def texts(html):
    return [text[:8] for _, text in pagetext.page_blocks(html)]


def test_names_alone_lose_no_text():
    for box in ('article class="post comments-open"', 'div class="content has-sidebar"', 'div class="search-results ad-free"',
                'section class="social-science"', 'div class="widget"', 'div id="notice"', 'main class="sidebar"'):
        assert texts(f"<{box}>{BODY}</{box.split()[0]}>") == ["the body"], box
    # a teaser does not stand for the page, an article does, however many comments it has
    assert texts(f"<article><p>a teaser</p></article><div>{BODY}</div>") == ["a teaser", "the body"]
    comments = '<div class="comment-list">' + "<p>so nice a page</p>" * 200 + "</div>"
    assert texts(f"<article>{BODY}{comments}</article>") == texts(f"<article>{BODY}</article>{comments}") == ["the body"]
    for box in ('div class="ad-slot"', 'div class="site-footer"', 'section id="related-posts"', 'div role="navigation"'):
        assert texts(f"<{box}>little</{box.split()[0]}>{BODY}") == ["the body"], box


def test_suffix_ranks():
    tokens = np.random.default_rng(0).integers(0, 3, 200)
    rank = extraction.suffix_ranks(tokens, 8)
    cut = [tuple(tokens[i:i + 8].tolist()) for i in range(200)]
    assert all((rank[i] < rank[j]) == (cut[i] < cut[j]) for i in range(0, 200, 3) for j in range(200))


def page(article, *, tag="article", extra=""):
    return f"<nav>menu items</nav>{extra}<{tag}>{article}</{tag}><footer>foot</footer>"


def test_extraction(spark):
    furniture = "subscribe to our weekly letter now and never miss a single story again"
    rows = []
    for i in range(30):  # furniture inside the articles of a host, and free text without any article
        own = f"story number {i} has its own words like w{i} v{i}"
        rows.append((i, f"http://a.com/{i}", page(f"<p>{own}</p><p>{furniture}</p>")))
        rows.append((100 + i, f"http://B.com:80/{i}", page(f"<p>{own} {furniture}</p>", tag="div")))
    rows += [(200, None, None), (201, "", ""), (None, "nonsense", page("<p>kept</p>")),
             (202, "http://c.com", page("<p>twice</p>")), (202, "http://c.com", page("<p>twice</p>"))]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, section int, host string")
    got = extraction.extract(pages).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter(r[:2] for r in rows)
    text = {r.page_id: r.text for r in got}
    for i in range(30):
        own = f"story number {i} has its own words like w{i} v{i}"
        assert text[i] == own and text[100 + i] == own
    assert text[200] == text[201] == "" and text[None] == "kept" and text[202] == "twice"
    assert all(r.n_chars == len(r.text) for r in got)
    # sections of a large host decide alike
    split = {r.page_id: r.text for r in extraction.extract(pages, section_bytes=1500).collect()}
    assert split == text


def brute_texts(rows):
    """Page texts by counting every substring of a host in a dictionary."""
    hosts = {}
    for k, (page_id, url, html) in enumerate(rows):
        host = re.sub(r"^[a-zA-Z]+://", "", url or "").split("/")[0].split("?")[0].split("#")[0].split(":")[0].lower()
        hosts.setdefault(host, []).append((k, ("none", k) if page_id is None else page_id, pagetext.page_blocks(html)))
    out = {}
    run = extraction.RUN
    for found in hosts.values():
        holders, pages = {}, len({p for _, p, _ in found})
        cuts = lambda ws: [tuple(ws[i:i + run]) for i in range(max(1, len(ws) - run + 1))]
        for _, p, blocks in found:
            for _, text in blocks:
                for c in cuts(text.split(" ")):
                    holders.setdefault(c, set()).add(p)
        for k, _, blocks in found:
            kept, gone_words = [], 0
            for main, text in blocks:
                ws = text.split(" ")
                least = max(extraction.MAIN_PAGES, extraction.MAIN_SHARE * pages) if main else max(
                    extraction.PAGES, extraction.SHARE * pages)
                gone = set()
                for i, c in enumerate(cuts(ws)):
                    if len(holders[c]) >= least:
                        gone.update(range(i, i + len(c)))
                gone_words += len(gone)
                kept.append(" ".join(w for i, w in enumerate(ws) if i not in gone))
            words = sum(len(t.split(" ")) for _, t in blocks)
            if blocks and blocks[0][0] and gone_words > extraction.COPY * words:
                kept = [t for _, t in blocks]
            out[k] = "\n\n".join(t for t in kept if t)
    return out


def check_pages(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter((r.page_id, r.url, r.text) for r in extraction.extract(pages, **options).collect())
    wanted = brute_texts(rows)
    assert got == Counter((p, u, wanted[k]) for k, (p, u, _) in enumerate(rows))


def test_texts_equal_brute_force(spark, table):
    rows = [(r.page_id, r.url, r.html) for r in table("pages", "0.01").select("page_id", "url", "html").collect()]
    check_pages(spark, rows)
    check_pages(spark, rows[:300], section_bytes=60_000)


def host_pages(n, share, tag):
    notice = "all of our stories are checked by two editors before they appear on this site"
    return [(i, f"http://h.com/{i}", f"<{tag}><p>" + " ".join(f"w{i}x{k}" for k in range(60)) + "</p>"
             + (f"<p>{notice}</p>" if i < share * n else "") + f"</{tag}>") for i in range(n)]


def test_thresholds_are_those_of_the_host(spark):
    for n, size in ((12, 1 << 22), (12, 2_000), (600, 1 << 22), (600, 40_000), (3000, 200_000)):
        for tag, share, stays in (("div", 0.1, True), ("div", 0.5, False), ("article", 0.5, True), ("article", 0.75, False)):
            if n == 3000 and share not in (0.1, 0.75):
                continue
            pages = spark.createDataFrame(host_pages(n, share, tag), "page_id long, url string, html string")
            found = extraction.extract(pages, section_bytes=size).where("contains(text, 'two editors')").count()
            assert found == (int(share * n + 0.999) if stays else 0), (n, size, tag, share)


def test_very_long_page(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, "http://a.com/1", f"<article><p>{long}</p></article>"), (2, "http://a.com/2", "<p>short</p>")]
    check_pages(spark, rows, section_bytes=10_000)


def test_copied_articles_stay(spark):
    rows = [(i, f"http://a.com/{i}", page("<h1>Title</h1><p>the very same long article text on all of these pages</p>"))
            for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in extraction.extract(pages).collect()} == {
        "Title\n\nthe very same long article text on all of these pages"}
    assert extraction.extract(pages.limit(0)).collect() == []


def brute_nearest(rows, nearest):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for k, q in enumerate(ids):
        if q % 20 == 0:
            s = (x * x[k]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:nearest]
            out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def check_nearest(vectors, rows, nearest=20):
    got = {}
    for r in neighbours.search(vectors, F.col("vec_id") % 20 == 0, nearest).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    wanted = brute_nearest(rows, nearest)
    assert set(got) <= set(wanted)
    scores, hits, total = {q: dict(w) for q, w in wanted.items()}, 0, 0
    vector = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        assert all(f[2] == pytest.approx(float(vector[f[1]] @ vector[q]), abs=1e-12) for f in found)
        hits += len({f[1] for f in found} & set(scores[q]))
    total = sum(len(w) for w in wanted.values())
    return hits / total


def test_recall_on_the_tables(table):
    for sf in ("0.001", "0.01"):
        vectors = table("embeddings", sf)
        rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
        assert check_nearest(vectors, rows) >= 0.9


def test_norms_ties_copies_and_unusable_rows(spark):
    random = np.random.default_rng(3)
    rows = [(i, (random.normal(size=8) * random.uniform(0.2, 3)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # a common vector
    bad = [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [1.0, None] * 4),
           (2080, [float("inf")] * 8), (2100, [1.0]), (None, rows[1][1])]
    vectors = spark.createDataFrame([(i, v, k, k) for k, (i, v) in enumerate([*rows, *bad, rows[5]])],
                                    "vec_id long, embedding array<double>, score int, id int")
    assert check_nearest(vectors, rows) >= 0.9


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], schema)
    got = neighbours.search(few, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 1, 0.5), (2, 2, -1.0)]


@pytest.mark.parametrize("rows, size, max_probes", [(21, 24, neighbours.MAX_PROBES), (400, 24, 2)])
def test_short_queries_are_searched_exactly(spark, rows, size, max_probes):
    """A table with hardly more vectors than wanted, and queries whose buckets
    would pass the bound: all true neighbours come back."""
    x = np.random.default_rng(1).normal(size=(rows, size))
    x[:17] = x[0] + x[:17] * 0.05  # near ones and a few far ones
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    args = () if max_probes == neighbours.MAX_PROBES else (neighbours.NEAREST, max_probes)
    got = {}
    for r in neighbours.search(frame, F.col("vec_id") % 3 == 0, *args).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, rows, 3):
        order = [int(i) for i in np.argsort(-(x @ x[q]), kind="stable") if i != q]
        assert got[q] == order[:20]


def test_memory_of_probes_is_bounded():
    """An index drawn for 10^8 rows, with weak neighbours: every query runs out
    of its buckets, and what is held at once stays small."""
    index = neighbours.Index.draw(64, 10 ** 8, 1.0, 0.57, 3000)
    queries = np.random.default_rng(0).normal(size=(6, 64))
    tracemalloc.start()
    found = index.probes(queries)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
    assert len(found) == neighbours.TABLES and all(len(g) == len(b) for rows in found for g, b in rows)


def test_a_query_visits_few_groups():
    """At 10^7 rows and neighbours at similarity 0.9 a query goes to less than
    a tenth of the groups of buckets."""
    random = np.random.default_rng(1)
    groups = 305
    index = neighbours.Index.draw(64, 10 ** 7, 1.0, 0.9, groups)
    queries = random.normal(size=(40, 64))
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    near = 0.9 * queries + np.sqrt(1 - 0.81) * _beside(queries, random)
    place, numbers = index.buckets(near)
    met, visited = np.zeros(len(queries), bool), 0
    for table, rows in enumerate(index.probes(queries)):
        for q, (group, bucket) in enumerate(rows):
            visited += len(np.unique(group))
            met[q] |= numbers[table, q] in bucket.tolist()
            assert place[table, q] in group.tolist() or numbers[table, q] not in bucket.tolist()
    assert visited / (len(queries) * neighbours.TABLES * groups) < 0.1
    assert met.mean() >= 0.9


def _beside(queries, random):
    """Unit vectors at right angles to the queries."""
    other = random.normal(size=queries.shape)
    other -= (other * queries).sum(axis=1, keepdims=True) * queries
    return other / np.linalg.norm(other, axis=1, keepdims=True)


def test_huge_and_tiny_components(spark):
    """Vectors of huge and of tiny finite values give finite scores or none."""
    rows = [(i, (np.random.default_rng(i).normal(size=4) * s).tolist()) for i, s in enumerate([1e150, 1e150, 1.0, 1e-150, 1e-160, 1.0])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 2 == 0).collect()
    by_query = Counter(r.query_id for r in got)
    assert set(by_query) <= {0, 2, 4} and all(n <= 5 for n in by_query.values())
    assert all(r.score == float(np.dot(rows[r.query_id][1], rows[r.vec_id][1])) or abs(r.score) > 0 for r in got)
