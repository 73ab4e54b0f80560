"""Exact inference against enumeration, and the trained models on held-out rows."""

import itertools
import math
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from harmlens.llm import chain, compression_quality, labelled_pages, labels, page_text, toxicity_spans, tree_model
from harmlens.llm import queries as q
from harmlens.llm.batches import texts_of
from harmlens.llm.page_tree import parse

from .helpers import ODD_TEXTS, clashing, documents, prose


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    n, first = 9, np.array([1, 0, 0, 0, 1, 0, 1, 0, 0], bool)
    u, start, moves = rng.normal(size=n), rng.normal(size=2), rng.normal(size=(2, 2))
    total, one, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for s in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(u[i] * s[i] + (start[s[i]] if first[i] else moves[s[i - 1], s[i]]) for i in range(n)))
        total += w
        one += w * np.array(s)
        for i in np.flatnonzero(~first):
            pairs[s[i - 1], s[i]] += w
    assert np.allclose(chain.marginals(u, first, start, moves), one / total)
    tags = rng.integers(0, 2, n)
    d_unary, _, d_moves = chain.log_likelihood_gradient(u, first, start, moves, tags)
    observed = np.zeros((2, 2))
    for i in np.flatnonzero(~first):
        observed[tags[i - 1], tags[i]] += 1
    assert np.allclose(d_moves, observed - pairs / total) and np.allclose(d_unary, tags - one / total)


def test_chain_of_extreme_potentials_is_finite():
    u = np.array([800.0, -800.0] * 5000)
    p = chain.marginals(u, np.arange(len(u)) % 100 == 0, np.zeros(2), np.array([[3.0, -3.0], [-3.0, 3.0]]))
    assert np.isfinite(p).all() and (p[::2] > 0.99).all()


def test_tree_marginals_equal_enumeration():
    page = parse("<div class='a'><p>one, two.</p><ul><li>three</li><li><a href=x>four</a></li></ul></div>")
    forest = tree_model.Forest.of([page])
    rng = np.random.default_rng(1)
    model = tree_model.Model(rng.normal(size=tree_model.BUCKETS), rng.normal(size=(2 * len(tree_model.KINDS), 2, 2)))
    own = np.bincount(forest.owner, model.weights[forest.flat], minlength=len(forest.parent))
    total, one = 0.0, np.zeros(len(own))
    for s in itertools.product((0, 1), repeat=len(own)):
        w = np.exp(sum(own[i] * s[i] for i in range(len(own))) + sum(model.pairs[forest.kind[i]][s[forest.parent[i]], s[i]] for i in range(1, len(own))))
        total += w
        one += w * np.array(s)
    p, pair = tree_model.marginals(forest, model)
    assert np.allclose(p, one / total)
    assert np.allclose(pair[1:].sum(axis=(1, 2)), 1) and np.allclose(pair[1:, :, 1].sum(axis=1), p[1:])


def test_pages_of_unseen_frames():
    html = """<html><body><div id="cookie-notice">We use cookies. <button>OK</button></div><header><h1>Site</h1></header>
    <div class="breadcrumb"><a href=/>Home</a></div><main><article class="post"><h1>Title &amp; more</h1><p>First   para&nbsp;one.<p>Second
    <a href=x>link</a> here.<ul><li>item one<li>item two</ul><div class="ad-slot">Buy now</div><aside class="related"><a href=a>Other</a></aside>
    <p>Third &lt;tag&gt; text.</p><section class="comments"><h3>Comments</h3><div class="comment"><p>Nice article, I liked it a lot. Good.</p></div>
    </section></article></main><aside id="sidebar"><h3>Popular</h3><p>Some long sidebar text that goes on. And on.</p></aside>
    <form><p>Subscribe to our list.</p><input></form><footer><p>&copy; 2020 All rights.</p></footer></body></html>"""
    wanted = "Title & more\nFirst para one.\nSecond link here.\nitem one\nitem two\nThird <tag> text."
    assert page_text.main_texts([html, "", "<p>only", "plain words", "<div>" * 3000 + "deep"], page_text.default_model()) == [
        wanted, "", "only", "plain words", "deep"]


def test_held_out_labelled_pages():
    pages = labelled_pages.pages(120, seed=77)
    found = page_text.main_texts([p.replace(' data-y="1"', "").replace(' data-y="0"', "") for p in pages], page_text.default_model())
    right = kept = wanted = 0
    for page, text in zip(pages, found):
        lines = {n.text for n in parse(page).nodes if n.tag == "#text" and n.label == 1}
        got = set(text.split("\n")) - {""}
        right, kept, wanted = right + len(lines & got), kept + len(got), wanted + len(lines)
    assert right / kept > 0.97 and right / wanted > 0.97


def test_given_pages_give_their_articles(spark, sf_dir):
    import html
    import re

    raw = {r.page_id: r.html for r in q.table(spark, sf_dir, "pages").collect()}
    rows = q.op1(spark, sf_dir).collect()
    assert len(rows) == len(raw)
    for r in rows:
        article = raw[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_text_after_and_inside_embedded_elements():
    lines = lambda html: [n.text for n in parse(html).nodes if n.tag == "#text"]
    assert lines("<p>a</p><svg-icon name='x'></svg-icon><p>main text</p>") == ["a", "main text"]
    for name in ("video-player", "select-menu", "title-bar", "style-guide", "script-x", "template-a", "math-field", "object-view"):
        assert lines(f"<p>a <{name}>b</{name}> c</p><p>d</p>") == ["a b c", "d"]
    assert lines("<p>a<svg width='1' />b</p><p>c <math/> d</p>") == ["a b", "c d"]
    assert lines("<svg><title/><style/><path d='M0'/></svg><p>a</p><svg><title>t</title></svg><p>b</p>") == ["a", "b"]
    assert lines("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]
    assert lines("<p>a <svg class='i'><title>t</title><path/></svg> b <video><source></video> c") == ["a b c"]
    for tag in ("noscript", "svg", "iframe", "object", "canvas", "audio", "video", "select", "datalist"):
        page = parse(f"<p>a <{tag} class='x'>b</{tag}> c</p><div>d</div>")
        assert [(n.text, page.nodes[n.parent].tag) for n in page.nodes if n.tag == "#text"] == [("a", "p"), ("b", tag), ("c", "p"), ("d", "div")]
        assert lines(f"<div><p>a <{tag}></p><p>b</p></div>c</{tag}>") == ["a", "b", "c"]
    assert lines("<select><option>a<option>b</select><object><p>c<div>d</div></object>e") == ["a b", "c", "d", "e"]
    for tag in ("script", "style", "template", "title", "textarea"):
        assert lines(f"a<{tag} x='>'>b<p>c</{tag}>d") == ["a d"]


def test_articles_keep_embedded_text():
    prose = "Some words of the article stand here, and they go on. A second sentence follows the first one."
    for tag in ("noscript", "object", "video", "audio", "canvas", "iframe"):
        html = f"""<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/x>More</a></li></ul></nav><article><h1>Title of it</h1><p>{prose}</p>
        <title-bar></title-bar><svg width="2"/><{tag}><p>Inside: {prose}</p></{tag}><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds. {prose}</p>
        <select><option>red<option>green<option>blue</select><p>Last. {prose}</p></article><footer><p>&copy; 2020 All rights.</p></footer></body></html>"""
        wanted = ["Title of it", prose, f"Inside: {prose}", f"So x=2 holds. {prose}", f"Last. {prose}"]
        assert page_text.main_texts([html], page_text.default_model()) == ["\n".join(wanted)], tag


def test_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "<script>x"), (4, "<!-- only -->"), (None, "<p>a</p>"), (4, "<!-- only -->"), (5, "<p " + "x" * 100_000)]
    df = clashing(spark.createDataFrame(rows, "page_id bigint, html string"))
    assert sorted((r.page_id or 0, r[page_text.TEXT]) for r in page_text.extracted(df.select("page_id", "html")).collect()) == [
        (0, "a"), (1, ""), (2, ""), (3, ""), (4, ""), (4, ""), (5, "")]
    assert page_text.extracted(df).filter("false").count() == 0


def test_comments_end_where_the_standard_says():
    lines = lambda html: [n.text for n in parse(html).nodes if n.tag == "#text"]
    for comment in ("<!-->", "<!--->", "<!-- x -->", "<!-- x --!>", "<!-- a > b -- c -->", "<!--[if IE]><p>x</p><![endif]-->", "<!x>", "<?x?>", "</ x>", "</>"):
        assert lines(f"<p>A</p>{comment}<p>B</p>") == ["A", "B"], comment
    assert lines("<!--[if !IE]><!--><p>A</p><!--<![endif]--><![if IE]>B<![endif]>") == ["A", "B"]
    assert lines("A<!-- never closed <p>B</p>") == ["A"]
    assert lines("A<script>x</script foo><p>B") == ["A", "B"]


def test_frames_are_seen_through_many_utility_classes():
    prose = "Some words of the article stand here, and they go on. A second sentence follows the first one."
    looks = [f"{a}-{b}" for a in ("px", "mt", "md:flex", "text", "lg:grid", "hover:bg") for b in ("4", "row", "sm", "gray", "lead")][:26]
    wrap = lambda inner, n: f'<div class="{" ".join(looks)}">' * n + inner + "</div>" * n
    links = "<ul>" + "".join(f"<li><a href=/{k}>Page {k}</a></li>" for k in range(5)) + "</ul>"
    story = f"<h3>Popular</h3><p>{prose}</p>"
    for n in (1, 3):
        for tag, frame, inner in (("aside", "sidebar", story), ("footer", "site-footer", story), ("div", "ad-slot", story), ("nav", "main-menu", links),
                                  ("section", "comments", f'<h3>Comments</h3><div class="comment"><p>{prose}</p></div>')):
            main = wrap(f"<h1>Title of it</h1><p>{prose}</p><p>More. {prose}</p>", n)
            html = (f"<html><body><header class='site-header'>{wrap('<p>Site</p>', n)}</header><main class=\"{' '.join(looks)}\"><article>{main}</article></main>"
                    f'<{tag} class="{frame}">{wrap(inner, n)}</{tag}></body></html>')
            assert page_text.main_texts([html], page_text.default_model()) == [f"Title of it\n{prose}\nMore. {prose}"], (n, frame)


@pytest.mark.parametrize("html", [
    "<div>" * 20_000 + "</section>" * 100_000, "<svg>" * 50_000, "<svg></svg>" * 50_000, "<p><article><div>" + "<section>" * 20_000 + "<p></p>" * 20_000,
    "".join(f"<div class='nav c{i}'>" for i in range(20_000)) + "x", "<!--" * 50_000, "<script>" * 50_000])
def test_pages_are_read_in_linear_time(html):
    model = page_text.default_model()
    begin = time.process_time()
    page_text.main_texts([html], model)
    assert time.process_time() - begin < 6


def test_fold_is_the_crc_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id bigint")
    got = {r.doc_id: r.h for r in df.withColumn("h", labels.is_fold("doc_id", 4, 2)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)} | {None: False}


@pytest.mark.parametrize("name, target, folds, held, least, most", [
    ("op2_toxicity_spans", "toxic", 3, 1, 0.8, 0.03), ("op6_compression_quality", "quality", 4, 2, 0.9, 0.15)])
def test_held_out_rows_by_language(name, target, folds, held, least, most, spark):
    """Recall and false-positive rate of rows that no label was learnt from, in every language and in all of them."""
    path = "/root/testdata/sf0.1"
    rows = q.QUERIES[name](spark, path).join(q.table(spark, path, "labels"), "doc_id").join(q.table(spark, path, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    outside = [r for r in rows if r.held_out]
    for lang in {r.lang for r in outside}:
        found = {y: [r.predicted for r in outside if r.lang == lang and r[target] == y] for y in (0, 1)}
        assert sum(found[1]) / len(found[1]) >= least, lang
        assert sum(found[0]) / len(found[0]) <= most, lang
    right = sum(r.predicted == r[target] for r in outside) / len(outside)
    always = max(sum(r[target] for r in outside), sum(1 - r[target] for r in outside)) / len(outside)
    assert right >= 0.96 and right > always


def test_toxicity_learns_nothing_from_held_out_labels(spark, sf_dir):
    docs, given = q.texts(spark, sf_dir), q.table(spark, sf_dir, "labels")
    flipped = given.withColumn("toxic", F.when(labels.is_fold("doc_id", 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity_spans.fit(docs, x) for x in (given, flipped))
    assert (a.weights == b.weights).all() and (a.moves == b.moves).all() and (a.calibration == b.calibration).all()


def test_training_texts_are_whole_and_bounded(spark):
    rows = [(i, f"text {i} " + "x" * (1000 + i)) for i in range(200)] + [(500, "y" * 30_000), (501, None)]
    given = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    sample = labels.training_sample(documents(spark, rows), given, "quality", 4, 2, 60, 40_000)
    texts = {t or "" for _, t in rows}
    assert all(t in texts for t, _ in sample)
    for y in (0, 1):
        own = [t for t, label in sample if label == y]
        assert 30 <= len(own) <= 60 and sum(map(len, own)) <= 40_000
        assert "y" * 30_000 not in own  # alone above a tenth of the bytes
    assert sample == labels.training_sample(documents(spark, rows[::-1]), given, "quality", 4, 2, 60, 40_000)
    assert len(labels.training_sample(documents(spark, rows), given, "quality", 4, 2, 1000, 1 << 30)) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)


def test_quality_score_equals_its_definition(spark, sf_dir):
    """Sizes of every block under both dictionaries, one block and one text at a time."""
    docs = q.texts(spark, sf_dir)
    model = compression_quality.fit(docs, q.table(spark, sf_dir, "labels"))
    packers = [zstandard.ZstdCompressor(level=model.settings.level, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
               for d in (model.good, model.bad)]

    def score(text):
        data = (text or "").encode()
        blocks = [data[at : at + model.settings.block_bytes] for at in range(0, len(data), model.settings.block_bytes)]
        good, bad = (sum(len(p.compress(b)) for b in blocks) for p in packers)
        d = 10 * (bad - good) / (bad + good) if blocks else 0.0
        r = (good + bad) / (2 * len(data)) if blocks else 0.0
        z = sum(w * x for w, x in zip(model.weights, [d, r, d * abs(d), r * r, d * r])) + model.weights[5]
        return 1 / (1 + math.exp(-z))

    both = docs.unionByName(documents(spark, ODD_TEXTS).select("doc_id", "text"))
    for row in compression_quality.scored(both, model).collect():
        assert math.isclose(row[compression_quality.SCORE], score(row.text), rel_tol=1e-6, abs_tol=1e-9)


def test_spans_take_linear_time_and_equal_decoded_offsets():
    text = "é foul x 漢字 foul foul 😀 y " * 3000
    held = texts_of(pa.array(["", text, None, "foul"]))
    start, stop, row = held.words()
    p = np.array([0.9 if held.decode(a, b) == "foul" else 0.1 for a, b in zip(start, stop)])
    begin = time.process_time()
    spans = toxicity_spans.spans_of(held, start, stop, row, p, 0.5)
    assert time.process_time() - begin < 1
    assert [text[s["start"] : s["end"]] for s in spans[1]] == ["foul", "foul foul"] * 3000
    assert spans[0] == spans[2] == [] and spans[3] == [{"start": 0, "end": 4, "p": 0.9}]


def test_classifiers_learn_nothing_from_held_out_labels(spark, sf_dir):
    docs, given = q.texts(spark, sf_dir), q.table(spark, sf_dir, "labels")
    flipped = given.withColumn("quality", F.when(labels.is_fold("doc_id", 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (compression_quality.fit(docs, x) for x in (given, flipped))
    assert a.good == b.good and a.bad == b.bad and (a.weights == b.weights).all()


def test_odd_texts_and_labels(spark):
    docs = clashing(documents(spark, ODD_TEXTS))
    for rows in ([], [(1, None, None)], [(4, 1, 1), (4, 0, 0), (None, 1, 1), (99, 0, 0)], [(4, 1, 1), (6, 0, 0), (7, 0, 0), (8, 1, 0)]):
        given = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
        for module, score in ((compression_quality, compression_quality.SCORE), (toxicity_spans, toxicity_spans.SCORE)):
            scored = module.scored(docs, module.fit(docs, given))
            assert scored.columns[: len(docs.columns)] == docs.columns
            values = [(r.doc_id, r.text, r[score]) for r in scored.collect()]
            assert len(values) == len(ODD_TEXTS) and all(0 <= s <= 1 for *_, s in values)
            empty = {s for _, t, s in values if not t}
            assert len(empty) == 1
    none = docs.filter("false")
    assert toxicity_spans.scored(none, toxicity_spans.fit(none, given)).count() == 0


def test_spans_are_code_points():
    sample = [(prose(k, 30).split() + [f"foul{k}" if k % 2 else f"nice{k}"] + prose(-k, 30).split(), k % 2) for k in range(200)]
    model = toxicity_spans.fit_tokens(sample, toxicity_spans.Settings())
    text = "😀é fine foul3, fine"
    held = texts_of(pa.array([text, ""]))
    start, stop, row = held.words()
    scores = toxicity_spans.WordScores(model).of(held, held.span_hashes(held.prefix_sums(False), start, stop), start, stop)
    p = chain.marginals(scores, np.diff(row, prepend=-1) > 0, model.start, model.moves)
    spans = toxicity_spans.spans_of(held, start, stop, row, p, 0.5)
    assert [text[s["start"] : s["end"]] for s in spans[0]] == ["foul3,"] and spans[1] == []
