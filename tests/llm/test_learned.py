"""The learned operators: held-out accuracy, layouts never seen in training, and odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.llm import html_extract, language, quality
from costlens.llm import language as L
from costlens.llm import queries as Q
from costlens.llm.common import table
from costlens.llm.html_blocks import blocks
from costlens.llm.html_extract import block_vectors

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "12 34 !!"), (5, "x"), (6, "😀 中文"), (7, "word " * 60_000), (7, "word " * 60_000), (None, "some text")]


def odd(spark):
    rows = [(i, None if t is None else t.encode("utf-16", "surrogatepass").decode("utf-16")) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS score", "'x' AS lang_pred")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, "/root/testdata/sf0.01", "documents")


def test_language_held_out(spark, docs):
    out = Q.QUERIES["op3_language"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"), F.avg(F.col("rejected").cast("double"))).first()
    assert held[0] > 0.98 and held[1] > 250 and held[2] < 0.01
    assert out.where("score < 0 or score > 1 or lang_pred = 'und' or held_out <> (crc32(cast(doc_id as string)) % 3 = 1)").count() == 0


def test_language_odd_inputs(spark, docs):
    model = Q.language_model(docs)
    got = language.predict_language(odd(spark), model).collect()
    assert len(got) == len(ODD)
    by = {r["id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["rejected"] and by[i]["score"] == 0 for i in (1, 2, 3, 4))
    assert by[7]["lang_pred"] in model.languages and by[None]["lang_pred"] in model.languages
    kept = language.drop_unidentified(odd(spark), model)
    assert kept.columns == odd(spark).columns and kept.where("doc_id between 1 and 4").count() == 0
    none = language.fit_language_model(docs.where("doc_id < 0"), F.lit(True))
    assert {r["lang_pred"] for r in language.predict_language(odd(spark), none).collect()} == {"und"}
    assert language.predict_language(odd(spark).where("doc_id > 99"), model).count() == 0


def test_gram_counts_whole_text():
    short = language.gram_counts("Ab c")
    assert short.sum() == 3 + 5 + 4  # letters; pairs and triples of _ab_c_
    assert language.gram_counts("7 8") is None
    long = "abc " * (language._CHUNK // 2)
    assert np.array_equal(language.gram_counts(long) - language.gram_counts(long[4:]), language.gram_counts("abc " * 9) - language.gram_counts("abc " * 8))


def test_quality_held_out(spark, docs):
    sf = "/root/testdata/sf0.01"
    out = Q.QUERIES["op10_quality"](spark, sf).join(table(spark, sf, "labels"), "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.97
    assert ((out.score >= 0) & (out.score <= 1)).all() and ((out.score >= 0.7) == (out.predicted == 1)).all()


def test_quality_learns_nothing_from_held_out_labels(spark, docs):
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.quality_model(docs, labels), Q.quality_model(docs, turned)
    assert all(np.array_equal(x, y) for x, y in zip(a.weights, b.weights)) and a.cut == b.cut and a.prior == b.prior


def test_quality_odd_inputs(spark, docs):
    model = Q.quality_model(docs, table(spark, "/root/testdata/sf0.01", "labels"))
    got = quality.score_quality(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["id"]: r["score"] for r in got}
    assert by[1] == by[2] == by[3] and by[7] < 0.7
    assert quality.drop_low_quality(odd(spark), model).columns == odd(spark).columns
    empty = quality.fit_quality_model(docs.where("doc_id < 0"), table(spark, "/root/testdata/sf0.01", "labels").where("doc_id < 0"), F.lit(True))
    assert quality.score_quality(odd(spark), empty).count() == len(ODD)


def test_nnpu_separates_without_negatives():
    rng = np.random.default_rng(0)
    pos = rng.normal(2, 1, (800, 3))
    unl = np.concatenate([rng.normal(2, 1, (400, 3)), rng.normal(-2, 1, (400, 3))])
    m = quality.fit_nnpu(pos, unl, 0.5)
    assert (m.raw(rng.normal(2, 1, (300, 3))) > 0).mean() > 0.95 and (m.raw(rng.normal(-2, 1, (300, 3))) < 0).mean() > 0.95


@pytest.fixture(scope="module")
def labeller(spark):
    return html_extract.fit_labeller(table(spark, "/root/testdata/sf0.01", "pages"))


def test_articles_of_the_given_pages(spark, labeller):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r["page_id"]: r for r in html_extract.extract_text(pages, labeller).collect()}
    right = 0
    for r in pages.collect():
        cut = blocks(r["html"])
        want = " ".join(b.text for b in cut if "article" in b.path)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
        right += got[r["page_id"]]["text"] == want
    assert right >= 0.98 * len(got)


def test_other_layouts(labeller):
    page = """<html><body><div class="cookie-notice"><p>We use cookies, please accept them all.</p><button>OK</button></div>
    <header><h2>Site</h2></header><nav><a href=/>Home</a> <a href=/x>News</a></nav><form><p>Sign up for our letter now</p><input></form>
    <main><h1>Title &amp; more</h1><p>First  long\nparagraph of the story with <b>bold</b>face words&nbsp;and a
    <a href="x">link</a> inside of it.</p><div class="ad">Buy this thing today, it is cheap and good.</div><p>Second long paragraph with plenty of words in it.<p>Third one, unclosed, with even more words to read in it.
    <ul><li>One item<li>Another item</ul></main>
    <aside class="sidebar"><h3>Related</h3><p>Other story teaser text goes here.</p></aside>
    <section class="comments"><h3>Comments</h3><p>I like this story a lot, thank you for it.</p></section><script>var x = "<p>no</p>";</script>
    <footer>&copy; 2020 Site and all of its owners</footer></body></html>"""
    want = ("Title & more First long paragraph of the story with boldface words and a link inside of it. Second long paragraph with "
            "plenty of words in it. Third one, unclosed, with even more words to read in it. One item Another item")
    assert html_extract.main_text([page], labeller) == [want]


def test_composed_layouts_held_out(labeller):
    composer = html_extract._Composer(["the quick brown fox jumps over a lazy dog and runs far away from here. " * 5], 77)
    wrong = total = 0
    for _ in range(150):
        page = blocks(composer.page())
        z = labeller.logits([html_extract.block_vectors(page)])[0]
        wrong += sum((s > 0) != (b.label > 0) for s, b in zip(z, page))
        total += len(page)
    assert wrong < 0.03 * total


def test_odd_pages(spark, labeller):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain text only"), (4, "u", "<p"), (5, "u", "<<>><a <b>&#x41;&bogus;"), (6, "u", "<!-- <p>x</p>"),
            (7, "u", "<article>" + "<p>some words in a long page.</p>" * 3000 + "</article>"), (7, "u", None), (None, "u", "</div></p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = html_extract.extract_text(df, labeller).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got if r["text"]}
    assert by[7].count("some words") == 3000
    assert html_extract.extract_text(df.where("page_id > 99"), labeller).count() == 0


def _random_labeller():
    d, h = html_extract.DIM, html_extract.HIDDEN
    rng = np.random.default_rng(3)
    return html_extract.Labeller([rng.normal(0, 0.1, n).astype(np.float32) for n in 2 * [(d, 4 * h), (h, 4 * h), (4 * h,)] + [(2 * h,), ()]])


def test_a_long_page_does_not_size_the_arrays_of_others():
    import tracemalloc

    model = _random_labeller()
    pages = ["<ul>" + f"<li>item {i} of a list" * (4000 if i == 200 else 3 + i % 5) + "</ul>" for i in range(256)]
    pages.append("<ul>" + "<li>one" * (html_extract.BATCH + 300))
    alone = [html_extract.main_text([p], model) for p in pages]
    tracemalloc.start()
    together = html_extract.main_text(pages, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [[t] for t in together] == alone and peak < 200e6, peak


def test_states_are_those_of_the_training_run():
    model, rng = _random_labeller(), np.random.default_rng(4)
    pages = [rng.normal(0, 0.3, (n, html_extract.DIM)).astype(np.float32) for n in (7, 0, 700, 256, 257, 1)]
    w = model.weights
    for p, z in zip(pages, model.logits(pages)):
        one = np.ones((len(p), 1), dtype=np.float32)
        h = [s[-1][0] for s in html_extract._run(p[:, None], one, *w[:3])]
        k = [s[-1][0] for s in html_extract._run(p[::-1][:, None], one, *w[3:6])][::-1]
        assert np.allclose(z, [np.concatenate(x) @ w[6] + w[7] for x in zip(h, k)], atol=1e-4)


def test_parts_of_a_training_batch_add_up(monkeypatch):
    rng = np.random.default_rng(6)
    pages = [rng.normal(0, 0.3, (n, html_extract.DIM)).astype(np.float32) for n in (5, 9, 3, 12, 7)]
    labels = [(rng.random(len(p)) < 0.5).astype(np.float32) for p in pages]
    whole = html_extract.train(pages, labels, epochs=1)
    monkeypatch.setattr(html_extract, "BATCH", 24)
    assert all(np.allclose(a, b, atol=1e-3) for a, b in zip(whole.weights, html_extract.train(pages, labels, epochs=1).weights))


def test_blocks():
    b = blocks("<ul><li>a<li><p>b <i>c</i>d<p>e</ul><td>f<td>g<br>h<style>x</style>&lt;&#233;")
    assert [x.text for x in b] == ["a", "b cd", "e", "f", "g h<é"]
    assert b[2].path == ("ul", "li", "p")


@pytest.mark.parametrize("inside, more", [
    ("<svg class=i/>", []), ('<svg viewBox="0 0 1 1"/>', []), ("<svg><style/><title/><path d='M0 0'/></svg>", []), ("<svg><path d=x><g>", []),
    ("<select name=q>", []), ("<object data=x>", []), ("<video src=x>", []), ("<video-player></video-player>", []), ("<select-menu/>", []),
    ("<script-x></script-x>", []), ("<script>var a = '<p>no</p>';</script >", []), ("<iframe src=x>no</iframe>", []), ("<textarea>no</textarea x>", []),
    ("<object>kept</object>", ["kept"]), ("<canvas><p>kept</canvas>", ["kept"]), ("<noscript><p>kept</p></noscript>", ["kept"]),
    ("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", ["if x=1 holds"]), ("<math/>", []), ("<svg><text>kept</text></svg>", ["kept"]),
    ("<svg><foreignObject><p>kept</p><p>too</p></foreignObject></svg>", ["kept", "too"])])
def test_no_element_swallows_the_article(inside, more):
    cut = blocks(f"<article><p>one</p>{inside}<p>two</p><p>three</p></article>")
    assert [b.text for b in cut] == ["one", *more, "two", "three"]
    assert all("article" in b.path and b.path[-1] == "p" for b in (cut[0], cut[-1]))


@pytest.mark.parametrize("value", ["12.5", "", "top", "1", "0", "-3", "²"])
def test_marks_of_corpus_pages_are_not_read(value):
    page = f'<article><div data-y="{value}"><p>one</p></div><p data-y=\'{value}\'>two</p></article>'
    assert [(b.text, b.label) for b in blocks(page, marked=False)] == [("one", 0), ("two", 0)]
    assert [b.label for b in blocks(page)] == [int(value == "1")] * 2
    model = _random_labeller()
    model.weights[-1] += 100
    assert html_extract.main_text([page], model) == ["one two"]


def test_an_icon_does_not_end_a_block():
    cut = blocks("<p>one <a href=x><svg><path d='M0'/></svg> two</a> three<p>four<svg><text>five</text></svg> six")
    assert [(b.path, b.text, b.linked) for b in cut] == [
        (("p",), "one two three", 4), (("p",), "four", 0), (("p", "svg", "text"), "five", 0), (("p",), "six", 0)]


def test_gradients_of_the_lstm():
    rng = np.random.default_rng(1)
    x, mask = rng.normal(size=(5, 3, html_extract.DIM)), np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], dtype=float)
    w, u, b = rng.normal(size=(html_extract.DIM, 16)) * 0.1, rng.normal(size=(4, 16)) * 0.1, rng.normal(size=16) * 0.1
    dout = rng.normal(size=(5, 3, 4))
    loss = lambda: sum((s[-1] * d).sum() for s, d in zip(html_extract._run(x, mask, w, u, b), dout))
    gw, gu, gb = html_extract._back(x, mask, w, u, html_extract._run(x, mask, w, u, b), dout)
    for p, g in ((w, gw), (u, gu), (b, gb)):
        at = tuple(rng.integers(n) for n in p.shape)
        old = p[at]
        p[at] = old + 1e-4
        up = loss()
        p[at] = old - 1e-4
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-4 - g[at]) < 1e-2 * max(1, abs(g[at]))


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<div>" * 5_000 + "</p>x" * 20_000, "<svg>" + "<g>y" * 50_000,
                                  "<article>" + "<span class=c{0}><div>x" * 30_000])
def test_deep_pages_take_room_and_time_by_their_length(page):
    import time
    import tracemalloc

    tracemalloc.start()
    began = time.perf_counter()
    cut = blocks(page)
    x = block_vectors(cut, 0, 500)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 and time.perf_counter() - began < 30 and len(x) == min(len(cut), 500)


def test_path_vector_is_the_set_of_its_words():
    import zlib

    from costlens.llm.html_extract import PATH_DIM

    b = blocks('<div class="a b"><ul id=menu><li>one</ul><p role=x>two</div>')
    for block in b:
        words = ["<<" + block.path[-1].split(" ")[0]]
        for names in block.path:
            words += ["<" + names.split(" ")[0], *names.split(" ")[1:]]
        want = {zlib.crc32(w.encode()) % PATH_DIM for w in words}
        assert set(np.flatnonzero(block_vectors([block])[0, :PATH_DIM])) == want


def test_a_language_of_one_repeated_row_is_learned(spark):
    rows = [(i, "der hund und die katze sind im haus", "de") for i in range(3000)]
    rows += [(5000 + i, f"the dog and the cat number {chr(97 + i % 26)} are in the house", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    for parts in (1, 5):
        model = L.fit_language_model(docs.repartition(parts), F.lit(True), per_language=20)
        assert model.languages == ["de", "en"]
        assert list(model.judge(["die katze und der hund", "the cat and the dog"])["lang_pred"]) == ["de", "en"]


def test_centroids_share_their_language_and_foreign_text_is_rejected(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = L.fit_language_model(docs, Q.fold("doc_id", 3) != 1)
    texts = [tuple(r) for r in docs.select("text", "lang").where("n_chars > 200").limit(2000).collect()]
    cos = model.vectors([L.gram_counts(t) for t, _ in texts]) @ model.centroids.T
    for i, lang in enumerate(model.languages):
        own = np.flatnonzero(model.owner == i)
        best = cos[[t[1] == lang for t in texts]][:, own].argmax(axis=1)
        share = np.bincount(best, minlength=len(own)) / len(best)
        assert len(own) >= 2 and (share > 0.02).sum() >= 2, (lang, share)
    judged = model.judge([t for t, _ in texts])
    assert judged["rejected"].mean() < 0.005
    rng = np.random.default_rng(0)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(300)]
    foreign = ["".join(chr(c) for c in rng.integers(0x430, 0x450, 400)), " ".join(noise), "漢字" * 50]
    assert model.judge(foreign)["rejected"].all()


def test_language_prediction_holds_few_texts_at_once(spark, monkeypatch):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcdefgh "), 30)) for _ in range(1000)]
    model = language.LanguageModel(np.ones(language.DIM, dtype=np.float32), ["x", "y"], np.array([0, 1]),
                                   rng.random((2, language.DIM)).astype(np.float32), np.zeros(2))
    sizes = []
    monkeypatch.setattr(language.LanguageModel, "cosines", lambda self, x: sizes.append(len(x)) or x @ self.centroids.T)
    got = model.judge([*texts, None, "7"])
    assert max(sizes) <= 256 and sum(sizes) == sum(t.strip() != "" for t in texts) and list(got["lang_pred"][-2:]) == ["und", "und"]
    monkeypatch.undo()
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "7"])], "doc_id long, text string").coalesce(1)
    rows = {r["id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in language.predict_language(df, model).collect()}
    assert len(rows) == 1002 and all(rows[i][0] == p and abs(rows[i][1] - s) < 1e-5 for i, (p, s) in enumerate(zip(got["lang_pred"], got["score"])))
