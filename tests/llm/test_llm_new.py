"""HTML extraction, whitening and the Merkle manifest against expected texts, a dense solver and a plain tree."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import CLASH, SCHEMA, prose

from daypanel.llm import html_extract, merkle_manifest, whitening

LONG = "Long sentence of the article. " * 5

PAGES = {
    "article": (
        "<title>t</title><nav><a href='/x'>menu</a></nav><div class='ad'>buy</div><article><h1>Head</h1><p>a &amp; b\n c"
        "<p>d<br>e &lt;i&gt;</p><script>var t='</p>';</script></article><footer>&copy; f</footer>",
        "Head\n\na & b c\n\nd e <i>",
    ),
    "short article": ("<body><article><p>x</p></article></body>", "x"),
    "unclosed": ("<article><h1>H</h1><p><b>one<p>two <i>three", "H\n\none\n\ntwo three"),
    "notices inside": (
        "<main><p>one</p><div id='cookie-consent'><p>we use</p></div><p>two<span class='ad'>ad<span>x</span></span> three</p>"
        "<section class='comments'><article class='comment'><p>me first</p></article></section>"
        "<aside>side</aside><form><p>mail</p><button>go</button></form></main>",
        "one\n\ntwo\n\nthree",
    ),
    "header inside": ("<article><header><h1>Title</h1><p>by me</p></header><p>t</p></article>", "Title\n\nt"),
    "layout words": (f"<div class='no-sidebar'><div class='sidebar'>s</div><p>{LONG}</p></div>", LONG.strip()),
    "main in a muted part": ("<div class='widget'><main><p>kept</p></main></div><p>gone</p>", "kept"),
    "no article": (
        f"<ul><li><a href='/'>home</a><li><a href='/a'>about</a></ul><h2>Head</h2><p>{LONG}</p><p>short</p><p>{LONG}</p>"
        "<div role='contentinfo'>imprint</div>",
        f"Head\n\n{LONG.strip()}\n\nshort\n\n{LONG.strip()}",
    ),
    "only short lines": ("<p>one<p>two", "one\n\ntwo"),
    "references": ("<article><p>&#65;&#x42;&ampc &notanentity; &nbsp;&eacute;</p></article>", "AB&c ¬anentity; é"),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b\n\nc"),
    "comment": ("<article><p>a<!-- <p>no</p> -->b</p><!-- rest <p>c", "ab"),
    "hidden": ("<article><p hidden>x</p><p style='display: none'>y</p><p>z</p></article>", "z"),
    "stray signs": ("<article><p>1 < 2 & 3 > 2 </ x> <3</p></article>", "1 < 2 & 3 > 2 <3"),
    "teasers": ("<article><p>text</p><div class='related'><article><p>other</p></article></div></article>", "text"),
    "capitals": ("<ARTICLE><P CLASS=AD>x</P><P>Y</P></ARTICLE>", "Y"),
    "nothing": ("<nav>a</nav>", ""),
    "empty": ("", ""),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, text = PAGES[name]
    assert html_extract.main_text(page) == text


def test_surge_and_dive():
    def kept(sizes, threshold):
        return np.flatnonzero(html_extract.between_surge_and_dive(np.array(sizes, np.int64), threshold)).tolist()

    assert kept([], 5) == []
    assert kept([0, 0, 0], 5) == []
    assert kept([5, 0, 0, 0, 50, 60, 0, 70, 0, 0, 0, 4], 86) == [4, 5, 7]  # a gap shorter than the window is no dive
    assert kept([3, 2, 0, 0, 0, 1], 86) == [0, 1]  # nothing surges, so the largest sum counts
    assert kept([3, 2, 0, 0, 0, 1], 0) == [0, 1, 5]


def test_windows_by_their_definition():
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([0, 0, 3, 40, 90]) for _ in range(rng.randint(1, 25))]
        sums = [sum(sizes[i : i + html_extract.WINDOW]) for i in range(len(sizes))]
        threshold = min(html_extract.SURGE, max(sums) - 1) if max(sums) else html_extract.SURGE
        want, on = [], False
        for i, s in enumerate(sums):
            on = (on or s > threshold) and s > 0
            want.append(on and sizes[i] > 0)
        got = html_extract.between_surge_and_dive(np.array(sizes, np.int64), html_extract.SURGE)
        assert got.tolist() == want


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 100_000 + "<i></i>" * 100_000 + "x",
        "<div>" * 100_000 + "</p>" * 100_000 + "x",
        "<p a='" * 100_001 + "x",
        "<a href=\"" * 100_001,
        "<!--" * 200_000,
        "<" * 500_000 + "&" * 500_000,
        "<script>" * 100_000,
        "<article>" + "<p>" + "word " * 400_000,
    ],
)
def test_long_and_broken_pages(page):
    import time

    start = time.perf_counter()
    html_extract.main_text(page)
    assert time.perf_counter() - start < 10


def test_pages_with_clashing_names(spark):
    rows = [(i, f"u{i}", page, "x", "y", 1) for i, (page, _) in enumerate(PAGES.values())]
    rows = [*rows, *rows[:3], (None, None, "<article><p>q</article>", None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, page string, n_chars long")
    got = Counter(tuple(r) for r in html_extract.digest(pages.repartition(3)).collect())
    texts = [text for _, text in PAGES.values()] + ["article"]
    want = Counter((i, f"u{i}", texts[i], len(texts[i])) for i in range(len(PAGES)))
    want += Counter((i, f"u{i}", texts[i], len(texts[i])) for i in range(3)) + Counter([(None, None, "q", 1)])
    assert got == want
    assert html_extract.digest(pages.filter("false")).collect() == []
    carried = html_extract.extract(pages).select("page.*").collect()
    assert Counter(map(tuple, carried)) == Counter(rows)


# Whitening


def check_whitened(rows, vectors, ids):
    """Rows of ``whiten`` against a dense solver; ``vectors`` in whole units."""
    fit = sorted(set(map(tuple, vectors)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean, values, basis = whitening.brute_force(vectors)
    shown = min(4, len(sums))
    alive = [v > 1e-9 * max(values[0], 1e-300) for v in values[:shown]]
    assert Counter((r.vec_id, r.component) for r in rows) == Counter((i, k + 1) for i in ids for k in range(shown))
    signs: dict = {}
    by_id = dict(zip(ids, vectors))
    for r in rows:
        x = by_id[r.vec_id]
        assert (r.n, r.deviation) == (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)))
        if not alive[r.component - 1]:
            assert r.whitened is None
            continue
        want = float((np.array(x) - mean) @ basis[:, r.component - 1]) / math.sqrt(values[r.component - 1])
        if abs(want) > 1e-6:
            sign = signs.setdefault(r.component, want * r.whitened > 0)
            assert sign == (want * r.whitened > 0)
        assert abs(abs(want) - abs(r.whitened)) < 1e-8
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
        assert r.identity_error < 1e-9


def vectors_of(seed, n, d):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(1, 3, d)).round(2).tolist()


def in_units(vectors):
    return [[math.floor(256 * c) for c in v] for v in vectors]


@pytest.mark.parametrize("n, d, parts", [(60, 7, 20), (300, 16, 3), (5, 9, 4), (40, 1, 2), (12, 3, 40)])
def test_whitened(spark, n, d, parts):
    vectors = vectors_of(n, n, d)
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(parts)
    check_whitened(whitening.whiten(rows).collect(), in_units(vectors), list(range(n)))


def test_odd_embeddings(spark):
    good = vectors_of(1, 40, 5)
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0, None, 0.0, 0.0, 0.0], [nan, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0, -inf, 0.0, 0.0], [1.0, 2.0], [1e300] * 5]
    rows = [(i, v, 1, "x", 5) for i, v in enumerate(good + odd)]
    schema = "vec_id long, embedding array<double>, label int, x string, component int"
    table = spark.createDataFrame(rows + rows[:7] + rows[:7], schema).repartition(4)
    got = whitening.whiten(table).collect()
    assert len(got) == 4 * (40 + 14)
    once = {(r.vec_id, r.component): r for r in got}
    assert all(once[r.vec_id, r.component] == r for r in got)
    check_whitened(list(once.values()), in_units(good), list(range(40)))


def test_few_or_equal_embeddings(spark):
    def whiten(vectors):
        return whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")).collect()

    assert whiten([]) == []
    assert whiten([None, [float("nan")]]) == []
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 3):
        rows = whiten(vectors)
        assert len(rows) == 2 * len(vectors)
        assert all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in rows)
    flat = [[float(i % 3), 2.0 * (i % 3), 5.0] for i in range(9)]  # one direction with variance
    check_whitened([r for r in whiten(flat)], in_units(flat), list(range(9)))


def test_spectrum_of_parts():
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(120, 6)) * 50).astype(np.int64)
    rows[:, 2] = rows[:, 3]  # no full rank
    rows[20:60] = rows[0]  # many repeats
    whole, parts = whitening.Spectrum(6), [whitening.Spectrum(6) for _ in range(3)]
    whole.add(rows)
    for own, part in zip(parts, (rows[:1], rows[1:40], rows[40:])):
        own.add(part)
    for other in parts[1:]:
        parts[0].combine(other)
    away = rows - rows.mean(0)
    want = away.T @ away
    for got in (whole, parts[0]):
        assert got.n == 120 and got.sums == rows.sum(0).tolist()
        assert np.allclose(got.vectors @ np.diag(got.values) @ got.vectors.T, want, atol=1e-9 * want.max())
        assert np.allclose(got.vectors.T @ got.vectors, np.eye(6), atol=1e-12)


def test_secular_roots():
    rng = np.random.default_rng(6)
    for m in (1, 2, 3, 10, 40):
        d = np.sort(rng.uniform(0, 10, m))
        w = 10 ** rng.uniform(-12, 1, m)
        got = d + whitening.secular_roots(d, w)[np.arange(m), np.arange(m)]
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(w), np.sqrt(w)))
        assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_exact_deviations():
    rows = np.array([[1 << 40, -3], [0, 5]], np.int64)
    assert whitening.deviations(rows, 2, [1 << 40, 2], 1 << 40) == [None, None]
    assert whitening.deviations(rows, 1, [1 << 40, 0], 1 << 40) == [9, None]
    assert whitening.deviations(rows[1:], 3, [1, 2], 5) == [1 + 13 * 13]


# Merkle manifest


def table_rows(documents):
    return [tuple(r) for r in documents.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def check_manifest(documents, levels=merkle_manifest.LEVELS):
    got = Counter(tuple(r) for r in merkle_manifest.digest(documents, levels).collect())
    want = Counter(merkle_manifest.brute_force(table_rows(documents)))
    assert got == want and got
    return got


@pytest.mark.parametrize("levels", [6, 1, 2])
def test_manifest(odd_documents, levels):
    check_manifest(odd_documents, levels)


def test_manifest_in_copies(spark, monkeypatch):
    """Node rows in several copies, a group with most rows, groups of one row, many groups."""
    monkeypatch.setattr(merkle_manifest, "SERVED", 4)
    langs = ["hot"] * 150 + [None] * 9 + [f"l{i}" for i in range(40)] + ["é", "日", "Z", ""]
    rows = [(i * 3 % 97, prose(i, 5), lang, "s", i, *CLASH) for i, lang in enumerate(langs)]
    got = check_manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), 2)
    assert {r[6] for r in got} == {True, False}


def test_manifest_of_repeated_rows(spark):
    rows = [(7, "same", "en", "s", 4, *CLASH)] * 70 + [(None, "same", "en", "s", 4, *CLASH)] * 5
    check_manifest(spark.createDataFrame(rows, SCHEMA).repartition(4))


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 129])
def test_manifest_sizes(spark, n):
    rows = [(i, f"t{i}", "en", None, i, *CLASH) for i in range(n)]
    check_manifest(spark.createDataFrame(rows, SCHEMA))


def test_manifest_of_nothing(empty_documents):
    assert merkle_manifest.digest(empty_documents).collect() == []


def test_recursion_limit_is_put_back(spark, odd_documents):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "12345")
    try:
        merkle_manifest.digest(odd_documents)
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "12345"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
