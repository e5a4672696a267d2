import itertools
import random
import time
import tracemalloc

import numpy as np
import pytest

from feedloom.llm import extraction as ex
from feedloom.llm.page_blocks import blocks_of, nested

SCHEMA = "page_id long, url string, html string, text string, id long"


def _pages(spark, rows):
    return spark.createDataFrame([(n, u, h, "x", 1) for n, (u, h) in enumerate(rows)], SCHEMA).repartition(2)


def _page(rng, form="article"):
    def line(n):
        return " ".join(rng.choice(["snow", "the", "river", "Émile", "of", "went", "&amp;", "home,"]) for _ in range(n)) + "."

    text = [line(rng.randint(4, 40)) for _ in range(rng.randint(1, 6))]
    start, end = {"article": ("<article>", "</article>"), "div": ('<div class="post-content">', "</div>")}[form]
    body = start + "".join(f"<p>{t}</p>" if rng.random() < 0.8 else f"<p><b>{t}<br>" for t in text)
    if rng.random() < 0.5:
        body += f'<div class="comments"><p>{line(12)}</p><p>{line(5)}</p></div>'
    body += end
    html = (f"<html><head><title>{line(4)}</title><style>p{{}}</style></head><body><nav><ul><li><a href=/a>{line(1)}</a></ul></nav>"
            f"<!-- note --><div class='ad'>{line(8)}</div>{body}<aside>{line(9)}</aside><footer>&copy; {line(10)}</footer></body></html>")
    return html, "\n".join(" ".join(t.replace("&amp;", "&").split()) for t in text)


def test_blocks():
    html = """<body>lead &eacute;<div class="Main-text" id=x>a<br>b <i>c</i><p>d<p>e</div>tail<script>no</script><ul><li>f<li>g</ul>
        <table><tr><td>1<td>2</table><form>h<textarea>no</textarea></form><a href=x>i</a>"""
    got = [(b.text, b.around[-1], b.linked) for b in blocks_of(html)]
    assert got == [
        ("lead é", ("body",), 0), ("a b c", ("div", ".main", ".text", ".x"), 0), ("d", ("p",), 0), ("e", ("p",), 0),
        ("tail", ("body",), 0), ("f", ("li",), 0), ("g", ("li",), 0), ("1", ("td",), 0), ("2", ("td",), 0),
        ("h", ("form",), 0), ("i", ("body",), 1)]
    assert blocks_of("") == [] and blocks_of("<p> \n</p>") == []


def _field(seed, rows=12):
    rng = np.random.default_rng(seed)
    field = ex.Field()
    field.of[:rows] = rng.normal(size=(rows, 2))
    field.step, field.first = rng.normal(size=(2, 2)), rng.normal(size=2)
    return field, [rng.integers(0, rows, 3).tolist() for _ in range(6)]


def _score(field, rows, labels):
    total = field.first[labels[0]] + sum(field.of[row, y].sum() for row, y in zip(rows, labels))
    return total + sum(field.step[a, b] for a, b in zip(labels, labels[1:]))


@pytest.mark.parametrize("seed", range(5))
def test_chain_against_all_labellings(seed):
    field, rows = _field(seed)
    ways = list(itertools.product((0, 1), repeat=len(rows)))
    scores = np.array([_score(field, rows, way) for way in ways])
    assert tuple(field.viterbi(rows)) == ways[int(scores.argmax())]
    odds = np.exp(scores - scores.max())
    odds /= odds.sum()
    single, pairs = field.marginals(rows)
    for t in range(len(rows)):
        assert single[t, 1] == pytest.approx(sum(p for p, way in zip(odds, ways) if way[t]))
    assert pairs[2][0, 1] == pytest.approx(sum(p for p, way in zip(odds, ways) if way[2:4] == (0, 1)))


def test_unseen_pages(spark):
    rng = random.Random(7)
    rows = [("http://a/", _page(rng)) for _ in range(150)]
    pages = _pages(spark, [(u, html) for u, (html, _) in rows] + [(None, None), ("b", ""), ("c", "<p>" + "word " * 50_000), ("d", "<")])
    field = ex.train(pages)
    got = {r.id: r for r in ex.extract(pages, field).collect()}
    assert all(got[n].text == text and got[n].n_chars == len(text) for n, (_, (_, text)) in enumerate(rows))
    assert (got[150].url, got[150].text, got[150].n_chars) == (None, "", 0) and got[151].text == ""
    new = [_page(rng, form) for form in ("article", "div") * 50]
    right = sum(ex.main_text(html, field) == text for html, text in new)
    assert right >= 95


def test_no_labelled_pages_and_no_pages(spark):
    pages = _pages(spark, [("a", "<div>x <b>y</b></div><p>z")])
    assert [r.text for r in ex.extract(pages, ex.train(pages)).collect()] == ["x y\nz"]
    none = _pages(spark, [])
    assert ex.extract(none, ex.train(none)).collect() == []


def test_few_marked_pages_are_all_learned(spark):
    rng = random.Random(11)
    marked = [_page(rng)[0] for _ in range(8)]
    plain = [f"<div><p>page {n} without a mark</div>" for n in range(792)]
    pages = _pages(spark, [("a", html) for html in plain + marked + marked[:4]])
    alone = ex.train(_pages(spark, [("a", html) for html in marked]))
    assert np.array_equal(ex.train(pages, sample=8).of, alone.of) and alone.of.any()


def test_features_look_at_the_whole_block():
    def told(text):
        return set(ex.features(blocks_of(f"<p>{text}</p>")[0]))

    assert ex._feature("signs:True") in told("word " * 50 + "©") and ex._feature("commas:2") in told("word " * 50 + "a, b, c, d")
    assert ex._feature("digits:3") in told("word " * 50 + "1" * 1000) and ex._feature("digits:0") in told("1" * 100 + "a" * 50_000)


def test_pages_of_any_depth(spark):
    """100,000 elements within each other, each with a block, in seconds; unclosed and crossed tags too."""
    field = ex.train(_pages(spark, [("a", _page(random.Random(n))[0]) for n in range(20)]))
    deep = ["<div>x" * 100_000, "<article>" + "<center class=ad>x" * 50_000, "<b><i>" * 50_000 + "x" + "</p>" * 50_000,
            "".join(f"<div class=c{'abcdefghij'[n % 10] * (n % 97)}>x" for n in range(50_000))]
    for html in deep:
        tracemalloc.start()
        started = time.time()
        text = ex.main_text(html, field)
        assert time.time() - started < 30 and tracemalloc.get_traced_memory()[1] < 300 << 20
        tracemalloc.stop()
        assert set(text) <= {"x", "\n"}
    assert ex.train(_pages(spark, [("a", "<article>" + "<div>x" * 5000)])).of.any() == False  # too deep to learn from  # noqa: E712


def test_scores_are_those_of_the_features():
    field, _ = _field(3, ex.FEATURES)
    blocks = blocks_of(_page(random.Random(5))[0] + "<div class='a b'><div class=a>x<div>y</div></div>z</div>")
    assert np.allclose(field.scores(blocks), field.emissions([ex.features(b) for b in blocks]))
    for b in blocks:
        assert nested(b.around).fresh == b.within.fresh and nested(b.around).depth == b.within.depth


def test_articles_without_marks_and_with_unlisted_names(spark):
    """The field is taught by marked pages; where a page marks nothing, what it has learned of texts and other elements counts."""
    rng = random.Random(2)
    field = ex.train(_pages(spark, [("a", _page(rng)[0]) for _ in range(150)]))
    bare = right = 0
    for _ in range(100):
        html, text = _page(rng)
        for begin in ("<section>", '<div class="zq-column">', "<div>"):
            end = "</section>" if "section" in begin else "</div>"
            bare += 1
            right += ex.main_text(html.replace("<article>", begin).replace("</article>", end), field) == text
    assert right / bare > 0.8
