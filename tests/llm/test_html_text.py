import itertools
import random

import pytest

from locusweave.llm import html_text

P = "This is a real sentence of an article, long enough to be told from a menu."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<nav><a href=x>Home</a></nav>", ""), (f"<article><h1>T &amp; U</h1><p>{P}<br>more&nbsp;<b>b</b>old<p>Short.</article>", f"T & U\n{P} more bold\nShort."),
        (f"<title>t</title><script>var a='</p>';</script><style>p{{}}</style><!-- c --><article><p>{P}</p></article><footer>&copy; me", P),
        (f"<body><div class=menu><a>a</a> <a>b</a></div><div id=content><p>{P}<p>{P}</div><div class='ad'>Buy this very good thing now, it is a long and good advert.</div><aside><p>{P}</aside></body>", f"{P}\n{P}"),
        (f"<article><header><h1>Head</h1></header><p>{P}</p><section class=comments><p>{P}</p></section><form><label>{P}</label></form></article>", f"Head\n{P}"),
        (f"<article><p>{P} 1 < 2 &am", f"{P} 1 < 2 &am"), (f'<article><p title="a>b">{P}</p', P), (f"<div class=cookie-notice>{P}</div><main><p>{P}", P),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_cut_is_least():
    rng = random.Random(0)
    for _ in range(150):
        n = rng.randint(1, 8)
        score = [rng.uniform(-3, 3) for _ in range(n)]
        links = [(i, j, rng.uniform(0, 2)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        cost = lambda label: sum(max(s, 0) if not k else max(-s, 0) for s, k in zip(score, label, strict=True)) + sum(w for i, j, w in links if label[i] != label[j])  # noqa: E731, B023
        assert cost(html_text.minimum_cut(score, links)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_neighbours_carry_a_short_block():
    page = f"<div><p>{P}</p><p>Ok</p><p>{P}</p></div>"
    assert html_text.main_text(page) == f"{P}\nOk\n{P}"


def test_no_text_is_lost_to_odd_markup_or_names():
    assert html_text.main_text(f"<article><p>{P}</p><p><a href=/it's-here>{P}</a> {P}</p><p>it's {P}</p></article>") == f"{P}\n{P} {P}\nit's {P}"
    assert html_text.main_text(f"<main><section class='legal'><p>{P} {P}</p></section></main>") == f"{P} {P}"
    assert html_text.main_text(f"<article><p>{P}</p><div class='reviews'><p>{P} {P}</p></div></article>") == f"{P}\n{P} {P}"


def test_the_cut_overturns_the_sign_of_a_block():
    page = f"<div><h2>Of words</h2><p>{P} {P}</p><p>Ok</p><p>{P} {P}</p></div><div class=menu><h2>Of menus</h2><ul><li><a href=x>One</a><li>A somewhat longer entry of the list.</ul></div>"
    found = html_text.blocks(page)
    keep = html_text.minimum_cut([b.score for b in found], html_text.edges(found))
    assert sum((b.score > 0) != k for b, k in zip(found, keep, strict=True)) >= 2
    assert html_text.main_text(page) == f"Of words\n{P} {P}\nOk\n{P} {P}"


def test_deep_nesting_takes_memory_in_proportion():
    import tracemalloc

    page = "<div>" * 50_000 + f"<p>{P}</p><p>{P}</p>" + "</div>" * 50_000
    tracemalloc.start()
    html_text.blocks(page)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60_000_000


def test_table(spark):
    rows = [(1, "u", f"<article><p>{P}</article>", "x"), (1, "u", f"<article><p>{P}</article>", "x"), (None, None, None, None), (2, "v", "<p>" * 3000 + P, "y"), (3, "w", f"<article>{'<p>' + P * 40}" * 50, "z")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {(r["page_id"], r["n_chars"]) for r in got} == {(1, len(P)), (None, 0), (2, len(P)), (3, 50 * len(P * 40) + 49)}
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [("Just text.", "Just text."), ("<p>Yes.</p>", "Yes."), ("<p>Hello</p>", "Hello"), ("<h1>Notes</h1><p>The shop opens at nine and shuts at five.</p>", "Notes\nThe shop opens at nine and shuts at five."), ("<ul><li><a href=a>Home</a><li><a href=b>News</a></ul><p>Closed today.</p>", "Closed today.")],
)
def test_short_pages_are_kept(page, text):
    assert html_text.main_text(page) == text


def _cost(score, links, label):
    return sum(max(s, 0) if not k else max(-s, 0) for s, k in zip(score, label, strict=True)) + sum(w for i, j, w in links if label[i] != label[j])


def test_cut_of_chains_ladders_and_grids_is_least():
    rng = random.Random(1)
    chain = lambda n: [(i, i + 1) for i in range(n - 1)]
    shapes = [chain(12), chain(12) + [(i, 11 - i) for i in range(5)], chain(12) + [(i, i + 2) for i in range(10)], chain(12) + [(i, i + 4) for i in range(8)], list(itertools.combinations(range(7), 2)), []]
    for shape in shapes * 12:
        n = 12
        score = [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(n)]
        links = [(i, j, rng.uniform(0, 2)) for i, j in shape]
        least = min(_cost(score, links, label) for label in itertools.product([False, True], repeat=n))
        assert _cost(score, links, html_text.minimum_cut(score, links)) == pytest.approx(least)


def test_many_undecided_blocks_take_time_in_proportion():
    import time

    rng = random.Random(2)
    words = "".join(f"<div>{' '.join('word' for _ in range(rng.randint(1, 30)))}</div>" for _ in range(50_000))
    nested = "".join(f"<div>text <div>{'w' * rng.randint(1, 90)}<p>{'v ' * rng.randint(1, 90)}</p>end</div>more</div>" for _ in range(10_000))
    for page in (words, nested):
        found = html_text.blocks(page)
        links = html_text.edges(found)
        began = time.process_time()
        html_text.minimum_cut([b.score for b in found], links)
        rest = html_text.minimum_cut([rng.uniform(-1, 1) for _ in found], links)
        assert len(rest) == len(found) >= 40_000
        assert time.process_time() - began < 20


def test_wide_grid_goes_through_the_flow():
    rng = random.Random(3)
    side = 40
    links = [(r * side + c, q, rng.uniform(0.5, 1.5)) for r in range(side) for c in range(side) for q in ((r * side + c + 1,) if c < side - 1 else ()) + ((r * side + c + side,) if r < side - 1 else ())]
    score = [rng.uniform(-2, 2) for _ in range(side * side)]
    label = html_text.minimum_cut(score, links)
    least = _cost(score, links, label)
    for i in range(side * side):  # no single change, and not all of one side, is better
        changed = list(label)
        changed[i] = not changed[i]
        assert _cost(score, links, changed) >= least - 1e-6
    assert least <= min(_cost(score, links, [x] * len(score)) for x in (False, True))
