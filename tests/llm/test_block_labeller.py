from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from llm_cases import prose

from statelake.llm.block_labeller import HIDDEN, INPUT, PATH_DIMS, Features, Network, Path, _place, blocks, extract, padded

SCHEMA = "page_id long, url string, html string"


def page(rnd, style):
    title, parts = prose(rnd, 6), [prose(rnd, rnd.randint(5, 60)) for _ in range(rnd.randint(1, 8))]
    links = "".join(f'<li><a href="/{i}">{prose(rnd, 1)}</a></li>' for i in range(5))
    body = f"<h1>{title}</h1>" + "".join(f"<p><b>{p}<br></p>" if i % 3 == 0 else f"<p>{p}</p>" for i, p in enumerate(parts))
    more = f'<div class="comments"><p>{prose(rnd, 20)}</p><p>{prose(rnd, 9)}</p></div>' if style == 1 else ""
    aside = f'<aside><p>{prose(rnd, 12)}</p></aside>' if style == 2 else ""
    html = (
        f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a="<p>x</p>";</script></head><body><nav><ul>{links}</ul></nav>'
        f'<!-- ad --><div class="ad">{prose(rnd, 8)}</div><article>{body}{more}</article>{aside}<footer>&copy; {prose(rnd, 5)}</footer>')
    return html, "\n".join([title, *parts])


def test_pages_without_their_frame(spark):
    rnd = random.Random(6)
    pages = [page(rnd, i % 3) for i in range(90)]
    rows = [(i, f"u{i}", h) for i, (h, _) in enumerate(pages)] + [(900, None, None), (901, "u", ""), (902, "u", "  "), (903, "u", "<div>"), (0, "again", pages[0][0])]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = extract(frame.selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    by_id = {r.page_id: r for r in got}
    assert sum(by_id[i].text == t for i, (_, t) in enumerate(pages)) >= 87
    assert all(by_id[i].text == "" and by_id[i].n_chars == 0 for i in (900, 901, 902, 903))
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract(frame.limit(0)).count() == 0


def test_blocks():
    assert [(t, k) for _, t, k in blocks("<p>a &amp; b\n c<br>d<p>e</p><a href='x'>f</a> g")] == [("a & b c d", 0), ("e", 0), ("f g", 1)]
    assert blocks("<script>x<p>y") == [] and blocks("<!-- <p>a") == []
    assert tuple(blocks('<div class="x y" title=">">a</div>')[0][0]) == ("div", "x", "y")
    assert [tuple(p) for p, *_ in blocks("<ul><li>a<li>b</ul></p></div>c")] == [("ul", "li"), ("ul", "li"), ()]
    # A value that is not closed ends at the next quote, as in a browser.
    assert [t for _, t, _ in blocks('<p title="a>b</p>c<i x=">">d')] == ['">d']
    assert [t for _, t, _ in blocks('<p title="a>b</p>c')] == ["b", "c"] == [t for _, t, _ in blocks("<p title='a>b</p>c")]
    assert [t for _, t, _ in blocks("<p it's>b</p>1 < 2 <")] == ["b", "1 < 2 <"]
    assert blocks("a" * 100_000)[0][1] == "a" * 100_000 and len(blocks("<p>b</p>" * 3000)) == 3000


def test_paths_carry_the_counts_of_their_tokens():
    rnd = random.Random(3)
    for _ in range(50):
        node, tokens = Path(), []
        for _ in range(rnd.randint(0, 9)):
            more = tuple(rnd.choice(["div", "p", "nav", "article", "x", "comment"]) for _ in range(rnd.randint(1, 3)))
            node, tokens = node.child(more), [*tokens, *more]
        expected = np.zeros(PATH_DIMS)
        for depth, token in enumerate(reversed(tokens)):
            expected[_place(token, PATH_DIMS)] += 1.0 if depth < 2 else 0.5
        assert list(node) == tokens and np.array_equal(node.vector(), expected)
        assert node.aside == bool({"nav", "comment"} & set(tokens)) and node.body == ("article" in tokens)


ODD = {
    "quotes": '<b "' * 100_000, "values": '<b a="' * 99_999 + ">x", "quoted ends": '<x a=">"' * 100_000, "nested": "<div>" * 100_000 + "x", "texts": "<div>x" * 50_000,
    "stray": "<div>" * 50_000 + "</p>" * 50_000 + "y", "opened": "<" * 300_000, "comments": "<!--" * 100_000, "marks": "<!a " * 100_000, "scripts": "<script " * 50_000,
    "ends": "<div><p>" * 50_000 + "</div>" * 50_000, "equals": "<a " + "= " * 200_000, "references": "&amp" * 100_000,
}


@pytest.mark.parametrize("kind", ODD)
def test_odd_pages_take_seconds(kind):
    began = time.perf_counter()
    leaves = blocks(ODD[kind])
    if leaves:
        Features()(leaves)
    assert time.perf_counter() - began < 10


def test_forward_pass_by_plain_loops():
    draw = np.random.default_rng(4)
    rows = [draw.normal(0, 1, (n, INPUT)) for n in (3, 1, 5)]
    net = Network()
    got = net.forward(*padded(rows))[0]
    squash = lambda v: 1 / (1 + math.exp(-v))
    for j, row in enumerate(rows):
        seen = {}
        for d, order in (("f", range(len(row))), ("b", range(len(row) - 1, -1, -1))):
            h, c = [0.0] * HIDDEN, [0.0] * HIDDEN
            for t in order:
                z = [sum(row[t][i] * net.w[f"x{d}"][i][k] for i in range(INPUT)) + sum(h[i] * net.w[f"h{d}"][i][k] for i in range(HIDDEN)) + net.w[f"b{d}"][k] for k in range(4 * HIDDEN)]
                c = [squash(z[HIDDEN + k]) * c[k] + squash(z[k]) * math.tanh(z[3 * HIDDEN + k]) for k in range(HIDDEN)]
                h = [squash(z[2 * HIDDEN + k]) * math.tanh(c[k]) for k in range(HIDDEN)]
                seen[d, t] = h
        for t in range(len(row)):
            out = sum(a * b for a, b in zip([*seen["f", t], *seen["b", t]], net.w["o"], strict=True)) + net.w["c"][0]
            assert got[t, j] == pytest.approx(squash(out), abs=1e-9)


def test_gradients_against_differences():
    draw = np.random.default_rng(0)
    x, mask = padded([draw.normal(0, 1, (n, INPUT)) for n in (4, 2, 6)])
    y = (draw.random(mask.shape) < 0.5).astype(float)
    net = Network()

    def loss():
        p = net.forward(x, mask)[0]
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    grads = net.gradients(x, mask, y)
    for name in grads:
        flat = net.w[name].reshape(-1)
        for i in draw.integers(0, flat.size, 4):
            old, step = flat[i], 1e-5
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert grads[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * step), abs=1e-6)
    assert net.w["hf"].shape == (HIDDEN, 4 * HIDDEN)
