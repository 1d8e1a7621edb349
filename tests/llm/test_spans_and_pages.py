"""Added personal-data spans and page text: planted cases, the method by brute force, linear time."""

import math
import random
import time

import pytest

from wardlake.llm import html_text, pii


def test_planted_numbers_are_found_and_decoys_left(spark):
    """Spans beyond the base patterns: recall on planted ones, none on order and version numbers."""
    rng = random.Random(4)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, planted, decoys = [], {}, {}
    for k in range(400):
        nation = f"{rng.randint(200, 989)}-{d(3)}-{d(4)}"
        forms = [nation, f"+44 20 {d(4)} {d(4)} 190.137.{rng.randint(1, 200)}.204", f"({rng.randint(200, 989)}) {d(3)}-{d(4)}",
                 f"call {d(3)} {d(4)}", f"+1 437 555 {d(4)} 4111111111111111"]
        form = forms[k % 5]
        lead = f"{word()} {word()} "
        rows.append((k, f"{lead}{form} {word()}"))
        start = len(lead) + (5 if form.startswith("call") else 0)
        planted[k] = start
    for k in range(400, 600):
        rows.append((k, f"{word()} order id {d(9)} version {rng.randint(1, 9)}.{rng.randint(0, 9)}.{d(2)} sha {d(7)}a"))
        decoys[k] = 1
    rows += [(600, None), (601, ""), (601, ""), (None, "437-555-0610")]
    got = pii.find(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r.spans for r in got if r.doc_id is not None}
    recall = sum(f"phone:{at}:" in found[k] for k, at in planted.items()) / len(planted)
    assert recall >= 0.9, recall
    assert sum(bool(found[k]) for k in decoys) <= 0.02 * len(decoys)


@pytest.mark.parametrize("unit", ["+1 (826) 555-4081 a@b.co ", "437-555-0610 ", "call 5550192 ", "+1 2 3 4 5 6 7 8 9 ", "a at b dot ", "4111-"])
def test_spans_take_linear_time(unit):
    text = unit * (1_000_000 // len(unit))
    begin = time.time()
    pii.proposed_spans(text, pii.base_spans(text))
    assert time.time() - begin < 8


PARAGRAPHS = "".join(f"<p>{'A sentence of the article with its words. ' * 6}</p>" for _ in range(8))
LINKS = "<div><ul>" + "".join(f"<li><a href='/{k}'>Some page number {k} of the list</a></li>" for k in range(60)) + "</ul></div>"


def test_ratio_selects_the_region(monkeypatch):
    """Without a tag or a name to go by the smoothed ratio finds the article; without the ratio it is missed."""
    page = f"<body><div>{LINKS}<div><h2>Title</h2>{PARAGRAPHS}</div></div></body>"
    got = html_text.main_text(page)
    assert got.startswith("Title\nA sentence") and "Some page" not in got and got.count("\n") == 8
    monkeypatch.setattr(html_text, "content_lines", lambda lines: [True] * len(lines))
    assert "Some page" in html_text.main_text(page)


@pytest.mark.parametrize("wrap", ['<div class="layout-sidebar-right">{}</div>', '<div class="elementor-widget">{}</div>', "<article>{}</article>", "{}"])
def test_names_do_not_overrule_the_text(wrap):
    body = f'<h2 class="section-header">Head</h2>{PARAGRAPHS}<table class="market-share-table"><tr><td>Cell one</td></tr></table>'
    page = f'<body><nav>menu</nav>{wrap.format("<div>" + body + "</div>")}<div class="ad">Buy this now</div><footer>foot</footer></body>'
    got = html_text.main_text(page).split("\n")
    assert got[0] == "Head" and got[-1] == "Cell one" and len(got) == 10


def test_longer_comments_are_left_out():
    page = f"<body><div><div><p>{'Text of the piece here. ' * 30}</p></div><div id='comments'>{PARAGRAPHS * 3}</div></div></body>"
    assert html_text.main_text(page) == ("Text of the piece here. " * 30).strip()


def test_ratio_smoothing_and_threshold_by_definition():
    rng = random.Random(2)
    for _ in range(50):
        lines = [("x" * rng.randint(1, 300), rng.randint(0, 9), None) for _ in range(rng.randint(1, 30))]
        ratio = [len(t) / max(1, n) for t, n, _ in lines]
        smooth = []
        for i in range(len(ratio)):
            pairs = [(math.exp(-(i - j) ** 2 / 2), ratio[j]) for j in range(len(ratio)) if abs(i - j) <= 2]
            smooth.append(sum(w * r for w, r in pairs) / sum(w for w, _ in pairs))
        mean = sum(smooth) / len(smooth)
        deviation = math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
        assert html_text.content_lines(lines) == [s >= min(mean, deviation) for s in smooth]


@pytest.mark.parametrize("unit", ["<div>w", "<b>x</i>", "<i><div><b>y</i>", "<p>a<span>", "<ul><li>z"])
def test_pages_take_linear_time(unit):
    begin = time.time()
    html_text.main_text(unit * (1_000_000 // len(unit)))
    assert time.time() - begin < 10


def test_pages_with_clashing_columns_and_repeats(spark):
    page = f"<div>{PARAGRAPHS}</div>"
    rows = [(1, "u", page, "x", 5), (1, "u", page, "x", 5), (None, None, None, None, None), (2, "v", "", "y", 0)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")).collect()
    assert sorted(r.n_chars for r in got) == sorted([0, 0] + [len(html_text.main_text(page))] * 2)
