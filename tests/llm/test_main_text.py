"""The block rules of main-text extraction: cases by hand, and both passes against a plain second version."""

import random

import pytest

from pagelake.llm import extract
from pagelake.llm.extract import Block

PROSE = ("The council met in the old hall of the town and it was said that the bridge would be closed for the summer, "
         "as the work on the river is to be done by then and the road has to be kept free for the people of the valley.")
MORE = "And this is what they have to say about it: that not all of it was paid for by the state, but by you and by us."


def page(*parts):
    return f"<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav>{''.join(parts)}<footer>All rights reserved</footer></body></html>"


def test_text_beside_a_teaser_article_is_found():
    html = page(f"<div><h1>Bridge</h1><p>{PROSE}</p><p>{PROSE} {MORE}</p></div>", "<article class='card'><h3>Short teaser</h3><p>Read on</p></article>")
    assert extract.main_text(html).split("\n")[:3] == ["Bridge", PROSE, f"{PROSE} {MORE}"]


def test_an_article_that_holds_most_decides_what_is_outside():
    html = page(f"<article><h1>Bridge</h1><p>{PROSE}</p><p>Yes.</p><p>{PROSE} {MORE}</p></article>", f"<div><p>{MORE} {MORE}</p></div>")
    assert extract.main_text(html).split("\n") == ["Bridge", PROSE, "Yes.", f"{PROSE} {MORE}"]


def test_a_list_of_links_in_an_article_goes_with_its_heading():
    links = "".join(f"<li><a href='/{i}'>Other story number {i}</a></li>" for i in range(4))
    html = page(f"<article><h1>Bridge</h1><p>{PROSE}</p><p>{MORE}</p><h3>Also read</h3><ul>{links}</ul></article>")
    assert extract.main_text(html).split("\n") == ["Bridge", PROSE, MORE]
    inner = page(f"<article><p>{PROSE}</p><p><a href='/x'>A linked line of the text</a></p><p>{MORE}</p></article>")
    assert extract.main_text(inner).split("\n") == [PROSE, "A linked line of the text", MORE]


@pytest.mark.parametrize("name, stays", [("side-effects", True), ("legal-history", True), ("side", False), ("notice big", False), ("cookie-bar", False), ("x-sidebar", False)])
def test_a_word_of_a_class_name_is_not_the_class(name, stays):
    html = page(f"<article><p>{PROSE}</p><p class='{name}'>{MORE}</p></article>")
    assert extract.main_text(html) == (f"{PROSE}\n{MORE}" if stays else PROSE)


def test_doubtful_places_need_prose():
    html = page(f"<article><p>{PROSE}</p><div class='related-posts'><p>See also</p><ul><li><a href='/1'>One</a></li></ul></div></article>")
    assert extract.main_text(html) == PROSE


def test_pages_without_prose_keep_what_nothing_speaks_against():
    assert extract.main_text("<body><p>Kort</p><p class='side'>x</p><p><a href='/'>y</a></p></body>") == "Kort"
    assert extract.main_text(None) == extract.main_text("") == extract.main_text("<nav>a</nav>") == ""


def plain_judge(b):
    stops = [w.strip(".,;:!?\"'()") in extract.STOP for w in b.text.lower().split()]
    share, links = sum(stops) / max(1, len(stops)), b.linked / len(b.text)
    if b.out or (links > 0.5 and (b.item or b.doubt or not b.inside)):
        return "no"
    if links > 0.5:
        return "open"
    if len(b.text) < 70 or (b.heading and not b.inside):
        return "no" if b.doubt else "open"
    if b.doubt:
        return "yes" if share >= 0.25 else "no"
    if b.inside:
        return "yes" if share >= 0.12 else "open"
    if len(b.text) >= 200:
        return "yes" if share >= 0.12 else "no"
    return "yes" if share >= 0.25 else "open" if share >= 0.12 else "no"


def plain_labels(blocks):
    label = [plain_judge(b) for b in blocks]
    inside = sum(len(b.text) for b, x in zip(blocks, label, strict=True) if b.inside and x != "no")
    outside = sum(len(b.text) for b, x in zip(blocks, label, strict=True) if not b.inside and x == "yes")
    prior = inside > 0 and inside >= outside
    if prior:
        label = [x if b.inside else "no" for b, x in zip(blocks, label, strict=True)]
    if "yes" not in label and not prior:
        return [not b.out and not b.doubt and b.linked <= 0.5 * len(b.text) for b in blocks]
    result = []
    for i, b in enumerate(blocks):
        if label[i] != "open":
            result.append(label[i] == "yes")
            continue
        own = prior and b.inside
        decided = [j for j in range(len(blocks)) if label[j] != "open" and (not own or (blocks[j].inside and not blocks[j].out))]
        left, right = max((j for j in decided if j < i), default=None), min((j for j in decided if j > i), default=None)
        said = [None if j is None else label[j] == "yes" for j in (left, right)]
        if own:
            result.append(said[1] is not False if b.heading else said != [False, False])
        elif None in said:
            result.append(bool(said[0] if said[0] is not None else said[1]))
        elif said[0] == said[1] or (not b.heading and i - left <= right - i):
            result.append(said[0])
        else:
            result.append(said[1])
    return result


def test_both_passes_match_a_plain_version():
    rng = random.Random(7)
    seen = set()
    for _ in range(3000):
        blocks = []
        for _ in range(rng.randint(0, 9)):
            text = " ".join(rng.choices(["the", "of", "bridge", "valley", "summer"], weights=rng.choice([(1, 1, 1, 1, 1), (0, 0, 1, 1, 1), (1, 0, 6, 3, 3)]), k=rng.choice([1, 4, 14, 20, 60])))
            blocks.append(Block(text, rng.choice([0, 0, 0, len(text)]), rng.random() < 0.15, rng.random() < 0.15, rng.random() < 0.5, rng.random() < 0.2, rng.random() < 0.2))
        got = extract.labels_of(blocks)
        assert got == plain_labels(blocks)
        seen.add(tuple(got))
    assert len(seen) > 100
