"""Labelled pages that have neither article nor main, nor names that tell parts apart: density alone finds the text."""

from __future__ import annotations

import time

import pytest

from graphloom.llm import html_text

CONTENTS = [
    ["The harbour at dawn", "Fishing boats left the harbour well before dawn and came back around noon with full nets and tired crews on board.", "Prices at the quay rose by a tenth, the auctioneer said, since storms had kept half of the fleet at home for two weeks.", "A second auction is planned for Friday morning if the weather holds, and buyers from inland towns have been told to come."],
    ["Bridge closed for repairs", "The old stone bridge over the river will be closed to all traffic from Monday on while workers replace two of its arches.", "Engineers found cracks after the spring flood, and divers who looked at the piers reported that the footings had shifted.", "Buses take the long way round by the mill; pedestrians may use the ferry, which will run every ten minutes until late evening."],
    ["How the cellar stays cool", "Thick walls of clay and straw keep the cellar at the same temperature all through the year, whatever the weather outside does.", "Air enters through a pipe buried two metres deep, loses its warmth to the ground and sinks to the floor of the storage room.", "Apples laid down in October were still firm in May, and the growers say that they have given up their electric cold store."],
    ["A choir without a hall", "For eleven years the choir has rehearsed in the waiting room of the railway station, between the last two trains of the evening.", "The acoustics are better than in most churches, says its leader, though the loudspeaker tends to join in during quiet passages.", "A concert of station songs is to be given in June, and passengers who miss their train are promised a seat in the first row."],
    ["Counting birds by ear", "Volunteers sat in the marsh for forty nights and wrote down every call that they heard, with the minute and the direction of it.", "When the lists were laid over one another, the same bird could be followed from reed bed to reed bed through the whole season.", "Twice as many bitterns live there as was thought, the group reports, and nearly all of them breed on the side nearest to the road."],
]


def links(*words: str) -> str:
    return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words)


def layouts(content: list[str]) -> list[tuple[str, list[str]]]:
    """(page, the blocks of its text) for each of six arrangements of one content."""
    head, *paragraphs = content
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    top, side = links("home", "news", "sport", "weather", "travel", "about"), links("one more story", "another story", "third story", "fourth story", "fifth story")
    bold = [p.replace(" the ", " <b>the</b> ", 1) for p in paragraphs]
    return [
        (f"<html><body><div><ul>{top}</ul></div><div><h2>{head}</h2>{body}</div><div><ul>{side}</ul></div></body></html>", content),
        (f"<html><body><table><tr><td><ul>{top}</ul></td><td><h2>{head}</h2>{body}</td><td><ul>{side}</ul></td></tr></table></body></html>", content),
        (f"<html><body><div><div><div><ul>{top}{side}</ul></div><div><div><h2>{head}</h2>{body}</div></div></div></div><div><a href='/a'>imprint</a> <a href='/b'>contact</a> <a href='/c'>terms</a></div></body></html>", content),
        (f"<html><body><div><h2>{head}</h2>{''.join(f'<p>{p}</p>' for p in bold)}<ul>{side}</ul></div><div><ul>{top}</ul><ul>{top}</ul><ul>{side}</ul></div></body></html>", content),
        (f"<body><ul>{top}</ul><div><p><span>{head}</span></p><div>{body}</div></div><ul>{side}{top}</ul>", content),
        (f"<html><body><div><a href='/1'>a</a><a href='/2'>b</a><a href='/3'>c</a><a href='/4'>d</a><a href='/5'>e</a></div><div><div><ul>{top}</ul><ul>{side}</ul><ul>{top}</ul></div><div>{'<br><br>'.join(content)}</div></div></body></html>", [" ".join(content)]),
    ]


PAGES = [page for content in CONTENTS for page in layouts(content)]


@pytest.mark.parametrize("page,blocks", PAGES, ids=range(len(PAGES)))
def test_text_is_found_by_density(page, blocks):
    assert html_text.main_text(page) == "\n".join(blocks)


def test_density_decides(monkeypatch):
    monkeypatch.setattr(html_text, "_density", lambda chars, *_: 1.0 if chars else 0.0)
    changed = sum(html_text.main_text(page) != "\n".join(blocks) for page, blocks in PAGES)
    assert changed > len(PAGES) * 2 / 3


@pytest.mark.parametrize("page", ["<b>x" * 100_000 + "<p>y" * 100_000, "<b>x" * 120_000 + "</i>" * 120_000, "<ul><li>x" * 100_000, "<table><tr><td>x" * 60_000], ids=range(4))
def test_a_page_of_unclosed_tags_takes_time_in_proportion(page):
    began = time.process_time()
    assert html_text.main_text(page[: len(page) // 10])
    tenth, began = time.process_time() - began, time.process_time()
    assert html_text.main_text(page)
    assert time.process_time() - began < 40 * max(tenth, 0.02)
