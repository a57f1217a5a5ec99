import random
import re

import pytest

from ledgerloom.llm import html_render

# Each page took minutes, or gigabytes of text, when cost grew with the square of the page.
HOSTILE = {
    "spans of rows and columns": ("<table><tr>", "<td colspan=1000 rowspan=1000>x", "<tr><td>y", 20_000),
    "spans that end in turn": ("<table><tr>", "<td rowspan=60000>x<td rowspan=60001>x", "<tr><td>y<td>z", 15_000),
    "open lists": ("", "<ul><li>x", "", 40_000), "open quotes": ("", "<blockquote>x<dl><dd>x", "", 20_000),
    "cells outside tables": ("", "<div><td>x", "", 40_000), "items outside lists": ("", "<div><li>x", "", 40_000),
    "stray end tags": ("", "<div></i>x", "", 40_000), "tables in tables": ("", "<table><tr><td>x", "", 10_000),
    "a tall cell beside many": ("<table><tr><td>", "x<br>", "<td>y", 20_000),
    "few cells after wide columns": ("<table><tr>", "<td rowspan=60000>" + "w" * 40, "<tr><td>y", 4_000)}


@pytest.mark.parametrize("name", HOSTILE)
def test_cost_is_in_proportion_to_the_page(name):
    head, first, then, times = HOSTILE[name]
    page = head + first * times + then * times
    text = html_render.render(page)
    assert len(text) < 25 * len(page)
    visible = re.sub("<[^>]*>", " ", page)
    assert all(text.count(letter) == visible.count(letter) for letter in "wxyz")


def placed(rows):
    """Cells of (columns, rows) in a grid, by the rule of HTML: the first free column, one slot after another."""
    taken, out = {}, []
    for y, row in enumerate(rows):
        x, here = 0, {}
        for across, down in row:
            while taken.get(x, 0) > y:
                x += 1
            out.append((y, x))
            if down > 1:
                here |= dict.fromkeys(range(x, x + across), y + down)
            x += across
        taken |= here
    return out


def test_columns_below_spans():
    rng = random.Random(8)
    for _ in range(500):
        rows = [[(rng.choice((1, 1, 2, 5)), rng.choice((1, 1, 2, 3, 9))) for _ in range(rng.randint(0, 5))]
                for _ in range(rng.randint(1, 12))]
        below, got = html_render.Below(), []
        for y, row in enumerate(rows):
            x, kept = 0, []
            for across, down in row:
                x = below.free(x, y)
                got.append((y, x))
                if down > 1:
                    kept.append((x, x + across, y + down))
                x += across
            for cell in kept:
                below.take(*cell)
        assert got == placed(rows)


def test_limits_of_spans():
    page = "<table><tr><td rowspan=1500>a<td>b" + "<tr><td>c" * 1_499 + "<tr><td>d</table>"
    lines = html_render.render(page).split("\n")
    assert lines[0] == "a  b" and lines[1_499] == "   c" and lines[1_500] == "d"  # a row past 1,000 is still below the cell


def test_indents_stop_but_text_and_markers_do_not():
    lines = html_render.render("<ol><li>x" * 100).split("\n")
    assert len(lines) == 100 and all(line.endswith("1. x") for line in lines)
    assert lines[1] == "   1. x" and max(map(len, lines)) == html_render.MAX_INDENT + len("1. x")


def test_tables_in_too_many_tables_are_blocks():
    deep = "<table><tr><td>" * (html_render.MAX_TABLES + 1) + "a<td>b<tr><td>c"
    assert html_render.render(deep).split("\n") == ["a", "b", "c"]
    assert html_render.render("<table><tr><td>" * html_render.MAX_TABLES + "a<td>b<tr><td>c") == "a  b\nc"
