"""Pages that are hard to scan, and style sheets."""

import time

import pytest

from lakemart.llm import html

M = 1 << 20
HARD = {
    "style without brace": "<style>" + "display " * (M // 8) + "</style>end",
    "open divs": "<div>" * (M // 5) + "end",
    "open quotes": '<a "' * (M // 4),
    "ends inside quotes": '<a ">" ' * (M // 7) + "end",
    "both quotes": "<a \"'" * (M // 5),
    "misnested": "<span>" + "<div>" * 80_000 + "</span>" * 80_000 + "end",
    "blocks in formatting": "<b><div>" * (M // 8) + "</b>" * 20_000 + "end",
    "nested tables": "<table><tr><td>x" * (M // 16) + "end",
    "nested quotations": "<blockquote>x" * (M // 13) + "end",
    "many rules": "<style>" + "".join(f".c{i}{{display:none}}" for i in range(20_000)) + "</style>"
                  + "".join(f"<b class=k{i}>x</b>" for i in range(20_000)) + "end",
    "open comments": "<!--" * (M // 4),
    "open style comments": "<style>display" + "/*" * (M // 2),
    "open scripts": "<script>x" * (M // 9),
    "long attributes": "<a " + "x " * (M // 2) + ">end",
}


@pytest.mark.parametrize("name", HARD)
def test_a_megabyte_takes_seconds(name):
    began = time.process_time()
    out = html.render(HARD[name])
    assert time.process_time() - began < 40
    if HARD[name].endswith("end"):
        assert out.endswith("end")


NAV = "<p>main</p><p class=nav>menu</p>"


@pytest.mark.parametrize("style,hidden", [
    ("<style>.nav{display:none}</style>", True),
    ("<style>@media print {.nav{display:none}}</style>", False),
    ("<style>@media print {p{color:red} .nav{display:none}} .x{top:0}</style>", False),
    ("<style>@media screen {.nav{display:none}}</style>", True),
    ("<style>@media only screen and (max-width: 600px) {.nav{display:none}}</style>", False),
    ("<style>@media (min-width: 40em) {.nav{display:none}}</style>", True),
    ("<style>@media print, screen {.nav{display:none}}</style>", True),
    ("<style>@media not print {.nav{display:none}}</style>", True),
    ("<style>@media (prefers-color-scheme: dark) {.nav{display:none}}</style>", False),
    ("<style>@media screen {@media print {.nav{display:none}}}</style>", False),
    ("<style>@supports (display: grid) {.nav{display:none}}</style>", True),
    ("<style>@keyframes a {from{visibility:hidden} .nav{display:none}}</style>", False),
    ("<style>@import 'x'; .nav{display:none}</style>", True),
    ("<style>@charset 'x';@media print{.a{top:0}}.nav{display:none}</style>", True),
    ("<style media=print>.nav{display:none}</style>", False),
    ("<style media='screen, print'>.nav{display:none}</style>", True),
    ("<style>/* .nav{display:none} */</style>", False),
    ("<style>.nav{display:none;/* } */color:red}</style>", True),
    ("<style>.nav{display:none} .nav{display:block}</style>", False),
    ("<style>.nav{color:red;display:none</style>", False),
    ("<style>} .nav{display:none}</style>", True),
    ("<!-- <style>.nav{display:none}</style> -->", False),
    ("<script>'<style>.nav{display:none}</style>'</script>", False),
])
def test_styles_hold_on_a_screen(style, hidden):
    want = "main" if hidden else "main\n\nmenu"
    assert html.render(style + NAV) == want
    assert html.render(NAV + style) == want             # a late sheet holds for the whole page
    assert html.render(f"<div>{NAV}</div>{style}") == want


def test_deep_layout_keeps_all_words():
    deep = "".join(f"<ul><li>w{i}" for i in range(300)) + "".join(f"<table><tr><td>t{i}" for i in range(120))
    got = html.render(deep).replace("-", " ").split()
    assert got == [f"w{i}" for i in range(300)] + [f"t{i}" for i in range(120)]
    assert max(len(x) for x in html.render(deep).split("\n")) < 2 * html.INDENT + 4 * html.NESTED
