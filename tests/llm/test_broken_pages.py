"""Markup that never ends: read as a plain search reads it, in time that grows with the page."""

import random
import re
import time

import pytest

from textorbit.llm.hostpaths import Page, Tags

# What a tag is, tried anew at every "<".
PLAIN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[!?/][^>]*>", re.DOTALL
)
BITS = [
    '<a "', "<p>", "</p>", "x ", '<div class="a b">', "</div>", "'", '"', ">", "<", "<!-- c -->", "<!", "<b>", "<li>", "<ul>",
    "<script>", "</script>", '="', "<p class='q\"'>", "<br/>", "</", "<!--", "<a'b c'd>", "?>", "<?",
]


def test_tags_are_those_of_a_plain_search():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(1, 25)))
        tags, at, got = Tags(text), 0, []
        while (found := tags.next(at)) is not None:
            got.append(found)
            at = found[1]
        want = [(m.start(), m.end(), bool(m[1]), m[2] and m[2].lower(), m[3] or "") for m in PLAIN.finditer(text)]
        assert got == want, text


@pytest.mark.parametrize(
    "piece,tail",
    [
        ('<a "', ""), ("<a <a ", ""), ("<!", ""), ("<a \"'", ">"), ("<a '\"", "'>"), ("<a", ""), ("<script </script ", ""), ("<div>", ""),
        ("<ul>", "<p>" * 20_000), ("<div>", "</x>" * 20_000), ('<div class="nav"><h1>x', ""), ("&amp;<", ""),
    ],
)
def test_a_long_broken_page_is_read_in_linear_time(piece, tail):
    text = piece * (300_000 // len(piece)) + tail
    start = time.perf_counter()
    page = Page(text)
    page.votes()
    page.text([])
    assert time.perf_counter() - start < 10
    assert max(map(len, page.paths)) < 5000  # deep nesting stays small


def test_text_around_broken_tags_is_kept():
    assert Page('<p>one <a href="x>two</p><p>three</p>').text([])[0] == 'one <a href="x>two\n\nthree'
    assert Page("a < b and c > d").text([])[0] == "a < b and c > d"
