"""Pages without article, with names of classes that speak of boilerplate; the ratios of tag paths decide on them."""

import pytest

from graphloom.llm import tag_paths

NAMES = [
    "content sidebar-right", "page-with-sidebar", "layout-sidebar-left", "comments-enabled", "post legal-analysis",
    "discussion-paper", "entry-header-image", "full-form", "x1", "story-body", "main-banner-story", "popular-science",
    "trending", "notice-of-results", "has-comments",
]
WORDS = "the river rose, and by noon the lower fields were under water; nobody had seen it so high before. "
TITLE = "A river rises"
PARAGRAPHS = [f"{WORDS.capitalize()}In village {i} people carried what they could to the church.".strip() for i in range(6)]
BODY = f"<h1>{TITLE}</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
EXPECTED = "\n".join([TITLE, *PARAGRAPHS])
#: Boilerplate that no name tells: lists of links, and short lines beside the text.
LINKS = "<div class='k3'><ul>" + "".join(f"<li><a href='/{i}'>Section {i} of the paper</a></li>" for i in range(30)) + "</ul></div>"
LINES = "<table class='k4'>" + "<tr><td>Edition</td><td>Tuesday</td></tr><tr><td>Price</td><td>2.50</td></tr>" * 6 + "</table>"


def _page(name, around):
    return f"<html><body>{around}<div class='{name}'>{BODY}</div>{around}</body></html>"


@pytest.mark.parametrize("around", [LINKS, LINES])
@pytest.mark.parametrize("name", NAMES)
def test_names_do_not_veto(name, around):
    assert tag_paths.main_text(_page(name, around)) == EXPECTED
    assert tag_paths.main_text(f"<body>{around}<form id='page'><div class='{name}'>{BODY}</div></form></body>") == EXPECTED


def test_ratios_decide(monkeypatch):
    """With every path taken for content most of these pages come out differently."""
    monkeypatch.setattr(tag_paths, "content_paths", lambda found: {b.tags() for b in found})
    pages = [_page(name, around) for name in NAMES for around in (LINKS, LINES)]
    assert sum(tag_paths.main_text(p) != EXPECTED for p in pages) > 20


def test_header_in_article_stays():
    page = f"<header class='top'><h1>The Gazette</h1><p>{WORDS * 3}</p></header><article><header><h1>{TITLE}</h1></header>"
    page += "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "<footer>Filed under weather</footer></article>"
    assert tag_paths.main_text(page) == EXPECTED


@pytest.mark.parametrize(
    "part",
    [
        "<section id='comments'><article class='comment'><p>{w}</p></article><article><p>{w}</p></article></section>",
        "<div class='user-comments'>" + "<div class='c'><p>{w}</p></div>" * 30 + "</div>",
        "<div class='cookie-message'><p>{w}</p></div>",
        "<div class='related-posts'><article><h2>Other</h2><p>{w}</p></article></div>",
        "<form class='newsletter'><p>{w}</p><input></form>",
        "<aside><p>{w}</p></aside>",
        "<div hidden><p>{w}</p></div>",
    ],
)
@pytest.mark.parametrize("tag", ["div class='x1'", "article", "main"])
def test_boilerplate_goes(part, tag):
    """Behind the text, before it and in its middle."""
    part = part.format(w=WORDS * 3)
    middle = BODY.replace("</p><p>", f"</p>{part}<p>", 1)
    end = tag.split()[0]
    for page in (f"<{tag}>{BODY}</{end}>{part}", f"{part}<{tag}>{BODY}</{end}>", f"<{tag}>{middle}</{end}>"):
        assert tag_paths.main_text(f"<html><body>{page}</body></html>") == EXPECTED


def test_only_boilerplate():
    assert tag_paths.main_text(f"<body><div class='cookie-banner'><p>{WORDS}</p></div><nav>Home</nav></body>") == ""
    assert tag_paths.main_text(f"<body><div class='sidebar'><p>{WORDS}</p></div><div class='comments'><p>{WORDS}</p></div></body>") == ""
