"""op7: pages of other make, broken markup, and time linear in the page."""

from __future__ import annotations

import time
from collections import Counter

import pyarrow.parquet as pq
import pytest

from sheaf.llm import htmltree
from tests.conftest import SF001, needs

STORY = "This is the main story, with several words. It goes on, and on."
MORE = "A second paragraph of the story, with more words in it."
ARTICLE = f"<article><h1>Title here</h1><p>{STORY}</p><p>{MORE}</p></article>"
COMMENT = "<p>I think this is great, thanks for the article. Really nice work, all.</p>"
PLAIN = "Plain text of a page that has no marks at all. It has some sentences, and they go on for a while, as such texts do."

pytestmark = needs(SF001)


@pytest.fixture(scope="module")
def model():
    counts: Counter = Counter()
    for page in pq.read_table(f"{SF001}/pages.parquet", columns=["html"]).column(0).to_pylist():
        counts.update(htmltree.count_page(page or ""))
    return htmltree.fit_counts(counts)


@pytest.mark.parametrize("other", [
    f"<div id=comments><article class=comment>{COMMENT}</article></div>",
    f"<section class=comments><article class=comment>{COMMENT}</article></section>",
    f"<div class=comment-list><article class=comment>{COMMENT}</article></div>",
    f"<div id=disqus><article>{COMMENT}</article></div>",
    f"<div id=disqus><div><div><article><div>{COMMENT}</div></article></div></div></div>",
    "<aside><article><h2>Other</h2><p>Teaser text of another story, please read it.</p></article></aside>",
])
def test_comments_and_teasers_stay_out(model, other):
    page = f"<html><body><nav><a href=/>Home</a></nav>{ARTICLE}{other}<footer>Copyright</footer></body></html>"
    assert htmltree.main_text(page, model) == f"Title here {STORY} {MORE}"


@pytest.mark.parametrize("page,want", [
    (f"<body>{PLAIN}</body>", PLAIN),
    (PLAIN, PLAIN),
    (f"<body><div>{PLAIN}</div></body>", PLAIN),
    (f"<p title=it's>{PLAIN}</p><p>Second it's here, paragraph.</p><p>Third.</p>", f"{PLAIN} Second it's here, paragraph. Third."),
    (f"<p title='x>y' class=\"a>b\">{PLAIN}</p>", PLAIN),
    (f'<p title="never closed>{PLAIN}</p><p>{STORY}</p>', f"{PLAIN} {STORY}"),
    ("<nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>", ""),
    (f"<p>{PLAIN}</p><p>1 < 2 and 3 > 2, as one knows.</p><a hre", f"{PLAIN} 1 < 2 and 3 > 2, as one knows."),
])
def test_plain_pages_and_quotes(model, page, want):
    assert htmltree.main_text(page, model) == want


@pytest.mark.parametrize("part", [
    "<a '", "<div>", "<a b='", "<p><b>", "<div></b>", "<b><div></b>", "<!", "<!--", "<li><div>", "a=", '<p x="', "</div><ul><li>", "<svg>", "<select><option>", "<p aaaa",
])
def test_broken_markup_takes_linear_time(model, part):
    def seconds(n: int) -> float:
        page = part * n + "</p></div>" * (n // 10)
        began = time.process_time()
        htmltree.main_text(page, model)
        return time.process_time() - began

    seconds(500)
    small, large = seconds(8_000), seconds(64_000)
    assert large < 0.5 or large < 24 * small, (small, large)  # eight times the page; quadratic would be 64


def test_a_megabyte_of_text(model):
    text = " ".join([STORY] * 17_000)
    assert htmltree.main_text(f"<article><p>{text}</p></article>", model) == text
