from __future__ import annotations

import html
import re

import numpy as np
import pytest

from docketrank.llm import pages


@pytest.fixture(scope="module")
def raw(spark, tables):
    return spark.read.parquet(f"{tables}/pages.parquet").select("page_id", "html")


@pytest.fixture(scope="module")
def model(raw):
    return pages.fit(raw)


def article(page):
    """The article of the generated pages, whose marks are known."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", "", p))).strip() for p in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(p for p in parts if p)


def test_generated_pages(raw, model):
    texts = [r["html"] for r in raw.collect()]
    assert pages.main_texts(texts, model) == [article(t) for t in texts]


def test_model_labels_by_itself(raw, model):
    """Held-out accuracy of the labels alone, without the check that follows them."""
    blocks = [pages.leaf_blocks(r["html"]) for r in raw.collect()]
    fitted = pages.train(blocks[::2])
    held = [b for b in blocks[1::2] if b]
    right = total = 0
    for page, label in zip(held, fitted.label(held), strict=True):
        wanted = np.array([pages.weak_label(b.path, True) for b in page])
        right, total = right + int((wanted == label).sum()), total + len(page)
    assert right >= 0.99 * total


def test_other_markup(model):
    page = """<html><head><title>no</title></head><body><header>Top</header><nav><a href=x>Home</a></nav>
    <aside>Side</aside><article><h1>A &amp; B</h1><p>One <b>bold</b>
    text<p>Two &lt;3 &copy; x<script>var p = "<p>no</p>";</script></p><ul><li>first<li>second</ul>
    <form><label>Mail</label></form></article><div class="comments"><p>I disagree</p></div><footer>End</footer>"""
    assert pages.main_texts([page], model) == ["A & B\nOne bold text\nTwo <3 © x\nfirst\nsecond"]


def test_broken_pages_do_not_fail(model):
    broken = ["", None, "<", "<<p", "<!--", "<p", "</p></p>", "<script>", "<a <b <c>", "&", "&am", "<p>" * 5000 + "x", "<div>" * 3000]
    assert len(pages.main_texts(broken, model)) == len(broken)
    assert pages.main_texts(["", None], model) == ["", ""]


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = pages.Labeller(rng)
    x, mask = pages.padded([rng.normal(size=(n, pages.WIDTH)).astype(np.float32) for n in (3, 5, 1)])
    wanted = (rng.random(mask.shape) > 0.5) * mask

    def loss():
        p = model._run(x, mask)[1]
        return -(mask * (wanted * np.log(p) + (1 - wanted) * np.log(1 - p))).sum() / mask.sum()

    for part, grad in zip(model.parameters(), model.gradients(x, mask, wanted)[0], strict=True):
        for key, value in part.items():
            at = tuple(rng.integers(0, n) for n in value.shape)
            step, kept = 1e-4, value[at]
            value[at] = kept + step
            up = loss()
            value[at] = kept - step
            down = loss()
            value[at] = kept
            assert (up - down) / (2 * step) == pytest.approx(grad[key][at], rel=2e-3, abs=1e-6)


def test_table(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (None, "<article><p>t</p></article>", "c"), (3, "<article><p>t</p></article>", "d")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = df.select("page_id", pages.main_text(df["html"], model).alias("found")).collect()
    assert {r["page_id"]: r["found"] for r in out} == {1: "", 2: "", None: "t", 3: "t"}
    empty = df.limit(0)
    assert empty.select(pages.main_text(empty["html"], pages.fit(empty))).count() == 0


ARTICLE_HTML = "<article><h1>A long title of it</h1><p>Words of the article that go on for a while.</p><p>More of them here.</p></article>"
ARTICLE_TEXT = "A long title of it\nWords of the article that go on for a while.\nMore of them here."


@pytest.mark.parametrize(
    "around",
    [
        "<html><body class='single no-sidebar'>{}</body></html>",
        "<body class='banner form'>{}</body>",
        "<body><main class='content has-banner'>{}</main></body>",
        "<body><div id='article-with-comments'>{}</div></body>",
        "<body><form action=x><nav>Home</nav>{}<footer>End</footer></form></body>",
    ],
)
def test_names_around_the_article_do_not_drop_it(model, around):
    assert pages.main_texts([around.format(ARTICLE_HTML)], model) == [ARTICLE_TEXT]


def test_names_beside_the_article_still_count():
    page = f"<body><form>{ARTICLE_HTML}<aside><article>Short teaser</article></aside><div class='big comments'>I disagree</div></form></body>"
    beside = {b.text: not pages.BESIDE.isdisjoint(b.path) for b in pages.leaf_blocks(page)}
    assert beside.pop("Short teaser") and beside.pop("I disagree") and not any(beside.values())


def texts_of(page):
    return [b.text for b in pages.leaf_blocks(page)]


def test_quotes_open_values_behind_an_equals_sign_only():
    assert texts_of("<p data-x=don't>Hello world</p><p>it's here</p><p>last</p>") == ["Hello world", "it's here", "last"]
    assert texts_of("<p title='a > b' id = \"x > y\">one</p><p \"odd' >two</p>") == ["one", "two"]


def test_scripts_inside_a_paragraph_leave_no_trace():
    page = "<p>one <script>if (a < b) x()</script>two</p><p>th<style>p {}</style>ree</p><template><p>no</p></template>four"
    assert texts_of(page) == ["one two", "three", "four"]


@pytest.mark.parametrize("bit", ["<a ", "<", "<!", "<p x='", '<p x="y', "<div>x", "</p><div>", "<li>a", "<b></i>", "<script>", "<!--", "<p a=b c=' d>"])
def test_a_megabyte_of_broken_markup_takes_seconds(bit):
    import time

    start = time.process_time()
    pages.leaf_blocks(bit * (1_000_000 // len(bit)))
    assert time.process_time() - start < 15


def test_copies_count_once_in_the_sample(spark, monkeypatch):
    """A page that is most of the table doesn't fill the sample, and pages too long stay out of it."""
    seen = []
    monkeypatch.setattr(pages, "train", lambda found: seen.append(len(found)))
    rows = [("<p>copy</p>",)] * 3000 + [(f"<p>page {i}</p>",) for i in range(50)] + [("<p>" + "x" * pages.FIT_CHARS,)]
    pages.fit(spark.createDataFrame(rows, "html string").repartition(4))
    assert seen == [51]
