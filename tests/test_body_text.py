"""Main text of nested pages: fixed texts, and random trees whose text is known from the tree."""

import random

import pytest
from pyspark.sql import functions as F

from presslens.functions import body_text as BT

CASES = [
    ("<article><table><tr><td>a<table><tr><td>x</td></tr></table>MENU</td></tr></table><p>Text</p></article>", "Text"),
    ("<article><table><table><table>deep</table></table>MENU</table><p>Text</article>after", "Text"),
    ("<article>a &copy b &amp;c<br>d<p>e<p>f</article>", "a © b &c\nd\ne\nf"),
    # an end tag inside a cell does not close what the table stands in
    ("<body><div><table><tr><td></div>menu</td></tr></table>text</div></body>", "text"),
    # an element left open ends with the one it stands in
    ("<body><main><nav>Menu<ul><li>x</main><p>rest</p></body>", "rest"),
    ("<article><aside>x<div>y</aside>z</div></article>", "z"),
    ("<article>one</p></div></section> two</article>", "one\ntwo"),
    # what the region itself stands in does not hide it
    ("<body><form><header>top</header><article>in</article></form></body>", "in"),
    ("<article>first</article><p>between</p><article>second</article>", "first\nsecond"),
    ("<article>a<article><nav>n</nav>b</article>c</article>", "a\nb\nc"),
    # void and self-closing elements are never open
    ("<article><img><hr><nav/>x<br/><input>y</article>", "x\ny"),
    # what looks like a tag inside quotes, scripts, comments and text
    ("<p title='a>b'>x<a href=\"</article>\">y</a><!-- </p> --><script>if (a<b) '</p>'</script>z", "xyz"),
    ("<p>a < b <3 <b>c</b>", "a < b <3 c"),
    ("<p>a<!-- never closed <p>b", "a"),
    ("<p>a<script>never closed <p>b", "a"),
    ("<ARTICLE><NAV>x</Nav><P>Text</P></Article>", "Text"),
    # an article without text: the next region
    ("<body><article><nav>menu</nav></article><p>text</p></body>", "text"),
    ("just  text\n\n of no\tpage &nbsp; ", "just text\nof no page"),
    ("", None),
    (None, None),
    ("<html><body></body></html>", None),
]


def test_fixed_texts(spark):
    df = spark.createDataFrame([(i, page) for i, (page, _) in enumerate(CASES)], "i int, html string")
    got = {r.i: r.b for r in df.select("i", BT.extract_body(F.col("html")).alias("b")).collect()}
    for i, (page, want) in enumerate(CASES):
        assert got[i] == want, page


INLINE = ("b", "a", "span", "i")
HIDDEN = ("nav", "table", "aside", "figure", "footer")
BLOCKS = ("p", "div", "section", "li", "h2")


def tree(rng, depth, shown):
    """(page text, main text) of a random element; newlines stand for line ends."""
    page, text = [], []
    for _ in range(rng.randrange(1, 5)):
        if depth == 0 or rng.random() < 0.4:
            word = rng.choice(["ein", "Wort", "été", "x1"])
            page.append(f" {word} ")
            text.append(f" {word} " if shown else "")
            continue
        name = rng.choice(INLINE + HIDDEN + BLOCKS)
        inner_page, inner_text = tree(rng, depth - 1, shown and name not in HIDDEN)
        line = "\n" if shown and name not in INLINE else ""
        page.append(rng.choice([f"<{name}>", f'<{name} class="a>b">', f"<{name.upper()} x=1>"]) + inner_page + f"</{name}>")
        text.append(line + inner_text + line)
    return "".join(page), "".join(text)


@pytest.mark.parametrize("seed", range(40))
def test_random_trees(seed):
    rng = random.Random(seed)
    page, text = tree(rng, rng.randrange(1, 7), True)
    lines = (" ".join(line.split()) for line in text.split("\n"))
    want = "\n".join(line for line in lines if line) or None
    around = f"<html><body><nav>menu</nav><article>{page}</article><footer>x</footer></body></html>"
    got = BT.main_text(around)
    assert got == want or want is None


def test_long_pages_take_one_pass():
    page = "<article>" + "<div>" * 20_000 + "a" + "<table><tr><td>x" * 2000 + "</article>" + "<p>" * 1000
    assert BT.main_text(page) == "a"
