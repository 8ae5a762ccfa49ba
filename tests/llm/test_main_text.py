import pytest

from contentlake.llm.main_text import Page, extract, labelled_pages, main_text, trained_model


@pytest.fixture(scope="module")
def model():
    return trained_model()


def test_held_out_layouts(model):
    right = total = 0
    for source in labelled_pages(150, seed=1234):
        page = Page(source)
        keep = model.marginals(page)
        for v, _ in page.runs:
            total += 1
            right += (page.label[v] or 0) == (keep[v] >= 0.5)
    assert right / total > 0.995


def test_article_without_its_surroundings(model):
    source = (
        '<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script><style>p{}</style></head><body>'
        "<header><p>Site name</p></header><nav><ul><li><a href=/>Home</a></li><li><a href=/>News</a></li></ul></nav><!-- x <p>no</p> -->"
        "<div class='cookie-banner'>We use cookies on this page to serve you.</div><article><h1>Fish &amp; chips</h1>"
        "<p><b>First   line<br>second &eacute;&#x41;.<p>Of.</p><div class=ad>Buy it now, it is very cheap.</div>"
        "<ul><li>One thing</li><li>Two things to see</li></ul><form><p>Name</p><button>Go</button></form><p>The end of it all, at last.</article>"
        "<aside><h3>Related</h3><ul><li><a href=1>More of this</a></li></ul></aside><section class='comments'><p>I like it a lot, thanks.</p></section>"
        "<footer>&copy; 2020 me</footer></body></html>")
    assert extract(source, model) == "Fish & chips\n\nFirst line second éA.\n\nOf.\n\nOne thing\n\nTwo things to see\n\nThe end of it all, at last."


@pytest.mark.parametrize("source", ["", "<", "<p", "<<<>>>", "</p></div>", "<p a='\"<b>", "<script>", "<!--", "&#xD800;&am", "<table><tr><td><table>" * 50,
                                    "<div>" * 3000 + "x", "\x00<p>\x00</p>"])
def test_broken_markup(model, source):
    assert isinstance(extract(source, model), str)


LINE = "Here is a sentence of the article that says something."


@pytest.mark.parametrize("name", ["button", "select", "svg", "object", "canvas", "noscript", "template", "audio", "video"])
def test_unclosed_elements_end_with_their_block(model, name):
    """What stands in the element goes; the article behind it, and other elements of its name, stay as they are."""
    closed = f"<p>{LINE} <{name}>Share</{name}>{LINE}</p>"
    for inside, after in ((f"<p>{LINE} <{name}>Share</p><p>{LINE}</p>", 1), (f"<p>{LINE}<{name} class='x'>Share<p>{LINE}</p>", 1),
                          (f"<div><p>{LINE}</p><{name}>Share</div><p>{LINE}</p>", 1), (f"<p>{LINE}</p><{name}>Share", 0), (closed, 0)):
        source = f"<body><article><h1>Head line of it</h1><p>{LINE}</p>{inside}{closed if after else ''}</article></body>"
        text = extract(source, model)
        assert "Share" not in text and text.count(LINE) == source.count(LINE), (name, inside)


def test_nested_and_raw_silent_elements(model):
    kept = f"<p>{LINE}</p>"
    for silent in ("<svg><svg><text>no</text></svg><p>no</p></svg>", "<object><p>no</p><object>no</object></object>", "<noscript><div><p>no</p></div></noscript>",
                   "<script>if (a < b) '</p></div>no'</script>", "<textarea><p>no</textarea>", "<button><p>no</p></button>", "<iframe></div>no</iframe>"):
        text = extract(f"<body><article><h1>Head line of it</h1>{kept}{silent}{kept}</article></body>", model)
        assert text == f"Head line of it\n\n{LINE}\n\n{LINE}", silent
    text = extract(f"<html><head><title>no</title><meta x><body><article><h1>Head line of it</h1>{kept}{kept}</article></body>", model)
    assert text == f"Head line of it\n\n{LINE}\n\n{LINE}"


def test_math_is_text(model):
    text = extract(f"<body><article><h1>Head line of it</h1><p>{LINE}</p><p>The sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> is more. {LINE}</p></article></body>", model)
    assert f"The sum x+1 is more. {LINE}" in text


def test_rows(spark, model):
    article = "<body><article><h1>Head line</h1>" + "<p>Some words that make a sentence.</p>" * 5 + "</article></body>"
    data = [(1, "u", article), (1, "u", article), (None, None, article), (2, "u", None), (3, None, ""), (4, "u", "<nav><a>x</a></nav>")]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string").selectExpr("*", "1 AS id", "'t' AS text", "2 AS n_chars")
    out = sorted(((r["id"], r["url"], r["text"], r["n_chars"]) for r in main_text(df).collect()), key=str)
    want = "\n\n".join(["Head line"] + ["Some words that make a sentence."] * 5)
    expected = [(i, u, want if h == article else "", len(want) if h == article else 0) for i, u, h in data]
    assert out == sorted(expected, key=str)
    assert main_text(df.limit(0)).count() == 0
