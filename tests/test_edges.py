"""Cases the form does not have."""

import pytest

from sheafwork import operators as op
from sheafwork import plans


def documents(spark, *pages):
    return spark.createDataFrame(list(enumerate(pages)), "doc_id int, html string")


def items_of(spark, html):
    rows = op.list_items(documents(spark, html)).orderBy("item").collect()
    return [row["text"] for row in rows]


def slot_of(spark, content):
    frame = op.slots(op.list_items(documents(spark, f"<ul><li>{content}</li></ul>")))
    row = frame.first()
    return row["label"], row["value"], row["hint"], row["is_unfilled"]


def test_no_sections(spark):
    page = documents(spark, "<p>a</p>", "", None)
    assert op.sections(page).isEmpty()
    assert op.item_tree(op.sections(page)).isEmpty()
    assert op.item_tree(page).isEmpty()


def test_preamble_keeps_early_items(spark):
    page = documents(spark, "<ul><li>a</ul><h2>1. T</h2><ul><li>b</ul>")
    rows = op.list_items(op.sections(page, preamble=True)).orderBy("pos").collect()
    assert [(r["pos"], r["item"], r["text"]) for r in rows] == [(0, 1, "a"), (1, 1, "b")]
    assert op.sections(page, preamble=True).where("pos = 0").first()["heading"] is None


def test_missing_metadata(spark):
    rows = op.document_metadata(
        documents(
            spark,
            "<p>no head</p>",
            "<title> </title><h1></h1>",
            "<HTML class='x' LANG=fr><META http-equiv=Content-Type content='text/html; charset=latin1'>"
            "<TITLE>a\n b</TITLE><H1 id=h><b>c</b></H1>",
            None,
        )
    )
    found = {r["doc_id"]: tuple(r)[1:] for r in rows.collect()}
    assert found == {
        0: (None,) * 4,
        1: (None,) * 4,
        2: ("fr", "latin1", "a b", "c"),
        3: (None,) * 4,
    }


def test_text_keeps_entities_and_drops_hidden(spark):
    html = "<p>a&amp;b</p><script type=x>1<2</script><!-- c --><STYLE>d</STYLE><p>e</p>"
    assert op.document_text(documents(spark, html)).first()["text"] == "a&amp;b e"


@pytest.mark.parametrize(
    "html, text",
    [
        ("a < b <b>c</b> > d <> e", "a < b c > d <> e"),
        ("a <!-- b", "a"),
        ("a <script>b", "a"),
        ("a <script>'<style>x</style>'; y</script> b", "a b"),
        ("a <b c", "a"),
        ("a <br/>b<BR >c</p\n>d", "a b c d"),
        ("<!DOCTYPE html><?x y?>a", "a"),
        ("  a \t b\r\n\r\nc\fd ", "a b c d"),
        ("a\tb", "a b"),
        ("", ""),
        (None, None),
    ],
)
def test_text(spark, html, text):
    assert op.document_text(documents(spark, html)).first()["text"] == text


@pytest.mark.parametrize(
    "html, texts",
    [
        ("<ul><li>a</li></ul> after", ["a"]),
        ("<link rel=x><ul><LI class=y>a</LI></ul>", ["a"]),
        ("<ul><li></li><li> </li></ul>", ["", ""]),
        ("<ul><li>a<li>b</ul>", ["a", "b"]),
        ("<ul><!-- <li>no</li> --><li>a</li></ul>", ["a"]),
        ("<ul><li>a<ul><li>b</li></ul></li></ul>", ["a", "b"]),
        ("<li>", [""]),
        ("<ul><li>a</li><li cla", ["a"]),
        ("<ul><li>a < 2", ["a < 2"]),
    ],
)
def test_items(spark, html, texts):
    assert items_of(spark, html) == texts


@pytest.mark.parametrize(
    "heading, no, title, marker",
    [
        ("12. A (b) c (d)", 12, "A (b) c", "d"),
        ("A", None, "A", None),
        ("3.A", 3, "A", None),
        ("3.", 3, None, None),
        ("(d)", None, None, "d"),
        ("99999999999. A", None, "99999999999. A", None),
        ("3.5 Scope", None, "3.5 Scope", None),
        ("4. a\u0085b\u2028c (d\u2029e)", 4, "a\u0085b\u2028c", "d\u2029e"),
        ("1. <b>A</b>\n B", 1, "A B", None),
    ],
)
def test_heading(spark, heading, no, title, marker):
    page = documents(spark, f"<h2>{heading}</h2>")
    row = op.parse_heading(op.sections(page)).first()
    assert (row["no"], row["title"], row["marker"]) == (no, title, marker)


def test_unclosed_heading(spark):
    row = op.parse_heading(op.sections(documents(spark, "<h2>1. A<ul><li>b</ul>"))).first()
    assert (row["heading"], row["no"], row["title"]) == (None, None, None)
    assert row["body"] == "1. A<ul><li>b</ul>"


HINT = '<span class="placeholder">{}</span>'


@pytest.mark.parametrize(
    "content, expected",
    [
        ("Link: http://a:b/c", ("Link", "http://a:b/c", None, False)),
        ('<span class="highlight">A:</span> b', ("A", "b", None, False)),
        ('<span class="highlight">A</span>: b', ("A", "b", None, False)),
        ("A: " + HINT.format("[b: c]"), ("A", None, "b: c", True)),
        (HINT.format("[b: c]"), (None, None, "b: c", True)),
        (HINT.format("b: c"), (None, None, "b: c", True)),
        (HINT.format(""), (None, None, None, True)),
        ("A: " + '<span id="i" class="x placeholder">[b]', ("A", None, "b", True)),
        ("A: [b]", ("A", None, "b", True)),
        ("[b]", (None, None, "b", True)),
        ("[b: c]", (None, None, "b: c", True)),
        ("[b: c] D: e", ("D", "e", None, False)),
        ("D [b: c]: e [f: g]", ("D", "e [f: g]", None, False)),
        ("[b: c", ("[b", "c", None, False)),
        ("[a: b [c: d: e] f: g] h: i", ("f", "g] h: i", None, False)),
        ("[a: b] [c: d] e", (None, "[a: b] [c: d] e", None, False)),
        ("[a]: b", (None, "[a]: b", None, False)),
        ("A: b [c]", ("A", "b [c]", None, False)),
        ("A: [b] [c]", ("A", "[b] [c]", None, False)),
        ("plain", (None, "plain", None, False)),
        ("my placeholder: x", ("my placeholder", "x", None, False)),
        ("A:", ("A", None, None, True)),
        ("", (None, None, None, True)),
        ("A: x &amp; y &lt;z&gt;", ("A", "x & y <z>", None, False)),
        ("A: &amp;lt;", ("A", "&lt;", None, False)),
        ("A: &#91;b&#93;", ("A", "[b]", None, False)),
        (": x", (None, ": x", None, False)),
    ],
)
def test_slot(spark, content, expected):
    assert slot_of(spark, content) == expected


def test_wide_takes_the_first_value(spark):
    page = documents(
        spark,
        "<h2>1. a</h2><ul><li>K: [x]</li><li>K: " + HINT.format("y") + "</li></ul>"
        "<h2>2. b</h2><ul><li>K: zz</li><li>K: aa</li></ul>",
        "<p>none</p>",
    )
    rows = op.wide(plans.document_slots(page), ["K", "L"])
    assert [tuple(r) for r in rows.collect()] == [(0, "zz", None)]
    rows = op.wide_documents(page, ["K", "L"]).orderBy("doc_id")
    assert [tuple(r) for r in rows.collect()] == [(0, "zz", None), (1, None, None)]


def test_carried_columns(spark):
    page = documents(spark, "<html lang=de><ul><li>a</ul><h2>1. T</h2><ul><li>b</ul>")
    known = op.document_metadata(page, "html")
    for operator in (op.list_items, op.item_tree):
        rows = operator(op.sections(known, "lang"), "lang").collect()
        assert [(r["lang"], r["text"]) for r in rows] == [("de", "b")]
        assert {r["lang"] for r in operator(known, "lang").collect()} == {"de"}


def test_completeness_by_a_carried_column(spark):
    page = documents(spark, "<html lang=de><ul><li>A: b<li>C: [d]</ul>", "<ul><li>e</ul>")
    slots = plans.document_slots(op.document_metadata(page, "html"), "lang")
    rows = op.completeness(slots, "lang").collect()
    assert {tuple(row) for row in rows} == {("de", 2, 1, 0.5), (None, 1, 1, 1.0)}


def test_render_checks_labels():
    with pytest.raises(ValueError):
        op.Slot("h", "a:b", "c")


def test_render_escapes(spark):
    form = op.Form("T & <U>", (op.Section("S", (op.Slot("h <&>", "L & M", "v"),)),), lang="en")
    values = ["a & b < c > d: e", "[x]", "", " \n", None, "&lt;", "</li><li>Q: r", "a \n b"]
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    pages = op.render(rows, form, "k")
    slots = plans.document_slots(pages).orderBy("doc_id").collect()
    assert [r["value"] for r in slots] == [
        "a & b < c > d: e",
        "[x]",
        None,
        None,
        None,
        "&lt;",
        "</li><li>Q: r",
        "a b",
    ]
    assert {r["label"] for r in slots} == {"L & M"}
    assert [r["hint"] for r in slots] == [None, None] + ["h <&>"] * 3 + [None] * 3
    assert op.document_metadata(pages).first()["title"] == "T &amp; &lt;U&gt;"


def test_empty_comments_end_at_once(spark):
    html = "<ul><li>a</li><!--><li>b</li><!---><li>c</li></ul><!-- x --!><h2>2. B</h2><!-- y"
    assert items_of(spark, html) == ["a", "b", "c"]
    assert op.document_text(documents(spark, html)).first()["text"] == "a b c 2. B"
    assert op.sections(documents(spark, html)).first()["heading"] == "2. B"


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ('<html data-lang="zz" lang="en">', ("en", None, None, None)),
        ('<html xml:lang="fr" lang="en">', ("en", None, None, None)),
        ('<!-- <html lang="xx"> --><html lang="en">', ("en", None, None, None)),
        ('<meta name="description" content="the charset=abc trick">', (None, None, None, None)),
        ('<meta content="text/html; charset=abc" http-equiv="Content-Type">', (None, "abc", None, None)),
        ("<script>'<title>a</title>'</script><title>b</title>", (None, None, "b", None)),
    ],
)
def test_metadata_is_read_from_what_shows(spark, html, expected):
    assert tuple(op.document_metadata(documents(spark, html)).drop("doc_id").first()) == expected


def test_placeholders(spark):
    span = '<span class="placeholder">[a <span>b</span> c]</span>'
    assert slot_of(spark, f"L: {span}") == ("L", None, "a b c", True)
    assert slot_of(spark, '<span data-class="placeholder">x</span>') == (None, "x", None, False)


def test_no_character_is_altered(spark):
    assert slot_of(spark, "L: a\x01b") == ("L", "a\x01b", None, False)
    assert slot_of(spark, "[x:y] L: a\x01b.[c:d]") == ("L", "a\x01b.[c:d]", None, False)
    page = documents(spark, "<ul><li>a\x01b<ul\x01><li>c\x02</ul>")
    tree = op.item_tree(page).orderBy("item").collect()
    assert [r["text"] for r in tree] == ["a\x01b", "c\x02"] == items_of(spark, page.first()["html"])


def test_forms_with_brackets_read_back(spark):
    form = op.Form("T", (op.Section("S", (op.Group("G [1]", (op.Slot("a]b[", "L", "v"),)),)),))
    rows = spark.createDataFrame([(1, None)], "id int, v string")
    found = plans.document_slots(op.render(rows, form, "id")).orderBy("item").collect()
    assert [(r["label"], r["value"], r["hint"]) for r in found] == [(None, None, "G [1]"), ("L", None, "a]b[")]
    for title, marker in (("a (b)", None), ("a", "b (c)"), ("a", " ")):
        with pytest.raises(ValueError):
            op.Section(title, (), marker)


@pytest.mark.parametrize("count", [0, 16, 17, 5_000])
def test_any_number_of_attributes(spark, count):
    quotes = ["'", '"', ""]
    others = "".join(f" data-a{i}={quotes[i % 3]}v{quotes[i % 3]}" for i in range(count))
    html = f"<html{others} lang=fr><meta{others} charset=latin1><title>t</title>"
    typed = f"<meta{others} http-equiv=content-type{others} content='text/html; charset=latin1'>"
    turned = f"<meta{others} content='text/html; charset=latin1'{others} http-equiv=\"Content-Type\">"
    rows = op.document_metadata(documents(spark, html, f"<html{others}>{typed}", turned)).orderBy("doc_id").collect()
    assert [(r["lang"], r["charset"]) for r in rows] == [("fr", "latin1"), (None, "latin1"), (None, "latin1")]


@pytest.mark.parametrize("count", [0, 8, 9, 5_000])
def test_any_number_of_spans_in_a_hint(spark, count):
    inner = "".join(f"<span class=s>w{i}</span> " for i in range(count))
    found = slot_of(spark, f'<span class="highlight">K:</span> <span class="placeholder">[say {inner}now]</span>')
    hint = " ".join(["say", *(f"w{i}" for i in range(count)), "now"])
    assert found == ("K", None, hint, True)


def test_an_attribute_is_the_first_that_gives_it(spark):
    pages = [
        "<html lang lang=en>",
        "<html data-lang=x lang=de lang=fr>",
        "<html a='lang=en'>",
        "<meta name=charset content='charset=a'><meta charset=b>",
        "<meta http-equiv=refresh http-equiv=content-type content='x; charset=c'>",
    ]
    rows = op.document_metadata(documents(spark, *pages)).orderBy("doc_id").collect()
    assert [(r["lang"], r["charset"]) for r in rows] == [("en", None), ("de", None), (None, None), (None, "b"), (None, "c")]
