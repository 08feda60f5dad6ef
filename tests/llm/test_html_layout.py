import re

from corpusmill.llm import html_layout as hl

SF = "/root/testdata/sf0.001"


def shown(source):
    return hl.render(source)[0]


def test_blocks_and_inline():
    assert shown("<h1>Title</h1><p>One <b>two</b>\n three<br>four<p>five") == "Title\n\nOne two three\nfour\n\nfive"
    assert shown("<div>a</div><div>b</div>c") == "a\nb\nc"
    assert shown("plain &amp; simple &lt;x&gt;") == "plain & simple <x>"
    assert shown("<pre> keep\n  this </pre>end") == " keep\n  this\n\nend"
    assert shown("a<hr>b") == "a\n\nb"


def test_hidden():
    assert shown("a<script>var x='</p>';</script><style>p{}</style>b") == "ab"
    assert shown("<p hidden>x</p><p style='DISPLAY: none'>y</p><p>z<span aria-hidden=true>q</span></p><!-- c --><head><title>t</title></head>w") == "z\n\nw"
    assert shown("<div style=\"visibility:hidden\">a<table><tr><td>b</table></div>c") == "c"


def test_lists():
    assert shown("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>f") == "- a\n- b\n  3. c\n  4. d\n- e\n\nf"


def test_tables():
    assert shown("<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>x<td>22</table>z") == "name       n\nlong name  1\nx          22\n\nz"
    assert shown("<table><caption>cap</caption><tr><td>a<p>b</p></td><td><table><tr><td>i<td>j</table></td></tr></table>") == "cap\na  i  j\nb"


def test_drawings_formulas_and_objects():
    assert shown("a <svg><title>t</title><desc>d</desc><metadata/><path d='x'/><text>one</text><text>two</text><defs><text>no</text></defs></svg> b") == "a one two b"
    assert shown("<svg><text display='none'>x</text><text>y</text></svg>z<svg/>w") == "y zw"
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mi>a</mi><mn>2</mn></mfrac></mrow><annotation>tex</annotation></semantics></math>"
    assert shown(f"so {formula} holds") == "so x=a 2 holds"
    assert shown("<object data=f.pdf><param name=n value=v><p>See the file</p></object>") == "See the file"


def test_select_shows_its_choice():
    assert shown("Size <select><option>S<option selected>M &amp; L<option>XL</select> now") == "Size M & L now"
    assert shown("<select><option disabled>Pick</option><optgroup label=g><option>One</option><option>Two</option></optgroup></select>") == "One"
    assert shown("<select><option disabled selected hidden>Pick</option><option>One</option></select>") == "Pick"
    assert shown("<select multiple><option>One<option hidden>No<option>Two</select>x") == "One\nTwo\nx"
    assert shown("<ul><li><select><option label='L'>One</select></ul><select hidden><option>h</select>") == "- L"
    assert shown("<table><tr><td><select><option>a<td>b</table>") == "a  b"


def test_broken_input():
    assert shown(None) == "" and shown("") == ""
    assert shown("a</b></div><p>b<") == "a\n\nb<"
    assert shown("x<!-- never closed <p>y") == "x"
    assert shown("<a title='unclosed>b</a>c") in ("bc", "c")
    deep = "<div>" * 5_000 + "x" + "<b>" * 5_000 + "y"
    assert shown(deep) == "xy"
    assert shown("<" * 20_000) == "<" * 20_000


def test_pages(spark, run_query):
    """All words of the article's paragraphs are shown, in order; scripts are not."""
    from html import unescape

    got = run_query("op8_html_layout", "page_id")
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        text = got[r["page_id"]]["text"]
        assert "track(" not in text and "margin:0" not in text
        body = re.sub(r"<head>.*?</head>|<script>.*?</script>|<style>.*?</style>|<!--.*?-->", "", r["html"], flags=re.S)
        flat = unescape(re.sub(r"<[^>]+>", " ", body)).split()
        marks = {"-", ">"}
        assert [w for w in text.split() if w not in marks and not re.fullmatch(r"\d+\.", w)] == [w for w in flat if w not in marks and not re.fullmatch(r"\d+\.", w)] or "display:none" in r["html"] or "hidden" in r["html"]


def test_awkward(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (None, "<p>x"), (2, "<p>y")], "page_id long, html string")
    assert sorted(r["text"] for r in hl.render_pages(pages).collect()) == ["", "", "x", "y"]
    assert hl.render_pages(pages.filter("false")).count() == 0
