from corpusmill.constants import MAX_ENTITY_QUESTIONS, MAX_KEYWORD_QUESTIONS, MAX_PARAGRAPHS, MAX_TEXT_LENGTH
from corpusmill.functions import dates, keywords, links, questions, relations
from corpusmill.functions import text as X
from corpusmill.functions.topics import classify_topic
from pyspark.sql import functions as F


def test_clean_text(one):
    cases = {
        "Example [1] text  with\n  extra spaces [23]": "Example text with extra spaces",
        "Hello [[Link|World]]<sup>1</sup> [[Page]]": "Hello World Page",
        "ＡＢＣ": "ABC",
        "a b &amp; c<!-- no --> <script>x<y</script>d": "a b & c d",
        "2 < 3 and 4 > 1": "2 < 3 and 4 > 1",
    }
    for raw, want in cases.items():
        assert one(X.clean_text, t=raw) == want


def test_clean_wiki_text(one):
    assert one(X.clean_wiki_text, t="<p>Hello [[Link|World]] {{temp}}</p>") == "Hello World"
    assert one(X.clean_wiki_text, t="a {{x\ny}} b [[Only]]") == "a b Only"


def test_advanced_clean(one):
    out = one(lambda t: X.advanced_clean_text(t, F.lit("pt")), t="<div>Example</div>\n[[1]]\n== Referências ==\nTexto")
    assert out == "Example 1"
    out = one(lambda t: X.advanced_clean_text(t, F.lit("en")), t='Intro {{Infobox}} text {| class="wikitable" | data |}')
    assert out == "Intro text"
    out = one(lambda t: X.advanced_clean_text(t, F.lit("en")), t="Something\n== See also ==\nOther info")
    assert out == "Something =="
    out = one(lambda t: X.advanced_clean_text(t, F.lit("de")), t="Größe übel [3]")
    assert out == "Grosse ubel"
    shared = "a == bibliography == references == b"
    assert one(lambda t: X.advanced_clean_text(t, F.lit("en")), t=shared) == "a == bibliography"
    assert one(lambda t: X.advanced_clean_text(t, F.lit("en")), t="a == x == y == References == b") == "a == x == y"
    assert one(lambda t: X.advanced_clean_text(t, F.lit("es")), t="año VÉASE TAMBIÉN otro") == "año"


def test_advanced_clean_split(one):
    def parts(stops=None):
        return lambda t: X.advanced_clean_text(t, F.lit("en"), stops, split=True)

    assert one(parts(), t=" [[One]] été [3]. Two!?\n== References ==\nno. no") == ["One ete", "Two"]
    assert one(parts({"en": ["the"]}), t="The cat. A the dog") == ["cat", "A dog"]
    assert one(parts(), t="") == [] and one(parts(), t=None) is None


def test_stop_words(one):
    stops = {"en": ["the", "and"]}
    assert one(lambda t: X.remove_stop_words(t, F.lit("en"), stops), t="the quick and brown fox") == "quick brown fox"
    assert one(lambda t: X.remove_stop_words(t, F.lit("fr"), stops), t="the fox") == "the fox"


def test_default_stop_words(spark):
    lists = X.default_stop_words(spark)
    assert "the" in lists["en"] and "und" in lists["de"]


def test_sentences(one):
    assert one(X.split_sentences, t=" One. Two!? \n Three ...") == ["One", "Two", "Three"]
    assert one(X.split_sentences, t="...") == []


def test_fold(one):
    assert one(X.fold_accents, t="Ação œuvre Łódź straße – “x”") == 'Acao oeuvre Lodz strasse - "x"'
    assert X.fold_text("Ação ß") == "Acao ss"


def test_parse_date(one):
    cases = {
        "January 1, 2020": "2020-01-01",
        "1 Jan 2020": "2020-01-01",
        "born 3rd of March 1999 in town": "1999-03-03",
        "2020-02-30": "",
        "03/04/2021": "2021-03-04",
        "25/12/2021": "2021-12-25",
        "20240229": "2024-02-29",
        "March 2020": "",
        **{f"5 {m} 2001": f"2001-{i:02d}-05" for i, m in enumerate(
            "January February March April May June July August Sept October Nov December".split(), 1)},
        "": "",
        "nothing": "",
    }
    for raw, want in cases.items():
        assert one(dates.parse_date, t=raw) == want, raw


def test_infobox_and_person(spark):
    box = F.create_map(*[F.lit(x) for x in ["title", " Page ", "date", "1 Jan 2020", "update", "x"]])
    person = F.create_map(*[F.lit(x) for x in ["name", "Guido", "birth_date", "1956", "occupation", "Programmer|BDFL"]])
    row = spark.range(1).select(
        dates.normalize_infobox(box).alias("b"), dates.normalize_person(person).alias("p"),
        dates.normalize_person(F.create_map(F.lit("x"), F.lit("y"))).alias("q"),
    ).first()
    assert row["b"] == {"title": "Page", "date": "2020-01-01", "update": ""}
    assert row["p"].asDict() == {"name": "Guido", "birth_date": "1956", "occupation": ["Programmer", "BDFL"]}
    assert row["q"].asDict() == {"name": "", "birth_date": "", "occupation": [""]}


def test_relations(one, spark):
    found = one(relations.extract_relations, t="Ada worked at IBM. Bob studied at MIT.")
    assert [tuple(r) for r in found] == [("Ada", "worked at", "IBM"), ("Bob", "studied at", "MIT")]
    df = spark.createDataFrame([([1, 1, 2], [3, 1, 3, 4])], "a array<int>, b array<int>")
    assert df.select(relations.merge_relations(F.col("a"), F.col("b"))).first()[0] == [1, 1, 2, 3, 4]


def test_topic(one):
    out = one(classify_topic, a="Deep Learning", b="O processamento de linguagem natural evoluiu")
    assert tuple(out) == ("ai", "nlp")
    assert tuple(one(classify_topic, a="Horse", b="Gallop")) == ("engenharia de software", "geral")


def test_questions(one, spark):
    out = one(lambda q: questions.translate_question(q, F.lit("es")), q="How does Python relate to programacion?")
    assert out == "Cómo Python se relaciona con programacion?"
    out = one(lambda q: questions.translate_question(q, F.lit("pt")), q="What is the role of x in y?")
    assert out == "O que é the role of x in y?"
    kws = F.array(*[F.lit(f"k{i}") for i in range(7)])
    ents = F.array(F.struct(F.lit("Ann").alias("text"), F.lit("PERSON").alias("type")),
                   F.struct(F.lit("1999").alias("text"), F.lit("DATE").alias("type")))
    capped = questions.generate_questions(F.lit("T"), F.lit("en"), kws, ents, MAX_KEYWORD_QUESTIONS, MAX_ENTITY_QUESTIONS)
    qs = spark.range(1).select(capped).first()[0]
    assert len(qs) == 1 + 3 * 5 + 1
    assert qs[0]["text"] == "What is T?" and qs[-1]["text"] == "What is the significance of Ann in T?"


def test_answers(one):
    out = one(lambda c, s: questions.generate_answers(c, s, MAX_TEXT_LENGTH, MAX_PARAGRAPHS), c="p1\n \np2\np3\np4" + "x" * 10100, s="sum")
    assert [a["type"] for a in out] == ["summary", "detailed", "paragraph", "paragraph", "paragraph"]
    assert len(out[1]["text"]) == 10000


def test_questions_and_answers_whole(spark, one):
    text = "p1\n \np2\np3\np4" + "x" * 10100
    out = one(questions.generate_answers, c=text, s="sum")
    assert [a["text"] for a in out] == ["sum", text, "p1", "p2", "p3", "p4" + "x" * 10100]
    kws = F.array(*[F.lit(f"k{i}") for i in range(7)])
    ents = F.array(*[F.struct(F.lit(f"e{i}").alias("text"), F.lit("PERSON").alias("type")) for i in range(6)])
    whole = questions.generate_questions(F.lit("T"), F.lit("en"), kws, ents)
    assert len(spark.range(1).select(whole).first()[0]) == 1 + 3 * 7 + 6


def test_zip(spark):
    rows = [(["a", "b", "c"], ["x"]), ([], ["x"]), (None, ["x"]), (["a"], None), (["a", "b"], ["x", "y"])]
    df = spark.createDataFrame(rows, "l array<string>, r array<string>")
    got = [r[0] for r in df.select(questions.zip_shorter(F.col("l"), F.col("r"), "q", "a")).collect()]
    assert [[tuple(p) for p in g or []] for g in got] == [[("a", "x")], [], [], [], [("a", "x"), ("b", "y")]]


def test_keywords(one):
    out = one(lambda t: keywords.extract_keywords(t, F.lit("en"), {"en": ["the", "of"]}), t="The cat of cat the Dog cat")
    assert out[0] == "cat" and "cat of cat" in out and "the" not in out
    out = one(lambda t: keywords.extract_keywords(t, F.lit("en"), {}, n=2, max_words=1), t="b a b a c")
    assert out == ["b", "a"]


def test_urls(one):
    assert tuple(one(links.parse_page_url, u="https://pt.wikipedia.org/wiki/Intelig%C3%AAncia_+a?x=1#y")) == ("Inteligência_+a", "pt")
    assert one(lambda u: links.base_url(u), u="xx") == "https://xx.wikipedia.org"
    assert one(links.link_title, u="https://en.wikipedia.org/wiki/A_B%20C") == "A B C"
    assert one(links.link_title, u="https://x.org/?q=/wiki/A") is None


def test_extract_links(one):
    html = (
        '<a href="/wiki/Page1">P1</a><a href="https://example.com/wiki/Page2">P2</a>'
        "<a href=\"/other/Page3\">P3</a><a class=x href='/wiki/Page4?a=1&amp;b=2'>P4</a><!-- <a href=\"/wiki/No\"> -->"
        '<a href="./wiki/Rel">r</a><a href="//de.x.org/wiki/P">p</a>'
    )
    out = one(lambda h: links.extract_links(h, F.lit("https://en.wikipedia.org")), h=html)
    assert out == [
        "https://en.wikipedia.org/wiki/Page1", "https://example.com/wiki/Page2", "https://en.wikipedia.org/wiki/Page4?a=1&b=2",
        "https://en.wikipedia.org/wiki/Rel", "https://de.x.org/wiki/P",
    ]
