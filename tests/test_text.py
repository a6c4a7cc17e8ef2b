"""Text, page, chunk and prompt expressions."""

import json

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from tallyweave.functions import prompts as pr
from tallyweave.functions import text as tx
from tallyweave.operators import documents as dc

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style></head><body>'
    '<script>if (a < b) "<p>no</p>"</script><!-- <p>no</p> --><h1>Big <b>one</b></h1>'
    '<p>A &amp;lt; B &#65;&#x42; &bogus; &copy;<a href=x>link</a>\nend<p>two'
    '<h2>Small</h2><table><tr><th>Y 2019</th><td>1 < 2</td></tr></table>'
    '<ul><li>i1<li>i2</ul><TABLE><td>last</td></TABLE></body></html>'
)


def value(spark, column, **data):
    schema = ", ".join(
        f"{k} {'array<struct<role string, content string>>' if isinstance(v, list) else 'string'}"
        for k, v in data.items())
    return spark.createDataFrame([tuple(data.values())], schema).select(column.alias("x")).first().x


def test_visible_text(spark):
    text = value(spark, tx.html_text("h"), h=PAGE)
    assert text == "TBig oneA &lt; B AB &bogus; © endtwoSmallY 20191 < 2i1i2last"
    assert value(spark, tx.html_text("h"), h=None) is None


def test_sql_functions(spark):
    tx.register(spark)
    df = spark.createDataFrame([(PAGE,), ("a & b",), (None,)], "h string")
    both = df.select(tx.html_text("h").alias("a"), F.expr("html_text(h)").alias("b")).collect()
    assert all(r.a == r.b for r in both)
    long = spark.createDataFrame([("w " * 250,), ("",), (None,)], "t string")
    both = long.select(tx.word_chunks("t").alias("a"), F.expr("word_chunks(t)").alias("b")).collect()
    assert all(r.a == r.b for r in both) and [len(r.a or []) for r in both] == [3, 0, 0]
    assert df.selectExpr("file_name('a/b.pdf') f", "squeeze(' a \n b') s").first() == ("b.pdf", "a b")


def test_elements_and_tables(spark):
    elements = tx.html_elements("h")
    found = value(spark, elements, h=PAGE)
    assert [(e.category, e.text) for e in found] == [
        ("Title", "Big one"), ("NarrativeText", "A &lt; B AB &bogus; ©link end"),
        ("NarrativeText", "two"), ("Title", "Small"), ("Table", "Y 2019 1 < 2"),
        ("ListItem", "i1"), ("ListItem", "i2"), ("Table", "last")]
    df = spark.createDataFrame([(PAGE,)], "h string").select(elements.alias("elements"))
    parts = [r.content for r in dc.document_rows(df).orderBy("part").collect()]
    assert parts[0] == (
        "-- Document title Big one, Small -- \n-- Table title Small -- \n"
        "<table><tr><th>Y 2019</th><td>1 < 2</td></tr></table>")
    assert len(parts) == 3 and parts[2].startswith("Big oneA &lt; B") and parts[2].endswith("i1i2")


def test_table_before_a_title_and_without_markup(spark):
    rows_ = [("d", 0, "Table", "t", "<table/>"), ("d", 1, "Title", "One", None),
             ("d", 2, "Table", "no markup", None), ("d", 3, "Text", "body", None)]
    elements = spark.createDataFrame(
        rows_, "file_name string, pos long, category string, text string, text_as_html string")
    documents = dc.gather_elements(elements.repartition(3), ["file_name"])
    assert [r.content for r in dc.document_rows(documents).orderBy("part").collect()] == [
        "-- Document title  -- \n-- Table title  -- \n<table/>", "Onebody"]


def test_gather_in_slices(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id").repartition(7)
    got = dc.gather(df, ["g"], "id", F.col("id"), "ids", slice_rows=16).collect()
    assert {r.g: r.ids for r in got} == {g: list(range(g, 1000, 2)) for g in (0, 1)}


def test_titles_and_years(spark):
    assert value(spark, tx.table_title("h"), h="<th>a</th> x <th class=y>b 2014</th> tail") == " tail"
    assert value(spark, tx.table_title("h"), h="no cells") == "no cells"
    assert value(spark, tx.years_in("h"), h="r2014-2019 and 2021") == ["2014", "2021"]
    assert value(spark, tx.years_in("h", "20[0-9]{2}"), h="2019") == ["2019"]


def test_path_ids(spark):
    paths = spark.createDataFrame(
        [("/Volumes/x/crawler_3/pdfs/5.pdf",), ("/Volumes/x/crawler_3/pdfs/123.pdf",), ("/x/a.pdf",)],
        "file_name string")
    assert [r[0] for r in paths.select(dc.id_from_path("file_name")).collect()] == [5, 123, None]
    documents = spark.createDataFrame([(5,), (6,)], "id long")
    assert rows(dc.join_by_path_id(documents, paths).select("id", "pdf_id")) == [(5, 5), (6, None)]
    assert [r[0] for r in paths.select(dc.id_at("file_name", 27, 2)).collect()] == [None, 12, None]


def test_escapes_and_lines(spark):
    assert value(spark, tx.strip_escapes("h"), h='say "caf\\xc3\\xa9 au" \\n on') == "say caf   on"
    assert value(spark, tx.tidy_lines("h"), h=" a \n\n \n  b\t\n") == "a\n\nb\n".rstrip(" ")
    lines = "1 2 3 words here\n1 2 a b c\n10 20 30 x.\n\n7"
    assert value(spark, tx.drop_numeric_lines("h"), h=lines) == "1 2 a b c\n10 20 30 x.\n"


words = some.lists(some.sampled_from(["a", "bb", "c.", "d!", "eee"]), max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(words, some.integers(2, 9), some.integers(0, 1))
def test_word_chunks_rebuild_the_text(spark, parts, length, overlap):
    chunks = value(spark, tx.word_chunks("t", length, overlap), t=" ".join(parts))
    split = [c.split(" ") for c in chunks]
    rebuilt = split[0] if split else []
    for chunk in split[1:]:
        assert len(chunk) > overlap and rebuilt[len(rebuilt) - overlap:] == chunk[:overlap]
        rebuilt = rebuilt + chunk[overlap:]
    assert rebuilt == parts and all(len(c) <= length for c in split)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(words, some.integers(3, 12))
def test_packed_chunks_keep_every_character(spark, parts, limit):
    text = " ".join(parts)
    chunks = value(spark, tx.packed_chunks("t", limit), t=text)
    assert all(0 < len(c) <= limit for c in chunks)
    assert "".join(chunks).replace(" ", "") == text.replace(" ", "")


def test_chunk_routing(spark):
    documents = spark.createDataFrame(
        [(1, None, "a/x2014.pdf"), (2, "-- table\n" + "x " * 400, "a/y.pdf"),
         (3, "One. " * 150, "a/r2019-2021.pdf"), (4, "", "a/z.pdf")],
        "id long, content string, doc_url string")
    cut = dc.chunk_rows(documents).orderBy("id", "chunk_no").collect()
    assert [(r.id, r.chunk_no) for r in cut] == [(2, 0), (3, 0), (3, 1)]
    assert cut[0].chunk == cut[0].content and cut[0].meta is None
    assert len(cut[1].chunk) <= 500
    assert json.loads(cut[1].meta) == {"file": "r2019-2021.pdf", "year": ["2021"]}


def test_sentence_numbers_run_over_files(spark):
    files = spark.createDataFrame(
        [("b.pdf", "One. Two!"), ("a.pdf", "Three? Four"), ("c.pdf", ""), ("d.pdf", None)],
        "file string, text string")
    got = dc.sentence_rows(files, "file", "text").orderBy("id").collect()
    assert [r.id for r in got] == [100, 101, 102, 103]
    by_file = {}
    for r in got:
        by_file.setdefault(r.title, []).append(r.content)
    assert by_file == {"b.pdf": ["One.", "Two!"], "a.pdf": ["Three?", "Four"]}
    twice = dc.sentence_rows(files.unionByName(files), "file", "text", slice_rows=3)
    assert sorted(r.id for r in twice.collect()) == list(range(100, 108))


def test_page_and_file_text(spark):
    pages = spark.createDataFrame([(1, "h1"), (2, "h2")], "id long, html_text string")
    files = spark.createDataFrame([(1, "p1"), (2, None), (3, "p3")], "id long, pdf_content string")
    assert rows(dc.join_page_and_file(pages, files).select("id", "html_pdf_content")) == [
        (1, "h1----p1"), (2, "h2")]


def test_dialogs(spark):
    three = [("user", "q1"), ("assistant", "a1"), ("user", "q2")]
    assert value(spark, pr.question_of("m"), m=three) == "q2"
    assert len(value(spark, pr.history_of("m"), m=three)) == 2
    assert value(spark, pr.history_of("m"), m=three[:1]) == []
    assert value(spark, pr.transcript(pr.history_of("m")), m=three) == "user: q1\nassistant: a1"
    route = pr.retrieval_query(pr.history_of("m"), pr.question_of("m"), F.lit("new"))
    assert value(spark, route, m=three) == "new"
    assert value(spark, route, m=three[:1]) == "q1"


def test_prompts(spark):
    assert value(spark, pr.fill("<{a}|{b}>", a="x", b="y"), x="1{b}", y=None) == "<1{b}|>"
    assert value(spark, pr.fill(pr.ASSISTANT, question="x"), x="Q").endswith("this question: Q")
    yes = value(spark, pr.routed("x", F.lit("r"), F.array(F.lit("s"))), x="Yes.")
    no = value(spark, pr.routed("x", F.lit("r"), F.array(F.lit("s"))), x="no idea")
    assert (yes.result, yes.sources) == ("r", ["s"]) and (no.result, no.sources) == (pr.REFUSAL, [])
    assert value(spark, pr.with_passage("x", F.lit("p")), x="q") == "q Adding additional context: p"
    assert value(spark, pr.temperature_or_default(F.lit(None).cast("double")), x="") == 1.0
    assert value(spark, pr.new_tokens_or_default(F.lit(7).cast("long")), x="") == 7
