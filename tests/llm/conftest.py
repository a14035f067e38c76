"""Small tables with the awkward cases: NULLs in every column, empty and very
long texts, ties, repeated rows, extra columns whose names the operators use."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship_package

VOCABULARY = ["the", "of", "Stone", "river", "Éte", "straße", "and", "wall,", "lamp.", "to", "in", "green", "house", "walked", "quiet", "night"]
EXTRA = ["block", "part", "size", "shard", "slot", "fp", "key", "n_words", "kept", "score", "ids", "record"]


def make_documents() -> list[tuple]:
    rng = random.Random(17)

    def text(n):
        return " ".join(rng.choice(VOCABULARY) + (str(rng.randrange(90)) if rng.random() < 0.4 else "") for _ in range(n))

    shared = text(70)
    base = text(160)
    words = base.split()
    near = " ".join(words[:80] + ["changed"] + words[81:])
    rows = [
        (0, None), (1, ""), (2, "   \n\t "), (3, "word"), (4, "two words"), (5, base), (6, base), (7, near), (8, base.upper()),
        (9, text(40) + " " + shared + " " + text(30)), (10, text(55) + "\n" + shared + "\n" + text(60)), (11, shared),
        (12, " ".join(["again and again"] * 60)), (13, "\n".join(["same line here"] * 30) + "\n\n" + text(60)),
        (14, text(6000)), (15, "café mail a.b+c@d-e.org, ip 10.0.0.1 card 4111 1111 1111 1111 call +1 (555) 123-4567 now"),
        (16, "see https://x.example.org/a?b=1, password=abc12345 at 12 Baker Street and token = \"deadbeef99\""),
        (17, "1.2.3.4.5.6.7.8 999.1.1.1 a@b.c@d.e +12345 4111111111111112"), (18, "x　y z\x1c<|endoftext|> \x7f"),
        (19, text(120) + " ### $$$ ***"), (20, shared + " " + shared), (None, base), (None, None), (21, text(300)), (21, text(300)), (5, base),
    ]
    rows += [(100 + i, base if i % 3 else near) for i in range(12)]
    rows += [(200 + i, text(60 + i)) for i in range(25)]
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return make_documents()


@pytest.fixture(scope="session")
def llm_dir(spark, doc_rows, tmp_path_factory):
    """Folder of the awkward tables."""
    ship_package(spark)
    root = str(tmp_path_factory.mktemp("llm") / "tables")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    docs = spark.createDataFrame(doc_rows, schema)
    docs = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("hot"), "n_chars": F.length("text").cast("long")})
    docs = docs.withColumns({c: F.lit(c) for c in EXTRA})
    docs.repartition(3).write.parquet(f"{root}/documents.parquet")
    items = [(0, " ".join(VOCABULARY[i % 16] + str(i * 7 % 50) for i in range(30)) + ". The answer is green lamp."), (1, None), (2, ""),
             (3, "too short"), (4, doc_rows[11][1]), (4, doc_rows[11][1]), (None, "unrelated " * 3 + "item that nobody copied anywhere at all today. Really not.")]
    spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).write.parquet(f"{root}/benchmark.parquet")
    labels = [(5, 1, 0), (6, 1, 0), (13, 0, 0), (12, 0, 0), (200, 1, 0), (201, 1, 0), (202, 1, 1), (None, 1, 0), (203, None, None), (204, 1, None), (5, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    pages = [(0, "http://a.example/x", "<html lang='en'><title>T &amp; t</title><script>no</script><p>One<br>two <a href='/l'>three</a></p></html>"),
             (1, None, "<p>x"), (2, "http://b.example/", None), (None, "http://c.example/\r\nX: y", ""), (0, "http://a.example/x", "<b>dup</b>"),
             (0, "http://a.example/x", "<b>dup</b>"), (3, "http://d.example/", "<p>" + "long text " * 20000 + "</p>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("record", F.lit("x")).write.parquet(f"{root}/pages.parquet")
    return root


@pytest.fixture(scope="session")
def empty_dir(spark, llm_dir, tmp_path_factory):
    """The same tables without rows."""
    root = str(tmp_path_factory.mktemp("llm-empty") / "tables")
    for name in ("documents", "benchmark", "labels", "pages"):
        spark.read.parquet(f"{llm_dir}/{name}.parquet").limit(0).write.parquet(f"{root}/{name}.parquet")
    return root
