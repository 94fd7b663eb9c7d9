"""Readable text and metadata of made pages."""

from gristmill.functions import article
from pyspark.sql import functions as F

LONG = "A sentence of an article that is long enough to be kept."


def test_pages(spark):
    page = f"""<HTML><head><title>t</title><meta property="og:site_name" content=" The Press "></head><body><nav><p>{LONG} in a nav</p></nav><!-- <p>{LONG}</p> -->
    <script>var x = "<p>{LONG}</p>"</script><div><h1>Title</h1><p>{LONG} <a href=x>one</a></p><p><a href=y>{LONG}</a> {LONG[:9]}</p><ul><li>short</li></ul><p>{LONG}\n  &amp; more</p></div><footer>{LONG}</footer>"""
    rows = [(1, page, "", None), (2, "<p>short text</p><p>tiny</p><p><a>all of it a link</a></p>", "own", "2024"), (3, "", None, ""), (4, None, None, None), (5, f"<p>{LONG * 3000}", None, None), (6, "<meta content='2024-05-01' name='article:published_time'>plain " + LONG, None, "")]
    df = spark.createDataFrame(rows, "i int, html string, press string, published string").withColumn("b", article.blocks(F.col("html")))
    got = {r.i: r for r in df.select("i", article.article_text(F.col("b"), 100).alias("t"), article.with_page(F.col("press"), F.col("published"), F.col("html")).alias("m")).collect()}
    assert got[1].t == f"{LONG} one\n{LONG} & more"
    assert got[2].t == "short text" and got[3].t == "" and got[4].t is None and got[5].t == LONG * 3000 and got[6].t == "plain " + LONG
    assert tuple(got[1].m) == ("The Press", None) and tuple(got[2].m) == ("own", "2024") and tuple(got[6].m) == (None, "2024-05-01") and tuple(got[4].m) == (None, None)
