"""Language ID: whole pages, held-out accuracy, junk, and defined cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from cashwatch.llm.language import UNDETERMINED, document_evidence, fit, identify, page_evidence

SF = "/root/testdata/sf0.01"
PAGE = "page_id bigint, url string, html string"


def test_markup_of_any_length_is_read(spark):
    far = "<!-- " + "x" * 12_000 + " -->"
    rows = [
        (1, "http://a.example.de/x", f"<!DOCTYPE html>{far}<html data-x='{'y' * 20_000}' lang=\"de\"><body>wort &{'a' * 30}; <img src='{'z' * 10_000}'>ende"),
        (2, None, "a < b <unclosed " + "<" * 5000),
        (3, "http://b.example/fr/x", "<p lang='es'>texte</p><script>if (a<b) {lang='de'}</script>"),
        (4, "x", None),
    ]
    found = {r.page_id: r for r in page_evidence(spark.createDataFrame(rows, PAGE)).collect()}
    assert found[1].declared == "de" and found[1].text.split() == ["wort", "ende"] and found[1].suffix == "de"
    assert found[2].text.startswith("a < b <unclosed <<<") and len(found[2].text) == len(rows[1][2])
    assert found[3].text.split() == ["texte"] and found[3].suffix == "fr" and found[3].declared == ""
    assert found[4].text == ""


def test_many_unclosed_tags_take_linear_time(spark):
    html = "<html " * 200_000 + "<p " * 200_000
    row = page_evidence(spark.createDataFrame([(1, "u", html)], PAGE)).first()
    assert row.text == html


def test_rows_that_were_not_fitted_on_get_their_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(docs.filter("doc_id % 2 = 0").select("text", "lang"))
    held_out = docs.filter("doc_id % 2 = 1")
    hidden = identify(document_evidence(held_out.withColumn("lang", F.lit(None).cast("string"))), model, keep_text=False)
    found = hidden.select("row.doc_id", "language", "accepted").join(held_out.select("doc_id", "lang"), "doc_id").collect()
    right = [r.language == r.lang for r in found if r.accepted]
    assert len(right) > 0.9 * len(found) and sum(right) > 0.98 * len(right)
    pages = page_evidence(spark.read.parquet(f"{SF}/pages.parquet"))
    named = identify(pages.withColumn("truth", F.col("declared")).withColumn("declared", F.lit("")), model, keep_text=False)
    judged = named.filter("accepted AND truth <> ''").selectExpr("count(*) AS n", "count_if(language = truth) AS same").first()
    assert judged.n > 100 and judged.same > 0.85 * judged.n


def test_junk_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(docs.select("text", "lang"))
    junk = ["zqxj wvkq jjxz qqkz vxzj kqwx zzjq " * 30, "0000 1111 !!!", "", None, "\x00\x01"]
    rows = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(junk)], "doc_id bigint, text string, lang string, source string")
    clashing = rows.withColumns({"language": F.lit("en"), "probability": F.lit(1.0), "host": F.lit("h"), "accepted": F.lit(True)})
    found = identify(document_evidence(clashing), model).collect()
    assert [r.accepted for r in found] == [False] * 5 and found[0].language == UNDETERMINED
    assert [r.row.language for r in found] == ["en"] * 5
    assert identify(document_evidence(clashing.limit(0)), model).count() == 0
    twice = identify(document_evidence(docs.limit(3).unionAll(docs.limit(3))), model, keep_text=False)
    assert twice.groupBy("row.doc_id", "language").count().filter("count <> 2").count() == 0
