from pyspark.sql import functions as F

from qbank.operators import sections as SEC


def test_union_folds_chapter_text_and_fills_missing(spark):
    econ = spark.createDataFrame([("keyterms", "T", "1-key-terms", "b", "u1", [("t", "d")])],
                                 "section_name string, section_text string, chapter_name string, "
                                 "textbook_name string, chapter_url string, "
                                 "key_terms array<struct<term:string,definition:string>>")
    fin = spark.createDataFrame([("summary", "C", "2-summary", "b", "u2", [("q", "a")])],
                                "section_name string, chapter_text string, chapter_name string, "
                                "textbook_name string, chapter_url string, "
                                "questions_and_answers array<struct<question:string,answer:string>>")
    out = {r.section_name: r for r in SEC.union_sections(econ, fin).collect()}
    assert out["summary"].section_text == "C" and out["summary"].key_terms is None
    assert out["keyterms"].questions_and_answers is None
    assert set(SEC.SECTION_SCHEMA.fieldNames()) <= set(SEC.union_sections(econ, fin).columns)


def test_delivery_envelope_and_sentence_variant(spark):
    df = spark.createDataFrame([("s", " One. Two .. ", "c", "b", "u")],
                               ["section_name", "section_text", "chapter_name", "textbook_name",
                                "chapter_url"])
    plain = SEC.envelope_json(SEC.delivery_envelope(df, "2024-11-01")).first().value
    assert plain.startswith('{"text":" One. Two .. ","metadata":{"date downloaded":"2024-11-01"')
    assert '"volunteer id":"2052","location":"Atlanta, USA"' in plain
    split = SEC.delivery_envelope(df, "2024-11-01", sentence_split=True).first().record.text
    assert split == "One Two"


def test_dedup_links_keeps_each_url_once(spark):
    df = spark.createDataFrame([("a", "r"), ("a", "r"), ("b", "r")], ["resolved_url", "route"])
    assert sorted(r.resolved_url for r in SEC.dedup_links(df).collect()) == ["a", "b"]
