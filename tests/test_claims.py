"""Conditional fields, the eight questions and applicability by hand."""

from pyspark.sql import functions as F

from millrace.operators import knowledge as K


def test_broken_conditions(spark):
    df = spark.createDataFrame([(1, "edge", "e1"), (2, "edge", None), (3, "claim", "e1"), (4, "claim", None), (5, None, "e1"), (6, None, None), (2, "edge", None)], "id int, derivation string, edge string")
    df = df.withColumn("BROKEN_", F.lit(1))
    rules = {"edge": (F.col("derivation") == "edge", F.col("edge").isNotNull()), "named": (F.lit(True), F.col("derivation").isNotNull())}
    got = sorted((r["id"], tuple(r["broken"])) for r in K.broken_conditions(df, rules).collect())
    assert got == [(2, ("edge",)), (2, ("edge",)), (3, ("edge",)), (5, ("edge", "named")), (6, ("named",))]
    assert K.broken_conditions(df.limit(0), rules).count() == 0


def test_eight_questions(spark):
    articles = spark.createDataFrame([(10, "u10", "p", None), (11, "u11", None, 10), (12, "u12", "p", 99), (13, None, "p", 13)], "article_id int, source_url string, publisher string, origin_id int")
    evidence = spark.createDataFrame(
        [(1, 10, "t", "m", 2), (2, 11, "t", "m", None), (3, 12, None, "m", 1), (4, 13, "t", None, 1), (5, None, "t", "m", 1), (1, 10, "t", "m", 2)],
        "evidence_id int, article_id int, created_at string, produced_by string, schema_version int",
    )
    refs = spark.createDataFrame([(1,), (1,), (2,), (4,), (None,)], "evidence_id int")
    answers = K.provenance_answers(evidence, articles, refs, refs.filter("evidence_id != 2"))
    first = [r.asDict() for r in answers.filter("evidence_id = 1").collect()]
    assert len(first) == 2 and first[0] == first[1] and first[0]["referenced_by_claims"] == 2
    assert (first[0]["original_source"], first[0]["created_by_pipeline"]) == ("u10", "m@2")
    assert answers.filter("evidence_id = 2").first()["original_source"] == "u10"
    still = {r["evidence_id"]: r["unanswered"] for r in K.unanswered(answers, K.QUESTIONS).collect()}
    assert still == {
        2: ["published_by", "created_by_pipeline", "derived_facts"],
        3: ["retrieved_at", "original_source", "referenced_by_claims", "derived_facts"],
        4: ["where_from", "original_source", "collected_by", "created_by_pipeline"],
        5: ["where_from", "published_by", "original_source", "referenced_by_claims", "derived_facts"],
    }


def test_applicable_to_claims(spark):
    items = spark.createDataFrame([(1, "text", "factual", "en"), (2, "text", "factual", "fr"), (3, "text", "opinion", "en"), (4, "image", None, "en"), (5, None, None, None), (6, "text", "factual", None)], "item_id int, modality string, claim_type string, language string")
    analysers = spark.createDataFrame([("b", ["text"], ["factual"], ["en"]), ("a", ["text", "image"], ["factual"], ["en", "de"]), ("c", ["text"], ["factual"], None)], "analyser string, modalities array<string>, claim_types array<string>, languages array<string>")
    got = {r["item_id"]: (r["analysers"], r["status"]) for r in K.applicable_to_claims(items, analysers).collect()}
    assert got == {
        1: (["a", "b"], "ok"), 2: ([], "unsupported_language"), 3: ([], "not_applicable"), 4: ([], "not_applicable"), 5: ([], "not_applicable"), 6: ([], "unsupported_language"),
    }
    assert {r["status"] for r in K.applicable_to_claims(items, analysers.limit(0)).collect()} == {"not_applicable"}
