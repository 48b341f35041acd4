"""Odd rows and empty tables through every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from freshet.llm import decontamination, language_model, minhash, packing, pii, quality_classifier, quality_rules, token_files, toxicity, url_filter
from freshet.llm.queries import URL_RULES
from freshet.llm.storage import new_path

ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs away from it all"), (2, None), (None, "lost"), (3, "")]
LABELS = [(3, 1, 0), (5, 0, 1), (4, 0, 0), (None, 1, 1), (6, None, None)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("x"))


def rules(spark):
    return spark.createDataFrame(URL_RULES, "host string, path string, verdict string")


def test_quality_classifier(spark, odd, empty, labels):
    model = quality_classifier.train(odd, labels)
    rows = quality_classifier.classify(odd, model).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert quality_classifier.classify(empty, quality_classifier.train(empty, labels.limit(0))).count() == 0
    alone = quality_classifier.train(odd, labels.where("quality = 1"))
    assert {r.score for r in quality_classifier.classify(odd, alone).collect()} == {0.5}


def test_toxicity(spark, odd, empty, labels):
    rows = toxicity.classify(odd, toxicity.train(odd, labels)).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert toxicity.classify(empty, toxicity.train(empty, labels.limit(0))).count() == 0


def test_quality_threshold_ties(spark):
    """Scores that tie at the quantile fall on one side together."""
    rows = [(i, "good words all the way and on" if i % 2 else "#### $$$$ ||||") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality_classifier.train(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"))
    got = {(r.doc_id % 2, r.predicted) for r in quality_classifier.classify(docs, model).collect()}
    assert got == {(0, 0), (1, 1)}


def test_long_repetitive_text_against_an_item_of_its_letters(spark):
    items = spark.createDataFrame([(1, "x" * 300), (2, "ab" * 60)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x" * 200_000), (2, "ab " * 50_000), (3, "x" * 299)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in decontamination.find_contamination(docs, items).collect()}
    assert got == {(1, 1, 0), (3, 1, 1)}


def test_hundreds_of_spans_in_one_text(spark):
    text = " ".join(f"u{i} at h{i} dot org x{i}@y.com" for i in range(500))
    row = pii.digests(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_email == 500 and len(row.spans.split(",")) == 1000


def test_url_filter(spark, odd):
    pages = odd.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), "host", "path", "id")
    rows = url_filter.filter_urls(pages, rules(spark)).collect()
    assert len(rows) == 9 and {(r.host, r.path, r.rule, r.verdict) for r in rows} == {("", "", None, "allow")}
    assert url_filter.filter_urls(pages.limit(0), rules(spark)).count() == 0
    assert url_filter.filter_urls(pages, rules(spark).limit(0)).count() == 9


def test_decontamination(spark, odd, empty, benchmark):
    assert decontamination.find_contamination(odd, benchmark).count() == 0
    hit = odd.limit(1).withColumn("text", F.lit("so THE quick  brown\nfox jumps over the lazy dog and runs away from it all!"))
    assert [tuple(r) for r in decontamination.find_contamination(hit, benchmark).collect()] == [(0, 1, 3, 73, 0)]
    assert decontamination.drop_contaminated(odd, benchmark).count() == 9 and decontamination.drop_contaminated(hit, benchmark).count() == 0
    assert decontamination.find_contamination(empty, benchmark).count() == 0
    assert decontamination.find_contamination(odd, benchmark.limit(0)).count() == 0


def test_pii(spark, odd, empty):
    rows = pii.digests(odd).collect()
    assert len(rows) == 9 and {r.spans for r in rows} == {""} and {r.n_email for r in rows} == {0}
    assert pii.digests(empty).count() == 0
    same = pii.redact(odd, length_col="n_chars")
    assert same.schema == odd.schema and same.count() == 9


def test_packing(spark, odd, empty):
    rows = packing.pack_documents(odd).collect()
    assert sum(r.length for r in rows if r.doc_id == 0) == 1
    assert sum(r.length for r in rows if r.doc_id is None) > 5
    assert packing.pack_documents(empty).count() == 0


def test_quality_rules(spark, odd, empty):
    rows = {(r.doc_id, r.n_words, r.kept) for r in quality_rules.judge(odd).collect()}
    assert {(0, 0, False), (1, 0, False), (2, 0, False), (3, 3, False), (None, 15, True), (5, 60_000, False)} <= rows
    assert quality_rules.judge(empty).count() == 0
    kept = quality_rules.keep(odd)
    assert kept.columns == odd.columns and [r.doc_id for r in kept.collect()] == [None]


def test_minhash(spark, odd, empty):
    rows = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()]
    assert sorted(rows, key=str) == sorted([
        (0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True), (None, 11, None, True), (4, 1, 4, True), (5, 1, 5, True), (6, 1, 6, True),
    ], key=str)
    assert minhash.near_duplicates(empty).count() == 0


def test_token_files(spark, odd, empty):
    path = new_path(spark, "t")
    token_files.write_tokens(odd, path)
    rows = token_files.digest_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 0, 1, 2, 3, 3, 4, 5, 6]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(9)]
    path = new_path(spark, "t")
    token_files.write_tokens(empty, path, encoding="delta")
    assert token_files.digest_tokens(spark, path).count() == 0


def test_language_model(spark, odd, empty):
    rows = language_model.score(odd).collect()
    assert len(rows) == 9 and {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1} and all(r.score < 0 for r in rows)
    assert language_model.score(empty).count() == 0


def test_pipeline_stages(spark, odd, empty, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            out.collect()
        pieces = corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
        ends = [r for r in pieces if r.start + r.length == r.doc_tokens]
        assert len(ends) == docs.count() and sum(r.length for r in pieces) == sum(r.doc_tokens for r in ends)
    near = corpus_pipeline.near_duplicates(spark, odd, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in near) == ["0", "1", "2", "3", "4", "5", "6", "None"]


def test_pipeline_near_duplicates_by_row(spark):
    """Repeated ids with different texts survive, copies without an id collapse."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (1, a), (2, b), (None, c), (None, c), (None, a), (3, None), (3, None), (3, ""), (4, ""), (None, ""), (None, "")]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, a), (1, b), (None, c), (3, None), (3, ""), (4, ""), (None, "")]))
