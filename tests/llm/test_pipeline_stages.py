"""The registered text queries and the pipeline's stages on the driver's smallest tables."""

import numpy as np
import pytest

import corpus_pipeline
from punctuality.llm import decontaminate, language_id, pii, queries, simhash

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", ["op1_language_id", "op9_quality"])
def test_predictions_hold_out(spark, docs, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert found.count() == docs.count()
    held = found.filter("held_out")
    if name == "op1_language_id":
        right = held.join(docs.select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL")
        assert right.filter("lang = lang_pred").count() > 0.95 * right.count()


def test_stages(spark, docs, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing",
    ]
    kept = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
        path = str(tmp_path / str(i))
        stage(spark, kept, SF_DIR).write.parquet(path)
        kept = spark.read.parquet(path)
        if i < 4:
            assert kept.columns == docs.columns and kept.schema == docs.schema
            after = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
            gone = set(before) - set(after)
        if i == 0:
            assert gone == {k for k, t in before.items() if not any(c.isalpha() for c in t or "")}
        if i == 1:
            rows = simhash.near_duplicates(docs.filter(docs.doc_id.isin(list(before))), "doc_id", "text").collect()
            assert gone == {r.doc_id for r in rows if r.doc_id != r.component_id}
        if i == 2:
            items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            holds = {k for k, t in before.items() if any(b in (t or "") for b in items)}
            assert holds <= gone and len(gone) <= len(holds) + 2
        if i == 3:
            assert not gone and not any(pii.base_spans(t or "") for t in after.values())
            assert any(before[k] != after[k] for k in after)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(before)
    assert kept.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0


def test_odd_documents_go_through(spark, tmp_path):
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, "some plain words here", "en", None, 21),
        (3, "some plain words here", "en", None, 21), (None, "a row without an id", None, "s", None),
        (4, "x" * 50_000 + " and words " * 5000, "en", "s", 1), (5, "12 !!", "en", "s", 5),
    ]
    kept = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, kept, SF_DIR).write.parquet(path)
        kept = spark.read.parquet(path)
    assert {r.doc_id for r in kept.collect()} == {3, 4, None}


def test_clashing_columns_stay(spark, docs, tmp_path):
    """Columns that bear the names of what the stages compute come out as they went in."""
    names = [
        "lang_pred", "score", "n_languages", "_masked", "fp", "key", "fingerprint", "component_id", "_dropped", "cosine", "spans", "base_sha256",
        "n_email", "keep", "node", "mark",
    ]
    kept = docs.selectExpr("*", *[f"CONCAT('{n}', doc_id) AS {n}" for n in names])
    columns = kept.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        path = str(tmp_path / str(i))
        stage(spark, kept, SF_DIR).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == columns
        wrong = " OR ".join(f"{n} <> CONCAT('{n}', doc_id)" for n in names)
        assert kept.filter(wrong).count() == 0
    stage = corpus_pipeline.STAGES[4][1](spark, kept, SF_DIR)
    assert stage.select("doc_id").distinct().count() == kept.count()


def test_junk_in_no_language_goes(spark, docs):
    """Noise of letters is rejected, short unknown words and all clean documents stay."""
    rng = np.random.default_rng(17)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 400)) for _ in range(20)]
    foreign = [" ".join("".join(rng.choice(list("бвгджзклмнп"), 6)) for _ in range(60)) for _ in range(5)]
    junk = spark.createDataFrame(
        [(10_000 + i, t, None, "junk", len(t)) for i, t in enumerate([*noise, *foreign, "0123 456", "xqzzkv"])], docs.schema
    )
    kept = corpus_pipeline.STAGES[0][1](spark, docs.unionByName(junk), SF_DIR)
    assert {r.doc_id for r in kept.filter("doc_id >= 10000").collect()} == {10_026}
    assert kept.filter("doc_id < 10000").count() == docs.filter("text RLIKE '[A-Za-z]'").count()


def test_stages_of_nothing(spark, docs, tmp_path):
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs.filter("false"), SF_DIR).write.parquet(path)
        assert spark.read.parquet(path).count() == 0


def test_models_do_not_read_what_they_must_not(spark, docs):
    model = language_id.fit(docs, "text", "lang", "doc_id")
    other = docs.selectExpr("doc_id + 1000 AS doc_id", "text", "'zz' AS lang", "'q' AS source", "n_chars")
    a, b = (language_id.predict(d, model, "text").select("text", "lang_pred", "score") for d in (docs, other))
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_no_leak_is_reported_twice(spark):
    found = queries.op3_decontamination(spark, SF_DIR)
    assert found.count() == found.select("doc_id", "item_id").distinct().count()
    assert decontaminate.LEAST < 10
