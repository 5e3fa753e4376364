"""No stage of the corpus pipeline loses a document because of its doc_id or its other columns."""

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_operators import PASSAGE, sentence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy string, host int, gone_copy string, rows int"


def table(spark, rows):
    made = [(i, t, "en", "s", len(t or ""), f"mine {n}", n, "g", 1) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, SCHEMA)


def stage(spark, name, docs):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text, r.copy) for r in out.collect()), key=str)


def test_near_duplicates_with_shared_and_missing_ids(spark):
    one, two, three = sentence(21, 40), sentence(22, 40), sentence(23, 40)
    rows = [(3, one), (8, one), (8, two), (None, one), (None, three), (None, three), (5, two), (5, two), (9, None), (9, "")]
    got = stage(spark, "n-gram Jaccard join", table(spark, rows))
    kept = [(i, t) for i, t, _ in got]
    assert sorted(kept, key=str) == sorted([(3, one), (5, two), (None, three), kept[[i for i, _ in kept].index(9)]], key=str)
    assert all(c.startswith("mine ") for _, _, c in got)


def test_clean_rows_stay_beside_contaminated_ones_of_the_same_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clean = sentence(31, 60)
    rows = [(4, clean), (4, f"{clean} {item} {clean}"), (None, clean + " more"), (None, f"{item} {PASSAGE}")]
    got = stage(spark, "benchmark decontamination", table(spark, rows))
    assert [(i, t) for i, t, _ in got] == sorted([(4, clean), (None, clean + " more")], key=str)


def test_quality_is_judged_row_by_row(spark):
    good = spark.read.parquet(f"{SF}/documents.parquet").join(
        spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").select("doc_id"), "doc_id", "left_semi"
    )
    texts = [r.text for r in good.orderBy("doc_id").limit(3).collect()]
    rows = [(1, texts[0]), (1, "# # # $$$ %%% ||| " * 30), (None, texts[1]), (None, None), (2, texts[2]), (2, texts[2])]
    got = stage(spark, "quality classifier", table(spark, rows))
    assert {t for _, t, _ in got} >= set(texts) and all(t for _, t, _ in got)
    assert sum(t == texts[2] for _, t, _ in got) == 2


def test_empty_documents_through_every_stage(spark):
    docs = table(spark, [(1, "x")]).limit(0)
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
        assert docs.count() == 0, name
