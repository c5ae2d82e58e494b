"""The stages in order on the smallest tables; each against its own input."""

import pytest
from pyspark.sql import functions as F

from plumbline.llm import jaccard, toxicity
from plumbline.llm.common import table, written


def test_stages(spark, sf):
    import corpus_pipeline

    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "mixing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), "test-stage")
        if name != "mixing":
            assert out.columns == docs.columns
        seen[name] = (docs, out)
        docs = out
    before, after = seen["toxicity"]
    model = toxicity.fit(before, table(spark, sf, "labels"))
    clean = {r.doc_id for r in toxicity.score(before, model).where("score < 0.5").collect()}
    assert {r.doc_id for r in after.collect()} == clean
    before, after = seen["near_duplicates"]
    parts = jaccard.join_components(before).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.doc_id for r in parts if r.component_id == r.doc_id})
    before, after = seen["repeated_passages"]
    assert before.count() == after.count()
    lengths = {r.doc_id: len(r.text) for r in before.collect()}
    assert all(len(r.text) <= lengths[r.doc_id] and r.n_chars == len(r.text) for r in after.collect())
    before, after = seen["mixing"]
    assert before.count() == after.count() and after.agg({"mix_taken": "sum"}).first()[0] > 0


DOCS = "doc_id long, text string, lang string, source string, n_chars int"
CLASHING = ["row", "holder", "key_hi", "kept", "size", "u", "data", "_hi", "mix_size"]
EDGE = [(1, None, "a"), (2, "", "a"), (3, "one", None), (3, "one", None), (None, "two words", "b"), (None, None, None), (5, "x " * 5000, "a")]


def edge_table(spark, rows):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    return df.select("*", *[F.lit(f"user {c}").alias(c) for c in CLASHING])


@pytest.mark.parametrize("rows", [EDGE, []], ids=["edge", "empty"])
def test_edges_through_all_stages(spark, sf, rows):
    import corpus_pipeline

    docs = edge_table(spark, rows)
    # of the row that is there twice one stays; the long text repeats itself and is emptied
    left = {"toxicity": rows, "near_duplicates": [r for k, r in enumerate(rows) if k != 3]}
    left["repeated_passages"] = left["decontamination"] = left["mixing"] = [(i, "" if i == 5 else t, s) for i, t, s in left["near_duplicates"]]
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), "test-edge")
        assert sorted(map(repr, out.select("doc_id", "text", "source").toLocalIterator())) == sorted(f"Row(doc_id={i!r}, text={t!r}, source={s!r})" for i, t, s in left[name]), name
        for c in CLASHING if name != "mixing" else CLASHING[:-1]:
            assert out.where(F.col(c).isNull() | (F.col(c) != f"user {c}")).isEmpty(), (name, c)
        if name != "mixing":
            assert out.columns == docs.columns
        docs = out
    assert docs.where("mix_size = 0 and mix_taken != 0").isEmpty() and docs.columns.count("mix_size") == 1
