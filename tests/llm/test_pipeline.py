"""The registered queries and the pipeline as a whole."""

import os
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pyspark.sql import functions as F

from corpora import none, odd, odd_rows, prose  # noqa: F401, I001

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "substring_dedup", "best_fit_packing"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with planted toxic documents, copies and a shared passage."""
    rng = random.Random(6)
    passage = prose(rng, 70).replace("\n", " ")
    rows, labels = [], []
    for i in range(240):
        text = prose(rng, rng.randint(60, 120))
        if i % 8 == 0:
            text += " nasty vilely"
        if i % 20 == 3:
            text += "\n" + prose(rng, 12).replace("\n", " ") + " " + passage
        rows.append((i, text, "en", "src0", len(text)))
        if i % 3:
            labels.append((i, 1, int(i % 8 == 0)))
    for i in (1, 2, 5):
        rows.append((1000 + i, rows[i][1], "en", "src1", 0))
    rows += [(2000, None, "en", None, None), (2001, "", None, "src1", 0)]
    top = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return top


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.toPandas()
        if name != "best_fit_packing":
            assert docs.columns == columns
    ids = {n: set(f["doc_id"]) for n, f in seen.items()}
    assert not any(i % 8 == 0 for i in ids["toxicity"] if i < 240)
    assert ids["toxicity"] >= {i for i in range(240) if i % 8} | {2000, 2001}
    assert ids["toxicity"] - ids["ngram_jaccard"] == {1001, 1002, 1005}
    assert ids["substring_dedup"] == ids["ngram_jaccard"] == ids["best_fit_packing"]
    before, after = (seen[n].set_index("doc_id")["text"] for n in ("ngram_jaccard", "substring_dedup"))
    changed = {i for i in before.index if before[i] != after[i] and before[i] is not None}
    assert changed == {i for i in range(240) if i % 20 == 3} - {3}


def test_stages_of_odd_rows(spark, odd, folder):
    """Nulls, repeats, very long texts and clashing names pass the filtering stages; columns stay."""
    docs = odd.withColumn("gone", F.lit(1)).withColumn("predicted", F.lit(2))
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, folder)
        assert out.columns == docs.columns
        assert function(spark, docs.where("false"), folder).count() == 0
        assert out.where("doc_id is null").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).where("doc_id is null").count() == 1


@needs_data
@pytest.mark.parametrize("name", ["op4_warc", "op7_paragraphs", "pipeline"])
def test_queries_run(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
