"""The pipeline's stages take effect, and each works on what its predecessor kept."""

import corpus_pipeline
import __spark_entry__
from tallyloom.llm.shared import settled, table

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline"} | {f"op{n}_" for n in range(1, 11)} <= names | {x.split("_")[0] + "_" for x in names}
    assert set(__spark_entry__.oracle_sql()) <= names


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mix_sources", "best_fit_packing"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = settled(stage(spark, docs, SF), f"test-{name}")
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            counts.append(out.count())
            docs = out
    before, toxic, lines, near, mixed = counts
    assert toxic < before and lines == toxic and near < lines and mixed > 0
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
