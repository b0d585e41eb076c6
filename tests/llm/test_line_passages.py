"""Repeated passages of one or two lines."""

import corpus_pipeline
from tallyloom.llm import line_dedup

LONG, HALF, OTHER = (" ".join(f"{name}{k}" for k in range(n)) for name, n in (("long", 51), ("half", 30), ("other", 30)))


def test_passages(spark):
    texts = [
        f"a\n{LONG}\nb", f"c\n{LONG}\nd\ne", LONG, f"f\n{HALF}\n{OTHER}\ng", f"{HALF}\n{OTHER}", f"h\n{HALF}\ni", f"{OTHER}\n{HALF}", "short", "short", "two\nlines", "two\nlines", "two\nlines\nand one", "", " ", " ", None,
    ]
    want = [
        f"a\n{LONG}\nb", "c\nd\ne", "", f"f\n{HALF}\n{OTHER}\ng", "", f"h\n{HALF}\ni", f"{OTHER}\n{HALF}", "short", "", "two\nlines", "", "two\nlines\nand one", "", " ", " ", None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for out in (line_dedup.dedup_lines(docs, passages=50), corpus_pipeline.dedup_lines(spark, docs, "")):
        assert [r.text for r in out.orderBy("doc_id").collect()] == want
