"""The corpus pipeline: documents from raw to packed sequences, in stages that each call one operator.

Every stage takes (spark, docs, folder of the tables), works on all rows that its predecessor kept,
and but for the last returns the columns of ``documents``.

Columns other than ``doc_id``, ``text`` and ``source`` are carried along, whatever their names; nulls
may stand in any column, texts may be empty or very long, rows may repeat, and an empty table gives
an empty table.  What a stage makes of such rows is said at each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import line_dedup, near_dedup, packing, source_mix, toxicity
from tallyloom.llm.queries import tokenizer, toxicity_model
from tallyloom.llm.shared import settled, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels`` and the raw documents, calls toxic go.

    A null text is judged as an empty one; repeated rows and rows without an id are judged by their text.
    """
    return toxicity.reject_toxic(docs, toxicity_model(spark, sf_dir))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows, of passages of over 50 words and of whole short texts go; every document stays.

    Null texts stay null, and a text that loses all lines becomes empty; repeated rows share their
    outcome, and rows without an id come first in the order that says which occurrence is the earliest.
    """
    return line_dedup.dedup_lines(docs, passages=50)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, and one of those that have no word (left): the one of the smallest id.

    Of repeated rows one stays; rows without an id stay only where no row of their group has one.
    """
    return near_dedup.dedup_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to twice.

    A text without words is taken no time; a null source is a source of its own; rows that are equal
    in all columns are taken as often as all of them together.
    """
    return source_mix.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row's tokens and its place in a sequence of at most 4096 tokens.

    A null or empty text is a piece of the end id alone; repeated rows and rows that share an id are
    pieces of their own.
    """
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

#: No SQL: the classifier, the hashing and the rounding of some stages have none; ``tests/llm/test_pipeline_rows.py`` compares each stage, and ``run``, with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's output is written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
