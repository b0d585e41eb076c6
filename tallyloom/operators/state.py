"""What a loader remembers: state by source, journals of runs, watermarks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def save_state(state: DataFrame, news: DataFrame, keys: Sequence[str], always: Sequence[str] = ("status", "last_error")) -> DataFrame:
    """State rows with the news merged in: a new value where there is one, else the old; ``always`` columns take the news as they are [STR-15]."""
    joined = state.withColumn("__old", F.lit(True)).alias("s").join(news.withColumn("__new", F.lit(True)).alias("n"), [F.col(f"s.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")

    def pick(c: str) -> Column:
        if c not in news.columns:
            return F.col(f"s.{c}").alias(c)
        if c in always and c not in keys:
            return F.when(F.col("__new"), F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
        return F.coalesce(F.col(f"n.{c}"), F.col(f"s.{c}")).alias(c)

    return joined.select(*[pick(c) for c in state.columns])


def history_row(spark, **fields) -> DataFrame:
    """One row for a journal of runs, to be appended [STR-15]; its types come from the values, text for those that are missing."""
    return spark.range(1).select(*[(F.lit(v) if v is not None else F.lit(None).cast("string")).alias(k) for k, v in fields.items()])


def last_checkpoints(history: DataFrame, by: str, finished: str = "finished_at", status: str = "status", checkpoint: str = "checkpoint_value", tie: str = "id") -> DataFrame:
    """(by, checkpoint) of the last success that has one; the latest end first, open ends last [STR-20]."""
    at = F.struct(F.col(finished).isNotNull(), F.col(finished), F.col(tie))
    return history.where((F.col(status) == "success") & F.col(checkpoint).isNotNull()).groupBy(by).agg(F.max_by(checkpoint, at).alias(checkpoint))


def set_watermark(history: DataFrame, row: DataFrame, gap: str = "INTERVAL 0 SECONDS", checkpoint: str = "checkpoint_value") -> DataFrame:
    """A journal with a success row that sets the watermark, ``gap`` before the row's own time [STR-20]."""
    return history.unionByName(row.withColumn(checkpoint, (F.col(checkpoint).cast("timestamp") - F.expr(gap)).cast("string")), allowMissingColumns=True)


def journal(loads: DataFrame, targets: DataFrame, syncs: DataFrame, configs: DataFrame, by: str, limit: int | None = None) -> DataFrame:
    """Both journals of runs in one form, newest first by ``by``, up to ``limit`` each [SET-08, JOI-23, SRT-05].

    Loads keep runs without a target; syncs keep those of active configurations alone.
    """
    first = loads.join(targets.select(F.col("id").alias("__t"), "target_table"), F.col("target_id") == F.col("__t"), "left").select(by, "run_id", "started_at", "status", F.lit("load").alias("path"), "target_table", "n_rows", "checkpoint_value")
    active = configs.where("is_active").select(F.col("id").alias("__c"), "target_table", by)
    second = syncs.join(active, F.col("sync_id") == F.col("__c")).select(by, "run_id", "started_at", "status", F.lit("sync").alias("path"), "target_table", "n_rows", F.concat(F.lit("partition "), F.col("part").cast("string")).alias("checkpoint_value"))
    both = first.unionByName(second)
    if limit is None:
        return both
    newest = Window.partitionBy(by).orderBy(F.col("started_at").desc_nulls_last(), "path", F.desc("run_id"))
    return both.withColumn("__k", F.row_number().over(newest)).where(F.col("__k") <= limit).drop("__k")


def isolated(groups: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Runs every group; one's failure stops no other, and all failures are raised together at the end [STR-21]."""
    done, failed = {}, {}
    for name, run in groups.items():
        try:
            done[name] = run()
        except Exception as error:  # noqa: BLE001 - gathered and raised below
            failed[name] = error
    if failed:
        raise ExceptionGroup(f"failed: {', '.join(failed)}", list(failed.values()))
    return done
