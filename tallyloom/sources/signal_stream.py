"""Change signals of several tables as one stream: (uid, updated_at, source), with an offset for each table.

Register with ``spark.dataSource.register(SignalSource)`` and read the format ``change_signals``.  Options:
``tables``, a JSON list of objects with ``path`` (Parquet files), ``key``, ``at`` and, if wanted, ``where`` (column
and value) and ``name``; ``overlap_s`` and ``skew_s``.

A batch of a table is what its times say: after the offset of the last batch, less the overlap, and up
to its newest time, but not later than now less the skew of the clocks.  Signals of the overlap come
again, so that none is lost that was written late; who takes the latest of each key does not notice.  With an overlap of 0
each signal comes once.  Offsets lie in the stream's checkpoint: a restart goes on where the last batch ended.
Files whose times lie outside a batch are not opened, and a file is a task.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

OVERLAP_S, SKEW_S = 300, 5
#: Before all times.
START = -(2**62)


def micros(value) -> int:
    """A time of a file's statistics or of an Arrow scalar; times without a zone count as UTC."""
    import datetime

    import pandas as pd

    stamp = pd.Timestamp(value) if not isinstance(value, datetime.datetime) else pd.Timestamp(value)
    return (stamp.tz_convert("UTC").tz_localize(None) if stamp.tzinfo else stamp).value // 1000


class Part(InputPartition):
    def __init__(self, table: int, path: str, after: int, until: int):
        self.table, self.path, self.after, self.until = table, path, after, until


class SignalSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "change_signals"

    def schema(self) -> str:
        return "uid string, updated_at timestamp, source string"

    def streamReader(self, schema) -> SignalReader:
        return SignalReader(self.options)


class SignalReader(DataSourceStreamReader):
    def __init__(self, options):
        self.tables = json.loads(options["tables"])
        self.overlap, self.skew = (int(float(options.get(o, d)) * 1e6) for o, d in (("overlap_s", OVERLAP_S), ("skew_s", SKEW_S)))

    def _spans(self, table: dict) -> Iterator[tuple[str, int, int]]:
        """(file, least time, largest time), from the files' footers; where those lack them (as for 96-bit times), from the column."""
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        import pyarrow.parquet as pq

        for fragment in ds.dataset(table["path"], format="parquet").get_fragments():
            file, times = pq.ParquetFile(fragment.path), []
            for k in range(file.metadata.num_row_groups):
                group = file.metadata.row_group(k)
                column = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == table["at"])
                if column.physical_type != "INT96" and column.statistics is not None and column.statistics.has_min_max:
                    times += [micros(column.statistics.min), micros(column.statistics.max)]
                else:
                    ends = pc.min_max(file.read_row_group(k, columns=[table["at"]]).column(0).cast(pa.timestamp("us"), safe=False).cast(pa.int64()))
                    times += [x for x in (ends["min"].as_py(), ends["max"].as_py()) if x is not None]
            if times:
                yield fragment.path, min(times), max(times)

    def initialOffset(self) -> dict:
        return {str(k): START for k in range(len(self.tables))}

    def latestOffset(self) -> dict:
        end = int(time.time() * 1e6) - self.skew
        newest = [max((top for _, _, top in self._spans(t)), default=START) for t in self.tables]
        return {str(k): min(top, end) for k, top in enumerate(newest)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        out = []
        for k, table in enumerate(self.tables):
            after, until = start.get(str(k), START), end[str(k)]
            if until <= after:
                continue
            after = after if after == START else after - self.overlap
            out += [Part(k, path, after, until) for path, low, top in self._spans(table) if low <= until and top > after]
        return out

    def read(self, partition: Part) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        table = self.tables[partition.table]
        where = table.get("where")
        columns = [table["key"], table["at"], *([where[0]] if where else [])]
        for batch in pq.ParquetFile(partition.path).iter_batches(columns=list(dict.fromkeys(columns))):
            at = batch.column(table["at"]).cast(pa.timestamp("us"), safe=False)
            at = (at.cast(pa.timestamp("us", "UTC")) if at.type.tz is None else at).cast(pa.int64())
            fine = pc.and_(pc.and_(pc.greater(at, partition.after), pc.less_equal(at, partition.until)), pc.is_valid(batch.column(table["key"])))
            if where:
                fine = pc.and_(fine, pc.equal(batch.column(where[0]), where[1]))
            fine = pc.fill_null(fine, False)
            uid = pc.ascii_lower(batch.column(table["key"]).cast(pa.string())).filter(fine)
            if len(uid):
                stamps = at.filter(fine).cast(pa.timestamp("us", "UTC"))
                name = pa.array([table.get("name", str(partition.table))] * len(uid))
                yield pa.RecordBatch.from_arrays([uid, stamps, name], ["uid", "updated_at", "source"])

    def commit(self, end: dict) -> None:
        pass
