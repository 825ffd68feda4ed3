"""A store that knows positions only, for the tests of the paged source."""

from collections.abc import Mapping

import pyarrow as pa


class ParquetPager:
    """Rows of parquet files in path order, as a store of pages; holds one row group at a time.

    It stands for a store that the paged source reads; parquet itself is better read
    with ``spark.read.parquet``, which prunes, pushes filters down and lists files once.
    """

    def __init__(self, options: Mapping[str, str]):
        import pyarrow.dataset as ds

        self._columns = [c.strip() for c in options["columns"].split(",")] if options.get("columns") else None
        self._dataset = ds.dataset(options["path"], format="parquet")
        self._groups: list[tuple] | None = None
        self._held: tuple[int, pa.Table] | None = None

    def schema(self) -> pa.Schema:
        schema = self._dataset.schema
        if self._columns:
            schema = pa.schema([schema.field(c) for c in self._columns])
        return schema.remove_metadata()

    def _row_groups(self) -> list[tuple]:
        if self._groups is None:
            self._groups, start = [], 0
            for fragment in sorted(self._dataset.get_fragments(), key=lambda f: f.path):
                for group in fragment.split_by_row_group():
                    rows = group.row_groups[0].num_rows  # count_rows counts the whole file
                    self._groups.append((start, rows, group))
                    start += rows
        return self._groups

    def _table(self, start: int, group) -> pa.Table:
        if self._held is None or self._held[0] != start:
            table = group.to_table(columns=self._columns).replace_schema_metadata(None)
            self._held = (start, table)
        return self._held[1]

    def count(self) -> int:
        return self._dataset.count_rows()

    def fetch(self, offset: int, limit: int) -> list[pa.RecordBatch]:
        batches: list[pa.RecordBatch] = []
        for start, rows, group in self._row_groups():
            low, high = max(offset, start), min(offset + limit, start + rows)
            if low < high:
                batches.extend(self._table(start, group).slice(low - start, high - low).to_batches())
        return batches
