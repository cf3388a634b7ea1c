"""Overwriting table writes through any Spark data source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSink:
    """Where tables go: files below ``location``, or a warehouse connector.

    File formats take ``location/name`` as their path. For a connector that
    names its table by an option (``table``, ``dbtable``), set ``name_option``;
    the value is then ``location.name``.
    """

    location: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    name_option: str | None = None

    def target(self, name: str) -> str:
        separator = "." if self.name_option else "/"
        return f"{self.location}{separator}{name}"

    def overwrite(
        self,
        df: DataFrame,
        name: str,
        partition_by: Iterable[str] = (),
        sort_by: Iterable[str] = (),
    ) -> str:
        """Replace one table. ``sort_by`` (``-`` for descending) is for small results only."""
        target = self.target(name)
        keys = [F.desc(key[1:]) if key.startswith("-") else F.asc(key) for key in sort_by]
        ordered = df.orderBy(*keys) if keys else df
        writer = ordered.write.format(self.format).mode("overwrite").options(**self.options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.name_option:
            writer.option(self.name_option, target).save()
        else:
            writer.save(target)
        return target


def write_tables(
    tables: Mapping[str, DataFrame], sink: TableSink, names: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Overwrite every table; a name without an entry in ``names`` is capitalised."""
    names = names or {}
    return {
        name: sink.overwrite(df, names.get(name, name.capitalize())) for name, df in tables.items()
    }
