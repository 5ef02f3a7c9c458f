"""Fact tables kept bucketed by transaction, so that joining them moves no row.

The join of transactions and check lines, and the sums per transaction behind it, need all rows
of a transaction in one place. Written so once, they are read so by every later plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallystick.sources.tables import Tables
from tallystick.sources.workspace import Workspace

KEY = "transaction_id"


def bucketed(df: DataFrame, workspace: Workspace, label: str, key: str, buckets: int) -> DataFrame:
    """The frame as a table of ``buckets`` buckets, one sorted file each, in the shared folder.

    Spark deals rows to partitions as it deals them to buckets, so each task writes one file.
    The table is known to this session's catalogue only; its files go with the workspace.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    folder = workspace.new_folder(label)
    name = f"tallystick_{folder.rsplit('-', 1)[1]}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", folder).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


class BucketedTables(Tables):
    """Tables whose transactions and check lines lie bucketed by transaction."""

    bucketed = True


def with_bucketed_facts(tables: Tables, workspace: Workspace, buckets: int) -> Tables:
    """The tables with both fact tables bucketed alike; the others stay as they are."""
    facts = {
        name: bucketed(tables[name], workspace, name, KEY, buckets)
        for name in ("transactions", "checks")
    }
    return BucketedTables(**(dict(tables.items()) | facts))
