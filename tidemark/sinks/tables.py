"""JDBC writer for flat change rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.config import JdbcTarget


def write_table(
    rows: DataFrame,
    target: JdbcTarget,
    table: str,
    mode: str = "append",
    connections: int | None = None,
) -> None:
    """Append (or overwrite) a table.

    ``connections`` bounds how many tasks write at once. A retried task may
    append rows again; the version column lets the reader keep one of them.
    """
    writer = (
        rows.write.format("jdbc")
        .options(**target.options())
        .option("dbtable", table)
        .option("batchsize", target.batch_size)
    )
    if connections:
        writer = writer.option("numPartitions", connections)
    writer.mode(mode).save()
