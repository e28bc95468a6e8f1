"""Writers. Every one replaces what is there and writes with all tasks;
``one_file`` moves the whole result through a single task, so it is only for
results known to be small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tallygrid.sources.tables import TEXT_CELLS

#: About 250 MB of text for sales documents.
DOCUMENTS_PER_FILE = 500_000


def _writer(df: DataFrame, one_file: bool):
    return (df.coalesce(1) if one_file else df).write.mode("overwrite")


def _write_text(df: DataFrame, path: str, one_file: bool, header: bool) -> None:
    """Cells as they are: no blank is trimmed, a quote inside quotes is doubled, a backslash
    is a character, an empty text is two quotes and null is nothing."""
    _writer(df, one_file).options(**TEXT_CELLS, header=header, dateFormat="yyyy-MM-dd", ignoreLeadingWhiteSpace=False,
                                  ignoreTrailingWhiteSpace=False, emptyValue='""').csv(path)


def write_positional(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Comma text without a header line."""
    _write_text(df, path, one_file, header=False)


def write_with_header(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Comma text with a header line."""
    _write_text(df, path, one_file, header=True)


def write_lines(df: DataFrame, path: str, one_file: bool = False) -> None:
    """One text column, one line per row."""
    _writer(df, one_file).text(path)


def write_sample(df: DataFrame, path: str, n: int = 5) -> None:
    """The first ``n`` rows, with a header line."""
    write_with_header(df.limit(n), path)


def write_documents(df: DataFrame, path: str, one_file: bool = False) -> None:
    """JSON lines; nested columns stay nested."""
    _writer(df, one_file).json(path)


def add_documents(df: DataFrame, path: str) -> None:
    """JSON lines beside those that are there, compressed. A task reads such a file as a
    whole, so files end after a number of documents."""
    df.write.mode("append").options(compression="gzip", maxRecordsPerFile=DOCUMENTS_PER_FILE).json(path)


def add_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet beside what is there, compressed."""
    df.write.mode("append").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, optionally laid out by columns so that later scans prune.

    A layout first brings rows of one folder together, so that not every task
    writes into every folder; adaptive execution splits folders that are large.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    _writer(df, False).partitionBy(*partition_by).parquet(path)


def write_collection(
    df: DataFrame, source: str, options: Mapping[str, str], path: str | None = None
) -> None:
    """Replace a collection through a connector on the classpath."""
    writer = df.write.format(source).options(**dict(options)).mode("overwrite")
    if path is None:
        writer.save()
    else:
        writer.save(path)
