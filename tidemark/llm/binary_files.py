"""Files of any bytes, written and read by Spark.

Spark's text writer copies a string's bytes as they are and ends each row with a
separator, so it writes binary rows too, through the committer and the file system
that the session knows. A format of this kind ends each of its records with the
separator and says the record's length at its start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_records(df: DataFrame, column: str, folder: str, ending: str, compression: str = "none", per_file: int = 0) -> None:
    """Writes a string or binary column, a record per row, as files of `folder` in the
    frame's order; `per_file` records to a file at most."""
    df.select(F.col(column).cast("string").alias("value")).write.option("lineSep", ending).option("compression", compression).option("maxRecordsPerFile", per_file).text(folder)


def read_files(df_reader, folder: str) -> DataFrame:
    """(part, chunk, content) of the written files; part and chunk give their order. The
    chunk ends the name, before the extensions; a group of the uuid may look like one."""
    files = df_reader.format("binaryFile").load(folder)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.filter(name.startswith("part-")).select(
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("part"), F.regexp_extract(name, r"-c(\d+)(?:\.[^-]*)?$", 1).cast("long").alias("chunk"), "content")
