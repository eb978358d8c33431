"""Order of written files whose names hold a uuid group that looks like a chunk."""

import os
import re
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import binary_files, token_files
from tidemark.sources.shared import new_folder

UUID = "1b2d3f4a-c012-4e5f-c0de-c1234567890a"


def renamed(folder: str, target: str) -> list[str]:
    """Copies a folder's files under names with the uuid above."""
    os.makedirs(target)
    names = [n for n in os.listdir(folder) if n.startswith("part-")]
    for n in names:
        shutil.copy(f"{folder}/{n}", f"{target}/" + re.sub(r"^(part-\d+)-[0-9a-f-]{36}", rf"\1-{UUID}", n))
    return sorted(os.listdir(target))


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_chunks_of_a_uuid_like_a_chunk(spark, tmp_path, compression):
    folder = new_folder(spark, "records")
    binary_files.write_records(spark.range(10).coalesce(1).select(F.format_string("r%02d", "id").alias("v")), "v", folder, "\n", compression, per_file=3)
    names = renamed(folder.removeprefix("file:"), str(tmp_path / "named"))
    assert len(names) == 4 and all(UUID in n for n in names)
    got = binary_files.read_files(spark.read, str(tmp_path / "named")).orderBy("part", "chunk").select("part", "chunk").collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 1), (0, 2), (0, 3)]


def test_starts_over_several_files_of_a_part(spark, tmp_path, monkeypatch):
    names, write = [], token_files.write_token_files

    def written(df, folder):
        write(df, f"{folder}-first")
        names.extend(renamed(f"{folder}-first".removeprefix("file:"), folder.removeprefix("file:")))

    monkeypatch.setattr(token_files, "BLOCKS", 1)
    monkeypatch.setattr(token_files, "write_token_files", written)
    monkeypatch.setattr(token_files, "new_folder", lambda spark, name: str(tmp_path / name))
    # several blocks of ids, each in a file of its own
    spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit("tide "), 20000 + F.col("id").cast("int")).alias("text")).coalesce(1).write.parquet(f"{tmp_path}/in/documents.parquet")
    rows = token_files.op1_token_files(spark, f"{tmp_path}/in").orderBy("doc_id").collect()
    assert len(rows) == 40 and len(names) > len({n[:10] for n in names})
    assert [r.start for r in rows] == np.concatenate(([0], np.cumsum([r.n_tokens for r in rows])[:-1])).tolist()
