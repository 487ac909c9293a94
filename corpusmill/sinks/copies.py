"""Copying files into a folder, by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import file_system, materialized, qualified, ship_package

COPY_BYTES = 8 << 20


def copy_files(found: DataFrame, root: str, path: str = "path", target: str = "target") -> DataFrame:
    """Copy each file to its ``target`` below ``root``; returns the rows with ``copied`` bytes, written down once.

    A file is streamed to a staged name and renamed when complete, so a lost executor leaves no partial file under the
    final name and a task that runs again replaces it by the same bytes.
    """
    destination = qualified(found.sparkSession, root)
    ship_package()
    rows = found.select(F.col(path).alias("_path"), F.col(target).alias("_target"))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(destination)
        for batch in batches:
            sizes = []
            for source, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                origin, location = file_system(source)
                final = f"{base}/{name}"
                folder, leaf = final.rsplit("/", 1)
                system.create_dir(folder, recursive=True)
                staged, size = f"{folder}/.{leaf}.{uuid.uuid4().hex}", 0
                with origin.open_input_stream(location, compression=None) as stream, system.open_output_stream(staged, compression=None) as out:
                    while block := stream.read(COPY_BYTES):
                        out.write(block)
                        size += len(block)
                system.move(staged, final)
                sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=[path, target, "copied"]
            )

    # By number: Spark would put rows as small as these together by their own size.
    spread = rows.repartition(max(rows.count(), 1), "_path")
    return materialized(spread.mapInArrow(copy, f"{path} string, {target} string, copied bigint"), "copied")
