"""Flat files of float32 vectors laid end to end, read in parallel by position."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vecflow.functions import ids, vectors
from vecflow.schema import to_points

FORMAT = "vecflow_flat_vectors"
_READ_BYTES = 8 << 20


@dataclass
class FlatSlice(InputPartition):
    """Some consecutive vectors of one file."""

    path: str
    first_record: int
    records: int
    first_position: int


class FlatVectorReader(DataSourceReader):
    def __init__(self, path: str, dim: int, split_bytes: int):
        self.path, self.dim, self.split_bytes = path, dim, split_bytes

    def partitions(self):
        """Split by file size alone; positions run on across files in name order."""
        width = 4 * self.dim
        per_slice = max(1, self.split_bytes // width)
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        files = [info]
        if info.type == pafs.FileType.Directory:
            listed = fs.get_file_info(pafs.FileSelector(root))
            files = sorted(
                (f for f in listed if f.is_file and not f.base_name.startswith(("_", "."))),
                key=lambda f: f.path,
            )
        slices, position = [], 0
        for file in files:
            if file.size is None or file.size % width:
                raise ValueError(f"{file.path} is not a whole number of {self.dim}-float vectors")
            total = file.size // width
            for first in range(0, total, per_slice):
                count = min(per_slice, total - first)
                slices.append(FlatSlice(file.path, first, count, position + first))
            position += total
        return slices or [FlatSlice("", 0, 0, 0)]

    def read(self, part: FlatSlice):
        width = 4 * self.dim
        step = max(1, _READ_BYTES // width)
        if part.records == 0:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        with fs.open_input_file(part.path) as source:
            source.seek(part.first_record * width)
            for done in range(0, part.records, step):
                count = min(step, part.records - done)
                values = np.frombuffer(source.read(count * width), dtype="<f4")
                first = part.first_position + done
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(first, first + count, dtype=np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(count + 1, dtype=np.int32) * self.dim),
                            pa.array(values, pa.float32()),
                        ),
                    ],
                    names=["position", "vector"],
                )


class FlatVectorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "position bigint, vector array<float>"

    def reader(self, schema) -> FlatVectorReader:
        path = self.options["path"]
        return FlatVectorReader(
            path if "://" in path else f"file://{path}",
            int(self.options["dim"]),
            int(self.options.get("splitbytes", 128 << 20)),
        )


def scan_flat_vectors(
    spark: SparkSession, path: str, dim: int, split_bytes: int = 128 << 20
) -> DataFrame:
    """Rows ``(position, vector)`` of a file, or of a folder's files in name order."""
    if dim < 1:
        raise ValueError("dim must be positive")
    spark.dataSource.register(FlatVectorSource)
    reader = spark.read.format(FORMAT).option("dim", dim).option("splitBytes", split_bytes)
    return reader.load(path)


def from_flat_vectors(
    spark: SparkSession, path: str, dim: int, id_map: DataFrame | None = None
) -> DataFrame:
    """Points with one unnamed vector and no payload.

    The id is the vector's position, or what ``id_map (position, id)`` holds for it.
    """
    rows = scan_flat_vectors(spark, path, dim)
    number = F.col("position")
    if id_map is not None:
        rows = rows.join(id_map.select("position", F.col("id").alias("_mapped")), "position")
        number = F.col("_mapped")
    return to_points(
        rows, id=ids.numeric_id(number), dense=vectors.unnamed_vector(F.col("vector"))
    )
