"""Row shapes shared by every module, and the helper that builds points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Target-side names of the unnamed vector and of the copied original id.
UNNAMED = ""
ID_FIELD = "__id__"
DOCUMENT_FIELD = "document"

#: Columns that a copy adds to its points: the range a point's key lies in, and the key in a form that keeps its order.
RANGE_MARK, KEY_MARK = "_range", "_key"

ID = "struct<num:decimal(20,0),uuid:string>"
SHARD_KEY = "struct<keyword:string,num:decimal(20,0)>"
DENSE = "map<string,array<float>>"
SPARSE = "map<string,struct<indices:array<bigint>,values:array<float>>>"
MULTI = "map<string,array<array<float>>>"
FIELDS = "map<string,variant>"

POINT_TYPES = {
    "id": ID,
    "dense": DENSE,
    "sparse": SPARSE,
    "multi": MULTI,
    "payload": "variant",
    "shard_key": SHARD_KEY,
}
POINT_COLUMNS = list(POINT_TYPES)

COLLECTION = (
    "name string, vectors map<string,struct<size:bigint,distance:string>>, "
    "sparse_names array<string>, payload_schema map<string,string>, sharding_method string"
)
RANGE_PLAN = "source_key string, plan_id string, range_id int, start_key string, end_key string"
PROGRESS = (
    "source_key string, plan_id string, range_id int, last_key string, "
    "processed bigint, updated_at timestamp"
)


def to_points(df: DataFrame, *extra: str, **columns: Column) -> DataFrame:
    """Project ``df`` to point columns; the ones not given are typed nulls.

    ``extra`` names columns of ``df`` to carry along, such as the sequence an
    upsert orders by.
    """
    unknown = set(columns) - set(POINT_TYPES)
    if unknown:
        raise ValueError(f"not point columns: {sorted(unknown)}")
    projected = [
        columns.get(name, F.lit(None)).cast(data_type).alias(name)
        for name, data_type in POINT_TYPES.items()
    ]
    return df.select(*projected, *extra)
