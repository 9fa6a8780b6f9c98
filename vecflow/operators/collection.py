"""A stored target collection that takes idempotent upserts.

Points lie in hash buckets. An upsert appends its rows in a folder of its own and
then adds one small commit file that lists the folders in force; a crash in
between leaves the earlier commit in force. Nothing stored is read or rewritten by
an upsert. Which row of a repeated id counts is found when points are read, from
ids and order alone, and only in buckets that can hold repeats.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.schema import ID, KEY_MARK, POINT_COLUMNS, POINT_TYPES, RANGE_MARK


class StoredCollection:
    """A collection at ``path``; ``buckets`` counts only when it is created."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        state = self._latest_commit()
        self.buckets = state["buckets"] if state else buckets
        self.marks: dict[int, tuple[str, int]] = {}

    # -- reading ---------------------------------------------------------

    @staticmethod
    def schema() -> T.StructType:
        fields = [T.StructField(n, T.DataType.fromDDL(t)) for n, t in POINT_TYPES.items()]
        return T.StructType(fields)

    def points(self) -> DataFrame:
        """Current points, one row per id."""
        return self._current(self._folders()).select(*POINT_COLUMNS)

    def fetch(self, ids: DataFrame) -> DataFrame:
        """Current points of the listed ids (a column ``id``), in full; an id that is not stored is left out.

        The bucket of a point is known from its id, so only the folders of buckets that a listed id falls into are
        read. The numbers of those buckets, at most ``buckets``, are all that reaches the driver; ``ids`` is evaluated
        once for them and once for the join. A list that is small by Spark's own estimate is broadcast; a long one
        meets the stored rows by bucket and id.
        """
        wanted = ids.select("id").where(F.col("id").isNotNull()).distinct()
        wanted = wanted.withColumn("bucket", self.bucket_of(F.col("id")))
        buckets = {r["bucket"] for r in wanted.select("bucket").distinct().collect()}
        folders = [restricted(folder, buckets & set(folder["buckets"])) for folder in self._folders()]
        stored = self._current([folder for folder in folders if folder["buckets"]])
        return stored.join(wanted, ["bucket", "id"], "left_semi").select(*POINT_COLUMNS)

    def _folders(self) -> list[dict]:
        state = self._latest_commit()
        return state["folders"] if state else []

    def _read(self, folders: list[dict]) -> DataFrame:
        """All rows of the listed folders; superseded buckets are not listed, so not read."""
        order = T.StructType.fromDDL("seq bigint, arrival bigint, commit string, bucket int")
        schema = T.StructType([*self.schema().fields, *order.fields])
        paths = [
            f"{self.path}/commit={folder['name']}" + ("" if folder["whole"] else f"/bucket={bucket}")
            for folder in folders
            for bucket in (folder["buckets"][:1] if folder["whole"] else folder["buckets"])
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def _current(self, folders: list[dict]) -> DataFrame:
        """The row in force of every id.

        Only ids stored more than once are joined back, so where they are few the
        vectors stay in place.
        """
        stored, unsure = self._read(folders), sorted(repeating_buckets(folders))
        if not unsure:
            return stored
        may_repeat = F.col("bucket").isin(unsure)
        order = F.struct("seq", "commit", "arrival")
        newest = (
            stored.where(may_repeat)
            .groupBy("bucket", "id")
            .agg(F.max(order).alias("_newest"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1")
            .drop("_n")
        )
        return (
            stored.join(newest, ["bucket", "id"], "left")
            .where(F.col("_newest").isNull() | (order == F.col("_newest")))
            .drop("_newest")
        )

    # -- writing ---------------------------------------------------------

    def bucket_of(self, point_id: Column) -> Column:
        return F.pmod(F.xxhash64(point_id["num"], point_id["uuid"]), F.lit(self.buckets)).cast(
            "int"
        )

    def upsert(self, batch: DataFrame, seq: str | None = None) -> int:
        """Apply one batch and return its number of distinct points.

        With ``seq`` (a whole number, date or timestamp) the highest one of an id
        stays, whichever batch brought it; of equal ones the later. Without it the
        row read last stays. A collection takes all its batches with ``seq`` or all
        without. The rows cross the network once, for the layout by bucket.
        """
        state = self._latest_commit() or {"sequenced": seq is not None, "folders": []}
        if state["sequenced"] != (seq is not None):
            raise ValueError("a collection takes all batches with seq or all without")
        number_or_uuid = F.coalesce(F.col("id.uuid"), F.col("id.num").cast("string"))
        stop = F.raise_error(F.lit("bad record: id is missing")).cast(ID)
        valid = batch.withColumn("id", F.when(number_or_uuid.isNull(), stop).otherwise(F.col("id")))
        marks = [c for c in (RANGE_MARK, KEY_MARK) if c in batch.columns]
        rows = valid.select(
            *POINT_COLUMNS,
            *marks,
            sequence_number(batch, seq).alias("seq"),
            F.monotonically_increasing_id().alias("arrival"),
            self.bucket_of(F.col("id")).alias("bucket"),
        )
        number = self._next_number()
        folder = {"name": self._write(rows, number), "buckets": [0], "whole": True}
        per_id = self._read([folder]).groupBy("bucket", "id").agg(F.count(F.lit(1)).alias("n"))
        per_bucket = (
            per_id.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("points"), F.max("n").alias("most"))
            .orderBy("bucket")
            .collect()
        )
        folder["buckets"] = [r["bucket"] for r in per_bucket]
        folder["repeats"] = [r["bucket"] for r in per_bucket if r["most"] > 1]
        if per_bucket:
            reached = self._marks_of(folder, rows.schema[KEY_MARK].dataType) if marks else {}
            self._commit(number, [*state["folders"], folder], state["sequenced"])
            self.marks = reached
        return sum(r["points"] for r in per_bucket)

    def _marks_of(self, folder: dict, key_type: T.DataType) -> dict[int, tuple[str, int]]:
        """Last key and rows of each range in a written folder; two narrow columns are read."""
        schema = T.StructType([T.StructField(RANGE_MARK, T.IntegerType()), T.StructField(KEY_MARK, key_type)])
        written = self.spark.read.schema(schema).parquet(f"{self.path}/commit={folder['name']}")
        last = F.max(KEY_MARK).cast("string").alias("last")
        found = written.groupBy(RANGE_MARK).agg(last, F.count(F.lit(1)).alias("points")).collect()
        return {r[RANGE_MARK]: (r["last"], r["points"]) for r in found}

    def compact(self, max_folders: int = 1) -> None:
        """Rewrite buckets with repeated ids or more than ``max_folders`` folders as one each.

        Reading then needs no comparison. Call it between batches; a copy never does.
        """
        state = self._latest_commit()
        if not state:
            return
        folders = state["folders"]
        held = Counter(b for folder in folders for b in folder["buckets"])
        scattered = {b for b, n in held.items() if n > max_folders}
        scattered |= {b for folder in folders for b in folder["repeats"]}
        if not scattered:
            return
        number = self._next_number()
        old = [restricted(folder, scattered) for folder in folders]
        rows = self._current([folder for folder in old if folder["buckets"]]).drop("commit")
        name = self._write(rows, number)
        merged = {"name": name, "buckets": sorted(scattered), "repeats": [], "whole": True}
        kept = [restricted(folder, set(folder["buckets"]) - scattered) for folder in folders]
        kept = [folder for folder in kept if folder["buckets"]]
        self._commit(number, [*kept, merged], state["sequenced"])

    def vacuum(self, keep_commits: int = 10) -> list[str]:
        """Delete folders that none of the last ``keep_commits`` commits lists.

        Readers that started from an older commit lose their files, and so does an
        upsert that is still running, so call it while nothing writes.
        """
        if keep_commits < 1:
            raise ValueError("at least the current commit must be kept")
        kept = {
            f"commit={folder['name']}"
            for number in self._commit_numbers()[-keep_commits:]
            for folder in self._read_commit(number)["folders"]
        }
        commits, fs = self._fs()
        stored = [s.getPath() for s in fs.listStatus(commits.getParent()) if s.isDirectory()]
        stale = [p for p in stored if p.getName() not in kept and not p.getName().startswith("_")]
        for folder in stale:
            fs.delete(folder, True)
        return sorted(p.getName() for p in stale)

    def _write(self, rows: DataFrame, number: int) -> str:
        """Write rows to a folder that no other attempt shares; returns its name."""
        name = f"{number:012d}-{uuid.uuid4().hex}"
        # Rebalance on the bucket: AQE merges small buckets' tasks and splits large ones.
        laid_out = rows.hint("rebalance", "bucket")
        laid_out.write.partitionBy("bucket").mode("error").parquet(f"{self.path}/commit={name}")
        return name

    # -- commits ---------------------------------------------------------

    def _fs(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits")
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit_numbers(self) -> list[int]:
        folder, fs = self._fs()
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _next_number(self) -> int:
        return (self._commit_numbers() or [0])[-1] + 1

    def _latest_commit(self) -> dict | None:
        numbers = self._commit_numbers()
        return self._read_commit(numbers[-1]) if numbers else None

    def _read_commit(self, number: int) -> dict:
        folder, fs = self._fs()
        name = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.json")
        stream = fs.open(name)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def _commit(self, number: int, folders: list[dict], sequenced: bool) -> None:
        """Write aside, then rename to the number: a second writer of it fails."""
        folder, fs = self._fs()
        state = {"buckets": self.buckets, "sequenced": sequenced, "folders": folders}
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        draft = Path(folder, f"{number:012d}-{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(state), "utf-8"))
        out.close()
        if not fs.rename(draft, Path(folder, f"{number:012d}.json")):
            raise RuntimeError(f"another writer already made commit {number} of {self.path}")


def repeating_buckets(folders: list[dict]) -> set[int]:
    """Buckets in which an id may occur twice: in several folders, or repeated within one."""
    held = Counter(b for folder in folders for b in folder["buckets"])
    repeats = {b for folder in folders for b in folder["repeats"]}
    return repeats | {b for b, n in held.items() if n > 1}


def restricted(folder: dict, buckets: set[int]) -> dict:
    """The folder with only these of its buckets."""
    kept = [b for b in folder["buckets"] if b in buckets]
    return {
        "name": folder["name"],
        "buckets": kept,
        "repeats": [b for b in folder["repeats"] if b in buckets],
        "whole": folder["whole"] and kept == folder["buckets"],
    }


def sequence_number(batch: DataFrame, seq: str | None) -> Column:
    """The order of versions as a whole number; null comes before all others."""
    if seq is None:
        return F.lit(None).cast("bigint")
    data_type = batch.schema[seq].dataType
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(seq)
    if isinstance(data_type, T.DateType):
        return F.unix_date(seq).cast("bigint")
    if isinstance(data_type, T.IntegralType):
        return F.col(seq).cast("bigint")
    raise TypeError(f"seq must be a whole number, date or timestamp, not {data_type.simpleString()}")
