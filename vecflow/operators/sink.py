"""Batched, retried upserts into an outside client."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from decimal import Decimal
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from vecflow.operators.upsert import keep_last
from vecflow.schema import KEY_MARK, POINT_COLUMNS, RANGE_MARK

# Which failures are worth another try, how often, and the first pause.
RETRYABLE = (
    "Please retry",
    "too_many_internal_resets",
    "RST_STREAM",
    "connection error",
    "ResourceExhausted",
)
MAX_ATTEMPTS = 5
BASE_DELAY_SECONDS = 0.2
DEFAULT_BATCH_SIZE = 50
#: Shards whose counts travel with a task's commit; a task that met more keeps them in a file beside the log.
INLINE_SHARDS = 100


def send_with_retry(send: Callable[[], Any], sleep: Callable[[float], None] = time.sleep) -> int:
    """Run ``send`` until it works; returns the retries used. No pause after the last try."""
    for attempt in range(MAX_ATTEMPTS):
        try:
            send()
            return attempt
        except Exception as error:
            retryable = any(mark in str(error) for mark in RETRYABLE)
            if not retryable or attempt == MAX_ATTEMPTS - 1:
                raise
        sleep(BASE_DELAY_SECONDS * 2**attempt)
    raise AssertionError("unreachable")


def whole_numbers(column: pa.Array) -> list[int | None]:
    """Whole decimals as Python numbers, by way of 64 bits where they fit."""
    try:
        return pc.cast(column, pa.int64()).to_pylist()
    except pa.ArrowInvalid:
        return [None if n is None else int(n) for n in column.to_pylist()]


def plain_values(pairs: pa.StructArray, text: str) -> list[int | str | None]:
    """Ids or shard keys as the client gets them: text, a whole number, or nothing."""
    fields = dict(zip((f.name for f in pairs.type), pairs.flatten()))
    texts, numbers = fields[text], fields["num"]
    if numbers.null_count == len(numbers):
        return texts.to_pylist()
    if texts.null_count == len(texts):
        return whole_numbers(numbers)
    return [n if t is None else t for t, n in zip(texts.to_pylist(), whole_numbers(numbers))]


def plain_rows(batch: pa.RecordBatch) -> list[dict]:
    """The rows of a batch as the client gets them, without the marks of a copy."""
    columns = {}
    for name, column in zip(batch.schema.names, batch.columns):
        if name in (RANGE_MARK, KEY_MARK):
            continue
        if name in ("id", "shard_key") and pa.types.is_struct(column.type):
            columns[name] = plain_values(column, "uuid" if name == "id" else "keyword")
        elif pa.types.is_map(column.type) and len(column) and column.offsets[0] == column.offsets[-1]:
            columns[name] = [[] if there else None for there in column.is_valid().to_pylist()]  # maps without entries
        else:
            columns[name] = column.to_pylist()
    if "shard_key" not in columns:
        columns["shard_key"] = [None] * batch.num_rows
    return [dict(zip(columns, values)) for values in zip(*columns.values())]


@dataclass
class Sender:
    """Sends the points of one task in batches and counts what each shard got."""

    client: Any
    batch_size: int
    delay_seconds: float = 0.0
    by_shard: bool = False
    shards: dict[Any, list[int]] = field(default_factory=dict)  # points, batches, retries
    pending: list[dict] = field(default_factory=list)
    known: set = field(default_factory=set)

    def send(self, rows: Iterable[dict]) -> None:
        for row in rows:
            if self.by_shard and self.pending and self.pending[0]["shard_key"] != row["shard_key"]:
                self.flush()
            self.pending.append(row)
            if len(self.pending) == self.batch_size:
                self.flush()

    def flush(self) -> None:
        if not self.pending:
            return
        rows, self.pending, retries = self.pending, [], 0
        key = rows[0]["shard_key"] if self.by_shard else None
        if key is not None and key not in self.known:
            retries += send_with_retry(lambda: self.client.create_shard_key(key))
            self.known.add(key)
        retries += send_with_retry(lambda: self.client.upsert(rows))
        counts = self.shards.setdefault(key, [0, 0, 0])
        for i, n in enumerate((len(rows), 1, retries)):
            counts[i] += n
        if self.delay_seconds:
            time.sleep(self.delay_seconds)


SENT = "keyword string, number decimal(20,0), points bigint, batches bigint, retries bigint"


def check_batch_size(batch_size: int) -> None:
    if batch_size < 1:
        raise ValueError(f"batches of {batch_size} points: the size must be greater than 0")


def wire_points(points: DataFrame) -> DataFrame:
    """Points as they travel to a client: the payload as JSON text."""
    return points.withColumn("payload", F.to_json("payload"))


def send_batches(
    points: DataFrame,
    client_factory: Callable[[], Any],
    batch_size: int = DEFAULT_BATCH_SIZE,
    delay_seconds: float = 0.0,
    by_shard: bool = False,
) -> DataFrame:
    """Send every point through ``client.upsert(list_of_dicts)``; one row per task and shard.

    The returned frame sends as it is evaluated; evaluate it once. A numeric id or
    shard key arrives as a whole number, a UUID or keyword as text. A task that is
    run again repeats its upserts, which changes nothing. An upsert replaces, so
    ids must be unique in ``points`` (see ``keep_last``).

    With ``by_shard`` a batch holds points of one shard, and a task first calls
    ``client.create_shard_key(key)`` for each of its keys, which must accept one
    that exists. Rows are ordered by shard within their task; none is moved.
    """
    check_batch_size(batch_size)

    def send_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(client_factory(), batch_size, delay_seconds, by_shard)
        for batch in batches:
            sender.send(plain_rows(batch))
        sender.flush()
        for key, counts in sender.shards.items():
            number = None if key is None or isinstance(key, str) else Decimal(key)
            columns = {
                "keyword": pa.array([key if isinstance(key, str) else None], pa.string()),
                "number": pa.array([number], pa.decimal128(20, 0)),
                **{name: [n] for name, n in zip(("points", "batches", "retries"), counts)},
            }
            yield pa.RecordBatch.from_pydict(columns)

    wire = wire_points(points)
    if by_shard:
        wire = wire.sortWithinPartitions("shard_key")
    return wire.mapInArrow(send_partition, SENT)


def write_batches(
    points: DataFrame,
    client_factory: Callable[[], Any],
    batch_size: int = DEFAULT_BATCH_SIZE,
    delay_seconds: float = 0.0,
) -> DataFrame:
    """``send_batches`` without regard to shards, and its totals in one row; evaluate it once."""
    return send_batches(points, client_factory, batch_size, delay_seconds).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("points", "batches", "retries")]
    )


# -- a client as the target of a copy --------------------------------------------

LOGGED = (
    "ranges array<struct<range_id:int,points:bigint,last_key:string>>, "
    f"shards array<struct<{SENT.replace('number decimal(20,0)', 'number string').replace(' ', ':').replace(',:', ',')}>>, "
    "file string"
)


@dataclass
class SentMessage(WriterCommitMessage):
    """What one task has sent: points and last key of each of its ranges, and counts of each shard, or the file of them."""

    ranges: dict[int, tuple[int, str]]
    shards: dict[Any, list[int]]
    points: int = 0
    file: str | None = None
    place: int = 0
    keys: dict[int, Any] = field(default_factory=dict)  # the last keys as they are ordered


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a folder that Spark reaches too."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    for spark_name, name in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(spark_name):
            path = name + path[len(spark_name) :]
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


class ClientWriter(DataSourceArrowWriter):
    """Spark's writer protocol over a client: tasks send, and what they sent travels with their commit.

    Only the attempt that Spark accepts has a message, so a task that failed before counts once. A job that fails
    still hands over the messages of the tasks that ended, so what these ranges reached is kept.
    """

    def __init__(self, client_factory, batch_size: int, delay_seconds: float, log_path: str, job: str, parts: int = 1):
        self.client_factory, self.batch_size, self.delay_seconds = client_factory, batch_size, delay_seconds
        self.log_path, self.job, self.parts = log_path, job, parts

    def write(self, iterator: Iterator[pa.RecordBatch]) -> SentMessage:
        sender, reached = Sender(self.client_factory(), self.batch_size, self.delay_seconds, by_shard=True), {}
        for batch in iterator:
            if RANGE_MARK in batch.schema.names:
                key, text = batch.column(KEY_MARK).flatten()  # key and its text
                last: dict[int, tuple[Any, int]] = {}
                range_ids = batch.column(RANGE_MARK).to_pylist()
                for i, (range_id, value) in enumerate(zip(range_ids, key.to_pylist())):
                    if range_id not in last or later(value, last[range_id][0]):
                        last[range_id] = value, i
                for range_id, count in Counter(range_ids).items():
                    value, i = last[range_id]
                    points, before, before_text = reached.get(range_id, (0, None, None))
                    if points and not later(value, before):
                        reached[range_id] = points + count, before, before_text
                    else:
                        reached[range_id] = points + count, value, text[i].as_py()
            sender.send(plain_rows(batch))
        sender.flush()
        context = TaskContext.get()
        message = SentMessage({r: (n, text) for r, (n, _, text) in reached.items()}, sender.shards)
        message.points = sum(counts[0] for counts in sender.shards.values())
        message.place = context.partitionId() if context else 0
        message.keys = {r: key for r, (_, key, _) in reached.items()}
        return self._kept_apart(message) if len(sender.shards) > INLINE_SHARDS else message

    def _kept_apart(self, message: SentMessage) -> SentMessage:
        """The message with its shards in a file, which counts only if the log names it."""
        fs, folder = file_system(self.log_path)
        fs.create_dir(f"{folder}/{SHARD_FILES}", recursive=True)
        name = f"{SHARD_FILES}/{self.job}-{message.place}-{uuid.uuid4().hex}.json"
        with fs.open_output_stream(f"{folder}/{name}") as out:
            out.write("\n".join(map(json.dumps, logged_shards(message.shards))).encode())
        return replace(message, shards={}, file=name)

    def commit(self, messages: list[SentMessage | None]) -> None:
        self._log(messages)

    def abort(self, messages: list[SentMessage | None]) -> None:
        self._log(messages)

    def _log(self, messages: list[SentMessage | None]) -> None:
        """One line per task that ended, in one file per job, put in place by a rename."""
        ended = [m for m in messages if isinstance(m, SentMessage)]
        places = {m.place for m in ended}
        # Of a range that several tasks share, all must have ended; otherwise all of it is sent again.
        whole = [m for m in ended if self.parts == 1 or all(m.place // self.parts * self.parts + i in places for i in range(self.parts))]
        lines = [json.dumps(logged(m)) for m in together(whole)]
        fs, folder = file_system(self.log_path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/.{self.job}") as out:
            out.write("\n".join(lines).encode())
        fs.move(f"{folder}/.{self.job}", f"{folder}/{self.job}.json")


def later(a: Any, b: Any) -> bool:
    """Whether a key comes after another as Spark orders them, which puts a float that is not a number last."""
    return a > b or (a != a and b == b)


def together(messages: list[SentMessage]) -> list[SentMessage]:
    """The same messages, but a range that several tasks shared is told once, with all its points and its last key."""
    found: dict[int, tuple[int, Any, str]] = {}
    for message in messages:
        for r, (n, text) in message.ranges.items():
            points, *before = found.get(r, (0, None, None))
            key = message.keys.get(r)
            found[r] = (points + n, *(before if points and not later(key, before[0]) else (key, text)))
    told = []
    for message in messages:
        mine = {r: (n, text) for r in message.ranges if r in found for n, _, text in [found.pop(r)]}
        told.append(replace(message, ranges=mine))
    return told


#: Beside the log's own files, under a name that readers of its folder pass over.
SHARD_FILES = "_shards"


def logged_shards(shards: dict[Any, list[int]]) -> list[dict]:
    return [
        {
            "keyword": key if isinstance(key, str) else None,
            "number": None if key is None or isinstance(key, str) else str(key),
            "points": points, "batches": batches, "retries": retries,
        }
        for key, (points, batches, retries) in shards.items()
    ]


def logged(message: SentMessage) -> dict:
    return {
        "ranges": [{"range_id": r, "points": n, "last_key": key} for r, (n, key) in message.ranges.items()],
        "shards": logged_shards(message.shards),
        "points": message.points,
        "file": message.file,
    }


class ClientTarget:
    """An outside client as the target of a copy, shard by shard.

    Points that carry the marks of a copy (range and key) are laid out by range, and the later version of an id is the
    one that is sent. A range is the work of one task, or of several, by id, where the session's shuffle partitions are
    more than the ranges. What the tasks sent is kept at ``log_path``, which tasks must reach too, also when the
    job fails; ``marks`` then has the ranges that are done. Without marks no row is moved, and ids must be unique.
    Batches hold one shard each; a task sends a shard's points of all its ranges together.

    ``client.count()``, where the client has it, is the number of points it holds.
    """

    def __init__(
        self,
        spark: SparkSession,
        client_factory: Callable[[], Any],
        log_path: str,
        batch_size: int = DEFAULT_BATCH_SIZE,
        delay_seconds: float = 0.0,
    ):
        check_batch_size(batch_size)
        file_system(log_path)  # an unknown kind of path fails here, before anything is sent
        self.spark, self.client_factory, self.log_path = spark, client_factory, log_path
        self.batch_size, self.delay_seconds = batch_size, delay_seconds
        self.marks: dict[int, tuple[str, int]] = {}

    def upsert(self, points: DataFrame, seq: str | None = None, ranges: int | None = None) -> int:
        """Send one batch and return the number of its points.

        ``ranges`` is the number of ranges that marked points lie in: as many tasks share them. Without it Spark may
        put small ranges together, and a failure then repeats all ranges of a task.

        With ``seq`` the highest of an id is sent; of equal ones, or without it, the row read last.
        """
        job, self.marks, parts = uuid.uuid4().hex, {}, 1
        marked = RANGE_MARK in points.columns
        columns = [c for c in POINT_COLUMNS if c in points.columns] + [RANGE_MARK, KEY_MARK] * marked
        rows = points.select(*columns, *([F.col(seq).alias("_seq")] if seq else []))
        order = ["_seq", "_arrival"] if seq else ["_arrival"]
        if marked or seq:
            rows = rows.withColumn("_arrival", F.monotonically_increasing_id())
            keys = [RANGE_MARK, "id"] if marked else ["id"]
            if marked and ranges:
                parts = math.ceil(int(self.spark.conf.get("spark.sql.shuffle.partitions")) / ranges)
                rows = rows.withColumn("_place", place_of(F.col(RANGE_MARK), F.col("id"), ranges, parts))
                rows, keys = rows.repartitionById(ranges * parts, F.col("_place")), ["_place", *keys]
            elif marked:
                rows = rows.repartition(RANGE_MARK)
            rows = keep_last(rows, keys, order)
        if marked:
            key = F.struct(F.col(KEY_MARK).alias("key"), F.col(KEY_MARK).cast("string").alias("text"))
            rows = rows.withColumn(KEY_MARK, key)
        wire = wire_points(rows.select(*columns))
        if "shard_key" in columns:
            wire = wire.sortWithinPartitions("shard_key")
        writer = ClientWriter(self.client_factory, self.batch_size, self.delay_seconds, self.log_path, job, parts)
        try:
            wire.write.format(_client_format(self.spark, writer)).mode("append").save()
        finally:
            sent = self._read_job(job)
            self.marks = {r["range_id"]: (r["last_key"], r["points"]) for line in sent for r in line["ranges"]}
        return sum(line["points"] for line in sent)

    def _read_job(self, job: str) -> list:
        fs, folder = file_system(self.log_path)
        path = f"{folder}/{job}.json"
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return []
        with fs.open_input_stream(path) as stream:
            return [json.loads(line) for line in stream.read().decode().splitlines() if line]

    def count(self) -> int:
        return self.client_factory().count()

    def sent(self) -> DataFrame:
        """Points, batches and retries per shard key, summed over all upserts."""
        log = self.spark.read.schema(LOGGED).json(self.log_path)
        shards = log.select(F.explode("shards").alias("s")).select("s.*")
        files = [f"{self.log_path}/{r['file']}" for r in log.where("file IS NOT NULL").select("file").collect()]  # one for a task
        if files:
            shards = shards.unionByName(self.spark.read.schema(shards.schema).json(files))
        number = F.col("number").cast("decimal(20,0)").alias("number")
        return shards.groupBy("keyword", number).agg(
            *[F.sum(c).alias(c) for c in ("points", "batches", "retries")]
        )


def place_of(range_id: Column, point_id: Column, ranges: int, parts: int) -> Column:
    """The task of a point: ``parts`` of them in a row belong to one range."""
    return (F.pmod(range_id, F.lit(ranges)) * parts + F.pmod(F.xxhash64(point_id), F.lit(parts)).cast("int")).cast("int")


def _client_format(spark: SparkSession, writer: ClientWriter) -> str:
    """Register a writer under a name of its own."""
    format_name = f"vecflow_client_{writer.job}"

    class ClientSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def writer(self, schema, overwrite: bool) -> ClientWriter:
            return writer

    spark.dataSource.register(ClientSink)
    return format_name
