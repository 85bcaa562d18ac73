"""Token-id files with a shared compression dictionary and an offset index (operator 2).

A folder holds ``shards`` and ``dictionary`` (Parquet, written by Spark's own
committer, so a lost executor leaves no half-written file). A row of ``shards``
is one container of consecutive documents:

    magic, width of an id, dictionary hash, number of documents,
    ids of the documents, their token counts, offsets of their frames, frames

Each document is one zstandard frame of its little-endian id array, compressed
with the dictionary of that hash. A short document is read by its offset alone.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vulnsift.llm.common import bounded_batches, map_batches
from vulnsift.llm.wordbpe import encoder

MAGIC = b"TKID1"
HEAD = struct.Struct("<5sB16sI")
NO_ID = -(1 << 63)  # stands for a null document id
SHARDS = "part int, seq int, part_start long, n_tokens long, first_id long, last_id long, content binary"
READ = "doc_id long, start long, n_tokens long, ids binary"


def _ids_bytes(offsets: np.ndarray, flat: np.ndarray, i: int, end: np.ndarray) -> bytes:
    return np.concatenate([flat[offsets[i] : offsets[i + 1]], end]).tobytes()


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, sample: int = 1024, longest: int = 8192, size: int = 32768) -> bytes:
    """A zstandard dictionary of the id arrays of about ``sample`` (at most twice
    as many) documents of at most ``longest`` characters, chosen by a hash of the
    id; empty if these are too few to train on. Only compression depends on it."""
    import zstandard

    n = docs.count()
    if not n:
        return b""
    share = min(1.0, 2 * sample / n)
    chosen = docs.where(F.length("text").between(1, longest)).where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    texts = [r[0] for r in chosen.select("text").limit(2 * sample).collect()]
    bpe = encoder(vocabulary)
    flat, offsets = bpe.encode(pa.array(texts, pa.string()))
    arrays = [_ids_bytes(offsets, flat, i, np.asarray([end_id], bpe.dtype)) for i in range(len(texts))]
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:16]


class Container:
    """One container under construction."""

    def __init__(self, width: int, dictionary: bytes):
        self.width, self.hash = width, dictionary_hash(dictionary)
        self.ids: list[int] = []
        self.counts: list[int] = []
        self.frames: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, count: int, frame: bytes) -> None:
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(count)
        self.frames.append(frame)
        self.held += len(frame)

    def content(self) -> bytes:
        ends = np.concatenate([[0], np.cumsum([len(f) for f in self.frames])]).astype("<u8")
        index = np.asarray(self.ids, "<i8").tobytes() + np.asarray(self.counts, "<u8").tobytes() + ends.tobytes()
        return HEAD.pack(MAGIC, self.width, self.hash, len(self.ids)) + index + b"".join(self.frames)


class Reader:
    """Random access to a container's documents."""

    def __init__(self, content: bytes, dictionary: bytes):
        import zstandard

        magic, width, own, n = HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token-id container")
        if own != dictionary_hash(dictionary):
            raise ValueError("the container was written with another dictionary")
        at = HEAD.size
        self.ids = np.frombuffer(content, "<i8", n, at)
        self.counts = np.frombuffer(content, "<u8", n, at + 8 * n).astype(np.int64)
        self.offsets = np.frombuffer(content, "<u8", n + 1, at + 16 * n).astype(np.int64) + at + 24 * n + 8
        self.dtype = np.dtype("<u2") if width == 2 else np.dtype("<u4")
        self.content = memoryview(content)
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def tokens(self, i: int) -> np.ndarray:
        return np.frombuffer(self.unzip.decompress(self.content[self.offsets[i] : self.offsets[i + 1]]), self.dtype)


_DICTIONARIES: dict[bytes, object] = {}


def _dictionary(raw: bytes):
    import zstandard

    if not raw:
        return None
    if raw not in _DICTIONARIES:
        _DICTIONARIES[raw] = zstandard.ZstdCompressionDict(raw)
    return _DICTIONARIES[raw]


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1, container_bytes: int = 1 << 20, level: int = 3) -> None:
    """Write the ids of every whole text, then ``end_id``, in ascending doc_id order.

    Null text counts as empty. A null id comes first; repeated rows are written
    each, those of one id in the order of a hash of their text. Other columns are
    ignored. An empty table makes an empty folder of files.
    """
    spark = docs.sparkSession
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    dictionary = train_dictionary(docs, vocabulary, end_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        bpe = encoder(vocabulary)
        zipper = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary), write_content_size=True)
        end = np.asarray([end_id], bpe.dtype)
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        box = Container(bpe.dtype.itemsize, dictionary)

        def closed() -> pa.RecordBatch:
            row = (part, seq, start, sum(box.counts), box.ids[0], box.ids[-1], box.content())
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=[c.split()[0] for c in SHARDS.split(", ")])

        for batch in bounded_batches(batches, "text"):
            flat, offsets = bpe.encode(batch.column("text"))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                raw = _ids_bytes(offsets, flat, i, end)
                box.add(doc_id, len(raw) // bpe.dtype.itemsize, zipper.compress(raw))
                if box.held >= container_bytes:
                    yield closed()
                    seq, start = seq + 1, start + sum(box.counts)
                    box = Container(bpe.dtype.itemsize, dictionary)
        if box.ids:
            yield closed()

    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    map_batches(ordered, run, SHARDS).write.option("compression", "uncompressed").parquet(f"{folder}/shards")
    spark.createDataFrame([(dictionary_hash(dictionary), dictionary)], "hash binary, content binary").coalesce(1).write.parquet(f"{folder}/dictionary")


def _open(spark: SparkSession, folder: str) -> tuple[DataFrame, bytes]:
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    return shards, bytes(spark.read.parquet(f"{folder}/dictionary").first()["content"])


def _with_base(shards: DataFrame) -> DataFrame:
    """Containers with the tokens of all earlier parts. There is one part for each
    partition that wrote, a number set by the session and not by the data."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return shards.join(F.broadcast(bases), "part")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a folder: doc_id, start (ids of all documents before it),
    n_tokens, ids (packed little-endian unsigned 32-bit integers)."""
    shards, dictionary = _open(spark, folder)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, own, content in zip(*(batch.column(c).to_pylist() for c in ("base", "part_start", "content"))):
                reader = Reader(content, dictionary)
                starts = base + own + np.cumsum(reader.counts) - reader.counts
                ids = [reader.tokens(i).astype("<u4").tobytes() for i in range(len(reader.ids))]
                columns = [pa.array([None if d == NO_ID else d for d in reader.ids.tolist()], pa.int64()), pa.array(starts, pa.int64())]
                columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return map_batches(_with_base(shards).select("base", "part_start", "content"), run, READ)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[int] | None:
    """The ids of one document, from its frame alone (null if there is none)."""
    shards, dictionary = _open(spark, folder)
    for r in shards.where(F.lit(doc_id).between(F.col("first_id"), F.col("last_id"))).orderBy("part", "seq").limit(2).collect():
        reader = Reader(r["content"], dictionary)
        at = np.flatnonzero(reader.ids == doc_id)
        if len(at):
            return reader.tokens(int(at[0])).tolist()
    return None
