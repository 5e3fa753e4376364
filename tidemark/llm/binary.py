"""Token ids in a compressed binary format with a shared dictionary (operator 6).

A dataset is a folder with three Parquet tables, so any store Spark can write will do:

* ``dictionary``: one row, the zstandard dictionary and its SHA-256;
* ``blocks``: runs of consecutive documents. ``frames`` holds one zstandard frame per document, compressed
  separately; ``offsets`` says where each begins, so one short document is read without its neighbours.
  Each block names the dictionary by its hash;
* ``parts``: tokens before each part of the writing job, which turn places in a part into global places.

Ids are stored as little-endian unsigned integers of ``ID_TYPE``; an id that does not fit raises an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import frames, tokens

ID_TYPE = "<u2"
LEVEL = 3
DICTIONARY_BYTES = 64 * 1024
#: Documents (those of smallest hash) that the dictionary is trained on, and ids of each at most: a longer
#: document gives slices spread evenly over its whole length.
SAMPLE_DOCS = 1_000
SAMPLE_IDS = 4_096
SLICE_IDS = 256
#: Compressed bytes after which a block is closed.
BLOCK_BYTES = 1 << 20

_BLOCKS = (
    "part int, block int, first_doc long, last_doc long, n_tokens long, start_in_part long, dictionary_hash string, "
    "doc_ids array<long>, counts array<int>, offsets array<int>, frames binary"
)
_READ = "doc_id long, start_in_part long, n_tokens long, ids_crc32 long, ids array<long>, part int"


def _ids(texts: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each document with its end id, in the type they are stored in."""
    for ids in tokens.encoder().many(texts):
        ids = np.append(ids, np.uint32(tokens.END))
        if ids.max() > np.iinfo(ID_TYPE).max:
            raise OverflowError(f"id {ids.max()} does not fit {ID_TYPE}; set ID_TYPE to <u4")
        yield ids.astype(ID_TYPE)


def _slices(ids: np.ndarray) -> list[bytes]:
    """At most ``SAMPLE_IDS`` ids of a document in its stored form, in slices spread over all of it."""
    if len(ids) <= SAMPLE_IDS:
        return [ids.tobytes()]
    starts = np.linspace(0, len(ids) - SLICE_IDS, SAMPLE_IDS // SLICE_IDS).astype(int)
    return [ids[s : s + SLICE_IDS].tobytes() for s in starts]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tokens.forgotten_after(batches):
        made = [b"".join(_slices(ids)) for ids in _ids(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["ids"])


def train_dictionary(docs: DataFrame) -> bytes:
    """A zstandard dictionary from serialized ids of a bounded sample; empty where there is too little text.

    Of rows that share a sampled doc_id the one with the least text hash is taken.
    """
    picked = docs.select("doc_id").filter("doc_id is not null").distinct()
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    held = docs.join(F.broadcast(picked), "doc_id").withColumn("tie", F.xxhash64("text"))
    texts = held.groupBy("doc_id").agg(F.min_by("text", "tie").alias("text"))
    sample = texts.select("text").mapInArrow(_sampled, "ids binary").collect()
    width = SLICE_IDS * np.dtype(ID_TYPE).itemsize
    samples = sorted(bytes(r.ids[k : k + width]) for r in sample for k in range(0, len(r.ids), width))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _compressed(batches: Iterator[pa.RecordBatch], dictionary: bytes) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True)
    for batch in tokens.forgotten_after(batches):
        counts, packed = [], []
        for ids in _ids(batch.column("text")):
            counts.append(len(ids))
            packed.append(squeeze.compress(ids.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int32()), pa.array(packed, pa.binary())],
            ["doc_id", "n_tokens", "frame"],
        )


def _blocked(batches: Iterator[pa.RecordBatch], dictionary_hash: str) -> Iterator[pa.RecordBatch]:
    """Blocks of the documents of one range of ids, which arrive in order."""
    part, block, start, schema = TaskContext.get().partitionId(), 0, 0, _block_schema()
    docs, counts, packed, size = [], [], [], 0

    def close() -> pa.RecordBatch:
        nonlocal block, start, docs, counts, packed, size
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in packed])]).tolist()
        held = [d for d in docs if d is not None]
        row = {
            "part": part,
            "block": block,
            "first_doc": min(held, default=None),
            "last_doc": max(held, default=None),
            "n_tokens": sum(counts),
            "start_in_part": start,
            "dictionary_hash": dictionary_hash,
            "doc_ids": docs,
            "counts": counts,
            "offsets": offsets,
            "frames": b"".join(packed),
        }
        block, start = block + 1, start + row["n_tokens"]
        docs, counts, packed, size = [], [], [], 0
        return pa.RecordBatch.from_pylist([row], schema)

    for batch in batches:
        for doc, count, frame in zip(
            batch.column("doc_id").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("frame").to_pylist(), strict=True
        ):
            docs.append(doc)
            counts.append(count)
            packed.append(frame)
            size += len(frame)
            if size >= BLOCK_BYTES:
                yield close()
    if docs:
        yield close()


def _block_schema() -> pa.Schema:
    return pa.schema(
        [
            ("part", pa.int32()),
            ("block", pa.int32()),
            ("first_doc", pa.int64()),
            ("last_doc", pa.int64()),
            ("n_tokens", pa.int64()),
            ("start_in_part", pa.int64()),
            ("dictionary_hash", pa.string()),
            ("doc_ids", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int32())),
            ("offsets", pa.list_(pa.int32())),
            ("frames", pa.binary()),
        ]
    )


def write_ids(docs: DataFrame, path: str) -> None:
    """Write the ids of every row of ``docs`` (doc_id, text) under ``path`` in ascending doc_id order.

    Null text is empty: only the end id. Null doc_ids come first. Rows that share a doc_id keep a frame
    each, ordered by its content. An empty table gives tables without blocks.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    raw = train_dictionary(docs)
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw))], "hash string, dictionary binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    packed = docs.mapInArrow(lambda b: _compressed(b, raw), "doc_id long, n_tokens int, frame binary")
    packed = frames.stored(packed, "frames").withColumn("tie", F.xxhash64("frame"))
    ordered = packed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = ordered.mapInArrow(lambda b: _blocked(b, digest), _BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    # One row per task of the writing job.
    totals = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).write.parquet(f"{path}/parts")


def _restored(batches: Iterator[pa.RecordBatch], held: dict[str, bytes], keep_ids: bool) -> Iterator[pa.RecordBatch]:
    readers: dict[str, zstandard.ZstdDecompressor] = {}
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
         ("ids", pa.list_(pa.int64())), ("part", pa.int32())]
    )
    for batch in batches:
        for row in batch.to_pylist():
            name = row["dictionary_hash"]
            if name not in readers:
                if hashlib.sha256(held[name]).hexdigest() != name:
                    raise ValueError(f"dictionary {name} is damaged")
                readers[name] = zstandard.ZstdDecompressor(dict_data=_dictionary(held[name]))
            start, offsets, wanted = row["start_in_part"], row["offsets"], row["wanted"]
            out = []
            for k, (doc, count) in enumerate(zip(row["doc_ids"], row["counts"], strict=True)):
                if wanted is None or doc in wanted:
                    frame = row["frames"][offsets[k] : offsets[k + 1]]
                    ids = np.frombuffer(readers[name].decompress(frame), ID_TYPE).astype("<u4")
                    if len(ids) != count:
                        raise ValueError(f"document {doc} has {len(ids)} ids, {count} are recorded")
                    out.append((doc, start, count, zlib.crc32(ids.tobytes()), ids.tolist() if keep_ids else None))
                start += count
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)), pa.array([row["part"]] * len(out), pa.int32())],
                schema=schema,
            )


def read_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None, keep_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of all documents under ``path``, or of those asked for.

    For a list of ids only blocks whose range holds one of them are read, and only their frames decoded.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    wanted = F.lit(None).cast("array<long>")
    if doc_ids is not None:
        ranges = F.lit(False)
        for doc in doc_ids:
            ranges = ranges | F.lit(doc).between(F.col("first_doc"), F.col("last_doc"))
        blocks, wanted = blocks.filter(ranges), F.lit(list(doc_ids)).cast("array<long>")
    held = {r["hash"]: bytes(r["dictionary"]) for r in spark.read.parquet(f"{path}/dictionary").collect()}
    rows = blocks.withColumn("wanted", wanted).mapInArrow(lambda b: _restored(b, held, keep_ids), _READ)
    # As many rows as the writing job had tasks.
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
