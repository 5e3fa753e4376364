"""Removal of word sequences that repeat across documents, found with FM-indexes of shards (operator 9).

A window is ``WINDOW`` consecutive words. Its *minimizer* is the smallest hash among its word 5-grams, so
equal windows have equal minimizers and meet under it. Work is cut down in three steps and only then
indexed:

1. minimizers that occur in one document only are dropped. Their occurrences are reduced per task, dealt
   by leading hash bits, and leave one bit each in a filter of fixed size;
2. consecutive windows with one minimizer form a *segment*. A segment that occurs unchanged in an earlier
   document is settled by the smallest document id of its content. Segments are known by their hash here;
3. different segments under one minimizer (edges of repeats, edited copies) go to shards. Each shard
   holds an FM-index over a wavelet matrix of its segments; backward search extends the match of each
   segment leftwards word by word, and intervals that reach ``WINDOW`` words give the smallest document
   id holding them.

A minimizer with many different segments is dealt by window, so no shard depends on one hot minimizer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames, words

WINDOW = 13
GRAM = 5
#: Bits of the filter of repeated minimizers, whatever the input; a full filter only passes more.
FILTER_BITS = 26
#: Different segments under one minimizer that still share a shard.
TOGETHER = 2_000
#: Segments a shard is meant to hold.
SHARD_SEGMENTS = 20_000

_SEGMENTS = "m long, seg long, doc_id long, start int, n int"
_CONTENTS = _SEGMENTS + ", content binary"


# --- windows and their minimizers -------------------------------------------------------------


def windows(found: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, minimizer and document of each window of the documents in ``found``."""
    count = max(len(found.hashes) - WINDOW + 1, 0)
    least = words.grams(found.hashes, GRAM)
    span, have = WINDOW - GRAM + 1, 1
    while have < span:  # minima over 2, 4, 8, ... grams, then the rest
        step = min(have, span - have)
        least = np.minimum(least[: max(len(least) - step, 0)], least[step:])
        have += step
    owner = found.owners()[:count]
    first = np.arange(count)
    inside = first + WINDOW <= found.bounds[owner + 1] if count else np.zeros(0, bool)
    return first[inside], words.mix(least[:count][inside]), owner[inside]


def _runs(minimizer: np.ndarray, owner: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where a segment begins: new minimizer or document, or as many windows as one gram can lead."""
    if not len(first):
        return np.zeros(0, np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (minimizer[1:] != minimizer[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    since = np.arange(len(first)) - np.repeat(begin, np.diff(np.append(begin, len(first))))
    return np.flatnonzero(since % (WINDOW - GRAM + 1) == 0)


# --- step 1: minimizers in two or more documents ----------------------------------------------


def _minimizer_blobs(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Per bucket of leading bits: next 32 bits of each minimizer with its least and greatest document."""
    for batch in batches:
        keys, docs = [], []
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            first, minimizer, owner = windows(words.split(data, offsets))
            runs = _runs(minimizer, owner, first)
            keys.append(minimizer[runs])
            docs.append(ids[begin:end][owner[runs]])
        keys, docs = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(docs or [ids[:0]])
        if not len(keys):
            continue
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, low, high = keys[at], np.minimum.reduceat(docs, at), np.maximum.reduceat(docs, at)
        twice = high != low
        keys, docs = np.concatenate([keys, keys[twice]]), np.concatenate([low, high[twice]])
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, docs = bucket[order], docs[order]
        short = ((keys[order] >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")
        at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = np.append(at[1:], len(bucket))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[at].astype(np.int32)),
                pa.array([short[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()),
                pa.array([docs[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()),
            ],
            ["bucket", "keys", "docs"],
        )


def _filter_slice(blobs: pa.Table, bits: int) -> pa.Table:
    """The bucket's slice of the filter: a bit for each minimizer seen in two documents."""
    keys = np.concatenate([np.frombuffer(x, "<u4") for x in blobs["keys"].to_pylist()])
    docs = np.concatenate([np.frombuffer(x, "<i8") for x in blobs["docs"].to_pylist()])
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    shared = keys[at][np.minimum.reduceat(docs, at) < np.maximum.reduceat(docs, at)]
    marks = np.zeros(1 << (FILTER_BITS - bits), bool)
    marks[shared >> np.uint32(32 - (FILTER_BITS - bits))] = True
    return pa.table({"bucket": blobs["bucket"][:1], "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())})


def _gathered(slices: DataFrame, bits: int) -> np.ndarray:
    """The slices of all buckets joined: always 2**FILTER_BITS packed bits."""
    size = 1 << (FILTER_BITS - bits - 3)
    packed = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in slices.toLocalIterator():
        packed[row.bucket * size : (row.bucket + 1) * size] = np.frombuffer(row.marks, np.uint8)
    return packed


def _bucket_bits(docs: DataFrame) -> int:
    return min(max(5, (frames.width(docs.sparkSession) - 1).bit_length()), 14)


def repeated_filter(docs: DataFrame) -> np.ndarray:
    """Filter by leading bits of the minimizers that occur in two documents."""
    bits = _bucket_bits(docs)
    blobs = docs.mapInArrow(lambda b: _minimizer_blobs(b, bits), "bucket int, keys binary, docs binary")
    slices = blobs.groupBy("bucket").applyInArrow(lambda t: _filter_slice(t, bits), "bucket int, marks binary")
    return _gathered(slices, bits)


def _prefix_slice(rows: pa.Table, bits: int) -> pa.Table:
    low = rows["prefix"].to_numpy() & ((1 << (FILTER_BITS - bits)) - 1)
    marks = np.zeros(1 << (FILTER_BITS - bits), bool)
    marks[low] = True
    return pa.table({"bucket": rows["bucket"][:1], "marks": pa.array([np.packbits(marks).tobytes()], pa.binary())})


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """Filter by leading bits of a column of hashes."""
    bits = _bucket_bits(hashes)
    prefix = F.shiftrightunsigned(hashes[hashes.columns[0]], 64 - FILTER_BITS)
    rows = hashes.select(prefix.alias("prefix")).distinct()
    rows = rows.withColumn("bucket", F.shiftright("prefix", FILTER_BITS - bits).cast("int"))
    slices = rows.groupBy("bucket").applyInArrow(lambda t: _prefix_slice(t, bits), "bucket int, marks binary")
    return _gathered(slices, bits)


def _passes(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


# --- step 2: segments -------------------------------------------------------------------------


def _segments(
    batches: Iterator[pa.RecordBatch], repeated: np.ndarray, wanted: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """Segments under repeated minimizers; with ``wanted``, only those it passes, with their word hashes."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            found = words.split(data, offsets)
            first, minimizer, owner = windows(found)
            runs = _runs(minimizer, owner, first)
            size = np.diff(np.append(runs, len(first)))
            passed = _passes(repeated, minimizer[runs])
            runs, size = runs[passed], size[passed]
            start, stop = first[runs], first[runs] + size + WINDOW - 1
            seg = words.spans(found.hashes, start, stop)
            if wanted is not None:
                passed = _passes(wanted, seg)
                runs, size, start, stop, seg = (x[passed] for x in (runs, size, start, stop, seg))
            columns = {
                "m": pa.array(minimizer[runs].view(np.int64)),
                "seg": pa.array(seg.view(np.int64)),
                "doc_id": pa.array(ids[begin:end][owner[runs]]),
                "start": pa.array((start - found.bounds[owner[runs]]).astype(np.int32)),
                "n": pa.array(size.astype(np.int32)),
            }
            if wanted is not None:
                raw = found.hashes.astype("<u8").tobytes()
                columns["content"] = pa.array([raw[8 * a : 8 * b] for a, b in zip(start, stop, strict=True)], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


# --- step 3: FM-index of a shard --------------------------------------------------------------


class WaveletMatrix:
    """Rank of any symbol before any place of a sequence of small integers, as packed bit rows."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.levels = max(int(sigma - 1).bit_length(), 1)
        self.rows, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1 == 1
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, bool)
            padded[: len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.rows.append((packed, before))
            self.zeros.append(len(bit) - int(before[-1]))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        order = np.argsort(symbols, kind="stable")
        ordered = symbols[order]
        self.first = np.zeros(sigma, np.int64)
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else order
        self.first[ordered[at]] = order[at]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``place``, elementwise; the symbols must occur."""
        for level, (packed, before), zeros in zip(
            reversed(range(self.levels)), self.rows, self.zeros, strict=True
        ):
            word, rest = place >> 6, (place & 63).astype(np.uint64)
            ones = before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << rest) - np.uint64(1)))
            place = np.where((symbol >> level) & 1 == 1, zeros + ones, place - ones)
        return place - self.first[symbol]


class FmIndex:
    """FM-index of texts of integer symbols; searches patterns of up to ``reach`` symbols backwards."""

    def __init__(self, texts: list[np.ndarray], reach: int = WINDOW) -> None:
        lengths = np.array([len(t) for t in texts])
        self.vocabulary, codes = np.unique(np.concatenate(texts), return_inverse=True)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(int(lengths.sum()) + len(texts), np.int64)  # 0 ends each text
        body = np.ones(len(text), bool)
        body[ends] = False
        text[body] = codes + 1
        self.text, self.sigma = text, len(self.vocabulary) + 1
        self.owner = np.repeat(np.arange(len(texts)), lengths + 1)
        # Suffixes sorted by their first ``reach`` symbols or more, by doubling; nothing runs on after an end.
        rank, have = text.copy(), 1
        while have < reach:
            after = np.zeros(len(text), np.int64)
            after[:-have] = rank[have:]
            after[np.arange(len(text)) + have > ends[self.owner]] = -1
            pair = rank * (int(rank.max()) + 2) + after + 1
            rank = np.unique(pair, return_inverse=True)[1]
            have *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.matrix = WaveletMatrix(text[self.suffixes - 1], self.sigma)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbol`` put before the patterns that have the intervals [low, high)."""
        base = self.smaller[symbol]
        return base + self.matrix.rank(symbol, low), base + self.matrix.rank(symbol, high)

    def matches(self, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of the ``length`` symbols before each place of the text in ``ends``."""
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text))
        for k in range(1, length + 1):
            low, high = self.extend(self.text[ends - k], low, high)
        return low, high

    def matching_statistics(self, symbols: np.ndarray) -> np.ndarray:
        """For each end in a streamed document, the longest match (up to ``reach``) that ends there."""
        place = np.searchsorted(self.vocabulary, symbols)
        known = np.take(self.vocabulary, np.minimum(place, len(self.vocabulary) - 1)) == symbols
        codes = np.where(known, place + 1, 0)
        out = np.zeros(len(codes), np.int64)
        live = np.flatnonzero(codes)
        low, high = np.zeros(len(live), np.int64), np.full(len(live), len(self.text))
        while len(live):
            symbol = codes[live - out[live]]
            low, high = self.extend(symbol, low, high)
            held = high > low
            live, low, high = live[held], low[held], high[held]
            out[live] += 1
            more = live - out[live] >= 0
            more[more] = codes[live[more] - out[live[more]]] > 0
            more &= out[live] < WINDOW
            live, low, high = live[more], low[more], high[more]
        return out


def _search_shard(rows: pa.Table) -> pa.Table:
    """Windows of the shard's segments that an earlier document holds: segment, window, that document."""
    content = [np.frombuffer(x, "<u8") for x in rows["content"].to_pylist()]
    doc = rows["lo"].to_numpy()
    index = FmIndex(content)
    sizes = np.array([len(c) - WINDOW + 1 for c in content])
    owner = np.repeat(np.arange(len(content)), sizes)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    begin = np.cumsum(sizes + WINDOW) - (sizes + WINDOW)
    low, high = index.matches(begin[owner] + within + WINDOW, WINDOW)
    spans, which = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
    held = doc[index.owner[index.suffixes]]
    cuts = np.append(spans.T.ravel(), len(held))[:-1]
    least = np.minimum.reduceat(np.append(held, np.iinfo(np.int64).max), cuts)[::2]
    first = least[which.ravel()]
    hit = first < doc[owner]
    seg, base = rows["seg"].to_numpy(), rows["base"].to_numpy()
    return pa.table(
        {
            "seg": pa.array(seg[owner[hit]]),
            "lo": pa.array(doc[owner[hit]]),
            "place": pa.array((base[owner[hit]] + within[hit]).astype(np.int32)),
            "least": pa.array(first[hit]),
        }
    )


def _covered(docs: DataFrame) -> DataFrame:
    """(doc_id, start, stop): word ranges covered by windows that start in an earlier document."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    repeated = share(repeated_filter(docs))
    seen = frames.stored(docs.mapInArrow(lambda b: _segments(b, repeated.value), _SEGMENTS), "segments")
    owned = frames.stored(
        seen.groupBy("m", "seg").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "segment-owners"
    )
    several = owned.groupBy("m").agg(F.count("*").alias("k")).filter("k > 1")
    compared = frames.stored(owned.join(several, "m").select("m", "seg", "lo", "k"), "segment-compared")
    shards = max(1, -(-compared.count() // SHARD_SEGMENTS))
    wanted = share(hash_filter(compared.select("seg")))
    contents = docs.mapInArrow(lambda b: _segments(b, repeated.value, wanted.value), _CONTENTS)
    whole = (
        contents.join(compared.withColumnRenamed("lo", "doc_id"), ["m", "seg", "doc_id"])
        .groupBy("m", "seg", "k", "n", F.col("doc_id").alias("lo"))
        .agg(F.first("content").alias("content"))
    )
    whole = frames.stored(whole, "segment-contents")
    together = whole.filter(F.col("k") <= TOGETHER).select(
        F.pmod(F.xxhash64("m"), F.lit(shards)).alias("shard"), "seg", "lo", F.lit(0).alias("base"), "content"
    )
    window = F.substring("content", F.col("base") * 8 + 1, F.lit(8 * WINDOW))
    apart = (
        whole.filter(F.col("k") > TOGETHER)
        .withColumn("base", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .withColumn("content", window)
    )
    # A window that many segments share enters an index twice at most: for its least and for its greatest document.
    shared = apart.groupBy("content").agg(F.min("lo").alias("least"), F.max("lo").alias("most")).filter("least < most")
    windows = shared.select(
        F.pmod(F.xxhash64("content"), F.lit(shards)).alias("shard"),
        F.xxhash64("content").alias("seg"),
        F.explode(F.array("least", "most")).alias("lo"),
        F.lit(-1).alias("base"),
        "content",
    )
    earlier = together.unionByName(windows).groupBy("shard").applyInArrow(
        _search_shard, "seg long, lo long, place int, least long"
    )
    earlier = frames.stored(earlier, "earlier-windows")
    found = earlier.filter("place < 0").select(F.col("seg").alias("window"), "least")
    places = apart.withColumn("window", F.xxhash64("content")).join(found, "window").filter("least < lo")
    earlier = earlier.filter("place >= 0").select("seg", "lo", "place").unionByName(
        places.select("seg", "lo", F.col("base").alias("place"))
    )
    copies = (
        seen.join(owned.filter("lo < hi").select("m", "seg", "lo"), ["m", "seg"])
        .filter("lo < doc_id")
        .select("doc_id", "start", (F.col("start") + F.col("n") + (WINDOW - 1)).alias("stop"))
    )
    edges = earlier.join(
        seen.select("seg", F.col("doc_id").alias("lo"), "start"), ["seg", "lo"]
    ).select(
        F.col("lo").alias("doc_id"),
        (F.col("start") + F.col("place")).alias("start"),
        (F.col("start") + F.col("place") + WINDOW).alias("stop"),
    )
    return copies.unionByName(edges)


# --- the operator -----------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ranges = batch.column("ranges").to_pylist()
        n_words, n_removed, kept, digest = [], [], [], []
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            found = words.split(data, offsets)
            for doc, a, b in zip(range(begin, end), found.bounds[:-1], found.bounds[1:], strict=True):
                step = np.zeros(b - a + 1, np.int64)
                for packed in ranges[doc] or ():
                    step[packed >> 32] += 1
                    step[packed & 0xFFFFFFFF] -= 1
                keep = a + np.flatnonzero(np.cumsum(step[:-1]) == 0)
                raw = data.data
                text = b" ".join(bytes(raw[s:e]) for s, e in zip(found.start[keep], found.stop[keep], strict=True))
                n_words.append(b - a)
                n_removed.append(b - a - len(keep))
                kept.append(text.decode())
                digest.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(digest, pa.string()),
                pa.array(kept, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) for each row of ``docs`` (doc_id, text).

    Null text has no words. Rows with null doc_id have no place in the order: they neither remove nor
    lose words. Rows that share a doc_id count as one document. Texts below ``WINDOW`` words are kept.
    Kept words are joined by one space. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    ranges = frames.stored(
        _covered(docs.filter("doc_id is not null"))
        .groupBy("doc_id")
        .agg(F.collect_set(F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop")).alias("ranges")),
        "covered",
    )
    return docs.join(ranges, "doc_id", "left").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
