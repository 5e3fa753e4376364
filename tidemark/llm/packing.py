"""Best-fit packing of token pieces into sequences, improved by swaps (operator 1).

Pieces are dealt at random to shards of about ``SHARD_PIECES``. A shard packs by best fit, longest first,
and then runs a local search: pieces of the emptiest bin move into other underfull bins, or one or two of
them change places with a shorter one there, as long as the sum of squared fills grows; bins that empty
are dropped. Loosely filled bins of all shards are taken apart and packed again in fewer shards, until one
shard is left or a round leaves nearly as many loose pieces as it was given: those have lengths that do not
fill a bin together, and their bins stand. Pieces of full length are sequences by themselves.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames, tokens, words

CAPACITY = 2048
SHARD_PIECES = 8_000
#: Bins filled below this share of the capacity are packed again with those of other shards.
LOOSE = 0.98
#: A round that leaves more than this share of its pieces loose is the last.
STUCK = 0.9

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, lane long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, lane long, bin int, offset long, fill long"


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only its first piece is shorter than the capacity."""
    first = count % capacity or min(count, capacity)
    return [(0, first), *((s, capacity) for s in range(first, count, capacity))]


@words.frugal
def _pieces(batches: Iterator[pa.RecordBatch], capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encode, end = tokens.encoder().many, np.array([tokens.END], "<u4").tobytes()
    lane = TaskContext.get().partitionId() << 33
    for batch in tokens.forgotten_after(batches):
        rows = []
        for doc, made in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text")), strict=True):
            ids = made.tobytes() + end
            for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                part = ids[4 * start : 4 * (start + length)]
                rows.append((doc, piece, start, length, zlib.crc32(part), lane, part if keep_ids else None))
                lane += 1
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "lane", "ids"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: 6 + keep_ids], names[: 6 + keep_ids]
        )


# --- one shard --------------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit, longest first: item indexes of each bin."""
    bins: list[list[int]] = []
    open_bins: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r is set if a bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(item)
        if room > length:
            open_bins[room - length].append(chosen)
            rooms |= 1 << (room - length)
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins that raise the sum of squared fills; returns the bins left."""
    fills = np.array([int(lengths[b].sum()) for b in bins])
    underfull = np.flatnonzero(fills < capacity)
    if len(underfull) < 2:
        return bins
    items = np.concatenate([bins[b] for b in underfull]).astype(np.int64)
    place = np.repeat(np.arange(len(underfull)), [len(bins[b]) for b in underfull])
    size, fill = lengths[items].astype(np.int64), fills[underfull].astype(np.int64)

    def improve(donor: int) -> bool:
        own = np.flatnonzero(place == donor)
        own = own[np.argsort(-size[own], kind="stable")]
        offers = [(int(size[a]), (a,)) for a in own]
        offers += [(int(size[a] + size[b]), (a, b)) for k, a in enumerate(own) for b in own[k + 1 :]]
        best = None
        for given, which in offers:
            if len(which) == 1:  # move: the fullest bin with room
                fits = (capacity - fill >= given) & (fill + given > fill[donor])
                fits[donor] = False
                if fits.any():
                    target = int(np.argmax(np.where(fits, fill, -1)))
                    place[which[0]] = target
                    fill[target] += given
                    fill[donor] -= given
                    return True
            gain = given - size  # swap against one shorter item elsewhere
            after = fill[place] + gain
            fits = (gain > 0) & (after <= capacity) & (after > fill[donor]) & (place != donor)
            if fits.any():
                taken = int(np.argmax(np.where(fits, after, -1)))
                if best is None or after[taken] > best[0]:
                    best = (int(after[taken]), which, taken)
                if best[0] == capacity:
                    break
        if best is None:
            return False
        _, which, taken = best
        target, gain = int(place[taken]), int(size[list(which)].sum() - size[taken])
        place[list(which)], place[taken] = target, donor
        fill[target] += gain
        fill[donor] -= gain
        return True

    again = True
    while again:
        again = False
        for donor in np.argsort(fill, kind="stable").tolist():
            while 0 < fill[donor] < capacity and improve(donor):
                again |= bool(fill[donor] == 0)
    kept = [bins[b] for b in np.flatnonzero(fills >= capacity)]
    order = np.argsort(place, kind="stable")
    at = np.flatnonzero(np.append(True, np.diff(place[order]) != 0))
    return kept + [x.tolist() for x in np.split(items[order], at[1:])]


@words.frugal
def _pack_shard(shard: pa.Table, capacity: int) -> pa.Table:
    shard = shard.sort_by("lane")
    lengths = shard["length"].to_numpy()
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    items = np.concatenate(bins).astype(np.int64)
    sizes = [len(b) for b in bins]
    ends = np.cumsum(lengths[items])
    fill = np.add.reduceat(lengths[items], np.cumsum([0, *sizes[:-1]]))
    base = np.repeat(np.cumsum(fill) - fill, sizes)
    return (
        shard.take(pa.array(items))
        .drop_columns(["shard"])
        .append_column("bin", pa.array(np.repeat(np.arange(len(bins)), sizes).astype(np.int32)))
        .append_column("offset", pa.array(ends - lengths[items] - base))
        .append_column("fill", pa.array(np.repeat(fill, sizes)))
    )


# --- the operator -----------------------------------------------------------------------------


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row of ``docs``.

    A document's ids are those of its text and an end id, so null and empty texts have one token. Documents
    beyond the capacity are cut, the rest stay whole. Rows that share or lack a doc_id are packed like
    any others. An empty table gives no rows.
    """
    made = docs.select("doc_id", "text").mapInArrow(lambda b: _pieces(b, capacity, False), _PIECE)
    made = frames.stored(made, "pieces")
    out = made.filter(F.col("length") >= capacity).select(
        *made.columns, (-1 - F.col("lane")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest, level = made.filter(F.col("length") < capacity), 0
    pieces = rest.count()
    while True:
        shards = max(1, -(-pieces // SHARD_PIECES))
        dealt = rest.withColumn("shard", F.pmod(F.xxhash64("lane", F.lit(level)), F.lit(shards)))
        packed = dealt.groupBy("shard").applyInArrow(
            lambda t: _pack_shard(t, capacity).append_column("shard", t["shard"]), _PACKED + ", shard long"
        )
        packed = frames.stored(packed, "packed")
        tight = F.col("fill") >= int(LOOSE * capacity)
        left = packed.filter(~tight).count() if shards > 1 else 0
        last = shards == 1 or left > STUCK * pieces
        tight = F.lit(True) if last else tight
        numbered = (F.lit(level) * F.lit(2**55)) + F.col("shard") * F.lit(2**24) + F.col("bin")
        out = out.unionByName(
            packed.filter(tight).select(*made.columns, numbered.cast("long").alias("sequence_id"), "offset")
        )
        if last:
            return out.drop("lane")
        rest, pieces, level = packed.filter(~tight).select(*made.columns), left, level + 1


def sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed sequences themselves, their ids joined in order of offset."""
    pieces = docs.select("doc_id", "text").mapInArrow(lambda b: _pieces(b, capacity, True), _PIECE + ", ids binary")
    key = ["doc_id", "piece", "ids_crc32"]
    placed = pack(docs, capacity).select(*key, "sequence_id", "offset")
    pieces = pieces.select(*(F.col(k).alias(f"piece_{k}") for k in key), "ids").dropDuplicates([f"piece_{k}" for k in key])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"piece_{k}"))
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most ``capacity`` pieces
    return (
        placed.join(pieces, same)
        .groupBy("sequence_id")
        .agg(ordered.alias("p"))
        .select(
            "sequence_id",
            F.aggregate("p", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"])).alias("ids"),
            F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        )
    )
