"""Conversation prefix trie (operator 11).

Every distinct turn sequence is a row of a padded matrix of turn ids. Rows are range-partitioned in the order
of their sequences, so a shard holds a contiguous part of the trie. In a block of a shard, ``lexsort`` orders the
matrix, column changes accumulated by OR mark where a node begins at each depth, and ``reduceat`` sums every depth,
deepest first. Only nodes on the paths of a block's first and last row can reach into other blocks: their parts
become the rows of the next, much smaller matrix, which is folded in the same way until one block is left.

Memory: equal sequences are reduced to one row first, whose members are hashed as a stream; blocks are cut by
cells, so a task holds some hundred megabytes, or a few hundred bytes a turn of its longest conversation if that is more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames

#: Cells (rows x depths) of one block's matrix, and the rows it has whatever their length.
CELLS, LEAST_ROWS = 1 << 20, 4
#: Boundary paths that one shard of a later level holds.
SHARD_PATHS = 2048
#: Ids of one piece of a member list.
PIECE = 4096
#: Conversations per template, and how many opening turns may come from it.
FAMILY, HEADS = 100, 6

NO_MEMBER = np.iinfo(np.int64).max
DIGEST = 16
SUMS = ("n", "least", "children", "leaves", "saved")
_NODES = (
    "block long, conv_id long, depth int, parent_conv_id long, parent_key binary, node_key binary, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string"
)
_PATHS = "path binary, chars array<int>, " + ", ".join(f"{x} array<long>" for x in SUMS) + ", end array<string>"


# --- sequences --------------------------------------------------------------------------------


def sequences(chats: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation the digest and code points of its turns in order.

    Null turn numbers come first; equal ones follow by role, then by digest. Null role and text are empty.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turn = F.struct(
        F.col("turn").isNotNull().alias("numbered"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).alias("chars"),
    )
    rows = chats.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["chars"])).alias("turns"))


def opening(conv_id: Column) -> Column:
    """How many opening turns a conversation takes from its template."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation after the opening of its family's template: (conv_id, path, chars)."""
    heads = turns.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    h = opening(F.col("conv_id"))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.when(h > 0, F.slice("head", 1, h))
    none = F.array().cast("array<struct<digest:string,chars:int>>")
    joined = turns.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "family", "left")
    whole = joined.select("conv_id", F.concat(F.coalesce(head, none), own).alias("turns"))
    return whole.select(
        "conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.chars").alias("chars")
    )


# --- members of equal sequences -----------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys in ascending order of id, as text of at most PIECE ids."""
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        out, begin = [], 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin] or i - begin == PIECE:
                out.append((keys[begin], ids[begin], i - begin, ",".join(map(str, ids[begin:i]))))
                begin = i
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            if out else [pa.array([], t) for t in (pa.binary(), pa.int64(), pa.int64(), pa.string())],
            ["key", "first", "members", "piece"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key from its pieces in order; the hash is fed piece by piece."""
    key, least, count, digest = None, 0, 0, None
    for batch in batches:
        out = []
        for k, first, members, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "first", "members", "piece")), strict=True):
            if k != key:
                if key is not None:
                    out.append((least, count, digest.hexdigest()))
                key, least, count, digest = k, first, 0, hashlib.sha256()
            digest.update((("," if count else "") + piece).encode())
            count += members
        if out:
            yield _ended(out)
    if key is not None:
        yield _ended([(least, count, digest.hexdigest())])


def _ended(rows: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["conv_id", "members", "ends"]
    )


def distinct_sequences(whole: DataFrame) -> DataFrame:
    """(conv_id, members, ends, path, chars) per distinct sequence; conv_id is its smallest member."""
    spark = whole.sparkSession
    keyed = whole.select(F.unhex(F.md5("path")).alias("key"), "conv_id")
    pieces = (
        keyed.repartitionByRange(frames.width(spark), "key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_pieces, "key binary, first long, members long, piece string")
    )
    ends = (
        pieces.repartition(frames.width(spark), "key")
        .sortWithinPartitions("key", "first")
        .mapInArrow(_hashed, "conv_id long, members long, ends string")
    )
    return ends.join(whole, "conv_id")


# --- the fold -----------------------------------------------------------------------------------


@dataclass
class Block:
    """Sequences as bytes of their turns' digests, with sums per depth 0..length that they bring along."""

    paths: list[bytes]
    chars: list
    sums: dict[str, list]
    ends: list

    def __len__(self) -> int:
        return len(self.paths)


def _padded(lists: list, width: int, fill: int) -> np.ndarray:
    lens = np.fromiter(map(len, lists), np.int64, len(lists))
    out = np.full((len(lists), width), fill, np.int64)
    out[np.arange(width) < lens[:, None]] = np.concatenate([np.asarray(x, np.int64) for x in lists]) if lens.sum() else 0
    return out


def turn_ids(paths: list[bytes], width: int) -> np.ndarray:
    """The padded matrix: ids in the order of the digests, 0 beyond the end."""
    raw = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((raw[:, 1], raw[:, 0]))
    new = np.ones(len(raw), bool)
    new[1:] = (raw[order][1:] != raw[order][:-1]).any(axis=1)
    ids = np.empty(len(raw), np.int32)
    ids[order] = np.cumsum(new)
    lens = np.fromiter(map(len, paths), np.int64, len(paths)) // DIGEST
    matrix = np.zeros((len(paths), width), np.int32)
    matrix[np.arange(width) < lens[:, None]] = ids
    return matrix


def prefix_keys(path: bytes) -> list[bytes]:
    """A key for each prefix of a path, the root's first."""
    state, keys = hashlib.blake2b(digest_size=DIGEST), []
    keys.append(state.digest())
    for i in range(0, len(path), DIGEST):
        state.update(path[i : i + DIGEST])
        keys.append(state.digest())
    return keys


def fold(block: Block, whole: bool, keyed: bool) -> tuple[pa.RecordBatch, list[dict]]:
    """Nodes that end in this block, and the paths of its first and last row with the parts of the others.

    ``whole``: there is no other block. ``keyed``: earlier blocks refer to these nodes as parents.
    """
    lens = np.fromiter(map(len, block.paths), np.int64, len(block)) // DIGEST
    depth = int(lens.max())
    matrix = turn_ids(block.paths, depth)
    order = np.lexsort(matrix.T[::-1]) if depth else np.arange(len(block))
    matrix, lens = matrix[order], lens[order]
    paths = [block.paths[i] for i in order]
    chars = _padded(block.chars, depth, 0)[order]
    sums = {x: _padded(block.sums[x], depth + 1, NO_MEMBER if x == "least" else 0)[order] for x in SUMS}
    ends = [block.ends[i] for i in order]

    begins = np.zeros((len(lens), depth + 1), bool)
    begins[0] = True
    begins[1:, 1:] = matrix[1:] != matrix[:-1]
    np.logical_or.accumulate(begins, axis=1, out=begins)

    leaf, saved = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)  # of nodes that begin in a row
    child = np.zeros(len(lens), np.int64)
    levels: list[dict] = [{}] * (depth + 1)
    for d in range(depth, -1, -1):
        rows = np.flatnonzero(lens >= d)
        at = np.flatnonzero(begins[rows, d])
        start = rows[at]
        ready = np.ones(len(at), bool)
        if not whole:
            ready[0] &= lens[0] < d
            ready[-1] &= lens[-1] < d
        n = np.add.reduceat(sums["n"][rows, d], at)
        children = np.add.reduceat(sums["children"][rows, d] + child[rows], at)
        own_leaf = ready & (children == 0)
        own_saved = np.where(ready, (n - 1) * chars[start, d - 1], 0) if d else np.zeros(1, np.int64)
        leaf[start] += own_leaf
        saved[start] += own_saved
        ended = [None] * len(at)
        segment = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(rows))))
        for i, s in zip(rows.tolist(), segment.tolist(), strict=True):
            if ends[i][d] is not None:
                ended[s] = ends[i][d]
        levels[d] = {
            "start": start,
            "ready": ready,
            "n": n,
            "least": np.minimum.reduceat(sums["least"][rows, d], at),
            "children": children,
            "leaves": np.add.reduceat(sums["leaves"][rows, d] + leaf[rows], at),
            "saved": np.add.reduceat(sums["saved"][rows, d] + saved[rows], at),
            "end": ended,
        }
        child[:] = 0
        child[start[ready]] = 1

    first_keys, last_keys = prefix_keys(paths[0]), prefix_keys(paths[-1])
    row_keys = [prefix_keys(p) for p in paths] if keyed else None
    block_id = int.from_bytes(hashlib.blake2b(paths[0], digest_size=8).digest(), "big", signed=True)
    out: dict[str, list] = {x.split()[0]: [] for x in _NODES.split(", ")}
    for d, level in enumerate(levels):
        take = np.flatnonzero(level["ready"])
        start = level["start"][take]
        out["block"] += [block_id] * len(take)
        out["depth"] += [d] * len(take)
        for name, key in (("conv_id", "least"), ("n_convs", "n"), ("n_children", "children"), ("n_leaves", "leaves"), ("saved_tokens", "saved")):
            out[name] += level[key][take].tolist()
        out["ends"] += [level["end"][i] for i in take.tolist()]
        out["node_key"] += [row_keys[i][d] for i in start.tolist()] if keyed else [None] * len(take)
        if d == 0:
            out["parent_conv_id"] += [None] * len(take)
            out["parent_key"] += [None] * len(take)
            continue
        above = levels[d - 1]
        parent = np.searchsorted(above["start"], start, "right") - 1
        for p in parent.tolist():
            known = bool(above["ready"][p])
            out["parent_conv_id"].append(int(above["least"][p]) if known else None)
            if known:
                out["parent_key"].append(None)
            else:
                out["parent_key"].append((first_keys if p == 0 and lens[0] >= d - 1 else last_keys)[d - 1])
    nodes = pa.RecordBatch.from_pydict(out, pa.schema([(k, _ARROW[k]) for k in out]))

    edges = []
    for row, place in ((0, 0), (len(lens) - 1, -1))[: 0 if whole else min(len(lens), 2)]:
        edge = {"path": paths[row], "chars": chars[row, : lens[row]].tolist(), **{x: [] for x in (*SUMS, "end")}}
        for d in range(int(lens[row]) + 1):
            level = levels[d]
            mine = not row or level["start"][-1] != 0  # a node on both paths brings its parts once
            for x in SUMS:
                edge[x].append(int(level[x][place]) if mine else NO_MEMBER if x == "least" else 0)
            edge["end"].append(level["end"][place] if mine else None)
        edges.append(edge)
    return nodes, edges


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
_TYPES |= {f"array<{k}>": pa.list_(v) for k, v in _TYPES.items()}
_ARROW = {name: _TYPES[kind] for name, kind in (x.split() for x in f"{_NODES}, {_PATHS}".split(", "))}


def _out(nodes: pa.RecordBatch | None, edges: list[dict]) -> Iterator[pa.RecordBatch]:
    names = list(_ARROW)
    if nodes is not None and len(nodes):
        held = dict(zip(nodes.schema.names, nodes.columns, strict=True))
        yield pa.RecordBatch.from_arrays([held.get(x, pa.nulls(len(nodes), _ARROW[x])) for x in names], names)
    if edges:
        yield pa.RecordBatch.from_arrays([pa.array([e.get(x) for e in edges], _ARROW[x]) for x in names], names)


def _leaf_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Distinct sequences: every depth has all their members, the last one their hash."""
    for path, chars, conv, n, end in zip(
        *(batch.column(c).to_pylist() for c in ("path", "chars", "conv_id", "members", "ends")), strict=True
    ):
        size = len(path) // DIGEST + 1
        none = [0] * size
        yield path, chars, ([n] * size, [conv] * size, none, none, none), [None] * (size - 1) + [end]


def _path_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    columns = [batch.column(c).to_pylist() for c in ("path", "chars", *SUMS, "end")]
    for path, chars, *sums, end in zip(*columns, strict=True):
        yield path, chars, tuple(sums), end


def _folded(batches: Iterator[pa.RecordBatch], first: bool, only: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive rows, folded one after the other. ``only``: this task has all rows of the level."""
    block, widest, done = Block([], [], {x: [] for x in SUMS}, []), 0, 0
    for batch in batches:
        for path, chars, sums, end in _leaf_rows(batch) if first else _path_rows(batch):
            size = max(widest, len(end))
            if len(block) >= LEAST_ROWS and (len(block) + 1) * size > CELLS:
                yield from _out(*fold(block, False, not first))
                block, size, done = Block([], [], {x: [] for x in SUMS}, []), len(end), done + 1
            widest = size
            block.paths.append(path)
            block.chars.append(chars)
            block.ends.append(end)
            for name, values in zip(SUMS, sums, strict=True):
                block.sums[name].append(values)
    if len(block):
        yield from _out(*fold(block, only and not done, not first))


def prefix_trie(chats: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node.

    Conversations are rebuilt with their family's opening first (``rebuilt``). Turns follow by number, null
    first; equal numbers by role, then by the MD5 of role and text; repeated rows are repeated turns. Null role
    and text are empty. Rows without conv_id belong to no conversation. Turns are told apart by a 128-bit
    digest. An empty table has no nodes. Extra columns are ignored.
    """
    spark = chats.sparkSession
    turns = frames.stored(sequences(chats), "trie-turns")
    whole = frames.stored(rebuilt(turns), "trie-rebuilt")
    rows = frames.stored(distinct_sequences(whole), "trie-sequences")
    schema, parts, shards, first = f"{_NODES}, {_PATHS}", [], frames.width(spark), True
    while True:
        ordered = (rows.repartitionByRange(shards, "path") if shards > 1 else rows.coalesce(1)).sortWithinPartitions("path")
        level = frames.stored(
            ordered.mapInArrow(lambda b, f=first, o=shards == 1: _folded(b, f, o), schema), "trie-level"
        )
        parts.append(level.filter("path is null"))
        rows = level.filter("path is not null")
        left = rows.count()
        if not left:
            break
        shards, first = max(1, min(frames.width(spark), left // SHARD_PATHS)), False
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    return _with_parents(nodes, parts[1:])


def _with_parents(nodes: DataFrame, later: list[DataFrame]) -> DataFrame:
    """Fill in parents that were on a block's boundary, by (block, parent): no block has more rows than its cells."""
    open_ = nodes.filter("parent_key is not null").select("block", "parent_key").distinct()
    out = nodes
    if later:
        known = later[0]
        for part in later[1:]:
            known = known.unionByName(part)
        known = known.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("found"))
        found = frames.stored(open_.join(known, "parent_key"), "trie-parents")
        out = nodes.join(found, ["block", "parent_key"], "left")
    else:
        out = nodes.withColumn("found", F.lit(None).cast("long"))
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    ).withColumn("depth", F.col("depth").cast("long"))
