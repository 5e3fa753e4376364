"""Similarity join on word shingles by chosen paths (operator 4).

Two texts are linked when the Jaccard similarity of their sets of five-word shingles is 0.8 or more.

* Texts with equal sets are one *representative*, the smallest document id among them.
* A set is embedded as ``COORDS`` minimum hashes. A run starts with all sets in one bucket; in a bucket
  (a path) each coordinate is chosen with probability 1 / (LAMBDA * COORDS) by a hash of the path, and the
  bucket is split on the values of each chosen coordinate. Splitting goes on while a bucket holds more than
  ``LEAF`` sets, for at most ``DEPTH`` levels. A *dense* bucket, which kept ``LAMBDA`` of the sets above it, is
  a leaf at any size: its sets are alike on average, so splitting repeats the same pairs on more paths.
  Of a bucket that is split, the ball around a pivot is settled first: its sets, and all that could be linked to
  them, join the pivot's candidate cluster, and only sets outside the ball are split further.
  ``runs_for`` gives the runs that reach the target recall; deeper splitting needs more, so runs are added
  until they are enough for the deepest level used, with the sets that were split below two levels.
* A leaf compares its sketches by brute force and leaves a star for each group it finds; a leaf too large
  for one task is compared block by block.
* Stars are joined to candidate clusters. Inside a cluster *all* pairs are compared exactly, again block
  by block, so a link is found if any chain of candidates joins its ends. Links are counted, not listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames, words

SHINGLE = 5
LAMBDA = 0.8
COORDS = 32
#: Sets in a bucket that are compared by brute force in one task.
LEAF = 512
DEPTH = 6
TARGET_RECALL = 0.999
#: Equal coordinates that make two sets candidates: a pair at 0.8 has fewer once in 10**5 pairs.
ALIKE = 16
#: Coordinates that a set shares with the pivot of its bucket to be in its ball, and to be joined to it: by the
#: triangle inequality what is alike to a set in the ball shares JOINED with the pivot.
BALL = 24
JOINED = BALL + ALIKE - COORDS
#: Rows of small groups that one task compares, group after group.
SHARD_ROWS = 20_000
_EMPTY = -1


def runs_for(target: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met in a leaf with probability ``target``.

    A pair survives a level with probability 1 - exp(-q) if it survives what lies below with q.
    """
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - target) / math.log(1 - q))


# --- sets and sketches ------------------------------------------------------------------------


def _multipliers() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, COORDS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(found: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of consecutive documents, sorted and distinct in each, and their bounds.

    A text of one to four words has one shingle, all of it; a text without words has none.
    """
    counts, owner = found.counts, found.owners()
    hashes = words.grams(found.hashes, SHINGLE)
    inside = np.flatnonzero(np.arange(len(hashes)) + SHINGLE <= found.bounds[owner[: len(hashes)] + 1])
    docs, values = owner[inside], hashes[inside]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        tails = [words.grams(found.hashes[found.bounds[d] : found.bounds[d + 1]], counts[d])[:1] for d in short]
        docs, values = np.append(docs, short), np.append(values, words.mix(np.concatenate(tails) + np.uint64(1)))
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    docs, values = docs[fresh], values[fresh]
    return values, np.searchsorted(docs, np.arange(len(counts) + 1))


def _digests(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 63-bit digest of each set, ``_EMPTY`` for the empty one."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.full(len(bounds) - 1, _EMPTY, np.int64)
    if len(full):
        out[full] = (words.mix(np.add.reduceat(words.mix(values), bounds[full])) >> np.uint64(1)).astype(np.int64)
    return out


@words.frugal
def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors = _multipliers()
    for batch in batches:
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            values, bounds = shingle_sets(words.split(data, offsets))
            full = np.flatnonzero(np.diff(bounds))
            least = np.zeros((end - begin, COORDS), np.int32)
            if len(full):
                for k, factor in enumerate(factors):
                    smallest = np.minimum.reduceat(values * factor, bounds[full])
                    least[full, k] = (words.mix(smallest) >> np.uint64(33)).astype(np.int32)
            flat = pa.array(least.ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[begin:end],
                    pa.array(_digests(values, bounds)),
                    pa.ListArray.from_arrays(pa.array(np.arange(end - begin + 1, dtype=np.int32) * COORDS), flat),
                ],
                ["doc_id", "digest", "sketch"],
            )


# --- splitting along chosen paths -------------------------------------------------------------


def _at_root(runs: int) -> list[tuple[int, int]]:
    """(run, coordinate) chosen in the first bucket, the same for every set."""
    draws = np.random.Generator(np.random.PCG64(11)).random((runs, COORDS)) < 1 / (LAMBDA * COORDS)
    return [(int(run), int(k)) for run, k in np.argwhere(draws)]


def _chosen() -> F.Column:
    """New paths of a row: one for each coordinate that its present path chooses."""
    bar = int(2**32 / (LAMBDA * COORDS))
    picked = F.filter(
        F.sequence(F.lit(0), F.lit(COORDS - 1)), lambda i: F.pmod(F.xxhash64("path", i), F.lit(2**32)) < bar
    )
    return F.transform(picked, lambda i: F.xxhash64("path", i, F.element_at("sketch", i + 1)))


def _leaves(sets: DataFrame, runs: int) -> DataFrame:
    """(path, id, n, pivot): the buckets of all runs that hold two sets or more."""
    return _split(sets, 0, runs)[0]


def _leaves_for(sets: DataFrame, target: float) -> DataFrame:
    """(path, id, n, pivot): the buckets of as many runs as the deepest level they use asks for.

    Two levels are what the first runs allow for. More runs are owed only to pairs that some run could part
    below them, and both ends of such a pair were split there: so those sets alone take part in them.
    """
    leaves, runs, deepest = None, 0, 2
    while (wanted := runs_for(target, deepest)) > runs:
        more, levels, deep = _split(sets, runs, wanted)
        leaves = more if leaves is None else leaves.unionByName(more)
        runs, deepest = wanted, max(deepest, levels)
        if deep is None:
            break
        sets = frames.stored(sets.join(deep.distinct(), "id", "left_semi"), "deep-sets")
    return leaves


def _equal(a: str, b: str) -> F.Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _around_pivots(rows: DataFrame, size: int) -> DataFrame:
    """Rows (path, id, above, sketch), ``size`` at most, with their bucket's pivot and the coordinates they share with it.

    Sketches differ by a metric, the number of unequal coordinates. A set with ``BALL`` coordinates of the pivot
    or more, and one that is alike to it (``ALIKE``), differ from the pivot by at most so many that the latter
    shares ``JOINED`` with it. So when all sets that share ``JOINED`` are joined to the pivot, no link of a set
    in the ball is lost, and the ball need not be split.
    """
    pivots = rows.groupBy("path").agg(F.min(F.struct("id", "sketch")).alias("p"))
    pivots = frames.stored(pivots.select("path", F.col("p.id").alias("pivot"), F.col("p.sketch").alias("centre")), "pivots", size)
    return rows.join(frames.small(pivots), "path").withColumn("shared", _equal("sketch", "centre")).drop("centre")


def _split(sets: DataFrame, begin: int, end: int) -> tuple[DataFrame, int, DataFrame | None]:
    """(path, id, n, pivot): the buckets of the runs from ``begin`` to ``end``: leaves, without pivot, and what
    is joined to a pivot; the levels of splitting; the ids that were split below two levels."""
    first = [F.xxhash64(F.lit(run), F.lit(k), F.col("sketch")[k]) for run, k in _at_root(end) if run >= begin]
    none = F.lit(None).cast("long").alias("pivot")
    if not first:
        return sets.select(F.lit(0).cast("long").alias("path"), "id", F.lit(0).cast("long").alias("n"), none).limit(0), 0, None
    held = sets.count()
    size = held * len(first)  # what a level begins with; the next ones have as many in the mean, or fewer
    rows = sets.select("id", F.lit(held).alias("above"), F.explode(F.array(*first)).alias("path"))
    done, deep = None, None
    for level in range(DEPTH):
        rows = frames.stored(rows, "paths", size)
        held = rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        rows = frames.stored(rows.join(held, "path"), "buckets", size)
        last = level + 1 == DEPTH
        ends = F.lit(last) | (F.col("n") <= LEAF) | (F.col("n") >= LAMBDA * F.col("above"))
        leaf = rows.filter(ends).select("path", "id", "n", none)
        done = leaf if done is None else done.unionByName(leaf)
        rows = rows.filter(~ends)
        if last or rows.isEmpty():
            return done, level + 1, deep
        rows = rows.select("id", "path", F.col("n").alias("above")).join(sets.select("id", "sketch"), "id")
        rows = frames.stored(_around_pivots(rows, size), "around", size)
        joined = F.xxhash64(F.col("path"), F.lit("pivot")).alias("path")
        near = rows.filter(F.col("shared") >= JOINED).select(joined, "id", F.col("above").alias("n"), "pivot")
        done = done.unionByName(near)
        rows = rows.filter(F.col("shared") < BALL)
        if level >= 1:
            more = rows.select("id")
            deep = more if deep is None else deep.unionByName(more)
        rows = rows.select("id", "above", F.explode(_chosen()).alias("path"))


def _in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Deal the rows of a key to all pairs of blocks of about ``size`` rows they belong to: adds i, j, block."""
    blocks = F.ceil(F.col("n") / size)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    rows = rows.withColumn("other", other)
    return rows.select(
        "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    ).drop("other")


def _dealt(rows: DataFrame, keys: list[str], rows_a_shard: int) -> DataFrame:
    """Groups of ``keys`` gathered to shards of many groups, by the counted rows."""
    rows = frames.stored(rows, "dealt")
    shards = max(1, -(-rows.count() // rows_a_shard))
    return rows.withColumn("shard", F.pmod(F.xxhash64(*keys), F.lit(shards))).groupBy("shard")


def _each(rows: pa.Table, keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a shard, one after the other."""
    if not rows.num_rows:
        return
    rows = rows.sort_by([(k, "ascending") for k in keys]).combine_chunks()
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for k in keys:
        value = rows[k].to_numpy()
        new[1:] |= value[1:] != value[:-1]
    at = np.append(np.flatnonzero(new), rows.num_rows)
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield rows.slice(a, b - a)


def _labels(linked: np.ndarray) -> np.ndarray:
    """Component of each row of a symmetric matrix of links: its smallest index."""
    label = np.arange(len(linked))
    while True:
        lowest = np.where(linked, label, len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, lowest)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


_STAR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@words.frugal
def _compare_sketches(shard: pa.Table) -> pa.Table:
    """Stars of the groups of like sketches in each bucket: id, smallest id of its group."""
    stars = []
    for rows in _each(shard, ["path", "i", "j"]):
        ids = rows["id"].to_numpy()
        flat = rows["sketch"].combine_chunks().flatten().to_numpy().reshape(len(ids), COORDS)
        alike = np.zeros((len(ids), len(ids)), np.int8)
        for k in range(COORDS):
            alike += flat[:, k, None] == flat[None, :, k]
        order = np.argsort(ids, kind="stable")
        label = ids[order][_labels((alike >= ALIKE)[np.ix_(order, order)])]
        moved = label != ids[order]
        if moved.any():
            stars.append(np.stack([ids[order][moved], label[moved]]))
    a, b = np.unique(np.concatenate(stars, axis=1), axis=1) if stars else np.zeros((2, 0), np.int64)
    return pa.Table.from_arrays([pa.array(a), pa.array(b)], schema=_STAR)


# --- connected components ---------------------------------------------------------------------


def components(edges: DataFrame, size: int | None = None) -> DataFrame:
    """(id, root): the smallest id of the component of every id in ``edges`` (a, b), a > b; about ``size`` at most.

    Every round points each id at the smallest neighbour of its neighbours, written out in between; a
    round is an aggregate with map-side combine and a join, whatever the size of a component.
    """
    edges = frames.stored(edges.distinct(), "edges", size)
    while True:
        down = edges.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("k"))
        inner = edges.join(down.select(F.col("a").alias("b")), "b", "left_semi")
        if down.filter("k > 1").isEmpty() and inner.isEmpty():
            return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
        # Neighbours below a, and a itself, all meet at a's smallest neighbour ...
        met = edges.join(down.select("a", "low"), "a").select(
            F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b")
        )
        met = frames.stored(met.filter("a > b").distinct(), "edges", size)
        # ... and neighbours above a are handed to the smallest of a's neighbourhood.
        low = met.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "b")
        handed = met.join(low, "b", "left").select("a", F.coalesce("low", "b").alias("b"))
        edges = frames.stored(handed.distinct(), "edges", size)


# --- exact comparison inside clusters ---------------------------------------------------------


@words.frugal
def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the texts whose digest is the id asked for."""
    for batch in batches:
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            values, bounds = shingle_sets(words.split(data, offsets))
            raw = values.astype("<u8").tobytes()
            asked = batch.column("id").to_numpy()[begin:end] == _digests(values, bounds)
            sets = [raw[8 * a : 8 * b] for a, b in zip(bounds[:-1][asked], bounds[1:][asked], strict=True)]
            kept = [batch.column(c)[begin:end].filter(pa.array(asked)) for c in ("id", "root", "n")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sets, pa.binary())], ["id", "root", "n", "shingles"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the given sets, by products of 0/1 matrices in column slices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    held = many[column] > 1
    owner, column = owner[held], np.unique(column[held], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, (1 << 22) // max(len(sets), 1))
    for left in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [left, left + width])
        part = np.zeros((len(sets), min(width, int(column[-1]) + 1 - left)), np.float32)
        part[owner[a:b], column[a:b] - left] = 1
        common += part @ part.T
    return common


_LINKS = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])


@words.frugal
def _exact_blocks(shard: pa.Table) -> pa.Table:
    """For each pair of blocks: link counts of the ids, and the smallest id that links join each to."""
    parts = [np.zeros((3, 0), np.int64)]
    for rows in _each(shard, ["root", "i", "j"]):
        rows = rows.sort_by("id")
        ids, block = rows["id"].to_numpy(), rows["block"].to_numpy()
        sets = [np.frombuffer(x, "<u8") for x in rows["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets], np.float64)
        common = overlaps(sets).astype(np.float64)
        linked = common * (1 + LAMBDA) >= LAMBDA * (sizes[:, None] + sizes[None, :]) - 1e-6
        np.fill_diagonal(linked, False)
        if rows["i"][0] != rows["j"][0]:
            linked &= block[:, None] != block[None, :]
        parts.append(np.stack([ids, linked.sum(axis=1), ids[_labels(linked)]]))
    return pa.Table.from_arrays([pa.array(x) for x in np.concatenate(parts, axis=1)], schema=_LINKS)


# --- the operator -----------------------------------------------------------------------------


def similarity_classes(docs: DataFrame, target: float = TARGET_RECALL) -> DataFrame:
    """(doc_id, rep_id, class_id, n_links) for each row of ``docs`` (doc_id, text).

    ``rep_id`` is the smallest id with an equal shingle set, ``class_id`` the smallest id of its connected
    component of links, ``n_links`` the representatives its own representative is linked to. Null, empty
    and blank texts have the empty set: they share one representative and link to nothing else. Rows with
    null doc_id keep a row of null ids. Rows that share a doc_id each bring their own text.
    """
    docs = docs.select("doc_id", "text")
    sets = frames.stored(
        docs.filter("doc_id is not null").mapInArrow(
            _sketches, "doc_id long, digest long, sketch array<int>"
        ),
        "sketches",
    )
    size = sets.count()
    reps = frames.stored(
        sets.groupBy("digest").agg(F.min("doc_id").alias("id")), "representatives", size
    )
    distinct = frames.stored(
        sets.filter(F.col("digest") != _EMPTY)
        .join(reps.withColumnRenamed("id", "doc_id"), ["digest", "doc_id"])
        .select(F.col("digest").alias("id"), "sketch")
        .dropDuplicates(["id"]),
        "sets",
        size,
    )
    buckets = _leaves_for(distinct, target)
    leaves = _in_blocks(buckets.filter("pivot is null").drop("pivot").join(distinct, "id"), LEAF)
    stars = _dealt(leaves, ["path", "i", "j"], SHARD_ROWS).applyInArrow(_compare_sketches, "a long, b long")
    around = buckets.filter("pivot < id").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    stars = stars.unionByName(around.distinct())
    roots = components(stars, size)
    roots = roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())
    clusters = frames.stored(
        roots.join(roots.groupBy("root").agg(F.count("*").alias("n")), "root")
        .join(reps.select(F.col("digest").alias("id"), F.col("id").alias("doc_id")), "id"),
        "clusters",
        size,
    )
    members = docs.join(frames.small(clusters), "doc_id").select("id", "root", "n", "text")
    exact = members.mapInArrow(_sets_of, "id long, root long, n long, shingles binary").dropDuplicates(["id"])
    blocks = _dealt(_in_blocks(exact, LEAF), ["root", "i", "j"], SHARD_ROWS // 4)
    found = frames.stored(blocks.applyInArrow(_exact_blocks, "id long, links long, low long"), "links")
    joined = components(found.filter("low < id").select(F.col("id").alias("a"), F.col("low").alias("b")), size)
    counted = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    numbered = (
        counted.join(joined, "id", "left")
        .select(F.col("id").alias("digest"), F.coalesce("root", "id").alias("root"), "n_links")
        .join(reps.withColumnRenamed("id", "rep_id"), "digest")
    )
    least = numbered.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    numbered = frames.stored(numbered.join(least, "root").select("digest", "class_id", "n_links"), "classes", size)
    by_set = reps.withColumnRenamed("id", "rep_id").join(numbered, "digest", "left")
    out = sets.select("doc_id", "digest").join(by_set, "digest").select(
        "doc_id",
        "rep_id",
        F.coalesce("class_id", "rep_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    null = F.lit(None).cast("long")
    none = docs.filter("doc_id is null").select(
        F.col("doc_id").cast("long"), null.alias("rep_id"), null.alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return out.unionByName(none)
