"""Hard-negative mining with an STR-packed R-tree (operator 13).

Rows are boxed over their label and their integer components. Shards are ranges of (label, widest component, id);
inside a shard sort-tile-recursive packing cuts the rows into leaves, component after component, and runs of
boxes into the boxes above. For an anchor a box gives an interval of inner products, summed from the interval of
each component; a queue opens boxes by the greatest score they may hold and drops those outside the wanted
labels and scores, or strictly below the kth best so far (ties are settled by id, so equal ones are opened).
Anchors are a stated share of the rows; they meet the shards in blocks, so no task has more than one shard and
one block. Bounds and scores are exact: whole numbers in doubles below 2**53, else Python integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import frames

#: Rows of a shard, of a leaf, and boxes per box above; anchors of a block.
SHARD_ROWS, LEAST_SHARD, LEAF, FANOUT, BLOCK = 16_384, 2_048, 96, 12, 4_096
SCALE = 256
#: Positives per anchor, negatives per positive, and the window of scores in percent of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Greatest whole-number component: products of up to 512 of them fit a long.
MOST = 1 << 27


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec): usable rows with whole-number components and the contract's labels."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = lambda x: F.least(F.greatest(F.lit(float(SCALE)) * x.cast("double"), F.lit(-float(MOST))), F.lit(float(MOST)))
    whole = F.transform("embedding", lambda x: F.floor(held(x)).cast("long"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable)
    one = kept.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct(label.cast("int").alias("label"), whole.alias("vec"))).alias("row")
    )
    return one.select("vec_id", "row.label", "row.vec")


# --- packing ------------------------------------------------------------------------------------


def tiles(points: np.ndarray, rows: np.ndarray, leaf: int, axes: list[int]) -> Iterator[np.ndarray]:
    """Sort-tile-recursive: rows in slabs along the first axis, those in slabs along the next, down to leaves."""
    if len(rows) <= leaf:
        yield rows
        return
    count = -(-len(rows) // leaf)
    slabs = count if len(axes) == 1 else max(2, int(np.ceil(count ** (1 / min(len(axes), 4)))))
    order = rows[np.argsort(points[rows, axes[0]], kind="stable")]
    size = -(-count // slabs) * leaf
    for at in range(0, len(order), size):
        yield from tiles(points, order[at : at + size], leaf, axes[1:] or axes)


def _packed(batches: Iterator[pa.RecordBatch], width: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """The leaves of this partition's shard, in packing order."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
    vecs = table["vec"].combine_chunks()
    lens = np.diff(vecs.offsets.to_numpy())
    points = np.zeros((len(ids), width), np.int64)
    points[np.arange(width) < lens[:, None]] = vecs.flatten().to_numpy()
    boxed = np.concatenate([labels[:, None].astype(float), points], axis=1)
    axes = [0, *(1 + np.argsort(-points.std(axis=0), kind="stable")).tolist()]
    shard, out = TaskContext.get().partitionId(), []
    for label in np.unique(labels):  # the label is the first axis, and its slabs are its values
        mine = np.flatnonzero(labels == label)
        out += list(tiles(boxed, mine, leaf, axes[1:] or axes))
    for at in range(0, len(out), 64):
        some = out[at : at + 64]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(some), pa.int32()),
                pa.array(range(at, at + len(some)), pa.int32()),
                pa.array([ids[r] for r in some], pa.list_(pa.int64())),
                pa.array([labels[r] for r in some], pa.list_(pa.int32())),
                pa.array([points[r].ravel() for r in some], pa.list_(pa.int64())),
            ],
            ["shard", "leaf", "ids", "labels", "vecs"],
        )


def pack(items: DataFrame, rows: int, width: int, leaf: int = LEAF) -> DataFrame:
    """(shard, leaf, ids, labels, vecs): the leaves of the tree; a shard is a range of (label, component, id)."""
    spread = items.select(F.posexplode("vec").alias("axis", "x")).groupBy("axis").agg(F.var_pop("x").alias("v"))
    widest = spread.orderBy(F.desc("v"), "axis").first()
    first = F.get("vec", F.lit(widest.axis if widest else 0))
    spark = items.sparkSession
    shards = max(-(-rows // SHARD_ROWS), min(frames.width(spark), -(-rows // LEAST_SHARD)), 1)
    keyed = items.withColumn("first", first).repartitionByRange(shards, "label", "first", "vec_id")
    leaves = keyed.sortWithinPartitions("label", "first", "vec_id").select("vec_id", "label", "vec")
    schema = "shard int, leaf int, ids array<long>, labels array<int>, vecs array<long>"
    return frames.stored(leaves.mapInArrow(lambda b: _packed(b, width, leaf), schema), "rtree-leaves")


class Tree:
    """The tree of one shard: leaves as stored, boxes above them from runs of FANOUT boxes."""

    def __init__(self, leaves: pa.Table, width: int, exact: bool) -> None:
        leaves = leaves.sort_by("leaf")
        kind = float if exact else object
        self.ids = [x.values.to_numpy() for x in leaves["ids"]]
        self.labels = [x.values.to_numpy() for x in leaves["labels"]]
        self.rows = [x.values.to_numpy().reshape(-1, width).astype(kind) for x in leaves["vecs"]]
        lo, hi = [r.min(axis=0) for r in self.rows], [r.max(axis=0) for r in self.rows]
        first, last = [int(x.min()) for x in self.labels], [int(x.max()) for x in self.labels]
        self.children: list[range | None] = [None] * len(lo)  # None: a leaf
        begin, end = 0, len(lo)
        while end - begin > 1:
            for at in range(begin, end, FANOUT):
                run = range(at, min(at + FANOUT, end))
                self.children.append(run)
                lo.append(np.minimum.reduce(lo[run.start : run.stop]))
                hi.append(np.maximum.reduce(hi[run.start : run.stop]))
                first.append(min(first[run.start : run.stop]))
                last.append(max(last[run.start : run.stop]))
            begin, end = end, len(lo)
        self.lo, self.hi, self.first, self.last = np.array(lo, kind).T, np.array(hi, kind).T, first, last
        self.root = len(lo) - 1

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with any point of each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.lo + down @ self.hi, up @ self.hi + down @ self.lo


class Best:
    """The first k rows of one score window, by score downwards, then id."""

    def __init__(self, k: int, low: int | None, high: int | None) -> None:
        self.k, self.low, self.high, self.rows = k, low, high, []

    @property
    def need(self) -> float | int:
        """Scores below this one cannot enter any more."""
        if len(self.rows) == self.k:
            return -self.rows[-1][0]
        return -np.inf if self.low is None else self.low

    def reach(self, least: float, most: float) -> float | None:
        """The greatest score that a box may bring; None if it can bring nothing."""
        if most < self.need or (self.high is not None and least > self.high):
            return None
        return most if self.high is None else min(most, self.high)

    def offer(self, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        fits = fits & (scores >= self.need)
        if self.high is not None:
            fits = fits & (scores <= self.high)
        at = np.flatnonzero(fits)
        if not len(at):
            return
        if len(at) > self.k:
            at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
        self.rows = sorted([*self.rows, *((-int(scores[i]), int(ids[i])) for i in at)])[: self.k]


def search(tree: Tree, anchor: np.ndarray, least: list, most: list, same: int | None, other: int | None, own: int, wanted: list[Best]) -> None:
    """Fill ``wanted`` from rows labelled ``same``, or from those not labelled ``other``, without the row ``own``."""

    def reach(box: int) -> float | None:
        if same is not None and not tree.first[box] <= same <= tree.last[box]:
            return None
        if other is not None and tree.first[box] == tree.last[box] == other:
            return None
        found = [r for b in wanted if (r := b.reach(least[box], most[box])) is not None]
        return max(found) if found else None

    top = reach(tree.root)
    queue = [] if top is None else [(-top, tree.root)]
    while queue:
        _, box = heapq.heappop(queue)
        if reach(box) is None:  # the kth best has risen since
            continue
        inside = tree.children[box]
        if inside is not None:
            for child in inside:
                r = reach(child)
                if r is not None:
                    heapq.heappush(queue, (-r, child))
            continue
        scores, labels, ids = tree.rows[box] @ anchor, tree.labels[box], tree.ids[box]
        fits = (labels == same if same is not None else labels != other) & (ids != own)
        for best in wanted:
            best.offer(scores, ids, fits)


# --- the two searches ---------------------------------------------------------------------------


def _blocks(anchors: DataFrame, leaves: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Anchors dealt to every shard, leaves to every block of anchors."""
    blocks = max(1, -(-count // BLOCK))
    shards = (leaves.agg(F.max("shard")).first()[0] or 0) + 1
    dealt = anchors.withColumn("block", F.pmod(F.hash("anchor_id"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    return dealt, leaves.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def _matrix(lists: pa.ChunkedArray, width: int, exact: bool) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x.values)] = x.values.to_numpy()
    return out.astype(float if exact else object)


def _positives(leaves: pa.Table, anchors: pa.Table, width: int, exact: bool, k: int) -> pa.Table:
    out: list[tuple] = []
    if len(leaves) and len(anchors):
        tree, points = Tree(leaves, width, exact), _matrix(anchors["vec"], width, exact)
        least, most = tree.bounds(points)
        for i, (own, label) in enumerate(zip(anchors["anchor_id"].to_pylist(), anchors["label"].to_pylist(), strict=True)):
            best = Best(k, None, None)
            search(tree, points[i], least[i].tolist(), most[i].tolist(), label, None, own, [best])
            out += [(own, found, -score) for score, found in best.rows]
    columns = zip(*out, strict=True) if out else [[]] * 3
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "found_id", "score"])


def _negatives(leaves: pa.Table, anchors: pa.Table, width: int, exact: bool, k: int, low: int, high: int) -> pa.Table:
    out: list[tuple] = []
    if len(leaves) and len(anchors):
        tree, points = Tree(leaves, width, exact), _matrix(anchors["vec"], width, exact)
        least, most = tree.bounds(points)
        held = (anchors[c].to_pylist() for c in ("anchor_id", "label", "positives"))
        for i, (own, label, positives) in enumerate(zip(*held, strict=True)):
            # low * p <= 100 * n <= high * p, in whole numbers
            wanted = [Best(k, -(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
            search(tree, points[i], least[i].tolist(), most[i].tolist(), None, label, own, [b for b in wanted if b.low <= b.high])
            for p, best in zip(positives, wanted, strict=True):
                out += [(own, p["found_id"], p["score"], found, -score) for score, found in best.rows]
    columns = zip(*out, strict=True) if out else [[]] * 5
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def _first(rows: DataFrame, keys: list[str], score: str, by_id: str, k: int) -> DataFrame:
    """The first k rows of each key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), by_id)
    return rows.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor``: a condition on vec_id, by default divisible by 100. Rows with a null id, label or vector, or
    a null or non-finite component take no part. Rows of one vec_id are one row, the one of smallest label, then
    vector. Missing components of shorter vectors are 0. Anchors without positives, and positives without a
    negative in their window, have no rows; a negative score leaves an empty window. Whole-number components are
    held within 2**27, so that scores fit a long. An empty table has no rows. Extra columns are ignored.
    """
    is_anchor = F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor
    items = frames.stored(vectors(rows), "rtree-items")
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))
    total = items.agg(
        F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("vec")).alias("width"), F.max(largest).alias("most")
    ).first()
    width, most = max(total.width or 0, 1), total.most or 0.0
    exact = width * most * most < 2.0**53
    leaves = pack(items, total.n, width)
    anchors = items.filter(is_anchor).withColumnRenamed("vec_id", "anchor_id")
    dealt, spread = _blocks(anchors, leaves, total.anchors)
    keys = ("shard", "block")
    found = spread.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
        lambda a, b: _positives(a, b, width, exact, POSITIVES), "anchor_id long, found_id long, score long"
    )
    first = _first(found, ["anchor_id"], "score", "found_id", POSITIVES)
    chosen = first.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "found_id", "score"))).alias("positives"))
    anchors = frames.stored(anchors.join(chosen, "anchor_id"), "rtree-positives")
    dealt, spread = _blocks(anchors, leaves, total.anchors)
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = spread.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
        lambda a, b: _negatives(a, b, width, exact, NEGATIVES, LOW, HIGH), schema
    )
    best = _first(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", NEGATIVES)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
