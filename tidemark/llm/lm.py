"""Scoring with a gated recurrent language model and corpus counts (operator 8).

Counts cover every training document. The most frequent words form the model's vocabulary; a GRU predicts
the next of them, or that another word follows, through a softmax factored into classes. Other words are
weighed by their corpus counts. The network is trained with truncated backpropagation in NumPy on the whole
texts of all training documents: they are dealt to shards of a set size by content, in each pass every shard
trains from the same weights, and their weights are averaged by the tokens they saw, in branches where there
are many. The output biases start from the counts of the corpus. In
training and in scoring the state is carried from window to window, so the whole text counts.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames, words

CLASSES, PER_CLASS = 32, 32
HIDDEN, EMBEDDED = 24, 16
STEPS = 16
#: Words whose counts every task knows; the rest are joined with the counts.
FREQUENT = 1 << 18
#: Passes over the training documents, and documents that a task trains on side by side.
PASSES, LANES = 3, 256
#: Ids of documents that wait for a lane.
HELD = 1 << 20
#: Training tokens of a shard, each the work of one task; documents of more tokens than LONG go first in it.
SHARD_TOKENS, LONG = 8_000_000, 2_048
#: Weights in one row of those that shards hand over, and shards that are averaged at once.
CHUNK, BRANCH = 1_024, 512
#: Columns that end each row of large arrays in memory: rows a power of two apart share their place in a cache.
SPARE = 16
#: Scores of a softmax that lie within this need no shift before they are exponents.
SAFE = 60
SMOOTH = 0.1
FOLDS = 10
END_WORD = np.int64(-1)  # hash of the end token; words with this hash would be taken for it
_END, _OTHER = 0, 1


def held_out(doc_ids: list[int | None]) -> np.ndarray:
    """Documents whose crc32(doc_id as text) is divisible by ``FOLDS``; a null id counts as empty text."""
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % FOLDS == 0 for d in doc_ids], bool)


# --- the network ------------------------------------------------------------------------------


class Gru:
    """GRU over word ids with a class-factored output; id = class * PER_CLASS + place in the class."""

    def __init__(self, counts: np.ndarray) -> None:
        """``counts``: corpus count of each id, zero for ids not in use."""
        draw = np.random.Generator(np.random.PCG64(3))
        size, h, e = CLASSES * PER_CLASS, HIDDEN, EMBEDDED
        normal = lambda *shape: (draw.standard_normal(shape) / math.sqrt(shape[-2])).astype(np.float32)
        weight = np.maximum(counts.reshape(CLASSES, PER_CLASS), 1e-6)
        self.p = {
            "emb": 0.3 * draw.standard_normal((size, e)).astype(np.float32),
            "wx": normal(e, 3 * h),
            "bx": np.zeros(3 * h, np.float32),
            "wh": normal(h, 3 * h),
            "wc": 0.1 * normal(h, CLASSES),
            "bc": np.log(weight.sum(1) / weight.sum()).astype(np.float32),
            "ww": 0.1 * normal(CLASSES, h, PER_CLASS),
            "bw": np.log(weight / weight.sum(1, keepdims=True)).astype(np.float32),
        }

    def inputs(self) -> np.ndarray:
        """What each id adds to the gates: ``emb @ wx + bx``, laid out feature by feature."""
        return (self.p["wx"].T @ self.p["emb"].T + self.p["bx"][:, None]).T

    def step(self, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """New state and what backpropagation needs, from rows of ``inputs()`` and the old state.

        Rows are views: in memory a feature of all lanes lies together, so that gates are whole blocks.
        """
        h, x, old = HIDDEN, inputs.T, state.T
        rec = self.p["wh"].T @ old
        gates = x[: 2 * h] + rec[: 2 * h]
        gates *= 0.5
        np.tanh(gates, out=gates)  # the logistic function is tanh of half its argument
        gates += 1
        gates *= 0.5
        reset, keep = gates[:h], gates[h:]
        fresh = reset * rec[2 * h :]
        fresh += x[2 * h :]
        np.tanh(fresh, out=fresh)
        new = old - fresh
        new *= keep
        new += fresh
        return new.T, reset.T, keep.T, fresh.T, rec[2 * h :].T

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """Memory of that name and shape that is kept from call to call; fresh pages cost more than the arithmetic."""
        held, size, kind = self.__dict__.setdefault("held", {}), math.prod(shape), self.p["wh"].dtype
        if name not in held or held[name].size < size or held[name].dtype != kind:
            held[name] = np.empty(size, kind)
        return held[name][:size].reshape(shape)

    def _joint(self) -> np.ndarray:
        """From state, embedding and 1 to the new state's recurrent part, the gates and its input part.

        The recurrent part and the first gate come out halved: the logistic function is tanh of half its argument,
        plus 1, halved, and the last halving of the first gate is left to what it multiplies.
        """
        p, h, e = self.p, HIDDEN, EMBEDDED
        joint = self._room("joint", h + e + 1, 4 * h)
        joint[:h, :h], joint[:h, h : 3 * h], joint[:h, 3 * h :] = p["wh"][:, 2 * h :], p["wh"][:, : 2 * h], 0
        joint[h:, :h], joint[h:-1, h:], joint[-1, h:] = 0, p["wx"], p["bx"]
        joint[:, : 2 * h] *= 0.5
        return joint

    def _heads(self) -> np.ndarray:
        """By class, from state and 1 to the scores of all classes and of the places in the class."""
        p, h = self.p, HIDDEN
        heads = self._room("heads", CLASSES, h + 1, CLASSES + PER_CLASS)
        heads[:, :h, :CLASSES], heads[:, h, :CLASSES] = p["wc"], p["bc"]
        heads[:, :h, CLASSES:], heads[:, h, CLASSES:] = p["ww"], p["bw"]
        return heads

    def _run(self, ids: np.ndarray, state: np.ndarray, joint: np.ndarray, learn: bool = False) -> tuple[np.ndarray, ...]:
        """By step: state, embedding and 1 before it; and what backpropagation multiplies by, if it is to ``learn``.

        That is what leads to the recurrent part, the gates and the fresh state, and the share of the state that is
        kept. A step's values lie together, a feature of all lanes after the other.
        """
        h, (steps, lanes) = HIDDEN, ids.shape
        met, held = self._room("met", steps + 1, h + EMBEDDED + 1, lanes), steps if learn else 1
        ways, keeps = self._room("ways", held, 4 * h, lanes), self._room("keeps", held, h, lanes)
        rec, fresh, part = (self._room(k, h, lanes) for k in ("rec", "fresh", "part"))
        table, ahead = np.ascontiguousarray(self.p["emb"].T), np.ascontiguousarray(joint.T)
        ahead[2 * h : 3 * h] *= 0.5
        to_rec, to_gates, to_fresh = ahead[:h, :h], ahead[h : 3 * h], ahead[3 * h :, h:]
        met[0, :h], met[:, -1] = state.T, 1
        for t in range(steps):
            now, new, way, keep = met[t], met[t + 1, :h], ways[t % held], keeps[t % held]
            np.take(table, ids[t], axis=1, out=now[h:-1], mode="clip")
            old, gates, reset = now[:h], way[: 2 * h], way[:h]
            np.dot(to_gates, now, out=gates)
            np.dot(to_rec, old, out=rec)
            np.dot(to_fresh, now[h:], out=fresh)
            np.tanh(gates, out=gates)
            gates += 1
            np.multiply(gates[h:], 0.5, out=keep)
            fresh += np.multiply(reset, rec, out=rec)
            np.tanh(fresh, out=fresh)
            np.subtract(old, fresh, out=new)
            new *= keep
            if learn:
                by_reset, by_keep, by_fresh = way[h : 2 * h], way[2 * h : 3 * h], way[3 * h :]
                np.subtract(1, keep, out=by_fresh)
                np.multiply(new, by_fresh, out=by_keep)
                np.subtract(1, np.multiply(fresh, fresh, out=part), out=part)
                by_fresh *= part
                np.subtract(2, reset, out=by_reset)
                by_reset *= rec
            new += fresh
        return met, ways, keeps

    def _after(self, met: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """States, and 1, after the chosen cells (step * lanes + lane) of a run, a row each."""
        steps, _, lanes = met.shape
        states = self._room("states", steps - 1, lanes, HIDDEN + 1)
        states[..., :HIDDEN], states[..., HIDDEN] = met[1:, :HIDDEN].transpose(0, 2, 1), 1
        return np.take(states.reshape(-1, HIDDEN + 1), rows, axis=0, out=self._room("after", len(rows), HIDDEN + 1), mode="clip")

    def _outputs(
        self, after: np.ndarray, targets: np.ndarray, heads: np.ndarray, by_head: np.ndarray | None = None, back: np.ndarray | None = None
    ) -> np.ndarray:
        """The log probability of each target, which are in order, after its row of ``after``.

        ``by_head`` takes the gradients of ``heads`` and ``back`` those of the states, if given. Scores of classes and
        then of places in the target's class are a row. Rows of a class are one slice.
        """
        n, width = len(targets), CLASSES + PER_CLASS
        at = np.searchsorted(targets, np.arange(0, CLASSES * PER_CLASS + 1, PER_CLASS)).tolist()
        slices = [(c, i, j) for c, (i, j) in enumerate(zip(at[:-1], at[1:], strict=True)) if i < j]
        both, sums = self._room("both", n, width), self._room("sums", width, 2)
        sums[:CLASSES], sums[CLASSES:] = (1, 0), (0, 1)
        for c, i, j in slices:
            np.dot(after[i:j], heads[c], out=both[i:j])
        halves, cells = both.reshape(n, 2, PER_CLASS), both.reshape(-1)
        if n and not -SAFE < both.min() <= both.max() < SAFE:
            halves -= halves.max(axis=2, keepdims=True)
        group, start = targets // PER_CLASS, np.arange(0, n * width, width)
        of_class = start + group
        start += CLASSES
        start += targets
        group *= PER_CLASS
        start -= group  # places
        logs = cells.take(of_class).astype(float)
        logs += cells.take(start)
        np.exp(both, out=both)
        total = both @ sums
        logs -= np.log(np.multiply(total[:, 0], total[:, 1], dtype=float))
        if by_head is not None:
            np.divide(1, total, out=total)
            halves *= total[:, :, None]
            for hits in (of_class, start):
                cells[hits] -= 1
            for c, i, j in slices:
                np.dot(both[i:j], heads[c, :HIDDEN].T, out=back[i:j])
                np.dot(after[i:j].T, both[i:j], out=by_head[c])
        return logs

    def log_probs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target after each state."""
        order = np.argsort(targets.astype(np.uint16), kind="stable")
        after = np.concatenate([states[order], np.ones((len(order), 1), states.dtype)], axis=1)
        out = np.empty(len(targets))
        out[order] = self._outputs(after, targets[order], self._heads())
        return out

    def gradients(self, ids: np.ndarray, targets: np.ndarray, live: np.ndarray, state: np.ndarray, flat: np.ndarray | None = None):
        """Loss and gradients over one window (steps, lanes), truncated at its start; and the last state.

        A lane that ends inside the window is dead from there on: nothing flows back from its dead steps, and
        its last state means nothing. ``flat`` takes the gradients, one after the other.
        """
        p, h, (steps, lanes) = self.p, HIDDEN, ids.shape
        flat = np.empty(sum(v.size for v in p.values()), p["wh"].dtype) if flat is None else flat
        grads, cut = {}, 0
        for k, v in p.items():
            grads[k], cut = flat[cut : cut + v.size].reshape(v.shape), cut + v.size
        joint, heads = self._joint(), self._heads()
        met, ways, keeps = self._run(ids, state, joint, learn=True)

        rows = np.flatnonzero(live)
        named = targets.ravel()[rows]
        order = np.argsort(named.astype(np.uint16), kind="stable")
        rows, named, n = rows[order], named[order], len(rows)
        after = self._after(met, rows)
        by_head, back = self._room("by_head", *heads.shape), self._room("back", n + 1, h)
        by_head[:] = 0
        logs = self._outputs(after, named, heads, by_head, back)
        back[n] = 0  # for dead steps
        grads["wc"][:], grads["bc"][:] = by_head[:, :h, :CLASSES].sum(axis=0), by_head[:, h, :CLASSES].sum(axis=0)
        grads["ww"][:], grads["bw"][:] = by_head[:, :h, CLASSES:], by_head[:, h, CLASSES:]
        column = np.full(live.size, n)
        column[rows] = np.arange(n)
        spread = np.take(back, column, axis=0, out=self._room("states", live.size, h), mode="clip").reshape(steps, lanes, h)

        ahead, part, by_joint = self._room("ahead", h, lanes), self._room("part", h, lanes), self._room("by_joint", steps, 4 * h, len(joint))
        by_id = self._room("by_id", EMBEDDED, live.size + SPARE)[:, : live.size].reshape(EMBEDDED, steps, lanes)
        to_state, to_id = joint[:h, : 3 * h], joint[h:-1, h:]
        ahead[:] = 0
        for t in reversed(range(steps)):
            way = ways[t]
            four = way.reshape(4, h, lanes)
            ahead += spread[t].T
            four[2:] *= ahead
            four[:2] *= four[3]
            ahead *= keeps[t]
            ahead += np.dot(to_state, way[: 3 * h], out=part)
            np.dot(way, met[t].T, out=by_joint[t])
            np.matmul(to_id, way[h:], out=by_id[:, t])
        by_joint = by_joint.sum(axis=0)
        by_joint[: 2 * h] *= 0.5
        grads["wh"][:, : 2 * h], grads["wh"][:, 2 * h :] = by_joint[h : 3 * h, :h].T, by_joint[:h, :h].T
        grads["wx"][:], grads["bx"][:] = by_joint[h:, h:-1].T, by_joint[h:, -1]
        before, by_emb = ids.ravel(), self._room("by_emb", EMBEDDED, len(p["emb"]))
        by_emb[:] = 0
        for into, values in zip(by_emb, by_id, strict=True):
            np.add.at(into, before, values.ravel())
        grads["emb"][:] = by_emb.T
        flat *= 1 / n
        return -logs.sum(), n, grads, met[steps, :h].T.copy()

    def train(self, texts: Iterator[np.ndarray], updates: float = 0, lanes: int = LANES, rate: float = 0.01) -> tuple[float, int, int]:
        """Adam over the windows of a stream of documents; ``updates`` were made before. Loss, tokens, updates.

        A window moves the weights by its share of the tokens of a full one.
        """
        weights = np.concatenate([v.ravel() for v in self.p.values()])
        cuts = np.cumsum([v.size for v in self.p.values()])[:-1]
        self.p = {k: x.reshape(v.shape) for (k, v), x in zip(self.p.items(), np.split(weights, cuts), strict=True)}  # views
        first, second, g = (np.zeros_like(weights) for _ in range(3))
        states, total, seen, n, full = np.zeros((lanes, HIDDEN), np.float32), 0.0, 0, 0, 1
        for lane, fresh, before, target, live in _windows(texts, lanes):
            state = np.where(fresh[:, None], np.float32(0), states[lane])
            loss, rows, _, states[lane] = self.gradients(before, target, live, state, g)
            total, seen, n, full = total + float(loss), seen + rows, n + 1, max(full, rows)
            length = math.sqrt(float(g @ g)) + 1e-9
            if length > 1:
                g *= 1 / length
            pace = rate * rows / full / math.sqrt(1 + (updates + n) / 300) / (1 - 0.9**n)
            root = math.sqrt((1 - 0.999**n) / 0.001)  # the moments are sums: 10 and 1000 times the averages
            first *= 0.9
            first += g
            g *= g
            second *= 0.999
            second += g
            np.sqrt(second, out=g)
            g += 1e-6 * root
            np.divide(first, g, out=g)
            g *= 0.1 * pace * root
            weights -= g
        return total, seen, n

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log probability of each document ids[bounds[k]:bounds[k+1]], none of them empty.

        Documents run side by side, those of like length together; the state of each goes on from window to window.
        """
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        scores, joint, heads = np.zeros(len(order)), self._joint(), self._heads()
        for docs in np.split(order, range(LANES, len(order), LANES)):
            size, state = sizes[docs], np.zeros((len(docs), HIDDEN), joint.dtype)
            for t in range(0, int(size.max(initial=0)), STEPS):
                n = int(np.searchsorted(-size, -t, "left"))  # documents longer than t
                steps = np.arange(t, min(t + STEPS, int(size[0])))[:, None]
                live, at = steps < size[:n], bounds[docs[:n]] + np.minimum(steps, size[:n] - 1)
                before = ids[at - 1]
                if not t:
                    before[0] = _END
                met = self._run(before, state[:n], joint)[0]
                state = met[-1, :HIDDEN].T.copy()
                rows, targets = np.flatnonzero(live), ids[at].ravel()
                rows = rows[np.argsort(targets[rows].astype(np.uint16), kind="stable")]
                logs = self._outputs(self._after(met, rows), targets[rows], heads)
                scores[docs[:n]] += np.bincount(rows % n, weights=logs, minlength=n)
        return scores


def _windows(texts: Iterator[np.ndarray], lanes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Lanes in use, which of them begin a document, and ids before, targets and presence by (step, lane).

    A lane goes through one document after the other, each of them from the begin of a window to its end.
    What lies beyond the end of a document is not present, whatever its ids. Documents are held in one array,
    those under way from the id before their place on, and some that wait.
    """
    texts = (t for t in texts if len(t))
    held, at, end = np.zeros(0, np.int64), np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    waiting = np.zeros((0, 2), np.int64)  # begin and end of each
    while True:
        free = np.flatnonzero(at >= end)
        if len(free) > len(waiting):
            more = _some(texts, len(free) - len(waiting), lanes)
            if more:
                busy = np.flatnonzero(at < end)
                parts = [held[a - 1 : b] for a, b in zip(at[busy], end[busy], strict=True)]
                parts += [held[a:b] for a, b in waiting] + more
                bounds = np.cumsum([0, *map(len, parts)])
                held = np.concatenate(parts)
                at[busy], end[busy] = bounds[: len(busy)] + 1, bounds[1 : len(busy) + 1]
                waiting = np.column_stack([bounds[:-1], bounds[1:]])[len(busy) :]
                at[free] = end[free] = 0
        free = free[: len(waiting)]
        at[free], end[free] = waiting[: len(free)].T
        waiting = waiting[len(free) :]
        lane = np.flatnonzero(at < end)
        if not len(lane):
            return
        steps = at[lane] + np.arange(STEPS)[:, None]
        live, steps = steps < end[lane], np.minimum(steps, end[lane] - 1)
        fresh = np.zeros(lanes, bool)
        fresh[free] = True
        fresh = fresh[lane]
        before = held[steps - 1]
        before[0, fresh] = _END
        at[lane] += STEPS
        yield lane, fresh, before, held[steps], live


def _some(texts: Iterator[np.ndarray], least: int, many: int) -> list[np.ndarray]:
    """The next ``least`` documents, and up to ``many`` more as long as all are below ``HELD`` ids."""
    got, size = [], 0
    for text in texts:
        got.append(text)
        size += len(text)
        if len(got) >= least and (size >= HELD or len(got) >= least + many):
            break
    return got


# --- counting ---------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the tokens of each batch's training documents."""
    for batch in batches:
        train = ~held_out(batch.column("doc_id").to_pylist())
        found = []
        for begin, end, data, offsets in words.chunks(batch.column("text")):
            chunk = words.split(data, offsets, lower=True)
            found.append(chunk.hashes[train[begin:end][chunk.owners()]].view(np.int64))
        tokens = np.concatenate(found) if found else np.zeros(0, np.int64)
        tokens, counts = np.unique(np.append(tokens, np.full(int(train.sum()), END_WORD)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(counts)], ["token", "c"])


def _slot(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of each token, in the order of tokens."""
    return (tokens >> (64 - bits)) + (1 << (bits - 1))


@dataclass
class Corpus:
    """What every task knows: frequent tokens by hash, their counts and model ids, totals, the network."""

    tokens: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    total: int
    distinct: int
    other_total: int
    other_distinct: int
    model: Gru | None = None

    @staticmethod
    def of(plain: dict) -> Corpus:
        model = Gru.__new__(Gru)
        model.p = plain["weights"]
        return Corpus(**{k: v for k, v in plain.items() if k != "weights"}, model=model)

    def look_up(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each token among the frequent ones, and whether it is one."""
        bits, first = self.slots
        last = len(self.tokens) - 1
        place = first[_slot(tokens, bits)]
        there = self.tokens[place]
        found = there == tokens
        left = np.flatnonzero(there < tokens)  # the token may be a later one of its slot
        for _ in range(8):
            place[left] = np.minimum(place[left] + 1, last)
            there = self.tokens[place[left]]
            found[left] = there == tokens[left]
            left = left[(there < tokens[left]) & (place[left] < last)]
            if not len(left):
                return place, found
        place[left] = np.minimum(np.searchsorted(self.tokens, tokens[left]), last)
        found[left] = self.tokens[place[left]] == tokens[left]
        return place, found

    @functools.cached_property
    def slots(self) -> tuple[int, np.ndarray]:
        """How many leading bits of a token tell its slot, and the index of the first token of each slot or after it."""
        bits = len(self.tokens).bit_length() + 2
        many = np.bincount(_slot(self.tokens, bits), minlength=1 << bits)
        return bits, np.minimum(np.cumsum(many) - many, len(self.tokens) - 1).astype(np.int32)

    @property
    def base_norm(self) -> float:
        return math.log10(self.total + SMOOTH * (self.distinct + 1))

    @property
    def other_norm(self) -> float:
        return math.log10(self.other_total + SMOOTH * (self.other_distinct + 1))


def _corpus(counts: DataFrame) -> Corpus:
    sizes = counts.groupBy(F.length(F.bin("c")).alias("bits")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    n, v, many, least = sum(r.n for r in sizes), sum(r.v for r in sizes), 0, 0
    for r in sorted(sizes, key=lambda r: -r.bits):  # counts below ``least`` need no sorting
        many, least = many + r.v, 1 << (r.bits - 1)
        if many >= FREQUENT:
            break
    frequent = counts.filter(F.col("c") >= least).orderBy(F.desc("c"), "token").limit(FREQUENT).toArrow()
    tokens, c = frequent["token"].to_numpy(), frequent["c"].to_numpy()
    size = CLASSES * PER_CLASS
    model_words = [k for k in np.lexsort((tokens, -c)) if tokens[k] != END_WORD][: size - 2]
    ids = np.full(len(tokens), _OTHER, np.int32)
    ids[model_words] = np.arange(2, 2 + len(model_words))
    ids[tokens == END_WORD] = _END
    known = ids != _OTHER
    order = np.argsort(tokens)
    distinct = v
    if not len(tokens):
        tokens, c, ids, order = np.array([END_WORD]), np.array([0]), np.array([_END], np.int32), np.array([0])
        known = np.array([True])
        v = 1  # so that the count of other words is not negative
    out = Corpus(
        tokens[order], c[order], ids[order], n, distinct, n - int(c[known].sum()), v - int(known.sum())
    )
    weights = np.zeros(size)
    np.add.at(weights, ids, c)
    weights[_OTHER] = out.other_total
    out.model = Gru(weights)
    return out


def _model_ids(corpus: Corpus, found: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Model ids of the documents with their end tokens, their bounds; and place and presence of the words."""
    place, frequent = corpus.look_up(found.hashes.view(np.int64))
    ids = np.full(len(place) + len(found.counts), _END, np.int32)
    ids[np.arange(len(place)) + found.owners()] = np.where(frequent, corpus.ids[place], _OTHER)
    return ids, found.bounds + np.arange(len(found.bounds)), place, frequent


# --- reading ----------------------------------------------------------------------------------

_READ = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_other long, counted double, other double, "
    "deal long, tokens array<long>, times array<int>, ids binary"
)


def _dealt(doc_ids: list[int | None], ids: list[bytes]) -> list[int]:
    """What deals documents to the shards of training: id, content, and a number for rows that repeat both."""
    seen: dict[tuple[int | None, int], int] = {}
    out = []
    for key in zip(doc_ids, map(zlib.crc32, ids), strict=True):
        seen[key] = seen.get(key, 0) + 1
        out.append(zlib.crc32(b"%d %d" % (key[0] or 0, seen[key])) << 31 ^ key[1])
    return out


def _read(batches: Iterator[pa.RecordBatch], corpus: Corpus) -> Iterator[pa.RecordBatch]:
    """Per document: its model ids, two bytes each, what the frequent tokens give, and the others with their numbers."""
    row = TaskContext.get().partitionId() << 33
    logs = np.log10(corpus.counts + SMOOTH)
    end_log = logs[corpus.tokens == END_WORD]
    end_log, end_known = (float(end_log[0]), int(corpus.counts[corpus.tokens == END_WORD][0] > 0)) if len(end_log) else (math.log10(SMOOTH), 0)
    for batch in batches:
        docs = batch.column("doc_id").to_pylist()
        parts: list[list[np.ndarray]] = [[] for _ in range(5)]
        raws, rare_tokens, rare_times, rare_sizes = [], [], [], []
        for _, _, data, offsets in words.chunks(batch.column("text")):
            found = words.split(data, offsets, lower=True)
            ids, bounds, place, frequent = _model_ids(corpus, found)
            owner, size = found.owners(), len(found.counts)
            raw = ids.astype("<u2").tobytes()
            raws += [raw[2 * a : 2 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            other = frequent & (corpus.ids[place] == _OTHER)
            add = lambda mark, weights=None: np.bincount(owner[mark], weights=weights, minlength=size)
            values = [
                np.diff(bounds), add(frequent), add(corpus.ids[place] == _OTHER) + add(~frequent & (corpus.ids[place] != _OTHER)),
                add(frequent, logs[place[frequent]]), add(other, logs[place[other]]),
            ]
            for kept, value in zip(parts, values, strict=True):
                kept.append(value)
            tokens, docs_of = found.hashes[~frequent].view(np.int64), owner[~frequent]
            order = np.lexsort((tokens, docs_of))
            tokens, docs_of = tokens[order], docs_of[order]
            fresh = np.ones(len(tokens), bool)
            fresh[1:] = (tokens[1:] != tokens[:-1]) | (docs_of[1:] != docs_of[:-1])
            rare_tokens.append(tokens[fresh])
            rare_times.append(np.diff(np.append(np.flatnonzero(fresh), len(tokens))))
            rare_sizes.append(np.bincount(docs_of[fresh], minlength=size))
        if not docs:
            continue
        n_tokens, n_known, n_other, counted, other = (np.concatenate(x) for x in parts)
        at = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(rare_sizes))]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row + np.arange(len(docs))),
                batch.column("doc_id"),
                pa.array(held_out(docs)),
                pa.array(n_tokens.astype(np.int64)),
                pa.array(n_known.astype(np.int64) + end_known),
                pa.array(n_other.astype(np.int64)),
                pa.array(counted + end_log),
                pa.array(other.astype(float)),
                pa.array(_dealt(docs, raws), pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(np.concatenate(rare_tokens))),
                pa.ListArray.from_arrays(at, pa.array(np.concatenate(rare_times).astype(np.int32))),
                pa.array(raws, pa.binary()),
            ],
            [x.split()[0] for x in _READ.split(", ")],
        )
        row += len(docs)


# --- training ---------------------------------------------------------------------------------

_PART = "chunk int, task int, tokens long, updates double, weights binary"


def _trained(batches: Iterator[pa.RecordBatch], weights: dict[str, np.ndarray], updates: float) -> Iterator[pa.RecordBatch]:
    """The weights after the documents of a shard, in rows of ``CHUNK``."""
    model = Gru.__new__(Gru)
    model.p = dict(weights)
    texts = (np.frombuffer(x.as_buffer(), "<u2").astype(np.int64) for batch in batches for x in batch.column("ids"))
    _, tokens, n = model.train(texts, updates)
    if not tokens:
        return
    raw = np.concatenate([model.p[k].ravel() for k in sorted(model.p)]).astype("<f4").tobytes()
    parts = [raw[k : k + 4 * CHUNK] for k in range(0, len(raw), 4 * CHUNK)]
    size, task = len(parts), TaskContext.get().partitionId()
    columns = [range(size), [task] * size, [tokens] * size, [float(n)] * size, parts]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _PART_SCHEMA, strict=True)], schema=_PART_SCHEMA
    )


_PART_SCHEMA = pa.schema(
    [("chunk", pa.int32()), ("task", pa.int32()), ("tokens", pa.int64()), ("updates", pa.float64()), ("weights", pa.binary())]
)


def _averaged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One chunk of weights, and the updates behind it, averaged over the tasks of a branch by their tokens."""
    chunk, branch = (k.as_py() for k in key)
    rows = rows.sort_by("task")  # the order of a sum shows in its last digits
    tokens = rows["tokens"].to_numpy()
    weights = np.stack([np.frombuffer(x, "<f4") for x in rows["weights"].to_pylist()])
    mean = np.average(weights, axis=0, weights=tokens.astype(float)).astype("<f4").tobytes()
    updates = float(np.average(rows["updates"].to_numpy(), weights=tokens.astype(float)))
    return pa.table([[chunk], [branch], [int(tokens.sum())], [updates], [mean]], schema=_PART_SCHEMA)


def _train(corpus: Corpus, read: DataFrame) -> None:
    """``PASSES`` passes, each from the average of the one before.

    Shards are dealt by content and of a set size, so that neither the number of tasks nor that of machines
    tells in the model. In a shard the longest documents go first, or a few lanes would be left with them.
    """
    shards = max(1, math.ceil(corpus.total / SHARD_TOKENS))
    ids = read.filter("not held_out").select("ids", "deal", "n_tokens").repartition(shards, "deal")
    ids = ids.sortWithinPartitions(F.greatest("n_tokens", F.lit(LONG)).desc(), "deal").select("ids")
    ids = ids.persist(StorageLevel.DISK_ONLY)  # dealt and sorted once; a lost shard is dealt again
    try:
        _passes(corpus, ids, shards)
    finally:
        ids.unpersist()


def _passes(corpus: Corpus, ids: DataFrame, shards: int) -> None:
    """Train the model of ``corpus`` on the shards that partition ``ids``."""
    share, updates = ids.sparkSession.sparkContext.broadcast, 0.0
    for _ in range(PASSES):
        start = share((corpus.model.p, updates))
        mean = ids.mapInArrow(lambda b, start=start: _trained(b, *start.value), _PART)
        left = shards
        while left:
            mean = mean.groupBy("chunk", F.floor(F.col("task") / BRANCH).cast("int").alias("branch")).applyInArrow(_averaged, _PART)
            left = math.ceil(left / BRANCH) if left > BRANCH else 0
        mean = frames.stored(mean, "weights").collect()
        if not mean:
            return
        flat = np.frombuffer(b"".join(bytes(r.weights) for r in sorted(mean, key=lambda r: r.chunk)), "<f4")
        names = sorted(corpus.model.p)
        cuts = np.cumsum([corpus.model.p[k].size for k in names])[:-1]
        corpus.model.p = {
            k: x.reshape(corpus.model.p[k].shape) for k, x in zip(names, np.split(flat, cuts), strict=True)
        }
        updates += mean[0].updates


# --- scoring ----------------------------------------------------------------------------------

_PLAIN = ["row", "doc_id", "held_out", "n_tokens", "n_known", "n_other", "counted", "other"]


def _scored(batches: Iterator[pa.RecordBatch], corpus: Corpus) -> Iterator[pa.RecordBatch]:
    """The plain columns, and what the network gives each document."""
    for batch in batches:
        raw = batch.column("ids").to_pylist()
        bounds = np.concatenate([[0], np.cumsum([len(x) // 2 for x in raw])]).astype(np.int64)
        neural = corpus.model.score(np.frombuffer(b"".join(raw), "<u2").astype(np.int64), bounds) / math.log(10)
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in _PLAIN), pa.array(neural)], [*_PLAIN, "neural"])


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Null text is empty: one end token. Null doc_ids are held out. Rows that share a doc_id are scored and
    counted each. Without training documents every count is zero. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    counts = docs.mapInArrow(_counted, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
    counts = frames.stored(counts.filter("c > 0"), "token-counts")
    corpus = _corpus(counts)
    share = spark.sparkContext.broadcast
    plain = {f.name: getattr(corpus, f.name) for f in fields(corpus) if f.name != "model"}
    known = share(plain | {"weights": {}})  # arrays only; workers need not import this module
    read = frames.stored(docs.mapInArrow(lambda b: _read(b, Corpus.of(known.value)), _READ), "read")
    _train(corpus, read)
    shared = share(plain | {"weights": corpus.model.p})
    kinds = {f.name: f.dataType.simpleString() for f in read.schema}
    scored = read.select(*_PLAIN, "ids").mapInArrow(
        lambda b: _scored(b, Corpus.of(shared.value)), ", ".join(f"{k} {kinds[k]}" for k in _PLAIN) + ", neural double"
    )
    rare = read.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("t")).select("row", "t.tokens", "t.times")
    joined = rare.join(counts.withColumnRenamed("token", "tokens"), "tokens", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)
    sums = joined.groupBy("row").agg(
        F.sum(F.col("times") * log).alias("rare"), F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known")
    )
    out = scored.join(sums, "row", "left").fillna({"rare": 0.0, "rare_known": 0})
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(corpus.total).cast("long").alias("train_tokens"),
        (F.col("counted") + F.col("rare") - F.col("n_tokens") * F.lit(corpus.base_norm)).alias("base_score"),
        (F.col("neural") + F.col("other") + F.col("rare") - F.col("n_other") * F.lit(corpus.other_norm)).alias("score"),
    )
