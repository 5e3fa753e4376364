"""Toxicity by a weighted finite-state pattern grammar (operator 12).

Words are read as symbols: insult, threat, target, negation, report, quotation mark, end of clause. Three small
weighted machines read the same symbols: one lowers what stands under a negation, one lowers what is quoted or
reported, one raises what is aimed at somebody and lets a threat count for what its target makes of it. Their
composition is one table of states, and a clause's score is the weight it emits from its start to its end.

Which words insult is learned: document counts of words and of beginnings of words, on labelled training rows,
give weights; beginnings stand for words not seen in training. A short list of common words is the start.
The clause scores of a document become a probability by logistic regression, fitted on documents whose
lexicon was learned from the other half of the training rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames, words as word_runs

#: Labelled documents (those of smallest hash) that lexicon and probabilities are fitted on.
SAMPLE_DOCS = 20_000
#: Strongest entries that a lexicon keeps, and the evidence (log-likelihood ratio) an entry needs.
ENTRIES, EVIDENCE = 20_000, 20.0
#: Beginnings of words that are counted, and how many words of toxic texts must share one.
SHORTEST, LONGEST, VARIETY = 3, 8, 4
#: Training texts that share one of this many minimum hashes of 5-word shingles are counted once.
SIGNATURES, SHINGLE = 6, 5
THRESHOLD = 0.3

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)

# Fixed word lists: common insults, threats, persons addressed or meant, negators, verbs of saying (en, fr, de, es).
INSULTS = """
idiot moron stupid dumb fool loser trash garbage scum worthless pathetic disgusting clown jerk imbecile
imbécile crétin connard débile ordure minable abruti
dummkopf trottel vollidiot abschaum arschloch versager wertlos
imbécil estúpido estúpida basura escoria inútil patético
""".split()
THREATS = """
kill murder hurt beat shoot stab burn destroy crush strangle
tuer frapper détruire brûler écraser
töten umbringen schlagen vernichten verbrennen
matar golpear destruir quemar aplastar
""".split()
TARGETS = """
you your yours yourself u he him his she her they them their
tu toi vous te ton votre ils elles
du dich dir dein ihr euch sie
tú ti usted ustedes vosotros ellos ellas
""".split()
NEGATORS = """
not no never isn aren wasn weren don doesn didn won cannot nobody without
ne pas jamais aucun sans
nicht kein keine niemals ohne
nunca jamás ningún sin
""".split()
REPORTS = """
say says said claim claims claimed write writes wrote written call called calls quote quoted quotes allegedly
dit disait écrit prétend selon
sagt sagte schrieb behauptet angeblich
dice dijo escribió afirma según
""".split()

SEED_WEIGHT, THREAT_WEIGHT, TARGET_WEIGHT = 3.0, 2.0, 1.0

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:|\n]+|[\"“”„«»]")
_QUOTES = frozenset('"“”„«»')


def distinct_words(text: str) -> set[str]:
    """The lower-case words of a text; only pieces with other characters inside are searched for them."""
    pieces = set(text.lower().split())
    mixed = [p for p in pieces if not p.isalpha()]
    found = pieces.difference(mixed)
    found.update(_WORD.findall(" ".join(mixed)))
    return found


# --- the grammar --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Machine:
    """States and the factor put on each symbol: ``arcs[state, symbol] = (next state, factor)``.

    Symbols without an arc leave the state as it is, with factor 1.
    """

    start: object
    arcs: dict

    def step(self, state: object, symbol: int) -> tuple:
        return self.arcs.get((state, symbol), (state, 1.0))


def negation(reach: int = 3, factor: float = 0.2) -> Machine:
    """Insults, threats and targets up to ``reach`` words after a negator count less."""
    arcs = {}
    for left in range(reach + 1):
        for symbol in (OTHER, INSULT, THREAT, TARGET, REPORT):
            weak = left and symbol in (INSULT, THREAT, TARGET)
            arcs[left, symbol] = (max(left - 1, 0), factor if weak else 1.0)
        arcs[left, NEGATION] = (reach, 1.0)
        arcs[left, END] = (0, 1.0)
    return Machine(0, arcs)


def reported_speech(factor: float = 0.5) -> Machine:
    """What follows a verb of saying, or stands in quotation marks, counts less up to the clause's end."""
    arcs = {(s, REPORT): (True, 1.0) for s in (False, True)} | {(s, END): (False, 1.0) for s in (False, True)}
    arcs |= {(s, QUOTE): (not s, 1.0) for s in (False, True)}
    arcs |= {(True, symbol): (True, factor) for symbol in (INSULT, THREAT, TARGET)}
    return Machine(False, arcs)


def aim(reach: int = 4, aimed: float = 1.5, idle: float = 0.25) -> Machine:
    """Insults near a target count more, threats without one little; a target counts after an insult or threat."""
    arcs = {}
    for near in range(reach + 1):
        for open_ in range(reach + 1):
            less = (max(near - 1, 0), max(open_ - 1, 0))
            for symbol in (OTHER, NEGATION, REPORT):
                arcs[(near, open_), symbol] = (less, 1.0)
            arcs[(near, open_), INSULT] = ((less[0], reach), aimed if near else 1.0)
            arcs[(near, open_), THREAT] = ((less[0], reach), aimed if near else idle)
            arcs[(near, open_), TARGET] = ((reach, 0), 1.0 if open_ else 0.0)
            arcs[(near, open_), END] = ((0, 0), 1.0)
    return Machine((0, 0), arcs)


def compose(machines: Iterable[Machine]) -> list[list[tuple[int, float]]]:
    """The product of machines that read the same symbols: ``table[state][symbol] = (next state, factor)``."""
    machines = list(machines)
    ids = {tuple(m.start for m in machines): 0}
    todo, table = list(ids), []
    while len(table) < len(ids):
        state, row = todo[len(table)], []
        for symbol in range(END + 1):
            steps = [m.step(s, symbol) for m, s in zip(machines, state, strict=True)]
            then = tuple(s for s, _ in steps)
            if then not in ids:
                ids[then] = len(ids)
                todo.append(then)
            row.append((ids[then], math.prod(f for _, f in steps)))
        table.append(row)
    return table


GRAMMAR = compose([negation(), reported_speech(), aim()])


@dataclass
class Lexicon:
    """Weights of insulting words and beginnings of words; the other symbols come from the fixed lists."""

    words: dict[str, float]
    stems: dict[str, float]
    table: dict[str, tuple[int, float]] = field(init=False)
    triggers: set[str] = field(init=False)
    heads: set[str] = field(init=False)

    def __post_init__(self) -> None:
        self.table = {w: (TARGET, TARGET_WEIGHT) for w in TARGETS}
        self.table |= {w: (NEGATION, 0.0) for w in NEGATORS} | {w: (REPORT, 0.0) for w in REPORTS}
        self.table |= {w: (THREAT, THREAT_WEIGHT) for w in THREATS}
        self.table |= {w: (INSULT, weight) for w, weight in self.words.items()}
        self.triggers = {w for w, (symbol, _) in self.table.items() if symbol in (INSULT, THREAT)}
        self.heads = {s[:SHORTEST] for s in self.stems}

    def read(self, word: str) -> tuple[int, float]:
        """Symbol and weight of a lower-case word: as a whole, else by its longest known beginning."""
        found = self.table.get(word)
        if (found is None or found[0] not in (INSULT, THREAT)) and word[:SHORTEST] in self.heads:
            for size in range(min(len(word), LONGEST), SHORTEST - 1, -1):
                if word[:size] in self.stems:
                    return INSULT, self.stems[word[:size]]
        return found or (OTHER, 0.0)

    def silent(self, text: str) -> bool:
        """No word of the text can give a clause a score."""
        found = distinct_words(text)
        if not self.triggers.isdisjoint(found):
            return False
        if self.heads.isdisjoint({w[:SHORTEST] for w in found}):
            return True
        return not any(w[:SHORTEST] in self.heads and self.read(w)[0] == INSULT for w in found)

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """Matched clauses: start, stop (code points) and score."""
        if self.silent(text):
            return []
        out, state, score, begin, stop = [], 0, 0.0, 0, 0
        for token in _TOKEN.finditer(text):
            word = token[0]
            if word[0].isalpha():
                symbol, weight = self.read(word.lower())
                stop = token.end()
            else:
                symbol, weight = (QUOTE if word in _QUOTES else END), 0.0
            state, factor = GRAMMAR[state][symbol]
            score += weight * factor
            if symbol == END:
                if score > 0:
                    out.append((begin, stop, score))
                score, begin = 0.0, token.end()
        if score > 0:
            out.append((begin, stop, score))
        return out


def features(clauses: list[tuple[int, int, float]], size: int) -> list[float]:
    """Of a document of ``size`` code points: sum, greatest, number, and density of its matched clauses."""
    if not clauses:
        return [0.0] * 4
    scores = [s for _, _, s in clauses]
    return [math.log1p(sum(scores)), math.log1p(max(scores)), math.log1p(len(scores)), math.log1p(100 * sum(scores) / (size + 100))]


# --- learning -----------------------------------------------------------------------------------


def trains(doc_id: Column) -> Column:
    """Rows whose labels may be learned; those without doc_id have none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 != 2, F.lit(True))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minimum hashes of each text's shingles, those of all words for shorter texts."""
    for batch in batches:
        for begin, end, data, offsets in word_runs.chunks(batch.column("text")):
            found = word_runs.split(data, offsets)
            columns = []
            for k in range(SIGNATURES):
                salted = word_runs.mix(found.hashes + np.uint64(k + 1))
                grams = word_runs.grams(salted, SHINGLE)
                least = []
                for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True):
                    some = grams[a : b - SHINGLE + 1] if b - a >= SHINGLE else salted[a:b]
                    least.append(int(some.min()) - (1 << 63) if len(some) else 0)
                columns.append(pa.array(least, pa.int64()))
            held = [batch.column(c)[begin:end] for c in ("copy", "text", "toxic", "fold")]
            yield pa.RecordBatch.from_arrays([*held, *columns], ["copy", "text", "toxic", "fold", *_MINIMA])


_MINIMA = [f"m{k}" for k in range(SIGNATURES)]


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(text, toxic, fold) of a bounded number of labelled training texts, one of each group of near copies.

    Copies would count each word of one text many times over. Of texts with an equal minimum hash the one of
    smallest text hash stays.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").filter(trains(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").alias("of")).agg((F.max("toxic") > 0).alias("toxic"))
    slim = docs.select(F.col("doc_id").alias("of"), F.xxhash64("text").alias("copy"))
    picked = (
        slim.join(marked, "of").distinct().orderBy(F.xxhash64("of"), "of", "copy").limit(sample)
        .select("of", "copy", "toxic", (F.crc32(F.col("of").cast("string")) % 8 > 3).alias("fold"))
    )
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("has"))
    same = (F.col("doc_id") == F.col("of")) & (F.col("has") == F.col("copy"))
    rows = texts.join(F.broadcast(frames.stored(picked, "toxicity-sample")), same)
    schema = "copy long, text string, toxic boolean, fold boolean, " + ", ".join(f"{m} long" for m in _MINIMA)
    rows = frames.stored(rows.select("copy", "text", "toxic", "fold").mapInArrow(_signed, schema), "toxicity-signed")
    left = rows.select("copy", "toxic", *_MINIMA)
    for m in _MINIMA:
        least = left.groupBy("toxic", m).agg(F.min(F.struct("copy", *_MINIMA)).alias("row"))
        left = least.select("toxic", "row.*")
    kept = left.select(F.col("copy").alias("keep"), F.col("toxic").alias("as"))
    same = (F.col("copy") == F.col("keep")) & (F.col("toxic") == F.col("as"))
    rows = rows.join(F.broadcast(kept), same).dropDuplicates(["copy", "toxic"])
    spread = rows.repartition(frames.width(docs.sparkSession), "copy")
    return frames.stored(spread.select("text", "toxic", "fold"), "toxicity-rows")


_COUNTS = "entry string, fold boolean, toxic boolean, docs long"


def _counted(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Documents per word and per beginning ('abc*'); the empty entry counts all documents."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            counts: dict[tuple, Counter] = {}
            part = batch.slice(at, rows)
            for text, toxic, fold in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "fold")), strict=True):
                words = distinct_words(text or "")
                entries = {f"{w[:n]}*" for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
                counts.setdefault((fold, toxic), Counter()).update([*entries, *words, ""])
            for (fold, toxic), found in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(found)),
                        pa.array([fold] * len(found)),
                        pa.array([toxic] * len(found)),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    ["entry", "fold", "toxic", "docs"],
                )


def _evidence(a: Column, b: Column, n: float, m: float) -> Column:
    """Log-likelihood ratio of ``a`` of n toxic against ``b`` of m other documents having an entry."""
    def part(seen: Column, of: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / ((a + b) * (of / (n + m))))).otherwise(0.0)

    return F.when(a * m > b * n, 2 * (part(a, n) + part(b, m))).otherwise(0.0)


def _weight(a: Column, b: Column, n: float, m: float) -> Column:
    """Log odds of an entry, less one standard error."""
    odds = F.log((a + 0.5) / (n + 1)) - F.log((b + 0.5) / (m + 1))
    return odds - F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))


def by_entry(counts: DataFrame) -> DataFrame:
    """A row per entry: toxic and other documents of each half, a0, b0, a1, b1."""
    docs = lambda fold, toxic: F.sum(F.when((F.col("fold") == fold) & (F.col("toxic") == toxic), F.col("docs")).otherwise(0))
    return counts.groupBy("entry").agg(
        docs(False, True).alias("a0"), docs(False, False).alias("b0"), docs(True, True).alias("a1"), docs(True, False).alias("b1")
    )


def lexicon(counts: DataFrame, folds: tuple[int, ...] = (0, 1)) -> Lexicon | None:
    """The lexicon of the given halves of the training rows; None if a label is missing there."""
    both = counts.select("entry", sum(F.col(f"a{f}") for f in folds).alias("a"), sum(F.col(f"b{f}") for f in folds).alias("b"))
    total = both.filter("entry = ''").first()
    if total is None or not total.a or not total.b:
        return None
    a, b, n, m = F.col("a"), F.col("b"), float(total.a), float(total.b)
    known = both.filter("entry <> '' and (a > 0 or b > 0)").select(
        "entry", _evidence(a, b, n, m).alias("evidence"), _weight(a, b, n, m).alias("weight"), F.col("entry").isin(INSULTS).alias("seed"),
        (a + b).alias("docs"),
    )
    strong = known.filter(F.col("seed") | ((F.col("evidence") >= EVIDENCE) & (F.col("weight") > 1)))
    strong = frames.stored(strong.orderBy(F.desc("seed"), F.desc("evidence"), "entry").limit(ENTRIES), "toxicity-strong")
    # A beginning must stand for several words, or it would say no more than the one it begins.
    toxic = both.filter((F.col("a") > 0) & ~F.col("entry").endswith("*") & (F.length("entry") >= SHORTEST))
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.length("entry"), F.lit(LONGEST)))
    begun = F.explode(F.transform(sizes, lambda n: F.concat(F.substring("entry", F.lit(1), n), F.lit("*"))))
    begun = toxic.select(begun.alias("entry")).join(F.broadcast(strong.select("entry")), "entry", "left_semi")
    varied = {r.entry for r in begun.groupBy("entry").count().filter(F.col("count") >= VARIETY).collect()}
    words, stems = dict.fromkeys(INSULTS, SEED_WEIGHT), {}
    for row in strong.collect():
        if row.entry.endswith("*"):
            if row.entry in varied:
                stems[row.entry[:-1]] = row.weight
        elif row.evidence >= EVIDENCE and row.weight > 1:
            words[row.entry] = row.weight
        elif row.seed and row.docs >= 10 and row.weight < 0:
            del words[row.entry]  # the labels say that it is harmless here
    return Lexicon(words, stems)


class Calibration:
    """Ridge-penalised logistic regression on clause features, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> None:
        z = np.concatenate([np.ones((len(x), 1)), x], axis=1)
        self.weights = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (p - y) + penalty * self.weights
            bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            self.weights -= np.linalg.solve(bend, slope)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


class Unlabelled:
    """Without usable labels: even odds at a clause as strong as two common insults."""

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-4 * (x[:, 0] - math.log1p(2 * SEED_WEIGHT))))


def _features(batches: Iterator[pa.RecordBatch], lexicons: dict[bool, Lexicon]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, folds = batch.column("text").to_pylist(), batch.column("fold").to_pylist()
        found = [features(lexicons[not f].clauses(t or ""), len(t or "")) for t, f in zip(texts, folds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], ["toxic", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> tuple[Lexicon, Calibration | Unlabelled]:
    """Lexicon and calibration; the seeds alone if the sample lacks one of the labels."""
    rows = training_rows(docs, labels, sample)
    counts = rows.mapInArrow(_counted, _COUNTS)
    counts = frames.stored(by_entry(counts), "toxicity-counts")
    whole = lexicon(counts)
    if whole is None:
        return Lexicon(dict.fromkeys(INSULTS, SEED_WEIGHT), {}), Unlabelled()
    halves = {bool(f): lexicon(counts, (f,)) or whole for f in (0, 1)}
    table = rows.mapInArrow(lambda b: _features(b, halves), "toxic boolean, x array<double>").toArrow()
    y = table["toxic"].to_numpy().astype(float)
    x = np.array(table["x"].to_pylist(), float).reshape(len(y), -1)
    order = np.lexsort([*x.T, y])  # the same sums whatever the order of arrival
    return whole, Calibration(x[order], y[order])


# --- scoring ------------------------------------------------------------------------------------


def _scored(
    batches: Iterator[pa.RecordBatch], words: Lexicon, model: Calibration | Unlabelled
) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        found = [words.clauses(t) for t in texts]
        x = np.array([features(c, len(t)) for c, t in zip(found, texts, strict=True)], float).reshape(len(texts), 4)
        names = ("start", "stop", "score")
        clauses = pa.array([[dict(zip(names, c, strict=True)) for c in cs] for cs in found], kind)
        columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(model.probability(x)), clauses]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "clauses"])


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted, clauses) per row of ``docs``.

    ``clauses`` holds the matched clauses: start, stop (code points) and score. ``score`` is the probability that
    the text is labelled toxic; ``predicted`` is 1 from 0.3 on. Null text is empty and, like any text without
    a match, has the score of no match. Labels are learned from rows whose crc32(doc_id) mod 4 is not 2;
    ``held_out`` marks the others, rows without doc_id are none of them. Repeated rows are scored each, repeated
    labels count as toxic if one is. Without both labels the fixed word list decides. Extra columns are ignored.
    """
    words, model = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (~trains(F.col("doc_id"))).alias("held_out"))
    schema = "doc_id long, held_out boolean, score double, clauses array<struct<start:long,stop:long,score:double>>"
    out = rows.mapInArrow(lambda b: _scored(b, words, model), schema)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")).select(
        "doc_id", "held_out", "score", "predicted", "clauses"
    )
