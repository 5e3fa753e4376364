"""Benchmark decontamination by templates (operator 5).

Numbers, quantities, units and names become typed placeholders, so a question whose figures or persons were
exchanged keeps its template. Windows of the template are joined by hash with those of the benchmark; the
values behind the placeholders must then agree: along one alignment, equal values of the item stand against
equal values in the document. Where they do not, the windows that hold the item's own values still count. Built
from SQL functions only.

Few documents get as far as windows: each benchmark window has pairs of neighbouring literal words, as more than
half of its words are literal. Only an odd window that alternates literal and placeholder has none; it has pairs
of literals with one word between, which are sought where the benchmark has such windows. One pass over the texts
finds the documents of all these pairs; then only documents that hold the rarest pair of some window are cut into
windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import frames

WINDOW = 8
#: Items with fewer tokens are not searched for; any text would hold them.
SHORTEST = 3
UNITS = (
    "kg mg km cm mm ml lb lbs oz ft mph km/h kph hz khz mhz ghz kb mb gb tb kw mw kwh joule joules watt watts volt volts"
    " gram grams kilogram kilograms meter meters metre metres mile miles inch inches foot feet yard yards liter liters"
    " litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years"
    " dollar dollars euro euros cent cents pound pounds percent degree degrees"
).split()
_BETWEEN = r"[^\p{L}\p{N}%]*[\x20\x09-\x0D]+[^\p{L}\p{N}%$€£]*"
_EDGES = r"^[^\p{L}\p{N}$€£]+|[^\p{L}\p{N}%]+$"
_NUMBER = r"^[$€£+-]?[0-9][0-9.,:/]*%?$"
_QUANTITY = r"^[$€£+-]?[0-9][0-9.,]*\p{L}{1,4}$"


def _words(text: Column) -> Column:
    """Words without the punctuation around them."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), _BETWEEN, " "), _EDGES, "")
    return F.array_remove(F.split(bare, " "), "")


def _template(word: Column) -> Column:
    return (
        F.when(word.rlike(_NUMBER), "<num>")
        .when(word.rlike(_QUANTITY), "<quantity>")
        .when(F.lower(word).isin(UNITS), "<unit>")
        .when(word.rlike(r"^\p{Lu}"), "<name>")
        .otherwise(F.lower(word))
    )


def _is_slot(token: Column) -> Column:
    return F.startswith(token, F.lit("<"))


def _pair(first: Column, second: Column) -> Column:
    return F.xxhash64(F.lower(first), F.lower(second))


def _wide_pair(first: Column, second: Column) -> Column:
    """Of words with one between them; told from neighbours by the mark."""
    return F.xxhash64(F.lower(first), F.lit(""), F.lower(second))


def _windows(texts: DataFrame, key: list[str], lengths: list[int]) -> DataFrame:
    """Windows of ``v`` (words) and ``t`` (template) with place, hash and whether the template is specific."""
    none = F.array().cast("array<struct<i:int,n:int>>")

    def places(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size("v") - n), lambda i: F.struct(i.alias("i"), F.lit(n).alias("n")))
        return F.when(F.size("v") >= n, each).otherwise(none)

    at = F.explode(F.flatten(F.array(*(places(n) for n in lengths))))
    cut = texts.select(*key, "v", "t", at.alias("w")).select(
        *key,
        F.col("w.i").alias("i"),
        F.col("w.n").alias("n"),
        F.slice("v", F.col("w.i") + 1, F.col("w.n")).alias("v"),
        F.slice("t", F.col("w.i") + 1, F.col("w.n")).alias("t"),
    )
    literal = F.size(F.filter("t", lambda x: ~_is_slot(x)))
    cut = cut.withColumn("specific", literal * 2 > F.col("n"))
    return cut.withColumn(
        "hash", F.when(F.col("specific"), F.xxhash64(F.lit("t"), "t")).otherwise(F.xxhash64(F.lit("v"), "v"))
    )


def _pairs_of_windows(windows: DataFrame) -> DataFrame:
    """(hash, pair, wide): pairs of each benchmark window, literal where the template is specific. They are of
    neighbours, or ``wide`` where no neighbours are literal."""

    def pairs(gap: int, made: Callable[[Column, Column], Column]) -> Column:
        # Not filter(sequence): a sequence to below its start would count down.
        places = F.slice(F.sequence(F.lit(0), F.col("n")), F.lit(1), F.greatest(F.col("n") - gap, F.lit(0)))
        usable = F.filter(
            places,
            lambda k: ~F.col("specific") | (~_is_slot(F.get("t", k)) & ~_is_slot(F.get("t", k + gap))),
        )
        return F.transform(usable, lambda k: made(F.get("v", k), F.get("v", k + gap)))

    both = windows.select("hash", pairs(1, _pair).alias("near"), pairs(2, _wide_pair).alias("far"))
    wide = F.size("near") == 0
    both = both.select("hash", wide.alias("wide"), F.explode(F.when(wide, F.col("far")).otherwise(F.col("near"))).alias("pair"))
    return both.distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, n_words, n_changed, verbatim): documents that hold a benchmark passage.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text). ``n_windows`` windows match in the best
    alignment, which covers ``n_words`` words of the item; ``n_changed`` of its values differ. Null texts are
    empty; items below ``SHORTEST`` words match nothing, items below ``WINDOW`` words only as a whole. A
    window without enough literal words is matched by its values. Rows that share a doc_id are judged apart
    and give the better row; null ids are kept as ids. No benchmark or no documents give no rows.
    """
    items = benchmark.select("item_id", _words(F.col("text")).alias("v")).filter(F.size("v") >= SHORTEST)
    items = items.withColumn("t", F.transform("v", _template))
    lengths = [r.n for r in items.select(F.least(F.size("v"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    if not lengths:
        items_windows = _windows(items, ["item_id"], [WINDOW])
    else:
        items_windows = _windows(items.withColumn("own", F.least(F.size("v"), F.lit(WINDOW))), ["item_id", "own"], sorted(lengths))
        items_windows = items_windows.filter("n = own").drop("own")
    known = frames.stored(items_windows, "benchmark-windows")
    pairs = frames.stored(_pairs_of_windows(known), "benchmark-pairs")

    lowered = docs.select("doc_id", _words(F.lower("text")).alias("w"))
    neighbours = F.transform(
        F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda x, k: F.xxhash64(F.get("w", k), x)
    )
    if not pairs.filter("wide").isEmpty():
        distant = F.transform(
            F.slice("w", 3, F.greatest(F.size("w"), F.lit(1))), lambda x, k: F.xxhash64(F.get("w", k), F.lit(""), x)
        )
        neighbours = F.concat(neighbours, distant)
    hashed = lowered.select("doc_id", F.explode(F.array_distinct(neighbours)).alias("pair"))
    hits = frames.stored(hashed.join(frames.small(pairs.select("pair").distinct()), "pair", "left_semi"), "pair-hits")
    spread = hits.groupBy("pair").agg(F.count("*").alias("docs"))
    rarest = F.min(F.struct(F.coalesce("docs", F.lit(0)), "pair"))
    chosen = pairs.join(spread, "pair", "left").groupBy("hash").agg(rarest.alias("r")).select("r.pair").distinct()
    chosen = frames.stored(chosen, "rarest-pairs")
    holders = frames.stored(hits.join(frames.small(chosen), "pair", "left_semi").select("doc_id").distinct(), "holders")
    same = docs.select("doc_id", "text").join(
        frames.small(holders.withColumnRenamed("doc_id", "of")), F.col("doc_id").eqNullSafe(F.col("of")), "left_semi"
    )
    held = same.select("doc_id", F.xxhash64("text").alias("copy"), _words(F.col("text")).alias("v"))
    held = held.withColumn("t", F.transform("v", _template))
    found = _windows(held, ["doc_id", "copy"], sorted(lengths) or [WINDOW])
    right = known.select("item_id", "hash", "n", F.col("i").alias("item_i"), F.col("v").alias("item_v"))
    matched = frames.stored(
        found.join(frames.small(right), ["hash", "n"]).withColumn("shift", F.col("i") - F.col("item_i")), "matches"
    )
    line = ["doc_id", "copy", "item_id", "shift"]
    slots = matched.select(
        *line,
        F.explode(F.arrays_zip(F.col("t"), F.col("item_v"), F.col("v"), F.sequence(F.col("item_i"), F.col("item_i") + F.col("n") - 1).alias("p"))).alias("s"),
    )
    slots = slots.filter(_is_slot(F.col("s.t"))).select(
        *line, F.col("s.item_v").alias("theirs"), F.col("s.v").alias("ours"), F.col("s.p").alias("p")
    )
    values = slots.groupBy(*line, "theirs").agg(
        F.min("ours").alias("low"), F.max("ours").alias("high"),
        F.countDistinct(F.when(F.col("ours") != F.col("theirs"), F.col("p"))).alias("changed"),
    )
    values = values.groupBy(*line).agg(
        F.bool_and(F.col("low") == F.col("high")).alias("agrees"), F.sum("changed").alias("n_changed")
    )
    # Words covered: a window adds what lies beyond the one before it. Both sets are bounded by the item's length.
    values_in = F.zip_with("t", "v", lambda t, v: F.when(_is_slot(t), v))
    theirs_in = F.zip_with("t", "item_v", lambda t, v: F.when(_is_slot(t), v))
    own = F.to_json(values_in) == F.to_json(theirs_in)
    matched = matched.select(*line, F.struct("item_i", "n").alias("place"), own.alias("own"))
    places = F.array_sort(F.collect_set("place"))
    own_places = F.array_sort(F.collect_set(F.when(F.col("own"), F.col("place"))))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["sum"] + F.greatest(x["item_i"] + x["n"] - F.greatest(a["end"], x["item_i"]), F.lit(0))).alias("sum"),
            F.greatest(a["end"], x["item_i"] + x["n"]).alias("end"),
        ),
        lambda a: a["sum"],
    )
    lines = matched.groupBy(*line).agg(places.alias("all"), own_places.alias("own"))
    null_safe = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in line]
    agrees = F.coalesce("r.agrees", F.lit(True))
    joined = lines.alias("l").join(values.alias("r"), null_safe, "left").select(
        *(F.col(f"l.{c}") for c in line), F.when(agrees, F.col("l.all")).otherwise(F.col("l.own")).alias("places"),
        F.when(agrees, F.coalesce("r.n_changed", F.lit(0))).otherwise(F.lit(0)).alias("n_changed"),
    )
    joined = joined.withColumn("n_windows", F.size("places").cast("long")).withColumn("n_words", covered)
    best = F.max(F.struct("n_words", "n_windows", (-F.col("n_changed")).alias("less")))
    return (
        joined.filter("n_windows > 0")
        .groupBy("doc_id", "item_id")
        .agg(best.alias("b"))
        .select(
            "doc_id", "item_id", "b.n_windows", "b.n_words", (-F.col("b.less")).alias("n_changed"),
            (F.col("b.less") == 0).alias("verbatim"),
        )
    )
