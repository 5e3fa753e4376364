"""Prefix trie, toxicity grammar and R-tree search against brute force, and on the awkward rows of their tables."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import rtree, toxicity, trie

# --- prefix trie --------------------------------------------------------------------------------


def brute_trie(rows):
    chats = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            chats[conv].append(((turn is not None, turn or 0, role, digest), role, text))
    chats = {c: [(role, text) for _, role, text in sorted(v)] for c, v in chats.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c, own in chats.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(chats.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append(c)
    below = defaultdict(list)
    for s in nodes:
        if s:
            below[s[:-1]].append(s)
    out, leaves, saved = [], {}, {}
    for s in sorted(nodes, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in below[s]) or 1
        saved[s] = (len(nodes[s]) - 1) * (len(s[-1][1]) if s else 0) + sum(saved[k] for k in below[s])
        digest = hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest()
        above = min(nodes[s[:-1]]) if s else None
        out.append((min(nodes[s]), len(s), above, len(nodes[s]), len(below[s]), leaves[s], saved[s], digest))
    return sorted(out, key=str)


CHATS = "conv_id long, turn long, role string, text string, block long, depth int, path string, key binary, n int"


def awkward_chats():
    pick = random.Random(7)
    rows = [(None, 0, "user", "lost"), (-3, 0, "user", "negative id"), (7, None, None, None), (8, 5, "user", "only turn é世")]
    for conv in range(0, 900, 100):  # templates with a common opening
        rows += [(conv, t, "user" if t % 2 else "system", f"opening {t if t < 3 else conv}") for t in range(pick.randint(1, 7))]
    for conv in range(1000, 1120):  # a third of all conversations are equal
        rows += [(conv, t, "user", f"hot {t}") for t in range(3)]
    for _ in range(600):
        rows.append((pick.randrange(900), pick.choice([None, 0, 0, 1, 2, 3, 9]), pick.choice([None, "user", "x"]), pick.choice("ab") * pick.randrange(3)))
    rows += [(450, t, "user", "long") for t in range(300)]
    return rows + rows[50:60]


@pytest.mark.parametrize(("cells", "paths"), [(1 << 20, 2048), (200, 16)])
def test_trie_equals_brute_force(spark, monkeypatch, cells, paths):
    monkeypatch.setattr(trie, "CELLS", cells)
    monkeypatch.setattr(trie, "SHARD_PATHS", paths)
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = awkward_chats()
    chats = spark.createDataFrame([(*r, 1, 2, "p", b"k", 3) for r in rows], CHATS).repartition(5)
    got = trie.prefix_trie(chats)
    assert [f.dataType.simpleString() for f in got.schema][:7] == ["bigint"] * 7
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], CHATS)).count() == 0
    only_null = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(only_null).count() == 0


def test_fold_of_one_block_counts_every_depth():
    paths = [b"".join(bytes([x]) * 16 for x in s) for s in ([], [1], [1, 2], [1, 3], [2])]
    sizes = [len(p) // 16 + 1 for p in paths]
    sums = {"n": [[2] * k for k in sizes], "least": [[i] * k for i, k in enumerate(sizes)]}
    sums |= {x: [[0] * k for k in sizes] for x in ("children", "leaves", "saved")}
    block = trie.Block(paths, [[5] * (k - 1) for k in sizes], sums, [[None] * (k - 1) + ["h"] for k in sizes])
    nodes, edges = trie.fold(block, True, False)
    rows = {(r["depth"], r["conv_id"]): r for r in nodes.to_pylist()}
    assert not edges
    assert (rows[0, 0]["n_convs"], rows[0, 0]["n_children"], rows[0, 0]["n_leaves"]) == (10, 2, 3)
    assert (rows[1, 1]["n_convs"], rows[1, 1]["saved_tokens"]) == (6, 5 * 5 + 5 + 5)
    partial, edges = trie.fold(block, False, False)
    assert {(r["depth"], r["conv_id"]) for r in partial.to_pylist()} == {(1, 1), (2, 2), (2, 3)}
    assert [len(e["n"]) for e in edges] == [1, 2]


# --- toxicity -----------------------------------------------------------------------------------

WORDS = toxicity.Lexicon({"idiot": 3.0, "moron": 3.0}, {"vequ": 2.0})


def clause(text):
    return sum(s for _, _, s in WORDS.clauses(text))


def test_grammar_scores_clauses_not_words():
    plain = clause("what an idiot")
    assert clause("you idiot") > plain > clause("not an idiot") > 0
    assert clause("he said idiot") < plain and clause('the word "idiot" here') < plain
    assert clause('"word" idiot') == plain  # the quotation is over
    assert clause("kill the process") < clause("i will kill you")
    assert clause("not. an idiot") == plain  # a negation ends with its clause
    assert clause("not one of all the big idiot") == plain  # out of reach
    assert clause("you. and they") == 0 and clause("") == 0 and clause(" \n.!") == 0
    assert clause("vequabc") == 2.0 and clause("veqabc") == 0


def test_clause_spans_are_code_points():
    text = "Gut so, é世. You IDIOT! Fine."
    [(start, stop, score)] = WORDS.clauses(text)
    assert text[start:stop].strip() == "You IDIOT" and score == 4.5


def test_composition_multiplies_its_machines():
    table = toxicity.compose([toxicity.negation(1, 0.5), toxicity.reported_speech(0.1)])
    state = table[0][toxicity.REPORT][0]
    state = table[state][toxicity.NEGATION][0]
    assert table[state][toxicity.INSULT][1] == pytest.approx(0.05)


def test_distinct_words_equal_a_full_search():
    text = "Ab½c x_y 1a2 don't É世 ... ab q\x1cz"
    assert toxicity.distinct_words(text) == set(toxicity._WORD.findall(text.lower()))


DOCS = "doc_id long, text string, lang string, copy long, score double, toxic int, fold int, of int"


def made_docs(spark, extra=()):
    pick, rows, labels = random.Random(3), [], []
    vocabulary = ["".join(pick.choice("aeiourstln") for _ in range(5)) for _ in range(300)]
    for i in range(400):
        words = pick.choices(vocabulary, k=40)
        if i % 4 == 0:
            for _ in range(3):
                words[pick.randrange(40)] = "zorgl" + pick.choice(["a", "bu", "ix", "omp", "und"])
        rows.append((i, " ".join(words) + ".", "en"))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += extra
    return spark.createDataFrame([(*r, 0, 0.5, 1, 1, 1) for r in rows], DOCS), labels


LABELS = "doc_id long, quality int, toxic int"


def test_learned_words_separate_held_out_documents(spark):
    docs, labels = made_docs(spark, [(None, None, None), (900, "", None), (901, "zorglnew zorgla", "xx"), (901, "zorglnew zorgla", "xx"), (902, "la " * 50_000, "en")])
    table = spark.createDataFrame([*labels, (None, 1, 1), (5, 0, None)], LABELS)
    got = toxicity.toxicity(docs, table).collect()
    assert len(got) == 405
    held = {r.doc_id: r for r in got if r.held_out}
    assert {i for i in held if i < 400} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r.predicted == int(i % 4 == 0) for i, r in held.items() if i < 400)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert by_id[None][0].score == by_id[900][0].score < 0.3 and not by_id[None][0].held_out
    assert len(by_id[901]) == 2 and by_id[901][0].predicted == 1  # a word that only its beginning gives away
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_held_out_labels_sources_and_languages_change_nothing(spark):
    docs, labels = made_docs(spark)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a = toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS)).select("doc_id", "score").collect()
    b = toxicity.toxicity(docs.withColumn("lang", F.lit("zz")), spark.createDataFrame(turned, LABELS)).select("doc_id", "score").collect()
    assert sorted(a) == sorted(b)


def test_near_copies_of_one_text_teach_no_words(spark):
    docs, labels = made_docs(spark)
    pick = random.Random(5)
    base = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    copies = []
    for i in range(1000, 1060):
        words = list(base)
        words[pick.randrange(120)] = f"changed{chr(97 + i % 26)}"
        copies.append((i, " ".join(words), "en", 0, 0.5, 1, 1, 1))
    more = spark.createDataFrame(copies, DOCS)
    table = spark.createDataFrame([*labels, *((r[0], 1, 1) for r in copies)], LABELS)
    lexicon, _ = toxicity.fit(docs.unionByName(more), table)
    assert not any(w.startswith("plain") for w in lexicon.words)
    assert any(s.startswith("zor") for s in lexicon.stems)


def test_toxicity_without_labels_or_documents(spark):
    docs, _ = made_docs(spark, [(500, "you idiot, you worthless moron", "en")])
    none = spark.createDataFrame([], LABELS)
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, none).collect()}
    assert got.pop(500) == 1 and not any(got.values())
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), none).count() == 0


def test_toxicity_finds_most_held_out_toxic_documents(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out and toxic is not null").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.03 * len(clean)


# --- R-tree -------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, shard int, block int, leaf int, first float, row string"


def brute_negatives(rows):
    kept = {}
    for vec_id, vec, label in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [math.floor(256 * x) for x in vec])
        kept[vec_id] = min(kept.get(vec_id, row), row)
    out = []
    for a, (label, vec) in kept.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vec, w)), i, k) for i, (k, w) in kept.items() if i != a)  # noqa: B905
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            window = [(-n, i) for n, i, k in scored if k != label and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(a, positive, rank, i, -p, n) for rank, (n, i) in enumerate(window, 1)]
    return sorted(out)


def awkward_vectors(spark, scale=1.0):
    import struct

    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    pick, rows = random.Random(11), []
    for i in range(700):
        label = pick.randrange(4)
        rows.append((i, [single(scale * (pick.gauss(0, 0.3) + (label == j))) for j in range(6)], label))
    rows += [(i, [single(scale * 0.5)] * 6, i % 3) for i in range(700, 1050)]  # a hot vector
    nan, inf = float("nan"), float("inf")
    rows += [(1100, None, 1), (1200, [1.0] * 6, None), (None, [1.0] * 6, 1), (1300, [nan] * 6, 1), (1400, [inf] + [0.0] * 5, 1), (1500, [None] * 6, 1)]
    rows += [(1600, [], 1), (1700, [single(scale)], 2), (1701, [0.0] * 6, 9), (100, [single(scale * 0.1)] * 6, 2)]
    return rows + rows[:20], spark.createDataFrame([(*r, 1, 2, 3, 0.5, "x") for r in rows + rows[:20]], VECTORS).repartition(4)


@pytest.mark.parametrize(("scale", "leaf", "least"), [(1.0, 8, 100), (1.0, 96, 5000), (1e5, 8, 300)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, scale, leaf, least):
    monkeypatch.setattr(rtree, "LEAST_SHARD", least)
    monkeypatch.setattr(rtree, "FANOUT", 3)
    monkeypatch.setattr(rtree, "BLOCK", 4)
    monkeypatch.setattr(rtree.pack, "__defaults__", (leaf,))
    rows, table = awkward_vectors(spark, scale)
    got = sorted(tuple(r) for r in rtree.hard_negatives(table).collect())
    assert got and got == brute_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert rtree.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    alone = spark.createDataFrame([(100, [1.0], 3)], "vec_id long, embedding array<float>, label int")
    assert rtree.hard_negatives(alone).count() == 0


def test_search_opens_few_boxes_of_separate_clusters(spark):
    """Boxes outside the wanted label, or below the kth best, stay shut."""
    pick = random.Random(2)
    rows = [(i, [pick.gauss(0, 0.02) + 3 * ((i // 400) == j) for j in range(4)], i // 400) for i in range(1600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    items = rtree.vectors(table)
    leaves = rtree.pack(items, 1600, 4, 16).toArrow()
    tree = rtree.Tree(leaves, 4, True)
    opened = []
    real = rtree.Best.offer
    anchor = rtree.np.array([768.0, 0.0, 0.0, 0.0])
    least, most = tree.bounds(anchor[None])
    best = rtree.Best(5, None, None)
    rtree.Best.offer = lambda self, *a: (opened.append(1), real(self, *a))[1]
    try:
        rtree.search(tree, anchor, least[0].tolist(), most[0].tolist(), 0, None, -1, [best])
    finally:
        rtree.Best.offer = real
    assert len(best.rows) == 5 and len(opened) * 4 < len(tree.rows)
