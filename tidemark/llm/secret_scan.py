"""Secrets in texts: known shapes, and strings that a tokenizer finds incompressible (operator 3).

Words of a language are a few characters to a token; random strings fall apart into tokens of one or two
characters. A long run of key characters with few characters per token is reported as ``random`` unless it is
a known digest, a number or an identifier made of words. Words at the ends of a run (``my-service-key-...``)
do not count: what stands between them is judged.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame

from tidemark.llm import words
from tidemark.llm.words import process_tables

VOCABULARY = "byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "random")
MIN_LENGTH = {"assign": 12, "access": 18, "hex": 16, "random": 20}
#: Characters per token at or below which a run counts as random.
DENSE = 2.2

_WORDS = re.compile(r"(?ai)pass|secret|token|api")
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_DIGEST = re.compile(r"(?i)[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}")
_UUID = re.compile(r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SEGMENT = re.compile(r"[A-Za-z0-9]+")
#: Parts of letters that are long enough to be told from chance, and characters per token that make one a word.
PART_LENGTH, WORD = 3, 2.5
#: What stands between the words at the ends of a run is judged by itself from this length on.
CORE = 16

_SCANNED = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, redacted string"
)


def _encoding() -> tiktoken.Encoding:
    tables = process_tables()
    if VOCABULARY not in tables:
        with open(public_tokenizers.path(VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        tables[VOCABULARY] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return tables[VOCABULARY]


def _is_word(part: str) -> bool:
    return part.isalpha() and len(part) >= PART_LENGTH and len(part) >= WORD * len(_encoding().encode_ordinary(f" {part.lower()}"))


def _core(run: str) -> str:
    """The run without the words, and one or two letters, that it begins and ends with; all of it if too little
    is left to judge."""

    def plain(segment: str) -> bool:
        return all(map(_is_word, _PART.findall(segment))) or (segment.isalpha() and len(segment) < PART_LENGTH)

    odd = [m for m in _SEGMENT.finditer(run) if not plain(m[0])]
    if not odd or odd[-1].end() - odd[0].start() < CORE:
        return run
    return run[odd[0].start() : odd[-1].end()]


def _identifier(run: str) -> bool:
    """A digest, a number, or words joined by signs or capitals: half of its letters and digits or more are words."""
    if _DIGEST.fullmatch(run) or _UUID.fullmatch(run):
        return True
    parts = _PART.findall(run)
    if all(p.isdigit() for p in parts):
        return True
    long = [p for p in parts if len(p) >= PART_LENGTH and p.isalpha()]
    return 2 * sum(map(len, long)) >= sum(map(len, parts)) and all(map(_is_word, long))


def _random(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for m in _RUN.finditer(text):
        if any(a < m.end() and m.start() < b for a, b in taken):
            continue
        run = _core(m.group())
        if _identifier(run):
            continue
        if len(run) / len(_encoding().encode_ordinary(run)) <= DENSE:
            out.append(m.span())
    return out


def scan(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, in code points; those of one kind do not overlap."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if _WORDS.search(text):
        found["assign"] = [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_LENGTH["assign"]]
    if "AKIA" in text:
        found["access"] = [m.span() for m in _ACCESS.finditer(text) if len(m[0]) >= MIN_LENGTH["access"]]
    found["hex"] = [m.span() for m in _HEX.finditer(text)]
    found["random"] = _random(text, [s for kind in KINDS[:3] for s in found[kind]])
    return found


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    order = sorted((a, kinds.index(k), b) for k in kinds for a, b in found[k])
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in order)


def redact(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each stretch of overlapping spans replaced by a placeholder."""
    out, at, covered = [], 0, 0
    for a, b in sorted(s for spans in found.values() for s in spans):
        if a >= covered:
            out += [text[at:a], "[SECRET]"]
        covered = max(covered, b)
        at = covered
    return "".join([*out, text[at:]])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.string()] * 3
    names = [x.split()[0] for x in _SCANNED.split(", ")]
    for batch in batches:
        rows = []
        for doc, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            text = value.as_py() or ""
            found = scan(text)
            base = joined(found, KINDS[:3])
            changed = redact(text, found) if any(found.values()) else None
            rows.append(
                (doc, *(len(found[k]) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(found, KINDS), changed)
            )
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans, redacted) for each row of ``docs``.

    Null text is empty and has no spans; without spans ``spans`` is empty and ``redacted`` null. Each row is
    judged by itself, so repeated and null doc_ids need no rule. Other columns are ignored.
    """
    return docs.select("doc_id", "text").mapInArrow(_scanned, _SCANNED)


@words.frugal
def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for value in batch.column("text"):
            text = value.as_py()
            found = scan(text or "")
            texts.append(redact(text, found) if any(found.values()) else text)
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))


def without_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span in ``text`` replaced by a placeholder; all columns stay."""
    return docs.mapInArrow(_redacted, docs.schema)
