"""Token ids of whole texts by a public tokenizer, encoding each distinct word once per task.

Byte-level BPE never merges across a space that precedes a word, nor across a single line break between
two words, nor from a letter to a sign. Texts are cut there on Arrow's buffers, the tokenizers library encodes
the distinct parts, and parts it has seen are not encoded again.
"""

from __future__ import annotations

import functools
import string
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tidemark.llm import words
from tidemark.llm.words import process_tables

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Parts a task remembers at least; twice as many at most.
REMEMBERED = 400_000
#: Bytes of whole texts that are cut and looked up together.
CHUNK_BYTES = 1 << 22
_LAST_PLAIN = "\u024f"  # up to here every version of Unicode agrees on what a letter is


def _byte_letters() -> dict[int, str]:
    """Fixed values of byte-level BPE: the letter that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


#: For each byte, whether it is an ASCII sign.
_SIGN = bytes(chr(b) in string.punctuation for b in range(256))
#: White space beyond ASCII, by the bytes of UTF-8.
_WIDE = [chr(c).encode() for c in range(128, 0x3001) if chr(c).isspace()]
_TWO, _THREE = (np.array([int.from_bytes(x) for x in _WIDE if len(x) == n]) for n in (2, 3))


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a part begins in the bytes of texts that begin at ``offsets``; each text begins a part.

    A part begins at a space before what is no white space; at a line break between two such characters, and after
    it; and at an ASCII sign after an ASCII or a Latin-1 letter. Where in doubt, nothing is cut.
    """
    size = len(data)
    begins = np.zeros(size + 1, bool)
    begins[offsets] = True
    pad = np.concatenate([np.zeros(2, np.uint8), data, np.zeros(3, np.uint8)])

    def solid(places: np.ndarray, last: bool) -> np.ndarray:
        """Whether the character that begins (or has its last byte) at each place of a text is no white space."""
        out = data[places] > 32
        doubt = np.flatnonzero(data[places] >= 128)
        at = places[doubt] + 2
        byte = [pad[at + k].astype(np.uint32) for k in ((-2, -1, 0) if last else (0, 1, 2))]
        two = byte[1] << 8 | byte[2] if last else byte[0] << 8 | byte[1]
        three = byte[0] << 16 | byte[1] << 8 | byte[2]
        out[doubt] = ~(np.isin(two, _TWO) | np.isin(three, _THREE))
        return out

    cut = begins[:size].copy()
    spaces = np.flatnonzero(data == 32)
    spaces = spaces[~begins[spaces + 1]]
    cut[spaces[solid(spaces + 1, False)]] = True
    breaks = np.flatnonzero(data == 10)
    breaks = breaks[~begins[breaks] & ~begins[breaks + 1]]
    breaks = breaks[solid(breaks - 1, True) & solid(breaks + 1, False)]
    cut[breaks] = cut[breaks + 1] = True
    letter = (data | 32) - np.uint8(97) < 26
    wide = np.flatnonzero(data == 0xC3) + 1
    wide = wide[wide < size]
    letter[wide] = (data[wide] != 0x97) & (data[wide] != 0xB7)  # the signs of multiplication and division
    cut[1:] |= letter[:-1] & np.frombuffer(data.tobytes().translate(_SIGN), bool)[1:]
    return np.flatnonzero(cut)


class _Parts(dict):
    """Ids of parts of texts; those not used since the last change of generation are forgotten."""

    def __init__(self, tokenizer: Tokenizer, before: str) -> None:
        self.tokenizer, self.before, self.model = tokenizer, before, tokenizer.model
        self.letters, self.older = _byte_letters(), {}
        self.before_ascii = before.translate(self.letters)
        self.signs = functools.lru_cache(1 << 12)(self._encoded)  # a run of signs after a word is encoded by itself

    def forget(self) -> None:
        self.clear()
        self.older = {}
        self.signs.cache_clear()

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, part: str) -> bytes:
        """One word of plain letters: the model alone, without a regular expression."""
        if part.isascii():
            spelled = self.before_ascii + part
        else:
            spelled = (self.before + part).encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def __missing__(self, part: str) -> bytes:
        made = self.older.pop(part, None)
        if made is None:
            word = part if part.isalpha() else part.rstrip(string.punctuation)
            if word.isalpha() and (word.isascii() or max(word) <= _LAST_PLAIN):
                made = self._word(part) if len(word) == len(part) else self[word] + self.signs(part[len(word) :])
            else:
                made = self._encoded(self.before + part)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[part] = made
        return made


class Encoder:
    """Ids of texts as unsigned 32-bit integers, without an end id."""

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.first, self.rest = _Parts(tokenizer, ""), _Parts(tokenizer, " ")

    def __call__(self, text: str) -> bytes:
        """Ids of one text, little-endian."""
        return next(self.many(pa.array([text], pa.string()))).tobytes()

    def many(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; null is empty. Within a run of texts each distinct part is looked up once."""
        for _, _, data, offsets in words.chunks(texts, CHUNK_BYTES):
            cuts = _cuts(data, offsets)
            ends = pa.py_buffer(np.append(cuts, len(data)).astype(np.int32))
            parts = pa.StringArray.from_buffers(len(cuts), ends, pa.py_buffer(data)).dictionary_encode()
            first, rest = self.first, self.rest
            found = [rest[x[1:]] if x[0] == " " else first[x] for x in parts.dictionary.to_numpy(zero_copy_only=False)]
            flat = np.frombuffer(b"".join(found), "<u4")
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            which = parts.indices.to_numpy()
            counts, stops = sizes[which], np.zeros(len(which) + 1, np.int64)
            np.cumsum(counts, out=stops[1:])
            ids = np.repeat((np.cumsum(sizes) - sizes)[which] - stops[:-1], counts)
            ids += np.arange(len(ids))
            ids = flat[ids]
            bounds = stops[np.searchsorted(cuts, offsets)]
            yield from (ids[k:n] for k, n in zip(bounds[:-1], bounds[1:], strict=True))


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    tables = process_tables()
    if ("encoder", vocabulary) not in tables:
        tables["encoder", vocabulary] = Encoder(vocabulary)
    return tables["encoder", vocabulary]


def forgotten_after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, at whose end the worker's encoders forget the parts they have seen.

    A worker lives on and runs tasks of other steps, which share its executor's memory; a task of a few thousand
    documents gains nothing from what tasks before it remembered.
    """
    try:
        yield from batches
    finally:
        for key, kept in process_tables().items():
            if isinstance(key, tuple) and key[0] == "encoder":
                kept.first.forget()
                kept.rest.forget()
