"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs, and its decoding.

The tree has a leaf for each adjacent pair of a word, holding the pair's merge rank and place;
its root is the lowest rank, leftmost among equals. A merge changes three leaves, each in a
logarithmic number of steps, until the root has no mergeable pair. Pieces between white space
are encoded on their own, because no token spans white space, and kept in a bounded cache.

The vocabulary travels as one broadcast of the tokenizer file, which has a fixed size.

Null text counts as empty and gives no ids. Very long texts need memory in proportion to the
text. Further columns of the input pass through; one that is called like an output column is
replaced by it.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, extended, held

NONE = 1 << 62
CACHE_ENTRIES = 150_000
LONGEST_CACHED = 64
# White_Space of the Unicode character database.
PIECE = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# White space, visible ASCII and the letters of Latin-1: no normal form changes such a text.
LATIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
# Fixed value: the word pattern of the tokenizer file, over those characters in lower case.
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")
# Bytes that are not visible Latin-1 stand at U+0100 and on, in order.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_ALPHABET = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Recent[T]:
    """A cache of bounded size: a full generation replaces the one before it."""

    def __init__(self, make: Callable[[str], T]) -> None:
        self.make = make
        self.new: dict[str, T] = {}
        self.old: dict[str, T] = {}

    def find(self, key: str) -> T:
        """The value of a key that is not in ``new``."""
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_CACHED:
            if len(self.new) >= CACHE_ENTRIES:
                self.old, self.new = self.new, {}
            self.new[key] = value
        return value

    def all(self, keys: list[str]) -> list[T]:
        get, find = self.new.get, self.find
        found = [get(k) for k in keys]
        if None in found:
            found = [find(k) if v is None else v for k, v in zip(keys, found, strict=True)]
        return found


class PairTree:
    """Lowest (rank, place) over a row of leaves, with point updates."""

    def __init__(self, keys: list[int]) -> None:
        self.size = 1
        while self.size < len(keys):
            self.size *= 2
        row = keys + [NONE] * (self.size - len(keys))
        tree = row
        while len(row) > 1:
            row = list(map(min, row[::2], row[1::2]))
            tree = row + tree
        self.tree = [NONE, *tree]

    def put(self, place: int, key: int) -> None:
        tree = self.tree
        k = self.size + place
        if tree[k] == key:
            return
        tree[k] = key
        while k > 1:
            beside = tree[k ^ 1]
            low = key if key < beside else beside
            k >>= 1
            if tree[k] == low:
                break
            tree[k] = key = low


class Bpe:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, content: str) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): k for k, (a, b) in enumerate(pairs)}
        self.joined = [self.vocab[a + b] for a, b in pairs]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, longest))) if longest else None
        # Only normalising and cutting into words of rarer scripts are taken from the library.
        library = Tokenizer.from_str(content)
        self.normal = library.normalizer.normalize_str
        self.cut = library.pre_tokenizer.pre_tokenize_str
        self.pieces: Recent[bytes] = Recent(self.piece)
        self.words: Recent[bytes] = Recent(self.word)

    def merge(self, word: str) -> list[int]:
        """Ids of one word, given in the byte alphabet of the vocabulary."""
        vocab = self.vocab
        names = [*word[:-1], word[-1] + self.suffix]
        ids = [vocab[n] for n in names if n in vocab]
        n = len(ids)
        if n < 2:
            return ids
        width = n.bit_length()
        mask = (1 << width) - 1
        rank, joined = self.rank.get, self.joined
        # Key of a leaf: rank, then place, so that equal ranks go from left to right.
        tree = PairTree(
            [
                NONE if (r := rank(pair)) is None else r << width | k
                for k, pair in enumerate(zip(ids, ids[1:]))
            ]
        )
        put, root = tree.put, tree.tree
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := root[1]) != NONE:
            left = low & mask
            right = after[left]
            made = ids[left] = joined[low >> width]
            ids[right] = -1
            follows = after[left] = after[right]
            key = NONE
            if follows < n:
                before[follows] = left
                put(right, NONE)
                if (r := rank((made, ids[follows]))) is not None:
                    key = r << width | left
            put(left, key)
            if (first := before[left]) >= 0:
                r = rank((ids[first], made))
                put(first, NONE if r is None else r << width | first)
        return [i for i in ids if i >= 0]

    def coded(self, words: list[str]) -> bytes:
        """Ids (little-endian) of words in the byte alphabet."""
        ids = [i for word in words for i in self.merge(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        """Of one word of a Latin text."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_ALPHABET)
        return self.coded([word])

    def piece(self, piece: str) -> bytes:
        """Of any text without white space."""
        return self.coded([w for w, _ in self.cut(self.normal(piece))])

    def _plain(self, text: str) -> list[bytes]:
        if LATIN.fullmatch(text):
            return self.words.all(LATIN_WORDS.findall(text.lower()))
        return self.pieces.all(PIECE.findall(text))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        ids: list[bytes] = []
        at = 0
        for found in self.split.finditer(text) if self.split else ():
            ids += self._plain(text[at : found.start()])
            ids.append(self.special[found[0]].to_bytes(4, "little"))
            at = found.end()
        ids += self._plain(text[at:])
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """Tokens of known ids, joined by spaces, as a tokenizer without a decoder does."""
        known = map(self.tokens.get, np.frombuffer(ids, "<u4").tolist())
        return " ".join([t for t in known if t is not None])


HELD = "tokenizer"


def load(content: str) -> Bpe:
    """One encoder for each worker process, kept for later tasks until another operator runs there."""
    return held(HELD, hashlib.sha256(content.encode()).hexdigest(), lambda: Bpe(content))


def _with_columns(frame: DataFrame, text: str, made: dict[str, pa.DataType], start):
    """``frame`` with the columns made of ``text``. ``start`` gives the function, once a task."""
    from pyspark.sql.pandas.types import from_arrow_type

    kept = [c for c in frame.columns if c not in made or c == text]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    passed = [k for k, c in enumerate(kept) if c not in made]
    at = kept.index(text)
    schema = extended(
        source.select(*(F.col(f"`{kept[k]}`") for k in passed)).schema,
        **{name: from_arrow_type(kind) for name, kind in made.items()},
    )

    def run(batches):
        function = start()
        for batch in batches:
            rows = [function(value) for value in batch.column(at).to_pylist()]
            columns = [
                pa.array([row[k] for row in rows], type=kind)
                for k, kind in enumerate(made.values())
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in passed), *columns],
                names=[*(kept[k] for k in passed), *made],
            )

    return arrow_map(source, run, schema, HELD)


def encode(frame: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (binary, little-endian unsigned 32-bit)."""
    content = Path(tokenizer).read_text(encoding="utf-8")
    shared = frame.sparkSession.sparkContext.broadcast(content)

    def start():
        coder = load(shared.value)
        return lambda value: (coder.encode(value or ""),)

    return _with_columns(frame, text, {"ids": pa.binary()}, start)


def decode(frame: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of ``ids``, which stay; null ids count as none."""
    content = Path(tokenizer).read_text(encoding="utf-8")
    shared = frame.sparkSession.sparkContext.broadcast(content)

    def start():
        coder = load(shared.value)
        return lambda value: (coder.decode(value or b""),)

    return _with_columns(frame, ids, {"decoded": pa.string()}, start)
