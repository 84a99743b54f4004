"""BPE encoding and decoding with a public word-level vocabulary file.

Each word's merges come off a priority queue of (rank, position) over a doubly
linked list of symbols; entries whose symbols have changed since are stale and
skipped. Decoding joins vocabulary strings.

Defined results: a null text is an empty one; an empty text has no tokens; the
strings of special tokens inside a text become their ids; texts of any length
and single words of any length are encoded whole; repeated rows repeat their
result; extra columns are ignored by `encode` and never clash, as only the id
and the text are read.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import map_arrow

#: Words in each of the two generations of a worker's cache; when the young one is full it becomes the old one.
CACHE_WORDS = 250_000
#: Longer words are encoded each time.
CACHE_LETTERS = 48

_SPACE = r"\t-\r \x85\xa0  -     　"

#: Code points that are letters or numbers to the pattern library since Unicode 17, and not to the vocabulary's own pattern.
_UNICODE_17 = """
558-558 58B-58C 88F-88F C5C-C5C CDC-CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD A7E2-A7E2 A7F1-A7F1
AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9 11DF1-11DF1 1246F-1246F
12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191
191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2
1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD
"""
_LATER = "--[" + "".join("-".join(f"\\U{int(c, 16):08X}" for c in run.split("-")) for run in _UNICODE_17.split()) + "]"
_WORDS = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}{_LATER}]+|[\p{{N}}{_LATER}]|[^{_SPACE}[\p{{L}}\p{{N}}{_LATER}]]+")
#: Capitals of Unicode 16 and 17 with their small letters, unknown to str.lower() here.
_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {0x3A3: 0x3C3}
#: The same for texts of Latin letters only, below U+0180, in a library that is faster and knows no letter classes.
_LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]|[^\\t-\\r \x85\xa00-9a-zªµºß-öø-ſ²³¹¼½¾]+")
_BEYOND_LATIN = re.compile("[^\0-ſ]")
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


#: Bits of an id and, in a queue entry, of a place in a word (in bytes).
ID_BITS, PLACE = 20, (1 << 40) - 1


def _four_bytes(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class WordBPE(dict):
    """A vocabulary file's encoder and decoder; as a dict it caches the ids of words, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if max(vocab.values()) >> ID_BITS:
            raise ValueError(f"{path}: ids beyond {ID_BITS} bits")
        self.merges = {vocab[a] << ID_BITS | vocab[b]: (rank << ID_BITS + 40, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.old: dict[str, bytes] = {}
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word. Queue entries are single numbers: rank, then place, then the new id."""
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        n, found = len(ids), self.merges.get
        queue = []
        for at in range(n - 1):
            if (m := found(ids[at] << ID_BITS | ids[at + 1])) is not None:
                queue.append(m[0] | at << ID_BITS | m[1])
        if not queue:
            return ids
        heapify(queue)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        while queue:
            entry = heappop(queue)
            at = entry >> ID_BITS & PLACE
            right = after[at]
            if right < 0 or ids[at] < 0:
                continue  # stale
            m = found(ids[at] << ID_BITS | ids[right])
            if m is None or m[0] | at << ID_BITS | m[1] != entry:
                continue  # stale
            new = ids[at] = m[1]
            ids[right] = -1
            after[at] = right = after[right]
            if right >= 0:
                before[right] = at
                if (m := found(new << ID_BITS | ids[right])) is not None:
                    heappush(queue, m[0] | at << ID_BITS | m[1])
            left = before[at]
            if left >= 0 and (m := found(ids[left] << ID_BITS | new)) is not None:
                heappush(queue, m[0] | left << ID_BITS | m[1])
        return [i for i in ids if i >= 0]

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word) or _four_bytes(self.merge(word.encode()))
        if len(word) <= CACHE_LETTERS:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    @staticmethod
    def words(text: str) -> list[str]:
        """The normalised words of a text without special tokens."""
        if text.isascii():
            return _ASCII_WORDS.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        if _BEYOND_LATIN.search(text):
            # Letters are lowered one by one: a capital sigma becomes the plain small one wherever it stands.
            return _WORDS.findall(text.translate(_LOWER).lower())
        return (_LATIN_WORDS if "\u0130" not in text else _WORDS).findall(text.lower())

    def pieces(self, text: str) -> list[str]:
        """The words and special tokens of a text (no word can equal a special token, as words of signs hold no letters)."""
        if "<|" not in text:
            return self.words(text)
        return [w for x in self.splits.split(text) if x for w in ([x] if x in self.special else self.words(x))]

    def encode(self, text: str) -> bytes:
        """The ids of a text, four little-endian bytes each."""
        if "<|" not in text:
            return b"".join(map(self.__getitem__, self.words(text)))
        special = self.special
        return b"".join(special[x].to_bytes(4, "little") if x in special else b"".join(map(self.__getitem__, self.words(x))) for x in self.splits.split(text) if x)

    def decode(self, ids: bytes) -> str:
        """The vocabulary's strings for the ids, special ones too; the file names no decoder, so a space joins them."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, WordBPE] = {}


def load(path: str) -> WordBPE:
    """The worker's encoder for a vocabulary file on its own disk."""
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """One row per document: id, n_tokens, ids (packed unsigned 32-bit little-endian), decoded; one narrow pass, no shuffle."""
    fields = [("n_tokens", pa.int64())] + [("ids", pa.binary())] * with_ids + [("decoded", pa.string())] * with_text
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = [bpe.encode(t) for t in batch.column("text").to_pylist()]
                out = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": ids}
                if with_text:
                    out["decoded"] = [bpe.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([batch.column("doc"), *(pa.array(out[k], kind) for k, kind in fields)], names=["doc", *(k for k, _ in fields)])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc {kind}, n_tokens long" + ", ids binary" * with_ids + ", decoded string" * with_text
    return map_arrow(rows, run, schema).withColumnRenamed("doc", id_col)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return encode(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
