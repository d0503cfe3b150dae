"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Merging is not replayed.  For every prefix of a piece the last token of its encoding is
stored: it is the one token ending there, among those an automaton over the vocabulary
reports, that is compatible with the last token of the prefix in front of it.  Following
the stored tokens back from the end emits the ids, which equal those of merging.

Two tokens are compatible when no merge crosses their border.  The last parts of the left
token and the first parts of the right one exist during intervals of merge ranks; a merge
of two such parts that is due while both exist crosses the border.

Defined results: null and empty texts have no ids; the strings of special tokens in a text
become their ids, as the library does by default.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import quoted
from siltworks.llm.tokens import Remembered, TextEncoder, byte_letters

_NEVER = 1 << 60
#: chunks, pieces and token pairs remembered per worker
REMEMBERED = 150_000
#: rows handed on at a time
ROWS = 500


class PrefixEncoder:
    """Exact ids of single pieces for a byte-level vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        bytes_of = {letter: chr(b) for b, letter in enumerate(byte_letters())}
        raw = lambda token: "".join(bytes_of[x] for x in token)
        vocabulary = {raw(token): id for token, id in rules["model"]["vocab"].items()}
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        for rank, pair in enumerate(rules["model"]["merges"]):
            left, right = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            a, b = vocabulary[left], vocabulary[right]
            self.merges[a, b] = rank
            self.parts.setdefault(vocabulary[left + right], (a, b, rank))
        self.automaton = ahocorasick.Automaton()
        for token, id in vocabulary.items():
            self.automaton.add_word(token, (id, len(token)))
        self.automaton.make_automaton()
        self.length = {id: len(token) for token, id in vocabulary.items()}
        self.spines = Remembered(self._spine)
        self.fits = Remembered(self._compatible, REMEMBERED)
        self.whole = Remembered(self._reachable)

    def _spine(self, key: tuple[int, int]) -> list[tuple[int, int]]:
        """From the outermost byte inwards: a part at one side and the rank at which it goes on."""
        token, side = key
        chain = [(token, _NEVER)]
        while chain[-1][0] in self.parts:
            left, right, rank = self.parts[chain[-1][0]]
            chain.append((right if side else left, rank))
        return chain[::-1]

    def _border(self, left: int, right: int) -> int | None:
        """The rank of the first merge across the border of two tokens, None if there is none."""
        a, b = self.spines[left, 1], self.spines[right, 0]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.merges.get((x, y))
            # of two merges with one rank, the one further left comes first
            if rank is not None and rank < x_ends and rank <= y_ends:
                return rank
            if x_ends == y_ends == _NEVER:
                return None
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self._border(*pair) is None

    def _reachable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives that one token."""
        if token not in self.parts:
            return self.length[token] == 1
        left, right, rank = self.parts[token]
        return self.whole[left] and self.whole[right] and self._border(left, right) == rank

    def __call__(self, piece: str) -> list[int]:
        text = piece.encode().decode("latin-1")
        last = [0] * (len(text) + 1)  # the last token of each prefix
        known = [True] + [False] * len(text)
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            start = end - size
            if known[end] or not known[start] or not self.whole[token]:
                continue
            if start == 0 or self.fits[last[start], token]:
                last[end], known[end] = token, True
        ids, end = [], len(text)
        while end:
            ids.append(last[end])
            end -= self.length[last[end]]
        return ids[::-1]


class Decoder:
    """Texts from ids by the bytes of the vocabulary's tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        bytes_of = {letter: b for b, letter in enumerate(byte_letters())}
        known = {id: bytes(bytes_of[x] for x in token) for token, id in rules["model"]["vocab"].items()}
        known |= {t["id"]: t["content"].encode() for t in rules["added_tokens"]}
        self.table = [known.get(i, b"") for i in range(max(known) + 1)]

    def __call__(self, ids: bytes | None) -> str:
        tokens = np.frombuffer(ids or b"", "<u4").tolist()
        return b"".join(map(self.table.__getitem__, tokens)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path, PrefixEncoder(path), REMEMBERED)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            yield batch.iloc[start : start + ROWS]


def encode_texts(df: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = text_encoder(tokenizer).encode
        for rows in _slices(batches):
            yield pd.DataFrame({"doc_id": rows["doc_id"], "ids": [encode(text) for text in rows["text"]]})

    rows = df.select(quoted(id).cast("string").alias("doc_id"), quoted(text).alias("text"))
    return _typed(rows.mapInPandas(run, "doc_id string, ids binary"), df, id)


def decode_texts(df: DataFrame, tokenizer: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, ids, text): the text that the ids stand for; null ids give an empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = decoder(tokenizer)
        for rows in _slices(batches):
            yield rows.assign(text=[decode(raw) for raw in rows["ids"]])

    rows = df.select(quoted(id).cast("string").alias("doc_id"), quoted(ids).alias("ids"))
    return _typed(rows.mapInPandas(run, "doc_id string, ids binary, text string"), df, id)


def _typed(out: DataFrame, df: DataFrame, id: str) -> DataFrame:
    return out.withColumn("doc_id", F.col("doc_id").cast(df.schema[id].dataType))
