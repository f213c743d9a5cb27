"""Problem 6: the corpus as ids of a public byte-level tokenizer.

A piece of the pre-tokenizer is either a vocabulary entry or is encoded by backtracking: an Aho-Corasick automaton
over the vocabulary (bytes mapped to Latin-1) gives the longest entry at each place; the encoder takes it if it may
stand beside the entry before it, else the next shorter entry, else goes one entry back. Two entries may stand side by
side if merging their joined bytes gives just these two back; this is memoised. The encoding of every prefix is
unique, so a place that led nowhere is never tried again and the work is linear in the length of the piece.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sources.tables import table

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the public pre-tokenizer pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a worker's memory of pieces and of pairs; it starts afresh when full, which changes no result.
PIECES_KEPT, PAIRS_KEPT, PIECE_LENGTH_KEPT = 300_000, 1_000_000, 64
#: Token ids after which an output batch is handed over.
BATCH_IDS = 2_000_000


class Encoder:
    """Encoder of one vocabulary, given as the text of its rank file."""

    def __init__(self, ranks: bytes):
        lines = (line.split() for line in ranks.splitlines() if line)
        self.word_of = {int(rank): base64.b64decode(word).decode("latin-1") for word, rank in lines}
        self.id_of = {word: i for i, word in self.word_of.items()}
        self.length = {i: len(word) for i, word in self.word_of.items()}
        self.shorter = {}
        self.automaton = ahocorasick.Automaton()
        for word, i in self.id_of.items():
            self.automaton.add_word(word, (i, len(word)))
            self.shorter[i] = next((self.id_of[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in self.id_of), None)
        self.automaton.make_automaton()
        self.split = regex.compile(PATTERN).findall
        self.pieces: dict[str, list[int]] = {}
        self.pairs: dict[int, bool] = {}

    def merged(self, word: str) -> list[int]:
        """Plain merging, lowest rank first and leftmost of equals; for the short strings of a pair."""
        parts = list(word)
        while len(parts) > 1:
            ranks = [self.id_of.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [self.id_of[p] for p in parts]

    def beside(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(self.word_of[a] + self.word_of[b]) == [a, b]
        return known

    def piece(self, word: str) -> list[int]:
        """Ids of one piece, its bytes as Latin-1."""
        whole = self.id_of.get(word)
        if whole is not None:
            return [whole]
        size, longest = len(word), [0] * len(word)
        for end, (i, n) in self.automaton.iter(word):
            longest[end - n + 1] = i
        dead, out, at, take = bytearray(size + 1), [], 0, longest[0]
        while at < size:
            while take is not None and (dead[at + self.length[take]] or out and not self.beside(out[-1], take)):
                take = self.shorter[take]
            if take is None:
                dead[at] = 1
                take = out.pop()
                at -= self.length[take]
                take = self.shorter[take]
                continue
            out.append(take)
            at += self.length[take]
            take = longest[at] if at < size else None
        return out

    def text(self, text: str) -> list[int]:
        out: list[int] = []
        known = self.pieces.get
        for p in self.split(text):
            out += known(p) or self.learn(p)
        return out

    def learn(self, p: str) -> list[int]:
        ids = self.piece(p.encode("utf-8").decode("latin-1"))
        if len(p) <= PIECE_LENGTH_KEPT:
            if len(self.pieces) >= PIECES_KEPT:
                self.pieces.clear()
            self.pieces[p] = ids
        return ids


_ENCODERS: dict[int, Encoder] = {}


def encoder(ranks: Broadcast) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    key = hash(ranks.value)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranks.value)
    return _ENCODERS[key]


def rank_file(spark: SparkSession, vocabulary: str, folder: str) -> Broadcast:
    """The vocabulary's rank file, under 2 MB whatever the corpus."""
    with open(f"{folder}/{vocabulary}.tiktoken", "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, key: str, text: str, vocabulary: str = "byte_bpe_50k", folder: str = TOKENIZERS, counts: bool = False) -> DataFrame:
    """(key, ids) or, with ``counts``, (key, n): one row for each row of ``df``, repeated keys included.

    A null or empty text has no ids. Strings of special tokens are ordinary text.
    """
    ranks = rank_file(df.sparkSession, vocabulary, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        for batch in batches:
            keys, ids, sizes, start = batch.column(0), [], [], 0
            for row, value in enumerate(batch.column(1)):
                value = value.as_py()
                before = len(ids)
                if value:
                    ids.extend(enc.text(value))
                sizes.append(len(ids) - before)
                if len(ids) > BATCH_IDS:
                    yield packed(keys.slice(start, row + 1 - start), ids, sizes)
                    ids, sizes, start = [], [], row + 1
            if sizes:
                yield packed(keys.slice(start), ids, sizes)

    def packed(keys: pa.Array, ids: list[int], sizes: list[int]) -> pa.RecordBatch:
        if counts:
            return pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64())], names=[key, "n"])
        offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, n bigint" if counts else f"{key} {kind}, ids array<int>")


def p6_ids(spark: SparkSession, folder: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Every document as ids of byte_bpe_50k, without special tokens."""
    return encode(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text", "byte_bpe_50k", tokenizers)
