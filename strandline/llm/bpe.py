"""BPE encoding with forced boundaries, and decoding.

Two bytes that are neighbours inside no token of the vocabulary can never be merged, so a word may be cut between
them; fragments are encoded one by one and their ids joined. A task keeps the ids of the fragments and words it has met in
a cache of ``CACHE`` bytes that is emptied when full, which changes no result; cache and vocabulary go when the task
ends, so a reused worker holds neither. Works for the ``word_bpe`` kind of file: NFC, lower case, white space dropped,
byte-level letters and a mark on the last letter of a word. Special tokens in a text are single ids, as in the library.

A null or empty text has no tokens. Repeated rows and null ids are rows like others. An empty table gives an empty
result. Columns other than id and text are ignored. The vocabulary's path must be readable on every worker; the file is never copied.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._tokens import release

WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Texts of these characters alone are split here; others by the library's own tables.
PLAIN = regex.compile(r"[\t\n\x0b\x0c\r\x20-\x7e¡-ɏ]*")
#: Bytes that a task's cache may take, about.
CACHE = 64 << 20
#: What an entry takes beside its text and ids.
ENTRY = 250


class Encoder:
    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.library = Tokenizer.from_file(path)
        self.last = models.BPE(self.vocab, merges, end_of_word_suffix=self.end)
        self.inner = models.BPE(self.vocab, merges, end_of_word_suffix="")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.text_of = {str(i): t for i, t in self.token.items()}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        #: What all special tokens begin with; a text without it holds none.
        self.mark = os.path.commonprefix(list(self.special))
        bare = [t[: -len(self.end)] if self.end and t.endswith(self.end) else t for t in self.vocab]
        self.pairs = {t[k : k + 2] for t in bare for k in range(len(t) - 1)}
        self.letter = self._letters()
        self.cache, self.held, self.words, self.parts = cache, 0, {}, {}

    @staticmethod
    def _letters() -> list[str]:
        """The letter that stands for each byte."""
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = iter(range(256, 512))
        return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]

    def cuts(self, letters: str) -> list[int]:
        """Where a word must be cut: between letters that no token has side by side."""
        pairs = self.pairs
        return [k for k in range(1, len(letters)) if letters[k - 1 : k + 1] not in pairs]

    def _part(self, letters: str, final: bool) -> list[int]:
        key = (letters, final)
        if (ids := self.parts.get(key)) is None:
            ids = self.parts[key] = [t.id for t in (self.last if final else self.inner).tokenize(letters)]
            self.held += ENTRY + len(letters) + 40 * len(ids)
        return ids

    def _word(self, word: str) -> str:
        """The ids of a word that isn't in the cache, as text."""
        if self.held > self.cache:
            self.words.clear()
            self.parts.clear()
            self.held = 0
        letters = word if word.isascii() and word.isprintable() else "".join([self.letter[b] for b in word.encode()])
        if at := self.cuts(letters):
            ends = [*at, len(letters)]
            ids = [i for a, b in zip([0, *at], ends, strict=True) for i in self._part(letters[a:b], b == len(letters))]
        else:
            ids = [t.id for t in self.last.tokenize(letters)]
        out = self.words[word] = " ".join(map(str, ids))
        self.held += ENTRY + 2 * len(word) + len(out)
        return out

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if PLAIN.fullmatch(text):
            return WORD.findall(unicodedata.normalize("NFC", text).lower())
        normal = self.library.normalizer.normalize_str(text)
        back = {c: b for b, c in enumerate(self.letter)}
        return [bytes(back[c] for c in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str) -> str:
        """Ids in decimal, joined by spaces."""
        if self.splitter is not None and self.mark in text:
            parts = self.splitter.split(text)
            return " ".join(filter(None, (str(self.special[p]) if p in self.special else self._plain(p) for p in parts)))
        return self._plain(text)

    def _plain(self, text: str) -> str:
        words, get, miss = self.words, self.words.get, self._word
        return " ".join([get(w) or miss(w) for w in self.split(text)])

    def decode(self, ids: str) -> str:
        """The library's decoding without a decoder: tokens joined by spaces."""
        text_of = self.text_of
        return " ".join([text_of[i] for i in ids.split(" ")]) if ids else ""


@contextmanager
def encoder(path: str) -> Iterator[Encoder]:
    """One for a task; what it held is given back at the end."""
    own = Encoder(path)
    try:
        yield own
    finally:
        own.__dict__.clear()
        release()


def _numbers(ids: str) -> np.ndarray:
    return np.array(ids.split(" "), np.int32) if ids else np.zeros(0, np.int32)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as own:
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    part = batch.slice(a, 256)
                    ids = pa.array([_numbers(own.encode(t or "")) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["_id", "ids"])

    key = F.col(f"`{id_col}`").alias("_id")
    kind = docs.select(key).dtypes[0][1]
    return docs.select(key, F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """encoded with its ids decoded in ``text``; null ids give an empty text."""

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with encoder(path) as own:
            for ids in parts:
                yield ids.map(lambda x: " ".join([own.token[i] for i in x]) if x is not None else "")

    return encoded.withColumn("text", text(F.col(f"`{ids_col}`")))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text where it is read: id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as own:
            for batch in batches:
                yield from digest(own, batch)

    def digest(own: Encoder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, first, second = [], [], []
        for text in batch.column(1):
            ids = own.encode(text.as_py() or "")
            n.append(ids.count(" ") + 1 if ids else 0)
            first.append(hashlib.sha256(ids.encode()).hexdigest())
            second.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        if n:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    key = F.col(f"`{id_col}`").alias("_id")
    kind = docs.select(key).dtypes[0][1]
    rows = docs.select(key, F.col(f"`{text_col}`").alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("_id", id_col)
