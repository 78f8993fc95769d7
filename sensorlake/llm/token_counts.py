r"""Token counts by byte-pair merging.

Each word of a text starts as one symbol per UTF-8 byte (the last one marked
as the word's end).  The adjacent pair of lowest rank merges first, the left
one of equal pairs; a heap yields the next pair and a doubly linked list
keeps the neighbours, so a word of n bytes costs O(n log n) however long it
is.  The count is the number of initial symbols minus the number of merges;
no identifiers are emitted.

Edge cases: a null or empty text has no tokens; white space alone has none.
A special token's string inside a text counts as one token and splits the
text there.  Rows are independent, so repeated rows, null ids and extra
columns need no treatment; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import ship

#: Words whose counts a worker remembers; beyond that it starts anew.
MEMO_WORDS = 400_000
_COUNTERS: dict[str, PairMerger] = {}

# White space as the vocabulary's normaliser defines it (Unicode White_Space).
_SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if printable in Latin-1, else the next unused character from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def merges_left(ids: list[int], ranks: dict[int, int], made: list[int]) -> int:
    """Symbols left after merging ``ids`` (changed in place).  ``ranks`` maps
    ``left << 32 | right`` to the pair's rank, ``made`` the rank to the
    merged symbol."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = ranks.get(ids[i] << 32 | ids[i + 1])
        if r is not None:
            heap.append(r << 32 | i)
    heapq.heapify(heap)
    left = n
    while heap:
        top = heapq.heappop(heap)
        r, i = top >> 32, top & 0xFFFFFFFF
        j = after[i]
        # Stale unless the pair standing at i is still the one of this rank.
        if ids[i] < 0 or j >= n or ranks.get(ids[i] << 32 | ids[j]) != r:
            continue
        ids[i], ids[j] = made[r], -1
        k = after[i] = after[j]
        left -= 1
        if k < n:
            before[k] = i
            s = ranks.get(ids[i] << 32 | ids[k])
            if s is not None:
                heapq.heappush(heap, s << 32 | i)
        h = before[i]
        if h >= 0:
            s = ranks.get(ids[h] << 32 | ids[i])
            if s is not None:
                heapq.heappush(heap, s << 32 | h)
    return left


class PairMerger(dict):
    """Counts tokens under one vocabulary file; as a dict, remembers words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        shown = byte_symbols()
        self.inner = [vocab[c] for c in shown]
        self.last = [vocab[c + end] for c in shown]
        # The vocabulary's own splitting pattern, white space spelled out.
        split = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        self.words = regex.compile(split.replace(r"[^\s", f"[^{_SPACE}")).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n = merges_left(ids, self.ranks, self.made)
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or "<|" not in text and not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        if not text.isascii():
            # Lower-casing goes character by character: no final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return sum(map(self.__getitem__, self.words(text.lower())))


def token_count(text: Column, file: str) -> Column:
    """Token count of a text column.  ``file`` is the name of a vocabulary
    file sent with ``SparkContext.addFile``."""

    @F.pandas_udf(LongType())
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if file not in _COUNTERS:
            _COUNTERS[file] = PairMerger(SparkFiles.get(file))
        merger = _COUNTERS[file]
        for texts in batches:
            yield pd.Series([merger.count(t) for t in texts], dtype="int64")

    return counted(text)


def token_counts(
    docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 2048
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit``
    tokens) added or replaced.  ``vocabulary`` is the path of a byte-level BPE
    file with word ends; it goes to each executor once, as a file.  Every row
    is whole and alone: no shuffle."""
    spark = docs.sparkSession
    ship(spark)
    spark.sparkContext.addFile(vocabulary)
    file = vocabulary.rsplit("/", 1)[-1]
    return (
        docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
        .withColumn("n_tokens", token_count(F.col(text), file))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
