r"""Licence scan: texts against licence templates by Dice coefficient.

Texts and templates are normalised: lower case; words are runs of letters and
digits, so that line breaks, comment marks and blank lines between paragraphs
do not count; lines that only state a copyright are left out.  Both are sets
of word bigrams, compared by the Dice coefficient 2 |A and B| / (|A| + |B|).
A template of m words is compared with these units of a document:

- every window of m consecutive words (all words, if there are fewer), so that
  a licence is found inside a longer line, paragraph or file;
- every line, paragraph (run of non-blank lines) and the whole text, where an
  edited licence of another length shows.

A document's score for a template is its best unit's.

Pruning by size, without loss: a coefficient of t needs sizes within
t / (2 - t) of each other, and as many shared bigrams as t / (2 - t) of the
template's.  A document that does not hold that many anywhere has no unit that
matches; only for the templates that remain are windows and lines looked at.
All windows of a template are scored at once: a bigram counts for the windows
from its last occurrence to this one, so that sums of steps give every
window's distinct and shared bigrams in time linear in the text.

The templates are some dozens of short texts, known before the job starts.
Rows are independent: no shuffle, one document in a worker at a time.

Edge cases: null, empty and texts of one word match nothing; of equal scores the
template of more words comes first (a notice before the line it holds), then the
smaller name; a template that several units match counts once,
with its best score.  Repeated rows match alike; an empty table gives an empty
result; columns beside the text are passed through, clashing ones replaced.  A
template needs two words.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .license_templates import TEMPLATES

THRESHOLD = 0.8
#: A line of more words that starts like a copyright statement has other content.
STATEMENT_WORDS = 15

WORD = re.compile(r"[^\W_]+")
COPYRIGHT = re.compile(r"[\W_]*(copyright\b|\(c\)|©)", re.I)

Gram = tuple[str, str]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def bigrams(text: str) -> frozenset[Gram]:
    found = words(text)
    return frozenset(zip(found, found[1:]))


def content_lines(text: str) -> list[str]:
    """Lines that do more than state a copyright."""
    return [s for s in text.split("\n") if not (COPYRIGHT.match(s) and len(words(s)) <= STATEMENT_WORDS)]


def units(lines: list[str]) -> list[str]:
    """Distinct lines, paragraphs and the whole."""
    parts, paragraph = [], []
    for line in [*lines, ""]:
        if line.strip():
            parts.append(line)
            paragraph.append(line)
        elif paragraph:
            parts.append("\n".join(paragraph))
            paragraph = []
    return list(dict.fromkeys([*parts, "\n".join(lines)]))


def window_counts(ids: np.ndarray, length: int) -> np.ndarray:
    """Distinct ids in each window of ``length`` (one window, if there are
    fewer ids); negative ids do not count."""
    n = len(ids)
    starts = max(n - length, 0) + 1
    order = np.argsort(ids, kind="stable")
    before = np.full(n, -1)
    again = ids[order[1:]] == ids[order[:-1]]
    before[order[1:][again]] = order[:-1][again]
    place = np.flatnonzero(ids >= 0)
    first = np.maximum(place - length + 1, before[place] + 1)
    last = np.minimum(place, starts - 1)
    counted = first <= last
    steps = np.bincount(first[counted], minlength=starts + 1)
    steps -= np.bincount(last[counted] + 1, minlength=starts + 1)
    return np.cumsum(steps)[:starts]


class TemplateIndex:
    """Templates by size, and the templates that hold each bigram."""

    def __init__(self, templates: dict[str, str], threshold: float):
        short = [name for name, t in templates.items() if len(words(t)) < 2]
        if short:
            raise ValueError(f"templates of fewer than two words: {short}")
        found = sorted((len(bigrams(t)), name, bigrams(t), len(words(t)) - 1) for name, t in templates.items())
        self.sizes = [n for n, *_ in found]
        self.names = [name for _, name, *_ in found]
        self.grams = [grams for _, _, grams, _ in found]
        self.lengths = [length for *_, length in found]
        self.holders: dict[Gram, list[int]] = {}
        for i, grams in enumerate(self.grams):
            for g in grams:
                self.holders.setdefault(g, []).append(i)
        self.threshold, self.ratio = threshold, threshold / (2 - threshold)

    def possible(self, grams: set[Gram]) -> set[int]:
        """Templates of which the bigrams hold enough for some unit."""
        shared = Counter(i for g in grams & self.holders.keys() for i in self.holders[g])
        return {i for i, c in shared.items() if c >= self.ratio * self.sizes[i] - 1e-9}

    def unit_scores(self, unit: str, wanted: set[int]) -> dict[int, float]:
        grams = bigrams(unit)
        n = len(grams)
        low = bisect_left(self.sizes, self.ratio * n - 1e-9)
        high = bisect_right(self.sizes, n / self.ratio + 1e-9)
        fitting = [i for i in wanted if low <= i < high]
        return {i: 2 * len(grams & self.grams[i]) / (n + self.sizes[i]) for i in fitting}

    def window_scores(self, pairs: list[Gram], wanted: set[int]) -> dict[int, float]:
        """Best window of each wanted template."""
        number: dict[Gram, int] = {}
        ids = np.fromiter((number.setdefault(g, len(number)) for g in pairs), np.int64, len(pairs))
        distinct: dict[int, np.ndarray] = {}
        scores = {}
        for i in wanted:
            length = self.lengths[i]
            if length not in distinct:
                distinct[length] = window_counts(ids, length)
            own = np.zeros(len(number), bool)
            own[[number[g] for g in self.grams[i] if g in number]] = True
            shared = window_counts(np.where(own[ids], ids, -1), length)
            scores[i] = float((2 * shared / (distinct[length] + self.sizes[i])).max())
        return scores

    def scan(self, text: str | None) -> list[tuple[str, float]]:
        """(template, best coefficient) of a document, best first."""
        lines = content_lines(text or "")
        found = words("\n".join(lines))
        pairs = list(zip(found, found[1:]))
        wanted = self.possible(set(pairs))
        if not wanted:
            return []
        best = self.window_scores(pairs, wanted)
        for unit in units(lines):
            for i, s in self.unit_scores(unit, wanted).items():
                best[i] = max(s, best[i])
        matched = [(-s, -self.lengths[i], self.names[i]) for i, s in best.items() if s >= self.threshold]
        return [(name, -s) for s, _, name in sorted(matched)]


def scan_licenses(
    docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``licenses`` added or replaced: (template, score) pairs,
    best first."""
    ship(docs.sparkSession)
    index = TemplateIndex(templates, threshold)

    @F.pandas_udf("array<struct<template:string,score:double>>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"template": t, "score": s} for t, s in index.scan(x)] for x in texts], dtype=object)

    return docs.withColumn("licenses", scanned(F.col(text)))
