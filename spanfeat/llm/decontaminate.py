"""Benchmark passages in training text: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame

from spanfeat.llm.common import text_rows, without

_WORD = re.compile(r"\w+")
MATCH, MISS, GAP = 2, -1, -1


def words(text: str | None) -> list[str]:
    """Lower-case word runs."""
    return _WORD.findall((text or "").lower())


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, start, end) in the passage, one vector step per item word.

    Along a row, gaps in the item are a running maximum of score plus distance, since the
    gap cost is linear.
    """
    n = len(passage)
    steps = np.arange(n + 1)
    row, origin = np.zeros(n + 1, np.int64), steps.copy()
    best = (0, 0, 0)
    for w in item:
        diagonal = row[:-1] + np.where(passage == w, MATCH, MISS)
        up = row[1:] + GAP
        cell = np.concatenate([[0], np.maximum(diagonal, up)])
        start = np.concatenate([[0], np.where(diagonal >= up, origin[:-1], origin[1:])])
        start = np.where(cell <= 0, steps, start)
        cell = np.maximum(cell, 0)
        lifted = cell - GAP * steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, steps, 0))
        row, origin = top + GAP * steps, start[source]
        k = int(row.argmax())
        if row[k] > best[0]:
            best = (int(row[k]), int(origin[k]), k)
    return best


class Block:
    """Items of one block with their seeds."""

    def __init__(self, items: list[tuple[int, list[str]]], n: int, rare: int):
        self.n = n
        self.vocab: dict[str, int] = {}
        for _, ws in items:
            for w in ws:
                self.vocab.setdefault(w, len(self.vocab))
        self.items = [(i, np.array([self.vocab[w] for w in ws], np.int64)) for i, ws in items]
        grams = [list(zip(*(ws.tolist()[k:] for k in range(n)))) if len(ws) >= n else [tuple(ws.tolist())] for _, ws in self.items]
        held = Counter(g for gs in grams for g in set(gs))
        self.seeds: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        self.sizes: set[int] = set()
        for k, gs in enumerate(grams):
            few = [p for p, g in enumerate(gs) if held[g] <= rare] or range(len(gs))
            for p in few:
                if gs[p]:
                    self.seeds[gs[p]].append((k, p))
                    self.sizes.add(len(gs[p]))
        self.seeds = dict(self.seeds)

    def find(self, text: str | None, threshold: float):
        """(item_id, similarity, first word, end word) of every item that the text holds."""
        ids = np.fromiter(map(self.vocab.get, ws := words(text), [-1] * len(ws)), np.int64, len(ws))
        if not len(ids):
            return
        hits = defaultdict(list)
        for size in self.sizes:
            if len(ids) < size:
                continue
            good = np.ones(len(ids) - size + 1, bool)
            for k in range(size):
                good &= ids[k : len(ids) - size + 1 + k] >= 0
            for p in np.flatnonzero(good).tolist():
                for k, q in self.seeds.get(tuple(ids[p : p + size].tolist()), ()):
                    hits[k].append(p - q)
        for k, starts in hits.items():
            item_id, item = self.items[k]
            margin = len(item) // 3 + 2
            best, lo, hi = (0, 0, 0), None, None
            for s in [*sorted(set(starts)), None]:
                if lo is not None and (s is None or s - margin > hi or hi - lo > 8 * len(item) + 64):
                    a, b = max(0, lo), min(len(ids), hi)
                    score, first, end = align(item, ids[a:b])
                    if score > best[0]:
                        best = (score, a + first, a + end)
                    lo = None
                if s is not None:
                    lo = s - margin if lo is None else lo
                    hi = s + len(item) + margin
            similarity = best[0] / (MATCH * len(item))
            if similarity >= threshold:
                yield item_id, similarity, best[1], best[2]


def leaks(
    docs: DataFrame, benchmark: DataFrame, n: int = 4, rare: int = 3, threshold: float = 0.5, block: int = 2000
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, end_word), one row per row of docs and item held.

    A seed is an ``n``-gram in at most ``rare`` items of its block (all n-grams of an item
    that has no rare one; a shorter item as a whole). Every place with a seed is aligned,
    whatever its frequency. Similarity is the alignment score over that of a full copy.
    The test set is the query set: it goes over all documents in blocks of ``block`` items,
    each sent to the tasks with its code, so a scan needs no shuffle. Null, empty or wordless texts and items
    match nothing; rows repeat as given; extra columns are ignored; no items give no rows.
    """
    schema = "doc_id long, item_id long, similarity double, first_word long, end_word long"
    found = docs.sparkSession.createDataFrame([], schema)

    def scan(items):
        made = Block(items, n, rare)

        def one(doc_id, text):
            for item in made.find(text, threshold):
                yield doc_id, *item

        return text_rows(docs, one, ["doc_id", "text"], schema)

    batch = []
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        if ws := words(row["text"]):
            batch.append((row["item_id"], ws))
        if len(batch) == block:
            found, batch = found.unionByName(scan(batch)), []
    return found.unionByName(scan(batch)) if batch else found


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; see ``leaks``. A null doc_id is kept unless it leaks."""
    return without(docs, leaks(docs, benchmark, **settings).select("doc_id"))
