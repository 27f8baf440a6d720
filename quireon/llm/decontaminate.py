"""Benchmark decontamination: CGK walks, bit-sampling LSH over windows, exact edit verification."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let_go, own_memos, read, spread

#: Repetitions of the walk, steps of a walk (about half as many words), sampled steps of a signature.
REPEATS, STEPS, SAMPLED = 4, 16, 4
#: Items under so many words are found by exact pieces, of which one survives any edits within the bound.
SHORT = 15
#: Of the eight words from a start, so many are words of the benchmark in any window with a clean stretch.
NEAR, KNOWN = 8, 6
#: Items that are compared in one pass over the documents; larger benchmarks take a pass per block.
BLOCK = 20_000
_FILTER = 1 << 22
_P = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def infix_distance(item: list, text: list) -> tuple[int, int]:
    """Least edit distance (in words) of item to a stretch of text, and where the first such stretch to end ends.

    Bit-parallel over the item: a row of the table is two integers, of its rising and falling steps.
    """
    m = len(item)
    at: dict = defaultdict(int)
    for i, x in enumerate(item):
        at[x] |= 1 << i
    full, top = (1 << m) - 1, 1 << m >> 1
    up, down, score, best = full, 0, m, (m, 0)
    for j, y in enumerate(text, 1):
        equal = at.get(y, 0)
        vertical = equal | down
        across = ((((equal & up) + up) ^ up) | equal) & full
        more, less = down | (full & ~(across | up)), up & across
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1) & full, (less << 1) & full
        up, down = less | (full & ~(vertical | more)), more & vertical
        if score < best[0]:
            best = (score, j)
    return best


class Index:
    """Signatures of every position of every item under each repetition of the walk."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, seed: int = 7):
        self.similarity = similarity
        self.items = [(i, w) for i, text in items if (w := words(text))]
        self.vocab = {w: k for k, w in enumerate(sorted({x for _, ws in self.items for x in ws}), 1)}
        rng = np.random.default_rng(seed)
        self.advance = rng.integers(0, 2, (REPEATS, STEPS, len(self.vocab) + 1), dtype=np.int64)
        self.sampled = [sorted(rng.choice(STEPS, SAMPLED, replace=False).tolist()) for _ in range(REPEATS)]
        self.coded = [np.array([self.vocab[w] for w in ws], np.int64) for _, ws in self.items]
        self.at: dict[int, list[tuple[int, int]]] = defaultdict(list)  # signature: (item, position)
        self.local = [[frozenset(c[o : o + NEAR].tolist()) for o in range(len(c) - NEAR + 1)] for c in self.coded]
        self.pieces: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))  # words: {key: (item, position)}
        for k, codes in enumerate(self.coded):
            if len(codes) < SHORT:
                edges = np.linspace(0, len(codes), self.most(codes) + 2).astype(int).tolist()
                for o, end in zip(edges, edges[1:], strict=False):
                    self.pieces[end - o][int(self.keys(codes[o:end], end - o)[0])].append((k, o))
                continue
            starts = np.arange(len(codes) - NEAR + 1)
            for r in range(REPEATS):
                for o, s in enumerate(self.signatures(codes, starts, r).tolist()):
                    self.at[s].append((k, o))
        self.bits = np.zeros(_FILTER, bool)
        if self.at:
            self.bits[(np.array(list(self.at), np.uint64) >> np.uint64(42)).astype(np.int64)] = True

    def most(self, item: np.ndarray) -> int:
        """Edits that an item may have."""
        return int((1 - self.similarity) * len(item) + 1e-9)

    @staticmethod
    def keys(codes: np.ndarray, size: int) -> np.ndarray:
        """A key of the words from each position that has so many."""
        n = len(codes) - size + 1
        h = np.zeros(n, np.uint64)
        for i in range(size):
            h = (h ^ codes[i : n + i].astype(np.uint64)) * _P
            h ^= h >> np.uint64(31)
        return h

    def signatures(self, codes: np.ndarray, starts: np.ndarray, r: int) -> np.ndarray:
        """The walk from each start: emit the word in place, then move on or stay as a random bit of (step, word) says."""
        padded = np.append(codes, np.zeros(STEPS, np.int64))
        i, out = starts.copy(), np.full(len(starts), r + 1, np.uint64)
        for j in range(self.sampled[r][-1] + 1):
            symbol = padded[i]
            if j in self.sampled[r]:
                out = (out ^ symbol.astype(np.uint64)) * _P
                out ^= out >> np.uint64(31)
            i += self.advance[r, j][symbol]
        return out * _P

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, first word, words, distance) of the best stretch for each item that the text holds."""
        ws = words(text)
        get = self.vocab.get
        codes = np.array([get(w, 0) for w in ws], np.int64)
        known = np.cumsum(np.append(0, codes > 0))
        found: dict[int, tuple[int, int, int]] = {}
        if len(ws) >= NEAR and self.at:
            starts = np.flatnonzero((known[NEAR:] - known[:-NEAR] >= KNOWN) & (codes[: len(codes) - NEAR + 1] > 0))
            tried: set[tuple[int, int]] = set()
            listed = codes.tolist()
            for r in range(REPEATS if len(starts) else 0):
                sig = self.signatures(codes, starts, r)
                for x in np.flatnonzero(self.bits[(sig >> np.uint64(42)).astype(np.int64)]):
                    s = int(starts[x])
                    for k, o in self.at.get(int(sig[x]), ()):
                        near = self.local[k][o]  # most words next to a true meeting point are the item's
                        if (k, s - o) not in tried and 4 * len(near.intersection(listed[s : s + NEAR])) >= 3 * len(near):
                            tried.add((k, s - o))
                            self.verify(k, s - o, codes, known, found)
        for size, pieces in self.pieces.items():
            if len(ws) >= size:
                where = np.flatnonzero(known[size:] - known[:-size] == size)
                for s, key in zip(where.tolist(), self.keys(codes, size)[where].tolist(), strict=True):
                    for k, o in pieces.get(key, ()):
                        self.verify(k, s - o, codes, known, found)
        return [(self.items[k][0], start, n, d) for k, (d, start, n) in sorted(found.items())]

    def verify(self, k: int, start: int, codes: np.ndarray, known: np.ndarray, found: dict) -> None:
        item = self.coded[k]
        most = self.most(item)
        a, z = max(0, start - most), min(len(codes), start + len(item) + most)
        if known[z] - known[a] < len(item) - most or (k in found and found[k][0] == 0 and found[k][1] <= a):
            return
        stretch = codes[a:z].tolist()
        if sum((Counter(item.tolist()) & Counter(stretch)).values()) < len(item) - most:
            return
        d, end = infix_distance(item.tolist(), stretch)
        if d <= most and (k not in found or d <= found[k][0]):
            back, n = infix_distance(item.tolist()[::-1], stretch[:end][::-1])
            if k not in found or (d, a + end - n) < found[k][:2]:
                found[k] = (d, a + end - n, n)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row per document and benchmark item that it holds: id, item_id, start_word, n_words, distance.

    Words are runs of anything but ASCII white space, lower-cased A-Z. An item is held where a
    stretch of the document is within (1 - similarity) of its words in edit distance. The best
    stretch counts, the first one on ties. Null texts hold nothing and empty items are held by nothing; repeated
    rows repeat; extra columns aren't read; empty tables give an empty result.

    A signature samples four steps of a random walk from a position, and every position of every
    item is indexed, so that any clean stretch of about eight words inside a leaked passage
    finds its item under one of the repetitions; the target recall at the very bound of edits is
    0.98. Items under SHORT words have too few positions for that: they are cut into one piece
    more than they may have edits, and any whole piece leads to verification, so none is missed. Items are a stated query set: they are
    compared in blocks of bounded size, each broadcast against all documents; no shuffle.
    """
    picked = spread(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")))
    spark, schema = docs.sparkSession, f"`{id_col}` long, `{item_col}` long, start_word long, n_words long, distance long"
    items, out, block = benchmark.select(F.col(item_col).cast("long"), item_text).filter(F.col(item_text).isNotNull()), None, []

    def scan(block: list) -> DataFrame:
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own_memos("decontaminate")
            index = Index(held.value, similarity)
            try:
                for batch in batches:
                    got = [(i, *x) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in index.search(t)]
                    yield pa.record_batch([pa.array([g[c] for g in got], pa.int64()) for c in range(5)], names=[id_col, item_col, "start_word", "n_words", "distance"])
            finally:
                del index
                let_go("decontaminate")

        return picked.mapInArrow(run, schema)

    for row in items.toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == BLOCK:
            out, block = (scan(block) if out is None else out.unionAll(scan(block))), []
    if block or out is None:
        out = scan(block) if out is None else out.unionAll(scan(block))
    return out


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
