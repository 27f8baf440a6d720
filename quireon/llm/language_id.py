"""Language identification: script ranges narrow candidates, Viterbi over per-word scores labels spans."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, let_go, own_memos, read, spread

#: Labelled rows that the classifier is fitted on at most (in expectation; chosen by a hash of id and text, since many rows may have no id).
FIT_ROWS = 20_000
#: Words kept in a task's memo.
MEMO = 400_000
#: Log-odds that a change of language has to win back.
SWITCH = 8.0
#: First and last code points of scripts (fixed values of the Unicode standard); letters elsewhere are "other".
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}


def script(letter: str) -> str:
    at = ord(letter)
    return next((name for name, ranges in SCRIPTS.items() if any(a <= at <= b for a, b in ranges)), "other")


def trigrams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def keys_of(codes: np.ndarray) -> np.ndarray:
    """A key of the trigram at every position (code points have 21 bits)."""
    return (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]


class Model:
    """Trigram log-probabilities by language, and which languages use which script."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        self.langs = sorted({lang for _, lang, _ in counts})
        k, at = len(self.langs), {lang: i for i, lang in enumerate(self.langs)}
        table_: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(k))
        used: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(k))
        for tri, lang, n in counts:
            table_[tri][at[lang]] += n
            used[script(tri[1])][at[lang]] += n
        total = sum(table_.values(), np.zeros(k)) + 0.5 * (len(table_) + 1)
        keys = keys_of(points("".join(table_)))[::3] if table_ else np.empty(0, np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        scores = [np.log((c + 0.5) / total) for c in table_.values()]
        self.scores = np.array([*(scores[i] for i in order), np.log(0.5 / total)])  # the last row is for unseen ones
        whole = sum(used.values(), np.zeros(k)) + 1e-9
        self.allowed = {s: c / whole > 0.01 for s, c in used.items()}
        self.fits: dict[str, np.ndarray] = {}  # by first letter
        self.memo: dict[str, int] = {}  # word: its row
        self.rows = np.empty((0, k))

    def first(self, letter: str) -> np.ndarray:
        """Languages that write a letter's script; none, where no learned language does."""
        if letter not in self.fits:
            self.fits[letter] = self.allowed.get(script(letter), np.zeros(len(self.langs), bool))
        return self.fits[letter]

    def score(self, found: list[str]) -> np.ndarray:
        """Log-likelihood of words by language, over their best; languages that don't write their script are far behind."""
        codes = points("".join([f"^{w}$" for w in found]))
        sizes = np.array([len(w) + 2 for w in found])
        starts = np.cumsum(sizes) - sizes
        keys = np.append(keys_of(codes), [-1, -1])
        at = np.searchsorted(self.keys, keys)
        got = self.scores[np.where(self.keys[at] == keys, at, len(self.scores) - 1)]
        got[starts + sizes - 1] = got[starts + sizes - 2] = 0.0  # trigrams over a word's end
        got = np.add.reduceat(got, starts)
        allowed = np.array([self.first(w[0]) for w in found])
        top = np.where(allowed, got, -np.inf).max(1, keepdims=True)
        known = allowed.any(1, keepdims=True)  # a script that no learned language uses tells nothing
        return np.where(known, np.where(allowed, np.maximum(got - np.where(known, top, 0.0), -20.0), -20.0), 0.0)

    def learn(self, docs: list[list[str]]) -> None:
        """Score each distinct new word of the documents once."""
        if len(self.memo) > MEMO:
            self.memo, self.rows = {}, self.rows[:0]
        new = list(set().union(*docs).difference(self.memo))
        if new and self.langs:
            self.memo.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, self.score(new)])

    def paths(self, docs: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each document's languages by word, along the best path of scores less SWITCH a change, and the scores."""
        out, hard = [], []
        for found in docs:
            s = self.rows[list(map(self.memo.__getitem__, found))]
            best = int(s.sum(0).argmax())
            # No other path wins if no stretch of words gains more than one change costs.
            gain = np.cumsum((s - s[:, best : best + 1]).max(1))
            if len(s) and (gain - np.minimum.accumulate(np.append(0.0, gain[:-1]))).max() > SWITCH:
                hard.append(len(out))
            out.append((np.full(len(found), best), s))
        for i, path in zip(hard, viterbi([out[i][1] for i in hard], SWITCH), strict=True):
            out[i] = (path, out[i][1])
        return out

    def predict(self, docs: list[list[str]]) -> list[tuple[str, float, list[tuple[str, int]]]]:
        """Of each document: language with most letters, its share of letters times its posterior, and (language, words) of each span."""
        if not self.langs:
            return [("und", 0.0, [])] * len(docs)
        self.learn(docs)
        out = []
        for found, (path, s) in zip(docs, self.paths(docs), strict=True):
            if not found:
                out.append(("und", 0.0, []))
                continue
            letters = np.bincount(path, weights=list(map(len, found)), minlength=len(self.langs))
            pred = int(letters.argmax())
            mine = s[path == pred].sum(0)
            odds = np.exp(np.clip(mine - mine[pred], -50, 50)).sum()
            cuts = np.flatnonzero(np.diff(path)) + 1
            edges = [0, *cuts.tolist(), len(path)]
            spans = [(self.langs[path[a]], b - a) for a, b in zip(edges, edges[1:], strict=False)]
            out.append((self.langs[pred], float(letters[pred] / letters.sum() / max(odds, 1.0)), spans))
        return out


def viterbi(scores: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """Of each document the path through its scores (words x languages) of the largest sum, where each change costs switch.

    Ties keep the language. All documents take a step at once, the longest first, so that those at work are a prefix.
    """
    if not scores:
        return []
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order])
    s = np.concatenate([scores[i] for i in order])
    starts = np.cumsum(sizes) - sizes
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left").tolist()  # documents with more than t words
    back = np.empty(s.shape, np.int32)
    best, own, rows = s[starts].copy(), np.arange(s.shape[1]), np.arange(len(sizes))
    for t in range(1, sizes[0]):
        a = active[t]
        b, at = best[:a], starts[:a] + t
        top = b.argmax(1)
        least = b[rows[:a], top][:, None] - switch
        stay = b >= least
        back[at] = np.where(stay, own, top[:, None])
        best[:a] = np.where(stay, b, least) + s[at]
    path, now = np.empty(len(s), np.int64), best.argmax(1)
    path[starts + sizes - 1] = now
    for t in range(sizes[0] - 1, 0, -1):
        a = active[t]
        at = starts[:a] + t
        now[:a] = back[at, now[:a]]
        path[at - 1] = now[:a]
    out = [path[:0]] * len(scores)
    for i, start, n in zip(order, starts.tolist(), sizes.tolist(), strict=True):
        out[i] = path[start : start + n]
    return out


def word_finder():
    import regex

    return regex.compile(r"\p{L}[\p{L}\p{M}]*").findall


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> list[tuple[str, str, int]]:
    """Trigram counts (trigram, lang, n) over a bounded sample of labelled training documents."""
    labelled = docs.filter((F.coalesce(id_remainder(id_col, 3), F.lit(0)) != 1) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    share = fit_rows / max(1, labelled.count())
    sample = labelled.filter(F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("language_id")
        find, n = word_finder(), defaultdict(int)
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                freq: dict[str, int] = defaultdict(int)
                for w in find(text.lower()):
                    freq[w] += 1
                for w, k in freq.items():
                    for t in trigrams(w):
                        n[t, lang] += k
        yield pa.record_batch([pa.array([t for t, _ in n]), pa.array([x for _, x in n]), pa.array(list(n.values()), pa.int64())], names=["tri", "lang", "n"])

    counts = sample.select(text_col, lang_col).mapInArrow(count, "tri string, lang string, n long").groupBy("tri", "lang").agg(F.sum("n").alias("n"))
    return [(r["tri"], r["lang"], r["n"]) for r in counts.collect()]  # trigrams of the bounded sample


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS, spans: bool = True) -> DataFrame:
    """One row per row of docs: id, held_out, lang_pred, score, spans (array of language and words).

    Learned from text and non-null lang of documents whose crc32(id) mod 3 is not 1, at most
    fit_rows of them in expectation. `und` with score 0 where text is null or has no letter, and
    everywhere if nothing is labelled. A null id counts as training (held_out false); repeated
    rows repeat; an empty table gives an empty result; extra columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col, fit_rows))  # bounded by fit_rows texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("language_id")  # this operator's are the task's own
        m, find = Model(model.value), word_finder()
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    part = batch.slice(start, 1024)
                    got = m.predict([find((t or "").lower()) for t in part.column(2).to_pylist()])
                    columns = [part.column(0), part.column(1), pa.array([g[0] for g in got]), pa.array([min(1.0, g[1]) for g in got])]
                    if spans:
                        columns.append(pa.array([[{"lang": a, "words": b} for a, b in g[2]] for g in got], pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))))
                    yield pa.record_batch(columns, names=[id_col, "held_out", "lang_pred", "score", *["spans"] * spans])
        finally:
            del m
            let_go("language_id")

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(id_remainder(id_col, 3) == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("_text"))
    return spread(picked).mapInArrow(run, f"`{id_col}` long, held_out boolean, lang_pred string, score double{', spans array<struct<lang: string, words: int>>' * spans}")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"), spans=False)
