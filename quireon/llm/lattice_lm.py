"""LM scoring: word counts smoothed by the marginal likelihood of a subword lattice."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, hot_join, id_remainder, read, spread, table, words
from .token_counts import tokenizer_path

#: Chance that a spelling ends after a piece before it is fitted, and share of the base measure that the end of a text has.
STOP, END = 0.35, 0.01
#: Rounds of fitting piece weights; rows of the lattices that are computed at once.
ROUNDS, CELLS = 1, 2_000_000
#: At most so many words are broadcast; every other word holds less than one token in so many.
HOT_WORDS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_loaded: dict[str, Lattice] = {}


class Lattice:
    """Marginal log-probability of words over all their segmentations into vocabulary pieces."""

    def __init__(self, pieces: list[tuple[str, float]]):
        """pieces: (piece, score). Scores of a merge vocabulary are ranks: a piece of score -r weighs 1 / (r + 1)."""
        weights = {p: 1.0 / (1.0 - min(0.0, s)) for p, s in pieces}
        single = [f"<0x{b:02X}>" for b in range(256)]
        text = [p for p in weights if p not in set(single)]
        keys = np.array([self.key(np.array([list(map(ord, p))], np.uint64))[0] for p in text], np.uint64)
        order = np.argsort(keys)
        self.keys, self.longest, self.stop = keys[order], max(map(len, text), default=1), STOP
        least = min(weights.values(), default=1.0)
        weight = np.array([weights[text[i]] for i in order] + [weights.get(b, least) for b in single])  # pieces, then bytes
        self.first = self.logs = np.log(weight / weight.sum())

    @staticmethod
    def key(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for column in codes.T:
            h = h * _BASE + column + np.uint64(1)
        return h

    def lattices(self, found: list[str]) -> Iterator[tuple]:
        """Words of one length at a time: which, piece at each (size - 1, word, start) or -1, log-weight of it, forward sums, spelt.

        The forward recursion runs in log space. spelt has (word, start) of the characters that no piece has: they go byte by byte.
        """
        lengths = np.array([len(w) + 1 for w in found])
        for n in np.unique(lengths).tolist():
            every = np.flatnonzero(lengths == n)
            longest = min(self.longest, n)
            step = max(1, CELLS // (n * longest))
            for which in (every[i : i + step] for i in range(0, len(every), step)):
                codes = np.array([[0x2581, *map(ord, found[i])] for i in which], np.uint64)  # pieces that begin a word begin with this mark
                piece = np.full((longest, len(which), n), -1, np.int32)
                h = np.zeros(codes.shape, np.uint64)
                for k in range(longest):
                    h = h[:, : n - k] * _BASE + codes[:, k:] + np.uint64(1)
                    at = np.minimum(np.searchsorted(self.keys, h), max(len(self.keys) - 1, 0))
                    piece[k, :, : n - k] = np.where(self.keys[at] == h, at, -1) if len(self.keys) else -1
                arc = np.where(piece >= 0, self.logs[piece], -np.inf)
                spelt = [(w, i, [len(self.keys) + b for b in chr(int(codes[w, i])).encode()]) for w, i in np.argwhere(piece[0] < 0).tolist()]
                for w, i, parts in spelt:
                    arc[0, w, i] = self.logs[parts].sum() + (len(parts) - 1) * math.log(1 - self.stop)
                arc += math.log(1 - self.stop)
                alpha = np.full((n + 1, len(which)), -np.inf)
                alpha[0] = 0.0
                for i in range(n):
                    m = min(longest, n - i)
                    alpha[i + 1 : i + 1 + m] = np.logaddexp(alpha[i + 1 : i + 1 + m], alpha[i] + arc[:m, :, i])
                yield which, piece, arc, alpha, spelt

    def score(self, found: list[str]) -> np.ndarray:
        """Natural log of each word's marginal likelihood."""
        out = np.empty(len(found))
        for which, _, _, alpha, _ in self.lattices(found):
            out[which] = alpha[-1] + math.log(self.stop / (1 - self.stop))
        return out

    def expected(self, found: list[str]) -> np.ndarray:
        """How often each piece (then each byte) is expected in the words' segmentations, by forward and backward sums."""
        out = np.zeros(len(self.logs))
        for _, piece, arc, alpha, spelt in self.lattices(found):
            longest, n = len(piece), len(alpha) - 1
            beta = np.full(alpha.shape, -np.inf)
            beta[n] = 0.0
            for i in range(n - 1, -1, -1):
                m = min(longest, n - i)
                beta[i] = np.logaddexp.reduce(arc[:m, :, i] + beta[i + 1 : i + 1 + m], axis=0)
            for k in range(longest):
                chance = np.exp(alpha[: n - k].T + arc[k, :, : n - k] + beta[k + 1 :].T - alpha[n][:, None])
                hit = piece[k, :, : n - k] >= 0
                out += np.bincount(piece[k, :, : n - k][hit], weights=chance[hit], minlength=len(out))
                if not k:
                    for w, i, parts in spelt:
                        np.add.at(out, parts, chance[w, i])
        return out

    def fitted(self, counts: np.ndarray, n: int) -> None:
        """Weights from the expected counts over n words, each piece's first weight counting for one piece in the mean."""
        if n:
            prior = np.exp(self.first) * len(counts)
            self.logs = np.log((counts + prior) / (counts.sum() + len(counts)))
            self.stop = min(0.99, n / counts.sum())


def lattice(path: str) -> Lattice:
    if path not in _loaded:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        _loaded[path] = Lattice([(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_unknown(i)])
    return _loaded[path]


def discount(ones: int, twos: int) -> float:
    """What is taken off each word's count, by leave-one-out from the numbers of words that occur once and twice."""
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learned from documents whose crc32(id) mod 5 is not 1 (a null id counts as training). Null
    text counts as empty: its one token is the end. With c the count of a word, N of all tokens and
    V of distinct ones in training, P(word) = (max(c - d, 0) + d V B(word)) / N, where d is the
    discount fitted by leave-one-out and the base measure B is the lattice likelihood: the sum over
    all segmentations into pieces of an existing vocabulary. The vocabulary's scores give the first
    weights of the pieces; `rounds` times they are fitted to all distinct training words by forward
    and backward sums. All sums are in log space, so words of any length have their own probability.
    `score` is the log10 of the text's probability, `base_score` that of the add-half word model.
    With no training text, P is B. Repeated rows repeat, extra columns are not read, an empty table
    gives an empty result.

    The model is a table with a row per distinct word; frequent words (bounded in number) meet
    their tokens by broadcast, rare ones by a shuffle on the word. Rows are numbered in a written
    table, which both branches read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = table(spread(rows), "rows")
    rows = rows.withColumn("_held", F.coalesce(id_remainder("_id", 5) == 1, F.lit(False)))
    tokens = rows.select("_row", "_held", F.explode(words(F.col("_text"))).alias("word"))
    counted = tokens.groupBy("word").agg(F.sum((~F.col("_held")).cast("long")).alias("c"), F.count("*").alias("n"))
    counted = table(counted, "counts")
    heads = rows.agg(F.sum((~F.col("_held")).cast("long"))).first()[0] or 0
    state: tuple | None = None

    def loaded(state: tuple | None) -> Lattice:
        m = lattice(tokenizer_path("piece_bpe_32k.model", path))
        m.logs, m.stop = state or (m.first, STOP)
        return m

    def expectations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, total, n = loaded(state), 0.0, 0
        for batch in batches:
            total = total + m.expected(batch.column(0).to_pylist())
            n += batch.num_rows
        if n:
            yield pa.record_batch([pa.array([*range(len(total)), -1], pa.int32()), pa.array([*total.tolist(), float(n)])], names=["piece", "times"])

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = loaded(state)
        for batch in batches:
            yield pa.record_batch([*batch.columns, pa.array(m.score(batch.column(0).to_pylist()))], names=["word", "c", "n", "b"])

    for _ in range(rounds):
        got = counted.filter("c > 0").select("word").mapInArrow(expectations, "piece int, times double").groupBy("piece").agg(F.sum("times").alias("times"))
        times = {r["piece"]: r["times"] for r in got.collect()}  # a row per piece of the vocabulary
        if times:
            m = loaded(state)
            m.fitted(np.array([times[k] for k in range(len(m.logs))]), round(times[-1]))
            state = (m.logs, m.stop)
    model = table(counted.mapInArrow(likelihood, "word string, c long, n long, b double"), "words")
    n, v, total, ones, twos = model.agg(F.coalesce(F.sum("c"), F.lit(0)), F.sum((F.col("c") > 0).cast("long")), F.coalesce(F.sum("n"), F.lit(0)), F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long"))).first()
    drop(counted)
    n, v, d = n + heads, (v or 0) + (heads > 0), discount(ones or 0, twos or 0)
    below, spared = n + 0.5 * (v + 1), math.log(d * v / n) if n else 0.0
    own, piece = F.log((F.col("c") - d) / n) if n else F.lit(None).cast("double"), F.col("b") + (math.log(1 - END) + spared)
    lp = F.when(F.col("c") > 0, F.greatest(own, piece) + F.log1p(F.exp(-F.abs(own - piece)))).otherwise(piece) / math.log(10)
    scored = model.select("word", "n", (F.col("c") > 0).cast("long").alias("known"), F.log10((F.col("c") + 0.5) / below).alias("base"), lp.alias("lp"))
    met = hot_join(tokens.select("_row", "word"), scored, ["word"], "n", total, share=HOT_WORDS)
    sums = met.groupBy("_row").agg(F.count("*").alias("words"), F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("lp").alias("lp"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    end = math.log10((max(heads - d, 0) + d * v * END) / n) if n else math.log10(END)
    return rows.select("_row", "_id", "_held").join(sums, "_row", "left").select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), (zero("words") + 1).cast("long").alias("n_tokens"), (zero("known") + int(heads > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (zero("base") + math.log10((heads + 0.5) / below)).cast("double").alias("base_score"), (zero("lp") + end).cast("double").alias("score"),
    )


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"))
