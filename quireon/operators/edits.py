"""Corrections learned from edits: token differences and fuzzy lookup, by vectorised Python."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKS = ".,;:?! "
TEXTS = T.ArrayType(T.StringType())


def corrected_expressions(raw: str, corrected: str) -> list[str]:
    """What a corrector wrote in place of other tokens, word by word unless one token became several."""
    a, b = raw.split(), corrected.split()
    out: list[str] = []
    for op, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op in ("replace", "insert"):
            out += [" ".join(b[k:m]).strip(MARKS)] if op == "insert" or (j - i == 1 and m - k > 1) else [w.strip(MARKS) for w in b[k:m]]
    return [x for x in out if x]


@F.pandas_udf(TEXTS)
def expressions(raw: pd.Series, corrected: pd.Series) -> pd.Series:
    return pd.Series([corrected_expressions(a or "", b or "") for a, b in zip(raw, corrected, strict=True)])


def close_matches(bank: list[str], n: int = 10, cutoff: float = 0.4):
    """Column function: the n expressions of a bank (a bounded list) that are closest to a word."""

    @F.pandas_udf(TEXTS)
    def closest(words: pd.Series) -> pd.Series:
        return pd.Series([difflib.get_close_matches(w or "", bank, n, cutoff) for w in words])

    return closest


def merge_bank(bank: DataFrame, new: DataFrame) -> DataFrame:
    return bank.select("expression").union(new.select("expression")).dropna().distinct()


def pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, raw, corrected) from neighbouring turns, by an equi-join on the turn number."""
    a, b = turns.filter("role = 'user'"), turns.filter("role = 'assistant'")
    return a.select("conv_id", F.col("turn").alias("t"), F.col("text").alias("raw")).join(b.select("conv_id", (F.col("turn") - 1).alias("t"), F.col("text").alias("corrected")), ["conv_id", "t"])


def stripped(word: Column) -> Column:
    return F.btrim(word, F.lit(MARKS))
