"""Token counts: pieces once per distinct pre-token, joined to per-document pre-token frequencies."""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_memos, read, spread

#: Distinct pre-tokens that a worker keeps before it starts anew; bounds its memory, not the result.
MEMO = 400_000
_loaded: dict[str, PieceCounter] = {}
#: White space as the tokenizer libraries have it (str.isspace() has four control characters more).
WHITE = r"\t-\r\x85\p{Z}"


def spelled(pattern: str) -> str:
    """The pattern with its white-space classes spelled out."""
    return pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that print stay, others follow 256."""
    keeps = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in keeps else chr(next(others)) for b in range(256)]


class PieceCounter:
    """Counts the tokens of a text under a tokenizers .json file with a Split + ByteLevel pre-tokenizer."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pieces = regex.compile(spelled(split["pattern"]["Regex"])).findall
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        # A text without the common start of all special strings (where they have one) holds none of them.
        start = commonprefix(specials)
        self.mark = (lambda text: start in text) if start else (lambda text: True)
        self.alphabet = byte_alphabet()
        self.controls = regex.compile("[\x1c-\x1f]").search
        self.counted: dict[str, int] = {}  # by pre-token
        self.memo: dict[str, int] = {}  # by chunk

    def forget(self) -> None:
        self.memo, self.counted = {}, {}

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # str.lower() looks at the neighbours of this letter; the tokenizer doesn't
                return "".join(map(str.lower, text))
        return text.lower()

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Frequencies of what stands between white space, and how many special strings are in the text."""
        parts = [text] if self.special is None or not self.mark(text) else self.special.split(text)
        found: Counter = Counter()
        for part in parts:
            part = self.normalise(part)
            found.update([part] if self.controls(part) else part.split())  # str.split() cuts at four control characters more
        return found, len(parts) - 1

    def learn(self, chunks: set[str]) -> None:
        """Count the pieces of each distinct pre-token once; a chunk has the sum of its pre-tokens."""
        alphabet, known = self.alphabet, self.counted
        for c in chunks:
            n = 0
            for p in self.pieces(c):
                if p not in known:
                    known[p] = len(self.model.tokenize("".join([alphabet[b] for b in p.encode()])))
                n += known[p]
            self.memo[c] = n


def counter(path: str) -> PieceCounter:
    if path not in _loaded:
        _loaded[path] = PieceCounter(path)
    return _loaded[path]


def tokenizer_path(name: str, path: str | None) -> str:
    """The given path, or where this machine (driver or executor) has the public file."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 2048) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit.

    Null text counts as empty (0 tokens); null ids are carried; repeated rows repeat; extra
    columns are not read. No shuffle: each worker counts the pieces of a distinct pre-token
    once, joins them to the frequencies of each document and sums; ids are never made.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer_path("word_bpe_49k.json", path))
        own_memos("token_counts", _loaded.clear)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                freq = [c.frequencies(t) for t in texts]
                if len(c.memo) > MEMO:
                    c.forget()
                c.learn(set().union(*(f.keys() for f, _ in freq)).difference(c.memo))
                memo = c.memo
                n = [extra + sum([memo[p] * k for p, k in f.items()]) for f, extra in freq]
                yield pa.record_batch(
                    [part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=[id_col, "n_bytes", "n_tokens", "over_limit"],
                )

    picked = spread(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text")))
    return picked.mapInArrow(run, f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
