"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside each partition."""

from __future__ import annotations

import base64
import gc
import heapq
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let_go, own_memos, read, spread
from .token_counts import spelled, tokenizer_path

#: Distinct pre-tokens, and chunks of them, that a worker keeps, and the characters of the longest of them;
#: beyond, it keeps those that the batch in hand holds too. Bounds its memory, not the result.
MEMO, MEMO_LENGTH = 800_000, 64
#: Token positions that one recursive query holds, and the bytes of the longest pre-token in one; longer ones
#: (runs of one symbol, say) would take a pass per merge and go through the heap, with the same result.
QUERY_POSITIONS, QUERY_BYTES = 100_000, 192
_loaded: dict[str, Codec] = {}

#: One pass per merge: token-position rows (with the position and token that follow) join the merge table,
#: and each word's least (rank, position) is contracted; the keyed recursion keeps one row a position, and
#: words without a change leave it.
CONTRACT = """
WITH RECURSIVE step(w, pos, after, tok, follows) USING KEY (w, pos) AS (
  SELECT w, pos, after, tok, follows FROM start
  UNION
  SELECT s.w, s.pos, CASE WHEN s.pos = b.pos THEN b.after ELSE s.after END,
         CASE WHEN s.pos = b.pos THEN b.merged WHEN s.pos = b.gone THEN -1 ELSE s.tok END,
         CASE WHEN s.pos = b.pos THEN b.follows WHEN s.pos = b.gone THEN -1 ELSE b.merged END
  FROM (
    SELECT f.w, f.least % 65536 AS pos, (f.least // 65536)::INTEGER AS merged, f.gone, t.after, t.follows
    FROM (
      SELECT a.w, min(m.id * 65536 + a.pos) AS least, arg_min(a.after, m.id * 65536 + a.pos) AS gone
      FROM recurring.step a JOIN (SELECT DISTINCT w FROM step) k ON k.w = a.w JOIN merges m ON m.l = a.tok AND m.r = a.follows GROUP BY a.w
    ) f JOIN recurring.step t ON t.w = f.w AND t.pos = f.gone
  ) b JOIN recurring.step s ON s.w = b.w AND s.tok >= 0 AND (s.pos = b.pos OR s.pos = b.gone OR s.after = b.pos)
)
SELECT w, string_agg(tok::VARCHAR, ' ' ORDER BY pos) AS ids FROM step WHERE tok >= 0 GROUP BY w
"""
#: Rows of (text, position, token) join the vocabulary; the ordered aggregation concatenates.
DECODE = "SELECT r.d, string_agg(v.bytes, '' ORDER BY r.pos) AS decoded FROM rows r JOIN vocab v ON v.id = r.tok GROUP BY r.d ORDER BY r.d"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Rank table in DuckDB; what distinct pre-tokens, and chunks of them, encode to."""

    def __init__(self, path: str, pattern: str | None = None):
        import duckdb
        import regex

        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        self.split = regex.compile(spelled(pattern)).findall
        self.ranks = ranks = read_ranks(path)
        self.bytes_of = {v: k for k, v in ranks.items()}
        pairs = [(ranks[b[:i]], ranks[b[i:]], r) for b, r in ranks.items() for i in range(1, len(b)) if b[:i] in ranks and b[i:] in ranks]
        l, r, ids = zip(*pairs, strict=True)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self.put("merges", l=pa.array(l, pa.int32()), r=pa.array(r, pa.int32()), id=pa.array(ids, pa.int64()))
        self.put("vocab", id=pa.array(list(self.bytes_of), pa.int64()), bytes=pa.array([b.hex() for b in self.bytes_of.values()]))
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces: dict[str, str] = {}  # pre-token: ids as text
        self.ids: dict[str, str] = {}  # chunk between two single spaces: ids as text

    def put(self, name: str, **columns: pa.Array) -> None:
        self.con.register("incoming", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def learn(self, pieces: set[str]) -> None:
        """Encode distinct pre-tokens by contraction to a fixpoint."""
        todo = []
        for p in pieces:
            raw = p.encode()
            if len(raw) > QUERY_BYTES:
                self.pieces[p] = " ".join(map(str, self.by_heap(raw)))
            else:
                todo.append((p, raw))
        todo.sort(key=lambda x: len(x[1]))  # a query takes as many passes as its longest word
        held = np.cumsum([len(raw) for _, raw in todo]) // QUERY_POSITIONS
        edges = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(todo)]
        for at, end in zip(edges, edges[1:], strict=False):
            part = todo[at:end]
            if not part:
                continue
            sizes = np.array([len(raw) for _, raw in part])
            last = np.cumsum(sizes) - 1
            tok = self.single[np.frombuffer(b"".join([raw for _, raw in part]), np.uint8)]
            pos = np.arange(len(tok)) - np.repeat(last - sizes + 1, sizes)
            follows = np.append(tok[1:], -1)
            follows[last] = -1
            self.put("start", w=pa.array(np.repeat(np.arange(len(part), dtype=np.int32), sizes)), pos=pa.array(pos), after=pa.array(pos + 1), tok=pa.array(tok), follows=pa.array(follows.astype(np.int32)))
            got = self.con.sql(CONTRACT).to_arrow_table()
            for i, ids in zip(*(got.column(k).to_pylist() for k in range(2)), strict=True):
                self.pieces[part[i][0]] = ids

    def decode(self, ids: list[str]) -> list[bytes]:
        """The bytes of each text's ids, by ordered aggregation over rows of bounded number; a longer text comes in parts."""
        counts = [x.count(" ") + 1 if x else 0 for x in ids]
        flat = np.fromstring(" ".join(filter(None, ids)), np.int32, sep=" ")
        text = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        parts: list[list[bytes]] = [[] for _ in ids]
        for at in range(0, len(flat), QUERY_POSITIONS):
            tok = flat[at : at + QUERY_POSITIONS]
            self.put("rows", d=pa.array(text[at : at + len(tok)]), pos=pa.array(np.arange(len(tok), dtype=np.int32)), tok=pa.array(tok))
            got = self.con.sql(DECODE).to_arrow_table()
            for i, x in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
                parts[i].append(bytes.fromhex(x))
        return [b"".join(p) for p in parts]

    def by_heap(self, raw: bytes) -> list[int]:
        """The same contraction for a very long pre-token, with a heap of (rank, position)."""
        ranks, n = self.ranks, len(raw)
        end, after, before, alive = [i + 1 for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := ranks.get(raw[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, end[i], end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != middle or after[i] >= n or end[after[i]] != stop:
                continue
            j = after[i]
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[raw[i : end[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[str], memo: int = MEMO) -> list[str]:
        """Ids, as text, of each text.

        No pre-token reaches over a single space between two other characters, so what stands
        between such spaces is looked up whole.
        """
        chunked = [self.chunks(t) for t in texts]
        seen = set().union(*chunked)
        if len(self.ids) > memo:
            self.ids = {c: self.ids[c] for c in seen.intersection(self.ids)}
        new = seen.difference(self.ids)
        tied = {c for c in new if self.open(c)}
        fresh = {c: self.split(c) for c in new - tied}
        whole = {i: self.split(t) for i, t in enumerate(texts) if tied and not tied.isdisjoint(chunked[i])}
        needed = set().union(*fresh.values(), *whole.values())
        if len(self.pieces) > memo:
            self.pieces = {p: self.pieces[p] for p in needed.intersection(self.pieces)}
        self.learn(needed.difference(self.pieces))
        pieces, ids_of = self.pieces, self.ids
        for c, parts in fresh.items():
            ids_of[c] = pieces[parts[0]] if len(parts) == 1 else " ".join([pieces[p] for p in parts])
        out = [" ".join([pieces[p] for p in whole[i]]) if i in whole else " ".join(map(ids_of.__getitem__, chunks)) for i, chunks in enumerate(chunked)]
        for kept, used in ((pieces, needed), (ids_of, new - tied)):
            for long in [x for x in used if len(x) > MEMO_LENGTH]:
                kept.pop(long, None)
        return out

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The text cut before single spaces; the first chunk has no space of its own."""
        first, *rest = text.split(" ")
        return [first, *[" " + c for c in rest]] if first or rest else []

    @staticmethod
    def open(chunk: str) -> bool:
        """Whether white space at a chunk's ends could join what stands next to it."""
        bare = chunk[1:] if chunk[:1] == " " else chunk
        return not bare or bare[0].isspace() or bare[-1].isspace()


def codec(path: str) -> Codec:
    if path not in _loaded:
        _loaded[path] = Codec(path)
    return _loaded[path]


def unload() -> None:
    for c in _loaded.values():
        c.con.close()
    _loaded.clear()


def bpe_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = True, memo: int = MEMO, keep: bool = True) -> DataFrame:
    """One row per row of docs: id, n_tokens, ids (array, only with with_ids), ids_sha256, decoded_sha256.

    memo says how many pre-tokens and chunks a worker keeps: memory for time; without keep it
    keeps them, and the tables, only to the end of a task (Spark deals tasks to its idle workers
    in turn, so that otherwise all of them come to hold their own).
    Null text counts as empty: no tokens, the digests of nothing. Null ids are carried,
    repeated rows repeat, extra columns are not read. No shuffle. Token-position rows of a
    batch's distinct pre-tokens join the merge table inside DuckDB; each pass contracts the
    leftmost pair of least rank of every word until no pair is left. The ids of each whole text
    are decoded again by an ordered aggregation over their positions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("byte_bpe", unload)  # kept from task to task of this operator
        c = codec(tokenizer_path("byte_bpe_50k.tiktoken", path))
        gc.disable()  # no cycles are made here, and passes over large memos are slow
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    ids = c.encode([t or "" for t in part.column(1).to_pylist()], memo)
                    columns = [part.column(0), pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64())]
                    if with_ids:
                        columns.append(pa.array([list(map(int, x.split())) for x in ids], pa.list_(pa.int32())))
                    columns += [pa.array([sha256(x.encode()).hexdigest() for x in ids]), pa.array([sha256(x).hexdigest() for x in c.decode(ids)])]
                    yield pa.record_batch(columns, names=[id_col, "n_tokens", *["ids"] * with_ids, "ids_sha256", "decoded_sha256"])
        finally:
            gc.enable()
            if not keep:
                del c
                let_go("byte_bpe")

    picked = spread(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text")))
    return picked.mapInArrow(run, f"`{id_col}` long, n_tokens long, {'ids array<int>, ' * with_ids}ids_sha256 string, decoded_sha256 string")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(read(spark, sf_dir, "documents"), with_ids=False)
