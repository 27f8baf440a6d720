"""Fill-in-the-middle transformation: big integers with a bit per byte mark token starts, and halving selects the cuts."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_memos, read, spread

#: What precedes prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
_letters = frozenset(range(ord("A"), ord("Z") + 1)) | frozenset(range(ord("a"), ord("z") + 1))
#: Byte classes as the digits of a binary number: ASCII letters, and bytes that go on with a code point.
LETTER = bytes(ord("1") if b in _letters else ord("0") for b in range(256))
INNER = bytes(ord("1") if 0x80 <= b < 0xC0 else ord("0") for b in range(256))


def starts_of(raw: bytes) -> tuple[int, int]:
    """Two masks of UTF-8 bytes, the first byte in the highest bit: starts of tokens, and starts of code points.

    A token is a run of ASCII letters or any other single code point: it starts at a byte that
    begins a code point, unless this byte and the one before it (one bit higher) are letters.
    """
    if not raw:
        return 0, 0
    letter, inner = int(raw.translate(LETTER), 2), int(raw.translate(INNER), 2)
    points = ~inner & ((1 << len(raw)) - 1)
    return points & ~(letter & letter >> 1), points


def select(mask: int, width: int, rank: int) -> int:
    """The place of the set bit with rank others above it, counted from the highest of width bits; width if there is none.

    Each step halves what is left, so all steps together read as much as the first one twice.
    """
    if rank >= mask.bit_count():
        return width
    at = 0
    while width > 1:
        low = width // 2
        high = mask >> low
        above = high.bit_count()
        if rank < above:
            mask, width = high, width - low
        else:
            mask, rank, at, width = mask & ((1 << low) - 1), rank - above, at + width - low, low
    return at


def draws(id_: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from a hash of the seed and the id (nothing where the id is null)."""
    digest = sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearranged(raw: bytes, id_: int | None, seed: int, marks: tuple[bytes, ...], fim_percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    tokens, points = starts_of(raw)
    n, width = tokens.bit_count(), len(raw)
    a, b, kind, order = draws(id_, seed)
    if not raw or kind % 100 >= fim_percent or any(m in raw for m in marks):
        return n, "plain", None, None, raw
    first, second = sorted((a % (n + 1), b % (n + 1)))
    i, j = select(tokens, width, first), select(tokens, width, second)
    prefix, middle, suffix = raw[:i], raw[i:j], raw[j:]
    to_i, to_j = (points >> width - i).bit_count(), (points >> width - j).bit_count()
    p, s, m = marks
    if order % 100 < spm_percent:
        return n, "spm", to_i, to_j - to_i, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", to_i, to_j - to_i, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, fim_percent: int = 90, spm_percent: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """One row per row of docs: id, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars, output.

    A text is cut at two token starts (or its end) drawn from a hash of seed and id. It stays as
    it is, form plain with null lengths, where it is empty (null too), holds a mark or is drawn
    so. Rows with equal ids are cut at the same draws; null ids share those of an empty id. Extra
    columns are not read; an empty table gives an empty result. A text of any length takes time
    and memory in proportion to it. No shuffle.
    """
    as_bytes = tuple(m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("fill_middle")
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                raws = part.column(1).cast(pa.binary()).to_pylist()
                got = [rearranged(raw or b"", i, seed, as_bytes, fim_percent, spm_percent) for i, raw in zip(part.column(0).to_pylist(), raws, strict=True)]
                n, form, prefix, middle, output = zip(*got, strict=True)
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    picked = spread(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text")))
    return picked.mapInArrow(run, f"`{id_col}` long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output of a form was made of. A mark's first occurrence is its own, since texts with marks stay plain."""
    p, s, m = marks
    between = lambda a, b: F.substring_index(F.substr(output, F.lit(len(a) + 1)), b, 1)
    after = lambda a: F.substr(output, F.locate(a, output) + len(a))
    middle = after(m)
    psm = F.concat(between(p, s), middle, F.substring_index(after(s), m, 1))
    spm = F.concat(F.substring_index(after(p), m, 1), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP11_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h FROM documents),
d AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS bigint) AS h1, CAST('0x' || h[9:16] AS bigint) AS h2, CAST('0x' || h[17:24] AS bigint) AS h3, CAST('0x' || h[25:32] AS bigint) AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
