"""File-name and shelf-mark functions as column expressions; a name that doesn't parse gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def cote(name: Column) -> Column:
    """First number of the name without leading zeros, and the small letters after it."""
    digits = _or_null(F.regexp_extract(name, r"(\d+)([a-z]*)", 1))
    return F.concat(digits.cast("decimal(38,0)").cast("string"), F.regexp_extract(name, r"(\d+)([a-z]*)", 2))


def page(name: Column, ext: str = ".jpg") -> Column:
    """First three digits before the extension (whose dot stands for any character)."""
    return _or_null(F.regexp_extract(name, rf"(\d\d\d){ext}", 1))


def prefix(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def is_valid(name: Column, ext: str = "jpg") -> Column:
    return name.rlike(rf"\d+[a-z]*.*\d\d\d\.{ext}")


def canonical(name: Column, mark: Column | None = None) -> Column:
    """CH-AEV_IV_<cote>_<ppp>.jpg, or null where the name doesn't end in three digits and .jpg; the shelf mark is that of the name, or mark."""
    return F.concat(F.lit("CH-AEV_IV_"), cote(name) if mark is None else mark, F.lit("_"), _or_null(F.regexp_extract(name, r"(\d\d\d\.jpg)$", 1)))


def official(name: Column, is_included: Column, mark: Column | None = None) -> Column:
    return F.when(is_included == 1, canonical(name, mark))


def text_name(name: Column) -> Column:
    return F.concat(prefix(name), F.lit("_fr.txt"))


def language_name(base: Column, state: Column, kind: str) -> Column:
    """<base>_<fr|de|it|la>_<kind>.txt for a language state."""
    code = F.create_map(*[F.lit(x) for pair in {"f": "fr", "a": "de", "t": "it", "l": "la"}.items() for x in pair])
    return F.concat(base, F.lit("_"), F.element_at(code, state), F.lit(f"_{kind}.txt"))


def batch(name: Column) -> Column:
    return F.expr("bigint(0)") + (_or_null(F.regexp_extract(name, r"(\d+)", 1)).cast("bigint") / 100).cast("bigint")


def batch_folder(name: Column) -> Column:
    return F.format_string("batch%02d", batch(name))


def join_key(name: Column) -> Column:
    return _or_null(F.regexp_extract(name, r"(\d+[a-z]*_\d+)", 1))


def page_label(name: Column) -> Column:
    return F.right(name, F.lit(3))


def image_id(name: Column) -> Column:
    return prefix(name)


def image_url(name: Column, base: str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), name)
