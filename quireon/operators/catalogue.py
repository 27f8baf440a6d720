"""Steps of the catalogue: side tables, language columns, entries of the selection and correction screens, progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.rules import LANGUAGE_STATES
from .log import any_or_null, as_set, literals, undecided

ROW_DEFAULTS = {"states": "array<string>", "selection_version": "string", "is_included": "int", "doublon": "string", "remarque": "string"}


# Columns of images and shelf marks
def linked_text(text: Column, has_binary: Column) -> Column:
    """The text's name or content, null where the image has no binary file."""
    return F.when(has_binary, text)


def by_language(text: Column, states: Column) -> list[Column]:
    """The text under each language that the image has."""
    flags = {"texte_fr": "f", "texte_la": "l", "texte_it": "t"}
    return [F.when(F.array_contains(states, code), text).alias(name) for name, code in flags.items()]


def derived_names(base: Column, states: Column, has_text: Column, kind: str) -> list[Column]:
    """Name of the derived text of each romance language, where the image has that language and a text."""
    flags = {"fr": "f", "it": "t", "la": "l"}
    return [F.when(has_text & F.array_contains(states, code), N.language_name(base, F.lit(code), kind)).alias(f"{name}_{kind}") for name, code in flags.items()]


def cote_flags(states: Column) -> list[Column]:
    flags = {"lang_fr": "f", "lang_de": "a", "lang_it": "t", "lang_la": "l", "structure_vide": "v"}
    return [F.array_contains(states, code).alias(name) for name, code in flags.items()]


def language_pages(df: DataFrame) -> DataFrame:
    """(cote, state, pages): sorted names of each language's pages, without manuscripts and pages without text."""
    typed = df.filter(~F.arrays_overlap("states", literals(["m", "b"])))
    rows = typed.select("cote", "Z_name", F.explode(F.array_intersect("states", literals(LANGUAGE_STATES))).alias("state"))
    return rows.groupBy("cote", "state").agg(F.sort_array(F.collect_list("Z_name")).alias("pages"))


def with_missing(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Columns that aren't there yet, at their defaults."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


# Joins with side tables
def with_generated_names(cotes: DataFrame, files: DataFrame, column: str) -> DataFrame:
    """The generated file of each shelf mark, by the shelf mark in its name; unknown ones get a row of their own."""
    return cotes.join(files.select(N.cote(F.col("file")).alias("cote"), F.col("file").alias(column)), "cote", "full")


def with_sizes(images: DataFrame, sizes: DataFrame, key: str | list[str] = "Z_name") -> DataFrame:
    """Sizes of images by their key: the name, or names of columns where names alone may coincide."""
    return images.join(sizes.select(*([key] if isinstance(key, str) else key), "width", "height"), key, "left")


def first_rows(df: DataFrame, columns: list[str], order: str = "Z_name") -> DataFrame:
    """Of each shelf mark its first row's columns, in order of the name."""
    first = df.groupBy("cote").agg(F.min_by(F.struct(*columns), order).alias("_f"))
    return first.select("cote", *[F.col(f"_f.{c}").alias(c) for c in columns])


def required(df: DataFrame, table: DataFrame, key: str, column: str) -> DataFrame:
    """The column of a table that has to have a row for every key; the least one counts, and a missing one is an error."""
    found = table.groupBy(key).agg(F.min(F.struct(column)).alias("_f"))
    joined = df.join(found, key, "left")
    value = F.when(F.col("_f").isNull(), F.raise_error(F.concat(F.lit(f"no {column} for "), F.col(key)))).otherwise(F.col(f"_f.{column}"))
    return joined.withColumn(column, value).drop("_f")


# Statistics
def compilations(df: DataFrame) -> DataFrame:
    """How many shelf marks are compilations; one with an undecided image is none."""
    return df.groupBy("cote").agg(any_or_null(F.col("is_compil")).alias("c")).agg(F.count_if(F.coalesce("c", F.lit(False))).alias("n_compilations"))


def fill_rates(df: DataFrame, text: str, column: str) -> DataFrame:
    """Share of simple documents with text that have the column, by interest."""
    simple = df.filter(F.col(text).isNotNull() & (F.col("is_compil") == False)).filter("interest is not null")  # noqa: E712
    return simple.groupBy("interest").agg(F.round(F.count(column) / F.count(text), 3).alias("rate"))


def liability_counts(df: DataFrame, text: str, code: str) -> DataFrame:
    """Texts by interest and code of how a value was found, over all documents."""
    return df.filter(F.col("interest").isNotNull() & F.col(code).isNotNull()).groupBy("interest", code).agg(F.count(text).alias("n"))


def progress(df: DataFrame) -> DataFrame:
    """Of each shelf mark: images to transcribe in a romance language, corrected ones, whether any and all are."""
    mine = df.filter(F.col("needs_transcription") & F.arrays_overlap("states", literals(["f", "l", "t"])))
    return mine.groupBy("cote").agg(F.count("*").alias("n"), F.count_if("has_been_corrected").alias("corrected"), F.bool_or("has_been_corrected").alias("begun"), F.bool_and("has_been_corrected").alias("done"))


def without_binary(df: DataFrame) -> DataFrame:
    """Images that need a text and have no binary file, German ones left out."""
    return df.filter(F.col("needs_transcription") & (F.size("binary_files") == 0) & ~F.array_contains("states", "a"))


# Entries of the selection screen
def default_row(names: DataFrame, version: str) -> DataFrame:
    """A row at its defaults for each Z_name; its shelf mark is the one given, or else that of the name."""
    cote = F.col("cote") if "cote" in names.columns else N.cote(F.col("Z_name"))
    values = {"states": F.array().cast("array<string>"), "selection_version": F.lit(version)}
    return names.select("Z_name", F.col("Z_name").alias("should_be_name"), cote.alias("cote"), *[(values[c] if c in values else F.lit(None)).cast(t).alias(c) for c, t in ROW_DEFAULTS.items()])


def loaded(names: DataFrame, log: DataFrame, version: str) -> DataFrame:
    """The log's row of each name, or one at its defaults; where names come with their shelf mark, that has to agree too."""
    default, key = default_row(names, version), [c for c in ("cote", "Z_name") if c in names.columns]
    return log.join(names.select(key), key, "left_semi").select(default.columns).unionByName(default.join(log, key, "left_anti"))


def merged(old: Column, value: Column, f: Callable[[Column, Column], Column]) -> Column:
    """The value, merged with the old one where there is one."""
    return F.when(old.isNull(), value).otherwise(f(old, value))


def entry(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def entered(df: DataFrame, name: Column, doublon: Column, remarque: Column) -> DataFrame:
    """What the text fields do to a row: a new name adds state r and moves the shelf mark, else a duplicate's name adds d; empty entries are null."""
    renamed = name != F.col("should_be_name")
    key = F.when(renamed, "r").when((F.length(doublon) > 0) & ~F.array_contains("states", "d"), "d")
    return df.withColumns({
        "states": F.when(key.isNull(), F.col("states")).otherwise(as_set(F.array_union("states", F.array(key)))),
        "cote": F.when(renamed, N.cote(name)).otherwise(F.col("cote")), "should_be_name": name, "doublon": entry(doublon), "remarque": entry(remarque),
    })


# Corrections and recognised texts
def corrected(log: DataFrame, saved: DataFrame) -> DataFrame:
    """saved (Z_name, interest, is_compil): these images are corrected; interest and compilation hold for their whole shelf mark, the last name's count.

    Where saved has the shelf mark too, it has to agree as well as the name.
    """
    key = [c for c in ("cote", "Z_name") if c in saved.columns]
    marks = saved.select(*key, F.lit(True).alias("_saved"))
    of = saved.join(log.select("Z_name", "cote"), key).groupBy("cote").agg(F.max_by(F.struct("interest", "is_compil"), "Z_name").alias("_of"))
    joined = log.join(marks, key, "left").join(of, "cote", "left")
    new = lambda c: F.when(F.col("_of").isNotNull(), F.col(f"_of.{c}")).otherwise(F.col(c))
    out = joined.withColumns({"has_been_corrected": F.coalesce("_saved", "has_been_corrected"), "interest": new("interest"), "is_compil": new("is_compil")})
    return out.select(log.columns)


def recognised(parts: DataFrame, also: list[str] | None = None) -> DataFrame:
    """(Z_name, text) from (Z_name, file, text): texts of an image's files in order of their names; one empty text and there is none.

    also names columns that tell images apart whose names coincide.
    """
    g = parts.groupBy("Z_name", *(also or [])).agg(F.array_sort(F.collect_list(F.struct("file", "text"))).alias("p"), F.bool_and(F.length("text") > 0).alias("whole"))
    return g.select("Z_name", F.when(F.col("whole"), F.array_join(F.transform("p", lambda x: x["text"]), "\n")).alias("text"))


def assembled(pages: Column) -> Column:
    """Pages as one text: no blank lines, words that a hyphen parts at a line's end joined."""
    return F.regexp_replace(F.regexp_replace(F.array_join(pages, "\n"), "\n+", "\n"), r"(?U)(\w)-\n(\w)", "$1$2")


def files_by_cote(files: DataFrame) -> DataFrame:
    """(cote, n): files of each shelf mark in a list of names."""
    return files.groupBy(N.cote(F.col("file")).alias("cote")).agg(F.count("*").alias("n"))


def next_image(log: DataFrame, files: DataFrame, part: Column, also: list[str] | None = None) -> DataFrame:
    """(part, file): the least undecided image of each part, else the least file that the log lacks; none where all is decided.

    also names columns of log and files that tell images apart whose names coincide.
    """
    key = [*(also or []), "Z_name"]
    open_ = log.filter(undecided(F.col("is_included"))).groupBy(part.alias("part")).agg(F.min("Z_name").alias("_undecided"))
    new = files.withColumnRenamed("file", "Z_name").join(log.select(key), key, "left_anti").groupBy(part.alias("part")).agg(F.min("Z_name").alias("_new"))
    return open_.join(new, "part", "full").select("part", F.coalesce("_undecided", "_new").alias("file"))


def next_batch(todo: DataFrame, done: DataFrame, key: str, cap: int = 5000) -> DataFrame:
    """The first rows, by key, that aren't done; a run takes cap of them at most, and the next run goes on."""
    return todo.join(done.select(key), key, "left_anti").orderBy(key).limit(cap)


def fitted(width: Column, height: Column, most: int) -> Column:
    """struct(width, height, ratio) of an image scaled to a square of side most."""
    tall = height > width
    side = lambda a, b: F.floor(F.lit(most) * a / b).cast("int")
    return F.struct(F.when(tall, side(width, height)).otherwise(most).alias("width"), F.when(tall, most).otherwise(side(height, width)).alias("height"), (F.greatest(width, height) / most).alias("ratio"))
