"""Rules over the image log: states, decisions, actions, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.rules import LANGUAGE_STATES, YES_STATES


def as_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def decode_set(c: Column) -> Column:
    """{'f', 'v'} as a sorted array; an empty set prints as set()."""
    return as_set(F.regexp_extract_all(c, F.lit("'([^']*)'"), F.lit(1)))


def encode_set(c: Column) -> Column:
    return F.when(F.size(c) == 0, "set()").otherwise(F.concat(F.lit("{'"), F.array_join(c, "', '"), F.lit("'}")))


def needs_transcription(included: Column, states: Column) -> Column:
    return F.coalesce(included == 1, F.lit(False)) & (F.size(states) > 0) & ~F.arrays_overlap(states, literals(["b", "p", "m"]))


def undecided(included: Column) -> Column:
    return included.isNull() | ~included.isin(0, 1)


def default_decision(included: Column, states: Column) -> Column:
    """A decision where states imply one: yes for languages, manuscript, no text and renaming, else no."""
    return F.when(included.isNull() & (F.size(states) > 0) & ~F.array_contains(states, "s"), F.arrays_overlap(states, literals(YES_STATES)).cast("int")).otherwise(included)


def on_yes(states: Column) -> Column:
    return F.when(F.size(states) == 0, literals(["f"])).otherwise(states)


def toggle(states: Column, key: Column) -> Column:
    """A state on or off; a duplicate no longer exists."""
    on = F.when(key == "d", F.array(F.lit("d"), F.lit("x"))).otherwise(F.array(key))
    return as_set(F.when(F.array_contains(states, key), F.array_except(states, F.array(key))).otherwise(F.array_union(states, on)))


def empty_structure(states: Column, interest: Column) -> Column:
    return F.when(interest.isin(1, 2), as_set(F.array_union(states, literals(["v"])))).otherwise(states)


def default_interest(interest: Column, states: Column) -> Column:
    return F.coalesce(interest, F.when(F.array_contains(states, "v"), 2).otherwise(4))


def consistency(df: DataFrame, mark: Column | None = None) -> DataFrame:
    """Three conditions of a row: duplicate field and state agree, so do renaming and state, shelf mark and name.

    mark is the shelf mark as a name spells it, where that isn't the shelf mark itself.
    """
    same = lambda a, b: a == b
    return df.withColumn("doublon_ok", same(F.col("doublon").isNotNull(), F.array_contains("states", "d"))).withColumn("renaming_ok", same(F.col("Z_name") != F.col("should_be_name"), F.array_contains("states", "r"))).withColumn("cote_ok", (F.col("cote") if mark is None else mark).eqNullSafe(N.cote(F.col("should_be_name"))))


def rename_actions(df: DataFrame, present: Column, target_present: Column, mark: Column | None = None) -> DataFrame:
    """(src, dst, action): what renaming would do to each file; nothing is moved here. The shelf mark is that of the new name, or mark."""
    action = F.when(undecided(F.col("is_included")), "undecided").when(F.col("is_included") == 0, "garbage").when(target_present, "exists").when(~present, "missing").otherwise("move")
    dst = F.when(F.col("is_included") == 1, N.canonical(F.col("should_be_name"), mark))
    return df.select(F.col("Z_name").alias("src"), dst.alias("dst"), action.alias("action"))


def dispatch(df: DataFrame) -> DataFrame:
    """A row per image and language batch: f, t and l go to fr, a goes to de."""
    lanes = F.array_compact(F.array(F.when(F.arrays_overlap("states", literals(["f", "t", "l"])), "fr"), F.when(F.array_contains("states", "a"), "de")))
    return df.filter("needs_transcription").select("Z_name", N.batch_folder(F.col("Z_name")).alias("folder"), F.explode(lanes).alias("lane"))


def link_binaries(df: DataFrame, files: DataFrame, also: list[str] | None = None) -> DataFrame:
    """Names of the binary files of each image by the shelf mark and page in both; one or two are expected.

    also names columns of both that have to agree too, where marks in names may coincide.
    """
    key = [*(also or []), "_k"]
    held = files.withColumn("_k", N.join_key(F.col("file"))).groupBy(*key).agg(F.sort_array(F.collect_set("file")).alias("binary_files"))
    out = df.withColumn("_k", N.join_key(F.col("Z_name"))).join(held, key, "left").drop("_k").withColumn("binary_files", F.coalesce("binary_files", F.array().cast("array<string>")))
    return out.withColumn("expected", F.size("binary_files").between(1, 2))


def any_or_null(c: Column) -> Column:
    """Null if any is null, else whether any is true."""
    return F.when(F.bool_or(c.isNull()), F.lit(None)).otherwise(F.bool_or(c))


def harmonised(interests: Column, states: Column) -> Column:
    """One degree of interest for a shelf mark from those of its images (nulls left out)."""
    rest = F.array_except(interests, F.array(F.lit(2), F.lit(4)))
    return F.when(F.size(interests) == 0, F.lit(None).cast("int")).when(F.size(interests) == 1, F.get(interests, F.lit(0))).when(F.size(rest) == 1, F.get(rest, F.lit(0))).otherwise(F.when(F.array_contains(states, "v"), 2).otherwise(4))


def cote_rollup(df: DataFrame) -> DataFrame:
    """Included images by shelf mark: states, names, harmonised interest, compilation flag, number of images."""
    g = df.filter("is_included = 1").groupBy("cote").agg(
        as_set(F.flatten(F.collect_set("states"))).alias("states"), F.sort_array(F.collect_list("Z_name")).alias("images"),
        F.sort_array(F.collect_set("interest")).alias("_i"), any_or_null(F.col("is_compil")).alias("is_compil"), F.count("*").alias("n_images"),
    )
    return g.withColumn("interest", harmonised(F.col("_i"), F.col("states"))).drop("_i")


def state_pivot(states: Column) -> list[Column]:
    flags = {"structure_vide": "v", "manuscrit": "m", "lang_fr": "f", "lang_de": "a", "lang_it": "t", "lang_la": "l", "lang_sans_texte": "b"}
    return [F.array_contains(states, code).alias(name) for name, code in flags.items()]


def upsert(df: DataFrame, changes: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of changes replace or join those of df."""
    return df.join(changes, key, "left_anti").unionByName(changes, allowMissingColumns=True)


def language_rows(df: DataFrame) -> DataFrame:
    return df.select("cote", F.explode(F.array_intersect("states", literals(LANGUAGE_STATES))).alias("state"))
