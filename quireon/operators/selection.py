"""Replay of the selection screen: key presses folded, in order, into a row of the log per image."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.rules import STATES, YES_STATES

ROW = "is_included int, states array<string>, doublon string, remarque string, should_be_name string, cote string, presses long"
#: What a press is: key (a state, 1 or y, 0 or n, Return) and, with Return, the three entries and what they hold.
PRESS = ["key", "name", "doublon", "remarque", "name_cote", "entries_ok"]


def with_entries(presses: DataFrame) -> DataFrame:
    """presses with what Return needs of its entries: the new name's shelf mark, and whether name and duplicate may stand.

    A name needs shelf mark and page; a duplicate is empty or has a shelf mark. Nulls count as empty.
    """
    name, double = F.coalesce("name", F.lit("")), F.coalesce("doublon", F.lit(""))
    return presses.withColumns({"name": name, "doublon": double, "remarque": F.coalesce("remarque", F.lit("")), "name_cote": N.cote(name), "entries_ok": N.is_valid(name) & ((double == "") | F.coalesce(double.rlike(r"\d"), F.lit(False)))})


def fresh(name: str, cote: str) -> dict:
    """An image that nobody has looked at."""
    return {"is_included": None, "states": set(), "doublon": None, "remarque": None, "should_be_name": name, "cote": cote, "presses": 0}


def pressed(row: dict, press: dict) -> dict:
    """row after a press.

    Yes without a state takes f; a state set while undecided decides (yes for languages,
    manuscript, no text and renaming), a duplicate no longer exists, a special case is undecided
    again; a state pressed again goes. Return records the entries, if they may stand: a new name
    is to be renamed and may change the shelf mark, else a duplicate's name sets its state.
    """
    row = row | {"presses": row["presses"] + 1, "states": set(row["states"])}
    key, state = press["key"], None
    if key in ("1", "y"):
        row["is_included"] = 1
        row["states"] = row["states"] or {"f"}
    elif key in ("0", "n"):
        row["is_included"] = 0
    elif key in STATES and key in row["states"]:
        row["states"].remove(key)
    elif key in STATES:
        state = key
    elif key == "Return" and press["entries_ok"]:
        if press["name"] != row["should_be_name"]:
            state = "r"
            row["cote"] = press["name_cote"]
        elif press["doublon"] and "d" not in row["states"]:
            state = "d"
        row |= {"should_be_name": press["name"], "doublon": press["doublon"] or None, "remarque": press["remarque"] or None}
    if state:
        row["states"] |= {state, "x"} if state == "d" else {state}
        if row["is_included"] is None:
            row["is_included"] = int(state in YES_STATES)
        if key == "s":
            row["is_included"] = None
    return row


def replayed(presses: DataFrame, key: str = "image") -> DataFrame:
    """(image, ROW) after all presses of each image, in order of (ts, event_id); an event that comes twice counts once.

    presses has image, image_name, ts, event_id, key, name, doublon, remarque. Rows are dealt by
    image and sorted; a task holds one row of the log at a time, however many presses an image has.
    """
    rows = with_entries(presses).withColumn("image_cote", N.cote(F.col("image_name"))).dropDuplicates([key, "ts", "event_id"])
    rows = rows.select(key, "image_name", "image_cote", *PRESS, "ts", "event_id").repartition(key).sortWithinPartitions(key, "ts", "event_id")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, row, done = None, None, []
        for batch in batches:
            for p in batch.to_dict("records"):
                if row is None or p[key] != at:
                    if row is not None:
                        done.append({key: at, **row, "states": sorted(row["states"])})
                    at, row = p[key], fresh(p["image_name"], p["image_cote"])
                row = pressed(row, p)
            if done:
                yield framed(done, key)
                done = []
        if row is not None:
            yield framed([{key: at, **row, "states": sorted(row["states"])}], key)

    return rows.mapInPandas(fold, f"{key} long, {ROW}")


def framed(rows: list[dict], key: str) -> pd.DataFrame:
    names = [key, *(c.split()[0] for c in ROW.split(", "))]
    return pd.DataFrame(rows, columns=names).astype({"is_included": "Int32"})
