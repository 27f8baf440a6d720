"""The selection screen replayed: batch fold against the rules press by press, stream against batch."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quireon.operators import selection as K
from quireon.plans.replay import presses
from quireon.streaming import selection as S

SF = "/root/testdata/sf0.001"
PRESS = "event_id long, ts timestamp, image long, image_name string, key string, name string, doublon string, remarque string"
T0 = datetime(2024, 1, 1)


def press(n, key, image=1, name="Ch-AEV_000001_001.jpg", doublon=None, remarque=None, at=None):
    return (n, T0 + timedelta(seconds=n if at is None else at), image, f"Ch-AEV_{image:06d}_001.jpg", key, name, doublon, remarque)


def state(spark, rows):
    r = K.replayed(spark.createDataFrame(rows, PRESS)).collect()
    return {x.image: x for x in r}


@pytest.mark.parametrize(
    ("keys", "included", "states"),
    [("y", 1, ["f"]), ("v", 0, ["v"]), ("vy", 1, ["v"]), ("a", 1, ["a"]), ("aa", 1, []), ("d", 0, ["d", "x"]), ("s", None, ["s"]), ("ys", None, ["f", "s"]), ("sa", 1, ["a", "s"]), ("ssa", 1, ["a"]), ("n1", 1, ["f"]), ("0f", 0, ["f"]), ("?", None, []), ("dx", 0, ["d"])],
)
def test_keys(spark, keys, included, states):
    r = state(spark, [press(k, key) for k, key in enumerate(keys)])[1]
    assert (r.is_included, r.states, r.presses) == (included, states, len(keys))


def test_entries(spark):
    """A new name changes the shelf mark and is to be renamed; a duplicate sets its state; entries that can't stand change nothing."""
    new, old = "CH-AEV_IV_77bis_002.jpg", "Ch-AEV_000001_001.jpg"
    r = state(spark, [press(0, "Return", name=new, doublon="", remarque="torn")])[1]
    assert (r.should_be_name, r.cote, r.states, r.is_included, r.doublon, r.remarque) == (new, "77bis", ["r"], 1, None, "torn")
    r = state(spark, [press(0, "Return", name=old, doublon="CH 12")])[1]
    assert (r.cote, r.states, r.is_included, r.doublon) == ("1", ["d", "x"], 0, "CH 12")
    for bad in ({"name": "nothing"}, {"name": None}, {"name": new, "doublon": "none"}):
        r = state(spark, [press(0, "Return", **bad)])[1]
        assert (r.should_be_name, r.states, r.is_included, r.doublon) == (old, [], None, None)


def test_order_repeats_and_images(spark):
    """Order is that of time and event, whatever the rows' order; an event that comes twice counts once; no presses, no rows."""
    rows = [press(3, "a", at=30), press(1, "v", at=10), press(2, "a", at=30), press(2, "a", at=30), press(4, "y", image=2)]
    got = state(spark, rows)
    assert (got[1].states, got[1].presses, got[1].is_included) == (["v"], 3, 0) and got[2].states == ["f"]
    assert state(spark, []) == {}


def test_stream_equals_batch(spark, tmp_path):
    """Presses in three micro-batches, some late, some twice; a last press a year later lets the watermark pass the others."""
    rows = sorted((r.asDict() for r in presses(spark, SF).collect()), key=lambda r: r["ts"])
    third = len(rows) // 3
    parts = [rows[:third], rows[third : 2 * third], rows[2 * third :]]
    late = [r for r in parts[0][-40:] if (parts[0][-1]["ts"] - r["ts"]) < timedelta(minutes=200)][::3]
    parts[0] = [r for r in parts[0] if r not in late]
    parts[1] = parts[1] + late + parts[0][-5:] + parts[1][3:6]
    end = rows[-1] | {"event_id": 10**9, "ts": rows[-1]["ts"] + timedelta(days=365), "image": 10**9}
    parts.append([end])
    for k, part in enumerate(parts):
        (tmp_path / "in").mkdir(exist_ok=True)
        with open(tmp_path / "in" / f"{k}.json", "w") as f:
            for r in part:
                f.write(json.dumps(r, default=lambda t: t.isoformat()) + "\n")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", S.PROVIDER)
    try:
        stream = spark.readStream.schema(PRESS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        out = S.replayed_stream(stream, "300 minutes")
        q = out.writeStream.foreachBatch(lambda df, n: df.withColumn("n", F.lit(n)).write.mode("append").parquet(str(tmp_path / "out"))).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    said = spark.read.parquet(str(tmp_path / "out"))
    last = said.groupBy("image").agg(F.max_by(F.struct(*[c for c in said.columns if c not in ("image", "n")]), "presses").alias("r")).select("image", "r.*")
    want = K.replayed(spark.createDataFrame(rows, PRESS))
    show = lambda df: sorted((r.image, r.is_included, r.states, r.doublon, r.remarque, r.should_be_name, r.cote, r.presses) for r in df.collect())
    assert show(last) == show(want) and said.select("n").distinct().count() > 1
