"""One file per row: retries, aborts, names that are there, batch and stream."""

import glob
import os
import pickle
import zipfile

import pytest
from pyspark.sql import functions as F

from quireon.plans import queries as Q, replay  # noqa: F401  registers its queries
from quireon.sources import named
from quireon.sources.named import Moves, NamedFiles, Reader, Writer
from quireon.sources.scratch import shared_folder


@pytest.fixture
def registered(spark):
    spark.dataSource.register(NamedFiles)
    return spark


def put(df, folder, **options):
    df.write.format("named_files").options(**options).mode("append").save(str(folder))


def test_written_once_and_read_back(registered, tmp_path):
    folder = tmp_path / "out"
    put(registered.createDataFrame([("a", "one"), ("b", None), ("é", "ligne\nß")], "name string, text string").repartition(3), folder, suffix=".txt")
    put(registered.createDataFrame([("a", 0, "two"), ("c", 0, "three"), ("c", 0, "three")], "name string, other int, text string"), folder, suffix=".txt")
    want = {"a.txt": "one", "b.txt": "", "é.txt": "ligne\nß", "c.txt": "three"}
    assert {f: (folder / f).read_text() for f in os.listdir(folder)} == want
    assert {tuple(r) for r in registered.read.format("named_files").load(str(folder)).collect()} == set(want.items())
    put(registered.createDataFrame([], "name string, text string"), folder)
    assert sorted(os.listdir(folder)) == sorted(want)


def test_a_failing_job_leaves_nothing(registered, tmp_path):
    """A name that can't stand stops its task after good rows; the job aborts, and no file, half or whole, is there."""
    folder = tmp_path / "out"
    for bad in ("x/y", "_x", ".x", "", None):
        rows = registered.createDataFrame([("good", "1"), (bad, "2")], "name string, text string").coalesce(1)
        with pytest.raises(Exception, match="can't name a file"):
            put(rows, folder)
        assert not folder.exists() or os.listdir(folder) == []


def test_a_task_retried_half_way(tmp_path):
    """The first attempt dies in the middle; only the second one's files are moved, each whole."""
    w = Writer({"path": str(tmp_path)}, ["name", "text"])

    def dies():
        yield {"name": "a", "text": "x" * 100}
        raise OSError("executor lost")

    with pytest.raises(OSError):
        w.write(dies())
    assert [f for f in os.listdir(tmp_path) if not f.startswith("_")] == []
    w.commit([w.write(iter([{"name": "a", "text": "y"}, {"name": "b", "text": "z"}])), None])
    assert sorted(os.listdir(tmp_path)) == ["a", "b"] and (tmp_path / "a").read_text() == "y"
    other = Moves({"path": str(tmp_path)}, ["name", "text"])
    other.settle([other.write(iter([{"name": "a", "text": "later"}]))])
    assert (tmp_path / "a").read_text() == "y"
    with pytest.raises(ValueError, match="no columns"):
        Moves({"path": "x", "namecolumn": "n"}, ["name", "text"])


def test_stream_writes_new_names(registered, tmp_path):
    (tmp_path / "in").mkdir()
    for run, rows in enumerate((["a\t1", "b\t2"], ["a\t3", "c\t4"])):
        (tmp_path / "in" / f"{run}.tsv").write_text("\n".join(rows))
        stream = registered.readStream.schema("name string, text string").option("sep", "\t").csv(str(tmp_path / "in"))
        stream.writeStream.format("named_files").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert {f: (tmp_path / "out" / f).read_text() for f in os.listdir(tmp_path / "out")} == {"a": "1", "b": "2", "c": "4"}


def test_the_driver_holds_no_names(tmp_path, monkeypatch):
    """What tasks tell the driver, and what it tells readers, is as small for many files as for few; lists of names are settled one by one."""
    w = Writer({"path": str(tmp_path)}, ["name", "text"])
    rows = [{"name": f"n{i % 9000}", "text": f"text {i}"} for i in range(9500)]  # later ones of equal names go
    told = [w.write(iter(rows[:6000])), w.write(iter(rows[6000:]))]
    assert max(len(pickle.dumps(m)) for m in told) < 500
    w.commit(told)
    shares = Reader({"path": str(tmp_path)}).partitions()
    assert len(shares) == 3 and len(pickle.dumps(shares)) < 500
    got = [row for share in shares for row in Reader({"path": str(tmp_path)}).read(share)]
    assert len(got) == 9000 and dict(got) == {f"n{i}": f"text {i}" for i in range(9000)} and len(os.listdir(tmp_path)) == 9000
    monkeypatch.setattr(named, "TASK_FILES", 10)
    assert len(Reader({"path": str(tmp_path)}).partitions()) == named.READERS


def test_packs_hold_files_by_the_same_rules(registered, tmp_path, monkeypatch):
    """Of equal names the first stays, in order or not, over packs that are full; few files are on the disk, and any tool opens them."""
    folder, rows = tmp_path / "out", [(f"né{i}", f"text {i}") for i in range(3000)]
    first = registered.createDataFrame(rows[:2000:2], "name string, text string")
    put(named.by_shares(first, F.concat("name", F.lit(".txt"))), folder, suffix=".txt", packed="true")
    put(registered.createDataFrame([("né4", "later"), ("empty", None)], "name string, text string"), folder, suffix=".txt", packed="true")
    put(named.by_shares(registered.createDataFrame([(n, t + " again" if i % 2 == 0 and i < 2000 else t) for i, (n, t) in enumerate(rows)], "name string, text string"), F.concat("name", F.lit(".txt"))), folder, suffix=".txt", packed="true")
    got = registered.read.format("named_files").option("packed", "true").load(str(folder)).collect()
    assert len(got) == 3001 and {r.name: r.text for r in got} == {f"{n}.txt": t for n, t in rows} | {"empty.txt": ""}
    made = os.listdir(folder)
    assert len(made) <= 2 * named.SHARES + 1 and all(zipfile.ZipFile(folder / f).testzip() is None for f in made)
    with pytest.raises(Exception, match="can't name a file"):
        put(registered.createDataFrame([("good", "1"), ("x/y", "2")], "name string, text string").coalesce(1), folder, packed="true")
    assert sorted(os.listdir(folder)) == sorted(made)
    monkeypatch.setattr(named, "PACK_FILES", 2)
    w = named.PackWriter({"path": str(tmp_path / "small")}, ["name", "text"])
    told = [w.write({"name": f"n{i}", "text": str(i)} for i in range(k, 3000)) for k in (0, 1)]
    w.commit([*told, None])
    read = named.PackReader({"path": str(tmp_path / "small")})
    assert sorted(row for share in read.partitions() for row in read.read(share)) == sorted((f"n{i}", str(i)) for i in range(3000))


def test_small_files_take_their_bytes(spark):
    """q_named_files holds some hundred bytes of disk a file, not a block."""
    rows = Q.QUERIES["q_named_files"](spark, "/root/testdata/sf0.01")
    folder = next(f for f in sorted(glob.glob(f"{shared_folder(spark)}/quireon-archive/named-*"), key=os.path.getmtime, reverse=True))
    found = [os.stat(f"{folder}/{f}") for f in os.listdir(folder)]
    assert len(found) <= 2 * named.SHARES and sum(f.st_blocks * 512 for f in found) < 400 * rows.count()
