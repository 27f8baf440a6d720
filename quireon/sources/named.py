"""One named file per row: a data source that writes what isn't there yet, whole or not at all, and reads it back.

    spark.dataSource.register(NamedFiles)
    df.write.format("named_files").option("suffix", ".json").mode("append").save(folder)
    spark.read.format("named_files").load(folder)

The folder is a path or an address that pyarrow.fs knows; on a cluster all machines must reach it.

A file takes a block of the disk at least, so millions of small ones take many times their bytes.
With option("packed", "true"), for both writing and reading, files are members of zip archives
instead, under the same rules: packs come whole or not at all, and of equal names the first stays.
Names are dealt over SHARES; rows that come in order of them (`by_shares`) make few packs.
"""

from __future__ import annotations

import io
import json
import os
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

#: Bytes and files that a reading task takes on in the mean, and reading tasks at most: each lists the folder for its share of names.
TASK_BYTES, TASK_FILES, READERS = 64 << 20, 4096, 64
#: Files that the driver moves at once, and names in a list of those to be moved.
AT_ONCE, LISTED = 16, 4096
#: Shares of names that packs are made of; files and bytes in a pack; bytes of packs for a reading task.
SHARES, PACK_FILES, PACK_BYTES, READ_BYTES = 256, 1 << 15, 32 << 20, 1 << 20


def place(folder: str) -> tuple[fs.FileSystem, str]:
    where, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    return where, path.rstrip("/")


def hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def listed(where: fs.FileSystem, root: str) -> Iterator[tuple[str, str]]:
    """(name, path) of the files of a folder that aren't pending or hidden, one by one; file systems other than a machine's own hand over a whole list."""
    if isinstance(where, fs.LocalFileSystem):
        with os.scandir(root) as found:
            yield from ((f.name, f.path) for f in found if not hidden(f.name) and f.is_file())
    else:
        yield from ((f.base_name, f.path) for f in where.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File and not hidden(f.base_name))


def by_shares(df: DataFrame, name: Column) -> DataFrame:
    """df with each share of file names (suffix and all) in one partition, in order of shares."""
    share = F.crc32(name.cast("binary")) % SHARES
    return df.repartition(share).sortWithinPartitions(share)


def packs(where: fs.FileSystem, root: str, share: int | None = None) -> list[str]:
    """Paths of a folder's packs, or those of a share, in the order in which they were committed."""
    return sorted(path for name, path in listed(where, root) if name.startswith("pack-" if share is None else f"pack-{share:03d}-"))


def opened(where: fs.FileSystem, path: str) -> zipfile.ZipFile:
    with where.open_input_stream(path) as f:
        return zipfile.ZipFile(io.BytesIO(f.read()))


@dataclass
class Written(WriterCommitMessage):
    """What one task has put into its folder: files by number, and lists of their names, so that a message doesn't grow with them."""

    folder: str
    lists: int


class Moves:
    """Both writers: tasks write into a pending folder of the job, and the driver moves whole files when all have ended, some thousands known to it at a time."""

    def __init__(self, options: dict, names: list[str]):
        self.folder, self.suffix, self.job = options["path"], options.get("suffix", ""), uuid.uuid4().hex
        self.name, self.text = options.get("namecolumn", names[0]), options.get("textcolumn", names[-1])
        if not {self.name, self.text} <= set(names):
            raise ValueError(f"no columns {self.name}, {self.text} in {names}")

    @property
    def pending(self) -> str:
        return f"_pending-{self.job}"

    def named(self, r: Row) -> str:
        name = r[self.name]
        if name is None or not name or "/" in name or "\0" in name or hidden(name):
            raise ValueError(f"{name!r} can't name a file")
        return name

    def write(self, rows: Iterator[Row]) -> Written:
        """Files of one task. A second attempt has a folder of its own, so halves of the first are never moved."""
        where, root = place(self.folder)
        mine, names, lists = f"{root}/{self.pending}/{uuid.uuid4().hex}", [], 0
        where.create_dir(mine)

        def told() -> None:
            with where.open_output_stream(f"{mine}/names-{lists}") as f:
                f.write(json.dumps(names).encode())

        for r in rows:
            name = self.named(r)
            if where.get_file_info(f"{root}/{name}{self.suffix}").type == fs.FileType.NotFound:
                with where.open_output_stream(f"{mine}/{lists}-{len(names)}") as f:
                    f.write((r[self.text] or "").encode())
                names.append(f"{name}{self.suffix}")
            if len(names) == LISTED:
                told()
                names, lists = [], lists + 1
        if names:
            told()
            lists += 1
        return Written(mine, lists)

    def settle(self, messages: list[Written | None]) -> None:
        """Move what isn't there by now (the first of equal names stays), list by list; then the pending folders go."""
        where, root = place(self.folder)
        local = isinstance(where, fs.LocalFileSystem)

        def move(item: tuple[str, str]) -> None:
            name, path = item
            if local:
                if not os.path.lexists(name):
                    os.rename(path, name)
            elif where.get_file_info(name).type == fs.FileType.NotFound:
                where.move(path, name)

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for m in messages:
                for k in range(m.lists if m else 0):
                    with where.open_input_stream(f"{m.folder}/names-{k}") as f:
                        names = json.loads(f.read())
                    wanted: dict[str, str] = {}
                    for i, name in enumerate(names):
                        wanted.setdefault(f"{root}/{name}", f"{m.folder}/{k}-{i}")
                    list((map if local else pool.map)(move, wanted.items()))  # a rename takes less time than handing it to a thread
        self.clear(messages)

    def clear(self, messages: list[Written | None]) -> None:
        """Pending folders of this job, and of the messages (a stream's writers are made anew for each step)."""
        where, root = place(self.folder)
        for path in {f"{root}/{self.pending}", *(m.folder.rpartition("/")[0] for m in messages if m)}:
            if where.get_file_info(path).type != fs.FileType.NotFound:
                where.delete_dir(path)


class Writer(Moves, DataSourceWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self.settle(messages)

    def abort(self, messages: list[Written | None]) -> None:
        self.clear(messages)


class StreamWriter(Moves, DataSourceStreamWriter):
    """Each micro-batch by itself; one that comes again finds its files there."""

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        self.settle(messages)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        self.clear(messages)


class Packs(Moves):
    """Tasks write archives, share by share, of what no pack of the share has; the driver numbers and moves whole archives."""

    def write(self, rows: Iterator[Row]) -> Written:
        where, root = place(self.folder)
        mine, share, made, pack, there = f"{root}/{self.pending}/{uuid.uuid4().hex}", -1, 0, None, set()
        where.create_dir(mine)

        def close() -> None:
            if pack:
                pack.close()
                with where.open_output_stream(f"{mine}/{share:03d}-{made:06d}.zip") as f:
                    f.write(held.getbuffer())

        for r in rows:
            name = f"{self.named(r)}{self.suffix}"
            of = zlib.crc32(name.encode()) % SHARES
            if of != share or (pack and (len(pack.filelist) >= PACK_FILES or held.tell() >= PACK_BYTES)):
                close()
                made, pack = made + bool(pack), None
            if of != share:
                share, there = of, set()
                for path in packs(where, root, share):
                    with opened(where, path) as old:
                        there.update(old.namelist())
            if name not in there:
                if not pack:
                    held = io.BytesIO()
                    pack = zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED)
                pack.writestr(zipfile.ZipInfo(name), r[self.text] or "", zipfile.ZIP_DEFLATED)
                there.add(name)
        close()
        return Written(mine, made + bool(pack))

    def settle(self, messages: list[Written | None]) -> None:
        """Packs of a commit come after all that are there; readers take the first of equal names."""
        where, root = place(self.folder)
        number = 1 + max((int(path.rpartition("/")[2].split("-")[2]) for path in packs(where, root)), default=0)
        for k, m in enumerate(messages):
            for f in where.get_file_info(fs.FileSelector(m.folder)) if m and m.lists else []:
                share, _, at = f.base_name.partition("-")
                where.move(f.path, f"{root}/pack-{share}-{number:08d}-{self.job}-{k:06d}-{at}")
        self.clear(messages)


class PackWriter(Packs, Writer):
    pass


class PackStreamWriter(Packs, StreamWriter):
    pass


@dataclass
class Files(InputPartition):
    """The files whose names' remainder by `of` is `at`."""

    at: int
    of: int


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def partitions(self) -> list[Files]:
        """Shares of names, some 64 MB a task; the driver holds no names, and looks at no more files than it takes to tell how many tasks there are."""
        where, root = place(self.folder)
        n = READERS
        if isinstance(where, fs.LocalFileSystem):
            files = size = 0
            for _, path in listed(where, root):
                files, size = files + 1, size + os.path.getsize(path)
                if files >= READERS * TASK_FILES or size >= READERS * TASK_BYTES:
                    break
            n = min(READERS, max(1, -(-files // TASK_FILES), -(-size // TASK_BYTES)))
        return [Files(k, n) for k in range(n)]

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        """Pending and hidden files aren't there."""
        where, root = place(self.folder)
        for name, path in listed(where, root):
            if zlib.crc32(name.encode()) % partition.of == partition.at:
                with where.open_input_stream(path) as f:
                    yield name, f.read().decode()


class PackReader(Reader):
    def partitions(self) -> list[Files]:
        """Shares of names, by the size of the packs."""
        where, root = place(self.folder)
        size = sum(f.size for f in where.get_file_info(packs(where, root)))
        n = min(READERS, 1 + size // READ_BYTES)
        return [Files(k, n) for k in range(n)]

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        where, root = place(self.folder)
        paths = packs(where, root)
        for share in range(partition.at, SHARES, partition.of):
            seen: set[str] = set()
            for path in (p for p in paths if p.rpartition("/")[2].startswith(f"pack-{share:03d}-")):
                with opened(where, path) as pack:
                    for f in pack.infolist():
                        if f.filename not in seen:
                            seen.add(f.filename)
                            yield f.filename, pack.read(f).decode()


class NamedFiles(DataSource):
    """Options: path, suffix (of file names), nameColumn and textColumn (else the first and the last), packed (files are members of archives)."""

    @property
    def packed(self) -> bool:
        return self.options.get("packed", "false").lower() == "true"

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, text string"

    def reader(self, schema: StructType) -> Reader:
        return (PackReader if self.packed else Reader)(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("named files are only added to; use mode append")
        return (PackWriter if self.packed else Writer)(self.options, schema.names)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:  # noqa: N802
        return (PackStreamWriter if self.packed else StreamWriter)(self.options, schema.names)
