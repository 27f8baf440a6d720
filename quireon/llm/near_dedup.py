"""MinHash near-dedup: bottom-k sketches of one hash function, inverted lists, union-sketch filter, exact Jaccard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, hot_join, let_go, own_memos, read, sieve, spread, table
from .components import components

#: Values that a sketch retains, and how many of the union sketch's must be shared to be verified.
#: A pair at the threshold 0.8 shares fewer than 5 of 16 with a chance of 3e-6.
K, SHARED = 16, 5
#: Longest inverted list that is gathered whole; longer ones are compared block by block.
LIST = 48
#: Classes and shingles of a block of a long list, in the mean; two blocks meet in a task.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)
_SIGN = np.uint64(1 << 63)
#: Words that a worker keeps the keys of, and the bytes of the longest of them: 60 MB at most; freed when a task ends.
MEMO, MEMO_BYTES = 200_000, 64
_memo: dict[bytes, int] = {}


def word_keys(text: str) -> np.ndarray:
    """64-bit keys of the words of a text, lower-cased A-Z; bytes.split() cuts at the six ASCII white spaces."""
    found = text.encode().lower().split()
    if len(_memo) > MEMO:
        _memo.clear()
    long = {}
    for w in set(found).difference(_memo):
        (_memo if len(w) <= MEMO_BYTES else long)[w] = xxhash.xxh3_64_intdigest(w)
    return np.array([_memo[w] if w in _memo else long[w] for w in found] if long else [_memo[w] for w in found], np.uint64)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct keys of the shingles of a text; the whole sequence where it has fewer words, none without words."""
    w = word_keys(text)
    n = min(size, len(w))
    if not n:
        return w
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ w[i : len(w) - n + 1 + i]) * _P
        h ^= h >> np.uint64(29)
    h *= _Q
    return np.unique(h ^ (h >> np.uint64(32)))


def alike(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(_id, n, same, sketch): number of shingles, 128-bit key of the set, its K least values (their sign bit turned, so that they sort)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("near_dedup")
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    part = batch.slice(start, 1024)
                    sets = [shingles(t or "", size) for t in part.column(1).to_pylist()]
                    least = [(s[:K] ^ _SIGN).view(np.int64) for s in sets]
                    sketches = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, least)]), pa.int32()), pa.array(np.concatenate(least)))
                    yield pa.record_batch([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets]), sketches], names=["_id", "n", "same", "sketch"])
        finally:
            _memo.clear()
            let_go("near_dedup")

    return docs.mapInArrow(run, "_id long, n long, same binary, sketch array<long>")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("near_dedup")
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    yield pa.record_batch([part.column(0), pa.array([shingles(t or "", size).tobytes() for t in part.column(1).to_pylist()], pa.binary())], names=["_id", "bag"])
        finally:
            _memo.clear()
            let_go("near_dedup")

    return docs.mapInArrow(run, "_id long, bag binary")


def passes(n: int, m: int, shared: int, union: int, ratio: int) -> bool:
    """Whether sets of n and m shingles may be linked, by their sizes and by the shared ones of the union sketch's values."""
    return 100 * min(n, m) >= ratio * max(n, m) and (shared >= SHARED or union < K and 100 * shared >= 60 * union)


def fits(ratio: int) -> Column:
    """passes() for columns n, sketch and m, other."""
    union = F.slice(F.array_sort(F.array_union("sketch", "other")), 1, F.greatest(F.size("sketch"), F.size("other")))
    shared, k = F.size(F.array_intersect(F.array_intersect("sketch", "other"), union)), F.size(union)
    return (100 * F.least("n", "m") >= ratio * F.greatest("n", "m")) & ((shared >= SHARED) | ((k < K) & (100 * shared >= 60 * k)))


def list_pairs(ratio: int):
    """Candidate pairs of inverted lists, of members in different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("near_dedup")
        yield from map(pairs_of, batches)
        let_go("near_dedup")

    def pairs_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = [], []
        for members in batch.column(0).to_pylist():
            members.sort(key=lambda m: m["id"])
            sketches = [np.array(m["sketch"], np.int64) for m in members]
            for i, x in enumerate(members):
                for j in range(i + 1, len(members)):
                    y = members[j]
                    if x["component"] == y["component"] or 100 * min(x["n"], y["n"]) < ratio * max(x["n"], y["n"]):
                        continue
                    union = np.union1d(sketches[i], sketches[j])[: max(len(sketches[i]), len(sketches[j]))]
                    shared = len(np.intersect1d(np.intersect1d(sketches[i], sketches[j], assume_unique=True), union, assume_unique=True))
                    if passes(x["n"], y["n"], shared, len(union), ratio):
                        a.append(x["id"])
                        b.append(y["id"])
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def postings(nodes: DataFrame) -> DataFrame:
    """(id, values, weight) of the classes with values that others retain too: those values with the lengths of their lists, rarest first."""
    posted = nodes.select("id", F.explode("sketch").alias("v"))
    df = table(posted.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1"), "df")
    met = hot_join(sieve(posted, "v", df, "df-bits"), df, ["v"], "df", df.agg(F.sum("df")).first()[0] or 0)
    out = table(met.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("values"), F.sum(F.log("df")).alias("weight")), "postings")
    drop(df)
    return out


def leader_pairs(posts: DataFrame, nodes: DataFrame, ratio: int) -> DataFrame:
    """(a, b): each class with the leaders of its lists, a random one and that with the most frequent values, as the original of many copies has.

    A member makes two rows a list at most, however long the list; the random leader is one of
    the whole table's order, so that like classes meet the same one in all their lists.
    """
    wide = posts.select("id", "weight", F.explode("values.v").alias("v"))
    leaders = table(wide.groupBy("v").agg(F.count("*").alias("df"), F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("l0"), F.max(F.struct("weight", "id"))["id"].alias("l1")), "leaders")
    met = hot_join(wide.select("id", "v"), leaders, ["v"], "df", leaders.agg(F.sum("df")).first()[0] or 0)
    star = met.select("id", F.explode(F.array("l0", "l1")).alias("l")).filter("id <> l").select(F.least("id", "l").alias("a"), F.greatest("id", "l").alias("b")).distinct()
    left = nodes.select(F.col("id").alias("a"), "n", "sketch")
    right = nodes.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    out = table(star.join(left, "a").join(right, "b").filter(fits(ratio)).select("a", "b"), "leader-pairs")
    drop(leaders)
    return out


def rest_pairs(posts: DataFrame, nodes: DataFrame, labels: DataFrame, ratio: int) -> tuple[DataFrame, DataFrame]:
    """(a, b), pairs of different components that share a value of a short list and pass the union sketch;
    and (id, n, values), the classes that enter long lists. Lists within one component drop out.

    A pair that passes the union sketch shares some number of values: SHARED, or 60% of a smaller
    set. If none of them has a short list, all have long ones, and of the long lists of either
    class, rarest first, all but that number less one hold a common one. So a class enters only
    these (values); most that hold a common passage enter none.
    """
    known = posts.join(labels, "id", "left").join(nodes, "id").select("id", "n", "sketch", "values", F.coalesce("component", "id").alias("component"))
    known = table(known, "known")
    wide = known.select("id", "component", F.explode("values").alias("p")).select("id", "component", "p.v")
    open_ = table(wide.groupBy("v").agg(F.count("*").alias("df"), F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1").select("v", "df"), "open-lists")
    short = known.select("id", "n", "sketch", "component", F.explode(F.filter("values", lambda p: p["df"] <= LIST)).alias("p")).select("p.v", F.struct("id", "n", "sketch", "component").alias("m"))
    near = short.join(open_.filter(F.col("df") <= LIST).select("v"), "v").groupBy("v").agg(F.collect_list("m").alias("ms")).select("ms").mapInArrow(list_pairs(ratio), "a long, b long")
    near = table(near.distinct(), "short-pairs")
    needed = F.least(F.lit(SHARED), F.expr("int((60 * size(sketch) + 99) div 100)"))
    long = F.expr(f"filter(values, p -> p.df > {LIST})")
    hot = known.select("id", "n", F.slice(long, 1, F.greatest(F.size(long) - needed + 1, F.lit(0)))["v"].alias("values")).filter(F.size("values") > 0)
    hot = table(hot, "hot")
    drop(known, open_)
    return near, hot


def block_links(bags: list[np.ndarray], values: list[list[int]], component: list[int], left: np.ndarray, right: np.ndarray, v: int, ratio: int) -> list[tuple[int, int]]:
    """Places (in left, in right) of linked classes that were in different components; likest sketches first.

    Links within a component that the links before them made are left out. A pair is tried only
    in the first list that both of its classes enter.
    """
    n = np.array([len(b) for b in bags])
    m = np.minimum(n, K)
    _, code, times = np.unique(np.concatenate([b[:K] for b in bags]), return_inverse=True, return_counts=True)
    owner, repeats = np.repeat(np.arange(len(bags)), m), times[code] > 1
    column, owner = (np.cumsum(times > 1) - 1)[code[repeats]], owner[repeats]
    shared = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int((times > 1).sum()), 2048):
        here = (column >= start) & (column < start + 2048)
        has = np.zeros((len(bags), 2048), np.float32)
        has[owner[here], column[here] - start] = 1
        shared += has[left] @ has[right].T
    needed, c = np.minimum(SHARED, -(-60 * m // 100)), np.array(component)
    x, y = left[:, None], right[None, :]
    ok = (shared >= np.maximum(needed[x], needed[y])) & (100 * np.minimum(n[x], n[y]) >= ratio * np.maximum(n[x], n[y])) & (c[x] != c[y])
    if len(left) == len(right) and (left == right).all():
        ok &= x < y
    i, j = np.nonzero(ok)
    order = np.argsort(-shared[i, j], kind="stable")
    root: dict[int, int] = {}

    def find(k: int) -> int:
        while k in root:
            if root[k] in root:
                root[k] = root[root[k]]
            k = root[k]
        return k

    sets, out = [set(w) for w in values], []
    for p, q in zip(left[i[order]].tolist(), right[j[order]].tolist(), strict=True):
        rp, rq = find(component[p]), find(component[q])
        if rp == rq or next(w for w in values[p] if w in sets[q]) != v:
            continue
        both, union = alike(bags[p], bags[q])
        if 100 * both >= ratio * union:
            root[rp] = rq
            out.append((p, q))
    return out


def long_links(hot: DataFrame, labels: DataFrame, docs: DataFrame, size: int, ratio: int) -> DataFrame:
    """Links (a, b) between components, from all pairs of the long lists.

    Of a list, the members outside its largest component are dealt into blocks, as are those
    inside; every two blocks of the outside meet, and every one of them with every one of the
    inside. Full sets are compared where they meet, so pairs aren't shuffled.
    """
    known = hot.select("id", "n", "values").join(labels, "id", "left").select("id", "n", "values", F.coalesce("component", "id").alias("component"))
    known = table(known, "long")
    posts = known.select(F.explode("values").alias("v"), "id", "n", "component")
    parts = posts.groupBy("v", "component").agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    lists = parts.groupBy("v").agg(F.sum("k").alias("df"), F.sum("s").alias("s"), F.max(F.struct("k", "s", "component")).alias("top")).filter("df > top.k")
    blocks = lambda k, s: F.greatest(F.ceil(k / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    lists = table(lists.select("v", "df", F.col("top.component").alias("top"), blocks(F.col("df") - F.col("top.k"), F.col("s") - F.col("top.s")).alias("outer"), blocks(F.col("top.k"), F.col("top.s")).alias("inner")), "long-lists")
    met = hot_join(posts, lists, ["v"], "df", lists.agg(F.sum("df")).first()[0] or 0)
    inside, dealt = F.col("component") == F.col("top"), lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    met = met.withColumn("block", F.when(inside, F.col("outer") + dealt("inner")).otherwise(dealt("outer")))
    upto = F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner"))
    cells = met.select("id", "v", "block", F.explode(F.sequence(F.lit(0), upto - 1)).alias("other"))
    places = cells.groupBy("id").agg(F.collect_list(F.struct("v", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))).alias("cells"))
    places = table(places.join(known.drop("n"), "id"), "places")
    bags = sets_of(sieve(docs, "_id", places.select(F.col("id").alias("_id")), "long-bits").join(places.select(F.col("id").alias("_id")), "_id", "left_semi").dropDuplicates(["_id"]), size)
    rows = places.join(bags.withColumnRenamed("_id", "id"), "id").select("id", "component", "values", "bag", F.explode("cells").alias("c"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        own_memos("near_dedup")
        v, i, j = (k.as_py() for k in key)
        block, ids = t.column("block").to_numpy(), t.column("id").to_pylist()
        bags = [np.frombuffer(b.as_buffer(), np.uint64) for b in t.column("bag")]  # in place
        got = block_links(bags, t.column("values").to_pylist(), t.column("component").to_pylist(), np.flatnonzero(block == i), np.flatnonzero(block == j), v, ratio)
        del bags
        let_go("near_dedup")
        return pa.table({"a": pa.array([ids[p] for p, _ in got], pa.int64()), "b": pa.array([ids[q] for _, q in got], pa.int64())})

    out = table(rows.select("c.v", "c.i", "c.j", "c.block", "id", "component", "values", "bag").groupBy("v", "i", "j").applyInArrow(run, "a long, b long"), "long-links")
    drop(known, lists, places)
    return out


def verified(pairs: DataFrame, docs: DataFrame, size: int, ratio: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= ratio * union."""
    ends = table(pairs.select(F.col("a").alias("_id")).unionAll(pairs.select(F.col("b").alias("_id"))).distinct(), "ends")
    bags = table(sets_of(sieve(docs, "_id", ends, "end-bits").join(ends, "_id", "left_semi").dropDuplicates(["_id"]), size), "bags")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memos("near_dedup")
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                both, union = alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                keep.append(100 * both >= ratio * union)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        batch = x = y = None  # noqa: F841  nothing holds the last bags
        let_go("near_dedup")

    met = pairs.select("a", "b").join(bags.select(F.col("_id").alias("a"), F.col("bag").alias("x")), "a").join(bags.select(F.col("_id").alias("b"), F.col("bag").alias("y")), "b")
    out = table(met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "verified")
    drop(ends, bags)
    return out


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, ratio: int = 80) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept.

    Words are runs of anything but the six ASCII white spaces, lower-cased A-Z; a document's set
    is its distinct shingles of `size` words (the whole sequence, if it has fewer words). Documents
    are linked where 100 * intersection >= ratio * union, confirmed on full sets; component_id is
    the least id reachable. Null or wordless text has an empty set and stands alone. A null id has
    no component and isn't kept. Rows that repeat an id are one document (of its texts the one with
    the least set key is compared). Extra columns aren't read. An empty table gives an empty result.

    Equal sets are one class from the start. Each class meets the leaders of its lists first, and
    what these link is contracted; after that only pairs of different components are made, of
    short lists and then of all blocks of the long ones.
    """
    base = spread(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")))
    seen = table(sketched(base, size), "sketches")
    full = seen.filter("n > 0 and _id is not null")
    classes = table(full.groupBy("same").agg(F.min(F.struct("_id", "n", "sketch")).alias("m"), F.count("*").alias("copies")), "classes")
    nodes = classes.select(F.col("m._id").alias("id"), "m.n", "m.sketch")
    posts = postings(nodes)
    pairs = leader_pairs(posts, nodes, ratio)
    links = verified(pairs, base, size, ratio)
    drop(pairs)
    labels = components(links)
    drop(links)
    pairs, hot = rest_pairs(posts, nodes, labels, ratio)
    drop(posts)
    more = verified(pairs, base, size, ratio)
    drop(pairs)
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
    merged = lambda found: found.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b")
    joined = components(merged(more))
    labels = relabelled(labels, joined)
    if hot.limit(1).count():
        far = long_links(hot, labels, base, size, ratio)
        if far.limit(1).count():
            labels = relabelled(labels, components(merged(far)))
        drop(far)
    drop(hot, more)
    total = classes.agg(F.sum("copies")).first()[0] or 0
    rooted = classes.select("same", "copies", F.col("m._id").alias("id")).join(labels, "id", "left").select("same", "copies", F.coalesce("component", "id").alias("component_id"))
    met = hot_join(full.select("_id", "n", "same"), rooted, ["same"], "copies", total).select("_id", "n", "component_id")
    alone = seen.filter("n = 0 or _id is null").select("_id", "n", F.col("_id").alias("component_id"))
    out = met.unionAll(alone)
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def relabelled(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """Labels after links between their components; joined has the components of these."""
    root = joined.select(F.col("id").alias("component"), F.col("component").alias("root"))
    old = labels.join(root, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
    out = table(old.unionByName(joined.join(labels, "id", "left_anti").select("id", "component")), "labels")
    drop(labels, joined)
    return out


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"), size=4)
