"""HTML extraction: page structure marks lines, nearest-URL page differencing deletes shared ones."""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, hot_join, ranked, read, sieve, spread, table

#: A tag with quoted values, and one that ends at the first > (after a quote that nothing closes).
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
#: Elements whose content is no text, elements outside an article, elements that end a block, and those without content.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "svg", "object", "canvas", "menu", "head"} | RAW
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
MARKED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|side-?bar|menu|nav\w*|breadcrumbs?|header|footer|masthead|comments?|respond|discussion|notices?|alert|cookies?|consent|banner|newsletter|subscri\w*|related|recommended|share|sharing|social|login|popup|modal|widget)(?:$|[\s_-])", re.I)
#: Names that stand for such a part by themselves, on a page with no other page of its host beside it.
PLAIN_NAMES = frozenset("ad ads advert advertisement advertising sponsored promo sidebar nav navbar navigation menu breadcrumb breadcrumbs comments cookie cookies newsletter popup social-share share-buttons".split())
NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPACE = re.compile(r"\s+")
ENDS_P = BLOCKS - {"html", "body", "head"}


def lines_of(page: str) -> list[tuple[str, str]]:
    """(kind, text) of each block in page order; kind is main (in article or main), open (no sign) or aside, by tags or names."""
    return [("aside" if mark else kind, text) for kind, text, mark, _ in blocks_of(page)]


def blocks_of(page: str) -> list[tuple[str, str, str, bool]]:
    """(kind, text, mark, heading) of each block in page order.

    kind is main (in article or main), open (no sign) or aside (in an element that is no text by
    its tag). mark has the tag and names of the outermost block element around it whose class, id
    or role could mean a menu, an advert and the like ("" if none); heading tells blocks in h1 to h6.
    """
    out: list[tuple[str, str, str, bool]] = []
    stack: list[tuple[str, bool, bool, str, bool]] = []  # name, aside, main, mark, heading
    buffer: list[str] = []
    late: list[tuple[str, bool, bool, str, bool]] = []

    def flush() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            _, aside, main, mark, heading = stack[-1] if stack else ("", False, False, "", False)
            out.append(("aside" if aside else "main" if main else "open", text, mark, heading))

    def pop() -> None:
        inside[stack.pop()[0]] -= 1

    at, n, tag, closed = 0, len(page), TAG, {}
    inside: Counter = Counter()  # open elements by name
    while at < n:
        start = page.find("<", at)
        if start < 0:
            buffer.append(page[at:])
            break
        buffer.append(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            end = page.find(">", start)
            at = n if end < 0 else end + 1
            continue
        if not page[start + 1 : start + 2].isalpha() and not (page.startswith("</", start) and page[start + 2 : start + 3].isalpha()):
            buffer.append("<")
            at = start + 1
            continue
        m = tag.match(page, start)
        if m is None:  # a quote is never closed: from here on quotes mean nothing, so that no part is scanned twice
            tag = PLAIN
            m = tag.match(page, start)
        if m is None:
            if page.find(">", start) < 0:
                buffer.append(page[start:])
                break
            buffer.append("<")
            at = start + 1
            continue
        at = m.end()
        name = m[2].lower()
        if name == "br":
            buffer.append(" ")
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if m[1]:
            if inside[name]:
                ends = False
                while True:
                    ends = ends or stack[-1][0] in BLOCKS or stack[-1][1]
                    if stack[-1][0] == name:
                        break
                    late.append(stack[-1])
                    pop()
                if ends:
                    stack.extend(reversed(late))
                    flush()
                    del stack[len(stack) - len(late) :]
                late.clear()
                pop()
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW:
            if name not in closed or closed[name] >= 0:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                closed[name] = end.end() if end else -1
            if name != "title" or closed[name] >= 0:
                at = closed[name] if closed[name] >= 0 else n
            continue
        if name in BLOCKS:
            flush()
            if name in ENDS_P:
                while inside["p"] and (stack[-1][0] not in BLOCKS or stack[-1][0] == "p"):
                    pop()
        above = stack[-1] if stack else ("", False, False, "", False)
        named = " ".join(a or b or c for a, b, c in NAMES.findall(m[3])) if m[3] and name in BLOCKS and not above[3] else ""
        marked = bool(named and name not in ("html", "body", "main") and MARKED.search(named)) and not (name == "article" and "comment" not in named.lower())
        aside = above[1] or name in ASIDE
        if aside and not above[1]:
            flush()
        if not m[3].endswith("/") or name in BLOCKS:
            mark = above[3] or (f"{name} {named}" if marked else "")
            stack.append((name, aside, above[2] or (name in ("article", "main") and not aside and not marked), mark, above[4] or name in HEADINGS))
            inside[name] += 1
    flush()
    return out


def profile(mine: list[int], theirs: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of mine with each start of theirs, bit-parallel over theirs."""
    at: dict[int, int] = defaultdict(int)
    for j, v in enumerate(theirs):
        at[v] |= 1 << j
    m = len(theirs)
    full = rest = (1 << m) - 1
    for v in mine:
        both = rest & at.get(v, 0)
        rest = ((rest + both) | (rest - both)) & full
    bits = np.frombuffer(rest.to_bytes(m // 8 + 1, "little"), np.uint8)
    return np.append(0, np.cumsum(np.unpackbits(bits, bitorder="little")[:m] == 0))


def aligned(x: list[int], y: list[int]) -> list[int]:
    """Positions of x in a longest common subsequence with y, in space that grows with the lengths alone (by halving x)."""
    if not x or not y:
        return []
    if len(x) == 1:
        return [0] if x[0] in y else []
    half = len(x) // 2
    split = profile(x[:half], y) + profile(x[half:][::-1], y[::-1])[::-1]
    cut = int(split.argmax())
    return aligned(x[:half], y[:cut]) + [half + i for i in aligned(x[half:], y[cut:])]


def shared(mine: list[int], theirs: list[int]) -> set[int]:
    """Positions of mine in a longest common subsequence with theirs; equal ends are matched first."""
    a, b = 0, min(len(mine), len(theirs))
    while a < b and mine[a] == theirs[a]:
        a += 1
    z = 0
    while z < b - a and mine[-1 - z] == theirs[-1 - z]:
        z += 1
    found = {*range(a), *range(len(mine) - z, len(mine))}
    x, y = mine[a : len(mine) - z], theirs[a : len(theirs) - z]
    both = set(x) & set(y)
    keep = [i for i, v in enumerate(x) if v in both]
    x, y = [x[i] for i in keep], [v for v in y if v in both]
    return found | {a + keep[i] for i in aligned(x, y)}


def differenced(hashes: list[int], path: str, after: dict | None, before: dict | None) -> tuple[list[int], list[int]]:
    """Positions of the lines that the nearest page shares, and of those that the pages on both sides share.

    Of the pages next in path order, that with the longer common start of the path is nearest.
    """
    beside = [x for x in (after, before) if x]
    if not beside:
        return [], []
    gone = [shared(hashes, x["hashes"]) for x in beside]
    near = max(range(len(beside)), key=lambda i: len(commonprefix([path, beside[i]["path"]])))
    return sorted(gone[near]), sorted(gone[0] & gone[1]) if len(gone) > 1 else []


def mark_key(mark: str) -> int:
    return xxhash.xxh3_64_intdigest(mark) - (1 << 63)


def text_of(page: str, near: list[int], both: list[int], confirmed: list[int] | None) -> str:
    """The blocks of the article: those that markup names less what both neighbours share, or else those in no other part less what the nearest shares.

    A name only proposes a part. Its blocks go where the host's other pages confirm it (its key is
    among confirmed) or, on a page without others (None), where it can't mean anything else; never
    a heading, and never all there is.
    """
    got = blocks_of(page)

    def leaves(i: int) -> bool:
        _, _, mark, heading = got[i]
        if not mark or heading:
            return False
        return mark_key(mark) in confirmed if confirmed is not None else not PLAIN_NAMES.isdisjoint(mark.lower().split()[1:])

    main = [i for i, b in enumerate(got) if b[0] == "main"]
    some, gone = (main, set(both)) if main else ([i for i, b in enumerate(got) if b[0] == "open"], set(near))
    mine = [i for i in some if not leaves(i)] or some
    return "\n".join([got[i][1] for i in [i for i in mine if i not in gone] or mine])


def with_confirmed_marks(gone: DataFrame, paths: DataFrame) -> DataFrame:
    """gone with _confirmed: of a page's marks, those that another path and at least half of its host's paths have."""
    held = paths.select("_host", F.explode(F.array_distinct("_marks")).alias("_mark")).groupBy("_host", "_mark").agg(F.count("*").alias("times"))
    sizes = paths.groupBy("_host").agg(F.count("*").alias("paths"))
    sure = held.join(sizes, "_host").filter("times >= 2 and 2 * times >= paths").select(F.xxhash64("_host", "_mark").alias("_mark_key"), "times")
    sure = table(sure.groupBy("_mark_key").agg(F.max("times").alias("times")), "marks")
    each = gone.select("_key", "_host", F.explode(F.array_distinct("_marks")).alias("_mark")).withColumn("_mark_key", F.xxhash64("_host", "_mark")).drop("_host")
    kept = hot_join(each, sure, ["_mark_key"], "times", sure.agg(F.sum("times")).first()[0] or 0)
    return gone.drop("_marks").join(kept.groupBy("_key").agg(F.collect_list("_mark").alias("_confirmed")), "_key", "left")


def with_repeated_lines(gone: DataFrame, paths: DataFrame) -> DataFrame:
    """(_key, _near, _both): of the lines that both neighbours share, those that at least half of the host's paths (three or more) have."""
    line = F.xxhash64("_host", "_line").alias("_line_key")
    each = gone.select("_key", "_host", F.posexplode("_lines").alias("_i", "_line"), "_both").select("_key", "_host", line, F.get("_both", F.col("_i")).alias("_at"))
    asked = table(each.select("_line_key").distinct(), "asked")
    held = paths.select("_host", F.explode(F.array_distinct("_hashes")).alias("_line")).select("_host", line)
    times = sieve(held, "_line_key", asked, "line-bits").groupBy("_line_key", "_host").agg(F.count("*").alias("times"))
    sizes = paths.groupBy("_host").agg(F.count("*").alias("paths"))
    often = table(times.join(sizes, "_host").filter("times >= 3 and 2 * times >= paths").groupBy("_line_key").agg(F.max("times").alias("times")), "boilerplate")
    kept = hot_join(each.drop("_host"), often, ["_line_key"], "times", often.agg(F.sum("times")).first()[0] or 0)
    kept = kept.groupBy("_key").agg(F.sort_array(F.collect_list("_at")).alias("_both"))
    out = table(with_confirmed_marks(gone.drop("_both", "_lines"), paths).drop("_host").join(kept, "_key", "left"), "gone")
    drop(gone, asked, often)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: id, url, text, n_chars.

    Each page is paired with the pages of the next paths of its host, after and before it in path
    order; the lines of their texts (blocks, menus and all) are aligned by longest common
    subsequence, and shared lines go. Markup is the second signal. Where it names the article
    (article or main), its blocks less those in menus, forms and the like by their tags are the
    text; names of block elements (class, id, role) that could mean an advert, a notice or comments
    count where at least half of the host's paths have them at such an element. Of these the lines go that both neighbours share and at least half of the host's paths
    have: copies of an article are few, what a site repeats is on most of its pages. Elsewhere the blocks not marked as such are the text,
    less the lines that the nearest page shares (the one with the longer common start of the path).
    A page with nothing left is a copy and stays whole.

    Null or empty html gives an empty text; a null url stands alone. Rows that repeat repeat;
    pages of one path count as the one of the least id; extra columns aren't read; an empty table
    gives an empty result. Hashes of lines are shuffled, and the html only of pages that lose lines.
    """
    address = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"
    key = F.xxhash64("_id", "_url", "_html").alias("_key")

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                got = [blocks_of(page) for page in part.column(3).to_pylist()]
                hashes = [[xxhash.xxh3_64_intdigest(b[1]) - (1 << 63) for b in page] for page in got]
                kinds = ["main" if any(b[0] == "main" for b in page) else "open" for page in got]  # what text_of() takes from
                marks = [sorted({mark_key(b[2]) for b in page if b[2] and b[0] == kind}) for page, kind in zip(got, kinds, strict=True)]
                yield pa.record_batch([*(part.column(i) for i in range(3)), *(pa.array(x, pa.list_(pa.int64())) for x in (hashes, marks))], names=["_key", "_id", "_url", "_hashes", "_marks"])

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(*differenced(*row), row[0]) for row in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            kind = pa.list_(pa.int32())
            lines = pa.array([[hashes[i] for i in both] for _, both, hashes in got], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([g[0] for g in got], kind), pa.array([g[1] for g in got], kind), lines, batch.column(6)], names=["_key", "_host", "_near", "_both", "_lines", "_marks"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [text_of(page or "", near or [], both or [], (sure or []) if beside else None) for page, near, both, sure, beside in zip(*(part.column(i).to_pylist() for i in range(2, 7)), strict=True)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["_id", "_url", "_text"])

    rows = spread(pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))).select(key, "_id", "_url", "_html")
    placed = table(rows.filter("_url is not null and _html is not null").mapInArrow(outline, "_key long, _id long, _url string, _hashes array<long>, _marks array<long>"), "outlines")
    placed = placed.select("_key", "_id", F.lower(F.regexp_extract("_url", address, 1)).alias("_host"), F.regexp_extract("_url", address, 2).alias("_path"), "_hashes", "_marks")
    first = placed.groupBy("_host", "_path").agg(F.min(F.struct("_id", "_hashes", "_marks")).alias("m"))
    paths = ranked(first.select("_host", "_path", "m._hashes", "m._marks"), ["_host", "_path"], "paths")
    beside = lambda step: paths.select("_host", (F.col("_rank") - step).alias("_rank"), F.struct(F.col("_path").alias("path"), F.col("_hashes").alias("hashes")).alias("_after" if step > 0 else "_before"))
    trio = paths.select("_host", "_path", "_rank").join(beside(1), ["_host", "_rank"], "left").join(beside(-1), ["_host", "_rank"], "left").filter("_after is not null or _before is not null")
    own = placed.join(trio.drop("_rank"), ["_host", "_path"]).select("_key", "_host", "_hashes", "_path", "_after", "_before", "_marks")
    gone = own.mapInArrow(difference, "_key long, _host string, _near array<int>, _both array<int>, _lines array<long>, _marks array<long>").filter("size(_near) > 0 or size(_marks) > 0")
    gone = with_repeated_lines(table(gone.dropDuplicates(["_key"]), "shared"), paths)
    none = F.lit(None).cast("array<int>")
    out = ["_id", "_url", "_html", "_near", "_both", "_confirmed", "_beside"]
    rest = sieve(rows, "_key", gone, "gone-bits", keep=False).withColumns({"_near": none, "_both": none, "_confirmed": none.cast("array<long>"), "_beside": F.lit(False)}).select(*out)
    cut = sieve(rows, "_key", gone, "gone-bits").join(gone.withColumn("_beside", F.lit(True)), "_key", "left").select(*out)
    done = rest.unionAll(cut).mapInArrow(write, "_id long, _url string, _text string")
    return done.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
