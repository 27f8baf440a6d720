"""Regular-expression matches with their places, cascades of patterns, and choice of a winner."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


#: An alternative that begins with a letter which isn't repeated.
_LETTER_FIRST = re.compile(r"[A-Za-z](?![?*+{])")


def group(alternatives: list[str], capture: bool = False) -> str:
    """One of the alternatives, the first that fits.

    Many that all begin with a letter are dealt by it, in their order, so that a place of the text
    is tried against one letter each before any of them; those of different letters never compete.
    For patterns that ignore case.
    """
    if len(alternatives) > 8 and all(_LETTER_FIRST.match(a) and "|" not in re.sub(r"\(.*?\)", "", a) for a in alternatives):
        by: dict[str, list[str]] = {}
        for a in alternatives:
            by.setdefault(a[0].lower(), []).append(a[1:])
        alternatives = [letter + (rest[0] if len(rest) == 1 else "(?:" + "|".join(rest) + ")") for letter, rest in by.items()]
    return ("(" if capture else "(?:") + "|".join(alternatives) + ")"


def literal(alternative: str) -> str:
    """The letters that every match of an alternative begins with, in lower case."""
    return re.match(r"(?:[\w' -](?![?*+{]))*", alternative)[0].lower()


def mentions(text: Column, alternatives: list[str]) -> Column:
    """Whether one of the alternatives may occur, in any case: plain searches, which take far less than a pattern's.

    Letters that patterns take for others (long s, Kelvin, dotted and dotless i, NUL for a space)
    count as those.
    """
    parts = sorted({literal(a) for a in alternatives})
    if "" in parts:
        return text.isNotNull()
    parts = [p for p in parts if not any(o != p and o in p for o in parts)]
    return let(folded(text), lambda t: reduce(lambda x, p: x | F.contains(t, F.lit(p)), parts[1:], F.contains(t, F.lit(parts[0]))))


def heads(pattern: str) -> set[str] | None:
    """ASCII characters that a match can begin with, in both cases; None where that isn't told by plain letters. Others may begin one too."""

    def first(items) -> tuple[set[str], bool]:
        """(characters, whether nothing may be consumed)"""
        out: set[str] = set()
        for op, of in items:
            name = str(op)
            if name == "LITERAL":
                got, empty = {chr(of)}, False
            elif name == "IN":
                got, empty = set().union(*[ranged(o, x) for o, x in of]), False
            elif name == "SUBPATTERN":
                got, empty = first(of[3])
            elif name == "BRANCH":
                each = [first(b) for b in of[1]]
                got, empty = set().union(*[g for g, _ in each]), any(e for _, e in each)
            elif name == "AT" and str(of) == "AT_BOUNDARY":
                continue
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                got, empty = first(of[2])
                empty = empty or of[0] == 0
            else:
                raise ValueError(name)
            out |= got
            if not empty:
                return out, False
        return out, True

    def ranged(op, of) -> set[str]:
        name = str(op)
        if name == "LITERAL":
            return {chr(of)}
        if name == "RANGE":
            return {chr(c) for c in range(of[0], of[1] + 1)}
        if name == "CATEGORY" and str(of) == "CATEGORY_DIGIT":
            return set("0123456789")
        raise ValueError(name)

    try:
        got, empty = first(re._parser.parse(pattern))
    except ValueError:
        return None
    if empty:
        return None
    return {x for c in got for x in (c, c.lower(), c.upper())}


def starting(pattern: str) -> str:
    """A pattern whose matches begin a word and may end within one."""
    return whole(rf"\b{pattern}", True)


def whole(pattern: str, part_of_word: bool = False) -> str:
    """Ignore case; word boundaries stand at the outer ends of the text of the pattern.

    Most places of a text are told apart by one look at their character, before boundaries and
    alternatives that ignore case are tried there, which takes far longer.
    """
    first = ""
    if pattern.startswith("^"):
        first = "^"
    elif pattern.startswith("(?:^|\n)"):
        first = "(?:^|(?=\n))"
    elif known := heads(pattern):
        first = "(?-i:(?=[^" + "".join(rf"\x{i:02x}" for i in range(128) if chr(i) not in known) + "]))"
    return "(?iU)" + first + (pattern if part_of_word else rf"\b{pattern}\b")


def folded(text: Column) -> Column:
    """Lower case, where letters that patterns take for others (long s, Kelvin, dotted and dotless i, NUL for a space) are those; as long as the text."""
    other = reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), zip("\u0130\u0131\u017f\u212a", "iisk", strict=True), text)
    return F.lower(F.replace(F.when(F.octet_length(text) == F.length(text), text).otherwise(other), F.lit("\x00"), F.lit(" ")))


def of_folded(pattern: str) -> str:
    """A pattern of whole(), for folded texts: it occurs there exactly where the other one does in the text (with NUL for a space)."""
    return "(?U)" + pattern.removeprefix("(?iU)").lower()



def let(value: Column, f) -> Column:
    """f(value) with value computed once per row and written once in the plan, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def find(text: Column, pattern: str) -> Column:
    """All matches: array of struct(start, end, text); NUL counts as a space.

    One pass with a pattern that is compiled once puts a NUL at both ends of each match; what
    stands between NULs is then gap and match by turns. (Splitting at the pattern itself would
    compile it anew for every row.)
    """
    pieces = F.split(F.regexp_replace(F.replace(text, F.lit("\x00"), F.lit(" ")), F.lit(pattern), F.lit("\x00$0\x00")), "\x00", -1)
    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("is_match"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        end = s["at"] + F.length(x)
        match = F.struct(s["at"].alias("start"), end.alias("end"), x.alias("text"))
        return F.struct(end.alias("at"), (~s["is_match"]).alias("is_match"), F.when(s["is_match"], F.concat(s["out"], F.array(match))).otherwise(s["out"]).alias("out"))

    return F.when(text.isNotNull(), F.aggregate(pieces, zero, step)["out"])


def cascade(text: Column, levels: list[tuple[str, str]], needs: list[str] | None = None, words: list[list[str]] | None = None) -> Column:
    """struct(code, matches) of the first level whose pattern occurs; only that level's matches are computed.

    needs has for each level a part of its pattern, or "", without which it can't occur; each
    such part is looked for once, before any level. words has for each level alternatives of
    which one must begin a word, or none at all; they are looked for where a part that the level
    needs occurs. Whether a pattern occurs is told from the text in lower case, which takes less
    time; matches come from the text itself.
    """
    parts = [p for p in dict.fromkeys(needs or []) if p]
    lists = [w for i, w in enumerate(words or []) if w and w not in words[:i]]

    def chosen(s: Column) -> Column:
        level = F.lit(len(levels))
        for i, (_, pattern) in reversed(list(enumerate(levels))):
            occurs = s["folded"].rlike(of_folded(pattern))
            if words and words[i]:
                occurs = s[f"w{lists.index(words[i])}"] & occurs
            level = F.when(s[f"p{parts.index(needs[i])}"] & occurs if needs and needs[i] else occurs, F.lit(i)).otherwise(level)
        return F.struct(s["text"].alias("text"), level.alias("level"))

    def mentioned(s: Column) -> Column:
        asked = [{needs[i] if needs else "" for i, w in enumerate(words) if w == got} for got in lists]
        known = [F.lit(False) if "" not in of else F.lit(True) for of in asked]
        for k, of in enumerate(asked):
            for p in sorted(of - {""}):
                known[k] = known[k] | s[f"p{parts.index(p)}"]
        return F.struct(s["text"].alias("text"), s["folded"].alias("folded"), *[s[f"p{k}"].alias(f"p{k}") for k in range(len(parts))], *[(known[k] & s["folded"].rlike(of_folded(starting(group(got))))).alias(f"w{k}") for k, got in enumerate(lists)])

    def matched(s: Column) -> Column:
        code, matches = F.lit("no_match"), F.lit(None)
        for i, (name, pattern) in reversed(list(enumerate(levels))):
            code = F.when(s["level"] == i, F.lit(name)).otherwise(code)
            matches = F.when(s["level"] == i, find(s["text"], pattern)).otherwise(matches)
        return F.struct(code.alias("code"), matches.alias("matches"))

    both = let(text, lambda t: F.struct(t.alias("text"), folded(t).alias("folded")))
    known = let(both, lambda s: F.struct(s["text"].alias("text"), s["folded"].alias("folded"), *[s["folded"].rlike(of_folded(p)).alias(f"p{k}") for k, p in enumerate(parts)])) if parts else both
    return let(let(let(known, mentioned) if lists else known, chosen), matched)


def first(matches: Column) -> Column:
    return F.get(matches, F.lit(0))


def last(matches: Column) -> Column:
    return F.get(matches, F.size(matches) - 1)


def extreme(matches: Column, length: Column) -> Column:
    """The match nearest to the start or the end of the text, the first one on ties."""
    ranked = F.transform(matches, lambda m, i: F.struct(F.least(m["start"], length - m["end"]).alias("d"), i.alias("i"), m.alias("m")))
    return F.array_min(ranked)["m"]


def unique(text: Column, pattern: str, part_of_word: bool = False) -> Column:
    """The match where there is exactly one, else null."""
    p = whole(pattern, part_of_word)
    return F.when(F.regexp_count(text, F.lit(p)) == 1, F.regexp_substr(text, F.lit(p)))


def gaps(matches: Column) -> Column:
    """Distances between the end of each match and the start of the next."""
    return F.transform(F.slice(matches, F.lit(2), F.greatest(F.size(matches) - 1, F.lit(0))), lambda m, i: m["start"] - F.get(matches, i)["end"])
