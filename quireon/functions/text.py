"""Text rewriting and cleaning as column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .spans import let

#: ASCII punctuation that a character class built from the whole set takes out: all but the backslash.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"
#: Signs that become another one (fixed values); accented Latin letters (to U+024F and U+1E00 to U+1EFF) become their base, by decomposition.
SIGNS = {"’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ħ": "h", "ı": "i", "ſ": "s", "\u00a0": " "}
_split = {c: unicodedata.normalize("NFD", c) for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)])}
_base = {c: d[0] for c, d in _split.items() if len(d) > 1 and d[0].isascii()} | SIGNS
ACCENTED, PLAIN = "".join(_base), "".join(_base.values())
#: Letters and signs that become several (fixed values).
WIDER = {"ß": "ss", "œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE", "°": "deg", "«": "<<", "»": ">>", "…": "...", "—": "--", "€": "EUR"}


def java(replacement: str) -> str:
    return re.sub(r"\\g<(\d)>|\\(\d)", lambda m: "$" + (m[1] or m[2]), replacement.replace("$", r"\$"))


def char_class(chars: str) -> str:
    return "[" + "".join("\\" + c for c in chars) + "]"


#: What a text can't be without for the first of the letter rules to change it, and the words that have a rule.
LETTERS_MET = r"(?U)[lI]\d|\d[lIoO]|[A-Za-z][10]|0[A-Za-z]|l[A-Z]|[A-Z]{2}l|[a-z]I|\b(?:ler|Ier|1es)\b"
WORDS_MET = r"(?U)\b(?:" + "|".join(rules.WORD_RULES) + r")\b"


def correct(text: Column, letters: bool = True, words: bool = True) -> Column:
    """The correction rules in order, each on whole words, case-sensitive; a text that no rule meets is left after one look at it."""

    def step(t: Column, met: str, pairs: list[tuple[str, str]]) -> Column:
        changed = lambda x: reduce(lambda y, r: F.regexp_replace(y, rf"(?U)\b{r[0]}\b", java(r[1])), pairs, x)
        return let(t, lambda x: F.when(x.rlike(met), changed(x)).otherwise(x))

    text = step(text, LETTERS_MET, rules.LETTER_RULES) if letters else text
    return step(text, WORDS_MET, list(rules.WORD_RULES.items())) if words else text


def changed_positions(before: Column, after: Column) -> Column:
    """Positions where two texts of one length differ; null where lengths differ."""
    at = F.filter(F.transform(F.split(before, ""), lambda c, i: F.when(c != F.substring(after, i + 1, F.lit(1)), i)), lambda i: i.isNotNull())
    return F.when(F.length(before) == F.length(after), at)


def replace_all(text: Column, pairs: dict[str, str]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs.items(), text)


def strip_lines(text: Column) -> Column:
    strip = lambda x: F.rtrim(F.ltrim(x, F.lit(rules.STRIP_LEFT)), F.lit(rules.STRIP_RIGHT))
    return F.array_join(F.transform(F.split(text, "\n"), strip), "\n")


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\n{2,}", "\n\n")


def trim_newlines(text: Column) -> Column:
    return F.btrim(text, F.lit("\n"))


def format_text(text: Column) -> Column:
    """Word corrections, apostrophes and ligatures, line ends, blank lines, outer newlines."""
    return trim_newlines(collapse_newlines(strip_lines(replace_all(correct(text, letters=False), rules.LIGATURES))))


def ascii_letters(text: Column) -> Column:
    return F.translate(replace_all(text, WIDER), ACCENTED, PLAIN)


def intermediate(text: Column) -> Column:
    """The text that extraction reads: no punctuation but - ' and \\, no accents, no blank lines, & as et, split words joined."""
    t = F.regexp_replace(text, char_class("".join(c for c in PUNCTUATION if c not in "-'&")), " ")
    t = F.regexp_replace(t, " +", " ")
    t = ascii_letters(t)
    t = F.regexp_replace(t, " *\n *", "\n")
    t = F.regexp_replace(t, "\n+", "\n")
    t = F.replace(F.replace(t, F.lit("&"), F.lit("et")), F.lit("\f"), F.lit(""))
    return F.regexp_replace(t, r"(?U)(\w)-\n(\w)", "$1$2")


def word_sequence(text: Column) -> Column:
    t = F.regexp_replace(intermediate(text), char_class(PUNCTUATION), " ")
    return F.lower(F.regexp_replace(F.replace(t, F.lit("\n"), F.lit(" ")), " +", " "))


def topic_text(text: Column) -> Column:
    t = F.regexp_replace(text, "\n+", " ")
    return F.replace(F.replace(t, F.lit("&"), F.lit("et")), F.lit("\f"), F.lit(""))


def tokens(text: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-case tokens without punctuation and stop words (no lemmatiser)."""
    t = F.regexp_replace(F.lower(text), char_class(PUNCTUATION), " ")
    found = F.filter(F.split(F.trim(F.regexp_replace(t, r"\s+", " ")), " "), lambda w: w != "")
    return F.filter(found, lambda w: ~w.isin(stop_words)) if stop_words else found


def strip_punctuation(word: Column) -> Column:
    return F.btrim(word, F.lit(".,;:?! "))


def replace_word(extended: Column, chosen: Column) -> Column:
    """The chosen word with the punctuation that stood round the old one."""
    lead, trail = F.regexp_extract(extended, r"^([.,;:?! ]*)", 1), F.regexp_extract(extended, r"([.,;:?! ]*)$", 1)
    return F.concat(lead, chosen, trail)


def capitalised(word: Column, labels: dict[str, str]) -> Column:
    """The label of a word, else its first letter in upper and the rest in lower case."""
    known = F.element_at(F.create_map(*[F.lit(x) for p in labels.items() for x in p]), word)
    return F.coalesce(known, F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substring(word, F.lit(2), F.length(word)))))


def highlights(text: Column) -> Column:
    """Numbers and runs of capitals that a corrector should look at."""
    return F.regexp_extract_all(text, F.lit(r"(\d+|[A-Z][A-Z]+)"), F.lit(1))


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))
