"""Patterns look at a place's character first; on odd letters they match what they matched without that."""

import pytest
from pyspark.sql import functions as F

from quireon.functions import rules as R
from quireon.functions import spans as S
from quireon.operators import extract as M

ODD = ["", "x", "SION le 3 MAI 1805", "ſion le ٣ mai 1805", "Kanton 12 bRumaire l'an 9", "le 3\x00mai 1805", "faİt a Sion le 12 Vendemıaire an 9", "É d'Etat\nArrête\nLOI sur", "\nLoi\nconseiller FÉDÉRAL 1805 Le prefet\nsigne Jean", "pour l'année 1805, pour l'annee 1806", "Imprimerie de hignou aine chez vincent imprimeur", "de mai 18055 mai 1805a 7bre 1801", "1er Juillet 1805 ßäſKİı"]
PATTERNS = [*[(p, False) for _, p in M.DATE_LEVELS], *[(p, False) for _, p in M.PRINTER_LEVELS + M.CATEGORY_LEVELS + M.PLACE_LEVELS], *[(p, True) for p in M.signature_patterns(R.SIGNATORIES)], ("^" + S.group(R.NO_TITLE), False), (S.group(R.CONNECTORS) + "$", False)]


def test_guards_change_no_match(spark):
    t = spark.createDataFrame([(x,) for x in ODD], "t string")
    plain = lambda p, part: "(?iU)" + (p if part else rf"\b{p}\b")
    all_of = lambda c, p: F.regexp_extract_all(c, F.lit(p), F.lit(0))
    space = F.replace("t", F.lit("\x00"), F.lit(" "))
    rows = t.select("t", *[F.struct(all_of(F.col("t"), S.whole(p, q)).alias("got"), all_of(F.col("t"), plain(p, q)).alias("want"), S.folded(F.col("t")).rlike(S.of_folded(S.whole(p, q))).alias("folded"), space.rlike(plain(p, q)).alias("occurs")).alias(f"p{i}") for i, (p, q) in enumerate(PATTERNS)]).collect()
    for r in rows:
        for x in r[1:]:
            assert x.got == x.want and x.folded == x.occurs
    assert sum(bool(x.got) for r in rows for x in r[1:]) > 20


@pytest.mark.parametrize("pattern", [M.FULL_DATE, M.PLACE_FULL, M.MONTH_YEAR])
def test_places_are_told_apart_by_a_character(pattern):
    assert S.whole(pattern).startswith("(?iU)(?-i:(?=[^") and S.heads(pattern) and " " not in S.heads(pattern)
