"""Metadata extraction from intermediate texts: prioritised cascades, winners, normal forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import spans as S
from ..functions.text import capitalised, one_line


def lookup(value: Column, pairs: dict) -> Column:
    """pairs[value], else the value itself."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), value), value)


def found(text: Column, pattern: str, part: int = 0) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, part), F.lit(""))


# Dates
MONTH_NUMBERS = {m: i for ms in (R.MONTHS, R.REPUBLICAN_MONTHS) for i, m in enumerate(ms, 1)} | R.MONTH_VARIANTS | R.SHORT_MONTHS
MONTH = S.group([*R.MONTHS, *R.REPUBLICAN_MONTHS, *R.MONTH_VARIANTS, *R.SHORT_MONTHS])
REPUBLICAN = S.group(R.REPUBLICAN_MONTHS)
GREGORIAN = S.group([*R.MONTHS, *R.MONTH_VARIANTS, *R.SHORT_MONTHS])
MONTH_YEAR = S.group([REPUBLICAN + r"(?: l'an| de l'an)? \d+", GREGORIAN + r"(?: l'an| de l'an)? \d\d\d\d"])
FULL_DATE = r"\d\d?'*(?:er|me|e|deg)? (?:jour du mois de |jour du mois d'|de |d')?" + MONTH_YEAR
PLACE = S.group([*R.PLACES, *R.PLACE_SPELLINGS])
BEFORE = S.group(R.BEFORE_DATE)
PLACE_FULL = PLACE + " " + BEFORE + "?" + FULL_DATE
PLACE_PARTIAL = PLACE + " (?:en )?" + MONTH_YEAR
LONG_FORMULA = S.group(R.ANNOUNCE) + " en " + S.group(R.CHAMBERS) + " a " + PLACE + " " + BEFORE
SHORT_FORMULA = S.group(R.ANNOUNCE) + " a " + PLACE + " " + BEFORE
DATE_LEVELS = [
    ("formule_grande+date_complete", LONG_FORMULA + FULL_DATE), ("formule_grande+date_partielle", LONG_FORMULA + MONTH_YEAR),
    ("formule_petite+date_complete", SHORT_FORMULA + FULL_DATE), ("formule_petite+date_partielle", SHORT_FORMULA + MONTH_YEAR),
    ("a_lieu+date_complete", "a " + PLACE_FULL), ("lieu+date_complete", PLACE_FULL), ("a_lieu+date_partielle", "a " + PLACE_PARTIAL), ("lieu+date_partielle", PLACE_PARTIAL),
    ("le+date_complete", BEFORE + FULL_DATE), ("le+date partielle", BEFORE + MONTH_YEAR), ("date_complete", FULL_DATE),
    ("pour_annee+annee", r"pour l'annee \d\d\d\d|pour l'exercice(?: de)? \d\d\d\d"), ("date_partielle_unique", MONTH_YEAR),
]


#: What each level can't be without, in one line with it: a full date, a month and year, or neither.
DATE_NEEDS = [S.starting(part) if (part := FULL_DATE if p.endswith(FULL_DATE) else MONTH_YEAR if p.endswith(MONTH_YEAR) else "") else "" for _, p in DATE_LEVELS]

#: Places of which each level that names one must mention one, and what begins the level of years.
DATE_WORDS = [[*R.PLACES, *R.PLACE_SPELLINGS] if PLACE in p else ["pour l'"] if c == "pour_annee+annee" else [] for c, p in DATE_LEVELS]


def dates(text: Column) -> tuple[Column, Column]:
    """(code, matches) of the date cascade; a partial date alone counts only if all its matches read alike."""
    def decide(c: Column) -> Column:
        alike = (c["code"] != "date_partielle_unique") | (F.size(F.array_distinct(F.transform(c["matches"], lambda m: m["text"]))) == 1)
        return F.struct(F.when(alike, c["code"]).otherwise("no_match").alias("code"), F.when(alike, c["matches"]).alias("matches"))

    got = S.let(S.cascade(one_line(text), [(c, S.whole(p)) for c, p in DATE_LEVELS], DATE_NEEDS, DATE_WORDS), decide)
    return got["code"], got["matches"]


def republican_to_gregorian(year: Column, month: Column, day: Column) -> Column:
    """Day of the Republican calendar as a date; years 3, 7 and 11 are leap years, later ones every fourth from 15."""
    leaps = F.when(year <= 14, F.floor(year / 4)).otherwise(3 + F.floor((year - 12) / 4))
    return F.date_add(F.lit("1792-09-22").cast("date"), (365 * (year - 1) + leaps + 30 * (month - 1) + (day - 1)).cast("int"))


def date_parts(date_text: Column) -> Column:
    """struct(day, month, year) of a text that holds a date; day and month may be null."""
    numbers = F.create_map(*[F.lit(x) for p in MONTH_NUMBERS.items() for x in p])

    def parts(d: Column) -> Column:
        best = F.coalesce(d["full"], d["partial"], d["t"])
        name = F.when(d["full"].isNotNull() | d["partial"].isNotNull(), found(best, rf"\b({MONTH})\b", 1))
        old = F.coalesce(name.isin(R.REPUBLICAN_MONTHS), F.lit(False))
        year = F.when(old, found(best, r"\b(\d+)$", 1)).otherwise(found(best, r"\b(\d\d\d\d)$", 1)).cast("int")
        return F.struct(F.when(d["full"].isNotNull(), found(best, r"^(\d\d?)", 1).cast("int")).alias("day"), F.element_at(numbers, name).alias("month"), year.alias("year"), old.alias("old"))

    def modern(p: Column) -> Column:
        other = republican_to_gregorian(p["year"], p["month"], F.coalesce(p["day"], F.lit(15)))
        of = lambda f, x: F.when(p["old"], f(other)).otherwise(x)
        return F.struct(F.when(p["day"].isNotNull(), of(F.dayofmonth, p["day"])).alias("day"), of(F.month, p["month"]).alias("month"), of(F.year, p["year"]).alias("year"))

    read = S.let(F.lower(date_text), lambda t: F.struct(t.alias("t"), found(t, S.whole(FULL_DATE)).alias("full"), found(t, S.whole(MONTH_YEAR)).alias("partial")))
    return S.let(S.let(read, parts), modern)


def filename_date(name: Column) -> Column:
    """struct(day, month, year) from dddd-dd-dd, dddd-dd or dddd between shelf mark and page of a file name."""
    middle = F.regexp_extract(name, r"^.*?\d+[a-z]*(.*).{8}$", 1)
    full, partial, year = (found(middle, p) for p in (r"\d\d\d\d-\d\d-\d\d", r"\d\d\d\d-\d\d", r"\d\d\d\d"))
    best = F.coalesce(full, partial, year)
    return F.struct(F.substring(full, 9, 2).cast("int").alias("day"), F.substring(F.coalesce(full, partial), 6, 2).cast("int").alias("month"), F.left(best, F.lit(4)).cast("int").alias("year"), F.when(best.isNotNull(), "filename_date").otherwise("no_match").alias("code"))


# Places
def place_in_date(date_text: Column) -> Column:
    near = F.coalesce(found(date_text, S.whole(f"({PLACE}) {BEFORE}?{FULL_DATE}"), 1), found(date_text, S.whole(f"({PLACE}) (?:en )?{MONTH_YEAR}"), 1), found(date_text, S.whole(f"^({PLACE})"), 1))
    return S.let(F.lower(near), lambda x: lookup(x, R.PLACE_SPELLINGS))


PLACE_LEVELS = [("Fait_a+lieu_seul", rf"fait (?:en {S.group(R.CHAMBERS)} )?a ({PLACE})"), ("lieu_impression", rf"({PLACE}) imprimerie|a ({PLACE}) chez")]


def place_in_text(text: Column) -> tuple[Column, Column]:
    """(code, place) where a text names the place of signing or of printing."""
    printed = S.whole(PLACE_LEVELS[1][1])

    def printing(made: Column) -> Column:
        """Printing is looked for where nothing is signed, and its place in what was found."""
        at = S.let(F.when(made.isNull() & S.mentions(text, ["imprimerie", "chez"]), F.regexp_substr(text, F.lit(printed))), lambda x: F.coalesce(found(x, printed, 1), found(x, printed, 2)))
        return F.struct(made.alias("made"), at.alias("printed"))

    def decide(p: Column) -> Column:
        code = F.when(p["made"].isNotNull(), PLACE_LEVELS[0][0]).when(p["printed"].isNotNull(), PLACE_LEVELS[1][0]).otherwise("no_match")
        return F.struct(code.alias("code"), S.let(F.lower(F.coalesce(p["made"], p["printed"])), lambda x: lookup(x, R.PLACE_SPELLINGS)).alias("place"))

    got = S.let(S.let(found(text, S.whole(PLACE_LEVELS[0][1]), 1), printing), decide)
    return got["code"], got["place"]


# Titles
NO_TITLE = S.whole("^" + S.group([*R.NO_TITLE, "(?:circulaire )?" + PLACE_FULL]))
ENDS = S.whole(S.group([*R.CONNECTORS, *R.END_CONNECTORS]) + "$")
STARTS = S.whole("^" + S.group(R.CONNECTORS))


def title(text: Column) -> Column:
    """The first block of connected lines that isn't a heading, joined by spaces; null where it starts like a sentence."""
    lines = F.split(text, "\n")
    start = F.struct(F.lit("skip").alias("mode"), F.lit("").alias("taken"), F.lit(None).cast("string").alias("before"))

    def step(s: Column, x: Column) -> Column:
        goes_on = s["before"].isNotNull() & (s["before"].rlike(ENDS) | x.rlike(STARTS))
        head = F.when(x.rlike(NO_TITLE), "skip").otherwise("take")
        mode = F.when(s["mode"] == "done", "done").when(goes_on, s["mode"]).when(s["mode"] == "take", "done").otherwise(head)
        taken = F.when(mode != "take", s["taken"]).when(s["mode"] == "take", F.concat(s["taken"], F.lit(" "), x)).otherwise(x)
        return F.struct(mode.alias("mode"), taken.alias("taken"), x.alias("before"))

    got = F.aggregate(lines, start, step)["taken"]
    return F.when((got != "") & ~got.rlike(S.whole("^" + S.group(R.FALSE_TITLES))), got)


# Printers
_names = sorted([*R.PRINTERS, *(k for k, v in R.PRINTER_SPELLINGS.items() if v in R.PRINTERS)], key=len)
_titles = sorted([*R.PRINTER_TITLES, *(k for k, v in R.PRINTER_SPELLINGS.items() if v in R.PRINTER_TITLES)], key=len)
_heads = [*R.PRINTER_HEADS[:7], "(?:imprime )?(?:a )?" + PLACE + "(?: |\n)chez ", *R.PRINTER_HEADS[7:]]
PRINTER_LEVELS = [
    ("nom_imprimeur", S.group([S.group(_heads) + "(?:de |des |d')?" + S.group(_names), "chez " + S.group(_names) + " (?:imprime(?:ur|rie)|impr(?:im)?)"])),
    ("titre_imprimerie", S.group(_titles)),
]


def printer(text: Column) -> tuple[Column, Column]:
    """(code, printer): the last match of the first level, by its shortest-first unique name."""
    def name(c: Column) -> Column:
        by = lambda x: F.when(c["code"] == "nom_imprimeur", S.unique(x, S.group(_names))).otherwise(S.unique(x, S.group(_titles)))
        return F.struct(c["code"].alias("code"), S.let(F.lower(S.last(c["matches"])["text"]), lambda x: S.let(by(x), lambda n: lookup(n, R.PRINTER_SPELLINGS))).alias("name"))

    (named, by_name), (titled, by_title) = ((c, S.whole(p)) for c, p in PRINTER_LEVELS)
    # Most texts name a printer, at their end: all matches are taken in the pass that looks for the first.
    level = S.let(S.find(text, by_name), lambda n: F.struct(n.alias("n"), ((F.size(n) < 1) & text.rlike(by_title)).alias("t")))
    chosen = S.let(level, lambda x: F.struct(F.when(F.size(x["n"]) > 0, named).when(x["t"], titled).otherwise("no_match").alias("code"), F.when(F.size(x["n"]) > 0, x["n"]).when(x["t"], S.find(text, by_title)).alias("matches")))
    got = S.let(chosen, name)
    return got["code"], got["name"]


# Signatures
def signature_patterns(titles: list[str]) -> tuple[str, str, str]:
    """(with a name on it, function alone, one line); group 1 is the function (2 in the last) and 2 the name (1 in the last)."""
    function = S.group(R.BEFORE_SIGNATURE) + "l(?:e |es |')" + S.group(titles) + "(?: " + S.group(R.SIGNATORY_EXTRAS) + ")?(?:" + S.group(R.TRANSITIONS) + ")?(?: " + S.group(R.OF) + "[^\n]+)?"
    return f"({function})(?: |\n)(?:{S.group(R.SIGNED)} )?([^\n]+)", f"({function})", f"({S.group(R.BEFORE_SIGNATURE)}[^\n]+) ({S.group(titles)})(?:\n|$)"


INSTITUTION = S.group(R.BEFORE_SIGNATURE) + "l(?:e |a |es |')" + S.group(R.INSTITUTIONS) + "(?: " + S.group(R.INSTITUTION_EXTRAS) + ")?(?: " + S.group(R.OF) + "[^\n]+)?"


def _clean(part: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(part, r"^(?:\d\d\d\d |\nPar |\nL S |\n)", "")), F.lit(""))


def signature(text: Column, mode: str = "principal") -> tuple[Column, Column, Column, Column]:
    """(code, matches, function, name) of the last signature; a one-line signature gives its code but no parts."""
    titles = R.SIGNATORIES if mode == "principal" else R.SECRETARIES
    grand, function, small = signature_patterns(titles)
    grand, small = S.whole(grand, True), S.whole(small, True)
    alone = S.whole(S.group([function, INSTITUTION]), True)

    def decide(s: Column) -> Column:
        hope, named = s["hope"], s["named"]
        code = F.when(F.size(named) > 0, F.lit("grande_signature"))
        if mode == "principal":
            code = code.when(hope & text.rlike(alone), "signature_institution")
        code = code.when(hope & text.rlike(small), "petite signature").otherwise("no_match")
        return S.let(code, lambda c: F.struct(c.alias("code"), F.when(c == "grande_signature", named).when(c == "signature_institution", S.find(text, alone)).when(c == "petite signature", S.find(text, small)).alias("matches")))

    def parts(c: Column) -> Column:
        got = S.last(c["matches"])["text"]
        who = F.when(c["code"] == "grande_signature", _clean(F.regexp_extract(got, grand, 2)))
        what = F.when(c["code"] == "grande_signature", _clean(F.regexp_extract(got, grand, 1))).when(c["code"] == "signature_institution", _clean(got))
        return F.struct(c["code"].alias("code"), c["matches"].alias("matches"), what.alias("what"), who.alias("who"))

    named = F.filter(S.find(text, grand), lambda m: ~F.lower(F.regexp_extract(m["text"], grand, 2)).isin(R.NO_NAMES))
    # No signature does without a title or an institution.
    hopeful = S.let(S.mentions(text, [*titles, *(R.INSTITUTIONS if mode == "principal" else [])]), lambda h: F.struct(h.alias("hope"), F.when(h, named).alias("named")))
    got = S.let(S.let(hopeful, decide), parts)
    return got["code"], got["matches"], got["what"], got["who"]


# Categories
CATEGORY_LEVELS = [("name", "(?:^|\n)(?:Projet d(?:e |'))?" + S.group(R.CATEGORIES)), ("verb", "\n" + S.group(list(R.CATEGORY_VERBS)) + "(?:nt)?\n")]


def category(text: Column) -> tuple[Column, Column, Column]:
    """(code, matches, category): the first match of the first level."""
    got = S.cascade(text, [(c, S.whole(p)) for c, p in CATEGORY_LEVELS])
    kind = F.btrim(F.lower(S.first(got["matches"])["text"]), F.lit("\n"))
    return got["code"], got["matches"], S.let(kind, lambda k: lookup(k, R.CATEGORY_FORMS))


# Topics
def topics(text: Column, model_topics: Column | None = None) -> tuple[Column, Column]:
    """(code, up to three topics): settling keywords in text order, then hints, then topics of a model."""
    named = lambda pairs: F.transform(F.regexp_extract_all(text, F.lit(S.whole(S.group(list(pairs)))), F.lit(0)), lambda k: lookup(F.lower(k), pairs))
    settled = F.slice(F.array_distinct(named(R.TOPIC_KEYWORDS)), 1, 3)
    words = F.slice(F.array_distinct(F.concat(settled, named(R.TOPIC_HINTS))), 1, 3)
    more = F.coalesce(model_topics, F.array().cast("array<string>")) if model_topics is not None else F.array().cast("array<string>")
    filled = F.array_union(words, F.slice(more, F.lit(1), F.greatest(3 - F.size(words), F.lit(0))))
    code = F.when(F.size(settled) == 3, "exclusive_keywords_only").when(F.size(words) == 3, "keywords").when(F.size(words) == 0, "lda_only").otherwise("keywords_and_lda")
    return code, filled


# Whole documents
def simple_documents(texts: DataFrame, keys: list[str], text: str = "text", model_topics: str | None = None) -> DataFrame:
    """One row per text with all its metadata; a place is looked for only where a date was found."""
    t = F.col(text)
    date_code, date_matches = dates(t)
    df = texts.withColumn("type_date", date_code).withColumn("_dates", date_matches)
    df = df.withColumn("_date", S.extreme(F.col("_dates"), F.length(t))["text"]).withColumn("_d", date_parts(F.col("_date")))
    place_code, place = place_in_text(t)
    near = place_in_date(F.col("_date"))
    dated = F.col("type_date") != "no_match"
    printer_code, printed = printer(t)
    kind_code, _, kind = category(t)
    topic_code, named = topics(t, F.col(model_topics) if model_topics else None)
    s_code, _, s_what, s_who = signature(t, "principal")
    c_code, _, c_what, c_who = signature(t, "secretary")
    return df.select(
        *keys, F.col("_d.day").alias("jour"), F.col("_d.month").alias("mois"), F.col("_d.year").alias("annee"), "type_date",
        F.when(dated, F.coalesce(near, place)).alias("lieu"), F.when(~dated, "no_match").when(near.isNotNull(), "lieu_avec_date").otherwise(place_code).alias("type_lieu"),
        kind.alias("categorie"), kind_code.alias("type_categorie"), title(t).alias("intitule"), printed.alias("imprimeur"), printer_code.alias("type_imprimeur"),
        s_who.alias("signataire_nom"), s_what.alias("signataire_titre"), s_code.alias("type_signataire"), c_who.alias("secretaire_nom"), c_what.alias("secretaire_titre"), c_code.alias("type_secretaire"),
        F.get(named, F.lit(0)).alias("sujet_1"), F.get(named, F.lit(1)).alias("sujet_2"), F.get(named, F.lit(2)).alias("sujet_3"), topic_code.alias("type_sujet"),
    )


def split_compilation(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Sub-documents of a compilation: keys, sous_document ("1", "2", ...), text.

    Cuts come from whichever of categories, dates and signatures is most frequent; a text with at
    most one of each is one sub-document.
    """
    t = F.col(text)
    df = texts.withColumn("_d", F.coalesce(dates(t)[1], F.array())).withColumn("_p", F.coalesce(signature(t)[1], F.array())).withColumn("_s", F.coalesce(signature(t, "secretary")[1], F.array())).withColumn("_c", F.coalesce(category(t)[1], F.array()))
    d, c, n_sig = F.size("_d"), F.size("_c"), F.size("_p")
    tail = lambda a: F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))
    starts = lambda a: F.transform(tail(a), lambda m: m["start"])
    ends = F.transform(F.slice("_d", F.lit(1), F.greatest(d - 1, F.lit(0))), lambda m: m["end"])
    df = df.withColumn("_all", F.array_sort(F.concat("_p", "_s"))).withColumn("_gaps", S.gaps(F.col("_all")))
    mean = F.aggregate("_gaps", F.lit(0.0), lambda s, x: s + x) / F.size("_gaps")
    wide = F.filter(F.transform("_gaps", lambda g, i: F.when(g >= mean, F.get("_all", i)["end"])), lambda e: e.isNotNull())
    near_start = S.first(F.col("_d"))["start"] < F.length(t) - S.last(F.col("_d"))["end"]
    cuts = F.when((d <= 1) & (n_sig <= 1) & (c <= 1), F.array().cast("array<int>")).when((c > n_sig) & (c > d), starts(F.col("_c"))).when(d > n_sig, F.when(near_start, starts(F.col("_d"))).otherwise(ends)).otherwise(wide)
    df = df.withColumn("_from", F.concat(F.array(F.lit(0)), cuts)).withColumn("_to", F.concat(cuts, F.array(F.length(t))))
    parts = F.zip_with("_from", "_to", lambda a, b: F.substring(t, a + 1, b - a))
    return df.select(*keys, F.posexplode(parts).alias("_n", text)).select(*keys, (F.col("_n") + 1).cast("string").alias("sous_document"), text)


def documents(texts: DataFrame, key: str = "cote", flag: str = "is_compil", text: str = "text") -> DataFrame:
    """Simple documents as they are and compilations by sub-document; rows whose flag is null are left out."""
    simple = simple_documents(texts.filter(~F.col(flag)), [key], text).withColumn("sous_document", F.lit(None).cast("string"))
    parts = split_compilation(texts.filter(F.col(flag)), [key], text)
    return simple.unionByName(simple_documents(parts, [key, "sous_document"], text))


def typed(found_: DataFrame) -> DataFrame:
    """Days, months and years as nullable whole numbers, all else that was found as text; what can't be a number is null."""
    numbers = {c: F.expr(f"try_cast({c} AS int)") for c in ("jour", "mois", "annee") if c in found_.columns}
    return found_.withColumns(numbers | {c: F.col(c).cast("string") for c in found_.columns if c in R.DOCUMENT_LABELS or c.startswith("type_")})


def finished(found_: DataFrame) -> DataFrame:
    """Types, labels of places and categories; a month outside 1..12 goes."""
    labelled = {"lieu": capitalised(F.col("lieu"), R.PLACE_LABELS), "categorie": capitalised(F.col("categorie"), R.CATEGORY_LABELS), "mois": F.when(F.col("mois").between(1, 12), F.col("mois"))}
    return typed(found_).withColumns(labelled)
