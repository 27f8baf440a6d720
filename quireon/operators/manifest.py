"""IIIF manifests: labels, dates, languages, nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.names import image_url, page_label


def shown(value: Column, kind: str = "string") -> Column:
    """A value as a reader sees it: - for null, oui or non, numbers without decimals."""
    if kind == "boolean":
        return F.when(value.isNull(), "-").when(value, "oui").otherwise("non")
    return F.coalesce((value.cast("bigint") if kind in ("double", "float") else value).cast("string"), F.lit("-"))


def french_date(day: Column, month: Column, year: Column) -> Column:
    name = F.get(F.array(*[F.lit(m) for m in R.LABEL_MONTHS]), month - 1)
    return F.coalesce(F.nullif(F.concat_ws(" ", day.cast("string"), name, year.cast("string")), F.lit("")), F.lit("-"))


def languages(states: Column, no_text: bool = False) -> Column:
    labels = R.LANGUAGE_LABELS | ({"b": "sans texte"} if no_text else {})
    return F.coalesce(F.nullif(F.concat_ws(", ", *[F.when(F.array_contains(states, s), label) for s, label in labels.items()]), F.lit("")), F.lit("-"))


def entry(label: str, value: Column) -> Column:
    return F.struct(F.lit(label).alias("label"), value.alias("value"))


def document_entries() -> Column:
    """Date, then the labelled fields of a document."""
    return F.array(entry("Date", french_date(F.col("jour"), F.col("mois"), F.col("annee"))), *[entry(label, shown(F.col(name))) for name, label in R.DOCUMENT_LABELS.items()])


def parts_entries(parts: DataFrame) -> DataFrame:
    """(cote, content): the sub-documents of each compilation, in order of their numbers, with their entries."""
    one = F.struct(F.col("sous_document").cast("int").alias("n"), F.struct(F.concat(F.lit("Sous-document "), F.col("sous_document")).alias("label"), document_entries().alias("metadata")).alias("part"))
    return parts.groupBy("cote").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["part"]).alias("content"))


def canvas(base: str) -> Column:
    """An image on its canvas: size, resource with its service, labelled fields and languages."""
    at = image_url(F.col("name"), f"{base}/iiif/2")
    service = F.struct(F.lit("http://iiif.io/api/image/2/context.json").alias("@context"), at.alias("@id"), F.lit("http://iiif.io/api/image/2/level2.json").alias("profile"))
    resource = F.struct(F.lit("dctypes:Image").alias("@type"), F.concat(at, F.lit("/full/full/0/default."), F.col("file_extension")).alias("@id"), service.alias("service"))
    fields = [entry(label, shown(F.array_contains("states", "m"), "boolean") if name == "manuscrit" else shown(F.col(name))) for name, label in R.IMAGE_LABELS.items()]
    metadata = F.array(*fields, entry("Langue", languages(F.col("states"), True)))
    painting = F.struct(F.lit("oa:Annotation").alias("@type"), F.lit("sc:painting").alias("motivation"), F.concat(at, F.lit("/canvas/1")).alias("on"), resource.alias("resource"), metadata.alias("metadata"))
    return F.struct(F.lit("sc:Canvas").alias("@type"), F.concat(at, F.lit("/canvas/1")).alias("@id"), F.concat(F.lit("Page "), page_label(F.col("name"))).alias("label"), "width", "height", F.array(painting).alias("images"))


#: What a publisher says of all manifests.
PUBLISHED = {"label": "archive", "description": "Imprimés", "license": "CC BY-NC 4.0", "attribution": "Archives"}


def manifests(cotes: DataFrame, images: DataFrame, parts: DataFrame, base: str = "https://example.org", published: dict[str, str] = PUBLISHED) -> DataFrame:
    """(cote, thumbnail, n_canvases, manifest): one JSON text per shelf mark, the image that stands for it and how many it shows.

    cotes: cote, interest, is_compil, n_images, states and document fields. images: cote, name,
    file_extension, width, height, states and the names of original texts. parts: sub-documents of
    compilations with the same fields as documents. The thumbnail is the image of the least name.
    """
    pages = images.groupBy("cote").agg(F.transform(F.array_sort(F.collect_list(F.struct("name", canvas(base).alias("canvas")))), lambda x: x["canvas"]).alias("canvases"), F.min_by(F.struct("name", "width", "height"), "name").alias("_t"))
    head = [entry("Côte", F.col("cote")), entry("Intérêt", shown(F.col("interest"))), entry("Compilation", shown(F.col("is_compil"), "boolean")), entry("Nombre d'images", shown(F.col("n_images"))), entry("Structure vide", shown(F.array_contains("states", "v"), "boolean"))]
    simple = F.to_json(F.concat(F.array(*head), document_entries(), F.array(entry("Langue", languages(F.col("states"))))))
    opened = F.to_json(F.array(*head))
    compiled = F.concat(F.left(opened, F.length(opened) - 1), F.lit(',{"label":"Contenu","value":'), F.coalesce(F.to_json("content"), F.lit("[]")), F.lit("}]"))
    metadata = F.when(F.coalesce("is_compil", F.lit(False)), compiled).otherwise(simple)
    pixels = lambda c: F.concat(F.col(f"_t.{c}").cast("string"), F.lit("px"))
    thumbnail = F.struct(F.concat(F.lit(f"{base}/iiif/2/"), F.col("_t.name"), F.lit("/thumb/canvas/1")).alias("@id"), F.lit("dctypes:images").alias("@type"), pixels("width").alias("width"), pixels("height").alias("height"))
    words = F.struct(F.lit("http://iiif.io/api/search/1/autocomplete").alias("profile"), F.lit("Get suggested words").alias("label"))
    search = F.array(F.struct(F.lit("http://iiif.io/api/search/1/context.json").alias("@context"), F.lit("").alias("@id"), F.lit("http://iiif.io/api/search/1/search").alias("profile"), F.lit("Search within this thing").alias("label"), words.alias("service")))
    sequences = F.array(F.struct(F.lit("sc:Sequence").alias("@type"), F.lit("individuals/paged").alias("viewingHint"), F.lit("left-to-right").alias("viewingDirection"), "canvases"))
    told = {k: F.lit(v).alias(k) for k, v in published.items()}
    start = F.struct(F.lit("http://iiif.io/api/presentation/2/context.json").alias("@context"), F.lit("sc:Manifest").alias("@type"), F.concat(F.lit(f"{base}/manifest/CH-AEV_IV_"), F.col("cote"), F.lit(".json")).alias("@id"), told["label"], told["description"])
    rest = F.struct(thumbnail.alias("thumbnail"), told["license"], search.alias("service"), told["attribution"], sequences.alias("sequences"))
    joined = lambda a, m, b: F.concat(F.left(a, F.length(a) - 1), F.lit(',"metadata":'), m, F.lit(","), F.substr(b, F.lit(2)))
    text = joined(F.to_json(start), metadata, F.to_json(rest))
    return cotes.join(pages, "cote").join(parts_entries(parts), "cote", "left").select("cote", F.col("_t.name").alias("thumbnail"), F.size("canvases").cast("long").alias("n_canvases"), text.alias("manifest"))
