"""Strings of annotation records, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where markings take their colours from, in order.
MARK_COLORS = ("red", "blue", "green", "pink", "yellow", "orange", "purple", "brown")


def first_non_blank(*values: Column) -> Column:
    """The first value that is not blank, trimmed."""
    return F.coalesce(*[F.when(F.trim(v) != "", F.trim(v)) for v in values])


def display_name(phrase: Column, category: Column, object_id: Column) -> Column:
    return F.coalesce(first_non_blank(phrase, category, object_id), F.lit("object"))


def strip_determiner(name: Column) -> Column:
    """A noun phrase without a leading the, a or an."""
    return F.trim(F.regexp_replace(F.trim(name), r"(?i)^(?:the|a|an)\s+", ""))


def noun_phrase(name: Column) -> Column:
    """``the`` and the bare noun phrase; ``the object`` if nothing is left."""
    bare = strip_determiner(F.coalesce(name, F.lit("")))
    return F.when(bare == "", F.lit("the object")).otherwise(F.concat(F.lit("the "), bare))


def name_key(name: Column) -> Column:
    return F.lower(strip_determiner(name))


def fill(template: Column, **values: Column) -> Column:
    """``[K]`` of a template replaced one after the other, in the order given."""
    for key, value in values.items():
        template = F.replace(template, F.lit(f"[{key}]"), value)
    return template


def capitalized(value: Column) -> Column:
    return F.concat(F.upper(F.substring(value, 1, 1)), F.substring(value, 2, 1 << 30))


def brace_format(template: Column, **values: Column) -> Column:
    """``{key}`` replaced, and ``{Key}`` by the value with a capital."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{" + key + "}"), value)
        template = F.replace(template, F.lit("{" + key[:1].upper() + key[1:] + "}"), capitalized(value))
    return template


def join_parts(*parts: Column) -> Column:
    """Non-blank parts with a blank line between them."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (F.trim(x) != "")), "\n\n")


def split_qa(prompt: Column, images: Column | None = None) -> tuple[Column, Column]:
    """(question, answer) around the first ``Answer: ``; both null without it. ``images`` tags go before the question."""
    parts = F.split(prompt, "Answer: ", 2)
    found = F.size(parts) == 2
    question = F.trim(parts[0])
    if images is not None:
        question = F.concat(F.repeat(F.lit("<image>"), images), question)
    return F.when(found, question), F.when(found, F.trim(F.get(parts, 1)))


def length_text(meters: Column) -> tuple[Column, Column]:
    """(value to two decimals, unit): centimetres below one metre."""
    small = meters < 1
    return F.format_string("%.2f", F.bround(F.when(small, meters * 100).otherwise(meters), 2)), F.when(small, F.lit("cm")).otherwise(F.lit("m"))


def visual_key(roles: Column, colors: Column, n_marked: Column, ids: Column | None = None) -> Column:
    """The key of an item's picture: ``original``, or its sorted roles, their colours (a map) and their number.

    Without ``ids`` two items that mark different objects in the same roles and colours
    share a picture; with the marked objects' ids (an array) they do not.
    """
    pairs = F.array_sort(F.transform(F.map_entries(colors), lambda e: F.concat_ws(":", e["key"], e["value"])))
    marked = F.concat_ws("#", F.array_join(F.array_sort(roles), ","), F.array_join(pairs, ","), n_marked.cast("string"))
    if ids is not None:
        marked = F.concat_ws("#", marked, F.array_join(F.array_sort(ids), ","))
    return F.when(n_marked == 0, F.lit("original")).otherwise(marked)


def mark_suffix(key: Column, length: int = 8) -> Column:
    return F.substring(F.sha2(key, 256), 1, max(4, min(64, length)))


def posix_path(path: Column) -> Column:
    """Forward slashes, single, without leading dots and slashes."""
    return F.regexp_replace(F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "/+", "/"), "^[./]+", "")


def marked_path(path: Column, key: Column) -> Column:
    """Where the marked copy of a picture goes: ``{folder}/{stem}_m{suffix}.jpg``; the picture's own path for ``original``."""
    clean = posix_path(path)
    stem = F.regexp_replace(clean, r"\.[^./]*$", "")
    return F.when(key == "original", clean).otherwise(F.concat(stem, F.lit("_m"), mark_suffix(key), F.lit(".jpg")))


def clean_object_name(name: Column) -> Column:
    """The last readable part of a mesh's name: parts stand between numbers, lose capitals at their end, and are read in lower case."""
    bare = F.regexp_replace(F.regexp_replace(name, "[oO]bj", ""), "^_+|_+$", "")
    parts = F.transform(F.split(bare, "[0-9_]*[0-9][0-9_]*"), lambda x: F.regexp_replace(x, r"[\p{Lu}_]+$", ""))
    last = F.get(F.reverse(F.filter(parts, lambda x: x != "")), 0)
    return F.coalesce(F.replace(F.lower(last), F.lit("_"), F.lit(" ")), F.lit(""))


def fenced_json(text: Column) -> Column:
    """JSON text without the fences around it."""
    return F.trim(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*|\s*```$", ""))


def refreshed(answer: Column) -> Column:
    """(phrase, category) of a model's JSON answer; a blank phrase is null, a category is trimmed and in lower case."""
    got = F.from_json(fenced_json(answer), "phrase string, category string")
    return F.struct(first_non_blank(got["phrase"]).alias("phrase"), F.lower(F.trim(got["category"])).alias("category"))


def made_id(prefix: Column, number: Column) -> Column:
    return F.concat_ws("#", prefix, number.cast("string"))


def mime(path: Column) -> Column:
    """The type of a file by its name."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return (
        F.when(ext.isin("jpg", "jpeg"), F.lit("image/jpeg"))
        .when(ext == "png", F.lit("image/png"))
        .when(ext == "webp", F.lit("image/webp"))
        .when(ext == "gif", F.lit("image/gif"))
        .otherwise(F.lit("application/octet-stream"))
    )
