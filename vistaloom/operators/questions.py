"""Questions about objects and relations: who may be asked about, in which style, and the true answers.

Random choices are hash draws of the row's own keys and a seed, so they do not
depend on partitions or order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions.text import display_name, name_key, noun_phrase

#: The axis of each atomic direction and its two options.
AXIS = {"left": "horizontal", "right": "horizontal", "above": "vertical", "below": "vertical"}
STYLES = ("single_axis", "full_sentence", "judgment")


def draw(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) from a seed and keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


#: What a question needs to know of each of its objects; computed before pairing, it takes no join afterwards.
ASKED = ("name", "unique", "boxed")


def named(objects: DataFrame, key: str = "sample_id") -> DataFrame:
    """Objects with ``name`` (a noun phrase), ``unique`` (nothing else in the sample has it) and ``boxed``."""
    shown = display_name(F.col("phrase"), F.col("category"), F.col("object_id"))
    n = F.count("*").over(Window.partitionBy(key, name_key(shown)))
    return objects.withColumns({"name": noun_phrase(shown), "unique": n == 1, "boxed": F.col("x1").isNotNull()})


def usable(relations: DataFrame) -> DataFrame:
    """Relations with ``ASKED`` of anchor and target that can be asked about, with ``mark_tier``.

    Both names are unique in the sample, or a mark can tell them apart: a box on one
    side at least, and on every side whose name is not unique.
    """
    a, t, ab, tb = (F.col(c) for c in ("anchor_unique", "target_unique", "anchor_boxed", "target_boxed"))
    fit = ((a & t) | ab | tb) & (a | ab) & (t | tb)
    return relations.filter(fit).withColumn("mark_tier", F.when(a & t, 0).when(a | t, 1).otherwise(2))


def candidates(relations: DataFrame, objects: DataFrame, key: str = "sample_id") -> DataFrame:
    """``usable`` relations, what is asked of each object joined to them."""
    own = named(objects, key)
    for p in ("anchor", "target"):
        relations = relations.join(own.select(key, F.col("object_id").alias(f"{p}_id"), *[F.col(c).alias(f"{p}_{c}") for c in ASKED]), [key, f"{p}_id"])
    return usable(relations)


def allocated(relations: DataFrame, requested: dict[str, int], order: str = "pos", key: str = "sample_id") -> DataFrame:
    """Candidates with the ``style`` they are used for, best tier first, each once; the others are left out."""
    # later styles go short first, so a rank alone says the style; only so many ranks leave the sort
    rank = F.row_number().over(Window.partitionBy(key).orderBy("mark_tier", order))
    rows = relations.withColumn("_k", rank).filter(F.col("_k") <= sum(requested.get(name, 0) for name in STYLES))
    style, sofar = None, 0
    for name in STYLES:
        sofar += requested.get(name, 0)
        style = F.when(F.col("_k") <= sofar, name) if style is None else style.when(F.col("_k") <= sofar, name)
    return rows.withColumn("style", style).drop("_k")


def single_axis_truth(components: Column, predicate: Column, du: Column, dv: Column, u: Column, close: float = 0.2) -> Column:
    """The atomic direction asked for: of two components the longer one, or, where they are close, one drawn by their lengths."""
    a, b = F.abs(du).cast("double"), F.abs(dv).cast("double")
    most = F.greatest(a, b)
    near = F.abs(a - b) / most <= close
    share = F.when(a == 0, F.lit(1.0)).otherwise(a) / (F.when(a == 0, F.lit(1.0)).otherwise(a) + F.when(b == 0, F.lit(1.0)).otherwise(b))
    first, second = F.get(components, 0), F.get(components, 1)
    two = F.when(most == 0, F.when(u < 0.5, first).otherwise(second)).when(near, F.when(u < share, first).otherwise(second)).when(a >= b, first).otherwise(second)
    return F.when(F.size(components) == 2, two).otherwise(F.coalesce(F.get(components, 0), predicate, F.lit("left")))


def axis_of(atom: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for p in AXIS.items() for x in p])[atom], F.lit("horizontal"))


def allows_partial(components: Column, du: Column, dv: Column, least: float = 0.75) -> Column:
    """Whether a statement of one component alone is partly true: there are two, of like lengths."""
    a, b = F.abs(du), F.abs(dv)
    return (F.size(components) == 2) & (F.greatest(a, b) > 0) & (F.least(a, b) / F.greatest(a, b) >= least)


def judgment_mode(partial: Column, u: Column, incorrect: float = 0.5, part: float = 0.15, correct: float = 0.35) -> Column:
    """``incorrect``, ``partial`` (where allowed) or ``correct``, drawn by their weights."""
    total = F.lit(incorrect + correct) + F.when(partial, part).otherwise(0.0)
    at = u * total
    return F.when(at < incorrect, "incorrect").when(partial & (at < incorrect + part), "partial").otherwise("correct")


def statement(mode: Column, true_phrase: Column, opposite: Column, atom_phrase: Column) -> Column:
    """The direction that a judgment question states."""
    return F.when(mode == "correct", true_phrase).when(mode == "partial", atom_phrase).otherwise(opposite)


def shuffled(options: Column, seed: int, *keys: Column) -> Column:
    """Options in an order drawn from the keys."""
    mixed = F.transform(options, lambda x: F.struct(draw(seed, *keys, x).alias("d"), x.alias("x")))
    return F.transform(F.array_sort(mixed), lambda x: x["x"])


def letter(options: Column, answer: Column) -> Column:
    """The letter of an answer among its options."""
    return F.substring(F.lit("ABCDEFGH"), F.array_position(options, answer).cast("int"), F.lit(1))


def wrong_counts(count: Column, seed: int, *keys: Column, n: int = 3, spread: int = 5) -> Column:
    """``n`` wrong counts within ``spread`` of the right one and not below zero."""
    around = F.filter(F.sequence(F.greatest(F.lit(0), count - spread), count + spread), lambda x: x != count)
    return F.slice(shuffled(around, seed, *keys), 1, n)


def farther(a: Column, b: Column) -> Column:
    """``A`` or ``B``: which of two distances is larger; a tie is B's."""
    return F.when(a > b, "A").otherwise("B")


def proximity(distance: Column, extent_a: Column, extent_b: Column, low: float = 0.5, high: float = 2.0) -> Column:
    """``next`` or ``far`` by the distance over the mean extent; null between."""
    ratio = distance / ((extent_a + extent_b) / 2)
    return F.when(ratio < low, "next").when(ratio > high, "far")


def camera_answer(a: Column, b: Column, same: float = 0.08) -> Column:
    """Which of two objects is nearer to the camera: A, B, or C for about the same."""
    return F.when(F.abs(a - b) < same, "C").when(a < b, "A").otherwise("B")
