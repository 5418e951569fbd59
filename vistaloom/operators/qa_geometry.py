"""Question items about counts, distances, sizes, depths, boxes and views.

Each function takes rows that hold what is asked about and returns them with
``question`` and ``answer``; choices are hash draws of the given keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import direction, templates
from vistaloom.functions.geometry3d import norm
from vistaloom.functions.text import length_text
from vistaloom.operators import questions


def _ask(rows: DataFrame, name: str, u: Column, condition: Column | None = None, **values: Column) -> DataFrame:
    q, a = templates.render(name, u, condition, **values)
    return rows.withColumns({"question": q, "answer": a})


def options_text(options: Column) -> Column:
    """Options under each other with their letters."""
    lines = F.transform(options, lambda x, i: F.concat(F.substring(F.lit("ABCDEFGH"), (i + 1).cast("int"), F.lit(1)), F.lit(": "), x.cast("string")))
    return F.array_join(lines, "\n")


def counting(counts: DataFrame, seed: int, key: str = "sample_id", tag: str = "category", n: str = "n") -> DataFrame:
    """Open counting questions."""
    return _ask(counts, "counting.open", questions.draw(seed, F.col(key), F.col(tag)), A=F.concat(tag, F.lit("s")), X=F.col(n).cast("string"))


def counting_choice(counts: DataFrame, seed: int, key: str = "sample_id", tag: str = "category", n: str = "n") -> DataFrame:
    """Counting questions with four options; the answer is a letter."""
    keys = (F.col(key), F.col(tag))
    wrong = questions.wrong_counts(F.col(n), seed, *keys)
    rows = counts.withColumn("options", F.concat(F.array(n), wrong)).filter(F.size("options") == 4)
    rows = rows.withColumn("options", questions.shuffled(F.col("options"), seed + 1, *keys))
    letter = questions.letter(F.col("options"), F.col(n))
    return _ask(rows, "counting.choice", questions.draw(seed, *keys), A=F.concat(tag, F.lit("s")), Y=options_text(F.col("options")), X=letter)


def absolute_distance(pairs: DataFrame, seed: int, meters: str = "distance", scale: float = 1.0) -> DataFrame:
    """How far apart (a, b) are, in metres or centimetres."""
    value, unit = length_text(F.col(meters) * scale)
    return _ask(pairs, "distance.absolute", questions.draw(seed, F.col("a"), F.col("b")), A=F.col("a").cast("string"), B=F.col("b").cast("string"), X=F.concat_ws(" ", value, unit))


def relative_distance(triples: DataFrame, seed: int) -> DataFrame:
    """Which of (a, b) is farther from, or closer to, c, from distances ``dx`` and ``dy``; a tie makes b farther and a closer."""
    u = questions.draw(seed, F.col("a"), F.col("b"), F.col("c"))
    a, b, c = (F.col(x).cast("string") for x in "abc")
    far = F.when(F.col("dx") > F.col("dy"), a).otherwise(b)
    near = F.when(F.col("dx") > F.col("dy"), b).otherwise(a)
    f, n = templates.render("distance.farther", u, A=a, B=b, C=c, X=far), templates.render("distance.closer", u, A=a, B=b, C=c, X=near)
    ask_far = questions.draw(seed + 1, a, b, c) < 0.5
    return triples.withColumns({"question": F.when(ask_far, f[0]).otherwise(n[0]), "answer": F.when(ask_far, f[1]).otherwise(n[1])})


def size(pairs: DataFrame, seed: int) -> DataFrame:
    """Whether a is bigger, or smaller, than b, from volumes ``a_v`` and ``b_v``; strict both ways."""
    u, a, b = questions.draw(seed, F.col("a"), F.col("b")), F.col("a").cast("string"), F.col("b").cast("string")
    big = templates.render("size.bigger", u, F.col("a_v") > F.col("b_v"), A=a, B=b)
    small = templates.render("size.smaller", u, F.col("a_v") < F.col("b_v"), A=a, B=b)
    ask = questions.draw(seed + 1, a, b) < 0.5
    return pairs.withColumns({"question": F.when(ask, big[0]).otherwise(small[0]), "answer": F.when(ask, big[1]).otherwise(small[1])})


def extent(objects: DataFrame, seed: int, name: str, meters: str) -> DataFrame:
    """How long an object's longest side is."""
    value, unit = length_text(F.col(meters))
    return _ask(objects, "size.absolute", questions.draw(seed, F.col(name)), A=F.col(name), X=F.concat_ws(" ", value, unit))


def depth_order(samples: DataFrame, seed: int, objects: str = "objects", key: str = "sample_id") -> DataFrame:
    """The order from near to far of ``objects`` (array of (depth, name)), asked in a shuffled order."""
    names = F.transform(F.array_sort(objects), lambda o: o["name"])
    asked = questions.shuffled(names, seed, F.col(key))
    return _ask(samples, "depth.order", questions.draw(seed, F.col(key)), A=F.array_join(asked, ", "), X=F.array_join(names, ", "))


def depth_nth(samples: DataFrame, seed: int, objects: str = "objects", key: str = "sample_id") -> DataFrame:
    """Which object is farthest (40 in 100), closest (40) or at a drawn place (20)."""
    names = F.transform(F.array_sort(objects), lambda o: o["name"])
    u, n = questions.draw(seed, F.col(key)), F.size(objects)
    place = F.when(u < 0.4, n).when(u < 0.8, F.lit(1)).otherwise((F.floor(questions.draw(seed + 1, F.col(key)) * n) + 1).cast("int"))
    rows = samples.withColumn("place", place)
    return _ask(rows, "depth.nth", u, A=F.array_join(questions.shuffled(names, seed, F.col(key)), ", "), N=F.col("place").cast("string"), X=F.element_at(names, F.col("place")))


def grounding(boxes: DataFrame, seed: int, name: str, numbers: list[str]) -> DataFrame:
    """An object's 3D box, its numbers to two decimals."""
    text = F.concat(F.lit("["), F.concat_ws(", ", *[F.format_string("%.2f", F.bround(F.col(c), 2)) for c in numbers]), F.lit("]"))
    return _ask(boxes, "grounding.boxes", questions.draw(seed, F.col(name)), A=F.col(name), X=text)


def camera_distance(pairs: DataFrame, seed: int) -> DataFrame:
    """Which of (a, b) is nearer to the camera, from distances ``a_d`` and ``b_d``."""
    a, b = F.col("a").cast("string"), F.col("b").cast("string")
    letter = questions.camera_answer(F.col("a_d"), F.col("b_d"))
    said = F.when(letter == "A", a).when(letter == "B", b).otherwise("about the same")
    return _ask(pairs, "distance.camera", questions.draw(seed, a, b), A=a, B=b, X=said)


def bearing(rows: DataFrame, seed: int, delta: float = 15) -> DataFrame:
    """The direction of ``b`` from ``a`` when facing a drawn heading: offsets (dx, dy) are turned to it."""
    keys = (F.col("a"), F.col("b"))
    turn = F.floor(questions.draw(seed, *keys) * 8).cast("int")
    angle = F.degrees(F.atan2("dx", "dy")) - 45 * turn
    angle = F.when(angle <= -180, angle + 360).otherwise(angle)
    heading = F.element_at(F.array(*[F.lit(c) for c in direction.COMPASS]), turn + 1)
    return _ask(rows, "views.direction", questions.draw(seed + 1, *keys), D=heading, A=F.col("a").cast("string"), B=F.col("b").cast("string"), X=direction.compass_of_angle(angle, delta))


def correspondence(matches: DataFrame, pixels: DataFrame, seed: int, apart: float = 20, options: int = 4) -> DataFrame:
    """Which pixel of view b shows the point marked in view a.

    ``matches`` (pair, u, v: pixels of view b) and ``pixels`` (pair, pu, pv); distractors
    are drawn from pixels at least ``apart`` from the match. Matches without enough of them give none.
    """
    far = norm([F.col("pu") - F.col("u"), F.col("pv") - F.col("v")]) >= apart
    draw = questions.draw(seed, F.col("pair"), F.col("pu"), F.col("pv"))
    rows = matches.join(pixels, "pair").filter(far).withColumn("_d", draw)
    rank = F.row_number().over(Window.partitionBy("pair", "u", "v").orderBy("_d", "pu", "pv"))
    rows = rows.withColumn("_k", rank).filter(F.col("_k") < options)
    text = lambda u, v: F.concat(F.lit("("), F.col(u).cast("string"), F.lit(", "), F.col(v).cast("string"), F.lit(")"))
    wrong = rows.groupBy("pair", "u", "v").agg(F.array_sort(F.collect_list(text("pu", "pv"))).alias("wrong")).filter(F.size("wrong") == options - 1)
    mixed = questions.shuffled(F.concat(F.array(text("u", "v")), F.col("wrong")), seed + 1, F.col("pair"))
    out = wrong.withColumn("options", mixed)
    return _ask(out, "views.correspondence", questions.draw(seed + 2, F.col("pair")), Y=options_text(F.col("options")), X=questions.letter(F.col("options"), text("u", "v")))


def matched_points(first: DataFrame, second: DataFrame, seed: int, within: float, size: tuple[int, int], least: int = 1, margin: int = 0) -> DataFrame:
    """(pair, qu, qv, u, v): for each pair of views a drawn pixel of the first and the pixel of the second that shows the same point.

    ``first`` and ``second`` are pixels (pair, u, v, x, y, z) with their points in the world. Points of both views
    meet in a grid of cells ``within`` wide; a pair needs ``least`` pixels with a partner, and both pixels must be
    ``margin`` from the border of a picture of ``size``.
    """
    from vistaloom.operators.points import nearest_within

    met = nearest_within(first, second, ["pair"], within, ["u", "v"])
    n = F.count("*").over(Window.partitionBy("pair"))
    met = met.withColumns({"_n": n, "_d": questions.draw(seed, F.col("pair"), F.col("a_u"), F.col("a_v"))}).filter(F.col("_n") >= least)
    best = met.groupBy("pair").agg(F.min(F.struct("_d", F.col("a_u").alias("qu"), F.col("a_v").alias("qv"), F.col("b_u").alias("u"), F.col("b_v").alias("v"))).alias("m"))
    inside = [(F.col(u) >= margin) & (F.col(u) <= size[0] - margin) & (F.col(v) >= margin) & (F.col(v) <= size[1] - margin) for u, v in (("qu", "qv"), ("u", "v"))]
    return best.select("pair", "m.qu", "m.qv", "m.u", "m.v").filter(inside[0] & inside[1])


def directions_of(items: DataFrame, edges: DataFrame, key: str = "sample_id") -> DataFrame:
    """(direction, n): questions by the short direction of their relation; buckets for those without a relation and for unknown ones."""
    e = edges.select(key, "relation_id", direction.short_token(F.col("components"), F.col("predicate")).alias("_t"), F.lit(True).alias("_there")).dropDuplicates([key, "relation_id"])
    rows = items.join(e, [key, "relation_id"], "left")
    bucket = F.when(F.col("relation_id").isNull(), "(no relation)").when(F.col("_there").isNull(), "(unknown relation)").otherwise(F.col("_t"))
    return rows.groupBy(bucket.alias("direction")).agg(F.count("*").alias("n"))


def caption_prompt(rows: DataFrame, modules: dict[str, str], seed: int, key: str, keep: float = 0.7) -> DataFrame:
    """A caption prompt of the modules that a draw keeps, the first always; the call to a model is a plug-in's."""
    first, *rest = modules.items()
    parts = [F.lit(first[1])] + [F.when(questions.draw(seed, F.col(key), F.lit(n)) < keep, F.lit(text)) for n, text in rest]
    return rows.withColumn("prompt", F.concat_ws(" ", *parts))
