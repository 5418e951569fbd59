"""Question items from relations: (sample_id, qa_id, style, question_type, question, answer, relation_id, marks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import direction, templates
from vistaloom.functions.text import MARK_COLORS, display_name, noun_phrase
from vistaloom.operators import questions

REQUESTED = {"single_axis": 2, "full_sentence": 2, "judgment": 2}


def _names(rows: DataFrame, objects: DataFrame) -> DataFrame:
    name = noun_phrase(display_name(F.col("phrase"), F.col("category"), F.col("object_id")))
    for side in ("anchor", "target"):
        rows = rows.join(objects.select("sample_id", F.col("object_id").alias(f"{side}_id"), name.alias(f"{side}_name")), ["sample_id", f"{side}_id"])
    return rows


def _numbered(rows: DataFrame) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(s) for s in questions.STYLES]), F.col("style"))
    number = F.row_number().over(Window.partitionBy("sample_id").orderBy(order, "mark_tier", "pos")) - 1
    return rows.withColumn("qa_id", F.concat(F.lit("qa#"), number.cast("string")))


def _by_style(make) -> Column:
    out = None
    for s in questions.STYLES:
        out = F.when(F.col("style") == s, make(s)) if out is None else out.when(F.col("style") == s, make(s))
    return out


def relation_2d(relations: DataFrame, objects: DataFrame | None, seed: int, requested: dict[str, int] = REQUESTED, unmarked: float = 0.82, dual: float = 0.1) -> DataFrame:
    """Items of image-plane relations (sample_id, pos, relation_id, anchor_id, target_id, predicate, components, du, dv).

    Without ``objects`` the relations bring what is asked of each object (``questions.ASKED``) along. Roles are marked where names are not unique, else now and then one at random; of
    items with two marks a share ``dual`` is kept. Samples without a relation give none.
    """
    rows = questions.usable(relations) if objects is None else questions.candidates(relations, objects)
    rows = questions.allocated(rows, requested)
    # each draw once a row
    rows = rows.withColumns({f"_u{k}": questions.draw(seed + k, F.col("sample_id"), F.col("anchor_id"), F.col("target_id")) for k in range(7)})
    u = lambda k: F.col(f"_u{k}")
    one = F.when(u(1) < 0.5, "anchor").otherwise("target")
    chance = F.when((u(0) >= unmarked) & F.when(one == "anchor", F.col("anchor_boxed")).otherwise(F.col("target_boxed")), F.array(one)).otherwise(F.array().cast("array<string>"))
    needed = F.filter(F.array(F.when(~F.col("anchor_unique"), "anchor"), F.when(~F.col("target_unique"), "target")), lambda x: x.isNotNull())
    rows = rows.withColumn("roles", F.when(F.col("mark_tier") == 0, chance).otherwise(needed))
    rows = rows.filter((F.size("roles") < 2) | (u(2) < dual))
    colors = F.map_from_arrays(F.col("roles"), F.transform("roles", lambda r, i: F.element_at(F.array(*[F.lit(c) for c in MARK_COLORS]), i + 1)))
    rows = rows.withColumn("colors", colors)

    def text(side: str) -> Column:
        mark = F.col("colors")[side]
        return F.when(mark.isNotNull(), F.concat(F.col(f"{side}_name"), F.lit(" in the "), mark, F.lit(" box"))).otherwise(F.col(f"{side}_name"))

    c, p = F.col("components"), F.col("predicate")
    truth = questions.single_axis_truth(c, p, F.col("du"), F.col("dv"), u(3))
    partial = F.coalesce(questions.allows_partial(c, F.col("du"), F.col("dv")), F.lit(False))
    rows = rows.withColumns({"anchor_text": text("anchor"), "target_text": text("target"), "truth": truth, "mode": questions.judgment_mode(partial, u(4))})
    horizontal = questions.axis_of(F.col("truth")) == "horizontal"
    first, second = F.when(horizontal, "left").otherwise("above"), F.when(horizontal, "right").otherwise("below")
    swap = u(5) < 0.5
    phrase = direction.phrase(c, p)
    said = questions.statement(F.col("mode"), phrase, direction.opposite(c, p), direction.phrase(F.array("truth"), F.col("truth")))
    common = {"T": F.col("target_text"), "R": F.col("anchor_text")}
    made = {
        "single_axis": templates.render("rel2d.single_axis", u(6), A=F.when(swap, second).otherwise(first), B=F.when(swap, first).otherwise(second), X=F.col("truth"), **common),
        "full_sentence": templates.render("rel2d.full_sentence", u(6), X=phrase, **common),
        "judgment": templates.render("rel2d.judgment", u(6), condition=F.col("mode") == "correct", S=said, X=phrase, **common),
    }
    rows = rows.withColumns({"question": _by_style(lambda s: made[s][0]), "answer": _by_style(lambda s: made[s][1])})
    rows = _numbered(rows).withColumn("question_type", F.when(F.col("style") == "single_axis", "MCQ").otherwise("open_ended"))
    return rows.select("sample_id", "qa_id", "style", "question_type", "question", "answer", "relation_id", "mark_tier", "roles", "colors", F.size("roles").alias("n_marked"), "pos")


def relation_3d(relations: DataFrame, objects: DataFrame | None, seed: int, requested: dict[str, int] | None = None) -> DataFrame:
    """Items of egocentric relations, in a drawn order: atomic, composite, and judgments of which half are flipped.

    Without ``objects`` the relations bring ``anchor_name`` and ``target_name`` along.
    """
    plan = requested or {"atomic": 2, "composite": 2, "judgment": 2}
    u = lambda k: questions.draw(seed + k, F.col("sample_id"), F.col("anchor_id"), F.col("target_id"))
    rank = F.row_number().over(Window.partitionBy("sample_id").orderBy(u(0), "anchor_id", "target_id"))
    rows = relations.filter(F.size("components") > 0)
    rows = (rows if objects is None else _names(rows, objects)).withColumn("_k", rank).filter(F.col("_k") <= sum(plan.values()))
    style = F.when(F.col("_k") <= plan["atomic"], "atomic").when(F.col("_k") <= plan["atomic"] + plan["composite"], "composite").otherwise("judgment")
    rows = rows.withColumns({"style": style, "flip": u(1) < 0.5})
    c = F.col("components")
    whole, flipped = F.array_join(c, " and "), F.array_join(direction.flip_first(c), " and ")
    common = {"T": F.col("target_name"), "R": F.col("anchor_name")}
    atomic = templates.render("rel3d.atomic", u(2), X=F.col("predicate"), **common)
    composite = templates.render("rel3d.composite", u(2), X=whole, **common)
    judgment = templates.render("rel3d.judgment", u(2), condition=~F.col("flip"), S=F.when(F.col("flip"), flipped).otherwise(whole), **common)
    pick = lambda i: F.when(F.col("style") == "atomic", atomic[i]).when(F.col("style") == "composite", composite[i]).otherwise(judgment[i])
    qa = F.concat(F.lit("qa#"), (F.col("_k") - 1).cast("string"))
    return rows.select("sample_id", qa.alias("qa_id"), "style", pick(0).alias("question"), pick(1).alias("answer"), "anchor_id", "target_id")
