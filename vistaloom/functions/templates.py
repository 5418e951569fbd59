"""Question and answer templates: a small table, and choosing from it by a hash draw.

A template has pools of questions and answers; a conditional one has an answer
pool for true and one for false. ``[K]`` in a text is filled by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from vistaloom.functions.text import fill


@dataclass(frozen=True)
class Template:
    questions: tuple[str, ...]
    answers: tuple[str, ...] = ()
    true: tuple[str, ...] = ()
    false: tuple[str, ...] = ()

    def __post_init__(self):
        if bool(self.true) != bool(self.false):
            raise ValueError("a conditional template needs answers for both outcomes")
        if not self.questions or not (self.answers or self.true):
            raise ValueError("a template needs questions and answers")


REGISTRY: dict[str, Template] = {}


def register(name: str, template: Template) -> None:
    if name in REGISTRY:
        raise ValueError(f"template {name} is there already")
    REGISTRY[name] = template


for _name, _template in {
    "rel2d.single_axis": Template(("Seen in the picture, is [T] [A] or [B] relative to [R]?", "Choose one: does [T] lie [A] or [B] of [R]?"), ("[X]",)),
    "rel2d.full_sentence": Template(("Where is [T] relative to [R]?", "Describe where [T] is with respect to [R]."), ("[T] is [X] [R].",)),
    "rel2d.judgment": Template(("Is it right that [T] is [S] [R]?", "True or false: [T] is [S] [R]."), true=("Yes, [T] is [X] [R].",), false=("No, [T] is [X] [R].",)),
    "rel3d.atomic": Template(("From the camera, on which side of [R] is [T]?",), ("[T] is [X] of [R].",)),
    "rel3d.composite": Template(("From the camera, how does [T] lie relative to [R]?",), ("[T] is [X] of [R].",)),
    "rel3d.judgment": Template(("From the camera, is [T] [S] of [R]?",), true=("Yes.",), false=("No.",)),
    "counting.open": Template(("How many [A] are in the picture?", "Count the [A]."), ("There are [X].",)),
    "counting.choice": Template(("How many [A] are in the picture?\n[Y]",), ("[X]",)),
    "distance.absolute": Template(("How far apart are [A] and [B]?",), ("[X]",)),
    "distance.farther": Template(("Which is farther from [C], [A] or [B]?",), ("[X]",)),
    "distance.closer": Template(("Which is closer to [C], [A] or [B]?",), ("[X]",)),
    "distance.camera": Template(("Which is nearer to the camera, [A] or [B]?",), ("[X]",)),
    "depth.order": Template(("Order these from near to far: [A].",), ("[X]",)),
    "depth.nth": Template(("Of [A], which is number [N] from the camera?",), ("[X]",)),
    "size.bigger": Template(("Is [A] bigger than [B]?",), true=("Yes.",), false=("No.",)),
    "size.smaller": Template(("Is [A] smaller than [B]?",), true=("Yes.",), false=("No.",)),
    "size.absolute": Template(("How long is the longest side of [A]?",), ("[X]",)),
    "position.higher": Template(("Which reaches higher, [A] or [B]?",), ("[X]",)),
    "position.near": Template(("Are [A] and [B] next to each other or far apart?",), ("[X]",)),
    "views.direction": Template(("You face [D] at [A]. In which direction is [B]?",), ("[X]",)),
    "views.correspondence": Template(("Which marked point of the second picture is the one marked in the first?\n[Y]",), ("[X]",)),
    "grounding.boxes": Template(("Find [A] and give its 3D box in camera coordinates.",), ("[X]",)),
}.items():
    register(_name, _template)


def _pick(pool: tuple[str, ...], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in pool]), (F.floor(u * len(pool)) + 1).cast("int"))


def render(name: str, u: Column, condition: Column | None = None, **values: Column) -> tuple[Column, Column]:
    """(question, answer) of a template chosen by the draw ``u`` and filled."""
    template = REGISTRY[name]
    if (condition is not None) != bool(template.true):
        raise ValueError(f"{name} does {'' if template.true else 'not '}take a condition")
    answer = _pick(template.answers, u) if condition is None else F.when(condition, _pick(template.true, u)).otherwise(_pick(template.false, u))
    return fill(_pick(template.questions, u), **values), fill(answer, **values)


def single_prompt(question: Column, answer: Column) -> Column:
    """Question and answer in one text, as ``text.split_qa`` cuts it."""
    return F.concat(question, F.lit(" Answer: "), answer)
