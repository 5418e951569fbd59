"""Words for directions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ordered components -> (phrase, opposite phrase, short token).
DIRECTIONS = {
    "left": ("to the left of", "to the right of", "left"),
    "right": ("to the right of", "to the left of", "right"),
    "above": ("above", "below", "above"),
    "below": ("below", "above", "below"),
    "left,above": ("to the upper left of", "to the lower right of", "upper left"),
    "left,below": ("to the lower left of", "to the upper right of", "lower left"),
    "right,above": ("to the upper right of", "to the lower left of", "upper right"),
    "right,below": ("to the lower right of", "to the upper left of", "lower right"),
}
#: Each 3D direction and the one it flips to.
FLIPS = {"left": "right", "right": "left", "above": "below", "below": "above", "front": "behind", "behind": "front"}
COMPASS = ("front", "front-right", "right", "back-right", "back", "back-left", "left", "front-left")


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _word(i: int, key: Column) -> Column:
    return _map({k: v[i] for k, v in DIRECTIONS.items()})[key]


def phrase(components: Column, predicate: Column) -> Column:
    """The phrase of ordered components (an array, or null), else of the predicate, else ``near``."""
    return F.coalesce(_word(0, F.array_join(components, ",")), _word(0, predicate), F.lit("near"))


def opposite(components: Column, predicate: Column) -> Column:
    return F.coalesce(_word(1, F.array_join(components, ",")), _word(1, predicate), F.lit("near"))


def short_token(components: Column, predicate: Column) -> Column:
    """The token of an unordered pair of components, else of the predicate, else ``left``."""
    forth, back = F.array_join(components, ","), F.array_join(F.reverse(components), ",")
    return F.coalesce(_word(2, forth), _word(2, back), _word(2, predicate), F.lit("left"))


def flip_first(components: Column) -> Column:
    """3D components with the first one flipped."""
    first = F.get(components, 0)
    return F.when(F.size(components) == 0, components).otherwise(
        F.concat(F.array(F.coalesce(_map(FLIPS)[first], first)), F.slice(components, 2, F.size(components)))
    )


def compass(dx: Column, dy: Column, delta: float = 15) -> Column:
    """One of eight directions of an offset; cardinal sectors are ``delta`` degrees to each side, ``(low, high]``."""
    angle = F.degrees(F.atan2(dx, dy))
    return compass_of_angle(angle, delta)


def compass_of_angle(angle: Column, delta: float = 15) -> Column:
    edges = [(-delta, delta, 0), (delta, 90 - delta, 1), (90 - delta, 90 + delta, 2), (90 + delta, 180 - delta, 3)]
    edges += [(-180 + delta, -90 - delta, 5), (-90 - delta, -90 + delta, 6), (-90 + delta, -delta, 7)]
    out = F.when((angle > 180 - delta) | (angle <= -180 + delta), F.lit(COMPASS[4]))
    for low, high, k in edges:
        out = out.when((angle > low) & (angle <= high), F.lit(COMPASS[k]))
    return out
