"""Row-level column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_to(col: ColumnLike, digits: int) -> Column:
    """Half-up rounding of the decimal value, as a double.

    The value is first placed on a grid of 8 decimals, so that binary noise (1.005 stored as
    1.00499...) cannot flip a tie; the result does not depend on summation order.
    """
    return F.round(_c(col).cast("decimal(28,8)"), digits).cast("double")


def is_true(col: ColumnLike) -> Column:
    """NULL counts as false."""
    return F.coalesce(_c(col), F.lit(False))


def clean_name(col: ColumnLike) -> Column:
    return F.initcap(F.trim(_c(col)))


def clean_email(col: ColumnLike) -> Column:
    return F.lower(F.trim(_c(col)))


def days_between(end: ColumnLike, start: ColumnLike) -> Column:
    """Whole days from ``start`` to ``end``, both taken as dates."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def map_values(col: ColumnLike, mapping: Mapping, default=None) -> Column:
    """Simple CASE: value -> mapped literal, unmapped and NULL -> ``default``."""
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = lookup[_c(col)]
    return found if default is None else F.coalesce(found, F.lit(default))


def bucketize(col: ColumnLike, edges: Sequence, labels: Sequence, closed: str = "left") -> Column:
    """Searched CASE over ascending ``edges``; ``len(labels) == len(edges) + 1``.

    ``closed='left'`` puts an edge value into the bucket above it (``value < edge`` tests),
    ``closed='right'`` into the bucket below it (``value <= edge`` tests). As in CASE with
    ELSE, NULL falls into the last bucket.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    value = _c(col)
    chain = None
    for edge, label in zip(edges, labels):
        test = value < F.lit(edge) if closed == "left" else value <= F.lit(edge)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return F.lit(labels[-1]) if chain is None else chain.otherwise(F.lit(labels[-1]))


def assign_phase(
    number: ColumnLike,
    phases: Sequence[tuple[str, int, int]],
    default: str = "bridge",
) -> Column:
    """Name the first inclusive range ``(name, low, high)`` that holds ``number``.

    The ranges are a short fixed parameter, so they become one CASE inside the scan stage
    instead of a range join.
    """
    chain = None
    for name, low, high in phases:
        test = _c(number).between(low, high)
        chain = F.when(test, F.lit(name)) if chain is None else chain.when(test, F.lit(name))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


# Display order of the season phases.
PHASE_ORDER = {
    "hot_start": 1,
    "slump": 2,
    "late_push": 3,
    "bridge": 4,
    "jersey_night": 5,
    "post_jersey": 6,
}


def phase_order(col: ColumnLike, order: Mapping[str, int] | None = None, default: int = 7) -> Column:
    return map_values(col, order or PHASE_ORDER, default)


def risk_tier(
    probability: ColumnLike, low: float = 0.40, high: float = 0.70, right_closed: bool = True
) -> Column:
    """Low / Medium / High. ``right_closed`` keeps a boundary value in the lower tier; NULL -> NULL."""
    p = _c(probability)
    names = ["Low", "Medium", "High"]
    tier = bucketize(p, [low, high], names, closed="right" if right_closed else "left")
    return F.when(p.isNotNull(), tier)


def promo_sensitivity(rate: ColumnLike, tier: ColumnLike) -> Column:
    """0.7 x promo rate plus a bonus for the customer's usual discount depth."""
    bonus = map_values(tier, {"deep": 0.3, "moderate": 0.15}, 0.0)
    return round_to(F.coalesce(_c(rate), F.lit(0.0)) * F.lit(0.7) + bonus, 4)


def recommended_action(sensitivity: ColumnLike, games: ColumnLike) -> Column:
    """First matching rule decides the outreach."""
    return (
        F.when(_c(sensitivity) > 0.5, F.lit("Offer discount"))
        .when(_c(games) > 5, F.lit("Loyalty reward"))
        .otherwise(F.lit("Re-engagement email"))
    )


def null_if(col: ColumnLike, value) -> Column:
    return F.nullif(_c(col), F.lit(value))


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike, floor: int | None = None) -> Column:
    """Ratio that never divides by zero.

    With ``floor`` the denominator is raised to at least that value (NULL counts as the floor)
    and a NULL numerator as 0; without it a zero denominator gives NULL.
    """
    top, bottom = _c(numerator), _c(denominator)
    if floor is None:
        return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    bottom = F.greatest(F.coalesce(bottom, F.lit(floor)), F.lit(floor))
    return F.coalesce(top, F.lit(0)).cast("double") / bottom.cast("double")


def flag_to_int(col: ColumnLike) -> Column:
    """true/false/NULL -> 1/0/NULL."""
    return _c(col).cast("int")
