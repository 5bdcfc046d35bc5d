"""Score strings and customer segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORES = ("r_score", "f_score", "m_score")

# Segment labels with their conditions on quartile scores (4 is best). The
# first that holds names the segment.
SEGMENTS = (
    ("Champions/VIP", "rfm_score_string = '444'"),
    ("Recent Customers", "r_score = 4"),
    ("Loyal Customers", "f_score = 4"),
    ("Big Spenders", "m_score = 4"),
    ("Lost Customers", "r_score <= 1"),
    ("At Risk", "r_score <= 2"),
)
OTHER_SEGMENT = "General Customers"


def score_string() -> Column:
    """The three scores side by side, such as `413`."""
    return F.concat(*[F.col(score).cast("string") for score in SCORES])


def segment(rules: tuple[tuple[str, str], ...] = SEGMENTS, default: str = OTHER_SEGMENT) -> Column:
    """Label of the first rule that holds."""
    return F.coalesce(*[F.when(F.expr(condition), label) for label, condition in rules], F.lit(default))
