"""Business thresholds as data, and the label expressions made from them."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Ordered (label, bound) steps; the first step that holds wins, NULL gets ``otherwise``."""

    steps: tuple[tuple[str, Decimal], ...]
    otherwise: str
    rising: bool = True

    def label(self, total: Column, count: Column | None = None) -> Column:
        """Label ``total``, or the mean ``total / count`` when a count is given.

        The mean is compared as ``total >= bound * count``, without dividing, so that a mean
        sitting exactly on a bound cannot slip off it by a rounding error.
        """
        chain = None
        for name, bound in self.steps:
            edge = F.lit(bound) if count is None else F.lit(bound) * count
            holds = total >= edge if self.rising else total <= edge
            chain = F.when(holds, name) if chain is None else chain.when(holds, name)
        return chain.otherwise(self.otherwise)


# The warehouse's business rules.
BANDS: dict[str, Bands] = {
    "performance": Bands(
        (("EXCELLENT", Decimal("0.9")), ("GOOD", Decimal("0.8")), ("FAIR", Decimal("0.7"))),
        "POOR",
    ),
    "stock_health": Bands(
        (("HEALTHY", Decimal("0.3")), ("MODERATE_RISK", Decimal("0.6"))),
        "HIGH_RISK",
        rising=False,
    ),
    "velocity": Bands(
        (("FAST_MOVING", Decimal("100")), ("MEDIUM_MOVING", Decimal("50"))),
        "SLOW_MOVING",
    ),
    "spend": Bands(
        (("TIER_1_HIGH_SPEND", Decimal("50000")), ("TIER_2_MEDIUM_SPEND", Decimal("20000"))),
        "TIER_3_LOW_SPEND",
    ),
    "grade": Bands(
        (("EXCELLENT", Decimal("80")), ("GOOD", Decimal("70")), ("FAIR", Decimal("60"))),
        "NEEDS_IMPROVEMENT",
    ),
}

# Stock velocity of an item and the turnover class it stands for.
TURNOVER_CLASSES: dict[str, str] = {
    "FAST": "HIGH_TURNOVER",
    "MEDIUM": "MEDIUM_TURNOVER",
    "SLOW": "LOW_TURNOVER",
}
UNKNOWN_TURNOVER = "UNKNOWN_TURNOVER"


def turnover_class(velocity: Column) -> Column:
    chain = None
    for seen, name in TURNOVER_CLASSES.items():
        chain = (F.when if chain is None else chain.when)(velocity == seen, name)
    return chain.otherwise(UNKNOWN_TURNOVER)
