from depotlake.functions.banding import BANDS, Bands
from depotlake.functions.measures import clamp_unit, late_share, mean, ratio

__all__ = ["BANDS", "Bands", "clamp_unit", "late_share", "mean", "ratio"]
