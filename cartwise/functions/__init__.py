"""Column expressions and skew-safe building blocks."""

from .columns import (FEATURES, SERVING_THRESHOLD, DEFAULT_CUT, THRESHOLD_GRIDS, GRID_START,
                      nan_to_null, ratio, standin_probability, validation_flag, hour_angle)
from .skew import sized_broadcast, cut_lineage, sequence_number, top_k_per_group

__all__ = ["FEATURES", "SERVING_THRESHOLD", "DEFAULT_CUT", "THRESHOLD_GRIDS", "GRID_START",
           "nan_to_null", "ratio", "standin_probability", "validation_flag", "hour_angle",
           "sized_broadcast", "cut_lineage", "sequence_number", "top_k_per_group"]
