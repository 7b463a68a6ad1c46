from .time import (EPOCH, add_hours, ceil_hour, day_diff, epoch_micros, floor_hour,
                   hour_diff, second_diff)
from .scalar import in_range, logistic, ne_3vl, round_half_away

__all__ = ["EPOCH", "add_hours", "ceil_hour", "day_diff", "epoch_micros", "floor_hour",
           "hour_diff", "second_diff", "in_range", "logistic", "ne_3vl", "round_half_away"]
