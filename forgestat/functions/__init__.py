"""Column helpers: pure expressions, no UDFs."""

from forgestat.functions.keys import surrogate_key, row_id
from forgestat.functions.time import (
    hour_boundaries, day_boundaries, trunc_ntz, day_of_week_sun0, to_date_key,
)
from forgestat.functions.users import is_bot_login
from forgestat.functions.sizing import broadcast_if_bounded
from forgestat.functions.numeric import round_scaled

__all__ = [
    "surrogate_key", "row_id", "hour_boundaries", "day_boundaries", "trunc_ntz",
    "day_of_week_sun0", "to_date_key", "is_bot_login", "broadcast_if_bounded", "round_scaled",
]
