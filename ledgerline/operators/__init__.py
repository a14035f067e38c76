from .relational import (
    DEFAULT_BROADCAST_LIMIT, broadcast_if_small, current_names, estimated_bytes,
    first_hit, latest_by, prev_period_join,
)
from .skew import dealt_by_key, fits_broadcast, heavy_keys, keyed_join, likely_keys, lookups_by_key, only_keys, salted_join

__all__ = [
    "DEFAULT_BROADCAST_LIMIT", "broadcast_if_small", "current_names", "estimated_bytes",
    "first_hit", "latest_by", "prev_period_join",
    "dealt_by_key", "fits_broadcast", "heavy_keys", "keyed_join", "likely_keys", "lookups_by_key", "only_keys", "salted_join",
]
