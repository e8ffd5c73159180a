from orrery.functions.columns import (
    blank_to_null,
    hash_percent,
    lenient_cast,
    literal_alternation,
    payload_json,
    round2,
    sentinel_flag,
    sentinel_to_null,
    trimmed,
)

__all__ = [
    "blank_to_null", "hash_percent", "lenient_cast", "literal_alternation",
    "payload_json", "round2", "sentinel_flag", "sentinel_to_null", "trimmed",
]
