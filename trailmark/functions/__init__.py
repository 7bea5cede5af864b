from trailmark.functions.lookup import kv_lookup
from trailmark.functions.numbers import micros, round_to_long, safe_ratio
from trailmark.functions.text import classify_prefix, joined_key, split_field
from trailmark.functions.times import civil_date, epoch_to_civil, utc_date

__all__ = [
    "civil_date",
    "classify_prefix",
    "epoch_to_civil",
    "joined_key",
    "kv_lookup",
    "micros",
    "round_to_long",
    "safe_ratio",
    "split_field",
    "utc_date",
]
