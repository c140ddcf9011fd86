"""Column helpers: plain functions from Column to Column, all JVM-side."""

from shelfline.functions.dates import month_component, month_of
from shelfline.functions.identity import json_payload, pii_hash, record_id
from shelfline.functions.masking import mask_email, mask_string
from shelfline.functions.money import cents_to_dollars, money_sum, net_cents, percent, ratio

__all__ = [
    "cents_to_dollars", "json_payload", "mask_email", "mask_string", "money_sum",
    "month_component", "month_of", "net_cents", "percent", "pii_hash", "ratio", "record_id",
]
