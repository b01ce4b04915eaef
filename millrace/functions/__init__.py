from millrace.functions.values import (
    epoch_millis,
    instant,
    round_half_up,
    undecoded_bytes,
    utf8_text,
    whole_number,
)

__all__ = [
    "epoch_millis",
    "instant",
    "round_half_up",
    "undecoded_bytes",
    "utf8_text",
    "whole_number",
]
