from sensorfold.functions.payload import (
    REASONS,
    held_candidate,
    holds_array,
    is_reading,
    parse_body,
    reading_candidate,
    reject_reason,
    slice_body,
    spelled_measure,
    strict_body,
    strip_backslashes,
    wire_quote,
)
from sensorfold.functions.text import TOKENIZER_PATTERN, letter_tokens
from sensorfold.functions.time import iso_millis, last_milli

__all__ = [
    "REASONS",
    "TOKENIZER_PATTERN",
    "held_candidate",
    "holds_array",
    "is_reading",
    "iso_millis",
    "last_milli",
    "letter_tokens",
    "parse_body",
    "reading_candidate",
    "reject_reason",
    "slice_body",
    "spelled_measure",
    "strict_body",
    "strip_backslashes",
    "wire_quote",
]
