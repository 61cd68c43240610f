"""Column expressions shared by operators and sources (all JVM built-ins)."""

from quarry.functions.hashing import hash_bits, hash_pick, hash_range
from quarry.functions.money import money_avg, money_sum, round_money
from quarry.functions.words import (
    TRIM_CHARACTERS,
    WHITESPACE_PATTERN,
    split_words,
)

__all__ = [
    "TRIM_CHARACTERS",
    "WHITESPACE_PATTERN",
    "hash_bits",
    "hash_pick",
    "hash_range",
    "money_avg",
    "money_sum",
    "round_money",
    "split_words",
]
