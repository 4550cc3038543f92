"""Argument checks for the scalars that operators take."""

from __future__ import annotations


def fraction(value: float) -> float:
    if not 0 <= value <= 1:
        raise ValueError(f"{value} is not between 0 and 1")
    return value


def identity(value: float) -> float:
    if not 0 <= value <= 100:
        raise ValueError(f"{value} is not between 0 and 100")
    return value


def word_size(value: int) -> int:
    if not 4 <= value <= 1000:
        raise ValueError(f"{value} is not between 4 and 1000")
    return value
