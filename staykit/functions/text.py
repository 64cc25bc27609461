"""Tests and extractions on text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def finds(value: Column, pattern: str) -> Column:
    """Whether the pattern occurs; NULL text does not match."""
    return F.coalesce(value.rlike(pattern), F.lit(False))


def mentions(value: Column, token: str) -> Column:
    """Whether the lower-cased text holds the token anywhere."""
    return F.instr(F.lower(value), token) > 0


def part(value: Column, separator: str, index: int) -> Column:
    """The index-th piece (from 0) of a separated text, NULL where there is none."""
    return F.get(F.split(value, re.escape(separator)), F.lit(index))


def promo_pattern(codes, literal: bool = True) -> str:
    """Pattern that finds the last of some promotion codes. With ``literal=False`` the codes are used as raw regular
    expressions, so a ``+`` in one is a quantifier."""
    return f"(.*)({'|'.join(re.escape(c) if literal else c for c in codes)})(.*)"


def last_code(value: Column, pattern: str) -> Column:
    """The code ``promo_pattern`` finds in the text: '' without one, NULL for NULL."""
    return F.regexp_extract(value, pattern, 2)


def taller_than(resolution: Column, lines: int) -> Column:
    """Whether either side of a ``1280x720``-like text exceeds ``lines``; unreadable text does not."""
    sides = [part(resolution, "x", i).try_cast("int") > lines for i in (0, 1)]
    return F.coalesce(sides[0], F.lit(False)) | F.coalesce(sides[1], F.lit(False))
