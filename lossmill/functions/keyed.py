"""Reproducible random attributes.

Draws are a function of the policy key alone, so they do not depend on the
partitioning, the row order or a retried task. One md5 of the key gives four
32-bit words; a word w becomes the uniform (w + 0.5) / 2**32, never 0 or 1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Calendar, Delay

WORD = 8  # hex digits of one 32-bit word


def digest(key: Column, stream: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{stream}")))


def uniform(hashed: Column, word: int = 0) -> Column:
    """Uniform in (0, 1) from word 0..3 of a digest."""
    digits = F.substring(hashed, 1 + word * WORD, WORD)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(2**32)


def normal_pair(u1: Column, u2: Column) -> tuple[Column, Column]:
    """Two independent standard normals from two uniforms (Box-Muller)."""
    radius = F.sqrt(F.log(u1) * -2.0)
    angle = u2 * (2.0 * math.pi)
    return radius * F.cos(angle), radius * F.sin(angle)


def lognormal(normal: Column, law: Delay) -> Column:
    return F.exp(normal * law.sigma + law.mu)


def keyed_date(key: Column, calendar: Calendar = Calendar()) -> Column:
    """Day drawn uniformly from the calendar's range."""
    day = F.floor(uniform(digest(key, "date")) * calendar.days).cast("int")
    return F.date_add(F.lit(calendar.first_day), day)
