"""Scores, gates and statuses as expressions; thresholds are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def points(rules: list[tuple[Column, int]], low: int | None = None) -> Column:
    """The sum of the points of the rules that hold."""
    total = sum((F.when(c, p).otherwise(0) for c, p in rules), F.lit(0))
    return (F.greatest(total, F.lit(low)) if low is not None else total).cast("long")


def notes(rules: list[tuple[Column, str]], separator: str = ";") -> Column:
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in rules])), separator)


def decision(score: Column, steps: list[tuple[int, str]], otherwise: str) -> Column:
    """The name of the first step that the score reaches."""
    out = None
    for least, name in steps:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise(otherwise)


def gate(flags: Column, blocking: list[str], warnings: Column | None = None) -> Column:
    """fail on a blocking flag, warn on any other, else pass."""
    some = F.size(flags) > 0
    if warnings is not None:
        some = some | (F.size(warnings) > 0)
    return F.when(F.arrays_overlap(flags, F.array(*[F.lit(b) for b in blocking])), "fail").when(some, "warn").otherwise("pass")


def first_failure(checks: list[tuple[Column, str]], ok: str = "ok") -> Column:
    """The name of the first check that fails; checks after it don't matter."""
    return F.coalesce(*[F.when(c, F.lit(n)) for c, n in checks], F.lit(ok))


def pace(words: Column, seconds: Column, low: float, high: float) -> tuple[Column, Column]:
    wpm = F.coalesce(F.try_divide(words * 60.0, seconds), F.lit(0.0))
    return wpm, F.when(wpm < low, "slow").when(wpm > high, "fast").otherwise("ok")


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def fidelity(bad: Column, ratio: Column, cropped: list[Column], least: float = 0.985) -> Column:
    """A text is faithful if it holds no bad pattern, is alike enough, and both sides begin at the anchor."""
    out = (F.size(bad) == 0) & (ratio >= least)
    for c in cropped:
        out = out & c
    return out
