"""Spans found in texts, and their digests as the contract writes them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from typing import NamedTuple


class Span(NamedTuple):
    """Code points ``start`` to ``end``, end exclusive."""

    kind: str
    start: int
    end: int


def ordered(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    """By start, then by kind as listed."""
    rank = {kind: i for i, kind in enumerate(kinds)}
    return sorted(set(spans), key=lambda s: (s.start, rank[s.kind], s.end))


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
