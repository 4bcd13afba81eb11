"""Token ranges of a ring: discovery, splits, groups and cover checks. Pure functions of small lists."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from .catalog import identifier
from .errors import ConfigError


@dataclass(frozen=True)
class Ring:
    """Tokens low..high, both included."""

    low: int
    high: int

    @property
    def size(self) -> int:
        return self.high - self.low + 1


FULL = Ring(-(2**63), 2**63 - 1)
#: The ring of the portable token.
PORTABLE = Ring(0, 2**60 - 1)


@dataclass(frozen=True)
class TokenRange:
    """Tokens above start, up to end. A range whose end is not above its start wraps; start = end is the whole ring."""

    start: int
    end: int
    replicas: tuple[str, ...] = ()

    @property
    def wraps(self) -> bool:
        return self.end <= self.start

    def size(self, ring: Ring = FULL) -> int:
        return self.end - self.start + (ring.size if self.wraps else 0)

    def fraction(self, ring: Ring = FULL) -> float:
        return self.size(ring) / ring.size

    def contains(self, token: int) -> bool:
        return token > self.start or token <= self.end if self.wraps else self.start < token <= self.end


def discover(tokens: dict[int, tuple[str, ...]], ring: Ring = FULL) -> list[TokenRange]:
    """Ranges between a ring's sorted tokens; the last wraps to the first. tokens: replicas by the range's first token."""
    order = sorted(tokens)
    if not order:
        raise ConfigError("a ring has one token at least")
    if order[0] < ring.low or order[-1] > ring.high:
        raise ConfigError("a token lies outside the ring")
    return [TokenRange(a, b, tokens[a]) for a, b in zip(order, [*order[1:], order[0]])]


def split(one: TokenRange, parts: int, ring: Ring = FULL) -> list[TokenRange]:
    """Equal parts of a range; the last takes the remainder. Not more parts than tokens."""
    size = one.size(ring)
    parts = max(1, min(parts, size))
    step = size // parts
    cut = [ring.low + (one.start + step * k - ring.low) % ring.size for k in range(parts)] + [one.end]
    return [TokenRange(a, b, one.replicas) for a, b in zip(cut, cut[1:])]


def split_proportionally(ranges: list[TokenRange], target: int, ring: Ring = FULL) -> list[TokenRange]:
    """About `target` parts, each range as many as its share of the ring, rounded half to even, one at least."""
    return [p for r in ranges for p in split(r, max(1, round(r.fraction(ring) * target)), ring)]


def whole(parts: int, ring: Ring = FULL) -> list[TokenRange]:
    """The ring in equal parts. The first starts after the ring's last token, and so wraps."""
    step = ring.size // parts
    cut = [ring.high, *(ring.low + step * k - 1 for k in range(1, parts)), ring.high]
    return [TokenRange(a, b) for a, b in zip(cut, cut[1:])]


def by_replicas(ranges: list[TokenRange]) -> dict[tuple[str, ...], list[TokenRange]]:
    out: dict[tuple[str, ...], list[TokenRange]] = defaultdict(list)
    for r in ranges:
        out[tuple(sorted(r.replicas))].append(r)
    return dict(out)


def covers(ranges: list[TokenRange], ring: Ring = FULL) -> bool:
    """Whether the ranges cover each token of the ring exactly once."""
    if sum(r.size(ring) for r in ranges) != ring.size:
        return False
    starts = {ring.low + (r.start - ring.low) % ring.size for r in ranges}
    return len(starts) == len(ranges) and starts == {ring.low + (r.end - ring.low) % ring.size for r in ranges}


def predicate(one: TokenRange, token: str = "token", ring: Ring = FULL) -> str:
    """SQL text of a range's test. The ring's first token belongs to a range that starts at it."""
    token, above = identifier(token), ">=" if one.start == ring.low else ">"
    return f"({token} {above} {one.start} {'OR' if one.wraps else 'AND'} {token} <= {one.end})"


def range_query(table: str, key: str, one: TokenRange, columns: list[str] | None = None, ring: Ring = FULL) -> str:
    """SQL text of a range's scan over xxhash64 tokens."""
    shown = ", ".join(identifier(c) for c in columns) if columns else "*"
    test = predicate(one, "token", ring).replace("token", f"xxhash64({identifier(key)})")
    return f"SELECT {shown} FROM {identifier(table)} WHERE {test}"
