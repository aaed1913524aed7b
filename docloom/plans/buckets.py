"""Buckets: ranges that tile the unsigned 64-bit row ids, so partitions and requests of a view scan are even."""

from __future__ import annotations

from dataclasses import dataclass

LARGEST = (1 << 64) - 1


@dataclass(frozen=True)
class Bucket:
    lower: int
    upper: int


@dataclass(frozen=True)
class Partition:
    buckets: tuple[Bucket, ...]

    def merged(self) -> Partition:
        """One bucket over the whole range, for one request a partition."""
        return Partition((Bucket(self.buckets[0].lower, self.buckets[-1].upper),))


def plan(partitions: int, batch_size: int, row_count: int) -> list[Partition]:
    """Partitions of buckets with about ``batch_size`` rows each; 0 means one bucket a partition. No rows: no partitions."""
    if row_count <= 0:
        return []
    partitions = max(1, min(partitions, row_count))
    each = 1 if batch_size <= 0 else max(1, -(-(-(-row_count // partitions)) // batch_size))
    edges = [(LARGEST + 1) * i // (partitions * each) for i in range(partitions * each + 1)]
    buckets = [Bucket(a, b - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [Partition(tuple(buckets[p * each : (p + 1) * each])) for p in range(partitions)]
