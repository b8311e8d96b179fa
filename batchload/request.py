"""The job request: what to cut into batches, and how."""

from __future__ import annotations

from dataclasses import dataclass


def is_blank(text: str | None) -> bool:
    return text is None or not text.strip()


@dataclass(frozen=True)
class BatchRequest:
    """One load job. Bounds and the partition list are texts in the caller's date pattern.

    `partitions` is a comma list; an entry is a partition name, or `name:start-end` for windows
    inside that partition. With both bounds given the partitions are ignored.
    """

    name: str
    pattern: str
    start: str | None = None
    end: str | None = None
    interval_seconds: int | None = None
    partitions: str | None = None
    select: str | None = None
    n_columns: int | None = None
    batchsize: int = 1000
    fetchsize: int = 1000
    parallelism: int | None = None
    num_slices: int | None = None
    clamp_end: bool = False

    @property
    def has_start(self) -> bool:
        return not is_blank(self.start)

    @property
    def has_end(self) -> bool:
        return not is_blank(self.end)

    @property
    def has_partitions(self) -> bool:
        return not is_blank(self.partitions)

    @property
    def slices(self) -> int | None:
        """Number of scan slices: as asked for, else one per parallel task; None leaves it to the
        session."""
        return self.num_slices or self.parallelism

    def validate(self) -> "BatchRequest":
        """Checks that need no parsing of times; `plans.build` does the rest."""
        if is_blank(self.name):
            raise ValueError("name is required")
        if is_blank(self.pattern):
            raise ValueError("pattern is required")
        if not (self.has_start or self.has_end or self.has_partitions):
            raise ValueError("give a start, an end or partitions")
        if self.interval_seconds is not None and self.interval_seconds <= 0:
            raise ValueError("interval_seconds must be positive")
        for field in ("batchsize", "fetchsize", "parallelism"):
            if getattr(self, field) is not None and getattr(self, field) < 1:
                raise ValueError(f"{field} must be positive")
        if self.n_columns is not None and self.n_columns < 1:
            raise ValueError("n_columns must be positive")
        if self.num_slices is not None and self.num_slices < (self.parallelism or 1):
            raise ValueError("num_slices must not be below parallelism")
        return self
