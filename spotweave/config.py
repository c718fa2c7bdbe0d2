"""Settings of a mapping run, checked before anything is planned."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Longest barcode or molecular identifier: 2 bits a base in a signed 64-bit number.
MAX_BASES = 31


def _check(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class BarcodeSpec:
    """Where the position barcode is: ``start`` counts from 0; ``mismatch`` substitutions are tolerated."""

    length: int = 25
    start: int = 0
    read: int = 1
    mismatch: int = 0

    def __post_init__(self) -> None:
        _check(0 < self.length <= MAX_BASES, f"barcode length must be 1 to {MAX_BASES}")
        _check(self.start >= 0, "barcode start must not be negative")
        _check(self.read in (1, 2), "barcode read must be 1 or 2")
        _check(0 <= self.mismatch <= 3, "mismatch must be 0 to 3")


@dataclass(frozen=True)
class UmiSpec:
    """Where the molecular identifier is; a negative start or no length means there is none."""

    start: int = 25
    length: int = 10
    read: int = 1

    def __post_init__(self) -> None:
        _check(self.length <= MAX_BASES, f"identifier length must be at most {MAX_BASES}")
        _check(self.read in (1, 2), "identifier read must be 1 or 2")

    @property
    def enabled(self) -> bool:
        """Whether reads have an identifier."""
        return self.start >= 0 and self.length > 0


@dataclass(frozen=True)
class FixedSpec:
    """Fixed sequences whose reads are dropped: (sequence, start); a negative start is anywhere, either strand."""

    sequences: tuple[tuple[str, int], ...] = ()


@dataclass(frozen=True)
class ProteinSpec:
    """Where the protein barcode is on the second read."""

    mismatch: int = 1
    start: int = 0
    length: int = 15

    def __post_init__(self) -> None:
        _check(self.mismatch in (0, 1, 2), "protein mismatch must be 0 to 2")
        _check(0 < self.length <= MAX_BASES and self.start >= 0, "protein barcode out of range")


@dataclass(frozen=True)
class RunSpec:
    """A whole run. ``fixed_in_protein`` applies the fixed filter in protein mode too."""

    barcode: BarcodeSpec = field(default_factory=BarcodeSpec)
    umi: UmiSpec = field(default_factory=UmiSpec)
    fixed: FixedSpec = field(default_factory=FixedSpec)
    protein: ProteinSpec | None = None
    segment: int = 1
    fixed_in_protein: bool = False

    def __post_init__(self) -> None:
        _check(self.segment > 0, "segment must be positive")
        _check(self.protein is None or self.umi.enabled, "protein mode needs a molecular identifier")
