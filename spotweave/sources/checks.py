"""What a job reads and writes, checked before it is planned."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from spotweave.sources.store import listed


def _missing(path: str) -> str | None:
    try:
        found = listed(path)
    except FileNotFoundError:
        return f"no such path: {path}"
    return None if found else f"no files in {path}"


def check_job(inputs: Sequence[str], outputs: Sequence[str]) -> None:
    """Raise ``ValueError`` with everything that is wrong, if anything is.

    There must be inputs and outputs, none with an empty name; each input is a file, a folder with files or a
    pattern that some file matches; no output is named twice or is an input. Paths are those of ``store.listed``.
    """
    wrong = [f"no {kind} given" for kind, names in (("input", inputs), ("output", outputs)) if not names]
    wrong += [f"{kind} {k} has no name" for kind, names in (("input", inputs), ("output", outputs)) for k, n in enumerate(names, 1) if not n]
    wrong += [x for x in (_missing(n) for n in inputs if n) if x]
    ends = Counter(n.rstrip("/") for n in outputs if n)
    wrong += [f"output named {k} times: {n}" for n, k in ends.items() if k > 1]
    wrong += [f"output is an input: {n}" for n in ends if n in {x.rstrip("/") for x in inputs}]
    if wrong:
        raise ValueError("; ".join(wrong))


def check_mapping(first: str, second: str, mask: str, outputs: Sequence[str]) -> list[tuple[str, str]]:
    """Lanes of a mapping run from comma-separated paths of first and of second reads, checked with its mask and outputs.

    Both sides must have as many lanes. The result is what ``read_fastq_pairs`` takes.
    """
    sides = [[x.strip() for x in paths.split(",")] if paths.strip() else [] for paths in (first, second)]
    if len(sides[0]) != len(sides[1]):
        raise ValueError(f"{len(sides[0])} lanes of first reads, {len(sides[1])} of second reads")
    check_job([*sides[0], *sides[1], mask] if sides[0] else [], outputs)
    return list(zip(*sides))
