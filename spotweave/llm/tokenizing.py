"""Encoding by a public tokenizer, run of characters by run of characters.

Both kinds of tokenizer used here cut a text before a run of whitespace that follows something
else, and nothing before the cut bears on what comes after it. So a text's ids are those of its
runs, one after another, and each run is encoded once in a task. What cannot be cut so is
encoded whole.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterator
from itertools import islice

#: Characters that one side takes for whitespace and the other not: such texts are encoded whole.
_ODD = re.compile("[\x1c-\x1f᠎​﻿]")
_RUNS = re.compile(r"\s*\S+|\s+")
#: Runs kept in a task, and runs that a worker keeps between its tasks (some 40 MB).
KEPT, IDLE = 1_000_000, 200_000
#: Punctuation that ends a word; what stands before it, if letters, is encoded apart.
_TAIL = ".,!?;:#$%&*"


class Encoder:
    """Ids of texts, as little-endian 32-bit numbers; ``spaces``: whether whitespace counts in the tokenizer."""

    def __init__(self, path: str, spaces: bool) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.spaces = spaces
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        import numpy as np

        vocabulary = self.tokenizer.get_vocab()
        #: Of each id, whether it ends a word, for tokenizers that mark that.
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True

    def _raw(self, texts: list[str]) -> Iterator[bytes]:
        for x in self.encode(texts, add_special_tokens=False):
            yield array.array("I", x.ids).tobytes()

    def _learn(self, new: list[str]) -> None:
        """Add runs to those that are known."""
        if self.spaces or not self.ends.any():
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                self.known.update(zip(part, self._raw(part), strict=True))
            return
        # a word of letters and its punctuation are one token sequence each, and capitals A-Z are lowered
        whole, rest = {}, []
        for w in new:
            core = w.rstrip(_TAIL)
            # a letter whose small form is several code points brings marks, which stay with what follows
            if core.isalpha() and max(core) < "\u0250" and len(core.lower()) == len(core):
                whole[w] = (core.lower() if core.isascii() else core, w[len(core) :])
            else:
                rest.append(w)
        if len(self.parts) > KEPT:
            self.parts.clear()
        self._learn_parts({x for pair in whole.values() for x in pair if x}.difference(self.parts))
        self.parts[""] = b""
        parts = self.parts
        self.known.update((w, parts[a] + parts[b]) for w, (a, b) in whole.items())
        self.known.update(zip(rest, self._raw(rest), strict=True))

    def _learn_parts(self, new: set[str]) -> None:
        """Encode single words many at a time: each ends with the one id that ends a word."""
        import numpy as np

        order = list(new)
        lists = [order[i : i + 500] for i in range(0, len(order), 500)]
        for words, x in zip(lists, self.encode([" ".join(p) for p in lists], add_special_tokens=False), strict=True):
            ids = np.array(x.ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(words):
                self.parts.update(zip(words, self._raw(words), strict=True))
                continue
            raw, at = ids.tobytes(), 0
            for w, stop in zip(words, stops.tolist(), strict=True):
                self.parts[w] = raw[4 * at : 4 * stop]
                at = stop

    def rest(self) -> None:
        """Keep between tasks what was learnt first, which is mostly what is frequent: other operators need the memory."""
        self.known = dict(islice(self.known.items(), IDLE))
        self.parts = dict(islice(self.parts.items(), IDLE // 2))

    def runs(self, text: str) -> list[str]:
        """The runs of a text."""
        if not self.spaces:
            return text.replace("\n", " ").split(" ")
        return [text] if _ODD.search(text) else _RUNS.findall(text)

    def batch(self, texts: list[str]) -> Iterator[list[bytes]]:
        """For each text the ids of its runs. Encodes runs that aren't known, about a million characters of text at a time."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < 1_000_000:
                size += len(texts[end])
                end += 1
            cut = [self.runs(t) for t in texts[at:end]]
            at = end
            wanted = set().union(*cut)
            new = wanted.difference(self.known)
            if len(self.known) + len(new) > KEPT:  # what is used now stays
                self.known = {w: self.known[w] for w in wanted.difference(new)}
            self._learn(list(new))
            get = self.known.__getitem__
            for runs in cut:
                yield list(map(get, runs))


def encoder(path: str, spaces: bool) -> Encoder:
    """The encoder of this process: a worker keeps it, and some of the runs it knows, for its next tasks.

    Functions reach workers by value, so what a module holds would be gone with each task; a module of
    the process's own holds the encoders instead.
    """
    import sys
    import types

    held = vars(sys.modules.setdefault("spotweave_worker_encoders", types.ModuleType("spotweave_worker_encoders")))
    key = f"{path}:{spaces}"
    if key not in held:
        held[key] = Encoder(path, spaces)
    return held[key]
