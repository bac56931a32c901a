"""Encoding whole texts chunk by chunk, so that every chunk that comes again is looked up.

A byte-level tokenizer first cuts a text into words, each with the one space before it. A space that a
visible character follows therefore always begins a word, whatever stands before it, and a text may be cut
there: the ids of the chunks, one after the other, are the ids of the text. Chunks recur far more often than
texts, and the chunks of a batch that have not been seen are encoded together.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

# A space between two blanks, or between a blank and the end, does not begin a word.
LOOSE_SPACE = re.compile(r"\s (?:\s|\Z)|^ (?:\s|\Z)")
WORD_SPACE = re.compile(r" (?=\S)")


def special_tokens(path: str) -> dict[str, int]:
    """The texts that the tokenizer of this file takes out of a text before cutting it into words."""
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file).get("added_tokens", [])}


def chunks_of(text: str) -> list[str]:
    """The text in chunks, cut before spaces that begin a word."""
    parts = WORD_SPACE.split(text) if LOOSE_SPACE.search(text) else text.split(" ")
    return [parts[0], *[" " + p for p in parts[1:]]]


class Recent(dict):
    """The values of recently used keys, computed together by ``compute`` when first asked for.

    There are two generations of at most ``size`` keys. When the younger one is full it becomes the older one,
    whose keys move up again when they are used; so frequent keys stay and memory is bounded.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], size: int):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def load(self, missing: set[str], used: Iterable[Iterable[str]] = ()) -> None:
        """Add the keys that are ``missing``. All of these and of the ``used`` are here until the next call."""
        if len(self) + len(missing) > self.size:
            kept = {k: self[k] for keys in used for k in keys if k in self}
            self.older = dict(self)
            self.clear()
            self.update(kept)
        older = self.older
        self.update({k: older[k] for k in missing if k in older})
        new = [k for k in missing if k not in self]
        self.update(zip(new, self.compute(new), strict=True))


class ChunkCache:
    """What ``encode`` makes of chunks, remembered. ``encode`` gets distinct chunks that hold no special token
    and gives a value for each; ``special`` has the values of the special tokens. ``chunks`` cuts a text."""

    def __init__(
        self,
        encode: Callable[[list[str]], Iterable],
        special: dict[str, object],
        size: int = 150_000,
        chunks: Callable[[str], list[str]] = chunks_of,
    ):
        self.special, self.chunks = special, chunks
        self.known = Recent(encode, size)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def parts(self, text: str) -> list[str]:
        """The chunks and special tokens of a text, in order."""
        if self.cut is None or not self.cut.search(text):
            return self.chunks(text)
        parts = self.cut.split(text)  # every other one is a special token
        return [c for i, part in enumerate(parts) for c in ([part] if i % 2 else self.chunks(part) if part else [])]

    def values(self, texts: Iterable[str], at_once: int = 4_000_000) -> Iterator[list]:
        """For each text the values of its chunks and special tokens, in order. The unknown chunks of about
        ``at_once`` letters of text are encoded together."""
        group: list[list[str]] = []
        letters = 0
        for text in texts:
            group.append(self.parts(text))
            letters += len(text)
            if letters >= at_once:
                yield from self.looked_up(group)
                group, letters = [], 0
        yield from self.looked_up(group)

    def looked_up(self, group: list[list[str]]) -> Iterator[list]:
        known, special = self.known, self.special
        distinct = set().union(*group)
        unknown = {c for c in distinct if c not in known}
        known.load(unknown.difference(special) if special else unknown, [distinct])
        for parts in group:
            try:
                yield list(map(known.__getitem__, parts))
            except KeyError:
                yield [known[c] if c not in special else special[c] for c in parts]
