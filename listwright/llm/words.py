"""Byte-level BPE by words: each distinct pre-token of a task's texts is encoded once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import regex

# Fixed values of the byte-level vocabulary: its pattern, and its end-of-text mark.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = "<|endoftext|>"

# Characters of text worked on together, and distinct words a worker remembers before it starts
# anew; neither changes results.
GROUP_CHARS = 8_000_000
REMEMBERED = 600_000

_find_any = regex.compile(PATTERN).findall
# The same pattern over ASCII, where letters may be tried first.
_find_ascii = re.compile(
    r" ?[A-Za-z]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
).findall


def find_words(text: str) -> list[str]:
    """The pre-tokens of a text that does not hold the end-of-text mark."""
    return _find_ascii(text) if text.isascii() else _find_any(text)


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes texts, remembering the words already met.

    ``encode_words`` gets distinct words in UTF-8, sorted, and returns for each its ids as
    little-endian unsigned 32-bit integers; ``end_of_text`` is the id of the mark, in that form.
    """

    def __init__(
        self, encode_words: Callable[[list[bytes]], Iterable[bytes]], end_of_text: bytes
    ) -> None:
        self.encode_words, self.end_of_text = encode_words, end_of_text
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; texts are worked on in groups of bounded size."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [[find_words(part) for part in text.split(END_OF_TEXT)] for text in texts]
        met: set[str] = set()
        for parts in split:
            met.update(*parts)
        new = sorted(word.encode() for word in met if word not in self.known)
        self.known.update(zip((word.decode() for word in new), self.encode_words(new)))
        ids = self.known.__getitem__
        for parts in split:
            yield self.end_of_text.join([b"".join(map(ids, part)) for part in parts])
