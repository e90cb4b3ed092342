"""Token ids of whole texts through a bounded cache of space-separated chunks.

The split pattern of byte-level BPE lets a token hold a space at its start only, or be a run of
white space. So a text may be cut before every space that is followed by a non-space or preceded
by one, and the chunks be encoded apart. Texts with a space inside a longer run of white space
are split by the pattern as a whole instead.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

INSIDE_RUN = re.compile(r"\s (?=\s|\Z)")
#: Chunks kept between texts in one worker, about 200 bytes each; a fuller cache starts anew.
KEPT_CHUNKS = 600_000
#: Longer chunks are encoded but not kept.
KEPT_LENGTH = 64

#: Marks that often follow a word.
MARKS = ".,"


class ChunkEncoder:
    """``encode(list of texts) -> list of bytes`` gives little-endian 32-bit ids of each text."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self.encode = encode
        self.cache: dict[str, bytes] = {}
        self.marks = dict(zip(MARKS, encode(list(MARKS)), strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        get = self.cache.get
        cut: list[tuple[list[str], list[bytes | None], list[int]] | None] = []
        missing: dict[str, None] = {}
        for text in texts:
            if not text or "\x00" in text or INSIDE_RUN.search(text):
                cut.append(None)
                continue
            chunks = text.split(" ")
            # keys are what follows a space; a text's head follows none and carries a mark instead
            if chunks[0]:
                chunks[0] = "\x00" + chunks[0]
            else:
                del chunks[0]
            found = list(map(get, chunks))
            gaps, at = [], -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                gaps.append(at)
                missing[chunks[at]] = None
            cut.append((chunks, found, gaps))
        fresh = self._encode_missing(missing)
        whole = iter(self.encode([t for t, c in zip(texts, cut, strict=True) if c is None and t]))
        out = []
        for text, own in zip(texts, cut, strict=True):
            if own is None:
                out.append(next(whole) if text else b"")
                continue
            chunks, found, gaps = own
            for at in gaps:
                found[at] = fresh[chunks[at]]
            out.append(b"".join(found))
        if len(self.cache) + len(fresh) > KEPT_CHUNKS:
            self.cache.clear()
        self.cache.update(fresh)
        for chunk in [c for c in fresh if len(c) > KEPT_LENGTH]:
            del self.cache[chunk]
        return out

    def _encode_missing(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """A word and the mark behind it never share a token, so its letters are encoded once for all marks."""
        wanted: dict[str, None] = {}
        marked = []
        for chunk in chunks:
            if chunk[-1:] in self.marks and (word := chunk[:-1]).isalpha():
                marked.append((chunk, word))
                if word not in self.cache:
                    wanted[word] = None
            else:
                wanted[chunk] = None
        out = dict(zip(wanted, self.encode([_text(c) for c in wanted]), strict=True))
        for chunk, word in marked:
            out[chunk] = (out.get(word) or self.cache[word]) + self.marks[chunk[-1]]
        return out


def _text(chunk: str) -> str:
    return chunk[1:] if chunk[:1] == "\x00" else " " + chunk
