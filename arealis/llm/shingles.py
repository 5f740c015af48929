"""Word shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import re

import numpy as np

from arealis.llm.common import per_worker

WIDTH = 5
# bytes read at a time
STRETCH = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def _hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    import xxhash

    known = per_worker("words", dict)
    try:
        found = [known[w] for w in words]
    except KeyError:
        if len(known) > 500_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        found = [known[w] for w in words]
    return np.array(found, np.uint64)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_stretches(text: str, carry: int, lower: bool = True):
    """The hashes of the text's words in stretches; each but the first begins with the
    ``carry`` words before it. Words are what white space \\x20 \\x09-\\x0D parts; A-Z
    count as a-z."""
    content = text.encode().lower() if lower else text.encode()
    at, kept = 0, np.zeros(0, np.uint64)
    while at < len(content):
        end = len(content)
        if end - at > STRETCH and (cut := _WHITE.search(content, at + STRETCH)):
            end = cut.start()
        fresh = _hashes(content[at:end].split())
        words = np.concatenate([kept, fresh]) if len(kept) else fresh
        yield words
        kept, at = words[len(words) - min(carry, len(words)) :], end


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n].copy()
    for k in range(1, width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return scrambled(total)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingles; fewer words than ``width`` make one shingle."""
    if not text:
        return np.zeros(0, np.uint64)
    parts, words = [], np.zeros(0, np.uint64)
    for words in word_stretches(text, width - 1):
        parts.append(np.unique(runs(words, width)))
    if not any(map(len, parts)):
        return scrambled(runs(words, len(words)) + np.uint64(len(words))) if len(words) else words
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
