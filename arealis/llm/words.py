"""Splitting text into chunks whose tokens do not depend on their neighbours, with a
bounded cache of encoded chunks.

A batch of texts is split and its distinct chunks are found by Arrow; each is looked up
or encoded once, the missing ones in one call, and the ids of all texts are put together
from them.

The byte-level pattern never joins what a single space between two non-space
characters parts, but for that space, which opens the next token. So a text is cut
at such spaces and the token ids of each chunk are worked out once per worker. The
cache only saves work: a chunk that fell out of it is encoded again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

# entries of a generation; two generations are kept
CACHE = 300_000
# longer chunks are encoded each time
LONGEST = 48

_OTHER = re.compile(r"[^\S \n]")
_SINGLE = re.compile(r" (?=\S)(?<=\S )")


# texts of a batch that are encoded together
TOGETHER = 1 << 20


def single_spaced(text: str) -> bool:
    """Whether every space stands between two characters that are no white space."""
    return not ("  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or _OTHER.search(text))


def chunks(text: str) -> list[str]:
    """Pieces of ``text``; each but the first stands for a space and itself."""
    return text.split(" ") if single_spaced(text) else _SINGLE.split(text)


def together(column, most: int = TOGETHER) -> Iterator[tuple[int, list[str]]]:
    """The texts of a batch in runs of about ``most`` characters, nulls as empty texts,
    each with the place of its first."""
    first, run, size = 0, [], 0
    for at, value in enumerate(column):
        text = value.as_py() or ""
        if run and size + len(text) > most:
            yield first, run
            first, run, size = at, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def special_tokens(path: str) -> dict[str, int]:
    """Texts that the tokenizer file turns into one id wherever they occur."""
    with open(path, encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}


class ChunkEncoder:
    """Encodes texts through ``encode``, which turns a list of pieces (with their
    leading space), none of them next to white space, into a list of values. The
    values of a text's chunks come back in order; a special token's value is
    ``special(id)``."""

    def __init__(self, encode: Callable[[list[str]], Iterable], specials: dict[str, int], special: Callable[[int], object], cache: int = CACHE):
        self.encode, self.new, self.old, self.cache = encode, {}, {}, cache
        self.specials = {text: special(at) for text, at in specials.items()}
        parts = sorted(map(re.escape, specials), key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(parts) + ")") if parts else None

    def _plain(self, text: str) -> list:
        first, *rest = chunks(text)
        head = list(self.encode([first])) if first else []
        tail = list(self.encode([" " + rest.pop()])) if rest and rest[-1][-1].isspace() else []
        try:
            return head + list(map(self.new.__getitem__, rest)) + tail
        except KeyError:
            pass
        if len(self.new) > self.cache:
            self.new, self.old = {}, self.new
        once = {}
        missing = []
        for chunk in set(rest).difference(self.new):
            if chunk in self.old:
                self.new[chunk] = self.old[chunk]
            else:
                missing.append(chunk)
        for chunk, value in zip(missing, self.encode([" " + chunk for chunk in missing]), strict=True):
            (self.new if len(chunk) <= LONGEST else once)[chunk] = value
        if once:
            return head + [once[c] if c in once else self.new[c] for c in rest] + tail
        return head + list(map(self.new.__getitem__, rest)) + tail

    def _looked_up(self, wanted: list[str]) -> Iterator[bytes]:
        """Values of distinct chunks."""
        if len(self.new) > self.cache:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        found = list(map(new.get, wanted))
        missing = []
        for at in [at for at, value in enumerate(found) if value is None]:
            value = found[at] = old.get(wanted[at])
            if value is None:
                missing.append(at)
            else:
                new[wanted[at]] = value
        for at, value in zip(missing, self.encode([" " + wanted[at] for at in missing]), strict=True):
            found[at] = value
            if len(wanted[at]) <= LONGEST:
                new[wanted[at]] = value
        return found

    def batch(self, texts: list[str], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's begin, with the end.
        Values have to be the bytes of ids of this kind."""
        import pyarrow as pa
        import pyarrow.compute as pc

        plain = np.array([bool(t) and not (self.parts and self.parts.search(t)) and single_spaced(t) for t in texts], bool)
        split = pc.split_pattern(pa.array([t for t, p in zip(texts, plain) if p], pa.string()), " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(zero_copy_only=False).copy(), coded.dictionary
        # first chunks have no space before them, a last one may end in white space
        alone = ends[:-1].tolist() + [e - 1 for f, e, t in zip(ends[:-1].tolist(), ends[1:].tolist(), (t for t, p in zip(texts, plain) if p)) if e - f > 1 and t[-1].isspace()]
        heads = len(ends) - 1
        apart = [next(iter(self.encode([("" if k < heads else " ") + words[int(codes[at])].as_py()]))) for k, at in enumerate(alone)]
        codes[alone] = len(words) + np.arange(len(alone))
        met = np.zeros(len(words) + len(alone), bool)
        met[codes] = True
        used = np.flatnonzero(met[: len(words)])
        others = [b"".join(self.values(t)) for t, p in zip(texts, plain) if not p]
        values = [*self._looked_up(words.take(pa.array(used)).to_pylist()), *apart, *others]
        place = np.empty(len(words) + len(alone), np.int32)
        place[used] = np.arange(len(used))
        place[len(words) :] = len(used) + np.arange(len(alone))

        count = np.ones(len(texts), np.int64)
        count[plain] = np.diff(ends)
        of_plain = np.repeat(plain, count)
        unit = np.empty(len(of_plain), np.int32)
        unit[of_plain] = place[codes]
        unit[~of_plain] = len(used) + len(alone) + np.arange(len(others))
        stock = np.frombuffer(b"".join(values), kind)
        sizes = np.array([len(v) for v in values], np.int64) // kind.itemsize
        starts = np.cumsum(sizes) - sizes
        size = sizes[unit]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        small = np.int32 if max(total, len(stock)) < 1 << 31 else np.int64
        ids = stock[np.arange(total, dtype=small) + np.repeat((starts[unit] - (upto - size)).astype(small), size)]
        return ids, np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(count)])]

    def values(self, text: str) -> list:
        if not text:
            return []
        if self.parts is None or not self.parts.search(text):
            return self._plain(text)
        found = []
        for part in self.parts.split(text):
            found += [self.specials[part]] if part in self.specials else self._plain(part) if part else []
        return found
