"""Exact byte pair encoding in linear time by backtracking over longest matches.

An Aho-Corasick automaton over the vocabulary finds, in one pass, the longest token
that starts at each byte of a piece. The encoder takes the longest token, asks a
table whether it may follow the token before it in a merged sequence, tries its
next shorter prefix token if not, and steps back when none is left; a bit per byte
keeps it from entering the same dead end twice. A pair is compatible if undoing the
merges of both tokens, latest first, never uncovers an earlier merge across their
border. Decoding looks each id up in a table of offsets into the vocabulary's bytes.

Defined cases: null and empty texts have no ids and decode to an empty text; special
tokens in a text become their id; pieces of any length are encoded whole; repeated
rows give the same row each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import numpy as np
from pyspark.sql import DataFrame

from arealis.llm.common import documents, per_worker
from arealis.llm.words import ChunkEncoder, special_tokens, together

FILE = "byte_bpe_50k.json"


def tokenizer_path(name: str = FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable bytes
    stand for themselves, the others follow from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tables made from a vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        alphabet, vocab = byte_alphabet(), given["model"]["vocab"]
        raw = {token: bytes(alphabet[c] for c in token) for token in vocab if all(c in alphabet for c in token)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in given["model"]["merges"]]
        # a token's rank: bytes first, then in the order of the merges that make it
        self.rank_of, self.ids, self.split, self.pairs = {}, [], [], {}
        for char in sorted(alphabet, key=alphabet.get):
            self._add(char, vocab[char], None)
        for left, right in merges:
            pair = self.rank_of[left], self.rank_of[right]
            if left + right not in self.rank_of:
                self._add(left + right, vocab[left + right], pair)
            self.pairs.setdefault(pair, self.rank_of[left + right])
        tokens = list(self.rank_of)  # one character per byte
        self.lengths = [len(t) for t in tokens]
        self.automaton = ahocorasick.Automaton()
        for rank, token in enumerate(tokens):
            self.automaton.add_word(token, rank)
        self.automaton.make_automaton()
        where = {token: rank for rank, token in enumerate(tokens)}
        self.shorter = [next((where[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in where), -1) for t in tokens]
        self.compatible: dict[int, bool] = {}  # by left << 20 | right
        # special tokens are not in the alphabet of bytes; they decode to their own text
        content = {at: raw.get(t, t.encode()) for t, at in vocab.items()} | {x["id"]: x["content"].encode() for x in given["added_tokens"]}
        ordered = [content.get(i, b"") for i in range(max(content) + 1)]
        self.sizes = np.array([len(b) for b in ordered], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.content = np.frombuffer(b"".join(ordered), np.uint8)
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.known: dict[str, list[int]] = {}

    def _add(self, token: str, at: int, pair):
        rank = len(self.ids)
        self.rank_of[token] = rank
        self.ids.append(at)
        self.split.append(pair or (rank, rank))

    def _may_follow(self, left: int, right: int) -> bool:
        """Undo the later of the two merges in turn. ``limit``: merges from this rank on
        would have come after the one just undone."""
        split, limit = self.split, len(self.ids)
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            part_left, part_right = split[left][1], split[right][0]
            left_first = left > right
            if left_first and part_left == left or not left_first and part_right == right:
                left_first = not left_first  # a byte has no merge to undo
                if (part_left == left) if left_first else (part_right == right):
                    return True
            if left_first:
                limit, left = left, part_left
            else:
                limit, right = right + 1, part_right

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one pre-tokenised piece, given in the alphabet of bytes."""
        size, lengths, shorter, compatible = len(piece), self.lengths, self.shorter, self.compatible
        longest, reach = [0] * size, [0] * size
        for end, rank in self.automaton.iter(piece):
            length = lengths[rank]
            start = end + 1 - length
            if length > reach[start]:
                longest[start], reach[start] = rank, length
        open_at = bytearray(b"\1") * (size + 1)
        ranks: list[int] = []
        at, last, token = 0, -1, longest[0] if size else 0
        while at < size:
            while token >= 0:
                end = at + lengths[token]
                if open_at[end]:
                    fits = last < 0 or compatible.get(last << 20 | token)
                    if fits is None:
                        fits = compatible[last << 20 | token] = self._may_follow(last, token)
                    if fits:
                        ranks.append(token)
                        at, last = end, token
                        if at < size:
                            token = longest[at]
                        break
                token = shorter[token]
            else:
                open_at[at] = 0
                token = ranks.pop()
                at -= lengths[token]
                last = ranks[-1] if ranks else -1
        return [self.ids[r] for r in ranks]

    def encode_chunks(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that the pattern keeps apart, all pre-tokenised in one go."""
        if len(self.compatible) > 400_000:
            self.compatible.clear()
        if len(self.known) > 200_000:
            self.known.clear()
        known, found = self.known, []
        pieces = iter(self.pieces("".join(texts)))
        for text in texts:
            left, ids = len(text.encode()), []
            while left:
                piece = next(pieces)[0]
                left -= len(piece)
                got = known.get(piece)
                if got is None:
                    got = self.encode_piece(piece)
                    if len(piece) <= 48:
                        known[piece] = got
                ids += got
            found.append(ids)
        return found

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return ""
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.content[at].tobytes().decode("utf-8", "replace")


class Codec:
    """Whole texts to ids and back, with the chunk cache."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.kind = np.dtype(np.uint16 if len(self.vocabulary.sizes) <= 1 << 16 else np.uint32)
        code = "H" if self.kind.itemsize == 2 else "I"
        packed = lambda ids: array(code, ids).tobytes()
        self.encoder = ChunkEncoder(lambda texts: map(packed, self.vocabulary.encode_chunks(texts)), special_tokens(path), lambda at: packed([at]), CACHE)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.encoder.values(text)), self.kind)

    def batch(self, texts: list[str]) -> tuple[list[np.ndarray], list[bytes]]:
        """The ids of each text, and the same in decimal joined by commas."""
        import pyarrow as pa
        import pyarrow.compute as pc

        ids, ends = self.encoder.batch(texts, self.kind)
        decimal = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids).cast(pa.string())), ",")
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], [d.as_buffer() for d in decimal]


def codec(path: str) -> Codec:
    return per_worker(("codec", path), lambda: Codec(path))


# chunks that a worker keeps, beside the tables of the vocabulary
CACHE = 150_000
# decoding works on this many ids at a time, so a long text needs little more than itself
STRETCH = 1_000_000


def round_trip(docs: DataFrame, path: str | None = None, text: str = "text", key: str = "doc_id", texts: bool = False) -> DataFrame:
    """Encode and decode each text: doc_id, n_tokens, ids_sha256, decoded_sha256, and
    with ``texts`` also ids (array) and decoded. About a MB of texts goes out at a time."""
    path = path or tokenizer_path()

    def run(batches):
        import pyarrow as pa

        own = codec(path)
        for batch, first, given in ((b, first, given) for b in batches for first, given in together(b.column(1))):
            all_ids, decimals = own.batch(given)
            rows = {"doc_id": batch.column(0).slice(first, len(given)), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
            for ids, decimal in zip(all_ids, decimals, strict=True):
                decoded = own.vocabulary.decode(ids) if len(ids) <= STRETCH else _long(own, ids)
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(decimal).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if texts:
                    rows["ids"].append(ids.astype(np.int32))
                    rows["decoded"].append(decoded)
            rows = {k: pa.array(v, pa.int64()) if k == "n_tokens" else v for k, v in rows.items() if texts or k not in ("ids", "decoded")}
            yield pa.RecordBatch.from_pydict(rows)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if texts else "")
    return docs.select(docs[key].cast("long"), docs[text]).mapInArrow(run, schema)


def _long(own: Codec, ids: np.ndarray) -> str:
    """As decode(), in stretches that end where a character does."""
    v, parts, at = own.vocabulary, [], 0
    while at < len(ids):
        end = min(len(ids), at + STRETCH)
        while end < len(ids) and (v.sizes[ids[end]] == 0 or 0x80 <= v.content[v.starts[ids[end]]] < 0xC0):
            end += 1
        parts.append(v.decode(ids[at:end]))
        at = end
    return "".join(parts)


def op9_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))
