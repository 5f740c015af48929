"""Token-id shards with a minimal perfect hash index.

Documents are range-partitioned by identifier; each partition encodes its texts in
order and writes one shard file: the raw ids (2 bytes each if the vocabulary allows,
else 4, little endian), then the documents' identifiers, a flag for null ones, their
id offsets, a JSON footer and its length. The index spreads distinct identifiers by
hash over files of bounded size; each holds levels of bits in which every key of the
file owns one bit (keys that meet on a bit go on to the next level), so a key's rank
among the set bits is a minimal perfect hash. A slot stores a 32-bit fingerprint, the
global number of the document and how many documents share the identifier. A lookup
hashes, tests a bit per level, and compares fingerprints: constant time, no keys kept.

Files go to one fresh folder below spark.checkpoint.dir (or one given) under a name of
their own and are renamed when whole, so a task that runs again leaves the same file.

Defined cases: a null text is empty, a null identifier sorts first and is found as the
key null; repeated identifiers are ordered by text and all found under their key; a
document without tokens has the end id alone; an empty table gives no document;
extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.bpe import tokenizer_path
from arealis.llm.common import documents, per_worker, scratch_path, stored
from arealis.llm.exact_dedup import located
from arealis.llm.words import ChunkEncoder, special_tokens, together
from arealis.session import estimated_bytes

END_ID = 2
MAGIC = b"IDSHARD1"
SHARD_BYTES = 128 << 20
TOGETHER = 2 << 20  # characters encoded at a time
KEYS_PER_FILE = 50_000
GAMMA = 2.0


# --- files ------------------------------------------------------------------------------------


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_whole(uri: str, chunks) -> None:
    """Write the parts under a name of this attempt, then rename."""
    files, path = filesystem(uri)
    attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
    draft = f"{path}.{attempt}.part"
    with files.open_output_stream(draft) as out:
        for chunk in chunks:
            out.write(chunk)
    files.move(draft, path)


class Shard:
    """Reader of one shard file."""

    def __init__(self, uri: str):
        files, path = filesystem(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        length = int.from_bytes(tail[:8], "little")
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is no shard")
        self.meta = json.loads(self.file.read_at(length, size - 16 - length))
        n, at = self.meta["docs"], self.meta["ids_bytes"]
        self.keys = np.frombuffer(self.file.read_at(8 * n, at), "<i8")
        self.null = np.frombuffer(self.file.read_at(n, at + 8 * n), np.uint8).astype(bool)
        self.offsets = np.frombuffer(self.file.read_at(8 * (n + 1), at + 9 * n), "<i8")
        self.kind = np.dtype(self.meta["kind"])

    def ids(self, row: int) -> np.ndarray:
        lo, hi = int(self.offsets[row]), int(self.offsets[row + 1])
        return np.frombuffer(self.file.read_at((hi - lo) * self.kind.itemsize, lo * self.kind.itemsize), self.kind)


# --- encoding ---------------------------------------------------------------------------------


class LibraryEncoder:
    """Whole texts to ids with the tokenizers library, chunk by chunk. Many chunks go
    through the library as one text; the ids are told apart by the bytes they cover."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, at in vocab.items():
            self.sizes[at] = len(token)
        self.kind = np.dtype("<u2" if len(self.sizes) <= 1 << 16 else "<u4")
        self.encoder = ChunkEncoder(self._encode, special_tokens(path), lambda at: np.array([at], self.kind).tobytes())

    def _encode(self, texts: list[str]) -> list[bytes]:
        import pyarrow as pa
        import pyarrow.compute as pc

        # the form for batches works out no places in the text
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(ends, np.cumsum(pc.binary_length(pa.array(texts, pa.string())).to_numpy().astype(np.int64)), "right").tolist()
        width, packed, at, found = self.kind.itemsize, ids.astype(self.kind).tobytes(), 0, []
        for cut in cuts:
            found.append(packed[at * width : cut * width])
            at = cut
        return found


def write_shards(docs: DataFrame, folder: str, path: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Write the shards; one row per document: shard, row, key, n_tokens."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    shards = shards or max(2 * cores, -(-estimated_bytes(docs) // SHARD_BYTES))
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    rows = rows.repartitionByRange(shards, F.col("key").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")

    def run(batches):
        import pyarrow as pa

        encoder = per_worker(("library", path), lambda: LibraryEncoder(path))
        shard = TaskContext.get().partitionId()
        end = np.array([end_id], encoder.kind).tobytes()
        keys, nulls, lengths, out = [], [], [], []

        def parts():
            for batch in batches:
                first = len(keys)
                keys.extend(batch.column(0).fill_null(0).to_pylist())
                nulls.extend(batch.column(0).is_null().to_pylist())
                for _, texts in together(batch.column(1), TOGETHER):
                    ids, ends = encoder.encoder.batch(texts, encoder.kind)
                    # the end id goes in after each text
                    yield np.insert(ids, ends[1:], end_id).astype(encoder.kind).tobytes()
                    lengths.extend((np.diff(ends) + 1).tolist())
                n = len(keys) - first
                out.append(pa.RecordBatch.from_pydict({"shard": pa.array([shard] * n, pa.int64()), "row": pa.array(range(first, len(keys)), pa.int64()), "key": batch.column(0), "n_tokens": pa.array(lengths[first:], pa.int64())}))
            offsets = np.concatenate([[0], np.cumsum(np.array(lengths, "<i8"))]).astype("<i8")
            yield np.array(keys, "<i8").tobytes()
            yield np.array(nulls, np.uint8).tobytes()
            yield offsets.tobytes()
            meta = {"docs": len(keys), "ids": int(offsets[-1]), "ids_bytes": int(offsets[-1]) * len(end), "kind": encoder.kind.str, "end_id": end_id}
            foot = json.dumps(meta).encode()
            yield foot + len(foot).to_bytes(8, "little") + MAGIC

        write_whole(f"{folder}/shard-{shard:06d}.ids", parts())
        yield from out

    return rows.mapInArrow(run, "shard long, row long, key long, n_tokens long")


# --- index ------------------------------------------------------------------------------------


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A one-to-one scrambling of 64-bit keys."""
    x = keys.view(np.uint64) + np.uint64((seed * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Distinct 64-bit keys to 0 .. n-1, one to one. Each level holds one bit per
    place; a key owns the first place on its way that no other waiting key shares."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())
        self.size = before

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, waiting = [], keys
        while len(waiting):
            places = max(64, int(GAMMA * len(waiting)))
            at = (mixed(waiting, len(levels)) % np.uint64(places)).astype(np.int64)
            count = np.bincount(at, minlength=places)
            levels.append(count == 1)
            waiting = waiting[count[at] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that are not in the set (others get
        any slot, which the fingerprint then refuses)."""
        found = np.full(len(keys), -1, np.int64)
        waiting = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(waiting):
                break
            at = (mixed(keys[waiting], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            found[waiting[hit]] = ranks[at[hit]]
            waiting = waiting[~hit]
        return found


def index_parts(keys: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of an index file."""
    table = PerfectHash.build(keys)
    slots = table.slots(keys)
    order = np.empty(len(keys), np.int64)
    order[slots] = np.arange(len(keys))
    meta = {"keys": len(keys), "levels": [len(x) for x in table.levels]}
    head = json.dumps(meta).encode()
    return [
        len(head).to_bytes(8, "little"),
        head,
        *[np.packbits(x).tobytes() for x in table.levels],
        fingerprints(keys)[order].tobytes(),
        numbers.astype("<i8")[order].tobytes(),
        counts.astype("<i8")[order].tobytes(),
    ]


class Index:
    """Reader of one index file."""

    def __init__(self, content: bytes):
        at = 8 + int.from_bytes(content[:8], "little")
        meta = json.loads(content[8:at])
        levels = []
        for places in meta["levels"]:
            size = -(-places // 8)
            levels.append(np.unpackbits(np.frombuffer(content[at : at + size], np.uint8))[:places].astype(bool))
            at += size
        self.hash, n = PerfectHash(levels), meta["keys"]
        self.prints = np.frombuffer(content, "<u4", n, at)
        self.numbers = np.frombuffer(content, "<i8", n, at + 4 * n)
        self.counts = np.frombuffer(content, "<i8", n, at + 12 * n)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the keys that are there, their first document and how many."""
        slots = self.hash.slots(keys)
        there = np.flatnonzero(slots >= 0)
        there = there[self.prints[slots[there]] == fingerprints(keys[there])]
        return there, self.numbers[slots[there]], self.counts[slots[there]]


class TokenStore:
    """The written shards and their index. ``shards`` has one row per shard: shard,
    docs_before, ids_before, docs, nulls."""

    def __init__(self, spark, folder: str, shards: DataFrame, files: int):
        self.spark, self.folder, self.shards, self.files = spark, folder, shards, files

    def locate(self, keys: DataFrame) -> DataFrame:
        """``keys`` (key) to one row per document found: key, shard, row. Keys that are
        not indexed give no row."""
        folder, files = self.folder, self.files
        kept = [(r["shard"], r["docs_before"], r["docs"], r["nulls"]) for r in self.shards.orderBy("shard").select("shard", "docs_before", "docs", "nulls").collect()]
        names, starts = np.array([k[0] for k in kept]), np.array([k[1] for k in kept])

        def run(batches):
            import pyarrow as pa

            opened = None, None
            for batch in batches:
                part, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                cuts = np.flatnonzero(np.diff(part)) + 1
                for lo, hi in zip([0, *cuts], [*cuts, len(part)], strict=True):
                    if hi == lo:
                        continue
                    if opened[0] != part[lo]:
                        reader, path = filesystem(f"{folder}/index-{part[lo]:06d}.mph")
                        opened = part[lo], Index(reader.open_input_file(path).read())
                    there, number, count = opened[1].find(key[lo:hi])
                    each = np.repeat(key[lo:hi][there], count)
                    number = np.repeat(number - (np.cumsum(count) - count), count) + np.arange(count.sum())
                    shard = np.searchsorted(starts, number, "right") - 1
                    yield pa.RecordBatch.from_pydict({"key": pa.array(each, pa.int64()), "shard": pa.array(names[shard], pa.int64()), "row": pa.array(number - starts[shard], pa.int64())})

        asked = keys.select("key").where("key is not null").distinct().select(file_of("key", files).alias("part"), "key")
        found = asked.repartition("part").sortWithinPartitions("part").mapInArrow(run, "key long, shard long, row long")
        if keys.where("key is null").isEmpty():
            return found
        nulls = self.shards.where("nulls > 0").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nulls") - 1)).alias("row"))
        return found.unionByName(nulls.select(F.lit(None).cast("long").alias("key"), "shard", "row"))

    def read(self, keys: DataFrame, ids: bool = False) -> DataFrame:
        """Keyed access: doc_id, start (ids of all documents before it), n_tokens,
        ids_crc32 and, if asked for, the ids."""
        folder = self.folder
        before = {r["shard"]: r["ids_before"] for r in self.shards.select("shard", "ids_before").collect()}

        def run(batches):
            import pyarrow as pa

            opened = None, None
            for batch in batches:
                rows = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
                for key, name, row in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    if opened[0] != name:
                        opened = name, Shard(f"{folder}/shard-{name:06d}.ids")
                    shard = opened[1]
                    if (None if shard.null[row] else int(shard.keys[row])) != key:
                        continue  # a key that is not stored met another's fingerprint
                    found = shard.ids(row)
                    rows["doc_id"].append(key)
                    rows["start"].append(before[name] + int(shard.offsets[row]))
                    rows["n_tokens"].append(len(found))
                    rows["ids_crc32"].append(zlib.crc32(found.astype("<u4").tobytes()))
                    if ids:
                        rows["ids"].append(found.astype(np.int32))
                yield pa.RecordBatch.from_pydict({k: v if k == "ids" else pa.array(v, pa.int64()) for k, v in rows.items() if ids or k != "ids"})

        located = self.locate(keys).repartition("shard").sortWithinPartitions("shard", "row")
        return located.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else ""))


def file_of(key: str, files: int):
    return F.pmod(F.xxhash64(key), F.lit(files).cast("long"))


def build(docs: DataFrame, path: str | None = None, folder: str | None = None, text: str = "text", key: str = "doc_id", end_id: int = END_ID) -> TokenStore:
    """Encode, write the shards, index them."""
    from pyspark.sql import Window

    spark, docs = docs.sparkSession, located(docs)  # files tell their size
    folder = folder or scratch_path(spark, "tokens")
    path = path or tokenizer_path()
    files, root = filesystem(folder)
    files.create_dir(root, recursive=True)
    entries = stored(write_shards(docs, folder, path, text, key, end_id), "entries")
    totals = entries.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("ids"), F.count_if(F.col("key").isNull()).alias("nulls"))
    # one row per shard, however many documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", "docs", "nulls", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("ids_before"))
    shards = stored(shards, "shards")
    count = -(-max(1, shards.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]) // KEYS_PER_FILE)

    def run(batches):
        import pyarrow as pa

        open_part, held = None, []

        def finish():
            columns = [np.concatenate([h[i] for h in held]) for i in range(3)]
            write_whole(f"{folder}/index-{open_part:06d}.mph", index_parts(*columns))
            return pa.RecordBatch.from_pydict({"part": pa.array([open_part], pa.int64()), "keys": pa.array([len(columns[0])], pa.int64())})

        for batch in batches:
            part, *columns = (batch.column(i).to_numpy() for i in range(4))
            cuts = np.flatnonzero(np.diff(part)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(part)], strict=True):
                if hi == lo:
                    continue
                if held and open_part != part[lo]:
                    yield finish()
                    held.clear()
                open_part = int(part[lo])
                held.append([c[lo:hi] for c in columns])
        if held:
            yield finish()

    numbered = entries.join(shards.select("shard", "docs_before"), "shard").where("key is not null")
    keyed = numbered.groupBy("key").agg(F.min(F.col("docs_before") + F.col("row")).alias("number"), F.count("*").alias("times"))
    keyed = keyed.select(file_of("key", count).alias("part"), "key", "number", "times")
    stored(keyed.repartition("part").sortWithinPartitions("part").mapInArrow(run, "part long, keys long"), "index")
    return TokenStore(spark, folder, shards, count)


def op4_token_index(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return build(docs).read(docs.select(F.col("doc_id").alias("key")))
