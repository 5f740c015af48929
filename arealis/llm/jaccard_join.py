"""Exact Jaccard self-join over word shingles, and its connected components.

A set is the distinct 5-word shingles of a text; equal sets are one class. Two sets
that overlap enough share one of the first shingles of either in any common order, so
a tile is the classes that have such a shingle in common. The order puts frequent
shingles last (by counters over all documents), so a passage that very many documents
share opens no tile unless the documents consist of little else. In a tile, classes
are banded by size: only sizes within the threshold of each other can match. A pair is
tested on hashed parity bitmaps first - every bit in which they differ is a shingle
that only one of the sets has, which bounds the overlap from above - and only pairs
that pass are intersected as sorted arrays.

Links are found in two rounds, so that large groups of near copies never make all
their pairs: first every class meets the class that leads most of its tiles, then
only pairs whose components still differ are tried. No pair is left out.

Defined cases: null and empty texts and texts of white space have empty sets and link
with nothing; fewer than 5 words are one shingle of their own; null identifiers take
part but never name a component unless all are null; repeated rows are copies; extra
columns are ignored. Sets are told apart by 64-bit hashes of shingles and of sets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import components, documents, stored
from arealis.llm.exact_dedup import located
from arealis.llm.shingles import shingle_set

THRESHOLD = 80  # per cent
COUNTERS = 1 << 20  # two tables of so many counters order the shingles
SLICE = 1 << 14
COARSE = 512  # bits of the bitmaps that tiles carry


# --- the common order -------------------------------------------------------------------------


def _counters(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & np.uint64(COUNTERS - 1)).astype(np.int64), ((hashes >> np.uint64(24)) & np.uint64(COUNTERS - 1)).astype(np.int64)


def frequency_levels(texts: DataFrame) -> bytes:
    """A byte per counter: twice the logarithm of how many shingles of all texts fall
    on it. Of fixed size, whatever the input."""

    def count(batches):
        import pyarrow as pa

        tables = np.zeros((2, COUNTERS), np.int64)
        for batch in batches:
            for value in batch.column(0):
                for table, at in zip(tables, _counters(shingle_set(value.as_py())), strict=True):
                    np.add.at(table, at, 1)
        flat = np.minimum(tables.reshape(-1), 2**32 - 1).astype("<u4")
        if flat.any():
            parts = flat.reshape(-1, SLICE)
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(len(parts)), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary())})

    def add(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums.setdefault(part, np.zeros(SLICE, np.int64)).__iadd__(np.frombuffer(counts.as_py(), "<u4"))
        level = {part: np.floor(2 * np.log2(np.maximum(total, 1))).astype(np.uint8).tobytes() for part, total in sums.items()}
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(level), pa.int32()), "level": pa.array(list(level.values()), pa.binary())})

    rows = texts.mapInArrow(count, "part int, counts binary").repartition("part").mapInArrow(add, "part int, level binary").collect()
    levels = np.zeros((2 * COUNTERS // SLICE, SLICE), np.uint8)
    for row in rows:
        levels[row["part"]] = np.frombuffer(row["level"], np.uint8)
    return levels.tobytes()


# --- sets -------------------------------------------------------------------------------------


def prefix_length(size: int, threshold: int = THRESHOLD) -> int:
    return size - -(-size * threshold // 100) + 1


def parity_bits(hashes: np.ndarray) -> bytes:
    """A bitmap of at least four bits per shingle, COARSE at least and a power of two,
    in which each shingle flips one bit."""
    bits = max(COARSE, 1 << int(4 * len(hashes) - 1).bit_length())
    flips = np.bincount((hashes >> np.uint64(32)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """The same bitmap as it would be with fewer bits."""
    while len(bitmap) > size:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def may_match(a: bytes, b: bytes, size_a: int, size_b: int, threshold: int = THRESHOLD) -> bool:
    """Whether sizes and bitmaps leave room for the overlap that is needed."""
    if 100 * min(size_a, size_b) < threshold * max(size_a, size_b):
        return False
    width = min(len(a), len(b)) // 8
    x, y = folded(np.frombuffer(a, np.uint64), width), folded(np.frombuffer(b, np.uint64), width)
    apart = int(np.bitwise_count(x ^ y).sum())
    overlap = (size_a + size_b - apart) // 2
    return 100 * overlap >= threshold * (size_a + size_b - overlap)


def match(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Exact, on sorted arrays."""
    where = np.minimum(np.searchsorted(a, b), max(len(a) - 1, 0))
    overlap = int((a[where] == b).sum()) if len(a) else 0
    return 100 * overlap >= threshold * (len(a) + len(b) - overlap) > 0


SETS = "file string, row long, id long, size int, cls long, prefix array<long>, bitmap binary, coarse binary"


def shingle_sets(docs: DataFrame, text: str, key: str, threshold: int) -> DataFrame:
    """One row per document. Prefix and bitmap are left out (null) where the same task
    has given them for an equal set."""
    levels = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs.select(docs[text])))

    def run(batches):
        import pyarrow as pa
        import xxhash

        level = np.frombuffer(levels.value, np.uint8).reshape(2, COUNTERS)
        seen: set[int] = set()
        for batch in batches:
            size, cls, prefix, bitmap, coarse = [], [], [], [], []
            for value in batch.column(3):
                hashes = shingle_set(value.as_py())
                name = np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64).item()
                size.append(len(hashes))
                cls.append(name)
                if len(hashes) and name not in seen:
                    seen.add(name)
                    one, two = _counters(hashes)
                    order = np.lexsort((hashes, np.minimum(level[0][one], level[1][two])))
                    prefix.append(hashes[order[: prefix_length(len(hashes), threshold)]].view(np.int64))
                    bitmap.append(parity_bits(hashes))
                    coarse.append(folded(np.frombuffer(bitmap[-1], np.uint64), COARSE // 64).tobytes())
                else:
                    for column in (prefix, bitmap, coarse):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(size, pa.int32()), pa.array(cls, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bitmap, pa.binary()), pa.array(coarse, pa.binary())],
                names=["file", "row", "id", "size", "cls", "prefix", "bitmap", "coarse"],
            )

    meta = docs.metadataColumn("_metadata")
    rows = docs.select(meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row"), docs[key].cast("long").alias("id"), docs[text].alias("text"))
    return stored(rows.mapInArrow(run, SETS), "sets")


# --- pairs ------------------------------------------------------------------------------------


def banded(key, cls, size, comp, bits, threshold: int):
    """Pairs of positions in the same tile whose sizes fit, whose components differ
    and whose coarse bitmaps leave room for the overlap, in portions. Rows come by key
    and size; each meets its next, second next ... neighbour while the size fits."""
    at, step = np.arange(len(key)), 1
    while len(at):
        at = at[at + step < len(key)]
        at = at[(key[at + step] == key[at]) & (size[at + step] * threshold <= size[at] * 100)]
        one = at[comp[at] != comp[at + step]]
        two = one + step
        apart = np.bitwise_count(bits[one] ^ bits[two]).sum(axis=1, dtype=np.int64)
        both = size[one] + size[two]
        overlap = (both - apart) // 2
        fits = 100 * overlap >= threshold * (both - overlap)
        if fits.any():
            a, b = cls[one[fits]], cls[two[fits]]
            yield np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
        step += 1


def tile_pairs(tiles: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of classes that may match, over all tiles."""

    def run(batches):
        import pyarrow as pa

        def given(columns):
            found = list(banded(*columns, threshold))
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

        held = None
        for batch in batches:
            columns = [batch.column(i).to_numpy().astype(np.int64) for i in range(4)]
            columns.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(-1, COARSE // 64))
            if held:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last tile may go on
            yield from given([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
        if held:
            yield from given(held)

    ordered = tiles.select("key", "cls", "size", "comp", "coarse").repartition("key").sortWithinPartitions("key", "size", "cls")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def matching(pairs: DataFrame, sets: DataFrame, docs: DataFrame, text: str, threshold: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that link: bitmaps first, then sorted arrays."""

    def bound(batches):
        import pyarrow as pa

        for batch in batches:
            a, b, size_a, bits_a, size_b, bits_b = (batch.column(i).to_pylist() for i in range(6))
            fits = pa.array([may_match(*x, threshold) for x in zip(bits_a, bits_b, size_a, size_b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(fits), batch.column(1).filter(fits)], names=["a", "b"])

    def arrays(batches):
        import pyarrow as pa

        for batch in batches:
            found = pa.array([shingle_set(value.as_py()).tobytes() for value in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["cls", "hashes"])

    def exact(batches):
        import pyarrow as pa

        for batch in batches:
            fits = pa.array([match(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), threshold) for x, y in zip(batch.column(2), batch.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(fits), batch.column(1).filter(fits)], names=["a", "b"])

    classes = sets.where("bitmap is not null").groupBy("cls").agg(F.first("size").alias("size"), F.first("bitmap").alias("bitmap"), F.min(F.struct("file", "row")).alias("at"))
    side = lambda name: classes.select(F.col("cls").alias(name), F.col("size").alias(f"size_{name}"), F.col("bitmap").alias(f"bits_{name}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "bits_a", "size_b", "bits_b")
    near = stored(near.mapInArrow(bound, "a long, b long"), "near")
    wanted = near.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = classes.join(wanted, "cls").select("cls", "at.file", "at.row")
    meta = docs.metadataColumn("_metadata")
    texts = docs.select(meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row"), docs[text].alias("text")).join(wanted, ["file", "row"]).select("cls", "text")
    own = stored(texts.mapInArrow(arrays, "cls long, hashes binary"), "arrays")
    both = near.join(own.withColumnsRenamed({"cls": "a", "hashes": "hashes_a"}), "a").join(own.withColumnsRenamed({"cls": "b", "hashes": "hashes_b"}), "b")
    return stored(both.select("a", "b", "hashes_a", "hashes_b").mapInArrow(exact, "a long, b long"), "links")


def similar(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """For every row of ``docs``: file, row, id, size, component (smallest id linked
    directly or through others) and comp (the name of its component, null for empty
    sets); and the located frame that file and row refer to."""
    docs = located(docs)
    sets = shingle_sets(docs, text, key, threshold)
    tile = Window.partitionBy("key")
    entries = sets.where("prefix is not null").select(F.explode("prefix").alias("key"), "cls", "size")
    entries = entries.withColumn("low", F.min("cls").over(tile)).withColumn("high", F.max("cls").over(tile)).withColumn("n", F.count("*").over(tile))
    entries = stored(entries.where("low <> high").select("key", "cls", "size", "n"), "tiles")

    # a copy's edits cost it tiles, so the text that a group was copied from has the
    # highest rank and leads the group's tiles
    ranks = entries.groupBy("cls").agg(F.sum("n").alias("rank"))
    led = entries.join(ranks, "cls").withColumn("lead", F.max(F.struct("rank", "cls")).over(tile)["cls"])
    met = led.where("cls <> lead").groupBy("cls", "lead").agg(F.count("*").alias("n"))
    met = met.groupBy("cls").agg(F.max(F.struct("n", "lead")).alias("best")).select(F.col("best.lead").alias("a"), F.col("cls").alias("b"))
    links = matching(met, sets, docs, text, threshold)
    named = stored(components(links), "named")

    coarse = sets.where("coarse is not null").groupBy("cls").agg(F.first("coarse").alias("coarse"))
    coarse = coarse.join(named.withColumnRenamed("id", "cls"), "cls", "left").select("cls", "coarse", F.coalesce("component", "cls").alias("comp"))
    tiles = entries.join(coarse, "cls")
    tiles = tiles.withColumn("low", F.min("comp").over(tile)).withColumn("high", F.max("comp").over(tile)).where("low <> high")
    rest = matching(stored(tile_pairs(tiles, threshold), "pairs"), sets, docs, text, threshold)
    named = stored(components(links.unionByName(rest)), "named").withColumnRenamed("id", "cls")

    rows = sets.select("file", "row", "id", "size", "cls").join(named, "cls", "left")
    rows = rows.withColumn("comp", F.when(F.col("size") > 0, F.coalesce("component", "cls"))).drop("component", "cls")
    smallest = rows.where("comp is not null").groupBy("comp").agg(F.min("id").alias("component"))
    rows = rows.join(smallest, "comp", "left")
    return rows.withColumn("component", F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("component"))), docs


def thinned(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest identifier,
    then the first by file and row. Rows with empty sets stay."""
    found, docs = similar(docs, text, key, threshold)
    first = F.min(F.struct(F.col("id").isNull(), "id", "file", "row")).alias("first")
    stay = found.where("comp is not null").groupBy("comp").agg(first).select("first.file", "first.row")
    stay = stay.unionByName(found.where("comp is null").select("file", "row"))
    meta = docs.metadataColumn("_metadata")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("whole"), meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row"))
    return rows.join(stay, ["file", "row"], "left_semi").select("whole.*")


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    found, _ = similar(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


ORACLE = r"""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [md5(array_to_string(w, ' '))]
  ELSE list_distinct([md5(array_to_string(w[i:i + 4], ' ')) for i in range(1, len(w) - 3)]) END AS s FROM words),
entries AS (SELECT doc_id, len(s) AS n, unnest(list_sort(s)[1:len(s) - CAST(ceil(len(s) * 80 / 100.0) AS BIGINT) + 1]) AS k FROM sets),
pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM entries a JOIN entries b ON a.k = b.k AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
sized AS (SELECT p.a, p.b, len(x.s) + len(y.s) AS total, len(list_intersect(x.s, y.s)) AS met FROM pairs p JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b),
links AS (SELECT a, b FROM sized WHERE 100 * met >= 80 * (total - met)),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.b = l.a) SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, len(s.s) AS n_shingles, r.component_id FROM sets s JOIN reach r ON r.a = s.doc_id
"""
