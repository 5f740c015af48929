"""Exact metric range join of embeddings, and its connected components.

For unit vectors a cosine of at least c is a distance of at most r = sqrt(2 - 2c).
Pivots drawn from the vectors part them into cells by the nearest pivot; a vector at
distances d from its own pivot and e from another can only have a partner in that
pivot's cell if e <= d + 2r and e <= R + r, R being the cell's radius (both by the
triangle inequality). Full cells are dealt into blocks of bounded size. A block is
written once, to a file, and says which cells its vectors may have partners in; two
blocks that name each other's cells meet once, in a task that reads both files, so no
vector is copied to where it is compared.

Two blocks first meet in few dimensions: the products with the main directions of a
sample and the length of what is left of a vector. By Cauchy-Schwarz the cosine there is
never less than the whole one, so pairs below c (less the rounding of single precision)
are no links; the others are decided by the whole vectors in double precision.

Equal vectors are one class. A task never lists its pairs: it counts links and joins
the members of a block in a local forest, so a group of any size costs one edge per
member and block.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are components of their own; vectors of different lengths never
link; rows that share an identifier are separate vectors; a null identifier takes part
but never names a component unless all are null; extra columns are ignored. Random
vectors of many dimensions are all about as far apart as from any pivot: then nearly all
blocks meet, and the join compares as many pairs as it would unpruned, each once.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import components, documents, scratch_path, stored
from arealis.llm.token_index import filesystem
from arealis.session import estimated_bytes

COSINE = 0.95
CELL = 4096  # vectors a cell should have
PIVOTS = 1024  # at most; their table goes to all tasks
SAMPLE = 1024  # vectors that the main directions are taken from, if they are no fewer
TILE = 4096  # vectors of a block
TILE_BYTES = 32 << 20  # of a block's vectors in double precision
STREAM = 1024  # vectors of a block compared at a time with STREAM / 4 of the other
FEW = 32  # dimensions that blocks meet in first
UNIT = 32  # pairs of blocks that a task compares without a break
TASKS = 8192  # at most, that the pairs of blocks are dealt to
BROADCAST_BYTES = 24 << 20  # size of the table of repeated vectors up to which it is broadcast
SLACK = 1e-9  # for rounding in the bounds


def unit(packed, kind: str) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, kind) for p in packed]).astype(np.float64)
    return normed(rows)


def normed(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ pivots.T)))


def packed_rows(vectors: DataFrame, column: str, key: str) -> tuple[DataFrame, str]:
    """All rows as uid, id and, unless it can't link, the packed vector, its length and its
    digest."""
    kind = "<f4" if "float" in vectors.schema[column].dataType.simpleString() else "<f8"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(2)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            # null components become NaN
            values = lists.flatten().cast(pa.float32() if kind == "<f4" else pa.float64(), safe=False).to_numpy(zero_copy_only=False).astype(kind)
            start = np.cumsum(size) - size
            found, digests = [None] * len(batch), [None] * len(batch)
            for n in np.unique(size[size > 0]).tolist():
                at = np.flatnonzero(size == n)
                x = values[start[at][:, None] + np.arange(n)]
                with np.errstate(over="ignore", invalid="ignore"):
                    norm = np.linalg.norm(x.astype(np.float64), axis=1)
                for i in np.flatnonzero(np.isfinite(x).all(axis=1) & (norm > 0) & (norm < np.inf)).tolist():
                    found[at[i]] = x[i].tobytes()
                    digests[at[i]] = hashlib.blake2b(found[at[i]], digest_size=16).digest()
            sizes = pa.array([None if v is None else n for v, n in zip(found, size.tolist(), strict=True)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary()), sizes, pa.array(digests, pa.binary())], names=["uid", "id", "v", "size", "digest"])

    rows = vectors.select(F.monotonically_increasing_id().alias("uid"), vectors[key].cast("long").alias("id"), vectors[column])
    return stored(rows.mapInArrow(run, "uid long, id long, v binary, size int, digest binary"), "vectors"), kind


class Forest:
    """Components of a block's vectors; a root is the least of its members."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            one, two = self.root[a], self.root[b]
            apart = np.flatnonzero(one != two)
            if not len(apart):
                return
            a, b, one, two = a[apart], b[apart], one[apart], two[apart]
            np.minimum.at(self.root, np.maximum(one, two), np.minimum(one, two))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


# --- few dimensions ---------------------------------------------------------------------------


def directions(sample: np.ndarray) -> np.ndarray | None:
    """FEW - 1 orthonormal rows along which the sample is largest; None if all dimensions
    are few."""
    if sample.shape[1] <= FEW:
        return None
    return np.linalg.svd(sample, full_matrices=False)[2][: FEW - 1]


def reduced(x: np.ndarray, main: np.ndarray | None) -> np.ndarray:
    """Unit vectors whose products are no less than those of ``x``, but for rounding."""
    if main is None:
        return x.astype(np.float32)
    p = x @ main.T
    return np.column_stack([p, np.sqrt(np.maximum(0.0, 1 - (p * p).sum(axis=1)))]).astype(np.float32)


def rounding(width: int) -> float:
    """More than single precision changes a product of unit vectors by."""
    return (width + 8) * 2.0**-23


def near_pairs(x, y, cosine: float, same: bool):
    """Places (i, j) of vectors of two blocks with a cosine of ``cosine`` or more, a few at
    a time; of a block with itself those with i < j. Blocks give ``few`` and ``whole(i)``."""
    least = cosine - rounding(x.few.shape[1])
    high = max(1, STREAM // 4)
    for top in range(0, len(x.few), high):
        for left in range(0, len(y.few), STREAM):
            if same and left + STREAM <= top:
                continue
            products = x.few[top : top + high] @ y.few[left : left + STREAM].T
            if products.max() < least:
                continue
            i, j = np.divmod(np.flatnonzero(products >= least), products.shape[1])
            if len(i) > products.size // 16:  # mostly near: all at once
                i, j = np.nonzero(x.whole(slice(top, top + high)) @ y.whole(slice(left, left + STREAM)).T >= cosine)
                i, j = i + top, j + left
            else:
                i, j, width = i + top, j + left, max(1, (1 << 20) // x.size)
                good = [np.einsum("ij,ij->i", x.whole(i[k : k + width]), y.whole(j[k : k + width])) >= cosine for k in range(0, len(i), width)]
                good = np.concatenate([*good, np.zeros(0, bool)])
                i, j = i[good], j[good]
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j


# --- blocks -----------------------------------------------------------------------------------


class Block:
    """A block's file: names, times, distances from the pivot, few dimensions, vectors. The
    vectors are read when they are first asked for."""

    def __init__(self, uri: str, n: int, size: int, width: int, kind: str):
        self.n, self.size, self.kind, self.rows = n, size, kind, None
        files, path = filesystem(uri)
        self.file = files.open_input_file(path)
        head = self.file.read_at(n * (24 + 4 * width), 0)
        self.names, self.times = (np.frombuffer(head, np.int64, n, 8 * n * i) for i in (0, 1))
        self.apart = np.frombuffer(head, np.float64, n, 16 * n)
        self.few = np.frombuffer(head, np.float32, n * width, 24 * n).reshape(n, width)
        self.past = len(head)

    def whole(self, which) -> np.ndarray:
        if self.rows is None:
            width = np.dtype(self.kind).itemsize * self.size
            self.rows = np.frombuffer(self.file.read_at(self.n * width, self.past), self.kind).reshape(self.n, self.size)
        return normed(self.rows[which])

    def some(self, keep: np.ndarray):
        """The block without the others; itself, if they are not many."""
        return Part(self, np.flatnonzero(keep)) if keep.sum() < 0.75 * self.n else self


class Part:
    def __init__(self, block: Block, at: np.ndarray):
        self.block, self.at, self.few, self.size = block, at, block.few[at], block.size

    def whole(self, which) -> np.ndarray:
        return self.block.whole(self.at[which])


def write_block(uri: str, names, times, apart, few, rows) -> None:
    files, path = filesystem(uri)
    with files.open_output_stream(path) as out:
        for part, kind in ((names, np.int64), (times, np.int64), (apart, np.float64), (few, np.float32), (rows, rows.dtype)):
            out.write(np.ascontiguousarray(part, kind).tobytes())


def by_block(batches):
    """Rows (block, cell, cls, times, apart, v) by block: block, cell and columns."""
    held, key = [], None

    def whole():
        names, times, apart, packed = (list(x) for x in zip(*held, strict=True))
        return *key, np.concatenate(names), np.concatenate(times), np.concatenate(apart), b"".join(packed)

    for batch in batches:
        block, cell, cls, times, apart = (batch.column(i).to_numpy() for i in range(5))
        cuts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]]).tolist() if len(block) else []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if held and key[0] != block[lo]:
                yield whole()
                held = []
            key = int(block[lo]), int(cell[lo])
            held.append((cls[lo:hi], times[lo:hi], apart[lo:hi], b"".join(batch.column(5).slice(lo, hi - lo).to_pylist())))
    if held:
        yield whole()


def links_of(batches, kind: str, cosine: float, pivots: dict):
    """Rows (unit, one, two), two blocks each, by unit and one: (a, b, links), where a is a
    class, b one that it is joined to, links the rows that it links to in the other block."""
    import pyarrow as pa

    radius = float(np.sqrt(2 - 2 * cosine)) + SLACK

    def opened(row):
        return Block(row["file"], row["n"], row["size"], row["width"], kind)

    def within(block, cell, other):
        """Those of a block that may have a partner in the other one, of that cell."""
        if cell < 0:
            return block
        bound = np.minimum(block.apart + 2 * radius, other.apart.max() + radius)
        return block.some(block.few @ pivots[cell] >= 1 - bound * bound / 2 - rounding(block.few.shape[1]))

    def batch_of(parts):
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "links"])

    key = one = None
    for batch in batches:
        for row in batch.to_pylist():
            if key != (row["unit"], row["one"]["block"]):
                if one is not None and links.any():
                    at = np.flatnonzero(links)
                    yield batch_of([(one.names[at], one.names[forest.root[at]], links[at])])
                key, one = (row["unit"], row["one"]["block"]), opened(row["one"])
                links, forest = np.zeros(one.n, np.int64), Forest(one.n)
            same = row["one"]["block"] == row["two"]["block"]
            two = one if same else opened(row["two"])
            x, y = (one, one) if same else (within(one, row["two"]["cell"], two), within(two, row["one"]["cell"], one))
            if not len(x.few) or not len(y.few):
                continue
            theirs, first = (links if same else np.zeros(two.n, np.int64)), np.full(two.n, -1)
            for i, j in near_pairs(x, y, cosine, same):
                i, j = x.at[i] if isinstance(x, Part) else i, y.at[j] if isinstance(y, Part) else j
                np.add(links, np.bincount(i, two.times[j], one.n).astype(np.int64), out=links)
                np.add(theirs, np.bincount(j, one.times[i], two.n).astype(np.int64), out=theirs)
                if same:
                    forest.join(i, j)
                    continue
                fresh = np.flatnonzero(first[j] < 0)
                first[j[fresh]] = i[fresh]
                forest.join(i, first[j])
            if not same and theirs.any():
                at = np.flatnonzero(theirs)
                yield batch_of([(two.names[at], one.names[first[at]], theirs[at])])
    if one is not None and links.any():
        at = np.flatnonzero(links)
        yield batch_of([(one.names[at], one.names[forest.root[at]], links[at])])


# --- the join ---------------------------------------------------------------------------------


def linked(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", cosine: float = COSINE) -> DataFrame:
    """One row per vector: uid, id, n_links, component (smallest id reachable), first
    (whether it is the row that names the component)."""
    spark = vectors.sparkSession
    rows, kind = packed_rows(vectors, column, key)
    # only digests travel to tell equal vectors; the first of them stands for all
    repeats = rows.where("digest is not null").groupBy("digest").agg(F.min("uid").alias("cls"), F.count("*").alias("times")).where("times > 1")
    repeats = stored(repeats, "repeats")
    repeats = F.broadcast(repeats) if estimated_bytes(repeats) <= BROADCAST_BYTES else repeats
    rows = rows.join(repeats, "digest", "left").select("uid", "id", "v", "size", F.when(F.col("digest").isNotNull(), F.coalesce("cls", "uid")).alias("cls"), F.coalesce("times", F.lit(1)).alias("times"))
    classes = rows.where("uid = cls").select("cls", "v", "times", "size")
    radius = float(np.sqrt(2 - 2 * cosine)) + SLACK
    amount = int(min(PIVOTS, max(1, -(-classes.count() // CELL))))
    drawn: dict[int, list[bytes]] = {}
    chosen: dict[int, int] = {}
    for i, row in enumerate(classes.orderBy(F.xxhash64("cls"), "cls").limit(max(amount, SAMPLE)).select("size", "v").collect()):
        drawn.setdefault(row["size"], []).append(bytes(row["v"]))
        chosen[row["size"]] = chosen.get(row["size"], 0) + (i < amount)
    samples = {size: unit(v, kind) for size, v in drawn.items()}
    pivots = {size: x[: chosen[size]] for size, x in samples.items() if chosen[size]}
    main = {size: directions(x) for size, x in samples.items()}
    first, total = {}, 0
    for size in sorted(pivots):
        first[size], total = total, total + len(pivots[size])
    few_pivots = {first[size] + k: p for size, x in pivots.items() for k, p in enumerate(reduced(x, main[size]))}

    def few_of(x):
        # lengths that the sample lacks are cut after the first dimensions
        width = x.shape[1]
        return reduced(x, main[width] if width in main else None if width <= FEW else np.eye(FEW - 1, width))

    def at_home(batches):
        """cls, v and times of each length, and the nearest pivot's cell and distance; -size
        for lengths without one, a cell of their own."""
        for batch in batches:
            size, cls, packed, times = batch.column(3).to_numpy(), batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for value in np.unique(size).tolist():
                at = np.flatnonzero(size == value)
                of_size = [packed[i] for i in at]
                cell, apart = np.full(len(at), -value), np.zeros(len(at))
                if value in pivots:
                    d = distances(unit(of_size, kind), pivots[value])
                    best = d.argmin(axis=1)
                    cell, apart = first[value] + best, d[np.arange(len(at)), best]
                yield value, cls[at], of_size, times[at], cell, apart

    def counted(batches):
        import pyarrow as pa

        for size, _, _, _, cell, apart in at_home(batches):
            names, which = np.unique(cell, return_inverse=True)
            reach = np.zeros(len(names))
            np.maximum.at(reach, which, apart)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.full(len(names), size), pa.int64()), pa.array(np.bincount(which), pa.int64()), pa.array(reach)], names=["cell", "size", "n", "reach"])

    # one row per pivot that has vectors, and per length without pivots
    cells = classes.mapInArrow(counted, "cell long, size long, n long, reach double").groupBy("cell").agg(F.max("size").alias("size"), F.sum("n").alias("n"), F.max("reach").alias("reach"))
    known, blocks = {}, 0
    for row in sorted(cells.collect(), key=lambda r: r["cell"]):
        count = -(-row["n"] // max(1, min(TILE, TILE_BYTES // (8 * row["size"]))))
        known[row["cell"]] = blocks, count, row["reach"]
        blocks += count

    def dealt(batches):
        import pyarrow as pa

        for _, cls, packed, times, cell, apart in at_home(batches):
            start, count = (np.array([known[c][i] for c in cell.tolist()], np.int64) for i in (0, 1))
            block = start + (hash_of(cls) % count.astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(cell, pa.int64()), pa.array(cls, pa.int64()), pa.array(times, pa.int64()), pa.array(apart), pa.array(packed, pa.binary())], names=["block", "cell", "cls", "times", "apart", "v"])

    folder = scratch_path(spark, "blocks")
    files, path = filesystem(folder)
    files.create_dir(path)

    def written(batches):
        """A row for each block: its file, and the cells that it may have partners in."""
        import pyarrow as pa

        attempt = TaskContext.get().taskAttemptId()
        for block, cell, names, times, apart, packed in by_block(batches):
            x = np.frombuffer(packed, kind).reshape(len(names), -1)
            size, around = x.shape[1], [cell]
            whole = normed(x)
            if cell >= 0:
                d = distances(whole, pivots[size])
                reach = np.array([known[first[size] + k][2] if first[size] + k in known else -np.inf for k in range(d.shape[1])])
                around = (first[size] + np.flatnonzero(((d <= apart[:, None] + 2 * radius) & (d <= reach + radius)).any(axis=0))).tolist()
            few, uri = few_of(whole), f"{folder}/{block}-{attempt}.vec"
            write_block(uri, names, times, apart, few, x)
            columns = [[block], [cell], [uri], [len(names)], [size], [few.shape[1]], [around]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "cell", "file", "n", "size", "width", "around"])

    table = classes.mapInArrow(dealt, "block long, cell long, cls long, times long, apart double, v binary").repartition("block").sortWithinPartitions("block")
    table = stored(table.mapInArrow(written, "block long, cell long, file string, n long, size long, width long, around array<long>"), "blocks")

    # blocks that name each other's cells meet once
    near = table.select(F.struct("block", "cell", "file", "n", "size", "width").alias("at"), F.explode("around").alias("other"))
    one, two = near.alias("one"), near.alias("two")
    meet = (F.col("one.other") == F.col("two.at.cell")) & (F.col("two.other") == F.col("one.at.cell")) & (F.col("one.at.block") <= F.col("two.at.block"))
    pairs = one.join(two, meet).select(F.col("one.at").alias("one"), F.col("two.at").alias("two"))
    # some of the blocks that one meets are a unit
    pairs = pairs.withColumn("unit", F.struct(F.col("one.block"), F.expr(f"two.block div {UNIT}"))).select(F.xxhash64("unit").alias("unit"), "one", "two")
    pairs = stored(pairs, "pairs")
    tasks = int(min(TASKS, max(1, -(-pairs.count() // UNIT), spark.sparkContext.defaultParallelism)))
    pairs = pairs.repartition(tasks, "unit").sortWithinPartitions("unit", "one.block", "two.block")
    found = stored(pairs.mapInArrow(lambda batches: links_of(batches, kind, cosine, few_pivots), "a long, b long, links long"), "found")

    links = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "cls")
    named = components(found.select("a", "b")).withColumnRenamed("id", "cls")
    out = rows.select("uid", "id", "cls", "times").join(links, "cls", "left").join(named, "cls", "left")
    out = out.select("uid", "id", F.when(F.col("cls").isNotNull(), F.coalesce("links", F.lit(0)) + F.col("times") - 1).otherwise(0).alias("links"), F.coalesce("component", "cls", "uid").alias("comp"))
    smallest = out.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull(), "id", "uid")).alias("low"))
    out = out.join(smallest, "comp")
    return out.select("uid", "id", F.col("links").cast("long").alias("n_links"), F.col("low.id").alias("component"), (F.col("low.uid") == F.col("uid")).alias("first"))


def hash_of(names: np.ndarray) -> np.ndarray:
    return names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)


def op3_vector_join(spark, sf_dir: str) -> DataFrame:
    found = linked(documents(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


ORACLE = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN reach ON a = vec_id
"""
