"""Centroid clustering over a vector-approximation file.

Two files stand for the vectors. The vector file holds their integer components in rows
of fixed width and is read by position. The approximation table holds, per vector, its
position and a few bits per dimension: the cell that the component falls into. In every
round two lookup tables (dimension, cell, centroid) give the least and the greatest
squared distance that a cell allows; their sums over the dimensions are an interval per
centroid. A vector whose interval for one centroid ends before all others begin is
assigned without being read. Only the others are fetched and compared, and only with the
centroids whose intervals overlap. Centroid sums change by the vectors that moved, so
between the first round and the last only undecided and moved vectors are fetched.

Distances and sums are exact integers; the cells decide what is read, never the result.
Nothing is shuffled by value: tasks add up their own sums, and what meets afterwards is
one number per centroid and dimension. The driver holds centroids, borders and sums.

Vector files go below spark.checkpoint.dir under the number of the attempt that wrote
them; the approximation rows that Spark commits name their file, so what a lost or
repeated attempt left is never read.

Defined cases: vectors that are null, of another length, or hold null or non-finite
components are left out, and so are components beyond 2^20 in size, whose squared
distances would not fit a long; fewer kept vectors than centroids give as many centroids
as there are vectors; a null identifier is hashed as an empty one; vectors that share an
identifier are separate and ordered by their components where the first centroids are
chosen; a centroid equal to an earlier one stays empty; an empty table gives no row;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import documents, scratch_path, stored
from arealis.llm.token_index import filesystem

DIMENSIONS = 64
SCALE = 64.0
LARGEST = 1 << 26  # of an integer component
BITS = 6  # of a cell
SPREAD = 3.5  # standard deviations that the inner cells cover on either side
FILE_ROWS = 1 << 18  # of a vector file
GAP = 128  # unwanted rows that are read rather than starting a new read
ROW = "file long, row long, vec_id long, cells binary, label int, distance long, totals array<long>"


# --- the vector file --------------------------------------------------------------------------


def integers(column, width: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the vectors of a batch that are kept, and their integer components."""
    import pyarrow.compute as pc

    fits = pc.equal(pc.fill_null(pc.list_value_length(column), -1), width)
    at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    values = column.filter(fits).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(scale * values)
        good = (np.abs(whole) <= LARGEST).all(axis=1)
    return at[good], whole[good].astype(np.int64)


class Writer:
    """Fixed-width rows into files of bounded length."""

    def __init__(self, folder: str, attempt: int):
        self.folder, self.attempt, self.files, self.row, self.out = folder, attempt, -1, 0, None

    def add(self, rows: np.ndarray) -> tuple[int, int]:
        if self.out is None or self.row + len(rows) > FILE_ROWS:
            self.close()
            self.files, self.row = self.files + 1, 0
            files, path = filesystem(f"{self.folder}/{self.name:x}.vec")
            self.out = files.open_output_stream(path)
        first = self.row
        self.out.write(rows.astype("<i4").tobytes())
        self.row += len(rows)
        return self.name, first

    @property
    def name(self) -> int:
        return self.attempt << 24 | self.files

    def close(self):
        if self.out is not None:
            self.out.close()
            self.out = None


class Reader:
    """Vectors by file and row; rows near each other come in one read."""

    def __init__(self, folder: str, width: int):
        self.folder, self.width, self.name, self.file = folder, width, None, None

    def fetch(self, names: np.ndarray, rows: np.ndarray) -> np.ndarray:
        found, bytes_of_row = np.empty((len(rows), self.width), np.int64), 4 * self.width
        for name in np.unique(names).tolist():
            if name != self.name:
                files, path = filesystem(f"{self.folder}/{name:x}.vec")
                self.name, self.file = name, files.open_input_file(path)
            here = np.flatnonzero(names == name)
            here = here[np.argsort(rows[here], kind="stable")]
            for run in np.split(here, np.flatnonzero(np.diff(rows[here]) > GAP) + 1):
                first, last = int(rows[run[0]]), int(rows[run[-1]])
                read = self.file.read_at((last - first + 1) * bytes_of_row, first * bytes_of_row)
                found[run] = np.frombuffer(read, "<i4").reshape(-1, self.width)[rows[run] - first]
        return found


def vector_file(vectors: DataFrame, folder: str, k: int, column: str, key: str, width: int, scale: float, seed: int) -> DataFrame:
    """Write the vector files; rows (file, row, vec_id) and, last of each task, its sums
    for the borders and its candidates for the first centroids."""

    def run(batches):
        import pyarrow as pa

        writer = Writer(folder, TaskContext.get().taskAttemptId())
        first, sums = [], np.zeros((4, width))
        sums[2], sums[3] = np.inf, -np.inf
        n = 0
        for batch in batches:
            at, whole = integers(batch.column(1), width, scale)
            if not len(at):
                continue
            ids = batch.column(0).take(pa.array(at)).to_pylist()
            name, row = writer.add(whole)
            hashes = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i in ids]
            bar = first[-1][0] if len(first) == k else "g"
            near = [(h, tuple(whole[j].tolist())) for j, h in enumerate(hashes) if h <= bar]
            first = heapq.nsmallest(k, first + near)
            n += len(at)
            sums[0] += whole.sum(axis=0)
            sums[1] += (whole.astype(np.float64) ** 2).sum(axis=0)
            sums[2] = np.minimum(sums[2], whole.min(axis=0))
            sums[3] = np.maximum(sums[3], whole.max(axis=0))
            yield pa.RecordBatch.from_pydict({
                "file": pa.array(np.full(len(at), name)),
                "row": pa.array(row + np.arange(len(at))),
                "vec_id": pa.array(ids, pa.int64()),
                "seeds": pa.nulls(len(at), SEEDS),
                "sums": pa.nulls(len(at), pa.list_(pa.float64())),
                "n": pa.nulls(len(at), pa.int64()),
            })
        writer.close()
        if n:
            seeds = [{"hash": h, "v": list(v)} for h, v in first]
            yield pa.RecordBatch.from_pydict({
                "file": pa.nulls(1, pa.int64()),
                "row": pa.nulls(1, pa.int64()),
                "vec_id": pa.nulls(1, pa.int64()),
                "seeds": pa.array([seeds], SEEDS),
                "sums": pa.array([sums.reshape(-1).tolist()]),
                "n": pa.array([n]),
            })

    import pyarrow as pa

    SEEDS = pa.list_(pa.struct([("hash", pa.string()), ("v", pa.list_(pa.int64()))]))
    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[column].cast("array<double>").alias("v"))
    return stored(rows.mapInArrow(run, "file long, row long, vec_id long, seeds array<struct<hash:string,v:array<long>>>, sums array<double>, n long"), "vectors")


# --- cells and bounds -------------------------------------------------------------------------


def borders_of(table: DataFrame, width: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per dimension the first integer of each cell but the first, and the least and the
    greatest component: inner cells of one breadth about the mean, two outer ones."""
    at = F.posexplode("sums").alias("at", "value")
    each = table.where("n is not null").select("n", at)
    part = F.floor(F.col("at") / width)
    found = each.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.when(part < 2, F.col("value"))).alias("total"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    rows = {r["at"]: r for r in found}
    get = lambda i, name: np.array([rows[i * width + d][name] for d in range(width)], np.float64)
    n = get(0, "n")
    mean = get(0, "total") / n
    deviation = np.sqrt(np.maximum(get(1, "total") / n - mean**2, 0.25))
    inner = np.linspace(-SPREAD, SPREAD, 2**bits - 1)
    return np.ceil(mean[:, None] + deviation[:, None] * inner).astype(np.int64), get(2, "low").astype(np.int64), get(3, "high").astype(np.int64)


def pack(cells: np.ndarray, bits: int) -> list[bytes]:
    """A few bits per cell, one row of bytes per vector."""
    spread = (cells[:, :, None] >> np.arange(bits)) & 1
    return [row.tobytes() for row in np.packbits(spread.reshape(len(cells), -1).astype(np.uint8), axis=1)]


def unpack(packed: list[bytes], width: int, bits: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    spread = np.unpackbits(rows, axis=1)[:, : width * bits].reshape(len(packed), width, bits)
    return (spread.astype(np.intp) << np.arange(bits)).sum(axis=2)


def lookups(centroids: np.ndarray, borders: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance along one dimension, by dimension, cell and
    centroid."""
    first = np.concatenate([low[:, None], borders], axis=1)
    last = np.concatenate([borders - 1, high[:, None]], axis=1)
    first, last = np.maximum(first, low[:, None])[:, :, None], np.minimum(last, high[:, None])[:, :, None]
    at = centroids.T[:, None, :]
    outside = np.maximum(np.maximum(first - at, at - last), 0)
    farthest = np.maximum(np.abs(first - at), np.abs(last - at))
    return outside**2, farthest**2


def intervals(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The bounds of every vector's squared distance to every centroid."""
    low, high = (np.zeros((len(cells), tables[0].shape[2]), np.int64) for _ in range(2))
    for d in range(cells.shape[1]):
        low += tables[0][d][cells[:, d]]
        high += tables[1][d][cells[:, d]]
    return low, high


def compared(candidates: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest candidate (the smaller number of equal ones) and its squared distance."""
    best, label = np.full(len(vectors), np.iinfo(np.int64).max), np.full(len(vectors), -1)
    for j in range(len(centroids)):
        rows = np.flatnonzero(candidates[:, j])
        distance = ((vectors[rows] - centroids[j]) ** 2).sum(axis=1)
        nearer = distance < best[rows]
        best[rows[nearer]], label[rows[nearer]] = distance[nearer], j
    return label, best


# --- rounds -----------------------------------------------------------------------------------


def assign(table: DataFrame, folder: str, centroids: np.ndarray, cells: tuple, bits: int, fetch_all: bool) -> DataFrame:
    """One assignment. The rows come out with their label; the last row of each task
    carries what its vectors change in the centroids' sums: per centroid the components,
    the count and, if all were fetched, the distances."""
    borders, low, high = cells
    tables, (k, width) = lookups(centroids, *cells), centroids.shape
    first_time = "cells" not in table.columns

    def run(batches):
        import pyarrow as pa

        reader, totals, fetched, seen = Reader(folder, width), np.zeros((k, width + 3), np.int64), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            vectors = None
            if first_time:
                vectors = reader.fetch(names, rows)
                code = np.stack([np.searchsorted(borders[d], vectors[:, d], "right") for d in range(width)], axis=1)
                packed, old = pack(code, bits), np.full(len(rows), -1)
            else:
                packed, old = batch.column(3).to_pylist(), batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
                code = unpack(packed, width, bits)
            least, greatest = intervals(code, tables)
            candidates = least <= greatest.min(axis=1)[:, None]
            label, distance = candidates.argmax(axis=1), np.full(len(rows), -1)
            undecided = candidates.sum(axis=1) > 1
            wanted = np.flatnonzero(undecided | (label != old) | fetch_all)
            if vectors is None:
                vectors = reader.fetch(names[wanted], rows[wanted])
            label[wanted], distance[wanted] = compared(candidates[wanted], vectors, centroids)
            moved = np.flatnonzero(label[wanted] != old[wanted])
            for j in np.unique(np.concatenate([label[wanted][moved], old[wanted][moved]])).tolist():
                if j < 0:
                    continue
                came, left = moved[label[wanted][moved] == j], moved[old[wanted][moved] == j]
                totals[j, :width] += vectors[came].sum(axis=0) - vectors[left].sum(axis=0)
                totals[j, width] += len(came) - len(left)
            if fetch_all:
                np.add.at(totals[:, width + 1], label, distance)
            totals[:, width + 2] += np.bincount(label[undecided], minlength=k)
            yield pa.RecordBatch.from_pydict({
                "file": batch.column(0),
                "row": batch.column(1),
                "vec_id": batch.column(2),
                "cells": pa.array(packed, pa.binary()),
                "label": pa.array(label, pa.int32()),
                "distance": pa.array(distance),
                "totals": pa.nulls(len(rows), pa.list_(pa.int64())),
            })
        if totals.any():
            nothing = {name: pa.nulls(1, kind) for name, kind in (("file", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("cells", pa.binary()), ("label", pa.int32()), ("distance", pa.int64()))}
            yield pa.RecordBatch.from_pydict(nothing | {"totals": pa.array([totals.reshape(-1).tolist()])})

    columns = ["file", "row", "vec_id"] + ([] if first_time else ["cells", "label"])
    return stored(table.where("file is not null").select(*columns).mapInArrow(run, ROW), "round")


def totals_of(table: DataFrame, k: int, width: int) -> np.ndarray:
    """The tasks' sums added up: one number per centroid and dimension comes here."""
    each = table.where("totals is not null").select(F.posexplode("totals").alias("at", "value"))
    found = np.zeros(k * (width + 3), object)
    for row in each.groupBy("at").agg(F.sum("value").alias("value")).collect():
        found[row["at"]] = row["value"]
    return found.reshape(k, width + 3)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, column: str = "embedding", key: str = "vec_id", width: int = DIMENSIONS, scale: float = SCALE, seed: int = 1, bits: int = BITS) -> tuple[DataFrame, list[dict]]:
    """The kept vectors (vec_id, cluster, distance), and per centroid its components,
    count, the sum of distances, and in ``undecided`` how many vectors the intervals left
    open in each assignment."""
    spark = vectors.sparkSession
    folder = scratch_path(spark, "vector-file")
    files, path = filesystem(folder)
    files.create_dir(path, recursive=True)
    table = vector_file(vectors, folder, k, column, key, width, scale, seed)
    seeds = table.where("seeds is not null").select(F.explode("seeds").alias("s")).select("s.*").orderBy("hash", "v").limit(k).collect()
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    centroids = np.array([s["v"] for s in seeds], np.int64)
    cells = borders_of(table, width, bits)
    sums, undecided = np.zeros((len(centroids), width + 1), object), []
    for turn in range(rounds + 1):
        table = assign(table, folder, centroids, cells, bits, turn == rounds)
        change = totals_of(table, len(centroids), width)
        sums = sums + change[:, : width + 1]
        undecided.append(int(change[:, width + 2].sum()))
        if turn < rounds:
            for j, total in enumerate(sums):
                if total[width]:
                    centroids[j] = [int(x) // int(total[width]) for x in total[:width]]
    found = [{"centroid": c.tolist(), "count": int(sums[j][width]), "inertia": int(change[j][width + 1]), "undecided": undecided} for j, c in enumerate(centroids)]
    rows = table.where("file is not null").select("vec_id", F.col("label").alias("cluster"), "distance")
    return rows, found


def op11_centroids(spark, sf_dir: str) -> DataFrame:
    rows, found = cluster(documents(spark, sf_dir, "embeddings"))
    inertias = [c["inertia"] for c in found]
    digests = [hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest() for c in found]
    of = lambda values, kind: F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1)
    return rows.select("*", of(inertias, "long").alias("cluster_inertia"), F.lit(sum(inertias)).cast("long").alias("inertia"), of(digests, "string").alias("centroid_sha256"))


_ASSIGN = """
d{n} AS (SELECT v.uid, c.j, list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{n} c),
a{n} AS (SELECT uid, arg_min(j, (d, j)) AS j, min(d) AS d FROM d{n} GROUP BY uid)"""

_MOVE = """,
m{n} AS (SELECT a.j, i, floor(sum(v.q[i])::DOUBLE / count(*))::BIGINT AS x FROM a{p} a JOIN v USING (uid), range(1, 65) AS r(i) GROUP BY a.j, i),
c{n} AS (SELECT c.j, coalesce(m.q, c.q) AS q FROM c{p} c LEFT JOIN (SELECT j, list(x ORDER BY i) AS q FROM m{n} GROUP BY j) m USING (j)),"""

ORACLE = (
    """
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS uid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS j, q FROM (SELECT sha256('1:' || vec_id) AS h, q FROM v ORDER BY h LIMIT 16)),"""
    + "".join(_ASSIGN.format(n=n) + (_MOVE.format(n=n + 1, p=n) if n < 3 else "") for n in range(4))
    + """
SELECT vec_id, a.j::INT AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.j)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a3 a JOIN v USING (uid) JOIN c3 c ON c.j = a.j
"""
)
