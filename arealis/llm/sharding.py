"""Sharding by a minimax contiguous partition of ordered groups.

Rows with equal texts are one group and never part. Groups stand in the order of their
digests; shards are stretches of that order. The capacity is the smallest with which as
many stretches as there are shards hold all groups: binary search, each capacity checked
by filling shards greedily, and the cuts are those of the capacity found. Groups larger
than an even share of what is left stand first, each a shard of its own, so that one
heap of copies does not set the capacity of all other shards.

No group is gathered. Rows are added up by the first bytes of their digests, inside
tasks first. A bucket of several groups can be cut somewhere inside: taken as divisible
it gives a lower bound of the capacity, taken as one piece an upper bound. While the two
differ, the buckets that cuts can fall in are added up by one byte more; a bucket whose
least and greatest digest are equal is one group. The driver holds bucket sums, their
number bounded by 65,536 and 256 for each bucket refined. A cut is a digest, so a row's
shard follows from its own digest, without a join.

Slots number each shard's rows by identifier, digest and position in the stored table,
in slices of bounded size.

Defined cases: a null text has no bytes and is grouped with the empty one; a null
identifier sorts first; repeated rows are separate rows of their group; with fewer groups
than shards some shards stay empty; an empty table gives no row; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import documents, stored
from arealis.operators.keys import with_row_id

SHARDS = 16
FIRST = 2  # bytes of the digest that the first buckets go by


class Buckets:
    """Bucket sums in digest order: stretches of groups, some of them single groups."""

    def __init__(self, rows: dict[bytes, tuple[int, bytes, bytes]]):
        self.rows = rows

    def refine(self, prefixes, parts: dict[bytes, tuple[int, bytes, bytes]]) -> None:
        for prefix in prefixes:
            del self.rows[prefix]
        self.rows |= parts

    def giants(self, shards: int) -> tuple[list[bytes], set[bytes]]:
        """The prefixes of groups larger than an even share of what is left, largest
        first, and the prefixes of buckets that must be refined to tell."""
        left, found = sum(size for size, _, _ in self.rows.values()), []
        for prefix, (size, low, high) in sorted(self.rows.items(), key=lambda item: (-item[1][0], item[0])):
            if len(found) == shards - 1 or size * (shards - len(found)) <= left:
                return found, set()
            if low != high:
                return found, {prefix}
            found.append(prefix)
            left -= size
        return found, set()

    def ordered(self, without: list[bytes]) -> "Line":
        return Line([(prefix, *self.rows[prefix]) for prefix in sorted(self.rows) if prefix not in set(without)])


class Line:
    """Buckets in order with running sums, for greedy filling."""

    def __init__(self, buckets: list[tuple[bytes, int, bytes, bytes]]):
        self.buckets = buckets
        self.ends = list(accumulate((b[1] for b in buckets), initial=0))
        self.total = self.ends[-1]
        # the largest part that can't be cut, by either reading
        self.whole = max((b[1] for b in buckets), default=0)
        self.atom = max((b[1] for b in buckets if b[2] == b[3]), default=0)

    def cuts(self, capacity: int, divisible: bool) -> list[int]:
        """Where shards filled up to ``capacity`` end, the last one at the total."""
        at, found = 0, []
        while at < self.total:
            end = min(at + capacity, self.total)
            i = bisect_right(self.ends, end) - 1
            inside = divisible and self.ends[i] < end and self.buckets[i][2] != self.buckets[i][3]
            at = end if inside else self.ends[i]
            found.append(at)
        return found

    def smallest(self, shards: int, divisible: bool) -> int:
        """The least capacity with which ``shards`` shards hold everything."""
        low, high = max(self.atom if divisible else self.whole, -(-self.total // shards)), max(self.total, 1)
        while low < high:
            middle = (low + high) // 2
            if len(self.cuts(middle, divisible)) <= shards:
                high = middle
            else:
                low = middle + 1
        return low

    def open(self, low: int, high: int) -> set[bytes]:
        """Buckets of several groups that a cut can fall in for capacities low to high."""
        found = set()
        early, late = self.cuts(low, False) if low >= self.whole else [], self.cuts(high, True)
        loose = self.cuts(low, True)
        for j in range(max(len(early), len(late), len(loose))):
            ends = [cuts[j] for cuts in (early, late, loose) if j < len(cuts)]
            first, last = bisect_right(self.ends, min(ends)) - 1, bisect_left(self.ends, max(ends))
            found.update(prefix for prefix, _, a, b in self.buckets[max(first - 1, 0) : last + 1] if a != b)
        return found


def summed(rows: DataFrame, length: int, within: DataFrame | None = None) -> dict[bytes, tuple[int, bytes, bytes]]:
    """Size, least and greatest digest by the first ``length`` bytes of the digest."""
    at = F.substring("digest", 1, length)
    if within is not None:
        rows = rows.join(F.broadcast(within), F.substring("digest", 1, length - 1) == F.col("prefix"), "left_semi")
    found = rows.groupBy(at.alias("prefix")).agg(F.sum("size").alias("size"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    return {bytes(r["prefix"]): (r["size"], bytes(r["low"]), bytes(r["high"])) for r in found.toLocalIterator()}


def plan(rows: DataFrame, shards: int = SHARDS) -> tuple[list[bytes], list[bytes], int]:
    """The digests of groups that are shards of their own, the last digest of each of the
    other shards but the last, and the capacity of these. ``rows`` has digest and size."""
    spark = rows.sparkSession
    buckets = Buckets(summed(rows, FIRST))
    while True:
        giants, refine = buckets.giants(shards)
        line, count = buckets.ordered(giants), shards - len(giants)
        if not refine:
            low, high = line.smallest(count, True), line.smallest(count, False)
            if low == high:
                break
            refine = line.open(low, high)
        for length in sorted({len(prefix) for prefix in refine}):
            chosen = [prefix for prefix in refine if len(prefix) == length]
            within = spark.createDataFrame([(bytearray(p),) for p in chosen], "prefix binary")
            buckets.refine(chosen, summed(rows, length + 1, within))
    # no cut of the smallest capacity lies inside a bucket: both readings agree on it
    ends = [bisect_left(line.ends, cut) for cut in line.cuts(high, False)]
    return [buckets.rows[p][1] for p in giants], [line.buckets[end - 1][3] for end in ends[:-1]], high


def shard_of(digest: Column, giants: list[bytes], cuts: list[bytes]) -> Column:
    """The shard of a digest: giants come first, then the stretches in order."""
    shard = F.lit(len(giants))
    for cut in cuts:
        shard = shard + (digest > F.lit(cut)).cast("int")
    for at, giant in enumerate(giants):
        shard = F.when(digest == F.lit(giant), at).otherwise(shard)
    return shard.cast("int")


def sharded(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row's id, size, text_crc32, shard and slot."""
    content = F.coalesce(docs[text], F.lit("")).cast("binary")
    rows = docs.select(
        docs[key].cast("long").alias("id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.monotonically_increasing_id().alias("at"),
    )
    rows = stored(rows, "sizes")
    giants, cuts, _ = plan(rows, shards)
    placed = rows.withColumn("shard", shard_of(F.col("digest"), giants, cuts)).withColumn("known", F.col("id").isNotNull())
    numbered = with_row_id(placed, ["shard", "known", "id", "digest", "at"], "slot")
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    before = list(accumulate((counts.get(s, 0) for s in range(shards)), initial=0))
    start = F.element_at(F.array(*[F.lit(b).cast("long") for b in before[:-1]]), F.col("shard") + 1)
    return numbered.select("id", "size", "text_crc32", "shard", (F.col("slot") - 1 - start).alias("slot"))


def op13_shards(spark, sf_dir: str) -> DataFrame:
    found = sharded(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_FILL = "f{n} AS (SELECT p.n, min(greatest(f.cap, p.upto - f.upto)) AS cap, any_value(p.upto) AS upto FROM f{p} f JOIN pre p ON p.n >= f.n GROUP BY p.n)"
_CUT = "x{n} AS (SELECT coalesce(max(upto), 0) AS upto FROM pre WHERE upto <= (SELECT upto FROM x{p}) + (SELECT cap FROM best))"

ORACLE = f"""
WITH poly AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b::BIGINT, range(0, 8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
d AS (SELECT doc_id, coalesce(text, '') AS text, sha256(coalesce(text, '')) AS h, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
crc AS (SELECT h, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda v: ('0x' || v)::BIGINT)), lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) AS text_crc32 FROM (SELECT h, any_value(text) AS text FROM d GROUP BY h), poly),
g AS (SELECT h, sum(size)::BIGINT AS size FROM d GROUP BY h),
big AS (SELECT h, size, row_number() OVER w AS k, sum(size) OVER () - sum(size) OVER w + size AS rest FROM g WINDOW w AS (ORDER BY size DESC, h ROWS UNBOUNDED PRECEDING)),
giant AS (SELECT h, k FROM big WHERE k < coalesce((SELECT min(k) FROM big WHERE k = {SHARDS} OR size * ({SHARDS} + 1 - k) <= rest), {SHARDS})),
own AS (SELECT count(*) AS n FROM giant),
pre AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) AS n, h, sum(size) OVER (ORDER BY h ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM g WHERE h NOT IN (SELECT h FROM giant)),
f0 AS (SELECT 0 AS n, 0::BIGINT AS cap, 0::BIGINT AS upto),
{", ".join(_FILL.format(n=n, p=n - 1) for n in range(1, SHARDS + 1))},
best AS (SELECT arg_max(q.cap, q.n) AS cap FROM ({" UNION ALL ".join(f"SELECT {n} AS shards, n, cap FROM f{n}" for n in range(1, SHARDS + 1))}) q, own WHERE shards = {SHARDS} - own.n),
x0 AS (SELECT 0::BIGINT AS upto),
{", ".join(_CUT.format(n=n, p=n - 1) for n in range(1, SHARDS + 1))},
cut AS (SELECT DISTINCT upto FROM ({" UNION ALL ".join(f"SELECT upto FROM x{n}" for n in range(1, SHARDS + 1))})),
place AS (SELECT h, k - 1 AS shard FROM giant UNION ALL SELECT h, (SELECT n FROM own) + (SELECT count(*) FROM cut WHERE cut.upto < pre.upto) AS shard FROM pre)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, h) - 1 AS slot, NULL::INT AS grown_shard FROM d JOIN crc USING (h) JOIN place USING (h)
"""
