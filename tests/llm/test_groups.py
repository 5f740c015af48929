"""Centroids, conversation repair and shards against brute force, and their defined cases."""

import hashlib
import heapq
import itertools
import math
import random
import zlib

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  executors get the functions by value
from arealis.llm import centroids, sharding, turns

# --- centroids --------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, width, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == width and None not in v and all(math.isfinite(x) for x in v)]
    kept = [(i, q) for i, q in kept if max(map(abs, q)) <= centroids.LARGEST]
    seeds = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), q) for i, q in kept)[:k]
    middle = [q for _, q in seeds]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        label = [near(q)[1] for _, q in kept]
        for j in range(len(middle)):
            mine = [q for (_, q), at in zip(kept, label, strict=True) if at == j]
            if mine:
                middle[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted((-1 if i is None else i, near(q)[1], near(q)[0]) for i, q in kept), middle


def clustered(table, **given):
    rows, found = centroids.cluster(table, **given)
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in rows.collect()), found


def vectors(seed=1, n=900, width=6):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) + (i % 3) for _ in range(width)]) for i in range(n)]
    same = rows[5][1]
    rows += [(1000 + i, same) for i in range(400)]  # copies
    rows += [(2000, None), (2001, []), (2002, [1.0]), (2003, [None] * width), (2004, [math.nan] * width), (2005, [math.inf] * width), (2006, [3e38] * width)]
    rows += [(None, [0.5] * width), (7, [0.25] * width), (7, [0.0] * width), (7, [0.0] * width), (2007, [-1000.0] * width), (2008, [1000.0] * width)]
    return rows


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_centroids(spark, monkeypatch, bits):
    monkeypatch.setattr(centroids, "FILE_ROWS", 500)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want, middle = plain_clusters(rows, 5, 3, 6, 64.0)
    got, found = clustered(table, k=5, width=6, bits=bits)
    assert got == want and [c["centroid"] for c in found] == middle
    assert [c["inertia"] for c in found] == [sum(d for _, j, d in want if j == at) for at in range(5)]
    assert [c["count"] for c in found] == [sum(j == at for _, j, _ in want) for at in range(5)]
    assert len(found[0]["undecided"]) == 4


def test_centroids_are_decided_by_cells(spark):
    """Narrow cells leave few vectors open."""
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 0.125) for _ in range(64)]) for i in range(1000)]
    got, found = clustered(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert len(got) == 1000 and max(found[0]["undecided"]) < 100


def test_centroid_bounds():
    rng = np.random.default_rng(3)
    x = rng.integers(-30, 30, (500, 8))
    middle = rng.integers(-30, 30, (7, 8))
    borders = np.sort(rng.integers(-30, 30, (8, 3)), axis=1)
    cells = np.stack([np.searchsorted(borders[d], x[:, d], "right") for d in range(8)], axis=1)
    assert (centroids.unpack(centroids.pack(cells, 2), 8, 2) == cells).all()
    low, high = centroids.intervals(cells, centroids.lookups(middle, borders, x.min(axis=0), x.max(axis=0)))
    exact = ((x[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (low <= exact).all() and (exact <= high).all() and (low < exact).any()


def test_centroid_cases(spark):
    kind = "vec_id long, embedding array<double>"
    assert clustered(spark.createDataFrame([], kind)) == ([], [])
    assert clustered(spark.createDataFrame([(1, None), (2, [1.0])], kind)) == ([], [])
    few = spark.createDataFrame([(3, [1.0] * 64, "x", "y"), (4, [2.0] * 64, "x", "y"), (4, [2.0] * 64, "x", "y")], kind + ", cells string, label string")
    got, found = clustered(few)
    assert [d for _, _, d in got] == [0, 0, 0] and len(found) == 3 and sorted(c["count"] for c in found) == [0, 1, 2]
    big = spark.createDataFrame([(1, [2.0**20] * 64), (2, [-(2.0**20)] * 64)], kind)
    assert clustered(big, k=1)[0] == [(1, 0, 64 * 2**52), (2, 0, 64 * 2**52)]


# --- conversations ----------------------------------------------------------------------------


def initials(roles):
    return "".join(r[0] for r in roles)


def plain_repair(rows):
    """Cheapest edits by a search over whole audits; rows (role, text) in order."""
    faults, seen = [], set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    found, queue, done = None, [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, last, made = heapq.heappop(queue)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            found = cost, audit, made
            break
        asked = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[asked]
        heapq.heappush(queue, (cost + 2, audit + "I", at, asked, (*made, (name, ""))))
        if at < len(rows):
            role, text = rows[at]
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, last, made))
            if faults[at] not in ("blank", "duplicate"):
                more = cost + (faults[at] == "truncated")
                heapq.heappush(queue, (more + 2, audit + "R", at + 1, asked, (*made, (name, text))))
                if role[:1] == asked:
                    heapq.heappush(queue, (more, audit + "K", at + 1, asked, (*made, (role, text))))
                if role[:1] == "s" and last == "":
                    heapq.heappush(queue, (more, audit + "K", at + 1, "s", (*made, (role, text))))
    cost, audit, made = found
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    count = lambda f: sum(x == f for x in faults)
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(rows)]
    return count("blank"), count("duplicate"), count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest


TEXTS = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Yes.\n", ".", "é", "a: b\nc."]
ROLES = ["user", "assistant", "system", "tool", "User", "", "ally"]


def conversation(rng, n):
    rows = []
    for turn in range(n):
        role = rng.choice(ROLES) if rng.random() < 0.4 else ["user", "assistant"][turn % 2]
        rows.append((role, rng.choice(TEXTS) if rng.random() < 0.7 else f"{rng.random()}."))
    return rows


def test_turns(spark):
    rng = random.Random(4)
    talks = {c: conversation(rng, c % 23) for c in range(150)} | {500: conversation(rng, 400), 501: [("user", "Yes.")] * 300}
    rows = [(c, t, role, text, 1) for c, talk in talks.items() for t, (role, text) in enumerate(talk)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv long, turn long, role string, text string, times long").repartition(3)
    got = {r["conv"]: tuple(r)[2:] for r in turns.repair(table).collect()}
    want = {c: plain_repair(talk) for c, talk in talks.items() if talk}
    assert got == want


def test_turns_least_audit():
    """Ties: the audit is the ASCII-least one of all cheapest."""
    for codes in itertools.product(range(9), repeat=4):
        best = min_audit(codes)
        assert turns.Solver().audit(bytes(codes)) == best[1]
        assert turns.cost_of(best[1], bytes(codes)) == best[0]


def min_audit(codes):
    ways = {0: (0, "")}
    for at in range(len(codes) + 1):
        for _ in range(4):
            for state, (cost, audit) in list(ways.items()):
                after = turns._NEXT[state]
                ways[after] = min(ways.get(after, (99, "")), (cost + 2, audit + "I"))
        if at == len(codes):
            break
        more = {}
        for state, (cost, audit) in ways.items():
            code = codes[at]
            steps = [(state, 3, "D")]
            if code != turns.GONE:
                steps.append((turns._NEXT[state], 2 + (code >> 2), "R"))
                if turns.kept_state(state, code) is not None:
                    steps.append((turns.kept_state(state, code), code >> 2, "K"))
            for after, price, letter in steps:
                more[after] = min(more.get(after, (99, "")), (cost + price, audit + letter))
        ways = more
    return min(ways[s] for s in (0, 3) if s in ways)


def test_turns_long():
    """A long conversation: linear space, and the same audit as row by row."""
    rng = random.Random(9)
    codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 8, 1, 2]) for _ in range(20_000))
    solver = turns.Solver()
    audit = solver.audit(codes)
    back = tuple(len(turns.ENDINGS[s]) * 2 for s in turns.STATES)
    for code in reversed(codes):
        back = tuple(min(more + back[to] for to, more, _ in turns.EDITS[code][s]) for s in turns.STATES)
    assert turns.cost_of(audit, codes) == back[0]
    assert sum(letter != "I" for letter in audit) == len(codes)
    assert len(solver.ahead) < 3000 and len(solver.back) < 3000


def test_turns_cases(spark):
    kind = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], kind)
    assert turns.repair(turns.damaged(turns.turned(empty))).count() == 0
    key = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([None, "A b.", "c? d", "é!"])) for c in [None, *range(60)] for t in [None, *range(3)]]
    rows += [(77, t, "user", "x") for t in range(1000) if key(77, t) == 0][:2]  # all its rows go
    rows += [(78, 1, "user", "B."), (78, 1, "user", "B."), (78, 5, "assistant", "C.")]
    plain = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", hashlib.sha256((r[3] or " ").encode()).digest())):
        talk = plain.setdefault(c, [])
        role, text, k = role or " ", text or " ", key(c, t)
        text = "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text
        talk += [(t, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    want = {}
    for c, talk in plain.items():
        met = {t for t, _, _ in talk if t is not None}
        talk = sorted(talk, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        want[c] = (max(met) - min(met) + 1 - len(met) if met else 0, *plain_repair([(r, x) for _, r, x in talk]))
    for extra in ("", ", conv string, digest string, times string, code string"):
        table = spark.createDataFrame([(*r, *["q"] * extra.count(",")) for r in rows], kind + extra).repartition(3)
        got = {r["conv"]: tuple(r)[1:] for r in turns.repair(turns.damaged(turns.turned(table))).collect()}
        assert got == want
    assert want[77] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# --- shards -----------------------------------------------------------------------------------


def plain_cuts(sizes, shards):
    """Smallest capacity for stretches of ``sizes`` in order, by trying all cut points."""
    upto = [0, *itertools.accumulate(sizes)]
    best = [0] + [math.inf] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[j], upto[i] - upto[j]) for j in range(i + 1)) for i in range(len(upto))]
    return best[-1]


def shard_rows(spark, texts, shards, ids=None, extra=""):
    rows = [(i, t, *["q"] * extra.count(",")) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    table = spark.createDataFrame(rows, "doc_id long, text string" + extra).repartition(3)
    return [r.asDict() for r in sharding.sharded(table, shards).collect()]


def held(texts, rows, shards):
    """Checks what must hold of any sharding; gives the bytes by shard."""
    assert sorted(r["id"] for r in rows) == list(range(len(texts)))
    where, slots, sums = {}, {}, [0] * shards
    for r in rows:
        raw = (texts[r["id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        assert where.setdefault(raw, r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append((r["slot"], r["id"]))
        sums[r["shard"]] += r["size"]
    for found in slots.values():
        assert [s for s, _ in sorted(found)] == list(range(len(found)))
        assert [i for _, i in sorted(found)] == sorted(i for _, i in found)
    return sums


@pytest.mark.parametrize("first", [1, 2])
def test_shards(spark, monkeypatch, first):
    monkeypatch.setattr(sharding, "FIRST", first)
    rng = random.Random(first)
    texts = ["é" * rng.randrange(60) + str(rng.randrange(700)) for _ in range(900)] + [None, "", None]
    texts += ["copy" * 40] * 200 + ["other" * 30] * 130  # two groups beyond an even share
    sums = held(texts, shard_rows(spark, texts, 6), 6)
    groups = {}
    for t in texts:
        raw = (t or "").encode()
        groups[raw] = groups.get(raw, 0) + len(raw) + 1
    order = sorted(groups, key=lambda raw: hashlib.sha256(raw).digest())
    big = sorted(groups.values(), reverse=True)[:2]
    assert sums[:2] == big
    rest = [groups[raw] for raw in order if groups[raw] not in big]
    assert max(sums[2:]) == plain_cuts(rest, 4)
    assert min(sums[2:]) > 0.8 * max(sums[2:])


def test_shards_of_one_bucket(spark, monkeypatch):
    """Every cut lies inside buckets that have to be refined byte by byte."""
    texts = [f"text {i} " * (i % 7) for i in range(300)]
    want = held(texts, shard_rows(spark, texts, 5), 5)
    real = sharding.F.unhex
    monkeypatch.setattr(sharding.F, "unhex", lambda c: sharding.F.concat(sharding.F.lit(b"\0\0\0\0"), real(c)))
    assert held(texts, shard_rows(spark, texts, 5), 5) == want


def test_shard_cases(spark):
    assert shard_rows(spark, [], 16) == []
    one = shard_rows(spark, ["same"] * 50, 16)
    assert {r["shard"] for r in one} == {0} and sorted(r["slot"] for r in one) == list(range(50))
    few = shard_rows(spark, ["a", "bb", None], 16, extra=", shard string, size string, digest string")
    assert len({r["shard"] for r in few}) == 3 and sorted(r["size"] for r in few) == [1, 2, 3]
    repeated = shard_rows(spark, ["a", "a", "b", "c", None], 2, ids=[None, None, 4, 4, None])
    assert sorted(r["size"] for r in repeated) == [1, 2, 2, 2, 2]
    for shard in {r["shard"] for r in repeated}:
        assert sorted(r["slot"] for r in repeated if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in repeated)))
    long = held(["x" * 500_000, "y", "z"], shard_rows(spark, ["x" * 500_000, "y", "z"], 3), 3)
    assert sorted(long) == [2, 2, 500_001]
