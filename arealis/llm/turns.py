"""Repair of conversations: audits, faults and the cheapest edits, by divide and conquer.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Four states
tell how far a legal one has come: nothing yet, after system, after user, after
assistant. A row is kept (0), given the role the state asks for (2) or deleted (3);
rows of user or assistant with an empty text may be inserted anywhere (2). Blank and
duplicate rows must be deleted, truncated ones that stay cost 1.

Of a stretch of rows the costs of its first half, from the state it starts in, and of
its second half, to the state it ends in, are two vectors of four. The states whose two
costs have the least sum are the optimal crossings; the one whose audit (the initials of
the edits) is ASCII-least is taken, and both halves are solved alike. Ties need no audit:
two audits of the same rows never are one another's beginning if both end in a row's own
edit, so the order of the four best first halves is carried along as ranks. Space is
linear, and a vector is one of few (costs less their least, and ranks), so a step is a
lookup in a table that fills as it is used.

Texts meet their conversation once. Faults are found on skinny rows (a digest for the
text): equal rows of a turn are one row with a count, combined inside tasks, and the
first turn of each role and digest comes by an aggregate and a join, so neither copies
nor a conversation with very many rows gather for it. Edits need one byte per row, as
long as the audit that is asked for. Last, a conversation's audit and its texts in order
stream past a digest, which is sequential by definition but keeps no text.

Defined cases: a null in any column but turn reads as one space, as does a null turn in
the damage key; a null turn sorts first and counts in no gap; a null conversation is a
conversation; rows of one turn are ordered by role, then by the digest of their text
(repeated rows are adjacent); only the initial of a role counts, an empty role or any
other initial fits nowhere and is reroled or deleted; an empty table gives no row; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import documents, stored

# the six ASCII white space characters
SPACE = r"\x20\x09-\x0D"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
# states: nothing yet, after system, after user, after assistant
STATES = range(4)
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # where a user or assistant row leads
_NAME = {2: "user", 3: "assistant"}
_INITIALS = ("s", "u", "a", "")  # the last one stands for all others
# a row's code: 0 to 3 its initial, plus 4 if truncated; 8 if it must go
GONE = 8
FAR = 1 << 40
# more than a detour to any other state costs: two rows inserted, or one deleted and one inserted
BEHIND = 6


# --- one conversation -------------------------------------------------------------------------


def kept_state(state: int, code: int) -> int | None:
    """The state after keeping a row, None if it does not fit."""
    initial = _INITIALS[code & 3]
    if initial == "s":
        return 1 if state == 0 else None
    after = _NEXT[state]
    return after if initial and _NAME[after][0] == initial else None


def _edits(code: int) -> list[list[tuple[int, int, str]]]:
    """For each state the (next state, cost, letters) of a row and the insertions before
    it: per next state the cheapest, ASCII-least of equal ones."""
    found = []
    for start in STATES:
        best, state, cost, letters = {}, start, 0, ""
        for _ in range(3):
            ways = [(state, COST[DELETE], DELETE)]
            if code != GONE:
                stays = TRUNCATED if code & 4 else 0
                ways.append((_NEXT[state], COST[REROLE] + stays, REROLE))
                if kept_state(state, code) is not None:
                    ways.append((kept_state(state, code), COST[KEEP] + stays, KEEP))
            for after, more, letter in ways:
                best[after] = min(best.get(after, (FAR, "")), (cost + more, letters + letter))
            state, cost, letters = _NEXT[state], cost + COST[INSERT], letters + INSERT
        found.append([(after, *way) for after, way in sorted(best.items())])
    return found


EDITS = [_edits(code) for code in range(GONE + 1)]
# what a state still needs after the last row
ENDINGS = {0: "", 1: "II", 2: "I", 3: ""}


class Solver:
    """Cheapest edits of conversations given as bytes of row codes."""

    def __init__(self):
        self.ahead, self.back = {}, {}

    def _ahead(self, vector, code, early):
        """Costs and ranks after one more row, less the least cost. States that can't be
        on a cheapest way are given up, so that vectors repeat: if the stretch is to end
        before any user row (``early``), those after one; else those that cost more than
        ``BEHIND`` above the least, as the others can follow any way from there for that."""
        known = self.ahead.get((vector, code, early))
        if known is None:
            best = {}
            for state, (cost, rank) in enumerate(vector):
                if cost < FAR:
                    for after, more, letters in EDITS[code][state]:
                        if not (early and after > 1):
                            best[after] = min(best.get(after, (FAR, 0, "")), (cost + more, rank, letters))
            least = min(way[0] for way in best.values())
            order = sorted((way[1:], state) for state, way in best.items() if way[0] <= least + BEHIND)
            ranked = {state: (best[state][0] - least, rank) for rank, (_, state) in enumerate(order)}
            known = self.ahead[vector, code, early] = tuple(ranked.get(s, (FAR, 0)) for s in STATES)
        return known

    def _back(self, vector, code):
        """Costs to the end before one more row, less the least."""
        known = self.back.get((vector, code))
        if known is None:
            costs = [min((more + vector[after] for after, more, _ in EDITS[code][state]), default=FAR) for state in STATES]
            least = min(costs)
            known = self.back[vector, code] = tuple(c - least if c < FAR else FAR for c in costs)
        return known

    def _stretch(self, codes, low, high, start, goal, out):
        """Letters of rows low to high from ``start`` to an end that costs ``goal`` by
        state; gives the state they end in."""
        if high - low == 1:
            _, letters, state = min((more + goal[to], letters, to) for to, more, letters in EDITS[codes[low]][start])
            out.append(letters)
            return state
        middle = (low + high) // 2
        early = goal[2] >= FAR and goal[3] >= FAR
        ahead = tuple((0, 0) if s == start else (FAR, 0) for s in STATES)
        for at in range(low, middle):
            ahead = self._ahead(ahead, codes[at], early)
        back = goal
        for at in range(high - 1, middle - 1, -1):
            back = self._back(back, codes[at])
        crossing = min((ahead[s][0] + back[s], ahead[s][1], s) for s in STATES)[2]
        self._stretch(codes, low, middle, start, tuple(0 if s == crossing else FAR for s in STATES), out)
        return self._stretch(codes, middle, high, crossing, goal, out)

    def audit(self, codes: bytes) -> str:
        """The initials of the cheapest edits, ASCII-least of equal ones."""
        out = []
        goal = tuple(len(ENDINGS[s]) * COST[INSERT] for s in STATES)
        state = self._stretch(codes, 0, len(codes), 0, goal, out) if codes else 0
        return "".join(out) + ENDINGS[state]


def cost_of(audit: str, codes: bytes) -> int:
    """What the edits of an audit cost."""
    total, at = 0, 0
    for letter in audit:
        total += COST[letter]
        if letter != INSERT:
            total += TRUNCATED if letter != DELETE and codes[at] & 4 else 0
            at += 1
    return total


# --- rows -------------------------------------------------------------------------------------


def turned(rows: DataFrame) -> DataFrame:
    """Rows as conv, turn, role, text, with nulls of role and text as one space."""
    blank = F.lit(" ")
    return rows.select(
        rows["conv_id"].cast("long").alias("conv"),
        rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"].cast("string"), blank).alias("role"),
        F.coalesce(rows["text"].cast("string"), blank).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``turned`` with their damage, and how often each is there (``times``)."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    return rows.withColumn("kind", kind).select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("times"),
    )


ORDER = ("turn_known", "turn", "role", "digest")


def digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).withColumn("turn_known", F.col("turn").isNotNull())


def skinny(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text: times, code, and whether an earlier
    turn has the same role and text. Rows that are not there keep their conversation."""
    last = F.regexp_extract("text", rf"([^{SPACE}])[{SPACE}]*\z", 1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = digested(rows).select("conv", *ORDER, "times", F.when(last == "", GONE).when(last.isin(".", "!", "?"), code).otherwise(code + 4).alias("code"), code.alias("initial"))
    once = marked.groupBy("conv", *ORDER).agg(F.sum("times").alias("times"), F.first("code").alias("code"), F.first("initial").alias("initial"))
    once = stored(once, "turns")
    there = once.where("times > 0")
    first = there.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn_known", "turn")).alias("first"), F.count("*").alias("turns"))
    # only what occurs in several turns has to be looked up again
    again = first.where("turns > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    met = once.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    earlier = F.col("first").isNotNull() & ~F.struct("turn_known", "turn").eqNullSafe(F.col("first"))
    return met.select("conv", *ORDER, "times", "code", "initial", earlier.alias("seen"))


REPORT = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation from rows of ``skinny``: counts, cost and audit."""

    def run(batches):
        import pyarrow as pa

        solver, state = Solver(), None

        def start(conv):
            return {"conv": conv, "codes": bytearray(), "low": None, "high": None, "turns": 0, "last": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "initial": None}

        def finish(s):
            codes = bytes(s["codes"])
            audit = solver.audit(codes)
            gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
            return s["conv"], gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost_of(audit, codes), audit

        def batch_of(done):
            kinds = [pa.int64()] * 7 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=NAMES)

        done = []
        for batch in batches:
            for conv, turn, times, code, initial, seen in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if state is None or state["conv"] != conv:
                    if state is not None:
                        done.append(finish(state))
                    state = start(conv)
                if not times:
                    continue
                if turn is not None and turn != state["last"]:
                    state["low"] = turn if state["low"] is None else state["low"]
                    state["high"], state["last"] = turn, turn
                    state["turns"] += 1
                if state["initial"] is not None and not legal(state["initial"], initial):
                    state["illegal"] += 1
                state["illegal"] += times - 1
                state["initial"] = initial
                copies = times if seen else times - 1
                if code == GONE:
                    state["blank"] += times
                    state["codes"] += bytes([GONE]) * times
                else:
                    state["duplicate"] += copies
                    if not seen:
                        state["codes"].append(code)
                        state["truncated"] += code >> 2
                    state["codes"] += bytes([GONE]) * copies
                if len(done) >= 2000:
                    yield batch_of(done)
                    done = []
        if state is not None:
            done.append(finish(state))
        if done:
            yield batch_of(done)

    NAMES = [part.split()[0] for part in REPORT.split(", ")]
    dealt = rows.repartition("conv").sortWithinPartitions("conv", *ORDER)
    return dealt.select("conv", "turn", "times", "code", "initial", "seen").mapInArrow(run, REPORT)


def legal(before: int, after: int) -> bool:
    """Whether two initials may stand side by side: su, ua or au."""
    return (before, after) in ((0, 1), (1, 2), (2, 1))


def repaired(report: DataFrame, rows: DataFrame) -> DataFrame:
    """``report`` with the digest of each repaired conversation. Per conversation the
    report's row comes first, then its rows in order; only the digest is kept."""

    def run(batches):
        import pyarrow as pa

        state, done = None, []

        def start(conv, report, audit):
            return {"conv": conv, "report": report, "audit": audit, "at": 0, "state": 0, "sha": hashlib.sha256(), "any": False}

        def say(s, role, text):
            s["sha"].update(f"{chr(10) if s['any'] else ''}{role}:{text}".encode())
            s["any"] = True

        def inserted(s):
            """Insertions that come next, as far as the audit has them."""
            while s["at"] < len(s["audit"]) and s["audit"][s["at"]] == INSERT:
                s["state"] = _NEXT[s["state"]]
                say(s, _NAME[s["state"]], "")
                s["at"] += 1

        def row(s, role, text):
            inserted(s)
            letter = s["audit"][s["at"]]
            s["at"] += 1
            if letter == KEEP:
                s["state"] = 1 if role[0] == "s" else _NEXT[s["state"]]
                say(s, role, text)
            elif letter == REROLE:
                s["state"] = _NEXT[s["state"]]
                say(s, _NAME[s["state"]], text)

        def finish(s):
            inserted(s)
            return s["report"] | {"repaired_sha256": s["sha"].hexdigest()}

        schema = pa.schema([(part.split()[0], pa.string() if part.split()[1] == "string" else pa.int64()) for part in OUT.split(", ")])
        for batch in batches:
            for conv, report, role, text, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if report is not None:
                    if state is not None:
                        done.append(finish(state))
                    state = start(conv, report, report["audit"])
                for _ in range(times if report is None else 0):
                    row(state, role, text)
                if len(done) >= 2000:
                    yield pa.RecordBatch.from_pylist(done, schema=schema)
                    done = []
        if state is not None:
            done.append(finish(state))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    OUT = REPORT + ", repaired_sha256 string"
    heads = report.select("conv", F.lit(0).alias("part"), F.struct(*report.columns).alias("report"))
    texts = digested(rows.where("times > 0")).withColumn("part", F.lit(1))
    both = heads.unionByName(texts, allowMissingColumns=True)
    dealt = both.repartition("conv").sortWithinPartitions("conv", "part", *ORDER)
    return dealt.select("conv", "report", "role", "text", "times").mapInArrow(run, OUT)


def repair(rows: DataFrame) -> DataFrame:
    """Report, audit and digest per conversation, for rows conv, turn, role, text, times."""
    return repaired(stored(reports(skinny(rows)), "reports"), rows)


def op12_turns(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(turned(documents(spark, sf_dir, "conversations")))).withColumnRenamed("conv", "conv_id")


_STEP = """
SELECT conv, i + 1 AS i, st, cost, audit, done, line FROM (
  SELECT s.conv, s.i, x.st, s.cost + x.cost AS cost, s.audit || x.letters AS audit,
    s.done || x.made || CASE WHEN x.letter = 'K' THEN r.role || ':' || r.text || chr(10) WHEN x.letter = 'R' THEN x.name || ':' || r.text || chr(10) ELSE '' END AS done, 0 AS line
  FROM s JOIN r ON r.conv IS NOT DISTINCT FROM s.conv AND r.n = s.i JOIN ways x ON x.was = s.st AND x.fault = r.fault AND (x.letter <> 'K' OR x.initial = r.initial))
QUALIFY row_number() OVER (PARTITION BY conv, st ORDER BY cost, audit) = 1"""

ORACLE = rf"""
WITH RECURSIVE poly AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b::BIGINT, range(0, 8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
o AS (SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
c AS (SELECT conv, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda h: ascii(h)::BIGINT)), lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 20 AS kind FROM o, poly),
dam AS (SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) - 1 AS n, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail, left(role, 1) AS initial FROM dam),
f AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
  lag(initial) OVER (PARTITION BY conv ORDER BY n) || initial AS pair FROM n),
r AS MATERIALIZED (SELECT conv, n, role, text, initial, CASE WHEN fault IN ('blank', 'duplicate') THEN 'gone' ELSE fault END AS fault FROM f),
ins(was, st, cost, letters, made) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 2, 'I', 'user:' || chr(10)), (1, 2, 2, 'I', 'user:' || chr(10)), (3, 2, 2, 'I', 'user:' || chr(10)), (2, 3, 2, 'I', 'assistant:' || chr(10)),
  (0, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
own(was, st, cost, letter, initial, name) AS (VALUES (0, 0, 3, 'D', '', ''), (1, 1, 3, 'D', '', ''), (2, 2, 3, 'D', '', ''), (3, 3, 3, 'D', '', ''),
  (0, 2, 2, 'R', '', 'user'), (1, 2, 2, 'R', '', 'user'), (3, 2, 2, 'R', '', 'user'), (2, 3, 2, 'R', '', 'assistant'),
  (0, 1, 0, 'K', 's', ''), (0, 2, 0, 'K', 'u', ''), (1, 2, 0, 'K', 'u', ''), (3, 2, 0, 'K', 'u', ''), (2, 3, 0, 'K', 'a', '')),
ways AS MATERIALIZED (SELECT ins.was, own.st, fault, ins.cost + own.cost + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 1 ELSE 0 END AS cost, ins.letters || letter AS letters, letter, initial, name, made
  FROM ins JOIN own ON own.was = ins.st, (VALUES ('none'), ('truncated'), ('gone')) AS q(fault) WHERE fault <> 'gone' OR letter = 'D'),
s AS (SELECT DISTINCT conv_id AS conv, 0::BIGINT AS i, 0 AS st, 0 AS cost, '' AS audit, '' AS done, 0 AS line FROM conversations UNION ALL {_STEP}),
ended AS (SELECT s.conv, s.cost + e.cost AS cost, s.audit || e.letters AS audit, s.done || e.made AS done FROM s LEFT JOIN (SELECT conv, count(*) AS n FROM r GROUP BY conv) k ON k.conv IS NOT DISTINCT FROM s.conv
  JOIN ins e ON e.was = s.st AND e.st IN (0, 3) AND (e.st = 3 OR e.letters = '') WHERE s.i = coalesce(k.n, 0)),
best AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY conv ORDER BY cost, audit) = 1),
counts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv)
SELECT b.conv AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
  sha256(CASE WHEN done = '' THEN '' ELSE left(done, length(done) - 1) END) AS repaired_sha256
FROM best b LEFT JOIN counts k ON k.conv IS NOT DISTINCT FROM b.conv
"""
