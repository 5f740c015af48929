"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Only DataFrame functions. Base patterns give the seeds: e-mail and IP addresses, card
and phone numbers. The words beside a seed are lexical patterns; other digit-bearing
tokens that stand in the same contexts are candidate instances. Patterns and instances
form a graph that is scored in turn for each kind, until no more instances are accepted: a pattern's confidence is the scored
share of the distinct instances it meets, an instance's score the chance that not all
its patterns err. Instances that confident patterns, each supported by several distinct
seeds or instances accepted before, score high enough become spans of that kind, unless they touch a base span.

The regular expressions are written so that no text makes them backtrack; they match
what the plain forms in the comments match, leftmost and without overlap.

Defined cases: null and empty texts have no spans; a null identifier is kept; repeated
rows are searched each for themselves but count once as evidence; texts of any length
are searched whole; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import documents, stored
from arealis.llm.exact_dedup import located

KINDS = ("email", "ip", "card", "phone")
# a lookbehind keeps later starts in a run from being tried; \G lets a match follow another
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # digit groups, bare or in brackets, with at most one space, point or hyphen between
    "group": r"(?<![A-Za-z0-9@._%+/:-])(?:\([0-9]++\)|[0-9]++(?![._-]?[A-Za-z@_%+/:]))(?:[\x20.-]?(?:\([0-9]++\)|[0-9]++(?![._-]?[A-Za-z@_%+/:])))++",
    # a run of identifier characters with a digit
    "token": r"(?<![A-Za-z0-9@._%+/:-])[A-Za-z@._%+/:-]*+[0-9][A-Za-z0-9@._%+/:-]*+",
}
MARKS = {"email": "@", "phone": "+", "ip": "."}  # a match holds this character
CONTEXT = 80  # characters of context looked at
ROUNDS = 3  # at least
SUPPORT = 3  # distinct seeds or accepted instances a pattern needs
CONFIDENT = 0.6  # for a pattern to score instances
ACCEPTED = 0.8  # for an instance to become a span
SHORTEST, DIGITS = 6, 4  # of an instance


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: Column, value: Column) -> Column:
    """Whether a match of a base pattern counts."""
    digits = _digits(value)
    parts = F.transform(F.split(value, r"\."), lambda x: F.regexp_replace(x, "^0+", ""))
    small = F.forall(parts, lambda x: (F.length(x) < 3) | (F.length(x) == 3) & (x <= "255"))
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", F.length(digits).between(13, 19) & F.call_function("luhn_check", digits))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .when(kind == "group", value.rlike(r"[\x20()]") & (F.length(value) >= SHORTEST) & (F.length(digits) >= DIGITS))
        .when(kind == "token", (F.length(value) >= SHORTEST) & (F.length(digits) >= DIGITS))
        .otherwise(F.lit(True))
    )


def matches(docs: DataFrame, text: str) -> DataFrame:
    """All valid matches: file, row, kind, value, start, end (code points, end
    exclusive), before and after (context)."""
    meta = docs.metadataColumn("_metadata")
    body = F.col("text")
    rows = docs.select(meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row"), docs[text].alias("text")).where(body.rlike("[0-9@]"))

    def searched(kind: str) -> Column:
        pattern = PATTERNS[kind]
        mark = F.contains(body, F.lit(MARKS[kind])) if kind in MARKS else F.lit(True)
        gaps = F.transform(F.split(body, pattern, -1), lambda x: F.struct(F.length(x).alias("size"), F.right(x, F.lit(CONTEXT)).alias("tail"), F.left(x, F.lit(CONTEXT)).alias("head")))
        return F.when(mark, F.struct(F.lit(kind).alias("kind"), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("values"), gaps.alias("gaps")))

    found = rows.select("file", "row", F.explode(F.array(*[searched(k) for k in PATTERNS])).alias("of")).where("size(of.values) > 0")
    found = found.select("file", "row", "of.kind", "of.values", "of.gaps")
    item = F.arrays_zip(F.col("values").alias("value"), F.col("gaps").alias("gap"), F.slice("gaps", F.lit(2), F.size("gaps")).alias("next"))
    found = found.select("file", "row", "kind", F.posexplode(item).alias("at", "item"))
    found = found.select("file", "row", "kind", "at", F.col("item.value").alias("value"), F.col("item.gap.size").alias("gap"), F.col("item.gap.tail").alias("before"), F.col("item.next.head").alias("after")).where("value is not null")
    so_far = Window.partitionBy("file", "row", "kind").orderBy("at")
    found = found.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far)).withColumn("start", F.col("end") - F.length("value"))
    # what a token ends with is punctuation of the sentence
    core = F.when(F.col("kind") == "token", F.regexp_replace("value", "[@._%+/:-]+$", "")).otherwise(F.col("value"))
    found = found.withColumn("value", core).withColumn("end", F.col("start") + F.length("value"))
    found = found.where(valid(F.col("kind"), F.col("value"))).replace("group", "token", "kind")
    return found.select("file", "row", "kind", "value", "start", "end", "before", "after")


def contexts(before: Column, after: Column) -> Column:
    """The lexical patterns of a place: the word or two before, the word after."""
    word = r"([^\s]+)"
    one = F.regexp_extract(before, word + r"\s*$", 1)
    two = F.regexp_extract(before, r"([^\s]+\s+[^\s]+)\s*$", 1)
    right = F.regexp_extract(after, r"^[^\s]*\s*" + word, 1)
    plain = lambda x: F.regexp_replace(F.lower(x), r"[0-9]+|\s+", " ")
    found = F.array(
        F.when(one != "", F.concat(F.lit("1 "), plain(one))),
        F.when(two != "", F.concat(F.lit("2 "), plain(two))),
        F.when((one != "") & (right != ""), F.concat(F.lit("3 "), plain(one), F.lit(" _ "), plain(right))),
    )
    return F.filter(found, lambda x: x.isNotNull())


def discovered(found: DataFrame) -> DataFrame:
    """New spans: file, row, kind, start, end."""
    base = F.col("kind") != "token"
    place = Window.partitionBy("file", "row").orderBy("start", "end")
    left = F.max(F.when(base, F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    right = F.min(F.when(base, F.col("start"))).over(place.rowsBetween(1, Window.unboundedFollowing))
    free = found.withColumn("left", left).withColumn("right", right)
    free = free.where(base | ((F.coalesce("left", F.lit(0)) <= F.col("start")) & (F.col("right").isNull() | (F.col("right") >= F.col("end")))))
    places = stored(free.select("file", "row", "kind", "value", "start", "end", contexts(F.col("before"), F.col("after")).alias("patterns")), "places")

    edges = places.select(F.explode("patterns").alias("pattern"), "value", F.when(base, F.col("kind")).alias("seed")).distinct()
    edges = stored(edges, "edges")
    sizes = edges.groupBy("pattern").agg(F.countDistinct("value").alias("meets"))
    seeds = edges.where("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    open_edges = edges.where("seed is null").select("pattern", "value")
    sizes = stored(sizes, "sizes")
    scores, rounds, most, accepted = seeds, 0, -1, 0
    while rounds < ROUNDS or accepted > most:
        rounds, most = rounds + 1, max(most, accepted)
        told = edges.join(scores, "value").where("seed is null or seed = kind").groupBy("pattern", "kind")
        support = F.countDistinct(F.when(F.col("score") >= ACCEPTED, F.col("value")))
        graph = told.agg(F.sum("score").alias("weight"), support.alias("support")).where(F.col("support") >= SUPPORT)
        confident = graph.join(sizes, "pattern").select("pattern", "kind", (F.col("weight") / (F.col("meets") + 0.5)).alias("confidence")).where(F.col("confidence") >= CONFIDENT)
        doubt = F.least("confidence", F.lit(0.99))
        fresh = open_edges.join(confident, "pattern").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - doubt)))).alias("score"))
        scores = stored(seeds.unionByName(fresh.join(seeds.select("value"), "value", "left_anti")), "scores")
        accepted = scores.where(F.col("score") >= ACCEPTED).count()
    chosen = scores.where(F.col("score") >= ACCEPTED).groupBy("value").agg(F.max(F.struct("score", "kind")).alias("best")).select("value", F.col("best.kind").alias("as_kind"))
    taken = places.where("kind = 'token'").join(chosen, "value").select("file", "row", F.col("as_kind").alias("kind"), "start", "end")
    # a token inside a span of several digit groups is part of it
    wider = Window.partitionBy("file", "row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return taken.withColumn("so_far", F.max("end").over(wider)).where("so_far is null or end > so_far").drop("so_far")


def spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All spans (file, row, kind, start, end, base), and the located frame."""
    docs = located(docs)
    found = stored(matches(docs, text), "matches")
    base = found.where("kind <> 'token'").select("file", "row", "kind", "start", "end", F.lit(True).alias("base"))
    return base.unionByName(discovered(found).withColumn("base", F.lit(False))), docs


def op10_private_data(spark, sf_dir: str) -> DataFrame:
    found, docs = spans(documents(spark, sf_dir))
    order = reduce(lambda c, k: c.when(F.col("kind") == k[1], F.lit(k[0])), enumerate(KINDS), F.when(F.lit(False), F.lit(-1)))
    span = F.struct(order.alias("at"), "start", "end", "kind")
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS]
    of_doc = found.groupBy("file", "row").agg(*counts, F.collect_list(F.when(F.col("base"), span)).alias("base_spans"), F.collect_list(span).alias("all_spans"))
    of_doc = of_doc.withColumn("base_text", joined(F.col("base_spans"))).withColumn("spans", joined(F.col("all_spans"))).drop("base_spans", "all_spans")
    meta = docs.metadataColumn("_metadata")
    rows = docs.select("doc_id", meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row")).join(of_doc, ["file", "row"], "left")
    return rows.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base_text", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
