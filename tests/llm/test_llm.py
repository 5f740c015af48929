"""The text operators against brute force, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  executors get the functions by value
import corpus_pipeline
from arealis.llm import bpe, exact_dedup, jaccard_join, language_id, main_text, mixing, passages, private_data, token_index, vector_join
from arealis.llm.common import components, stored
from arealis.llm.shingles import shingle_set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("al", "be", "cor", "du", "en", "fa") for b in ("ra", "ti", "mon", "ve", "lis", "qua", "so")]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows_of(seed=3):
    """Prose, exact and near copies, nulls, blanks, a long text, repeated rows."""
    rng = random.Random(seed)
    base = [text_of(rng, n) for n in (3, 12, 40, 90, 200, 400)]
    texts = [*base, *base[:4], None, "", " \n\t", "x", "a b\nc d", "ab cd", text_of(rng, 6000), "é" * 50, "<|endoftext|> end", "A  B", "a\x0bb"]
    for t in base[2:]:
        words = t.split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s1", None]), len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, base[3], "en", "s0", 5), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Extra columns with the names that the operators use themselves."""
    names = "digest content size file row key cls comp whole identity score lang_pred mix_copy value kind"
    rows = [(*r, *["q"] * len(names.split())) for r in rows_of()]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", {n} string" for n in names.split()))


def linked(ids, links):
    at = {i: i for i in ids}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        at[b] = a
    return {i: root(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(600, 640)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = linked({x for link in links for x in link}, links)
    met = {x for a, b in links if a != b for x in (a, b)}
    assert found == {i: want[i] for i in met}


# --- language ---------------------------------------------------------------------------------


def test_language(spark):
    rng = random.Random(2)
    kinds = {"aa": "abc", "bb": "xyz"}
    rows = [(i, " ".join("".join(rng.choice(kinds[k]) for _ in range(5)) for _ in range(30)), k) for i in range(300) for k in [rng.choice(["aa", "bb"])]]
    rows += [(1000, None, "aa"), (1001, "123 !!", "bb"), (1002, "abc bca cab" * 20_000, None), (None, "xyz zyx", "aa")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(table)
    found = {r["doc_id"]: r for r in language_id.identify(table, model).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["lang_pred"] == k for i, _, k in rows[:300])
    assert (found[1000]["lang_pred"], found[1000]["score"]) == (found[1001]["lang_pred"], found[1001]["score"]) == ("und", 0.0)
    assert found[1002]["lang_pred"] == "aa" and 0 < found[1002]["score"] <= 1
    assert 0 < (model.weights == 0).mean() < 1  # sparse


def test_language_stretches(monkeypatch):
    text = "Ab1c  déf. ghi" * 40
    whole = language_id.counted(text)
    monkeypatch.setattr(language_id, "STRETCH", 7)
    assert (language_id.counted(text) == whole).all()


def test_language_cases(none, odd):
    assert language_id.fit(none) is None
    assert language_id.identify(none, None).count() == 0
    found = language_id.identify(odd, language_id.fit(odd))
    assert set(odd.columns) <= set(found.columns) and found.count() == odd.count()


def test_temperature():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(4000, 3)) * 2
    labels = np.array([rng.choice(3, p=p) for p in language_id.softmax(scores / 4)])
    assert abs(language_id.temperature(scores, labels) - 4) < 0.6


# --- exact copies -----------------------------------------------------------------------------


def copies(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i if i is not None else 1 << 63, i))
    return groups


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: exact_dedup.F.substring(exact_dedup.sha256(c), 1, 0).cast("binary")])
def test_exact_dedup(docs, digest):
    decided, _ = exact_dedup.deduplicate(docs, digest=digest)
    found = Counter((r["id"], r["keep_id"], r["group_size"]) for r in decided.collect())
    groups = copies(rows_of())
    want = Counter((i, min(g)[2], len(g)) for g in groups.values() for _, _, i in g)
    assert found == want
    assert decided.where("kept").count() == len(groups)


def test_exact_dedup_batches(docs):
    decided, _ = exact_dedup.deduplicate(docs.repartition(6), files_per_batch=2)
    assert decided.where("kept").count() == len(copies(rows_of()))


def test_exact_dedup_cases(none, odd):
    assert exact_dedup.unique(none).count() == 0
    kept = exact_dedup.unique(odd)
    assert kept.columns == odd.columns and kept.count() == len(copies(rows_of()))


# --- vectors ----------------------------------------------------------------------------------


def test_vectors(spark, monkeypatch):
    for name, value in (("CELL", 20), ("TILE", 16), ("STREAM", 7)):
        monkeypatch.setattr(vector_join, name, value)
    rng = np.random.default_rng(5)
    heart = rng.normal(size=(12, 8))
    x = np.concatenate([rng.normal(size=(60, 8)), np.repeat(heart, 15, axis=0) + rng.normal(size=(180, 8)) * 0.12]).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, None), (1003, []), (1004, [0.0] * 8), (1005, [1.0, None] * 4), (1006, [float("nan")] * 8), (1007, [1.0, 2.0]), (1008, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = {r["id"]: (r["n_links"], r["component"]) for r in vector_join.linked(table).collect()}
    good = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(i, j) for i in good for j in good if i != j and len(good[i]) == len(good[j]) and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.95]
    degree, comp = Counter(i for i, _ in links), linked([r[0] for r in rows], links)
    assert found == {i: (degree[i], comp[i]) for i, _ in rows}
    assert vector_join.linked(table.limit(0)).count() == 0


def near_ones(rng, kind):
    """Random vectors of 64 components, some near others or equal, a dense group, and a few
    of another length; no cosine lies at the limit itself."""
    x = rng.normal(size=(260, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    shift = rng.normal(size=(120, 64))
    shift /= np.linalg.norm(shift, axis=1)[:, None]
    close = x[:120] + shift * np.linspace(0.05, 0.6, 120)[:, None]
    group = x[200] + rng.normal(size=(90, 64)) * 0.01
    other = rng.normal(size=(3, 40))
    rows = [*x, *close, *group, *x[:20], other[0], other[0] * 2, other[1], other[2], other[2]]
    return [(i, [float(v) for v in np.asarray(r, kind)]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("kind,sample,most", [("float32", 1024, 24 << 20), ("float64", 3, -1)])
def test_vectors_are_not_copied_to_cells(spark, monkeypatch, kind, sample, most):
    for name, value in (("CELL", 40), ("TILE", 64), ("STREAM", 16), ("SAMPLE", sample), ("BROADCAST_BYTES", most), ("UNIT", 5)):
        monkeypatch.setattr(vector_join, name, value)
    rows = near_ones(np.random.default_rng(7), kind)
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{'float' if kind == 'float32' else 'double'}>").repartition(3)
    dealt, repartition = [], type(table).repartition
    monkeypatch.setattr(type(table), "repartition", lambda self, *args: (dealt.append(self.count()), repartition(self, *args))[1])
    found = {r["id"]: (r["n_links"], r["component"]) for r in vector_join.linked(table).collect()}
    # only so many rows as there are vectors, though each may have partners in any cell
    assert dealt and max(dealt) <= len(rows)
    good = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows}
    links = [(i, j) for i in good for j in good if i != j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.95]
    degree, comp = Counter(i for i, _ in links), linked(list(good), links)
    assert found == {i: (degree[i], comp[i]) for i in good}


def test_few_dimensions_lose_no_pair():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(200, 80)) * rng.random(80), rng.normal(size=(40, 80)) * 0.02 + 1])
    y = np.concatenate([x[:100] + rng.normal(size=(100, 80)) * 0.2, rng.normal(size=(50, 80))])
    x, y = (vector_join.normed(z) for z in (x, y))
    for main in (vector_join.directions(x), vector_join.directions(x[:5]), np.eye(31, 80)):
        few = [vector_join.reduced(z, main) for z in (x, y)]
        assert few[0].shape[1] <= vector_join.FEW and (few[0] @ few[1].T + vector_join.rounding(32) >= x @ y.T).all()


# --- tokens -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


def test_bpe(library):
    rng = random.Random(7)
    own = bpe.Codec(bpe.tokenizer_path())
    letters = "ab ethn\n\t 's12é.,!ñ日🙂 \x85\x0b\x1c"
    texts = ["", " ", "  a  b ", "x" * 3000, "a<|endoftext|> b", "²½ Ⅷ", "it's 'll we'll", "日本語 テキスト 🙂🙂"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(70))) for _ in range(1500)]
    texts += ["one two three", "one two three\n", "two", "three four\n", "one", " ".join(rng.choice(WORDS) for _ in range(3000))]
    packed = token_index.LibraryEncoder(bpe.tokenizer_path())
    for size in (1, 7, len(texts)):
        for at in range(0, len(texts), size):
            some = texts[at : at + size]
            batch, decimals = own.batch(some)
            flat, ends = packed.encoder.batch(some, packed.kind)
            for k, (text, found, decimal) in enumerate(zip(some, batch, decimals, strict=True)):
                ids = library.encode(text, add_special_tokens=False).ids
                assert found.tolist() == own.encode(text).tolist() == flat[ends[k] : ends[k + 1]].tolist() == ids
                assert bytes(decimal).decode() == ",".join(map(str, ids))
                assert own.vocabulary.decode(found) == library.decode(ids, skip_special_tokens=False)
    assert own.batch([]) == ([], []) and [len(x) for x in own.batch(["", ""])[0]] == [0, 0]


def test_bpe_rows(docs, none, odd, library, monkeypatch):
    found = bpe.round_trip(docs, texts=True).collect()
    assert Counter(r["decoded"] for r in found) == Counter(r[1] or "" for r in rows_of())
    assert all(hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest() == r["ids_sha256"] and r["n_tokens"] == len(r["ids"]) for r in found)
    assert bpe.round_trip(none).count() == 0 and bpe.round_trip(odd).count() == len(rows_of())
    own = bpe.Codec(bpe.tokenizer_path())
    monkeypatch.setattr(bpe, "STRETCH", 3)
    text = "héllo 🙂 wörld 日本"
    assert bpe._long(own, own.encode(text)) == text


def test_token_store(docs, none, odd, library):
    store = token_index.build(docs)
    rows = sorted(rows_of(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for i, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = store.read(docs.select(docs.doc_id.alias("key")))
    assert Counter(tuple(r) for r in found.collect()) == Counter(want)
    some = store.read(docs.sparkSession.createDataFrame([(4,), (12345,), (-1,)], "key long"), ids=True).collect()
    assert len(some) == 3 and {r["doc_id"] for r in some} == {4}  # three rows share the identifier
    assert token_index.build(none).read(none.select(none.doc_id.alias("key"))).count() == 0
    assert token_index.build(odd).read(odd.select(odd.doc_id.alias("key"))).count() == len(rows)


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    table = token_index.PerfectHash.build(keys)
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    index = token_index.Index(b"".join(token_index.index_parts(keys, np.arange(len(keys)), np.ones(len(keys), np.int64))))
    there, number, _ = index.find(keys[::-1].copy())
    assert len(there) == len(keys) and (number == np.arange(len(keys))[::-1]).all()
    assert len(index.find(keys + 1)[0]) < 5


# --- shingles ---------------------------------------------------------------------------------


def plain_sets(rows):
    sets = []
    for _, text, *_ in rows:
        words = (re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).encode().split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    return sets


def test_shingles(monkeypatch):
    from arealis.llm import shingles

    rng = random.Random(4)
    text = text_of(rng, 500).replace(" ", "\n ", 40)
    whole = shingle_set(text)
    monkeypatch.setattr(shingles, "STRETCH", 50)
    assert (shingle_set(text) == whole).all()
    assert len(whole) == len(plain_sets([(0, text)])[0])


def near_rows():
    rng = random.Random(9)
    rows = [(i, t) for i, t, *_ in rows_of() if i is not None][:-2]
    for base in range(8):
        words = text_of(rng, 60 + 20 * base).split()
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append((1000 + len(rows), " ".join(copy[: len(copy) - rng.randrange(6)])))
    passage = text_of(rng, 55)
    rows += [(5000 + i, text_of(rng, 40) + " " + passage + " " + text_of(rng, 30)) for i in range(30)]
    return rows


def test_jaccard(spark):
    rows = near_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found, _ = jaccard_join.similar(table)
    sets = plain_sets(rows)
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    comp = linked([r[0] for r in rows], links)
    want = Counter((i, len(s), comp[i]) for (i, _), s in zip(rows, sets, strict=True))
    assert Counter((r["id"], r["size"], r["component"]) for r in found.collect()) == want
    kept = jaccard_join.thinned(table)
    empty = sum(not s for s in sets)
    assert kept.count() == len({comp[i] for (i, _), s in zip(rows, sets, strict=True) if s}) + empty


def test_jaccard_bound():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(rng.integers(0, len(a) + 1))], rng.integers(0, 2**63, int(rng.integers(1, 40))).astype(np.uint64)]))
        if jaccard_join.match(a, b):
            assert jaccard_join.may_match(jaccard_join.parity_bits(a), jaccard_join.parity_bits(b), len(a), len(b))


def test_jaccard_cases(none, odd):
    assert jaccard_join.thinned(none).count() == 0
    kept = jaccard_join.thinned(odd)
    assert kept.columns == odd.columns and 0 < kept.count() < odd.count()


# --- mixing -----------------------------------------------------------------------------------


def test_poisson(spark):
    import math

    means = [0.01, 0.5, 3.0, 40.0, 900.0]
    rows = [(u / 97, m) for u in range(97) for m in means]
    for u, m, k in spark.createDataFrame(rows, "u double, m double").select("u", "m", mixing.poisson(mixing.F.col("u"), mixing.F.col("m"))).collect():
        cdf = lambda n: sum(math.exp(-m + j * math.log(m) - math.lgamma(j + 1)) for j in range(n + 1))
        assert cdf(k) > u - 1e-9 and (k == 0 or cdf(k - 1) <= u + 1e-9)


def test_mixing(spark, none, odd):
    rows = [(i, f"text {i}", ["a", "b", None][min(i % 10, 2)]) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(table, {"a": 0.5, None: 0.5, "absent": 0.0}, size=2.0)
    count = Counter(r["source"] for r in mixed.collect())
    assert abs(count["a"] - 3000) < 350 and abs(count["b"] + count[None] - 3000) < 350
    order = [r["mix_order"] for r in mixed.collect()]
    assert order == sorted(order)
    assert mixing.mix(none, {None: 1.0}).count() == 0
    assert set(odd.columns) <= set(mixing.mix(odd, {"s0": 1.0, None: 1.0}).columns)
    assert mixing.mix(table, {"a": 1.0}).where("source is null or source = 'b'").count() == 0


# --- passages ---------------------------------------------------------------------------------


def test_passages(spark, none, odd):
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    exact, fuzzy = fresh(70), fresh(90)
    worn = list(fuzzy)
    for at in (20, 45, 70):
        worn[at] = "other"
    del worn[60]
    texts = [fresh(30) + exact + fresh(40), fresh(10) + exact, fresh(60) + fuzzy + fresh(5), worn + fresh(33), fresh(300), fresh(20) + exact[:30], [], None]
    rows = [(i, None if t is None else " ".join(t)) for i, t in enumerate(texts)]
    found = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    pairs = {tuple(sorted((r["doc_id"], r["other_id"]))): r for r in found}
    assert set(pairs) == {(0, 1), (2, 3)}
    bounds = {r[d]: (r[s], r[e]) for r in found for d, s, e in (("doc_id", "start", "end"), ("other_id", "other_start", "other_end"))}
    assert bounds[0] == (30, 100) and bounds[1] == (10, 80)
    assert bounds[2] == (60, 150) and bounds[3] == (0, 89)
    assert pairs[2, 3]["agree"] == 86
    assert passages.repeated(none).count() == 0
    assert passages.repeated(odd).count() > 0


def test_passages_of_equal_documents(spark):
    """Copies are whole passages of the first one; what that shares with others is found."""
    rng = random.Random(31)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    one, brief = fresh(120), fresh(45)
    texts = [fresh(80), one, fresh(30) + one[20:100], [w.upper() for w in one], one, brief, brief, None, None, fresh(20) + brief + fresh(9) + brief[:2]]
    found = passages.repeated(spark.createDataFrame([(i, None if t is None else "  ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)).collect()
    rows = {(r["doc_id"], r["other_id"]): (r["start"], r["end"], r["other_start"], r["other_end"], r["alike"]) for r in found}
    assert rows[3, 1] == rows[4, 1] == (0, 120, 0, 120, 1.0) and rows[2, 1] == (30, 110, 20, 100, 1.0)
    assert set(rows) == {(3, 1), (4, 1), (2, 1)}


def test_passages_of_frequent_lines(spark):
    """Passages whose lines are all frequent by themselves."""
    rng = random.Random(21)
    lines = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(25)) for _ in range(50)]
    texts = [" ".join(" ".join(rng.choice(lines) for _ in range(1)) + f" f{i}a{j} f{i}b{j}" for j in range(6)) for i in range(400)]
    planted = []
    for n in range(10):
        three = " ".join(rng.sample(lines, 3))
        for at in rng.sample(range(400), 2):
            texts[at] += f" g{n} h{at} " + three
            planted.append((at, three))
    found = passages.repeated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    places = defaultdict(list)
    for r in found:
        places[r["doc_id"]].append((r["start"], r["end"]))
        places[r["other_id"]].append((r["other_start"], r["other_end"]))
    for at, three in planted:
        words, part = texts[at].split(), three.split()
        start = next(i for i in range(len(words)) if words[i : i + 75] == part)
        assert any(lo <= start and start + 75 <= hi for lo, hi in places[at])


def test_passages_down_to_alike(spark):
    """Words changed at even distances, down to 0.8 alike: every pair is found."""
    rng = random.Random(22)
    rows, wanted = [], set()
    for n in range(200):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([50, 60, 80]))]
        every = rng.choice([5, 6, 8, 10])
        worn = [f"x{n}x{i}" if i % every == every // 2 else w for i, w in enumerate(words)]
        rows += [(2 * n, " ".join(["a", str(n), *words, f"b{n}"])), (2 * n + 1, " ".join([f"c{n}", *worn, "d", f"e{n}"]))]
        wanted.add((2 * n, 2 * n + 1))
    found = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {tuple(sorted((r["doc_id"], r["other_id"]))) for r in found} == wanted


def test_passages_against_brute_force(spark):
    """Of all places of runs of 51 words that two texts share, nearly all are covered."""
    rng = random.Random(23)
    pool = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 60))) for _ in range(60)]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(250)] + [" ".join(pool[:4])] * 3
    found = passages.repeated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    covered = defaultdict(set)
    for r in found:
        covered[r["doc_id"]].update(range(r["start"], r["end"]))
        covered[r["other_id"]].update(range(r["other_start"], r["other_end"]))
        x, y = texts[r["doc_id"]].split()[r["start"] : r["end"]], texts[r["other_id"]].split()[r["other_start"] : r["other_end"]]
        assert min(len(x), len(y)) >= 50 and r["alike"] >= 0.8 and r["agree"] <= min(len(x), len(y))
    places = defaultdict(set)
    for i, t in enumerate(texts):
        words = t.split()
        for at in range(len(words) - 50):
            places[tuple(words[at : at + 51])].add((i, at))
    shared = [place for group in places.values() if len({i for i, _ in group}) > 1 for place in group]
    missed = [1 for i, at in shared if not set(range(at, at + 51)) <= covered[i]]
    assert len(shared) > 4000 and len(missed) <= 0.01 * len(shared)


def test_partners_of_every_place():
    """Each place of a hash that two documents have meets one of another document."""
    rng = random.Random(1)
    for _ in range(500):
        rows = sorted({(rng.randrange(4), rng.randrange(5), rng.randrange(40)) for _ in range(rng.randrange(1, 40))})
        of = defaultdict(set)
        for h, d, _ in rows:
            of[h].add(d)
        hashes, docs, at = (np.array(x) for x in zip(*rows))
        first, second, a, b = passages.partners(*passages.recurring(docs, at, hashes.astype(np.uint64)))
        kinds = defaultdict(set)
        for h, d, p in rows:
            kinds[d, p].add(h)
        assert (first < second).all() and all(kinds[i, x] & kinds[j, y] for i, j, x, y in zip(*(z.tolist() for z in (first, second, a, b))))
        met = {*zip(first.tolist(), a.tolist()), *zip(second.tolist(), b.tolist())}
        assert all((d, p) in met for h, d, p in rows if len(of[h]) > 1)


def test_passages_that_one_text_repeats(spark):
    """Every place of a run of 50 words that two texts share is in a row, also where a text
    has it more often than all others, or both repeat one word."""
    rng = random.Random(43)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    part, other = fresh(70), fresh(60)
    texts = [fresh(30) + part + fresh(9), [w for _ in range(4) for w in [*fresh(20), *part]], fresh(8) + part + part + fresh(5)]
    texts += [other * 3 + fresh(12), fresh(5) + other, fresh(80)]
    texts += [fresh(6) + ["x"] * n + fresh(7) for n in (90, 480, 200)] + [["y"] * 60 + fresh(3) + ["y"] * 130, fresh(4) + ["y"] * 55]
    found = passages.repeated(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)).collect()
    covered = defaultdict(set)
    for r in found:
        x, y = texts[r["doc_id"]][r["start"] : r["end"]], texts[r["other_id"]][r["other_start"] : r["other_end"]]
        assert r["doc_id"] != r["other_id"] and min(len(x), len(y)) >= 40 and r["agree"] <= min(len(x), len(y))
        covered[r["doc_id"]].update(range(r["start"], r["end"]))
        covered[r["other_id"]].update(range(r["other_start"], r["other_end"]))
    places = defaultdict(set)
    for i, words in enumerate(texts):
        for at in range(len(words) - 49):
            places[tuple(words[at : at + 50])].add((i, at))
    shared = [place for group in places.values() if len({i for i, _ in group}) > 1 for place in group]
    assert len(shared) > 900 and all(set(range(at, at + 50)) <= covered[i] for i, at in shared)


def test_chains():
    rng = random.Random(1)
    for _ in range(60):
        points = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(12)})
        a, b = [p[0] for p in points], [p[1] for p in points]
        for chain in passages.chains(a, b):
            assert all(a[i] < a[j] and b[i] < b[j] for i, j in zip(chain, chain[1:]))
    line = [(i * 7, i * 7 + 3) for i in range(9)] + [(30, 4)]
    line.sort()
    a, b = zip(*line)
    assert max(map(len, passages.chains(list(a), list(b)))) == 9


# --- pages ------------------------------------------------------------------------------------


def test_main_text(spark):
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav>a b</nav>
    <div class="sidebar">Side. text, yes.</div><div class="post"><h2>Head&amp;s</h2><p>Hello   world, this is <a href=x>a link</a> text. More, of it.</p>
    One &lt;two<p>Short<p>Next</p><ul><li>i1<li>i2</ul></div><div id="comments"><p>Great post, thanks. Really.</p></div>
    <div class="cookie-notice">We use cookies.</div><form>Name, please.</form><!-- gone --><footer>c</footer></body></html>"""
    assert main_text.main_text(page) == "Head&s\nHello world, this is a link text. More, of it.\nOne <two\nShort\nNext\ni1\ni2"
    assert main_text.main_text("<p>a<p>b") == "a\nb"
    assert main_text.main_text("no tags") == "no tags"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "<nav>x</nav>"), (4, "u", "<article>" + "<p>Long, text.</p>" * 20_000)]
    found = {r["page_id"]: r for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[2]["text"] == found[3]["text"] == found[None]["text"] == ""
    assert found[4]["n_chars"] == 20_000 * len("Long, text.\n") - 1


def test_main_text_names():
    """Names on the list that do not speak against the article."""
    text = "".join(f"<p>Paragraph {i} of the story, with commas, and a point at its end.</p>" for i in range(6))
    want = main_text.main_text(f"<body>{text}</body>")
    assert want.count("\n") == 5
    for page in (
        f"<body class='home no-sidebar'>{text}</body>",
        f"<body><div class='content with-sidebar'>{text}</div></body>",
        f"<article class='post has-comments'>{text}</article>",
        f"<body><div class='sidebar'>{text}</div><p>More.</p></body>",
    ):
        assert want in main_text.main_text(page), page
    for name in ("related-work", "side-effects", "search-algorithms", "social-impact"):
        more = "<h2>Title</h2><p>A section of its own, with words, as long as the others are.</p>"
        assert "A section of its own" in main_text.main_text(f"<article>{text}<section id='{name}'>{more}</section></article>")
    assert main_text.main_text(f"<body><article>{text}</article><div id='comments'>{text * 3}</div><div class='social-links'><p>Like</p><p>Pin</p></div></body>") == want


def test_main_text_ratios():
    """Without article or main the ratios choose the container."""
    text = "".join(f"<p>Paragraph {i} of the story, with commas, and a point at its end.</p>" for i in range(6))
    links = "".join(f"<ul><li><a href=x>link {i}</a></li></ul>" for i in range(8))
    found = main_text.main_text(f"<body><div><div>{links}</div></div><section>{text}<p>Short</p></section></body>")
    assert found.startswith("Paragraph 0") and found.endswith("\nShort") and "link" not in found


# --- private data -----------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def counts(kind, value):
    digits = re.sub(r"\D", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_patterns(spark):
    rng = random.Random(8)
    pieces = ["a@b.c", "x.y+z@mail-1.example.org", "1.2.3.4", "300.1.1.1", "001.2.3.255", "4111 1111 1111 1111", "4111111111111111", "+1 (743) 555-3824", "+44.20.7946.0958", "@", ".", "-", " ", "é", "🙂", "9", "12", "+", "a", "\n", "5500-0000-0000-0004"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(400)]
    texts += ["1" * 50_000, "a" * 100_000 + "@", "1 " * 40_000, "+1" + "(" * 50_000, None, ""]
    table = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), "texts")
    meta = table.select("doc_id", table.metadataColumn("_metadata").getField("file_path").alias("file"), table.metadataColumn("_metadata").getField("row_index").alias("row"))
    found = private_data.matches(table, "text").where("kind <> 'token'").join(meta, ["file", "row"])
    got = Counter((r["doc_id"], r["kind"], r["start"], r["end"]) for r in found.collect())
    want = Counter((i, k, m.start(), m.end()) for i, t in enumerate(texts) for k, p in PLAIN.items() for m in re.finditer(p, t or "") if (k != "email" or i < 400) and counts(k, m[0]))
    assert got == want


def test_bootstrapping(spark):
    rng = random.Random(6)
    phones = [f"+1 {rng.randrange(200, 999)} 555 {rng.randrange(1000, 9999)}" for _ in range(12)]
    rows = [(i, f"please dial {p} for help with case {i}") for i, p in enumerate(phones)]
    rows += [(100, "please dial 743-555-38245 for help"), (101, "the year was 20240101 then"), (102, "please wait"), (103, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found, located = private_data.spans(table)
    meta = located.select("doc_id", located.metadataColumn("_metadata").getField("file_path").alias("file"), located.metadataColumn("_metadata").getField("row_index").alias("row"))
    fresh = [(r["doc_id"], r["kind"], r["start"], r["end"]) for r in found.where("not base").join(meta, ["file", "row"]).collect()]
    assert fresh == [(100, "phone", 12, 25)]
    assert found.where("base").count() == 12


def fresh_spans(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, located = private_data.spans(table)
    meta = located.select("doc_id", located.metadataColumn("_metadata").getField("file_path").alias("file"), located.metadataColumn("_metadata").getField("row_index").alias("row"))
    return {(r["doc_id"], texts[r["doc_id"]][r["start"] : r["end"]], r["kind"]) for r in found.where("not base").join(meta, ["file", "row"]).collect()}


def test_bootstrapping_groups(spark):
    texts = [f"please dial +1 {200 + i} 555 {1000 + i} for help" for i in range(12)]
    texts += ["please dial 743 555 3824 for help", "please dial (743) 555-3825 for help", "please dial 74355538 for help", "1 " * 40_000 + "x"]
    assert fresh_spans(spark, texts) == {(12, "743 555 3824", "phone"), (13, "(743) 555-3825", "phone"), (14, "74355538", "phone")}


def test_bootstrapping_rounds(spark):
    """Found instances bring in the pattern that they stand in elsewhere, and so on."""
    texts = [f"please dial +1 {200 + i} 555 {1000 + i} for help" for i in range(90)]
    wanted, sizes = set(), (45, 22, 11, 5, 2)
    frames = ["please dial {} for help", "kindly ring {} right away", "never fax {} without notice", "always text {} before noon", "simply page {} after dark", "again call {} at last"]
    for step in range(len(frames) - 1):
        for i in range(sizes[step]):
            number = f"7{step}3 555 {4000 + i}"
            for frame in frames[step : step + 2]:
                wanted.add((len(texts), number, "phone"))
                texts.append(frame.format(number))
    assert fresh_spans(spark, texts) == wanted


def test_private_cases(none, odd):
    assert private_data.spans(none)[0].count() == 0
    assert private_data.spans(odd)[0].count() == 0


# --- pipeline ---------------------------------------------------------------------------------


def test_pipeline(spark, docs, none, odd):
    rows = stored(docs, "docs")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows
        rows = stored(stage(spark, before, None), name)
        assert rows.columns == before.columns
        if name == "language_id":
            assert rows.where("text is null or not text rlike '[a-zA-Z]'").count() == 0 or rows.where("text rlike '^é'").count() == rows.where("not text rlike '[a-zA-Z]'").count()
    last = corpus_pipeline.STAGES[-1][1](spark, rows, None)
    assert Counter(r["doc_id"] for r in last.collect()) == Counter(r["doc_id"] for r in rows.collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "mixing", "bpe"]
    for table in (stored(none, "none"), stored(odd, "odd")):
        for name, stage in corpus_pipeline.STAGES:
            table = stored(stage(spark, table, None), name)
