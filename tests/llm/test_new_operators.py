"""Periodic runs, I-Match fingerprints and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cairn.llm import imatch, periodic_runs, spelling
from tests.llm.test_edges import CLASHING, LONG, ROWS, SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["v"] * len(CLASHING)) for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


# --- periodic runs --------------------------------------------------------------------------------------------------


def plain_runs(words, min_length=24, min_periods=3):
    """All runs, by comparing each place with all that follow."""
    found = {}
    for p in range(1, len(words) // min_periods + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(min_length, min_periods * p) and i > start:
                found.setdefault((start, i + p - start), p)
            i += 1
    return sorted((s, n, p) for (s, n), p in found.items())


def periodic_text(rng, size):
    words = []
    while len(words) < size:
        if rng.random() < 0.5:
            piece = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 30))]
            words += (piece * rng.randint(2, 9))[: -rng.randint(1, len(piece))]
        else:
            words += [rng.randint(1, 4) for _ in range(rng.randint(1, 10))]
    return np.array(words, np.int64)


@pytest.mark.parametrize("modulus", [1, 1 << 20])
@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed, modulus, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SPARSE_FROM", modulus)
    monkeypatch.setattr(periodic_runs, "PAIRS", 100)
    rng = random.Random(seed)
    for _ in range(25):
        given = [periodic_text(rng, rng.choice([0, 1, 23, 24, 60, 300])) for _ in range(rng.randint(1, 5))]
        least = rng.choice([(24, 3), (24, 3), (2, 2), (7, 2), (10, 4)])
        got = periodic_runs.runs_of(given, *least)
        assert [[tuple(r) for r in runs.tolist()] for runs in got] == [
            [(s, n, p) for s, n, p in sorted(plain_runs(t.tolist(), *least), key=lambda r: (r[0], r[2]))] for t in given
        ]


@pytest.mark.parametrize("modulus", periodic_runs.COVERS)
def test_covers_hold_every_difference(modulus):
    cover = periodic_runs.COVERS[modulus]
    assert {(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def test_extensions_equal_comparison():
    rng = random.Random(3)
    given = [periodic_text(rng, 400), periodic_text(rng, 150)]
    words = periodic_runs.joined(given)
    owner = np.repeat([0, 1], [len(given[0]) + 1, len(given[1]) + 2])
    both = periodic_runs.Extensions(words, owner)
    pairs = [tuple(rng.sample(range(1, 1 + len(given[0])), 2)) for _ in range(2000)]
    pairs += [(i, i + p) for p in (1, 2, 5) for i in range(1, 300)]

    def extension(a, b):
        n = 0
        while words[a + n] == words[b + n] != 0:
            n += 1
        return n

    a, b = np.array(pairs).T
    assert both.of(a, b).tolist() == [extension(x, y) for x, y in pairs]


def test_runs_of_odd_rows(docs, none):
    found, runs, collapsed = periodic_runs.collapse_runs(docs)
    assert found.columns == [*docs.columns, runs, collapsed]
    rows = found.collect()
    assert len(rows) == len(ROWS) and all(not r[runs] for r in rows)
    assert sorted(r[collapsed] for r in rows) == sorted(" ".join((r[1] or "").split()) for r in ROWS)
    assert periodic_runs.collapse_runs(none)[0].count() == 0
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(docs, min_periods=1)


def test_runs_are_collapsed_to_one_period(spark):
    frame = spark.createDataFrame([(1, "x " + "a b c\n" * 9 + "y"), (2, "z " * 100_000)], "runs int, `te.xt` string")
    found, runs, collapsed = periodic_runs.collapse_runs(frame, "te.xt")
    assert runs == "_runs"
    got = {r["runs"]: ([tuple(x) for x in r[runs]], r[collapsed]) for r in found.collect()}
    assert got == {1: ([(1, 27, 3)], "x a b c y"), 2: ([(0, 100_000, 1)], "z")}


def test_query_of_runs_equals_a_plain_version(spark, texts):
    got = {r.doc_id: r for r in contract.queries()["op11_periodic_runs"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
        kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
        assert tuple(got[i]) == (i, len(runs), *best, milli, *hashes)


# --- I-Match --------------------------------------------------------------------------------------------------------


def test_lexicon_is_a_band_of_document_frequency(spark):
    docs = spark.createDataFrame([(f"all Half{i % 2} {i} rare{i // 2} rare{i // 2}",) for i in range(100)], "t string")
    known = {r.term for r in imatch.lexicon(docs, "t", 0.01, 0.5).collect()}
    hashed = lambda words: {r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()}
    assert known == hashed([f"half{i}" for i in range(2)] + [f"rare{i}" for i in range(50)])


def test_fingerprints_follow_what_texts_share(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [rng.sample(vocabulary, 120) for _ in range(100)]
    rows = [(i, " ".join(w), " ".join(w[:90] + base[(i + 1) % 100][:30])) for i, w in enumerate(base)]
    frame = spark.createDataFrame(rows, "id int, text string, other string")
    known = imatch.lexicon(frame)
    shuffled = frame.select("id", F.expr("array_join(reverse(split(text, ' ')), ' , ')").alias("other"))
    prints = [
        imatch.fingerprints(f, known, ["id"], c).select("id", F.col("fingerprint").alias(n))
        for n, f, c in (("a", frame, "text"), ("b", frame, "other"), ("c", shuffled, "other"))
    ]
    joined = prints[0].join(prints[1], "id").join(prints[2], "id")
    got = joined.select(imatch.likeness(F.col("a"), F.col("b")).alias("ab"), (F.col("a") == F.col("c")).alias("same")).collect()
    assert all(r.same for r in got)  # order, repeats and punctuation do not matter
    assert min(r.ab for r in got) > 0.15 and 0.35 < sum(r.ab for r in got) / 100 < 0.65


def test_fingerprints_of_odd_rows(docs, none, spark):
    known = imatch.lexicon(docs)
    found = imatch.fingerprints(docs, known, ["doc_id"]).collect()
    assert sum(r.copies for r in found) == len(ROWS)
    prints = defaultdict(set)
    for r in found:
        prints[r.doc_id].add(r.fingerprint)
    assert prints[3] == prints[4] and prints[3] <= prints[None] and prints[5] != prints[4]
    assert imatch.fingerprints(none, known, ["doc_id"]).count() == 0
    empty = imatch.lexicon(none)
    assert empty.count() == 0 and imatch.fingerprints(docs, empty, ["a.b", "doc_id"]).count() == len(found)


@pytest.mark.parametrize("per_task", [1, 3, 50_000])
def test_ids_form_a_ring(spark, per_task):
    ids = [5, -7, 100, 3, 8, 2**62, 41, 40]
    got = imatch.successors(spark.createDataFrame([(i,) for i in ids], "`a b` long"), per_task).collect()
    ring = sorted(ids)
    assert {r.id: r.next for r in got} == dict(zip(ring, ring[1:] + ring[:1], strict=True))
    assert imatch.successors(spark.createDataFrame([(1,)], "x long")).collect()[0].next == 1
    assert imatch.successors(spark.createDataFrame([], "x long")).count() == 0


def test_query_of_fingerprints(spark, texts):
    frame = contract.queries()["op12_imatch"](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {r.doc_id: r for r in frame.collect()}
    ids = sorted(texts)
    for i, following in zip(ids, ids[1:] + ids[:1], strict=True):
        text, other = texts[i] or "", texts[following] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + other[:q]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_next == plain_likeness(got[i].fingerprint, got[following].fingerprint)
        assert got[i].near_edited == plain_likeness(got[i].fingerprint, got[i].edited_fingerprint)
    of = defaultdict(set)
    for i, text in texts.items():
        of[text].add(got[i].fingerprint)
    assert all(len(prints) == 1 for prints in of.values())
    near = sorted(r.near_edited for r in got.values())
    assert near[len(near) // 20] > 0.05 and near[len(near) // 2] > 0.35
    assert sorted(r.near_next for r in got.values())[-len(got) // 20] < 0.1


def plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = (dict(level.split(":") for level in p.split("|")) for p in (a, b))
    pairs = [p for level in x.keys() & y.keys() for p in zip(x[level].split(","), y[level].split(","), strict=False)]
    hits = [p == q for p, q in pairs if (p, q) != ("", "")]
    return sum(hits) / max(1, len(hits))


def test_edited_texts_of_repeated_and_missing_ids(spark):
    from cairn.llm.queries import with_edited

    rows = [(1, "abcdefgh"), (1, "abcdefgh"), (1, "ABCDEFGH"), (None, "nullnull"), (None, None), (9, ""), (4, "wxyz")]
    got = with_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # NULL comes first; after 9 the ring begins again.
    assert sorted((r.doc_id or 0, r.edited) for r in got) == [
        (0, ""), (0, "nullnuAB"), (1, "ABCDEFwx"), (1, "abcdefwx"), (1, "abcdefwx"), (4, "wxy"), (9, ""),
    ]


# --- spelling -------------------------------------------------------------------------------------------------------


def plain_near(words):
    """All pairs one edit apart, through the words without one code point."""
    near = defaultdict(set)
    of = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            of[len(w), i, w[:i] + w[i + 1 :]].add(w)
    for group in of.values():
        for a in group:
            near[a] |= group - {a}
    for w in words:
        for i in range(len(w)):
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def plain_variants(counts):
    near = plain_near(set(counts))
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 5 * n:
            form[w] = best

    @cache
    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_all_near_words(seed):
    rng = random.Random(seed)
    for shorter in (0, 1):
        held = sorted({"".join(rng.choice("abcé") for _ in range(6)) for _ in range(400)})
        asked = sorted({"".join(rng.choice("abcé") for _ in range(6 - shorter)) for _ in range(200)})
        near = plain_near({*held, *asked})
        want = {(a, b) for a in asked for b in near[a] if b in held}
        found = {(asked[i], held[j]) for q, m in spelling.near_pairs(held, asked) for i, j in zip(q, m, strict=True)}
        assert found == want and want


def test_every_point_has_one_cell_and_boxes_prune():
    rng = np.random.default_rng(0)
    points = rng.integers(0, 3, (500, spelling.DIMENSIONS)).astype(np.int8)
    root, leaves = spelling.tree(points, 20, tight=False)
    assert sorted(np.concatenate(leaves)) == list(range(500)) and max(map(len, leaves)) <= 20
    others = rng.integers(0, 9, (300, spelling.DIMENSIONS)).astype(np.int8)
    cells = [i for _, who in spelling.reached(root, others, 0, 0) for i in who]
    assert sorted(cells) == list(range(300))
    words = ["".join(random.Random(i).choices("etaoinshrdlu", range(12, 0, -1), k=8)) for i in range(500)]
    points = spelling.vectors(words)
    tight, leaves = spelling.tree(points, spelling.LEAF, tight=True)
    assert sum(len(who) for _, who in spelling.reached(tight, points, 1, 1)) < 500 * len(leaves) / 2


@pytest.mark.parametrize("cell, sample", [(1024, 50_000), (3, 50_000), (3, 40)])
def test_variants_equal_brute_force(spark, cell, sample):
    rng = random.Random(7)
    words = {"".join(rng.choice("abÿz") for _ in range(rng.randint(6, 9))) for _ in range(500)}
    words |= {"aaaaaa" + "b" * i for i in range(9)} | set(map("".join, zip("abcdef" * 9, "fedcba" * 9, strict=True)))
    counts = {w: 5 * 5 ** rng.randint(0, 9) + rng.randint(0, 1) for w in words if len(w) >= 6}
    counts |= {"aaaaaa" + "b" * i: 5 ** (i + 1) for i in range(9)}  # a path of nine forms
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(frame, cell=cell, sample=sample).select("word", "form", "root", "n", "n_near", "form_n")
    assert {tuple(r) for r in got.collect()} == plain_variants(counts)


def test_vocabulary_of_odd_rows(docs, none, spark):
    runs = docs.select(F.explode(spelling.letter_runs(F.col("text"))).alias("a.b"))
    counts = Counter(w for r in ROWS for w in re.findall("[a-zÀ-ÿ]+", (r[1] or "").lower()) if len(w) >= 6)
    want = {w: n for w, n in counts.items() if n >= 5}
    assert {r.word: r.n for r in spelling.vocabulary(runs, 6, 5).collect()} == want
    empty = spelling.vocabulary(none.select(F.explode(spelling.letter_runs(F.col("text")))))
    assert spelling.variants(empty).count() == 0
    odd = spark.createDataFrame([("ÀB×cdéF÷gÿ ĀABCDEF1ghijkl abcde", LONG)], "t string, u string")
    assert odd.select(spelling.letter_runs(F.col("t"))).first()[0] == ["Àb×cdéf÷gÿ", "abcdef", "ghijkl"]


def test_query_of_variants_equals_a_plain_version(spark, texts):
    counts = Counter()
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for i, text in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    got = contract.queries()["op13_spelling_variants"](spark, SMALL).select("word", "form", "root", "n", "n_near", "form_n")
    assert {tuple(r) for r in got.collect()} == plain_variants(counts)
