"""The registered queries on the smallest tables."""

import glob
import hashlib
import math
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from cairn.llm import tokens, training_order
from cairn.llm.oracles import OP6, ORACLES
from cairn.llm.queries import QUERIES
from tests.llm import plain
from tests.test_queries import canonical

FOLDER = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def docs(oracle):
    return oracle.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def run(spark, name):
    return contract.queries()[name](spark, FOLDER)


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_oracle(spark, oracle, name):
    frame, result = run(spark, name), oracle.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert canonical(frame.columns, frame.collect()) == canonical(names, result.fetchall())


def test_quality_scores_agree_with_held_out_labels(spark, oracle):
    scored = {r.doc_id: r for r in run(spark, "op2_pu_quality").collect()}
    labels = oracle.execute("SELECT doc_id, quality FROM labels").fetchall()
    for doc_id, r in scored.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5)
    held = [(scored[i].score, q) for i, q in labels if scored[i].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_language_model_scores(spark, docs):
    text = {i: (t or "").encode().lower().split() + [b""] for i, t, _ in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in text}
    counts = Counter(w for i, words in text.items() if not held[i] for w in words)
    n, v = sum(counts.values()), len(counts)
    got = run(spark, "op4_interpolation").collect()
    for r in got:
        words = text[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words), n)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    for flag in (True, False):
        assert sum(r.score for r in got if r.held_out == flag) > sum(r.base_score for r in got if r.held_out == flag)


def test_near_duplicates(spark, docs):
    sets = [plain.shingles(t) for _, t, _ in docs]
    want = {docs[i][0]: (len(sets[i]), docs[first][0]) for i, first in enumerate(plain.clusters(sets))}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op8_ngram_join").collect()} == want


def taken(docs):
    """How often the mix takes each document."""
    size = {i: len(plain.WORD.findall(t)) for i, t, _ in docs}
    own = defaultdict(list)
    for i, t, s in docs:
        h = int(hashlib.md5(f"{i}:{t}".encode()).hexdigest()[:15], 16)
        own[s].append((h, i))
    names = sorted(own)
    total = {s: sum(size[i] for _, i in own[s]) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(total.values())
    while True:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * unit >= 2 * total[s]}
        if not full:
            break
        target |= {s: 2.0 * total[s] for s in full}
        free, left = free - full, left - sum(2.0 * total[s] for s in full)
    target |= {s: weight[s] * unit for s in free}
    copies = {}
    for s in names:
        whole = int(target[s] // total[s])
        rest, below = target[s] - whole * total[s], 0
        for h, i in sorted(own[s]):
            copies[i] = whole + (below < rest and rest - below > size[i] / 2)
            below += size[i]
    return copies


def test_pipeline_equals_a_plain_version(spark, oracle, docs):
    good = {i for i, kept in oracle.execute(f"SELECT doc_id, kept FROM ({OP6})").fetchall() if kept}
    left = [d for d in docs if d[0] in good]
    first = plain.clusters([plain.shingles(t) for _, t, _ in left])
    left = [d for k, d in enumerate(left) if first[k] == k]
    items = oracle.execute("SELECT item_id, text FROM benchmark").fetchall()
    found = {i: plain.contamination(t, items) for i, t, _ in left}
    left = [d for d in left if not (found[d[0]][1] and 20 * found[d[0]][1] >= found[d[0]][0])]
    copies = taken(left)
    sizes = {i: len(tokens.encode_whole(t.encode(), training_order.VOCABULARY)) + 1 for i, t, _ in left}
    total = sum(sizes[i] * n for i, n in copies.items())

    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert len(rows) == -(-total // training_order.LENGTH)
    assert sorted(r.slot for r in rows) == sorted(r.sequence for r in rows) == list(range(len(rows)))
    assert sum(r.n_tokens for r in rows) == total
    assert {i for r in rows for i in r.doc_ids} == {i for i, n in copies.items() if n}


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), FOLDER).columns == docs.columns
