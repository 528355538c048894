"""Nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairn.llm import (
    decontaminate,
    html_text,
    interpolation,
    mixing,
    ngram_join,
    pu_quality,
    quality_rules,
    tokens,
    training_order,
    url_filter,
    warc,
)
from tests.llm import plain

BASE = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = [
    *("n_words", "kept", "size", "hash", "target", "copies", "spans", "items", "n_hit", "score", "digest", "part"),
    *("role", "host", "path", "rule", "verdict", "mix_source", "cairn_words", "cairn_digest", "a.b", "`q`"),
]
SCHEMA = f"{BASE}, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASHING)
LONG = " ".join(f"w{i % 977} x{i}" for i in range(40_000))
PHRASE = " ".join(f"bench{i}" for i in range(20))
PROSE = " ".join(f"word{i} alpha{i} the beta{i} gamma{i}" for i in range(30))

ROWS = [
    (1, PROSE, "en", "s1", 10),
    (1, PROSE, "en", "s1", 10),
    (1, PROSE, None, None, None),
    (2, PROSE + " more", "en", "s2", 10),
    (None, PROSE, "en", "s1", 1),
    (None, None, None, None, None),
    (3, None, "en", "s1", 0),
    (4, "", "en", "s2", 0),
    (5, " \t\n ", "en", "s3", 4),
    (6, "one", "en", "s3", 3),
    (7, "ONE", "en", None, 3),
    (8, LONG, "en", "s2", len(LONG)),
    (9, f"{PROSE} {PHRASE} end", "en", "s4", 1),
    (10, PHRASE.upper(), "de", "s4", 1),
]
BENCHMARK = [(1, PHRASE), (1, PHRASE), (2, "bench3 bench4"), (None, "one"), (3, None), (4, ""), (5, "?!")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["v"] * len(CLASHING)) for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(BENCHMARK, "item_id long, text string")


def own_columns(frame, columns):
    """The input's columns came through unchanged."""
    assert frame.columns[: len(columns)] == columns


def test_rules(docs, none):
    judged = quality_rules.judge(docs)
    own_columns(judged, docs.columns)
    got = sorted((r.text or "", r["_n_words"], r["_kept"]) for r in judged.collect())
    assert got == sorted((r[1] or "", len((r[1] or "").split()), "the beta" in (r[1] or "")) for r in ROWS)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum("the beta" in (r[1] or "") for r in ROWS)
    assert quality_rules.judge(none).count() == 0


def test_stop_words_in_any_case_and_of_known_languages_only(spark):
    english, foreign = " ".join(f"WORD{i} THE" for i in range(40)), " ".join(f"слово{i}" for i in range(60))
    rows = [(1, english, "en"), (2, foreign, "ru"), (3, foreign, "en-GB"), (4, foreign, None), (5, "!!! " * 60, "ru")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in quality_rules.keep_good(frame, lang="lang").collect()) == [1, 2]
    assert [r.doc_id for r in quality_rules.keep_good(frame).collect()] == [1]


def test_mix(docs, none):
    got = mixing.mix(docs, budgets=(0.5, 1.5)).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r.taken <= r.taken_2 <= 2 * r["size"] for r in got)  # a smaller mix is part of a larger
    assert {(r.source_size, r.target_2) for r in got if r.doc_id == 7} == {(151, 302.0)}
    assert mixing.mix(none).count() == 0
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    again = mixing.mixed_rows(docs)
    assert sorted(map(str, rows.collect())) == sorted(map(str, again.collect()))
    taken = {r.doc_id: r.copies_2 for r in got if r.doc_id == 8}
    assert rows.where("doc_id = 8").count() == taken[8]
    assert mixing.mixed_rows(none).count() == 0


def test_mix_of_sources_full_at_the_same_level(spark):
    sizes = spark.createDataFrame([("A", 50), (None, 20)], "source string, size long")
    got = mixing.targets(sizes, [1.5], mixing.WEIGHTS, mixing.MOST_REPEATS).collect()
    assert {r.source: r.target for r in got} == {"A": 75.0, None: 30.0}


def test_decontamination(docs, none, benchmark, monkeypatch):
    want = [plain.contamination(r[1], [("" if i is None else i, t or "") for i, t in BENCHMARK]) for r in ROWS]
    for block in (8 << 20, 10):  # all items at once, or a block for each
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        found, name = decontaminate.annotate(docs, benchmark, clean=True)
        own_columns(found, docs.columns)
        got = found.collect()
        assert sorted((r[name["n_words"]], r[name["n_hit"]], r[name["items"]]) for r in got) == sorted(want)
        cleaned = {r.doc_id: r[name["cleaned"]] for r in got if r[name["cleaned"]] is not None}
        assert cleaned == {6: "", 7: "", 9: f"{PROSE}  end", 10: ""}
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 1, 1, 2, 3, 4, 5, 8]
    assert decontaminate.keep_clean(none, benchmark).count() == 0
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == len(ROWS)


def test_a_task_holds_one_block_of_items(spark, monkeypatch):
    """Each search of a block finds no other block's value in its process."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 10)
    search = decontaminate.shard_hits

    def counted(texts, phrases):
        import gc

        held = sum(type(o).__name__ == "Phrases" for o in gc.get_objects())
        return search(texts, phrases)[0], [{str(held)} for _ in texts]

    items = spark.createDataFrame([(i, f"item{i} of them") for i in range(5)], "item_id long, text string")
    texts = spark.createDataFrame([(1, "item3 of them")], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(decontaminate, "shard_hits", counted)
    found, name = decontaminate.annotate(texts, items)
    assert [r[name["items"]] for r in found.collect()] == [["1"]]


def test_too_many_items_are_refused(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 5)
    monkeypatch.setattr(decontaminate, "MOST_BLOCKS", 3)
    items = spark.createDataFrame([(i, "some words") for i in range(4)], "item_id long, text string")
    with pytest.raises(ValueError, match="split them"):
        decontaminate.annotate(spark.createDataFrame([(1, "x")], "doc_id long, text string"), items)


def test_ngram_join(docs, none):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.component_ids(docs).collect()}
    n = len(plain.shingles(PROSE))
    assert (1, n, 1) in got and (None, n, 1) in got and (2, n + 1, 1) in got
    assert {(6, 1, 6), (7, 1, 6), (4, 0, 4), (5, 0, 5), (3, 0, 3), (None, 0, None)} <= got
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 10]
    assert ngram_join.component_ids(none).count() == 0 and ngram_join.keep_one(none).count() == 0


@pytest.mark.parametrize("buckets", [4, 1000])
def test_an_entry_takes_few_bytes_in_any_number_of_buckets(buckets):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 2**64, 50, np.uint64)) for _ in range(4000)]
    rows = list(ngram_join.dealt(sets, buckets, False))
    size = sum(len(pa.compress(x, "lz4", asbytes=True)) for row in rows for x in row[1:])
    assert size <= 5.5 * sum(map(len, sets))
    whole = [
        pair
        for _, hashes, owners in ngram_join.dealt(sets, buckets, True)
        for pair in zip(ngram_join.from_steps(owners), ngram_join.from_planes(hashes, np.uint64), strict=True)
    ]
    assert sorted(whole) == sorted((i, h) for i, s in enumerate(sets) for h in s)


def test_large_blocks_lose_no_link(spark, monkeypatch):
    """Hundreds of near copies, and outsiders, over many chunks."""
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(90):
        own = list(words)
        own[i % 60] = f"x{i}"
        if i % 3 == 0:
            own[(i * 7 + 20) % 60] = f"y{i}"
        texts.append(" ".join(own[: 60 - i % 4]))
    want = plain.clusters([plain.shingles(t) for t in texts])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.component_ids(frame).collect()} == dict(enumerate(want))


def searched(spark, monkeypatch, texts):
    """Sets that the second search gets, and the components."""
    sent, plain_stored = [], ngram_join.stored

    def counted(frame, label):
        table = plain_stored(frame, label)
        if label == "join-searched":
            sent.append(table.count())
        return table

    monkeypatch.setattr(ngram_join, "stored", counted)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.component_ids(frame).collect()}
    monkeypatch.setattr(ngram_join, "stored", plain_stored)
    return sent, found


def test_search_grows_with_the_texts_that_share_passages(spark, monkeypatch):
    """Texts of four passages, each of which another text has too: one block without a link."""
    monkeypatch.setattr(ngram_join, "CHUNK", 8)

    def chained(n):
        order = [random.Random(k).sample(range(n), n) for k in range(2)]
        passage = lambda k, i: " ".join(f"p{k}x{i}w{j}" for j in range(24))
        at = [{text: place for place, text in enumerate(o)} for o in order]
        return [
            " ".join(passage(k, at[k][i] // 2 if side else n + (at[k][i] + 1) % n // 2) for k in range(2) for side in range(2))
            for i in range(n)
        ]

    sizes = []
    for n in (48, 96):
        sent, found = searched(spark, monkeypatch, chained(n))
        assert found == {i: i for i in range(n)}
        sizes.append(sent[0])
    assert 0 < sizes[0] and sizes[1] <= 2.2 * sizes[0]


def test_both_ways_of_the_second_search_lose_no_link(spark, monkeypatch):
    """Clusters of copies, chains of near texts and texts that share passages only."""
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    monkeypatch.setattr(ngram_join, "BRIDGES", 1)
    rng = random.Random(0)
    passages = [" ".join(f"s{k}w{j}" for j in range(30)) for k in range(6)]
    texts = []
    for i in range(50):
        words = " ".join(rng.sample(passages, rng.randint(1, 4))).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 30)}"
        texts.append(" ".join(words))
    want = plain.clusters([plain.shingles(t) for t in texts])
    sent, found = searched(spark, monkeypatch, texts)
    assert found == dict(enumerate(want)) and sent[0] > 0


def test_second_search_grows_with_a_cluster_and_its_outsiders(spark, monkeypatch):
    """Near copies of one text, and a third that shares most of it but is no link of any."""
    monkeypatch.setattr(ngram_join, "CHUNK", 8)

    def cluster(n):
        rng, texts = random.Random(n), []
        for i in range(n):
            words = [f"w{j}" for j in range(200)]
            for k, j in enumerate(rng.sample(range(0, 200, 5), 6 if i % 3 == 0 else 1)):
                words[j] = f"own{i}x{k}"
            texts.append(" ".join(words))
        return texts

    sizes = []
    for n in (120, 240):
        texts = cluster(n)
        sent, found = searched(spark, monkeypatch, texts)
        assert found == dict(enumerate(plain.clusters([plain.shingles(t) for t in texts])))
        assert len(set(found.values())) > n / 4
        sizes.append(sent[0])
    assert 0 < sizes[0] and sizes[1] <= 2.2 * sizes[0]


@pytest.mark.parametrize("limits", [{"PIECE": 8}, {"PIECE_TOKENS": 300}, {"LEAST_PIECES": 1}])
def test_second_search_loses_no_link_between_its_pieces(spark, monkeypatch, limits):
    for name, value in ({"CHUNK": 4, "BRIDGES": 1} | limits).items():
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(1)
    texts = []
    for i in range(90):
        words = [f"w{j}" for j in range(60)]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"n{rng.randint(0, 9)}"
        texts.append(" ".join(words[: 60 - i % 4]))
    want = plain.clusters([plain.shingles(t) for t in texts])
    sent, found = searched(spark, monkeypatch, texts)
    assert found == dict(enumerate(want)) and sent[0] > 0


def test_training_order(docs, none):
    folder = training_order.shard_folder(docs)
    manifest = training_order.materialise(docs, folder, length=64, shard_slots=10, table=False)
    rows = sorted(manifest.collect(), key=lambda r: r.sequence)
    assert [r.sequence for r in rows] == list(range(len(rows))) == sorted(r.slot for r in rows)
    read = {r.slot: r.tokens for r in training_order.read_slots(manifest, folder, length=64).collect()}
    stream = [t for r in rows for t in read[r.slot][: r.n_tokens]]
    texts, own = [], []
    for token in stream:
        if token == training_order.END:
            texts.append(tokens.encoding(training_order.VOCABULARY)[0].decode(own))
            own = []
        else:
            own.append(token)
    assert not own and sorted(texts) == sorted(r[1] or "" for r in ROWS)
    assert all(r.slot // 10 == r.shard and r.offset == r.slot % 10 * 128 for r in rows)
    later = training_order.read_slots(manifest, folder, first=5, length=64)
    assert later.count() == len(rows) - 5
    empty = training_order.materialise(none, training_order.shard_folder(none), table=False)
    assert empty.count() == 0


def test_language_model(docs, none):
    scored, weights = interpolation.score(docs, "doc_id", "text", F.col("doc_id") == 2, F.col("doc_id") == 9, table=False)
    got = scored.collect()
    assert len(got) == len(ROWS) and all(r.score < 0 and r.base_score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert [r.held_out for r in got if r.doc_id == 2] == [True]
    training = [(r[1] or "").lower().split() + [""] for r in ROWS if r[0] != 2]
    assert {r.train_tokens for r in got} == {sum(map(len, training))}
    assert {r.n_known for r in got if r.doc_id == 2} == {len(PROSE.split()) + 1}
    assert interpolation.score(none, "doc_id", "text", F.lit(False), F.lit(False), table=False)[0].count() == 0
    alone, _ = interpolation.score(docs, "doc_id", "text", F.lit(True), F.lit(False), table=False)
    assert {(r.train_tokens, r.n_known) for r in alone.collect()} == {(0, 0)}


def test_quality_model(docs, none, spark):
    trusted = spark.createDataFrame([(1,), (1,), (None,), (99,)], "doc_id long")
    scored, name = pu_quality.score(docs, pu_quality.learn(docs, trusted))
    own_columns(scored, docs.columns)
    assert name == "_score" and all(0 <= r[name] <= 1 for r in scored.collect())
    blank, name = pu_quality.score(docs, pu_quality.learn(none, trusted))
    assert {r[name] for r in blank.collect()} == {0.5}
    assert pu_quality.score(none, pu_quality.learn(docs, trusted))[0].count() == 0


@pytest.mark.parametrize("hot", [None, 7])
def test_quality_samples_are_bounded_and_fair(spark, monkeypatch, hot):
    """A third of the rows without id or with one id, and without words."""
    rows = [(hot, " ") if i % 3 == 0 else (1000 + i, f"word{i} and more") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(r[0],) for r in rows if r[0] == 7 or (r[0] or 1) % 2 == 0], "doc_id long")
    seen = []
    monkeypatch.setattr(pu_quality, "estimated_prior", lambda p, u: seen.extend([p, u]) or 0.5)
    pu_quality.learn(frame, trusted, max_positive=200, max_unlabelled=300)
    p, u = seen
    assert 150 <= len(p) <= 200 and 240 <= len(u) <= 300

    def hot_share(x):
        return (x[:, pu_quality.N_FEATURES - 8] == 0).mean()

    assert abs(hot_share(u) - 1 / 3) < 0.1
    assert abs(hot_share(p) - (1 / 2 if hot else 0)) < 0.12


PAGES = [
    (1, "http://www.Example.com/en/x?y", "<article><p>" + "same words " * 20 + "</article>"),
    (2, "http://b.net/es/", "<article><p>" + "same words " * 20 + "</article>"),
    (0, "ftp://b.org", "<article><p>" + "same words " * 20 + "</article>"),
    (None, "no scheme", "<article><p>" + "same words " * 20 + "</article>"),
    (0, None, "<article><p>" + "same words " * 20 + "</article>"),
    (3, "", "short"),
    (4, "://", "short"),
    (5, "http://a.b.net/fr/" + "x" * 5000, "<p>" + "long word " * 50_000),
    (6, "https://example.com/EN/", None),
    (7, "https://other.example.com/en/", ""),
]


@pytest.fixture(scope="module")
def pages(spark):
    extra = ["text", "host", "rule", "file", "digest", "payload"]
    schema = "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame([(*p, *["v"] * len(extra)) for p in PAGES], schema).cache()


def test_archives(pages, monkeypatch):
    for size in (256 << 20, 300):  # one archive per task, or many
        monkeypatch.setattr(warc, "FILE_BYTES", size)
        folder = warc.archive_folder(pages)
        index = warc.write_archives(pages, folder)
        got = warc.read_records(index, folder).collect()
        assert sorted((r.page_id is None, r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes > 99) == [
            (False, 0, "response", None),
            (False, 0, "response", None),
            (False, 1, "revisit", 0),
            (False, 2, "revisit", 0),
            (False, 5, "response", None),
            (True, None, "revisit", 0),
        ]
        for r in got:
            source = next(h for i, u, h in PAGES if i == r.page_id and u == r.url) or ""
            assert r.payload_digest == hashlib.sha256(source.encode()).hexdigest()
            assert r.payload_bytes == len(source.encode())
            assert r.payload == (None if r.record_type == "revisit" else source.encode())
    assert warc.write_archives(pages.limit(0), warc.archive_folder(pages)).count() == 0


def test_page_text(pages):
    found, name = html_text.extract(pages)
    own_columns(found, pages.columns)
    got = {(r.page_id, r.url): r[name] for r in found.collect()}
    assert got[1, PAGES[0][1]] == " ".join(["same words"] * 20)
    assert got[6, PAGES[8][1]] == "" and got[3, ""] == "short"
    assert html_text.extract(pages.limit(0))[0].count() == 0


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
    ("net", "/fr/", "allow"),
]


def test_url_rules(pages, spark, monkeypatch):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for rate in (0.01, 0.9):  # the second makes many mistakes, which later levels undo
        monkeypatch.setattr(url_filter, "FIRST_RATE", rate)
        found, name = url_filter.classify(pages, rules)
        own_columns(found, pages.columns)
        got = {(r.page_id, r.url): (r[name["rule"]], r[name["verdict"]]) for r in found.collect()}
        assert got[1, PAGES[0][1]] == ("www.example.com/en/", "allow")
        assert got[2, PAGES[1][1]] == ("net/es/", "block") and got[5, PAGES[7][1]] == ("net/fr/", "block")
        assert got[6, PAGES[8][1]] == ("com/", "allow") and got[7, PAGES[9][1]] == ("example.com/en/", "block")
        assert {got[i, u] for i, u, _ in PAGES[2:7]} == {(None, "allow")}
    assert url_filter.classify(pages.limit(0), rules)[0].count() == 0
    assert url_filter.classify(pages, rules.limit(0))[0].where(F.col(name["verdict"]) == "allow").count() == len(PAGES)


def test_cascade_is_exact_on_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "FIRST_RATE", 0.4)
    listed = {f"h{i}.com/" for i in range(0, 300, 3)}
    universe = [f"h{i}.com/" for i in range(300)]
    cascade = url_filter.cascade(
        spark.createDataFrame([(k,) for k in listed], "key string"),
        spark.createDataFrame([(k,) for k in universe], "key string"),
    )
    assert len(cascade.levels) > 2 and {k for k in universe if k in cascade} == listed


def test_training_order_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    long_text = "some words, and more. " * 9000
    docs = spark.createDataFrame([(i, long_text if i % 9 == 0 else f"text {i}") for i in range(40)], "doc_id long, text string")
    docs = docs.repartition(3).mapInArrow(watched, docs.schema)
    folder = training_order.shard_folder(docs)
    manifest = training_order.materialise(docs, folder, length=128)
    assert seen.value == 40
    held = sorted(manifest.collect(), key=lambda r: r.sequence)
    assert sorted({i for r in held for i in r.doc_ids}) == list(range(40))
    read = {r.slot: r.tokens for r in training_order.read_slots(manifest, folder, length=128).collect()}
    stream = [t for r in held for t in read[r.slot][: r.n_tokens]]
    own = tokens.encode([long_text.strip().encode()], training_order.VOCABULARY)[0].tolist()
    assert stream.count(training_order.END) == 40 and len(stream) > 5 * len(own)


def test_url_rules_run_few_jobs_whatever_the_partitions(pages, spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "60")
    conf("spark.sql.shuffle.partitions", "60")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    spark.sparkContext.setJobGroup("url-rules", "")
    try:
        found, name = url_filter.classify(pages, rules)
        assert found.where(F.col(name["verdict"]) == "block").count() > 0
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("url-rules")) < 120
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
