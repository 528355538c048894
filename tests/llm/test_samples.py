"""Samples that depend on nothing but the rows, and the SQL of the quality rules."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cairn.llm import html_text, pu_quality, quality_rules
from cairn.llm.oracles import OP6
from cairn.llm.samples import sample
from tests.test_queries import canonical

PROSE = "Die Stadt und das Land sind nicht sehr weit von hier und mit dem Rad in einer Stunde zu erreichen. "


def drawn(frame, limit, copies):
    found = sample(frame, F.col("t"), [F.col("id")], limit, copies).orderBy("place").collect()
    return [(r.place, r.weight, r.value) for r in found]


@pytest.mark.parametrize("copies", [True, False])
def test_samples_are_bounded_fair_and_the_same_for_any_split(spark, copies):
    rows = [(1, "hot") if i % 3 == 0 else (None, f"t{i % 1500}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "id int, t string")
    want = drawn(frame.coalesce(1), 300, copies)
    assert want == drawn(frame.repartition(7), 300, copies)
    weight = sum(w for _, w, _ in want)
    assert 250 <= weight <= 300 and [p for p, _, _ in want] == list(range(len(want)))
    hot = sum(w for _, w, t in want if t == "hot")
    assert abs(hot / weight - 1 / 3) < 0.06 if copies else hot <= 1
    # All rows, if there are fewer than the limit.
    assert sum(w for _, w, _ in drawn(frame, 5000, copies)) == (3000 if copies else len(set(rows)))
    assert drawn(frame.where("false"), 10, copies) == []
    with pytest.raises(ValueError):
        sample(frame, F.col("t"), [], 10**9, copies)


def test_model_does_not_depend_on_splits(spark):
    rows = [(i, f"word{i} and {'more ' * (i % 9)}" if i % 4 else "!!! ??? " * (i % 5)) for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 1000, 3)], "doc_id long")
    texts = spark.createDataFrame([(t,) for _, t in rows[:50]], "text string")
    scores = []
    for split in (frame.coalesce(1), frame.repartition(5)):
        model = pu_quality.learn(split, trusted, max_positive=100, max_unlabelled=300)
        scored, name = pu_quality.score(texts, model)
        scores.append([r[name] for r in scored.collect()])
    assert scores[0] == scores[1]


def test_labelled_pages_are_bounded_and_different(spark):
    pages = ["<article>hot page</article>" if i % 3 else f"<article>page {i}</article><p>beside" for i in range(900)]
    frame = spark.createDataFrame([(p,) for p in pages], "html string")
    first, again = (html_text.learn_weights(f, limit=100) for f in (frame.coalesce(1), frame.repartition(6)))
    assert first == again
    chosen = sample(frame, F.col("html"), [], 100, copies=False).collect()
    assert 70 <= len(chosen) <= 100 and len({r.value for r in chosen}) == len(chosen)
    everything = sample(frame, F.col("html"), [], 1000, copies=False).collect()
    assert {r.value for r in everything} == set(pages)


def test_rules_equal_their_sql_in_any_language_and_case(spark, tmp_path):
    texts = [PROSE * 5, (PROSE * 5).upper(), "слово дело место время " * 3 + " ".join(f"имя{i}" for i in range(60)), PROSE, "", None]
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, c) for t in texts for c in ("de", "DE_at", " en-GB", "ru", "", None))]
    unique = [(i, None if t is None else " ".join(f"{w}{k}" if k % 3 else w for k, w in enumerate(t.split())), c) for i, t, c in rows]
    frame = spark.createDataFrame(unique, "doc_id long, text string, lang string")
    frame.write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    result = connection.execute(OP6)
    names = [c[0] for c in result.description]
    judged = quality_rules.judge(frame, lang="lang").select(*names)
    want = result.fetchall()
    assert canonical(names, judged.collect()) == canonical(names, want)
    verdicts = {r[names.index("doc_id")]: r[names.index("kept")] for r in want}
    assert verdicts[0] and verdicts[6] and verdicts[15] and not verdicts[12] and set(verdicts.values()) == {True, False}


@pytest.mark.parametrize("seed", range(8))
def test_region_is_the_best_of_all_stretches(seed):
    rng = random.Random(seed)
    pieces = ["<p>", "</p>", "<div>", "</div>", "<a href=x>", "</a>", "<b>", "</b>", "one two three ", "word ", "<nav>menu here</nav>"]
    page = html_text.Page("".join(rng.choices(pieces, k=rng.randint(0, 40))))
    weights = {kind: rng.choice([-3.0, -1.0, -0.5, 0.5, 2.0]) for kind in page.kinds}

    def score(i):
        if page.apart[i]:
            return 0.0
        return weights[page.kinds[i]] * (page.words[i] if page.kinds[i].startswith("word") else 1)

    n = len(page.kinds)
    best = max((sum(map(score, range(a, b))) for a in range(n) for b in range(a, n + 1)), default=0.0)
    first, last = page.region(weights)
    assert sum(map(score, range(first, last))) == pytest.approx(max(0.0, best))
