"""The data structures and models against plain versions."""

import random

import numpy as np
import pytest

from cairn.llm import decontaminate, html_text, interpolation, overlaps, pu_quality, tokens, training_order, url_filter, warc
from cairn.llm.fm_index import FMIndex, suffix_array
from cairn.llm.prefix_tree import Member, build, connect, linked


@pytest.mark.parametrize("seed", range(5))
def test_index_counts_and_locates_every_pattern(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 6, int(rng.integers(1, 300)))
    index = FMIndex(text)
    patterns = np.zeros((60, 4), np.int64)
    lengths = rng.integers(1, 5, 60)
    for row, n in zip(patterns, lengths, strict=True):
        row[4 - n :] = rng.integers(1, 8, n)  # 6 and 7 never occur
    low, high = index.search(patterns, lengths)
    for row, n, a, b in zip(patterns, lengths, low, high, strict=True):
        want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == row[4 - n :]).all()]
        assert sorted(index.locate(np.arange(a, b))) == want


def test_suffixes_are_sorted_even_when_all_symbols_are_equal():
    assert suffix_array(np.array([3, 3, 3, 3, 0])).tolist() == [4, 3, 2, 1, 0]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_one_to_one_and_turns_back(size):
    order = training_order.Permutation(size)
    slots = order.slots(np.arange(size))
    assert sorted(slots) == list(range(size))
    assert (order.sequences(slots) == np.arange(size)).all()
    if size == 1000:
        assert (slots != training_order.Permutation(size, key=1).slots(np.arange(size))).any()


@pytest.mark.parametrize("seed", range(6))
def test_tree_connects_what_brute_force_links(seed):
    rng = random.Random(seed)
    base = [rng.sample(range(200), 40) for _ in range(3)]
    members = []
    for i in range(40):
        tokens = set(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            tokens.discard(rng.randint(0, 199))
            tokens.add(rng.randint(0, 199))
        members.append(Member(f"m{i:02}", len(tokens) + rng.randint(0, 4), sorted(tokens)))

    def classes(pairs):
        group = {m.name: {m.name} for m in members}
        for a, b in pairs:
            if group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
        return {frozenset(g) for g in group.values()}

    want = [
        (a.name, b.name)
        for a in members
        for b in members
        if a.name < b.name and linked(len(set(a.tokens) & set(b.tokens)), a.size, b.size)
    ]
    assert classes(connect(members, [])) == classes(want)
    # What is known to be connected is not linked again.
    assert connect(members, [(m.name, "all") for m in members]) == []


@pytest.mark.parametrize("strip, pairs, dense", [(512, 1 << 20, 16), (7, 5, 2), (7, 5, 1), (512, 1, 0), (3, 1, 1000)])
@pytest.mark.parametrize("seed", range(4))
def test_counted_overlaps_connect_what_brute_force_links(monkeypatch, seed, strip, pairs, dense):
    for name, value in (("STRIP", strip), ("PAIRS", pairs), ("DENSE", dense)):
        monkeypatch.setattr(overlaps, name, value)
    rng = random.Random(seed)
    base = [rng.sample(range(200), 40) for _ in range(3)]
    sets, sizes, roots = [], [], []
    for i in range(60):
        tokens = set(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            tokens.discard(rng.randint(0, 199))
            tokens.add(rng.randint(0, 199))
        sets.append(np.array(rng.sample(sorted(tokens), len(tokens)), np.uint64))
        sizes.append(len(tokens) + rng.randint(0, 6))
        roots.append(rng.choice([0, 0, 0, i + 1]))
    group = dict(enumerate(roots))

    def classes(pairs):
        of = dict(group)
        for a, b in pairs:
            old, new = of[a], of[b]
            of = {k: new if v == old else v for k, v in of.items()}
        return {frozenset(k for k in of if of[k] == v) for v in set(of.values())}

    want = [(a, b) for a in range(60) for b in range(a) if linked(len({*sets[a]} & {*sets[b]}), sizes[a], sizes[b])]
    _, component = np.unique(roots, return_inverse=True)
    found = overlaps.connected(list(range(60)), np.array(sizes), component, sets)
    assert {(max(p), min(p)) for p in found} <= set(want) and all(roots[a] != roots[b] for a, b in found)
    assert classes(found) == classes(want)
    assert overlaps.connected([0, 1], np.array([0, 3]), np.array([0, 1]), [sets[0][:0], sets[0][:3]]) == []


def test_tree_shares_beginnings_and_bounds_its_subtrees():
    root = build([Member("a", 4, [1, 2, 3, 4]), Member("b", 5, [1, 2, 7]), Member("c", 1, [])])
    (child,) = root.children
    assert child.tokens == [1, 2] and sorted(c.tokens for c in child.children) == [[3, 4], [7]]
    assert (root.smallest, root.largest, root.longest, child.longest) == (1, 5, 4, 2)
    assert [m.name for m in root.members] == ["c"]


def test_spans_are_merged_and_removed():
    spans = decontaminate.merged(np.array([0, 1, 1, 0, 1], bool))
    assert spans == [[1, 3], [4, 5]]
    assert decontaminate.without("Eins, zwei drei. Ünf: sechs!".encode(), spans) == "Eins, . Ünf: !"


def test_keys_of_a_url_are_host_ends_with_path_beginnings():
    keys = url_filter.candidates("a.b.com", "/en/x", [1, 4, 9])
    assert keys == ["a.b.com/en/", "b.com/en/", "a.b.com/", "com/en/", "b.com/", "com/"]
    assert url_filter.candidates("", "", [1]) == []


def test_weights_follow_held_out_likelihood():
    # Context seen often: the bigram estimate explains all. Context seen once: the token estimate does.
    histogram = np.array([[5, 140, 90, 100], [1, 0, 120, 100]])
    weights = interpolation.learnt(histogram)
    assert weights[5, 0] > 0.9 and weights[1, 1] > 0.9
    assert np.allclose(weights.sum(1), 1) and (weights[:, 2] > 0).all() and weights[0, 0] == 0


def test_risk_minimiser_finds_the_prior_and_separates():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, (900, 5)), rng.normal(-2, 1, (300, 5))
    mixed = np.vstack([good[:600], bad[:200]])
    prior = pu_quality.estimated_prior(good[600:], mixed)
    assert abs(prior - 0.75) < 0.08
    model = pu_quality.fit(good[600:], mixed, prior)
    assert (model(good) >= 0.5).mean() > 0.97 and (model(bad) < 0.5).mean() > 0.9


def test_features_are_finite_for_any_text():
    x = pu_quality.features([b"", b" \n ", "é".encode(), b"A" * 10_000, b"one two three one two three"])
    assert x.shape == (5, pu_quality.N_FEATURES) and np.isfinite(x).all() and (x[0] == 0).all()


ARTICLE = (
    "<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li>"
    "<a href=x>Menu one</a></ul></nav><div class='cookie-notice'>We use cookies and more words</div><{tag}><h1>Big "
    "&amp; bold</h1><p>First   <b>par</b>agraph\nwith words enough to win &lt;here&gt;.<div class=ad>Buy this now"
    "</div><p>Second one is as long as the first was, truly.<form><p>Your mail</form><script>var a='<p>x</p>'</script>"
    "<div id=comments><p>Nice article, thanks a lot for that</div></{tag}><aside><p>Read also</p></aside><footer>"
    "<p>All rights reserved</p></footer></body></html>"
)
WANTED = (
    "Big & bold\nFirst paragraph with words enough to win <here>.\nSecond one is as long as the first was, truly."
)


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_article_without_what_surrounds_it(tag):
    labelled = [ARTICLE.replace("{tag}", "article")] * 3
    weights = html_text.weighed(html_text.counted(labelled))
    assert html_text.main_text(ARTICLE.replace("{tag}", tag), weights) == WANTED
    assert html_text.main_text(ARTICLE.replace("{tag}", tag), {}) == WANTED


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p></p>", ""),
        ("<script>never closed <p>words here", ""),
        ("plain words &eacute; only", "plain words é only"),
        ("<p>a < b and <b>c</p><p>&nbsp; d e </p>", "a < b and c\nd e"),
        ("<p>open <a href='x>y'>quote</a> <div class=ad>left <p>right side", "open quote\nright side"),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page, {"word p link": 1.0, "tag p": -0.1}) == text


def test_titles_stay_and_comment_lists_go():
    page = (
        "<header><p>Site of all sites</p></header><article><header class=entry-header><h1>The title</h1></header><p>Body of "
        "it all, at length.</p><ol class='commentlist'><li>I say so too, and more of it</ol></article>"
    )
    assert html_text.main_text(page, {"word h1": 3.0}) == "The title\nBody of it all, at length."


@pytest.mark.parametrize(
    "name",
    "content has-sidebar|no-sidebar|no-ads|menu-open|related-work|commentary|shareholders|promotion-of-health|"
    "naval-history|with_share|social-policy|navigable|recommended-by-us|widgetry".split("|"),
)
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_names_that_only_begin_like_furniture_lose_no_text(name, attribute):
    page = f"<div><p>Before it are words.<section {attribute}='{name}'><p>The words of this part.</section><p>And after it more.</div>"
    assert html_text.main_text(page, {}) == "Before it are words.\nThe words of this part.\nAnd after it more."


@pytest.mark.parametrize(
    "page, text",
    [
        # Named like furniture, yet around the content.
        ("<div class=sidebar><article><h1>Title</h1><p>All of the words.</article></div>", "Title\nAll of the words."),
        ("<header><h1>Site</h1></header><div class=widget><article><p>Few.</article></div><p class=x>", "Few."),
        ("<form class=search><main><p>All of the words.</main></form>", "All of the words."),
        ("<div class=overlay><h1>Title</h1><p>All of the words.</div>", "Title\nAll of the words."),
        ("<div id=widget><p>All of the words here.</div><p>Not many.", "All of the words here.\nNot many."),
        ("<body class='search menu'><p>All of the words.", "All of the words."),
        ("<p>One and two.<h2 id=comments>On comments</h2><p>Three and a few.", "One and two.\nOn comments\nThree and a few."),
        ("<p data-class=ad>All of the words.", "All of the words."),
        # Beside the content.
        ("<h1>Title</h1><p>It is.<div class='box comments'><article><p>Not so.</article></div>", "Title\nIt is."),
        ("<p>All of the words.<div class='x site_footer y'><p>Or so.</div>", "All of the words."),
        ("<article><p>It is.</article><div class=comments><p>One more than it, two more.</div>", "It is."),
    ],
)
def test_content_stays_whatever_its_element_is_named(page, text):
    assert html_text.main_text(page, {"word h1": 3.0, "word h2": 3.0, "tag p": -0.1}) == text


@pytest.mark.parametrize(
    "piece",
    [
        *("<svg />", "<svg width='3'/>", "<video-js></video-js>", "<audio-player>", "<template-part />", "<title-bar></title-bar>"),
        *("<svg>", "<object data=x>", "<audio src='x'>", "<video>", "<canvas>", "<select>", "<iframe src=x>", "<noscript>"),
        *("<svg/><svg>no</svg>", "<video><video>no</video>", "<SVG><a><svg>no</svg></a></SVG>", "<object><p>no</object>"),
        *("<script>no</script>", "<style>no<p></style>", "<select><option>no</select >"),
    ],
)
def test_elements_without_end_swallow_nothing(piece):
    page = f"<p>One and two.{piece}<p>Three, four, five."
    assert html_text.main_text(page, {"tag svg": -0.1, "tag video": -0.1}) == "One and two.\nThree, four, five."


def test_many_elements_without_end_take_linear_time():
    page = "<p>word" + "<svg><object>" * 100_000 + "<p>so it ends here<svg>no</svg>"
    assert len(html_text.parts(page)) == 1 and html_text.main_text(page, {"tag svg": 0.0, "tag object": 0.0}).endswith("here")


def test_long_pages_take_linear_time():
    page = "<p>" + "word <b>x</b> " * 50_000 + "<div class=ad>" * 2_000 + "<p>so it ends here"
    assert html_text.main_text(page, {}).endswith("x\nso it ends here")


@pytest.mark.parametrize("url", ["http://a/b?c=%20d", "http://ü/\r\nX: y", None, ""])
@pytest.mark.parametrize("refers", [None, 3])
def test_record_round_trip(url, refers):
    data = warc.record(7, url, "<p>\r\n\r\né".encode(), "ab", refers)
    headers, http, payload = warc.parsed(data)
    assert headers["WARC-Type"] == ("response" if refers is None else "revisit")
    assert payload == ("<p>\r\n\r\né".encode() if refers is None else b"")
    assert http.endswith(b"Content-Length: 9") and headers["WARC-Record-ID"] == "<urn:page:7>"


def test_neighbours_are_read_together():
    def row(file, offset, length):
        return {"file": file, "offset": offset, "length": length}

    rows = [row("a", 0, 10), row("a", 10, 5), row("a", 1 << 20, 5), row("b", 0, 9), row("b", 9, warc.MOST_READ)]
    assert [len(g) for g in warc.ranges(rows)] == [2, 1, 1, 1]


def test_words_encoded_once_give_the_tokens_of_the_text():
    rng = random.Random(0)
    pieces = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "1", "23", "!", "\u00a0", "\u3000", "don't", "日本", "\x1c", "\r\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))).encode() for _ in range(3000)]
    found = tokens.encode(texts, training_order.VOCABULARY)
    for text, own in zip(texts, found, strict=True):
        assert own.tolist() == tokens.encoding(training_order.VOCABULARY)[0].encode_ordinary(text.decode())
    assert tokens.count(texts, training_order.VOCABULARY) == sum(map(len, found))
    assert tokens.encode([], training_order.VOCABULARY) == [] and tokens.count([b""], training_order.VOCABULARY) == 0
