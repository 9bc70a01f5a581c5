"""The parts of the corpus operators that run inside a task, against plain versions."""

import dataclasses
import itertools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm import (
    attention,
    boosting,
    decontaminate,
    fingerprints,
    html_extract,
    line_dedup,
    packing,
    simhash,
    token_counts,
)
from marketlake.llm.queries import tokenizer


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, previous = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(previous[j] + 1, row[-1] + 1, previous[j - 1] + (x != y)))
    return row[-1]


words = st.lists(st.sampled_from("abcd"), max_size=14)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), words, st.integers(0, 4))
def test_myers_gives_the_least_distance_of_every_end(pattern, text, budget):
    want = []
    for end in range(1, len(text) + 1):
        least = min(edit_distance(pattern, text[start:end]) for start in range(end + 1))
        if least <= budget:
            want.append((end, least))
    assert decontaminate.myers_ends(pattern, text, budget) == want


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**9))
def test_matcher_finds_every_occurrence_within_the_budget(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 25))] for _ in range(4)]
    item = rng.choice(items)
    budget = len(item) // 5
    changed = list(item)
    for _ in range(rng.randint(0, budget)):
        at = rng.randrange(len(changed))
        changed[at : at + 1] = rng.choice(([], ["new"], [changed[at], "new"]))
    filler = [rng.choice(vocabulary) for _ in range(40)]
    cut = rng.randint(0, 40)
    text = " ".join(filler[:cut] + changed + filler[cut:])
    matcher = decontaminate.Matcher([(k, " ".join(x)) for k, x in enumerate(items)], 0.2)
    found = {hit[0] for hit in matcher.find(text)}
    everything = text.split()
    want = {
        k for k, x in enumerate(items) if decontaminate.myers_ends(x, everything, len(x) // 5)
    }
    assert items.index(item) in want and found == want
    assert matcher.contains(text)


def test_matcher_spans_ignore_case_and_signs():
    matcher = decontaminate.Matcher([(7, "One two, three four five six.")], 0.2)
    text = "İ x ONE two three; four FIVE\nsix y"
    (hit,) = matcher.find(text)
    assert hit[:2] == (7, 0) and text[hit[3] : hit[4]] == "ONE two three; four FIVE\nsix"
    assert list(matcher.find(None)) == list(matcher.find("")) == []
    assert not decontaminate.Matcher([(1, " ?! "), (2, None)], 0.2).contains("a b")


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_patience_aligns_equal_lines_in_order(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(pairs))
    assert bool(pairs) == bool(set(a) & set(b))


def test_shared_blocks():
    shared = line_dedup.shared_blocks
    # A block counts as a whole; lines that stand alone are too short.
    assert shared(list("xabcy"), [9] * 5, list("abc"), 20) == [1, 2, 3]
    assert shared(list("xaybz"), [9] * 5, list("ab"), 10) == []
    # Moved and repeated blocks go as well.
    assert shared(list("ABxA"), [30, 30, 5, 30], list("BA"), 30) == [0, 1, 3]
    assert shared([], [], list("ab"), 1) == shared(list("ab"), [1, 1], [], 1) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9))
def test_tree_links_join_what_all_pairs_join(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 60))
    base = rng.integers(0, 2**64, 3, dtype=np.uint64)
    fps = base[rng.integers(0, 3, n)]
    for k in range(n):
        for bit in rng.integers(0, 64, rng.integers(0, 7)):
            fps[k] ^= np.uint64(1) << np.uint64(bit)
    rows = sorted(set(zip(rng.integers(0, 3, n).tolist(), fps.tolist(), strict=True)))
    shard = np.array([r[0] for r in rows])
    fps = np.array([r[1] for r in rows], np.uint64)

    def parts(links):
        root = {f: f for f in fps.tolist()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return {f: find(f) for f in root}

    pairs = [
        (int(a), int(b))
        for (s, a), (t, b) in itertools.combinations(rows, 2)
        if s == t and (a ^ b).bit_count() <= 4
    ]
    a, b = simhash.shard_links(fps, shard, 4)
    assert parts(zip(a.tolist(), b.tolist(), strict=True)) == parts(pairs)
    assert len(a) <= len(fps)


def plain_simhash(text):
    from xxhash import xxh64_intdigest

    found = re.split(rb"[\x20\x09-\x0d]+", text.encode().lower().strip(b" \t\n\x0b\x0c\r"))
    if found == [b""]:
        return 0
    shingles = [b" ".join(found[k : k + 4]) for k in range(max(1, len(found) - 3))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text", ["", " \n", "One", "one TWO three", "a b c d", "É é à b\tc\x0bd e f", "x y " * 700]
)
def test_fingerprint_is_the_majority_of_shingle_bits(text):
    assert simhash.fingerprint(text) % 2**64 == plain_simhash(text)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_fills_bins_without_gaps(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets, fills = packing.best_fit(lengths, 50)
    at = [0] * len(fills)
    open_bins = []
    for length, k, offset in zip(lengths, bins, offsets, strict=True):
        free = [50 - f for f in open_bins]
        fitting = [f for f in free if f >= length]
        if k == len(open_bins):
            assert not fitting
            open_bins.append(0)
        else:
            assert free[k] == min(fitting)
        assert offset == at[k]
        at[k] += length
        open_bins[k] += length
    assert at == fills and all(f <= 50 for f in fills)


ODD_TEXTS = [
    "",
    "it's John's, ok!, x.y. a,b 3.5, İstanbul ΑΣ. foo!. don't. … é. café.",
    "<|endoftext|> q<|startoftext|>.  nb sp. ''s 12,5. ...",
    "ǅ ﬁne ½ ² ª º. ŉ. A.B.C. e.g., 'tis. x'S. l'été, Straße. ẞ é",
    "日本語 テキスト。 русский текст, ελληνικά.",
    "word " * 3000,
]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_word_lookup_gives_the_ids_of_the_whole_text(text):
    words_to_ids = packing.encoder(tokenizer("word_bpe_49k.json"))
    (data,) = words_to_ids.encode([text])
    want = words_to_ids.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(data, "<u4").tolist() == want


SPACED = ["a  b", "a   b", "a \n b", "x\n\n y", "  lead", " ", "\n", "end  ", "end \n", "tab\t b", "é　 x"]


@pytest.mark.parametrize("text", ODD_TEXTS + SPACED)
def test_token_lengths_and_spans_are_those_of_the_whole_text(text):
    lengths = token_counts.Lengths(tokenizer("byte_bpe_multi_50k.tiktoken"))
    got = lengths.of(text)
    tokens = lengths.encoding.encode_ordinary(text)
    assert got.tolist() == [len(lengths.encoding.decode_single_token_bytes(t)) for t in tokens]
    starts, ends = token_counts.spans(text, got)
    at = 0
    for token, start, end in zip(tokens, starts, ends, strict=True):
        data = lengths.encoding.decode_single_token_bytes(token)
        before = text.encode()[:at].decode("utf-8", "ignore")
        assert start == len(before) and end >= start + 1
        at += len(data)
        assert text[start:end].encode()[: len(data)] or data == b""
    assert not len(ends) or ends[-1] == len(text)


def test_crossing_tokens_go_by_the_rule():
    starts, ends = np.array([0, 2, 6]), np.array([2, 6, 8])
    sections = np.array([0, 3, 5])
    counts, crossing = token_counts.attribute(starts, ends, sections, 8, "start")
    assert counts.tolist() == [2, 0, 1] and crossing.tolist() == [1, 0, 0]
    counts, crossing = token_counts.attribute(starts, ends, sections, 8, "majority")
    # Characters 2 | 3 4 | 5: the middle section has most of the second token.
    assert counts.tolist() == [1, 1, 1] and crossing.tolist() == [0, 1, 0]
    counts, _ = token_counts.attribute(np.array([0]), np.array([2]), np.array([0, 1]), 2, "majority")
    assert counts.tolist() == [1, 0]
    with pytest.raises(ValueError):
        token_counts.attribute(starts, ends, sections, 8, "other")


def test_phrases_and_likeness():
    assert fingerprints.phrases(b"a b a b a b a".split()) == {b"a", b"b", b"a b", b"a b a"}
    same = fingerprints.signature("One two three four")
    assert fingerprints.likeness(same, fingerprints.signature("one  TWO three\nfour")) == 1
    empty = fingerprints.signature("")
    assert fingerprints.likeness(empty, empty) == 1 and fingerprints.likeness(empty, same) < 0.1
    assert (fingerprints.from_text(fingerprints.as_text(same)) == same).all()
    assert len(fingerprints.words_of("字" * 50)) == 50
    assert fingerprints.edited_text("abcde", "x") == "abcx"
    assert fingerprints.edited_text("abcde", "xyz") == "abcxy"
    assert fingerprints.edited_text("a", "xyz") == "a"


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**9))
def test_likeness_estimates_the_share_of_common_phrases(seed):
    rng = random.Random(seed)
    a = [f"w{rng.randrange(400)}" for _ in range(400)]
    b = a[: rng.randrange(400)] + [f"v{rng.randrange(400)}" for _ in range(200)]
    x, y = (fingerprints.phrases([w.encode() for w in t]) for t in (a, b))
    want = len(x & y) / len(x | y)
    got = fingerprints.likeness(fingerprints.signature(" ".join(a)), fingerprints.signature(" ".join(b)))
    assert abs(got - want) < 0.2


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 7), st.integers(0, 10**9))
def test_cut_costs_no_more_than_any_labelling(n, seed):
    rng = random.Random(seed)
    gain = [rng.randint(-9, 9) for _ in range(n)]
    edges = {
        (a, b): rng.randint(0, 6)
        for a, b in itertools.combinations(range(n), 2)
        if rng.random() < 0.6
    }

    def cost(label):
        own = sum(abs(g) for g, side in zip(gain, label, strict=True) if g and (g > 0) != side)
        return own + sum(w for (a, b), w in edges.items() if label[a] != label[b])

    least = min(cost(label) for label in itertools.product((False, True), repeat=n))
    assert cost(html_extract.minimum_cut(gain, edges)) == least


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="main"><header><h2>Site name</h2></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, please accept.</div>
<article><h1>Head &amp; line</h1><p><b>First  paragraph&nbsp;of the article, which is long.<br>More of it.<p>Short.
<aside>Related: something else</aside><form><label>Name</label><input name="a>b"><button>Send</button></form>
<p>Second one with a <a href="x">link</a> &lt;kept&gt;.</p><!-- <p>no</p> --><ul><li>Item one<li>Item two</ul>
<section id="comments"><p>A reader says that this is a very good article, and goes on.</p></section></article>
<div class="sidebar"><p>Popular posts this week, and many more words to read here.</p></div>
<footer>&copy; 2024 Site. All rights reserved.</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_extract.main_text(PAGE).split("\n") == [
        "Head & line",
        "First paragraph of the article, which is long. More of it.",
        "Short.",
        "Second one with a link <kept>.",
        "Item one",
        "Item two",
    ]


def test_main_text_without_marks_and_of_odd_pages():
    text = "This is a long paragraph of plain text, with several clauses, that goes on for a while."
    page = f"<div><a href=1>Home</a> <a href=2>News</a></div><div><p>{text}<p>{text}</div><div><a href=3>Next</a></div>"
    assert html_extract.main_text(page) == f"{text}\n{text}"
    assert html_extract.main_text(None) == html_extract.main_text("") == ""
    assert html_extract.main_text("<script>never closed") == ""
    assert html_extract.main_text("<article>a < b &unknown; &#x41;</article>") == "a < b &unknown; A"
    assert html_extract.main_text("<article>" + "<div>" * 5000 + "deep") == "deep"


def test_main_text_keeps_formulas_and_articles_in_hinted_wrappers():
    text = "This is a long paragraph of plain text, with several clauses, that goes on for a while."
    page = f"<article><p>{text} <math><mi>E</mi><mo>=</mo><mi>m</mi></math></p><noscript><p>{text}</p></noscript></article>"
    assert html_extract.main_text(page) == f"{text} E=m\n{text}"
    for name in ("layout has-sidebar", "content no-comments", "with-footer", "sidebar"):
        page = f'<div class="{name}"><article><p>{text}</p><p>{text}</p></article></div>'
        assert html_extract.main_text(page) == f"{text}\n{text}"
    page = f'<div class="has-sidebar"><div><p>{text}</p><p>{text}</p></div></div>'
    assert html_extract.main_text(page) == f"{text}\n{text}"
    for name in ("sidebar", "ad-banner-2", "cookie-notice", "comments"):
        page = f'<div><p>{text}</p></div><div class="x {name}"><p>No {text}</p></div>'
        assert html_extract.main_text(page) == text


OPEN_PAGES = {
    "tags": "<a " * 350_000,
    "quotes": '<a "' * 250_000,
    "both quotes": "<a '><b \">" * 100_000,
    "comments": "x<!--" * 200_000,
    "declarations": "<!x " * 250_000,
    "end tags": "</x " * 250_000,
    "frames": "<iframe>x " * 100_000,
    "nested blocks": "<div>word " * 100_000,
    "blocks below a paragraph": "<p><button>" + "<div>w " * 100_000,
    "nested spans": "<span>w " * 120_000,
    "nested lists": "<ul><li>w " * 80_000,
}


@pytest.mark.parametrize("kind", OPEN_PAGES)
def test_pages_of_a_million_signs_left_open_are_parsed_in_seconds(kind):
    page = OPEN_PAGES[kind]
    assert len(page) > 700_000
    start = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - start < 30


def test_sections_of_an_article_stay_whatever_their_names():
    words = "We discuss the findings of the study, which were many and varied, in some detail here."
    for name in ("discussion", "related", "notice", "responses", "search"):
        page = f"<article><p>{words}</p><section id='{name}'><h2>Title</h2><p>{words}</p></section></article>"
        assert html_extract.main_text(page) == f"{words}\nTitle\n{words}"
    for name in ("comments", "discussion comments", "sidebar", "newsletter"):
        page = f"<article><p>{words}</p><section class='{name}'><h2>Title</h2><p>{words}</p></section></article>"
        assert html_extract.main_text(page) == words
    page = f"<article><p>{words}</p></article><div class='discussion'><p>{words}</p></div>"
    assert html_extract.main_text(page) == words


def test_text_of_objects_and_examples_stays():
    words = "The article has a paragraph that is long enough to be taken for its text."
    page = f"<article><p>{words}</p><object>An object that cannot be shown.</object><xmp>a <b> &amp; c</xmp></article>"
    assert html_extract.main_text(page) == f"{words}\nAn object that cannot be shown.\na <b> &amp; c"


def test_boosting_separates_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=3000) > 0).astype(float)
    held = np.arange(3000) % 3 == 0
    model = boosting.fit(x, y, held)
    fresh = rng.normal(size=(2000, 4))
    p = model.probability(fresh)
    assert ((p >= 0.5) == (fresh[:, 0] * fresh[:, 1] > 0)).mean() > 0.85
    assert p.min() >= 0 and p.max() <= 1
    order = np.argsort(model.margin(fresh))
    assert (np.diff(p[order]) >= 0).all()
    assert boosting.fit(x, np.zeros(3000), held).probability(fresh[:2]).tolist() == [0, 0]
    assert boosting.fit(x[:0], y[:0], held[:0]).probability(fresh[:1]).tolist() == [0]


def small_model(seed=0, counts_on=True):
    rng = np.random.default_rng(seed)
    size = 49_408
    counts = np.zeros(size)
    if counts_on:
        counts[:300] = rng.integers(1, 100, 300)
    ends = rng.random(size) < 0.5
    sample = rng.integers(0, 300, (200, 48)).astype(np.int32) if counts_on else np.empty((0, 48), np.int32)
    classes = attention.classify(sample, counts, ends)
    rows = attention.rows_of(counts, classes)
    by_row = rng.integers(0, 5, (attention.TABLE_ROWS, 64)).astype(float)
    by_class = np.zeros((attention.PAIRED, 64))
    pairs = np.zeros((attention.PAIRED, attention.PAIRED))
    shares = attention.shares_from(counts, classes, pairs, by_class)
    model = attention.initial(rows, classes, shares, by_row, size - 2, size - 1)
    return attention.train(sample, model, most_steps=20)


@pytest.mark.parametrize("counts_on", [True, False])
def test_attention_gives_a_distribution_over_the_next_id(counts_on):
    model = small_model(counts_on=counts_on)
    text = np.arange(20) % 7
    before = np.full((1, 16), len(model.qkv) - 1, np.int32)
    own = np.full((1, 16), len(model.qkv) - 1, np.int32)
    ids = np.full((1, 16), model.begin, np.int32)
    own[0, 0] = model.row_of[model.begin]
    own[0, 1:4] = model.row_of[text[:3]]
    ids[0, 1:4] = text[:3]
    total = 0.0
    every = np.arange(49_408)
    for at in range(0, len(every), 4096):
        part = every[at : at + 4096]
        targets = np.full((len(part), 16), -1, np.int32)
        targets[:, 3] = part
        log_p = model._forward(
            before.repeat(len(part), 0), own.repeat(len(part), 0), ids.repeat(len(part), 0), targets
        )
        total += (10.0 ** log_p[:, 3].astype(float)).sum()
    assert total == pytest.approx(1.0, abs=1e-3)


def test_attention_gradients_are_those_of_the_score():
    class Nothing:
        def of(self, inputs, targets, classes):
            return np.zeros(len(inputs), np.float32)

    model = dataclasses.replace(small_model(), shares=Nothing())
    text = np.random.default_rng(2).integers(0, 300, 90)
    *_, inputs, _, targets = model.laid_out([text])
    classes = np.where(targets >= 0, model.class_of[targets], -1)
    fit = attention.Fit(model)
    split = len(model.qkv)
    d_table = np.zeros((1, *inputs.shape, 48), np.float32)
    d_last = np.zeros((len(fit.weights) - split) * 48, np.float32)
    fit._gradients(inputs[None], classes[None, 1:], 1, d_table, d_last)
    got = np.zeros((split, 48))
    np.add.at(got, inputs, d_table[0])
    got = np.concatenate([got[:-1], np.zeros((1, 48)), d_last.reshape(-1, 48)])
    rng = np.random.default_rng(3)
    for rows in (np.unique(model.row_of[text]), np.arange(split, len(fit.weights))):
        way = np.zeros_like(fit.weights)
        way[rows] = rng.normal(0, 0.02, (len(rows), 48))
        up, down = (
            -attention.with_weights(model, fit.weights + x * way).score([text])[0] * np.log(10) for x in (1, -1)
        )
        assert (up - down) / 2 == pytest.approx((got * way).sum(), rel=0.02, abs=0.01)


def test_attention_is_causal_and_scores_each_id_once():
    model = small_model()
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 300, n) for n in (0, 1, 15, 16, 17, 100, 3000)]
    together = model.score(texts)
    assert together == pytest.approx([model.score([t])[0] for t in texts], rel=1e-4)
    # The score of a text is that of its beginning and of the rest, which the end does not change.
    long = rng.integers(0, 300, 40)
    ids = np.concatenate([[model.begin], long])
    steps = [model.score([long[:k]])[0] for k in range(41)]
    assert all(b < 0 for b in steps) and len(ids) == 41
    assert (model.score([]) == np.empty(0)).all()
