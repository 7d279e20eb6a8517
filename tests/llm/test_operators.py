from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fundsift import session
from fundsift.llm import (
    byte_bpe,
    common,
    decontaminate,
    exact_dedup,
    html_extract,
    language,
    maxent,
    merge_sort,
    minhash,
    sharding,
    simhash,
    substrings,
    token_counts,
)
from fundsift.llm import words as word_splitter
from fundsift.llm.components import components
from fundsift.llm.html_blocks import Page


def words(text):
    return (text or "").encode().lower().split()


def ids(rows):
    return [r[0] for r in rows]


# -- byte-level BPE and token counts


def tiktoken_encoding():
    import public_tokenizers

    bpe = byte_bpe.load(byte_bpe.VOCABULARY)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.rank_of, special_tokens={})


def test_bpe_equals_tiktoken(odd_docs):
    expected = tiktoken_encoding()
    rows = odd_docs.select("text", byte_bpe.encode(F.col("text")).alias("ids")).withColumn("back", byte_bpe.decode(F.col("ids"))).collect()
    for r in rows:
        assert r.ids == expected.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()


def test_bpe_on_long_and_random_pieces():
    expected, bpe, dice = tiktoken_encoding(), byte_bpe.load(byte_bpe.VOCABULARY), random.Random(3)
    parts = ["a", "aa", "the", " ", "  ", "\n", "\x85", "é", "ß", "日本", "١٢", "²", "'s", "_", "!!", "ing", "\U0001f600"]
    texts = ["".join(dice.choices(parts, k=dice.randint(0, 60))) for _ in range(500)]
    for text in [*texts, "a" * 20_000, "abcab" * 5000, " " * 3000, "the" * 5000]:
        assert bpe.encode(text) == expected.encode_ordinary(text)


def test_very_long_texts_are_encoded_in_parts(monkeypatch):
    expected, bpe = tiktoken_encoding(), byte_bpe.load(byte_bpe.VOCABULARY)
    monkeypatch.setattr(byte_bpe, "GROUP", 50)
    monkeypatch.setattr(byte_bpe, "MATCHES", 7)
    monkeypatch.setattr(byte_bpe, "CACHED", 20)
    texts = ["short one", "", "é" * 30 + " and so on, " * 20, "x", "a  b\n\n c" * 15, "end"]
    assert list(bpe.encode_all(texts)) == list(map(expected.encode_ordinary, texts))


def test_lower_rank_goes_first():
    """A merge that brings about a lower rank is followed by that rank, not by its equals."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abca": 256, b"bc": 300, b"abc": 301, b"ab": 302, b"ca": 299, b"aab": 257}
    own = byte_bpe.ByteBpe(ranks, r"[a-c]+")
    expected = tiktoken.Encoding("x", pat_str=r"[a-c]+", mergeable_ranks=ranks, special_tokens={})
    for k in range(1, 8):
        for text in map("".join, itertools.product("abc", repeat=k)):
            assert own.encode(text) == expected.encode_ordinary(text)


def greedy(word, starting, continuing):
    n = i = 0
    while i < len(word):
        found = next((j for j in range(len(word), i, -1) if word[i:j] in (continuing if i else starting)), None)
        if found is None:
            return token_counts.UNKNOWN
        i, n = found, n + 1
    return n


def test_piece_counter_equals_greedy_matching():
    dice = random.Random(1)
    for k in range(600):
        letters = b"abc"[: dice.choice([2, 3])]
        one, two = ({bytes(dice.choices(letters, k=dice.randint(1, 5))) for _ in range(dice.randint(1, 8))} for _ in range(2))
        counter = token_counts.PieceCounter(one, two if k % 2 else one)
        for _ in range(10):
            word = bytes(dice.choices(letters, k=dice.randint(0, 12)))
            assert counter.count(word) == greedy(word, one, two if k % 2 else one)


def test_token_counts(odd_docs):
    bpe = byte_bpe.load(byte_bpe.VOCABULARY)
    for r in odd_docs.select("text", token_counts.token_counts(F.col("text")).alias("c")).collect():
        pieces = bpe.pattern.findall(r.text or "")
        assert r.c.n_words == len(pieces)
        if len(r.text or "") < 1000:
            assert r.c.n_tokens == sum(greedy(p.encode(), bpe.rank_of, bpe.rank_of) for p in pieces)


# -- sharding


def test_shards_match_the_mixture(odd_docs, no_docs):
    tie = odd_docs.withColumn("tie", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    rows = sharding.interleave(tie, 4).collect()
    assert len(rows) == odd_docs.count()
    by_shard = Counter(r.shard for r in rows)
    assert max(by_shard.values()) - min(by_shard.values()) <= 1
    for shard, n in by_shard.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    for source, n in Counter(r.source for r in rows).items():
        each = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(each[s] - n / 4) <= 2 for s in range(4))
    assert sharding.interleave(no_docs.withColumn("tie", F.lit(1)), 4).count() == 0


# -- exact and near duplicates


def normal(text):
    import re

    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_exact_groups(odd_docs, odd_rows, no_docs):
    found = Counter(tuple(r) for r in exact_dedup.groups(odd_docs).collect())
    expected = Counter()
    for doc_id, text, *_ in odd_rows:
        same = [r[0] for r in odd_rows if normal(r[1]) == normal(text)]
        keep = min((i for i in same if i is not None), default=None)
        expected[doc_id, keep, len(same), doc_id == keep, hashlib.sha256(normal(text).encode()).hexdigest()] += 1
    assert found == expected
    assert exact_dedup.groups(no_docs).count() == 0


def test_unique_keeps_each_text_once(odd_docs, odd_rows, no_docs):
    kept = exact_dedup.unique(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(r[1]) for r in odd_rows})
    assert exact_dedup.unique(no_docs).count() == 0


def test_ambiguous_hashes_do_not_join_texts(odd_docs, monkeypatch):
    plain = {tuple(r) for r in exact_dedup.groups(odd_docs).collect()}
    hashes = [r[0] for r in odd_docs.select(F.explode(exact_dedup.chunks(exact_dedup.normalised(F.col("text")))).alias("c")).select(F.xxhash64("c")).distinct().collect()]
    monkeypatch.setattr(exact_dedup, "ambiguous_hashes", lambda *_: hashes[:20])
    assert {tuple(r) for r in exact_dedup.groups(odd_docs).collect()} == plain


def shingle_sets(rows, width):
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append(frozenset(zip(*(w[k:] for k in range(width)), strict=False)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    return sets


def linked(sets):
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    return [root(a) for a in range(len(sets))]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(odd_docs, odd_rows, width):
    sets = shingle_sets(odd_rows, width)
    roots = linked(sets)
    expected = Counter()
    for k, (doc_id, *_) in enumerate(odd_rows):
        least = min((odd_rows[j][0] for j in range(len(odd_rows)) if roots[j] == roots[k] and odd_rows[j][0] is not None), default=None)
        expected[doc_id, len(sets[k]), least, doc_id == least] += 1
    assert Counter(tuple(r) for r in minhash.near_duplicates(odd_docs, width=width).collect()) == expected


def test_links_between_components_are_found(spark, monkeypatch):
    """A chain whose ends are unlike, and a crowd around a text that is not the smallest id."""
    dice = random.Random(11)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(150):
        copy = list(base)
        for place in dice.sample(range(200), 12):
            copy[place] = f"c{k}x{place}"
        rows.append((k, " ".join(copy)))
    rows.append((900, " ".join(base)))
    rows += [(1000 + k, " ".join(f"v{j}" for j in range(9 * k, 9 * k + 120))) for k in range(12)]
    monkeypatch.setattr(minhash, "BLOCK", 8)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    roots = linked(shingle_sets(rows, 2))
    least = {}
    for (i, _), root in zip(rows, roots, strict=True):
        least[root] = min(i, least.get(root, i))
    assert found == {i: least[root] for (i, _), root in zip(rows, roots, strict=True)}


def test_near_duplicates_of_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def test_large_groups_have_few_pairs_of_blocks(spark):
    """All pairs of members meet once, in blocks that are not small."""
    n = 1000
    values = np.random.default_rng(3).integers(0, 2, (n, minhash.HASHES)).astype(np.uint32)
    values[1] = values[0]
    members = spark.createDataFrame([(7, k, k, 1) for k in range(n)], "group long, node long, part long, size int")
    payload = spark.createDataFrame([(k, bytearray(values[k].tobytes())) for k in range(n)], "node long, signature binary")
    pairs = minhash._block_pairs(members, payload).cache()
    assert pairs.count() <= 10
    found = pairs.mapInArrow(minhash._candidates_in_blocks, "a long, b long").collect()
    agreement = (values[:, None] == values[None]).sum(axis=2) >= minhash.LEAST_AGREEMENT
    expected = {(a, b) for a, b in zip(*np.nonzero(agreement), strict=True) if a < b}
    assert (0, 1) in expected and {tuple(r) for r in found} == expected


def test_components(spark):
    dice = random.Random(5)
    edges = [(dice.randrange(200), dice.randrange(200)) for _ in range(130)] + [(300 + k, 301 + k) for k in range(40)] + [(None, 3), (5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert found[start] == min(seen)
    assert set(found) == set(near)


# -- language


def test_language(spark, odd_docs, no_docs):
    rows = [(k, text, lang) for k, (text, lang) in enumerate([("the house and the tree", "en"), ("le chat et la maison", "fr"), ("der Hund und das Haus", "de")] * 5)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "fr"]
    asked = spark.createDataFrame([("the tree and the house",), ("la maison et le chat",), (None,), ("",), ("12 ²!",)], "text string")
    found = [tuple(r.p) for r in asked.select(language.predict(spark, F.col("text"), model).alias("p")).collect()]
    assert [f[0] for f in found] == ["en", "fr", "und", "und", "und"]
    assert all(0 <= f[1] <= 1 for f in found)
    assert len(odd_docs.select(language.predict(spark, F.col("text"), language.train(odd_docs)).alias("p")).collect()) == odd_docs.count()
    empty = language.train(no_docs)
    assert empty.languages == []
    assert asked.select(language.predict(spark, F.col("text"), empty)["lang_pred"]).first()[0] == "und"


def test_languages_in_blocks_equal_one_model(spark, monkeypatch):
    """More languages than a block holds: the same predictions and posteriors."""
    dice = random.Random(5)
    names = ["de", "en", "es", "fr", "it", "ünd", "zz"]
    rows = [(k, "".join(dice.choices(f"abc{i}{i} ", k=30)), name) for k, (i, name) in enumerate(list(enumerate(names)) * 4)]
    docs = spark.createDataFrame([*rows, (99, None, "en"), (100, "12", "fr"), (101, "a", None)], "n long, text string, lang string")

    def predicted():
        model = language.train(docs)
        found = docs.select("n", language.predict(spark, F.col("text"), model).alias("p")).orderBy("n").collect()
        return len(model.more), [(r.p.lang_pred, round(r.p.score, 6)) for r in found]

    blocks, whole = predicted()
    assert blocks == 0
    for most in (1, 2, 3):
        monkeypatch.setattr(language, "MAX_CELLS", most * language.BUCKETS)
        assert predicted() == (-(-len(names) // most) - 1, whole)


# -- web pages


def test_min_cut_equals_brute_force():
    dice = random.Random(3)
    for _ in range(200):
        n = dice.randint(1, 6)
        a, b = (np.array([dice.choice([0, 1, 2, 3.5]) for _ in range(n)]) for _ in range(2))
        edges = [(i, j, dice.choice([0.5, 1, 2])) for i in range(n) for j in range(i + 1, n) if dice.random() < 0.5]

        def cost(x, n=n, a=a, b=b, edges=edges):
            return sum(b[i] if x[i] else a[i] for i in range(n)) + sum(w for i, j, w in edges if x[i] != x[j])

        best = min(map(cost, itertools.product([0, 1], repeat=n)))
        assert cost(html_extract.min_cut(a, b, edges)) == pytest.approx(best)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><a href="/">Home</a></header>
<div class="cookie-notice">We use cookies.</div><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="wrap"><div class="entry-content"><h1>The &eacute;nd &amp; more</h1><p>First  part,<br>with a break and <b>bold</b> words in it.
<p>Second part is a sentence as well, long enough to count. &lt;tag&gt;</p><script>var x = "<p>no</p>";</script>
<div class="ad">Buy now!</div><p>Third part of the text is also a proper sentence.</p></div>
<aside>Related things</aside><div id="comments"><p>I liked this very much, thank you for it.</p></div>
<form><label>Mail</label><input name=q></form></div><footer>&copy; Someone</footer>"""


def test_extract(spark):
    rows = [(1, PAGE), (2, None), (3, ""), (4, "just text"), (5, "<p>" * 3000 + "deep"), (6, "<a href='x"), (1, PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    weights = html_extract.train(pages)
    found = [r.t for r in pages.select(html_extract.extract(spark, F.col("html"), weights).alias("t")).collect()]
    assert found[0] == found[-1] == "\n".join([
        "The énd & more", "First part, with a break and bold words in it.",
        "Second part is a sentence as well, long enough to count. <tag>", "Third part of the text is also a proper sentence.",
    ])
    assert found[1:3] == ["", ""]
    assert html_extract.train(pages.limit(0)).shape == weights.shape


@pytest.mark.parametrize("before", [
    '<nav><svg class="i"/></nav>', "<svg/>", '<nav><svg data-x="a>b" /><svg><path d="M0"/></svg></nav>', '<svg><use href="#a"/></svg>', "<svg-icon></svg-icon><title-bar></title-bar>",
])
def test_self_closing_images_take_no_text_along(before):
    assert [b.text for b in Page(f"{before}<article><p>Main text.</article><footer><svg><title>no</title></svg></footer>").blocks] == ["Main text."]


@pytest.mark.parametrize(("attrs", "hidden"), [
    ('data-title="The hidden truth"', False), ('class="flex hidden md:block"', False), ("title='aria-hidden=true display:none'", False), ('aria-hidden="false"', False),
    ('data-style="display:none"', False), ('style="display:none;display:block"', False), ('style="--display:none"', False), ("hidden", True), ('class="a" HIDDEN=""', True), ("aria-hidden=true", True),
    ("aria-hidden='true' data-x='1'", True), ('style="color:red; Display : none !important"', True), ("style=display:none", True),
])
def test_only_attributes_hide(attrs, hidden):
    assert [b.text for b in Page(f"<body><article {attrs}><p>Main text.</article>").blocks] == ([] if hidden else ["Main text."])


def test_blocks_of_articles():
    source = "<body><nav>Menu</nav><article><header><h2>Name</h2></header><p>One.<p>Two.<aside>Aside</aside></article></body>"
    weights = np.array([html_extract.PRIOR[f] for f in html_extract.FEATURES])
    assert html_extract.extract_text(source, weights) == "Name\nOne.\nTwo."
    assert [b.text for b in Page(source).blocks] == ["Menu", "Name", "One.", "Two.", "Aside"]


# -- language model


def test_scores(odd_docs, odd_rows, no_docs):
    learn = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(5)) != 1
    rows = maxent.score(odd_docs, learn).collect()
    counts = Counter()
    for doc_id, text, *_ in odd_rows:
        if (doc_id or 0) % 5 != 1:
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for doc_id, text, *_ in odd_rows:
        tokens = [*words(text), None]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        expected[doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 5)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == expected
    assert all(r.score < 0 for r in rows)
    untrained = maxent.score(odd_docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.base_score) < 1e-6 for r in untrained)
    assert maxent.score(no_docs, F.lit(True)).count() == 0


def test_rare_words_are_joined(odd_docs, monkeypatch):
    plain = sorted(round(r.score, 6) for r in maxent.score(odd_docs, F.lit(True)).collect())
    monkeypatch.setattr(maxent, "SHARE", 0.01)
    assert sorted(round(r.score, 6) for r in maxent.score(odd_docs, F.lit(True)).collect()) == plain


def test_scores_equal_a_direct_computation(spark):
    """Two rounds of updates over all documents and the scores, token by token with Python's numbers."""
    dice = random.Random(6)
    names = [f"w{k}" for k in range(60)]
    texts = [" ".join(dice.choices(names, weights=range(60, 0, -1), k=dice.randint(0, 50))) for _ in range(30)] + [None, "Unseen w1 w2"]
    rows = list(enumerate(texts))
    learn = [k for k, _ in rows if k % 4]
    top = sorted(Counter(w for k in learn for w in words(texts[k])).items(), key=lambda x: (-x[1], x[0]))
    counts, own = dict(top), {w: 1 + k for k, (w, _) in enumerate(top[: maxent.OWN])}
    place = lambda w: 0 if w is None else own.get(w) or 16 + xxhash.xxh64_intdigest(w, 42) % 16
    ends = len(learn)
    sizes, types = [0] * 32, [0] * 32
    for w, n in [*counts.items(), (None, ends)]:
        sizes[place(w)] += n
        types[place(w)] += 1
    total = sum(sizes)
    rates = [(n + 0.5) / (total + 16) for n in sizes]
    numbers = maxent._Numbers(own)

    def tokens(text):
        """Class and buckets of each token, and the token."""
        found = words(text)
        batch = next(maxent.batches_of(iter([(0, [numbers.of(found)] if found else [])]), 13))
        return list(zip(batch.places.tolist(), zip(*(f.tolist() for f in batch.features), strict=True), [*found, None], strict=True))

    weights: dict = {}

    def shares(buckets):
        each = [rates[c] * math.exp(sum(weights.get((k, b), [0] * 32)[c] for k, b in enumerate(buckets))) for c in range(32)]
        return [e / sum(each) for e in each]

    for _ in range(maxent.ROUNDS):
        sums: dict = {}
        for k in learn:
            for c, buckets, _ in tokens(texts[k]):
                expected = shares(buckets)
                for f in enumerate(buckets):
                    seen, model = sums.setdefault(f, ([0] * 32, [0] * 32))
                    seen[c] += 1
                    for j in range(32):
                        model[j] += expected[j]
        for f, (seen, model) in sums.items():
            step = [math.log((s + 5 * r) / (m + 5 * r)) / 3 for s, m, r in zip(seen, model, rates, strict=True)]
            weights[f] = [a + b for a, b in zip(weights.get(f, [0] * 32), step, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scored = {r.doc_id: r.score for r in maxent.score(docs, F.col("doc_id") % 4 != 0).collect()}
    for k, text in rows:
        expected = 0.0
        for c, buckets, w in tokens(text):
            expected += math.log10(shares(buckets)[c])
            n = ends if w is None else counts.get(w, 0)
            if c > maxent.OWN:
                expected += math.log10((n + 0.5) / (sizes[c] + 0.5 * (types[c] + 1)))
        assert scored[k] == pytest.approx(expected, abs=1e-3)


def test_the_words_before_tell_words_of_a_class_apart(spark):
    """Two words as frequent as each other, of one hashed class, each after a word of its own."""
    names = [f"n{k}" for k in range(2000)]
    one = next(w for w in names if maxent.leaf(w.encode(), 0) == 3)
    two = next(w for w in names if maxent.leaf(w.encode(), 0) == 3 and maxent.leaf(w.encode(), 1) != maxent.leaf(one.encode(), 1))
    texts = [" ".join(names[k : k + 40]) for k in range(0, 2000, 40)] + [" ".join(f"f{k}" for k in range(maxent.OWN)) for _ in range(90)]
    texts += [f"here {one}", f"there {two}"] * 40
    docs = spark.createDataFrame([*enumerate(texts), (-1, f"here {one}"), (-2, f"here {two}")], "doc_id long, text string")
    found = {r.doc_id: r for r in maxent.score(docs, F.col("doc_id") >= 0).filter("doc_id < 0").collect()}
    assert found[-1].base_score == pytest.approx(found[-2].base_score)
    assert found[-1].score > found[-2].score + 0.5


def test_leaves_count_words_as_their_numbers_do(spark):
    names = [f"n{k}" for k in range(3000)]
    docs = spark.createDataFrame([(" ".join(names[k % 7 :]),) for k in range(9)], "text string")
    known = maxent.vocabulary(maxent.count_tokens(docs), 9)
    assert known.splits == 1 and [maxent.splits_for(n) for n in (0, 1024, 1025, 1 << 15, 1 << 20)] == [0, 0, 1, 1, 2]
    expected = np.zeros(16 * 32)
    for k in range(9):
        for w in names[k % 7 :]:
            if w.encode() not in known.own:
                expected[maxent.leaf(w.encode(), 1)] += 1
    assert known.leaf_tokens.tolist() == expected.tolist()
    assert known.class_tokens.sum() == known.tokens and known.leaf_types.sum() == 3000 - maxent.OWN
    numbers = maxent._Numbers(known.own).of([w.encode() for w in names])
    batch = next(maxent.batches_of(iter([(0, [numbers])]), 13))
    inner = [0 if w.encode() in known.own else 1 + maxent.leaf(w.encode(), 1) for w in names]
    assert batch.leaves(1).tolist() == [*inner, 0]
    for level, rates in zip(batch.levels(1), maxent.rates_of(known), strict=True):
        weights = np.random.default_rng(1).normal(size=(3, 1 << 13, 32)).astype(np.float32)
        shares = maxent.probabilities(weights, np.log(rates).astype(np.float32), level)
        assert shares.sum(axis=0) == pytest.approx(1, abs=1e-5)


def test_words_are_hashed_as_spark_does(spark):
    text = " ".join("é" * (n % 2) + "abcdefghijklmnopqrstuvwxyz0123456789" * 2 for n in range(2)) + "\t\x0b x\r\n" + " ".join("zyxwvutsrqponmlkjihgfedcba9876543210-~"[:n] for n in range(38)) + " "
    starts, found = word_splitter.word_hashes(text.encode())
    assert found.tolist() == [xxhash.xxh64_intdigest(w, 42) for w in text.encode().split()]
    assert [text.encode()[s:].split()[0] for s in starts] == text.encode().split()
    rows = spark.createDataFrame([(w.decode(),) for w in text.encode().split()], "w string").select(F.xxhash64("w")).collect()
    assert found.astype(np.int64).tolist() == [r[0] for r in rows]
    assert [len(word_splitter.word_hashes(raw)[0]) for raw in (b"", b" ", b"a", b" a", b"a ")] == [0, 0, 1, 1, 1]


def test_new_words_are_not_hashed_one_by_one(monkeypatch):
    calls = []
    plain = xxhash.xxh64_intdigest
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *a: calls.append(a) or plain(*a))
    texts = [" ".join(f"new{k}" for k in range(i, i + 50)) for i in range(0, 5000, 50)] + [None, "", "end " * 300_000, "one"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    found = list(maxent._training_batches(iter([batch, batch]), {b"end": 1}, 13))
    assert sum(len(b.places) for b in found) == 2 * (5000 + 300_000 + 1 + len(texts))
    assert sum(int((b.places == 1).sum()) for b in found) == 600_000
    assert len(calls) < 10


def test_small_inputs_in_many_parts_send_few_models(spark, monkeypatch):
    parts = []
    added = maxent._added_up
    monkeypatch.setattr(maxent, "_added_up", lambda made, *a: parts.append(made.rdd.getNumPartitions()) or added(made, *a))
    docs = spark.createDataFrame([(f"one two {k}",) for k in range(200)], "text string").repartition(40)
    known = maxent.vocabulary(maxent.count_tokens(docs), 200)
    maxent.train(docs, known)
    assert len(parts) == maxent.ROUNDS and max(parts) <= 8


def test_buckets_grow_with_the_tokens():
    assert [maxent.bucket_bits(n) for n in (0, 10**6, 1 << 27, 1 << 28, 1 << 40)] == [13, 13, 14, 15, 15]


# -- repeated passages and merge sort


def cleaned(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    for raw in raws:
        spans = [(i, i + length) for i in range(len(raw) - length + 1) if seen[raw[i : i + length]] > 1]
        left, removed, runs = substrings.remove(raw, spans)
        yield len(raw), removed, runs, left


def test_repeats_equal_brute_force(odd_docs, odd_rows, no_docs):
    rows = [r for r in odd_rows if len(r[1] or "") < 20_000]
    found = substrings.without_repeats(odd_docs.filter("text IS NULL OR length(text) < 20000")).collect()
    expected = Counter((r[0], *c) for r, c in zip(rows, cleaned([r[1] for r in rows]), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == expected
    assert substrings.without_repeats(no_docs).count() == 0


def test_shortened_splitters_part_keys_as_whole_ones_do():
    dice = random.Random(4)
    keys = sorted({bytes(dice.choices(b"ab", k=dice.randint(0, 12))) for _ in range(400)} - {b""})
    for step in (1, 3, 40):
        whole = keys[step::step]
        short = merge_sort.shortened(whole)
        assert sum(map(len, short)) <= sum(map(len, whole))
        parts = [sum(s <= k for s in short) for k in keys]
        assert parts == sorted(parts)
        assert all(parts[keys.index(w)] == i + 1 for i, w in enumerate(whole))


def test_splitters_are_some_of_the_sampled_keys(spark):
    rows = [(k, f"{k * 7919 % 1000:04d}".encode()) for k in range(1000)]
    sample = spark.createDataFrame(rows, "n long, word binary").repartition(5)
    found = merge_sort.splitters_of(sample, lambda d: [bytes(w) for w in d["word"]])
    assert 1000 // merge_sort.SAMPLED - 8 <= len(found) <= 1000 // merge_sort.SAMPLED + 8
    assert found == sorted(set(found))
    assert merge_sort.splitters_of(sample.limit(0), lambda d: list(d["word"])) == []


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_overlapping_passages(spark, seed, monkeypatch):
    """Passages whose ends differ from copy to copy, cut from few sources, in small ranges and chunks."""
    monkeypatch.setattr(merge_sort, "RUN", 40)
    monkeypatch.setattr(merge_sort, "RANGE", 60)
    dice = random.Random(seed)
    sources = ["".join(dice.choices("abcd ", k=900)) for _ in range(3)] + ["ab" * 450]
    rows = []
    for k in range(60):
        parts = []
        for _ in range(3):
            source, start = dice.choice(sources), dice.randrange(600)
            parts += ["".join(dice.choices("xyz", k=dice.randrange(90))), source[start : start + dice.randint(150, 300)]]
        rows.append((k, "".join(parts)))
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = {r[0]: c for r, c in zip(rows, cleaned([r[1] for r in rows]), strict=True)}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found} == expected


@pytest.fixture
def staged(monkeypatch):
    """(name, rows) of the tables that the search for repeats stages, in order."""
    found = []

    def counted(df, name):
        table = common.stage(df, name)
        found.append((name, table.count()))
        return table

    monkeypatch.setattr(substrings, "stage", counted)
    return found


def overlapping(seed, n=60):
    dice = random.Random(seed)
    sources = ["".join(dice.choices("abcd ", k=900)) for _ in range(3)]
    for k in range(n):
        parts = []
        for _ in range(3):
            source, start = dice.choice(sources), dice.randrange(600)
            parts += ["".join(dice.choices("xyz", k=dice.randrange(90))), source[start : start + dice.randint(150, 300)]]
        yield k, "".join(parts)


def test_repeats_found_in_slices(spark, monkeypatch, staged):
    monkeypatch.setattr(substrings, "SORTED", 0)
    monkeypatch.setattr(substrings, "OPEN", 0)
    monkeypatch.setattr(substrings, "LEAST", 200)
    rows = list(overlapping(5))
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = {r[0]: c for r, c in zip(rows, cleaned([r[1] for r in rows]), strict=True)}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found} == expected
    names = [name for name, _ in staged]
    assert 1 < names.count("records") < names.count("strings")


def test_tables_of_repeats_go_once_read(spark, monkeypatch):
    most, before = [], set(session._SCRATCH)
    monkeypatch.setattr(substrings, "stage", lambda df, name: (common.stage(df, name), most.append(len(set(session._SCRATCH) - before)))[0])
    freed = spark.conf.get(common._FREED)
    found = substrings.without_repeats(spark.createDataFrame(list(overlapping(6, 20)), "doc_id long, text string"))
    left = set(session._SCRATCH) - before
    assert len(left) == 1 and "/spans-" in left.pop()
    assert max(most) <= 9 and len(most) > 15
    assert spark.conf.get(common._FREED) == freed
    assert len(found.collect()) == 20


def test_only_strings_that_may_be_repeated_are_stored(spark, staged):
    """One text makes strings open at a common passage; those of all other texts there are not looked at."""
    dice = random.Random(9)

    def some(n):
        return "".join(dice.choices("abcdefgh", k=n))

    passage, ahead, behind = some(120), some(150), some(150)
    texts = [some(150) + passage + some(150) for _ in range(40)]
    texts += [ahead + passage + some(150), some(150) + passage + behind, ahead + passage + behind]
    found = substrings.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    expected = {k: c for k, c in enumerate(cleaned(texts))}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found} == expected
    assert 0 < sum(n for name, n in staged if name == "strings") < 200


def test_removed_runs():
    assert substrings.remove(b"0123456789", [(2, 4), (3, 6), (6, 7), (9, 10)]) == (b"0178", 6, 2)
    assert substrings.remove(b"", []) == (b"", 0, 0)


def test_anchors_cover_every_string_once(monkeypatch):
    dice = random.Random(2)
    for text in ("a" * 900, "ab" * 500, "".join(dice.choices("abc", k=3000)), "x" * 199, "y" * 200):
        for chunk in (1 << 18, 256):
            monkeypatch.setattr(substrings, "CHUNK", chunk)
            _, at, first, last = substrings.anchors(text.encode())
            strings = sorted(i for f, end in zip(first, last, strict=True) for i in range(f, end + 1))
            assert strings == list(range(max(0, len(text) - 199)))
            assert all(f <= a and end <= a <= f + 176 for a, f, end in zip(at, first, last, strict=True))


def test_loser_tree_merges_with_prefixes():
    dice = random.Random(4)
    for n in (1, 2, 3, 7, 16):
        runs = [sorted(bytes(dice.choices(b"ab", k=dice.randint(0, 40))) for _ in range(dice.randint(0, 60))) for _ in range(n)]
        coded = [merge_sort.front_coded(r) for r in runs]
        merged = list(merge_sort.LoserTree([merge_sort.decoded(s.tolist(), t) for s, t in coded]))
        keys = [k for _, _, k in merged]
        assert keys == sorted(itertools.chain(*runs))
        for (_, _, a), (_, shared, b) in itertools.pairwise(merged):
            assert shared == merge_sort.common_prefix(a, b)


# -- decontamination


def test_decontamination(spark, no_docs):
    dice = random.Random(9)
    names = ["".join(dice.choices("abcdefghij", k=6)) for _ in range(2000)]
    items = [" ".join(dice.choices(names, k=dice.randint(15, 60))) for _ in range(20)] + [None, "", "two words", None]
    docs, expected = [], set()
    for k in range(200):
        before, after = " ".join(dice.choices(names, k=60)), " ".join(dice.choices(names, k=40))
        if k % 4:
            docs.append((k, f"{before} {after}"))
            continue
        item = dice.randrange(20)
        inside = items[item].split()
        for place in dice.sample(range(len(inside)), len(inside) // (8 if k % 8 else 1000)):
            inside[place] = "edited"
        docs.append((k, f"{before} {' '.join(inside).upper()}! {after}"))
        expected.add((k, item))
    docs += [(None, items[0]), (400, None), (401, ""), docs[0], docs[0]]
    bench = spark.createDataFrame([(k, t, "z") for k, t in enumerate(items)] + [(0, items[0], "z")], "item_id long, text string, key string")
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.item_id < 20} == expected | {(None, 0)}
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert all(0.6 <= r.score <= 1 for r in found)
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [11, 300])
def test_edited_copies_are_found_however_many_there_are(spark, copies, monkeypatch):
    """One exact copy, and edited copies that all keep the same few n-grams."""
    item = [f"w{k}" for k in range(20)]
    docs = [(0, " ".join(item))]
    docs += [(1 + c, " ".join(["before"] * 9 + [f"c{c}x{k}" if k % 4 == 3 else w for k, w in enumerate(item)] + ["after"] * 9)) for c in range(copies)]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    for most in (decontaminate.MAX_EXACT, 0):
        monkeypatch.setattr(decontaminate, "MAX_EXACT", most)
        found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
        assert {(r.doc_id, r.item_id) for r in found} == {(k, 7) for k in range(copies + 1)}


def test_decontamination_of_any_script(spark):
    latin = "Según él, la canción ñandú está aquí: über große Straßen fährt Ödön, où l’été naît; ΟΔΟΣ ΣΟΦΙΑΣ и Жёлтый дом"
    chinese = "数据工程师需要在训练语言模型之前清除基准测试的内容否则结果不可信"
    spaced = "one two three four five six seven eight nine ten"
    items = [(1, latin), (2, chinese), (3, spaced)]
    docs = [
        (1, f"avant {latin.upper()} après"),
        (2, f"我们今天读到{chinese}这一段文字"),
        (3, "say “one two—three\u00a0four\u3000five… six» seven–eight‘nine’\u2003ten”"),
        (4, f"before {latin.lower()}"),
        (5, "否则我们今天不需要读文字"),
    ]
    schema = "{} long, text string"
    found = decontaminate.contaminated(spark.createDataFrame(docs, schema.format("doc_id")), spark.createDataFrame(items, schema.format("item_id")))
    assert {(r.doc_id, r.item_id, r.score) for r in found.collect()} == {(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (4, 1, 1.0)}


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_plain_words_equal_the_pattern(odd_rows, chunk, monkeypatch):
    monkeypatch.setattr(word_splitter, "CHUNK", chunk)
    for text in [*(r[1] for r in odd_rows if len(r[1] or "") < 5000), "a\u00a0Ça_1—ǅ x\x1fy ñ\ud800", "日本語のテキスト and ไทย1"]:
        expected = re.findall("[\u0e00-\u0eff\u3040-\u30ff\u4e00-\u9fff]|[^\\W\u0e00-\u0eff\u3040-\u30ff\u4e00-\u9fff]+", (text or "").casefold())
        expected = [w for w in expected if w.isalnum() or "_" in w]
        assert [w.decode() for c in word_splitter.plain_words(text) for w in c] == expected


@pytest.mark.parametrize("most", [decontaminate.MAX_EXACT, 0])
def test_decontamination_equals_all_pairs(spark, most, monkeypatch):
    """Every document aligned with every item as a whole: short, long and equal items, edited copies, common words, nulls."""
    monkeypatch.setattr(decontaminate, "MAX_EXACT", most)
    dice = random.Random(12)
    names = ["of", "the", "and", "a"] * 8 + [f"w{k}" for k in range(80)]

    def prose(n):
        return dice.choices(names, k=n)

    items = [prose(n) for n in (1, 2, 3, 8, 12, 15, 20, 25, 40, 300)]
    items.append(list(items[5]))
    docs = [prose(dice.randint(0, 80)) for _ in range(30)]
    for item in items * 3:
        copy = [dice.choice([w, w, w, w, w, w, "edited"]) for w in item]
        docs.append(prose(dice.randint(0, 40)) + copy[dice.randint(0, 2) :] + prose(dice.randint(0, 40)))
    docs.append(prose(50) + items[3] + prose(1000) + items[6] + items[4] + prose(700))
    docs.append(prose(1500))
    rows = [(k, " ".join(d)) for k, d in enumerate(docs)] + [(900, None), (901, "")]
    bench = [(k, " ".join(i)) for k, i in enumerate(items)] + [(50, None), (51, "  ")]
    ids_of = word_splitter.WordIds()
    expected = {}
    for d, text in rows:
        for i, item in bench:
            a, b = decontaminate.numbers(item, ids_of), decontaminate.numbers(text, ids_of)
            if not len(a) or not len(b):
                continue
            width = min(3, len(a))
            score, start, end = decontaminate.align(a, b)
            near = b[start:end]
            if score >= 0.6 and set(decontaminate._hashes(a, width).tolist()) & set(decontaminate._hashes(near, width).tolist()):
                expected[d, i] = round(score, 9)
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in found.collect()}
    assert {k: got.get(k) for k in expected} == expected
    assert all(score >= 0.6 for score in got.values())


def test_runs_reach_as_far_as_their_own_items():
    at, reach = np.array([10, 12, 100, 500, 520]), np.array([5, 5, 200, 4, 30])
    assert list(decontaminate.runs(at, reach, 540)) == [(0, 3, 0, 303), (3, 5, 490, 540)]
    assert list(decontaminate.runs(at[:2], reach[:2], 14)) == [(0, 2, 5, 14)]
    assert list(decontaminate.runs(at[:0], reach[:0], 5)) == []


def test_skipped_alignments_are_below_the_threshold():
    dice = np.random.default_rng(2)
    for _ in range(400):
        a = dice.integers(0, 30, dice.integers(1, 20)).astype(np.uint64)
        b = np.concatenate([dice.integers(0, 60, dice.integers(1, 30)).astype(np.uint64), np.repeat(a, dice.integers(1, 3))])
        b = b[dice.random(len(b)) < dice.choice([0.6, 0.9])]
        if len(b) and not decontaminate._may_align(a, b):
            assert decontaminate.align(a, b)[0] < decontaminate.THRESHOLD


def test_alignment_equals_brute_force():
    dice = np.random.default_rng(1)
    for _ in range(60):
        a, b = dice.integers(0, 4, dice.integers(1, 9)).astype(np.uint64), dice.integers(0, 4, dice.integers(1, 25)).astype(np.uint64)
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            step = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] - decontaminate.GAP, table[i, j - 1] - decontaminate.GAP)
        score, start, end = decontaminate.align(a, b)
        assert score == table.max() / (2 * len(a))
        assert 0 <= start <= end <= len(b)


def nats():
    return np.array([html_extract.PRIOR[f] for f in html_extract.FEATURES])


@pytest.mark.parametrize("page", [
    "<body><form id='aspnetForm'>{}</form></body>",
    "<body><nav><a href=x>Home</a></nav><article><form action=x>{}<input name=q></form></article><footer>Legal</footer></body>",
    "<body><aside>{}</aside></body>",
])
def test_page_wide_forms_keep_their_article(page):
    paragraphs = [f"This is a long paragraph number {k}, with many words, that goes on and on until it ends." for k in range(5)]
    source = page.format("".join(f"<p>{p}</p>" for p in paragraphs))
    assert html_extract.extract_text(source, nats()).split("\n") == paragraphs


def test_small_forms_and_reactions_go():
    text = "<p>This is a long paragraph, with many words, that goes on and on until it ends.</p>" * 4
    source = f"<body><article>{text}<form><p>Write your own comment, please, it will be read.</p></form></article><section id='reactions'><p>I liked it, and so did my dog.</p></section></body>"
    assert set(html_extract.extract_text(source, nats()).split("\n")) == {re.sub("<.*?>", "", text[: text.index("</p>")])}


def test_deep_pages_take_time_in_proportion():
    for piece in ("<div>x ", "<div>x </span>", "<li><div>x ", "<p><b>x</div>"):
        start = time.perf_counter()
        page = Page(piece * 100_000)
        assert len(page.blocks) >= 50_000
        page.evidence()
        html_extract.smoothness(page)
        assert time.perf_counter() - start < 10


def test_distances_and_shares_follow_the_tree():
    page = Page("<div>aa<p>bb</p><section><p>cccc</p></section></div><div>dd</div>")
    a, b, c, d = (block.element for block in page.blocks)
    assert [page.distance(a, b), page.distance(b, c), page.distance(c, d), page.distance(d, d)] == [1, 3, 4, 0]
    assert page.shares()[a] == 0.8


def test_training_pages_do_not_depend_on_their_order(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "SAMPLE", 6)
    rows = [(None, f"<article><p>Text number {k}.</p></article><nav>{'Menu ' * k}</nav>") for k in range(30)] + [(1, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    first = html_extract.train(pages.repartition(5))
    assert np.array_equal(first, html_extract.train(pages.orderBy(F.desc("html")).coalesce(1)))
    assert np.array_equal(html_extract.train(pages.limit(0)), nats())


# -- pipeline


def test_texts_without_letters_go_with_or_without_labels(spark):
    texts = [None, "", " \t\n", "12 ²!", "_", "\u0301", "\U0001f600", "a", "1 é", "東", "\U00020000", "ʰ", "ǅ", "½ ª", "7\nж"]
    for lang in (None, "en"):
        docs = spark.createDataFrame([(k, t, lang) for k, t in enumerate(texts)], "doc_id long, text string, lang string")
        kept = corpus_pipeline.keep_known_languages(spark, docs, "")
        assert kept.columns == docs.columns
        assert sorted(ids(kept.collect())) == [k for k, t in enumerate(texts) if any(map(str.isalpha, t or ""))]


def test_missing_languages_are_filled_in(spark):
    rows = [(k, text, lang, 7) for k, (text, lang) in enumerate([("le chat et la souris", "fr"), ("the cat and the mouse", "en"), ("the mouse", None), ("la souris", None), ("the cat", "fr"), (None, "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, found long")
    kept = corpus_pipeline.keep_known_languages(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.lang, r.found) for r in kept.collect()) == [(0, "fr", 7), (1, "en", 7), (2, "en", 7), (3, "fr", 7), (4, "fr", 7)]


def test_columns_of_the_last_stage_are_replaced(spark):
    docs = spark.createDataFrame([(1, "one two", "x", 2.0, "y"), (2, None, None, None, None)], "doc_id long, text string, token_ids string, n_tokens double, found string")
    coded = corpus_pipeline.encode_and_decode(spark, docs, "").orderBy("doc_id").collect()
    bpe = byte_bpe.load(byte_bpe.VOCABULARY)
    assert [(r.text, r.found, r.token_ids, r.n_tokens, r.round_trip) for r in coded] == [("one two", "y", bpe.encode("one two"), 2, True), (None, None, [], 0, True)]


def test_pipeline(spark, odd_docs, odd_rows, no_docs, tmp_path):
    bench = str(tmp_path / "benchmark.parquet")
    spark.createDataFrame([(1, " ".join((odd_rows[60][1] or "").split()[:40]))], "item_id long, text string").write.parquet(bench)
    docs = odd_docs
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = step(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "byte_bpe":
            assert docs.columns == before.columns
    rows = docs.collect()
    texts = [normal(r.text) for r in rows]
    assert len(texts) == len(set(texts))
    assert all(any(c.isalpha() for c in t) for t in texts)
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)
    kept = [(r.doc_id, r.text) for r in rows]
    assert len(set(linked(shingle_sets(kept, corpus_pipeline.SHINGLE)))) == len(kept)
    empty = no_docs
    for _, step in corpus_pipeline.STAGES:
        empty = step(spark, empty, str(tmp_path))
    assert empty.count() == 0


def test_language_equals_plain_naive_bayes(spark):
    """Counts, smoothing, prior and posterior computed again with Python's numbers."""

    def buckets(text):
        codes, mask = [ord(c) for c in text.lower()], (1 << 32) - 1
        for k in range(len(codes)):
            mixed = 0
            for n in range(1, 4):
                if k + n > len(codes):
                    break
                mixed = (mixed * 0x01000193 & mask) ^ codes[k + n - 1]
                yield ((mixed + n) * 2654435761 & mask) >> 17

    dice = random.Random(8)
    kinds = {"aa": "abcdeé ", "bb": "abcxyz ", "cc": "东京bc "}
    rows = [(lang, "".join(dice.choices(letters, k=dice.randint(0, 60)))) for lang, letters in kinds.items() for _ in range(8 + len(lang))]
    rows += [(None, "abc abc"), ("aa", None)]
    seen = Counter(lang for lang, _ in rows if lang)
    counts = {lang: Counter() for lang in seen}
    for lang, text in rows:
        if lang:
            counts[lang].update(buckets(text or ""))
    model = language.train(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    for text in ["abc", "xyz a", "东", "éé éé", "".join(dice.choices("abxé东 ", k=200))]:
        log = {
            lang: math.log(seen[lang] / seen.total())
            + sum(math.log((counts[lang][b] + 0.5) / (counts[lang].total() + 0.5 * language.BUCKETS)) for b in buckets(text))
            for lang in seen
        }
        best = max(sorted(log), key=log.get)
        found = language._predict_one(model, text)
        assert found[0] == best
        assert found[1] == pytest.approx(1 / sum(math.exp(v - log[best]) for v in log.values()), rel=1e-3)


def test_chunks_count_each_character_run_once(monkeypatch):
    text = "Straße und Brücke, " * 9
    whole = Counter(np.concatenate(list(language.buckets_of(text))).tolist())
    for size in (1, 2, 3, 10):
        monkeypatch.setattr(language, "CHUNK", size)
        assert Counter(np.concatenate(list(language.buckets_of(text))).tolist()) == whole


def test_long_pretokens_have_a_bucket_for_each_rank(monkeypatch):
    """Random vocabularies whose merges may bring about lower ranks, and a mix of long and short."""
    monkeypatch.setattr(byte_bpe, "LONG", 12)
    dice = random.Random(3)
    for k in range(60):
        tokens = list({bytes(dice.choices(b"abc", k=dice.randint(2, 5))) for _ in range(14)})
        dice.shuffle(tokens)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(tokens)}
        own = byte_bpe.ByteBpe(ranks, r"[a-c]+")
        expected = tiktoken.Encoding(f"own{k}", pat_str=r"[a-c]+", mergeable_ranks=ranks, special_tokens={})
        texts = [" ".join("".join(dice.choices("abc", k=dice.randint(1, 40))) for _ in range(4)) for _ in range(10)]
        assert list(own.encode_all(texts)) == list(map(expected.encode_ordinary, texts))


def test_long_pretokens_are_not_remembered():
    bpe = byte_bpe.load(byte_bpe.VOCABULARY)
    long = "qz" * 5000
    expected = tiktoken_encoding().encode_ordinary(long + " end")
    assert bpe.encode(long + " end") == expected
    assert long not in bpe.known
    assert all(len(piece) <= byte_bpe.LONGEST_CACHED for piece in bpe.known)


def test_round_trip_equals_encoding_and_decoding(odd_docs, no_docs):
    rows = odd_docs.select("text", byte_bpe.encode(F.col("text")).alias("ids"), byte_bpe.round_trip(F.col("text")).alias("both")).collect()
    assert all(r.both.ids == r.ids and bytes(r.both.decoded) == (r.text or "").encode() for r in rows)
    assert no_docs.select(byte_bpe.round_trip(F.col("text"))).count() == 0
    assert no_docs.select(token_counts.token_counts(F.col("text"))).count() == 0


# -- SimHash


def plain_fingerprint(text, width=4):
    w = words(text)
    runs = [b" ".join(w[k : k + width]) for k in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(keys, values, radius):
    parent = list(range(len(keys)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(range(len(keys)), 2):
        if (values[a] ^ values[b]).bit_count() <= radius:
            parent[root(a)] = root(b)
    roots = [root(a) for a in range(len(keys))]
    return [min((k for k, r in zip(keys, roots, strict=True) if r == own and k is not None), default=None) for own in roots]


def test_simhash_equals_brute_force(odd_docs, odd_rows, no_docs):
    prints = [plain_fingerprint(r[1]) for r in odd_rows]
    least = least_reachable([r[0] for r in odd_rows], prints, 4)
    expected = Counter((r[0], f"{p:016x}", c) for r, p, c in zip(odd_rows, prints, least, strict=True))
    assert Counter(tuple(r) for r in simhash.near_duplicates(odd_docs).collect()) == expected
    assert simhash.near_duplicates(no_docs).count() == 0


def test_tiles_find_all_links(spark, monkeypatch):
    """Chains and balls of fingerprints, over many tiles of a cell, at the sign bit too."""
    monkeypatch.setattr(simhash, "TILE", 16)
    monkeypatch.setattr(simhash, "STRIP", 5)
    dice = random.Random(5)
    values = {0, (1 << 64) - 1, 1 << 63, (1 << 63) | 0b111}
    for _ in range(30):
        start = dice.getrandbits(64)
        for _ in range(25):
            values.add(start)
            for bit in dice.sample(range(64), dice.randint(1, 6)):
                start ^= 1 << bit
    values.update(sum(1 << b for b in dice.sample(range(64), 32)) for _ in range(500))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [found.get(v, v) for v in signed] == least_reachable(signed, values, 4)


def test_fingerprint_of_a_long_text_in_chunks(monkeypatch):
    text = " ".join(f"w{k % 997}" for k in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(word_splitter, "CHUNK", 100)
    assert simhash.fingerprint(text) == whole
    assert whole % (1 << 64) == plain_fingerprint(text)
