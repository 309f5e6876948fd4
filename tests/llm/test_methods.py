"""Operators against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from gatefold.llm import (
    catalog,
    chat,
    components,
    elias_fano,
    html_extract,
    line_dedup,
    minmax,
    mixing,
    ngram_trie,
    packing,
    sketch,
    toxicity,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


def made_up(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# packing ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 4095, 4096, 4097, 12_345])
def test_binary_cuts_cover_once(n):
    cuts = list(packing.binary_cuts(n))
    assert [s for s, _ in cuts] == list(itertools.accumulate([0, *[k for _, k in cuts]]))[:-1]
    assert sum(k for _, k in cuts) == n and all(k & (k - 1) == 0 and k <= 4096 for _, k in cuts)


def test_pieces_hold_the_tokenizers_ids(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = collections.defaultdict(dict)
    for r in catalog.op4_packing(spark, SF).collect():
        got[r.doc_id][r.start] = (r.length, r.ids_crc32)
    for doc_id, text in texts.items():
        ids = [*coder.encode(text, add_special_tokens=False).ids, 2]
        for start, (length, crc) in got[doc_id].items():
            assert crc == zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes())
        assert sum(length for length, _ in got[doc_id].values()) == len(ids)


@pytest.mark.parametrize("text", ["a<|endoftext|>b C", "<|ENDOFTEXT|> x", "É́ ΣΑΣ x\x1cy", "it's 12,3!! ..a"])
def test_words_encode_like_the_text(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert packing.WordTokens.of(path).ids(text.encode()) == np.array(ids, dtype="<u4").tobytes()


def test_words_of_many_texts_are_looked_up_once():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path, asked = public_tokenizers.path("word_bpe_49k.json"), collections.Counter()

    class Counted(packing.WordTokens):
        def get(self, word):
            asked[word] += 1
            return super().get(word)

    texts = [
        "The thing, the\u00a0other THING.", "", "  \x0b the\tthing, ", "the <|ENDOFTEXT|> The", "a<|endoftext|>b the",
        "e\u0301\u00e9 \u03a3\u0391\u03a3 it's 12,3 \u2003 x\x1cy the", "\u0301the thing,",
    ]
    known, coder = Counted(path), Tokenizer.from_file(path)
    for rows in (pa.array(texts, pa.large_binary()), pa.array([t.encode() for t in ["the", *texts]], pa.binary()).slice(1)):
        asked.clear()
        ids, starts = known.ids_of(rows)
        for at, text in enumerate(texts):
            assert ids[starts[at] : starts[at + 1]].tolist() == coder.encode(text, add_special_tokens=False).ids
        assert asked[b"the"] == asked[b"thing,"] == 1


# chat ------------------------------------------------------------------------------------------

def test_escape_round_trip():
    parts = [*chat.CONTROLS, "\\", "a", "<", "[", ">", "]", "/", "INST]", "<\\s>", "[\\\\INST]"]
    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 7)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROLS)


def test_conversations_read_back(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    turns = collections.defaultdict(list)
    for r in rows:
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in catalog.op7_chat_formatting(spark, SF).collect()}
    assert set(got) == set(turns)
    for key, spoken in turns.items():
        spoken.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in spoken)
        loss = "".join(text for _, role, text in spoken if role == "assistant")
        assert got[key].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[key].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[key].loss_chars == len(loss)


# fingerprints ----------------------------------------------------------------------------------

def spark_hash(words):
    import xxhash

    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - 2**64 if seed >= 2**63 else seed


def test_fingerprints_match_brute_force(spark, texts):
    import re

    def shingles(text):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
        return {spark_hash(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    got = {r.doc_id: r for r in catalog.op6_fingerprints(spark, SF).collect()}
    order = sorted(texts)
    off = []
    for here, after in zip(order, order[1:] + order[:1], strict=True):
        text, r = texts[here], got[here]
        k = len(text) // 4
        edited = text[: len(text) - k] + texts[after][:k]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        a, b = shingles(text), shingles(edited)
        assert r.fingerprint == "".join(f"{x & (2**64 - 1):016X}" for x in sorted(a)[:64])
        off.append(abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1)))
    assert np.mean(off) < 0.06 and max(off) < 0.3


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(6000)]
    docs = made_up(spark, [" ".join(words[:4000]), " ".join(words[2000:]), " ".join(words)])
    made = sketch.fingerprints(docs, k=256)
    whole = made.where("doc_id = 2").first().sketch
    parts = made.where("doc_id < 2").selectExpr("1 as g", "sketch")
    joined = sketch.merge_sketches(parts, ["g"], k=256).first().sketch
    # the union of the parts lacks only the shingles across the seam, of which there are none
    assert joined == whole
    a, b = made.where("doc_id = 0"), made.where("doc_id = 1").selectExpr("sketch as other")
    r = a.crossJoin(b).select(
        sketch.resemblance(a.sketch, b.other, 256).alias("j"),
        sketch.containment(a.sketch, b.other, 256).alias("c"),
        sketch.distinct_count(a.sketch, 256).alias("n"),
    ).first()
    assert abs(r.j - 1996 / 5996) < 0.1 and abs(r.c - 0.5) < 0.13 and abs(r.n / 3996 - 1) < 0.2


# near duplicates -------------------------------------------------------------------------------

def brute_components(texts, num, den):
    sets = {}
    for d, t in texts.items():
        w = t.encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d)) for d in texts}


def test_near_duplicates_of_the_table(documents, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minmax.near_duplicates(documents).collect()}
    assert got == brute_components(texts, 80, 100)


def test_chains_and_borders(spark):
    """Chains of edits whose ends are unlike, pairs just at and below the border, and one passage in all."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    shared = [word() for _ in range(60)]
    texts = []
    for _ in range(12):
        w = [word() for _ in range(120)]
        for _ in range(12):
            texts.append(" ".join(w))
            w = list(w)
            w[rng.randrange(len(w))] = word()
            if rng.random() < 0.4:
                w[rng.randrange(len(w))] = word()
    texts += [" ".join(shared + [word() for _ in range(rng.randint(5, 40))]) for _ in range(60)]
    rng.shuffle(texts)
    named = dict(enumerate(texts))
    got = minmax.near_duplicates(made_up(spark, texts), numerator=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(named, 85, 100)


def test_min_and_max_estimate_likeness():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, size=k, dtype=np.uint64) for k in (800, 100, 100))
    signer = minmax.Signer()
    x, y = (signer.sign(np.concatenate([common, s])) for s in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.08 and len(x) == 2 * minmax.PERMUTATIONS


def test_an_id_with_several_texts_is_one_document(spark):
    one, two, three = ("one two three four five six", "a b c d e f g", "k l m n o p q")
    rows = [(3, one), (5, one), (5, two), (9, two), (9, three), (11, three), (12, "something else for itself alone")]
    got = minmax.near_duplicates(made_up(spark, []).union(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {(r.doc_id, r.component_id, r.kept) for r in got.collect()} == {
        (3, 3, True), (5, 3, False), (9, 3, False), (11, 3, False), (12, 12, True)}


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 450), (7, 7)]
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(table, "a", "b").collect()}
    assert got == {i: 0 for i in range(201)} | {k: 400 for k in (400, 450, 500)}


# lines -----------------------------------------------------------------------------------------

def word_distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_lines_match_brute_force(spark):
    rng = random.Random(11)
    lines = [[rng.choice("abcd") + str(rng.randrange(3)) for _ in range(rng.randint(3, 9))] for _ in range(60)]
    for _ in range(120):
        w = list(rng.choice(lines))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(w))
            rng.choice([lambda: w.insert(at, "new"), lambda: w.pop(at) if len(w) > 1 else 0,
                        lambda: w.__setitem__(at, "sub")])()
        lines.append(w)
    rng.shuffle(lines)
    texts = ["\n".join("  ".join(w) for w in lines[i : i + 6]) for i in range(0, len(lines), 6)]
    seen, want = [], {}
    for d, text in enumerate(texts):
        for n, line in enumerate(text.split("\n")):
            w = line.split()
            earlier = [p for p, other in seen if len(w) >= 5 and word_distance_one(w, other)]
            want[d, n] = min([*earlier, (d, n)])
            if len(w) >= 5:
                seen.append(((d, n), w))
    got = {
        (r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no)
        for r in line_dedup.line_verdicts(made_up(spark, texts)).collect()
    }
    assert got == want and sum(k != v for k, v in want.items()) > 50


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row[0] = row[0], i + 1
        for k, y in enumerate(b):
            before, row[k + 1] = row[k + 1], min(before + (x != y), row[k + 1] + 1, row[k] + 1)
    return row[-1]


def test_long_lines_with_several_edits(spark):
    """Edits up to and beyond the bound, chains of edited copies, and a passage that unlike lines share."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(20)]
    lines = [[f"w{rng.randrange(400)}" for _ in range(n)] for n in (30, 31, 32, 33, 50, 50, 64, 130) for _ in range(2)]
    lines += [passage + [f"w{rng.randrange(400)}" for _ in range(40)] for _ in range(5)]
    for _ in range(60):
        w = list(rng.choice(lines))
        for _ in range(rng.randint(1, 5)):
            at = rng.randrange(len(w))
            rng.choice([lambda: w.insert(at, "new"), lambda: w.pop(at), lambda: w.__setitem__(at, "sub")])()
        lines.append(w)
    texts = [" ".join(w) for w in lines]
    want = {}
    for d, a in enumerate(lines):
        near = (e for e in range(d) if word_distance(a, lines[e]) <= max(1, min(len(a), len(lines[e])) // 16))
        want[d] = min(near, default=d)
    got = {r.doc_id: r.first_doc_id for r in line_dedup.line_verdicts(made_up(spark, texts)).collect()}
    assert got == want
    assert sum(word_distance(lines[d], lines[e]) > 1 for d, e in want.items()) > 15


def test_words_are_sent_for_alike_pairs_only(spark, monkeypatch):
    rng = random.Random(11)
    lines = []
    for _ in range(20):  # lines share a passage, and one of three is within the bound of the one before
        a = [f"w{rng.randrange(5000)}" for _ in range(40)]
        a[10:16] = ["all", "of", "them", "say", "this", "often"]
        near, far = a.copy(), [f"v{rng.randrange(5000)}" for _ in range(40)]
        near[rng.randrange(40)] = "sub"
        far[20:26] = a[10:16]
        lines += [a, near, far]
    looked_at = {}
    kept_copy = line_dedup.stored_copy

    def noted(df, label):
        looked_at[label] = looked_at.get(label, 0) + (made := kept_copy(df, label)).count()
        return made

    monkeypatch.setattr(line_dedup, "stored_copy", noted)
    got = line_dedup.line_verdicts(made_up(spark, [" ".join(w) for w in lines])).collect()
    assert {r.doc_id for r in got if not r.kept} == {d for d in range(60) if d % 3 == 1}
    assert 20 <= looked_at["line-dedup-pairs"] < 60 < looked_at["line-dedup-grams"]


def test_lines_of_one_phrase_make_no_pairs(spark, monkeypatch):
    """Lines that share a phrase and little else are paired in no step after the join that compares them."""
    rng = random.Random(5)
    phrase = [f"p{i}" for i in range(12)]
    lines = [phrase + [f"w{rng.randrange(100000)}" for _ in range(28)] for _ in range(60)]
    lines.append([*lines[40][:-1], "sub"])
    compared, alike = [], line_dedup._alike

    def noted(partners, *rest):
        compared.append(partners.count())
        return alike(partners, *rest)

    monkeypatch.setattr(line_dedup, "_alike", noted)
    got = line_dedup.line_verdicts(made_up(spark, [" ".join(w) for w in lines])).collect()
    assert {r.doc_id: r.first_doc_id for r in got if not r.kept} == {60: 40}
    assert len(compared) == 2 and max(compared) <= len(lines)


def test_frequent_keys_are_dealt_out_without_changing_verdicts(spark, documents, monkeypatch):
    want = {tuple(r) for r in line_dedup.line_verdicts(documents).collect()}
    monkeypatch.setattr(line_dedup, "_SAMPLE", 1)
    monkeypatch.setattr(line_dedup, "_HOT_ROWS", 2)
    monkeypatch.setattr(line_dedup, "_HOT_SHARE", 0.0)
    assert {tuple(r) for r in line_dedup.line_verdicts(documents).collect()} == want
    keyed = line_dedup.meeting_keys(documents).distinct()
    often = keyed.groupBy("key").count().where("count > 1").select("key")
    shared = line_dedup.shared_keys(documents)
    assert not often.isEmpty() and shared.exceptAll(keyed.join(often, "key")).isEmpty()
    assert shared.count() == keyed.join(often, "key").count()


def test_exact_copies_of_short_lines_go(spark):
    texts = ["Les.\none two three four\n\n東京都", "Les.\n\n東京都\n  one  two three four", "one two three five\n \nLes"]
    got = [r.text for r in line_dedup.dedup_lines(made_up(spark, texts)).orderBy("doc_id").collect()]
    assert got == [texts[0], "", texts[2]]


def test_lines_are_cut_from_their_own_row(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e\nx"), (2, "only in this row\ny"), (None, "a b c d e\nz"), (None, "kept here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 9, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [(1, "a b c d e"), (2, "only in this row\ny"), (2, "x"), (9, "kept here"), (9, "z")]


# mixing ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("goal", [{"max_repeats": 3.0}, {"max_repeats": None, "target_entropy": 1.0}])
def test_mixture_meets_its_goal(spark, goal):
    sizes = {"a": 200, "b": 40, "c": 10}
    rows = [(i * 3 + k, s, "x y z") for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), **goal).collect()
    per = collections.Counter(r.source for r in got)
    assert per["a"] == 200 and {r.doc_id for r in got} == {r[0] for r in rows}
    for s, n in sizes.items():  # whole blocks hold everything once, the last one each row once at most
        blocks = collections.Counter(r.block for r in got if r.source == s)
        assert all(blocks[b] == n for b in range(1, max(blocks))) and blocks[max(blocks)] <= n
    if goal.get("target_entropy"):
        total = sum(per.values())
        entropy = -sum(v / total * math.log(v / total) for v in per.values())
        assert abs(entropy - 1.0) < 0.02
    else:
        assert abs(per["c"] - 30) <= 1 and 40 < per["b"] < 120


# language model --------------------------------------------------------------------------------

def test_elias_fano_finds_every_value():
    rng = np.random.default_rng(7)
    for values in (np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)),
                   np.arange(1000, dtype=np.uint64), np.sort(rng.integers(0, 40, 500)).astype(np.uint64),
                   np.array([0], dtype=np.uint64), np.empty(0, dtype=np.uint64)):
        ef = elias_fano.EliasFano.from_arrays(
            elias_fano.mapped(elias_fano.dump(elias_fano.EliasFano.of(values).arrays()))
        )
        assert (ef.get(np.arange(len(values))) == values).all()
        if len(values):
            asked = np.concatenate([values, values + np.uint64(1)])
            assert (ef.successor(asked) == np.searchsorted(values, asked)).all()
            assert ((ef.find(asked) >= 0) == np.isin(asked, values)).all()


def test_elias_fano_searches_ranges_and_long_runs():
    """Ranges as a pointer gives them; runs of equal values that are longer than 64 high bits."""
    rng = np.random.default_rng(8)
    for values in (np.sort(rng.integers(0, 10_000, 5000)), np.sort(rng.integers(0, 2**61, 4000)),
                   np.repeat(rng.integers(0, 5, 9).cumsum(), 150)):
        values = values.astype(np.uint64)
        ef, n = elias_fano.EliasFano.of(values), len(values)
        at = rng.integers(0, n - 1, 800)
        here, behind = ef.span(at)
        assert (here == values[at]).all() and (behind == values[at + 1]).all()
        lo = rng.integers(0, n, 800)
        hi = np.minimum(n, lo + rng.integers(0, 200, 800))
        asked = values[np.minimum(lo + rng.integers(0, 250, 800), n - 1)]
        want = np.array([a + np.searchsorted(values[a:b], v) for a, b, v in zip(lo, hi, asked, strict=True)])
        assert (ef.successor(asked, lo, hi) == want).all()
        there = np.array([w < b and values[w] == v for w, b, v in zip(want, hi, asked, strict=True)])
        assert (ef.find(asked, lo, hi) == np.where(there, want, -1)).all()


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_brute_force(spark, documents, texts, order):
    tokens = lambda t: [*t.encode().lower().split(), 1]
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    train = [tokens(t) for d, t in texts.items() if not held(d)]
    one = collections.Counter(itertools.chain(*train))
    n, v = sum(one.values()), len(one)
    grams, heads, weights = collections.Counter(), collections.Counter(), [1.0, 4.0][: order - 1]
    for t in train:
        padded = [None] * (order - 1) + t
        for i in range(order - 1, len(padded)):
            for k in range(1, order):
                grams[tuple(padded[i - k : i + 1])] += 1
                heads[tuple(padded[i - k : i])] += 1
    model = ngram_trie.fit(documents.where(ngram_trie.fold(documents.doc_id) != 0), order=order)
    assert (model.n_tokens, model.n_types) == (n, v)
    got = {r.doc_id: r for r in ngram_trie.score(documents, model).collect()}
    for d, text in texts.items():
        t = tokens(text)
        padded, score = [None] * (order - 1) + t, 0.0
        for i in range(order - 1, len(padded)):
            p0 = (one[padded[i]] + 0.1) / (n + 0.1 * (v + 1))
            top = sum(w * grams[tuple(padded[i - k : i + 1])] for k, w in enumerate(weights, 1))
            low = sum(w * heads[tuple(padded[i - k : i])] for k, w in enumerate(weights, 1))
            score += math.log10((top + model.mu * p0) / (low + model.mu) if order > 1 else p0)
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert got[d].n_tokens == len(t) and got[d].n_known == sum(one[w] > 0 for w in t)
        assert math.isclose(got[d].base_score, base, abs_tol=1e-6)
        assert abs(got[d].score - score) < 2e-4 * len(t) + 1e-9


def test_frequent_words_are_spread_without_changing_scores(spark, documents):
    model = ngram_trie.fit(documents)
    the = int(minmax.WordHashes()[b"the"]) | 4
    split = ngram_trie.Routing(5, {int(ngram_trie.END): 3, the: 5})
    plain = {r.doc_id: r.score for r in ngram_trie.score(documents, model).collect()}
    original = ngram_trie._routing
    ngram_trie._routing = lambda docs: split
    try:
        other = ngram_trie.fit(documents)
    finally:
        ngram_trie._routing = original
    assert (other.n_tokens, other.n_types) == (model.n_tokens, model.n_types)
    assert set(other.hot) == set(split.fan)
    for r in ngram_trie.score(documents, other).collect():
        assert math.isclose(plain[r.doc_id], r.score, rel_tol=1e-9, abs_tol=1e-6)


def test_levels_hold_the_smoothed_probabilities(spark):
    """The stored shards answer by themselves: numerators and denominators of every n-gram."""
    docs = spark.createDataFrame([(1, "a b a b"), (2, "A b c"), (3, None)], "doc_id long, text string")
    model = ngram_trie.fit(docs)
    text = [["a", "b", "a", "b", 1], ["a", "b", "c", 1], [1]]
    one = collections.Counter(itertools.chain(*text))
    grams = collections.Counter(
        tuple(reversed(([0, 0, *t])[i : i + k]))
        for t in text for k in (2, 3) for i in range(3 - k, len(t) + 3 - k)
    )
    n, v, heads, scores = sum(one.values()), len(one), 0, []
    for r in model.shards.collect():
        trie = ngram_trie.Trie.mapped(bytes(r.levels))
        assert trie.order == 3 and len(trie.pointers) == len(trie.keys) == len(trie.scores) == 2
        heads += len(trie.heads[0][0])
        for pair in trie.scores:
            scores += list(trie.at(pair, np.arange(len(pair[0]))))
    want = []
    for gram, count in grams.items():
        p0 = model.mu * (one[gram[0]] + 0.1) / (n + 0.1 * (v + 1))
        want.append(math.log10(p0 + grams[gram[:2]] + (4 * count if len(gram) == 3 else 0)))
    assert heads == sum(len(g) == 2 for g in grams) and len(scores) == len(want)
    assert np.abs(np.sort(scores) - np.sort(want)).max() <= 0.5 / 8192 + 1e-9


def test_the_query_scores_trigrams(spark, documents):
    """The registered query's scores are those of order 3, longer contexts included."""
    got = {r.doc_id: r.score for r in catalog.op5_ngram_trie(spark, SF).collect()}
    model = ngram_trie.fit(documents.where(ngram_trie.fold(documents.doc_id) != 0), order=3)
    want = {r.doc_id: r.score for r in ngram_trie.score(documents, model).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[d], want[d], abs_tol=1e-6) for d in want)


class Told:
    """Stands for a broadcast value."""

    def __init__(self, value):
        self.value = value


def test_grams_sent_do_not_grow_with_the_shards():
    """Frequent context words go to a shard by rank, without their hashes."""
    import pyarrow as pa

    rng = random.Random(5)
    text = [" ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(1000)) for _ in range(60)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(text)], names=["doc_id", "text"])
    _, _, hashes = ngram_trie._tokens(pa.chunked_array([rows.column(1)]))
    hashes = np.sort(hashes)
    ranks = Told(ngram_trie.Ranks(hashes, np.arange(len(hashes), dtype=np.int32)))
    for per_document in (False, True):
        few, many = (
            sum(len(b.column(2)[0].as_py()) for b in ngram_trie._events(3, ngram_trie.Routing(n), ranks, per_document)(iter([rows])))
            for n in (2, 32)
        )
        assert many < 1.5 * few


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_tokens_are_words_between_ascii_white_space(monkeypatch, size):
    import pyarrow as pa
    import xxhash

    monkeypatch.setattr(ngram_trie, "BATCH_BYTES", size)
    texts = ["A b  a\tb\x0b", " ", "", None, "x", "\u00c0B \u00e0b \u00c9", "a " * 50, "\x1ca\x85b  c\r\nd"]
    rows = [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], names=["text"]) for t in (texts, [], texts[:3])]
    got = []
    for part in ngram_trie._parts(iter(rows)):
        tokens, lengths, hashes = ngram_trie._tokens(part.column(0))
        columns = [hashes[c] for c in ngram_trie._grams(tokens, lengths, 3)]
        got += [np.stack([c[e - n : e] for c in columns]).T.tolist() for n, e in zip(lengths, np.cumsum(lengths), strict=True)]
    want = []
    for t in texts + texts[:3]:
        made = [2, 2, *[xxhash.xxh64_intdigest(w) | 4 for w in (t or "").encode().lower().split()], 1]
        want.append([made[i : i + 3][::-1] for i in range(len(made) - 2)])
    assert got == want


@pytest.mark.parametrize("ranked", [0, 3, 200])
def test_ranked_words_change_no_score(spark, documents, monkeypatch, ranked):
    docs = documents.limit(40)
    plain = ngram_trie.fit(docs)
    want = {r.doc_id: r for r in ngram_trie.score(documents, plain).collect()}
    monkeypatch.setattr(ngram_trie, "RANKED", ranked)
    model = ngram_trie.fit(docs)
    assert len(model.ranks.value) <= ranked < len(plain.ranks.value)
    for r in ngram_trie.score(documents, model).collect():
        assert (r.n_tokens, r.n_known) == want[r.doc_id][1:3]
        assert math.isclose(r.score, want[r.doc_id].score, abs_tol=1e-6)


def test_the_model_is_not_shuffled_to_be_asked(spark, documents):
    model = ngram_trie.fit(documents)
    plan = ngram_trie.score(documents, model)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and plan.count("Exchange hashpartitioning(shard") == 1


# toxicity --------------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    rng = random.Random(2)
    clean = ["".join(rng.choices("aeioulmnrst", k=rng.randint(3, 8))) for _ in range(3000)]
    bad = ["grumpf", "blorkest", "skizzle"]
    rows, labels = [], []
    for d in range(1500):
        toxic = rng.random() < 0.15
        words = rng.choices(clean, k=rng.randint(20, 200))
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((d, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((d, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    truth = {d: any(w in t.split() for w in bad) for d, t in rows}
    held = [d for d in got if got[d].held_out]
    assert len(held) > 200 and all(zlib.crc32(str(d).encode()) % 5 == 0 for d in held)
    assert sum(got[d].predicted == truth[d] for d in held) / len(held) > 0.97
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {d for d in got if not got[d].predicted}


def test_negative_risk_is_not_fitted_further():
    rows = [np.array([0]) for _ in range(20)] + [np.array([i % 2]) for i in range(200)]
    positive = np.array([True] * 20 + [False] * 200)
    w, bias = toxicity.nnpu_fit(rows, positive, 2, prior=0.5)
    assert bias + w[0] > 0 > bias + w[1]


# pages -----------------------------------------------------------------------------------------

def page(body, extra=""):
    return f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><p>x";</script></head>
    <body><header class="top"><h1>Site name</h1><nav><ul><li><a href=/>Home</a></li></ul></nav></header>
    <div id="cookie-notice"><p>We use cookies and more cookies on this long notice.</p></div>
    {body}
    <aside class="sidebar"><p>Popular posts and other long side matters here.</p></aside>{extra}
    <section id="comments"><p>A reader has written a very long comment, longer than all else. {"bla " * 80}</p></section>
    <form><p>Sign up</p><input></form><footer><p>&copy; somebody</p></footer></body></html>"""


def test_articles_in_several_layouts(spark):
    article = "<h1>A &amp; B</h1><p>First   para&shy;graph\n of &lt;text&gt; <b>bold</b>.<p>Second<br>one.<ul><li>x<li>y</ul>"
    want = "A & B\nFirst para­graph of <text> bold.\nSecond one.\nx\ny"
    layouts = [
        f"<article>{article}</article>",
        f"<main><article class='post-17'><header>{article}</header></article></main>".replace("<header>", "<header>", 1),
        f"<div class='wrap'><div class='content'>{article}</div></div>",
        f"<table><tr><td class=body>{article}</td></tr></table>",
    ]
    rows = [(10 * k + n, f"https://h{k}.example/{n}", page(x)) for k, x in enumerate(layouts) for n in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html_extract.extract(pages).collect():
        assert r.text == want and r.n_chars == len(want) and r.by_consensus


def test_wrappers_do_not_hide_the_article():
    article = "<h1>Title</h1><p>A first paragraph of the article, long enough to count.</p><p>A second one.</p>"
    want = "Title\nA first paragraph of the article, long enough to count.\nA second one."
    for outer in ("<div class='overflow-hidden'>", "<div class='has-sidebar'>", "<div id='page' class='with-side-nav'>",
                  "<form id=aspnetForm>", "<div class=sidebar-left><div class='nav-open form-page'>", "<div class=comments-open>"):
        for inner in ("<article>", "<main>", "<div class=entry>"):
            if "comments" in outer and "div" in inner:
                continue
            end = f"</{inner[1:].split()[0].rstrip('>')}>"
            tail = "</form>" if "<form" in outer else "</div>" * outer.count("<div")
            body = f"{outer}<div class=sidebar><p>Popular things</p></div>{inner}{article}{end}{tail}"
            for source in (f"<body>{body}</body>", page(body)):
                assert html_extract.Page(source).text(None)[0] == want, (outer, inner)
    hidden = "<p>Shown.<span class=hidden> not</span><b class=overflow-hidden> too</b></p><div style='display:none'><article>x</article></div>"
    assert html_extract.Page(f"<body>{hidden}</body>").text(None)[0] == "Shown. too"


def test_pages_of_comments_alone_have_no_text():
    for source in ("<div class=comments><p>All there is.</div>", "<div id=comment-list><h2>Comments</h2><p>A b.</div>",
                   "<body><section class='user-comments'><div class=item><p>A long opinion.</div></section></body>"):
        assert html_extract.Page(source).text(None)[0] == ""
    assert html_extract.Page("<div class=comments-open><p>All there is.</div>").text(None)[0] == "All there is."


def test_articles_split_over_containers(spark):
    intro, rest = "An intro that says in a few words what follows. " * 4, "Much more text makes up the body. " * 18
    split = f"<div class=post><h1>Title</h1><div class=intro>{intro}</div><div class=body>{rest}</div></div>"
    direct = f"<h1>Title</h1><div class=intro>{intro}</div><div class=body>{rest}</div>"
    want = "\n".join(["Title", intro.strip(), rest.strip()])
    links = "<div class=x>" + "<a href=/>Another long title of a post</a> " * 9 + "</div>"
    layouts = [f"<body><div>My Blog</div>{split}{links}</body>", f"<body>{direct}</body>",
               f"<body><div class=page><div class=name>My Blog</div>{split}<div class=end>Made by us</div></div></body>"]
    rows = [(10 * k + n, f"https://s{k}.example/{n}", x) for k, x in enumerate(layouts) for n in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html_extract.extract(pages).collect()} == {want}


def test_deep_pages_are_read_in_linear_time():
    import time

    n = 30_000
    for source in ("<div>x" * n, "<b>x<li>" * n, "<i>" * n + "<p>x" * n, "<div>" * n + "<li>x</p>" * n):
        start = time.process_time()
        read = html_extract.Page(source)
        read.votes()
        assert read.text(None)[0] and time.process_time() - start < 20


def test_pages_of_the_table(spark):
    import html
    import re

    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in catalog.op1_html_extraction(spark, SF).collect()}
    assert set(got) == set(raw)
    for key, source in raw.items():
        inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert got[key] == "\n".join(x for x in lines if x)


# pipeline --------------------------------------------------------------------------------------

def test_pipeline_stages(spark, documents):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "minhash near-dedup", "mixing", "packing"]
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF).cache()
        assert made.columns == documents.columns, name
        before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in (docs, made))
        assert after <= before and (name not in ("line dedup", "mixing") or after == before)
        if name == "minhash near-dedup":
            roots = brute_components({r.doc_id: r.text for r in docs.collect()}, 80, 100)
            assert after == {d for d, (_, root) in roots.items() if d == root}
        docs = made
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == after
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
