"""Hostile rows: every operator gives its defined result for them."""

import pytest
from pyspark.sql import functions as F

from gatefold.llm import (
    chat,
    host_rules,
    html_extract,
    line_dedup,
    minmax,
    mixing,
    ngram_trie,
    packing,
    sketch,
    toxicity,
)

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
DOCS = "doc_id long, text string, source string, key string, block string, n int"


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, a very long one, repeated rows, a null id, clashing extra columns."""
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "   \n \t", None), (4, LONG, "a"), (5, LONG, "b"),
        (6, "one two three", "b"), (6, "one two three", "b"), (None, "no id at all here", "a"),
    ]
    return spark.createDataFrame([(i, t, s, "k", "x", 1) for i, t, s in rows], DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def test_packing(odd, none):
    got = packing.pack(odd, path("word_bpe_49k.json")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert r.length == 1 << r.bucket and len(r.tokens) == 4 * r.length and r.offset == 0
    assert [len(by[k]) for k in (1, 2, 3)] == [1, 1, 1] and by[1][0].doc_tokens == 1
    assert len(by[6]) == 2 * len({r.start for r in by[6]}) and None in by
    assert sum(r.length for r in by[4]) == by[4][0].doc_tokens > 60_000
    assert len({r.sequence_id for r in got}) == len(got)
    assert packing.pack(none, path("word_bpe_49k.json")).count() == 0


def test_sketch(odd, none):
    got = {(r.doc_id, r.text): r for r in sketch.edited_fingerprints(odd).collect()}
    assert got[1, ""].sketch == [] and got[1, ""].near_next == 1.0 == got[2, ""].near_edited
    assert got[3, "   \n \t"].n_chars == 6 and got[4, LONG].near_next == 1.0
    assert got[4, LONG].sketch == got[5, LONG].sketch and len(got[4, LONG].sketch) <= sketch.K
    assert got[6, "one two three"].edited == "one two th" and got[None, "no id at all here"].near_next == 0
    assert sketch.edited_fingerprints(odd).count() == 8
    assert sketch.edited_fingerprints(none).count() == 0


def test_host_rules(odd, none):
    got = host_rules.judge(odd).collect()
    assert len(got) == 8 and all(r.base_failed for r in got if r.doc_id in (1, 2, 3, 6))
    long = [r for r in got if r.doc_id == 4][0]
    assert long.n_words == 30_000 and long.n_repeat_words == 30_000 and not long.kept
    assert {r.host for r in got} == {"a", "b", None} and all(r.host_failed is not None for r in got)
    assert host_rules.judge(none).count() == 0


def test_near_duplicates(odd, none):
    got = [tuple(r) for r in minmax.near_duplicates(odd).orderBy("doc_id").collect()]
    assert got == [
        (None, 1, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True),
        (4, got[4][1], 4, True), (5, got[4][1], 4, False), (6, 1, 6, True), (6, 1, 6, True),
    ]
    assert minmax.near_duplicates(none).count() == 0


def test_lines(odd, none):
    got = line_dedup.line_verdicts(odd).collect()
    assert {(r.doc_id, r.kept) for r in got if r.n_words == 30_000} == {(4, True), (5, False)}
    assert all(r.kept for r in got if r.doc_id != 5)
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(odd).collect()}
    assert texts[1] is None and texts[4] == LONG and texts[5] == "" and texts[6] == "one two three"
    assert line_dedup.dedup_lines(odd).columns == odd.columns and line_dedup.dedup_lines(odd).count() == 8
    assert line_dedup.line_verdicts(none).count() == 0 and line_dedup.dedup_lines(none).count() == 0


def test_mixing(odd, none):
    got = mixing.mix(odd).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6, None}
    assert len([r for r in got if r.doc_id == 6]) % 2 == 0  # rows with one id stay together
    assert mixing.mix(none).count() == 0


def test_columns_with_names_of_the_operators_own(odd):
    own = ["_id", "_row", "_dropped", "of", "row", "gone", "place", "_key", "_whole", "_last", "whole", "last", "rank"]
    wide = odd.select("*", *[F.lit(k).alias(c) for k, c in enumerate(own)])
    cut = line_dedup.dedup_lines(wide)
    assert cut.columns == wide.columns and cut.count() == 8
    blocks = mixing.mix(wide)
    assert set(blocks.columns) == {*wide.columns, "block_rank"}
    assert blocks.count() == mixing.mix(odd).count()
    assert {tuple(r) for r in blocks.select(*own).collect()} == {tuple(range(len(own)))}


def test_trie(odd, none):
    model = ngram_trie.fit(odd)
    got = {r.doc_id: r for r in ngram_trie.score(odd, model).collect()}
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 1 and got[4].n_tokens == 30_001
    assert ngram_trie.score(odd, model).count() == 8 and all(r.n_known == r.n_tokens for r in got.values())
    assert ngram_trie.score(none, model).count() == 0
    empty = ngram_trie.fit(none)
    assert {r.base_score for r in ngram_trie.score(odd, empty).where("n_tokens = 1").collect()} == {0.0}


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, None), (None, 1), (99, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [None]
    assert toxicity.score(none, toxicity.fit(none, labels.limit(0))).count() == 0
    assert toxicity.without_toxic(odd, model).columns == odd.columns


def test_pages(spark):
    schema = "page_id long, url string, html string, host string, text string"
    rows = [(1, None, None), (2, "http://a/x", ""), (3, "not a url", "<p>plain"), (3, "not a url", "<p>plain"),
            (None, "http://a/y", "<div>" * 20_000 + "deep"), (5, "http://b/", "<p>a" * 20_000)]
    pages = spark.createDataFrame([(*r, "h", "t") for r in rows], schema)
    got = [(r.page_id, r.text, r.n_chars) for r in html_extract.extract(pages).collect()]
    assert sorted(got, key=repr)[:2] == [(1, "", 0), (2, "", 0)]
    assert got.count((3, "plain", 5)) == 2 and (None, "deep", 4) in got
    assert (5, "\n".join(["a"] * 20_000), 39_999) in got
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_chat(spark):
    coder = path("byte_bpe_50k.tiktoken")
    schema = "conv_id long, turn long, role string, text string, input_ids string"
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", "first"), (2, 0, "a b[END]", "y"),
            (2, 0, "a b[END]", "y"), (None, 0, "assistant", "z" * 50_000)]
    table = spark.createDataFrame([(*r, "e") for r in rows], schema)
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(table, coder), coder).collect()}
    assert (got[1].n_turns, got[2].n_turns, got[None].n_turns) == (3, 2, 1)
    assert (got[1].loss_chars, got[2].loss_chars, got[None].loss_chars) == (5, 0, 50_000)
    assert chat.conversation_digests(chat.format_turns(table.limit(0), coder), coder).count() == 0
