"""Prefix trie, structure repair and prefix-wise BPE against brute force."""

import hashlib
import random
import zlib

import pytest

from gatefold.llm import bpe, prefix_trie
from gatefold.llm import structure_repair as repair

TURNS = "conv_id long, turn long, role string, text string, key string, depth int, chunk int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def made_turns(seed, n_convs, texts, longest=7):
    """Conversations with copies, ties, nulls, missing bases and a negative id."""
    rng = random.Random(seed)
    rows = []
    for conv in [*rng.sample(range(3 * n_convs), n_convs), -7]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "system", "usher", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, rng.choice(texts)))
    # Rows that share a turn number are equal here: their order is this library's own.
    seen = {}
    return [(c, t, *seen.setdefault((c, t), (r, x))) for c, t, r, x in rows]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 1) for r in rows], TURNS).repartition(3)


def in_order(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role, text))
    return {c: sorted(v, key=lambda r: r[:2]) for c, v in out.items()}


def brute_trie(rows):
    own = {c: [(r or "", x or "") for _, _, r, x in v] for c, v in in_order(rows).items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        rebuilt[c] = (*own.get(base, [])[:h], *turns[h:])
    nodes = {}
    for c, run in rebuilt.items():
        for d in range(len(run) + 1):
            nodes.setdefault(run[:d], []).append(c)
    out = set()
    for run, members in nodes.items():
        below = [r for r in nodes if r[: len(run)] == run]
        leaves = [r for r in below if not any(len(s) == len(r) + 1 and s[:-1] == r for s in below)]
        saved = sum((len(nodes[r]) - 1) * len(r[-1][1].encode()) for r in below if r)
        ends = ",".join(map(str, sorted(c for c in members if rebuilt[c] == run)))
        parent = min(nodes[run[:-1]]) if run else None
        children = sum(len(r) == len(run) + 1 for r in below)
        out.add((min(members), len(run), parent, len(members), children, len(leaves), saved, sha(ends)))
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("seed, texts", [(1, ["a", "b", None, "", "é"]), (2, ["x"])])
def test_trie_is_the_brute_force_trie(spark, seed, texts):
    rows = made_turns(seed, 40, texts)
    got = prefix_trie.trie(frame(spark, rows)).collect()
    found = [tuple(r[c] for c in NODE) for r in got]
    assert len(found) == len(set(found)) and set(found) == brute_trie(rows)


def test_trie_of_hostile_rows(spark):
    long = "word " * 40_000
    rows = [(5, 1, "user", long)] * 3 + [(6, 1, "user", long), (None, 1, "user", "x"), (15, None, None, None)]
    got = prefix_trie.trie(frame(spark, rows)).collect()
    assert {tuple(r[c] for c in NODE) for r in got} == brute_trie([r for r in rows if r[0] is not None])
    assert prefix_trie.trie(frame(spark, rows).limit(0)).count() == 0


def test_trie_of_a_conversation_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_BLOCK", 4)
    rows = [(c, t, "user", f"t{t % 3}") for c in (10, 11, 12, 14) for t in range(30)]
    got = prefix_trie.trie(frame(spark, rows)).collect()
    assert {tuple(r[c] for c in NODE) for r in got} == brute_trie(rows)


def test_trie_reseeds_when_hashes_collide(spark, monkeypatch):
    """Fingerprints of one value only: every node is unsound until the seed changes."""
    real, seeds = prefix_trie._hashed, []

    def weak(conversations, names, seed):
        seeds.append(seed)
        made = real(conversations, names, seed)
        from pyspark.sql import functions as F

        return made.withColumns({"x1": F.lit(1).cast("long"), "x2": F.lit(1).cast("long")}) if seed == 0 else made

    monkeypatch.setattr(prefix_trie, "_hashed", weak)
    rows = made_turns(3, 10, ["a", "b"])
    got = prefix_trie.trie(frame(spark, rows)).collect()
    assert seeds == [0, 1] and {tuple(r[c] for c in NODE) for r in got} == brute_trie(rows)


def damaged(rows):
    out = {}
    for conv, turns in in_order(rows).items():
        kept = out.setdefault(conv, [])
        for seen, turn, role, text in turns:
            turn = turn if seen else None
            ident = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            code = zlib.crc32(ident.encode()) % 20
            role, text = (" " if v is None else v for v in (role, text))
            text = {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(code, text)
            role = "user" if code == 4 else role
            kept += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def cheapest(turns):
    """(price, audit, repaired rows) over all edit sequences, by recursion on (turn, state)."""
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    known = {}

    def best(i, state, inserts):
        if (i, state, inserts) in known:
            return known[i, state, inserts]
        ways = []

        def way(price, letter, row, i, state, inserts=0):
            rest = best(i, state, inserts)
            if rest:
                ways.append((price + rest[0], letter + rest[1], row + rest[2]))

        if i == len(turns) and state in (0, 3):
            ways.append((0, "", ()))
        if inserts < 3:
            for letter, to in moves[state].items():
                if letter != "s":
                    way(2, "I", ({"u": "user:", "a": "assistant:"}[letter],), i, to, inserts + 1)
        if i < len(turns):
            role, text, must, cut = turns[i]
            way(3, "D", (), i + 1, state)
            if not must:
                for letter, to in moves[state].items():
                    if role[:1] == letter:
                        way(cut, "K", (f"{role}:{text}",), i + 1, to)
                    if letter != "s":
                        way(2 + cut, "R", ({"u": "user:", "a": "assistant:"}[letter] + text,), i + 1, to)
        known[i, state, inserts] = min(ways, default=None)
        return known[i, state, inserts]

    return best(0, 0, 0)


def brute_repair(rows):
    out = set()
    for conv, turns in damaged(rows).items():
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        faults, judged, seen = {"b": 0, "d": 0, "t": 0}, [], set()
        for _, role, text in turns:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not shown else "d" if (role, text) in seen else "" if shown[-1] in ".!?" else "t"
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            judged.append((role, text, fault in ("b", "d") and bool(fault), int(fault == "t")))
        roles = [r[0][:1] for r in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        price, audit, repaired = cheapest(judged)
        out.add((conv, gaps, *faults.values(), illegal, price, audit, sha("\n".join(repaired))))
    return out


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(spark, rows):
    given = frame(spark, rows)
    return {tuple(r[c] for c in REPORT) for r in repair.repair_report(given, repair.damage(given)).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_is_the_cheapest_and_least(spark, seed):
    texts = ["Yes.", "No!", "cut", "", " \n", None, "a.b", "x?", "Ω…", "Yes. "]
    rows = made_turns(seed, 150, texts, longest=12)
    assert report(spark, rows) == brute_repair(rows)


def test_repair_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 5)
    rows = made_turns(5, 12, ["Yes.", "No!", "cut", "", "So.", "If.", "Or?"], longest=40)
    assert report(spark, rows) == brute_repair(rows)


def test_repair_of_hostile_rows(spark):
    long = "word " * 40_000 + "."
    rows = [(None, 1, "user", long), (None, 2, "assistant", long), (3, None, None, None), (9, 4, "s", "x.")]
    # The only row of this conversation is dropped.
    gone = next(c for c in range(100, 999) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((gone, 1, "user", "Gone."))
    found = report(spark, rows)
    assert found == brute_repair(rows) and (gone, 0, 0, 0, 0, 0, 0, "", sha("")) in found
    given = frame(spark, rows).limit(0)
    assert repair.repair_report(given, repair.damage(given)).count() == 0


def test_repaired_turns_are_legal(spark):
    import re

    given = frame(spark, made_turns(7, 60, ["Yes.", "cut", "", "No!"], longest=9))
    found = {}
    for r in repair.repaired_turns(repair.damage(given)).orderBy("conv_id", "seq").collect():
        found[r.conv_id] = found.get(r.conv_id, "") + r.role[0]
    assert found and all(re.fullmatch("(s?(ua)+)?", roles) for roles in found.values())


def test_block_tables_equal_single_steps():
    rng, t = random.Random(4), repair.tables()
    for _ in range(200):
        letters = "".join(rng.choice("ABCDEFGHIJKLMNOP") for _ in range(rng.randint(0, 30)))
        vector, price = 0, 0
        for letter in reversed(letters):
            vector, more = t.single[vector][letter]
            price += more
        assert repair.ends_of_blocks(letters, 0)[1:] == (vector, price)


@pytest.fixture(scope="module")
def word_bpe():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_the_library(word_bpe):
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(word_bpe), bpe.Encoder(bpe.vocabulary(word_bpe))
    rng = random.Random(11)
    odd = ["<|endoftext|>", "<|", "A", "Σ", "İ", "é", "\x85", "\x1c", "ß", "²", "Ⅷ", " ", "😀", "'S", "'ll", "\x00"]
    texts = ["", " \n", "ab" * 5000, "a" * 9999, "﻿x", "’s it's IT'S"]
    for k in range(4000):
        pick = (
            lambda: rng.choice("aabbcdeefghiiiklmnnoorsstt'  .,!0")
        ) if k % 3 else (lambda: rng.choice(odd)) if k % 2 else (lambda: chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x20000)])))
        texts.append("".join(pick() for _ in range(rng.choice([3, 9, 40]))))
    ids = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 500):
        made = list(encoder.texts([t.encode() for t in texts[at : at + 500]]))
        for text, (data, shown), want in zip(texts[at : at + 500], made, ids[at : at + 500], strict=True):
            assert memoryview(data).cast("i").tolist() == want, text
            assert shown == library.decode(want, skip_special_tokens=False)


def test_rows_of_the_encoder(spark, word_bpe):
    rows = [(1, None), (2, ""), (3, "Hello, world"), (3, "Hello, world"), (None, "x " * 50_000)]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, n_tokens int, ids string")
    made = bpe.encode(docs, word_bpe)
    got = {(r.doc_id, r.n_tokens): r for r in made.collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 3), (None, 50_000)} and got[1, 0].decoded == "" and got[1, 0].ids == []
    assert got[3, 3].decoded == "hello</w> ,</w> world</w>" and made.count() == 5
    again = bpe.decode(made.withColumnRenamed("decoded", "first"), word_bpe)
    assert again.where("decoded <> first").count() == 0
    assert bpe.encode(docs.limit(0), word_bpe).count() == 0
