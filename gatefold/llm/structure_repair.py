"""Repair of conversation structure with Four-Russians block tables.

A conversation is legal when its role initials read ``(s?(ua)+)?``. Keeping, reroling, deleting and
inserting turns has a price, and the cheapest edits are a shortest path over four states. The prices
from every state to the end, less the least of them, form one of a few vectors, so the step back
over any block of symbols is a table entry: the vector before it and the price in between. A
conversation is priced from its end by one look-up per block; then each block is expanded backward
and its edits are traced forward, always the ASCII-least that is still cheapest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import prefix_sums
from .common import chunks, partitions_of, picked, stored_copy

BLOCK = 4  # symbols per table entry
CHUNK = 4096  # turns per row of the symbol table

# Prices of the edits; an undeleted truncated turn adds one.
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
ACCEPTED = (0, 3)
KEEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
# The role that may be put in at each state, and the state after it.
OFFERS = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
WRITTEN = {"u": "user", "a": "assistant"}
ROLES = "suao"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL_PAIRS = {"su", "ua", "au"}
_FAR = 10**6

KEY = ["none", "conv"]
WHITE = " \t\n\x0b\x0c\r"


def symbol(role: str, fault: int) -> str:
    """The letter of a turn: its role's initial and its fault."""
    return chr(ord("A") + 4 * ROLES.index(role) + fault)


def read_symbol(letter: str) -> tuple[str, int]:
    role, fault = divmod(ord(letter) - ord("A"), 4)
    return ROLES[role], fault


def step_back(after: tuple[int, ...], role: str, fault: int) -> list[int]:
    """Prices to the end from each state before a turn, given those behind it."""
    prices = []
    for state in range(4):
        best = DELETE + after[state]
        if fault not in (BLANK, DUPLICATE):
            extra = CUT_OFF if fault == TRUNCATED else 0
            if state in KEEPS[role]:
                best = min(best, extra + after[KEEPS[role][state]])
            best = min(best, RENAME + extra + after[OFFERS[state][1]])
        prices.append(best)
    return with_inserts(prices)


def with_inserts(prices: list[int]) -> list[int]:
    for _ in range(2):
        prices = [min(p, INSERT + prices[OFFERS[s][1]]) for s, p in enumerate(prices)]
    return prices


class Tables:
    """Vectors of normalised prices, and the step back over one symbol and over a block."""

    def __init__(self):
        letters = [symbol(r, f) for r, f in product(ROLES, range(4))]
        end = with_inserts([0 if s in ACCEPTED else _FAR for s in range(4)])
        self.vectors = [tuple(p - min(end) for p in end)]
        self.end_price = min(end)
        number = {self.vectors[0]: 0}
        self.single: list[dict[str, tuple[int, int]]] = []
        while len(self.single) < len(self.vectors):
            steps = {}
            for letter in letters:
                prices = step_back(self.vectors[len(self.single)], *read_symbol(letter))
                vector = tuple(p - min(prices) for p in prices)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                steps[letter] = number[vector], min(prices)
            self.single.append(steps)
        # Blocks differ only by what their symbols do, so equal steps share one letter.
        alike: dict[tuple, str] = {}
        self.plain = str.maketrans({
            x: alike.setdefault(tuple(steps[x] for steps in self.single), x) for x in letters
        })
        level = [{"": (v, 0)} for v in range(len(self.vectors))]
        for _ in range(BLOCK):
            level = [
                {
                    x + block: (self.single[v][x][0], price + self.single[v][x][1])
                    for block, (v, price) in blocks.items()
                    for x in alike.values()
                }
                for blocks in level
            ]
        self.blocks = level


@lru_cache(maxsize=1)
def tables() -> Tables:
    """The tables of this process."""
    return Tables()


def ends_of_blocks(symbols: str, vector: int) -> tuple[list[int], int, int]:
    """Vector behind each block, the vector before the first one and the price in between."""
    t = tables()
    plain, price, behind = symbols.translate(t.plain), 0, []
    whole = len(plain) - len(plain) % BLOCK
    if whole < len(plain):
        behind.append(vector)
        for letter in reversed(plain[whole:]):
            vector, more = t.single[vector][letter]
            price += more
    for at in range(whole - BLOCK, -1, -BLOCK):
        behind.append(vector)
        vector, more = t.blocks[vector][plain[at : at + BLOCK]]
        price += more
    return behind[::-1], vector, price


def trace(symbols: str, vector: int, state: int) -> tuple[list[str], int]:
    """The edits of a run of turns, given the vector behind it and the state before it.

    Per turn the roles put in before it (``u``, ``a``) and what becomes of it: ``K`` kept, ``D`` deleted,
    ``U`` or ``A`` renamed.
    """
    t = tables()
    behind, _, _ = ends_of_blocks(symbols, vector)
    edits = []
    for k, after in enumerate(behind):
        block = symbols[k * BLOCK : (k + 1) * BLOCK]
        inside = [after]
        for letter in reversed(block):
            inside.append(t.single[inside[-1]][letter][0])
        inside.reverse()
        for letter, before, later in zip(block, inside, inside[1:], strict=False):
            edit, state = _edit(letter, t.vectors[before], t.vectors[later], t.single[later][letter][1], state)
            edits.append(edit)
    return edits, state


def _edit(letter: str, before: tuple, later: tuple, more: int, state: int) -> tuple[str, int]:
    role, fault = read_symbol(letter)
    extra = CUT_OFF if fault == TRUNCATED else 0
    put_in = ""
    while True:
        price = before[state] + more
        offer, following = OFFERS[state]
        if DELETE + later[state] == price:
            return put_in + "D", state
        if INSERT + before[following] + more == price:
            put_in, state = put_in + offer, following
        elif state in KEEPS[role] and extra + later[KEEPS[role][state]] == price:
            return put_in + "K", KEEPS[role][state]
        else:
            return put_in + offer.upper(), following


def last_inserts(state: int) -> str:
    """Roles put in after the last turn."""
    out = ""
    while state not in ACCEPTED:
        offer, state = OFFERS[state]
        out += offer
    return out


# Letters of the audit by the letters of an edit.
AUDIT = str.maketrans({"u": "I", "a": "I", "U": "R", "A": "R"})


def damage(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Damaged rows by ``crc32(conv_id:turn) % 20``: 0 drops, 1 empties the text, 2 removes its
    sentence ends, 3 repeats the row, 4 sets the role to user. Nulls are one space each; the
    conversation of a null id has ``none`` true and ``conv`` 0. Other columns are left behind."""
    rows = picked(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    ident, at, r, t = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    code = F.crc32(F.concat(ident, F.lit(":"), at).cast("binary")) % 20
    bare = F.translate("_text", ".!?", "")
    return (
        rows.select(*keys_of(F.col("conv_id")), "turn", r.alias("_role"), t.alias("_text"), code.alias("_code"))
        .where("_code <> 0")
        .select(
            *KEY, "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("_role")).alias("role"),
            F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, bare).otherwise(F.col("_text")).alias("text"),
            F.when(F.col("_code") == 3, 2).otherwise(1).alias("copies"),
        )
    )


def keys_of(conv_id: Column) -> list[Column]:
    return [conv_id.isNull().alias("none"), F.coalesce(conv_id, F.lit(0)).cast("long").alias("conv")]


def _symbols(rows: DataFrame) -> DataFrame:
    """Turns with their hashes and what they show by themselves; the texts stay behind."""
    initial = F.substring("role", 1, 1)
    shown = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    alone = F.when(shown == "", BLANK).when(~shown.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    return rows.select(
        *KEY, "turn", *_hashes(), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        alone.alias("alone"), "copies",
    )


def _hashes() -> list[Column]:
    return [
        F.xxhash64(F.lit(1), "role", "text").alias("x1"), F.xxhash64(F.lit(2), "text", "role").alias("x2")
    ]


def symbol_chunks(rows: DataFrame) -> DataFrame:
    """One row per conversation and ``CHUNK`` turns: their symbols and the keys to find their texts.

    Rows need ``none, conv, turn, role, text, copies``. Turns are in order of ``turn``, nulls first, then
    of a hash of role and text. Positions come from sums over slices and duplicates from the least
    position of equal turns, so long conversations and often repeated turns spread over tasks.
    """
    one = F.lit(1).cast("long").alias("one")
    each = _symbols(rows).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    narrow = each.select(*KEY, "turn", "x1", "x2", "initial", "alone", one)
    placed = prefix_sums(narrow, KEY, ["turn", "x1", "x2"], ["one"]).withColumnRenamed("one_before", "pos")
    placed = stored_copy(placed.drop("one", "one_total"), "repair-turns")
    firsts = placed.groupBy(*KEY, "x1", "x2").agg(F.min("pos").alias("pos"))
    marked = placed.join(firsts.withColumn("fresh", F.lit(True)), [*KEY, "x1", "x2", "pos"], "left")
    fault = (
        F.when(F.col("alone") == BLANK, BLANK).when(F.col("fresh").isNull(), DUPLICATE).otherwise(F.col("alone"))
    )
    place = F.array_position(F.lit(list(ROLES)), F.col("initial")) - 1
    code = F.lit(ord("A")) + 4 * place + fault
    turns = marked.withColumn("symbol", F.char(code))
    packed = F.array_sort(F.collect_list(F.struct("pos", "symbol", "turn", "x1", "x2")))
    return (
        turns.groupBy(*KEY, F.floor(F.col("pos") / CHUNK).alias("chunk"))
        .agg(packed.alias("turns"))
        .withColumn("symbols", F.array_join(F.col("turns.symbol"), ""))
    )


def _batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


PRICED = pa.schema([
    ("none", pa.bool_()), ("conv", pa.int64()), ("chunk", pa.int64()), ("symbols", pa.string()),
    ("behind", pa.int32()), ("cost", pa.int64()),
])
TRACED = pa.schema([
    ("none", pa.bool_()), ("conv", pa.int64()), ("chunk", pa.int64()), ("edits", pa.list_(pa.string())),
    ("last", pa.string()), ("audit", pa.string()), ("cost", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
])
_SQL = {"bool": "boolean", "int64": "long", "int32": "int", "string": "string", "list<item: string>": "array<string>"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[str(f.type)]}" for f in schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def traced_chunks(packed: DataFrame) -> DataFrame:
    """Edits, audit and counts per chunk: prices go through a conversation's chunks from the last to
    the first, edits from the first to the last. A task holds one chunk at a time."""
    n = partitions_of(packed.sparkSession)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def priced():
            current, vector, cost = None, 0, 0
            for none, conv, chunk, symbols in _rows(batches):
                if current != (none, conv):
                    current, vector, cost = (none, conv), 0, tables().end_price
                behind = vector
                _, vector, more = ends_of_blocks(symbols, vector)
                cost += more
                yield none, conv, chunk, symbols, behind, cost + tables().vectors[vector][0]

        for part in chunks(priced(), lambda r: len(r[3])):
            yield _batch(part, PRICED)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def traced():
            current, state, role = None, 0, ""
            held = None
            for none, conv, chunk, symbols, behind, cost in _rows(batches):
                if current != (none, conv):
                    if held:
                        yield _closed(held, state)
                    current, state, role, held = (none, conv), 0, "", None
                if held:
                    yield held
                edits, state = trace(symbols, behind, state)
                seen = [read_symbol(x) for x in symbols]
                roles = [role, *(r for r, _ in seen)]
                pairs = [a + b for a, b in zip(roles, roles[1:], strict=False) if a]
                faults = [f for _, f in seen]
                role = roles[-1]
                held = (
                    none, conv, chunk, edits, "", "".join(edits).translate(AUDIT), cost if chunk == 0 else 0,
                    faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
                    sum(p not in LEGAL_PAIRS for p in pairs),
                )
            if held:
                yield _closed(held, state)

        for part in chunks(traced(), lambda r: 8 * len(r[3])):
            yield _batch(part, TRACED)

    dealt = packed.select(*KEY, "chunk", "symbols").repartition(n, *KEY)
    back = dealt.sortWithinPartitions(*KEY, F.col("chunk").desc()).mapInArrow(price, _ddl(PRICED))
    again = back.repartition(n, *KEY).sortWithinPartitions(*KEY, "chunk")
    return again.mapInArrow(follow, _ddl(TRACED))


def _closed(held: tuple, state: int) -> tuple:
    """The last chunk of a conversation with the roles put in behind it."""
    last = last_inserts(state)
    return *held[:4], last, held[5] + last.translate(AUDIT), *held[6:]


def _with_texts(rows: DataFrame, packed: DataFrame, traced: DataFrame) -> DataFrame:
    """Texts and edits of a conversation in one order, the text of a turn before its edits."""
    edited = packed.join(traced.select(*KEY, "chunk", "edits", "last"), [*KEY, "chunk"])
    each = edited.select(*KEY, F.explode(F.arrays_zip("turns", "edits")).alias("t")).select(
        *KEY, F.lit(0).alias("tail"), "t.turns.turn", "t.turns.x1", "t.turns.x2",
        (F.col("t.turns.pos") + 1).alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), F.col("t.edits").alias("edit"),
    )
    zero = F.lit(0).cast("long")
    tails = edited.where("last <> ''").select(
        *KEY, F.lit(1).alias("tail"), zero.alias("turn"), zero.alias("x1"), zero.alias("x2"), zero.alias("pos"),
        F.lit("").alias("role"), F.lit("").alias("text"), F.col("last").alias("edit"),
    )
    texts = rows.select(
        *KEY, F.lit(0).alias("tail"), "turn", *_hashes(), zero.alias("pos"), "role", "text", F.lit(None).cast("string").alias("edit")
    )
    n = partitions_of(rows.sparkSession)
    return texts.unionByName(each).unionByName(tails).repartition(n, *KEY).sortWithinPartitions(
        *KEY, "tail", "turn", "x1", "x2", "pos"
    ).select(*KEY, "role", "text", "edit")


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, int, str, str]]:
    """(none, conv, role, text) of the repaired turns in order."""
    role = text = ""
    for none, conv, own_role, own_text, edit in _rows(batches):
        if edit is None:
            role, text = own_role, own_text
            continue
        for letter in edit:
            if letter in WRITTEN:
                yield none, conv, WRITTEN[letter], ""
            elif letter == "K":
                yield none, conv, role, text
            elif letter != "D":
                yield none, conv, WRITTEN[letter.lower()], text


REPAIRED = pa.schema([("none", pa.bool_()), ("conv", pa.int64()), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string())])
DIGESTED = pa.schema([("none", pa.bool_()), ("conv", pa.int64()), ("repaired_sha256", pa.string())])


def _repaired(ordered: DataFrame) -> DataFrame:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbered():
            current, seq = None, 0
            for none, conv, role, text in _assembled(batches):
                current, seq = (none, conv), seq + 1 if current == (none, conv) else 0
                yield none, conv, seq, role, text

        for part in chunks(numbered(), lambda r: len(r[4])):
            yield _batch(part, REPAIRED)

    return ordered.mapInArrow(write, _ddl(REPAIRED))


def _digested(ordered: DataFrame) -> DataFrame:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests():
            current, digest = None, None
            for none, conv, role, text in _assembled(batches):
                if current == (none, conv):
                    digest.update(b"\n")
                else:
                    if current:
                        yield *current, digest.hexdigest()
                    current, digest = (none, conv), hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            if current:
                yield *current, digest.hexdigest()

        for part in chunks(digests(), lambda r: 80):
            yield _batch(part, DIGESTED)

    return ordered.mapInArrow(write, _ddl(DIGESTED))


def _conv_id(column: str = "conv") -> Column:
    return F.when(~F.col("none"), F.col(column)).alias("conv_id")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, seq, role, text`` of all repaired conversations; ``rows`` as :func:`damage` gives them."""
    packed = stored_copy(symbol_chunks(rows), "repair-chunks")
    traced = stored_copy(traced_chunks(packed), "repair-edits")
    return _repaired(_with_texts(rows, packed, traced)).select(_conv_id(), "seq", "role", "text")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of the input: faults of its damaged rows, price, audit and digest of
    its repair.

    A conversation without rows after damage has zeros, an empty audit and the digest of nothing. Turns
    of one number are ordered by a hash of role and text; equal ones are duplicates. Rows without id form
    one conversation with a null id. An empty table gives no rows. Long texts stream through the task
    that digests their conversation, one turn at a time.
    """
    packed = stored_copy(symbol_chunks(rows), "repair-chunks")
    traced = stored_copy(traced_chunks(packed), "repair-edits")
    parts = F.array_sort(F.collect_list(F.struct("chunk", "audit")))
    counted = ("blank", "duplicate", "truncated", "illegal", "cost")
    whole = traced.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in counted], F.array_join(parts["audit"], "").alias("audit")
    )
    spans = rows.groupBy(*KEY).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    digests = _digested(_with_texts(rows, packed, traced))
    every = conversations.select(*keys_of(F.col("conv_id"))).distinct()
    zero = F.lit(0).cast("long")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (
        every.join(spans, KEY, "left").join(whole, KEY, "left").join(digests, KEY, "left")
        .select(
            _conv_id(), *[F.coalesce(c, zero).alias(c) for c in ("gaps", *counted)],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
        )
    )
