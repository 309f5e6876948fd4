"""Prefix trie of rebuilt conversations by composable fingerprints.

A run of turns has the fingerprint ``(n, sum of element_i * BASE^i)`` modulo two primes, and two runs
compose by shifting the second past the first. Prefix products of the stored conversations are
enough: a rebuilt conversation is the product of a head of its base and, divided out of its own
products, its own suffix, so no rebuilt text is ever made. Rows of a node carry a reference to the
stored turn that ends them; a node is accepted when all its rows name equal turns and parents,
which makes equality exact by induction over the depth. Where one fails, all is done again under
another seed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from ..operators.prefix import prefix_sums
from .common import chunks, partitions_of, picked, stored_copy

# Fixed values of the fingerprint: two primes below 2^31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1288490189, 916326983)

BASE_GROUP = 5
HEAD_TURNS = 9
_BLOCK = 4096
_POSITION_BITS = 40
_DIGEST_IDS = 65_536

ENDS = "depth long, fp long, first long, ids string"
DIGESTS = "depth long, fp long, ends_sha256 string"


def _power(k: int, exponent: Column) -> Column:
    """BASES[k] to a non-negative exponent, modulo its prime, by the bits of the exponent."""
    prime, factor = PRIMES[k], BASES[k]
    out = F.lit(1).cast("long")
    for bit in range(_POSITION_BITS):
        set_bit = F.shiftright(exponent, bit).bitwiseAND(F.lit(1)) == 1
        out = out * F.when(set_bit, F.lit(factor).cast("long")).otherwise(F.lit(1).cast("long")) % F.lit(prime)
        factor = factor * factor % prime
    return out


def _shift(k: int, steps: Column) -> Column:
    """BASES[k]^-steps for 0 <= steps < HEAD_TURNS."""
    inverse = pow(BASES[k], -1, PRIMES[k])
    table = [pow(inverse, j, PRIMES[k]) for j in range(HEAD_TURNS)]
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in table]), steps.cast("int") + 1)


def _joined(v1: Column, v2: Column) -> Column:
    return v1 * F.lit(1 << 31) + v2


def block_sums(df: DataFrame, by: str, position: str, measures: Sequence[str]) -> DataFrame:
    """``<m>_upto`` and ``<m>_total`` per measure: running sums by a dense integer position.

    Blocks of positions are summed on their own and carry the totals of earlier blocks, so a group
    of any size is spread over tasks; nothing is stored.
    """
    placed = df.withColumn("_block", F.floor(F.col(position) / F.lit(_BLOCK)))
    inside = Window.partitionBy(by, "_block").orderBy(position)
    summed = placed.withColumns({f"_in_{m}": F.sum(m).over(inside) for m in measures})
    group = Window.partitionBy(by)
    earlier = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(by, "_block")
        .agg(*[F.sum(m).alias(f"_part_{m}") for m in measures])
        .select(
            by, "_block",
            *[F.coalesce(F.sum(f"_part_{m}").over(earlier), F.lit(0)).alias(f"_carry_{m}") for m in measures],
            *[F.sum(f"_part_{m}").over(group).alias(f"{m}_total") for m in measures],
        )
    )
    out = summed.join(carried, [by, "_block"])
    return out.withColumns({f"{m}_upto": F.col(f"_in_{m}") + F.col(f"_carry_{m}") for m in measures}).drop(
        "_block", *[f"_{p}_{m}" for p in ("in", "carry") for m in measures]
    )


def _hashed(conversations: DataFrame, names: dict[str, str], seed: int) -> DataFrame:
    rows = picked(conversations, **names).where("conv_id IS NOT NULL")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.xxhash64(F.lit(2 * seed), role, text).alias("x1"),
        F.xxhash64(F.lit(2 * seed + 1), text, role).alias("x2"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def _turns_collide(hashed: DataFrame) -> bool:
    """Whether two different stored turns have the same pair of hashes."""
    texts = hashed.select("x1", "x2", "role", "text").distinct()
    return bool(texts.groupBy("x1", "x2").count().where("count > 1").limit(1).count())


def _products(hashed: DataFrame) -> DataFrame:
    """Every stored turn with its position from 1, its element and its prefix product."""
    narrow = hashed.select("conv_id", "turn", "role", "x1", "x2", "bytes", F.lit(1).cast("long").alias("one"))
    placed = prefix_sums(narrow, ["conv_id"], ["turn", "role", "x1", "x2"], ["one"])
    at = F.col("one_before") + 1
    elements = {
        f"e{k + 1}": F.pmod(F.col(f"x{k + 1}"), F.lit(PRIMES[k])) * _power(k, F.col("pos")) % F.lit(PRIMES[k])
        for k in (0, 1)
    }
    turns = placed.select("conv_id", at.alias("pos"), "x1", "x2", "bytes").withColumns(elements)
    summed = block_sums(turns, "conv_id", "pos", ["e1", "e2"])
    values = {f"v{k + 1}": F.pmod(F.col(f"e{k + 1}_upto"), F.lit(PRIMES[k])) for k in (0, 1)}
    return summed.withColumns(values).drop("e1_upto", "e2_upto", "e1_total", "e2_total")


def _plans(products: DataFrame) -> DataFrame:
    """Per conversation its base, the turns taken from it and what the composition needs."""
    known = products.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS
    plans = known.select(
        "conv_id", "n", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % BASE_GROUP).alias("base")
    )
    sizes = known.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    heads = products.where(F.col("pos") < HEAD_TURNS)
    at_head = heads.select(F.col("conv_id").alias("base"), F.col("pos").alias("hh"), F.col("v1").alias("hv1"), F.col("v2").alias("hv2"))
    at_own = heads.select("conv_id", F.col("pos").alias("h"), F.col("v1").alias("ov1"), F.col("v2").alias("ov2"))
    zero = F.lit(0).cast("long")
    return (
        plans.join(sizes, "base", "left")
        .withColumn("hh", F.least("h", F.coalesce("base_n", zero)))
        .join(at_head, ["base", "hh"], "left")
        .join(at_own, ["conv_id", "h"], "left")
        .fillna(0, ["hv1", "hv2", "ov1", "ov2"])
        .withColumn("size", F.col("hh") + F.greatest(F.col("n") - F.col("h"), zero))
        .drop("base_n")
    )


def _blocked(plans: DataFrame, size: str) -> DataFrame:
    """A plan row for every block of its conversation's positions."""
    last = F.floor(F.col(size) / F.lit(_BLOCK))
    return plans.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _members(products: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and depth: fingerprint, parent's fingerprint, turn reference."""
    heads = products.where(F.col("pos") < HEAD_TURNS).withColumnRenamed("conv_id", "base")
    own_plans = _blocked(plans, "n").select("conv_id", "_block", "h", "hh", "hv1", "hv2", "ov1", "ov2")
    from_base = plans.select("conv_id", "base", "hh").join(heads, "base").where("pos <= hh")
    rows = [
        from_base.select(
            "conv_id", F.col("pos").alias("depth"), "v1", "v2", "e1", "e2", "x1", "x2", "bytes",
            F.col("base").alias("turn_conv"), F.col("pos").alias("turn_pos"),
        )
    ]
    own = (
        products.withColumn("_block", F.floor(F.col("pos") / F.lit(_BLOCK)))
        .join(own_plans, ["conv_id", "_block"]).where("pos > h")
    )
    moved = {}
    for k in (0, 1):
        shift, prime = _shift(k, F.col("h") - F.col("hh")), F.lit(PRIMES[k])
        moved[f"m{k}"] = (
            F.col(f"hv{k + 1}")
            + F.pmod(F.col(f"v{k + 1}") - F.col(f"ov{k + 1}"), prime) * shift % prime
        ) % prime
        moved[f"s{k}"] = F.col(f"e{k + 1}") * shift % prime
    rows.append(
        own.withColumns(moved).select(
            "conv_id", (F.col("pos") - F.col("h") + F.col("hh")).alias("depth"),
            F.col("m0").alias("v1"), F.col("m1").alias("v2"), F.col("s0").alias("e1"), F.col("s1").alias("e2"),
            "x1", "x2", "bytes", F.col("conv_id").alias("turn_conv"), F.col("pos").alias("turn_pos"),
        )
    )
    before = [F.pmod(F.col(f"v{k + 1}") - F.col(f"e{k + 1}"), F.lit(PRIMES[k])) for k in (0, 1)]
    return rows[0].unionByName(rows[1]).select(
        "conv_id", "depth", _joined(F.col("v1"), F.col("v2")).alias("fp"), _joined(*before).alias("parent_fp"),
        "x1", "x2", "bytes", "turn_conv", "turn_pos",
    )


def _grouped(members: DataFrame) -> DataFrame:
    """Nodes below the root, and whether all rows of a node name one turn and one parent."""
    same = [F.min(c) == F.max(c) for c in ("x1", "x2", "parent_fp")]
    first = F.min(F.struct("conv_id", "turn_conv", "turn_pos"))
    return members.groupBy("depth", "fp").agg(
        F.count(F.lit(1)).alias("n_convs"), first.alias("first"), F.min("parent_fp").alias("parent_fp"),
        F.max("bytes").alias("bytes"), (same[0] & same[1] & same[2]).alias("sound"),
    ).select("depth", "fp", "parent_fp", "n_convs", "bytes", "first.*", "sound")


def _ends_digests(ends: DataFrame) -> DataFrame:
    """Digest of the sorted, comma-joined ids that end at each node.

    Ids are sorted over all tasks, joined to long strings where they lie, and only these strings meet
    in the task of a node, one after the other.
    """
    n = partitions_of(ends.sparkSession)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():
            key, ids = None, []
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in range(3))
                for depth, fp, conv in zip(*columns, strict=True):
                    if key != (depth, fp) or len(ids) >= _DIGEST_IDS:
                        if ids:
                            yield *key, ids[0], ",".join(map(str, ids))
                        key, ids = (depth, fp), []
                    ids.append(conv)
            if ids:
                yield *key, ids[0], ",".join(map(str, ids))

        for part in chunks(runs(), lambda r: len(r[3])):
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["depth", "fp", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes():
            key, digest = None, None
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in (0, 1, 3))
                for depth, fp, ids in zip(*columns, strict=True):
                    if key == (depth, fp):
                        digest.update(b"," + ids.encode())
                        continue
                    if key is not None:
                        yield *key, digest.hexdigest()
                    key, digest = (depth, fp), hashlib.sha256(ids.encode())
            if key is not None:
                yield *key, digest.hexdigest()

        for part in chunks(nodes(), lambda r: 80):
            types = [pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["depth", "fp", "ends_sha256"])

    ordered = ends.select("depth", "fp", "conv_id").repartitionByRange(n, "depth", "fp", "conv_id")
    joined = ordered.sortWithinPartitions("depth", "fp", "conv_id").mapInArrow(strings, ENDS)
    dealt = joined.repartition(n, "depth", "fp").sortWithinPartitions("depth", "fp", "first")
    return dealt.mapInArrow(digests, DIGESTS)


def trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` and the stored turn it ends with (``turn_conv``, ``turn_pos`` from 1).

    A conversation is rebuilt from the first ``crc32(id) % 9`` turns of conversation ``id - id % 5``
    (remainder with the sign of the id) and its own turns after as many. Null roles and texts are
    empty; null turns come first; rows that share a turn are ordered by role and a hash of the text;
    repeated rows are turns of their own; rows without conv_id belong to no conversation. An empty
    table has no node, not even a root. Other input columns are ignored. Long texts are hashed where
    they lie and moved once, to compare turns of equal hashes; long conversations are cut into blocks.
    """
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    seed = 0
    while True:
        hashed = _hashed(conversations, names, seed)
        if not _turns_collide(hashed):
            products = stored_copy(_products(hashed), "trie-products")
            plans = stored_copy(_plans(products), "trie-plans")
            members = stored_copy(_members(products, plans), "trie-members")
            nodes = stored_copy(_grouped(members), "trie-nodes")
            if not nodes.where("NOT sound").limit(1).count():
                break
        seed += 1
    return _measured(plans, members, nodes.drop("sound"))


def _measured(plans: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    root = plans.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("depth"), zero.alias("fp"), F.lit(None).cast("long").alias("parent_fp"), "n_convs",
        zero.alias("bytes"), "conv_id", F.lit(None).cast("long").alias("turn_conv"), F.lit(None).cast("long").alias("turn_pos"),
    )
    every = root.unionByName(nodes)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_fp").alias("fp")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    # What a node adds lies with its smallest member, who stays the smallest at every greater depth.
    full = every.join(children, ["depth", "fp"], "left").withColumns({
        "n_children": F.coalesce("n_children", zero),
        "saved": (F.col("n_convs") - 1) * F.col("bytes"),
    })
    full = full.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    summed = stored_copy(block_sums(full, "conv_id", "depth", ["saved", "leaf"]), "trie-summed")
    own = summed.select(
        "depth", "fp", "parent_fp", "conv_id", "n_convs", "n_children", "turn_conv", "turn_pos",
        (F.col("saved_total") - F.col("saved_upto") + F.col("saved")).alias("own_saved"),
        F.col("leaf_total").alias("own_leaves"),
    )
    # A conversation's whole sums count at the nodes above its own first.
    firsts = summed.groupBy("conv_id").agg(
        F.min("depth").alias("first_depth"), F.max("saved_total").alias("more_saved"), F.max("leaf_total").alias("more_leaves")
    ).where("first_depth > 0 AND (more_saved > 0 OR more_leaves > 0)")
    owners = _blocked(firsts.withColumn("last", F.col("first_depth") - 1), "last")
    above = (
        members.select("conv_id", "depth", "fp")
        .unionByName(plans.select("conv_id", zero.alias("depth"), zero.alias("fp")))
        .withColumn("_block", F.floor(F.col("depth") / F.lit(_BLOCK)))
        .join(owners, ["conv_id", "_block"]).where("depth < first_depth")
        .groupBy("depth", "fp").agg(F.sum("more_saved").alias("more_saved"), F.sum("more_leaves").alias("more_leaves"))
    )
    ends = members.select("conv_id", "depth", "fp").join(
        plans.select("conv_id", F.col("size").alias("depth")), ["conv_id", "depth"]
    ).unionByName(plans.where("size = 0").select("conv_id", zero.alias("depth"), zero.alias("fp")))
    parents = every.select(
        (F.col("depth") + 1).alias("depth"), F.col("fp").alias("parent_fp"), F.col("conv_id").alias("parent_conv_id")
    )
    with_parent = salted_join(own, parents, ["depth", "parent_fp"], spread=["fp"], how="left")
    return (
        with_parent.join(above, ["depth", "fp"], "left")
        .join(_ends_digests(ends), ["depth", "fp"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            (F.col("own_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
            (F.col("own_saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
            "turn_conv", "turn_pos",
        )
    )
