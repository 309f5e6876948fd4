"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

One hash evaluation per permutation gives two signature values, the smallest and the largest.
Bands of signature values propose candidates, a bit sketch of the signature discards hopeless
ones, and every remaining link is confirmed on the whole shingle sets. Texts with equal sets are
one node throughout, and a band bucket links its members to one hub instead of to each other;
only members that stay in different components after that are compared among themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import picked, stored_copy
from .components import connected_components

WIDTH = 5
PERMUTATIONS = 216
BAND_ROWS = 6
BANDS = 48
SKETCH_BITS = 256
# A pair is confirmed unless its sketches differ in so many places that a pair at the border would
# do so with a probability of about one in a million: this many standard deviations above the mean.
SURE = 5.0
HUB_ROUNDS = 2
_WORD_CACHE = 400_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SIGNED = (
    "doc_id long, n_shingles long, set_hi long, set_lo long, "
    "bits_0 long, bits_1 long, bits_2 long, bits_3 long, bands array<long>, places array<long>"
)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; remembers up to a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes, known: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a lower-cased text."""
    words = text.lower().split()  # bytes: only A-Z is lowered, only ASCII white space cuts
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - width + 1)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(min(width, len(words))):
        s = s * _M1 + h[k : k + n]
    return np.unique(_mix(s + np.uint64(min(width, len(words)))))


class Signer:
    """Min-max signatures under fixed permutations x -> a x + b modulo 2**64 with odd a."""

    def __init__(self, permutations: int = PERMUTATIONS, band_rows: int = BAND_ROWS):
        random = np.random.default_rng(20240601)
        draw = random.integers(0, 2**63, size=(2, permutations), dtype=np.uint64)
        self.a, self.b = draw[0] * np.uint64(2) + np.uint64(1), draw[1]
        self.band_rows = band_rows
        self.powers = random.integers(0, 2**63, size=band_rows, dtype=np.uint64) | np.uint64(1)

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=np.uint64)
        high = np.zeros(len(self.a), dtype=np.uint64)
        for at in range(0, len(shingles), 2048):
            image = shingles[at : at + 2048, None] * self.a + self.b
            low, high = np.minimum(low, image.min(axis=0)), np.maximum(high, image.max(axis=0))
        return np.stack([low, high], axis=1).ravel()

    def bands(self, signature: np.ndarray) -> np.ndarray:
        rows = signature[: BANDS * self.band_rows].reshape(-1, self.band_rows)
        keys = (rows * self.powers).sum(axis=1, dtype=np.uint64)
        return _mix(keys + np.arange(len(rows), dtype=np.uint64) * _M1).view(np.int64)

    def bits(self, signature: np.ndarray) -> np.ndarray:
        one = (_mix(signature[:SKETCH_BITS]) >> np.uint64(63)).astype(np.uint8)
        return np.packbits(one).view(np.int64)

    def places(self, signature: np.ndarray) -> np.ndarray:
        """One byte per signature value, eight to a number."""
        return (_mix(signature) >> np.uint64(56)).astype(np.uint8).view(np.int64)


def signatures(
    docs: DataFrame,
    width: int = WIDTH,
    permutations: int = PERMUTATIONS,
    band_rows: int = BAND_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Set size, 128-bit set identity, bit sketch and band keys per row (no bands if no words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known, signer = WordHashes(), Signer(permutations, band_rows)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            sizes = np.zeros(len(texts), dtype=np.int64)
            fixed = np.zeros((len(texts), 6), dtype=np.int64)
            bands, places = [], []
            for i in range(len(texts)):
                shingles = shingle_set(texts[i].as_py() or b"", known, width)
                sizes[i] = len(shingles)
                if not len(shingles):
                    bands.append([])
                    places.append([])
                    continue
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                signature = signer.sign(shingles)
                fixed[i, :2] = np.frombuffer(digest, dtype=np.int64)
                fixed[i, 2:] = signer.bits(signature)
                bands.append(signer.bands(signature))
                places.append(signer.places(signature))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes), *[pa.array(fixed[:, k]) for k in range(6)],
                    pa.array(bands, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64())),
                ],
                names=[part.split()[0] for part in SIGNED.split(", ")],
            )

    return picked(docs, doc_id=doc_id, text=text).mapInArrow(sign, SIGNED)


def _most(places: int, differs: float) -> int:
    """Places in which two sketches of a pair at the border may differ."""
    return math.ceil(places * differs + SURE * math.sqrt(places * differs * (1 - differs)))


def _alike(numerator: int, denominator: int, permutations: int, once: Column | None = None) -> Column:
    """Can the pair (columns a_*, b_*) reach the likeness, by set sizes and sketches?

    Cheap tests come first: sizes, then one bit per signature value, then one byte per value.
    ``once`` is tested before the bytes.
    """
    small = F.least("a_n", "b_n")
    large = F.greatest("a_n", "b_n")
    unlike = 1 - numerator / denominator
    bits = sum(
        (F.bit_count(F.col(f"a_bits_{k}").bitwiseXOR(F.col(f"b_bits_{k}"))) for k in range(4)), F.lit(0)
    )

    def bytes_differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for shift in (4, 2, 1):  # the lowest bit of a byte becomes the or of all its bits
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

    values = F.aggregate(
        F.zip_with("a_places", "b_places", bytes_differ), F.lit(0), lambda n, x: n + x
    )
    test = (denominator * small >= numerator * large) & (bits <= _most(SKETCH_BITS, unlike / 2))
    if once is not None:
        test = test & once
    return test & (values <= _most(2 * permutations, unlike * 255 / 256))


def _side(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{side}_{c}") for c in nodes.columns])


def confirmed(
    pairs: DataFrame,
    docs: DataFrame,
    numerator: int,
    denominator: int,
    width: int = WIDTH,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are alike enough.

    Texts are joined to the pairs; the side with the many partners is joined last, so its rows
    come one after the other and its set is made once per run of equal ids.
    """
    texts = picked(docs, doc_id=doc_id, text=text)
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "a_text", "b_text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, mine = WordHashes(), None, None
        for batch in batches:
            kept = []
            lefts, rights = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            for i in range(batch.num_rows):
                a_text = lefts[i].as_py() or b""
                if a_text != last:
                    last, mine = a_text, shingle_set(a_text, known, width)
                other = shingle_set(rights[i].as_py() or b"", known, width)
                common = len(np.intersect1d(mine, other, assume_unique=True))
                union = len(mine) + len(other) - common
                if union and denominator * common >= numerator * union:
                    kept.append(i)
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(kept)), batch.column(1).take(pa.array(kept))],
                    names=["a", "b"],
                )

    return both.mapInArrow(check, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    numerator: int = 80,
    denominator: int = 100,
    width: int = WIDTH,
    permutations: int = PERMUTATIONS,
    band_rows: int = BAND_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    Two documents are linked if ``denominator * |intersection| >= numerator * |union|`` of their
    distinct shingles (5 words, A-Z lowered; a shorter text is one shingle). ``component_id`` is the
    smallest id reachable over links, ``kept`` marks that document. Null, empty and blank texts have no
    shingles and link to nothing. Rows with the same id are one document
    with the links of all its texts. A row without id is its
    own: null component, kept. Other input columns are ignored. Ties do not arise: ids order
    everything.
    """
    signed = stored_copy(
        signatures(docs, width, permutations, band_rows, doc_id, text), "minmax-signatures"
    )
    linkable = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    sets = linkable.groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("rep"))
    nodes = stored_copy(
        linkable.join(sets, ["set_hi", "set_lo"]).where(F.col("doc_id") == F.col("rep")).select(
            F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"),
            *[f"bits_{k}" for k in range(4)], "bands", "places",
        ).dropDuplicates(["id", "n", *[f"bits_{k}" for k in range(4)]]),
        "minmax-nodes",
    )
    small = nodes.drop("bands")
    # an id with several sets is one document: their representatives are linked
    of_id = linkable.join(sets, ["set_hi", "set_lo"]).select("doc_id", "rep")
    several = of_id.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("a < top")
    same_id = (
        of_id.join(several, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    )
    keyed = nodes.select("id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    members = stored_copy(
        keyed.join(shared.select("key"), "key").select("key", "id"), "minmax-buckets"
    )

    def confirm(pairs: DataFrame) -> DataFrame:
        likely = (
            pairs.join(_side(small, "b"), F.col("b") == F.col("b_id"))
            .join(_side(small, "a"), F.col("a") == F.col("a_id"))
            .where(_alike(numerator, denominator, permutations))
            .select("a", "b")
            .distinct()
        )
        return confirmed(likely, docs, numerator, denominator, width, doc_id, text)

    def apart(labels: DataFrame) -> DataFrame:
        """Members of buckets that still span several components, with their component."""
        named = members.join(labels, members.id == labels.node, "left").select(
            "key", "id", F.coalesce("component", "id").alias("component")
        )
        split = named.groupBy("key").agg(
            F.min("component").alias("c_lo"), F.max("component").alias("c_hi")
        ).where("c_lo < c_hi")
        return stored_copy(named.join(split.select("key"), "key"), "minmax-apart")

    # Hubs: each bucket's smallest id, then a pseudo-random member of what is still apart.
    hubs = members.groupBy("key").agg(F.min("id").alias("a"))
    first = members.join(hubs, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    links = stored_copy(confirm(first).unionByName(same_id), "minmax-links")
    labels = connected_components(links, "a", "b")
    for turn in range(1, HUB_ROUNDS):
        left = apart(labels)
        if left.isEmpty():
            break
        order = F.struct(F.xxhash64(F.lit(turn), "id").alias("h"), F.col("id"), F.col("component"))
        hubs = left.groupBy("key").agg(F.min(order).alias("hub"))
        more = (
            left.join(hubs, "key")
            .where(F.col("component") != F.col("hub.component"))
            .select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
            .distinct()
        )
        links = stored_copy(links.unionByName(confirm(more)), "minmax-links")
        labels = connected_components(links, "a", "b")
    left = apart(labels)
    if not left.isEmpty():
        # What is left: every pair of one bucket in two components that sketches do not rule out,
        # taken from the first bucket that the two share.
        sided = left.join(nodes, "id")
        one, two = _side(sided, "a"), _side(sided, "b")
        first_shared = F.array_min(F.array_intersect("a_bands", "b_bands")) == F.col("a_key")
        rest = one.join(
            two,
            (F.col("a_key") == F.col("b_key"))
            & (F.col("a_component") < F.col("b_component"))
            & _alike(numerator, denominator, permutations, first_shared),
        ).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()
        links = stored_copy(
            links.unionByName(confirmed(rest, docs, numerator, denominator, width, doc_id, text)),
            "minmax-links",
        )
        labels = connected_components(links, "a", "b")
    named = sets.join(labels, F.col("rep") == F.col("node"), "left").select(
        F.col("set_hi").alias("of_hi"), F.col("set_lo").alias("of_lo"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    placed = signed.select("doc_id", "n_shingles", "set_hi", "set_lo").join(
        named,
        (F.col("set_hi") == F.col("of_hi")) & (F.col("set_lo") == F.col("of_lo"))
        & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(),
        "left",
    )
    return placed.select(
        "doc_id", "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
