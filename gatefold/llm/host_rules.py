"""Quality rules judged per document and per host, in DataFrame expressions only.

Every document is measured once. Rule failures are summed by host, each host's failure rate is
shrunk towards the corpus with a beta prior fitted to the hosts themselves, and the verdict on
the host is joined back: a document goes if it fails a rule or if its host as a whole does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, picked, stored_copy, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 8
MAX_DUP_LINE_PERCENT = 50
# A host fails when the shrunk rate of one rule is above this share of its documents.
HOST_LIMIT = 0.5
# Prior strength (in documents) where the hosts' rates show no spread to fit one from.
FLAT_STRENGTH = 10.0
RULES = ("few_words", "repeats", "symbols", "dup_lines")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur at least twice among ``words``.

    Windows are hashed; only a text with a repeated hash is sorted, then neighbours with equal
    hashes give the start positions and the gaps between those the covered words.
    """

    def positions(hashes: Column) -> Column:
        tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(t: Column) -> Column:
            same = F.filter(
                t,
                lambda p, i: (p["h"] == F.get(t, i - 1)["h"])
                | F.coalesce(p["h"] == F.get(t, i + 1)["h"], F.lit(False)),
            )
            return F.array_sort(F.transform(same, lambda p: p["i"]))

        def covered(s: Column) -> Column:
            gaps = F.transform(
                s, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(s, i + 1) - x, F.lit(window)))
            )
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return bound(bound(tagged, starts), covered)

    def counted(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(1), F.size(w) - F.lit(window - 1)),
            lambda i: F.xxhash64(*[F.get(w, i + F.lit(k - 1)) for k in range(window)]),
        )
        several = bound(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), positions(h)).otherwise(0),
        )
        return F.when(F.size(w) > window, several).otherwise(0)

    return bound(words, counted)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document with its counts and one 0/1 column ``failed_<rule>`` per rule."""
    rows = picked(docs, doc_id=doc_id, host=host, text=text).select(
        "doc_id", "host", F.coalesce("text", F.lit("")).alias("text")
    )
    words = bound(
        words_of(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    lines = bound(
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    symbols = F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long")
    counted = rows.select(
        "doc_id", "host", words.alias("w"), lines.alias("l"), symbols.alias("n_symbols")
    ).select(
        "doc_id", "host", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines",
        "w.n_repeat_words",
    )
    return counted.withColumns(
        {
            "failed_few_words": (F.col("n_words") < MIN_WORDS).cast("int"),
            "failed_repeats": (
                100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
            ).cast("int"),
            "failed_symbols": (
                100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")
            ).cast("int"),
            "failed_dup_lines": (
                100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
            ).cast("int"),
        }
    )


def _beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """Prior failures and prior documents of a beta distribution with these moments."""
    mean, variance = mean or 0.0, variance or 0.0
    fits = 0 < variance < mean * (1 - mean)
    strength = mean * (1 - mean) / variance - 1 if fits else FLAT_STRENGTH
    return strength * mean, strength


def host_verdicts(measured: DataFrame) -> DataFrame:
    """``host, host_docs, host_rate_<rule>.., host_failed``: shrunk failure rates per host.

    The prior of a rule is a beta distribution with the mean and variance that the raw rates have
    over the hosts (method of moments), so a host with few documents is judged close to the
    corpus and one with many by its own record.
    """
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"),
        *[F.sum(f"failed_{r}").alias(f"fails_{r}") for r in RULES],
    )
    rate = {r: F.col(f"fails_{r}") / F.col("host_docs") for r in RULES}
    found = hosts.agg(
        *[F.avg(rate[r]).alias(f"mean_{r}") for r in RULES],
        *[F.var_pop(rate[r]).alias(f"var_{r}") for r in RULES],
    ).first()
    prior = {r: _beta_prior(found[f"mean_{r}"], found[f"var_{r}"]) for r in RULES}
    shrunk = {
        f"host_rate_{r}": (F.col(f"fails_{r}") + F.lit(prior[r][0])) / (F.col("host_docs") + F.lit(prior[r][1]))
        for r in RULES
    }
    judged = hosts.select("host", "host_docs", *[c.alias(n) for n, c in shrunk.items()])
    worst = F.greatest(*[F.col(n) for n in shrunk])
    return judged.withColumn("host_failed", worst > HOST_LIMIT)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Counts, rule failures, the host's verdict and ``kept`` for every document.

    ``base_failed`` is too few words or too many repeated ones; ``kept`` is false for it, for a
    failed symbol or line rule, and for every document of a failed host. Null text has no words;
    documents with a null host form one host; empty texts fail for too few words; repeated rows
    are judged alike and each counts for the host; other columns are ignored.
    """
    measured = stored_copy(measures(docs, doc_id, text, host), "host-rules")
    verdicts = host_verdicts(measured).withColumnRenamed("host", "judged_host")
    joined = measured.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host")), "left")
    base = (F.col("failed_few_words") + F.col("failed_repeats")) > 0
    failed = base | ((F.col("failed_symbols") + F.col("failed_dup_lines")) > 0)
    return joined.withColumn("base_failed", base).withColumn(
        "kept", ~failed & ~F.coalesce(F.col("host_failed"), F.lit(False))
    ).drop("judged_host")
