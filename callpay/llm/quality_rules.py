"""Quality rules judged per host, DataFrame functions only.

Each document is measured against fixed rules. Failures are added up per host (``source``), and the host's
failure rate of each rule is shrunk towards the rate of all hosts by an empirical beta prior: mean and
spread of the rates over hosts give the prior's two counts (method of moments), so that a host
with few documents is judged by what is usual and a large one by its own record. A host whose
shrunk rate of any rule exceeds that rule's limit is rejected, and the verdict is joined
back to its documents. A document is kept if it passes the base rule and its host is not rejected.

Cases: NULL text has no words and fails the base rule, as an empty one does; a NULL host is a host of its
own; repeated rows count as often as they occur; a single host gets the prior of one document; an empty table
gives no rows. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import BLANKS, let, named, split_words, stored

MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
#: Largest shrunk failure rate of a host that is still kept, by rule.
LIMITS = {"short": 0.5, "repeats": 0.5, "symbols": 0.5, "dup_lines": 0.5}


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 8-word windows that occur twice or more: the union of the windows' spans.

    Windows are compared by 64-bit hashes within one text; where all differ, nothing is sorted.
    """

    def covered(hashes: Column) -> Column:
        tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            m = F.size(s)
            same = lambda e, j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["h"] == e["h"])) | (
                (j < m - 1) & (s[F.least(j + 1, m - 1)]["h"] == e["h"])
            )
            return F.sort_array(F.transform(F.filter(s, same), lambda e: e["i"]))

        def span(p: Column) -> Column:
            m = F.size(p)
            width = F.transform(p, lambda q, j: F.when(j < m - 1, F.least(F.lit(WINDOW), p[F.least(j + 1, m - 1)] - q)).otherwise(WINDOW))
            return F.aggregate(width, F.lit(0), lambda a, x: a + x)

        found = let(let(tagged, starts), span)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)])
    )
    return F.when(n >= WINDOW, let(windows, covered)).otherwise(0).cast("bigint")


def _measured(text: Column) -> Column:
    """All measures of a text as one struct, bound inside one expression.

    An optimiser that moves a filter below the measuring then copies one expression, not parts
    that would be evaluated again for every word.
    """
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)

    def counted(words: Column) -> Column:
        n = F.size(words)
        return let(
            _repeat_words(words, n),
            lambda repeats: F.struct(
                n.cast("bigint").alias("n_words"),
                F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
                let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
                repeats.alias("n_repeat_words"),
                ((n < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n)).alias("base_failed"),
            ),
        )

    return let(split_words(text), counted)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    rows = docs.withColumn("__m", _measured(F.coalesce("text", F.lit(""))))
    kept = [c for c in docs.columns if c not in MEASURES]
    return rows.select(*kept, *[F.col(f"__m.{m}").alias(m) for m in MEASURES])


def failures() -> dict[str, Column]:
    """Rule name to whether a measured document fails it."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * n,
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > 10 * n,
    }


def host_verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """Per host: documents, failures by rule, shrunk rates by rule, and whether it is kept.

    One row per host; the prior is fitted over these rows.
    """
    rules = failures()
    hosts = measured.groupBy(named(host).alias("__host")).agg(
        F.count("*").alias("docs"),
        *[F.sum(F.when(bad, 1).otherwise(0)).alias(f"bad_{rule}") for rule, bad in rules.items()],
    )
    hosts = stored(hosts, "hosts")
    moments = [
        f(F.col(f"bad_{rule}") / F.col("docs")).alias(f"{what}_{rule}")
        for rule in rules
        for what, f in (("mean", F.avg), ("spread", F.var_samp))
    ]
    prior = hosts.agg(F.struct(*moments).alias("p"))
    judged = hosts.withColumn("__p", prior.scalar())
    kept = F.lit(True)
    for rule in rules:
        mean, spread = F.col(f"__p.mean_{rule}"), F.col(f"__p.spread_{rule}")
        weight = F.when(spread > 0, F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0))).otherwise(F.lit(1.0))
        rate = (F.col(f"bad_{rule}") + mean * weight) / (F.col("docs") + weight)
        judged = judged.withColumn(f"rate_{rule}", rate)
        kept = kept & (F.col(f"rate_{rule}") <= LIMITS[rule])
    return judged.withColumn("host_kept", kept).drop("__p")


def judge(measured: DataFrame, hosts: DataFrame, host: str = "source", failed: str = "base_failed", out: str = "kept") -> DataFrame:
    """Measured documents plus ``out``: passes the base rule, host not rejected. ``hosts`` as :func:`host_verdicts` gives them."""
    verdict = hosts.select(F.col("__host").alias("__b_host"), F.col("host_kept").alias("__host_kept"))
    joined = measured.withColumn("__host", named(host)).join(
        verdict, F.col("__host").eqNullSafe(F.col("__b_host")), "left"
    )
    kept = ~F.col(failed) & F.coalesce("__host_kept", F.lit(True))
    return joined.withColumn(out, kept).drop("__host", "__b_host", "__host_kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """Documents that pass, with the columns they came with.

    Texts are measured twice, once for the host counts and once where rows are dropped, rather than
    shuffled or stored; the verdicts are stored, a few bytes per host, and joined by their size.
    """
    hosts = stored(host_verdicts(measures(docs.select("text", "source"))), "verdicts")
    texts = docs.withColumn("__bad", _measured(F.coalesce("text", F.lit("")))["base_failed"])
    return judge(texts, hosts, failed="__bad", out="__kept").where("__kept").select(*docs.columns)
