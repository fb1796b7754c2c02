"""Line dedup by a log-template tree.

Lines are parsed to a fixed depth: by their number of tokens, then by their leading tokens, where a token
with a digit counts as variable. Inside such a leaf, fields generalise by position: a token stays
constant where enough lines of the leaf have it at its place, otherwise the place is variable. A
line's template is its leaf with the variable places left open. Templates that recur in
``MIN_DOCS`` different texts or more, and of which enough places are constant, are boilerplate: their lines are dropped.
A line of ``LONG_TOKENS`` tokens or more that stands word for word, digits too, in ``LONG_DOCS`` different texts is
dropped as well: so long a wording recurs only where it was copied.

Only lines of leaves that recur are taken apart into tokens, once per distinct line; open places are
never constant, so a leaf of nothing but numbers is no boilerplate, with one wording or several. All steps are counts that are combined before they are
shuffled, so that a line that a third of all documents share is one row per task.

Cases: NULL and empty texts have no lines and stay as they are; lines of fewer than ``MIN_TOKENS`` tokens are
always kept; a line repeated within one document counts once; documents of one text count as one here,
whatever their ids; an empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import BLANK_RUN, BLANKS, let, stored

DEPTH = 3
MIN_TOKENS, MIN_DOCS = 4, 10
CONSTANT_PERCENT = 60
#: A line of so many tokens is no coincidence: word for word in so many different texts it is a repeated passage.
LONG_TOKENS, LONG_DOCS = 50, 2
OPEN = "<*>"


def spaced(line: Column) -> Column:
    """The line without outer blanks, each run of blanks as one space."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    uneven = reduce(or_, [trimmed.contains(run) for run in ("  ", *BLANKS[1:])])
    return F.when(uneven, F.regexp_replace(trimmed, BLANK_RUN, " ")).otherwise(trimmed)


def mask(plain: Column) -> Column:
    """Tokens with a digit become open places."""
    digits = F.regexp_replace(plain, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", OPEN)
    return F.when(plain.rlike("[0-9]"), digits).otherwise(plain)


def parsed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text code, line number, leaf, masked line, digest of a long line) of all lines that are long enough."""

    def parsed(plain: Column, masked: Column) -> Column:
        tokens = F.length(masked) - F.length(F.replace(masked, F.lit(" "))) + 1
        leaf = F.xxhash64(tokens, F.substring_index(masked, " ", DEPTH))
        exact = F.when(tokens >= LONG_TOKENS, F.md5(plain))
        return F.struct(masked.alias("masked"), tokens.alias("tokens"), leaf.alias("leaf"), exact.alias("exact"))

    lines = F.transform(
        F.split("text", "\n"), lambda line: let(spaced(line), lambda plain: let(mask(plain), lambda m: parsed(plain, m)))
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("code"), F.posexplode(lines).alias("at", "line"))
    long_enough = rows.where(F.col("line.tokens") >= MIN_TOKENS)
    return long_enough.select("doc_id", "code", "at", "line.masked", "line.leaf", "line.exact")


def repeated_passages(lines: DataFrame) -> DataFrame:
    """(exact) of long lines that stand word for word in ``LONG_DOCS`` different texts or more."""
    held = lines.where("exact is not null").select("exact", "code").distinct()
    return stored(held.groupBy("exact").count().where(f"count >= {LONG_DOCS}").select("exact"), "passages")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(lines without their texts, wordings that are dropped): columns doc_id, code, at, leaf, exact, wording; leaf, wording, template."""
    # texts are parsed once: masked lines are stored as a column that one later step reads, the others pass over it
    lines = stored(parsed_lines(docs).withColumn("wording", F.xxhash64("masked")), "lines")
    held = lines.select("leaf", "wording", "code").distinct()
    wordings = stored(held.groupBy("leaf", "wording").agg(F.count("*").alias("docs")), "wordings")
    leaves = wordings.groupBy("leaf").agg(F.sum("docs").alias("held")).where(f"held >= {min_docs}")
    leaves = stored(leaves.select(F.col("leaf").alias("h_leaf")), "leaves")

    texts = lines.join(leaves, F.col("leaf") == F.col("h_leaf"), "left_semi").select("leaf", "wording", "masked")
    # made distinct by hash first: a minimum of strings is sorted
    once = texts.distinct().groupBy("leaf", "wording").agg(F.min("masked").alias("masked"))
    counted = once.join(wordings.withColumnsRenamed({"leaf": "w_leaf", "wording": "w"}), (F.col("leaf") == F.col("w_leaf")) & (F.col("wording") == F.col("w")))
    tokens = stored(
        counted.select("leaf", "wording", "docs", F.posexplode(F.split("masked", " ")).alias("place", "token")).withColumn(
            "token", F.when(F.col("token") != OPEN, F.xxhash64("token"))
        ),
        "line-tokens",
    )
    fixed = tokens.where("token is not null").groupBy("leaf", "place", "token").agg(F.sum("docs").alias("n"))
    fixed = fixed.where(f"n >= {min_docs}").select(*[F.col(c).alias(f"f_{c}") for c in ("leaf", "place", "token")])
    same = (F.col("leaf") == F.col("f_leaf")) & (F.col("place") == F.col("f_place")) & (F.col("token") == F.col("f_token"))
    places = tokens.join(fixed, same, "left").groupBy("leaf", "wording").agg(
        F.first("docs").alias("docs"),
        F.count("*").alias("places"),
        F.count("f_token").alias("constant"),
        # an order-free code of the constant places is the template's name
        F.bit_xor(F.when(F.col("f_token").isNotNull(), F.xxhash64("f_place", "f_token"))).alias("named"),
    )
    named = places.where(f"100 * constant >= {CONSTANT_PERCENT} * places")
    general = named.select("leaf", "wording", F.xxhash64("leaf", "named", "constant").alias("template"), "docs")
    templates = stored(general, "templates")

    often = templates.select(F.col("leaf").alias("t_leaf"), F.col("wording").alias("t_wording"), "template")
    on = (F.col("leaf") == F.col("t_leaf")) & (F.col("wording") == F.col("t_wording"))
    spread = held.join(often, on).select("template", "code").distinct().groupBy("template").count()
    recurring = spread.where(f"count >= {min_docs}").select(F.col("template").alias("r"))
    dropped = templates.join(recurring, F.col("template") == F.col("r")).select("leaf", "wording", "template")
    return lines.drop("masked"), stored(dropped, "dropped")


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, plus n_lines, n_dropped and n_templates.

    ``n_templates`` counts templates and repeated long wordings that the dropped lines belong to.
    """
    lines, dropped = recurring_lines(docs.select("doc_id", "text"), min_docs)
    wanted = dropped.withColumnsRenamed({c: f"d_{c}" for c in dropped.columns})
    gone = lines.join(wanted, (F.col("leaf") == F.col("d_leaf")) & (F.col("wording") == F.col("d_wording")))
    passages = repeated_passages(lines).withColumnRenamed("exact", "d_exact")
    long = lines.where("exact is not null").join(passages, F.col("exact") == F.col("d_exact"))
    found = ["doc_id", "code", "at"]
    gone = gone.select(*found, "d_template").unionByName(long.select(*found, F.xxhash64("exact").alias("d_template")))
    per_doc = stored(
        gone.groupBy(F.col("doc_id").alias("__id"), F.col("code").alias("__code")).agg(
            F.collect_set("at").alias("__gone"), F.countDistinct("d_template").alias("__templates")
        ),
        "gone",
    )
    coded = docs.withColumn("__text_code", F.xxhash64("text"))
    joined = coded.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_code") == F.col("__code")), "left")
    keep = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("__gone", i))
    extra = {
        "n_lines": F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0).cast("bigint"),
        "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("bigint"),
        "n_templates": F.coalesce("__templates", F.lit(0)).cast("bigint"),
    }
    out = joined.withColumns({f"__{k}": v for k, v in extra.items()})
    out = out.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n")))
    kept = [c for c in docs.columns if c not in extra]
    return out.select(*kept, *[F.col(f"__{k}").alias(k) for k in extra])
