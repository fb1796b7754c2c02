"""Chat formatting by prefix-target expansion, DataFrame functions only.

Every assistant turn of a conversation becomes an example of its own: all turns before it as
context, and that one reply under the loss mask. Turns after the last reply (or a conversation
without a reply) form one more example with nothing to learn, so that no turn is lost.

Template, per turn: ``<|turn|>role<|text|>text<|end|>``. Control strings inside roles and texts, this template's
and those of other common ones, get a backslash after their first character; existing backslashes there
are kept and counted, so that unescaping takes exactly one away again.

Cases: NULL role or text is read as empty; rows of one turn number are ordered by role, then text; rows
without a conversation id form one conversation of their own; repeated rows are turns of their own; other
columns do not pass through; an empty table gives no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import let

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What may follow `<` or `[` in a control string.
_REST = r"(?=\|[^|<>\[\]]{1,64}\|>|/?s>|/?(?:bos|eos|pad|unk|mask|start_of_turn|end_of_turn)>|/?INST\]|</?SYS>>)"
_FIRST = r"([<\[])"
REPLY = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"(\\*)" + _REST, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"\\(\\*)" + _REST, "$1$2")


def format_chats(turns: DataFrame) -> DataFrame:
    """Examples (conv_id, example, target_turn, formatted, loss_start, loss_end, last) of rows (conv_id, turn, role, text).

    ``loss_start`` and ``loss_end`` are code point offsets of the trainable reply in ``formatted``; both
    are NULL where nothing is trained. ``last`` marks the example that holds the whole conversation.
    The table grows with the number of replies times the length of their context: that is the
    operator, each example is a text of its own.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    marked = talks.select(
        "conv_id",
        F.transform(
            "ts",
            lambda t: F.struct(
                F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"),
                escape(t["text"]).alias("body"),
                (t["role"] == REPLY).alias("reply"),
            ),
        ).alias("ts"),
    )
    shown = F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    told = marked.select("conv_id", "ts", shown.alias("shown"), F.size("ts").alias("n"))
    targets = F.filter(
        F.transform("ts", lambda t, i: F.struct(i.alias("i"), t["reply"].alias("reply"))),
        lambda x: x["reply"] | (x["i"] == F.col("n") - 1),
    )
    examples = told.select("conv_id", "ts", "shown", "n", F.posexplode(targets).alias("example", "x"))
    target = F.element_at("ts", F.col("x.i") + 1)
    context = F.array_join(F.slice("shown", F.lit(1), F.col("x.i")), "")
    made = examples.select(
        "conv_id",
        "example",
        F.when(F.col("x.reply"), F.col("x.i")).alias("target_turn"),
        (F.col("x.i") == F.col("n") - 1).alias("last"),
        F.col("x.reply").alias("reply"),
        target.alias("target"),
        context.alias("context"),
    )
    start = F.length("context") + F.length("target.head")
    return made.select(
        "conv_id",
        "example",
        "target_turn",
        F.concat("context", "target.head", "target.body", F.lit(END)).alias("formatted"),
        F.when(F.col("reply"), start).alias("loss_start"),
        F.when(F.col("reply"), start + F.length("target.body")).alias("loss_end"),
        "last",
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text again: array of (role, text), unescaped."""
    pieces = F.split(formatted, r"<\|turn\|>")

    def turn(part: Column) -> Column:
        return let(
            F.split(part, r"<\|text\|>"),
            lambda p: F.struct(
                unescape(p[0]).alias("role"),
                unescape(F.substring(p[1], F.lit(1), F.length(p[1]) - len(END))).alias("text"),
            ),
        )

    return let(pieces, lambda p: F.transform(F.slice(p, F.lit(2), F.size(p) - 1), turn))


def chat_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its examples."""
    trained = unescape(
        F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    )
    read = examples.select(
        "conv_id",
        "example",
        F.when(F.col("last"), read_back(F.col("formatted"))).alias("turns"),
        F.coalesce(trained, F.lit("")).alias("trained"),
        F.length("formatted").cast("bigint").alias("chars"),
    )
    talks = read.groupBy("conv_id").agg(
        F.max("turns").alias("turns"),
        F.sort_array(F.collect_list(F.struct("example", "trained"))).alias("trained"),
        F.sum("chars").alias("formatted_chars"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = talks.withColumn("learned", F.array_join("trained.trained", ""))
    return learned.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
