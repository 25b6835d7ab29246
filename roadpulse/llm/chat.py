"""Chat formatting with Spark expressions: sorted turn structs, merged runs, one text each.

A conversation becomes ``<s>role[INST]text</s><s>role[INST]text[SEP]text</s>``:
one block per run of turns of one role, its texts parted by ``[SEP]``. The loss
mask is a list of (start, length) spans, in code points, one per text of the
trained role.

Defined results: a NULL role or text counts as empty, a NULL conv_id is a
conversation of its own, a NULL turn comes first, turns with equal numbers are
ordered by role and text, repeated rows stay repeated turns, an empty table
gives no rows. Other columns of the input are not read, whatever their names.
One conversation is one text, so it has to fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, SEPARATOR, CLOSE = "<s>", "[INST]", "[SEP]", "</s>"

# A control string as first character and rest, with any backslashes between.
# Escaping adds a backslash there and unescaping takes one away, so escaped text
# holds no control string and comes back exactly.
_CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\]|SEP\])"
_ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?INST\]|SEP\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Rows (conv_id, turn, role, text) to rows (conv_id, formatted, loss_spans)."""
    plain = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = plain.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    runs = sorted_turns.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])))
    blocks = runs.withColumn("blocks", F.transform("starts", lambda start, k: F.slice(
        "turns", start + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - start)))

    def piece(text: Column, trained: Column) -> Column:
        return F.struct(text.alias("text"), trained.alias("trained"))

    def fixed(text: Column | str) -> Column:
        return piece(F.lit(text) if isinstance(text, str) else text, F.lit(False))

    def pieces(block: Column) -> Column:
        role = block[0]["role"]
        texts = F.flatten(F.transform(block, lambda turn, i: F.array(
            fixed(F.when(i > 0, SEPARATOR).otherwise("")),
            piece(escape(turn["text"]), role == trained_role))))
        return F.concat(F.array(fixed(F.concat(F.lit(OPEN), escape(role), F.lit(HEAD)))), texts,
                        F.array(fixed(CLOSE)))

    rendered = blocks.withColumn("pieces", F.flatten(F.transform("blocks", pieces)))
    none = F.array().cast("array<struct<start:int,length:int>>")
    spans = F.aggregate(
        "pieces", F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda done, part: F.struct(
            (done["at"] + F.length(part["text"])).alias("at"),
            F.when(part["trained"], F.array_append(done["spans"], F.struct(
                done["at"].alias("start"), F.length(part["text"]).alias("length"))))
            .otherwise(done["spans"]).alias("spans")),
        lambda done: done["spans"])
    return rendered.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs that a formatted conversation was made of, in order."""
    def turns(block: Column) -> Column:
        head = F.substring_index(block, HEAD, 1)
        body = F.substr(block, F.length(head) + len(HEAD) + 1)
        return F.transform(F.split(body, r"\Q" + SEPARATOR + r"\E"), lambda text: F.struct(
            unescape(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
            unescape(text).alias("text")))

    parts = F.split(formatted, CLOSE)
    return F.flatten(F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turns))


def trained_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda span: unescape(
        F.substr(formatted, span["start"] + 1, span["length"]))), "")


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and hashes of formatted conversations, taken from the output alone."""
    read = conversations.select("conv_id", "formatted",
                                read_turns(F.col("formatted")).alias("turns"),
                                trained_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    rows = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(rows, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
