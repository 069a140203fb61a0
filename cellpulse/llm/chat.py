"""Chat formatting with typed content parts.

A message is an array of parts. A visitor, one expression per kind of part, turns them in order into text:
text parts are escaped, all others become a placeholder that is recorded as an attachment with its expanded
token count. Turns are then joined by a template with a loss mask over the assistant texts. Every step is a
DataFrame function; the mask holds byte offsets, so reading a span back costs its length and not its position.

Control strings of the template start with `<` or `[`. In texts these two characters and the escape
character are replaced by the escape character and a digit, so no control string can appear in a text and
the original is restored exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template and the escapes.
TURN_OPEN, ROLE_CLOSE, TURN_CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"
ESCAPE = "\\"
ESCAPED = ((ESCAPE, ESCAPE + "0"), ("<", ESCAPE + "1"), ("[", ESCAPE + "2"))

PART = (
    "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
#: Tokens that one placeholder stands for: image patches of this side, audio tokens a second, tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 512


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPED:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(ESCAPED):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def part_tokens(part: Column) -> Column:
    """Expanded tokens of a part that is not text; unknown sizes count as zero."""
    patches = lambda side: F.ceil(F.coalesce(side, F.lit(0)) / PATCH)
    return (
        F.when(part["kind"] == "image", patches(part["width"]) * patches(part["height"]))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
        .otherwise(F.lit(0))
        .cast("long")
    )


def visit(part: Column, number: Column) -> Column:
    """What stands for a part in the output: the escaped text, or `[KIND number]`. A null text is empty and a
    part of an unknown or null kind counts as text."""
    other = part["kind"].isin("image", "audio", "document")
    placeholder = F.concat(F.lit("["), F.upper(part["kind"]), F.lit(" "), (number + 1).cast("string"), F.lit("]"))
    return F.when(F.coalesce(other, F.lit(False)), placeholder).otherwise(
        escape(F.coalesce(part["text"], F.lit("")))
    )


def flattened(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, parts) with `body`, the flattened parts, and `attachments`: the place of
    each other part in its message, its kind, reference and expanded tokens. Null parts are an empty message."""
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    placed = F.transform(
        parts,
        lambda p, i: F.struct(
            visit(p, i).alias("body"), (i + 1).alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"),
            part_tokens(p).alias("tokens"),
        ),
    )
    return messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), placed.alias("placed")).select(
        "conv_id", "turn", "role",
        F.array_join(F.transform("placed", lambda p: p["body"]), "").alias("body"),
        F.transform(
            F.filter("placed", lambda p: p["kind"].isin("image", "audio", "document")),
            lambda p: F.struct(p["place"].alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
        ).alias("attachments"),
    )


def formatted(messages: DataFrame) -> DataFrame:
    """One row per conversation: `output`, `mask` (byte offset and length of each assistant body in `output`),
    `attachments` with their turn's place, and `attachment_tokens`.

    Turns are ordered by turn, then role and body; equal rows are all kept. Null turns come first. A null
    conv_id is a conversation of its own. No input gives no rows.
    """
    turns = flattened(messages)
    head = F.concat(F.lit(TURN_OPEN), escape(F.col("role")), F.lit(ROLE_CLOSE))
    pieces = turns.select(
        "conv_id", "turn", "role", "body", "attachments",
        F.concat(head, "body", F.lit(TURN_CLOSE)).alias("piece"), F.octet_length(head).alias("head"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("n", F.row_number().over(order)).withColumn(
        "at", F.coalesce(F.sum(F.octet_length("piece")).over(before), F.lit(0)) + F.col("head")
    )
    row = F.struct(
        "n", "piece", "at", F.octet_length("body").alias("size"), (F.col("role") == "assistant").alias("learned"),
        "attachments",
    )
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return joined.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("output"),
        F.transform(
            F.filter("rows", lambda r: r["learned"]),
            lambda r: F.struct(r["at"].cast("int").alias("at"), r["size"].cast("int").alias("size")),
        ).alias("mask"),
        F.flatten(
            F.transform(
                "rows",
                lambda r: F.transform(
                    r["attachments"],
                    lambda a: F.struct(r["n"].alias("message"), a["place"].alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
                ),
            )
        ).alias("attachments"),
    ).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda t, a: t + a["tokens"])
    )


def read_back(chats: DataFrame) -> DataFrame:
    """What `formatted` wrote, read from `output` and `mask` alone: `turns` (role, text) and `learned`, the
    text under the mask with nothing between. Placeholders stay as they are."""
    pieces = F.split("output", TURN_CLOSE)
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape(F.substring_index(F.substring_index(p, ROLE_CLOSE, 1), TURN_OPEN, -1)).alias("role"),
            unescape(F.substring_index(p, ROLE_CLOSE, -1)).alias("text"),
        ),
    )
    both = chats.select(
        "conv_id", "output", turns.alias("turns"),
        F.transform("mask", lambda m: F.struct(m["at"].alias("at"), m["size"].alias("size"))).alias("mask"),
        F.encode("output", "UTF-8").alias("bytes"),
    )
    # One copy of the output per span would be wasteful inside a lambda: zip a reference to it with every span.
    spans = F.arrays_zip(
        F.col("mask").alias("m"), F.array_repeat(F.col("bytes"), F.size("mask")).alias("b")
    )
    return both.select("conv_id", "output", "turns", spans.alias("spans")).select(
        "conv_id", "output", "turns",
        F.array_join(
            F.transform(
                "spans",
                lambda z: unescape(F.decode(F.substring(z["b"], z["m"]["at"] + 1, z["m"]["size"]), "UTF-8")),
            ),
            "",
        ).alias("learned"),
    )


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, read back from the output."""
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read_back(chats).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", turn), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("output").cast("long").alias("formatted_chars"),
    )
