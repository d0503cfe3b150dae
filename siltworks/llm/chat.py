r"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, adjacent turns of one role are
merged into a block by array functions, and blocks are joined into one string::

    ### role: first text<turn/>second text</turn>

followed by a newline per block.  Control strings inside texts and roles are escaped, so
``parse`` gives the turns back exactly: ``\`` becomes ``\s``, ``</turn>`` ``\l/turn>``,
``<turn/>`` ``\lturn/>`` and ``### `` ``\h## ``; in roles ``:`` becomes ``\c`` as well.

Defined results: null texts and roles are empty; null turn numbers come first; turns with
one number are ordered by role and text and all kept, repeated rows too; rows with a null
conversation id form one conversation; an empty table gives no rows; other columns are
ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import quoted

OPEN, COLON, NEXT, CLOSE = "### ", ": ", "<turn/>", "</turn>\n"
_ESCAPES = [("\\", "\\s"), ("</turn>", "\\l/turn>"), ("<turn/>", "\\lturn/>"), ("### ", "\\h## ")]
_CODES = [("\\h", "#"), ("\\l", "<"), ("\\c", ":"), ("\\s", "\\")]

#: turn numbers per first-level group: long conversations are collected in slices
SLICE = 64


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column, role: bool = False) -> Column:
    return _replaced(text, _ESCAPES + [(":", "\\c")] if role else _ESCAPES)


def unescaped(text: Column) -> Column:
    return _replaced(text, _CODES)


def collect_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the sorted turn structs of each conversation.

    Slices of a conversation are collected first, so its rows are spread over tasks and
    its last group only joins finished slices.
    """
    item = F.struct(
        quoted(turn).alias("turn"),
        F.coalesce(quoted(role), F.lit("")).alias("role"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    slices = (
        rows.select(quoted(conv).alias("conv_id"), F.floor(quoted(turn) / SLICE).alias("slice"), item.alias("item"))
        .groupBy("conv_id", "slice")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    whole = slices.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("slice", "items"))).alias("parts"))
    return whole.select("conv_id", F.flatten(F.transform("parts", lambda p: p["items"])).alias("turns"))


def format_chat(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, n_turns, n_blocks, formatted, loss_runs).

    ``loss_runs`` cuts ``formatted`` from its start into runs of ``chars`` code points;
    ``loss`` marks those to learn: the texts of the roles in ``learn``, without markers.
    """
    turns = collect_turns(rows, conv, turn, role, text)
    size = F.size("turns")
    starts = F.filter(
        F.transform("turns", lambda t, i: F.when((i == 0) | (t["role"] != F.get("turns", i - 1)["role"]), i)),
        lambda i: i.isNotNull(),
    )
    marked = turns.withColumn("starts", starts)
    blocks = F.transform(
        "starts",
        lambda s, k: F.struct(
            F.get("turns", s)["role"].alias("role"),
            F.transform(
                F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), size) - s), lambda t: escaped(t["text"])
            ).alias("texts"),
        ),
    )
    blocked = marked.withColumn("blocks", blocks)
    header = lambda b: F.concat(F.lit(OPEN), escaped(b["role"], role=True), F.lit(COLON))
    formatted = F.array_join(
        F.transform("blocks", lambda b: F.concat(header(b), F.array_join(b["texts"], NEXT), F.lit(CLOSE))), ""
    )
    run = lambda chars, loss: F.struct(chars.cast("int").alias("chars"), loss.alias("loss"))
    runs = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda x, j: F.array(
                            run(F.when(j == 0, F.char_length(header(b))).otherwise(F.lit(len(NEXT))), F.lit(False)),
                            run(F.char_length(x), b["role"].isin(*learn)),
                        ),
                    )
                ),
                F.array(run(F.lit(len(CLOSE)), F.lit(False))),
            ),
        )
    )
    return blocked.select(
        "conv_id",
        size.cast("long").alias("n_turns"),
        F.size("blocks").cast("long").alias("n_blocks"),
        formatted.alias("formatted"),
        runs.alias("loss_runs"),
    )


def parse(formatted: DataFrame) -> DataFrame:
    """Add ``parsed`` (role and text of every turn) and ``learned`` (the unescaped texts
    under the loss mask), both read from ``formatted`` and ``loss_runs``."""
    sections = F.split("formatted", CLOSE, -1)
    cut = formatted.withColumn("_sections", F.slice(sections, 1, F.size(sections) - 1))
    body = lambda s: F.substr(s, F.lit(len(OPEN) + 1))
    name = lambda s: F.substring_index(body(s), COLON, 1)
    texts = lambda s: F.split(F.substr(body(s), F.char_length(name(s)) + len(COLON) + 1), NEXT, -1)
    cut = cut.withColumn("_blocks", F.transform("_sections", lambda s: F.struct(name(s).alias("role"), texts(s).alias("texts"))))
    parsed = F.flatten(
        F.transform(
            "_blocks",
            lambda b: F.transform(b["texts"], lambda x: F.struct(unescaped(b["role"]).alias("role"), unescaped(x).alias("text"))),
        )
    )
    strings = F.flatten(
        F.transform(
            "_blocks",
            lambda b: F.concat(
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda x, j: F.array(F.when(j == 0, F.concat(F.lit(OPEN), b["role"], F.lit(COLON))).otherwise(F.lit(NEXT)), x),
                    )
                ),
                F.array(F.lit(CLOSE)),
            ),
        )
    )
    masked = F.filter(
        F.zip_with(strings, "loss_runs", lambda s, r: F.when(r["loss"] & (F.char_length(s) == r["chars"]), unescaped(s))),
        lambda s: s.isNotNull(),
    )
    return cut.withColumns({"parsed": parsed, "learned": masked}).drop("_sections", "_blocks")
