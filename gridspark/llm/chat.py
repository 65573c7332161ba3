"""Operator 8: chat formatting over typed content parts.

A message is a list of parts (`kind`, `text`, `ref`, `units`). Each kind has a visitor that turns a
part into text: text parts are escaped, image, audio and document parts become ordered placeholders
with the reference recorded and the tokens they stand for counted.

A turn is written as  <|turn|>ROLE<|text|>CONTENT<|end|>  with a line end after it. Inside roles and
contents a backslash is doubled, and a backslash is put after each `<` and `[`, so that no control
string of any template (`<|end|>`, `</s>`, `[INST]`) is left whole; `unescaped` turns it back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import for_workers, text_or_empty

PARTS = "array<struct<kind:string,text:string,ref:string,units:double>>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Tokens that a unit of a part stands for: an image tile, a second of audio, a page of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([<\[])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\|\\(\\)", "$1$2")


def visit(part: Column, number: Column, tokens_per_unit: dict[str, int]) -> Column:
    """Text for one part; `number` counts the attachments of a conversation from 1.

    A part without a kind, or of an unknown one, counts as text. Missing text is empty.
    """
    known = F.create_map(*[F.lit(x) for pair in tokens_per_unit.items() for x in pair])
    kind = F.lower(part["kind"])
    placeholder = F.concat(F.lit("<|"), kind, F.lit(":"), number.cast("string"), F.lit("|>"))
    return F.when(F.coalesce(F.map_contains_key(known, F.coalesce(kind, F.lit(""))), F.lit(False)), placeholder).otherwise(
        escaped(F.coalesce(part["text"], F.lit("")))
    )


def text_parts(text: str = "text") -> Column:
    """A text column as a message of one text part."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text_or_empty(text).alias("text"),
            null.cast("string").alias("ref"), null.cast("double").alias("units"),
        )
    )


def format_turns(
    df: DataFrame,
    parts: Column,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    learn: tuple[str, ...] = ("assistant",),
    tokens_per_unit: dict[str, int] | None = None,
) -> DataFrame:
    """One row per turn: `conv`, `position` (from 0), `formatted`, `loss_begin`, `loss_end`,
    `attachments` (number, kind, ref, tokens) and `n_tokens`, the tokens of all placeholders.

    Turns are ordered by `turn` (nulls first), equal ones by role and content; repeated rows are
    further turns. A null role is empty. `loss_begin` and `loss_end` are code points of `formatted`
    between which the loss counts: the content of the roles in `learn`, else nothing (0, 0). Rows
    without a conversation form one. A conversation's formatted text is its turns in order; they are
    kept apart, so that none has to fit in memory.
    """
    rates = tokens_per_unit or TOKENS_PER_UNIT
    known = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), who.alias("role"),
        F.coalesce(parts.cast(PARTS), F.array().cast(PARTS)).alias("parts"),
    )
    attached = lambda p: F.coalesce(F.map_contains_key(known, F.coalesce(F.lower(p["kind"]), F.lit(""))), F.lit(False))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "parts")
    # Running sums and numbers: Spark streams the sorted turns, whatever their count.
    sums = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.size(F.filter("parts", attached))
    rows = rows.withColumn("position", F.row_number().over(order) - 1)
    rows = rows.withColumn("earlier", F.sum(own).over(sums) - own)
    numbered = F.transform(
        "parts",
        lambda p, i: F.struct(
            p.alias("part"),
            (F.col("earlier") + F.size(F.filter(F.slice("parts", 1, i + 1), attached))).alias("number"),
        ),
    )
    rows = rows.withColumn("numbered", numbered)
    content = F.array_join(F.transform("numbered", lambda x: visit(x["part"], x["number"], rates)), "")
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    rows = rows.withColumn("head", head).withColumn("content", content)
    counted = F.col("role").isin(*learn)
    begin = F.char_length("head")
    attachments = F.transform(
        F.filter("numbered", lambda x: attached(x["part"])),
        lambda x: F.struct(
            x["number"].alias("number"), F.lower(x["part"]["kind"]).alias("kind"), x["part"]["ref"].alias("ref"),
            F.ceil(F.coalesce(x["part"]["units"], F.lit(1.0)) * F.element_at(known, F.lower(x["part"]["kind"])))
            .cast("long").alias("tokens"),
        ),
    )
    out = rows.select(
        F.col("conv").alias(conv),
        F.col("position").cast("long").alias("position"),
        F.concat("head", "content", F.lit(END + "\n")).alias("formatted"),
        F.when(counted, begin).otherwise(0).cast("long").alias("loss_begin"),
        F.when(counted, begin + F.char_length("content")).otherwise(0).cast("long").alias("loss_end"),
        attachments.alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return out.withColumn("n_tokens", total)


def parsed(turns: DataFrame) -> DataFrame:
    """`format_turns` rows with `role` and `text` read back out of the formatted text, and `learned`,
    the text under the loss mask. Placeholders stay in `text` as they are."""
    shape = rf"(?s)^\Q{TURN}\E(.*?)\Q{TEXT}\E(.*)\Q{END}\E\n$"
    begin, end = F.col("loss_begin"), F.col("loss_end")
    learned = F.substring(F.col("formatted"), (begin + 1).cast("int"), (end - begin).cast("int"))
    return turns.withColumns(
        {
            "role": unescaped(F.regexp_extract("formatted", shape, 1)),
            "text": unescaped(F.regexp_extract("formatted", shape, 2)),
            "learned": unescaped(learned),
        }
    )


def digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation, from the formatted turns in order; they pass through one by one.

    `n_turns`, `turns_sha256` (role, line end, text, line end per turn), `loss_chars`, `loss_sha256`
    (all text under the mask) and `formatted_chars`.
    """
    for_workers(turns.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = turns.schema[conv].dataType
    rows = parsed(turns).select(
        F.col(conv).alias("conv"), "position", "role", "text", "learned",
        F.char_length("formatted").cast("long").alias("chars"),
    )
    rows = rows.repartition("conv").sortWithinPartitions("conv", "position")
    schema = pa.schema([
        (conv, to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = object(), None, []

        def closed():
            n, turns_hash, loss_chars, loss_hash, chars = state
            return (now, n, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars)

        def packed():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in done], schema=schema)

        for frame in frames:
            columns = [frame.column(i).to_pylist() for i in (0, 2, 3, 4, 5)]
            for conv_id, role, text, learned, chars in zip(*columns, strict=True):
                if state is None or conv_id != now:
                    if state is not None:
                        done.append(closed())
                    now, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += chars
            if done:
                yield packed()
                done = []
        if state is not None:
            done.append(closed())
            yield packed()

    return rows.mapInArrow(
        run,
        f"`{conv}` {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )
