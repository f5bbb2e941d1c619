"""Preference pairs as one prompt and two masked completions.

The turns that a chosen and a rejected conversation have in common, from the start, are the
prompt and rendered once. What follows on either side is a completion. A completion comes with
the character spans that count in training: the text and end mark of its assistant turns.

All of it is done row by row with DataFrame functions; only putting the turns of a conversation
together needs a shuffle.

Rules for odd rows: a null role or text counts as empty; turns are ordered by turn, role and
text, those without a number first, and repeated turns stay; if one side is the beginning of
the other, its completion is empty, and both are if the two are equal; a null or empty
conversation has no turns, and a null turn is an empty one; text that looks like a mark is kept
apart from marks by a space; texts of any length are rendered whole; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeloom.llm.tables import columns, ship
from lifeloom.llm.tokens import TokenBytes

END = "<|end|>\n"
TRAINED = "assistant"


def clean(text: Column) -> Column:
    return F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))


def as_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order."""
    rows = columns(conversations, "conv_id", "turn", "role", "text")
    turn = F.struct("turn", clean(F.col("role")).alias("role"), clean(F.col("text")).alias("text"))
    turns = F.array_sort(F.collect_list(turn))
    return rows.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    )


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), t["text"], F.lit(END))), "")


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two conversations have in common from the start."""
    least = F.least(F.size(a), F.size(b))
    same = F.zip_with(
        F.slice(a, 1, least), F.slice(b, 1, least), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"])
    )
    differs = F.array_position(same, F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(least).cast("int")


def trained_spans(turns: Column) -> Column:
    """[start, end) in the rendered turns of what is trained on."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.char_length(header(t))
        end = begin + F.char_length(t["text"]) + len(END)
        own = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"), F.when(t["role"] == TRAINED, F.concat(a["spans"], own)).otherwise(a["spans"]).alias("spans")
        )

    return F.aggregate(turns, start, step, lambda a: a["spans"])


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans and rejected_spans.

    ``pairs`` has pair_id and, as arrays of (role, text), chosen and rejected.
    """
    kind = "array<struct<role:string,text:string>>"
    rows = columns(pairs, "pair_id", "chosen", "rejected")
    tidy = lambda t: F.struct(clean(t["role"]).alias("role"), clean(t["text"]).alias("text"))
    sides = {s: F.transform(F.coalesce(F.col(s).cast(kind), F.array().cast(kind)), tidy) for s in ("chosen", "rejected")}
    rows = rows.select("pair_id", *(v.alias(k) for k, v in sides.items()))
    rows = rows.withColumn("prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    rest = {s: F.slice(s, F.col("prompt_turns") + 1, F.size(s) + 1) for s in sides}
    return rows.select(
        "pair_id",
        "prompt_turns",
        rendered(F.slice("chosen", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        *(rendered(t).alias(s) for s, t in rest.items()),
        *(trained_spans(t).alias(f"{s}_spans") for s, t in rest.items()),
    )


def tokenised(formatted: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """pair_id and, for the prompt and each side, its ids; for each side also a mask of 0 and 1."""
    ship(formatted.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TokenBytes.load(tokenizer)
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for row in b.to_pylist():
                out[0].append(np.frombuffer(encode(row["prompt"]), np.uint32).astype(np.int32))
                for at, side in ((1, "chosen"), (3, "rejected")):
                    cuts = [0, *(x for s in row[f"{side}_spans"] for x in (s["start"], s["end"])), len(row[side])]
                    parts = [encode(row[side][a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]
                    out[at].append(np.frombuffer(b"".join(parts), np.uint32).astype(np.int32))
                    out[at + 1].append(np.repeat(np.arange(len(parts)) % 2, [len(p) // 4 for p in parts]).astype(np.int32))
            names = ["prompt_ids", "chosen_ids", "chosen_mask", "rejected_ids", "rejected_mask"]
            cols = [pa.array(c, pa.list_(pa.int32())) for c in out]
            yield pa.RecordBatch.from_arrays([b.column("pair_id"), *cols], ["pair_id", *names])

    kind = formatted.schema["pair_id"].dataType.simpleString()
    lists = ", ".join(f"{n} array<int>" for n in ("prompt_ids", "chosen_ids", "chosen_mask", "rejected_ids", "rejected_mask"))
    return formatted.mapInArrow(work, f"pair_id {kind}, {lists}")
