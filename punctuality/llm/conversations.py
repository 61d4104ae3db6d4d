"""Repair of conversations by a square-root checkpointed dynamic programme.

A conversation is sound if its roles read ``(s?(ua)+)?`` by their initials. Rows are kept, given
another role, deleted, or joined by inserted ones; the cheapest edits are found by a programme with
four states: nothing yet, after system, after user, after assistant. A conversation of n rows is cut
into blocks of about sqrt(n) rows. The backward pass keeps state-cost vectors at the ends of blocks
only: each block gives its least costs from state to state, which are chained from the last block to
the first. Then each block recomputes the vectors between its own ends and walks forward, taking the
ASCII-least edit that is tight. It does so for each state it may be entered in, so that blocks need
not wait for each other; which of the walks counts is chained from the first block to the last. So no
task holds more than the square root of a conversation, but for the audit string itself.

Rows are put in order by a range partitioning, so that a conversation with much of the table is sorted
by many tasks. A digest of a whole conversation is sequential by nature: its rows stream through one
task, in order and without being collected.

Order: by turn, nulls first; rows of one turn by role, text digest and then copies. A null in role or
text counts as one space, so such a text is blank. A null conversation is one of its own. Repeated
rows are duplicates. Text of any length is read whole; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import fields, rows_to_batch, small_batches
from punctuality.plans.durable import durable

SPACE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
# Costs, and what comes next: fixed values of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
FOLLOWS = (USER, USER, ASSISTANT, USER)  # the only role that may be put after each state
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
FAR = 1 << 60  # no way
END = (0, INSERT * 2, INSERT, 0)  # costs after the last row
SHORTEST = 64  # rows of a block at least
LEGAL = ("su", "ua", "au")


# The programme of one block


def before_row(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs of all states before a row. ``code``: the role's initial (o: another), in capitals if the
    text is truncated; x: the row must go."""
    low = code.lower()
    if low == "x":
        plain = [DELETE + c for c in after]
    else:
        extra = TRUNCATED if code != low else 0
        keeps = KEEPS[low]
        plain = [
            min(DELETE + after[s], extra + REROLE + after[FOLLOWS[s]], extra + after[keeps[s]] if s in keeps else FAR)
            for s in range(4)
        ]
    # After two insertions the states repeat.
    once = [INSERT + plain[FOLLOWS[s]] for s in range(4)]
    return tuple(min(plain[s], once[s], INSERT + once[FOLLOWS[s]], FAR) for s in range(4))


def least_costs(codes: str) -> list[list[int]]:
    """Least costs of a block, from each state before it to each state after it."""
    columns = []
    for last in range(4):
        costs = tuple(0 if s == last else FAR for s in range(4))
        for code in reversed(codes):
            costs = before_row(code, costs)
        columns.append(costs)
    return [[column[s] for column in columns] for s in range(4)]


def walk(codes: str, after: tuple[int, ...], last: bool, entries: range | list[int]) -> tuple[int, list[int], list[str]]:
    """Cost from the first entry, and for each entry the state after the block and its script.

    A script has a word for each row: its edits, with the initial of a role that is given. ``last``:
    insertions after the last row belong to its word.
    """
    vectors = [after]
    for code in reversed(codes):
        vectors.append(before_row(code, vectors[-1]))
    vectors.reverse()
    exits, scripts = [], []
    for state in entries:
        words = []
        for i, code in enumerate(codes):
            word, low = "", code.lower()
            extra = TRUNCATED if code != low else 0
            here, there = vectors[i], vectors[i + 1]
            # ASCII order: D, I, K, R. An insertion never comes twice into one state.
            while True:
                cost, put = here[state], FOLLOWS[state]
                if cost == DELETE + there[state]:
                    word += "D"
                elif cost == INSERT + here[put]:
                    word += "I" + NAMES[put][0]
                    state = put
                    continue
                elif low != "x" and state in KEEPS[low] and cost == extra + there[KEEPS[low][state]]:
                    word += "K"
                    state = KEEPS[low][state]
                else:
                    word += "R" + NAMES[put][0]
                    state = put
                break
            words.append(word)
        while last and END[state]:
            state = FOLLOWS[state]
            words[-1] += "I" + NAMES[state][0]
        exits.append(state)
        scripts.append(" ".join(words))
    return vectors[0][entries[0]], exits, scripts


# The plan over all conversations


@dataclass(frozen=True)
class Repair:
    """``rows``: all rows in order (``conv, seq, role, text``); ``scripts``: what is done at each row
    (``conv, seq, script``); ``found``: a row of counts, cost and audit for each conversation."""

    rows: DataFrame
    scripts: DataFrame
    found: DataFrame


def _named(conv: Column) -> Column:
    """A key that is never null."""
    return F.when(conv.isNull(), "null").otherwise(F.concat(F.lit("="), conv.cast("string")))


def in_order(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copy: Column | None = None) -> DataFrame:
    """Rows with ``seq``, which ascends in the order of the conversation, ``part``, the task that has
    sorted them, their fault but for duplicates, the role's initial, and the digest of role and text."""
    role, text = F.coalesce(role_col, F.lit(" ")), F.coalesce(text_col, F.lit(" "))
    shown = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = df.select(
        _named(F.col(conv_col)).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        (F.lit(0) if copy is None else copy).alias("copy"),
    ).withColumn("digest", F.unhex(F.sha2(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"), 256)))
    order = ["conv", "turn", "role", "digest", "copy"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    fault = F.when(shown == "", "blank").when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    return durable(rows.select(
        "conv", "turn", "role", "text", "digest", initial.alias("initial"), fault.alias("fault"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"),
    ))


def plan(rows: DataFrame) -> Repair:
    """The cheapest edits of the conversations in ``rows``, as :func:`in_order` gives them."""
    narrow = rows.select("conv", "turn", "digest", "initial", "fault", "part", "seq")
    repeated = narrow.filter("fault <> 'blank'").groupBy("conv", "digest").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = repeated.filter("n > 1").select("conv", "digest", "first")
    # Each task has a run of a conversation; runs are in the order of tasks.
    runs = narrow.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("run"))
    whole = Window.partitionBy("conv")
    before = F.sum("n").over(whole.orderBy("part")) - F.col("n")
    runs = runs.select("conv", "part", "run", before.alias("before"), F.sum("n").over(whole).alias("size"))
    marked = narrow.join(repeated, ["conv", "digest"], "left").join(runs, ["conv", "part"])
    again = (F.col("fault") != "blank") & (F.col("seq") > F.col("first"))
    fault = F.when(again, "duplicate").otherwise(F.col("fault"))
    long_ = F.greatest(F.lit(SHORTEST), F.ceil(F.sqrt("size")))
    place = F.col("before") + F.col("seq") - F.col("run")
    marked = marked.select("conv", "turn", "initial", fault.alias("fault"), "seq", F.floor(place / long_).alias("block"))
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    inside = F.sort_array(F.collect_list(F.struct("seq", code.alias("code"), "initial")))
    counted = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    blocks = marked.groupBy("conv", "block").agg(inside.alias("inside"), *counted)
    text = lambda name: F.array_join(F.transform("inside", lambda x: x[name]), "")
    blocks = blocks.select(
        "conv", "block", F.col("inside")["seq"].alias("seqs"), text("code").alias("codes"), text("initial").alias("initials"),
        "blank", "duplicate", "truncated",
    )
    # The block before gives its last initial; a conversation's blocks are the square root of its rows.
    along = Window.partitionBy("conv").orderBy("block")
    blocks = durable(blocks.select(
        "*", F.coalesce(F.lag(F.substring("initials", -1, 1)).over(along), F.lit("")).alias("last"),
        (F.max("block").over(Window.partitionBy("conv")) + 1).alias("blocks"),
    ))
    walked = durable(_walked(blocks.join(_checkpoints(blocks), ["conv", "block"], "left")))
    taken = walked.join(_entries(walked), ["conv", "block"], "left").withColumn("script", F.col("scripts")[F.coalesce("entry", F.lit(0))])
    scripts = taken.select("conv", F.explode(F.arrays_zip("seqs", F.split("script", " ").alias("words"))).alias("x"))
    audits = F.transform(F.sort_array(F.collect_list(F.struct("block", F.regexp_replace("script", "[^DIKR]", "").alias("audit")))), lambda x: x["audit"])
    found = taken.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"), F.array_join(audits, "").alias("audit"),
    )
    gaps = narrow.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    return Repair(rows.select("conv", "seq", "role", "text"), scripts.select("conv", F.col("x.seqs").alias("seq"), F.col("x.words").alias("script")), found.join(gaps, "conv"))


def _checkpoints(blocks: DataFrame) -> DataFrame:
    """``conv, block, after``: costs behind each block, for conversations of several blocks."""
    schema = fields("conv string, block bigint, least array<bigint>")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, block, codes = (c.to_pylist() for c in batch.columns)
            yield rows_to_batch([(c, b, [x for row in least_costs(t) for x in row]) for c, b, t in zip(conv, block, codes, strict=True)], schema)

    def backward(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block", ascending=False)
        costs, after = np.array(END, np.int64), []
        for least in group["least"]:
            after.append(costs)
            costs = np.minimum((np.asarray(least, np.int64).reshape(4, 4) + costs).min(1), FAR)
        return pd.DataFrame({"conv": group["conv"], "block": group["block"], "after": after})

    several = blocks.filter("blocks > 1").select("conv", "block", "codes").mapInArrow(matrices, schema)
    return several.groupBy("conv").applyInPandas(backward, "conv string, block bigint, after array<bigint>")


def _walked(blocks: DataFrame) -> DataFrame:
    """Blocks with their cost, exits and scripts by state of entry, and pairs of roles that don't follow."""
    schema = fields(
        "conv string, block bigint, blocks bigint, seqs array<bigint>, blank bigint, duplicate bigint, truncated bigint,"
        " illegal bigint, cost bigint, exits array<bigint>, scripts array<string>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, block, of, seqs, blank, duplicate, truncated, codes, initials, last, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                roles = last + initials
                illegal = sum(roles[i : i + 2] not in LEGAL for i in range(len(roles) - 1))
                cost, exits, scripts = walk(codes, tuple(after or END), block == of - 1, [START] if not block else range(4))
                rows.append((conv, block, of, seqs, blank, duplicate, truncated, illegal, cost, exits, scripts))
            yield rows_to_batch(rows, schema)

    return small_batches(blocks).select(
        "conv", "block", "blocks", "seqs", "blank", "duplicate", "truncated", "codes", "initials", "last", "after"
    ).mapInArrow(run, schema)


def _entries(walked: DataFrame) -> DataFrame:
    """``conv, block, entry``: the state each block is entered in, for conversations of several blocks."""

    def forward(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        state, entry = START, []
        for exits in group["exits"]:
            entry.append(state)
            state = int(exits[state])
        return pd.DataFrame({"conv": group["conv"], "block": group["block"], "entry": entry})

    several = walked.filter("blocks > 1").select("conv", "block", "exits")
    return several.groupBy("conv").applyInPandas(forward, "conv string, block bigint, entry int")


def repaired(repair: Repair) -> DataFrame:
    """``conv, seq, place, role, text``: the sound conversations, in the order of ``seq`` and ``place``."""
    steps = F.regexp_extract_all("script", F.lit("D|K|[IR][ua]"), 0)
    rows = repair.rows.join(repair.scripts, ["conv", "seq"]).select("conv", "seq", "role", "text", F.posexplode(steps).alias("place", "step"))
    given = F.when(F.col("step").endswith("u"), NAMES[USER]).otherwise(NAMES[ASSISTANT])
    return rows.filter("step <> 'D'").select(
        "conv", "seq", "place", F.when(F.col("step") == "K", F.col("role")).otherwise(given).alias("role"),
        F.when(F.col("step").startswith("I"), "").otherwise(F.col("text")).alias("text"),
    )


def digests(rows: DataFrame) -> DataFrame:
    """``conv, sha256`` of the lines ``role:text`` of each conversation of :func:`repaired`, streamed in order."""
    schema = fields("conv string, sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                line = f"{role}:{text}".encode()
                if conv == current:
                    state.update(b"\n")
                    state.update(line)
                    continue
                if current is not None:
                    done.append((current, state.hexdigest()))
                current, state = conv, hashlib.sha256(line)
            yield rows_to_batch(done, schema)
        if current is not None:
            yield rows_to_batch([(current, state.hexdigest())], schema)

    rows = small_batches(rows).repartition("conv").sortWithinPartitions("conv", "seq", "place")
    return rows.select("conv", "role", "text").mapInArrow(run, schema)


def damaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows after damage by the key's hash, with ``copy`` (1 for a repetition)."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    rows = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), kind.alias("kind")
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 0, F.array().cast("array<int>")).when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def repaired_after_damage(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Faults, cost, audit and digest of every conversation of ``df`` after damage."""
    rows = in_order(damaged(df, conv_col, turn_col, role_col, text_col), "conv_id", "turn", "role", "text", F.col("copy"))
    repair = plan(rows)
    all_ = df.select(F.col(conv_col).alias("conv_id")).distinct().withColumn("conv", _named(F.col("conv_id")))
    found = all_.join(repair.found, "conv", "left").join(digests(repaired(repair)), "conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
