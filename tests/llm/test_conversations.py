"""Conversation repair against trying all edits, and against a plain programme over whole audits."""

import hashlib
import re
import zlib
from functools import cache
from itertools import product

import numpy as np
import pytest

from punctuality.llm import conversations

BLANK = re.compile(r"[^\x20\x09-\x0D]")
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = BLANK.findall(text)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif shown[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def try_all(rows):
    """Least cost, its ASCII-least audit and the repaired rows, from every way to edit a few rows."""
    inserted = [(), *product("ua"), *product("ua", repeat=2)]
    best = None
    choices = []
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        extra = 3 if fault == "truncated" else 0
        ways = [(4, "D", None)]
        if fault not in ("blank", "duplicate"):
            ways += [(extra, "K", (role, text)), (extra + 3, "R", ("user", text)), (extra + 3, "R", ("assistant", text))]
        choices.append([(3 * len(put) + c, "I" * len(put) + e, put, r) for put in inserted for c, e, r in ways])
    choices.append([(3 * len(put), "I" * len(put), put, None) for put in inserted])
    for ways in product(*choices):
        out = []
        for _, _, put, row in ways:
            out += [("user" if p == "u" else "assistant", "") for p in put] + ([row] if row else [])
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
            key = (sum(w[0] for w in ways), "".join(w[1] for w in ways))
            if best is None or key < best[:2]:
                best = (*key, out)
    return best


def by_whole_audits(rows):
    """The same for any length: the best audit behind each row and state, compared as a whole."""
    marks = faults(rows)
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, put):
        found = []
        if put < 2:
            for letter in step[state].replace("s", ""):
                cost, audit, out = best(i, letter, put + 1)
                found.append((cost + 3, "I" + audit, (("user" if letter == "u" else "assistant", ""), *out)))
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            (role, text), extra = rows[i], 3 if marks[i] == "truncated" else 0
            cost, audit, out = best(i + 1, state, 0)
            found.append((cost + 4, "D" + audit, out))
            if marks[i] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in step[state]:
                    cost, audit, out = best(i + 1, role[:1], 0)
                    found.append((cost + extra, "K" + audit, ((role, text), *out)))
                for name in ("user", "assistant"):
                    if name[0] in step[state]:
                        cost, audit, out = best(i + 1, name[0], 0)
                        found.append((cost + extra + 3, "R" + audit, ((name, text), *out)))
        return min(found, key=lambda x: x[:2]) if found else (10**9, "~", ())

    for i in reversed(range(len(rows))):  # else the recursion is as deep as the conversation is long
        for state in step:
            best(i, state, 0)
    return best(0, "", 0)


def result(rows, turns):
    roles = "".join(r[:1] if r[:1] in ("s", "u", "a") else "o" for r, _ in rows)
    known = [t for t in turns if t is not None]
    marks = faults(rows)
    cost, audit, out = by_whole_audits(tuple(rows))
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0, marks.count("blank"), marks.count("duplicate"),
        marks.count("truncated"), sum(roles[i : i + 2] not in ("su", "ua", "au") for i in range(len(rows) - 1)),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def expected(rows):
    """The contract over (conv, turn, role, text), row by row."""
    by_conv = {}
    for conv, turn, role, text in rows:
        out = by_conv.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    answer = []
    for conv, found in by_conv.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        answer.append((conv, *(result([r[1:] for r in found], [r[0] for r in found]) if found else (0, 0, 0, 0, 0, 0, "", EMPTY))))
    return sorted(answer, key=repr)


def table_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return df.selectExpr("*", "'x' AS conv", "'x' AS seq", "'x' AS copy", "'x' AS kind", "'x' AS block")


def conversations_of(seed, n, low=0, high=14):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    words = ["yes.", "no!", "what?", "and then", "  ", "", "end. \n", "é.", None]
    rows = []
    for conv in range(n):
        turns = sorted(rng.choice(40, rng.integers(low, high), replace=False).tolist())
        regular = rng.random() < 0.5
        for i, turn in enumerate(turns):
            role = ("user", "assistant")[i % 2] if regular and rng.random() < 0.8 else roles[rng.integers(len(roles))]
            text = words[rng.integers(len(words))] if rng.random() < 0.4 else f"text {conv} {i}."
            rows.append((conv, int(turn), role, text))
    return rows


def found_of(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_programme_tries_all_edits():
    rng = np.random.default_rng(0)
    roles, words = ["system", "user", "assistant", "tool"], ["a.", "b.", "c", " "]
    for _ in range(25):
        rows = tuple((roles[rng.integers(4)], words[rng.integers(4)]) for _ in range(rng.integers(0, 4)))
        best = by_whole_audits(rows)
        assert (best[0], best[1], list(best[2])) == try_all(rows)


@pytest.mark.parametrize("shortest", [64, 2])
def test_repair_after_damage(spark, monkeypatch, shortest):
    monkeypatch.setattr(conversations, "SHORTEST", shortest)
    rows = conversations_of(1, 120)
    found = conversations.repaired_after_damage(table_of(spark, rows).repartition(5), "conv_id", "turn", "role", "text")
    assert found_of(found) == expected(rows)


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    """Its rows are sorted by several tasks and cut into blocks of their square root."""
    monkeypatch.setattr(conversations, "SHORTEST", 4)
    rng = np.random.default_rng(3)
    rows = [(7, t, ["system", "user", "assistant"][rng.integers(3)], f"t{t % 400}" + ".?x"[rng.integers(3)]) for t in rng.permutation(600).tolist()]
    rows += conversations_of(4, 10)
    rows = [r for r in rows if r[0] != 7 or r[1] not in range(300, 320)]
    df = table_of(spark, rows).repartition(6)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    try:
        found = conversations.repaired_after_damage(df, "conv_id", "turn", "role", "text")
        assert found_of(found) == expected(rows)
        ordered = conversations.in_order(df, "conv_id", "turn", "role", "text")
    finally:
        spark.conf.unset(small)
    assert ordered.filter("conv = '=7'").select("part").distinct().count() > 1
    long_ = conversations.plan(ordered).scripts.filter("conv = '=7'")
    assert long_.count() == 580


def test_odd_conversations(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "no id."), (1, None, "user", "a."), (1, None, "user", "a."), (2, 5, None, "x."),
        (3, 1, "system", "only."), (4, 1, "assistant", "z" * 300_000 + "."), (5, -3, "user", "é "), (5, 9, "assistant", "!"),
        (6, 1, "user", ""), (6, 2, "user", "\t\n"),
    ]
    df = table_of(spark, rows)
    assert found_of(conversations.repaired_after_damage(df, "conv_id", "turn", "role", "text")) == expected(rows)
    assert conversations.repaired_after_damage(table_of(spark, []), "conv_id", "turn", "role", "text").count() == 0


def test_repaired_rows(spark):
    rows = [(1, 1, "user", "hi."), (1, 2, "user", "you there?"), (1, 3, "tool", "cut"), (2, 1, "system", " ")]
    repair = conversations.plan(conversations.in_order(table_of(spark, rows), "conv_id", "turn", "role", "text"))
    out = conversations.repaired(repair).orderBy("conv", "seq", "place")
    assert [tuple(r) for r in out.select("conv", "role", "text").collect()] == [
        ("=1", "user", "hi."), ("=1", "assistant", "you there?"),
    ]
    assert [tuple(r) for r in repair.found.select("conv", "cost", "audit").orderBy("conv").collect()] == [("=1", 7, "KRD"), ("=2", 4, "D")]
