"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from tidemark.llm import queries, repair

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = (" " if v is None else v for v in (role, text))
        case = zlib.crc32(":".join(shown).encode()) % 20
        if case == 1:
            text = ""
        elif case == 2:
            text = re.sub("[.!?]", "", text)
        elif case == 4:
            role = "user"
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(case, 1))
    return out


def search(rows):
    """Least cost and audit of (role, text, fault) rows by trying every edit, then the messages of that audit."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserts):
        found = []
        if inserts < 4:
            cost, audit = best(i, after[state], inserts + 1)
            found.append((cost + 3, "I" + audit))
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, ""))
            return min(found, default=(10**9, ""))
        role, _, fault = rows[i]
        cost, audit = best(i + 1, state, 0)
        found.append((cost + 4, "D" + audit))
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            first = role[:1]
            if first == "s" and state == "" or first in ("u", "a") and after[state] == first:
                cost, audit = best(i + 1, first, 0)
                found.append((cost + more, "K" + audit))
            cost, audit = best(i + 1, after[state], 0)
            found.append((cost + more + 3, "R" + audit))
        return min(found)

    for i in range(len(rows), 0, -1):       # from the end, so that no call goes deep
        for state in after:
            best(i, state, 0)
    cost, audit = best(0, "", 0)
    state, i, out = "", 0, []
    name = {"u": "user", "a": "assistant"}
    for letter in audit:
        if letter in "IR":
            state = after[state]
            out.append((name[state], rows[i][1] if letter == "R" else ""))
        elif letter == "K":
            state = rows[i][0][:1]
            out.append(rows[i][:2])
        i += letter != "I"
    return cost, audit, out


def expected(rows):
    found = []
    for conv, kept in damaged(rows).items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        seen, marked = set(), []
        for _, role, text in kept:
            bare = text.strip(SPACE)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen else
                     "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[0] for r in kept if r[0] is not None]
        cost, audit, out = search(marked)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        count = lambda kind: sum(f == kind for _, _, f in marked)
        found.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"),
                      count("duplicate"), count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                      hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()))
    return found


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0]))


def run(spark, rows, **options):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, audit string, copies int")
    return repair.digests(repair.repair(repair.damage(table), **options)).collect()


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    found = queries.queries()["op11_repaired"](spark, SF)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                             "repaired_sha256"]
    assert ordered(found.collect()) == ordered(expected(rows))


def made(rng, conversations, most):
    texts = ["Yes.", "No!", "", " \t", "cut", "Why?", "More. ", "é.", "so\n", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "ant", None]
    rows = []
    for conv in conversations:
        for turn in range(rng.randint(0, most)):
            rows.append((conv, rng.choice([turn, turn, turn * 3, None]), rng.choice(roles), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece_rows", [1, 3, 7, 4096])
def test_any_cut_into_pieces_gives_the_same(spark, piece_rows):
    rows = made(random.Random(3), [*range(60), None], 12) + made(random.Random(4), [1000], 400)
    assert ordered(run(spark, rows, piece_rows=piece_rows)) == ordered(expected(rows))


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", f"Text {t}."])) for t in range(900)]
    rows += [(7, 5, "user", "Again.")] * 300 + [(c, 0, "user", "Hi.") for c in range(20)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
            "copies", repair.F.lit(1))
        pieces = repair.repair(table).where("conv_id = 7").select("part").distinct().count()
        found = run(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert pieces > 4
    assert ordered(found) == ordered(expected(rows))


def test_edges(spark):
    assert run(spark, []) == []
    dropped = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    empty = (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert [tuple(r) for r in run(spark, [(5, dropped, "user", "Hi.")])] == [empty]
    rows = [(None, None, None, None), (1, None, "user", "A."), (1, None, "user", "A."), (2, 3, "user", "x" * 200_000 + "."),
            (2, 4, "assistant", "y" * 3_000_000), (3, -(2**63), "user", "A."), (3, 2**63 - 1, "assistant", "B.")]
    found, wanted = ordered(run(spark, rows)), ordered(expected(rows))
    assert found[-1][0] == 3 and found[-1][1] in (None, wanted[-1][1])
    assert found[:-1] == wanted[:-1] and found[-1][2:] == wanted[-1][2:]


def test_block_tables_are_the_steps_of_their_symbols():
    made_tables = repair.tables()
    rng = np.random.default_rng(2)
    for _ in range(200):
        codes = rng.integers(0, repair.SYMBOLS, int(rng.integers(0, 23))).astype(np.uint8)
        at, cost = (int(x) for x in (rng.integers(len(made_tables.vectors)), 0))
        behind = at
        for symbol in codes[::-1]:
            cost += int(made_tables.gain[at, symbol])
            at = int(made_tables.step[at, symbol])
        assert repair.backwards(codes, behind)[1:] == (at, cost)
        assert repair.through(codes)[behind] == at
