"""Conversation repair: block tables against exhaustive search, odd rows, long conversations, and the SQL."""

import hashlib
import itertools
import random

import numpy as np
import pytest

import check_oracle
from llm import conversation_repair as repair

SF = "/root/testdata/sf0.001"
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
BLANKS = " \t\n\v\f\r"


def insert(best):
    for _ in range(3):
        for state, (cost, audit, lines) in list(best.items()):
            role, to = ("assistant", 3) if state == 2 else ("user", 2)
            option = (cost + 5, audit + "I", [*lines, f"{role}:"])
            best[to] = min(best.get(to, option), option)
    return best


def slow_repair(rows):
    """Least (cost, audit, lines) of each state, row by row; rows are (role, text, fault)."""

    best = {0: (0, "", [])}
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in insert(best).items():
            options = [(state, (cost + 2, audit + "D", lines))]
            if fault in ("", "truncated"):
                extra = 5 if fault else 0
                if (state, role[:1]) in STEPS:
                    options.append((STEPS[state, role[:1]], (cost + extra, audit + "K", [*lines, f"{role}:{text}"])))
                for new in ("user", "assistant"):
                    if (state, new[0]) in STEPS:
                        options.append((STEPS[state, new[0]], (cost + extra + 1, audit + "R", [*lines, f"{new}:{text}"])))
            for to, option in options:
                after[to] = min(after.get(to, option), option)
        best = after
    best = insert(best)
    return min(best[state] for state in (0, 3) if state in best)


def slow_report(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of (turn, role, text) in order."""

    judged, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = slow_repair(judged)
    counts = [sum(f == name for _, _, f in judged) for name in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def marked(mark):
    return ("system", "user", "assistant", "tool")[mark >> 2], "text", repair.FAULTS[mark & 3]


def test_block_tables_against_search():
    for n in range(5):
        for marks in itertools.product([0, 3, 4, 5, 7, 8, 11, 12, 14], repeat=n):
            assert repair.cheapest_audit(np.array(marks, np.uint8)) == slow_repair([marked(m) for m in marks])[:2]
    rng = random.Random(6)
    for _ in range(800):
        marks = [rng.randrange(16) for _ in range(rng.randrange(70))]
        assert repair.cheapest_audit(np.array(marks, np.uint8)) == slow_repair([marked(m) for m in marks])[:2]


def test_few_vectors_make_the_tables():
    tables = repair.tables()
    assert len(tables.vectors) < 50
    assert len(tables.block_to) == len(tables.vectors) and len(tables.block_to[0]) == 10**repair.BLOCK


CLASH = "conv_id long, turn long, role string, text string, n long, conv long, part int, report string, digest string, mark int"


def made(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, "x", "y", 4) for row in rows], CLASH)


def by_order(rows):
    """As the operator orders them: turn (nulls first), role, digest; null role or text is one space."""

    tidy = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(tidy, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))


def odd_conversations():
    return {
        1: [(None, "user", "a."), (None, "assistant", "b."), (3, None, None), (5, "user", ""), (5, "user", "")],
        2: [(0, "system", "s."), (1, "user", "u"), (2, "assistant", "a!"), (2, "assistant", "a!"), (7, "Übel", "x.")],
        3: [(0, "", "text."), (1, "user", " \n\t ")],
        None: [(1, "user", "hi?"), (2, "assistant", "汉字. \n")],
        4: [(k, "user" if k % 2 else "assistant", f"{k}.") for k in range(0, 40, 3)],
        5: [(1, "user", "long " * 60_000 + "."), (2, "user", "long " * 60_000 + ".")],
    }


def test_odd_rows(spark):
    rows = [(conv, *turn) for conv, turns in odd_conversations().items() for turn in turns]
    found = repair.conversation_reports(made(spark, rows).repartition(3))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    assert got == {conv: slow_report(by_order(turns)) for conv, turns in odd_conversations().items()}
    assert repair.conversation_reports(made(spark, rows).limit(0)).count() == 0
    assert repair.repaired_turns(made(spark, rows).limit(0)).count() == 0


def test_repaired_turns_follow_the_pattern(spark):
    rows = [(conv, *turn) for conv, turns in odd_conversations().items() for turn in turns]
    repaired = repair.repaired_turns(made(spark, rows)).collect()
    for conv, turns in odd_conversations().items():
        own = sorted((r for r in repaired if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        digest = hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest()
        assert digest == slow_report(by_order(turns))[-1]
        letters = "".join(r.role[0] for r in own)
        assert letters.removeprefix("s") == "ua" * (len(letters) // 2)


def test_copies_and_dropped_rows(spark):
    rows = [(1, 0, "user", "a.", 2), (1, 1, "assistant", "b.", 0), (2, 5, "user", "c.", 0), (3, 1, "user", "d.", None), (4, 1, "tool", "e.", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    got = {r.conv_id: tuple(r)[1:] for r in repair.conversation_reports(df, copies="copies").collect()}
    nothing = slow_report([])
    assert nothing == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {1: slow_report([(0, "user", "a.")] * 2), 2: nothing, 3: nothing, 4: slow_report([(1, "tool", "e.")])}


@pytest.mark.parametrize("same_turn", [False, True])
def test_a_conversation_with_most_rows_spans_partitions(spark, same_turn):
    rng = random.Random(8)
    turns = [(0 if same_turn else k // 2, rng.choice(["user", "assistant", "tool"]), rng.choice(["yes.", "no", "", f"{k}!", f"{k}"])) for k in range(6000)]
    rows = [(1, *turn) for turn in turns] + [(k, 0, "user", "x.") for k in range(2, 50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spread = repair._narrow(repair._tidy(df, "conv_id", "turn", "role", "text", None)).repartitionByRange(8, *repair._ORDER)
    assert spread.where("conv = 1").selectExpr("spark_partition_id() p").distinct().count() > 3
    got = {r.conv_id: tuple(r)[1:] for r in repair.conversation_reports(df).collect()}
    assert got[1] == slow_report(by_order(turns))
    assert len(got) == 49 and got[7] == slow_report([(0, "user", "x.")])


def test_query_matches_sql(spark):
    ((_, problem, count, _),) = check_oracle.compare(spark, check_oracle.connect(SF), SF, ["op13_conversation_repair"])
    assert problem is None and count > 0
