"""Conversation repair against enumeration of all edits and against the SQL twin."""

import hashlib
import itertools
import random
import re

import duckdb
import pytest

from sparrowmill.llm import repair as module
from sparrowmill.llm.queries import ORACLES
from sparrowmill.llm.repair import RESULT, damaged, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
TEXTS = ["Yes.", "no", " \t\n", "", "What?\n", "x! ", "one\ntwo", "é😀", "\x1c.", "..."]
ROLES = ["system", "user", "assistant", "tool", "", "User", "unknown"]


def by_hand(rows):
    """All sequences of edits, with at most one insertion before a row and two at the end."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    choices = []
    for (role, text), fault in zip(rows, faults):
        own = [("D", 4, [])]
        if fault in ("", "truncated"):
            more = 3 if fault else 0
            own += [("K", more, [(role, text)])] + [("R", 3 + more, [(r, text)]) for r in ("user", "assistant")]
        inserted = [("", 0, [])] + [("I", 3, [(r, "")]) for r in ("user", "assistant")]
        choices.append([(a + b, c + d, x + y) for a, c, x in inserted for b, d, y in own])
    tails = [("", 0, [])] + [("I", 3, [(r, "")]) for r in ("user", "assistant")]
    tails += [("II", 6, [(r, ""), (q, "")]) for r in ("user", "assistant") for q in ("user", "assistant")]
    best = None
    for parts in itertools.product(*choices, tails):
        out = [row for p in parts for row in p[2]]
        if all(r for r, _ in out) and GRAMMAR.fullmatch("".join(r[0] for r, _ in out)):
            found = sum(p[1] for p in parts), "".join(p[0] for p in parts), "\n".join(f"{r}:{t}" for r, t in out)
            best = found if best is None else min(best, found)
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (*counts, illegal, best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest())


def test_against_all_edits(spark):
    rng = random.Random(5)
    given = {}
    for conv in range(120):
        turns = sorted(rng.sample(range(9), rng.randint(1, 3)))
        given[conv] = [(t, rng.choice(ROLES[:3] if conv % 3 else ROLES), rng.choice(TEXTS[:6] if conv % 2 else TEXTS)) for t in turns]
    rows = [(c, *r) for c, conv in given.items() for r in conv]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.conv_id: tuple(r)[1:] for r in repair(df).collect()}
    for conv, own in given.items():
        turns = [r[0] for r in own]
        assert got[conv] == (turns[-1] - turns[0] + 1 - len(turns), *by_hand([r[1:] for r in own])), own
    assert len(got) == len(given)


def odd_rows():
    rng = random.Random(9)
    pick = lambda values: rng.choice([*values, None])
    rows = [(pick(range(60)), pick(range(12)), pick(ROLES[:4]), pick([*TEXTS, "a longer sentence without an end"])) for _ in range(500)]
    rows += rows[:40] + [(70, None, None, None), (71, None, "user", "x."), (71, None, "user", "y."), (None, None, None, None)]
    rows += [(80, t, ["user", "assistant"][t % 2], f"text {t}." * (t % 50)) for t in range(3000)]
    return rows + [(81, 1, "user", "x" * 2_000_000), (81, 3, "assistant", "y. " * 500_000)]


def test_sql_twin_on_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    given = spark.createDataFrame([(*r, "e", 1, 2, True) for r in rows], SCHEMA + ", there string, repeats int, no_turn int, kind boolean")
    got = repair(damaged(given.repartition(5)), there=module.F.col("there")).toPandas()
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = con.sql(ORACLES["op12_conversation_repair"]).fetchall()
    show = lambda found: sorted(repr([None if v is None or v != v else v if isinstance(v, str) else int(v) for v in r]) for r in found)
    assert show(got[RESULT].itertuples(index=False)) == show(want)


def test_long_conversations_spill(spark, monkeypatch):
    rows = [(1, t, "user", f"{'long ' * 50}{t}.") for t in range(12_000)]
    got = repair(spark.createDataFrame(rows, SCHEMA)).first()
    assert got.gaps == 0 and got.illegal == 11_999 and len(got.audit) == 12_000 and got.cost == 6_000 * 3
    text = "\n".join(f"{['user', 'assistant'][t % 2]}:{r[3]}" for t, r in enumerate(rows))
    assert set(got.audit) == {"K", "R"} and got.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_and_dropped(spark):
    assert repair(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(5, 1, "user", "a.")], SCHEMA)
    got = repair(df, there=module.F.lit(False)).first()
    assert tuple(got) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_conversations_may_have_names(spark):
    df = spark.createDataFrame([("a", 1, "user", "x."), (None, 1, "user", "x.")], SCHEMA.replace("conv_id bigint", "conv_id string"))
    assert sorted(map(str, [r.conv_id for r in repair(df).collect()])) == ["None", "a"]


@pytest.mark.parametrize("rows", [0, 1])
def test_steps_are_few(rows):
    program = module.Program()
    rng = random.Random(rows)
    situation = program.start
    for _ in range(20_000):
        situation, _, _ = program.step(situation, rng.choice(["s", "u", "a", "x"]), rng.choice(module.FAULTS))
    assert len(program.steps) < 2_000
