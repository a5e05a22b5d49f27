import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from basketry.llm import op12_repair as rep

GOOD = re.compile(r"(s?(ua)+)?\Z")
OPEN = re.compile(r"(s?(ua)*u?)\Z")   # what may still become good


def brute_edits(rows):
    """Least (cost, audit) over every sequence of edits that costs no more than deleting everything."""
    best = (4 * len(rows), "D" * len(rows))

    def go(i, initials, audit, cost):
        nonlocal best
        if cost > best[0] or not OPEN.match(initials):
            return
        if i == len(rows):
            if GOOD.match(initials):
                best = min(best, (cost, audit))
        else:
            c, fault = rows[i]
            go(i + 1, initials, audit + "D", cost + 4)
            if fault not in (rep.BLANK, rep.DUPLICATE):
                more = 3 if fault == rep.CUT else 0
                go(i + 1, initials + (c or "?"), audit + "K", cost + more)
                for r in "ua":
                    go(i + 1, initials + r, audit + "R", cost + 3 + more)
        for r in "ua":
            go(i, initials + r, audit + "I", cost + 3)
    go(0, "", "", 0)
    return best


def test_cheapest_edits_of_all_short_conversations():
    kinds = [("s", 0), ("u", 0), ("a", 0), ("x", 0), ("u", 1), ("s", 3), ("u", 3), ("a", 3)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert rep.cheapest_edits(list(rows)) == brute_edits(list(rows)), rows
    rng = random.Random(4)
    for _ in range(60):
        rows = [rng.choice(kinds + [("a", 2), ("", 0)]) for _ in range(rng.randrange(4, 6))]
        assert rep.cheapest_edits(rows) == brute_edits(rows), rows


def test_long_conversations_and_edits_that_apply():
    rng = random.Random(8)
    rows = [(rng.choice("uaus"), rng.choice([0, 0, 0, 1, 3])) for _ in range(3000)]
    cost, audit = rep.cheapest_edits(rows)
    texts = iter([({"u": "user", "a": "assistant", "s": "system"}[c], str(i)) for i, (c, _) in enumerate(rows)])
    out = list(rep.apply_edits(audit, texts))
    assert next(texts, None) is None and GOOD.match("".join(role[0] for _, role, _ in out))
    charged = {"I": 3, "D": 4, "R": 3, "K": 0}
    kept = [f for (_, f), e in zip(rows, audit.replace("I", ""), strict=True) if e != "D"]
    assert cost == sum(charged[e] for e in audit) + 3 * kept.count(rep.CUT)
    assert rep.cheapest_edits([]) == (0, "")


def brute(conversations):
    """The contract in plain Python."""
    groups = defaultdict(list)
    for conv, turn, role, text in conversations:
        own = groups[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if draw == 3 else 1)
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, rows = set(), []
        for _, role, text in own:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = (rep.BLANK if not said else rep.DUPLICATE if (role, text) in seen
                     else rep.CUT if said[-1] not in ".!?" else rep.FINE)
            seen.add((role, text))
            rows.append((role[:1], fault))
        turns = [t for t, _, _ in own if t is not None]
        count = [f for _, f in rows].count
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(rows))
        cost, audit = brute_edits(rows)
        body = "\n".join(f"{r}:{t}" for _, r, t in rep.apply_edits(audit, iter([o[1:] for o in own])))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count(rep.BLANK), count(rep.DUPLICATE),
                     count(rep.CUT), illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())
    return out


def conversations(seed=5, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(1, 6)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2]),
                         rng.choice(["user", "assistant", "system", "user", "tool", "", None, "Anna"]),
                         rng.choice(["Fine.", "cut off", "Why? \n", " \t", "", None, "Ünï!", "a:b\nc."])))
    return rows + [(7, 1, "user", "Fine."), (7, 1, "user", "Fine.")]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_rows_follow_the_contract(spark):
    rows = conversations()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("digest", "copy", "kind", "counts", "fault", "nth", "dropped"):
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit("x"))
    damaged = rep.damage(df)
    got = {r.conv_id: tuple(r)[1:] for r in rep.repair_digests(damaged, rep.plan_repairs(damaged)).collect()}
    assert got == brute(rows)


def test_repaired_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "You there?"), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "Hm."),
            (3, 5, "system", "Be kind."), (3, 7, "user", "Go on."), (3, 8, "assistant", "Well, no")]
    df = rep.undamaged(spark.createDataFrame(rows, SCHEMA))
    plans = rep.plan_repairs(df)
    got = defaultdict(list)
    for r in sorted(rep.repaired_rows(df, plans).collect()):
        got[r.conv_id].append((r.edit, r.role, r.text))
    assert got[1] == [("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "You there?"), ("K", "assistant", "Yes.")]
    assert got[2] == [("I", "user", ""), ("K", "assistant", "Hm.")]
    assert [r[:2] for r in got[3]] == [("K", "system"), ("K", "user"), ("K", "assistant")]
    assert {r.conv_id: (r.gaps, r.truncated, r.cost) for r in plans.collect()} == {1: (0, 0, 3), 2: (0, 0, 3), 3: (1, 1, 3)}
    nothing = rep.undamaged(spark.createDataFrame([], SCHEMA))
    assert rep.plan_repairs(nothing).count() == 0
    assert rep.repair_digests(nothing, rep.plan_repairs(nothing)).count() == 0


def test_texts_are_dealt_once_by_conversation(spark):
    df = rep.undamaged(spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA))
    plan = rep._plans_and_texts(df, rep.plan_repairs(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
