"""Conversation structure repair by a shortest path over big-integer weights.

The rows of a conversation are read in order of turn. A row may be kept, given
another role (user or assistant), or deleted, and empty user or assistant rows may
be inserted anywhere, so that the role initials read ``(s?(ua)+)?``. The cheapest
edits are a shortest path in a DAG whose nodes are (row, state of that pattern).

One integer is a path's whole weight: its high digits are the cost, and below them
stand ``width`` digits of three bits each, one for a letter of the audit (D, I, K,
R as 1 to 4 in ASCII order), first letter highest, with zeros at the end. Comparing
two weights as integers therefore compares costs first and then the audits in
ASCII order, a shorter one before its extensions. The nodes are settled from the
last row backwards: putting an edit before a path adds its cost, moves the letters
one digit down and sets the highest one; each node takes the least of its integers.

Rows are streamed: a first shuffle carries digests and marks only, not texts, and
brings a conversation's rows to one task in order; the second brings the texts and
the audit, which alone determines the repaired rows, and these are digested as they
pass. A task holds a few bytes a row of one conversation (and integers of six bits
a row), never its texts. The rows of one conversation are inherently one sequence.

Defined results: a NULL conv_id is a conversation of its own; NULL roles and texts
are one blank; rows of equal turn go by role, then digest of the text, and of equal
rows the second is a duplicate; NULL turns come first; a role's initial is its first character, so a role without characters
or with another initial than s, u, a must be given another or deleted; texts are
compared whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, materialize, table

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3   # costs
LETTERS = "_DIKR"                                 # digit of a letter is its place
BITS = 3
FINE, BLANK, DUPLICATE, CUT = range(4)
DROPPED = 4                                       # a row that only says that its conversation exists
LEGAL_PAIRS = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
# states: nothing yet, after the system row, after a user row, after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}   # role of an inserted or relabelled row


def cheapest_edits(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) for rows (initial, fault) by the integer-minimum DAG."""
    n = len(rows)
    width = 2 * n + 4                 # a row and an insertion before it each, a few more at the ends
    cost_unit = 1 << (BITS * width)
    letters = cost_unit - 1
    top = [d << (BITS * (width - 1)) for d in range(len(LETTERS))]
    never = cost_unit << 62

    def before(letter: str, cost: int, path: int) -> int:
        if path >= never:
            return never
        low = path & letters
        return path - low + cost * cost_unit + top[LETTERS.index(letter)] + (low >> BITS)

    def with_insertions(best: list[int]) -> list[int]:
        user = min(best[USER], before("I", INSERT, best[ASSISTANT]))
        assistant = min(best[ASSISTANT], before("I", INSERT, best[USER]))
        return [min(best[START], before("I", INSERT, user)), min(best[SYSTEM], before("I", INSERT, user)), user, assistant]

    paths = with_insertions([0, never, never, 0])
    for initial, fault in reversed(rows):
        best = []
        for state in range(4):
            ways = [before("D", DELETE, paths[state])]
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED if fault == CUT else 0
                if initial in NEXT[state]:
                    ways.append(before("K", more, paths[NEXT[state][initial]]))
                ways.append(before("R", RELABEL + more, paths[NEXT[state][WANTED[state]]]))
            best.append(min(ways))
        paths = with_insertions(best)
    path = paths[START]
    digits, audit = path & letters, []
    for place in range(width - 1, -1, -1):
        digit = (digits >> (BITS * place)) & 7
        if not digit:
            break
        audit.append(LETTERS[digit])
    return path >> (BITS * width), "".join(audit)


def apply_edits(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired conversation; the audit says all that is needed besides the rows."""
    state = START
    for letter in audit:
        role, text = ROLES[WANTED[state]], ""
        if letter != "I":
            old, text = next(rows)
            if letter == "D":
                continue
            if letter == "K":
                role = old
        state = NEXT[state][role[:1]]
        yield letter, role, text


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: rows with conv_id, turn, role, text, copy and dropped."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    draw = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return conversations.select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(role).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (draw == 0).alias("dropped"))


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form that :func:`plan_repairs` takes."""
    blank = F.lit(" ")
    return conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                                F.coalesce("text", blank).alias("text"), F.lit(0).alias("copy"), F.lit(False).alias("dropped"))


ORDER = ["conv_id", "turn", "role", "digest", "copy"]
PLAN = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _groups(batches, columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of equal conv_id in a sorted stream; a run must be used up before the next one."""
    def rows():
        for b in batches:
            yield from zip(b["conv_id"], *(b[c] for c in columns), strict=True)
    stream = rows()
    ahead = next(stream, None)

    def run(conv):
        nonlocal ahead
        while ahead is not None and ahead[0] == conv:
            row, ahead = ahead, next(stream, None)
            yield row[1:]
    while ahead is not None:
        conv = ahead[0]
        own = run(conv)
        yield conv, own
        for _ in own:
            pass


def _plan(conv, rows: Iterator[tuple]) -> dict[str, list]:
    coded, counts, illegal = [], [0] * 5, 0
    low = high = None
    n_turns, previous, last = 0, None, ""
    for turn, initial, fault in rows:
        counts[fault] += 1
        if fault == DROPPED:
            continue
        if turn is not None:
            if low is None:
                low = turn
            if turn != previous:
                n_turns, previous = n_turns + 1, turn
            high = turn
        if coded and last + initial not in LEGAL_PAIRS:
            illegal += 1
        last = initial
        coded.append((initial, fault))
    cost, audit = cheapest_edits(coded)
    return {"conv_id": [conv], "gaps": [0 if low is None else high - low + 1 - n_turns], "blank": [counts[BLANK]],
            "duplicate": [counts[DUPLICATE]], "truncated": [counts[CUT]], "illegal": [illegal], "cost": [cost],
            "audit": [audit]}


def plan_repairs(rows: DataFrame) -> DataFrame:
    """Per conversation its faults and cheapest edits; rows come from :func:`damage` or :func:`undamaged`."""
    said = r"[^\x20\x09-\x0D]"
    small = _with_digest(rows).select(
        "conv_id", "turn", "role", "copy", "digest", "dropped",
        F.when(~F.col("text").rlike(said), BLANK)
        .when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), FINE).otherwise(CUT).alias("fault"))
    # rows are dealt by conversation once; the window below sorts inside these partitions
    dealt = small.repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy(F.asc_nulls_first("turn"), "copy")
    fault = (F.when(F.col("dropped"), DROPPED).when(F.col("fault") == BLANK, BLANK)
             .when(F.col("nth") > 1, DUPLICATE).otherwise(F.col("fault")))
    marked = dealt.withColumn("nth", F.row_number().over(same)).withColumn("fault", fault)
    ordered = marked.sortWithinPartitions(*ORDER, "nth").select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault")

    def work(batches):
        for conv, own in _groups(batches, ["turn", "initial", "fault"]):
            yield _plan(conv, own)
    return materialize(map_batches(ordered, ["conv_id", "turn", "initial", "fault"], PLAN, work), "repair_plans")


def _plans_and_texts(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Plan row and text rows of each conversation in one task, in order."""
    first = plans.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.col("audit").alias("text"), F.lit(0).alias("copy"), F.lit(None).cast("binary").alias("digest"),
                         F.array(*COUNTS).alias("counts"))
    texts = _with_digest(rows.where(~F.col("dropped"))).select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "copy", "digest",
        F.lit(None).cast("array<bigint>").alias("counts"))
    return (first.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:])
            .select("conv_id", "role", "text", "counts"))


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit, role, text: the repaired conversations."""
    def work(batches):
        for conv, own in _groups(batches, ["role", "text"]):
            _, audit = next(own)
            out = []
            for place, row in enumerate(apply_edits(audit, own)):
                out.append((place, *row))
                if len(out) == 1024:
                    yield _turns(conv, out)
                    out = []
            yield _turns(conv, out)

    def _turns(conv, out):
        return {"conv_id": [conv] * len(out), "place": [o[0] for o in out], "edit": [o[1] for o in out],
                "role": [o[2] for o in out], "text": [o[3] for o in out]}
    return map_batches(_plans_and_texts(rows, plans), ["conv_id", "role", "text"],
                       "conv_id long, place long, edit string, role string, text string", work)


def repair_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans with the SHA-256 of each repaired conversation (``role:text``, joined by newlines)."""
    def work(batches):
        for conv, own in _groups(batches, ["role", "text", "counts"]):
            _, audit, counts = next(own)
            digest, sep = hashlib.sha256(), ""
            for _, role, text in apply_edits(audit, (r[:2] for r in own)):
                digest.update(f"{sep}{role}:{text}".encode("utf-8", "surrogatepass"))
                sep = "\n"
            yield {"conv_id": [conv], **{c: [n] for c, n in zip(COUNTS, counts, strict=True)}, "audit": [audit],
                   "repaired_sha256": [digest.hexdigest()]}
    return map_batches(_plans_and_texts(rows, plans), ["conv_id", "role", "text", "counts"],
                       PLAN + ", repaired_sha256 string", work)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: damage, faults, cheapest edits and the digest of the repaired conversation."""
    rows = damage(table(spark, sf_dir, "conversations"))
    return repair_digests(rows, plan_repairs(rows))


ORACLE = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (
  SELECT *, xor(list_reduce(flatten(list_transform(string_split(k, ''), lambda c: [CAST(ascii(c) AS BIGINT),
                -1, -1, -1, -1, -1, -1, -1, -1])),
                lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END,
                CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS draw FROM raw),
d AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM h, (VALUES (0), (1)) AS twice(copy) WHERE draw <> 0 AND (copy = 0 OR draw = 3)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy, nth) AS i
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM d)),
f AS MATERIALIZED (
  SELECT *, left(role, 1) AS c,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE 'f' END AS fault FROM o),
g AS (
  SELECT conv_id, max(i) AS n, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY conv_id),
a AS (
  SELECT conv_id, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM f) GROUP BY conv_id),
dp AS (
  SELECT conv_id, n + 1 AS i, {'c': 0, 'a': ''} AS s, {'c': 1000000000000, 'a': ''} AS t,
         {'c': 3, 'a': 'I'} AS u, {'c': 0, 'a': ''} AS v FROM g
  UNION ALL
  SELECT conv_id, i, list_min([s, {'c': w.c + 3, 'a': 'I' || w.a}]), list_min([t, {'c': w.c + 3, 'a': 'I' || w.a}]),
         w, list_min([v, {'c': u.c + 3, 'a': 'I' || u.a}])
  FROM (SELECT *, list_min([u, {'c': v.c + 3, 'a': 'I' || v.a}]) AS w FROM (
    SELECT f.conv_id, f.i,
      list_min([{'c': s.c + 4, 'a': 'D' || s.a}, {'c': u.c + 3 + k, 'a': 'R' || u.a},
                CASE c WHEN 's' THEN {'c': t.c + k, 'a': 'K' || t.a} WHEN 'u' THEN {'c': u.c + k, 'a': 'K' || u.a}
                ELSE {'c': 1000000000000, 'a': ''} END]) AS s,
      list_min([{'c': t.c + 4, 'a': 'D' || t.a}, {'c': u.c + 3 + k, 'a': 'R' || u.a},
                CASE c WHEN 'u' THEN {'c': u.c + k, 'a': 'K' || u.a} ELSE {'c': 1000000000000, 'a': ''} END]) AS t,
      list_min([{'c': u.c + 4, 'a': 'D' || u.a}, {'c': v.c + 3 + k, 'a': 'R' || v.a},
                CASE c WHEN 'a' THEN {'c': v.c + k, 'a': 'K' || v.a} ELSE {'c': 1000000000000, 'a': ''} END]) AS u,
      list_min([{'c': v.c + 4, 'a': 'D' || v.a}, {'c': u.c + 3 + k, 'a': 'R' || u.a},
                CASE c WHEN 'u' THEN {'c': u.c + k, 'a': 'K' || u.a} ELSE {'c': 1000000000000, 'a': ''} END]) AS v
    FROM dp JOIN (SELECT *, CASE fault WHEN 'f' THEN 0 WHEN 't' THEN 3 ELSE 1000000000000 END AS k FROM f) AS f
      ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i - 1))),
best AS (SELECT conv_id, s.c AS cost, s.a AS audit FROM dp WHERE i = 1),
e AS (SELECT conv_id, audit, unnest(string_split(audit, '')) AS letter,
             generate_subscripts(string_split(audit, ''), 1) AS p FROM best WHERE audit <> ''),
x AS (SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS i, count(*) FILTER (WHERE letter <> 'D') OVER w AS kept
      FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
y AS (SELECT x.*, f.role, f.text, max(CASE WHEN letter = 'K' AND kept = 1 AND f.c = 's' THEN 1 ELSE 0 END)
             OVER (PARTITION BY x.conv_id) AS led
      FROM x LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.i = x.i AND x.letter <> 'I'),
z AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (kept - led) % 2 = 1 THEN 'user'
             ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS body
      FROM y WHERE letter <> 'D' GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS b
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM b.conv_id
"""
