"""Repair of conversation structure by the cheapest edits.

A conversation's rows must become an optional system turn followed by user / assistant pairs
(or nothing).  The edits are Keep, Rerole, Delete and Insert.  Their lattice has a
node per number of rows used up and state of the role pattern; every edit is an edge with a cost.

A bidirectional Dijkstra search runs over that lattice: a forward heap from the start and a reverse
heap from the two goals.  Once they meet, both go on until the sum of their
least open distances is above the best cost, so every crossing of equal cost is known.  Of all cheapest paths
through those crossings, the one whose audit (the concatenated edit initials) is least in
ASCII order is walked from the start.

Rows come to the search as a sorted stream, first all rows of a conversation without their texts, then with
them: the search needs a few bytes a row, and the texts only pass through the hash of the
repaired conversation.  One conversation is one audit and one sequential hash, so one task goes
over it; a third of all rows in one conversation cost that task its sort (which spills), about
150 bytes a row and no text.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
SPACE = " \t\n\x0b\x0c\r"
# States of the role pattern: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
GOALS = (START, ASSISTANT)
AFTER = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
# The state after the only turn that may be made up in a state: an assistant turn after a user turn, else a user turn.
MADE = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
FAR = 2**31 - 1


class Lattice:
    """Edges of the edit lattice; node ``4 * rows used + state``.

    ``initials`` has the first character of each row's role, ``drop`` whether it must be
    deleted, ``cut`` whether it is truncated.
    """

    def __init__(self, initials: list[str], drop: list[bool], cut: list[bool]):
        self.initials, self.drop, self.cut = initials, drop, cut
        self.rows = len(initials)

    def goals(self) -> list[int]:
        return [4 * self.rows + q for q in GOALS]

    def out(self, node: int) -> Iterator[tuple[str, int, int]]:
        """(edit initial, cost, next node), by initial."""
        i, q = divmod(node, 4)
        open_ = i < self.rows
        if open_:
            yield "D", DELETE, node + 4
        yield "I", INSERT, 4 * i + MADE[q]
        if open_ and not self.drop[i]:
            cut = TRUNCATED * self.cut[i]
            kept = AFTER.get(self.initials[i], {}).get(q)
            if kept is not None:
                yield "K", KEEP + cut, 4 * (i + 1) + kept
            yield "R", REROLE + cut, 4 * (i + 1) + MADE[q]

    def into(self, node: int) -> Iterator[tuple[int, int]]:
        """(cost, previous node)."""
        i, q = divmod(node, 4)
        makers = [p for p in range(4) if MADE[p] == q]
        for p in makers:
            yield INSERT, 4 * i + p
        if not i:
            return
        yield DELETE, node - 4
        if not self.drop[i - 1]:
            cut = TRUNCATED * self.cut[i - 1]
            for p in makers:
                yield REROLE + cut, 4 * (i - 1) + p
            for p, after in AFTER.get(self.initials[i - 1], {}).items():
                if after == q:
                    yield KEEP + cut, 4 * (i - 1) + p


def cheapest_edits(lattice: Lattice) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits; of equal ones that with the ASCII-least audit."""
    nodes = 4 * (lattice.rows + 1)
    ahead, back = array("i", [FAR]) * nodes, array("i", [FAR]) * nodes  # settled distances
    forward, reverse = [(0, 0)], [(0, g) for g in lattice.goals()]
    heapq.heapify(reverse)
    settled, best = [], FAR
    while forward and reverse and forward[0][0] + reverse[0][0] <= best:
        if forward[0] <= reverse[0]:
            far, node = heapq.heappop(forward)
            if ahead[node] <= far:
                continue
            ahead[node] = far
            settled.append(node)
            best = min(best, far + back[node])
            for _, cost, nxt in lattice.out(node):
                if ahead[nxt] > far + cost:
                    heapq.heappush(forward, (far + cost, nxt))
                    best = min(best, far + cost + back[nxt])
        else:
            far, node = heapq.heappop(reverse)
            if back[node] <= far:
                continue
            back[node] = far
            best = min(best, far + ahead[node])
            for cost, prev in lattice.into(node):
                if back[prev] > far + cost:
                    heapq.heappush(reverse, (far + cost, prev))
                    best = min(best, far + cost + ahead[prev])
    goals = set(lattice.goals())
    # forward nodes that lie on a cheapest path, from the crossings backwards; edges without cost lead to later
    # nodes, so the order of settling is an order of the paths
    on_path = bytearray(nodes)

    def leads(far: int, cost: int, nxt: int) -> bool:
        return far + cost + back[nxt] == best or bool(on_path[nxt] and ahead[nxt] == far + cost)

    for node in reversed(settled):
        far = ahead[node]
        on_path[node] = (node in goals and far == best) or any(leads(far, c, n) for _, c, n in lattice.out(node))
    audit, node, far = [], 0, 0
    while not (node in goals and far == best):
        edit, cost, node = next(e for e in lattice.out(node) if leads(far, e[1], e[2]))
        far += cost
        audit.append(edit)
    return best, "".join(audit)


class _Conversation:
    """Faults and edits of one conversation while its sorted rows stream by."""

    def __init__(self, conv):
        self.conv = conv
        self.turns, self.low, self.high = 0, None, None
        self.roles: list[str] = []
        self.blank, self.cut = [], []
        self.keys = array("q")
        self.audit: str | None = None

    def add(self, turn, role: str, blank: bool, cut: bool, h1: int, h2: int) -> None:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        self.roles.append(role[:1])
        self.blank.append(blank)
        self.cut.append(cut)
        self.keys.extend((h1, h2))

    def solve(self) -> None:
        rows = len(self.roles)
        first = np.zeros(rows, bool)
        if rows:
            pairs = np.frombuffer(self.keys, np.int64).reshape(-1, 2)
            first[np.unique(pairs, axis=0, return_index=True)[1]] = True
        repeat = [not b and not f for b, f in zip(self.blank, first.tolist(), strict=True)]
        drop = [b or r for b, r in zip(self.blank, repeat, strict=True)]
        self.gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        self.counts = sum(self.blank), sum(repeat), sum(c and not d for c, d in zip(self.cut, drop, strict=True))
        self.illegal = sum(a + b not in LEGAL for a, b in zip(self.roles, self.roles[1:]))
        self.cost, self.audit = cheapest_edits(Lattice(self.roles, drop, self.cut))
        self.keys = self.blank = self.cut = None
        self.at, self.state, self.lines, self.hash = 0, START, 0, sha256()

    def _line(self, line: str) -> None:
        self.hash.update(("\n" + line if self.lines else line).encode())
        self.lines += 1

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = MADE[self.state]
            self._line(NAMES[self.state] + ":")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        """The next row with its text, after ``solve``."""
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = AFTER[role[:1]][self.state]
            self._line(f"{role}:{text}")
        elif edit == "R":
            self.state = MADE[self.state]
            self._line(f"{NAMES[self.state]}:{text}")

    def result(self) -> tuple:
        if self.audit is None:
            self.solve()
        self._inserted()
        return (self.conv, self.gaps, *self.counts, self.illegal, self.cost, self.audit, self.hash.hexdigest())


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done, schema = None, [], None

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema, strict=True)], names=RESULT)

    for batch in batches:
        if schema is None:
            schema = [batch.schema.field("conv").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = [batch.column(c).to_pylist() for c in ("conv", "phase", "turn", "role", "blank", "cut", "h1", "h2", "text")]
        for conv, phase, turn, role, blank, cut, h1, h2, text in zip(*columns, strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv)
            if phase == 0:
                now.add(turn, role, blank, cut, h1, h2)
            elif phase == 1:
                if now.audit is None:
                    now.solve()
                now.text(role, text)
        if len(done) >= 1000:
            yield flush()
            done = []
    if now is not None:
        done.append(now.result())
        yield flush()


def damaged(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text`` with one fault per row chosen by crc32(``conv:turn``) % 20, as entries of the sorted stream.

    A dropped row leaves an entry of phase 2, so its conversation still has a result; any other row
    has one without its text (phase 0) and one with it (phase 1), twice if it is repeated.
    """

    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    marked = rows.select("conv", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    faulty = marked.select("conv", "turn", role.alias("role"), text.alias("text"), "fault").withColumn(
        "end", F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    )
    faulty = faulty.select(
        "conv", "turn", "role", "text", "fault",
        (F.col("end") == "").alias("blank"),
        (~F.col("end").isin("", ".", "!", "?")).alias("cut"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64("text", F.lit("second"), "role").alias("h2"),
    )
    narrow = F.struct(F.lit(0).alias("phase"), F.lit(None).cast("string").alias("text"))
    whole = F.struct(F.lit(1).alias("phase"), F.col("text").alias("text"))
    gone = F.struct(F.lit(2).alias("phase"), F.lit(None).cast("string").alias("text"))
    entries = (
        F.when(F.col("fault") == 0, F.array(gone)).when(F.col("fault") == 3, F.array(narrow, narrow, whole, whole)).otherwise(F.array(narrow, whole))
    )
    return faulty.withColumn("entry", F.explode(entries)).select(
        "conv", "entry.phase", "turn", "role", "blank", "cut", "h1", "h2", "entry.text"
    )


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Damage and repair of every conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Null role and text are one space (so blank), a null conversation id is a conversation of its own, null
    turns come first and do not count for gaps.  Rows of one turn come by role, then by a hash of (role, text);
    repeated rows are equal and lie together, all but the first are duplicates.  A role counts by its first
    character; an empty role is never legal.  Texts are compared by 128 bits of hash.  A
    conversation that lost all rows has zeros, an empty audit and the hash of the empty string.  Other columns are not
    read; an empty table gives no rows.
    """
    named = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    conv_type = rows.schema[conv_col].dataType
    kinds = [conv_type, *[T.LongType()] * 6, T.StringType(), T.StringType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(RESULT, kinds, strict=True)])
    in_order = [F.col("conv"), F.col("phase"), F.col("turn").asc_nulls_first(), "role", "h1", "h2"]
    return damaged(named).repartition("conv").sortWithinPartitions(*in_order).mapInArrow(_repaired, schema)


def oracle() -> str:
    """The result as DuckDB SQL: a table of cheapest prefixes, row after row, by a recursive query."""
    return r"""
WITH RECURSIVE
k AS (SELECT *, list_transform(list_filter(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
    lambda x: x <> ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes FROM conversations),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
    list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384::BIGINT * (a & 1)))),
    4294967295::BIGINT) % 20 AS fault FROM k),
g AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS again FROM h WHERE fault <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS last_char FROM g),
m AS (SELECT *, last_char = '' AS is_blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_again FROM n),
r AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS ini, is_blank, NOT is_blank AND is_again AS is_dup,
  NOT is_blank AND NOT is_again AND last_char NOT IN ('.', '!', '?') AS is_cut,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM m),
ins(q0, q1, c, a, t) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'), (3, 2, 2, 'I', chr(10) || 'user:'), (2, 3, 2, 'I', chr(10) || 'assistant:'),
  (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
moves(ini, q0, q1) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
dp AS (
  SELECT x.conv_id, CAST(0 AS BIGINT) AS i, ins.q1 AS q, CAST(ins.c AS BIGINT) AS cost, ins.a AS audit, ins.t AS made
  FROM (SELECT DISTINCT conv_id FROM conversations) x, ins WHERE ins.q0 = 0
  UNION ALL
  SELECT conv_id, i, q, min(cost), arg_min(audit, lpad(CAST(cost AS VARCHAR), 9, '0') || audit), arg_min(made, lpad(CAST(cost AS VARCHAR), 9, '0') || audit)
  FROM (
    SELECT e.conv_id, e.i, ins.q1 AS q, e.cost + ins.c AS cost, e.audit || ins.a AS audit, e.made || ins.t AS made
    FROM (
      SELECT dp.conv_id, r.i, s.q1, dp.cost + s.c AS cost, dp.audit || s.a AS audit, dp.made || s.t AS made
      FROM dp JOIN r ON dp.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = dp.i + 1,
      LATERAL (
        SELECT dp.q AS q1, 3 AS c, 'D' AS a, '' AS t
        UNION ALL SELECT moves.q1, CAST(r.is_cut AS INTEGER), 'K', chr(10) || r.role || ':' || r.text FROM moves
          WHERE moves.ini = r.ini AND moves.q0 = dp.q AND NOT r.is_blank AND NOT r.is_dup
        UNION ALL SELECT CASE WHEN dp.q = 2 THEN 3 ELSE 2 END, 2 + CAST(r.is_cut AS INTEGER), 'R',
          chr(10) || (CASE WHEN dp.q = 2 THEN 'assistant' ELSE 'user' END) || ':' || r.text WHERE NOT r.is_blank AND NOT r.is_dup
      ) s
    ) e JOIN ins ON ins.q0 = e.q1
  ) GROUP BY conv_id, i, q),
f AS (SELECT conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_dup) AS duplicate, count(*) FILTER (is_cut) AS truncated,
  count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
z AS (SELECT c.conv_id, coalesce(n, 0) AS n, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN f ON c.conv_id IS NOT DISTINCT FROM f.conv_id),
b AS (SELECT conv_id, i, cost, audit, made, row_number() OVER (PARTITION BY conv_id, i ORDER BY cost, audit) AS place FROM dp WHERE q IN (0, 3))
SELECT z.conv_id, CAST(gaps AS BIGINT) AS gaps, CAST(blank AS BIGINT) AS blank, CAST(duplicate AS BIGINT) AS duplicate, CAST(truncated AS BIGINT) AS truncated,
  CAST(illegal AS BIGINT) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(substr(made, 2)) AS repaired_sha256
FROM z JOIN b ON z.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = z.n AND b.place = 1"""
