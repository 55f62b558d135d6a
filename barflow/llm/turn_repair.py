"""Cheapest repairs of conversations by depth-first branch and bound.

A conversation's rows are taken by turn (nulls first; of rows with one turn, by the MD5
of role and text). A row's first fault counts: blank (nothing but ASCII blanks),
duplicate (role and text seen earlier), truncated (its last other character is none of
``.!?``). Edits, and what they cost:

    K keep 0      R rerole to user or assistant 2      D delete 3 (must, where blank or
    I insert an empty user or assistant turn 2           duplicate)

and 1 for every truncated row that stays. What is left must have the role initials
``(s?(ua)+)?``. Of the cheapest edits those count whose initials, in order, come first in
ASCII (the audit). What may follow is told by a row's number and one of four states
(nothing yet, after a leading system turn, after a user, after an assistant), which make
a node; an audit fixes every role it gives.

``search`` holds the open branches in a list of its own (no recursion). A branch is cut

* by the suffix lower bound: the cost of the rows still to come in a relaxed problem, in
  which a lone system turn may end a conversation, added to its own cost is above the
  incumbent's, or equals it and the branch's initials come later than the incumbent's;
* by dominance: its node was reached before at less cost, or at the same cost by an
  audit that comes first. (Of two audits of one node and cost none begins the other, since
  they would differ by inserts, which cost; so their order stays with any common rest.)

Branches with the least bound go first, so that the first dive nearly always gives the
answer and the rest of the search proves it.

Texts move once. A first shuffle takes (conv_id, turn, digest, role initial, flags) to one
task a conversation, which searches and names the rows that stay; a second sorts these
before their texts, so that a conversation's repaired lines pass through a task in order
without ever being held together. A digest of a whole conversation is sequential, so a
conversation passes through one task however long it is: in streams that spill, but for
about 200 bytes a row of the conversation being searched.

Defined results: null roles and texts are one space; a null conv_id is a conversation of
its own; a conversation without rows has zeros, an empty audit and no lines; identical rows
are duplicates of the first; an empty table gives empty results. Columns other than
conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from barflow.llm.common import Scratch

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
LEGAL = {"su", "ua", "au"}
START, LEAD, USER, REPLY = range(4)      # nothing yet; after a system, a user, an assistant turn
NEEDED = {START: "user", LEAD: "user", USER: "assistant", REPLY: "user"}
AFTER = {"user": USER, "assistant": REPLY}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def keeps(state: int, initial: str) -> int | None:
    """The state after a kept row of that role initial, if it may stay."""
    if initial == NEEDED[state][0]:
        return AFTER[NEEDED[state]]
    return LEAD if initial == "s" and state == START else None


def suffix_bounds(rows: list[tuple[str, int]]) -> list[tuple[int, int, int]]:
    """For each place the least cost of the rows from there on, in the relaxed problem:
    with nothing yet, after a user turn, and after an assistant or system turn."""
    fresh, user, even = 0, 2, 0
    out = [(fresh, user, even)]
    for initial, fault in reversed(rows):
        f, u, e = fresh + 3, user + 3, even + 3
        if fault not in (BLANK, DUPLICATE):
            late = fault == TRUNCATED
            as_user, as_reply = late + user, late + even
            f = min(f, as_user if initial == "u" else as_reply if initial == "s" else as_user + 2, as_user + 2)
            u = min(u, as_reply if initial == "a" else as_reply + 2)
            e = min(e, as_user if initial == "u" else as_user + 2)
        fresh, user, even = min(f, u + 2), min(u, e + 2), min(e, u + 2)
        out.append((fresh, user, even))
    out.reverse()
    return out


def written(branch: tuple | None) -> str:
    """The audit of a linked branch."""
    out = []
    while branch:
        branch, letter = branch
        out.append(letter)
    return "".join(reversed(out))


def search(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of rows (role initial, fault)."""
    n = len(rows)
    bounds = suffix_bounds(rows)
    reached: dict[tuple[int, int], tuple[int, tuple | None]] = {}      # by node: least cost, its branch
    best, audit = 3 * n, "D" * n
    path: list[str] = []
    same = 0            # how far the path and the incumbent's audit agree

    def bound(i: int, state: int) -> int:
        return bounds[i][0 if state == START else 1 if state == USER else 2]

    def moves(i: int, state: int, cost: int) -> list[tuple[int, str, int, int, int]]:
        """(bound, letter, place, state, cost) of the branches of a node, the first to follow last."""
        out = []
        into = AFTER[NEEDED[state]]
        if i < n:
            initial, fault = rows[i]
            out.append(("D", i + 1, state, cost + 3))
            if fault not in (BLANK, DUPLICATE):
                late = fault == TRUNCATED
                after = keeps(state, initial)
                if after is not None:
                    out.append(("K", i + 1, after, cost + late))
                out.append(("R", i + 1, into, cost + late + 2))
        out.append(("I", i, into, cost + 2))
        return sorted(((c + bound(j, s), letter, j, s, c) for letter, j, s, c in out), reverse=True)

    # a frame: its node's branch, its open moves
    stack = [(None, moves(0, START, 0) if n else [])]
    while stack:
        branch, todo = stack[-1]
        if not todo:
            stack.pop()
            if path:
                path.pop()
                same = min(same, len(path))
            continue
        least, letter, i, state, cost = todo.pop()
        at = len(path)
        if least > best:
            todo.clear()         # the others' bounds are no lower
            continue
        agree = same == at and at < len(audit) and audit[at] == letter
        if least == best and not agree:
            # the first letter that differs decides
            mine, other = (path[same], audit[same]) if same < at else (letter, audit[at:at + 1])
            if mine > other:
                continue
        known = reached.get((i, state))
        if known and (known[0] < cost or known[0] == cost and written(known[1]) <= "".join(path) + letter):
            continue
        step = (branch, letter)
        reached[i, state] = cost, step
        path.append(letter)
        same = at + 1 if agree else same
        if i == n and state in (START, REPLY) and (cost < best or "".join(path) < audit):
            best, audit, same = cost, "".join(path), len(path)
        stack.append((step, moves(i, state, cost)))
    return best, audit


def survivors(audit: str, roles: list[str]) -> list[tuple[int, str | None, list[str], list[str]]]:
    """(row, new role or None, roles inserted before, roles inserted at the end) of rows that stay."""
    state, row = START, 0
    out: list[tuple[int, str | None, list[str], list[str]]] = []
    inserted: list[str] = []
    for letter in audit:
        role = NEEDED[state]
        if letter == "I":
            inserted.append(role)
            state = AFTER[role]
            continue
        if letter != "D":
            out.append((row, role if letter == "R" else None, inserted, []))
            inserted = []
            state = AFTER[role] if letter == "R" else keeps(state, roles[row])
        row += 1
    if out:
        out[-1][3].extend(inserted)
    return out


def faults(turns: list[int | None], rows: list[tuple[str, int]]) -> dict[str, int]:
    known = [t for t in turns if t is not None]
    kinds = [fault for _, fault in rows]
    return {"gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
            "blank": kinds.count(BLANK), "duplicate": kinds.count(DUPLICATE), "truncated": kinds.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for (a, _), (b, _) in pairwise(rows))}


def flagged(rows: DataFrame, present: Column) -> DataFrame:
    """conv_id, turn, role, text, digest, present: nulls of role and text are one space."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       F.unhex(F.md5(F.concat(role, F.lit("\0"), text))).alias("digest"),
                       present.alias("present"))


def coded(rows: DataFrame) -> DataFrame:
    """Each row's place in its conversation, role initial and first fault."""
    said = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    small = rows.select(
        "conv_id", "turn", "digest", "present", F.substring("role", 1, 1).alias("initial"),
        F.when(F.length(said) == 0, BLANK).when(~F.substring(said, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(0).alias("own")).repartition("conv_id")
    by_turn = [F.col("turn").asc_nulls_first(), F.col("digest")]
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest", "present").orderBy(*by_turn))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(*by_turn))
    return (small.withColumn("seen", seen).withColumn("place", place)
            .select("conv_id", "turn", "digest", "present", "initial", "place",
                    F.when((F.col("own") != BLANK) & (F.col("seen") > 1), DUPLICATE)
                    .otherwise(F.col("own")).alias("fault"))
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place"))


def solved(out_schema: pa.Schema):
    """A pass over sorted, coded rows: a summary for each conversation, then its rows that stay."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = out_schema.names
        out: dict[str, list] = {c: [] for c in names}
        conv, turns, rows, digests, begun = None, [], [], [], False

        def put(**values) -> None:
            for c in names:
                out[c].append(values.get(c))

        def finish() -> None:
            cost, audit = search(rows)
            put(conv_id=conv, rank=0, audit=audit, cost=cost, **faults(turns, rows))
            for row, role, before, after in survivors(audit, [initial for initial, _ in rows]):
                put(conv_id=conv, rank=1, turn=turns[row], digest=digests[row], kind=0, new_role=role,
                    before=before, after=after)

        def batch() -> pa.RecordBatch:
            ready = pa.RecordBatch.from_pydict(out, schema=out_schema)
            for c in names:
                out[c] = []
            return ready

        for part in batches:
            columns = (part.column(c).to_pylist()
                       for c in ("conv_id", "turn", "digest", "present", "initial", "place", "fault"))
            for c, turn, digest, present, initial, place, fault in zip(*columns):
                if place == 1:
                    if begun:
                        finish()
                    if len(out["rank"]) > 10_000:
                        yield batch()
                    conv, turns, rows, digests, begun = c, [], [], [], True
                if present:
                    turns.append(turn)
                    rows.append((initial, fault))
                    digests.append(digest)
        if begun:
            finish()
        yield batch()

    return solve


def conversation_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, tuple[str, str] | None]]:
    """(summary, None) where a conversation begins, then (None, (role, text)) of its repaired lines."""
    stays = None         # the row that stays, until its text has come
    for part in batches:
        for row in part.to_pylist():
            if row["rank"] == 0:
                stays = None
                yield row, None
            elif row["kind"] == 0:
                stays = row
            elif stays and (row["turn"], row["digest"]) == (stays["turn"], stays["digest"]):
                yield from ((None, (role, "")) for role in stays["before"])
                yield None, (stays["new_role"] or row["role"], row["text"])
                yield from ((None, (role, "")) for role in stays["after"])
                stays = None


class Repair:
    """The repair of ``rows`` (conv_id, turn, role, text).

    Rows that are not ``present`` only name their conversation.
    """

    def __init__(self, rows: DataFrame, present: Column | None = None):
        self.rows = flagged(rows, F.lit(True) if present is None else present)
        self.conv = self.rows.schema["conv_id"]
        counts = ", ".join(f"{c} long" for c in COUNTS)
        schema = (f"rank int, turn long, digest binary, kind int, new_role string, before array<string>, "
                  f"after array<string>, {counts}, audit string")
        schema = StructType([StructField("conv_id", self.conv.dataType), *StructType.fromDDL(schema).fields])
        self.edits = Scratch(rows.sparkSession, "turn-repair").cut(
            coded(self.rows).mapInArrow(solved(to_arrow_schema(schema)), schema))

    def summary(self) -> DataFrame:
        """conv_id, the counts of faults, cost and audit: a row for each conversation."""
        return self.edits.where("rank = 0").select("conv_id", *COUNTS, "audit")

    def _in_order(self) -> DataFrame:
        """Summaries, rows that stay and texts, each conversation's in order in one partition."""
        texts = self.rows.where("present").select("conv_id", F.lit(1).alias("rank"), "turn", "digest",
                                                  F.lit(1).alias("kind"), "role", "text")
        return (self.edits.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
                .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "rank",
                                      F.col("turn").asc_nulls_first(), "digest", "kind"))

    def turns(self) -> DataFrame:
        """conv_id, place, role, text: the repaired rows."""
        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, conv, place = [], None, 0
            for summary, line in conversation_lines(batches):
                if summary:
                    conv, place = summary["conv_id"], 0
                    continue
                held.append({"conv_id": conv, "place": place, "role": line[0], "text": line[1]})
                place += 1
                if len(held) == 1000:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)
                    held = []
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

        schema = StructType([self.conv, *StructType.fromDDL("place long, role string, text string").fields])
        arrow = to_arrow_schema(schema)
        return self._in_order().mapInArrow(put, schema)

    def digests(self) -> DataFrame:
        """The summary and the SHA-256 of the repaired ``role:text`` lines, joined by newlines."""
        fields = [self.conv, *StructType.fromDDL(
            ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string").fields]
        schema = StructType(fields)

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, now, sha, first = [], None, None, True
            for summary, line in conversation_lines(batches):
                if summary:
                    if now:
                        held.append(now | {"repaired_sha256": sha.hexdigest()})
                    if len(held) >= 10_000:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held = []
                    now, sha, first = {c: summary[c] for c in names}, hashlib.sha256(), True
                    continue
                sha.update(("" if first else "\n").encode() + f"{line[0]}:{line[1]}".encode("utf-8", "surrogatepass"))
                first = False
            if now:
                held.append(now | {"repaired_sha256": sha.hexdigest()})
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

        arrow = to_arrow_schema(schema)
        names = schema.names[:-1]
        return self._in_order().mapInArrow(digest, schema)


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with faults planted by crc32(``conv_id:turn``) % 20, and which of them are there.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its
    role user; nulls are one space. Dropped rows stay, marked, to name their conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c)
                     for c in ("conv_id", ":", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    out = rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault != 0).alias("there"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return out.drop("copy"), F.col("there")
