"""Branch and bound against a best-first search, and the whole query against plain Python."""

import hashlib
import heapq
import random
import zlib

from barflow.llm import turn_repair
from barflow.llm.queries import op12_turn_repair
from barflow.llm.turn_repair import BLANK, DUPLICATE, TRUNCATED, Repair, search
from tests.llm.samples import SF_MID

CONVERSATIONS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit) by taking states in the order of (cost, audit)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        need = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, need))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if fault not in (BLANK, DUPLICATE):
                late = int(fault == TRUNCATED)
                heapq.heappush(heap, (cost + late + 2, audit + "R", i + 1, need))
                if initial == need or initial == "s" and last == "":
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, initial))


def lines_of(rows, audit):
    out, i, last = [], 0, ""
    for letter in audit:
        need = "assistant" if last == "u" else "user"
        if letter == "I":
            out.append(f"{need}:")
            last = need[0]
            continue
        role, text = rows[i]
        i += 1
        if letter == "D":
            continue
        role = need if letter == "R" else role
        out.append(f"{role}:{text}")
        last = role[0]
    return out


def expected(rows):
    """conv_id -> the columns of the contract, from whole conversations."""
    convs = {}
    for c, t, role, text in rows:
        kept = convs.setdefault(c, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(x for x in text if x not in ".!?")
        if fault == 4:
            role = "user"
        kept.extend([(t, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    out = {}
    for c, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))
        seen, coded = set(), []
        for _, role, text in kept:
            said = text.rstrip(BLANKS)
            fault = BLANK if not said else DUPLICATE if (role, text) in seen else 0
            if not fault and said[-1] not in ".!?":
                fault = TRUNCATED
            seen.add((role, text))
            coded.append((role[:1], fault))
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit = cheapest(coded)
        lines = lines_of([(r, t) for _, r, t in kept], audit)
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                  *[sum(f == kind for _, f in coded) for kind in (BLANK, DUPLICATE, TRUNCATED)],
                  sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:])),
                  cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_search_finds_the_cheapest_and_first_audit():
    rng = random.Random(5)
    for _ in range(4000):
        weights = rng.choice([(1, 4, 4, 1), (4, 1, 1, 1), (1, 1, 1, 1), (0, 5, 1, 0)])
        rows = [(rng.choices("sua ", weights)[0], rng.choices((0, BLANK, DUPLICATE, TRUNCATED), (6, 1, 1, 2))[0])
                for _ in range(rng.randint(0, 14))]
        assert search(rows) == cheapest(rows), rows


def test_search_of_long_conversations_stays_near_linear():
    rng = random.Random(6)
    for letters in ("s", "u", "sua", "ua"):
        rows = [(rng.choice(letters), rng.choice((0, 0, 0, BLANK, TRUNCATED))) for _ in range(20_000)]
        assert search(rows) == cheapest_long(rows)


def cheapest_long(rows):
    """(cost, audit) by the exact cost of what is left, from the end, then forwards."""
    n, inf = len(rows), 10 ** 9
    states = ("", "s", "u", "a")
    left = [dict.fromkeys(states, inf) for _ in range(n + 1)]

    def steps(i, last):
        need = "a" if last == "u" else "u"
        if i < n:
            initial, fault = rows[i]
            yield "D", 3, i + 1, last
            if fault not in (BLANK, DUPLICATE):
                late = int(fault == TRUNCATED)
                if initial == need or initial == "s" and last == "":
                    yield "K", late, i + 1, initial
                yield "R", late + 2, i + 1, need
        yield "I", 2, i, need

    for i in range(n, -1, -1):
        for _ in range(3):
            for last in states:
                ends = [0] if i == n and last in ("", "a") else []
                left[i][last] = min(ends + [c + left[j][x] for _, c, j, x in steps(i, last)])
    i, last, audit = 0, "", []
    while not (i == n and left[i][last] == 0 and last in ("", "a")):
        letter, _, i2, last2 = min((s for s in steps(i, last) if s[1] + left[s[2]][s[3]] == left[i][last]),
                                   key=lambda s: "DIKR".index(s[0]))
        audit.append(letter)
        i, last = i2, last2
    return left[0][""], "".join(audit)


def test_query_equals_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/conversations.parquet").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in op12_turn_repair(spark, SF_MID).collect()}
    assert got == expected(rows)


def test_odd_rows(spark):
    rng = random.Random(7)
    words = ["", " ", "\t\x0b", "Yes.", "no", "Why? ", "é!", None, "a:b\nc."]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice([None, 0, 1, 2, 3, 9, 10 ** 12]),
             rng.choice(["user", "assistant", "system", "", None, "tool", "ustad"]), rng.choice(words))
            for _ in range(400)]
    rows += [(50, t, "user", "hi " * 200_000 + "x.") for t in range(3)]
    rows += [(60 + i, 0, "user", "only row.") for i in range(60)]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    clashing = df.selectExpr("*", *[f"'x' as {c}" for c in ("rank", "kind", "digest", "place", "cost", "there")])
    damaged, there = turn_repair.damaged(clashing)
    repair = Repair(damaged, there)
    got = {r.conv_id: tuple(r)[1:] for r in repair.digests().collect()}
    want = expected(rows)
    assert got == want
    assert any(w == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, w in want.items() if c and c >= 60)
    assert {r.conv_id: tuple(r)[1:] for r in repair.summary().collect()} == {c: w[:-1] for c, w in want.items()}
    lines = {}
    for r in repair.turns().orderBy("place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, w in want.items():
        assert hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == w[-1]
    empty = Repair(df.limit(0))
    assert empty.digests().count() == empty.turns().count() == empty.summary().count() == 0
