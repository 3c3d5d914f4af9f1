"""Conversation repair against a plain shortest-path search and SQL."""

import hashlib
import heapq
import itertools
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from tallyloom.llm import queries_turns, turns
from tests.parity import compare, duck

LEGAL = re.compile(r"(s?(ua)+)?")


def plain(codes):
    """Cheapest edits, least in ASCII order, by uniform-cost search over (row, roles so far)."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(codes) and q in (0, 3):
            return cost, audit
        if (i, q) in seen:
            continue
        seen.add((i, q))
        want = 3 if q == 2 else 2
        heapq.heappush(heap, (cost + 2, audit + "I", i, want))
        if i < len(codes):
            row = codes[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q))
            if row != "-":
                short, to = row.islower(), {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((row.lower(), q))
                if to is not None:
                    heapq.heappush(heap, (cost + short, audit + "K", i + 1, to))
                heapq.heappush(heap, (cost + 2 + short, audit + "R", i + 1, want))
    raise AssertionError


def plain_all(codes, most):
    """Every edit script up to a length, for short rows: the least by cost and text whose roles are legal."""
    best = None
    for size in range(most + 1):
        for script in itertools.product("DIKR", repeat=size):
            if sum(e != "I" for e in script) != len(codes):
                continue
            at, cost, roles = 0, 0, [""]
            for e in script:
                row = codes[at] if at < len(codes) and e != "I" else None
                if row is not None:
                    at += 1
                if e == "D":
                    cost += 3
                elif row == "-":
                    break
                elif e == "K":
                    cost, roles = cost + row.islower(), [r + row.lower() for r in roles]
                else:
                    cost, roles = cost + 2 + (row is not None and row.islower()), [r + x for r in roles for x in "ua"]
            else:
                if any(LEGAL.fullmatch(r) for r in roles):
                    best = min(best or (cost, "".join(script)), (cost, "".join(script)))
    return best


CODES = st.text("-suaxSUAX", max_size=40)


@settings(max_examples=300, deadline=None)
@given(CODES)
def test_search_is_cheapest_and_least(codes):
    assert turns.search(codes) == plain(codes)


@settings(max_examples=60, deadline=None)
@given(st.text("-suaxSUAX", max_size=3))
def test_search_equals_all_scripts(codes):
    assert turns.search(codes) == plain_all(codes, 2 * len(codes) + 2)


@settings(max_examples=60, deadline=None)
@given(st.text("-suaxSUAX", min_size=1, max_size=60), st.integers(1, 9))
def test_pieces_join_to_the_whole(codes, size):
    paths = [
        {"piece": i // size, "entry": entry, "leave": leave, "cost": found[0], "audit": found[1]}
        for i in range(0, len(codes), size) for entry in ([0] if i == 0 else range(4)) for leave in range(4)
        if (found := turns.search(codes[i : i + size], entry, leave))]
    assert turns.joined(paths) == plain(codes)


def plain_conversations(rows):
    """The whole contract in plain Python over (conv, turn, role, text), damage done already."""
    out, convs = {}, {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, codes, faults = set(), "", []
        for _, role, text in mine:
            body = text.strip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else letter if fault else letter.upper()
        cost, audit = plain(codes)
        known = [t for t, _, _ in mine if t is not None]
        lines, queue, last = [], iter(mine), ""
        for e in audit:
            role, text = ("", "") if e == "I" else next(queue)[1:]
            if e != "D":
                role = role if e == "K" else "assistant" if last == "user" else "user"
                lines.append(f"{role}:{text}")
                last = "user" if role[:1] == "u" else role
        firsts = [r[:1] for _, r, _ in mine]
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(draw, conv, size):
    return [(conv, draw.choice([None, i, i, i, i + 5]), draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             draw.choice([f"Line {i}.", f"Line {i}", "Again!", " \t\n", "", None, "Ends. \n\r"])) for i in range(size)]


@pytest.fixture(scope="module")
def wild(spark):
    """Conversations of none to many pieces; one holds most rows; a null id."""
    draw = random.Random(4)
    rows = rows_of(draw, 1, 900) + rows_of(draw, None, 70) + [r for c in range(2, 40) for r in rows_of(draw, c, draw.randrange(1, 9))]
    for conv, size in ((100, 64), (101, 65), (102, 128), (103, 129)):
        rows += rows_of(draw, conv, size)
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)


def test_conversations_equal_plain(wild):
    rows, table = wild
    got = {r["conv"]: tuple(r)[1:] for r in turns.audits_of(table).collect()}
    assert got == plain_conversations(rows)


def test_repaired_turns_are_legal(wild):
    seen = turns.inspected(turns.turns(wild[1], "conv_id", "turn", "role", "text"))
    audits = turns.audited(seen)
    digests = {r["conv"]: r["digest"] for r in turns.repaired_digests(seen, audits).collect()}
    convs = {c: [] for c in digests}
    for r in turns.repaired(seen, audits).collect():
        convs[r["conv"]].append((r["place"], r["role"], r["text"]))
    for conv, lines in convs.items():
        lines.sort()
        assert [p for p, _, _ in lines] == list(range(len(lines))) and LEGAL.fullmatch("".join(r[0] for _, r, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest() == digests[conv]


@pytest.mark.parametrize("rows", ["wild", "dropped", "empty"])
def test_query_equals_sql(spark, wild, tmp_path, rows):
    """Nulls anywhere, repeated rows, a column that clashes; conversations that lose all rows; no rows."""
    data = {"wild": [r for r in wild[0] if r[0] != 1], "dropped": [(i, 0, "user", "Hi.") for i in range(60)], "empty": []}[rows]
    path = f"{tmp_path}/conversations.parquet"
    table = spark.createDataFrame([(*r, 1, 2) for r in data], "conv_id bigint, turn bigint, role string, text string, n int, pos int")
    table.coalesce(1).write.parquet(path)
    con = duck(f"{tmp_path}/none")
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    out = queries_turns.op13_conversation_repair(spark, str(tmp_path))
    assert compare(out, con, queries_turns._SQL) == []
    if rows == "dropped":
        assert 0 < out.where("audit = '' and cost = 0").count() < 60
