"""Repair of the turn structure of conversations by iterative-deepening A*.

A conversation is repaired by edits of its rows so that the roles follow
``(s?(ua)+)?``: an optional system turn, then user and assistant in turn.  The
cheapest edits are wanted, and of those the first in ASCII order.  The search
is depth-first, tries edits in ASCII order, and is repeated with a higher bound
of cost until it arrives: the first path that arrives is then the answer.  A
lower bound of the cost of the rows that are left cuts branches, and a table of
states that failed, with the budget they had, keeps a state from being searched
again.

Long conversations are cut into pieces of ``PIECE`` rows.  Every piece is searched on
its own, from each state it may be entered in to each it may be left in, and the pieces
are put together in order; only one letter an edit is kept, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.arrow import map_arrow
from tallyloom.llm.places import met, placed
from tallyloom.operators.lookup import small
from tallyloom.session import settled

PIECE = 64
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
# states of the turn order
START, SYSTEM, USER, ASSISTANT = range(4)
_WANTED = (USER, USER, ASSISTANT, USER)  # what an inserted or renamed turn becomes in each state
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_BLANKS = "\\x20\\x09-\\x0D"


def _next(state: int, initial: str) -> int | None:
    """State after a turn with this initial, if it may come now."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=1 << 16)
def search(codes: str, entry: int = START, leave: int | None = None) -> tuple[int, str] | None:
    """Cost and edits of the cheapest path over rows, or None if there is none.

    A row is ``-`` (must go) or the initial of its role, in capitals if its text is not cut
    short (``X``/``x``: any other role).  With ``leave`` the path ends after the last row in
    that state; without it, it may add turns at the end and must end where a conversation may.
    """
    rows = len(codes)
    if leave is not None and not _reachable(codes, entry, leave):
        return None
    least = [0] * (rows + 1)  # what the rows from here on cost at least
    for i in reversed(range(rows)):
        row = codes[i]
        cost = DELETE if row == "-" else min(DELETE, row.islower() * TRUNCATED + (row in "xX") * REROLE)
        least[i] = least[i + 1] + cost
    failed = [[-1] * 4 for _ in range(rows + 1)]
    edits: list[str] = []

    def arrive(i: int, state: int, budget: int) -> bool:
        if i == rows:
            if state == leave or (leave is None and state in (START, ASSISTANT)):
                return True
            if leave is not None:
                return False
        if budget < least[i] or failed[i][state] >= budget:
            return False
        for edit, cost, at, to in moves(i, state):
            if cost <= budget and arrive(at, to, budget - cost):
                edits.append(edit)
                return True
        failed[i][state] = budget
        return False

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order."""
        if i < rows:
            yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, _WANTED[state]
        if i < rows and codes[i] != "-":
            short = codes[i].islower() * TRUNCATED
            to = _next(state, codes[i].lower())
            if to is not None:
                yield "K", short, i + 1, to
            yield "R", REROLE + short, i + 1, _WANTED[state]

    bound = least[0]
    while not arrive(0, entry, bound):
        bound += 1
    return bound, "".join(reversed(edits))


def _reachable(codes: str, entry: int, leave: int) -> bool:
    if leave == START or leave == SYSTEM:
        return leave == entry or (leave == SYSTEM and entry == START and "s" in codes.lower())
    return True


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces ``conv, piece, n, codes`` to their paths; ``leave`` -1 is the end of the conversation."""
    for batch in batches:
        out: list[tuple] = []
        for conv, piece, n, codes in zip(*(c.to_pylist() for c in batch.columns)):
            if n <= PIECE:
                out.append((conv, piece, START, -1, *search(codes)))
                continue
            for entry in (START,) if piece == 0 else range(4):
                for leave in range(4):
                    found = search(codes, entry, leave)
                    if found:
                        out.append((conv, piece, entry, leave, *found))
        columns = list(zip(*out)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (batch.schema.types[0], pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()))],
            ["conv", "piece", "entry", "leave", "cost", "audit"])


def joined(paths: list[dict]) -> tuple[int, str]:
    """Cheapest way through the pieces of one conversation, in order."""
    best = {START: (0, "")}
    table: dict[int, list[dict]] = {}
    for p in paths:
        table.setdefault(p["piece"], []).append(p)
    for piece in sorted(table):
        now: dict[int, tuple[int, str]] = {}
        for p in table[piece]:
            if p["entry"] in best:
                cost, audit = best[p["entry"]]
                way = (cost + p["cost"], audit + p["audit"])
                now[p["leave"]] = min(now.get(p["leave"], way), way)
        best = now
    ends = {-1: "", START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
    return min((cost + INSERT * len(ends[q]), audit + ends[q]) for q, (cost, audit) in best.items())


def _joined_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [joined(paths) for paths in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            ["conv", "cost", "audit"])


def _walk(emit: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator:
    """Rows sorted by conversation, each led by its edits: what ``emit(conv, place, role, text)`` and, at a
    conversation's end, ``emit(conv, places)`` give.  Holds one conversation's edits, never its rows."""
    conv, audit, at, state, place = None, None, 0, START, 0

    def added() -> Iterator:
        nonlocal at, state, place
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _WANTED[state]
            yield emit(conv, place, _NAMES[state], "")
            place += 1

    for batch in batches:
        for name, pos, role, text, edits in zip(*(c.to_pylist() for c in batch.columns)):
            if pos < 0:
                if audit is not None:
                    yield from added()
                    yield emit(conv, place)
                conv, audit, at, state, place = name, edits, 0, START, 0
                continue
            yield from added()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            if edit == "R":
                state = _WANTED[state]
                role = _NAMES[state]
            else:
                state = _next(state, role[0])
            yield emit(conv, place, role, text)
            place += 1
    if audit is not None:
        yield from added()
        yield emit(conv, place)


def _turn_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    types = None

    def batch_of_rows() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (types, pa.int64(), pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["conv", "place", "role", "text"])

    def watched() -> Iterator[pa.RecordBatch]:
        nonlocal types
        for batch in batches:
            types = batch.schema.types[0]
            yield batch

    for row in _walk(lambda *r: r, watched()):
        if len(row) == 4:
            rows.append(row)
        if len(rows) >= 1000:
            yield batch_of_rows()
            rows.clear()
    if rows:
        yield batch_of_rows()


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the repaired ``role:text`` lines of each conversation, updated row by row."""
    running = hashlib.sha256()

    def emit(conv, place, role=None, text=None):
        nonlocal running
        if role is not None:
            running.update(("\n" * (place > 0) + f"{role}:{text}").encode())
            return None
        done, running = running.hexdigest(), hashlib.sha256()
        return conv, done

    out: list[tuple] = []
    types = None

    def watched() -> Iterator[pa.RecordBatch]:
        nonlocal types
        for batch in batches:
            types = batch.schema.types[0]
            yield batch

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in out], types), pa.array([d for _, d in out], pa.string())], ["conv", "digest"])

    for done in _walk(emit, watched()):
        if done is not None:
            out.append(done)
        if len(out) >= 5000:
            yield packed()
            out.clear()
    if out:
        yield packed()


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text``; a null role or text becomes one space."""
    return rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), _filled(role).alias("role"), _filled(text).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Turns with faults by a hash of ``conv:turn``: of 20 kinds 0 drops a turn, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes it the user's; a null in the hash counts as one space."""
    kind = F.crc32(F.concat(_filled("conv"), F.lit(":"), _filled("turn")).cast("binary")) % 20
    return rows.withColumn("_kind", kind).where("_kind <> 0").select(
        "conv", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def inspected(rows: DataFrame) -> DataFrame:
    """Turns ``conv, turn, role, text`` with their place in the conversation (``pos``, ``n`` turns) and first ``fault``.

    Turns are ordered by ``turn`` (nulls first); those of one turn by a digest of role and text, so that repeated
    turns are neighbours.  Faults: ``blank`` (white space only), ``duplicate`` (role and text seen earlier),
    ``truncated`` (the last character that is not white space ends no sentence), else null.
    """
    marked = settled(rows.withColumn("mark", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)))
    laid = placed(marked, ["conv"], ["turn", "mark"])
    firsts = laid.groupBy("conv", "mark").agg(F.min("pos").alias("first"), F.count("*").alias("times"))
    again = small(settled(firsts.where("times > 1").drop("times")))
    fault = (
        F.when(~F.col("text").rlike(f"[^{_BLANKS}]"), "blank").when(F.col("pos") > F.col("first"), "duplicate")
        .when(~F.col("text").rlike(f"[.!?][{_BLANKS}]*\\z"), "truncated"))
    return met(laid, again, ["conv", "mark"], "left").select("conv", "turn", "role", "text", "pos", "n", fault.alias("fault"))


def _codes() -> Column:
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    return (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit("-"))
        .when(F.col("fault") == "truncated", letter).otherwise(F.upper(letter)))


def audited(turns: DataFrame) -> DataFrame:
    """Per conversation of ``inspected`` turns: counts of faults, gaps, illegal neighbours, and the cheapest edits.

    ``gaps`` counts the turn numbers missing between the first and the last; ``illegal`` the neighbours whose initials
    are none of su, ua, au; ``audit`` has a letter per edit (Delete, Insert, Keep, Rerole) and ``cost`` is theirs.
    """
    light = turns.select(
        "conv", "n", "turn", F.expr(f"pos div {PIECE}").alias("piece"), "fault",
        F.struct("pos", _codes().alias("code"), F.substring("role", 1, 1).alias("initial")).alias("item"))
    count = lambda name: F.count_if(F.col("fault") == name).alias(name)
    pieces = light.groupBy("conv", "piece").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list("item")).alias("items"), count("blank"), count("duplicate"), count("truncated"))
    legal = lambda a, b: F.concat(a, b).isin("su", "ua", "au")
    inner = F.size(F.filter(
        F.sequence(F.lit(1), F.size("items") - 1),
        lambda i: ~legal(F.element_at("items", i)["initial"], F.element_at("items", i + 1)["initial"])))
    pieces = settled(pieces.select(
        "conv", "piece", "n", F.array_join("items.code", "").alias("codes"), "blank", "duplicate", "truncated",
        F.when(F.size("items") > 1, inner).otherwise(0).alias("illegal"),
        F.element_at("items", 1)["initial"].alias("head"), F.element_at("items", -1)["initial"].alias("tail")))
    schema = f"conv {pieces.schema['conv'].dataType.simpleString()}"
    # few bytes but much work: not left to one task
    tasks = pieces.sparkSession.sparkContext.defaultParallelism
    paths = map_arrow(pieces.select("conv", "piece", "n", "codes").repartition(tasks), _searched,
                      f"{schema}, piece bigint, entry int, leave int, cost bigint, audit string")
    gathered = paths.groupBy("conv").agg(F.collect_list(F.struct("piece", "entry", "leave", "cost", "audit")).alias("paths"))
    edits = map_arrow(gathered, _joined_batches, f"{schema}, cost bigint, audit string")
    # neighbours across the cut of two pieces
    tails = pieces.select("conv", (F.col("piece") + 1).alias("piece"), F.col("tail").alias("before"))
    heads = pieces.where("piece > 0").select("conv", "piece", "head")
    across = met(heads, tails, ["conv", "piece"]).groupBy("conv").agg(F.count_if(~legal(F.col("before"), F.col("head"))).alias("across"))
    sums = pieces.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    span = light.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    found = met(met(met(sums, across, ["conv"], "left"), span, ["conv"]), edits, ["conv"])
    return found.select(
        "conv", "gaps", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.coalesce("across", F.lit(0))).alias("illegal"), "cost", "audit")


def _led(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Turns of a conversation in order behind a line with its edits."""
    lines = audits.select("conv", F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), "audit")
    rows = turns.select("conv", "pos", "role", "text", F.lit(None).cast("string").alias("audit"))
    return rows.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "pos")


def repaired(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The conversations after their edits: ``conv, place`` (from 0), ``role, text``.

    Added turns are empty.  A task streams the turns in order and holds the edits of one conversation.
    """
    conv = turns.schema["conv"].dataType.simpleString()
    return map_arrow(_led(turns, audits), _turn_batches, f"conv {conv}, place bigint, role string, text string")


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv, digest``: SHA-256 (hex) of the ``role:text`` lines of every repaired conversation, none of them gathered."""
    conv = turns.schema["conv"].dataType.simpleString()
    return map_arrow(_led(turns, audits), _digest_batches, f"conv {conv}, digest string")


def audits_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
              damage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per conversation (null ids make one): ``conv``, the columns of ``audited`` and ``digest``.

    A conversation without any row left has zeros, no edits and the digest of nothing.  Rows that repeat are
    duplicates of the first.  Other columns are not read.  An empty table gives an empty table.
    """
    given = turns(rows, conv, turn, role, text)
    seen = settled(inspected(damage(given) if damage else given))
    audits = settled(audited(seen))
    known = given.select("conv").distinct()
    found = met(met(known, audits, ["conv"], "left"), repaired_digests(seen, audits), ["conv"], "left")
    zeros = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = hashlib.sha256().hexdigest()
    return found.withColumns(zeros | {
        "audit": F.coalesce("audit", F.lit("")), "digest": F.coalesce("digest", F.lit(nothing))})
