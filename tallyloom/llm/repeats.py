"""Exact repeated passages of all documents by a sparse, distributed suffix array.

A passage of ``length`` bytes is repeated if the same bytes start anywhere else.
Sorting every suffix of 100 TB is out of reach, so suffixes are sampled such that
no repeat is missed: in every window of ``length`` bytes the smallest hash of its
``GRAM``-byte substrings names an *anchor*, and equal windows name it at the same
offset.  Windows in a row with one anchor are kept as one *stretch*.

1. Stretches meet by the hash of their anchor gram.  Stretches equal in every
   byte are repeats already (copies inside a batch are found before the shuffle).
2. Of grams with several different stretches, one of each kind is *open*: its
   bytes are cut from the text and meet again by a longer shared block, each with
   the offsets for which that block is certain.
3. Each such bucket gets an enhanced suffix array of the bytes right of the
   anchors.  A stack scan walks its common-prefix interval tree; in every interval
   the left contexts are compared, and members that agree on ``length`` bytes in
   all but differ on the left or the right form a maximal repeat with all its
   occurrences.  Buckets beyond ``BUCKET`` are halved by offset and meet again by
   a longer block, until the block is the whole window and needs no comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from tallyloom.llm.arrow import map_arrow
from tallyloom.session import settled

LENGTH, GRAM = 200, 50
BUCKET = 4096  # stretches compared in one suffix array
_LOT = 1 << 19  # bytes hashed at once
_PART = 1 << 22  # bytes of one document handled at once
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < count:
        steps = np.full(max(count, _LOT + (1 << 17)), base, np.uint64)
        steps[0] = 1
        held = _POWERS[base] = np.multiply.accumulate(steps)
    return held[:count]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of every ``gram`` bytes."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(data.astype(np.uint64) * _powers(_BASE, len(data)), out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _powers(_INVERSE, len(data) + 1 - gram)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Stretches of short texts, laid end to end: ``text, first window, last window, anchor, gram hash``.

    Places are from the text's start.  Ties of the hash go to the leftmost gram.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    hashes = _gram_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    marked = (hashes & ~np.uint64(0xFFFFFF)) | place
    anchor = (_window_minimum(marked, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    sound = np.flatnonzero(np.arange(len(anchor)) + length <= ends[owner])
    if not len(sound):
        return none, none, none, none, none.astype(np.uint64)
    anchors, owners = anchor[sound], owner[sound]
    new = np.flatnonzero(np.r_[True, (np.diff(anchors) != 0) | (np.diff(owners) != 0)])
    first, last = sound[new], sound[np.r_[new[1:] - 1, len(sound) - 1]]
    text = owners[new]
    start = ends[text] - sizes[text]
    return text, first - start, last - start, anchors[new] - start, hashes[anchors[new]]


def _lots(rids: np.ndarray, texts: Iterator[bytes], length: int):
    """Texts in lots of about ``_LOT`` bytes; long ones in overlapping parts: ``(row, start, bytes)``."""
    lot, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), _PART):
            part = text[at : at + _PART + length - 1]
            if len(part) < length:
                continue
            lot.append((row, at, part))
            size += len(part)
            if size >= _LOT:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def _packed(first, last, anchor):
    """Stretch as one long: first window, then window count and anchor relative to it."""
    return first << 16 | (last - first) << 8 | (anchor - first)


def _stretch_batches(length: int, gram: int):
    """Rows ``rid, h, c, stretch, same``: ``same`` 1 if known to repeat, 2 if besides its kind need not be sent on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy()
            found = []
            for lot in _lots(rids, (v.as_py() or b"" for v in batch.column(1)), length):
                text, first, last, anchor, h = stretches([p for _, _, p in lot], length, gram)
                parts = [p for _, _, p in lot]
                c = np.fromiter((
                    xxh3_64_intdigest(parts[t][a:b], d) for t, a, b, d in zip(
                        text.tolist(), first.tolist(), (last + length).tolist(), (anchor - first).tolist())), np.uint64, len(text))
                rows = np.array([r for r, _, _ in lot], np.int64)[text]
                start = np.array([s for _, s, _ in lot], np.int64)[text]
                found.append((rids[rows], h.view(np.int64), c.view(np.int64), _packed(first + start, last + start, anchor + start)))
            if not found:
                continue
            rid, h, c, stretch = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((c, h))
            rid, h, c, stretch = rid[order], h[order], c[order], stretch[order]
            as_last = np.r_[False, (h[1:] == h[:-1]) & (c[1:] == c[:-1])]
            same = np.where(as_last, 2, np.where(np.r_[as_last[1:], False], 1, 0)).astype(np.int32)
            # what is only a copy goes by its row, so a hot passage is spread
            by = np.where(as_last, rid, h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (by, h, c, rid, stretch, same)], ["by", "h", "c", "rid", "stretch", "same"])

    return run


def _settle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by copy or not, gram, kind.  ``open`` 0: the stretch repeats; 1: it must be compared.

    A row is needed beside its neighbours only, and the first kind of a gram until the second comes.
    """
    held: list[np.ndarray] | None = None  # the last row, whose successor is not known yet
    before = None  # gram and kind of the row before the held one
    first_kind = None  # first kind of the current gram, not sent yet

    def rows(rid, stretch, h, is_open):
        return pa.RecordBatch.from_arrays(
            [pa.array(rid), pa.array(stretch), pa.array(h), pa.array(np.full(len(rid), is_open, np.int32))],
            ["rid", "stretch", "h", "open"])

    def done(cols, last: bool):
        nonlocal before, first_kind
        h, c, rid, stretch, same = cols
        count = len(h) if last else len(h) - 1
        if count <= 0:
            return
        like_next = np.r_[(h[1:] == h[:-1]) & (c[1:] == c[:-1]), False]
        like_last = np.r_[before is not None and before == (h[0], c[0]), like_next[:-1]]
        repeats = (like_last | like_next | (same > 0))[:count]
        if repeats.any():
            yield rows(rid[:count][repeats], stretch[:count][repeats], h[:count][repeats], 0)
        kinds = np.flatnonzero(~like_last[:count])
        if len(kinds):
            hk = h[kinds]
            earlier = np.r_[before is not None and before[0] == hk[0], hk[1:] == hk[:-1]]
            later = np.r_[hk[1:] == hk[:-1], False]
            send = kinds[earlier | later]
            if first_kind is not None and earlier[0]:
                yield rows(*first_kind, 1)
            first_kind = None
            if not earlier[-1]:
                k = kinds[-1:]
                first_kind = (rid[k], stretch[k], h[k])
            if len(send):
                yield rows(rid[send], stretch[send], h[send], 1)
        before = (h[count - 1], c[count - 1])

    for batch in batches:
        names = batch.schema.names
        cols = [batch.column(names.index(n)).to_numpy() for n in ("h", "c", "rid", "stretch", "same")]
        copies = cols[4] == 2
        if copies.any():
            yield rows(cols[2][copies], cols[3][copies], cols[0][copies], 0)
            cols = [x[~copies] for x in cols]
        if held is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(held, cols)]
        if len(cols[0]):
            yield from done(cols, False)
            held = [x[-1:] for x in cols]
    if held is not None:
        yield from done(held, True)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] equal, a[:high] not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of at least ``length`` bytes around a common place: ``left extent, right extent, members``.

    ``lefts`` are the bytes before the place, nearest first; ``rights`` those from
    it.  The common-prefix intervals of the sorted ``rights`` are found by a stack
    scan.  In each interval the members are put in order of their left context and
    cut where neighbours share too little; every run of two or more is a repeat.
    It is left-maximal by construction and right-maximal as the interval is.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    shared = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    rank = {m: i for i, m in enumerate(sorted(range(len(lefts)), key=lefts.__getitem__))}

    def groups(low: int, high: int, depth: int):
        members = sorted(order[low : high + 1], key=rank.__getitem__)
        run, extent = [members[0]], None
        for a, b in zip(members, members[1:]):
            common = _common(lefts[a], lefts[b])
            if common + depth >= length:
                run.append(b)
                extent = common if extent is None else min(extent, common)
            else:
                if extent is not None:
                    yield extent, depth, run
                run, extent = [b], None
        if extent is not None:
            yield extent, depth, run

    stack: list[tuple[int, int]] = []  # (depth, first member) of open intervals
    for i, depth in enumerate([*shared, -1]):
        low = i
        while stack and stack[-1][0] > depth:
            closed, low = stack.pop()
            yield from groups(low, i, closed)
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, low))


def _covered(lefts: list[bytes], rights: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each member the ``(left, right)`` extents around the place that some other member repeats."""
    out: list[list[tuple[int, int]]] = [[] for _ in lefts]
    if len(lefts) == 2:
        l, r = _common(lefts[0], lefts[1]), _common(rights[0], rights[1])
        return [[(l, r)], [(l, r)]] if l + r >= length else out
    for _, depth, members in maximal_repeats(lefts, rights, length):
        commons = [_common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for i, m in enumerate(members):  # the farthest left this member shares with any other
            out[m].append((max(commons[max(0, i - 1) : i + 1]), depth))
    return out


def _bucket_batches(length: int):
    """Runs of one ``key``: ``rid, start, stop`` of repeated bytes."""

    def solve(rows: list[tuple]):
        if len(rows) < 2:
            return
        if rows[0][4] == rows[0][5]:  # the block is the window itself
            for rid, at, _, _, low, _, _ in rows:
                yield rid, at - low, at - low + length
            return
        lefts = [left for _, _, left, _, _, _, _ in rows]
        rights = [right for _, _, _, right, _, _, _ in rows]
        for (rid, at, *_), spans in zip(rows, _covered(lefts, rights, length)):
            for left, right in spans:
                yield rid, at - left, at + right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            found = []
            for k, rid, at, low, high, left, right in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if k != key:
                    found.extend(solve(held))
                    held, key = [], k
                held.append((rid, at, left[::-1], right, low, high, None))
            if found:
                yield _span_rows(found)
        found = list(solve(held))
        if found:
            yield _span_rows(found)

    return run


def _span_rows(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["rid", "start", "stop"])


_LEVEL = ["key", "rid", "at", "low", "high", "left", "right"]


def _level(rows: DataFrame, length: int) -> DataFrame:
    """Rows keyed by the block that all windows of their offset range ``low..high`` contain.

    ``left`` are the ``high`` bytes before the anchor, ``right`` the ``length - low`` from it, as far as the
    stretch has them; the node's range is ``nlow..nhigh``.
    """
    block = F.concat(
        F.substring("left", F.octet_length("left") - F.col("nlow") + 1, F.col("nlow")),
        F.substring("right", F.lit(1), F.lit(length) - F.col("nhigh")))
    return rows.withColumn("key", F.xxhash64("h", "nlow", block))


def _halved(rows: DataFrame, length: int) -> DataFrame:
    """Each row's offset range cut in two, with the bytes that each part needs; parts without a window go."""
    middle = F.floor((F.col("nlow") + F.col("nhigh")) / 2).cast("int")
    parts = F.explode(F.array(
        F.struct(F.col("nlow").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("nhigh").alias("b"))))
    cut = (
        rows.select("*", parts.alias("_n"))
        .withColumns({"nlow": F.col("_n.a"), "nhigh": F.col("_n.b"), "low": F.greatest("low", "_n.a"), "high": F.least("high", "_n.b")})
        .where("low <= high").drop("_n")
    )
    return _level(cut.withColumns({
        "left": F.substring("left", F.octet_length("left") - F.col("high") + 1, F.col("high")),
        "right": F.substring("right", F.lit(1), F.lit(length) - F.col("low"))}), length)


def _compared(rows: DataFrame, length: int, bucket: int) -> DataFrame:
    """``rid, start, stop`` from the open stretches' bytes; oversize buckets are halved until none is left."""
    out, level = [], settled(_halved(rows, length))
    while True:
        sizes = level.groupBy("key").agg(F.count("*").alias("_n"), F.max(F.col("nhigh") - F.col("nlow")).alias("_w"))
        large = settled(sizes.where((F.col("_n") > bucket) & (F.col("_w") > 0)).select("key"))
        some = large.count()
        fit = level.join(large, "key", "left_anti") if some else level
        columns = ["key", "rid", "at", "nlow", "nhigh", "left", "right"]
        spans = map_arrow(fit.select(*columns).repartition("key").sortWithinPartitions("key"), _bucket_batches(length),
                          "rid bigint, start bigint, stop bigint")
        out.append(spans)
        if not some:
            break
        level = settled(_halved(level.join(large, "key", "left_semi"), length))
    first, *rest = out
    for more in rest:
        first = first.unionByName(more)
    return first


def with_row_id(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds ``_rid``, a 64-bit hash of id and text: rows that repeat both share it, and all their results."""
    return docs.withColumn("_rid", F.xxhash64(key, text))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """``_rid, spans``: byte ranges (start, stop) covered by passages of ``length`` bytes that also start elsewhere.

    Ranges may overlap; only rows with any are returned.  ``docs`` needs ``_rid``
    (see ``with_row_id``) and ``text``; a null text is empty.  Repeats inside a
    document count, also overlapping ones.
    """
    if not 0 < length - gram < 256:
        raise ValueError("length must exceed the gram by less than 256 bytes")
    bytes_of = docs.select(F.col("_rid").alias("rid"), F.col("text").cast("binary").alias("text")).where(F.octet_length("text") >= length)
    sampled = map_arrow(bytes_of, _stretch_batches(length, gram),
                        "by bigint, h bigint, c bigint, rid bigint, stretch bigint, same int")
    laid = sampled.repartition("by").sortWithinPartitions("h", "c")
    known = settled(map_arrow(laid, _settle_batches, "rid bigint, stretch bigint, h bigint, open int"))
    first = F.shiftright("stretch", 16)
    windows = F.shiftright("stretch", 8).bitwiseAND(F.lit(255))
    equal = known.where("open = 0").select("rid", first.alias("start"), (first + windows + length).alias("stop"))
    lists = known.where("open = 1").groupBy("rid").agg(F.collect_list(F.struct(
        "h", first.alias("first"), (first + windows).alias("last"),
        (first + F.col("stretch").bitwiseAND(F.lit(255))).alias("at"))).alias("open"))
    cut = F.transform("open", lambda s: F.struct(
        s["h"].alias("h"), s["at"].alias("at"), (s["at"] - s["last"]).cast("int").alias("low"),
        (s["at"] - s["first"]).cast("int").alias("high"),
        F.substring("text", (s["first"] + 1).cast("int"), (s["at"] - s["first"]).cast("int")).alias("left"),
        F.substring("text", (s["at"] + 1).cast("int"), (s["last"] - s["at"] + length).cast("int")).alias("right")))
    # repeated rows hold the same bytes: one of them is enough here
    opened = (
        bytes_of.join(lists, "rid").select("rid", F.explode(cut).alias("s")).select("rid", "s.*")
        .withColumns({"nlow": F.lit(0), "nhigh": F.lit(length - gram)})
    )
    spans = equal.unionByName(_compared(opened, length, bucket))
    return spans.groupBy(F.col("rid").alias("_rid")).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted disjoint ranges, touching ones joined."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], reach[np.r_[at[1:] - 1, len(spans) - 1]]], axis=1)


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, runs, sums = [], [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            text = text.as_py() or b""
            if not spans.is_valid or not len(spans):
                rest, gone, count = text, 0, 0
            else:
                both = spans.values
                ranges = merged(np.stack([both.field(0).to_numpy(), both.field(1).to_numpy()], axis=1))
                edges = [0, *ranges.ravel().tolist(), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                gone, count = len(text) - len(rest), len(ranges)
            kept.append(rest)
            removed.append(gone)
            runs.append(count)
            sums.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sums, pa.string())],
            ["_rid", "kept", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame, length: int = LENGTH, keep: bool = True, carried: list[str] | None = None) -> DataFrame:
    """Every row with ``kept`` (its bytes outside all repeats), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    ``carried`` columns stay (``doc_id`` if not given).  A text without repeats
    stays whole, a null text is empty.  Rows that repeat are copies of each other.
    """
    carried = carried or ["doc_id"]
    marked = with_row_id(docs)
    spans = repeated_spans(marked, length)
    rows = marked.select(*carried, F.col("_rid"), F.col("text").cast("binary").alias("_bytes")).join(spans, "_rid", "left")
    return _apply(rows, carried, keep)


def _apply(rows: DataFrame, carried: list[str], keep: bool) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    width = len(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inner = pa.RecordBatch.from_arrays(batch.columns[width:], ["_rid", "text", "spans"])
            done = next(_kept_batches(iter([inner])))
            size = pa.array([len(v.as_py() or b"") for v in inner.column(1)], pa.int64())
            out = [*batch.columns[:width], size, *done.columns[2:]] + ([done.column(1)] if keep else [])
            yield pa.RecordBatch.from_arrays(out, [*carried, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep)

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carried) + ", n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return map_arrow(rows.select(*carried, "_rid", "_bytes", "spans"), run, schema + ", kept binary" * keep)


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeats cut from ``text`` and ``n_chars`` set anew; a character cut in two goes whole.

    No row goes, also if nothing of its text is left.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]

    def readable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v.as_py().decode("utf-8", "ignore") for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*others, "text"])

    kept = without_repeats(docs, length, carried=others).select(*others, "kept")
    kinds = dict(docs.dtypes)
    out = map_arrow(kept, readable, ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", text string")
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns) if "n_chars" in docs.columns else out.select(*docs.columns)
