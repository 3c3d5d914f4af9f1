"""Language identification by a bidirectional gated recurrent network over bytes.

Text is read in windows of ``WINDOW`` bytes, all of them, one after the other.
In each window a gated unit runs forwards and another backwards; both states
together label every byte, and a document's probabilities are the mean over its
bytes.  The network is trained in numpy by backpropagation through time over the
whole window, on a bounded sample of labelled rows; prediction covers whole texts
in Arrow tasks without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.arrow import held, map_arrow

WINDOW, HIDDEN = 64, 16
#: Bound of the labelled sample: documents of each language, and windows taken from each, spread over its text.
SAMPLE_DOCS, SAMPLE_WINDOWS = 400, 8
UNKNOWN = "und"
TEXTS = 2000  # texts labelled together, so that windows come in whole lots


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """True if crc32 of the id as text leaves the remainder; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


class ByteNetwork:
    """Gated recurrent units with piecewise linear gates.  Weights of both directions stacked: input table, recurrent matrix, bias of the recurrent candidate; output layer."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7):
        draw = np.random.default_rng(seed)
        scale = 1 / np.sqrt(hidden)
        self.hidden = hidden
        self.weights = {
            "x": draw.normal(0, 0.3, (2, 256, 3 * hidden)), "u": draw.normal(0, scale, (2, hidden, 3 * hidden)),
            "b": np.zeros((2, 1, hidden)), "v": draw.normal(0, scale, (2 * hidden, classes)), "c": np.zeros(classes)}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def states(self, codes: np.ndarray, mask: np.ndarray | None, trace: list | None = None) -> np.ndarray:
        """States (2, time, windows, hidden) for codes (time, windows); the second direction reads backwards."""
        h, w = self.hidden, self.weights
        steps, count = codes.shape
        both = np.stack([codes, codes[::-1]])
        masks = None if mask is None else np.stack([mask, mask[::-1]])
        out = np.empty((2, steps, count, h), np.float32)
        state = np.zeros((2, count, h), np.float32)
        for t in range(steps):
            inputs = np.stack([w["x"][0][both[0, t]], w["x"][1][both[1, t]]])
            inner = state @ w["u"]
            gates = np.clip(0.25 * (inputs[:, :, : 2 * h] + inner[:, :, : 2 * h]) + 0.5, 0, 1)
            keep, reset = gates[:, :, :h], gates[:, :, h:]
            inside = inner[:, :, 2 * h :] + w["b"]
            fresh = inputs[:, :, 2 * h :] + reset * inside
            np.tanh(fresh, out=fresh)
            new = fresh + keep * (state - fresh)
            if masks is not None:
                new *= masks[:, t, :, None]
            if trace is not None:
                trace.append((state, keep, reset, inside, fresh))
            state = new
            out[:, t] = state
        out[1] = out[1, ::-1].copy()
        return out

    def _odds(self, codes: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """Label probabilities (time, classes, windows) of every byte.

        As ``states`` without a trace: units first and windows last, so that every step works on whole rows, in
        buffers that are reused; gates are scaled once instead of at every step.
        """
        h, w = self.hidden, self.weights
        scale, shift = np.ones(3 * h, np.float32), np.zeros(3 * h, np.float32)
        scale[: 2 * h], shift[: 2 * h] = 0.25, 0.5
        tables = np.ascontiguousarray((w["x"] * scale + shift).transpose(0, 2, 1))
        inner_of = np.ascontiguousarray((w["u"] * scale).transpose(0, 2, 1))
        bias, ends = w["b"].transpose(0, 2, 1), np.ascontiguousarray(w["v"].reshape(2, h, -1).transpose(0, 2, 1))
        steps, count = codes.shape
        logits = np.empty((steps, ends.shape[1], count), np.float32)
        inputs, inner = np.empty((3 * h, count), np.float32), np.empty((3 * h, count), np.float32)
        label = np.empty((ends.shape[1], count), np.float32)
        for side in (0, 1):
            state = np.zeros((h, count), np.float32)
            for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                np.take(tables[side], codes[t], axis=1, out=inputs, mode="clip")
                np.matmul(inner_of[side], state, out=inner)
                gates, fresh = inner[: 2 * h], inner[2 * h :]
                gates += inputs[: 2 * h]
                np.maximum(gates, 0, out=gates)
                np.minimum(gates, 1, out=gates)
                fresh += bias[side]
                fresh *= gates[h:]
                fresh += inputs[2 * h :]
                np.tanh(fresh, out=fresh)
                state -= fresh
                state *= gates[:h]
                state += fresh
                if mask is not None:
                    state *= mask[t]
                if side == 0:
                    np.matmul(ends[0], state, out=logits[t])
                else:
                    logits[t] += np.matmul(ends[1], state, out=label)
        logits += w["c"][:, None]
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def probabilities(self, codes: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """Label probabilities (time, windows, classes) of every byte."""
        return self._odds(codes, mask).transpose(0, 2, 1)

    def gradients(self, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss (mean cross entropy over bytes) and its gradient by backpropagation through time."""
        h, w = self.hidden, self.weights
        trace: list = []
        s = self.states(codes, mask, trace)
        steps, count = codes.shape
        logits = s[0] @ w["v"][:h] + s[1] @ w["v"][h:] + w["c"]
        logits -= logits.max(-1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(-1, keepdims=True)
        total = max(1.0, float(mask.sum()))
        at = np.arange(count)
        loss = -float((np.log(p[:, at, labels] + 1e-12) * mask).sum()) / total
        delta = p.copy()
        delta[:, at, labels] -= 1
        delta *= mask[:, :, None] / total
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        grad["c"] = delta.sum((0, 1))
        grad["v"][:h] = np.tensordot(s[0], delta, ((0, 1), (0, 1)))
        grad["v"][h:] = np.tensordot(s[1], delta, ((0, 1), (0, 1)))
        into = np.stack([delta @ w["v"][:h].T, (delta @ w["v"][h:].T)[::-1]])
        both, masks = np.stack([codes, codes[::-1]]), np.stack([mask, mask[::-1]])
        back = np.zeros((2, count, h), np.float32)
        for t in range(steps - 1, -1, -1):
            state, keep, reset, inside, fresh = trace[t]
            d = (into[:, t] + back) * masks[:, t, :, None]
            d_fresh = d * (1 - keep) * (1 - fresh * fresh)
            d_keep = d * (state - fresh) * (0.25 * ((keep > 0) & (keep < 1)))
            d_reset = d_fresh * inside * (0.25 * ((reset > 0) & (reset < 1)))
            d_inner = np.concatenate([d_keep, d_reset, d_fresh * reset], axis=2)
            d_input = np.concatenate([d_keep, d_reset, d_fresh], axis=2)
            grad["u"] += state.transpose(0, 2, 1) @ d_inner
            grad["b"] += (d_fresh * reset).sum(1, keepdims=True)
            for i in (0, 1):
                np.add.at(grad["x"][i], both[i, t], d_input[i])
            back = d * keep + d_inner @ w["u"].transpose(0, 2, 1)
        return loss, grad

    def train(self, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray, passes: int = 400, batch: int = 128,
              rate: float = 0.01, seed: int = 11) -> list[float]:
        """Adam over batches drawn with equal chance per class; the loss of every pass."""
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        of_class = [np.flatnonzero(labels == c) for c in np.unique(labels)]
        losses = []
        for step in range(1, passes + 1):
            pick = np.concatenate([draw.choice(x, -(-batch // len(of_class))) for x in of_class])
            loss, grad = self.gradients(codes[:, pick], mask[:, pick], labels[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * (1 - step / (passes + 1)) ** 0.5
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.weights[k] -= np.float32(now) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return losses


def windows_of(text: bytes) -> list[bytes]:
    return [text[i : i + WINDOW] for i in range(0, len(text), WINDOW)]


def _codes(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for w in windows), np.uint8).reshape(-1, WINDOW)
    sizes = np.array([len(w) for w in windows])
    return np.ascontiguousarray(data.T), (np.arange(WINDOW)[:, None] < sizes).astype(np.float32)


def sampled_windows(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                    docs: int = SAMPLE_DOCS, windows: int = SAMPLE_WINDOWS) -> DataFrame:
    """``lang, part``: windows of at most ``docs`` rows of each language, those with the lowest hash of id and text."""
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = usable.groupBy(F.col(lang).alias("_l")).agg(F.count("*").alias("_n"))
    draw = F.shiftrightunsigned(F.xxhash64(key, text), 32)
    # about three times the bound pass before anything is ranked
    near = usable.join(F.broadcast(counts), F.col(lang) == F.col("_l")).where(
        draw <= F.lit(float(3 * docs + 30) * 2**32) / F.col("_n"))
    size = F.octet_length(F.col(text))
    place = lambda j: F.floor(F.greatest(size - WINDOW, F.lit(0)) * j / max(1, windows - 1)).cast("int") + 1
    parts = F.array_distinct(F.array(*[F.substring(F.col(text).cast("binary"), place(j), F.lit(WINDOW)) for j in range(windows)]))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_d", "_k", "parts"))
    return (
        near.select(F.col(lang).alias("lang"), draw.alias("_d"), F.col(key).alias("_k"), parts.alias("parts"))
        .withColumn("_r", rank).where(F.col("_r") <= docs).select("lang", F.explode("parts").alias("part"))
    )


def fitted(labelled: DataFrame, **options) -> tuple[list[str], ByteNetwork | None]:
    """Languages in order of name and the trained network; no language, no network."""
    rows = sorted((r["lang"], bytes(r["part"])) for r in sampled_windows(labelled, **options).collect())
    names = sorted({lang for lang, _ in rows})
    if not names:
        return [], None
    codes, mask = _codes([part for _, part in rows])
    network = ByteNetwork(len(names))
    if len(names) > 1:
        network.train(codes, mask, np.array([names.index(lang) for lang, _ in rows]))
    return names, network


def pooled(network: ByteNetwork, texts: list[bytes], lot: int = 1024) -> np.ndarray:
    """Mean label probabilities over all bytes of each text (zero for an empty one)."""
    classes = len(network.weights["c"])
    sums = np.zeros((len(texts), classes))
    # whole windows need no mask; the rest of each text does
    whole = [np.frombuffer(t, np.uint8)[: len(t) // WINDOW * WINDOW].reshape(-1, WINDOW) for t in texts]
    owners = np.repeat(np.arange(len(texts)), [len(w) for w in whole])
    grid = np.concatenate(whole) if len(owners) else np.zeros((0, WINDOW), np.uint8)
    for at in range(0, len(owners), lot):
        p = network._odds(np.ascontiguousarray(grid[at : at + lot].T), None)
        np.add.at(sums, owners[at : at + lot], p.sum(0).T)
    rest = [(i, t[len(t) // WINDOW * WINDOW :]) for i, t in enumerate(texts) if len(t) % WINDOW]
    rest.sort(key=lambda r: len(r[1]))  # rests of like length together: no step runs on rests that are over
    for at in range(0, len(rest), lot):
        part = rest[at : at + lot]
        codes, mask = _codes([w for _, w in part])
        longest = len(part[-1][1])
        codes, mask = codes[:longest], mask[:longest]
        p = network._odds(codes, mask) * mask[:, None, :]
        np.add.at(sums, [i for i, _ in part], p.sum(0).T)
    return sums / np.maximum(1, [len(t) for t in texts])[:, None]


def predicted(docs: DataFrame, names: list[str], network: ByteNetwork | None, carried: list[str], text: str = "text") -> DataFrame:
    """``carried`` columns, ``lang_pred`` and ``score`` (pooled probability of that language) of every row.

    A null text, one without a letter, and any text when no language was learned
    is ``und`` with score 0.  Ties go to the first name.
    """
    sent, name = docs.sparkSession.sparkContext.broadcast((names, network)), uuid.uuid4().hex
    shown = list(dict.fromkeys([*carried, text]))

    def labelled(network: ByteNetwork | None, names: list[str], batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, readable = batch.column(shown.index(text)).cast(pa.binary()), batch.column(len(shown))
        known = [i for i, r in enumerate(readable.to_pylist()) if r] if network else []
        best, top = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
        if known:
            p = pooled(network, [texts[i].as_py() for i in known])
            best[known], top[known] = p.argmax(1), np.clip(p.max(1), 0, 1)
        preds = [names[b] if b >= 0 else UNKNOWN for b in best]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(shown.index(c)) for c in carried), pa.array(preds, pa.string()), pa.array(top)], [*carried, "lang_pred", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, network = held(name, lambda: sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                yield labelled(network, names, batch.slice(at, TEXTS))

    kinds = dict(docs.select(*carried).dtypes)
    readable = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carried) + ", lang_pred string, score double"
    return map_arrow(docs.select(*shown, readable.alias("_readable")), run, schema)


def identified(docs: DataFrame, modulus: int = 3, remainder: int = 1, carried: list[str] | None = None) -> DataFrame:
    """Predictions for all rows, learned from ``text`` and ``lang`` of those not held out by the crc32 of ``doc_id``."""
    out = held_out("doc_id", modulus, remainder)
    names, network = fitted(docs.where(~out).select("doc_id", "text", "lang"))
    return predicted(docs.withColumn("held_out", out), names, network, [*(carried or ["doc_id"]), "held_out"])
