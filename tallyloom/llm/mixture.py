"""Mixing documents to target token totals per domain, with soft membership.

A softmax classifier, fitted on a bounded sample of the labelled table, gives every
document the posterior of each domain.  A document of ``n`` tokens and rate ``r``
then counts ``r n p_k`` expected tokens in domain ``k``.  Nonnegative rates whose
totals come closest to the targets (least squares, each domain's miss weighed by the
inverse of the domains' second moments, so steps need no tuning and are few) are
found by accelerated projected gradient steps from rate 1.  A step needs one number
per domain from all documents, which each task sums over its own; every task replays
the few steps since the last checkpoint on its rows, so no rates are moved or gathered.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.arrow import map_arrow
from tallyloom.session import settled

#: Bounds of the fit: labelled rows of each domain, and words that become features (met in at least MIN_ROWS of them).
SAMPLE_ROWS, FEATURES, MIN_ROWS = 2000, 1024, 5
CLEAR = 20.0  # least likelihood-ratio statistic of a feature word
_REPLAY = 16  # steps between checkpoints of the rates
_CLEAN = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_SHAPES = 10


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (ASCII) runs of letters."""
    return text.lower().translate(_CLEAN).split()


def _shape(text: bytes, words: list[bytes]) -> list[float]:
    """Shares of capitals, signs, digits; words that repeat the one before; the commonest word; new words; short or no text."""
    size, count = max(1, len(text)), max(1, len(words))
    letters = size - len(text.translate(None, _LETTERS))
    upper = size - len(text.translate(None, _LETTERS[:26]))
    digits = size - len(text.translate(None, b"0123456789"))
    plain = size - len(text.translate(None, b" \t\n\r\x0b\x0c" + bytes(range(128, 256))))
    signs = max(0, size - letters - digits - plain)
    again = sum(map(operator.eq, words, words[1:]))
    counts = Counter(words)
    return [upper / max(1, letters), 4.0 * (signs > 0.06 * size), signs / size, digits / size, 4.0 * (again > 0.1 * count), again / count,
            max(counts.values(), default=0) / count, len(counts) / count, 1.0 if not words else 0.0, min(1.0, 10 / (1 + count))]


class DomainModel:
    """Softmax regression on the presence of chosen words and a few measures of the text's shape."""

    def __init__(self, names: list[str], words: list[bytes]):
        self.names, self.place = names, {w: i for i, w in enumerate(words)}
        self.weights = np.zeros((len(words) + _SHAPES, len(names)), np.float64)
        self.bias = np.zeros(len(names))

    def features(self, text: bytes) -> tuple[list[int], list[float], int]:
        words = words_of(text)
        at = [i for i in map(self.place.get, set(words)) if i is not None]
        base = len(self.place)
        return at + list(range(base, base + _SHAPES)), [1.0] * len(at) + _shape(text, words), len(text.split())

    def fit(self, found: list[tuple[list[int], list[float]]], labels: np.ndarray, shares: np.ndarray, passes: int = 200,
            rate: float = 0.05, penalty: float = 1e-4) -> None:
        """Full-batch descent on the features of the sampled rows: at most rows times features numbers in memory."""
        x = np.zeros((len(found), len(self.weights)), np.float32)
        for row, (at, values) in zip(x, found):
            row[at] = values
        y = np.eye(len(self.names), dtype=np.float32)[labels]
        # a domain weighs what it does among all labelled rows, however many of its rows are here
        weight = (shares / np.maximum(1, y.sum(0)))[labels]
        weight = (weight / weight.sum()).astype(np.float32)
        first = [np.zeros_like(self.weights), np.zeros_like(self.bias)]
        second = [np.zeros_like(self.weights), np.zeros_like(self.bias)]
        for step in range(1, passes + 1):
            delta = (self._softmax(x @ self.weights.astype(np.float32) + self.bias.astype(np.float32)) - y) * weight[:, None]
            grads = [(delta.T @ x).T + penalty * self.weights, delta.sum(0)]
            for g, m, v, w in zip(grads, first, second, (self.weights, self.bias)):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def posteriors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Posterior of each domain and token count (words) of each text."""
        z, n = np.empty((len(texts), len(self.names))), np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            at, value, n[i] = self.features(text)
            z[i] = np.array(value) @ self.weights[at] + self.bias
        return self._softmax(z), n


def domain_of(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of a table ``doc_id, quality, toxic``: toxic, low or high; a null label counts as 0.

    Ids with several rows take the worst.  Rows without an id are left out.
    """
    worst = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce("toxic", F.lit(0))).alias("t"), F.min(F.coalesce("quality", F.lit(0))).alias("q"))
    return worst.select("doc_id", F.when(F.col("t") > 0, "toxic").when(F.col("q") > 0, "high").otherwise("low").alias("domain"))


def fitted(docs: DataFrame, domains: DataFrame, rows: int = SAMPLE_ROWS) -> DomainModel | None:
    """Model of ``doc_id, domain``, learned on the ``rows`` documents of each domain with the lowest hash; None without any."""
    sizes = settled(domains.groupBy("domain").agg(F.count("*").alias("n")))  # one row per domain
    labelled_rows = {r["domain"]: r["n"] for r in sizes.collect()}
    # about three times the bound pass before anything is ranked
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 32)
    near = domains.join(F.broadcast(sizes), "domain").where(draw <= F.lit(float(6 * rows + 60) * 2**32) / F.col("n"))
    sampled = near.withColumn("_r", F.row_number().over(Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id")))
    labelled = sampled.where(F.col("_r") <= 2 * rows).select("doc_id", "domain")  # some ids have no document
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").cast("binary").alias("text"))
    # at most 2 * rows ids of each domain
    found = texts.join(F.broadcast(labelled), "doc_id").withColumn(
        "_r", F.row_number().over(Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id", "text")))
    found = settled(found.where(F.col("_r") <= rows).select("doc_id", "domain", "text"))
    per_domain = {r["domain"]: r["n"] for r in found.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    names = sorted(per_domain)
    if not names:
        return None

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, Counter] = {}
            for domain, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(domain, Counter()).update({w for w in words_of(text.as_py()) if len(w) <= 40})
            for domain, counts in sums.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([domain] * len(counts)), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                    ["domain", "word", "n"])

    counts = map_arrow(found.select("domain", "text"), present, "domain string, word binary, n bigint").groupBy("word").agg(
        *[F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"n{i}") for i, d in enumerate(names)],
        F.sum("n").alias("n"))
    whole = sum(per_domain.values())

    def term(joint: Column, word: Column, domain: int) -> Column:
        return F.when(joint > 0, joint / whole * F.log(joint * F.lit(float(whole)) / (word * F.lit(float(domain))))).otherwise(F.lit(0.0))

    # mutual information of a word's presence with the domain
    gain = sum((term(F.col(f"n{i}"), F.col("n"), per_domain[d])
                + term(F.lit(per_domain[d]) - F.col(f"n{i}"), F.lit(whole) - F.col("n"), per_domain[d]) for i, d in enumerate(names)), F.lit(0.0))
    best = counts.where((F.col("n") >= MIN_ROWS) & (gain * (2 * whole) >= CLEAR)).orderBy(F.desc(F.round(gain, 12)), "word").limit(FEATURES).collect()
    model = DomainModel(names, [bytes(r["word"]) for r in best])

    def lessons_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(t.as_py())[:2] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
                ["domain", "doc_id", "at", "value"])

    kind = dict(found.dtypes)["doc_id"]
    lessons = map_arrow(found.select("domain", "doc_id", "text"), lessons_of, f"domain string, doc_id {kind}, at array<int>, value array<double>")
    if len(names) > 1:
        table = lessons.toArrow()
        held = sorted(zip(*(table.column(c).to_pylist() for c in ("domain", "doc_id", "at", "value"))))
        model.fit([(at, value) for _, _, at, value in held], np.array([names.index(d) for d, *_ in held]),
                  np.array([labelled_rows[n] for n in names], float))
    return model


def memberships(docs: DataFrame, model: DomainModel, carried: list[str]) -> DataFrame:
    """``carried`` columns, ``n_tokens`` and ``p`` (posterior per domain, in the order of ``model.names``) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = sent.value.posteriors([v.as_py() or b"" for v in batch.column(batch.num_columns - 1)])
            width = p.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * width), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n), lists], [*carried, "n_tokens", "p"])

    kinds = dict(docs.dtypes)
    return map_arrow(docs.select(*carried, F.col("text").cast("binary").alias("_bytes")), run,
                     "".join(f"`{c}` {kinds[c]}, " for c in carried) + "n_tokens bigint, p array<double>")


def _steps(count: int) -> list[float]:
    """Momentum of each step."""
    out, t = [], 1.0
    for _ in range(count):
        following = (1 + math.sqrt(1 + 4 * t * t)) / 2
        out.append((t - 1) / following)
        t = following
    return out


def _replayed(rate, last, p, history):
    """Rates after the steps ``(momentum, step vector)``: the point looked at, moved against the residual, kept nonnegative."""
    for momentum, move in history:
        look = rate + momentum * (rate - last)
        last, rate = rate, np.maximum(0.0, look - p @ move)
    return rate, last


def _matrix(batch: pa.RecordBatch, at: int) -> np.ndarray:
    values = batch.column(at).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def rate_plan(members: DataFrame, targets: list[float], steps: int = 60, tolerance: float = 1e-5) -> list[tuple[float, np.ndarray]]:
    """The steps that bring the sums of ``rate * n_tokens * p`` over ``members`` closest to ``targets``.

    Steps are scaled by token count, so rates depend on what a document holds, not
    on its length.  Stops when the residual is below ``tolerance`` of the largest
    target or no longer falls.  ``rates`` replays the plan on any row's posterior.
    """
    wanted = np.array(targets, float)
    width = len(wanted)
    held = settled(members.select("n_tokens", "p").withColumns({"_rate": F.lit(1.0), "_last": F.lit(1.0)}))
    products = held.select(*[
        F.coalesce(F.sum(F.col("n_tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j))), F.lit(0.0)).alias(f"m{i}_{j}")
        for i in range(width) for j in range(width)]).first()
    moments = np.array(products, float).reshape(width, width)
    # with this weight the largest curvature is 1; a domain that no document holds gets no weight
    weigh = np.linalg.pinv(moments, rcond=1e-10, hermitian=True)
    scale = max(1.0, float(np.abs(wanted).max()))
    plan: list[tuple[float, np.ndarray]] = []
    done = 0  # steps that the checkpointed rates already hold

    def totals(momentum: float) -> np.ndarray:
        steps_now = plan[done:]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(width)
            for batch in batches:
                n, p = batch.column(0).to_numpy(), _matrix(batch, 1)
                rate, last = _replayed(batch.column(2).to_numpy(), batch.column(3).to_numpy(), p, steps_now)
                sums += (n * (rate + momentum * (rate - last))) @ p
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

        summed = map_arrow(held, run, "sums array<double>")
        return np.array(summed.select(*[F.coalesce(F.sum(F.get("sums", F.lit(i))), F.lit(0.0)) for i in range(width)]).first(), float)

    def advanced() -> DataFrame:
        steps_now = plan[done:]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rate, last = _replayed(batch.column(2).to_numpy(), batch.column(3).to_numpy(), _matrix(batch, 1), steps_now)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rate), pa.array(last)], batch.schema.names)

        return map_arrow(held, run, "n_tokens bigint, p array<double>, _rate double, _last double")

    best, stale = math.inf, 0
    for momentum in _steps(steps):
        residual = totals(momentum) - wanted
        size = float(np.abs(residual).max()) / scale
        stale = stale + 1 if size > best * 0.999 else 0
        best = min(best, size)
        if size < tolerance or stale >= 10:
            break
        plan.append((momentum, weigh @ residual))
        if len(plan) - done == _REPLAY:
            held = settled(advanced())
            done = len(plan)
    return plan


def rates(p: np.ndarray, plan: list[tuple[float, np.ndarray]]) -> np.ndarray:
    """Rates of rows with posteriors ``p``."""
    one = np.ones(len(p))
    return _replayed(one, one, p, plan)[0]


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], carried: list[str] | None = None) -> DataFrame:
    """Every row with ``n_tokens``, ``p_<domain>`` and the ``rate`` that brings the domains to ``weights`` of all tokens.

    Weights are normed over the learned domains; a domain without one gets none.
    Without any labelled document there is one domain and every rate is 1.
    """
    carried = carried or ["doc_id"]
    model = fitted(docs, domain_of(labels)) or DomainModel(["all"], [])
    members = settled(memberships(docs, model, carried))
    tokens = float(members.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0])
    wanted = [max(0.0, weights.get(n, 0.0)) for n in model.names]
    wanted = wanted if sum(wanted) > 0 else [1.0] * len(wanted)
    plan = rate_plan(members, [tokens * w / sum(wanted) for w in wanted])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rates(_matrix(batch, batch.num_columns - 1), plan))], [*batch.schema.names, "rate"])

    kinds = dict(members.dtypes)
    rated = map_arrow(members, run, ", ".join(f"`{c}` {kinds[c]}" for c in members.columns) + ", rate double")
    return rated.select(*carried, "n_tokens", *[F.get("p", F.lit(i)).alias(f"p_{n}") for i, n in enumerate(model.names)], "rate")


def without_domain(docs: DataFrame, labels: DataFrame, unwanted: str = "toxic", least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that stay when the target of ``unwanted`` is what documents mostly of other domains hold of it.

    The other targets are what those documents hold, so their rates stay near 1
    and the others' fall to 0; a document stays if its rate is at least ``least``
    (that is, rounds to one copy).
    """
    model = fitted(docs, domain_of(labels))
    if model is None or unwanted not in model.names:
        return docs
    at = model.names.index(unwanted)
    members = settled(memberships(docs, model, []))
    kept = members.where(F.get("p", F.lit(at)) < 0.5).select(*[
        F.coalesce(F.sum(F.col("n_tokens") * F.get("p", F.lit(i))), F.lit(0.0)) for i in range(len(model.names))]).first()
    plan = rate_plan(members, list(kept))
    sent = docs.sparkSession.sparkContext.broadcast((model, plan))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, plan = sent.value
            p, _ = model.posteriors([v.as_py() or b"" for v in batch.column(batch.num_columns - 1)])
            stays = rates(p, plan) >= least
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(pa.array(stays))

    # the posterior is computed again: cheaper than moving texts to join their rates
    return map_arrow(docs.withColumn("_bytes", F.col("text").cast("binary")), run,
                     ", ".join(f"`{c}` {kind}" for c, kind in docs.dtypes))
