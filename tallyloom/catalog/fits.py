"""Descent steps and fits, library models and whole flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, sql_draw, sql_uniform, sql_words, table
from tallyloom.catalog.tables import TRIPS_SQL, trip_lines
from tallyloom.catalog.words import _CLASS_SQL, _STOP, IDF_SQL, SIZE, TERMS_SQL, labelled_documents, stem_sql
from tallyloom.functions.losses import hinge, logistic, weighted_hinge
from tallyloom.functions.text import letter_words
from tallyloom.operators import features as ft, measures
from tallyloom.operators.sampling import weighted_split
from tallyloom.plans import descent, documents, forest, mlfit, softmax, trips
from tallyloom.session import settled
from tallyloom.sources.lines import spread
from tallyloom.sources.sinks import reused

# -- squared loss over line items -------------------------------------------------------

INPUTS = ["x0", "x1", "x2", "x3"]


def _items(spark, folder):
    return spread(table(spark, folder, "lineitem")).select(
        F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
        F.lit(1.0).alias("x0"), F.col("l_quantity").alias("x1"), F.col("l_discount").alias("x2"), F.col("l_tax").alias("x3"),
        (F.col("l_extendedprice") / 10000.0).alias("y"))


_ITEMS_SQL = """x AS (SELECT l_orderkey || ':' || l_linenumber AS key, 1.0::DOUBLE AS x0, l_quantity AS x1, l_discount AS x2,
 l_tax AS x3, l_extendedprice / 10000.0::DOUBLE AS y FROM lineitem)"""
_SUMS_SQL = ", ".join(
    ["count(*)::DOUBLE AS n", "sum(y * y) AS yy"]
    + [f"sum(x{i} * y) AS y_{i}" for i in range(4)]
    + [f"sum(x{i} * x{j}) AS x_{i}_{j}" for i in range(4) for j in range(i, 4)])


def _members_sql(keys: str, key: str, batch: int, total: str, passes: int, seed: int = 13) -> str:
    """Which row joins which batch: gaps drawn one after another, as long as there are passes."""
    number = lambda k: sql_uniform(f"{key} || ':' || {k}", seed)
    gap = lambda k: (
        f"CASE WHEN (SELECT n FROM total) <= {batch} THEN 0 ELSE least(floor(ln(1 - {number(k)}) / ln(1 - {batch}.0::DOUBLE / (SELECT n FROM total))), "
        f"{passes})::INT END")
    return f"""total AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM ({total})),
 drawn AS (SELECT {key}, 0 AS k, {gap('0')} AS pass FROM ({keys})
  UNION ALL SELECT {key}, k + 1, pass + 1 + {gap('(k + 1)')} FROM drawn WHERE pass < {passes}),
 members AS MATERIALIZED (SELECT {key}, pass FROM drawn WHERE pass < {passes})"""


def _linear_sql(batches: bool, passes: int, rate: str, tolerance: float | None, batch: int = 50, seed: int = 13) -> str:
    """The descent as a recursive query over the sums of products."""
    xx = [[f"x_{min(i, j)}_{max(i, j)}" for j in range(4)] for i in range(4)]
    row = ["(" + " + ".join(f"{xx[i][j]} * w{j}" for j in range(4)) + ")" for i in range(4)]
    loss = ("(yy - 2 * (" + " + ".join(f"w{i} * y_{i}" for i in range(4)) + ") + "
            + " + ".join(f"w{i} * {row[i]}" for i in range(4)) + ") / divisor")
    grads = ", ".join(f"({row[i]} - y_{i}) / divisor AS g{i}" for i in range(4))
    if batches:
        sums = f"""{_members_sql("SELECT DISTINCT key FROM x", "key", batch, "SELECT 1 FROM x", passes, seed)},
         g AS MATERIALIZED (SELECT pass, {batch}.0::DOUBLE AS divisor, {_SUMS_SQL} FROM x JOIN members USING (key) GROUP BY pass)"""
        link = "g.pass = it.i AND"
    else:
        sums = f"g AS MATERIALIZED (SELECT *, n AS divisor FROM (SELECT {_SUMS_SQL} FROM x))"
        link = ""
    done = f"abs(l - old) <= {tolerance}" if tolerance is not None else "false"
    new = ", ".join(f"w{i} - rate * g{i} AS w{i}" for i in range(4))
    start = ", ".join(f"0.1::DOUBLE AS w{i}" for i in range(4))
    return f"""WITH RECURSIVE {_ITEMS_SQL}, {sums},
 it AS (SELECT 0::BIGINT AS i, {start}, {rate}::DOUBLE AS rate, 0.0::DOUBLE AS old, false AS done
  UNION ALL SELECT i + 1, {new}, CASE WHEN l < old THEN rate * 1.05::DOUBLE ELSE rate * 0.5::DOUBLE END, l, {done}
  FROM (SELECT it.*, {loss} AS l, {grads} FROM it, g WHERE {link} NOT it.done AND it.i < {passes}))"""


_WEIGHTS_OUT = """ SELECT pos, round(w, 6) AS w FROM (SELECT unnest([0, 1, 2, 3])::INT AS pos, unnest([w0, w1, w2, w3]) AS w
 FROM it WHERE i = (SELECT max(i) FROM it))"""
_RATE = "1e-4"


def _rounded_weights(fit, spark, digits=6):
    return fit.weight_table(spark).withColumn("w", F.round("w", digits))


@query(f"WITH {_ITEMS_SQL} SELECT " + ", ".join(
    ["round(avg(pow(y - 0.1 * (x0 + x1 + x2 + x3), 2)), 6) AS loss"]
    + [f"round(avg(-x{i} * (y - 0.1 * (x0 + x1 + x2 + x3))), 6) AS g{i}" for i in range(4)]) + " FROM x")
def linreg_step(spark, folder):
    row = descent.product_sums(_items(spark, folder), INPUTS, "y")
    w = [F.lit(0.1)] * 4
    xx = lambda i, j: F.col(f"x_{min(i, j)}_{max(i, j)}")
    xw = [sum((xx(i, j) * w[j] for j in range(4)), F.lit(0.0)) for i in range(4)]
    loss = F.col("yy") - 2 * sum((w[i] * F.col(f"y_{i}") for i in range(4)), F.lit(0.0)) + sum(
        (w[i] * xw[i] for i in range(4)), F.lit(0.0))
    return row.select(
        F.round(loss / F.col("n"), 6).alias("loss"),
        *[F.round((xw[i] - F.col(f"y_{i}")) / F.col("n"), 6).alias(f"g{i}") for i in range(4)])


@query(_linear_sql(False, 3, _RATE, None) + _WEIGHTS_OUT)
def linreg_three_steps(spark, folder):
    fit = descent.fit_linear(_items(spark, folder), INPUTS, "y", rate=1e-4, tolerance=None, passes=3)
    return _rounded_weights(fit, spark)


@query(_linear_sql(False, 300, _RATE, 0.1) + _WEIGHTS_OUT)
def linreg_fit(spark, folder):
    fit = descent.fit_linear(_items(spark, folder), INPUTS, "y", rate=1e-4, tolerance=0.1, passes=300)
    return _rounded_weights(fit, spark)


@query(_linear_sql(False, 300, _RATE, 0.1) + " SELECT i::INT AS iteration, round(old, 6) AS loss FROM it WHERE i > 0 AND NOT done")
def linreg_losses(spark, folder):
    fit = descent.fit_linear(_items(spark, folder), INPUTS, "y", rate=1e-4, tolerance=0.1, passes=300)
    return fit.loss_table(spark).withColumn("loss", F.round("loss", 6))


@query(_linear_sql(True, 300, _RATE, None) + _WEIGHTS_OUT)
def linreg_minibatch_fit(spark, folder):
    fit = descent.fit_linear_batches(
        _items(spark, folder), INPUTS, "y", "key", size=50, rate=1e-4, passes=300, fast=False)
    return _rounded_weights(fit, spark)


# -- the trip regression from lines to mean squared error ---------------------------------------

def _trip_fit_sql(passes: int, rate: str, tolerance: float) -> str:
    """Valid trips, nine tenths for the sums of products, the descent over them, the error on the rest."""
    width = len(trips.INPUTS)
    xx = [[f"x_{min(i, j)}_{max(i, j)}" for j in range(width)] for i in range(width)]
    sums = ", ".join(["count(*)::DOUBLE AS n", "sum(y * y) AS yy"] + [f"sum(x{i} * y) AS y_{i}" for i in range(width)]
                     + [f"sum(x{i} * x{j}) AS x_{i}_{j}" for i in range(width) for j in range(i, width)])
    row = ["(" + " + ".join(f"{xx[i][j]} * w{j}" for j in range(width)) + ")" for i in range(width)]
    loss = ("(yy - 2 * (" + " + ".join(f"w{i} * y_{i}" for i in range(width)) + ") + "
            + " + ".join(f"w{i} * {row[i]}" for i in range(width)) + ") / n")
    grads = ", ".join(f"({row[i]} - y_{i}) / n AS g{i}" for i in range(width))
    pred = " + ".join(f"x{i} * w{i}" for i in range(width))
    return f"""WITH RECURSIVE {TRIPS_SQL.removeprefix('WITH ')},
 x AS MATERIALIZED (SELECT {sql_uniform("l_orderkey || ':' || l_linenumber")} < 0.9::DOUBLE AS train, 1.0::DOUBLE AS x0,
  seconds / 60.0::DOUBLE AS x1, miles AS x2, fare AS x3, extra AS x4, fare AS y FROM valid),
 g AS MATERIALIZED (SELECT {sums} FROM x WHERE train),
 it AS (SELECT 0::BIGINT AS i, {", ".join(f"0.1::DOUBLE AS w{i}" for i in range(width))}, {rate}::DOUBLE AS rate, 0.0::DOUBLE AS old, false AS done
  UNION ALL SELECT i + 1, {", ".join(f"w{i} - rate * g{i}" for i in range(width))},
   CASE WHEN l < old THEN rate * 1.05::DOUBLE ELSE rate * 0.5::DOUBLE END, l, abs(l - old) <= {tolerance}
  FROM (SELECT it.*, {loss} AS l, {grads} FROM it, g WHERE NOT it.done AND it.i < {passes})),
 w AS (SELECT * FROM it WHERE i = (SELECT max(i) FROM it))
 SELECT i AS passes, count(*) AS n, round(sum(y), 4) AS sum_y, round(avg(pow(y - ({pred}), 2)), 6) AS mse FROM x, w WHERE NOT train GROUP BY i"""


@query(_trip_fit_sql(300, "1e-4", 0.1))
def trip_regression(spark, folder):
    lines = trip_lines(spark, folder).select(
        F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"), "value")
    fit, measured = trips.run_trips(lines)
    passes = fit.stopped_at or len(fit.losses)
    return measured.select(F.lit(passes).cast("bigint").alias("passes"), "n", F.round("sum_y", 4).alias("sum_y"), F.round("mse", 6).alias("mse"))


# -- margins over term weights ---------------------------------------------------------------

def _docs(spark, folder):
    docs = labelled_documents(spark, folder)
    return docs.select("doc_id", F.col("quality").alias("label"), letter_words("text").alias("words"))


_DOCS_SQL = f"""docs AS MATERIALIZED (SELECT doc_id, quality AS label, {sql_words()} AS words
 FROM documents JOIN labels USING (doc_id)), {TERMS_SQL}"""


def _margin_sql(model: str, passes: int, rate: float, penalty: str, idf: bool = True, batch: int | None = None,
                seed: int = 13) -> str:
    """The descent unrolled: margins, loss, gradient, weights and step of each pass."""
    negative = "0.0" if model == "logistic" else "-1.0"
    feats = f"""{IDF_SQL}, feats AS MATERIALIZED (SELECT tf.doc_id, tf.pos, value * idf AS value,
      CASE WHEN label = 1 THEN 1.0::DOUBLE ELSE {negative}::DOUBLE END AS y FROM tf JOIN idf USING (pos) JOIN docs USING (doc_id))""" if idf else f"""
      feats AS MATERIALIZED (SELECT tf.doc_id, tf.pos, value,
      CASE WHEN label = 1 THEN 1.0::DOUBLE ELSE {negative}::DOUBLE END AS y FROM tf JOIN docs USING (doc_id))"""
    share = """, pr AS MATERIALIZED (SELECT count(DISTINCT doc_id) FILTER (y > 0) / (SELECT count(*) FROM docs)::DOUBLE AS pr FROM feats)"""
    loss = {
        "logistic": "-y * m + greatest(m, 0) + ln(1 + exp(-abs(m)))",
        "hinge": "greatest(0, 1 - y * m)",
        "weighted": "greatest(0, (CASE WHEN y > 0 THEN 1 - pr ELSE pr END) * (1 - y * m))",
    }[model]
    slope = {
        "logistic": "1 / (1 + exp(-m)) - y",
        "hinge": "CASE WHEN y * m > 1 THEN 0 ELSE -y END",
        "weighted": "CASE WHEN y * m > 1 THEN 0 ELSE -y * (CASE WHEN y > 0 THEN 1 - pr ELSE pr END) END",
    }[model]
    full_loss, full_gradient = {
        "none": ("raw", "coalesce(g, 0)"),
        "scalar": ("raw + 2 * {f} * norm", "coalesce(g, 0) + 2 * {f} * norm"),
        "batch": ("{r} * 0.5 * norm + raw / {b}", "{r} * w + coalesce(g, 0) / {b}"),
    }[penalty.split(":")[0]]
    parts = penalty.split(":")
    fill = {"f": f"{parts[1]}::DOUBLE" if len(parts) > 1 else "0"}
    if batch:
        fill |= {"b": f"{batch}.0::DOUBLE", "r": f"(1.0::DOUBLE / ({parts[1]}::DOUBLE * {batch}))"}
    full_loss, full_gradient = full_loss.format(**fill), full_gradient.format(**fill)
    steps = [f" w0 AS MATERIALIZED (SELECT pos, 0.1::DOUBLE AS w FROM terms)",
             f" st0 AS (SELECT {rate}::DOUBLE AS rate, 0.0::DOUBLE AS old)"]
    for i in range(passes):
        member = f"JOIN members USING (doc_id) WHERE pass = {i}" if batch else ""
        steps += [
            f""" m{i} AS MATERIALIZED (SELECT doc_id, any_value(y) AS y, sum(value * w) AS m
                 FROM feats JOIN w{i} USING (pos) {member} GROUP BY doc_id)""",
            f""" l{i} AS MATERIALIZED (SELECT {full_loss} AS loss, norm FROM (SELECT sum({loss}) AS raw,
                 (SELECT sqrt(sum(w * w)) FROM w{i}) AS norm FROM m{i}, pr))""",
            f" g{i} AS MATERIALIZED (SELECT f.pos, sum(({slope}) * value) AS g FROM feats f JOIN m{i} ON f.doc_id = m{i}.doc_id, pr GROUP BY f.pos)"
            .replace("y * m", f"m{i}.y * m").replace("- y", f"- m{i}.y").replace("-y", f"-m{i}.y").replace("WHEN y >", f"WHEN m{i}.y >"),
            f""" w{i + 1} AS MATERIALIZED (SELECT w{i}.pos, w - rate * ({full_gradient}) AS w
                 FROM w{i} LEFT JOIN g{i} ON w{i}.pos = g{i}.pos, st{i}, l{i})""",
            f""" st{i + 1} AS (SELECT CASE WHEN loss < old THEN rate * 1.05::DOUBLE ELSE rate * 0.5::DOUBLE END AS rate, loss AS old
                 FROM st{i}, l{i})""",
        ]
    drawn = ", " + _members_sql("SELECT DISTINCT doc_id FROM feats", "doc_id", batch, "SELECT 1 FROM docs", passes, seed) if batch and passes else ""
    return f"WITH RECURSIVE {_DOCS_SQL}, {feats}{share}{drawn}, " + ",".join(steps)


def _whole_sql(model: str, passes: int, rate: float, tolerance: float, penalty: str, idf: bool = True, batch: int | None = None,
               seed: int = 13) -> str:
    start = _margin_sql(model, 0, rate, penalty, idf, batch, seed)
    prelude = start[len("WITH RECURSIVE "):].rsplit(", w0 AS MATERIALIZED", 1)[0].rstrip().rstrip(",")
    return _descent_sql(prelude, model, passes, rate, tolerance, penalty, batch, seed)


def _descent_sql(prelude: str, model: str, passes: int, rate: float, tolerance: float, penalty: str, batch: int | None = None,
                 seed: int = 13, total: str = "SELECT 1 FROM docs") -> str:
    """The whole descent with its stop test as a recursive query over ``feats``; the weights are one list per pass."""
    loss = {
        "logistic": "-y * m + greatest(m, 0) + ln(1 + exp(-abs(m)))",
        "hinge": "greatest(0, 1 - y * m)",
        "weighted": "greatest(0, (CASE WHEN y > 0 THEN 1 - pr ELSE pr END) * (1 - y * m))",
    }[model]
    slope = {
        "logistic": "1 / (1 + exp(-m)) - m.y",
        "hinge": "CASE WHEN m.y * m > 1 THEN 0 ELSE -m.y END",
        "weighted": "CASE WHEN m.y * m > 1 THEN 0 ELSE -m.y * (CASE WHEN m.y > 0 THEN 1 - pr ELSE pr END) END",
    }[model]
    kind, _, factor = penalty.partition(":")
    b = f"{batch}.0::DOUBLE" if batch else "1"
    r = f"(1.0::DOUBLE / ({factor or 1}::DOUBLE * {b}))"
    whole_loss, whole_gradient = {
        "none": ("raw", "z[2]"),
        "scalar": (f"raw + 2 * {factor}::DOUBLE * norm", f"(z[2] + 2 * {factor}::DOUBLE * norm)"),
        "batch": (f"{r} * 0.5 * norm + raw / {b}", f"({r} * z[1] + z[2] / {b})"),
    }[kind]
    member, drawn = "", ""
    if batch:
        member = "AND b.doc_id = f.doc_id AND b.pass = it.i"
        drawn = _members_sql("SELECT DISTINCT doc_id FROM feats", "doc_id", batch, total, passes, seed) + ","
    margins = f"""SELECT f.doc_id, any_value(f.y) AS y, sum(f.value * it.w[f.pos + 1]) AS m FROM feats f, it{", members b" if batch else ""}
      WHERE NOT it.done AND it.i < {passes} {member} GROUP BY f.doc_id"""
    return f"""WITH RECURSIVE {prelude}, {drawn}
 it AS (SELECT 0::BIGINT AS i, (SELECT list(0.1::DOUBLE) FROM terms) AS w, {rate}::DOUBLE AS rate, 0.0::DOUBLE AS old, false AS done
  UNION ALL
  SELECT i + 1, list_transform(list_zip(w, gs), lambda z: z[1] - rate * {whole_gradient}),
   CASE WHEN {whole_loss} < old THEN rate * 1.05::DOUBLE ELSE rate * 0.5::DOUBLE END, {whole_loss},
   abs({whole_loss} - old) <= {tolerance}
  FROM (SELECT it.*, sqrt(list_sum(list_transform(it.w, lambda x: x * x))) AS norm, l.raw, g.gs
   FROM it, (SELECT sum({loss}) AS raw FROM ({margins}) m, pr) l,
    (SELECT list(coalesce(k.g, 0) ORDER BY t.pos) AS gs FROM terms t LEFT JOIN
      (SELECT f.pos, sum(({slope}) * f.value) AS g FROM feats f JOIN ({margins}) m ON f.doc_id = m.doc_id, pr GROUP BY f.pos) k
      ON t.pos = k.pos) g
   WHERE NOT it.done AND it.i < {passes}))"""


_WHOLE_OUT = """ SELECT (generate_subscripts(w, 1) - 1)::INT AS pos, round(unnest(w), 6) AS w FROM it
 WHERE i = (SELECT max(i) FROM it)"""


def _out(passes: int) -> str:
    return f" SELECT pos, round(w, 9) AS w FROM w{passes}"


def _losses_out(passes: int) -> str:
    rows = " UNION ALL ".join(f"SELECT {i + 1} AS iteration, loss FROM l{i}" for i in range(passes))
    return f" SELECT iteration::INT AS iteration, round(loss, 6) AS loss FROM ({rows})"


def _prepared(spark, folder, negative, use_idf=True):
    docs = _docs(spark, folder)
    terms = settled(ft.training_dictionary(docs, SIZE))
    features = ft.training_weights(docs, terms, carry=["label"], use_idf=use_idf)
    return docs, terms, descent.with_target(settled(features), F.col("label") == 1, negative)


def _fit(spark, folder, model, rule, penalty, use_idf=True, batch=None):
    docs, terms, features = _prepared(spark, folder, -1.0 if model != "logistic" else 0.0, use_idf)
    width = terms.count()
    if model == "weighted":
        loss = weighted_hinge(measures.positive_share(docs, features, F.col("label") == 1).first()["pr"])
    else:
        loss = logistic() if model == "logistic" else hinge()
    if batch is None:
        return descent.fit_margin(features, width, loss, rule, penalty)
    return descent.fit_margin_batches(features, width, loss, rule, batch, docs.count(), penalty, fast=False)


def _step(spark, folder, model, use_idf=True):
    """Gradient of one pass at equal weights of 0.1."""
    docs, _, features = _prepared(spark, folder, -1.0 if model != "logistic" else 0.0, use_idf)
    if model == "weighted":
        loss = weighted_hinge(measures.positive_share(docs, features, F.col("label") == 1).first()["pr"])
    else:
        loss = logistic() if model == "logistic" else hinge()
    flat = features.select("pos").distinct().withColumn("w", F.lit(0.1))
    sums = descent.pass_sums(descent.arranged(features), flat, loss)
    return sums.select("pos", F.round("gradient", 9).alias("gradient"))


_STEP_OUT = " SELECT pos, round(g, 9) AS gradient FROM g0"


@query(_margin_sql("logistic", 1, 0.01, "none") + _STEP_OUT)
def logreg_step(spark, folder):
    return _step(spark, folder, "logistic")


@query(_margin_sql("hinge", 1, 0.01, "none") + _STEP_OUT)
def svm_step(spark, folder):
    return _step(spark, folder, "hinge")


@query(_margin_sql("weighted", 1, 0.1, "none", idf=False) + _STEP_OUT)
def weighted_svm_step(spark, folder):
    return _step(spark, folder, "weighted", use_idf=False)


_PASSES = 5


def _logreg(spark, folder):
    rule = descent.Descent(0.01, None, _PASSES)
    return _fit(spark, folder, "logistic", rule, descent.scalar_norm_penalty(1e-4))


@query(_margin_sql("logistic", _PASSES, 0.01, "scalar:1e-4") + _out(_PASSES))
def logreg_fit(spark, folder):
    return _rounded_weights(_logreg(spark, folder), spark, 9)


@query(_margin_sql("logistic", _PASSES, 0.01, "scalar:1e-4") + _losses_out(_PASSES))
def logreg_losses(spark, folder):
    return _logreg(spark, folder).loss_table(spark).withColumn("loss", F.round("loss", 6))


@query(_margin_sql("logistic", _PASSES, 0.001, "scalar:1e-3", batch=100) + _out(_PASSES))
def logreg_minibatch_fit(spark, folder):
    rule = descent.Descent(0.001, None, _PASSES)
    fit = _fit(spark, folder, "logistic", rule, descent.scalar_norm_penalty(1e-3), batch=100)
    return _rounded_weights(fit, spark, 9)


@query(_margin_sql("hinge", _PASSES, 0.01, "batch:0.1", batch=100) + _out(_PASSES))
def svm_fit(spark, folder):
    rule = descent.Descent(0.01, None, _PASSES)
    fit = _fit(spark, folder, "hinge", rule, descent.batch_norm_penalty(0.1, 100), batch=100)
    return _rounded_weights(fit, spark, 9)


@query(_margin_sql("weighted", _PASSES, 0.1, "none", idf=False) + _out(_PASSES))
def weighted_svm_fit(spark, folder):
    rule = descent.Descent(0.1, None, _PASSES)
    return _rounded_weights(_fit(spark, folder, "weighted", rule, descent.no_penalty, use_idf=False), spark, 9)


# -- the same fits at their published length, with the stop test ------------------------------

def _whole(variant: str):
    return {
        "logistic": ("logistic", descent.Descent(0.01, 0.01, 300), descent.scalar_norm_penalty(1e-4), True, None),
        "weighted": ("weighted", descent.Descent(0.1, 0.1, 500), descent.no_penalty, False, None),
        "logistic_batches": ("logistic", descent.Descent(0.001, 0.1, 300), descent.scalar_norm_penalty(1e-3), True, 100),
        "svm_batches": ("hinge", descent.Descent(0.01, 1e-4, 200), descent.batch_norm_penalty(0.1, 100), True, 100),
    }[variant]


@query(_whole_sql("logistic", 300, 0.01, 0.01, "scalar:1e-4") + _WHOLE_OUT)
def logreg_whole_fit(spark, folder):
    return _rounded_weights(_fit(spark, folder, *_whole("logistic")), spark)


@query(_whole_sql("weighted", 500, 0.1, 0.1, "none", idf=False) + _WHOLE_OUT)
def weighted_svm_whole_fit(spark, folder):
    return _rounded_weights(_fit(spark, folder, *_whole("weighted")), spark)


@query(_whole_sql("logistic", 300, 0.001, 0.1, "scalar:1e-3", batch=100) + _WHOLE_OUT)
def logreg_minibatch_whole_fit(spark, folder):
    return _rounded_weights(_fit(spark, folder, *_whole("logistic_batches")), spark)


@query(_whole_sql("hinge", 200, 0.01, 1e-4, "batch:0.1", batch=100) + _WHOLE_OUT)
def svm_whole_fit(spark, folder):
    return _rounded_weights(_fit(spark, folder, *_whole("svm_batches")), spark)


@query(_margin_sql("logistic", 1, 1.0, "none") + """ SELECT term, pos, round(w, 9) AS w FROM w1 JOIN terms USING (pos)
 ORDER BY round(w, 9) DESC, pos LIMIT 25""")
def top_coefficients(spark, folder):
    _, terms, features = _prepared(spark, folder, 0.0)
    fit = descent.fit_margin(features, terms.count(), logistic(), descent.Descent(1.0, None, 1))
    return measures.top_terms(_rounded_weights(fit, spark, 9), terms, 25).select("term", "pos", "w")


@query(_margin_sql("logistic", 1, 1.0, "none") + """ SELECT doc_id, round(sum(value * w), 9) AS margin,
 CASE WHEN sum(value * w) > 0.5 THEN 1 ELSE 0 END AS pred FROM feats JOIN w1 USING (pos) GROUP BY doc_id""")
def score_documents(spark, folder):
    _, terms, features = _prepared(spark, folder, 0.0)
    fit = descent.fit_margin(features, terms.count(), logistic(), descent.Descent(1.0, None, 1))
    scored = measures.score_features(features, fit.weight_table(spark), threshold=0.5)
    return scored.withColumn("margin", F.round("margin", 9))


# -- regression of several classes, forest -----------------------

def _vectors(spark, folder):
    return mlfit.dense_vectors(
        table(spark, folder, "embeddings").withColumn("label", F.col("label").cast("double")), "embedding")


# The optimum of a strictly convex loss does not depend on the way there: SQL takes accelerated steps of fixed size.
_SOFTMAX_SQL = """WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
 long AS (SELECT unnest(range(len(x))) AS pos, unnest(x) AS v FROM e),
 sd AS MATERIALIZED (SELECT list(CASE WHEN s > 1e-12 THEN 1 / s ELSE 0 END ORDER BY pos) AS inv FROM (SELECT pos, stddev_samp(v) AS s FROM long GROUP BY pos)),
 z AS MATERIALIZED (SELECT vec_id, label::DOUBLE AS label, list_transform(list_zip(x, inv), lambda p: p[1] * p[2]) AS z FROM e, sd),
 k AS MATERIALIZED (SELECT DISTINCT label FROM z),
 c AS MATERIALIZED (SELECT count(*)::DOUBLE AS n, 0.5 * avg(list_inner_product(z, z)) + 1 AS big, any_value(len(z)) AS d FROM z),
 it AS (SELECT 0 AS i, label, list_transform(range(d), lambda q: 0.0::DOUBLE) AS w, list_transform(range(d), lambda q: 0.0::DOUBLE) AS y FROM k, c
  UNION ALL
  SELECT i + 1, label, w2, list_transform(list_zip(w2, w), lambda p: p[1] + (sqrt(big) - 1) / (sqrt(big) + 1) * (p[1] - p[2]))
  FROM (SELECT it.i, it.label, it.w, c.big, list_transform(list_zip(it.y, g.g), lambda p: p[1] - (p[2] / n + p[1]) / big) AS w2
   FROM it, c, (
    SELECT label, list(s ORDER BY pos) AS g FROM (
     SELECT label, pos, sum(r * v) AS s FROM (
      SELECT label, r, unnest(range(len(z))) AS pos, unnest(z) AS v FROM (
       SELECT k.label, m.z, exp(m.m - m.top) / sum(exp(m.m - m.top)) OVER (PARTITION BY m.vec_id) - (m.label = k.label)::INT AS r
       FROM (SELECT z.vec_id, z.label, z.z, it.label AS cls, list_inner_product(z.z, it.y) AS m,
         max(list_inner_product(z.z, it.y)) OVER (PARTITION BY z.vec_id) AS top FROM z, it WHERE it.i < {steps}) m JOIN k ON k.label = m.cls)) GROUP BY label, pos) GROUP BY label) g
   WHERE g.label = it.label AND it.i < {steps})),
 w AS MATERIALIZED (SELECT label, list_transform(list_zip(w, inv), lambda p: p[1] * p[2]) AS w FROM it, sd WHERE i = {steps})"""


def _softmax(spark, folder):
    features = settled(softmax.exploded(table(spark, folder, "embeddings"), "embedding", ["vec_id", "label"]))
    return features, softmax.fit_softmax(features, features.agg(F.max("pos") + 1).first()[0], key="vec_id")


@query(_SOFTMAX_SQL.format(steps=120) + """ SELECT vec_id, label, cls AS pred FROM (
 SELECT e.vec_id, e.label, w.label AS cls, row_number() OVER (PARTITION BY e.vec_id ORDER BY list_inner_product(x, w.w) DESC, w.label) AS i FROM e, w) WHERE i = 1""")
def multinomial_lr(spark, folder):
    features, fit = _softmax(spark, folder)
    return softmax.predict_softmax(features, fit, ["vec_id", "label"])


@query(_SOFTMAX_SQL.format(steps=120) + """ SELECT label AS cls, unnest(range(len(w)))::INT AS pos, round(unnest(w), 6) AS w, true AS optimal FROM w""")
def multinomial_weights(spark, folder):
    """The weights, and whether no component of the penalised gradient is left above a millionth."""
    _, fit = _softmax(spark, folder)
    return fit.weight_table(spark).withColumns({"w": F.round("w", 6), "optimal": F.lit(bool(fit.certificate < 1e-6))})


def _forest_sql(trees: int = 3, depth: int = 4, bins: int = 32, seed: int = 13) -> str:
    """The same trees: one pair of tables per level, ends at the class with the largest sum of leaf shares."""
    weight = " + ".join(f"({sql_uniform(chr(39).join(['vec_id || ', ':', ' || tree']), seed)} >= {c!r}::DOUBLE)::INT" for c in forest.POISSON)
    parts = [f"""WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label::DOUBLE AS label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
 long AS MATERIALIZED (SELECT r, unnest(range(len(x)))::INT AS pos, unnest(x) AS v FROM e),
 spans AS MATERIALIZED (SELECT pos, min(v) AS lo, max(v) - min(v) AS span FROM long GROUP BY pos),
 cells AS MATERIALIZED (SELECT r, pos, CASE WHEN span > 0 THEN least({forest.CELLS - 1}, floor((v - lo) / span * {forest.CELLS}.0::DOUBLE)) ELSE 0 END::INT AS cell FROM long JOIN spans USING (pos)),
 held AS (SELECT pos, cell, count(*) AS n FROM cells GROUP BY pos, cell),
 cuts AS MATERIALIZED (SELECT pos, cell, ((sum(n) OVER (PARTITION BY pos ORDER BY cell) - n) * {bins} // sum(n) OVER (PARTITION BY pos))::INT AS bin FROM held),
 b AS MATERIALIZED (SELECT r, pos, bin FROM cells JOIN cuts USING (pos, cell)),
 s0 AS MATERIALIZED (SELECT r, vec_id, label, tree, 1 AS node, {weight} AS w FROM e, (SELECT unnest(range({trees}))::INT AS tree))"""]
    for i in range(depth):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT tree, node, pos FROM (
  SELECT tree, node, pos, row_number() OVER (PARTITION BY tree, node ORDER BY {sql_draw("tree || ':' || node || ':' || pos", f"{seed}f")}, pos) AS q
  FROM (SELECT DISTINCT tree, node FROM s{i} WHERE w > 0 AND node >= {1 << i}), spans) WHERE q <= (SELECT ceil(sqrt(count(*))) FROM spans)),
 h{i} AS MATERIALIZED (SELECT tree, node, pos, bin, label, sum(w) AS n FROM s{i} JOIN a{i} USING (tree, node) JOIN b USING (r, pos) WHERE w > 0 GROUP BY ALL),
 g{i} AS (SELECT c.tree, c.node, c.pos, c.bin, h.label, coalesce(sum(n) FILTER (h.bin <= c.bin), 0) AS l, coalesce(sum(n) FILTER (h.bin > c.bin), 0) AS r
  FROM (SELECT DISTINCT tree, node, pos, bin FROM h{i}) c JOIN h{i} h USING (tree, node, pos) GROUP BY ALL),
 k{i} AS (SELECT tree, node, pos, bin, sum(l * l)::DOUBLE / sum(l)::DOUBLE + sum(r * r)::DOUBLE / nullif(sum(r), 0)::DOUBLE AS score,
   sum((l + r) * (l + r))::DOUBLE / sum(l + r)::DOUBLE AS whole FROM g{i} GROUP BY ALL),
 f{i} AS MATERIALIZED (SELECT tree, node, pos, bin AS cut FROM k{i} WHERE score > whole
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, pos, bin) = 1),
 s{i + 1} AS MATERIALIZED (SELECT s.r, vec_id, label, s.tree, CASE WHEN f.pos IS NULL THEN s.node ELSE 2 * s.node + (b.bin > f.cut)::INT END AS node, w
  FROM s{i} s LEFT JOIN f{i} f ON s.tree = f.tree AND s.node = f.node LEFT JOIN b ON b.r = s.r AND b.pos = f.pos)""")
    parts.append(f"""leaf AS MATERIALIZED (SELECT tree, node, label AS cls, n * {forest.SHARE} // sum(n) OVER (PARTITION BY tree, node) AS share
  FROM (SELECT tree, node, label, sum(w) AS n FROM s{depth} WHERE w > 0 GROUP BY ALL))
SELECT vec_id, label, cls AS pred FROM (SELECT r, vec_id, label, cls, sum(share) AS votes FROM s{depth} JOIN leaf USING (tree, node) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY votes DESC, cls) = 1""")
    return ",\n ".join(parts)


@query(_forest_sql())
def random_forest(spark, folder):
    rows = _vectors(spark, folder).select("vec_id", "label", "embedding")
    fitted = forest.fit_forest(rows, "vec_id", vector="embedding")
    return forest.predict_forest(rows, fitted, ["vec_id", "label"], vector="embedding")


def _flow_sql(name: str, passes: int, penalty: str) -> str:
    """Split, dictionary, fit, scores and counts of every task of a flow."""
    preset = documents.PRESETS[name]
    model = {"weighted_hinge": "weighted"}.get(preset.model, preset.model)
    train = sql_uniform("doc_id", 13) + " < 0.8::DOUBLE"
    if preset.stem:
        words = f"""raw AS MATERIALIZED (SELECT doc_id, unnest({sql_words()}) AS term FROM documents JOIN labels USING (doc_id)), {stem_sql("raw")},
 kept AS MATERIALIZED (SELECT doc_id, list(stem) AS words FROM raw JOIN stems USING (term) WHERE stem NOT IN ({_STOP}) GROUP BY doc_id),
 every AS MATERIALIZED (SELECT doc_id, {_CLASS_SQL} AS label, coalesce(words, []) AS words, {train} AS train
  FROM documents JOIN labels USING (doc_id) LEFT JOIN kept USING (doc_id))"""
    else:
        words = f"""every AS MATERIALIZED (SELECT doc_id, {_CLASS_SQL} AS label, {sql_words()} AS words, {train} AS train
  FROM documents JOIN labels USING (doc_id))"""
    hit = {
        "one_vs_rest": ("label = {t} AND pred = {t}", "label <> {t} AND pred <> {t}", "label <> {t} AND pred = {t}", "label = {t} AND pred <> {t}"),
        "exclude_other": ("label = {t} AND pred = {t}", "label = 0 AND pred = 0", "label = 0 AND pred <> 0", "label = {t} AND pred <> {t}"),
        "label_equality": ("label = {t} AND pred = {t}", "label <> {t} AND pred = label", "label <> {t} AND pred <> label", "label = {t} AND pred <> {t}"),
    }[preset.policy]
    parts = []
    for task, target, without in preset.tasks:
        own = f"WHERE label <> {without}" if without is not None else ""
        value, joined = ("value * idf", "JOIN idf USING (pos)") if preset.use_idf else ("value", "")
        total = "SELECT 1 FROM docs" if without is None else "SELECT DISTINCT doc_id FROM feats"
        negative = "0.0" if model == "logistic" else "-1.0"
        prelude = f"""{words}, docs AS MATERIALIZED (SELECT doc_id, label, words FROM every WHERE train), {TERMS_SQL}, {IDF_SQL},
 feats AS MATERIALIZED (SELECT tf.doc_id, tf.pos, {value} AS value,
  CASE WHEN label = {target} THEN 1.0::DOUBLE ELSE {negative}::DOUBLE END AS y FROM tf {joined} JOIN docs USING (doc_id) {own}),
 pr AS MATERIALIZED (SELECT count(DISTINCT doc_id) FILTER (y > 0) / (SELECT count(*) FROM docs {own})::DOUBLE AS pr FROM feats)"""
        factor = "value * ln((SELECT count(DISTINCT doc_id) FROM held)::DOUBLE / (1 + hdf))" if preset.use_idf else "value"
        counts = [f"count(*) FILTER ({h.format(t=target)}) AS {c}" for h, c in zip(hit, ("tp", "tn", "fp", "fn"))]
        descent_sql = _descent_sql(prelude, model, passes, preset.rate, preset.tolerance, penalty, preset.batch, 13, total)
        parts.append(f"""(SELECT '{task}' AS task, * FROM ({descent_sql},
 held AS MATERIALIZED (SELECT DISTINCT doc_id, label, pos, 1.0::DOUBLE / doc_len AS value FROM
  (SELECT doc_id, label, len(words) AS doc_len, unnest(words) AS term FROM every WHERE NOT train) JOIN terms USING (term)),
 f AS (SELECT pos, count(*) AS hdf FROM held GROUP BY pos),
 fitted AS (SELECT generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS w FROM it WHERE i = (SELECT max(i) FROM it)),
 said AS (SELECT doc_id, label, CASE WHEN sum({factor} * w) > 0 THEN {target} ELSE 0 END AS pred
  FROM held JOIN f USING (pos) JOIN fitted USING (pos) GROUP BY doc_id, label)
 SELECT (SELECT max(i) FROM it)::INT AS losses, {", ".join(counts)} FROM said))""")
    return f"""WITH c AS ({" UNION ALL ".join(parts)}),
 r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE END AS r FROM c)
 SELECT task, losses, tp, tn, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END, 4) AS f_score,
  round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 4) AS accuracy FROM r"""


def _flow(preset: str, passes: int | None):
    def run(spark, folder):
        docs = labelled_documents(spark, folder).select("doc_id", "label", letter_words("text").alias("words"))
        train, test = weighted_split(docs, "doc_id", [0.8, 0.2])
        return documents.run_documents(train, test, preset, passes=passes, fast=False)

    return run


_PENALTIES = {"logistic_full": "scalar:1e-4", "logistic_full_unstemmed": "scalar:1e-4", "logistic_batches": "scalar:1e-3",
              "svm_batches": "batch:0.1", "weighted_svm": "none"}
# five passes: a quick check of everything around the fit
for _name in ("logistic_full", "logistic_full_unstemmed", "logistic_batches", "svm_batches"):
    query(_flow_sql(_name, 5, _PENALTIES[_name]), name=f"flow_{_name}_quick")(_flow(_name, 5))
    query(_flow_sql(_name, documents.PRESETS[_name].passes, _PENALTIES[_name]), name=f"flow_{_name}_whole")(_flow(_name, None))
query(_flow_sql("weighted_svm", documents.PRESETS["weighted_svm"].passes, _PENALTIES["weighted_svm"]), name="flow_weighted_svm")(
    _flow("weighted_svm", None))
for _name in ("multinomial", "forest"):
    query(name=f"flow_{_name}")(_flow(_name, None))
