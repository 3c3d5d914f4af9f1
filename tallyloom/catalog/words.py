"""Cleaning, dictionaries, term weights and class labels of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, sql_uniform, sql_words, table
from tallyloom.functions import stemming
from tallyloom.functions.text import (
    BLANK, STOP_WORDS, WORD, clean_social, clean_tagger, letter_words, lowered_words, without_stop_words,
)
from tallyloom.operators import features as ft, vocabulary as vc
from tallyloom.operators.recode import bag_union, class_from_prefix, parse_tagged_line, synthetic_ids
from tallyloom.operators.sampling import weighted_split
from tallyloom.operators.stats import class_counts as count_classes, distinct_values, frequencies
from tallyloom.session import settled
from tallyloom.sources.lines import spread

SIZE = 20000


def docs_with_words(spark, folder):
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", letter_words("text").alias("words"))


DOCS_SQL = f"docs AS MATERIALIZED (SELECT doc_id, {sql_words()} AS words FROM documents)"
TERMS_SQL = f"""
 tokens AS (SELECT doc_id, len(words) AS doc_len, unnest(words) AS term FROM docs),
 top AS (SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM tokens GROUP BY term
         ORDER BY n DESC, term LIMIT {SIZE}),
 terms AS MATERIALIZED (SELECT term, n, df, (row_number() OVER (ORDER BY n DESC, term) - 1)::INT AS pos FROM top),
 tf AS MATERIALIZED (SELECT DISTINCT doc_id, doc_len, pos, 1.0::DOUBLE / doc_len AS value FROM tokens JOIN terms USING (term))
"""
IDF_SQL = """
 idf AS (SELECT pos, count(*) AS df, ln((SELECT count(*) FROM docs)::DOUBLE / (1 + count(*))) AS idf FROM tf GROUP BY pos)
"""


@query(f"WITH {DOCS_SQL}, {TERMS_SQL} SELECT term, n, pos FROM terms")
def dictionary_topk(spark, folder):
    return vc.dictionary(vc.term_counts(docs_with_words(spark, folder)), SIZE)


@query(f"WITH {DOCS_SQL}, {TERMS_SQL} SELECT term, n, df, pos FROM terms")
def dictionary_with_frequency(spark, folder):
    return ft.training_dictionary(docs_with_words(spark, folder), SIZE)


@query(f"WITH {DOCS_SQL}, {TERMS_SQL} SELECT doc_id, doc_len, pos, round(value, 12) AS value FROM tf")
def doc_presence_tf(spark, folder):
    docs = docs_with_words(spark, folder)
    out = ft.positions(docs, vc.dictionary(vc.term_counts(docs), SIZE))
    return out.withColumn("value", F.round("value", 12))


@query(f"""WITH {DOCS_SQL}, {TERMS_SQL}
 SELECT doc_id, doc_len, pos, round(count(*)::DOUBLE / doc_len, 12) AS value
 FROM tokens JOIN terms USING (term) GROUP BY doc_id, doc_len, pos""")
def doc_count_tf(spark, folder):
    docs = docs_with_words(spark, folder)
    out = ft.positions(docs, vc.dictionary(vc.term_counts(docs), SIZE), tf="count")
    return out.withColumn("value", F.round("value", 12))


@query(f"""WITH {DOCS_SQL}, {TERMS_SQL}
 SELECT doc_id, doc_len, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS positions FROM tf GROUP BY doc_id, doc_len""")
def doc_positions(spark, folder):
    docs = docs_with_words(spark, folder)
    out = ft.position_lists(ft.positions(docs, vc.dictionary(vc.term_counts(docs), SIZE)))
    return out.withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), ","))


@query(f"WITH {DOCS_SQL}, {TERMS_SQL}, {IDF_SQL} SELECT pos, df, round(idf, 9) AS idf FROM idf", name="idf")
def inverse_frequency(spark, folder):
    docs = docs_with_words(spark, folder)
    terms = ft.training_dictionary(docs, SIZE)
    return terms.select("pos", "df", F.round(ft.idf(F.col("df"), ft.row_total(docs)), 9).alias("idf"))


@query(f"""WITH {DOCS_SQL}, {TERMS_SQL}, {IDF_SQL}
 SELECT doc_id, pos, round(value * idf, 9) AS value FROM tf JOIN idf USING (pos)""")
def tfidf(spark, folder):
    docs = docs_with_words(spark, folder)
    out = ft.training_weights(docs, ft.training_dictionary(docs, SIZE))
    return out.select("doc_id", "pos", F.round("value", 9).alias("value"))


_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)


@query(f"""WITH docs AS MATERIALIZED (
   SELECT doc_id, list_filter({sql_words()}, lambda w: w NOT IN ({_STOP})) AS words FROM documents),
 {TERMS_SQL}, {IDF_SQL} SELECT doc_id, pos, round(value * idf, 9) AS value FROM tf JOIN idf USING (pos)""")
def tfidf_no_stop(spark, folder):
    docs = docs_with_words(spark, folder).withColumn("words", without_stop_words("words"))
    out = ft.training_weights(docs, ft.training_dictionary(docs, SIZE))
    return out.select("doc_id", "pos", F.round("value", 9).alias("value"))


# Four fifths of the documents make the dictionary, the rest is weighted with it.
_TRAIN = f"{sql_uniform('doc_id', 13)} < 0.8::DOUBLE"
_HELD_SQL = f"""WITH docs AS MATERIALIZED (SELECT doc_id, {sql_words()} AS words FROM documents WHERE {_TRAIN}),
 {TERMS_SQL},
 other AS (SELECT doc_id, len(words) AS doc_len, unnest(words) AS term FROM
           (SELECT doc_id, {sql_words()} AS words FROM documents WHERE NOT ({_TRAIN}))),
 held AS MATERIALIZED (SELECT DISTINCT doc_id, 1.0::DOUBLE / doc_len AS value, pos, df FROM other JOIN terms USING (term))
"""


def _halves(spark, folder):
    return weighted_split(docs_with_words(spark, folder), "doc_id", [0.8, 0.2], 13)


@query(_HELD_SQL + """,
 n AS (SELECT count(DISTINCT doc_id)::DOUBLE AS n FROM held),
 hdf AS (SELECT pos, count(*) AS hdf FROM held GROUP BY pos)
 SELECT doc_id, pos, round(value * ln(n / (1 + hdf)), 9) AS value FROM held JOIN hdf USING (pos), n""")
def tfidf_held_out(spark, folder):
    train, test = _halves(spark, folder)
    out = ft.scoring_features(test, ft.training_dictionary(train, SIZE))
    return out.select("doc_id", "pos", F.round("value", 9).alias("value"))


@query(_HELD_SQL + """
 SELECT doc_id, pos, round(value * ln((SELECT count(*) FROM docs)::DOUBLE / (1 + df)), 9) AS value FROM held""")
def tfidf_held_out_train_idf(spark, folder):
    train, test = _halves(spark, folder)
    out = ft.scoring_features(
        test, ft.training_dictionary(train, SIZE), idf_from="train", n_train=ft.row_total(train))
    return out.select("doc_id", "pos", F.round("value", 9).alias("value"))


@query(f"WITH {DOCS_SQL} SELECT count(DISTINCT term) AS terms FROM (SELECT unnest(words) AS term FROM docs)")
def vocabulary_size(spark, folder):
    return vc.vocabulary_size(vc.term_counts(docs_with_words(spark, folder)))


# -- stems ------------------------------------------------------------------------
# The SQL keeps the two region starts as numbers and compares lengths, where the
# Spark version anchors patterns at both ends of the word.

def _sql_step(source: str, branches: list[tuple[str, str]], out: str) -> str:
    cases = " ".join(f"WHEN {test} THEN {value}" for test, value in branches)
    return f" {out} AS (SELECT term, p1, p2, CASE {cases} ELSE w END AS w FROM {source})"


def _sql_rules(rules: dict[str, str], region: str) -> list[tuple[str, str]]:
    return [
        (f"ends_with(w, '{s}')",
         f"CASE WHEN length(w) - {len(s)} >= {region} THEN left(w, length(w) - {len(s)}) || '{to}' ELSE w END")
        for s, to in rules.items()
    ]


def stem_sql(source: str) -> str:
    """CTEs ending in ``stems(term, stem)`` for the distinct ``term`` of ``source``."""
    v, c = "[aeiouy]", "[^aeiouy]"
    exceptions = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in stemming.EXCEPTIONS.items())
    steps = [
        f" y0 AS (SELECT DISTINCT term, regexp_replace(regexp_replace(term, '^y', 'Y'), '({v})y', '\\1Y', 'g') AS w FROM {source})",
        f""" y1 AS (SELECT term, w, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)')
            THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
            WHEN regexp_matches(w, '^{c}*{v}+{c}') THEN length(regexp_extract(w, '^{c}*{v}+{c}'))
            ELSE length(w) END AS p1 FROM y0)""",
        f""" y2 AS (SELECT term, w, p1, CASE WHEN regexp_matches(substr(w, p1 + 1), '^{c}*{v}+{c}')
            THEN p1 + length(regexp_extract(substr(w, p1 + 1), '^{c}*{v}+{c}')) ELSE length(w) END AS p2 FROM y1)""",
        _sql_step("y2", [
            ("ends_with(w, 'sses')", "left(w, length(w) - 2)"),
            ("ends_with(w, 'ied') OR ends_with(w, 'ies')",
             "CASE WHEN length(w) > 4 THEN left(w, length(w) - 2) ELSE left(w, length(w) - 1) END"),
            ("ends_with(w, 'us') OR ends_with(w, 'ss')", "w"),
            (f"ends_with(w, 's') AND regexp_matches(left(w, greatest(length(w) - 2, 0)), '{v}')", "left(w, length(w) - 1)"),
        ], "s1a"),
        f""" s1b AS (SELECT term, p1, p2, w, CASE
            WHEN ends_with(w, 'eedly') THEN -5 WHEN ends_with(w, 'ingly') THEN 5 WHEN ends_with(w, 'edly') THEN 4
            WHEN ends_with(w, 'eed') THEN -3 WHEN ends_with(w, 'ing') THEN 3 WHEN ends_with(w, 'ed') THEN 2 ELSE 0 END AS cut
            FROM s1a)""",
        f""" s1c AS (SELECT term, p1, p2, CASE
            WHEN cut < 0 AND length(w) + cut >= p1 THEN left(w, length(w) + cut) || 'ee'
            WHEN cut > 0 AND regexp_matches(left(w, length(w) - cut), '{v}') THEN left(w, length(w) - cut) ELSE w END AS w,
            cut > 0 AND regexp_matches(left(w, length(w) - cut), '{v}') AS gone FROM s1b)""",
        _sql_step("s1c", [
            ("NOT gone", "w"),
            ("ends_with(w, 'at') OR ends_with(w, 'bl') OR ends_with(w, 'iz')", "w || 'e'"),
            ("right(w, 2) IN (" + ", ".join(f"'{d}'" for d in stemming.DOUBLES) + ")", "left(w, length(w) - 1)"),
            (f"length(w) <= p1 AND (regexp_matches(w, '{c}{v}[^aeiouywxY]$') OR regexp_matches(w, '^{v}{c}$'))", "w || 'e'"),
        ], "s1d"),
        _sql_step("s1d", [(f"length(w) > 2 AND regexp_matches(w, '{c}[yY]$')", "left(w, length(w) - 1) || 'i'")], "s1e"),
        _sql_step("s1e", _sql_rules(stemming.STEP_2, "p1") + [
            ("ends_with(w, 'ogi')", "CASE WHEN ends_with(w, 'logi') AND length(w) - 3 >= p1 THEN left(w, length(w) - 1) ELSE w END"),
            ("ends_with(w, 'li')",
             "CASE WHEN regexp_matches(w, '[cdeghkmnrt]li$') AND length(w) - 2 >= p1 THEN left(w, length(w) - 2) ELSE w END"),
        ], "s2"),
        _sql_step("s2", [
            rule for s, to in stemming.STEP_3.items()
            for rule in _sql_rules({s: to}, "p2" if s == "ative" else "p1")
        ], "s3"),
        _sql_step("s3", [
            (test + (" AND (w LIKE '%sion' OR w LIKE '%tion')" if s == "ion" else ""), value)
            for s in stemming.STEP_4 for test, value in _sql_rules({s: ""}, "p2")
        ], "s4"),
        _sql_step("s4", [
            ("ends_with(w, 'll')", "CASE WHEN length(w) - 1 >= p2 THEN left(w, length(w) - 1) ELSE w END"),
            ("ends_with(w, 'e')",
             f"""CASE WHEN length(w) - 1 >= p2 THEN left(w, length(w) - 1)
                 WHEN length(w) - 1 >= p1 AND length(w) >= 4 AND NOT regexp_matches(w, '{c}{v}[^aeiouywxY]e$')
                 THEN left(w, length(w) - 1) ELSE w END"""),
        ], "s5"),
        f""" stems AS MATERIALIZED (SELECT term, CASE WHEN length(term) <= 2 THEN term ELSE
            CASE term {exceptions} ELSE replace(w, 'Y', 'y') END END AS stem FROM s5)""",
    ]
    return ",".join(steps)


_RAW_SQL = f"WITH raw AS MATERIALIZED (SELECT doc_id, unnest({sql_words()}) AS term FROM documents), {stem_sql('raw')}"


@query(_RAW_SQL + " SELECT term, stem FROM stems")
def stems(spark, folder):
    counts = vc.term_counts(docs_with_words(spark, folder))
    return stemming.with_stem(counts, "term").select("term", "stem")


@query(_RAW_SQL + f""", c AS (SELECT stem AS term, count(*) AS n FROM raw JOIN stems USING (term)
   WHERE stem NOT IN ({_STOP}) GROUP BY stem ORDER BY n DESC, term LIMIT {SIZE})
 SELECT term, n, (row_number() OVER (ORDER BY n DESC, term) - 1)::INT AS pos FROM c""")
def stemmed_dictionary(spark, folder):
    counts = vc.stemmed_counts(vc.term_counts(docs_with_words(spark, folder)))
    return vc.dictionary(counts, SIZE)


@query(_RAW_SQL + f""", tokens AS MATERIALIZED (SELECT doc_id, stem AS term FROM raw JOIN stems USING (term) WHERE stem NOT IN ({_STOP})),
 lens AS (SELECT doc_id, count(*) AS doc_len FROM tokens GROUP BY doc_id),
 top AS (SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM tokens GROUP BY term ORDER BY n DESC, term LIMIT {SIZE}),
 terms AS MATERIALIZED (SELECT term, df, (row_number() OVER (ORDER BY n DESC, term) - 1)::INT AS pos FROM top)
 SELECT doc_id, pos, round((1.0::DOUBLE / doc_len) * ln((SELECT count(*) FROM documents)::DOUBLE / (1 + df)), 9) AS value
 FROM (SELECT DISTINCT doc_id, term FROM tokens) JOIN lens USING (doc_id) JOIN terms USING (term)""")
def stemmed_tfidf(spark, folder):
    docs = settled(vc.stem_documents(docs_with_words(spark, folder)))
    out = ft.training_weights(docs, ft.training_dictionary(docs, SIZE))
    return out.select("doc_id", "pos", F.round("value", 9).alias("value"))


# -- cleaning ------------------------------------------------------------------------

@query(f"""SELECT conv_id, turn, regexp_replace(lower(text),
 '([#$@][^{BLANK}]+)|(http[^{BLANK}]+)|[^{WORD}{BLANK}]', '', 'g') AS cleaned FROM conversations""", name="clean_social")
def social(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", clean_social("text").alias("cleaned"))


@query(f"""SELECT doc_id, regexp_replace(lower(text),
 '([#$@][^{BLANK}]+)|(http[^{BLANK}]+)|[^{WORD}{BLANK}]', '', 'g') AS cleaned FROM documents""")
def clean_social_documents(spark, folder):
    return spread(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", clean_social("text").alias("cleaned"))


@query(f"""SELECT conv_id, turn, regexp_replace(regexp_replace(lower(
 regexp_replace(text, '[^a-zA-Z0-9''{BLANK}]', '', 'g')), '^[{BLANK}]+|[{BLANK}]+$', '', 'g'), '[{BLANK}]+', ' ', 'g')
 AS cleaned FROM conversations""", name="clean_tagger")
def tagger(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", clean_tagger("text").alias("cleaned"))


@query("""SELECT doc_id, array_to_string(list_filter(string_split(
 regexp_replace(lower(text), '[^a-z]', ' ', 'g'), ' '), lambda w: w <> ''), ' ') AS cleaned FROM documents""")
def clean_lower_first(spark, folder):
    return spread(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", F.array_join(lowered_words("text"), " ").alias("cleaned"))


# -- lines, classes -----------------------------------------------------------------

_LINE_SQL = """('<doc id="' || CASE WHEN quality = 1 THEN 'AU' ELSE 'G' END || doc_id || '" url="http://x/' || doc_id
 || '" title="t">' || text || '</doc>')"""


@query(f"""WITH l AS (SELECT doc_id, {_LINE_SQL} AS line, toxic, text FROM documents JOIN labels USING (doc_id)),
 parsed AS (SELECT substr(line, instr(line, 'id="') + 4, instr(line, '" url=') - instr(line, 'id="') - 4) AS doc_id,
   substr(line, instr(line, '">') + 2, length(line) - instr(line, '">') - 7) AS body FROM l WHERE toxic = 0
   UNION ALL SELECT 'AD' || doc_id, text FROM l WHERE toxic = 1)
 SELECT doc_id, CASE left(doc_id, 2) WHEN 'AD' THEN 1 WHEN 'AU' THEN 2 ELSE 0 END AS label,
   length(body)::INT AS chars, len({sql_words('body')})::INT AS n_words FROM parsed""")
def parse_doc_line(spark, folder):
    docs = spread(table(spark, folder, "documents")).join(table(spark, folder, "labels"), "doc_id")
    number = F.col("doc_id").cast("string")
    line = F.concat(
        F.lit('<doc id="'), F.when(F.col("quality") == 1, "AU").otherwise("G"), number,
        F.lit('" url="http://x/'), number, F.lit('" title="t">'), F.col("text"), F.lit("</doc>"))
    tagged = parse_tagged_line(docs.where("toxic = 0").select(line.alias("value"))).select("doc_id", "body")
    promoted = synthetic_ids(docs.where("toxic = 1").select("doc_id", F.col("text").alias("body")), key="doc_id")
    return bag_union(tagged, promoted.select("doc_id", "body")).select(
        "doc_id", class_from_prefix("doc_id").alias("label"),
        F.length("body").alias("chars"), F.size(letter_words("body")).alias("n_words"))


def labelled_documents(spark, folder):
    """Documents with labels: toxic 1, else quality 2, else 0."""
    docs = spread(table(spark, folder, "documents")).join(table(spark, folder, "labels"), "doc_id")
    return docs.withColumn("label", F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2).otherwise(0))


_CLASS_SQL = "CASE WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 2 ELSE 0 END"


@query(f"SELECT {_CLASS_SQL} AS label, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def class_counts(spark, folder):
    return count_classes(labelled_documents(spark, folder))


@query(f"SELECT doc_id, {_CLASS_SQL} AS label FROM documents JOIN labels USING (doc_id) WHERE {_CLASS_SQL} <> 1")
def class_filter(spark, folder):
    return labelled_documents(spark, folder).where("label != 1").select("doc_id", "label")


@query("SELECT lang, min(doc_id) AS first_seen FROM documents GROUP BY lang", name="distinct_values")
def distinct_languages(spark, folder):
    return distinct_values(table(spark, folder, "documents"), "lang", "doc_id")


@query("SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def source_counts(spark, folder):
    return frequencies(table(spark, folder, "documents"), "source")
