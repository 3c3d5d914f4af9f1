"""Sentences, tags and integer sequences made of conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.functions.text import last_number
from tallyloom.operators import sequences as sq, vocabulary as vc
from tallyloom.operators.lookup import small
from tallyloom.sources.lines import spread

#: Published vocabulary sizes of the text classifier and of the tagger, and the tagger's sequence length.
TEXT_WORDS, TAGGER_WORDS, LENGTH = 10_000, 36_000, 110

_CLEAN = r"""trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9'']+', ' ', 'g'), ' +', ' ', 'g'))"""


def _turns(spark, folder):
    """Turns as token arrays; role and position stand for tags and token order."""
    turns = spread(table(spark, folder, "conversations"))
    plain = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9']+", " "))
    return turns.select("conv_id", "turn", "role", F.array_remove(F.split(plain, " "), "").alias("words"))


_TURNS_SQL = rf"""turns AS MATERIALIZED (SELECT conv_id, turn, role,
 list_filter(string_split({_CLEAN}, ' '), lambda w: w <> '') AS words FROM conversations),
 tok AS MATERIALIZED (SELECT conv_id, turn, unnest(words) AS term, generate_subscripts(words, 1) AS place FROM turns)"""


def _ids_sql(first: int, size: int) -> str:
    return f"""c AS (SELECT term, count(*) AS n FROM tok GROUP BY term ORDER BY n DESC, term LIMIT {size}),
 voc AS MATERIALIZED (SELECT term, (row_number() OVER (ORDER BY n DESC, term) + {first - 1})::INT AS id FROM c)"""


def _text(column):
    return F.array_join(F.col(column).cast("array<string>"), " ")


@query("""SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS sentence, string_agg(role, ' ' ORDER BY turn) AS roles
 FROM conversations GROUP BY conv_id""")
def sentences(spark, folder):
    out = sq.sentences(table(spark, folder, "conversations"), "conv_id", "turn", "text", ["role"])
    return out.select("conv_id", "sentence", F.array_join("role", " ").alias("roles"))


@query("""SELECT role, (dense_rank() OVER (ORDER BY f) - 1)::INT AS id FROM
 (SELECT role, min(conv_id * 1000000 + turn) AS f FROM conversations GROUP BY role)""")
def tag_ids(spark, folder):
    turns = table(spark, folder, "conversations").withColumn("_at", F.col("conv_id") * 1000000 + F.col("turn"))
    return vc.appearance_ids(turns, "role", "_at")


@query("""WITH t AS (SELECT role, (dense_rank() OVER (ORDER BY f) - 1)::INT AS id FROM
 (SELECT role, min(conv_id * 1000000 + turn) AS f FROM conversations GROUP BY role)),
 e AS (SELECT conv_id, list(id ORDER BY turn) AS ids FROM conversations JOIN t USING (role) GROUP BY conv_id)
, f AS (SELECT id AS fill FROM t WHERE role = 'user')
 SELECT conv_id, array_to_string(list_concat(ids, list_resize([]::INT[], greatest(12 - len(ids), 0), fill)), ' ') AS ids
 FROM e, f""")
def encode_tags(spark, folder):
    turns = table(spark, folder, "conversations").withColumn("_at", F.col("conv_id") * 1000000 + F.col("turn"))
    tags = vc.appearance_ids(turns, "role", "_at")  # kept by its numbering, so counting it is cheap
    listed = sq.sentences(turns, "conv_id", "turn", "text", ["role"])
    ids = sq.encode(listed, ["conv_id"], "role", small(tags), term="role")
    fill = tags.where(F.col("role") == "user").select("id").scalar()
    return ids.select("conv_id", sq.pad("ids", 12, fill, truncate=None).alias("ids")).withColumn("ids", _text("ids"))


@query(f"""WITH {_TURNS_SQL}, {_ids_sql(2, TEXT_WORDS)}
 SELECT t.conv_id, t.turn, coalesce(string_agg(i.id::VARCHAR, ' ' ORDER BY place), '') AS ids FROM turns t LEFT JOIN
 (SELECT conv_id, turn, place, coalesce(id, 1) AS id FROM tok LEFT JOIN voc USING (term)) i USING (conv_id, turn)
 GROUP BY t.conv_id, t.turn""")
def token_ids(spark, folder):
    turns = _turns(spark, folder)
    ids = sq.encode(turns, ["conv_id", "turn"], "words", vc.text_vocabulary(vc.term_counts(turns), TEXT_WORDS + 2), unknown=1)
    return ids.withColumn("ids", _text("ids"))


def _known_ids(spark, folder):
    turns = _turns(spark, folder)
    voc = vc.tagger_vocabulary(vc.term_counts(turns), TAGGER_WORDS + 1)
    return voc, sq.encode(turns, ["conv_id", "turn"], "words", voc)


_KNOWN_SQL = f"""WITH {_TURNS_SQL}, {_ids_sql(1, TAGGER_WORDS)},
 known AS MATERIALIZED (SELECT t.conv_id, t.turn, coalesce(list(id ORDER BY place) FILTER (id IS NOT NULL), []) AS ids,
  coalesce(list(term ORDER BY place) FILTER (id IS NOT NULL), []) AS words
  FROM turns t LEFT JOIN (SELECT * FROM tok JOIN voc USING (term)) k USING (conv_id, turn) GROUP BY t.conv_id, t.turn)"""


@query(_KNOWN_SQL + f""" SELECT conv_id, turn,
 array_to_string(list_concat(cut, list_transform(range({LENGTH} - len(cut)), lambda x: 0)), ' ') AS ids
 FROM (SELECT conv_id, turn, CASE WHEN len(ids) > {LENGTH} THEN ids[len(ids) - {LENGTH - 1}:] ELSE ids END AS cut FROM known)""")
def pad_sequences(spark, folder):
    _, ids = _known_ids(spark, folder)
    return ids.select("conv_id", "turn", sq.pad("ids", LENGTH).alias("ids")).withColumn("ids", _text("ids"))


@query(_KNOWN_SQL + f""" SELECT conv_id, turn,
 array_to_string(list_concat(list_transform(range({LENGTH} - len(cut)), lambda x: 0), cut), ' ') AS ids
 FROM (SELECT conv_id, turn, ids[:{LENGTH}] AS cut FROM known)""")
def pad_sequences_front(spark, folder):
    _, ids = _known_ids(spark, folder)
    cut = sq.pad("ids", LENGTH, padding="pre", truncate="post")
    return ids.select("conv_id", "turn", cut.alias("ids")).withColumn("ids", _text("ids"))


@query(_KNOWN_SQL + " SELECT conv_id, turn, array_to_string(words, ' ') AS words FROM known")
def decode_ids(spark, folder):
    voc, ids = _known_ids(spark, folder)
    padded = ids.withColumn("ids", sq.pad("ids", LENGTH, truncate=None))
    out = sq.decode(padded, ["conv_id", "turn"], "ids", voc)
    return out.withColumn("words", F.array_join("words", " "))


@query(_KNOWN_SQL + f""" SELECT conv_id, turn, array_to_string(list_transform(cut, lambda x: x * 10), ' ') AS tags
 FROM (SELECT conv_id, turn, CASE WHEN len(ids) > {LENGTH} THEN ids[len(ids) - {LENGTH - 1}:] ELSE ids END AS cut FROM known)""")
def trim_predictions(spark, folder):
    """A made-up prediction (ten times the id) for padded sequences, cut back to the sentence."""
    _, ids = _known_ids(spark, folder)
    padded = ids.select("conv_id", "turn", sq.pad("ids", LENGTH).alias("ids"))
    predicted = F.transform("ids", lambda x: x * 10)
    return padded.select("conv_id", "turn", sq.trim_prediction(predicted, "ids").alias("tags")).withColumn("tags", _text("tags"))


@query("""SELECT conv_id, turn, ('Conversation: ' || conv_id) AS name, conv_id::INT AS number,
 CASE role WHEN 'user' THEN 'person' WHEN 'assistant' THEN 'machine' END AS speaker FROM conversations""")
def last_number_and_names(spark, folder):
    name = F.concat(F.lit("Conversation: "), F.col("conv_id").cast("string"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", name.alias("name"), last_number(name).alias("number"),
        sq.map_label("role", {"user": "person", "assistant": "machine"}).alias("speaker"))


