"""Text cleaning and the stop-word list."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The English stop-word list (179 entries).
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# What counts as a blank, and as a letter, digit or underscore, in Unicode.
BLANK = r"\s\x0B\x1C-\x1F\x85\p{Z}"
WORD = r"\p{L}\p{N}_"


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def letter_words(text: Column | str) -> Column:
    """Words of a document: every non-letter splits, then lower case; no empty words."""
    spaced = F.regexp_replace(_col(text), "[^a-zA-Z]+", " ")
    return F.array_remove(F.split(F.lower(spaced), " "), "")


def lowered_words(text: Column | str) -> Column:
    """Like ``letter_words`` but lower-cases first (differs for upper-case letters outside
    ASCII whose lower case is an ASCII letter)."""
    spaced = F.regexp_replace(F.lower(_col(text)), "[^a-z]+", " ")
    return F.array_remove(F.split(spaced, " "), "")


def clean_social(text: Column | str) -> Column:
    """Lower case; delete hashtags, cash tags, mentions, links and punctuation."""
    pattern = f"([#$@][^{BLANK}]+)|(http[^{BLANK}]+)|[^{WORD}{BLANK}]"
    return F.regexp_replace(F.lower(_col(text)), pattern, "")


def clean_tagger(text: Column | str) -> Column:
    """Keep ASCII letters, digits, apostrophes and blanks; lower, trim, squeeze blanks."""
    kept = F.lower(F.regexp_replace(_col(text), f"[^a-zA-Z0-9'{BLANK}]", ""))
    trimmed = F.regexp_replace(kept, f"^[{BLANK}]+|[{BLANK}]+$", "")
    return F.regexp_replace(trimmed, f"[{BLANK}]+", " ")


def without_stop_words(words: Column | str, stop=STOP_WORDS) -> Column:
    """Drop stop words from a word array; other words keep their order and copies."""
    stop_list = [str(w) for w in stop]
    return F.filter(_col(words), lambda w: ~w.isin(stop_list))


def last_number(text: Column | str) -> Column:
    """The last blank-separated token as an integer (``Sentence: 12`` gives 12)."""
    return F.element_at(F.split(F.trim(_col(text)), f"[{BLANK}]+"), -1).try_cast("int")


def spaced(words: Column | str) -> Column:
    return F.array_join(_col(words), " ")
