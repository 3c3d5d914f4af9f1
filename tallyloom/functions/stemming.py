"""English Snowball (Porter2) stemming as built-in column expressions.

The published algorithm trims suffixes that lie in two regions of a word: R1 is
what follows the first non-vowel after a vowel, R2 the same within R1.  Where the
regions start is found once; a suffix lies in a region when the word without it is
at least that long.  A step takes the longest listed suffix with one pattern and
looks its replacement up in a small map, so the generated code stays short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.once import once

# Fixed values of the published algorithm.
V = "[aeiouy]"
C = "[^aeiouy]"
SPECIAL_HEADS = ["gener", "commun", "arsen"]
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
    "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing",
    "canning": "canning", "cannings": "canning", "herring": "herring", "herrings": "herring",
    "earring": "earring", "earrings": "earring",
    "proceed": "proceed", "proceeds": "proceed", "proceeded": "proceed", "proceeding": "proceed",
    "exceed": "exceed", "exceeds": "exceed", "exceeded": "exceed", "exceeding": "exceed",
    "succeed": "succeed", "succeeds": "succeed", "succeeded": "succeed", "succeeding": "succeed",
}
STEP_2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive",
    "tional": "tion", "biliti": "ble", "lessli": "less",
    "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive",
    "fulli": "ful", "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate",
    "alli": "al", "bli": "ble",
}
STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic",
    "ative": "", "ical": "ic", "ness": "", "ful": "",
}
STEP_4 = [
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti",
    "ous", "ive", "ize", "ion", "al", "er", "ic",
]

R1 = f"^(?:{'|'.join(SPECIAL_HEADS)})|^{C}*{V}+{C}"
R2 = f"^{C}*{V}+{C}"
_W, _S, _P1, _P2 = "_stem", "_suffix", "_r1", "_r2"


def _w() -> Column:
    return F.col(_W)


def _start(text: Column, pattern: str) -> Column:
    """Where a region starts: the length of the pattern's match, or the whole text."""
    head = F.length(F.regexp_extract(text, pattern, 0))
    return F.when(head > 0, head).otherwise(F.length(text))


def _suffix(suffixes) -> Column:
    """The longest of the suffixes the word ends with, or an empty text."""
    longest = max(len(s) for s in suffixes)
    return F.regexp_extract(F.right(_w(), F.lit(longest)), f"({'|'.join(suffixes)})$", 1)


def _room() -> Column:
    """Length of the word without its suffix."""
    return F.length(_w()) - F.length(_S)


def _step(df: DataFrame, rules: dict[str, str], allowed: Column) -> DataFrame:
    """Swap the longest suffix for its replacement where that is allowed."""
    to = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    swapped = F.concat(F.left(_w(), _room()), to[F.col(_S)])
    return df.withColumn(_S, _suffix(rules)).withColumn(
        _W, F.when((F.col(_S) != "") & allowed, swapped).otherwise(_w())
    )


def _plural(df: DataFrame) -> DataFrame:
    n, s = F.length(_w()), F.col(_S)
    cut = (
        F.when(s == "sses", 2)
        .when(s.isin("ied", "ies"), F.when(n > 4, 2).otherwise(1))
        .when((s == "s") & _w().rlike(f"{V}.+s$"), 1)
        .otherwise(0)
    )
    return df.withColumn(_S, _suffix(["sses", "ied", "ies", "us", "ss", "s"])).withColumn(_W, F.left(_w(), n - cut))


def _past(df: DataFrame) -> DataFrame:
    s = F.col(_S)
    bare = F.left(_w(), _room())
    removed = s.isin("ingly", "edly", "ing", "ed") & bare.rlike(V)
    df = df.withColumn(_S, _suffix(["eedly", "ingly", "edly", "eed", "ing", "ed"])).withColumns({
        "_removed": removed,
        _W: F.when(removed, bare)
        .when(s.isin("eedly", "eed") & (_room() >= F.col(_P1)), F.concat(bare, F.lit("ee")))
        .otherwise(_w()),
    })
    # a removed ending may leave a stem that needs its e back, or one of two equal letters less
    short = (F.length(_w()) <= F.col(_P1)) & _w().rlike(f"{C}{V}[^aeiouywxY]$|^{V}{C}$")
    double = _w().rlike(f"({'|'.join(DOUBLES)})$")
    repaired = (
        F.when(_w().rlike("(at|bl|iz)$"), F.concat(_w(), F.lit("e")))
        .when(double, F.left(_w(), F.length(_w()) - 1))
        .when(short, F.concat(_w(), F.lit("e")))
        .otherwise(_w())
    )
    return df.withColumn(_W, F.when(F.col("_removed"), repaired).otherwise(_w())).drop("_removed")


def _final(df: DataFrame) -> DataFrame:
    n = F.length(_w())
    keeps_e = (n < 4) | _w().rlike(f"{C}{V}[^aeiouywxY]e$")
    drop = (_w().endswith("ll") & (n > F.col(_P2))) | (
        _w().endswith("e") & ((n > F.col(_P2)) | ((n > F.col(_P1)) & ~keeps_e))
    )
    return df.withColumn(_W, F.when(drop, F.left(_w(), n - 1)).otherwise(_w()))


def with_stem(df: DataFrame, term: str, out: str = "stem") -> DataFrame:
    """Add the stem of a lower-case word column.  Narrow: no shuffle, no Python worker.

    For words of letters only, as ``letter_words`` makes them: endings with an
    apostrophe are not taken off.

    The result is computed ``once``: the optimizer would otherwise substitute the
    whole chain of steps into a later filter on the stem, and each step mentions
    the one before it several times.
    """
    word = F.regexp_replace(F.regexp_replace(F.col(term), "^y", "Y"), f"({V})y", "$1Y")
    df = df.withColumn(_W, word).withColumn(_P1, _start(_w(), R1))
    df = df.withColumn(_P2, F.col(_P1) + _start(F.expr(f"substr({_W}, {_P1} + 1)"), R2))
    df = _past(_plural(df))
    df = df.withColumn(_W, F.regexp_replace(_w(), f"^(.+{C})[yY]$", "$1i"))
    suffix, room = F.col(_S), _room()
    in_1, in_2 = room >= F.col(_P1), room >= F.col(_P2)
    df = _step(df, STEP_2 | {"ogi": "og", "li": ""}, in_1
               & ((suffix != "ogi") | _w().endswith("logi")) & ((suffix != "li") | _w().rlike("[cdeghkmnrt]li$")))
    df = _step(df, STEP_3, F.when(suffix == "ative", in_2).otherwise(in_1))
    df = _step(df, {s: "" for s in STEP_4}, in_2 & ((suffix != "ion") | _w().rlike("[st]ion$")))
    df = _final(df)
    exceptions = F.create_map(*[F.lit(x) for pair in EXCEPTIONS.items() for x in pair])
    stem = (
        F.when(F.length(term) <= 2, F.col(term))
        .otherwise(F.coalesce(F.try_element_at(exceptions, F.col(term)), F.translate(_w(), "Y", "y")))
    )
    return df.withColumn(out, once(stem)).drop(_W, _S, _P1, _P2)
