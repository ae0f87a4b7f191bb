"""Text cleaning as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from hirelattice.session import join_hot

# all characters that count as white space, Unicode ones included; Java's \\s knows only six of them
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_LOWER, _UPPER, _DIGITS = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
_LATIN = "".join(map(chr, range(0xC0, 0x100)))


def _other_than(kept: str) -> str:
    """A class of all characters but the kept ones. Listed one by one, since the regex engine looks
    single characters below 256 up in a bit set, but tests ranges and all others in turn."""
    return "[^" + "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in kept) + "]"


def _accent_table() -> tuple[str, str]:
    """By rule: letters below U+3000 that decompose to one base letter, and the marks themselves."""
    pairs, marks = [], []
    for code in range(0x00C0, 0x3000):
        ch = chr(code)
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
        if base != ch and len(base) == 1:
            pairs.append((ch, base))
    # characters past the end of the second text are deleted
    return "".join(a for a, _ in pairs) + "".join(marks), "".join(b for _, b in pairs)


_FROM, _TO = _accent_table()


def strip_accents(text: Column) -> Column:
    """Letters without their marks; letters that have no decomposition, such as ß, stay."""
    return F.translate(text, _FROM, _TO)


def strip_blank(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def clean_v1(text: Column) -> Column:
    """Lower case, letters with accents only, single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), _other_than(_LOWER + _LATIN) + "+", " "))


def clean_v2(text: Column) -> Column:
    """Lower case without accents, letters, digits and white space; blanks are not squeezed."""
    kept = _LOWER + _DIGITS + SPACES
    low = strip_accents(F.lower(text))
    # texts within Latin-1, the most, need no test for the wide blanks
    wide = F.regexp_replace(low, _other_than(kept), " ")
    narrow = F.regexp_replace(low, _other_than("".join(c for c in kept if ord(c) < 256)), " ")
    return strip_blank(F.when(text.rlike("[^\\x00-\\xff]"), wide).otherwise(narrow))


def clean_v3(text: Column) -> Column:
    """Without accents, letters and apostrophes, single blanks; case is kept."""
    return F.trim(F.regexp_replace(strip_accents(text), _other_than(_LOWER + _UPPER + "'") + "+", " "))


def sanitize_csv(text: Column) -> Column:
    """Line breaks to blanks, double quotes doubled, other control characters dropped; null to empty."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), "\\r\\n|\\n|\\r", " ")
    return F.regexp_replace(F.regexp_replace(flat, '"', '""'), "[\\x00-\\x1F\\x7F]", "")


def reduce_title(title: Column) -> Column:
    """``A / B rest`` to ``A rest``."""
    return F.regexp_replace(title, "([^\\s/]+) / ([^\\s/]+)(.*)", "$1$3")


def first_three(code: Column) -> Column:
    """The first three characters, null when there are fewer."""
    return F.nullif(F.regexp_extract(code, "^(.{3})", 1), F.lit(""))


def shorten(text: Column, limit: int = 500) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def joined_text(columns: list[str], sep: str = ". ") -> Column:
    """All columns as one text; nulls keep their place as empty text."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def words(text: Column) -> Column:
    """Pieces of two or more letters, digits or underscores, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}_]{2,}"), F.lit(0))


def _dictionary(lemmas: DataFrame, stopwords: DataFrame, special: dict[str, str]) -> DataFrame:
    """(word, lemma, dropped) of all words that are not simply kept; dropped if the word or its lemma is a stop word."""
    stop = stopwords.select(F.col("word")).filter("word is not null").distinct()
    known = lemmas.select("word", "lemma").filter("word is not null")
    marked = known.join(stop.withColumn("stopped", F.lit(True)), "word", "full")
    if special:
        # a special word counts as its own lemma where no dictionary has it
        own = lemmas.sparkSession.createDataFrame([(w,) for w in special], "word string").join(marked, "word", "left_anti")
        marked = marked.unionByName(own, allowMissingColumns=True)
    lemma = F.coalesce("lemma", "word")
    for old, new in special.items():
        lemma = F.when(lemma == old, F.lit(new)).otherwise(lemma)
    named = marked.withColumn("lemma", lemma).join(stop.select(F.col("word").alias("lemma"), F.lit(True).alias("gone")), "lemma", "left")
    return named.select("word", "lemma", F.coalesce("stopped", "gone", F.lit(False)).alias("dropped"))


def lemmatize(
    df: DataFrame, id_column: str, text_column: str, lemmas: DataFrame, stopwords: DataFrame, min_length: int = 2,
    special: dict[str, str] | None = None,
) -> DataFrame:
    """(id, text) of lemmas in word order, without stop words, numbers and short lemmas.

    ``lemmas`` is a dictionary (word, lemma); a word that is not in it is its own lemma. ``special``
    maps single lemmas and defaults to the one correction the source makes. The words of a row are
    regrouped by the row's own id, so a group is one text. Lemmas and stop words are one dictionary, which the words meet in
    one join; a word of many rows is split over tasks.
    """
    special = {"dater": "data"} if special is None else special
    pieces = F.split(clean_v2(F.col(text_column)), f"[{SPACES}]+")
    rows = df.select(id_column, F.posexplode(pieces).alias("pos", "word")).filter("word <> '' and not word rlike '^[0-9]+$'")
    joined = join_hot(rows, _dictionary(lemmas, stopwords, special), "word", "left")
    rows = joined.filter("not coalesce(dropped, false)").withColumn("lemma", F.coalesce("lemma", "word")).filter(F.length("lemma") >= min_length)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "lemma")))
    texts = rows.groupBy(id_column).agg(F.array_join(F.transform(ordered, lambda x: x["lemma"]), " ").alias("text"))
    return df.select(id_column).join(texts, id_column, "left").withColumn("text", F.coalesce("text", F.lit("")))
