"""Quality rules: line-first cleaning (DataFrame functions only).

Every line of a text is judged by itself: a line with words stays if it ends
like a sentence (in any script that marks it), is no navigation bar (parts cut
by ``|``), is not shouted, is not mostly symbols and its first boilerplate
phrase, if any, is a small part of it. Failing lines are removed; a document that loses more than ``max_lost`` of its word characters
goes, as does one that fails the base rules (too few words, or too many words
in repeated five-word windows). All work is per row: no shuffle, no Python.

Defined results: a null or blank text has no words and is rejected; blank
lines never fail; repeated rows are judged one by one; other columns of the
input pass through whatever their names are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import WORD_GAP, let, short_batches

#: Symbols that are counted, and words per repetition window.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Defaults of the line rules.
MAX_LOST = 0.3
MAX_SYMBOL_SHARE = 0.1
MIN_BARS = 2
MIN_SHOUT = 8
#: A phrase makes a line boilerplate if it is at least this share of it, so
#: that sentences which only contain it stay.
MIN_BOILERPLATE_SHARE = 0.25
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "all rights reserved", "sign in to", "log in to", "subscribe to our",
    "click here", "read more", "skip to content",
    "alle rechte vorbehalten", "weiterlesen", "zum inhalt springen",
    "tous droits réservés", "lire la suite", "aller au contenu",
    "todos los derechos reservados", "leer más", "saltar al contenido",
)
#: Characters that end a sentence (Unicode's sentence terminals
#: in present use, the ellipsis, and the shads of Tibetan).
SENTENCE_ENDS = (
    "!.?…։؝؞؟۔܀܁܂߹।॥།༎၊။።፧፨។៕᙮᠃᠉᥄᥅᱾᱿‼‽⁇⁈⁉⸮⸼。꓿꘎꘏꛳꛷꣎꣏꤯꧈꧉꩝꩞꩟꯫﹒﹖﹗！．？｡")
#: They may be followed by quotes and brackets of any script, each after a
#: space as in French.
ENDS = rf"""[{SENTENCE_ENDS}](?:[\x20\x{{A0}}\x{{202F}}]?["'\p{{Pi}}\p{{Pf}}\p{{Pe}}])*[\x20\x09-\x0D]*\z"""
_USUAL_ENDS = r"[.!?][\"')]*\z"
_HAS_WORD = r"[^\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    """Maximal runs outside white space; null text: none."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(parts, lambda w: w != "")


def _symbols(text: Column) -> Column:
    """How many characters of SYMBOLS a text has (all are one byte long)."""
    lost = [F.octet_length(F.replace(text, F.lit(s), F.lit(""))) for s in SYMBOLS]
    return (F.octet_length(text) * len(SYMBOLS) - sum(lost[1:], lost[0])).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that the text has twice or more.

    Windows are compared by a 64-bit hash. Texts without a repeated window
    (the rule) stop at a distinct count; for the others the windows are
    sorted by hash, those beside an equal one give the start positions, and
    the positions' cover is summed."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(h) - WINDOW + 1)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + (k - 1))
                                                      for k in range(WINDOW)]))

    def cover(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda e, j: (e["h"] == F.get(s, j - 1)["h"])
                             | (e["h"] == F.get(s, j + 1)["h"]))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        def covered(p: Column) -> Column:
            gaps = F.transform(p, lambda x, j: F.least(
                F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        return let(ordered, lambda s: let(starts(s), covered))

    found = let(hashes, lambda h: F.when(F.size(h) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w),
                                         F.lit(0).cast("long")).otherwise(cover(w)))))
    return found


def boilerplate_pattern(phrases: Sequence[str]) -> str:
    """Whole words only; the phrase is group 1."""
    edge = r"[^\p{L}\p{N}]"
    return f"(?:^|{edge})({'|'.join(phrases)})(?:{edge}|$)"


def _line_fails(line: Column, boilerplate: Sequence[str]) -> Column:
    letters = F.regexp_replace(line, r"[^\p{L}]+", "")
    # Most lines end in a usual mark, which is quicker to see.
    fails = ~(line.rlike(_USUAL_ENDS) | line.rlike(ENDS))
    fails |= F.size(F.split(line, r"\|")) > MIN_BARS
    fails |= (F.length(letters) >= MIN_SHOUT) & (F.upper(letters) == letters) \
        & (F.lower(letters) != letters)
    fails |= _symbols(line) > MAX_SYMBOL_SHARE * F.length(line)
    if boilerplate:
        # Few lines hold a phrase at all: a plain search goes first.
        pattern = boilerplate_pattern(boilerplate)
        fails |= let(F.lower(line), lambda low: reduce(
            lambda x, y: x | y, [F.contains(low, F.lit(p)) for p in boilerplate])
            & (F.length(F.regexp_extract(low, pattern, 1))
               >= F.greatest(F.lit(1), MIN_BOILERPLATE_SHARE * F.length(line))))
    return line.rlike(_HAS_WORD) & fails


def judge(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST,
          boilerplate: Sequence[str] = BOILERPLATE) -> DataFrame:
    """(row: the input row, quality: figures, verdict and cleaned text).

    ``quality`` has n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, lost_chars (word characters of removed
    lines), clean_text (null if the text is null) and kept."""
    short_batches(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def lines(ls: Column) -> Column:
        worded = F.filter(ls, lambda x: x.rlike(_HAS_WORD))
        return F.struct(
            (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("dup"),
            F.filter(ls, lambda x: ~_line_fails(x, boilerplate)).alias("clean"),
            F.size(ls).alias("n"))

    def figures(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"))

    # Behind an explode of one element the figures are computed once, whatever
    # filters and columns are asked of the result.
    step = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.explode(F.array(F.struct(
            let(words_of(F.col(f"`{text}`")), figures).alias("w"),
            let(F.split(body, "\n"), lines).alias("l"),
            _symbols(body).alias("n_symbols")))).alias("f")).select("row", "f.*")
    left = F.array_join(F.col("l.clean"), "\n")
    # Only a text that lost lines is counted again.
    left_chars = F.when(F.size("l.clean") == F.col("l.n"), F.col("w.word_chars")).otherwise(
        F.length(F.array_join(words_of(left), "")).cast("long"))
    step = step.select("row", "w", "l.dup", "n_symbols", F.explode(F.array(F.struct(
        left.alias("left"), (F.col("w.word_chars") - left_chars).alias("lost")))).alias("f")) \
        .select("row", "w", "dup", "n_symbols", "f.*")
    base_failed = (F.col("w.n_words") < MIN_WORDS) \
        | (100 * F.col("w.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("w.n_words"))
    kept = ~base_failed & (F.col("lost") <= max_lost * F.col("w.word_chars"))
    return step.select("row", F.struct(
        F.col("w.n_words").alias("n_words"), F.col("w.word_chars").alias("word_chars"),
        F.col("n_symbols").alias("n_symbols"), F.col("dup").alias("n_dup_lines"),
        F.col("w.n_repeat_words").alias("n_repeat_words"),
        base_failed.alias("base_failed"), F.col("lost").alias("lost_chars"),
        F.when(F.col(f"row.`{text}`").isNotNull(), F.col("left")).alias("clean_text"),
        kept.alias("kept")).alias("quality"))


def clean(docs: DataFrame, text: str = "text", n_chars: str = "n_chars",
          **rules) -> DataFrame:
    """The documents that stay, with failing lines removed from ``text`` (and
    ``n_chars``, if there, counted again); columns as given."""
    judged = judge(docs, text, **rules).filter("quality.kept")

    def column(c: str) -> Column:
        old = F.col(f"row.`{c}`")
        if c == text:
            return F.col("quality.clean_text").alias(c)
        if c == n_chars:
            return F.when(F.col("quality.lost_chars") > 0,
                          F.length("quality.clean_text")).otherwise(old) \
                .cast(docs.schema[c].dataType).alias(c)
        return old.alias(c)

    return judged.select(*[column(c) for c in docs.columns])
