"""Line-first cleaning of documents with DataFrame functions only.

Each line is judged by itself: punctuation (symbols or doubled exclamation marks
in place of sentences, no letter or digit at all), navigation (separators
between items, menu words) and boilerplate (notices about cookies, scripts,
rights). Lines that fail go; a document that loses too much of its text, is too
short, or repeats itself is rejected. All of it is one pass over a row, without
a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.columns import bound, free_name

BREAKS = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 30
MARKS_PER_WORD = 0.3
SEPARATORS_PER_WORD = 0.2
MIN_SEPARATORS = 3
MENU_LINE_WORDS = 6
#: Fixed phrases of navigation and boilerplate lines, in lower case.
MENU = r"^(home|menu|login|log in|sign in|sign up|register|search|next|previous|back to top|skip to (main )?content|read more|share this|follow us|contact us|about us|site ?map)\b"
BOILERPLATE = r"(all rights reserved|terms of (use|service)|privacy policy|cookie policy|use of cookies|uses cookies|enable javascript|javascript is disabled|lorem ipsum|subscribe to our newsletter|click here to)"

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BREAKS), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of three that occur twice or more."""
    n = F.size(words)

    def of_hashes(h: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
            at = F.transform(twice, lambda i: F.get(s, i)["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(bound(F.sort_array(pairs), of_sorted))

    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 3, 0).otherwise(bound(windows, of_hashes))


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule; a line without a word breaks none."""
    words = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    marks = F.regexp_count(line, F.lit(r"[#*$%&<>]+|!!+"))
    separators = F.regexp_count(line, F.lit(r"(^|[ \t])[|›»·•>]([ \t\r]|$)"))
    punctuation = (marks > words * F.lit(MARKS_PER_WORD)) | ~line.rlike(r"[\p{L}\p{N}]")
    low = F.lower(F.trim(line))
    navigation = ((separators >= MIN_SEPARATORS) & (separators > words * F.lit(SEPARATORS_PER_WORD))) | ((words <= MENU_LINE_WORDS) & low.rlike(MENU))
    return (words > 0) & (punctuation | navigation | low.rlike(BOILERPLATE))


def judged(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``quality``: the metrics, both verdicts and the text of the lines that stay.

    Null and empty texts have no words and fail; repeated rows are judged alike;
    ids are not read, so null ones do no harm; an empty table gives no rows. A
    column of ``docs`` named ``quality`` gives way to the new one. Texts of any
    length are judged whole.
    """
    raw = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))

    def of_text(text: Column) -> Column:
        lines = F.split(text, "\n")
        filled = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        measured = bound(
            words_of(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                _repeat_words(w).cast("long").alias("n_repeat_words"),
            ),
        )
        return F.struct(
            measured.alias("m"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            bound(filled, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.array_join(F.filter(lines, lambda x: ~line_fails(x)), "\n").alias("clean_text"),
            F.char_length(text).alias("chars"),
        )

    name = free_name(docs, "_quality")
    q = F.col(name)
    base = (q["m"]["n_words"] < MIN_WORDS) | (100 * q["m"]["n_repeat_words"] > MAX_REPEAT_PERCENT * q["m"]["n_words"])
    lost = q["chars"] - F.char_length(q["clean_text"])
    kept = ~base & (100 * lost <= MAX_LOST_PERCENT * q["chars"])
    verdict = F.struct(
        q["m"]["n_words"].alias("n_words"),
        q["m"]["word_chars"].alias("word_chars"),
        q["n_symbols"].alias("n_symbols"),
        q["n_dup_lines"].alias("n_dup_lines"),
        q["m"]["n_repeat_words"].alias("n_repeat_words"),
        base.alias("base_failed"),
        kept.alias("kept"),
        lost.cast("long").alias("n_lost_chars"),
        q["clean_text"].alias("clean_text"),
    )
    # generated, not projected: so it is computed once, whatever is asked of it further on
    measured = docs.select("*", F.explode(F.transform(F.array(raw), of_text)).alias(name))
    return measured.withColumn("quality", verdict).drop(name)
