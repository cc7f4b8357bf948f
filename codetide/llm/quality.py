"""Quality rules from one text and from the lines that a host's documents share.

Everything here is built-in expressions. A text is read once; its words, windows and lines are counted inside the row.
Only line hashes are shuffled: a document names each of its lines once, and counts per (host, line) are combined in the tasks first, so a line
that every document of a host bears costs a row per task.

A line is above the limit when more than ``MOST_DOCUMENTS`` documents of the host bear it, however large the host is. It is removed from all documents but the
first that bears it (least doc_id), so that a passage is never lost as a whole. A document is depleted when less than
``LEAST_LEFT`` of the characters of its lines is left. Copies are documents like others: of many in one host the first is kept.

Lines are compared lower-cased, with each run of white space as one space, by 64-bit hash.

Defined cases: a null text is an empty one and fails the base rules; a null source is the host ''; repeated rows get a row each, count as a document each and
are judged alike; a null doc_id is first only where there is no other; lines without a word are no lines; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetide.llm.common import materialise, whole_text

# What separates words, what counts as a symbol, the base limits.
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

MOST_DOCUMENTS = 10
LEAST_LEFT = 0.3

_POSITION_BITS = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _plain_spaces(text: Column) -> Column:
    return F.translate(text, SPACE_CHARACTERS, " " * len(SPACE_CHARACTERS))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(_plain_spaces(text), " "), "")


def _with_equal_neighbour(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """Elements of a sorted array whose key another element has, too."""
    return let(
        ordered,
        lambda s: F.filter(s, lambda x, i: (key(x) == key(F.get(s, i - 1))) | (key(x) == key(F.get(s, i + 1)))),
    )


def repeated_words(words: Column) -> Column:
    """Words in those 3-word windows that the text has twice or more, the first included.

    Windows are sorted by 34 bits of hash with their position in the rest of a long, which is fast and misses none; the few with
    an equal neighbour are then compared as strings.
    """
    position_mask = F.lit((1 << _POSITION_BITS) - 1)

    def of(w: Column) -> Column:
        coded = F.transform(
            F.slice(w, F.lit(1), F.size(w) - 2),
            lambda x, i: F.shiftleft(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), _POSITION_BITS).bitwiseOR(i.cast("long")),
        )
        alike = _with_equal_neighbour(F.sort_array(coded), lambda c: F.shiftright(c, _POSITION_BITS))
        return let(alike, lambda found: F.when(F.size(found) == 0, F.lit(0)).otherwise(covered(w, found)))

    def covered(w: Column, found: Column) -> Column:
        exact = F.transform(
            found,
            lambda c: let(
                c.bitwiseAND(position_mask).cast("int"),
                lambda p: F.struct(F.concat_ws(" ", F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("window"), p.alias("at")),
            ),
        )
        twice = _with_equal_neighbour(F.sort_array(exact), lambda x: x["window"])
        places = F.sort_array(F.transform(twice, lambda x: x["at"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last")),
            lambda a, p: F.struct((a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum"), p.alias("last")),
            lambda a: a["sum"],
        )

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(of(w)))


def _lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARACTERS, "") != "")


def normalised_line(line: Column) -> Column:
    spaced = _plain_spaces(F.lower(line))
    return F.btrim(F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " +", " ")).otherwise(spaced))


def base_statistics(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, the counts within a text, base_failed, and the text's lines as (hash, characters)."""
    text = F.col("text")
    lines = F.transform(
        _lines(text),
        lambda x: let(normalised_line(x), lambda line: F.struct(F.xxhash64(line).alias("line"), F.length(line).alias("chars"))),
    )
    counts = docs.select("doc_id", *carried, whole_text().alias("text")).select(
        "doc_id",
        *carried,
        F.xxhash64("text").alias("text_hash"),
        (F.length(text) - F.length(F.translate(text, SPACE_CHARACTERS, ""))).alias("spaces"),
        F.length(text).alias("chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated"))).alias("words"),
        lines.alias("lines"),
    )
    n_words, repeated = F.col("words.n").cast("long"), F.col("words.repeated").cast("long")
    return counts.select(
        "doc_id", *carried, "text_hash", n_words.alias("n_words"), (F.col("chars") - F.col("spaces")).cast("long").alias("word_chars"),
        "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"),
        ((n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)).alias("base_failed"),
        "lines",
    )


def lines_above_limit(texts: DataFrame, most_documents: int) -> DataFrame:
    """host, line, first_id of the lines to remove, from rows of host, doc_id and lines."""
    borne = texts.select("host", "doc_id", F.explode(F.array_distinct("lines.line")).alias("line"))
    bearers = borne.groupBy("host", "line").agg(F.count(F.lit(1)).alias("bearers"), F.min("doc_id").alias("first_id"))
    return bearers.where(F.col("bearers") > most_documents).select("host", "line", "first_id", F.lit(True).alias("above"))


def quality_of(docs: DataFrame, most_documents: int = MOST_DOCUMENTS, least_left: float = LEAST_LEFT) -> DataFrame:
    """One row per document: host, text_hash, the base counts, line_chars, removed_chars, base_failed, depleted, kept."""
    hosted = docs.withColumn("host", F.coalesce("source", F.lit("")))
    stored = materialise(base_statistics(hosted, "host").withColumn("row", F.monotonically_increasing_id()), "statistics")
    above = materialise(lines_above_limit(stored, most_documents), "above")
    names = [c for c in stored.columns if c != "lines"]
    each = stored.select(*names, F.explode_outer("lines").alias("line"))
    each = each.select(*names, "line.line", "line.chars").join(above, ["host", "line"], "left")
    gone = F.col("above") & ~F.col("first_id").eqNullSafe(F.col("doc_id"))
    per_row = each.groupBy(*names).agg(
        F.coalesce(F.sum("chars"), F.lit(0)).alias("line_chars"),
        F.coalesce(F.sum(F.when(gone, F.col("chars"))), F.lit(0)).alias("removed_chars"),
    )
    depleted = F.col("line_chars") - F.col("removed_chars") < least_left * F.col("line_chars")
    return per_row.drop("row").withColumn("depleted", depleted).withColumn("kept", ~F.col("base_failed") & ~depleted)


def kept_documents(docs: DataFrame, **limits: float) -> DataFrame:
    """The documents, with all their columns, that the rules keep. A verdict holds for a document's id, source and text."""
    rejected = materialise(quality_of(docs, **limits).where("not kept").select("doc_id", "host", "text_hash").distinct(), "rejected")
    mine, other = docs.alias("mine"), rejected.alias("rejected")
    same = (
        F.col("mine.doc_id").eqNullSafe(F.col("rejected.doc_id"))
        & (F.coalesce("mine.source", F.lit("")) == F.col("rejected.host"))
        & (F.xxhash64(whole_text("mine.text")) == F.col("rejected.text_hash"))
    )
    return mine.join(other, same, "left_anti")


def quality_query(docs: DataFrame) -> DataFrame:
    return quality_of(docs).drop("host", "text_hash")
