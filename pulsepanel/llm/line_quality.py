"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per text: characters in words, symbols, repeated lines, and words in repeated 3-word windows. Across texts:
lines are normalised (lower case, runs of white space as one blank), hashed, and each hash is counted in how
many distinct documents (id and text) of its host it occurs; with ``copies_count_once``, in how many distinct texts,
so that copies of one text are not boilerplate of a host. Lines above the limit are removed (``remove_lines``), and a
text that is left with too small a share of its words is rejected.

Counting is a distinct count in two steps with partial sums in every task, so a host with a third of all
rows or a line that most texts share is spread by line, text and task. Frequent lines are joined back on host
and hash, a join that adaptive execution may split.

A repeated window is first looked for by hash, then compared word by word: hashes only nominate. White space
is the ASCII kind (tab to carriage return, blank). Null texts are empty: no words, no lines, rejected. A null
host is a host of its own. Rows with one id and equal text share their result, each row
gets one; they count once, and are depleted by the lines of any of their hosts. An empty table gives an empty one. A
very long text is one row of a task; its lines are rows of their own while they are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.common import ROW, join_rows, join_table

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: A line is boilerplate of a host above this number of distinct documents.
MAX_DOCUMENTS = 20
#: A text is depleted when less than this share of the words of its lines is left.
MIN_LEFT_PERCENT = 30
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
_POSITION = (1 << 31) - 1


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, "[\\x09-\\x0D ]+")
    )


def _lines(text: Column) -> Column:
    """The lines that hold a word, as they are."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add n_repeat_words to a table with words and n_words."""
    starts = F.sequence(F.lit(0), F.col("n_words") - 3)
    word = lambda i, k: F.get(F.col("words"), i + k)
    has_window = F.col("n_words") >= 3
    no_longs = F.array().cast("array<bigint>")
    gram = F.transform(starts, lambda i: F.xxhash64(word(i, 0), word(i, 1), word(i, 2)))
    df = df.withColumn("grams", F.when(has_window, gram).otherwise(no_longs))
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    # the upper half of the hash and the position in one number, in order
    packed = F.transform(
        "grams", lambda h, i: h.bitwiseAND(F.lit(~_POSITION)).bitwiseOR(i.cast("bigint"))
    )
    df = df.withColumn("packed", F.when(repeats, F.sort_array(packed)).otherwise(no_longs))
    upper = lambda i: F.shiftright(F.get(F.col("packed"), i), 31)
    beside = F.filter(
        F.sequence(F.lit(0), F.size("packed") - 1),
        lambda i: F.coalesce(upper(i) == upper(i - 1), F.lit(False))
        | F.coalesce(upper(i) == upper(i + 1), F.lit(False)),
    )
    at = lambda i: F.get(F.col("packed"), i).bitwiseAND(F.lit(_POSITION)).cast("int")
    nominated = F.sort_array(
        F.transform(
            beside,
            lambda i: F.struct(
                F.concat_ws(" ", word(at(i), 0), word(at(i), 1), word(at(i), 2)).alias("run"),
                at(i).alias("at"),
            ),
        )
    )
    empty = F.array().cast("array<struct<run: string, at: int>>")
    df = df.withColumn("nominated", F.when(F.size("packed") > 0, nominated).otherwise(empty))
    run = lambda i: F.get(F.col("nominated"), i)["run"]
    confirmed = F.filter(
        "nominated",
        lambda x, i: F.coalesce(run(i - 1) == x["run"], F.lit(False))
        | F.coalesce(run(i + 1) == x["run"], F.lit(False)),
    )
    found = F.sort_array(F.transform(confirmed, lambda x: x["at"]))
    # windows in order: each adds the words behind the end of the one before
    covered = F.aggregate(
        found,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct(
            (acc["n"] + 3 - F.greatest(F.lit(0), acc["end"] - p)).alias("n"), (p + 3).alias("end")
        ),
        lambda acc: acc["n"],
    )
    return df.withColumn(
        "n_repeat_words", F.when(F.size("nominated") > 0, covered).otherwise(F.lit(0).cast("bigint"))
    )


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row key and the figures of each text alone."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("words", _words(F.col("text"))).withColumn("lines", _lines(F.col("text")))
    rows = rows.withColumn("n_words", F.size("words"))
    return _repeat_words(rows).select(
        "doc_id",
        F.xxhash64("text").alias(ROW),
        F.col("n_words").cast("bigint"),
        F.length(F.translate("text", SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
    )


def host_lines(
    docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, row key, place among the lines, host, line hash and words of every line that holds a word."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    host = F.coalesce(F.concat(F.lit("="), F.col(f"`{host_col}`").cast("string")), F.lit(""))
    bare = F.btrim(F.col("line"), F.lit(SPACE))
    normal = F.lower(F.regexp_replace(bare, "[\\x09-\\x0D ]+", " "))
    blanks = F.length(normal) - F.length(F.translate(normal, " ", ""))
    each = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.xxhash64(host).alias("host"))
    each = each.select("doc_id", F.xxhash64("text").alias(ROW), "host", F.posexplode(F.split("text", "\n")))
    return (
        each.withColumnsRenamed({"pos": "at", "col": "line"})
        .where(bare != "")
        .select("doc_id", ROW, "at", "host", F.xxhash64(normal).alias("hash"), (blanks + 1).alias("n"))
    )


def frequent_lines(
    lines: DataFrame, limit: int = MAX_DOCUMENTS, copies_count_once: bool = False
) -> DataFrame:
    """host and hash of the lines in more than ``limit`` distinct documents, or texts, of the host."""
    document = F.col(ROW) if copies_count_once else F.struct("doc_id", ROW)
    counts = lines.groupBy("host", "hash").agg(F.count_distinct(document).alias("documents"))
    return counts.where(F.col("documents") > limit).select("host", "hash")


def remove_lines(
    docs: DataFrame,
    host_col: str = "source",
    limit: int = MAX_DOCUMENTS,
    copies_count_once: bool = False,
) -> DataFrame:
    """All rows and columns of a table with doc_id and text; texts without their host's frequent lines.

    The other lines stay as they are, empty ones too. A null text stays null; a text of which all lines go is empty.
    """
    lines = host_lines(docs, host_col)
    gone = (
        lines.join(frequent_lines(lines, limit, copies_count_once), ["host", "hash"], "left_semi")
        .groupBy("doc_id", ROW)
        .agg(F.sort_array(F.collect_set("at")).alias("gone"))
    )
    marked = join_table(docs, gone, "left")
    at = F.col(f"`{marked.columns[-1]}`")
    all_lines = F.split("text", "\n")
    # the lines between one place that goes and the next, from before the first to behind the last
    ends = F.concat(F.array(F.lit(-1)), at, F.array(F.size(all_lines)))
    between = F.transform(
        F.sequence(F.lit(0), F.size(at)),
        lambda i: F.slice(all_lines, F.get(ends, i) + 2, F.get(ends, i + 1) - F.get(ends, i) - 1),
    )
    left = F.when(at.isNull(), F.col("text")).otherwise(F.array_join(F.flatten(between), "\n"))
    return marked.select(*(left.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def judge(
    docs: DataFrame,
    host_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = MAX_DOCUMENTS,
    min_left_percent: int = MIN_LEFT_PERCENT,
    copies_count_once: bool = False,
) -> DataFrame:
    """The figures of every row, base_failed, the share of words left, and whether it is kept.

    A line that repeats within a text counts once here: repetition has its own figures.
    """
    lines = host_lines(docs, host_col, id_col, text_col)
    frequent = frequent_lines(lines, limit, copies_count_once).withColumn("frequent", F.lit(True))
    left = (
        lines.drop("at")
        .distinct()
        .join(frequent, ["host", "hash"], "left")
        .groupBy("doc_id", ROW)
        .agg(
            F.sum("n").alias("line_words"),
            F.sum(F.when(F.col("frequent"), F.col("n")).otherwise(0)).alias("frequent_words"),
        )
    )
    out = join_rows(measures(docs, id_col, text_col), left)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    lost = F.coalesce("frequent_words", F.lit(0).cast("bigint"))
    of = F.coalesce("line_words", F.lit(0).cast("bigint"))
    return out.select(
        "doc_id", ROW, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        lost.alias("n_frequent_words"),
        failed.alias("base_failed"),
        (~failed & (100 * (of - lost) >= min_left_percent * of)).alias("kept"),
    )
