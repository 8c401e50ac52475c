"""Line deduplication across documents, in built-in functions: hashes of lines are range-partitioned and sorted.

Long lines become rows (hash, document, position), which are range-partitioned by hash and block of document ids and
sorted by document, latest first, and position. Passing over them in that order marks the first row of every document
and hence of every line. Blocks hold a bounded range of ids, so a line that stands in a third of all documents is
spread over many tasks; only one row for each of its blocks is brought together to count documents and find the one
that keeps the line. What comes out is no text but a compressed bitmap for each document that loses lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import stored, texts_of

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
# Document ids of one block of a line's rows.
BLOCK_IDS = 4096
WORD_BITS = 64
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINE = ("h1", "h2")


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A to Z lower-cased; plain ASCII takes the cheaper function."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def text_mark(text: Column) -> Column:
    """Tells apart rows that share an id; equal rows have equal lines, so they need no telling apart."""
    return F.xxhash64(text)


def long_lines(documents: DataFrame, least_chars: int) -> DataFrame:
    """One row per line whose key is long enough: its hash (128 bits), document, mark of the text, position."""
    lines = documents.select("doc_id", text_mark(F.col("text")).alias("mark"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.where(F.char_length("line") >= least_chars).withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= least_chars)
    return keys.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        F.floor(F.col("doc_id") / F.lit(BLOCK_IDS)).alias("block"),
        "doc_id",
        "mark",
        "pos",
    )


def keep_bitmaps(documents: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark, keep`` of each document that loses lines; a document without a row keeps all of its lines.

    A line is lost if its key, of at least ``least_chars`` code points, stands in at least ``least_docs`` documents, of
    which this one has not the largest id. ``keep`` lists, in order, the 64-bit words of the document's bitmap that are
    not all ones, as (word, bits); bit b of word w is line 64 w + b. A document is an id: rows that repeat an id count
    once, and all of them keep the line if the id is the largest. Null ids are one document, below all others. ``mark``
    is the text's hash, which tells rows of one id with different texts apart. Null texts and empty ones are one
    empty line; an empty table gives an empty result; other columns are not read.
    """
    rows = stored(long_lines(texts_of(documents, id_col, text_col), least_chars))
    order = Window.partitionBy(*LINE, "block").orderBy(F.desc_nulls_last("doc_id"), "mark", "pos")
    dealt = rows.repartitionByRange(*LINE, "block")
    passed = dealt.select(
        "*",
        ((F.row_number().over(order) == 1) | ~F.lag("doc_id").over(order).eqNullSafe(F.col("doc_id"))).cast("int").alias("opens"),
    )
    blocks = passed.groupBy(*LINE, "block").agg(F.sum("opens").alias("docs"), F.max("doc_id").alias("last"))
    whole = Window.partitionBy(*LINE)
    common = (
        blocks.select(*LINE, F.col("block").alias("in_block"), F.sum("docs").over(whole).alias("docs"), F.max("last").over(whole).alias("keeper"))
        .where(F.col("docs") >= least_docs)
        .select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "in_block", "keeper")
    )
    same = (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")) & F.col("block").eqNullSafe(F.col("in_block"))
    lost = passed.join(common, same).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    bit = F.expr(f"shiftleft(1L, pos % {WORD_BITS})")
    words = lost.groupBy("doc_id", "mark", F.expr(f"pos div {WORD_BITS}").alias("word")).agg(F.bit_or(bit).alias("gone"))
    return words.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"))


def lost_positions(keep: Column) -> Column:
    """The positions of the lines that a bitmap does not keep."""
    bits = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))

    def of_word(word: Column) -> Column:
        gone = F.filter(bits, lambda b: F.getbit(word["bits"], b) == 0)
        return F.transform(gone, lambda b: (word["word"] * WORD_BITS + b).cast("int"))

    return F.flatten(F.transform(keep, of_word))


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's lines that its bitmap keeps: ``doc_id, n_lines (before), n_dropped, text``."""
    split = texts_of(documents, id_col, text_col).select("doc_id", text_mark(F.col("text")).alias("mark"), split_lines(F.col("text")).alias("lines"))
    gone = bitmaps.select(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark"), lost_positions(F.col("keep")).alias("gone"))
    found = split.join(gone, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark")), "left")
    # `lines` and `gone` are columns of the join, so the functions below read them without computing them anew per line.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get(F.col("lines"), i)))
    return found.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.array_join(kept, "\n").alias("text"),
    )
