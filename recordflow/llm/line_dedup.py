"""Removal of repeated passages by content-defined chunks of lines.

A rolling hash runs over the hashes of neighbouring lines (blank ones are passed over); where it is a multiple
of ``SPAN``, a chunk ends. So a boundary depends on the two lines beside it alone, and a passage has the same
chunks wherever it stands. A chunk of several lines that stands before, here or in another document, goes as
a whole. What lies at the ends of a passage is in chunks that reach beyond it: of all chunks that are not
repeated themselves, each window of the rolling hash (two lines) is looked up as well, and so is each line of
fifty words or more. A match thus reaches over all equal neighbouring lines, and a passage shorter than any chunk
is found, too. Every chunk and window is compared byte by byte with its first occurrence before it goes.

Joins carry hashes and places. The texts of first occurrences are picked out by a filter of fixed size over
their places and travel to their repetitions; whole documents are shuffled once, to meet what they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import WORD, staged

#: Words from which a line is a passage of its own.
LONG_LINE = 50
#: Lines of a chunk, on average.
SPAN = 4
#: Bits of one map of the filter of places, bits for each place, and maps at most (16 MB).
_MAP = 32_768
_BITS_EACH = 16
_MOST_MAPS = 4096
#: Where an item lies: a chunk itself, in no chunk alone, or else the first line of its chunk.
_CHUNK, _JOINT = -2, -1
_ITEM = "array<struct<h: bigint, s: int, e: int, within: int>>"


def _keyed(docs: DataFrame) -> DataFrame:
    """``row`` and the document's key ``k``."""
    return docs.select(
        F.struct("*").alias("row"), F.struct(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t")).alias("k")
    )


def _parsed(keyed: DataFrame) -> DataFrame:
    """With the ``lines`` of a document, and ``full``: number and words of those that have words."""
    a = keyed.select("*", F.split(F.coalesce("row.text", F.lit("")), "\n", -1).alias("lines"))
    # Words are counted inside the list that keeps them: a column of counts, looked up line by line, would be
    # put into the look-up by the optimizer and counted again for every line.
    counted = F.transform("lines", lambda x, i: F.struct((i + 1).alias("i"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    return a.select("*", F.filter(counted, lambda x: x["w"] > 0).alias("full"))


def _hashed(parsed: DataFrame) -> DataFrame:
    """With the hashes of the lines with words, and of each two neighbours (null after the last)."""
    a = parsed.select("*", F.transform("full", lambda x: F.xxhash64(F.get("lines", x["i"] - 1))).alias("hashes"))
    nexts = F.slice("hashes", 2, F.greatest(F.size("hashes") - 1, F.lit(0)))
    return a.select("*", F.zip_with("hashes", nexts, lambda x, y: F.when(y.isNotNull(), F.xxhash64(x, y))).alias("roll"))


def _with_items(docs: DataFrame) -> DataFrame:
    """Everything to look up, as (h, s, e, within): numbers are those of lines with words, from 0.

    Of each chunk: itself, if it has several lines; the windows inside it; the one over its end; its long lines.
    """
    parsed, n = _hashed(_parsed(_keyed(docs))), F.size("hashes")
    none, no_items = F.array().cast("array<int>"), F.array().cast(_ITEM)
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)
    ends = F.filter(every, lambda i: (i == n - 1) | (F.pmod(F.get("roll", i), F.lit(SPAN)) == 0))
    a = parsed.select("*", ends.alias("ends"))
    starts = F.concat(F.array(F.lit(0)), F.transform("ends", lambda i: i + 1))
    zipped = F.zip_with("ends", starts, lambda e, s: F.struct(s.alias("s"), e.alias("e")))
    b = a.select("*", F.filter(zipped, lambda x: x["e"].isNotNull()).alias("chunks"))

    def item(h: Column, s: Column, e: Column, within: Column) -> Column:
        return F.struct(h.alias("h"), s.alias("s"), e.alias("e"), within.cast("int").alias("within"))

    def of_chunk(x: Column) -> Column:
        s, e = x["s"], x["e"]
        lines = F.sequence(s, e)
        whole = F.xxhash64(F.slice("hashes", s + 1, e - s + 1), F.lit(SPAN))
        inside = F.transform(F.slice(lines, F.lit(1), e - s), lambda i: item(F.get("roll", i), i, i + 1, s))
        long = F.transform(
            F.filter(lines, lambda i: F.get("full", i)["w"] >= LONG_LINE),
            lambda i: item(F.xxhash64(F.get("hashes", i), F.lit(LONG_LINE)), i, i, s),
        )
        return F.concat(
            F.when(e > s, F.array(item(whole, s, e, F.lit(_CHUNK))).cast(_ITEM)).otherwise(no_items),
            inside.cast(_ITEM),
            F.when(e < n - 1, F.array(item(F.get("roll", e), e, e + 1, F.lit(_JOINT))).cast(_ITEM)).otherwise(no_items),
            long.cast(_ITEM),
        )

    return b.select("row", "k", "lines", "full", F.flatten(F.transform("chunks", of_chunk)).alias("items"))


def _text(item: Column) -> Column:
    """The lines with words of an item."""
    return F.array_join(
        F.transform(F.slice("full", item["s"] + 1, item["e"] - item["s"] + 1), lambda x: F.get("lines", x["i"] - 1)), "\n"
    )


def _repeated(places: DataFrame) -> DataFrame:
    """(h, first): the first place of everything that stands in several."""
    grouped = places.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "s", "e")).alias("first"))
    return grouped.where("n > 1").select("h", "first")


def _slot(k: Column, s: Column, e: Column, maps: int) -> Column:
    return F.pmod(F.xxhash64(k["d"], k["t"], s, e), F.lit(maps * _MAP))


def _first_texts(items: DataFrame, firsts: DataFrame, wanted: int) -> DataFrame:
    """(h, text) of first occurrences. ``items`` are scanned; rows at other places hardly ever leave their task."""
    maps = min(max(1, -(-wanted * _BITS_EACH // _MAP)), _MOST_MAPS)
    slot = _slot(F.col("first.k"), F.col("first.s"), F.col("first.e"), maps)
    bits = firsts.select((slot / _MAP).cast("int").alias("map"), (slot % _MAP).alias("bit"))
    # No more than 4096 rows of 4 KB.
    bitmaps = staged(bits.groupBy("map").agg(F.call_function("bitmap_construct_agg", F.col("bit")).alias("bits")), "bits")
    texts = items.select("k", F.explode(F.transform("items", lambda x: F.struct(x["h"], x["s"], x["e"], _text(x).alias("text")))).alias("x"))
    texts = texts.select("k", "x.h", "x.s", "x.e", "x.text").withColumn("slot", _slot(F.col("k"), F.col("s"), F.col("e"), maps))
    met = texts.withColumn("map", (F.col("slot") / _MAP).cast("int")).join(F.broadcast(bitmaps), "map")
    at = F.col("slot") % _MAP
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    some = met.where(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1)
    some = some.select("h", "text", F.struct("k", "s", "e").alias("first"))
    return some.join(firsts, ["h", "first"]).dropDuplicates(["h"]).select("h", "text")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``kept_text``, ``n_lines`` and ``n_removed`` of every row.

    First occurrences are those of the smallest (doc_id, hash of the text, place); a null id sorts
    first. Rows with equal id and text are one document, in one place, and share its fate. A null text stays null, an
    empty or wordless one unchanged; a text whose lines all stand before becomes empty. An empty table
    gives no rows. Lines end at ``\\n``; a text of any length is one row of one task. Windows that overlap in one
    document are not two places. Every line that is removed still stands before, in its document or in one that
    sorts before.
    """
    parts = _with_items(docs)
    # Not the inner form of explode: its filter on the size would be pushed below and repeat all of the above.
    each = parts.select("k", F.explode_outer("items").alias("x")).where("x is not null").select("k", "x.*")
    each = staged(each, "places")
    chunks = each.where(F.col("within") == _CHUNK)
    first_chunks = staged(_repeated(chunks), "first-chunks")
    copies = chunks.join(first_chunks, "h").where(F.struct("k", "s", "e") != F.col("first"))
    copies = staged(copies.select("k", "s", "e", "h"), "copies")
    # What lies inside a repeated chunk needs no look-up: the chunk goes as a whole.
    within = copies.select("k", F.col("s").alias("within"))
    rest = each.where(F.col("within") != _CHUNK).join(within, ["k", "within"], "left_anti")
    rest = staged(rest.select("k", "s", "e", "h"), "windows")
    first_windows = staged(_repeated(rest), "first-windows")
    found = rest.join(first_windows, "h")
    # Two windows of one document overlap when the first line of one is the second of the other.
    near = (F.col("k") == F.col("first.k")) & (F.col("s") <= F.col("first.e"))
    again = copies.unionByName(found.where(~near).select("k", "s", "e", "h"))
    firsts = first_chunks.unionByName(first_windows)
    texts = _first_texts(parts, firsts, firsts.count())
    again = again.join(texts, "h").select(F.col("k").alias("rk"), F.struct("s", "e", "text").alias("r"))
    # One list per document, no longer than its own chunks and windows.
    by_doc = again.groupBy("rk").agg(F.collect_list("r").alias("repeats"))
    # A text is cut to lines after the join, so that it is shuffled once, as it is.
    joined = _parsed(_keyed(docs).join(by_doc, F.col("k") == F.col("rk"), "left"))
    none = F.expr("cast(array() as array<int>)")

    def gone(r: Column) -> Column:
        """The lines of an item, with the blank ones between them."""
        span = F.sequence(F.get("full", r["s"])["i"], F.get("full", r["e"])["i"])
        return F.when(_text(r) == r["text"], span).otherwise(none)

    out = joined.withColumn("removed", F.flatten(F.transform("repeats", gone)))
    every = F.sequence(F.lit(1), F.size("lines"))
    out = out.withColumn("keep", F.when(F.size("removed") > 0, F.array_except(every, F.col("removed"))))
    # Of a text whose lines are all gone, the blank ones around them go as well.
    left = F.exists("keep", lambda i: F.get("lines", i - 1).rlike(WORD))
    out = out.withColumn("keep", F.when(left | F.col("keep").isNull(), F.col("keep")).otherwise(none))
    kept = F.array_join(F.transform("keep", lambda i: F.get("lines", i - 1)), "\n")
    result = F.struct(
        "row",
        F.when(F.col("keep").isNull(), F.col("row.text")).otherwise(kept).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("keep"), F.lit(0)).cast("long").alias("n_removed"),
    )
    # Through a generator: a caller's filter would be pushed into the look-ups of lines, and cut the text for each.
    return out.select(F.inline_outer(F.array(result)))
