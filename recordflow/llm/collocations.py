"""Collocations from a weighted de Bruijn graph of words.

Nodes are phrases of three words, edges phrases of four: an edge leads from its first three words to its
last three and weighs as many occurrences as it has. Only the longest phrase that begins at a word is
counted (four words, or what is left of the piece). How often a shorter phrase occurs follows from the
flow: the weights of all edges that begin with it, plus the ends of pieces that do. A node with as much
flow as the edge into it and the edge out of it lies on a path without branches; such paths are contracted,
and the phrases inside need not be told from the longer ones around them.

Two passes over the texts. The first counts pairs of words by 64-bit hashes. Whatever a pair below the
smallest wanted count is in cannot be wanted either, so the second pass ends a phrase there, as at the end
of a piece; the counts of all wanted phrases and of their parts stay exact. Pairs are looked up in a filter of
16 MB at most: what passes by mistake costs work and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from recordflow.llm.common import row_chunks, staged
from recordflow.llm.tally import (
    byte_set,
    key_counts,
    lower_ascii,
    span_hashes,
    span_strings,
    text_bytes_of,
    word_spans,
)
from recordflow.llm.wordhash import mix

#: Words of an edge.
LONGEST = 4
_BREAK = byte_set([*b".,;:!?", *range(0x0A, 0x0E)])
_GAP = _BREAK | byte_set(b" \t")
_CHUNK = 2 << 20
_TIMES = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
#: Bits of the filter of pairs: 16 a pair, up to 16 MB.
FILTER_BITS = (16, 27)
_FILTER_BLOCK = 17


def _chunk(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
    """(bytes, starts, ends, row, hash with the language, whether the next word is in the same piece)."""
    data = lower_ascii(data)
    starts, ends, row = word_spans(data, offsets, _GAP)
    piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts] + row if len(starts) else row
    words = mix(span_hashes(data, starts, ends) ^ langs.view(np.uint64)[row])
    joined = np.zeros(len(starts), bool)
    joined[:-1] = piece[1:] == piece[:-1]
    return data, starts, ends, row, words, joined


def _pair_hashes(words: np.ndarray) -> np.ndarray:
    """The hash of each word and the next one."""
    return mix(words * _TIMES[0] + np.append(words[1:], np.uint64(0)) * _TIMES[1])


def _chunks(batches: Iterator[pa.RecordBatch]):
    for batch, data, offsets in row_chunks(batches, "text", _CHUNK):
        yield batch, _chunk(data, offsets, np.asarray(batch.column("lang_key")))


def _pairs(batches: Iterator[pa.RecordBatch]):
    for _, (_, _, _, _, words, joined) in _chunks(batches):
        keys, counts = np.unique(_pair_hashes(words)[joined], return_counts=True)
        yield keys, counts, None


def _frequent(least: int):
    def finish(keys: np.ndarray, counts: np.ndarray, _) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(keys[counts >= least].view(np.int64))], ["pair"])

    return finish


def _slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    return [(keys & low).astype(np.int64), ((keys >> np.uint64(32)) & low).astype(np.int64)]


def _slot_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(np.concatenate(_slots(np.asarray(batch.column("pair")).view(np.uint64), bits)))
            columns = [pa.array((slot >> _FILTER_BLOCK).astype(np.int32)), pa.array(slot)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "slot"])

    return run


def _bit_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        block, slot = np.asarray(batch.column("block")), np.asarray(batch.column("slot"))
        for b in np.unique(block):
            seen.setdefault(int(b), np.zeros(1 << _FILTER_BLOCK, bool))[slot[block == b] & ((1 << _FILTER_BLOCK) - 1)] = True
    for b, flags in seen.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "bits": [np.packbits(flags).tobytes()]})


def pair_filter(texts: DataFrame, least: int) -> np.ndarray:
    """Bits of the pairs that occur at least ``least`` times, and of few others."""
    found = key_counts(texts, text_bytes_of(texts), _pairs, _frequent(least), "pair long")
    found = staged(found, "pairs")
    low, high = FILTER_BITS
    bits = min(max(low, int(16 * found.count()).bit_length()), high)
    blocks = found.mapInArrow(_slot_rows(bits), "block int, slot long").repartition("block")
    out = np.zeros(max(1, (1 << bits) >> 3), np.uint8)
    size = 1 << (_FILTER_BLOCK - 3)
    for r in blocks.mapInArrow(_bit_blocks, "block int, bits binary").toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        out[r["block"] * size : (r["block"] + 1) * size] = part[: len(out)]
    return out


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for slot in _slots(keys, int(len(bits) * 8).bit_length() - 1):
        out &= (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
    return out


def _longest(bits: np.ndarray):
    """The longest phrases of each chunk with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (data, starts, ends, row, words, joined) in _chunks(batches):
            n = len(starts)
            if not n:
                continue
            follows = joined.copy()
            follows[joined] = _passes(bits, _pair_hashes(words)[joined])
            size, key, more = np.ones(n, np.int64), words * _TIMES[0], np.ones(n, bool)
            for j in range(1, LONGEST):
                more[: n - j + 1] &= follows[j - 1 :]
                more[n - j + 1 :] = False
                size += more
                at = np.flatnonzero(more)
                key[at] += words[at + j] * _TIMES[j]
            _, index, flow = np.unique(mix(key + size.astype(np.uint64)), return_index=True, return_counts=True)
            size, row = size[index], row[index]
            # Words of a phrase are joined by one blank: the gap byte after each but the last.
            spaced = np.append(np.where(_GAP[data], np.uint8(0x20), data), np.uint8(0x20))
            first = np.cumsum(size) - size
            word = np.arange(int(size.sum())) - np.repeat(first, size) + np.repeat(index, size)
            length = ends[word] - starts[word] + 1
            length[first + size - 1] -= 1
            pieces = np.concatenate([[0], np.cumsum(length)])
            text = spaced[np.arange(pieces[-1]) + np.repeat(starts[word] - pieces[:-1], length)]
            at = pieces[first]
            gram = span_strings(text, at, pieces[first + size] - at)
            lang = batch.column("lang").take(pa.array(row))
            columns = [lang, gram, pa.array(size.astype(np.int32)), pa.array(flow)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "size", "flow"])

    return run


def head(gram: str | Column, k: int | Column) -> Column:
    """The first ``k`` words of a phrase; the last ones for negative ``k``."""
    gram = F.col(gram) if isinstance(gram, str) else gram
    return F.call_function("substring_index", gram, F.lit(" "), k if isinstance(k, Column) else F.lit(k))


def flows(edges: DataFrame, least: int) -> DataFrame:
    """(lang, gram, size, flow) of all phrases of up to four words with that flow, from the longest phrases."""
    sizes = F.sequence(F.lit(1), F.least("size", F.lit(LONGEST - 1)))
    parts = edges.select("lang", "flow", "gram", F.explode(sizes).alias("size"))
    nodes = parts.groupBy("lang", head("gram", F.col("size")).alias("gram"), "size").agg(F.sum("flow").alias("flow"))
    return nodes.unionByName(edges.where(F.col("size") == LONGEST)).where(F.col("flow") >= least)


def paths(counts: DataFrame) -> DataFrame:
    """(lang, words, flow): edges joined along nodes that have no flow besides.

    An edge and the one after it belong together if the node between them has the flow of both. Pointers to
    the edge before are doubled until all have reached the first one. A path lies inside a piece of a
    text, so its list of words is no longer than that.
    """
    edges = counts.where(F.col("size") == LONGEST).select("lang", F.col("gram").alias("edge"), "flow")
    nodes = counts.where(F.col("size") == LONGEST - 1).select("lang", F.col("gram").alias("node"), "flow")
    at = ["lang", "node", "flow"]
    into = edges.withColumn("node", head("edge", -3)).join(nodes, at).select("lang", "node", F.col("edge").alias("before"))
    out = edges.withColumn("node", head("edge", 3)).join(nodes, at).select("lang", "node", "edge")
    now = staged(out.join(into, ["lang", "node"]).select("lang", "edge", "before", F.lit(1).alias("steps")), "chains")
    while True:
        mark = Observation("chains")
        further = now.select("lang", F.col("edge").alias("before"), F.col("before").alias("first"), F.col("steps").alias("more"))
        moved = now.join(further, ["lang", "before"], "left").select(
            "lang",
            "edge",
            F.coalesce("first", "before").alias("before"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            "first",
        )
        moved = moved.observe(mark, F.count("first").alias("n")).drop("first")
        now = staged(moved, "chains")
        if not mark.get["n"]:
            break
    placed = edges.join(now, ["lang", "edge"], "left")
    step = F.struct(F.coalesce("steps", F.lit(0)).alias("steps"), head("edge", -1).alias("word"))
    lists = placed.groupBy("lang", F.coalesce("before", "edge").alias("head")).agg(
        F.sort_array(F.collect_list(step)).alias("steps"), F.max("flow").alias("flow")
    )
    rest = F.transform(F.slice("steps", F.lit(2), F.size("steps")), lambda s: s["word"])
    return lists.select("lang", F.concat(F.split("head", " "), rest).alias("words"), "flow")


def _inside(counts: DataFrame, joined: DataFrame) -> DataFrame:
    """(lang, gram, above): the largest count of a longer phrase around a phrase.

    A pair inside four words is inside three words that occur at least as often.
    """
    starts = F.sequence(F.lit(1), F.size("words") - 2)
    threes = joined.select("lang", "flow", "words", F.explode(starts).alias("at")).select(
        "lang", F.concat_ws(" ", F.slice("words", F.col("at"), F.lit(3))).alias("gram"), "flow"
    )
    nodes = counts.where(F.col("size") == 3)
    twos = nodes.select("lang", F.explode(F.array(head("gram", 2), head("gram", -2))).alias("gram"), "flow")
    return threes.unionByName(twos).groupBy("lang", "gram").agg(F.max("flow").alias("above"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80) -> DataFrame:
    """The ``top`` collocations of each language: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\n-\\r]`` and those into words at blanks and tabs;
    phrases have two to four words, occur ``a >= least`` times and stay inside a piece. A cut after k
    words gives ``floor(2000000 * a / (l + r))`` with the counts of both parts; the smallest counts, the first
    of equal ones. Phrases inside a longer one with ``covered`` percent of their occurrences are left out.
    Ties in score go to the larger ``a``, then to the smaller phrase by bytes.

    A null language is ``und``, a null or empty text has no words, repeated rows count again, an empty table
    gives no rows. A text of any length is one piece of work for one task. Only ``text`` and ``lang`` are read.
    """
    lang = F.coalesce("lang", F.lit("und")).alias("lang")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), lang, F.xxhash64(lang).alias("lang_key"))
    bits = pair_filter(texts, least)
    found = texts.mapInArrow(_longest(bits), "lang string, gram string, size int, flow long")
    edges = staged(found.groupBy("lang", "gram", "size").agg(F.sum("flow").alias("flow")), "edges")
    counts = staged(flows(edges, least), "flows")
    kept = counts.where("size > 1").join(_inside(counts, paths(counts)), ["lang", "gram"], "left")
    wide = lambda name: F.col(name).cast("decimal(38, 0)")
    kept = kept.where(F.col("above").isNull() | (wide("above") * 100 < wide("flow") * covered)).drop("above")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": head("gram", F.col("k")), "right": head("gram", F.col("k") - F.col("size"))})
    part = lambda name, count: counts.select("lang", F.col("gram").alias(name), F.col("flow").alias(count))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    score = F.expr("cast(cast(flow as decimal(30, 0)) * 2000000 as decimal(38, 0)) div (l + r)")
    best = cuts.groupBy("lang", "gram", "flow").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    rows = best.select("lang", F.col("gram").alias("phrase"), F.col("flow").alias("a"), "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    total = edges.groupBy("lang").agg(F.sum("flow").alias("n"))
    return rows.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
