"""Exact Jaccard join of word-shingle sets: subsets for small sets, inverted lists for large ones.

Two sets with ``100 * |A & B| >= 75 * |A | B|`` share at least ``c = ceil(0.75 m)`` elements, m being
the size of either. In any one order of all elements, the first ``m - c + k`` elements of both then
share at least k. The order is rare-first: a sketch of fixed size counts all shingles of all
documents, so what many documents share stands last and seldom begins a set. The order decides only
how much work there is, never the result.

* Small sets (m up to a boundary): each pair of the first ``m - c + 2`` elements is a signature;
  similar small sets share one.
* Large sets: the first ``m - c + 1`` elements are looked up in inverted lists, which also hold the
  small sets that a large one can still be similar to.
* The boundary is the largest size at which listing pairs costs less than scanning lists, whose mean
  length the sketch's second moment gives.

Equal sets are one node throughout, so copies cost nothing. Short lists give all their pairs. A long
list gives a star: its members against a pivot of their size. Whatever a long list still holds in
different components after the stars meets in a second round: members of lists with one head are dealt
in blocks, each pair of blocks counts all overlaps by its own inverted lists (a matrix product), and only
one link for two components leaves the task. So no link is lost, no pairs are shuffled, and a large group
of near copies costs its size and not its square. Every candidate is verified on the full sets. Neither
links nor sets come to the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import row_chunks, staged
from recordflow.llm.components import components
from recordflow.llm.wordhash import mix, set_ids, shingle_sets

SHINGLE = 5
#: Cells of the counting sketch: 16 MB for the tasks, whatever the corpus.
CELLS = 1 << 24
#: Bits of the filter of wanted documents: 16 for each, within these bounds. A full filter lets more
#: documents pass than are wanted, which costs time only.
FILTER_LEAST, FILTER_MOST = 1 << 20, 1 << 27
_BLOCK = 1 << 14
_HOT = 128  # ranks from here on are those of hot lists
#: Lists up to this length give all their pairs at once.
SHORT_LIST = 4
#: Small sets are never larger than this; beyond it a set would have more than 150 pairs.
MOST_SMALL = 64
#: Postings and set elements per task of the reduce sides.
POSTINGS_PER_BUCKET = 1_000_000
ELEMENTS_PER_BUCKET = 2_000_000
#: Lists that the sketch holds to be longer than this are dealt over all tasks and starred by joins.
HOT_LIST = 2_000
TEXT_BYTES = 2 << 20
#: Sets that meet in one task of the second round, and the elements that are counted at once.
BLOCK_SETS, COUNTED = 1_000, 2_048


def needed(m: np.ndarray) -> np.ndarray:
    """The elements that a set of m must share with any similar set: ceil(0.75 m)."""
    return -(-3 * m // 4)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _sets(batches: Iterator[pa.RecordBatch]):
    for batch, data, offsets in row_chunks(batches, "text", TEXT_BYTES):
        hashes, ends = shingle_sets(data, offsets, SHINGLE)
        yield batch, hashes, ends, set_ids(hashes, ends)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's set size and node, and the task's part of the sketch in blocks."""
    counts = np.zeros(CELLS, np.uint16)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("block", pa.int32()), ("blob", pa.binary())]
    )
    for batch, hashes, ends, nodes in _sets(batches):
        np.add.at(counts, (hashes & np.uint64(CELLS - 1)).astype(np.int64), np.uint16(1))
        none = [None] * len(nodes)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(ends)), pa.array(nodes), pa.array(none, pa.int32()), pa.array(none, pa.binary())],
            schema=schema,
        )
    if counts.any():
        cells = counts.astype("<u2").reshape(-1, _BLOCK)
        none = pa.array([None] * len(cells), pa.int64())
        blobs = pa.array([zlib.compress(c.tobytes(), 1) for c in cells], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, pa.array(range(len(cells)), pa.int32()), blobs], schema=schema
        )


def _add_blocks(mean: float, hot: int):
    """Sums of each block, as ranks of the elements in it; a rank from ``_HOT`` on is that of a hot list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("blob").to_pylist()):
                part = np.frombuffer(zlib.decompress(blob), "<u2")
                if block in total:
                    total[block] += part
                else:
                    total[block] = part.astype(np.uint32)
        for block, cells in total.items():
            counts = cells.astype(np.float64)
            rank = np.minimum(_HOT - 1, 2 * np.log2(1 + counts)) + _HOT * (counts - mean > hot)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "ranks": pa.array([zlib.compress(rank.astype(np.uint8).tobytes(), 1)], pa.binary()),
                    "squares": [float((counts**2).sum())],
                }
            )

    return run


def _sketch(parts: DataFrame, total: int) -> tuple[np.ndarray, float]:
    """The rank of each cell and the sum of the squared counts: fixed sizes, whatever the corpus."""
    blobs = parts.where(F.col("block").isNotNull()).select("block", "blob").repartition("block")
    sums = blobs.mapInArrow(_add_blocks(total / CELLS, HOT_LIST), "block int, ranks binary, squares double")
    ranks, squares = np.zeros(CELLS, np.uint8), 0.0
    for row in sums.toLocalIterator():
        at = row["block"] * _BLOCK
        ranks[at : at + _BLOCK] = np.frombuffer(zlib.decompress(row["ranks"]), np.uint8)
        squares += row["squares"]
    return ranks, squares


def small_boundary(total: float, squares: float) -> int:
    """The largest set size whose pairs cost less than scanning the lists of its prefix.

    ``total`` counts the elements of all sets, ``squares`` sums the squares of the sketch's counts.
    """
    if not total:
        return 2
    # Second moment without what unrelated shingles in one cell add: others per list.
    others = max(0.0, squares / total - total / CELLS - 1)
    sizes = np.arange(3, MOST_SMALL + 1)
    k = sizes - needed(sizes) + 1
    pays = np.flatnonzero(k * (k + 1) // 2 <= k * (1 + others))
    return int(sizes[pays[-1]]) if len(pays) else 2


def _postings(levels: bytes, boundary: int, buckets: int):
    """Postings in blocks by bucket: 32 more bits of the element, node and size; hot ones whole and spread."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(zlib.decompress(levels), np.uint8)
        pend: list[tuple] = []
        seen: set[int] = set()  # nodes since the last block: copies post once
        room = 0

        def block() -> pa.RecordBatch:
            e, node, m, hot = (np.concatenate(x) for x in zip(*pend))
            bucket = np.where(hot, mix(e + node.view(np.uint64)), e & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
            bucket = bucket.astype(np.int64) * 2 + hot
            order = np.argsort(bucket, kind="stable")
            e, node, m, bucket = e[order], node[order], m[order], bucket[order]
            at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(at[1:], len(e))
            whole = bucket[at] % 2 > 0
            elements = [
                (e[x:y] if w else (e[x:y] >> np.uint64(32)).astype("<u4")).tobytes() for x, y, w in zip(at, ends, whole)
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[at] // 2),
                    pa.array(whole),
                    pa.array(elements, pa.binary()),
                    pa.array([node[x:y].tobytes() for x, y in zip(at, ends)], pa.binary()),
                    pa.array([m[x:y].tobytes() for x, y in zip(at, ends)], pa.binary()),
                ],
                ["bucket", "hot", "element", "node", "m"],
            )

        for _, hashes, ends, nodes in _sets(batches):
            sizes = np.diff(ends)
            cell = (hashes & np.uint64(CELLS - 1)).astype(np.int64)
            key = (rank[cell].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
            least = sizes - needed(sizes)
            fresh = np.zeros(len(nodes), bool)
            _, one = np.unique(nodes, return_index=True)
            for i in np.sort(one).tolist():
                if int(nodes[i]) not in seen:
                    seen.add(int(nodes[i]))
                    fresh[i] = True
            keep = np.zeros(len(hashes), bool)
            for i in np.flatnonzero(fresh & (sizes > max(2, 3 * boundary // 4))):
                x, y = ends[i], ends[i + 1]
                keep[x:y] = key[x:y] <= np.partition(key[x:y], least[i])[least[i]]
            at = np.flatnonzero(keep)
            doc = np.searchsorted(ends, at, side="right") - 1
            pend.append((hashes[at], nodes[doc], sizes[doc].astype("<u4"), rank[cell[at]] >= _HOT))
            room += len(at)
            for i in np.flatnonzero(fresh & (sizes > 2) & (sizes <= boundary)):
                x, y = ends[i], ends[i + 1]
                p = least[i] + 2
                first = np.sort(hashes[x:y][key[x:y] <= np.partition(key[x:y], p - 1)[p - 1]])
                j, k = np.triu_indices(len(first), 1)
                pairs = mix(mix(first[j]) + first[k])
                same = np.full(len(pairs), nodes[i])
                pend.append((pairs, same, np.full(len(pairs), sizes[i], "<u4"), np.zeros(len(pairs), bool)))
                room += len(pairs)
            if room > 1_000_000:
                yield block()
                pend.clear()
                seen.clear()
                room = 0
        if room:
            yield block()

    return post


_MEMBERS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("list", pa.int64()), ("m", pa.int64()), ("hot", pa.bool_())])


def _candidates(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Pairs of short lists (list, m null), stars of long ones (list null, m: lists), members of long ones (b null)."""
    hot = np.asarray(table.column("hot").combine_chunks())

    def column(name: str, kind: str, part: np.ndarray) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).filter(pa.array(part)).to_pylist()), kind)

    def members(ids: np.ndarray, node: np.ndarray, m: np.ndarray, is_hot: bool) -> pa.Table:
        none, flag = pa.array([None] * len(ids), pa.int64()), pa.array([is_hot] * len(ids), pa.bool_())
        return pa.table([pa.array(node), none, pa.array(ids), pa.array(m.astype(np.int64)), flag], schema=_MEMBERS)

    out = [members(column("element", "<i8", hot), column("node", "<i8", hot), column("m", "<u4", hot), True)]
    e, node, m = column("element", "<u4", ~hot), column("node", "<i8", ~hot), column("m", "<u4", ~hot).astype(np.int64)
    if len(e):
        order = np.lexsort((node, m, e))
        e, node, m = e[order], node[order], m[order]
        one = np.ones(len(e), bool)
        one[1:] = (e[1:] != e[:-1]) | (node[1:] != node[:-1])
        e, node, m = e[one], node[one], m[one]
        heads = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
        count = np.diff(np.append(heads, len(e)))
        size, place = np.repeat(count, count), np.arange(len(e)) - np.repeat(heads, count)
        found, stars = [], []
        for step in range(1, SHORT_LIST):
            i = np.flatnonzero((size <= SHORT_LIST) & (place + step < size))
            found.append((i, i + step))
        # Sizes ascend within a list. A long list's pivot is the first member that is not too small.
        for h, n in zip(heads[count > SHORT_LIST], count[count > SHORT_LIST]):
            sizes, p = m[h : h + n], 0
            while p < n:
                end = int(np.searchsorted(sizes, 4 * sizes[p] // 3, side="right"))
                stars.append((np.full(end - p - 1, h + p), np.arange(h + p + 1, h + end)))
                p = end
        i, j = (np.concatenate(x) for x in zip(*found))
        fits = 4 * m[i] >= 3 * m[j]
        pairs = np.unique(np.stack([node[i][fits], node[j][fits]], 1), axis=0)
        none = pa.array([None] * len(pairs), pa.int64())
        flag = pa.array([False] * len(pairs), pa.bool_())
        out.append(pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none, flag], schema=_MEMBERS))
        if stars:
            i, j = (np.concatenate(x) for x in zip(*stars))
            pairs, times = np.unique(np.stack([node[i], node[j]], 1), axis=0, return_counts=True)
            none = pa.array([None] * len(pairs), pa.int64())
            flag = pa.array([False] * len(pairs), pa.bool_())
            out.append(pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, pa.array(times), flag], schema=_MEMBERS))
        long = size > SHORT_LIST
        out.append(members((np.int64(key[0].as_py()) << 32) + e[long].astype(np.int64), node[long], m[long], False))
    return pa.concat_tables(out)


def _stars(found: DataFrame) -> DataFrame:
    """One pair for each member of long lists: with the pivot that most of its lists have.

    Hot lists get their pivots here, one a size class, by an aggregation and a join that can be split.
    """
    hot = found.where(F.col("list").isNotNull() & F.col("hot")).select(
        "list", F.floor(F.log(F.col("m")) / math.log(4 / 3)).alias("class"), F.col("a").alias("node")
    )
    pivots = hot.groupBy("list", "class").agg(F.min("node").alias("a"))
    spread = hot.join(pivots, ["list", "class"]).where("a != node").groupBy("a", "node").agg(F.count(F.lit(1)).alias("n"))
    plain = found.where(F.col("list").isNull() & F.col("m").isNotNull()).select("a", F.col("b").alias("node"), F.col("m").alias("n"))
    every = plain.unionByName(spread).groupBy("a", "node").agg(F.sum("n").alias("n"))
    best = every.groupBy("node").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
    return best.select(F.col("a"), F.col("node").alias("b"))


def _wanted_texts(bits: bytes):
    """The texts of documents that some pair needs, compressed, by a filter that lets few others pass."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = np.frombuffer(bits, np.uint8)
        size = np.uint64(8 * len(member))
        seen: set[int] = set()  # repeated rows go once per task
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            at = (mix(ids.view(np.uint64)) % size).astype(np.int64)
            batch = batch.filter(pa.array((member[at >> 3] >> (at & 7) & 1).astype(bool)))
            keys = [hash(x) for x in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            fresh = [not (k in seen or seen.add(k)) for k in keys]
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            texts = [zlib.compress(x.encode(), 4) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return pick


def _filter_bits(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = np.zeros(size // 8, np.uint8)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            at = (mix(ids.view(np.uint64)) % np.uint64(size)).astype(np.int64)
            np.bitwise_or.at(member, at >> 3, (1 << (at & 7)).astype(np.uint8))
        if member.any():
            yield pa.RecordBatch.from_pydict({"bits": pa.array([member.tobytes()], pa.binary())})

    return run


def _sets_of(table: pa.Table) -> tuple[dict[int, np.ndarray], pa.Table]:
    """The sets of a bucket's compressed texts by their nodes, and the rows without text."""
    has = pa.array(np.asarray(table.column("text").is_valid()))
    sets: dict[int, np.ndarray] = {}
    for batch in table.filter(has).select(["text"]).to_batches(max_chunksize=1_000):
        texts = [zlib.decompress(x).decode() for x in batch.column("text").to_pylist()]
        for _, hashes, ends, nodes in _sets(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.large_string())})])):
            sets.update((n, hashes[a:b]) for n, a, b in zip(nodes.tolist(), ends, ends[1:]))
    return sets, table.filter(pc.invert(has))


def _verify(table: pa.Table) -> pa.Table:
    """Links among the pairs of one bucket; the table holds its texts and its pairs."""
    sets, rest = _sets_of(table)
    links = []
    for a, b in zip(rest.column("a").to_pylist(), rest.column("b").to_pylist()):
        x, y = sets[a], sets[b]
        shared = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * shared >= 75 * (len(x) + len(y) - shared):
            links.append((a, b))
    return pa.table({"a": pa.array([p[0] for p in links], pa.int64()), "b": pa.array([p[1] for p in links], pa.int64())})


def _texts_for(docs: DataFrame, sent: DataFrame) -> DataFrame:
    """bucket and compressed text of the documents in ``sent`` (bucket, doc_id); a filter keeps the others' texts away."""
    ids = staged(sent.distinct(), "sent")
    wanted = ids.count()
    size = min(FILTER_MOST, max(FILTER_LEAST, 1 << (16 * wanted).bit_length()))
    bits = np.zeros(size // 8, np.uint8)
    for row in ids.select("doc_id").repartition(8).mapInArrow(_filter_bits(size), "bits binary").toLocalIterator():
        bits |= np.frombuffer(row["bits"], np.uint8)
    found = _texts(docs).mapInArrow(_wanted_texts(bits.tobytes()), "doc_id long, text binary")
    return found.join(ids, found["doc_id"].eqNullSafe(ids["doc_id"])).select("bucket", "text")


def _links(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar.

    A text goes to the bucket of the smallest node that it is paired with, so most groups meet in one
    bucket. A group of too many elements is split by its nodes. A pair is checked where its less paired
    end is, and the other end's text is sent there once for all pairs.
    """
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("o")), F.struct(F.col("b").alias("node"), F.col("a").alias("o"))))
    ends = pairs.select(both.alias("x")).groupBy("x.node").agg(
        F.count(F.lit(1)).alias("d"), F.least(F.min("x.o"), F.first("x.node")).alias("label")
    )
    reps = sets.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    nodes = staged(ends.join(reps, "node"), "nodes")
    elements = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(spread, math.ceil(elements / ELEMENTS_PER_BUCKET))
    sizes = nodes.groupBy("label").agg(F.ceil(F.sum("n") / ELEMENTS_PER_BUCKET).alias("splits"))
    home = F.pmod(F.xxhash64("label", F.pmod(F.xxhash64("node"), F.col("splits"))), F.lit(buckets))
    nodes = staged(nodes.join(sizes, "label").select("node", "doc_id", "d", home.alias("bucket")), "homes")

    def end(x: str) -> DataFrame:
        return nodes.select(F.col("node").alias(x), F.col("d").alias("d" + x), F.col("bucket").alias("bucket_" + x))

    first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    bucket = F.when(first, F.col("bucket_a")).otherwise(F.col("bucket_b")).alias("bucket")
    placed = staged(pairs.join(end("a"), "a").join(end("b"), "b").select("a", "b", bucket), "placed")
    sent = placed.select("bucket", F.col("a").alias("node")).union(placed.select("bucket", "b")).distinct()
    sent = sent.join(nodes.select("node", "doc_id"), "node").select("bucket", "doc_id")
    none = F.lit(None).cast("long")
    texts = _texts_for(docs, sent).select("bucket", none.alias("a"), none.alias("b"), "text")
    rows = texts.unionByName(placed.select("bucket", "a", "b", F.lit(None).cast("binary").alias("text")))
    return rows.groupBy("bucket").applyInArrow(_verify, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut to words; a set holds the distinct five-word shingles, or
    the whole sequence of a shorter text. Null, empty and wordless texts have an empty set: size 0,
    linked with nothing, their own component. ``component_id`` is the smallest ``doc_id`` that links
    reach. A null ``doc_id`` never names a component. Repeated rows get equal results, an empty
    table none. Only ``doc_id`` and ``text`` are read.
    """
    described = staged(
        _texts(docs).mapInArrow(_describe, "doc_id long, n long, node long, block int, blob binary"), "described"
    )
    sets = described.where(F.col("block").isNull()).select("doc_id", "n", "node")
    full = sets.where(F.col("n") > 0)
    total = full.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranks, squares = _sketch(described, total)
    boundary = small_boundary(total, squares)
    posted = full.agg(F.sum(F.floor(F.col("n") / 4) + 1 + F.when(F.col("n") <= boundary, F.col("n")).otherwise(0))).first()[0]
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(spread, math.ceil((posted or 0) / POSTINGS_PER_BUCKET))
    levels = zlib.compress(ranks.tobytes(), 1)
    del ranks
    posts = _texts(docs).mapInArrow(
        _postings(levels, boundary, buckets), "bucket long, hot boolean, element binary, node binary, m binary"
    )
    kinds = "a long, b long, list long, m long, hot boolean"
    found = staged(posts.groupBy("bucket").applyInArrow(_candidates, kinds), "found")

    near = found.where(F.col("list").isNull() & F.col("m").isNull()).select("a", "b").union(_stars(found))
    first = staged(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = staged(_links(docs, full, first), "verified")
    label = components(links)
    more = staged(_across(docs, full, found, label), "across")
    if not more.isEmpty():
        label = components(links.unionByName(more))

    least = full.groupBy("node").agg(F.min("doc_id").alias("least"))
    named = label.join(least, "node")
    group = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_node = named.join(group, "label").select("node", "component_id")
    alone = least.join(by_node, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    return (
        sets.join(alone, (sets["node"] == alone["node"]) & (sets["n"] > 0), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share, by their inverted lists in slices of elements."""
    which = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count > 1
    number = np.cumsum(several) - 1
    keep = several[element]
    which, element = which[keep], number[element[keep]]
    order = np.argsort(element, kind="stable")
    which, element = which[order], element[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(several.sum()), COUNTED):
        a, b = np.searchsorted(element, [low, low + COUNTED])
        has = np.zeros((len(sets), COUNTED), np.float32)
        has[which[a:b], element[a:b] - low] = 1
        shared += has @ has.T
    return shared


def _meet(table: pa.Table) -> pa.Table:
    """Links between components among the sets that meet in the tasks of one bucket; one for two components."""
    sets, rest = _sets_of(table)
    rest = rest.sort_by("task")
    task, node, label = (rest.column(c).to_numpy() for c in ("task", "node", "label"))
    a_out, b_out = [], []
    at = np.flatnonzero(np.append(True, task[1:] != task[:-1])) if len(task) else []
    for x, y in zip(at, np.append(at[1:], len(task))):
        own, labels = node[x:y], label[x:y]
        size = np.array([len(sets[n]) for n in own.tolist()], np.float32)
        shared = _overlaps([sets[n] for n in own.tolist()])
        similar = 100 * shared >= 75 * (size[:, None] + size[None, :] - shared)
        i, j = np.nonzero(similar & (labels[:, None] < labels[None, :]))
        if len(i):
            _, one = np.unique(np.stack([labels[i], labels[j]], 1), axis=0, return_index=True)
            a_out.append(own[i[one]])
            b_out.append(own[j[one]])
    ends = [np.concatenate(o) if o else np.zeros(0, np.int64) for o in (a_out, b_out)]
    return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})


def _across(docs: DataFrame, sets: DataFrame, found: DataFrame, label: DataFrame) -> DataFrame:
    """Links within long lists whose ends the stars left in different components.

    Members of all such lists with the same smallest node meet once; more than a block of them are
    dealt to blocks, and every two blocks meet in a task.
    """
    members = found.where(F.col("list").isNotNull()).select("list", F.col("a").alias("node"))
    named = members.join(label, "node", "left").select("list", "node", F.coalesce("label", "node").alias("label"))
    lists = named.groupBy("list").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("head"))
    mixed = lists.where(F.col("low") != F.col("high")).select("list", "head")
    meeting = staged(named.join(mixed, "list").select("head", "node", "label").distinct(), "meeting")
    blocks = meeting.groupBy("head").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = meeting.join(blocks, "head").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        F.xxhash64("head", F.least(own, F.col("other")), F.greatest(own, F.col("other"))).alias("task"), "node", "label"
    )
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(spread, math.ceil(dealt.count() / BLOCK_SETS))
    dealt = staged(dealt.distinct().withColumn("bucket", F.pmod(F.xxhash64("task"), F.lit(buckets))), "dealt")
    reps = sets.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = _texts_for(docs, dealt.select("bucket", "node").distinct().join(reps, "node").select("bucket", "doc_id"))
    none = F.lit(None).cast("long")
    rows = texts.select("bucket", *[none.alias(c) for c in ("task", "node", "label")], "text").unionByName(
        dealt.select("bucket", "task", "node", "label", F.lit(None).cast("binary").alias("text"))
    )
    return rows.groupBy("bucket").applyInArrow(_meet, "a long, b long")
