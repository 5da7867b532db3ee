"""I-Match fingerprints over a lexicon and randomised subsets of it.

A term is a hashed, lower-cased word. The lexicon keeps the terms whose document frequency lies in a band; the
frequencies are counted over all documents, in a sketch of fixed size. A text keeps its distinct terms of the
lexicon. Where those are less than half of its terms, which is so for texts of words that are everywhere or
nowhere else, the rarer half of the others is added. The kept terms, sorted, are hashed

* once as a whole,
* in eight broad random subsets, each without a quarter of all terms, and
* in narrow random subsets, where a text has about one term each, at three levels that suit its number of terms.

The first two see every kept term and say that texts are equal or almost so; a few changed terms spare some of the
broad subsets. The narrow ones, the first of 2**level subsets, tell how much texts have in common when broad
ones all differ.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import row_chunks, staged, text_bytes
from recordflow.llm.wordhash import mix, word_hashes

CELLS = 1 << 20
_BLOCK = 1 << 14
#: The lexicon: terms in at least two documents and this share of all, and at most that share.
BAND = (1e-5, 0.05)
#: A text with a smaller share of its distinct terms in the lexicon adds this share of the others.
LEAST_SHARE = 0.5
#: Broad subsets, and the eighths of all terms that each has.
BROAD = 8
BROAD_EIGHTHS = 6
#: Narrow subsets of each level.
SUBSETS = 48
LEVELS = (-1, 0, 1)
MOST_LEVEL = 40
_CHUNK = 2 << 20


def distinct_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms (cells) of each text, as parallel arrays (text, cell), both ascending."""
    words, ends = word_hashes(data, offsets, lower=True)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    pairs = np.unique(doc * CELLS + (words & np.uint64(CELLS - 1)).astype(np.int64))
    return pairs // CELLS, pairs % CELLS


def kept_terms(doc: np.ndarray, cell: np.ndarray, n: int, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms that fingerprints are made of, of terms (doc, cell).

    ``rarity`` has 0 for the cells of the lexicon and, for others, their place by document frequency. Terms
    beyond the lexicon are taken by that place, equal ones by the hash of the cell.
    """
    order = np.lexsort((mix(cell.astype(np.uint64)), rarity[cell], doc))
    doc, cell = doc[order], cell[order]
    size = np.bincount(doc, minlength=n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    own = np.bincount(doc, rarity[cell] == 0, minlength=n).astype(np.int64)
    more = np.where(own < LEAST_SHARE * size, np.ceil(LEAST_SHARE * (size - own)).astype(np.int64), 0)
    keep = place < (own + more)[doc]
    return doc[keep], cell[keep]


class Prints:
    """Fingerprints of texts: the level, the hash of all terms, those of broad subsets and of narrow ones."""

    def __init__(self, level: np.ndarray, whole: np.ndarray, broad: np.ndarray, narrow: np.ndarray):
        self.level, self.whole, self.broad, self.narrow = level, whole, broad, narrow

    def packed(self, i: int) -> bytes:
        return b"".join(
            [
                bytes([int(self.level[i])]),
                self.whole[i : i + 1].astype(">u8").tobytes(),
                self.broad[i].astype(">u4").tobytes(),
                self.narrow[i].astype(">u2").tobytes(),
            ]
        )

    def likeness(self, i: int, j: int) -> float:
        """1 for equal kept terms; else the larger of two shares of equal subsets.

        The share of equal broad subsets counts for texts that differ in few terms, that of narrow ones, of those
        that either text has terms in, at a level that both have, for others. Texts without terms are like each other
        alone.
        """
        if self.whole[i] == self.whole[j]:
            return 1.0
        if not self.whole[i] or not self.whole[j]:
            return 0.0
        broad = float((self.broad[i] == self.broad[j]).mean())
        return max(broad, self._narrow_share(i, j))

    def _narrow_share(self, i: int, j: int) -> float:
        a, b = int(self.level[i]), int(self.level[j])
        own_a = {a + s: n for n, s in enumerate(LEVELS)}
        own_b = {b + s: n for n, s in enumerate(LEVELS)}
        shared = [x for x in own_a if x in own_b and x >= 0]
        if not shared:
            return 0.0
        # The level nearest to both, the finer one of two.
        best = min(shared, key=lambda x: (abs(x - a) + abs(x - b), -x))
        x, y = self.narrow[i, own_a[best]], self.narrow[j, own_b[best]]
        some = (x > 0) | (y > 0)
        return float((x[some] == y[some]).sum() / some.sum()) if some.any() else 0.0


def _sums(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Hashes of sets of terms: the mixed sum of the terms' hashes, whatever their order; 0 for none."""
    out = np.zeros(n, np.uint64)
    np.add.at(out, doc, value)
    return np.where(np.bincount(doc, minlength=n) > 0, np.maximum(mix(out), np.uint64(1)), np.uint64(0))


def fingerprints(data: np.ndarray, offsets: np.ndarray, rarity: np.ndarray) -> Prints:
    """Fingerprints of texts; one without words has no terms and zeros throughout."""
    n = len(offsets) - 1
    doc, cell = kept_terms(*distinct_terms(data, offsets), n, rarity)
    cell = cell.astype(np.uint64)
    level = np.ceil(np.log2(np.maximum(1, np.bincount(doc, minlength=n)))).astype(np.int64)
    spot, value = mix(cell + np.uint64(0x51ED270B)), mix(cell * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
    broad = np.zeros((n, BROAD), np.uint32)
    for k in range(BROAD):
        # Three bits of the term's place for each broad subset.
        has = (spot >> np.uint64(3 * k)) & np.uint64(7) < np.uint64(BROAD_EIGHTHS)
        broad[:, k] = (_sums(doc[has], value[has], n) >> np.uint64(32)).astype(np.uint32)
    narrow = np.zeros((n, len(LEVELS), SUBSETS), np.uint16)
    for i, step in enumerate(LEVELS):
        bits = np.clip(level + step, 0, MOST_LEVEL)[doc].astype(np.uint64)
        subset = np.where(bits > 0, spot >> (np.uint64(64) - np.maximum(bits, np.uint64(1))), np.uint64(0))
        first = subset < SUBSETS
        sums = _sums(doc[first] * SUBSETS + subset[first].astype(np.int64), value[first], n * SUBSETS)
        short = (sums >> np.uint64(48)).astype(np.uint16)
        narrow[:, i, :] = np.where(sums > 0, np.maximum(short, 1), 0).reshape(n, SUBSETS)
    return Prints(level, _sums(doc, value, n), broad, narrow)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, docs = np.zeros(CELLS, np.int64), 0
    for batch, data, offsets in row_chunks(batches, "text", _CHUNK):
        _, cell = distinct_terms(data, offsets)
        counts += np.bincount(cell, minlength=CELLS)
        docs += batch.num_rows
    if docs:
        cells = counts.astype("<u4").reshape(-1, _BLOCK)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(cells)), pa.int32()),
                pa.array([zlib.compress(c.tobytes(), 1) for c in cells], pa.binary()),
                pa.array([docs] + [0] * (len(cells) - 1), pa.int64()),
            ],
            ["block", "blob", "docs"],
        )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    docs: dict[int, int] = {}
    for batch in batches:
        for block, blob, n in zip(*(batch.column(c).to_pylist() for c in ("block", "blob", "docs"))):
            part = np.frombuffer(zlib.decompress(blob), "<u4").astype(np.int64)
            total[block] = total[block] + part if block in total else part
            docs[block] = docs.get(block, 0) + n
    blocks = sorted(total)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(blocks, pa.int32()),
            pa.array([total[b].tobytes() for b in blocks], pa.binary()),
            pa.array([docs[b] for b in blocks], pa.int64()),
        ],
        ["block", "blob", "docs"],
    )


def fit_lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """For each cell 0 if it belongs to the lexicon, else how common it is among the others, from all documents."""
    kinds = "block int, blob binary, docs long"
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    cells, n = np.zeros(CELLS, np.int64), 0
    for row in texts.mapInArrow(_count, kinds).repartition("block").mapInArrow(_add, kinds).toLocalIterator():
        cells[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(row["blob"], np.int64)
        n += row["docs"]
    known = (cells >= max(2, band[0] * n)) & (cells <= max(2, band[1] * n))
    # Eighths of a power of two of the frequency: 1 for a single document.
    common = 1 + np.round(8 * np.log2(np.maximum(cells, 1))).astype(np.int64)
    return np.where(known, 0, np.minimum(common, 255)).astype(np.uint8)


_OUT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _compare(ids: list, texts: list[str], following: list[str], rarity: np.ndarray) -> dict[str, list]:
    """The result rows of texts with the text that follows each."""
    edited = []
    for text, nxt in zip(texts, following):
        k = len(text) // 3
        edited.append(text[: len(text) - k] + nxt[:k])
    n = len(texts)
    prints = fingerprints(*text_bytes(pa.array(texts + edited + following[-1:], pa.string())), rarity)
    # The text that follows is the next one of the list, but for the last.
    after = list(range(1, n)) + [2 * n]
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).digest() for t in edited],
        "fingerprint": [prints.packed(i) for i in range(n)],
        "edited_fingerprint": [prints.packed(n + i) for i in range(n)],
        "near_edited": [prints.likeness(i, n + i) for i in range(n)],
        "near_next": [prints.likeness(i, j) for i, j in enumerate(after)],
    }


def _rarity(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def _edit(packed: bytes):
    """Rows of one range; its first text and its last, which lacks a next one, are put aside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = _rarity(packed)
        part = TaskContext.get().partitionId()
        columns = [c.split()[0] for c in _OUT.split(", ")]
        schema = pa.schema(
            [
                *zip(columns, [pa.int64(), pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2]),
                ("part", pa.int64()),
                ("kind", pa.string()),
                ("text", pa.string()),
            ]
        )

        def aside(kind: str, doc_id, text: str) -> pa.RecordBatch:
            row = dict.fromkeys(columns) | {"doc_id": doc_id, "part": part, "kind": kind, "text": text}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        last: tuple | None = None
        for batch, _, _ in row_chunks(batches, "text", _CHUNK):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if last is None:
                yield aside("head", ids[0], texts[0])
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            last = ids[-1], texts[-1]
            if len(texts) > 1:
                found = _compare(ids[:-1], texts[:-1], texts[1:], rarity)
                none = [None] * (len(texts) - 1)
                yield pa.RecordBatch.from_pydict(found | {"part": none, "kind": none, "text": none}, schema=schema)
        if last is not None:
            yield aside("tail", *last)

    return run


def _finish(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = _rarity(packed)
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pydict(_compare([row["doc_id"]], [row["text"]], [row["next"]], rarity))

    return run


def fingerprint_edits(docs: DataFrame, rarity: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last third replaced by the beginning of the next document, in descending
    order of ``doc_id`` (equal ids by a hash of the text, null last; the first follows the last). A null
    text is empty. Only ``doc_id`` and ``text`` are read; repeated rows are rows of their own, an empty
    table gives none. Texts are dealt by ranges of ids once; a range's last document meets the first
    one of the next range afterwards. A text of any length is fingerprinted whole, by one task. Fingerprints are
    base64 text.
    """
    spark = docs.sparkSession
    packed = zlib.compress((fit_lexicon(docs) if rarity is None else rarity).tobytes())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = staged(ranged.mapInArrow(_edit(packed), f"{_OUT}, part long, kind string, text string"), "edits")
    heads = done.where("kind = 'head'").select(F.col("part").alias("at"), F.col("text").alias("next"))
    # Part numbers only, one per range, come to the driver.
    parts = sorted(r["at"] for r in heads.select("at").collect())
    follow = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, at long")
    tails = done.where("kind = 'tail'").select("part", "doc_id", "text").join(follow, "part").join(heads, "at")
    ends = tails.select("doc_id", "text", "next").mapInArrow(_finish(packed), _OUT)
    both = done.where(F.col("kind").isNull()).drop("part", "kind", "text").unionByName(ends)
    texts = {c: F.translate(F.base64(c), "\r\n", "") for c in ("fingerprint", "edited_fingerprint")}
    return both.withColumns(texts | {"edited_sha256": F.lower(F.hex("edited_sha256"))})
