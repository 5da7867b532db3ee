"""A log-bilinear language model, trained with noise-contrastive estimation, that scores whole texts.

A text is its words and one end. The model predicts the next token from the four before it: the context's
vector is the sum of the words' vectors, each scaled component by component for its place, and a token's score is
the product of that vector with its own, plus its bias. Outputs are the end, the most frequent words, and 64
classes of all other words by their last two bytes; within a class a word has its add-one share of the class's
tokens, with one share for words never seen. The softmax over all outputs is computed whole, as a product of
matrices for thousands of contexts at once, so probabilities are normalised.

Counts of words cover all texts that are learned from; every word of them is one training step. A round takes a
share of the documents: each task goes through its own texts, and the models are averaged block by block, weighted
by their tokens. Only the model, of a fixed size, comes to the driver. Counts of the words that are not in a
bounded table of the most frequent ones are joined to the texts that use them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import row_chunks, staged
from recordflow.llm.tally import byte_set, key_counts, lower_ascii, span_hashes, text_bytes_of, word_spans
from recordflow.llm.wordhash import mix

#: Words with an output of their own, and classes of other words.
WORDS = 191
CLASSES = 64
OUTPUTS = 1 + WORDS + CLASSES
END, START = 0, OUTPUTS
CONTEXT = 4
DIM = 24
#: Words whose counts every scoring task has at hand.
TABLE = 1 << 17
#: Noise samples that the steps of a batch share, the batch, contexts scored at once, the rate of adaptive steps.
NOISE = 32
BATCH = 1024
SCORED = 512
RATE = 0.1
#: Sixteenths of the documents in each round.
ROUNDS = ((0, 1), (1, 4), (4, 16))
_GAP = byte_set([0x20, *range(0x09, 0x0E)])
_CHUNK = 1 << 20
_SEED = 20_011


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, row) of each word."""
    data = lower_ascii(data)
    starts, ends, row = word_spans(data, offsets, _GAP)
    last = data[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    return span_hashes(data, starts, ends), (mix(last * np.uint64(257) + before) % np.uint64(CLASSES)).astype(np.uint8), row


def _keys(batches: Iterator[pa.RecordBatch]):
    for _, data, offsets in row_chunks(batches, "text", _CHUNK):
        keys, kinds, _ = _words(data, offsets)
        keys, first, counts = np.unique(keys, return_index=True, return_counts=True)
        yield keys, counts, kinds[first]


def _rows(keys: np.ndarray, counts: np.ndarray, tags: np.ndarray) -> Iterator[pa.RecordBatch]:
    columns = [pa.array(keys.view(np.int64)), pa.array(tags.astype(np.int32)), pa.array(counts)]
    yield pa.RecordBatch.from_arrays(columns, ["key", "kind", "n"])


class Vocabulary:
    """Counts of all words as a table, and what every task has to know of them."""

    def __init__(self, texts: DataFrame):
        self.docs = texts.count()
        counted = key_counts(texts.select("text"), text_bytes_of(texts), _keys, _rows, "key long, kind int, n long")
        self.words = staged(counted, "words")
        per_class = self.words.groupBy("kind").agg(F.sum("n"), F.count(F.lit(1))).collect()
        top = self.words.orderBy(F.desc("n"), "key").limit(TABLE).toArrow()
        keys, kinds, counts = (np.asarray(top[c].combine_chunks()) for c in ("key", "kind", "n"))
        own = min(WORDS, len(keys))
        #: All tokens and all distinct ones, ends included.
        self.tokens = sum(n for _, n, _ in per_class) + self.docs
        self.distinct = sum(v for _, _, v in per_class) + (self.docs > 0)
        tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
        for kind, n, v in per_class:
            tokens[kind], distinct[kind] = n, v
        np.subtract.at(tokens, kinds[:own], counts[:own])
        np.subtract.at(distinct, kinds[:own], 1)
        self.class_size = tokens + distinct + 1
        self.share = np.concatenate([[self.docs], counts[:own], np.zeros(WORDS - own), tokens]) + 0.5
        self.share /= self.share.sum()
        order = np.argsort(keys.view(np.uint64))
        self.keys, self.counts = keys.view(np.uint64)[order], counts[order]
        out = np.full(len(keys), -1)
        out[:own] = 1 + np.arange(own)
        self.outputs = out[order]

    def local(self) -> Lexicon:
        return Lexicon(self.keys, self.counts, self.outputs, self.share, self.class_size)


class Lexicon:
    """The bounded part of a vocabulary, for tasks."""

    def __init__(self, keys, counts, outputs, share, class_size):
        self.keys, self.counts, self.outputs, self.share, self.class_size = keys, counts, outputs, share, class_size

    def find(self, keys: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The output of each word, and its count (0 if it is not in the table)."""
        if not len(self.keys):
            return 1 + WORDS + kinds.astype(np.int64), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        own = np.where(known, self.outputs[at], -1)
        return np.where(own < 0, 1 + WORDS + kinds.astype(np.int64), own), np.where(known, self.counts[at], 0)


def contexts(outputs: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of ``n`` texts with an end after each: (target, contexts, where each text begins)."""
    sizes = np.bincount(row, minlength=n) + 1
    begins = np.cumsum(sizes) - sizes
    target = np.full(int(sizes.sum()), END, np.int64)
    target[np.arange(len(row)) + row] = outputs
    place = np.arange(len(target)) - np.repeat(begins, sizes)
    before = np.full((CONTEXT, len(target)), START, np.int64)
    for j in range(CONTEXT):
        before[j, j + 1 :] = np.where(place[j + 1 :] > j, target[: max(0, len(target) - j - 1)], START)
    return target, before, begins


class Model:
    """Parameters as one vector, with views; the second half are the sums of squared steps."""

    SHAPES = {"given": (OUTPUTS + 1, DIM), "out": (OUTPUTS, DIM), "bias": (OUTPUTS,), "place": (CONTEXT, DIM)}

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        half = len(flat) // 2
        at, self.p, self.g = 0, {}, {}
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            self.p[name] = flat[at : at + size].reshape(shape)
            self.g[name] = flat[half + at : half + at + size].reshape(shape)
            at += size

    @classmethod
    def initial(cls, share: np.ndarray) -> Model:
        half = sum(int(np.prod(s)) for s in cls.SHAPES.values())
        model = cls(np.zeros(2 * half, np.float32))
        rng = np.random.default_rng(_SEED)
        for name in ("given", "out"):
            model.p[name][:] = rng.normal(0, 0.1, cls.SHAPES[name])
        model.p["place"][:] = 1 / np.sqrt(1 + np.arange(CONTEXT))[:, None]
        model.p["bias"][:] = np.log(share)
        model.flat[half:] = 1e-5
        return model

    def vectors(self, before: np.ndarray) -> np.ndarray:
        out = self.p["given"][before[0]] * self.p["place"][0]
        for j in range(1, CONTEXT):
            out += self.p["given"][before[j]] * self.p["place"][j]
        return out

    def log_probabilities(self, target: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Natural logarithms of the targets' probabilities; the softmax is over all outputs."""
        out = np.empty(len(target))
        # The bias is one more component, so that logits come from one product.
        outputs = np.concatenate([self.p["out"], self.p["bias"][:, None]], 1).T.copy()
        size = float(np.sqrt((self.p["out"] ** 2).sum(1)).max())
        one = np.ones((SCORED, 1), np.float32)
        for a in range(0, len(target), SCORED):
            t = target[a : a + SCORED]
            given = np.concatenate([self.vectors(before[:, a : a + SCORED]), one[: len(t)]], 1)
            logits = given @ outputs
            # Biases are about logarithms of shares: no exponential of 32 bits overflows and some are not small.
            if size * float(np.sqrt((given * given).sum(1)).max()) > 60 or self.p["bias"].max() > 20:
                logits -= logits.max(1)[:, None]
            own = logits[np.arange(len(t)), t].astype(np.float64)
            out[a : a + len(t)] = own - np.log(np.exp(logits, out=logits).sum(1).astype(np.float64))
        return out

    def _step(self, name: str, grad: np.ndarray, rows=slice(None)) -> None:
        g = self.g[name]
        g[rows] += grad * grad
        self.p[name][rows] += RATE * grad / np.sqrt(g[rows])

    def learn(self, target: np.ndarray, before: np.ndarray, share: np.ndarray, rng: np.random.Generator) -> None:
        """One step of noise-contrastive estimation for each batch: data against shared noise."""
        odds = np.log(NOISE * share).astype(np.float32)
        for a in range(0, len(target), BATCH):
            t, ctx = target[a : a + BATCH], before[:, a : a + BATCH]
            noise = rng.choice(OUTPUTS, NOISE, p=share)
            given = [self.p["given"][c] for c in ctx]
            q = sum(v * self.p["place"][j] for j, v in enumerate(given))
            out, bias = self.p["out"], self.p["bias"]
            data = (q * out[t]).sum(1) + bias[t] - odds[t]
            false = q @ out[noise].T + (bias[noise] - odds[noise])
            up = 1 / (1 + np.exp(np.clip(data, -30, 30)))
            down = -1 / (1 + np.exp(np.clip(-false, -30, 30)))
            dq = up[:, None] * out[t] + down @ out[noise]
            d_out = _summed(t, up[:, None] * q, OUTPUTS)
            d_bias = np.bincount(t, up, OUTPUTS)
            np.add.at(d_out, noise, down.T @ q)
            np.add.at(d_bias, noise, down.sum(0))
            d_given = np.zeros((OUTPUTS + 1, DIM))
            d_place = np.empty((CONTEXT, DIM))
            for j in range(CONTEXT):
                d_given += _summed(ctx[j], dq * self.p["place"][j], OUTPUTS + 1)
                d_place[j] = (dq * given[j]).sum(0)
            scale = 1 / len(t)
            for name, grad in (("out", d_out), ("bias", d_bias), ("given", d_given), ("place", d_place)):
                self._step(name, (grad * scale).astype(np.float32))


def _summed(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by index."""
    flat = (index[:, None] * DIM + np.arange(DIM)).ravel()
    return np.bincount(flat, rows.ravel(), n * DIM).reshape(n, DIM)


def _train(model: Model, words: Lexicon, number: int):
    """The model after the texts of a task, in blocks weighted by its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, steps, rng = Model(model.flat.copy()), 0, None
        for batch, data, offsets in row_chunks(batches, "text", _CHUNK):
            keys, kinds, row = _words(data, offsets)
            rng = rng or np.random.default_rng([_SEED, number, int(keys[0]) if len(keys) else 0])
            target, before, _ = contexts(words.find(keys, kinds)[0], row, batch.num_rows)
            own.learn(target, before, words.share, rng)
            steps += len(target)
        if steps:
            parts = np.array_split(own.flat.astype(np.float64) * steps, _BLOCKS)
            blobs = pa.array([p.tobytes() for p in parts], pa.binary())
            columns = [pa.array(range(_BLOCKS), pa.int32()), blobs, pa.array([float(steps)] * _BLOCKS)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "blob", "steps"])

    return run


#: Blocks that models are averaged in.
_BLOCKS = 16


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            seen = total.setdefault(r["block"], [0.0, 0.0])
            seen[0] = seen[0] + np.frombuffer(r["blob"])
            seen[1] += r["steps"]
    for block, (blob, steps) in total.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "blob": [blob.tobytes()], "steps": [steps]})


def fit(texts: DataFrame) -> tuple[Vocabulary, Model]:
    """Counts and a model of (text, deal): ``deal`` says in which round a text is learned from."""
    words = Vocabulary(texts)
    model, kinds = Model.initial(words.share), "block int, blob binary, steps double"
    for number, (low, high) in enumerate(ROUNDS):
        some = texts.where(F.col("deal").between(low, high - 1)).select("text")
        got = some.mapInArrow(_train(model, words.local(), number), kinds).repartition("block").mapInArrow(_average, kinds).collect()
        if got:
            parts = [np.frombuffer(r["blob"]) / r["steps"] for r in sorted(got, key=lambda r: r["block"])]
            model = Model(np.concatenate(parts).astype(np.float32))
    return words, model


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<long>"


def _score(model: Model, words: Lexicon, end_count: int):
    """What a text's scores are made of, but for the counts of its rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, part = 0, TaskContext.get().partitionId()
        for batch, data, offsets in row_chunks(batches, "text", _CHUNK):
            n = batch.num_rows
            keys, kinds, row = _words(data, offsets)
            output, count = words.find(keys, kinds)
            target, before, begins = contexts(output, row, n)
            model_sum = np.add.reduceat(model.log_probabilities(target, before) / np.log(10), begins)
            known, named = count > 0, output <= WORDS
            logs = np.where(known, np.log10(count + 1.0), 0)
            base = np.bincount(row, logs, n) + np.log10(end_count + 1.0)
            inside = logs - np.log10(words.class_size[np.where(named, 0, output - 1 - WORDS)])
            model_sum += np.bincount(row, np.where(named, 0, inside), n)
            rare = keys[~known].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=n))])
            columns = [
                pa.array((np.int64(part) << 40) + done + np.arange(n)),
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(np.bincount(row, minlength=n) + 1),
                pa.array(np.bincount(row[known], minlength=n) + int(end_count > 0)),
                pa.array(base),
                pa.array(model_sum),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(rare)),
            ]
            done += n
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])

    return run


def score_texts(docs: DataFrame, learn: Column) -> DataFrame:
    """Score every text by a model of those for which ``learn`` is true.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): ``score`` is the model's log10
    probability of the text's words and its end, ``base_score`` that of the add-one unigram model. Where
    ``learn`` is false the text is held out; where it is null (no id) neither.

    Words are lower-cased (A-Z) and lie between white space; a null or empty text is its end alone. A text of any
    length is scored whole, by one task. Repeated rows count again and are scored alike, but for rounding in 32-bit
    products. With nothing to learn from, the counts are zero and the model is uniform. An empty table gives no rows.
    Only ``doc_id`` and ``text`` are read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        learn.alias("learn"),
        F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(16)).alias("deal"),
    )
    words, model = fit(rows.where("learn").select("text", "deal"))
    asked = rows.select("doc_id", (~F.coalesce("learn", F.lit(True))).alias("held_out"), "text")
    scored = staged(asked.mapInArrow(_score(model, words.local(), words.docs), _SCORED), "scored")
    rare = scored.select("row", F.explode("rare").alias("key")).join(words.words.select("key", "n"), "key", "left")
    more = rare.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("logs"), F.count("n").alias("found")
    )
    both = scored.drop("rare").join(more, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    size = float(np.log10(words.tokens + words.distinct + 1.0))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * size).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
