import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_fixtures import docs, messy, tokenizer  # noqa: F401
from recordflow.llm import packing, token_files
from recordflow.llm.common import text_bytes
from recordflow.llm.encode import encoder


def plain(tokenizer):
    t = Tokenizer.from_file(tokenizer)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é,.'s1 \n\t  日<|>\x85\x1c", max_size=40), max_size=5))
def test_pieces_encode_like_whole_texts(texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, ends = encoder(path).encode(*text_bytes(pa.array(texts, pa.string())))
    assert [list(ids[a:b]) for a, b in zip(ends, ends[1:])] == [plain(path)(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<", "one", "'s", " ", "  ", "\n", "é", ","]), max_size=12), max_size=5))
def test_added_tokens_encode_as_the_library_does(texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, texts = Tokenizer.from_file(path), ["".join(t) for t in ["one <|endoftext|> two", *texts]]
    ids, ends = encoder(path).encode(*text_bytes(pa.array(texts, pa.string())))
    assert [list(ids[a:b]) for a, b in zip(ends, ends[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in ids[: ends[1]]


def test_added_tokens_that_take_in_blanks(tmp_path, tokenizer):
    from tokenizers import AddedToken

    library = Tokenizer.from_file(tokenizer)
    library.add_special_tokens([AddedToken("<sep>", lstrip=True, rstrip=True, normalized=False)])
    library.add_tokens([AddedToken("<sep>x", normalized=True)])
    library.save(str(tmp_path / "own.json"))
    texts = ["one  <sep> \n two <sep>x<|endoftext|>", "<sep", ">", "", "a <sep>"]
    ids, ends = encoder(str(tmp_path / "own.json")).encode(*text_bytes(pa.array(texts, pa.string())))
    assert [list(ids[a:b]) for a, b in zip(ends, ends[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files(docs, messy, tokenizer):
    encode = plain(tokenizer)
    manifest = token_files.write_token_files(docs(messy), tokenizer, end_id=2)
    rows = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 6, 7, 8, 9]
    texts = {m[0]: m[1] for m in messy}
    at = 0
    for r in rows:
        ids = encode(texts[r.doc_id]) + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    assert token_files.read_token_files(token_files.write_token_files(docs([]), tokenizer, 2)).collect() == []


def test_packing(docs, messy, tokenizer):
    encode = plain(tokenizer)
    rows = packing.pack_documents(docs(messy), tokenizer, end_id=0).collect()
    texts = {m[0]: encode(m[1]) + [0] for m in messy}
    ids = defaultdict(list)
    for r in rows:
        ids[r.doc_id].append((r.start, r.length))
        assert r.doc_tokens == len(texts[r.doc_id]) and r.ids_crc32 == crc(texts[r.doc_id][r.start : r.start + r.length])
    for doc_id, parts in ids.items():
        times = sum(m[0] == doc_id for m in messy)
        assert sorted(parts) == sorted([(a, min(1024, len(texts[doc_id]) - a)) for a in range(0, len(texts[doc_id]), 1024)] * times)
    seen = defaultdict(list)
    for r in rows:
        seen[r.sequence_id].append((r.offset, r.length))
    for parts in seen.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 1024
    assert packing.pack_documents(docs([]), tokenizer).collect() == []


def test_windows_are_filled_as_well_as_can_be():
    rng = random.Random(3)
    for _ in range(30):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(6)}
        room = rng.randrange(1, 90)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        taken = packing.best_fill(counts, room)
        assert all(taken[k] <= counts[k] for k in taken)
        assert sum(k * v for k, v in taken.items()) == max(s for s in sums if s <= room)
    lengths = [rng.randrange(1, 1024) for _ in range(4000)]
    windows = packing.plan_windows(lengths)
    used = [x for pattern, times in windows for _ in range(times) for x in pattern]
    assert sorted(used) == sorted(lengths)
    assert sum(times for _, times in windows) * 1024 <= 1.01 * sum(lengths)  # hardly any padding


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_pieces_are_encoded_together(tokenizer, monkeypatch):
    from recordflow.llm import encode

    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé'.,1", k=rng.randrange(1, 9))) for _ in range(6000)]
    texts = [" ".join(words[i : i + 50]) + rng.choice(["", "\n", "  ", " 日", "<|endoftext|>"]) for i in range(0, 6000, 50)]
    library = Tokenizer.from_file(tokenizer)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]

    def check(own, given):
        ids, ends = own.encode(*text_bytes(pa.array(given, pa.string())))
        return [list(ids[a:b]) for a, b in zip(ends, ends[1:])]

    own = encode.Encoder(tokenizer)
    own.tokenizer = counted = Counted(own.tokenizer)
    plain_texts = [t.removesuffix("<|endoftext|>") for t in texts]
    assert check(own, plain_texts) == [library.encode(t, add_special_tokens=False).ids for t in plain_texts]
    assert counted.texts < 500
    assert check(own, texts) == want
    # A cache that is too small, and pieces that all have one hash, cost work only.
    monkeypatch.setattr(encode, "CACHE", 40)
    small = encode.Encoder(tokenizer)
    assert [check(small, texts[i : i + 10]) for i in range(0, 120, 10)] == [want[i : i + 10] for i in range(0, 120, 10)]
    assert len(small.known) <= 40
    monkeypatch.setattr(encode, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    assert check(encode.Encoder(tokenizer), texts) == want
