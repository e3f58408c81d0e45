import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken

from tidemart.llm import bpe as B
from tidemart.llm import packing as K
from tidemart.llm import token_counts as C

PARTS = ["a", "e", "th", " ", "  ", "\n", "é", "漢", "字", "'s", "12", "!", "--", "\x1c", "\xa0", "😀", "Ab", "tion", "\t", "ß", "İ", "Σ", "é"]


def texts(seed, n=4000):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 50))) for _ in range(n)]


def library():
    bpe = B.byte_bpe("byte_bpe_50k.tiktoken")
    return bpe, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: n for n, t in bpe.bytes_of.items()}, special_tokens={})


def test_transducer_equals_the_byte_library():
    bpe, enc = library()
    for t in texts(1):
        ids = bpe.encode(t)
        assert ids == enc.encode_ordinary(t)
        assert bpe.decode(ids) == t
    bpe.machine.max_states = 50  # starts anew all the time
    assert all(bpe.encode_span(t) == enc.encode_ordinary(t) for t in ["unbelievable", "antidisestablishmentarianism", "aaaaaaaaaaaaaaaa"] if t)
    bpe.machine.max_states = 250_000


def test_word_encoder_equals_the_library():
    w = B.word_bpe("word_bpe_49k.json")
    for t in texts(2, 2000):
        assert np.frombuffer(w.encode(t), "<u2").tolist() == w.library.encode(t, add_special_tokens=False).ids


def test_utf8_decoder_in_any_cuts():
    text = "aé漢😀z"
    raw = text.encode()
    for cut in range(len(raw) + 1):
        d = B.Utf8Decoder()
        assert d.feed(raw[:cut]) + d.feed(raw[cut:]) + d.close() == text
    for bad in (b"\xff", b"\xc0\x80", b"\xed\xa0\x80", b"\xe6\xbc", b"\xf5a", b"\xe6a"):
        d = B.Utf8Decoder()
        assert d.feed(bad) + d.close() == bad.decode("utf-8", "replace")


def test_encode_decode_rows(make, odd):
    _, enc = library()
    got = {(r.doc_id, r.decoded_sha256): r for r in B.encode_decode(make(odd)).collect()}
    for i, t in odd:
        r = got[i, hashlib.sha256((t or "").encode()).hexdigest()]
        ids = enc.encode_ordinary(t or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert np.frombuffer(r.ids, "<u4").tolist() == ids


def test_word_encoder_looks_a_known_run_up():
    w = B.WordBpe(P.path("word_bpe_49k.json"))
    text = 'A known word, and "one" more: x.y 2024!\nÉté. l\'eau ... don\'t; (end). 漢字, Σ. ' + "long-" * 40
    first = w.encode(text)
    assert np.frombuffer(first, "<u2").tolist() == w.library.encode(text, add_special_tokens=False).ids
    assert not any(len(k) > 64 for k in w.cache)
    w.pieces = None  # words and their marks need no pattern any more
    assert w.encode("A known word, and more: Été.") == B.word_bpe("word_bpe_49k.json").encode("a known word , and more : été .")


def test_terms_and_weights_as_plain_sorting_has_them():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 3000):
        ids = r.integers(0, 700, n).astype("<u2")
        for a, b in zip(K.terms(ids), np.unique(ids, return_counts=True)):
            assert a.tolist() == b.tolist()
        w = r.integers(0, 20, n).astype(np.float32)
        top = np.argsort(-w, kind="stable")[:K.QUERY_TERMS]
        assert K.heaviest(w).tolist() == top[w[top] > 0].tolist()


def test_packing_covers_every_token_once(make, odd):
    w = B.word_bpe("word_bpe_49k.json")
    rows = odd + [(100 + i, " ".join(random.Random(i).choices(["red", "green", "blue", "stone", "river"], k=700))) for i in range(60)]
    got = K.pack(make(rows), shard_bytes=100_000).collect()
    shards = {r.sequence_id >> 32 for r in got}
    assert len(shards) > 1
    sequences = {}
    pieces = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_length))
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        size = parts[0][2]
        assert at <= size <= 4096 and (size == 4096 or size == at)
        short += at < size
    assert short <= len(shards)
    for i, t in rows:
        want = [*np.frombuffer(w.encode(t or ""), "<u2").tolist(), 2]
        parts = [p for p in pieces[i] if p[2] == len(want)]
        copies = sum(1 for j, u in rows if j == i)
        assert sum(len(p[1]) for p in parts) == copies * len(want)
        for start, ids, _ in parts:
            assert want[start:start + len(ids)] == ids
    assert K.pack(make([])).count() == 0


def test_packing_deals_by_content(make):
    topics = ["river stone water bridge valley mountain forest lake field road", "bread cheese butter sugar kitchen dinner salt soup fruit plate",
              "music piano song voice dance concert singer stage guitar drum", "court judge law trial lawyer police prison crime witness jury"]
    r = random.Random(11)
    rows = [(i, " ".join(r.choices(topics[i % 4].split(), k=40) + r.choices(["the", "and", "with", "from"], k=8))) for i in range(480)]
    got = K.pack(make(rows), shard_bytes=9_000).collect()
    shards = {}
    for doc, shard in {(x.doc_id, x.sequence_id >> 32) for x in got}:
        shards.setdefault(shard, []).append(doc % 4)
    assert len(shards) >= 8 and sum(map(len, shards.values())) == len(rows)
    assert sum(max(s.count(t) for t in range(4)) for s in shards.values()) > 0.8 * len(rows)
    # a shard weighs terms by their frequency in the whole table
    df = np.zeros(K.IDS, np.int64)
    df[[5, 6]] = 90, 2
    index = K.Index([np.array([5, 6], np.uint16)] * 2, K.Corpus(100, df, 2.0))
    assert index.own_weight[1] > 5 * index.own_weight[0] > 0


def test_packing_puts_neighbours_together():
    r = random.Random(5)
    a, b = list(range(1000, 1200)), list(range(2000, 2200))
    docs = [np.array(r.choices(a if i % 2 else b, k=500), np.uint16) for i in range(40)]
    order = K.layout(docs)
    assert sorted(order) == list(range(40))
    assert sum((x % 2) != (y % 2) for x, y in zip(order, order[1:])) < 12


def test_counts_follow_edits():
    count = C.counter("byte_bpe_50k.tiktoken")
    r = random.Random(9)
    for t in texts(3, 60) + ["".join(random.Random(4).choices(PARTS, k=8000)), "x" * 3000, "word " * 900, "", " ", "\n" * 900]:
        tree = C.Counts(t, count)
        for _ in range(12):
            assert tree.total == count("".join(tree.leaves)) and "".join(tree.leaves) == t
            start, length, insert = r.randrange(len(t) + 1), r.choice([0, 1, 5, 400]), "".join(r.choices(PARTS, k=r.choice([0, 1, 4, 60])))
            tree.edit(start, length, insert)
            t = t[:start] + insert + t[start + length:]
        assert tree.total == count(t)
    long = "some words go on " * 4000
    tree = C.Counts(long, count)
    before = tree.encoded
    tree.edit(30_000, 3, "other")
    assert tree.encoded - before < 2000


def test_count_tokens_rows(make, odd):
    count = C.counter("byte_bpe_50k.tiktoken")
    docs = C.revision(make(odd))
    edited = {}
    for r in docs.select("doc_id", "text", "edits").collect():
        t = r.text or ""
        for e in r.edits:
            t = t[:e.start] + e.insert + t[e.start + e.length:]
        edited.setdefault(r.doc_id, set()).add((count(r.text or ""), count(t)))
    got = C.count_tokens(docs).collect()
    assert len(got) == len(odd)
    assert all((r.n_tokens, r.n_tokens_edited) in edited[r.doc_id] for r in got)
