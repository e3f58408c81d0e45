"""Byte-pair encoding by a lazily determinised transducer, and streaming UTF-8 decoding.

The merges of a vocabulary define, for every prefix of a piece, exactly one
valid last token: the one whose left neighbour in the encoding of the shorter
prefix keeps apart from it when the merges run over both. Reading a piece left
to right, the set of tokens that may still be open is a non-deterministic
automaton with outputs. ``Transducer`` determinises it on demand: a state is
the set of (open token, output still undecided, last closed token); what all of
them agree on is emitted at once, so the lookahead is bounded by the longest
token. Transitions are remembered, and the whole machine starts anew when it
holds ``max_states`` states.

Pieces are strings of units; a unit is one byte (as a Latin-1 character).
"""

from __future__ import annotations

import base64
import contextlib
import ctypes
import gc
import re
from array import array
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unicode white space as the tokenizer libraries understand \s (fixed values).
WHITE = r"\t-\r \x85\xa0  -     　"

CACHE_ENTRIES = 100_000


class Memo(dict):
    """Results of ``make`` in two generations of ``size``: what was used in the last one outlives the next.

    Only what ``keep`` holds true of, if given, is remembered."""

    def __init__(self, make, size=CACHE_ENTRIES, keep=None):
        super().__init__()
        self.make, self.size, self.keep, self.old = make, size, keep, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if self.keep is None or self.keep(key):
            self.put(key, value)
        return value

    def put(self, key, value):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def drop(self) -> int:
        n = len(self) + len(self.old)
        self.clear()
        self.old = {}
        return n


class Transducer:
    """``vocab``: unit string -> id, which is the rank of the merge that makes it too."""

    def __init__(self, vocab, max_states=200_000):
        self.vocab, self.max_states = vocab, max_states
        self.open = {h: h for t in vocab for h in (t[:i] for i in range(1, len(t)))}
        self.edges: dict[str, tuple] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self._restart()

    def _restart(self):
        self.states = {}
        self.start = self._state((("", (), ""),))

    def _state(self, entries):
        """A state is its moves, unit -> (state, output); under None it keeps its entries and its output at the end."""
        state = self.states.get(entries)
        if state is None:
            state = self.states[entries] = {None: (entries, next((out for held, out, _ in entries if not held), ()))}
        return state

    def _edges(self, token):
        """How the merge loop builds ``token`` alone: (reached, its leftmost parts, its rightmost parts).

        A part comes with the ranks of the merges that made it and that used it up. The ranks of a token's merges
        rise, since a merge of a token is learned after the token.
        """
        known = self.edges.get(token)
        if known is not None:
            return known
        parts = list(token)
        left, right = [[parts[0], -1, None]], [[parts[-1], -1, None]]
        while len(parts) > 1:
            ranks = [(r, i) for i in range(len(parts) - 1) if (r := self.vocab.get(parts[i] + parts[i + 1])) is not None]
            if not ranks:
                break
            r, i = min(ranks)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            for side, at, j in ((left, 0, 0), (right, -1, len(parts) - 1)):
                if i == j:
                    side[-1][2] = r
                    side.append([parts[at], r, None])
        known = self.edges[token] = (len(parts) == 1, left, right)
        return known

    def _follows(self, last, token):
        """Whether the merges over both leave ``last`` and ``token`` as they are: no merge joins their edges first."""
        reached, left, _ = self._edges(token)
        if not last:
            return reached
        known = self.apart.get((last, token))
        if known is None:
            if len(self.apart) > 150_000:
                self.apart.clear()
            known, rank = reached, self.vocab.get
            for a, made_a, used_a in self._edges(last)[2] if reached else ():
                for b, made_b, used_b in left:
                    r = rank(a + b)
                    if r is not None and r > made_a and r > made_b and (used_a is None or r < used_a) and (used_b is None or r <= used_b):
                        known = False
            self.apart[last, token] = known
        return known

    def _move(self, state, unit):
        entries, closed = [], None
        for held, out, last in state[None][0]:
            token = held + unit
            if closed is None and token in self.vocab and self._follows(last, token):
                closed = ("", (*out, self.vocab[token]), token)
            if token in self.open:
                entries.append((self.open[token], out, last))
        if closed is None:
            raise ValueError(f"the vocabulary has no token for unit {unit!r}")
        entries.append(closed)
        first = entries[0][1]
        agreed = min(len(out) for _, out, _ in entries)
        for _, out, _ in entries:
            while out[:agreed] != first[:agreed]:
                agreed -= 1
        entries = tuple(sorted((held, out[agreed:], last) for held, out, last in entries))
        move = state[unit] = (self._state(entries), first[:agreed])
        return move

    def encode(self, piece) -> list[int]:
        if len(self.states) > self.max_states:
            self._restart()
        state, out = self.start, []
        for unit in piece:
            try:
                state, closed = state[unit]
            except KeyError:
                state, closed = self._move(state, unit)
            if closed:
                out += closed
        out += state[None][1]
        return out


    def forget(self) -> int:
        n = len(self.states)
        self.apart.clear()
        self.edges.clear()
        self._restart()
        return n


class Utf8Decoder:
    """Incremental UTF-8: bytes in any cuts, text of the complete characters out; bad bytes become U+FFFD.

    ``need`` counts the continuation bytes still missing, ``low``/``high`` bound the next one (shorter forms and
    surrogates are refused).
    """

    def __init__(self):
        self.need, self.low, self.high, self.code = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        out, at = [], 0
        while at < len(data):
            if not self.need:
                try:
                    out.append(data[at:].decode())
                    break
                except UnicodeDecodeError as e:
                    out.append(data[at : at + e.start].decode())
                    at += e.start
            out.append(self._byte(data[at]))
            at += 1
        return "".join(out)

    def _byte(self, b: int) -> str:
        bad = ""
        if self.need:
            if self.low <= b <= self.high:
                self.code, self.need = self.code << 6 | b & 0x3F, self.need - 1
                self.low, self.high = 0x80, 0xBF
                return "" if self.need else chr(self.code)
            bad, self.need, self.low, self.high = "\ufffd", 0, 0x80, 0xBF
        if b < 0x80:
            return bad + chr(b)
        if 0xC2 <= b <= 0xDF:
            self.need, self.code = 1, b & 0x1F
        elif 0xE0 <= b <= 0xEF:
            self.need, self.code = 2, b & 0x0F
            self.low, self.high = (0xA0, 0xBF) if b == 0xE0 else (0x80, 0x9F) if b == 0xED else (0x80, 0xBF)
        elif 0xF0 <= b <= 0xF4:
            self.need, self.code = 3, b & 0x07
            self.low, self.high = (0x90, 0xBF) if b == 0xF0 else (0x80, 0x8F) if b == 0xF4 else (0x80, 0xBF)
        else:
            return bad + "\ufffd"
        return bad

    def close(self) -> str:
        bad, self.need, self.low, self.high = self.need, 0, 0x80, 0xBF
        return "�" if bad else ""


class ByteBpe:
    """Encoder and decoder for a file of byte ranks, pre-tokenised by ``pattern``."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {n: t for t, n in ranks.items()}
        self.decimals = {n: str(n) for n in self.bytes_of}
        vocab = {t.decode("latin-1"): n for t, n in ranks.items()}
        self.vocab = vocab
        self.machine = Transducer(vocab, 250_000)
        self.pieces = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))
        self.loose = regex.compile(f" [{WHITE}]|[{WHITE}] |^[{WHITE}]|[{WHITE}]$")
        self.cache = Memo(self._packed, 200_000)

    def forget(self) -> int:
        """Drop what is remembered; returns how much it was."""
        return self.machine.forget() + self.cache.drop()

    def encode_piece(self, piece: str) -> list[int]:
        units = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        whole = self.vocab.get(units)
        return [whole] if whole is not None else self.machine.encode(units)

    def spans(self, text: str) -> list[str]:
        """Cuts of ``text`` at which pre-tokens begin whatever stands around them.

        Between a character that isn't white space and a single space no pre-token goes on, so words with the
        space before them can be encoded, and remembered, one by one. Texts with other white space next to a
        space are cut into the pre-tokens themselves.
        """
        if not text:
            return []
        if self.loose.search(text):
            return self.pieces.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]

    def encode_span(self, span: str) -> list[int]:
        return [n for p in self.split(span) for n in self.encode_piece(p)]

    def _packed(self, span: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers; pre-tokens are remembered among the spans."""
        parts = self.split(span)
        if len(parts) == 1:
            return array("I", self.encode_piece(span)).tobytes()
        return b"".join(map(self.cache.__getitem__, parts))

    def split(self, span: str) -> list[str]:
        """Pre-tokens of a span; a word of letters with its space, and one character after it, needs no pattern."""
        word = span[1:] if span[0] == " " else span
        if word.isalpha():
            return [span]
        if word[:-1].isalpha():
            return [span[:-1], span[-1]]
        return self.pieces.findall(span)

    def encode(self, text: str) -> list[int]:
        return array("I", b"".join(map(self.cache.__getitem__, self.spans(text)))).tolist()

    def decode_stream(self, ids, block=1):
        """Text as it becomes complete, ``block`` tokens at a time."""
        machine, bytes_of = Utf8Decoder(), self.bytes_of
        for i in range(0, len(ids), block):
            yield machine.feed(b"".join(map(bytes_of.__getitem__, ids[i : i + block])))
        yield machine.close()

    def decode(self, ids) -> str:
        return "".join(self.decode_stream(ids, 4096))


class WordBpe:
    """Encoder for a tokenizers file: lower case, white space dropped, BPE with word ends.

    No pre-token goes on over white space, so the runs between it are encoded, and remembered, one by one, and the
    pre-tokens of a new run among them. A new one goes to the model of the tokenizers library. Runs with letters beyond the
    Latin blocks, and texts with the separators U+001C to U+001F, go through the whole library, whose normaliser
    then decides.
    """

    #: Pre-token pattern of the file's splitter (fixed value), with its letters and numbers up to U+024F.
    LETTERS, NUMBERS = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾"
    PIECES = rf"[{LETTERS}]+|[{NUMBERS}]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{LETTERS}{NUMBERS}]+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = (b for b in range(256) if b not in own)
        self.alphabet = {b: 256 + i for i, b in enumerate(others)}
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        self.pieces = re.compile(self.PIECES)
        # a mark between a letter and white space is a pre-token by itself: parted from its word, it spares a run of its own
        self.mark = re.compile(rf"[.,;:!?](?<=[{self.LETTERS}].)(?!\S)")
        # a text whose lower case stays within the Latin blocks is in normal form C but for Kelvin and Angstrom signs
        self.beyond = re.compile("[^\0-\u024f]")
        self.cache = Memo(self._run, 200_000, self._common)

    def forget(self) -> int:
        """Drop what is remembered; returns how much it was."""
        return self.cache.drop()

    def _whole(self, text: str) -> bytes:
        return array("H", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    @staticmethod
    def _common(run: str) -> bool:
        return len(run) <= 64

    def _run(self, run: str) -> bytes:
        """Ids of a run in lower case, or of one with letters beyond the Latin blocks as it is."""
        plain = run.isascii()
        if not plain and self.beyond.search(run.lower()):
            return self._whole(run)
        if not run.isalpha():
            pieces = self.pieces.findall(run)
            if len(pieces) > 1:
                return b"".join(map(self.cache.__getitem__, pieces))
        units = run if plain and run.isalpha() else run.encode().decode("latin-1").translate(self.alphabet)
        return array("H", [t.id for t in self.model.tokenize(units)]).tobytes()

    def _split(self, text: str) -> list[str]:
        """Runs between white space in lower case, without the mark that ends them; one with letters beyond the Latin blocks stays as it is."""
        low = text.lower()
        if low.isascii() or not self.beyond.search(low):
            return self.mark.sub(r" \g<0>", low).split()
        return [r if self.beyond.search(r.lower()) else r.lower() for r in text.split()]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 16-bit numbers."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._whole(text)
        return b"".join(map(self.cache.__getitem__, self._split(text)))


_encoders: list = []


def _long_lived() -> None:
    """The automaton is many small objects that all live on: keep the cyclic collector from walking them often."""
    gc.freeze()
    gc.set_threshold(200_000, 50, 100)


@lru_cache(maxsize=2)
def byte_bpe(name: str) -> ByteBpe:
    """One encoder for each Python worker; ``name``: a rank file of the public tokenizers."""
    import public_tokenizers as P

    out = ByteBpe(P.path(name), P.PATTERN)
    _encoders.append(out)
    _long_lived()
    return out


@lru_cache(maxsize=2)
def word_bpe(name: str) -> WordBpe:
    import public_tokenizers as P

    out = WordBpe(P.path(name))
    _encoders.append(out)
    _long_lived()
    return out


def release_encoders() -> None:
    """Give back what the encoders of this Python worker remember; tasks of other operators begin with it.

    Spark keeps workers from one stage to the next, and with them the memory of an encoder that nobody uses then.
    """
    if sum(e.forget() for e in _encoders) <= 1000:
        return
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def encode_decode(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", keep_ids: bool = True) -> DataFrame:
    """Ids of each whole text and the digest of the bytes decoded from them.

    Returns (doc_id, n_tokens, ids binary: little-endian unsigned 32 bit, ids_sha256, decoded_sha256). ids is null
    without ``keep_ids``. A null or
    empty text has no ids; repeated rows give repeated results. No shuffle: one Arrow pass over the rows.
    """
    import hashlib

    import pyarrow as pa

    def run(batches):
        bpe = byte_bpe(ranks)
        decimal = bpe.decimals.__getitem__
        for batch in batches:
            n, packed, ids_sha, back_sha = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text or "")
                n.append(len(ids))
                packed.append(array("I", ids).tobytes() if keep_ids else None)
                ids_sha.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                back_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.binary()), pa.array(ids_sha), pa.array(back_sha)],
                names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")
