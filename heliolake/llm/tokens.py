"""Problem 7: token ids of every text by a public byte-level BPE, as a streaming transducer.

Every text, whatever its length, is fed to the same transducer in chunks of ``CHUNK`` characters;
ids are emitted once no later input can change them. What is held back is bounded by the chunk, the longest
word between spaces and the merge list's lookahead, or by ``RUN`` characters where a word is longer.

* Units. A space after a character that is no white space begins a new pretoken whatever follows,
  so what stands between such places is final once the next one is seen.
* Pretokens. Within a unit the pattern tells them apart. Of a unit that goes on beyond ``RUN``
  characters, pretokens are final that end ``PATTERN_LOOKAHEAD`` characters before the end of what is held: a
  run is decided by the character after it, a contraction by two more. A single run (letters,
  digits, symbols or white space) that is longer still goes on into the piece transducer as it arrives.
* Pieces. The bytes of a pretoken are encoded from left to right. A sequence of tokens is
  the encoding of its bytes exactly if each two neighbours are the encoding of theirs, so the
  encoding of each prefix is the encoding of a shorter prefix and one token. The final encoding
  passes through one of any ``lookahead`` successive places, which is the longest token that
  the merge list can form in a run of the given kind. Tokens common to the chains from all of
  these places are stable and leave.

What the transducer gave for a pretoken or unit of up to ``KEPT_LENGTH`` characters is kept for its next occurrence.
Decoding goes back through a byte-to-text state machine that keeps unfinished characters.

Defined results: null and empty texts have the empty list; strings of special tokens are
ordinary text; lone surrogates, which UTF-8 can't hold, encode as a question mark.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the public tokenizers' files.
TOKENIZER_DIR = os.environ.get("HELIOLAKE_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the pretoken pattern of the byte-level BPE.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PATTERN_LOOKAHEAD = 4
#: Characters that a chunk holds, and characters of a unit beyond which its pretokens leave before it ends.
CHUNK, RUN = 1 << 16, 1 << 12
#: Units or pretokens that a worker keeps, and the longest of them.
KEPT, KEPT_LENGTH = 500_000, 64

_WORDS = regex.compile(PATTERN)
_UNSAFE = re.compile(r"\s ")
_SAFE_SPACE = re.compile(r"(?<=\S) ")
#: What a run goes on with, by the kind of its characters.
_KINDS = {"letters": regex.compile(r"\p{L}*"), "digits": regex.compile(r"\p{N}*"), "space": regex.compile(r"\s*"), "symbols": regex.compile(r"[^\s\p{L}\p{N}]*")}

#: A token of one kind, with the space that may lead it.
_ONE_KIND = regex.compile(r"(?P<space>\s+)| ?(?:(?P<letters>\p{L}+)|(?P<digits>\p{N}+)|(?P<symbols>[^\s\p{L}\p{N}]+))")


def kind_of(char: str) -> str:
    """The kind of run that a character stands in."""
    return next(k for k, p in _KINDS.items() if p.fullmatch(char))


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Tokens and ids from a file of base64 tokens and ranks."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}


def token_lengths(ranks: dict[bytes, int]) -> dict[str, list[int]]:
    """Lengths in bytes of the tokens that can stand in each kind of run, the longest first.

    The first is the sufficient lookahead of the merge list in such a run. A token that is no
    whole text (a part of a character) may stand in any run.
    """
    lengths: dict[str, set[int]] = {k: {1} for k in _KINDS}
    for token in ranks:
        try:
            m = _ONE_KIND.fullmatch(token.decode("utf-8"))
            kinds = [m.lastgroup] if m else []
        except UnicodeDecodeError:
            kinds = list(_KINDS)
        for k in kinds:
            lengths[k].add(len(token))
    return {k: sorted(v, reverse=True) for k, v in lengths.items()}


class _Kept(dict):
    """Results by text; what is missing is worked out, and kept if it is short."""

    def __init__(self, work: Callable[[str], bytes]) -> None:
        super().__init__()
        self.work = work

    def __missing__(self, text: str) -> bytes:
        got = self.work(text)
        if len(text) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.clear()
            self[text] = got
        return got


class Codec:
    """One tokenizer: encoding, counting and decoding of whole texts or of streams. Ids travel as 32-bit integers in bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        lengths = token_lengths(ranks)
        #: Sufficient lookahead of the merge list in bytes, for each kind of run.
        self.lookahead = {k: v[0] for k, v in lengths.items()}
        #: Lengths to try at each place of a run, from its beginning on.
        self.lengths = {k: [[n for n in v if n <= end] for end in range(v[0] + 1)] for k, v in lengths.items()}
        self.words = _Kept(self._word)
        self.units = _Kept(self._unit)
        self.spaced = _Kept(lambda rest: self._unit(" " + rest))
        #: Pretokens that the piece transducer has encoded, for tests.
        self.transduced = 0
        self._pairs: dict[tuple[int, int], bool] = {}
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._bytes: list[bytes] | None = None

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        stream = Encoder(self)
        if len(text) <= CHUNK:
            return stream.feed(text) + stream.finish()
        return b"".join([*(stream.feed(text[at : at + CHUNK]) for at in range(0, len(text), CHUNK)), stream.finish()])

    def decode(self, ids: list[int]) -> str:
        d = Decoder(self)
        return d.feed(ids) + d.finish()

    def token(self, i: int) -> bytes:
        if self._bytes is None:
            table = [b""] * (max(self.ranks.values()) + 1)
            for b, r in self.ranks.items():
                table[r] = b
            self._bytes = table
        return self._bytes[i]

    def _unit(self, text: str) -> bytes:
        """Ids of text whose ends are pretoken boundaries."""
        get = self.words.__getitem__
        return b"".join(map(get, _WORDS.findall(text)))

    def _word(self, word: str) -> bytes:
        """Ids of one pretoken."""
        data = word.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        if whole is not None:
            return np.int32(whole).tobytes()
        self.transduced += 1
        p = Piece(self, kind_of(word[-1]))
        return p.feed(data) + p.finish()

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens that the merge list joins last to form a token; None for single bytes and what it never forms."""
        if token not in self._halves:
            parts, own = [token[i : i + 1] for i in range(len(token))], self.ranks[token]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank >= own:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def compatible(self, a: int, b: int) -> bool:
        """Is (a, b) the encoding of its own bytes?

        The tokens' last merges are undone, the latest first, and with them what they hide from the border between
        the two. They stay apart unless a merge across the border comes before one that has been undone.
        """
        got = self._pairs.get((a, b))
        if got is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            got = self._pairs[a, b] = self._apart(self.token(a), self.token(b))
        return got

    def _apart(self, x: bytes, y: bytes) -> bool:
        ranks, limit = self.ranks, 1 << 31
        while True:
            across = ranks.get(x + y)
            if across is not None and across < limit:
                return False
            if len(x) > 1 and (len(y) == 1 or ranks[x] > ranks[y]):
                if (split := self.halves(x)) is None:
                    return False
                # of equal merges the left one comes first
                limit, x = ranks[x], split[1]
            elif len(y) > 1:
                if (split := self.halves(y)) is None:
                    return False
                limit, y = ranks[y] + 1, split[0]
            else:
                return True


class Encoder:
    """Text in chunks to ids; holds back only what later text may change."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.held, self.begun = codec, "", False
        self.run: Piece | None = None
        self.kind = ""

    def feed(self, chunk: str) -> bytes:
        out = b""
        if self.run is not None:
            out, chunk = self._go_on(chunk)
            if self.run is not None:
                return out
        text = self.held + chunk
        parts = _SAFE_SPACE.split(text) if _UNSAFE.search(text) else text.split(" ")
        # the space before a unit stands between the parts; a text that begins with one has an empty first part
        if len(parts) > 1:
            if text[:1] == " " and not parts[0]:
                parts = parts[1:]
                first = self.codec.spaced
            else:
                first = self.codec.units
            self.held = parts.pop() if len(parts) == 1 else ""
            if parts:
                last = parts.pop()
                if parts:
                    out += first[parts[0]] + b"".join(map(self.codec.spaced.__getitem__, parts[1:]))
                    self.held = " " + last
                else:
                    self.held = (" " if first is self.codec.spaced else "") + last
            elif first is self.codec.spaced:
                self.held = " " + self.held
        else:
            self.held = text
        return out + self._shortened() if len(self.held) > RUN else out

    def _shortened(self) -> bytes:
        """Ids of the decided pretokens of a long unit; a run that is left goes on into the piece transducer."""
        limit, end, out = len(self.held) - PATTERN_LOOKAHEAD, 0, []
        for w in _WORDS.finditer(self.held):
            if w.end() > limit:
                break
            out.append(self.codec.words[w[0]])
            end = w.end()
        self.held = self.held[end:]
        if len(self.held) > RUN:
            self.kind = kind_of(self.held[len(self.held) // 2])
            self.run = Piece(self.codec, self.kind)
            # the pretoken begins as the pattern says, so what goes on is of one kind after a leading space
            lead = 1 if self.kind != "space" and self.held[0] == " " else 0
            out.append(self.run.feed(self.held[:lead].encode()))
            rest, self.held = self.held[lead:], ""
            got, rest = self._go_on(rest)
            out.append(got)
            if rest:
                out.append(self.feed(rest))
        return b"".join(out)

    def _go_on(self, chunk: str) -> tuple[bytes, str]:
        """Feed a run with what continues it; the rest of the chunk once it ends."""
        run = self.run
        assert run is not None
        chunk = self.held + chunk
        self.held = ""
        end = _KINDS[self.kind].match(chunk).end()
        if self.kind != "space":
            out = run.feed(chunk[:end].encode("utf-8", "replace"))
            if end == len(chunk):
                return out, ""
            self.run = None
            return out + run.finish(), chunk[end:]
        # the last white space before a word isn't part of the run
        out = run.feed(chunk[: max(end - 1, 0)].encode("utf-8", "replace"))
        self.held = chunk[max(end - 1, 0) : end]
        if end == len(chunk):
            return out, ""
        rest, self.held, self.run = self.held + chunk[end:], "", None
        return out + run.finish(), rest

    def finish(self) -> bytes:
        if self.run is not None:
            out = self.run.feed(self.held.encode("utf-8", "replace")) + self.run.finish()
        elif self.held[:1] == " ":
            out = self.codec.spaced[self.held[1:]]
        else:
            out = self.codec.units[self.held] if self.held else b""
        self.run, self.held = None, ""
        return out


class Piece:
    """Bytes of one pretoken in chunks to ids, with the merge list's lookahead."""

    def __init__(self, codec: Codec, kind: str) -> None:
        self.codec, self.lookahead, self.lengths = codec, codec.lookahead[kind], codec.lengths[kind]
        self.window = b""  # bytes after the last emitted token
        self.last: list[int] = [-1]  # last token of the encoding of each prefix of the window
        self.before = -1  # last emitted token

    def feed(self, data: bytes) -> bytes:
        out: list[int] = []
        step = 8 * self.lookahead
        for at in range(0, len(data), step):
            self._extend(data[at : at + step])
            if len(self.window) > step:
                out += self._stable()
        return np.array(out, np.int32).tobytes()

    def _extend(self, data: bytes) -> None:
        c = self.codec
        self.window += data
        w, get, last = self.window, c.ranks.get, self.last
        for end in range(len(last), len(w) + 1):
            found = -1
            for length in self.lengths[end] if end < self.lookahead else self.lengths[-1]:
                t = get(w[end - length : end])
                if t is not None:
                    start = end - length
                    prior = last[start] if start else self.before
                    # no token before, or one that stays apart from this
                    if (prior < 0 and not start) or (prior >= 0 and c.compatible(prior, t)):
                        found = t
                        break
            last.append(found)

    def _chain(self, end: int) -> list[int]:
        """The encoding of a prefix."""
        out = []
        while end:
            t = self.last[end]
            out.append(t)
            end -= len(self.codec.token(t))
        return out[::-1]

    def _stable(self) -> list[int]:
        """Tokens that the chains from all places within the lookahead have in common."""
        n = len(self.window)
        open_ = {end for end in range(n - self.lookahead, n + 1) if self.last[end] >= 0}
        # the farthest place gives way to the one before its token, until the chains have met
        at = n
        while len(open_) > 1:
            while at not in open_:
                at -= 1
            open_.remove(at)
            open_.add(at - len(self.codec.token(self.last[at])))
        keep = open_.pop()
        if not keep:
            return []
        out = self._chain(keep)
        self.before = out[-1]
        self.window = self.window[keep:]
        self.last = [-1, *self.last[keep + 1 :]]
        return out

    def finish(self) -> bytes:
        out = self._chain(len(self.window))
        self.window, self.last, self.before = b"", [-1], -1
        return np.array(out, np.int32).tobytes()


class Decoder:
    """Ids in chunks to text; bytes of an unfinished character wait for the next chunk."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.state = codec, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.codec.token, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


_CODECS: dict[int, Codec] = {}


def codec_of(data: bytes) -> Codec:
    """One codec per worker process and tokenizer file."""
    key = hash(data)
    if key not in _CODECS:
        _CODECS[key] = Codec(load_ranks(data))
    return _CODECS[key]


def tokenizer_bytes(name: str = "byte_bpe_50k", folder: str | None = None) -> bytes:
    with open(os.path.join(folder or TOKENIZER_DIR, f"{name}.tiktoken"), "rb") as f:
        return f.read()


def encode_column(df: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str | None = None, counts: bool = False) -> DataFrame:
    """``key, ids`` (or ``key, n_tokens``) of every row; the tokenizer's file, under 1 MB, is broadcast."""
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_bytes(name, folder))
    kind = dict(df.dtypes)[key]
    out = "n_tokens" if counts else "ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for b in batches:
            # rows leave in slices, so a batch of long texts doesn't hold all its ids at once
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                got = [codec.packed(t) for t in part.column(1).to_pylist()]
                sizes = np.array([len(g) for g in got]) // 4
                if counts:
                    values = pa.array(sizes.astype(np.int32))
                else:
                    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                    values = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), values], names=[key, out])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"{key} {kind}, {out} {'int' if counts else 'array<int>'}")


def decode_column(df: DataFrame, key: str, ids: str, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``key, text`` of every row's ids; null ids give the empty text."""
    shared = df.sparkSession.sparkContext.broadcast(tokenizer_bytes(name, folder))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [codec.decode(i) if i else "" for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(F.col(key), F.col(ids)).mapInArrow(run, f"{key} {kind}, text string")
