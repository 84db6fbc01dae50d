"""Problem 9: pages of repeated key phrases, link lists, tags, breadcrumbs or product names.

A text becomes a sequence of lines: it is cut at line breaks, sentence ends and list separators,
and long stretches without any are cut into windows, so unpunctuated notes have lines too. A
hidden Markov model labels each line as prose, link list, tag list (key phrases, tags, product
names) or menu (breadcrumbs, related searches). A line's emission is the likelihood of its
words under each label, with words reduced to classes where their spelling says nothing
(numbers, addresses, hash tags, model numbers); pairs of characters stand for words in Chinese.
A page is flagged if labels other than prose cover at least two thirds of its text.

The model is trained here, without lists of words of any language. In a sample of about ``SAMPLE``
documents of at most ``SAMPLE_CHARS`` characters, chosen by a hash of their id, lines that are
certain by their shape are the seeds: sentences that close with a stop and repeat nothing, in texts
that repeat little, are prose; addresses in texts full of them are links; word pairs that
come again and again within a line or a text are tags. Word likelihoods, the first label's
chances and the chances from label to label are estimated from the seeds, and in ``ROUNDS`` rounds
of Viterbi training the model labels every line of the sample and is estimated anew. The sample
bounds what the driver holds. Labelling covers every line of every document; copies get the
same label as they have the same text. A lone line that is no certain list falls to prose by the
first label's estimated chances; there is no least length. A model can be saved and used again.

Reading is by white-space tokens: what a token stands for and whether it ends a line is worked out
once per spelling and kept. Labels are found for many documents at once, line by line over all that
have one.

Defined results: null, empty and blank texts and texts without words aren't flagged; tables of
numbers count as prose; without documents, or without any certain line, nothing is flagged.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROSE, LINKS, TAGS, MENU = range(4)
STATES = 4
SAMPLE, SAMPLE_CHARS, ROUNDS = 4000, 16_384, 3
#: Words that the model may know.
VOCABULARY = 60_000
#: Part of the text that must be other than prose.
SHARE = 2 / 3
#: Words of a line are not independent: their likelihoods count with this weight.
TEMPER = 0.6
#: Occurrences that are added to each word's, spread over the labels by their sizes.
SMOOTH = 2.0
#: Weight of all lists' words in each kind of list, and the least log likelihood of a word against its likeliest label.
BACK_OFF, FLOOR = 0.3, 6.0
#: A pair of words comes again and again if it occurs three times, and once in so many lines of the text.
AGAIN = 0.08
#: Spellings that a worker keeps, and the longest of them; documents labelled at once, and their characters.
KEPT, KEPT_LENGTH = 500_000, 40
SLICE, SLICE_CHARS = 512, 4_000_000
#: Tokens of a line and characters of a token at most; longer ones are cut.
_WINDOW, _RUN = 24, 300

_ANCHOR = re.compile(r"<a\b[^>]*>", re.I)
_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]]+|(?<![\w@])[\w-]+(?:\.[\w-]+)*\.[a-z]{2,12}(?=/[^\s<>\"')\]]|[\s).,;|]|$)(?:/[^\s<>\"')\]]*)?", re.I)
_MAY_LINK = re.compile(r"\.[A-Za-z]{2}|://|www\.")
_DOT = re.compile(r"[\[({](?:dot|\.)[\])}]", re.I)
_SPACED_DOT = re.compile(r"\s*[\[({](?:dot|\.)[\])}]\s*", re.I)
_MARKUP = re.compile(r"</?\w[^<>]*>")
_STOP = re.compile(r"[.!?][\"”’)]*$")
_FULL_STOP = re.compile(r"(?<=[。！？；])")
_WORD = re.compile(r"\x01|#\w+|[A-ZÀ-Þ]{2,}\w*-\d+|[㐀-鿿]+|\d+(?:[.,:/-]\d+)*[A-Za-z]?|>|(?![㐀-鿿])[^\W\d_](?:(?![㐀-鿿])[\w@])*")
_SEPARATORS = frozenset("|·•/»›–—-\x02")

#: How a token ends: within its line, ending it, ending it with a stop.
_WITHIN, _ENDS, _STOPS = range(3)
#: A token: (its words, characters, how it ends, tokens that it is made of if it holds several line ends).
Token = tuple[tuple[int, ...], int, int, "tuple[Token, ...]"]
#: A line: (its words, characters, does it end with a stop).
Line = tuple[list[int], int, bool]


def classes_of(w: str) -> tuple[str, ...]:
    """What one spelt word stands for: itself in lower case, a class where the spelling says nothing, pairs of characters for Chinese."""
    c = w[0]
    if c.isalpha():
        if "㐀" <= c <= "鿿":
            return tuple(w[i : i + 2] for i in range(len(w) - 1)) or (w,)
        return ("<model>",) if "-" in w else (w.lower(),)
    if c == "\x01":
        return ("<url>",)
    if c == "#":
        return ("<number>",) if w[1:].isdigit() else ("<tag>",)
    if c == ">":
        return ("<crumb>",)
    return ("<number>",) if w[-1].isdigit() else ("<measure>",)


class Reader:
    """Texts to lines of word numbers; ``number`` gives a word's."""

    def __init__(self, number: Callable[[str], int]) -> None:
        self.number = number
        self._seen: dict[str, Token] = {}

    def token(self, t: str) -> Token:
        """What a token without white space stands for, kept for the next time unless it is long."""
        got: Token
        if t in _SEPARATORS:
            got = (), 0, _ENDS, ()
        elif t[0] == "\x01":
            got = (self.number("<url>"),), len(t) + 1, _WITHIN, ()
        else:
            end = _STOPS if _STOP.search(t) else _ENDS if t[-1] == ";" else _WITHIN
            plain = _URL.sub("\x01", t) if _MAY_LINK.search(t) else t
            plain = _MARKUP.sub(" ", plain) if "<" in plain else plain
            scale = len(t) / max(1, len(plain))
            parts: list[Token] = []
            for p in _FULL_STOP.split(plain):
                for k in range(0, len(p), _RUN):
                    part = p[k : k + _RUN]
                    words = tuple(self.number(c) for w in _WORD.findall(part) for c in classes_of(w))
                    parts.append((words, round(len(part) * scale), _STOPS if part[-1] in "。！？；" else _ENDS, ()))
            if not parts:
                got = (), len(t) + 1, end, ()
            else:
                words, n, last, _ = parts[-1]
                parts[-1] = words, n + 1, last if last == _STOPS else end, ()
                got = parts[0] if len(parts) == 1 else ((), 0, _WITHIN, tuple(parts))
        if len(t) <= KEPT_LENGTH:
            if len(self._seen) >= KEPT:
                self._seen.clear()
            self._seen[t] = got
        return got

    def lines(self, text: str) -> list[Line]:
        """The lines that have words; none of more than ``_WINDOW`` tokens."""
        if "\x01" in text or "\x02" in text:
            text = text.replace("\x01", " ").replace("\x02", " ")
        if ("[" in text or "(" in text or "{" in text) and _DOT.search(text):
            text = _SPACED_DOT.sub(".", text)
        if "<" in text:
            text = _ANCHOR.sub(lambda m: " " + "\x01" * len(m[0]) + " ", text).replace("</a>", " \x02 ")
        out: list[Line] = []
        get, token, add = self._seen.get, self.token, out.append
        words: list[int] = []
        for row in text.split("\n"):
            n = k = 0
            for t in row.split():
                held, size, end, parts = get(t) or token(t)
                if parts:
                    for held, size, end, _ in parts[:-1]:
                        words += held
                        if words:
                            add((words, n + size, end == _STOPS))
                        words, n, k = [], 0, 0
                    held, size, end, _ = parts[-1]
                words += held
                n += size
                k += 1
                if end or k == _WINDOW:
                    if words:
                        add((words, n - 1, end == _STOPS))
                        words = []
                    n = k = 0
            if words:
                add((words, n - 1, False))
                words = []
        return out


def viterbi(rows: np.ndarray, counts: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Most likely labels of the lines of many documents, which stand one after the other in ``rows``."""
    order = np.argsort(-counts, kind="stable")
    many = counts[order]
    first = (np.cumsum(counts) - counts)[order]
    longest = int(many[0]) if len(many) else 0
    active = np.searchsorted(-many, -np.arange(longest), side="left")  # documents with more than so many lines
    back, path = np.zeros(rows.shape, np.int8), np.zeros(len(rows), np.int8)
    score = start + rows[first[: active[0]]] if longest else np.zeros((0, STATES))
    for t in range(1, longest):
        a = active[t]
        ways = score[:a, :, None] + move
        at = first[:a] + t
        back[at] = ways.argmax(1)
        score[:a] = ways.max(1) + rows[at]
    now = score.argmax(1)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at = first[:a] + t
        path[at] = now[:a]
        now[:a] = back[at, now[:a]]
    return path


class Model:
    """Word likelihoods by label, relative to their mean, and the chain's estimated chances."""

    def __init__(self, words: list[str], weights: np.ndarray, start: np.ndarray, move: np.ndarray) -> None:
        self.words, self.weights, self.start, self.move = words, weights, start, move
        known, none = {w: i for i, w in enumerate(words)}, len(words)
        self.reader = Reader(lambda c: known.get(c, none))

    def label(self, docs: list[list[Line]]) -> np.ndarray:
        """Labels of the lines of all documents, one after the other."""
        flat: list[int] = []
        starts: list[int] = []
        for d in docs:
            for words, _, _ in d:
                starts.append(len(flat))
                flat += words
        if not starts:
            return np.zeros(0, np.int8)
        rows = TEMPER * np.add.reduceat(self.weights[np.array(flat)], starts, axis=0)
        return viterbi(rows, np.array([len(d) for d in docs if d]), self.start, self.move)

    def to_json(self) -> str:
        return json.dumps({"words": self.words, "weights": self.weights.tolist(), "start": self.start.tolist(), "move": self.move.tolist()})

    @classmethod
    def from_json(cls, text: str) -> Model:
        d = json.loads(text)
        return cls(d["words"], *(np.array(d[k], float) for k in ("weights", "start", "move")))


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    """Write a model as a table of one row, on any storage that Spark writes to."""
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> Model:
    return Model.from_json(spark.read.parquet(path).first()[0])


def pair_share(words: list[int], times: Counter, least: float) -> float:
    """Share of a line's pairs of neighbours that occur at least so many times."""
    return sum(times[p] >= least for p in zip(words, words[1:])) / max(1, len(words) - 1)


def certain_labels(lines: list[Line], names: list[str]) -> list[int | None]:
    """Labels of the lines of one text that are certain by their shape, None for the others.

    Plain words are those that are no class (number, address, tag, ...). What is looked at: the part of lines with
    an address; the part of pairs of words that the text has again and again (``AGAIN``); how often the text has the line;
    whether the line closes with a stop.
    """
    total = len(lines)
    whole = Counter(tuple(w) for w, _, _ in lines)
    pairs = Counter(p for w, _, _ in lines for p in zip(w, w[1:]))
    n_pairs = sum(pairs.values())
    least = max(3, AGAIN * total)
    repeats = sum(v for v in pairs.values() if v >= least) / n_pairs if n_pairs >= 12 else 0.0
    linked = sum(any(names[i] == "<url>" for i in w) for w, _, _ in lines)
    often = sum(v for v in whole.values() if v >= 3) / total
    out: list[int | None] = []
    for words, _, stop in lines:
        n = len(words)
        kinds = Counter(names[i] for i in words if names[i][0] == "<")
        numbers, plain = kinds["<number>"] + kinds["<measure>"], n - kinds.total()
        chinese = sum("㐀" <= names[i][0] <= "鿿" for i in words)
        own = Counter(zip(words, words[1:]))
        again = sum(v for v in own.values() if v > 1) / max(1, n - 1)
        sentence = stop and again < 0.15 and plain >= (7 if chinese > n / 2 else 5)
        label = None
        if kinds["<url>"]:
            if linked >= max(4, 0.3 * total):
                label = LINKS if plain <= 5 * kinds["<url>"] else None
            elif sentence or plain >= 5:
                label = PROSE
        elif kinds["<crumb>"] >= 2 and plain <= 6 * kinds["<crumb>"]:
            label = MENU
        elif kinds["<tag>"] >= max(1, 0.6 * n) or (kinds["<model>"] and kinds["<measure>"] and plain <= 6 * kinds["<model>"]):
            label = TAGS
        elif numbers >= 0.6 * n:
            label = PROSE
        elif again >= 0.5 and n >= 6:
            label = TAGS
        elif not sentence and whole[tuple(words)] >= 3 and often >= 0.4 and 2 <= plain <= 8:
            label = TAGS
        elif not sentence and 2 <= plain <= 6 and repeats >= 0.5 and pair_share(words, pairs, least) >= 0.5:
            label = TAGS
        elif sentence and repeats < 0.4 and whole[tuple(words)] == 1 and pair_share(words, pairs, least) < 0.4:
            label = PROSE
        out.append(label)
    return out


def _estimate(words: list[str], flat: np.ndarray, line_of: np.ndarray, labels: np.ndarray, doc_of: np.ndarray) -> Model:
    """Model of labelled lines (-1: no label); a word counts if it occurs three times."""
    of = labels[line_of]
    table = np.stack([np.bincount(flat[of == k], minlength=len(words)) for k in range(STATES)], axis=1).astype(float)
    total = table.sum(1)
    rank = np.array(sorted(np.flatnonzero(total >= 3), key=lambda i: (-total[i], words[i]))[:VOCABULARY], np.int64)
    table, kept = table[rank], [words[i] for i in rank]
    # a script's share differs from label to label by accident of the sample: words compete within theirs. What is
    # added to the counts follows the sizes of prose and lists, so that a rare word doesn't lean to the smaller one;
    # each kind of list falls back on all of them, as key phrases stand in tags, links and menus alike.
    script = np.array([0 if w[0] == "<" else 1 if "㐀" <= w[0] <= "鿿" else 2 for w in kept])
    logs = np.zeros_like(table)
    for k in range(3):
        mine, rivals = table[script == k], table[script == k] if k else table
        size = rivals.sum(0) + 1
        two = np.column_stack((mine[:, PROSE], mine[:, PROSE + 1 :].sum(1)))
        sizes = np.array([size[PROSE], size[PROSE + 1 :].sum()])
        two = (two + SMOOTH * sizes / sizes.sum()) / sizes
        lists = (1 - BACK_OFF) * mine[:, PROSE + 1 :] / size[PROSE + 1 :] + BACK_OFF * two[:, 1:]
        logs[script == k] = np.log(np.column_stack((two[:, 0], lists)))
    logs = np.maximum(logs - logs.max(1, keepdims=True), -FLOOR)
    # the chain's chances; each is seen once beforehand
    first = np.r_[True, doc_of[1:] != doc_of[:-1]]
    start = np.bincount(labels[first & (labels >= 0)], minlength=STATES) + 1.0
    follows = ~first[1:] & (labels[1:] >= 0) & (labels[:-1] >= 0)
    move = np.bincount(labels[:-1][follows] * STATES + labels[1:][follows], minlength=STATES * STATES).reshape(STATES, STATES) + 1.0
    return Model(kept, np.vstack((logs, np.zeros((1, STATES)))), np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)))


def train(texts: list[str]) -> Model | None:
    """Model from the certain lines of a sample, refined by Viterbi training; None without any."""
    numbers: dict[str, int] = {}
    reader = Reader(lambda c: numbers.setdefault(c, len(numbers)))
    docs = [d for d in map(reader.lines, texts) if d]
    words = list(numbers)
    seeds = np.array([-1 if k is None else k for d in docs for k in certain_labels(d, words)], np.int64)
    if not (seeds >= 0).any():
        return None
    lines = [w for d in docs for w, _, _ in d]
    flat = np.array([i for w in lines for i in w])
    line_of = np.repeat(np.arange(len(lines)), [len(w) for w in lines])
    doc_of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    model = _estimate(words, flat, line_of, seeds, doc_of)
    for _ in range(ROUNDS):
        rows = {w: i for i, w in enumerate(model.words)}
        of = np.array([rows.get(w, len(rows)) for w in words])
        score = TEMPER * np.add.reduceat(model.weights[of[flat]], np.r_[0, np.cumsum([len(w) for w in lines])[:-1]], axis=0)
        found = viterbi(score, np.array([len(d) for d in docs]), model.start, model.move).astype(np.int64)
        labels = np.where(seeds >= 0, seeds, found)
        model = _estimate(words, flat, line_of, labels, doc_of)
    return model


def shares_of(model: Model, texts: list[str | None]) -> list[tuple[float, int]]:
    """(part of the text's characters that isn't prose, number of words that aren't) of each text."""
    docs = [model.reader.lines(t) if t else [] for t in texts]
    other = model.label(docs) != PROSE
    out, at = [], 0
    for d in docs:
        size = rest = words = 0
        for k, (w, n, _) in enumerate(d):
            size += n
            if other[at + k]:
                rest += n
                words += len(w)
        at += len(d)
        out.append((rest / size if size else 0.0, words))
    return out


def fit(df: DataFrame, key: str, text: str, sample: int = SAMPLE) -> Model | None:
    """Train on about ``sample`` texts of at most ``SAMPLE_CHARS`` characters, chosen by a hash of their ids.

    The driver gets these rows only, however many partitions there are, and never more than twice as many.
    """
    n = df.count()
    share = min(1.0, sample / max(n, 1))
    chosen = F.shiftrightunsigned(F.xxhash64(key, F.lit(9)), 11) < int(share * (1 << 53))
    some = df.select(key, text).filter(F.col(text).isNotNull() & (F.length(text) <= SAMPLE_CHARS) & chosen).limit(2 * sample)
    return train([r[1] for r in some.orderBy(key).collect()])


def page_shares(df: DataFrame, key: str, text: str, sample: int = SAMPLE, model: Model | None = None) -> DataFrame:
    """``key, non_prose, other_words, is_spam`` of every document, by the given model or one trained on a sample."""
    model = model or fit(df, key, text, sample)
    kind = dict(df.dtypes)[key]
    schema = f"{key} {kind}, non_prose double, other_words int, is_spam boolean"
    shared = df.sparkSession.sparkContext.broadcast(model and model.to_json())  # at most VOCABULARY words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.from_json(shared.value) if shared.value else None
        for b in batches:
            at = 0
            while at < b.num_rows:
                texts: list[str | None] = []
                held = 0
                while at + len(texts) < b.num_rows and len(texts) < SLICE and held < SLICE_CHARS:
                    texts.append(b.column(1)[at + len(texts)].as_py())
                    held += len(texts[-1] or "")
                got = shares_of(m, texts) if m else [(0.0, 0)] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array([s for s, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int32()), pa.array([s >= SHARE - 1e-9 for s, _ in got])],
                    names=[key, "non_prose", "other_words", "is_spam"],
                )
                at += len(texts)

    return df.select(key, text).mapInArrow(run, schema)
