"""Toxicity scoring after noisy-channel deobfuscation.

Channel. A writer may replace letters by look-alikes (leetspeak), spread a word's letters by separators, or repeat letters.
Every token that shows such a sign becomes a lattice: each run of one character offers the letters it may stand for, once
or twice, or nothing, at the channel's cost. Viterbi search with three letters of history finds the reading that costs
least under the channel and a character language model; what it restores replaces the token. Tokens without a sign have
one reading and stay. Signs are look-alikes before or between letters, trailing $ and @, repeated and doubled letters, and
three letters or more that one to three separators each hold apart. Where the sign is weak (a doubled letter, or a spaced
word of three letters or of longer separators), the token as written competes.

Language model: character 2-, 3- and 4-grams counted over the whole texts of all documents (4-grams hashed to 20 bits, so
the tables are bounded), each order smoothed by the next shorter one.

Score: logistic regression on words and word beginnings of the restored text, each by presence and by rate. It is trained
on a bounded sample, ``MOST_ROWS`` labelled ids by hash order, each with the first ``LONGEST`` characters of its text (of the
smallest one, where an id repeats).

Defined results: a null or empty text scores as one without words; without labels, or with one label only, every score is
the smoothed share of label 1; a document with several labels counts as toxic if one says so; null labels are left out;
rows that repeat are scored alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import table
from tickforge.llm.langid import fold
from tickforge.llm.letters import codes

MOST_ROWS, LONGEST = 6000, 20_000
#: Words and word beginnings in the model, what lengths of beginnings there are, and the ridge of the regression.
FEATURES, BEGINNINGS, RIDGE = 300, (3, 4, 5, 6, 7), 1e-4
FOURS = 1 << 20
#: Weight of the next shorter history, in observations.
BACKOFF = 4.0
MEMO = 200_000

#: The letters that a look-alike may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
#: Channel costs in nats: a look-alike, a letter written twice, three or more times, a look-alike that is none, a separator.
LOOKALIKE, DOUBLED, REPEATED, NO_LETTER, SEPARATOR = 0.7, 3.0, 0.5, 4.0, 0.1
#: A reading of a word whose only sign is a doubled letter must cost less than this share of the word as written: a letter
#: less saves about the cost of one in any word that the model doesn't know.
SHARE = 0.5

_LETTER = r"[^\W\d_]"
_WORDS = re.compile(rf"{_LETTER}+")
_MARK = rf"(?:[^\W_]|[{re.escape(''.join(c for c in LEET if not c.isdigit()))}])"
_SPACED = re.compile(rf"(?<![^\W_])(?:{_MARK}[ .\-_*~]){{3,}}{_MARK}(?![^\W_])")
_GAP = re.compile(r"[ .\-_*~]{1,3}")
_WIDE = re.compile(rf"(?<![^\W_])(?:{_MARK}{_GAP.pattern}){{2,}}{_MARK}(?![^\W_])")
_TOKEN = re.compile(rf"{_MARK}+")
_SIGN = re.compile(rf"[{re.escape(''.join(LEET))}](?={_LETTER})|(?<={_LETTER})\d|({_LETTER})\1\1|(?<={_LETTER})[$@]+(?![^\W_])")
_DOUBLE = re.compile(rf"({_LETTER})\1")
_BREAK = "\0"


@cache
def _classes() -> np.ndarray:
    """Of each code point below U+3000: 1 letter, 2 look-alike, 4 digit, 8 separator of a spaced word; the last for all others."""
    t = np.zeros(0x3001, np.uint8)
    for cp in range(0x3000):
        c = chr(cp)
        t[cp] = c.isalpha() + 2 * (c in LEET) + 4 * c.isdigit() + 8 * (c in " .-_*~")
    t[-1] = 1
    return t


def _may_show(text: str) -> tuple[bool, bool]:
    """Whether a token of the text may show a sign, and whether a word may be spaced: a cheap test before the patterns."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = _classes()[np.minimum(points, 0x3000)]
    letter, mark, alnum = (c & 1) != 0, (c & 7) != 0, (c & 5) != 0
    sign = ((c[:-1] & 2) != 0) & letter[1:] | letter[:-1] & ((c[1:] & 6) != 0)
    alone = mark.copy()
    alone[1:] &= ~alnum[:-1]
    alone[:-1] &= ~alnum[1:]
    near = np.diff(np.flatnonzero(alone)) <= 4
    return bool(sign.any() or (letter[1:] & (points[1:] == points[:-1])).any()), bool((near[1:] & near[:-1]).any())


@lru_cache(maxsize=1 << 16)
def _code(char: str) -> int:
    c = codes(char)
    return int(c[1]) if len(c) > 1 else 0


class CharModel:
    """Costs (negative log probabilities) of a letter code after three others."""

    def __init__(self, two: np.ndarray, three: np.ndarray, four: np.ndarray):
        self.two, self.three, self.four = two, three, four
        self.one = two.reshape(64, 64).sum(axis=0) + 0.5
        self._forget()

    def _forget(self) -> None:
        """What was worked out with the model, kept with it: a worker's tasks share the broadcast model, and so this."""
        self.memo: dict[tuple[int, int], float] = {}
        self.readings: dict[tuple[str, int], tuple[str, float]] = {}
        self.tokens: dict[str, str] = {}

    def __getstate__(self):
        return {n: getattr(self, n) for n in ("one", "two", "three", "four")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def cost(self, history: int, code: int) -> float:
        """history: the last three codes as one 18-bit number."""
        known = self.memo.get((history, code))
        if known is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            p = self.one[code] / self.one.sum()
            last = history & 63
            p = (self.two[last * 64 + code] + BACKOFF * p) / (self.one[last] - 0.5 + BACKOFF)
            pair = history & 4095
            p = (self.three[pair * 64 + code] + BACKOFF * p) / (self.two[pair] + BACKOFF)
            n = min(self.four[_hash4(history * 64 + code)], self.three[history])
            p = (n + BACKOFF * p) / (self.three[history] + BACKOFF)
            self.memo[history, code] = known = -math.log(p)
        return known


def _hash4(code):
    return ((code * 0x9E3779B1) & 0xFFFFFFFF) >> 12


def ngram_counts(texts) -> list[np.ndarray]:
    """Counts of the 2-, 3- and hashed 4-grams of letter codes."""
    total = [np.zeros(64**2, np.int64), np.zeros(64**3, np.int64), np.zeros(FOURS, np.int64)]
    held: list[list[np.ndarray]] = [[], [], []]
    waiting = 0

    def add():
        for t, parts in zip(total, held):
            if parts:
                t += np.bincount(np.concatenate(parts), minlength=len(t))
                parts.clear()

    for text in texts:
        c = codes(text).astype(np.int64)
        two = c[:-1] * 64 + c[1:]
        three = two[:-1] * 64 + c[2:]
        for parts, x in zip(held, (two, three, _hash4(three[:-1] * 64 + c[3:]))):
            parts.append(x)
        waiting += len(c)
        if waiting > 2_000_000:
            add()
            waiting = 0
    add()
    return total


def char_model(docs: DataFrame) -> CharModel:
    """Counted over all texts of ``docs``: each task adds up its own tables, and Spark sums them by n-gram."""
    def run(batches):
        total = [np.zeros(64**2, np.int64), np.zeros(64**3, np.int64), np.zeros(FOURS, np.int64)]
        for batch in batches:
            for t, more in zip(total, ngram_counts(x for x in batch.column("text").to_pylist() if x)):
                t += more
        for order, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), order), pa.int32()), pa.array(at), pa.array(t[at])],
                                             ["size", "gram", "n"])

    counts = docs.select("text").mapInArrow(run, "size int, gram long, n long").groupBy("size", "gram").agg(F.sum("n").alias("n"))
    got = counts.toArrow()  # at most 64^2 + 64^3 + 2^20 rows
    size, gram, n = (got.column(c).to_numpy() for c in ("size", "gram", "n"))
    tables = []
    for order, length in enumerate((64**2, 64**3, FOURS)):
        t = np.zeros(length)
        t[gram[size == order]] = n[size == order]
        tables.append(t)
    return CharModel(*tables)


class Restorer:
    def __init__(self, model: CharModel):
        self.model, self.memo, self.tokens = model, model.readings, model.tokens

    def _runs(self, token: str):
        return [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", token, re.S)]

    def _readings(self, char: str, count: int, spaced: int):
        """(emitted, cost) of a run of one character."""
        if char.isalpha():
            if count == 1:
                return [(char, 0.0)]
            if count == 2:
                return [(char * 2, 0.0), (char, DOUBLED)]
            return [(char, REPEATED), (char * 2, REPEATED)]
        if char in LEET:
            once, twice = {1: (0.0, None), 2: (DOUBLED, 0.0)}.get(count, (REPEATED, REPEATED))
            readings = [(a, LOOKALIKE + once) for a in LEET[char]] + [(_BREAK, NO_LETTER)]
            return readings + [(a * 2, LOOKALIKE + twice) for a in LEET[char] if twice is not None]
        return [[(_BREAK, 0.0)], [("", SEPARATOR)], [("", SEPARATOR), (_BREAK, 0.0)]][spaced]

    def decode(self, token: str, spaced: int = 0) -> str:
        """The cheapest reading of a lower-case token. spaced: separators go (1), or go or break words (2)."""
        return self._cheapest(token, spaced)[0]

    def _cheapest(self, token: str, spaced: int) -> tuple[str, float]:
        """The cheapest reading and its cost."""
        known = self.memo.get((token, spaced))
        if known is not None:
            return known
        paths = {0: (0.0, None)}  # by the last three codes: cost, and the chain of what was emitted
        for char, count in self._runs(token):
            after = {}
            for emitted, price in self._readings(char, count, spaced):
                code = [_code(c) for c in emitted]
                for history, (cost, chain) in paths.items():
                    cost += price
                    for c in code:
                        cost += self.model.cost(history, c)
                        history = (history << 6 | c) & 0x3FFFF
                    if history not in after or cost < after[history][0]:
                        after[history] = (cost, (chain, emitted))
            paths = after
        price, _, chain = min((cost + self.model.cost(h, 0), i, chain) for i, (h, (cost, chain)) in enumerate(paths.items()))
        parts = []
        while chain:
            chain, emitted = chain
            parts.append(emitted)
        out = "".join(reversed(parts)).replace(_BREAK, " ")
        if len(self.memo) > MEMO:
            self.memo.clear()
        self.memo[token, spaced] = out, price
        return out, price

    def _written(self, word: str) -> float:
        """The cost of a word of letters as it is written."""
        history, cost = 0, 0.0
        for c in word:
            c = _code(c)
            cost += self.model.cost(history, c)
            history = (history << 6 | c) & 0x3FFFF
        return cost + self.model.cost(history, 0)

    def _undoubled(self, word: str) -> str:
        """The word with those doubled letters single for which that costs less than ``SHARE`` of the word as written."""
        ends = [m.end() for m in _DOUBLE.finditer(word)]
        most = SHARE * self._written(word)
        if len(ends) > 4:
            reading, price = self._cheapest(word, 0)
            return reading if price < most else word
        best = (most, word)
        for some in range(1, 1 << len(ends)):
            gone = [e for i, e in enumerate(ends) if some >> i & 1]
            if DOUBLED * len(gone) < best[0]:
                reading = "".join(word[a:b - 1] for a, b in zip([0, *gone], gone)) + word[gone[-1]:]
                best = min(best, (DOUBLED * len(gone) + self._written(reading), reading))
        return best[1]

    def _token(self, token: str) -> str:
        known = self.tokens.get(token)
        if known is None:
            known = token
            if _SIGN.search(token):
                known = self.decode(token)
            elif _DOUBLE.search(token) and token.isalpha():
                known = self._undoubled(token)
            if len(self.tokens) > MEMO:
                self.tokens.clear()
            self.tokens[token] = known
        return known

    def _apart(self, word: str) -> str:
        if _SPACED.fullmatch(word):
            return self.decode(word, 1)
        if not _WORDS.search(word) or sum(c.isalnum() for c in word) < 2:
            return word
        marks = _GAP.sub(" ", word)
        reading = self.decode(marks, 2)
        return word if reading.split() == marks.split() else reading

    def restore(self, text: str) -> str:
        """The lower-case text with every token that shows a sign of obfuscation replaced by its cheapest reading."""
        text = text.lower()
        sign, spaced = _may_show(text)
        if spaced:
            text = _WIDE.sub(lambda m: self._apart(m[0]), text)
        if sign:
            # Every distinct token once; most texts have none that changes, and stay as they are.
            changed = {t: r for t in set(_TOKEN.findall(text)) if (r := self._token(t)) != t}
            if changed:
                text = _TOKEN.sub(lambda m: changed.get(m[0], m[0]), text)
        return text


def word_features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in BEGINNINGS if len(word) > n)]


class Scorer:
    """names: the features; weights: by presence, by rate; bias."""

    def __init__(self, names: list[str], presence: np.ndarray, rate: np.ndarray, bias: float):
        self.names, self.presence, self.rate, self.bias = names, presence.tolist(), rate.tolist(), bias
        self.place = {n: i for i, n in enumerate(names)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def counts(self, restored: str) -> tuple[dict[int, int], int]:
        words = _WORDS.findall(restored)
        found: dict[int, int] = {}
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for word, n in Counter(words).items():
            at = memo.get(word)
            if at is None:
                at = memo[word] = tuple(self.place[f] for f in word_features(word) if f in self.place)
            for i in at:
                found[i] = found.get(i, 0) + n
        return found, max(len(words), 1)

    def score(self, restored: str) -> float:
        found, words = self.counts(restored)
        z = self.bias + sum(self.presence[i] + self.rate[i] * _rate(n, words) for i, n in sorted(found.items()))
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def _rate(n: int, words: int) -> float:
    """Per hundred words, three at most count."""
    return min(100.0 * n / words, 3.0)


def _surprise(a, b, positive, negative):
    """Log-likelihood ratio of a feature that a of the positive and b of the negative texts have; 0 if it speaks against."""
    if a / positive <= b / negative:
        return 0.0
    total = positive + negative
    cells = ((a, (a + b) * positive / total), (b, (a + b) * negative / total),
             (positive - a, (total - a - b) * positive / total), (negative - b, (total - a - b) * negative / total))
    return sum(seen * math.log(seen / expected) for seen, expected in cells if seen > 0)


def fit(restored: list[str], toxic: list[int], features: int = FEATURES, ridge: float = RIDGE) -> Scorer:
    """Logistic regression, by accelerated gradient descent, on the features that tell most of label 1."""
    y = np.array(toxic, float)
    positive, negative = int(y.sum()), int((1 - y).sum())
    if not positive or not negative:
        p = (positive + 1) / (positive + negative + 2)
        return Scorer([], np.zeros(0), np.zeros(0), math.log(p / (1 - p)))
    seen = {0: Counter(), 1: Counter()}
    for text, label in zip(restored, toxic):
        seen[int(label)].update({f for w in set(_WORDS.findall(text)) for f in word_features(w)})
    ranked = sorted(((-_surprise(n, seen[0][f], positive, negative), f) for f, n in seen[1].items() if n >= 3))[:features]
    names = [f for s, f in ranked if s < 0]
    model = Scorer(names, np.zeros(len(names)), np.zeros(len(names)), 0.0)
    x = np.zeros((len(restored), 2 * len(names) + 1))
    x[:, -1] = 1
    for row, text in zip(x, restored):
        found, words = model.counts(text)
        for i, n in found.items():
            row[i], row[len(names) + i] = 1, _rate(n, words)
    step = 1 / (0.25 * np.linalg.norm(x, 2)**2 / len(x) + ridge)
    w = ahead = np.zeros(x.shape[1])
    momentum = 1.0
    hold = np.full(x.shape[1], ridge)
    hold[-1] = 0
    for _ in range(400):
        slope = x.T @ (1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30))) - y) / len(x) + hold * ahead
        new, next_momentum = ahead - step * slope, (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / next_momentum * (new - w)
        w, momentum = new, next_momentum
    return Scorer(names, w[:len(names)], w[len(names):-1], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, may_learn, chars: CharModel) -> Scorer:
    """Fit on a bounded sample of the labelled rows for which ``may_learn`` holds."""
    known = (labels.filter(may_learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_ROWS))
    # The smallest text of an id that repeats.
    sample = (docs.select("doc_id", F.substring("text", 1, LONGEST).alias("text")).join(F.broadcast(known), "doc_id")
              .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).filter(F.col("text").isNotNull()).collect())
    rows = sorted((r.doc_id, r.text, r.toxic) for r in sample)
    restorer = Restorer(chars)
    return fit([restorer.restore(r[1]) for r in rows], [r[2] for r in rows])


def _mapped(docs: DataFrame, chars: CharModel, columns: str, kind, row) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(chars)
    name = columns.split()[0]

    def run(batches):
        restorer = Restorer(shared.value)
        for batch in batches:
            values = [row(restorer.restore(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, kind)], ["doc_id", name])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {columns}")


def restored_texts(docs: DataFrame, chars: CharModel) -> DataFrame:
    """doc_id, restored: the lower-case text after deobfuscation."""
    return _mapped(docs, chars, "restored string", pa.string(), lambda text: text)


def scored_texts(docs: DataFrame, chars: CharModel, scorer: Scorer) -> DataFrame:
    """doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    return _mapped(docs, chars, "score double", pa.float64(), lambda text: shared.value.score(text))


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted: trained on the labels of all rows but those of fold ``held``."""
    chars = char_model(docs)
    scorer = train(docs, labels, fold(F.col("doc_id"), parts) != held, chars)
    out = scored_texts(docs, chars, scorer)
    return out.select("doc_id", (fold(F.col("doc_id"), parts) == held).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: doc_id, held_out, score, predicted."""
    return score_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "labels", "doc_id", "toxic"))
