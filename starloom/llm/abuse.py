"""Scores for abusive, hateful and sexually explicit text: FTRL-proximal logistic regression.

Text is read as word tokens with disguises undone (other alphabets, digits and signs for
letters, stretched and spelled-out words, markup inside words).  Features are hashed word n-grams
and skip-grams.  The model is trained on windows of WINDOW tokens and a document's score is that of
its worst window, wherever it stands, so one sentence in a long text counts as much as in a short
one.

There are no labels in the data and none are made from it by hand.  The model starts from sentences
built by rule from general vocabulary (phrases.py), abusive and harmless.  Windows of a bounded sample
of documents are then added: as harmless those for which a model that never saw their half of the
sample finds no sign of abuse, as abusive those of which both models are sure.  What lies between stays
unlabelled.  The model's score alone decides.  Per-coordinate learning rates let rare phrases learn
fast, and the L1 term keeps the broadcast model small however large the corpus.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import phrases
from starloom.sources.tables import Scratch

WINDOW = 14  #: tokens of a training window
WINDOWS = (5, 9, WINDOW)  #: lengths of the windows that are scored
BIAS = -3.0  #: log-odds of a window without known features; fixed, as the sample's classes aren't those of the corpus
BITS = 20
SAMPLE_DOCS = 4_000  #: expected number of documents whose windows may be used for training
SAMPLE_TASKS = 16
TRAIN_WINDOWS = 40_000  #: most windows sent to the driver
THRESHOLD = 0.5  #: score from which a document is flagged
POSITIVE = 2.0
MARGIN = 3.0
OTHERS = 0.15  #: share of the sample's windows that are used as background
ROUNDS = 2  #: times each sampled document's worst window is looked at
HARD = 0.15  #: score from which a window is worth learning
SURE, UNSURE, UNLIKELY = 0.9, 0.7, 0.3  #: scores that label a window: see label_of
BATCH = 64  #: windows of a learning step
PASSES = 6
CACHE = 200_000  #: chunks a worker remembers
SEED = 10
OVERLAP = WINDOW + 3
BLOCK = 200_000  #: tokens scored at a time; longer texts are cut into blocks that overlap by a window

# Letters of other alphabets that look like Latin ones, and what digits stand for in a word.
LOOKALIKES = str.maketrans("авеосрхуіјѕԁӏкмнтпигԛԝαβεικνορτυχωϲ", "abeocpxyijsdlkmhtnurqwabeiknoptuxwc")
DIGITS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "v": "u", "!": "i", "|": "il", "€": "e", "$": "s"}
SIGNS = "#*@$%.+?&^~"

_IN_WORD = re.compile(r"<!--\s*-->|<(\w+)[^<>]{0,20}></\1>|<(?:nowiki|wbr)\s*/?>|&(?:shy|zwnj|zwj|#8203|#173);")
_EDGE = "[](){}<>|=:;,\"'`’‘“”«»¿¡…–—/\\_-"
_SPELLED = re.compile(r"[^\W_](?:[.\-_*+][^\W_]){2,}")
_PART = re.compile(r"[^\W_]+(?:[#*@$%+?&^~][^\W_]*)*|[#*@$%][^\W_]+", re.UNICODE)
_DOTTED = re.compile(r"[^\W\d_]+\.[^\W\d_]+")
_RUN = re.compile(r"(.)\1+")


def _flat(word: str) -> str:
    return _RUN.sub(r"\1", word)


def _folded(word: str) -> str:
    """In lower case, without accents and invisible signs, look-alike letters as Latin ones."""
    if not word.isascii():
        word = unicodedata.normalize("NFKD", word.translate(LOOKALIKES))
        word = "".join(c for c in word if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").translate(LOOKALIKES)
    return word


#: Words that insult, degrade or are sexually explicit; disguised spellings are led back to them.
_KNOWN = frozenset(map(_folded, phrases.vocabulary()))
_BY_FLAT: dict[str, str] = {}
for _w in sorted(_KNOWN, key=lambda w: (len(w), w), reverse=True):
    if len(_w) > 2:
        _BY_FLAT[_flat(_w)] = _w


def _by_start(words) -> dict[tuple[int, str], list[str]]:
    """Words by length and first letter, and by length alone."""
    out: dict[tuple[int, str], list[str]] = {}
    for w in sorted(words):
        out.setdefault((len(w), w[0]), []).append(w)
        out.setdefault((len(w), ""), []).append(w)
    return out


_STARTS, _FLAT_STARTS = _by_start(_KNOWN), _by_start(_BY_FLAT)


def _alike(part: str, starts: dict[tuple[int, str], list[str]]) -> str | None:
    first = part[0]
    for word in starts.get((len(part), first if first.isalpha() and first != "v" else ""), ()):
        if _fits(part, word):
            return word
    return None


def _fits(part: str, word: str) -> bool:
    letters = 0
    for a, b in zip(part, word, strict=True):
        if a == b:
            letters += 1
        elif not (a in SIGNS or b in DIGITS.get(a, "")):
            return False
    return 2 * letters >= len(word) or (letters >= 1 and all(a == b or b in DIGITS.get(a, "") for a, b in zip(part, word, strict=True)))


def _known(part: str) -> str | None:
    """The listed word that part stands for."""
    if part in _KNOWN:
        return part
    flat = _flat(part)
    if part.isalpha():
        for spelling in (part.replace("v", "u"), flat, flat.replace("v", "u")):
            if spelling in _KNOWN and len(spelling) > 2:
                return spelling
        return (_BY_FLAT.get(flat) or _BY_FLAT.get(flat.replace("v", "u"))) if flat != part and len(flat) > 3 else None
    if len(part) > 2 and (word := _alike(part, _STARTS)):
        return word
    if flat != part and len(flat) > 2 and (key := _alike(flat, _FLAT_STARTS)):
        return _BY_FLAT[key]
    return None


def words_of(chunk: str) -> list[str]:
    """The word tokens of a chunk without blanks, in lower case and with disguises undone."""
    if chunk.isdigit():
        return ["0"]
    core = _folded(chunk).strip(_EDGE).rstrip(".!?,")
    if not core:
        return []
    if core.isalpha():
        return [_known(core) or core]
    if _SPELLED.fullmatch(core):
        joined = "".join(c for c in core if c.isalnum())
        return [_known(joined) or joined]
    out = []
    for piece in re.split(r"[^\w#*@$%+?&^~.!]+", core):
        if _DOTTED.fullmatch(piece) and (word := _known(piece)):
            out.append(word)
            continue
        for part in _PART.findall(piece.replace("!", " ") if not _known(piece) else piece):
            if part.isdigit():
                out.append("0")
                continue
            word = _known(part)
            if word is None:
                word = re.sub(r"[#*@$%+?&^~]+$|^[#*@$%]+", "", part)
            if word:
                out.append(word)
    return out


LETTER = 1 << 16
EMPTY = np.empty(0, np.int64)


def token_hash(word: str) -> int:
    """32 bits of a word; single letters stay themselves, below LETTER, so that spelled-out words are seen."""
    return ord(word) if len(word) == 1 and word.isalpha() and ord(word) < LETTER else zlib.crc32(word.encode()) | LETTER


class Reader:
    """Turns texts into arrays of token hashes; remembers chunks."""

    def __init__(self) -> None:
        self.seen: dict[str, tuple[int, ...]] = {}
        self.said: dict[str, list[str]] = {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        if "''" in text:
            text = text.replace("'''", "").replace("''", "")
        if "<" in text or "&" in text:
            text = _IN_WORD.sub("", text)
        return text.casefold().split()

    def hashes(self, chunk: str) -> tuple[int, ...]:
        h = tuple(token_hash(w) for w in words_of(chunk))
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[chunk] = h
        return h

    def _tokens(self, chunks: list[str]) -> np.ndarray:
        found = list(map(self.seen.get, chunks))
        if None in found:
            found = [self.hashes(c) if h is None else h for c, h in zip(chunks, found, strict=True)]
        return np.fromiter(chain.from_iterable(found), np.int64)

    def read(self, text: str) -> np.ndarray:
        """Token hashes of a text."""
        chunks = self.chunks(text)
        tokens = self._tokens(chunks)
        letter = tokens < LETTER
        return self._tokens(_joined(chunks)) if (letter[:-2] & letter[1:-1] & letter[2:]).any() else tokens

    def words(self, text: str) -> list[str]:
        if len(self.said) >= CACHE:
            self.said.clear()
        said, out = self.said, []
        for c in _joined(self.chunks(text)):
            w = said.get(c)
            if w is None:
                w = said[c] = words_of(c)
            out += w
        return out


def _joined(chunks: list[str]) -> list[str]:
    """Three or more single letters in a row are one word spelled out."""
    single = [len(c) == 1 and c.isalpha() for c in chunks]
    if sum(single) < 3:
        return chunks
    out, i = [], 0
    while i < len(chunks):
        j = i
        while j < len(chunks) and single[j]:
            j += 1
        # the last letter may carry a sign: w h o r e!!!
        k = j + 1 if j > i and j < len(chunks) and chunks[j][:1].isalpha() and not chunks[j][1:2].isalnum() and len(chunks[j].rstrip(".!?,]|}'\":;1)")) == 1 else j
        if k - i >= 3:
            out.append("".join(c[0] for c in chunks[i:k]))
            i = k
        elif j > i:
            out += chunks[i:j]
            i = j
        else:
            out.append(chunks[i])
            i += 1
    return out


# Features

_MIX = np.uint64(0x9E3779B97F4A7C15)
_KINDS = 5


def features(tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hashed features, a row per token: word, bigram, trigram, skip-1 and skip-2 bigram that end at it.

    place: the token's index in its text.  Features that would reach before the text are -1.
    """
    t = tokens.astype(np.uint64)

    def back(k: int) -> np.ndarray:
        return np.concatenate((np.zeros(min(k, len(t)), np.uint64), t[: max(0, len(t) - k)]))

    def mix(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
        x = (a * np.uint64(31) + np.uint64(kind)) * _MIX
        x = (x ^ (x >> np.uint64(29))) + b
        x = x * _MIX
        return x ^ (x >> np.uint64(32))

    p, pp, ppp = back(1), back(2), back(3)
    two = mix(p, t, 2)
    kinds = (mix(t, t, 1), two, mix(pp, two, 3), mix(pp, t, 4), mix(ppp, t, 5))
    out = np.stack([(x & np.uint64((1 << BITS) - 1)).astype(np.int32) for x in kinds], 1)
    for column, reach in ((1, 1), (2, 2), (3, 2), (4, 3)):
        out[place < reach, column] = -1
    return out


class Ftrl:
    """FTRL-proximal for logistic loss over hashed features that are present or not."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 1.0, l2: float = 0.1) -> None:
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.l1 = l1
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, i: np.ndarray | slice) -> np.ndarray:
        z, l1 = self.z[i], self.l1
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, windows: list[np.ndarray], labels: np.ndarray, importance: np.ndarray) -> None:
        """One step over a batch; the gradients of a coordinate are added up first."""
        flat, sizes = np.concatenate(windows), np.array([len(x) for x in windows])
        at, where = np.unique(flat, return_inverse=True)
        w = self.weights(at)
        total = np.bincount(np.repeat(np.arange(len(windows)), sizes), w[where], len(windows))
        g = (1 / (1 + np.exp(-np.clip(total + BIAS, -30, 30))) - labels) * importance
        g = np.bincount(where, np.repeat(g, sizes), len(at))
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights(slice(None))
        at = np.flatnonzero(w)
        return at.astype(np.int32), w[at].astype(np.float32)


# Labels

# Pronouns and people a window may be aimed at.
TARGETS = frozenset(
    """you your yours yourself yourselves u ur he him she her they them their these those people women woman men girl girls boy boys immigrants migrants foreigners refugees jews muslims
    christians blacks whites gays lesbians gypsies dich dir dein deine deinen ihr euch euer eure sie ihnen diese frauen leute tu te toi ton ta tes vous votre vos ils elles eux ces femmes gens
    ti tus usted ustedes vosotros ellos ellas estos esos mujeres gente""".split()
)


def written_windows() -> list[tuple[str, int]]:
    """The rule-built sentences, as the reader reads them."""
    reader = Reader()
    return [(" ".join(reader.words(t)), y) for t, y in phrases.sentences()]


def _hash01(text: str) -> float:
    return zlib.crc32(text.encode("utf-8", "ignore")) / 2**32


def background_of(reader: Reader, text: str, doc_id: int, share: float = OTHERS) -> Iterator[str]:
    """Windows of a text without listed words, the given share of them, chosen by hash."""
    words = reader.words(text)
    for start in range(0, len(words), WINDOW):
        w = words[start : start + WINDOW]
        if _hash01(f"{doc_id}|{start}") < share and _KNOWN.isdisjoint(w):
            yield " ".join(w)


def label_of(words: list[str], inside: float, outside: float) -> int | None:
    """1, 0 or None (unlabelled) for a window, from two scores.

    outside is the score of a model that has not seen the window's half of the sample.  Abusive: both
    models are SURE, and it holds a listed word or somebody it could be aimed at.  Harmless: the model
    outside finds it UNLIKELY, or it holds neither and that model is UNSURE.
    """
    charged = not (_KNOWN.isdisjoint(words) and TARGETS.isdisjoint(words))
    if charged and min(inside, outside) >= SURE:
        return 1
    return 0 if outside < (UNLIKELY if charged else UNSURE) else None


def sample_of(documents: DataFrame, total: int, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """A hash sample of about sample_docs documents with a text, whole."""
    share = min(1.0, sample_docs / max(1, total))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED)), 11).cast("double") * F.lit(2.0**-53)
    return documents.filter((u < share) & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")


def _bounded(windows: DataFrame, most: int) -> list[tuple[str, int, int]]:
    """(window, label, half): at most ``most`` distinct windows, chosen by hash."""
    d = windows.groupBy("window", "half").agg(F.max("label").alias("label")).orderBy(F.xxhash64("window"), "window", "half").limit(most).toPandas()
    return list(zip(d["window"], d["label"].astype(int), d["half"].astype(int), strict=True))


def background(sample: DataFrame, most: int = TRAIN_WINDOWS) -> list[tuple[str, int, int]]:
    """At most ``most`` background windows of the sample."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for b in batches:
            rows = [(w, h) for d, t, h in zip(b["doc_id"], b["text"], b["half"], strict=True) for w in background_of(reader, t, int(d))]
            yield pd.DataFrame(rows, columns=["window", "half"]).assign(label=0)

    return _bounded(sample.mapInPandas(cut, "window string, half int, label int"), most)


def worst_windows(spark: SparkSession, sample: DataFrame, model: tuple, halves: list[tuple], most: int = TRAIN_WINDOWS) -> list[tuple[str, int, int]]:
    """The worst window of each sampled document that label_of can label, with its label."""
    shared = spark.sparkContext.broadcast((model, halves))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, weights = Reader(), dense(shared.value[0])
        outside = [scorer(m) for m in shared.value[1][::-1]]
        for b in batches:
            rows = []
            for text, half in zip(b["text"], b["half"], strict=True):
                words = reader.words(text)
                score, start, end = worst_window(weights, words)
                if score >= HARD:
                    w = words[start:end]
                    label = label_of(w, score, outside[half]([" ".join(w)])[0])
                    if label is not None:
                        rows.append((" ".join(w), half, label))
            yield pd.DataFrame(rows, columns=["window", "half", "label"])

    return _bounded(sample.mapInPandas(cut, "window string, half int, label int"), most)


class Trainer:
    """Keeps its windows, so that more can be added and learnt from where the model stands."""

    def __init__(self) -> None:
        self.ftrl, self.order = Ftrl(), np.random.default_rng(SEED)
        self.x: list[np.ndarray] = []
        self.y: list[int] = []
        self.add(written_windows())

    def add(self, windows: list[tuple[str, int]]) -> None:
        for text, label in windows:
            t = np.array([token_hash(w) for w in text.split()], np.int64)
            f = features(t, np.arange(len(t))).ravel()  # a feature counts as often as it occurs, as in scoring
            if len(f):
                self.x.append(f[f >= 0])
                self.y.append(label)

    def learn(self, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
        """Learn from the windows the model gets wrong, or right by less than MARGIN; abusive ones count POSITIVE times.

        Returns the non-zero weights: positions and values.
        """
        y = np.array(self.y)
        flat, starts = np.concatenate(self.x), np.cumsum([0] + [len(x) for x in self.x[:-1]])
        for _ in range(passes):
            margin = (2 * y - 1) * (np.add.reduceat(self.ftrl.weights(flat), starts) + BIAS)
            wrong = self.order.permutation(np.flatnonzero(margin < MARGIN))
            for at in range(0, len(wrong), BATCH):
                i = wrong[at : at + BATCH]
                self.ftrl.learn([self.x[k] for k in i], y[i], np.where(y[i] == 1, POSITIVE, 1.0))
        return self.ftrl.model()


# Scoring


def dense(model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """All weights; the last one stands for features that are not there."""
    weights = np.zeros((1 << BITS) + 1, np.float32)
    weights[model[0]] = model[1]
    return weights


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x + BIAS, -30, 30)))


def _window_sums(weights: np.ndarray, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each token and each of WINDOWS the sum of the weights in the window that ends there."""
    total = np.concatenate(([0.0], np.cumsum(weights[features(tokens, place)].sum(1).astype(np.float64))))
    ends = np.arange(1, len(tokens) + 1)
    return np.stack([total[ends] - total[ends - np.minimum(place + 1, n)] for n in WINDOWS])


def worst_window(weights: np.ndarray, words: list[str]) -> tuple[float, int, int]:
    """Score, first and last-but-one token of the worst window of a text of any length; (0, 0, 0) without words."""
    best = (-np.inf, 0, 0)
    for at in range(0, len(words), BLOCK):
        first = max(0, at - OVERLAP)
        tokens = np.array([token_hash(w) for w in words[first : at + BLOCK]], np.int64)
        each = _window_sums(weights, tokens, np.arange(len(tokens)))
        if first:
            each[:, :OVERLAP] = -np.inf  # the block before has scored them
        k, end = np.unravel_index(int(each.argmax()), each.shape)
        if each[k, end] > best[0]:
            best = (float(each[k, end]), first + max(0, int(end) + 1 - WINDOWS[k]), first + int(end) + 1)
    return (float(_logistic(best[0])), *best[1:]) if words else (0.0, 0, 0)


def scorer(model: tuple[np.ndarray, np.ndarray]):
    """A function from texts to scores in 0 .. 1."""
    weights, reader = dense(model), Reader()

    def block(pieces: list[tuple[int, bool, np.ndarray]], best: np.ndarray) -> None:
        sizes = np.array([len(p[2]) for p in pieces], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(sizes.sum()) - np.repeat(starts, sizes)
        window = _window_sums(weights, np.concatenate([p[2] for p in pieces]), place).max(0)
        # a continued piece begins with tokens whose windows the piece before has scored
        window[np.repeat([p[1] for p in pieces], sizes) & (place < OVERLAP)] = -np.inf
        np.maximum.at(best, [p[0] for p in pieces], np.maximum.reduceat(window, starts))

    def score(texts: list[str | None]) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        pieces, size = [], 0
        for i, t in enumerate(texts):
            read = reader.read(t) if t else EMPTY
            for at in range(0, len(read), BLOCK):
                piece = read[max(0, at - OVERLAP) : at + BLOCK]
                pieces.append((i, at > 0, piece))
                size += len(piece)
                if size >= BLOCK:
                    block(pieces, best)
                    pieces, size = [], 0
        if pieces:
            block(pieces, best)
        return np.where(np.isinf(best), 0.0, _logistic(best))

    return score


def fit(spark: SparkSession, documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Train on the rule-built sentences and on windows of a bounded sample of documents.

    The sample has two halves.  A model of each half judges what is taken from the other.
    """
    scratch = Scratch(spark)
    half = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(2)).cast("int")
    sample = scratch.put(sample_of(documents, documents.count()).withColumn("half", half).repartition(SAMPLE_TASKS, "doc_id"))  # a bounded number of rows
    plain = background(sample)
    trainer, apart = Trainer(), [Trainer(), Trainer()]
    for h in (0, 1):
        apart[h].add([(w, y) for w, y, at in plain if at == h])
    halves = [t.learn() for t in apart]
    for h in (0, 1):
        own = [w for w, _, at in plain if at == h]
        outside = scorer(halves[1 - h])(own)
        trainer.add([(w, 0) for w, s in zip(own, outside, strict=True) if s < UNSURE or (TARGETS.isdisjoint(w.split()) and s < SURE)])
    model = trainer.learn()
    for _ in range(ROUNDS):
        found = worst_windows(spark, sample, model, halves)
        trainer.add([(w, y) for w, y, _ in found] * 2)
        for h in (0, 1):
            apart[h].add([(w, y) for w, y, at in found if at == h] * 2)
        model, halves = trainer.learn(), [t.learn() for t in apart]
    scratch.close()
    return model


def scores(spark: SparkSession, documents: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, source, score: every document, its whole text.  Null and empty texts score 0."""
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer(shared.value)
        for texts in batches:
            yield pd.Series(score(texts.tolist()), dtype="float64")

    scored.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return documents.select("doc_id", "source", F.pandas_udf(scored, T.DoubleType())("text").alias("score"))


def rates(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per source its documents, those at or above the threshold, their share and the mean score."""
    hit = (F.col("score") >= threshold).cast("bigint")
    return scored.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(hit).alias("flagged"), F.round(F.avg(hit), 6).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score"))
