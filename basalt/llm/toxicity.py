"""Toxicity scores over texts whose disguised words a noisy channel restores first."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.common import cut, held_out, release

#: Letters that a symbol may stand for. Fixed values of the channel.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Marks that may be slipped between the letters of a word.
FILLERS = "._-*~'`^,:/\\"
#: Natural-log costs of the channel's steps.
SUBSTITUTE, COLLAPSE, DELETE, BREAK = 1.0, 0.7, 0.7, 0.5
#: Labelled documents that the classifier is fitted on, at most.
MAX_TRAIN = 10_000
#: Distinct words that a Python worker remembers, and letters of those that it does.
CACHE, REMEMBERED = 300_000, 64

_EDGES = "\"'.,;:!?()[]{}<>*%&#$@~`^|\\/-_=+«»“”‘’…"
_RUN = re.compile(r"(.)\1\1")
_DISGUISE = re.compile("[" + re.escape("".join(LEET) + FILLERS) + "]")


# -- the character language model ------------------------------------------------------------


@lru_cache(65_536)
def folded(char: str) -> str:
    """The letter that the character model knows: Latin letters without their marks, and one
    symbol for all letters of another block, so that trigrams are bounded by the alphabet."""
    base = unicodedata.normalize("NFD", char)[0]
    return base if ord(base) < 0x250 else chr(0xE000 + (ord(base) >> 8))


def word_ngrams(words: Counter) -> Counter:
    """Trigram counts, with ``^`` and ``$`` as the word's ends, of plain words."""
    found: Counter = Counter()
    for word, n in words.items():
        word = word.strip(_EDGES)
        if word.isalpha():
            padded = f"^^{''.join(map(folded, word))}$"
            for i in range(len(padded) - 2):
                found[padded[i : i + 3]] += n
    return found


def character_counts(docs: DataFrame) -> DataFrame:
    """Rows (gram, n): trigram counts over the plain words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        words: Counter = Counter()
        grams: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                words.update((text.as_py() or "").lower().split())
                if len(words) > CACHE:
                    grams.update(word_ngrams(words))
                    words.clear()
        grams.update(word_ngrams(words))
        yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class CharacterModel:
    """Interpolated trigram model over characters; ``cost`` is a negative log probability."""

    def __init__(self, grams: dict[str, int]) -> None:
        self.three = grams
        self.two: Counter = Counter()
        self.one: Counter = Counter()
        context: Counter = Counter()
        for gram, n in grams.items():
            self.two[gram[1:]] += n
            self.one[gram[2]] += n
            context[gram[:2]] += n
        self.context, self.total = context, max(1, sum(self.one.values()))
        self.before: Counter = Counter()
        for pair, n in self.two.items():
            self.before[pair[0]] += n
        self.known: dict[tuple[str, str], float] = {}

    def cost(self, history: str, char: str) -> float:
        value = self.known.get((history, char))
        if value is None:
            p1 = (self.one[char] + 0.1) / (self.total + 50)
            p2 = (self.two[history[1] + char] + 2 * p1) / (self.before[history[1]] + 2)
            p3 = (self.three.get(history + char, 0) + 2 * p2) / (self.context[history] + 2)
            if len(self.known) > CACHE:
                self.known.clear()
            self.known[history, char] = value = -float(np.log(p3))
        return value


# -- the channel -----------------------------------------------------------------------------


def lattice(token: str) -> list[list[tuple[str, float, int]]]:
    """For each place in ``token``, the steps (letters written, cost, places consumed)."""
    runs = [1] * len(token)
    for i in range(len(token) - 2, -1, -1):
        if token[i] == token[i + 1]:
            runs[i] += runs[i + 1]
    steps: list[list[tuple[str, float, int]]] = []
    for char, run in zip(token, runs):
        here: list[tuple[str, float, int]] = []
        if char.isalpha():
            here.append((char, 0.0, 1))
            if run >= 3:  # a drawn-out letter stands for one or two
                here += [(char, COLLAPSE, run), (char * 2, COLLAPSE, run)]
        for letter in LEET.get(char, ""):
            here.append((letter, SUBSTITUTE, 1))
            if run >= 2:
                here.append((letter, SUBSTITUTE + COLLAPSE, run))
        if char in FILLERS:
            here.append(("", DELETE, 1))
        steps.append(here or [("", 3 * DELETE, 1)])
    return steps


def decode(token: str, model: CharacterModel, breaks: bool = False) -> tuple[str, float]:
    """Viterbi: the cheapest text whose disguise ``token`` may be, and its cost per letter.

    With ``breaks`` a word may end after any letter, so that several words come out, parted by
    spaces. A state is the last two letters; each keeps only a link to the one before, and places
    that are done are let go, so tokens of any length are decoded whole."""
    open_states: dict[int, dict[str, tuple[float, tuple | None]]] = {0: {"^^": (0.0, None)}}
    for i, here in enumerate(lattice(token)):
        for history, (cost, link) in open_states.pop(i, {}).items():
            for letters, price, used in here:
                total, past = cost + price, history
                for letter in letters:
                    known = folded(letter)
                    total += model.cost(past, known)
                    past = past[1] + known
                reached = open_states.setdefault(i + used, {})
                old = reached.get(past)
                if old is None or total < old[0]:
                    reached[past] = total, (link, letters) if letters else link
                if breaks and letters:
                    ended = total + model.cost(past, "$") + BREAK
                    old = reached.get("^^")
                    if old is None or ended < old[0]:
                        reached["^^"] = ended, ((link, letters), " ")
    ends = [(cost + (0.0 if history == "^^" else model.cost(history, "$")), link) for history, (cost, link) in open_states.get(len(token), {}).items() if link]
    if not ends:
        return token, float("inf")
    cost, link = min(ends, key=lambda x: x[0])
    parts = []
    while link:
        link, letters = link
        parts.append(letters)
    text = "".join(reversed(parts)).strip()
    return text, cost / (len(text) + 1)


class Restorer:
    """Turns tokens into the words that are scored, remembering what it has seen."""

    def __init__(self, model: CharacterModel) -> None:
        self.model = model
        self.seen: dict[str, tuple[str, ...]] = {}

    def token(self, raw: str) -> tuple[str, ...]:
        """The words of one lower-cased token: the plain one, and the restored one if it differs."""
        found = self.seen.get(raw)
        if found is not None:
            return found
        bare = raw.strip(_EDGES)
        words = [bare] if bare else []
        core = raw.strip("\"'.,;:?()[]{}<>")
        if len(core) >= 3 and (_DISGUISE.search(core) or _RUN.search(core)):
            word, _ = decode(core, self.model)
            if word != bare:
                words.append(word)
        found = tuple(words)
        if len(raw) <= REMEMBERED:
            if len(self.seen) > CACHE:
                self.seen.clear()
            self.seen[raw] = found
        return found

    def spaced(self, letters: list[str]) -> tuple[str, ...]:
        """The words of a row of single characters of any length, parted where the model finds
        that cheapest; letters that stay alone say nothing new."""
        text, _ = decode("".join(letters), self.model, breaks=True)
        return tuple(x for x in text.split() if len(x) > 1)

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a whole text."""
        tokens = text.lower().split()
        found: set[str] = set()
        token = self.token
        for raw in set(tokens):
            found.update(token(raw))
        row: list[str] = []
        for raw in tokens:
            if len(raw) == 1:
                row.append(raw)
            elif row:
                if len(row) > 2:
                    found.update(self.spaced(row))
                row = []
        if len(row) > 2:
            found.update(self.spaced(row))
        return found


def word_features(words: set[str]) -> set[str]:
    """Whole words, and prefixes of four to six letters for inflected ones."""
    found = {f"w{x}" for x in words}
    for x in words:
        found.update(f"p{x[:n]}" for n in (4, 5, 6) if len(x) > n)
    return found


# -- the classifier --------------------------------------------------------------------------


def _features(docs: DataFrame, restorer) -> DataFrame:
    """Rows (row, toxic, feature) of labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(restorer.value)
        for batch in batches:
            rows, labels, found = [], [], []
            for row, text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                for x in sorted(word_features(restore.words(text or ""))):
                    rows.append(row)
                    labels.append(toxic)
                    found.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(labels, pa.int32()), pa.array(found, pa.string())], names=["row", "toxic", "feature"])

    return docs.select("row", "text", "toxic").mapInArrow(run, "row long, toxic int, feature string")


def fit(docs: DataFrame, labels: DataFrame, model) -> dict[str, float]:
    """Feature weights, ``""`` the bias, from at most ``MAX_TRAIN`` labelled documents that are
    not held out. Features are all of the sample's whose log odds stand out by 2.6 standard
    errors; the logistic regression has a ridge penalty and is solved by full gradient steps
    with adaptive rates."""
    marked = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most MAX_TRAIN rows
    sample = cut(texts.select(F.col("doc_id").cast("long").alias("row"), "text", "toxic").repartition(12))
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {"": float(np.log((bad + 1) / (good + 1)))}
    rows = cut(_features(sample, model))
    counts = rows.groupBy("feature").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    odds = F.log(((F.col("t") + 0.5) / (bad + 1)) / ((F.col("n") - F.col("t") + 0.5) / (good + 1)))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("n") - F.col("t") + 0.5))
    best = counts.withColumn("gain", F.abs(odds) / error).where("n >= 3 and gain >= 2.6").orderBy(F.desc("gain"), "feature")
    vocabulary = {r["feature"]: i for i, r in enumerate(best.select("feature").collect())}
    numbered = docs.sparkSession.createDataFrame(list(vocabulary.items()), "feature string, at int")
    if not vocabulary:
        return {"": float(np.log(bad / good))}
    held = rows.join(F.broadcast(numbered), "feature").select("row", "at").toArrow()  # of the bounded sample
    known = sample.groupBy("row").agg(F.max("toxic").alias("toxic")).toArrow().sort_by("row")
    r = np.searchsorted(known["row"].to_numpy(), held["row"].to_numpy()).astype(np.int32)
    c, y = held["at"].to_numpy().astype(np.int32), known["toxic"].to_numpy().astype(float)
    del held
    # Adam on the sparse design: few passes, deterministic.
    w, b = np.zeros(len(vocabulary)), float(np.log(bad / good))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, 401):
        z = b + np.bincount(r, weights=w[c], minlength=len(y))
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.append(np.bincount(c, weights=gap[r], minlength=len(w)) / len(y) + 1e-5 * w, gap.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return {"": b} | {x: float(w[i]) for x, i in vocabulary.items()}


def with_toxicity(docs: DataFrame, labels: DataFrame, column: str = "toxicity") -> DataFrame:
    """The rows of ``docs`` with their score in one double column more; no row is shuffled.

    ``column`` must not be a name that ``docs`` has: that is an error."""
    if column in docs.columns:
        raise ValueError(f"documents have a column {column} already")
    grams = {r["gram"]: r["n"] for r in character_counts(docs).collect()}  # bounded by the alphabet
    context = docs.sparkSession.sparkContext
    model = context.broadcast(CharacterModel(grams))
    weights = context.broadcast(fit(docs, labels, model))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        restore, weight = Restorer(model.value), weights.value
        bias = weight[""]
        values: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            scores = []
            for text in batch.column(place):
                used: set[str] = set()
                for word in restore.words(text.as_py() or ""):
                    known = values.get(word)
                    if known is None:
                        if len(values) > CACHE:
                            values.clear()
                        values[word] = known = tuple(x for x in word_features({word}) if x in weight)
                    if known:
                        used.update(known)
                z = bias + sum(weight[x] for x in sorted(used))
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Texts count whole and are restored before they are scored: a character trigram model over
    the words of all texts prices the readings of a token's lattice (symbols for letters, drawn
    out letters, marks between letters, letters set apart by spaces), and Viterbi picks one.
    A null or empty text is scored by the classifier's bias alone; a null doc_id counts as not
    held out and is scored too; repeated rows are scored each; labels whose ``toxic`` is neither
    0 nor 1 are ignored, and a document labelled twice is toxic if any label says so; without
    labels of both kinds all texts get one score; further columns of either table play no part.
    """
    scored = with_toxicity(docs.select("doc_id", "text"), labels, "score")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
