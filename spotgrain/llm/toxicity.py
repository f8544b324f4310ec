"""Toxicity with a string-subsequence kernel machine.

The kernel compares words by their common subsequences of three characters,
each weighted by decay to the power of the stretch that it spans, over
stretches of up to ``SPAN`` characters; so it tolerates gaps and inserted
characters.  It is divided by a value that depends on the words' lengths only
(from ``LONGEST`` letters on it stays as it is there: a longer word's best
stretch weighs no less), which keeps it a kernel.  A word goes from a letter to
a letter; signs around it do not count.  Single characters in a row
("i d i o t") are read as one word.

Landmarks are words of the training documents: those that tell labels apart
best, each unlike those taken before, and some at random.  Nystroem's K^(-1/2)
maps a word to features, in which a linear support vector machine (dual
coordinate descent) is trained.  Labels are of documents: of a toxic one the
word with the highest value is the example (chosen anew each round), beside all
words that set the labels apart beyond chance; of a clean one every word is,
and the highest join the training set each round.  A document's values are its
``TOP`` highest different words'; a logistic regression with Platt's targets,
fitted on a fifth of the sample that the machine has not seen, makes them a
probability.

As the machine is linear in the subsequences, a word's value is a sum of one
number for each, and whole texts are scored by table look-up.

Training takes a bounded sample of the labelled rows (``Settings``).  Only
labels of rows whose crc32(doc_id) mod 5 is not 0 are read; source, lang and
doc_id are no inputs.

Cases: a null or empty text has no words and gets the score of the lowest
values; repeated rows are scored each; each row is scored where it lies, so
shared ids do no harm; a null doc_id is scored and not held out; labels that
are null or of unknown documents are left out, of two labels of one id the
higher counts; with no labelled rows, or one class only, every score is that
class's share (0 without rows); a very long text is scored in a time and memory
in proportion to its length; other columns are not read, so their names cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, materialize, table

DECAY, SPAN, CLASSES = 0.7, 6, 40
#: The class of the place before a word's first character, and after its last.
EDGE = CLASSES - 1
LONGEST, TOP = 64, 3
SINGLES = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
AROUND = re.compile("^[^a-z\u00c0-\U0010ffff]+|[^a-z\u00c0-\U0010ffff]+$")
STEPS = tuple((j, k) for k in range(2, SPAN) for j in range(1, k))


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and of the machine.  Scoring has none."""

    #: Labelled documents, a third of them of the rarer label.
    max_train: int = 3000
    #: Their different words together; a document with over a twentieth of that is not taken.
    max_words: int = 2_000_000
    #: Landmarks that tell labels apart, the words they are chosen from, and their letters.
    landmarks: int = 300
    candidates: int = 1200
    letters: tuple[int, int] = (3, 32)
    #: Landmarks drawn at random from words of clean documents, and their letters.
    random_landmarks: int = 300
    random_letters: tuple[int, int] = (4, 16)
    #: Words of clean documents in the first round, and how many of the highest join in each.
    negatives: int = 6000
    hardest: int = 2000
    rounds: int = 4
    #: Of a word on the wrong side, for the machine; of a toxic one five times that.
    cost: float = 12.0
    seed: int = 7


def classes_of(code: np.ndarray) -> np.ndarray:
    """a-z are 1 to 26, other letters above ASCII 27 up, all else 0 (a gap)."""
    out = np.zeros(len(code), np.int64)
    low = (code >= 97) & (code <= 122)
    out[low] = code[low] - 96
    high = code >= 0xC0
    out[high] = 27 + code[high] % (EDGE - 27)
    return out


def plain(text: str) -> str:
    """In lower case, two spaces between words (an end and a beginning); three
    and more single characters in a row are one word."""
    return SINGLES.sub(lambda m: "".join(m[0].split()), " ".join(text.lower().split())).replace(" ", "  ")


def words_of(text: str) -> list[str]:
    return [w for w in (AROUND.sub("", w) for w in plain(text).split()) if w]


def joined(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(classes, word number) of the words' characters, words SPAN gaps apart."""
    gap = " " * (SPAN + 1)
    code = np.frombuffer((" " + gap.join([*words, ""])).encode("utf-32-le", "surrogatepass"), np.uint32)
    own = np.repeat(np.arange(len(words)), [len(w) + SPAN + 1 for w in words])
    c = classes_of(code)
    starts = np.cumsum([0, *[len(w) + SPAN + 1 for w in words]])[:-1].astype(np.int64)
    c[starts] = EDGE
    c[starts + [len(w) + 1 for w in words]] = EDGE
    return c, np.concatenate([own, own[-1:]])


def triples(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(triple, word number, weight): all weighted subsequences, one gap pattern at a time."""
    c, own = joined(words)
    for j, k in STEPS:
        a, b, d = c[:-k], c[j : len(c) - k + j], c[k:]
        ok = np.flatnonzero((a > 0) & (b > 0) & (d > 0))
        yield (a[ok] * CLASSES + b[ok]) * CLASSES + d[ok], own[ok], DECAY ** (k + 1)


def self_value(lengths: np.ndarray) -> np.ndarray:
    """The kernel of a word of that length whose subsequences all differ."""
    n = np.minimum(lengths, LONGEST).astype(float) + 2
    return np.maximum(sum(np.maximum(n - k, 0) * DECAY ** (2 * k + 2) for _, k in STEPS), DECAY**6)


class Landmarks:
    """Words to compare with, as a table from triples to their weights in each."""

    def __init__(self, words: list[str]):
        self.words = words
        weights: dict[tuple[int, int], float] = {}
        for t, own, w in triples(words):
            for key in zip(t.tolist(), own.tolist()):
                weights[key] = weights.get(key, 0) + w
        known = sorted({t for t, _ in weights})
        place = {t: i for i, t in enumerate(known)}
        scale = 1 / np.sqrt(self_value(np.array([len(w) for w in words])))
        self.row = np.full(CLASSES**3, -1, np.int32)
        self.row[known] = np.arange(len(known))
        self.value = np.zeros((len(known), len(words)), np.float32)
        for (t, i), w in weights.items():
            self.value[place[t], i] = w * scale[i]

    def kernel(self, words: list[str]) -> np.ndarray:
        """words x landmarks."""
        rows, owns, weights = [], [], []
        for t, own, w in triples(words):
            r = self.row[t]
            hit = r >= 0
            rows.append(r[hit])
            owns.append(own[hit])
            weights.append(np.full(int(hit.sum()), w, np.float32))
        r, own, w = np.concatenate(rows), np.concatenate(owns), np.concatenate(weights)
        order = np.argsort(own, kind="stable")
        r, own, w = r[order], own[order], w[order]
        out = np.zeros((len(words), len(self.words)), np.float32)
        part = max(1000, 2_000_000 // max(1, len(self.words)))  # a few MB at a time
        at = 0
        while at < len(r):
            to = min(at + part, len(r))
            if to < len(r):
                to = max(int(np.searchsorted(own, own[to])), at + 1)
                if to <= at + 1 and own[at] == own[min(at + part, len(r) - 1)]:
                    to = int(np.searchsorted(own, own[at], "right"))
            first = np.flatnonzero(np.concatenate([[True], np.diff(own[at:to]) > 0]))
            out[own[at:to][first]] = np.add.reduceat(self.value[r[at:to]] * w[at:to, None], first, axis=0)
            at = to
        return out / np.sqrt(self_value(np.array([len(x) for x in words]))).astype(np.float32)[:, None]


def choose_landmarks(docs: list[list[str]], labels: np.ndarray, s: Settings) -> tuple[list[str], dict[str, float], list[str]]:
    """(landmarks, scores, telling words).  Scores are signed chi-squared of
    label and presence; landmarks the best, each with a kernel under 0.8 to
    those before, then random words."""
    count = (Counter(), Counter())
    for words, y in zip(docs, labels):
        count[int(y)].update(words)
    size = [max(1, int((labels == y).sum())) for y in (0, 1)]
    share = size[1] / sum(size)

    def score(w: str) -> float:
        p, q = count[1][w] / size[1], count[0][w] / size[0]
        both = (count[1][w] + count[0][w]) / sum(size)
        return (p - q) * abs(p - q) * share * (1 - share) / max(both * (1 - both), 1e-9)

    scores = {w: score(w) for w in count[1]}
    words = sorted((w for w in scores if s.letters[0] <= len(w) <= s.letters[1] and count[1][w] >= 2), key=lambda w: (-scores[w], w))[: s.candidates]
    chosen: list[int] = []
    alike = Landmarks(words).kernel(words) if words else np.zeros((0, 0), np.float32)
    for i in range(len(words)):
        if len(chosen) < s.landmarks and (not chosen or alike[i, chosen].max() < 0.8):
            chosen.append(i)
    # Those that chance would not set apart so clearly, of as many words as there are.
    sure = [w for w in scores if sum(size) * scores[w] > 2 * np.log(len(scores)) + 4 and count[1][w] >= 3]
    rest = sorted(w for w in count[0] if s.random_letters[0] <= len(w) <= s.random_letters[1] and count[1][w] == 0)
    pick = np.random.default_rng(s.seed).permutation(len(rest))[: s.random_landmarks]
    return [words[i] for i in chosen] + [rest[i] for i in sorted(pick)], scores, sure


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 12.0, rounds: int = 40, seed: int = 7) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; the
    fewer examples of class 1 weigh five times as much."""
    n = len(y)
    upper = np.where(y > 0, 5 * cost, cost)
    square = np.einsum("ij,ij->i", x, x) + 1e-12
    alpha, w, rng = np.zeros(n), np.zeros(x.shape[1]), np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(n):
            g = y[i] * (x[i] @ w) - 1
            a = min(max(alpha[i] - g / square[i], 0), upper[i])
            if a != alpha[i]:
                w += (a - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(a - alpha[i]))
                alpha[i] = a
        if moved < 1e-4:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of 1 / (1 + exp(-(w x + b))), the last of them b, by Newton's
    method, with Platt's targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - t) + 1e-6 * w)
        step *= min(1, 2 / max(1e-9, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


# A model is a dictionary of plain arrays: workers need no copy of the package.
#   constant: the score of every text, or None
#   table: a number for each subsequence of three; shift: the machine's bias
#   floor: values under it count as that; weights: of the logistic regression


def train_model(words: list[list[str]], labels: np.ndarray, s: Settings = Settings()) -> dict:
    """``words``: the different words of each document."""
    if len(set(labels.tolist())) < 2:
        return {"constant": float(labels.mean()) if len(labels) else 0.0}
    fit = np.arange(len(words)) % 5 != 4
    if len(set(labels[fit].tolist())) < 2 or len(set(labels[~fit].tolist())) < 2:
        fit = np.ones(len(words), bool)
    marks, scores, sure = choose_landmarks([w for w, f in zip(words, fit) if f], labels[fit], s)
    toxic = [w for w, f, y in zip(words, fit, labels) if f and y and w]
    clean = sorted({w for ws, f, y in zip(words, fit, labels) if f and not y for w in ws})
    if not marks or not toxic or not clean:
        return {"constant": float(labels.mean())}
    landmarks = Landmarks(marks)
    k = landmarks.kernel(marks).astype(float)
    value, vector = np.linalg.eigh((k + k.T) / 2)
    keep = value > 1e-3 * value.max()
    nystroem = ((vector[:, keep] / np.sqrt(value[keep])) @ vector[:, keep].T).astype(np.float32)
    rng = np.random.default_rng(s.seed)
    negative = {clean[i] for i in rng.permutation(len(clean))[: s.negatives]}
    pick = {w: scores.get(w, -9.0) for ws in toxic for w in ws}
    model = {"constant": None, "table": np.zeros(CLASSES**3, np.float32), "shift": 0.0, "floor": -np.inf}
    for _ in range(s.rounds):
        positive = sorted({max(ws, key=lambda w: (pick[w], w)) for ws in toxic} | set(sure))
        some = positive + sorted(negative - set(positive))
        z = np.ones((len(some), len(marks) + 1), np.float32)
        for i in range(0, len(some), 2000):
            z[i : i + 2000, :-1] = landmarks.kernel(some[i : i + 2000]) @ nystroem
        y = np.where(np.arange(len(some)) < len(positive), 1.0, -1.0)
        w = linear_svm(z, y, s.cost)
        model["table"][:] = 0
        known = landmarks.row >= 0
        model["table"][known] = (landmarks.value @ (nystroem @ w[:-1]))[landmarks.row[known]]
        model["shift"] = float(w[-1])
        high = word_values(model, clean)
        negative |= {clean[i] for i in np.argsort(-high, kind="stable")[: s.hardest]}
        names = list(pick)
        pick = dict(zip(names, word_values(model, names).tolist()))
    model["floor"] = float(np.quantile(high, 0.95))
    held = [w for w, f in zip(words, fit) if not f] or words
    y = labels[~fit] if not fit.all() else labels
    model["weights"] = logistic(top_values(model, [" ".join(w) for w in held]), y)
    return model


def word_values(model: dict, words: list[str]) -> np.ndarray:
    """Of words as ``words_of`` gives them."""
    out = [text_values(model, "  ".join(words[i : i + 10_000]))[0] for i in range(0, len(words), 10_000)]
    return np.concatenate(out) if out else np.zeros(0)


def text_values(model: dict, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts) of the words of a text."""
    code = np.frombuffer((" " + text + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    c = classes_of(code).astype(np.int32)
    # What is no letter around a space belongs to it.
    gap = c == 0
    runs = np.concatenate([[0], np.flatnonzero(np.diff(gap)) + 1])
    wide = np.logical_or.reduceat(code <= 32, runs) & gap[runs]
    space = np.repeat(wide, np.diff(np.concatenate([runs, [len(code)]])))
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    if not len(starts):
        return np.zeros(0), starts
    # The places before and after a word are its edges, and belong to it.
    own = np.zeros(len(c), np.int32)
    own[starts - 1] = 1
    word = np.cumsum(own, dtype=np.int32)
    c[starts - 1] = EDGE
    c[ends] = EDGE
    total = np.zeros(len(c), np.float32)
    for k in range(2, SPAN):
        if len(c) <= k:
            break
        outer, part = c[:-k] * (CLASSES * CLASSES) + c[k:], np.zeros(len(c) - k, np.float32)
        for j in range(1, k):
            part += model["table"][outer + c[j : len(c) - k + j] * CLASSES]
        # Nothing that reaches into the next word, and no gap at either end.
        part *= (word[:-k] == word[k:]) & (c[:-k] > 0) & (c[k:] > 0)
        total[: len(part)] += part * np.float32(DECAY ** (k + 1))
    values = np.add.reduceat(total, starts - 1) / np.sqrt(self_value(ends - starts))
    return values + model["shift"], starts


def top_values(model: dict, texts: list[str]) -> np.ndarray:
    """texts x TOP: the values of each text's highest different words, and
    the floor where there are fewer."""
    out, at = np.full((len(texts), TOP), model["floor"]), 0
    while at < len(texts):  # about a million characters at a time
        to, held = at, 0
        while to < len(texts) and (to == at or held + len(texts[to]) < 1 << 20):
            held += len(texts[to])
            to += 1
        block = [plain(t) for t in texts[at:to]]
        end = np.cumsum([len(t) + 2 for t in block])
        values, starts = text_values(model, "  ".join(block))
        high = np.flatnonzero(values > model["floor"])
        if len(high):
            # Equal words have equal values.
            row, v = np.searchsorted(end, starts[high] - 1, "right"), np.round(values[high], 4)
            order = np.lexsort((-v, row))
            row, v = row[order], v[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (v[1:] != v[:-1])])
            row, v = row[new], v[new]
            first = np.searchsorted(row, row)
            rank = np.arange(len(row)) - first
            out[at + row[rank < TOP], rank[rank < TOP]] = v[rank < TOP]
        at = to
    return out


def scores_of(model: dict, texts: list[str]) -> np.ndarray:
    if model["constant"] is not None:
        return np.full(len(texts), model["constant"])
    x = top_values(model, texts)
    return 1 / (1 + np.exp(-np.clip(x @ model["weights"][:-1] + model["weights"][-1], -40, 40)))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = [list(dict.fromkeys(words_of(t))) for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], pa.array(words, pa.list_(pa.string()))], names=["doc_id", "toxic", "words"])


def train(texts: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> dict:
    """``texts``: where the labelled documents' texts are.  The sample, some
    thousand documents' different words, is all that comes to the driver."""
    known = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic")).where("labelled IS NOT NULL AND toxic IN (0, 1)")
    known = known.where(~held_out(F.col("labelled"))).groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    # A third of the sample is for the rarer label, so that it has enough words.
    some = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("labelled"), "labelled").limit(settings.max_train * n // 3) for y, n in ((0, 2), (1, 1))]
    some = F.broadcast(some[0].union(some[1]))  # max_train rows of two numbers
    chosen = docs_of(texts).join(some, F.col("doc_id") == F.col("labelled")).select("doc_id", "toxic", "text")
    rows = materialize(chosen.mapInArrow(_word_batches, "doc_id long, toxic int, words array<string>"), "toxicity-sample")
    # Shared ids make more rows than ids: the bound on words holds for rows.
    sizes = rows.select("doc_id", F.xxhash64("doc_id", "words").alias("h"), F.size("words").alias("n")).where(F.col("n") <= settings.max_words // 20)
    sizes = sizes.orderBy(F.xxhash64("doc_id"), "h").limit(2 * settings.max_train).collect()
    total = np.cumsum([x.n for x in sizes])
    taken = {(x.doc_id, x.h) for x, t in zip(sizes, total) if t <= settings.max_words}
    keys = F.broadcast(rows.sparkSession.createDataFrame(sorted(taken), "i long, h long"))
    rows = rows.join(keys, (F.col("doc_id") == F.col("i")) & (F.xxhash64("doc_id", "words") == F.col("h")), "left_semi")
    names: dict[str, str] = {}  # one object for each different word
    rows = sorted((x.doc_id, x.toxic, [names.setdefault(w, w) for w in x.words]) for x in rows.toLocalIterator())
    return train_model([x[2] for x in rows], np.array([x[1] for x in rows], float), settings)


def toxicity_score(spark: SparkSession, model: dict):
    """A function of text columns."""
    shared = spark.sparkContext.broadcast(model)  # one table of CLASSES^3 numbers

    def score(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in column:
            yield pd.Series(scores_of(shared.value, ["" if t is None else t for t in s.tolist()]), dtype="float64")

    return F.pandas_udf(score, "double")


def toxicity_scores(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row."""
    return docs_of(docs).select("doc_id", toxicity_score(docs.sparkSession, model)(F.col("text")).alias("score"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    s = toxicity_scores(docs, model)
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
