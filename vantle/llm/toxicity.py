"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities and strengths of lexicon words, their nearness to
second-person words, capitals, punctuation, and how often words hide letters behind
digits, signs or stretched letters. The lexicon is a short fixed list plus words and
word beginnings that labelled toxic texts use far more often than others.

A bounded labelled sample (labels.MAX_LABELLED) is cut in folds by a hash of doc_id.
Features of a fold use the other folds' lexicon, and calibration uses margins of trees
grown without the fold, so no text judges its own words. The lexicon has at most
MAX_LEXICON learnt terms, the most telling ones: the bound of what is broadcast and a
parameter of fit(). Every whole text is scored.

Defined results: null text counts as empty and is scored like any other; without
labelled rows of both classes the score is the share of toxic labels, 0 without any;
equal texts have equal scores; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, text_arrays, text_batches, texts_of, written
from .labels import MAX_LABELLED, labelled_texts

#: Plain insults, and second-person words, of four languages.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers trash scum pathetic worthless disgusting clown filth vermin garbage jerk imbecile fool"
    " idioten dumm blöd abschaum wertlos widerlich trottel versager müll crétin imbécile débile ordure minable racaille nul"
    " idiota idiotas estúpido estúpida imbécil basura asqueroso asquerosa inútil escoria payaso patético"
).split()
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner euch euer ihr tu te toi ton ta tes vous votre vos tú ti tuyo tuya usted ustedes vosotros os".split()
)
#: Signs and digits that stand for letters.
LETTERS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e"})
EDGE = "\"'`.,;:!?()[]{}<>«»„“”‚’…-–—*_~#%&|/\\"
STRETCHED = re.compile(r"(.)\1{2,}")
INNER = re.compile(r"[^\W\d_][\d@$!|+€*._\-#%&]+[^\W\d_]")
PREFIXES = (4, 5, 6)
NEAR = 6
FEATURES = (
    "lexicon_share", "lexicon_count", "lexicon_strongest", "lexicon_strength", "lexicon_distinct", "second_person_share", "near_second_person",
    "capital_words", "capital_letters", "exclamations", "questions", "punctuation", "hidden_share", "hidden_lexicon", "log_words", "mean_word",
)
#: Learnt terms of the lexicon at most: with the fixed ones, some 100 KB on every worker.
MAX_LEXICON = 4_000


def plain_forms(word: str) -> tuple[str, str, bool]:
    """(lower case without edge signs, the same with hidden letters restored, whether any were hidden)."""
    bare = word.strip(EDGE).lower()
    hidden = not word.isalpha() and bool(INNER.search(word.strip(".,;:!?"))) or bool(STRETCHED.search(bare))
    if not hidden:
        return bare, bare, False
    restored = STRETCHED.sub(r"\1", re.sub(r"[^\w]|_", "", word.lower().strip(".,;:!?").translate(LETTERS)))
    return bare, restored, True


#: Words stand between ASCII white space.
WORDS = re.compile("[^\x20\x09-\x0d]+").findall


def terms_of(text: str) -> set[str]:
    """Distinct words and word beginnings ("lowe*") of a text."""
    words = {plain_forms(w)[1] for w in set(WORDS(text))}
    words.discard("")
    return words.union(w[:n] + "*" for w in words for n in PREFIXES if len(w) > n)


LEXICAL, PERSON, CAPITAL, HIDDEN, FOUND = (1 << k for k in range(5))


class WordTable:
    """Per raw word: what the features need, worked out once.

    A word has a code, the place of its strength and flags among all that occur. Words are
    held in two generations of half of ``limit``: one met again moves to the young one, so
    frequent words stay when the old one goes.
    """

    def __init__(self, lexicon: dict[str, float], limit: int = 400_000):
        self.lexicon, self.limit = lexicon, limit
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.number: dict[tuple[float, int], int] = {}

    def strength(self, word: str) -> float:
        get = self.lexicon.get
        return max(get(word, 0.0), *(get(word[:n] + "*", 0.0) for n in PREFIXES))

    def _learn(self, w: str) -> int:
        bare, restored, hidden = plain_forms(w)
        open_, found = self.strength(bare) if bare else 0.0, 0.0
        if hidden and restored:
            found = self.strength(restored)
        marks = ((open_ > 0 or found > 0, LEXICAL), (bare in SECOND_PERSON, PERSON), (len(bare) > 1 and w.isupper(), CAPITAL), (hidden, HIDDEN), (found > open_, FOUND))
        return self.number.setdefault((max(open_, found), sum(bit for mark, bit in marks if mark)), len(self.number))

    def _codes(self, words: list[str]) -> np.ndarray:
        if len(self.young) > self.limit // 2:
            self.young, self.old = {}, self.young
        codes = np.fromiter(map(self.young.get, words, itertools.repeat(-1)), np.int64, len(words))
        for k in np.flatnonzero(codes < 0).tolist():
            w = words[k]
            code = self.old.get(w)
            self.young[w] = codes[k] = self._learn(w) if code is None else code
        return codes

    def matrix(self, texts: list[str] | pa.Array) -> np.ndarray:
        """One row of features a text; a text without words has zeros."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        out = np.zeros((len(texts), len(FEATURES)))
        if not len(texts):
            return out
        parts = pc.ascii_split_whitespace(texts)
        coded = parts.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy()
        of = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
        if "" in distinct:  # white space at a text's ends
            real = index != distinct.index("")
            index, of = index[real], of[real]
        size = np.bincount(of, minlength=len(texts))
        ends = np.cumsum(size)
        some = np.flatnonzero(size)
        if not len(some):
            return out
        codes = self._codes(distinct)[index]
        strengths, marks = (np.array(x) for x in zip(*self.number, strict=True))
        strength, flags = strengths[codes], marks[codes]
        starts = (ends - size)[some]
        total = lambda values: np.add.reduceat(values, starts)
        count = lambda bit: total((flags & bit > 0).astype(np.int64))
        n = size[some]
        hit = np.flatnonzero(flags & LEXICAL)
        person = np.concatenate([[0], np.cumsum(flags & PERSON > 0)])
        first, last = (ends - size)[of[hit]], ends[of[hit]]
        close = person[np.minimum(last, hit + NEAR + 1)] - person[np.maximum(first, hit - NEAR)] > 0
        hits = np.bincount(of[hit], minlength=len(texts))[some]
        kinds = np.unique(of[hit] * len(distinct) + index[hit]) // len(distinct)
        bytes_, counted = byte_counts(texts, (UPPER, EXCLAMATION, QUESTION, SIGN))
        bytes_, (upper, exclamations, questions, signs) = bytes_[some], counted[:, some]
        out[some] = np.stack([
            hits / n, np.log1p(hits), np.maximum.reduceat(strength, starts), total(strength) / n, np.log1p(np.bincount(kinds, minlength=len(texts))[some]),
            count(PERSON) / n, np.bincount(of[hit[close]], minlength=len(texts))[some] / n, count(CAPITAL) / n, upper / bytes_, exclamations / n, questions / n,
            signs / bytes_, count(HIDDEN) / n, count(FOUND) / n, np.log1p(n), (bytes_ - n) / n,
        ], 1)
        return out


def _byte_set(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int8)
    out[list(chars.encode())] = 1
    return out


UPPER, EXCLAMATION, QUESTION, SIGN = (_byte_set(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!", "?", "!\"#$%&'()*+,-./:;<=>?@"))


def byte_counts(texts: pa.Array, sets: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each text, how many of them are in each of the sets)."""
    plain = texts.cast(pa.large_binary())
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    raw = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets - offsets[0]
    reach = [np.concatenate([[0], np.cumsum(members[raw], dtype=np.int64)])[ends] for members in sets]
    return np.diff(ends), np.array([np.diff(r) for r in reach])


@dataclass
class Trees:
    """Boosted complete trees on the logistic loss: arrays of split features, thresholds and leaf values."""

    depth: int = 3
    start: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


def grow(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0) -> Trees:
    """Newton boosting with histogram splits at feature quantiles."""
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Trees(depth, math.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    for f, e in enumerate(edges):  # a feature that is rarely above its least value still gets a split there
        above = x[x[:, f] > x[:, f].min(), f]
        edges[f] = np.unique(np.concatenate([e, [x[:, f].min()], np.quantile(above, [0.25, 0.5, 0.75]) if len(above) else []]))
    code = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    margin = np.full(len(x), model.start)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == k)
                best = 1e-6
                if len(rows) < 10:
                    continue
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for f, e in enumerate(edges):
                    size = len(e) + 1
                    left_g = np.cumsum(np.bincount(code[rows, f], g[rows], size))[:-1]
                    left_h = np.cumsum(np.bincount(code[rows, f], h[rows], size))[:-1]
                    gain = left_g**2 / (left_h + l2) + (total_g - left_g) ** 2 / (total_h - left_h + l2) - total_g**2 / (total_h + l2)
                    if len(gain) and gain.max() > best:
                        best, feature[k], threshold[k] = gain.max(), f, e[int(gain.argmax())]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        leaves = node - inner
        value = rate * np.bincount(leaves, g, inner + 1) / (np.bincount(leaves, h, inner + 1) + l2)
        margin += value[leaves]
        model.feature.append(feature), model.threshold.append(threshold), model.leaf.append(value)
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(margins, rising shares) by pooling adjacent violators; to be read by linear interpolation."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # mean margin, label sum, weight
    for m, v in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([m, v, 1.0])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            m2, v2, w2 = blocks.pop()
            m1, v1, w1 = blocks[-1]
            blocks[-1] = [(m1 * w1 + m2 * w2) / (w1 + w2), v1 + v2, w1 + w2]
    points = np.array(blocks).reshape(-1, 3)
    return points[:, 0], (points[:, 1] + 0.5 * points[:, 1].sum() / max(1.0, points[:, 2].sum())) / (points[:, 2] + 0.5)


@dataclass
class Scorer:
    """What is broadcast: lexicon, trees and calibration."""

    lexicon: dict[str, float]
    trees: Trees | None
    at: np.ndarray
    share: np.ndarray
    prior: float

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        """Scores of feature rows. A hundredth of the uncalibrated score keeps the order within calibration steps."""
        if self.trees is None:
            return np.full(len(x), self.prior)
        margin = self.trees.margin(x)
        raw = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        fitted = np.interp(margin, self.at, self.share) if len(self.at) else raw
        return np.clip(0.99 * fitted + 0.01 * raw, 0.0, 1.0)


FOLDS = 5


def _fold(doc_id: str = "doc_id"):
    return F.pmod(F.xxhash64(F.lit("fold"), F.col(doc_id)), F.lit(FOLDS)).cast("int")


def _lexicon(found: DataFrame, skipped: int | None, n1: float, n0: float, most: int) -> dict[str, float]:
    """The fixed insults plus at most ``most`` terms that toxic texts use far more often than others.

    Terms are counted without the texts of fold ``skipped``, if any: it has no say in which are chosen.
    """
    lexicon = {w: 2.0 for w in INSULTS}
    if n1 < 1 or n0 < 1:
        return lexicon
    less = (lambda c: F.col(c)) if skipped is None else (lambda c: F.col(c) - F.col(f"{c}{skipped}"))
    toxic, clean = less("toxic"), less("clean")
    odds = F.log((toxic + 0.5) / F.lit(n1 + 1) / ((clean + 0.5) / F.lit(n0 + 1)))
    for term, strength in found.select("term", toxic.alias("toxic"), odds.alias("odds")).filter("toxic >= 2 and odds > 1.5").orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(most).select("term", "odds").collect():
        lexicon[term] = max(lexicon.get(term, 0.0), strength)
    return lexicon


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MAX_LABELLED, max_lexicon: int = MAX_LEXICON, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Learn from at most ``most`` labelled texts outside the held-out fifth."""
    sample = written(labelled_texts(docs, labels, label, most, id_col, text_col).withColumn("fold", _fold()), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[Counter(), Counter()] for _ in range(FOLDS)]
        for part, texts in text_batches(batches):
            for text, y, fold in zip(texts, part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                counts[fold][1 if y else 0].update(terms_of(text))
        for fold, (clean, toxic) in enumerate(counts):
            terms = list(toxic.keys() | clean.keys())
            for i in range(0, len(terms), 50_000):
                t = terms[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array([fold] * len(t), pa.int32()), pa.array([toxic[x] for x in t], pa.int64()), pa.array([clean[x] for x in t], pa.int64())], names=["term", "fold", "toxic", "clean"])

    sizes = {(r["fold"], r["label"]): r["n"] for r in sample.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    n1 = np.array([sizes.get((k, 1), 0) for k in range(FOLDS)], float)
    n0 = np.array([sizes.get((k, 0), 0) for k in range(FOLDS)], float)
    if not n1.sum() or not n0.sum():
        none = np.empty(0)
        return Scorer({w: 2.0 for w in INSULTS}, None, none, none, float(n1.sum() / max(1.0, n1.sum() + n0.sum())))
    folds = range(FOLDS)
    by_fold = lambda c: [F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}") for k in folds]
    found = sample.mapInArrow(released(count), "term string, fold int, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), *by_fold("toxic"), *by_fold("clean"))
    found = written(found.filter("toxic >= 2"), "terms")
    # a fold's features come from the other folds' lexicon, so no text vouches for its own words
    without = [_lexicon(found, k, n1.sum() - n1[k], n0.sum() - n0[k], max_lexicon) for k in folds]
    lexicon = _lexicon(found, None, n1.sum(), n0.sum(), max_lexicon)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [WordTable(x, 100_000) for x in without]
        for part, texts in text_arrays(batches, most=4 << 20):
            fold = part.column(3).to_numpy()
            x = np.zeros((len(texts), len(FEATURES)))
            for k in folds:
                x[fold == k] = tables[k].matrix(texts.filter(pa.array(fold == k)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), *(pa.array(x[:, k]) for k in range(len(FEATURES)))], names=["doc_id", "label", "fold", *FEATURES])

    got = sample.mapInArrow(released(features), "doc_id long, label int, fold int, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow().sort_by("doc_id")
    y, fold = got["label"].to_numpy().astype(np.float64), got["fold"].to_numpy()
    x = np.stack([got[f].to_numpy() for f in FEATURES], 1)
    # calibration reads margins of trees that have not seen the row
    margin = np.zeros(len(y))
    for k in folds:
        rows = fold == k
        if rows.any() and len(set(y[~rows])) == 2:
            margin[rows] = grow(x[~rows], y[~rows]).margin(x[rows])
    at, share = isotonic(margin, y)
    return Scorer(lexicon, grow(x, y), at, share, float(y.mean()))


def score(df: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score double) of every whole text."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(sent.value.lexicon)
        for part, texts in text_arrays(batches, most=4 << 20):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sent.value.calibrated(table.matrix(texts)))], names=["doc_id", "score"])

    return texts_of(df, id_col, text_col).mapInArrow(released(run), "doc_id long, score double")
