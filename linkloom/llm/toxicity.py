"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value calibration.

From labelled documents each unit (a word, or the beginning of longer words) gets the log-odds of
being met in toxic against other documents, under a Dirichlet prior of half a count and a share of
the pooled counts. Units that chance does not explain, after correction for all that were tried and
with copies counted once, form the lexicon. A token scores as its longest known unit, less a drift
that makes the mean score of clean text negative.

One linear scan finds all maximal scoring segments of a text. In clean text of n tokens, segments
of score S or more are expected K n exp(-lambda S) times; lambda solves sum p(s) exp(lambda s) = 1 for
the scores of clean tokens, K comes from counting. Segments expected less than ``alpha`` times are the
toxic passages. The normalised scores lambda S - ln(K n) of all segments above 0 are summed, and a
logistic curve makes the probability. The curve is fitted on documents that the lexicon used for it
has not seen; the lexicon is then made again from all.

At most ``MAX_LABELLED`` labelled documents, chosen by a hash of their id, are read to fit; they
also bound the lexicon, with ``MAX_UNITS``. All else covers every whole text.

* Null and empty texts have no tokens, and the score of a text without any evidence.
* Long texts are read in pieces of about a megabyte; memory holds two bytes and more for each token.
* Labels that are null or contradict each other are not used. A labelled id with several texts
  teaches its first text in order. Without labels of both kinds every score is the smoothed share of
  toxic labels, 0 if there are none.
* Repeated rows are scored one by one, and equal texts score equal. Empty tables give no rows.
* Columns but key and text are not read; kept columns may have any names but those of the result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.batches import map_texts
from linkloom.llm.store import Store, ship

MAX_LABELLED = 20_000
MAX_UNITS = 50_000
STEMS = (6, 5, 4, 3)  # letters of the beginnings that are units
PRIOR = 500.0  # pooled counts in the prior
STEP = 0.25  # scores are whole numbers of this size
ALPHA = 0.05
_CACHED = 100_000
_FOLDED = 200_000
_PIECE = 1 << 20
_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]")


def units(word: str) -> list[str]:
    """The word itself, and its beginnings as ``abc*``, the longest first."""
    return [word, *[word[:k] + "*" for k in STEMS if len(word) > k]]


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """The text cut between words, with the place of each piece."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, min(len(text), at + _PIECE))
        end = gap.end() if gap else len(text)
        yield at, text[at:end]
        at = end


class _Memo(dict):
    """The score of each word, known or not; remembers a bounded number."""

    def __init__(self, lexicon: dict[str, int]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        known = self.lexicon
        score = next((known[u] for u in units(word.lower()) if u in known), 0)
        if len(self) < _CACHED:
            self[word] = score
        return score


def segments(scores: np.ndarray) -> list[tuple[int, int, int]]:
    """All maximal scoring segments of whole numbers: score, first place, place after the last.

    A segment is maximal if it has no better part and lies in no better segment whose every
    proper beginning and end is positive. Only places with positive scores are visited.
    """
    total = np.cumsum(scores, dtype=np.int64)
    found: list[tuple[int, int, int, int, int]] = []  # sum before, sum after, first, end, link
    for at in np.flatnonzero(scores > 0).tolist():
        high = int(total[at])
        low, first, end = high - int(scores[at]), at, at + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= high:
                found.append((low, high, first, end, j))
                break
            low, first = found[j][0], found[j][2]
            del found[j:]
    return [(high - low, first, end) for low, high, first, end, _ in found]


@dataclass
class Model:
    lexicon: dict[str, int] = field(default_factory=dict)
    drift: int = 1
    rate: float = 1.0  # lambda, for scores in steps
    density: float = 1.0  # K
    bias: float = -math.inf
    slope: float = 0.0

    def scores(self, text: str, memo: _Memo) -> np.ndarray:
        """The lexicon's score of each token, without the drift."""
        made = [
            np.array(list(map(memo.__getitem__, _WORD.findall(piece))), np.int16)
            for _, piece in _pieces(text)
        ]
        return np.concatenate(made) if made else np.zeros(0, np.int16)

    def normal(self, score: int, n: int) -> float:
        """Below 0 if segments as good are expected more than once in n clean tokens."""
        return self.rate * score - math.log(self.density * max(n, 1))

    def found(self, text: str, memo: _Memo) -> tuple[int, list[tuple[float, int, int]]]:
        """The number of tokens, and all maximal segments by normalised score and tokens."""
        scores = self.scores(text, memo)
        if not (scores > 0).any():
            return len(scores), []
        made = segments(scores.astype(np.int32) - self.drift)
        return len(scores), [(self.normal(s, len(scores)), a, b) for s, a, b in made]

    @staticmethod
    def evidence(normals: list[float]) -> float:
        """From -1, no sign of toxicity, over 0 to the logarithm of all that is significant."""
        over = sum(x for x in normals if x > 0)
        return math.log1p(over) if over else max([-1.0, *[x / 10 for x in normals]])

    def probability(self, evidence: float) -> float:
        at = self.bias + self.slope * evidence
        return 1 / (1 + math.exp(-at)) if at > -700 else 0.0


def _places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Tokens first to end (not included) as places in the text; spans are in order."""
    out, span, first, n = [], 0, 0, 0
    for at, piece in _pieces(text):
        for word in _WORD.finditer(piece):
            if span == len(spans):
                return out
            if n == spans[span][0]:
                first = at + word.start()
            n += 1
            if n == spans[span][1]:
                out.append((first, at + word.end()))
                span += 1
    return out


# -- fitting

def labelled(docs: DataFrame, labels: DataFrame, text: str, usable: Column, most: int) -> DataFrame:
    """``doc_id``, ``toxic`` and one ``text`` of at most ``most`` labelled documents."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable)
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
        .where("toxic = _most").select("doc_id", "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    # The broadcast has at most `most` rows of two numbers.
    texts = docs.select("doc_id", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    known = texts.join(F.broadcast(chosen), "doc_id")
    return known.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _counts(sample: DataFrame, known: set[str] | None = None) -> DataFrame:
    """``unit``, ``y1`` and ``y0``: in how many toxic and other documents it occurs. With ``known``,
    only these units, and what is counted is different evidence: for a word, the pairs of words
    around its first place in each document, so that copies and near copies of a text count once;
    for a beginning, the words that begin so, as one frequent word says nothing of others."""
    ship(sample.sparkSession)
    only = sample.sparkSession.sparkContext.broadcast(known)

    def met(text: str) -> Iterator[str | tuple[str, str]]:
        if only.value is None:
            yield from {u for _, piece in _pieces(text) for w in set(_WORD.findall(piece))
                        for u in units(w.lower())}
            return
        seen, last, before, waiting = set(), "", "", []
        for _, piece in _pieces(text):
            for word in _WORD.findall(piece):
                yield from ((u, f"{last} {word}") for u in waiting)
                whole, *stems = units(word.lower())
                if whole in seen:
                    waiting = []
                else:
                    seen.add(whole)
                    waiting = [whole] if whole in only.value else []
                    yield from ((u, whole) for u in stems if u in only.value)
                last, before = before, word
        yield from ((u, f"{last} ") for u in waiting)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()

        def folded() -> pa.RecordBatch:
            keys = list(counted)
            names, around = zip(*[(k, "") if isinstance(k, str) else k for k, _ in keys], strict=True)
            toxic = np.array([t for _, t in keys], bool)
            n = np.array(list(counted.values()), np.int64)
            counted.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(around), pa.array(n * toxic), pa.array(n * ~toxic)],
                ["unit", "around", "y1", "y0"],
            )

        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
                counted.update((k, bool(label)) for k in met(text.as_py()))
                if len(counted) > _FOLDED:
                    yield folded()
        if counted:
            yield folded()

    made = sample.select("toxic", "text").mapInArrow(count, "unit string, around string, y1 long, y0 long")
    if known is not None:
        sums = made.groupBy("unit", "around").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
        made = sums.select("unit", (F.col("y1") > 0).cast("int").alias("y1"), (F.col("y0") > 0).cast("int").alias("y0"))
    return made.groupBy("unit").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))


def _z(y1: Column, y0: Column, share: float) -> Column:
    """Standard errors (the root of twice the log-likelihood ratio) from ``share`` of toxic counts."""

    def part(y: Column, p: float) -> Column:
        return F.when(y > 0, y * F.log(y / ((y1 + y0) * p))).otherwise(0.0)

    return F.sqrt(F.greatest(2 * (part(y1, share) + part(y0, 1 - share)), F.lit(0.0)))


def _lexicon(sample: DataFrame, store: Store, name: str, most: int) -> dict[str, int]:
    """The log-odds of units, in steps, that chance gives to less than one unit of all: the ``most``
    farthest from 0 in standard errors."""
    counted = store.put(f"units_{name}", _counts(sample).where("y1 + y0 >= 3"))
    n1, n0, kinds = counted.agg(F.sum("y1"), F.sum("y0"), F.count("*")).first()
    if not n1 or not n0:
        return {}
    share = n1 / (n1 + n0)
    least = NormalDist().inv_cdf(1 - 0.5 / max(kinds, 2))
    z = _z(F.col("y1"), F.col("y0"), share)

    def clear(frame: DataFrame) -> DataFrame:
        return frame.where(z >= least).orderBy(z.desc(), "unit").limit(most)

    known = {r["unit"] for r in clear(counted).select("unit").collect()}
    if not known:
        return {}
    prior = F.lit(0.5) + F.lit(PRIOR / (n1 + n0)) * (F.col("y1") + F.col("y0"))

    def odds(y: str, n: int) -> Column:
        return F.log((F.col(y) + prior) / (n + PRIOR - F.col(y) - prior))

    kept = clear(_counts(sample, known)).select("unit", (odds("y1", n1) - odds("y0", n0)).alias("odds"))
    return {
        r["unit"]: step for r in kept.collect()
        if (step := round(max(-8.0, min(8.0, r["odds"])) / STEP))
    }


def _histogram(sample: DataFrame, model: Model, kind: str) -> Counter:
    """How often each score occurs among the tokens, or the maximal segments, of the texts."""
    ship(sample.sparkSession)
    known = sample.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts = known.value, Counter()
        memo = _Memo(model.lexicon)
        for batch in batches:
            for text in batch.column("text"):
                scores = model.scores(text.as_py(), memo).astype(np.int32)
                if kind == "segments":
                    counts.update(s for s, _, _ in segments(scores - model.drift))
                else:
                    counts.update(dict(zip(*[x.tolist() for x in np.unique(scores, return_counts=True)], strict=True)))
        yield pa.RecordBatch.from_pydict({
            "score": pa.array(list(counts), pa.int64()), "n": pa.array(list(counts.values()), pa.int64()),
        })

    made = sample.select("text").mapInArrow(count, "score long, n long")
    return Counter({r["score"]: r["n"] for r in made.groupBy("score").agg(F.sum("n").alias("n")).collect()})


def _calibrate(model: Model, clean: DataFrame) -> None:
    """Set drift, lambda and K by clean documents. Positive scores of the lexicon that these do not
    hold count half a token, so that lambda is finite."""
    tokens = _histogram(clean, model, "tokens")
    for score in set(model.lexicon.values()):
        if score > 0:
            tokens[score] += 0.5
    n = sum(tokens.values())
    mean = sum(s * c for s, c in tokens.items()) / n
    model.drift = max(1, math.floor(mean) + 1)
    share = {s - model.drift: c / n for s, c in tokens.items()}
    low, high = 0.0, 1.0

    def over(rate: float) -> bool:
        return sum(p * math.exp(min(700.0, rate * s)) for s, p in share.items()) > 1

    while not over(high) and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    model.rate = max(high, 1e-6)
    good = sorted(s - model.drift for s in model.lexicon.values() if s > model.drift)
    at = good[len(good) // 2] if good else 1
    seen = sum(c for s, c in _histogram(clean, model, "segments").items() if s >= at)
    model.density = (seen + 1) * math.exp(min(600.0, model.rate * at)) / n


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A logistic curve through smoothed labels, by Newton's method; never falling."""
    ones, zeros = int(y.sum()), int((1 - y).sum())
    goal = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    at = np.zeros(2)
    design = np.stack((np.ones(len(x)), x), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (goal - p) - 1e-3 * at
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (float(at[0]), float(at[1])) if at[1] > 0 else (math.log((ones + 1) / (zeros + 1)), 0.0)


def fit(
    docs: DataFrame, labels: DataFrame, store: Store, usable: Column | None = None,
    text: str = "text", max_labelled: int = MAX_LABELLED, max_units: int = MAX_UNITS,
) -> Model:
    """Learn from the labels for which ``usable`` (of ``doc_id``) holds."""
    usable = F.lit(True) if usable is None else usable
    sample = store.put("labelled", labelled(docs, labels, text, usable, max_labelled))
    n = {r["t"]: r["n"] for r in
         sample.groupBy((F.col("toxic") != 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    ones, zeros = n.get(True, 0), n.get(False, 0)
    model = Model()
    if ones or zeros:
        model.bias = math.log((ones + 1) / (zeros + 1))
    curve = F.pmod(F.xxhash64("text"), F.lit(3)) == 0
    model.lexicon = _lexicon(sample.where(~curve), store, "part", max_units)
    clean = sample.where(curve & (F.col("toxic") == 0))
    if not model.lexicon or clean.isEmpty():
        return Model(bias=model.bias)
    _calibrate(model, clean)
    judged = _judged(sample.where(curve), model, ["toxic"], "text").select("toxic", "evidence").toPandas()
    y = (judged["toxic"].to_numpy() != 0).astype(float)
    if 0 < y.sum() < len(y):
        model.bias, model.slope = _curve(judged["evidence"].to_numpy(), y)
    # What is known now of scores and chance also serves the lexicon of all labelled documents.
    model.lexicon = _lexicon(sample, store, "all", max_units)
    return model


# -- scoring

_JUDGED = (
    "n_tokens long, evidence double, score double, "
    "passages array<struct<first:long,end:long,expected:double>>"
)


def _judged(docs: DataFrame, model: Model, keep: list[str], text: str, alpha: float = ALPHA) -> DataFrame:
    known = docs.sparkSession.sparkContext.broadcast(model)
    worker: list[_Memo] = []

    def digest(texts: list[bytes]) -> dict[str, list]:
        model = known.value
        if not worker:
            worker.append(_Memo(model.lexicon))
        out: dict[str, list] = {"n_tokens": [], "evidence": [], "score": [], "passages": []}
        for whole in texts:
            string = whole.decode()
            n, made = model.found(string, worker[0])
            evidence = model.evidence([x for x, _, _ in made])
            clear = [(math.exp(-x), a, b) for x, a, b in made if math.exp(min(700.0, -x)) <= alpha]
            places = _places(string, [(a, b) for _, a, b in clear]) if clear else []
            out["n_tokens"].append(n)
            out["evidence"].append(evidence)
            out["score"].append(model.probability(evidence))
            out["passages"].append([
                {"first": a, "end": b, "expected": e}
                for (e, _, _), (a, b) in zip(clear, places, strict=True)
            ])
        return out

    return map_texts(docs, text, keep, _JUDGED, digest)


def judge(
    docs: DataFrame, model: Model, keep: list[str], text: str = "text", alpha: float = ALPHA
) -> DataFrame:
    """``keep``, ``n_tokens``, ``evidence``, ``score`` (0 to 1) and ``passages`` of every document.

    A passage reaches from letter ``first`` to before ``end``, counted from 0; ``expected`` is how
    many as good ones a clean text of that length has by chance.
    """
    return _judged(docs, model, keep, text, alpha)
