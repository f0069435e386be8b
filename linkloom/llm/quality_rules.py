"""Quality rules: a learned decision list over statistics of whole texts.

Sequential covering grows one conjunction of thresholds after the other on labelled
statistics, prunes each on rows held out, and stops when no precise rule is left. The list
becomes one ordered Spark ``CASE`` expression.

A rule must keep its precision on rows it was not grown on, by more hits than chance gives to the
share of bad rows there, corrected for the rules tried. A list has at most ``max_rules`` rules of at
most ``MAX_TESTS`` tests, each cut at one of ``cuts`` quantiles: bounds of the model, not of the data.

* Nulls and empty texts have no words and one line; all other counts are 0.
* Long texts are counted whole; memory holds some 20 bytes for each byte of the longest.
* A null ``doc_id`` is kept as such. Repeated rows, and equal texts, are judged one by one alike.
* Of rules that cover as much, the one of the first feature in alphabetical order is grown.
* Without labels of both kinds the list is empty, and only the base rule rejects. Empty tables give
  no rows. Only key and text are read, so other columns may have any names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.batches import map_texts

STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_digits long, n_marks long, longest_word long, "
    "n_word_kinds long"
)

# At most so many labelled documents are read to learn the list.
MAX_LABELLED = 20_000
WINDOW = 8
MAX_TESTS = 6
# The chance that a rule without merit is accepted.
LUCK = 0.005

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _flags(members: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


_SPACE = _flags(b" \t\n\x0b\x0c\r")
_SYMBOL = _flags(b"#*$%&|<>")
_UPPER = _flags(bytes(range(65, 91)))
_DIGIT = _flags(b"0123456789")
_MARK = _flags(b"!?")


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _numbers(data: bytes) -> np.ndarray:
    """The words of some texts as numbers: equal words, and only those, have the same."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in data.split()], np.int64)


def _ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers for pairs: equal pairs, and only those, have the same."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _repeated(word: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where windows of eight words begin that stand twice or more in their text."""
    whole = len(word) - WINDOW + 1
    if whole <= 0:
        return np.zeros(0, np.int64)
    inside = np.flatnonzero(owner[:whole] == owner[WINDOW - 1 :])
    mixed = (word.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    key = owner[:whole].astype(np.uint64)
    for k in range(WINDOW):
        key = key * _STEP + mixed[k : k + whole]
    key = (key ^ (key >> np.uint64(31)))[inside]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    left, right = inside[order[:-1][same]], inside[order[1:][same]]
    if not (all((word[left + k] == word[right + k]).all() for k in range(WINDOW))
            and (owner[left] == owner[right]).all()):
        # Different windows of one key: number pairs, fours and eights of words instead.
        for step in (1, 2, 4):
            word = _ranked(word[:-step], word[step:])
        exact = _ranked(owner[:whole], word)[inside]
        _, back, times = np.unique(exact, return_inverse=True, return_counts=True)
        return inside[times[back] > 1]
    return np.unique(np.concatenate((left, right)))


def text_statistics(texts: list[bytes]) -> dict[str, np.ndarray | list]:
    """The columns of :data:`STATISTICS` for some UTF-8 texts."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = np.concatenate(([0], ends[:-1]))
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    space = _SPACE[data]

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, starts, dtype=np.int64)

    edge = np.diff(space.astype(np.int8), prepend=np.int8(1))
    begin = np.flatnonzero(edge == -1)
    end = np.flatnonzero((edge == 1)[1:]) + 1 if len(data) > 1 else begin[:0]
    owner = np.searchsorted(ends, begin, "right")
    count = np.bincount(owner, minlength=len(texts))
    word = _numbers(joined)

    change = np.zeros(len(word) + 1, np.int64)
    twice = _repeated(word, owner)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + WINDOW, -1)
    covered = np.cumsum(change)[:-1] > 0

    kinds = np.unique(owner * (int(word.max(initial=0)) + 1) + word) // (int(word.max(initial=0)) + 1)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, owner, end - begin)
    return {
        "n_words": count,
        "word_chars": per_text(~space & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(_SYMBOL[data]),
        "n_dup_lines": [_dup_lines(t) for t in texts],
        "n_repeat_words": np.bincount(owner[covered], minlength=len(texts)),
        "n_lines": per_text(data == 10),
        "n_upper": per_text(_UPPER[data]),
        "n_digits": per_text(_DIGIT[data]),
        "n_marks": per_text(_MARK[data]),
        "longest_word": longest,
        "n_word_kinds": np.bincount(kinds, minlength=len(texts)),
    }


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    return map_texts(docs, text, keep, STATISTICS, text_statistics)


def features() -> dict[str, Column]:
    """What rules may test. Shares of an empty text are 0."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))

    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "longest_word": F.col("longest_word").cast("double"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("n_marks", "n_words"),
        "upper_per_char": share("n_upper", "word_chars"),
        "digits_per_char": share("n_digits", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_kinds_share": share("n_word_kinds", "n_words"),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        column = x[self.feature]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def _holds(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: int) -> Rule:
    """Add the test of the highest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while bad[inside].any() and not bad[inside].all() and len(rule) < MAX_TESTS:
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 1e-9
        for name in sorted(x):
            values = x[name][inside]
            levels = np.unique(np.quantile(values, np.linspace(0, 1, cuts + 1)))
            for low, high in zip(levels[:-1], levels[1:], strict=True):
                cut = float((low + high) / 2)
                over = values > cut
                for above, side in ((True, over), (False, ~over)):
                    p, n = bad[inside][side].sum(), (~bad[inside])[side].sum()
                    if p and (g := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > gain:
                        best, gain = Test(name, above, cut), g
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int]:
    hit = _holds(rule, x, len(bad))
    n = int(hit.sum())
    return (float(bad[hit].sum()) / n if n else 0.0), n


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of the rule that is most precise on held-out rows; the shorter on a tie.
    Precision counts one row of each kind more, so that a few hits do not win by luck."""

    def score(r: Rule) -> float:
        precision, n = _worth(r, x, bad)
        return (precision * n + 1) / (n + 2)

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=score)


def _by_luck(hits: int, bad: int, share: float) -> float:
    """The chance of at least ``bad`` bad rows among ``hits`` if their share is ``share``."""
    if share <= 0 or share >= 1:
        return float(share >= 1 or not bad)
    ways = [
        math.lgamma(hits + 1) - math.lgamma(k + 1) - math.lgamma(hits - k + 1)
        + k * math.log(share) + (hits - k) * math.log1p(-share)
        for k in range(bad, hits + 1)
    ]
    return min(1.0, sum(map(math.exp, ways)))


def learn(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    hold_out: np.ndarray,
    min_precision: float = 0.98,
    cuts: int = 64,
    max_rules: int = 12,
) -> list[Rule]:
    """The decision list: rules that reject, in the order in which they were found."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        grow, prune = left & ~hold_out, left & hold_out
        if not bad[grow].any():
            break
        held, y = {k: v[prune] for k, v in x.items()}, bad[prune]
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], cuts)
        if not rule:
            break
        tried = len(rule)
        rule = _prune(rule, held, y)
        precision, n = _worth(rule, held, y)
        if not n or precision < min_precision:
            break
        if _by_luck(n, round(precision * n), float(y.mean())) * tried > LUCK:
            break
        rules.append(rule)
        left &= ~_holds(rule, x, len(bad))
    return rules


def learn_from(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, text: str = "text"
) -> list[Rule]:
    """Learn from at most ``max_labelled`` labelled documents, chosen by a hash of their id.

    Documents with ``quality`` 0 are to be rejected; those that the base rule rejects anyway
    teach nothing. Labels that contradict each other, or
    are null, are not used. A document repeated under one id counts once, as its first text.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_q"))
        .where("quality = _q").select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    # The broadcast has at most max_labelled rows of two numbers.
    known = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    made = with_statistics(known, ["doc_id", "quality"]).where(~base_failed())
    names = list(features())
    one = F.min(F.struct(*[c.alias(n) for n, c in features().items()])).alias("x")
    # A row of numbers for each labelled document, however often its id is repeated.
    rows = made.groupBy("doc_id", "quality").agg(one).select("doc_id", "quality", "x.*").toPandas()
    rows = rows.sort_values("doc_id")
    ids = rows["doc_id"].to_numpy(np.int64).astype(np.uint64)
    hold_out = ((ids * _STEP) >> np.uint64(40)) % np.uint64(3) == 0
    x = {n: rows[n].to_numpy(float) for n in names}
    return learn(x, rows["quality"].to_numpy() == 0, hold_out)


def verdict(rules: list[Rule]) -> Column:
    """The text of the first rule that holds, null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        holds = rule[0].column()
        for test in rule[1:]:
            holds &= test.column()
        out = F.when(holds, F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def base_failed() -> Column:
    """Too short, or more than 30 % of the words in repeated windows of eight words."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, all statistics, ``base_failed``, ``rule`` and ``kept`` for every document."""
    rules = learn_from(docs, labels, text=text)
    judged = with_statistics(docs, keep, text).withColumns(
        {"base_failed": base_failed(), "rule": verdict(rules)}
    )
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns as they are."""
    rules = learn_from(docs, labels, text=text)
    whole = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"),
                        F.col(f"`{text}`").alias("_whole"))
    judged = with_statistics(whole, ["_row"], "_whole")
    return judged.where(~base_failed() & verdict(rules).isNull()).select("_row.*")
