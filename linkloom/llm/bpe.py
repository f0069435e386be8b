"""Exact byte-pair encoding by dynamic programming over prefixes, and its decoding.

A sequence of tokens is the encoding of a word exactly if each neighbouring pair is the
encoding of its own text, so every prefix has one possible last token. For each prefix an
automaton over the vocabulary lists the tokens that end there, its failure links running
through all suffixes; the one that is compatible with the last token of the prefix before it
is stored. Back-pointers from the end of the word give the ids.

Texts are split into words as the vocabulary file says: NFC, white space, lower case, then its
pattern; the texts of special tokens become their ids.

* Null and empty texts have no ids, and decode to the empty text. Repeated rows are encoded one by one.
* The encoding of a word is unique, so there are no ties. Empty tables give no rows.
* A text of any length is encoded whole; memory holds one text and caches of bounded size.
* Kept columns may have any names but those of the result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from linkloom.llm.store import ship

WORD_END = "</w>"
_END = "\0"
_NEVER = 1 << 60
# So many words, and twice as many pairs of tokens, are remembered by each worker.
CACHED = 500_000
# White space to Python's str.split, but not to the pattern.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable,
    else the next free one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder for a vocabulary file with word ends and byte letters."""

    def __init__(self, spec: bytes, cached: int = CACHED):
        self.cached = cached
        parsed = json.loads(spec)
        model, split = parsed["model"], parsed["pre_tokenizer"]["pretokenizers"][0]
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.texts = {i: t for t, i in (vocab | self.specials).items()}
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special_split = regex.compile(
            "(" + "|".join(regex.escape(t) for t in self.specials) + ")"
        ).split
        # Bytes read as Latin-1 have the code points of their values.
        self.letters = dict(enumerate(byte_letters()))

        self.rank = [-1] * len(vocab)
        self.parts: list[tuple[int, int]] = [(-1, -1)] * len(vocab)
        self.merges: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = vocab[a], vocab[b]
            self.merges[pair] = rank
            made = vocab[a + b]
            self.rank[made], self.parts[made] = rank, pair
        self.pairs: dict[int, bool] = {}
        self.matches = ahocorasick.Automaton()
        for text, token in vocab.items():
            if self._arises(token):
                text = text.removesuffix(WORD_END) + _END * text.endswith(WORD_END)
                self.matches.add_word(text, (token, len(text)))
        self.matches.make_automaton()
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _arises(self, token: int) -> bool:
        """Whether merging by rank ever builds this token."""
        rank = self.rank[token]
        return rank < 0 or self._apart(*self.parts[token], rank)

    def _apart(self, left: int, right: int, until: int = _NEVER) -> bool:
        """Whether no merge across the border of two tokens comes before ``until``.

        Both are taken apart again, the younger first. A merge of two pieces that meet at the
        border would have happened if it comes before either of them was merged into its own
        token; of equal merges, the one further left comes first.
        """
        rank, parts, merges = self.rank, self.parts, self.merges
        left_gone = right_gone = until
        while True:
            across = merges.get((left, right))
            if across is not None and across < left_gone and across <= right_gone:
                if across < until:
                    return False
            if rank[left] > rank[right]:
                left_gone, left = rank[left], parts[left][1]
            elif rank[right] >= 0:
                right_gone, right = rank[right], parts[right][0]
            else:
                return True

    def _compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) >= 2 * self.cached:
            self.pairs.clear()
        fits = self.pairs[left << 32 | right] = self._apart(left, right)
        return fits

    def word(self, text: str) -> bytes:
        """The ids of one word, as 32-bit integers."""
        spelled = text.encode().decode("latin-1").translate(self.letters) + _END
        n = len(spelled)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        pairs, compatible = self.pairs, self._compatible
        for at, (token, length) in self.matches.iter(spelled):
            end = at + 1
            if last[end] < 0:
                start = end - length
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    fits = pairs.get(before << 32 | token)
                    if not (compatible(before, token) if fits is None else fits):
                        continue
                last[end], back[end] = token, start
        ids = []
        while n:
            ids.append(last[n])
            n = back[n]
        ids.reverse()
        return array("i", ids).tobytes()

    def _words(self, words: list[str]) -> bytes:
        known, made = self.words, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                if len(known) >= self.cached:
                    known.clear()
                ids = known[word] = self.word(word)
            made.append(ids)
        return b"".join(made)

    def _chunk(self, chunk: str) -> bytes:
        if len(self.chunks) >= self.cached:
            self.chunks.clear()
        ids = self._words(self.pattern.findall(chunk))
        if len(chunk) <= 64:
            self.chunks[chunk] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Lower case letter by letter: a final sigma is not treated apart.
        text = text.replace("Σ", "σ").lower()
        if _ODD_SPACE.search(text):
            return self._words(self.pattern.findall(text))
        get, chunk = self.chunks.get, self._chunk
        return b"".join([get(c) or chunk(c) for c in text.split()])

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if any(t in text for t in self.specials):
            made = b"".join(
                np.int32(self.specials[part]).tobytes() if part in self.specials
                else self._plain(part)
                for part in self.special_split(text)
            )
        else:
            made = self._plain(text)
        return np.frombuffer(made, np.int32)

    def decode(self, ids: list[int]) -> str:
        """The texts of the tokens, joined by blanks, as the vocabulary names no decoder.
        Unknown ids are left out."""
        return " ".join(filter(None, map(self.texts.get, ids)))


_LOADED: dict[tuple[int, int], WordBpe] = {}


def _loaded(spec: bytes, cached: int = CACHED) -> WordBpe:
    """One encoder per worker and vocabulary, so that its caches outlive a task."""
    key = hash(spec), cached
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(spec, cached)
    return _LOADED[key]


def _vocabulary(docs: DataFrame, vocabulary: str):
    """The file's bytes, read on the driver; executors need no such file."""
    with open(vocabulary, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _map_column(
    docs: DataFrame, column: str, name: str, kind, make, keep: list[str] | None
) -> DataFrame:
    """The columns ``keep`` of ``docs``, all by default, and one made from batches of another."""
    ship(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c != name]
    # Kept columns travel as one, so that their names may be any.
    others = [F.col(f"`{c}`") for c in keep if c != column]
    row = F.struct(F.lit(0).alias("_"), *others).alias("_row")
    source = docs.select(row, F.col(f"`{column}`").alias("_from"))
    returned = ["_row", "_from"][: 1 + (column in keep)]
    schema = StructType([source.schema[c] for c in returned]).add("_made", kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = make(part.column("_from"))
                columns = [*[part.column(c) for c in returned], made]
                yield pa.RecordBatch.from_arrays(columns, names=[*returned, "_made"])

    whole = source.mapInArrow(run, schema)
    back = [F.col("_from") if c == column else F.col("_row")[c] for c in keep]
    return whole.select(
        *[b.alias(c) for b, c in zip(back, keep, strict=True)], F.col("_made").alias(name)
    )


def encode(
    docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids",
    keep: list[str] | None = None, cached: int = CACHED,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, all by default, and the token ids of each whole text as
    an array of integers. A column of that name is replaced. Fewer ``cached`` words take less
    memory and more time; give :func:`decode` the same number."""
    spec = _vocabulary(docs, vocabulary)

    def make(texts: pa.Array) -> pa.Array:
        bpe = _loaded(spec.value, cached)
        made = [bpe.encode(t or "") for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, made)], dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(made)))

    return _map_column(docs, text, ids, ArrayType(IntegerType()), make, keep)


def decode(
    docs: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded",
    keep: list[str] | None = None, cached: int = CACHED,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, all by default, and the text that its ids stand for; null
    ids are the empty text. A column of that name is replaced."""
    spec = _vocabulary(docs, vocabulary)

    def make(arrays: pa.Array) -> pa.Array:
        bpe = _loaded(spec.value, cached)
        return pa.array([bpe.decode(x or []) for x in arrays.to_pylist()], pa.string())

    return _map_column(docs, ids, text, StringType(), make, keep)
