"""Token ids of whole texts by a byte-level vocabulary of ranks."""

from __future__ import annotations

import base64
import re
from array import array

import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession


# White space as the patterns of byte-level vocabularies have it, in runs that would fill the stack
# of their matcher.
_LONG_BLANK = re.compile(
    "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{5000,}"
)


class ByteTokens:
    """Encoder for ranks as base64 and number, one token per line; ``end`` is the next free id."""

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self.end = len(table)

    def ids(self, text: str) -> list[int]:
        """The ids of the whole text.

        A long run of white space is cut out, as the pattern takes it for one piece: all of it at the
        end of the text, else all but the last letter, which may begin the next piece.
        """
        out, at = [], 0
        for run in _LONG_BLANK.finditer(text):
            after = run.end() - (run.end() < len(text))
            out += self.encoding.encode_ordinary(text[at : run.start()])
            out += self.encoding._encode_single_piece(text[run.start() : after])
            at = after
        return out + self.encoding.encode_ordinary(text[at:]) if out or at else \
            self.encoding.encode_ordinary(text)

    def count(self, text: str) -> int:
        return len(self.ids(text))

    def encode(self, text: str) -> bytes:
        """The ids as 16-bit little-endian numbers."""
        return array("H", self.ids(text)).tobytes()


_LOADED: dict[int, ByteTokens] = {}


def share(spark: SparkSession, ranks: str, pattern: str) -> Broadcast:
    """The vocabulary for the tasks; it is read on the driver and has a fixed size."""
    with open(ranks, "rb") as file:
        return spark.sparkContext.broadcast((file.read(), pattern))


def loaded(shared: Broadcast) -> ByteTokens:
    """One encoder per worker and vocabulary."""
    key = hash(shared.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteTokens(*shared.value)
    return _LOADED[key]
