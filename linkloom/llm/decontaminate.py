"""Benchmark decontamination by templates, in DataFrame operations only.

A text becomes a template: numbers, names and units turn into typed placeholders, the other
words lower case. Windows of ``window`` words of all documents are joined by hash with those of
the benchmark. What a document shares with an item is the set of the item's words that matched
windows cover. A window whose placeholders stand for equal values on both sides counts by itself.
Over all windows whose values differ these must map consistently: the same value of the item always
to the same value of the document, and back. That keeps items asked with other parameters, and
drops mere accidents of form.

A document holds an item if that covers ``min_share`` of the item's words. An item shorter than a
window is one window of its own length, sought in longer documents too if it has ``LEAST_WORDS``
words; a shorter one is found only where it is the whole document. Windows that are placeholders by
more than half are compared by their words as they stand, in lower case.

Each window has up to three hashes: of its template, of the template in which capitalised words
that begin a sentence are names too, and of its words in lower case, which finds copies in other
case. ``COMMON`` words are never names at the beginning of a sentence. Where more than a fifth of the
words have capitals within sentences, as in languages that write all nouns so, capitals make no names.

Each item window names three of its literal words that stand together, or fewer if it has no three. A
document's windows are made only around such words, which a set or a bitmap of fixed size tells; a document
without any has no template made at all. Equal windows hold the same words, so none is missed.

Windows that more
than ``MAX_SHARED`` items hold, such as an instruction that all begin with, do not bring documents and
items together where they cover too little of an item by themselves; they count for pairs that other
windows found. So a sentence of many items makes no pairs of all that quote it.

The windows of the benchmark are broadcast in blocks of at most ``MAX_BLOCK`` rows, each a few
numbers and slot words; each further block reads the documents again.

* Nulls and empty texts hold nothing and are held by nothing; so do empty tables.
* Rows equal in id and text are judged alike and returned once per item; ties do not arise.
* Texts are read whole, whatever their length, as one row of the task.
* Documents keep all their columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.keys import boxed, row_key, unboxed
from linkloom.llm.store import Store

MAX_BLOCK = 500_000
MAX_SHARED = 16
# So many marks are looked up as a set, more in a map of bits: 512 kB.
MAX_SET = 20_000
MAP_BITS = 1 << 22

# One or two words are no sign of a leak within a longer text.
LEAST_WORDS = 3

# Units in the order of length, mass, volume, time, temperature, money, shares.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yards mile miles meter meters metre metres "
    "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons "
    "ms s sec min h hr hrs second seconds minute minutes hour hours day days week weeks "
    "month months year years "
    "c f k degree degrees usd eur gbp dollar dollars euro euros cent cents percent"
).split()

# Words that often begin a sentence.
COMMON = (
    "a an the this that these those there here it its he she they we you i his her their our your my "
    "what which who whom whose when where why how if in on at by for from to of with without and or "
    "but as so then than after before during while since until because although though however "
    "is are was were be do does did has have had can could will would should may might must let "
    "each every all some any no not one two three both many much more most other another "
    "find given suppose calculate compute determine choose consider"
).split()

# Private letters stand for the placeholders, so that they pass for words.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# All that parts words: ASCII, Latin-1, general and CJK punctuation and spaces. The middle dot
# stands for the separators within numbers.
_BREAKS = (
    r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\xa9\xab-\xb1\xb4\xb6\xb8\xbb\xbf\xd7\xf7"
    r"\u2000-\u206f\u3000-\u303f]+"
)


def _if_digits(c: Column, then: Column, other: Column) -> Column:
    return F.when(F.regexp_like(c, F.lit("[0-9]")), then).otherwise(other)


def _spaced(c: Column) -> Column:
    """Numbers as words of their own, their separators as middle dots."""
    dotted = F.regexp_replace(c, r"(?<=[0-9])[.,](?=[0-9])", "·")
    spaced = F.regexp_replace(dotted, r"(?<=[0-9])(?=\p{L})|(?<=\p{L})(?=[0-9])", " ")
    return _if_digits(c, spaced, c)


def _words(c: Column) -> Column:
    return F.array_remove(F.split(c, _BREAKS), "")


_WORD = r"\p{Lu}[\p{Ll}\p{M}]+(?!\p{L})"
_FIRST_WORD = rf"(?<!\p{{L}})(?=\p{{Lu}})(?!(?i:{'|'.join(COMMON)})(?!\p{{L}})){_WORD}"


_WITHIN = r"(?<=[\p{Ll},;] )"


def _has_names(spaced: Column, words: Column) -> Column:
    """Whether capitals within sentences are few enough among the words to be those of names."""
    capitals = F.regexp_count(spaced, F.lit(f"{_WITHIN}{_WORD}"))
    return (capitals < 4) | (5 * capitals <= F.size(words))


def _placed(spaced: Column, names: Column) -> Column:
    """The text with placeholders; names are capitalised words that go on within a sentence."""
    named = F.when(names, F.regexp_replace(spaced, f"{_WITHIN}{_WORD}", NAME)).otherwise(spaced)
    number = F.regexp_replace(named, r"[0-9][0-9·]*", NUMBER)
    units = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    unit = F.regexp_replace(number, rf"(?i)(?<={NUMBER} )(?:{units})(?!\p{{L}})", UNIT)
    return _if_digits(spaced, unit, named)


def template(c: Column) -> Column:
    """The words of a text in lower case, with placeholders."""
    spaced = _spaced(c)
    return _words(F.lower(_placed(spaced, _has_names(spaced, _words(spaced)))))


_MARK = "struct<kind:int,words:array<string>>"
_KEYS = "array<struct<p:int,n:int,hash:bigint,slots:array<string>,mark:struct<kind:int,words:array<string>>>>"


def _windows(
    text: Column, window: int, lengths: list[int] | None = None, marks: Marks | None = None
) -> Column:
    """``p``, ``n``, ``hash``, ``slots`` and ``mark`` of every window of ``n`` words from place
    ``p``, one for each of its hashes; fewer words than a window make one. ``lengths`` are those of
    further windows. ``mark`` is what :func:`_mark` makes of the window; with ``marks`` only windows
    that hold one of them are made, and ``mark`` is null.

    ``slots`` has the words that stand for the window's placeholders, none for a window hashed by
    its words. A template with placeholders for more than half of a window has no hash.
    """
    def is_slot(word: Column) -> Column:
        return word.isin(NUMBER, NAME, UNIT)

    def of_length(
        n: Column, plain: Column, forms: list[tuple[Column, Column]], found: Column | None
    ) -> Column:
        def key(words: Column, p: Column, slots: Column) -> Column:
            part = F.slice(words, p + 1, n)
            mark = F.lit(None).cast(_MARK) if marks is not None else _mark(part)
            return F.struct(
                p.alias("p"), n.alias("n"), F.xxhash64(part).alias("hash"), slots.alias("slots"),
                mark.alias("mark"),
            )

        none = F.array().cast("array<string>")

        def at(p: Column) -> Column:
            def keys(found: Column) -> Column:
                # Templates with no more placeholders than the one before equal that.
                sizes = [F.lit(0), *[F.size(found[k]) for k in range(len(forms))]]
                made = [
                    F.when((sizes[k + 1] > sizes[k]) & (2 * sizes[k + 1] <= n), key(words, p, found[k]))
                    for k, (words, _) in enumerate(forms)
                ]
                return F.array_compact(F.array(key(plain, p, none), *made))

            return _bind(F.array(*[
                F.array_compact(F.slice(values, p + 1, n)) for _, values in forms
            ]), keys)

        if found is None:
            starts = F.sequence(F.lit(0), F.size(plain) - n)
        else:
            starts = F.array_distinct(F.flatten(F.transform(found, lambda i: F.sequence(
                F.greatest(i - n + 1, F.lit(0)), F.least(i, F.size(plain) - n)
            ))))
        if not forms:
            return F.transform(starts, lambda p: key(plain, p, none))
        return F.flatten(F.transform(starts, at))

    def every(
        plain: Column, forms: list[tuple[Column, Column]], found: Column | None
    ) -> Column:
        usual = F.least(F.size(plain), F.lit(window))
        if not lengths:
            return of_length(usual, plain, forms, found)
        shorter = F.filter(F.array(*map(F.lit, lengths)), lambda n: n < usual)
        sizes = F.concat(F.array(usual), shorter)
        return F.flatten(F.transform(sizes, lambda n: of_length(n, plain, forms, found)))

    def values(words: Column, plain: Column) -> Column:
        return F.zip_with(words, plain, lambda word, value: F.when(is_slot(word), value))

    def whole(spaced: Column, plain: Column, found: Column | None) -> Column:
        def slotted(v: Column) -> Column:
            forms = [(v[1], v[3]), (v[2], v[4])]
            return F.when(F.exists(v[2], is_slot), every(v[0], forms, found)) \
                .otherwise(every(v[0], [], found))

        def with_values(words: Column) -> Column:
            added = [values(words[k], words[0]) for k in (1, 2)]
            return _bind(F.array(words[0], words[1], words[2], *added), slotted)

        def placed(names: Column) -> Column:
            def formed(text: Column) -> Column:
                first = F.when(names, F.regexp_replace(text, _FIRST_WORD, NAME)).otherwise(text)
                return _bind(F.array(plain, _words(F.lower(text)), _words(F.lower(first))), with_values)

            return _bind(_placed(spaced, names), formed)

        return _bind(_has_names(spaced, plain), placed)

    def searched(spaced: Column) -> Column:
        def near(plain: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(plain) - 1)
            none = F.array().cast(_KEYS)
            found = _bind(
                F.filter(places, lambda i: marks.at(plain, i)),
                lambda f: F.when(F.size(f) > 0, whole(spaced, plain, f)).otherwise(none),
            )
            return F.when(F.size(plain) > 0, found).otherwise(none)

        words = _words(F.lower(spaced))
        if marks is None:
            return _bind(words, lambda plain: whole(spaced, plain, None))
        return _bind(words, near)

    return _bind(_spaced(text), searched)


# Which of some words in a row make a mark: the first of these of which a window has literal ones.
_KINDS = [(0, 1, 2), (0, 1), (0, 2), (0,)]
def _mark(words: Column) -> Column:
    """Literal words of a window that tell where to look for it: the longest of the first kind it
    has; of those as long, the last in order."""
    def of(kind: int) -> Column:
        offsets = _KINDS[kind]
        runs = F.transform(F.sequence(F.lit(0), F.size(words) - 1 - offsets[-1]), lambda i: F.array(
            *[F.get(words, i + k) for k in offsets]))
        plain = F.filter(runs, lambda run: ~F.exists(run, lambda w: w.rlike(f"[{NUMBER}{NAME}{UNIT}]")))
        sized = F.transform(plain, lambda run: F.struct(F.length(F.array_join(run, "")).alias("n"), run.alias("run")))
        best = F.array_max(sized)["run"]
        made = F.struct(F.lit(kind).alias("kind"), best.alias("words"))
        return F.when((F.size(words) > offsets[-1]) & best.isNotNull(), made)

    return F.coalesce(*[of(kind) for kind in range(len(_KINDS))])


class Marks(NamedTuple):
    """Hashes of marks: a set, or a map of ``MAP_BITS`` bits if they are many; and their kinds."""

    hashes: list[int] | None
    bits: Column
    kinds: list[int]

    @staticmethod
    def of(wanted: DataFrame) -> Marks:
        """The marks of all wanted windows; the map is a scalar subquery, of 64 bits each."""
        spark = wanted.sparkSession
        marks = wanted.where(F.col("mark").isNotNull()).select(
            F.xxhash64("mark.kind", *[F.get("mark.words", F.lit(k)) for k in range(3)]).alias("bit"),
            "mark.kind",
        ).distinct()
        kinds = sorted(marks.agg(F.collect_set("kind")).first()[0])
        hashes = [r["bit"] for r in marks.select("bit").limit(MAX_SET + 1).collect()]
        if len(hashes) <= MAX_SET:
            return Marks(hashes, F.lit(None).cast("array<bigint>"), kinds)
        slots = marks.groupBy(_slot(F.col("bit")).alias("slot")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("set")
        ).collect()
        known = [0] * (MAP_BITS // 64)
        for row in slots:
            known[row["slot"]] = row["set"]
        return Marks(None, spark.createDataFrame([(known,)], "known array<bigint>").scalar(), kinds)

    def at(self, words: Column, i: Column) -> Column:
        """Whether a mark begins at a place."""
        def has(kind: int) -> Column:
            bit = F.xxhash64(F.lit(kind), *[F.get(words, i + k) for k in _KINDS[kind]])
            if self.hashes is not None:
                return bit.isin(self.hashes)
            slot = F.get(self.bits, _slot(bit))
            return F.bit_get(slot, bit.bitwiseAND(F.lit(63)).cast("int")) == 1

        return reduce(Column.__or__, map(has, self.kinds), F.lit(False))


def _slot(bit: Column) -> Column:
    return F.shiftrightunsigned(bit, 6).bitwiseAND(F.lit(MAP_BITS // 64 - 1)).cast("int")


def _items(benchmark: DataFrame) -> DataFrame:
    return (
        benchmark.select("item_id", F.col("text").alias("t")).where("t IS NOT NULL").distinct()
        .withColumn("length", F.size(template(F.col("t")))).where("length > 0")
    )


def _wanted(items: DataFrame, window: int, min_share: float, store: Store) -> DataFrame:
    """The windows of all items: ``hash``, ``n``, ``item``, ``ip``, ``of_item``, ``mark`` and
    ``brings``, whether equal windows bring a document and the item together."""
    rows = store.put("item_windows", items.select(
        "item", "length", F.explode(_windows(F.col("t"), window)).alias("w")
    ).select("w.hash", "w.n", "item", "length", F.col("w.p").alias("ip"),
             F.col("w.slots").alias("of_item"), "w.mark"))
    shared = rows.groupBy("hash", "n").agg(F.countDistinct("item").alias("items"))
    shared = store.put("shared_windows", shared.where(F.col("items") > MAX_SHARED).drop("items"))
    marked = rows.join(shared.withColumn("common", F.lit(True)), ["hash", "n"], "left")
    marked = marked.withColumn("common", F.coalesce("common", F.lit(False)))
    runs = F.transform(F.collect_set(F.when(F.col("common"), F.struct("ip", "n"))),
                       lambda r: F.sequence(r["ip"], r["ip"] + r["n"] - 1))
    enough = marked.groupBy("item", "length").agg(
        F.size(F.array_distinct(F.flatten(runs))).alias("covered")
    ).select("item", (F.col("covered") >= F.lit(min_share) * F.col("length")).alias("alone"))
    return store.put("wanted", marked.join(enough, "item").select(
        "hash", "n", "item", "ip", "of_item", "mark", (~F.col("common") | F.col("alone")).alias("brings")
    ))


def _equal(places: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    pairs = F.zip_with(
        "of_item", "of_doc", lambda x, y: F.struct(x.alias("of_item"), y.alias("of_doc"))
    )
    return places.join(wanted, on).select(
        "_key", "id", "item", (F.col("dp") - F.col("ip")).alias("shift"), "ip", pairs.alias("pairs"),
    )


def hits(
    docs: DataFrame, items: DataFrame, window: int, min_share: float, store: Store
) -> DataFrame:
    """Equal windows: ``_key``, ``id``, ``item``, ``shift`` between document and item, ``ip``
    where the window begins in the item, and ``pairs`` of slot values."""
    wanted = _wanted(items, window, min_share, store)
    short = items.where(F.col("length").between(LEAST_WORDS, window - 1)).select("length").distinct()
    lengths = sorted(r["length"] for r in short.collect())

    def windows(of: DataFrame, marks: Marks) -> DataFrame:
        known = of.withColumn("_marks", marks.bits)
        made = _windows(F.col("t"), window, lengths, marks._replace(bits=F.col("_marks")))
        return known.select("_key", "id", F.explode(made).alias("w")).select(
            "_key", "id", F.col("w.p").alias("dp"), "w.hash", "w.n", F.col("w.slots").alias("of_doc")
        )

    bringing = wanted.where("brings").drop("brings")
    places = windows(docs, Marks.of(bringing))
    bringing = bringing.drop("mark")
    blocks = -(-bringing.count() // MAX_BLOCK) or 1
    parts = [
        _equal(places, F.broadcast(
            bringing.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == b) if blocks > 1 else bringing
        ), ["hash", "n"])
        for b in range(blocks)
    ]
    found = store.put("hits", reduce(DataFrame.unionByName, parts))
    others = wanted.where("NOT brings").drop("brings")
    marks = Marks.of(others)
    others = others.drop("mark")
    if others.isEmpty():
        return found
    met = store.put("met", found.select("_key", "item").distinct().join(
        others.select("item").distinct(), "item", "left_semi"))
    again = docs.join(met.select("_key").distinct(), "_key", "left_semi").dropDuplicates(["_key"])
    more = windows(again, marks).join(met, "_key")
    return found.unionByName(store.put("more_hits", _equal(more, others, ["item", "hash", "n"])))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 8,
    min_share: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, ``item_id``, ``share`` of the item's words, ``verbatim`` and ``_key``."""
    store = Store(docs.sparkSession)
    keyed = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("t")) \
        .where("t IS NOT NULL AND t <> ''").withColumn("_key", row_key("id", "t"))
    items = store.put(
        "items", _items(benchmark).withColumn("item", F.monotonically_increasing_id())
    )
    table = hits(keyed, items, window, min_share, store)

    # Each shift between a document and an item is an alignment of its own.
    equal = F.forall("pairs", lambda v: v["of_item"] == v["of_doc"])
    shifts = table.withColumn("equal", equal).groupBy("_key", "id", "item", "shift").agg(
        F.collect_set(F.when(F.col("equal"), F.col("ip"))).alias("equal"),
        F.collect_set(F.when(~F.col("equal"), F.col("ip"))).alias("other"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("equal"), F.col("pairs"))))).alias("pairs"),
    )

    def kinds(side: str) -> Column:
        return F.size(F.array_distinct(F.transform("pairs", lambda v: v[side])))

    consistent = (kinds("of_item") == F.size("pairs")) & (kinds("of_doc") == F.size("pairs"))
    counted = shifts.withColumn("other", F.when(consistent, F.col("other")).otherwise(F.array()))
    places = F.array_distinct(F.flatten(F.transform(
        F.array_union("equal", "other"), lambda p: F.sequence(p, F.least(p + window, F.col("length")) - 1)
    )))
    aligned = counted.where((F.size("equal") > 0) | (F.size("other") > 0)).join(items.drop("t"), "item").select(
        "_key", "id", "item", "item_id", "length", places.alias("places"),
        (F.size("other") == 0).alias("same"),
    )
    judged = aligned.groupBy("_key", "id", "item", "item_id", "length").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
        F.min("same").alias("verbatim"),
    ).withColumn("share", F.col("covered") / F.col("length"))
    best = judged.where(F.col("share") >= min_share).groupBy("_key", "id", "item_id").agg(
        F.round(F.max("share"), 6).alias("share"), F.max("verbatim").alias("verbatim")
    )
    return best.select(F.col("id").alias(key), "item_id", "share", "verbatim", "_key")


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that hold no item, with all their columns as they are."""
    leaked = leaks(docs, benchmark, key=key, text=text).select("_key").distinct()
    # One plan at all sizes: the leaks of a large corpus outgrow any broadcast.
    kept = boxed(docs, key, text).join(leaked.hint("merge"), "_key", "left_anti")
    return unboxed(kept, docs.columns)
