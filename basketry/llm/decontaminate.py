"""Benchmark decontamination by template windows.

* Canonical form: words are runs of non-white ASCII characters, without the signs around them, lower-
  cased; a word of signs only counts for nothing. Numbers (digits or number words) become the placeholder
  of numbers, measures the one of units, capitalised words inside a sentence the one of names. The value
  of a slot is the word it replaced. A capitalised word that begins a sentence may be a name or not: windows that
  hold it are made both ways, in texts and items.
* Template windows: every run of ``WIDTH`` words of an item, and of a text. A window with fewer than
  ``LITERAL`` words left keeps all its values, so that runs of numbers do not match each other. Items of
  fewer words are one window of their own length, kept literal.
* A fixed-size bitmap of the items' window hashes (at most ``2**BITMAP_BITS`` bits, whatever the number
  of items) goes to the tasks; windows of texts that pass it are joined with the items' windows on the
  hash. The bitmap only saves work: what passes by chance finds no partner.
* Slots: windows of one text and item that lie on one diagonal (same distance of positions) must map the
  item's values to the text's one to one. Windows on diagonals that do not are not counted; if only words that
  begin sentences break it, the windows that take these for names are not.
* A text is contaminated by an item when at least ``share`` of the item's words lie in windows counted, or are
  the same literal words less than ``WIDTH`` words from one on its diagonal: a changed word costs itself only.

Null ids are kept; rows with the same id and text are one; null or empty texts and items match nothing;
an empty table gives an empty result. Columns other than those named are ignored. Every text is read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import WordTable, bitmap, in_bitmap, kept, mix, ship
from basketry.llm.tokens import parts_of
from basketry.session import materialise

WIDTH, LITERAL, SHARE = 5, 3, 0.8
BITMAP_BITS = 24
#: Characters of texts that are described at once.
AT_ONCE = 1 << 18

# Number words and units of measure in the languages of the data.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "billion "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante "
    "cinquante soixante cent cents mille millions milliard milliards "
    "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn "
    "achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen "
    "milliarde milliarden "
    "cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete "
    "dieciocho diecinueve veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil millón "
    "millones".split()
)
UNITS = frozenset(
    "% mm cm dm m km mg g kg t ml cl l in ft yd mi oz lb lbs mph kmh s sec min h hr hrs kb mb gb tb hz khz mhz "
    "ghz w kw mw v kv a ma j kj cal kcal pa kpa °c °f usd eur gbp $ € £ inch inches foot feet yard yards mile "
    "miles ounce ounces pound pounds ton tons tonne tonnes liter liters litre litres gram grams kilogram "
    "kilograms meter meters metre metres kilometer kilometers kilometre kilometres second seconds minute minutes "
    "hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent "
    "degree degrees".split()
)

_SLOT_CODE = {kind: xxhash.xxh64_intdigest(f"slot {kind}") for kind in ("number", "unit", "name")}
_GLUED = re.compile(rb"[0-9][A-Za-z%\xc2\xe2]")
_GLUE = re.compile(rb"(?<=[0-9])(?=[A-Za-z%\xc2\xe2])")
_NUMBER = re.compile(r"[-+]?[0-9][0-9.,:/]*")
_EDGES = re.compile(r"^[^\w%$€£°]+|[^\w%$€£°]+$")
_CAPITAL, _ENDS, _SLOT, _SKIP = 1, 2, 4, 8


def _describe(raw: bytes) -> tuple[int, int, int]:
    """Hash of the value, code (the value's or its slot's) and flags of a word."""
    text = raw.decode("utf-8", "replace")
    bare = _EDGES.sub("", text)
    value = bare.lower()
    flags = _ENDS if text.rstrip("\"')]»”’").endswith((".", "!", "?", ":")) else 0
    code = xxhash.xxh64_intdigest(value)
    kind = None
    if not value:
        flags |= _SKIP
    elif _NUMBER.fullmatch(value) or value in NUMBER_WORDS:
        kind = "number"
    elif value in UNITS:
        kind = "unit"
    elif len(bare) > 1 and bare[0].isupper() and (bare[1:].islower() or bare.isalpha()):
        # Also in capitals only, and with further ones inside.
        flags |= _CAPITAL
    return code, _SLOT_CODE[kind] if kind else code, flags | (_SLOT if kind else 0)


def _words() -> WordTable:
    return kept("templates", lambda: WordTable(_describe, 3))


def canonical(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, codes and whether each is a slot, of the words of a text."""
    return described(text)[:3]


def described(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same, and whether each is a literal word that may be a name, since it begins a sentence."""
    return described_all([text])[:4]


def described_all(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """The same of several texts, one behind the other, and the number of the text of each word."""
    words, sizes = [], []
    for text in texts:
        raw = (text or "").encode()
        if _GLUED.search(raw):
            raw = _GLUE.sub(b" ", raw)
        split = raw.split()
        words += split
        sizes.append(len(split))
    found = _words().of(words)
    owner = np.repeat(np.arange(len(texts)), sizes)
    flags = found[:, 2].astype(np.uint8)
    fresh = np.ones(len(words), bool)
    if len(words):
        fresh[1:] = ((flags[:-1] & _ENDS) > 0) | (owner[1:] != owner[:-1])
    capital = (flags & _CAPITAL) > 0
    name = capital & ~fresh
    codes = np.where(name, np.uint64(_SLOT_CODE["name"]), found[:, 1])
    slots = name | ((flags & _SLOT) > 0)
    keep = (flags & _SKIP) == 0
    return found[keep, 0], codes[keep], slots[keep], (capital & ~slots)[keep], owner[keep]


def windows(values: np.ndarray, codes: np.ndarray, slots: np.ndarray, width: int, literal: bool) -> np.ndarray:
    """Hash of the template window that starts at each word."""
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if literal:
        use = np.ones(count, bool)
    else:
        held = np.concatenate([[0], np.cumsum(~slots)])
        use = held[width:] - held[:count] < min(LITERAL, width)
    template = _joined(codes, width, count, width)
    return np.where(use, _joined(values, width, count, width + 100), template) if use.any() else template


def _joined(codes: np.ndarray, width: int, count: int, seed: int) -> np.ndarray:
    total = np.full(count, seed, np.uint64)
    for i in range(width):
        total = (total ^ codes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return mix(total)


def name_windows(
    codes: np.ndarray, slots: np.ndarray, maybe: np.ndarray, width: int, within: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Starts, hashes and taken words (a row of the places in the window) of the windows that take some words that
    begin sentences for names; only of starts ``within``. Most windows have one such word: those with all of theirs
    taken come from one pass over all words, the others from their subsets."""
    count = len(codes) - width + 1
    if count <= 0 or not maybe.any():
        return
    held = np.concatenate([[0], np.cumsum(maybe)])
    held = held[width:] - held[:count]
    if within is not None:
        held = np.where(within, held, 0)
    literal = np.concatenate([[0], np.cumsum(~(slots | maybe))])
    starts = np.flatnonzero((held > 0) & (literal[width:] - literal[:count] >= min(LITERAL, width)))
    every = _joined(np.where(maybe, np.uint64(_SLOT_CODE["name"]), codes), width, count, width)
    yield starts, every[starts], maybe[starts[:, None] + np.arange(width)]
    starts = np.flatnonzero(held > 1)
    if not len(starts):
        return
    places = starts[:, None] + np.arange(width)
    codes, slots, maybe, held = codes[places], slots[places], maybe[places], held[starts]
    rank = np.where(maybe, np.cumsum(maybe, axis=1) - 1, 63)
    for subset in range(1, (1 << int(held.max())) - 1):
        taken = (subset >> rank) & 1 > 0
        use = (held >= subset.bit_length()) & (subset + 1 < (1 << held)) & ((~(slots | taken)).sum(axis=1) >= min(LITERAL, width))
        if use.any():
            named = np.where(taken[use], np.uint64(_SLOT_CODE["name"]), codes[use])
            total = np.full(len(named), width, np.uint64)
            for i in range(width):
                total = (total ^ named[:, i]) * np.uint64(0x9E3779B97F4A7C15)
                total ^= total >> np.uint64(29)
            yield starts[use], mix(total), taken[use]


def pieces(texts: list[str | None], width: int | None, known: np.ndarray | None = None) -> Iterator[tuple]:
    """Windows of several texts, of those ``known`` may hold: number of the text, its windows, and of each hash,
    width, start, values of slots, codes of the literal words around it (0 for others) and whether it takes the
    beginning of a sentence for a name. Without ``width`` of one text, windows of its own length if it is short."""
    values, codes, slots, maybe, owner = described_all(texts)
    width = width or min(WIDTH, len(values))
    count = len(values) - width + 1
    if not width or count <= 0:
        return
    found = windows(values, codes, slots, width, width < WIDTH)
    inside = owner[:count] == owner[width - 1 :]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    kinds = [(np.flatnonzero(inside), found[inside], None)]
    if width == WIDTH:
        kinds += list(name_windows(codes, slots, maybe, width, inside))
    signed, literal = values.view(np.int64), np.where(slots, np.uint64(0), codes).view(np.int64)
    reach = WIDTH - 1
    for starts, hashes, taken in kinds:
        for i in (range(len(hashes)) if known is None else np.flatnonzero(in_bitmap(known, hashes)).tolist()):
            at = int(starts[i])
            text = int(owner[at])
            first, last = int(bounds[text]), int(bounds[text + 1])
            held = slots[at : at + width] if taken is None else slots[at : at + width] | taken[i]
            before, after = literal[max(first, at - reach) : at], literal[at + width : min(last, at + width + reach)]
            around = [0] * (reach - len(before)) + before.tolist() + after.tolist() + [0] * (reach - len(after))
            n = last - first - width + 1
            yield text, n, int(hashes[i].astype(np.int64)), width, at - first, signed[at : at + width][held].tolist(), around, taken is not None


_WINDOW = "hash long, width int, at int, slots array<long>, around array<long>, loose boolean"
_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_()]


def _batch(rows: list[tuple], keys: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * (len(keys) + len(_TYPES))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, [*keys, *_TYPES], strict=True)], names=[*names, "hash", "width", "at", "slots", "around", "loose"]
    )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id, n_windows`` and the windows of every item."""

    ship(benchmark.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(item, *piece[1:]) for piece in pieces([text], None)]
            yield _batch(rows, [pa.int64(), pa.int32()], ["item_id", "n_windows"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return materialise(items.mapInArrow(cut, f"item_id long, n_windows int, {_WINDOW}"), "item-windows")


def text_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Windows of the texts that pass the bitmap of the items' windows."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(items.select("hash"), BITMAP_BITS))
    # At most WIDTH different widths.
    widths = sorted(r.width for r in items.select("width").distinct().collect())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            rows = []
            ids, keys, texts = (c.to_pylist() for c in batch.columns)
            for part in parts_of([t or "" for t in texts], AT_ONCE):
                mine, own = ids[part], keys[part]
                for width in widths:
                    rows += [(mine[i], own[i], *piece) for i, _, *piece in pieces(texts[part], width, known)]
                if len(rows) >= 20_000:
                    yield _batch(rows, [pa.int64(), pa.int64()], ["doc_id", "text_key"])
                    rows = []
            yield _batch(rows, [pa.int64(), pa.int64()], ["doc_id", "text_key"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(cut, f"doc_id long, text_key long, {_WINDOW}")


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, text_key, item_id, n_windows, matched, coverage, exact``: one row per text and item that
    reach ``share``; ``exact`` when all slots hold the item's own values."""
    items = item_windows(benchmark)
    left, right = text_windows(docs, items).alias("d"), items.alias("i")
    met = left.join(right, (F.col("d.hash") == F.col("i.hash")) & (F.col("d.width") == F.col("i.width")))
    pair = ["doc_id", "text_key", "item_id"]
    # Positions of the item beside the window where both have the same literal word.
    place = lambda k: F.col("i.at") + F.when(k < WIDTH - 1, k - (WIDTH - 1)).otherwise(k - (WIDTH - 1) + F.col("i.width"))
    alike = F.zip_with("i.around", "d.around", lambda x, y: (x == y) & (x != 0))
    beside = F.filter(F.transform(alike, lambda same, k: F.when(same, place(k))), lambda p: p.isNotNull())
    met = met.select(
        "d.doc_id",
        "d.text_key",
        "i.item_id",
        "i.n_windows",
        F.col("i.at").alias("at"),
        (F.col("d.at") - F.col("i.at")).alias("diagonal"),
        F.arrays_zip(F.col("i.slots").alias("theirs"), F.col("d.slots").alias("ours")).alias("slots"),
        (F.col("i.n_windows") + F.col("i.width") - 1).alias("n_words"),
        F.concat(F.sequence(F.col("i.at"), F.col("i.at") + F.col("i.width") - 1), beside).alias("words"),
        (F.col("d.loose") | F.col("i.loose")).alias("loose"),
    )
    # Positions and slot pairs of one diagonal are bounded by the item's length.
    def gathered(name: str) -> list[Column]:
        firm = F.when(~F.col("loose"), F.col(name))
        return [F.array_distinct(F.flatten(F.collect_set(c))).alias(to) for c, to in ((F.col(name), name), (firm, f"firm_{name}"))]

    places = [F.collect_set("at").alias("places"), F.collect_set(F.when(~F.col("loose"), F.col("at"))).alias("firm_places")]
    lines = met.groupBy(*pair, "diagonal").agg(
        F.max("n_windows").alias("n_windows"), F.max("n_words").alias("n_words"), *places, *gathered("slots"), *gathered("words")
    )

    def consistent(name: str) -> Column:
        theirs, ours = F.array_distinct(f"{name}.theirs"), F.array_distinct(f"{name}.ours")
        return (F.size(name) == F.size(theirs)) & (F.size(name) == F.size(ours))

    same = F.forall("slots", lambda s: s["theirs"] == s["ours"])
    every = consistent("slots")
    found = (
        lines.filter(every | consistent("firm_slots"))
        .select(*pair, "n_windows", "n_words", same.alias("same"), *[F.when(every, F.col(c)).otherwise(F.col(f"firm_{c}")).alias(c) for c in ("places", "words")])
        .groupBy(*pair)
        .agg(
            F.max("n_windows").alias("n_windows"),
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("matched"),
            F.bool_and("same").alias("exact"),
            (F.size(F.array_distinct(F.flatten(F.collect_set("words")))) / F.max("n_words")).alias("coverage"),
        )
    )
    return found.filter(F.col("coverage") >= share).select(*pair, "n_windows", "matched", "coverage", "exact")


def clean(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without the contaminated texts; all columns are kept."""
    found = materialise(contaminated(docs, benchmark, share).select("doc_id", "text_key").distinct(), "contaminated").alias("c")
    keyed = docs.alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64(F.col("d.text")) == F.col("c.text_key"))
    return keyed.join(found, same, "left_anti")
