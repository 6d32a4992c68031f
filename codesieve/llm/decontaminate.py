"""Benchmark decontamination by templates: finds passages of a benchmark even where numbers, names or units were changed.

Texts are cut into words; numbers, names (capitalised within a sentence) and units (after a number) become typed
placeholders, all else a lower-case literal. Windows of ``span`` such tokens are hashed and joined with those of the
benchmark, and equal templates are confirmed. Matches on one diagonal (same distance between the places in document and
item) are one alignment. Its most frequent mapping gives each value of the item the value of the document that stands for
it in most slots, and each name of the document to one name of the item only. A window counts if its slots agree with that
mapping or hold the item's own value; windows that do not are dropped by themselves. A document is contaminated by an item
when the windows that count cover at least ``coverage`` of the item's windows.

Template windows with fewer than ``literals`` literals are no evidence and left out of both sides. Beside the templates,
windows of the words as they are (letters folded) are joined in the same way, whatever kinds of words they hold: an item of
names, capitals or numbers only, which no template represents, is found where it stands word for word. An item shorter than
a window is one window of its own length; one of fewer than ``literals`` words is compared with whole documents only, for so
few words stand in many texts by chance.

Documents are read once. A bit map of fixed size over the benchmark's hashes goes to all executors; only windows whose
bit is set leave the task, and the join decides. A large benchmark makes the map less selective, not the result wrong.

Defined results: null and empty texts match nothing; rows with the same id and text are one document, rows with the
same id and another text are judged by themselves; items are told apart by id and text; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm import bytetext
from codesieve.llm.store import Store, let

SPAN = 10
LITERALS = 5
COVERAGE = 0.5
#: Bits of the map over the benchmark's window hashes.
MAP_BITS = 1 << 24

LITERAL, NUMBER, NAME, UNIT = range(4)
MARKS = ("", "<number>", "<name>", "<unit>")

#: Words that are units when they follow a number.
UNITS = (
    "percent cent cents dollar dollars euro euros pound pounds second seconds minute minutes hour hours day days week weeks "
    "month months year years mm cm m km meter meters metre metres kilometer kilometers inch inches foot feet yard yards mile "
    "miles mg g kg gram grams kilogram kilograms ton tons ounce ounces lb lbs ml l liter liters litre litres gallon gallons "
    "cup cups degree degrees celsius fahrenheit watt watts volt volts byte bytes kb mb gb mph "
    "prozent sekunde sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren "
    "kilometern metern zentimeter gramm kilogramm kilo tonne tonnen grad "
    "seconde secondes heure heures jour jours semaine semaines mois an ans année années mètre mètres kilomètre kilomètres "
    "gramme grammes kilogramme kilogrammes litre litres degré degrés "
    "ciento segundo segundos minuto minutos hora horas día días semana semanas mes meses año años metro metros kilómetro "
    "kilómetros gramo gramos kilogramo kilogramos litro litros grado grados dólar dólares libra libras € £ °c °f"
).split()

_UNIT_HASHES = np.sort(
    np.concatenate(
        [
            bytetext.word_hashes(np.frombuffer(u.encode(), np.uint8), np.array([0]), np.array([len(u.encode())]))
            for u in UNITS
        ]
    )
)
_MARK_HASHES = bytetext.mix(np.arange(1, 5, dtype=np.uint64))

WINDOWS = "id long, text_key long, plain boolean, place int, span int, hash long, template string, slots array<string>, kinds array<int>, offsets array<int>"
WINDOW_NAMES = ["id", "text_key", "plain", "place", "span", "hash", "template", "slots", "kinds", "offsets"]
WINDOW_KINDS = [
    pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()),
    pa.list_(pa.int32()), pa.list_(pa.int32()),
]


class Tokens:
    """The canonical tokens of the documents of a slice."""

    def __init__(self, part: bytetext.Slice):
        raw = part.data
        after = np.append(raw[1:], 0) if len(raw) else raw
        before = np.insert(raw[:-1], 0, 0) if len(raw) else raw
        digit = (raw >= 48) & (raw <= 57)
        upper = (raw >= 65) & (raw <= 90)
        accented = (raw == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
        self.data = bytetext.LOWER[raw]
        self.data[np.flatnonzero(accented) + 1] += 0x20
        word = digit | upper | ((raw >= 97) & (raw <= 122)) | (raw >= 0x80)
        digits_around = np.append(digit[1:], False) & np.insert(digit[:-1], 0, False) if len(raw) else digit
        word |= ((raw == 46) | (raw == 44)) & digits_around
        # Dashes, quotes and dots of the general punctuation block are three bytes that begin with these two.
        quote = np.flatnonzero((raw == 0xE2) & (after == 0x80))
        for k in range(3):
            word[np.minimum(quote + k, len(raw) - 1)] = False
        self.begin, self.stop = bytetext.word_bounds(part, word)
        self.low = np.searchsorted(self.begin, part.starts)
        self.high = np.searchsorted(self.begin, part.ends)
        hashes = bytetext.word_hashes(self.data, self.begin, self.stop)
        ends = (raw == 46) | (raw == 33) | (raw == 63) | (raw == 58) | (raw == 10)
        ends &= ~word
        sums = np.concatenate([[0], np.cumsum(ends)])
        gap_start = np.concatenate([[0], self.stop[:-1]]) if len(self.begin) else self.begin
        opens = sums[self.begin] > sums[gap_start]
        first = self.low[self.high > self.low]
        opens[first] = True
        count = np.concatenate([[0], np.cumsum(digit)])
        number = count[self.stop] > count[self.begin]
        follows = np.zeros(len(number), bool)
        follows[1:] = number[:-1]
        follows[first] = False
        at = np.minimum(np.searchsorted(_UNIT_HASHES, hashes), len(_UNIT_HASHES) - 1)
        unit = follows & (_UNIT_HASHES[at] == hashes)
        name = (upper | accented)[self.begin] & ~opens if len(self.begin) else number
        self.kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, LITERAL)))
        self.canonical = np.where(self.kind == LITERAL, hashes, _MARK_HASHES[self.kind])
        self.hashes = hashes
        self.literals = np.concatenate([[0], np.cumsum(self.kind == LITERAL)])

    def word(self, k: int) -> str:
        return self.data[self.begin[k] : self.stop[k]].tobytes().decode("utf-8", "replace")

    def window(self, k: int, span: int, plain: bool) -> tuple[str, list[str], list[int], list[int]]:
        """Template, slot values, their kinds and their places in the window at token ``k``; a plain one has no slots."""
        kinds = self.kind[k : k + span].tolist()
        words = [self.word(j) for j in range(k, k + span)]
        if plain:
            return " ".join(words), [], [], []
        template = " ".join(w if kind == LITERAL else MARKS[kind] for w, kind in zip(words, kinds))
        filled = [j for j, kind in enumerate(kinds) if kind != LITERAL]
        return template, [words[j] for j in filled], [kinds[j] for j in filled], filled


def _window_rows(spans: dict[bool, list[int]], literals: int, bits: np.ndarray | None) -> Callable:
    """Rows of windows, of templates and plain (the keys of ``spans``): of all (no map; each text has the one span of a kind
    that suits it) or of those whose bit is set."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("id").to_pylist(), batch.column("text_key").to_pylist()
            for part in bytetext.slices(batch.column("text")):
                tokens = Tokens(part)
                rows = []
                for plain, span in sorted((kind, span) for kind, some in spans.items() for span in some):
                    hashes = bytetext.window_hashes(tokens.hashes if plain else tokens.canonical, span)
                    enough = np.ones(len(hashes), bool)
                    if plain:
                        hashes = bytetext.mix(hashes)
                    elif len(hashes):
                        enough = tokens.literals[span:] - tokens.literals[:-span] >= literals
                    if bits is not None:
                        place = (hashes % np.uint64(len(bits) * 8)).astype(np.int64)
                        enough = enough & ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)
                    for k in np.flatnonzero(enough).tolist():
                        doc = int(np.searchsorted(tokens.high, k, "right"))
                        length = tokens.high[doc] - tokens.low[doc]
                        if k + span > tokens.high[doc] or (bits is None and span != min(max(spans[plain]), length)):
                            continue
                        if plain and span < literals and span != length:
                            continue
                        row = part.first + doc
                        window = tokens.window(k, span, plain)
                        signed = int(hashes[k : k + 1].view(np.int64)[0])
                        rows.append((ids[row], keys[row], plain, k - int(tokens.low[doc]), span, signed, *window))
                if rows:
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), WINDOW_KINDS)]
                    yield pa.RecordBatch.from_arrays(columns, WINDOW_NAMES)

    return windows


def _texts(df: DataFrame, id_column: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return df.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _bit_map(windows: DataFrame, bits: int) -> np.ndarray:
    """The map of the windows' hashes; what comes to the driver is at most the map itself, page by page."""
    page = 1 << 13
    unsigned = F.pmod(F.col("hash").bitwiseAND(bits - 1), F.lit(bits))  # the number of bits is a power of two
    places = windows.select(unsigned.alias("place")).distinct()
    pages = places.groupBy(F.floor(F.col("place") / page).alias("page")).agg(
        F.collect_list(F.pmod("place", F.lit(page)).cast("int")).alias("set")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in pages.toLocalIterator():
        place = np.array(row["set"], np.int64) + row["page"] * page
        np.bitwise_or.at(out, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return out


def _counting(windows: Column) -> Column:
    """Those windows of an alignment whose slots agree with its mapping; all of them if nothing is contradicted."""
    same = lambda p: p["theirs"] == p["ours"]

    def contradict(p: Column, q: Column) -> Column:
        other = (p["theirs"] == q["theirs"]) & (p["ours"] != q["ours"])
        merged = (p["kinds"] == NAME) & (p["ours"] == q["ours"]) & (p["theirs"] != q["theirs"])
        return (p["kinds"] == q["kinds"]) & (other | merged)

    def agreeing(ranked: Column) -> Column:
        """``ranked`` has every pair with the number of its slots, doubled, and one more if its value is unchanged."""
        beaten = lambda a: F.exists(ranked, lambda b: contradict(a["pair"], b["pair"]) & (b["n"] > a["n"]))
        pairs_of = lambda found: F.transform(found, lambda a: a["pair"])
        bad, top = pairs_of(F.filter(ranked, beaten)), pairs_of(F.filter(ranked, lambda a: ~beaten(a)))
        level = let(top, lambda t: F.exists(t, lambda p: F.exists(t, lambda q: contradict(p, q))))
        changed = F.filter(pairs_of(ranked), lambda p: ~same(p))
        return let(
            F.when(level, changed).otherwise(F.filter(bad, lambda p: ~same(p))),
            lambda out: F.filter(windows, lambda w: ~F.arrays_overlap(w["slots"]["pair"], out)),
        )

    def ranks(slots: Column) -> Column:
        slot_pairs = F.transform(slots, lambda s: s["pair"])
        held = lambda p: F.size(F.filter(slot_pairs, lambda q: q == p))
        return F.transform(
            F.array_distinct(slot_pairs), lambda p: F.struct(p.alias("pair"), (2 * held(p) + same(p).cast("int")).alias("n"))
        )

    def checked(slots: Column) -> Column:
        pairs = F.array_distinct(F.transform(slots, lambda s: s["pair"]))
        names = F.filter(pairs, lambda p: p["kinds"] == NAME)
        given = F.transform(pairs, lambda p: F.struct(p["kinds"], p["theirs"]))
        one_each = F.size(F.array_distinct(given)) == F.size(pairs)
        no_merged = F.size(F.array_distinct(F.transform(names, lambda p: p["ours"]))) == F.size(names)
        return F.when(one_each & no_merged, windows).otherwise(let(ranks(slots), agreeing))

    return let(F.array_distinct(F.flatten(F.transform(windows, lambda w: w["slots"]))), checked)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = SPAN,
    literals: int = LITERALS,
    coverage: float = COVERAGE,
    map_bits: int = MAP_BITS,
) -> DataFrame:
    """Contaminated documents: ``doc_id, text_key, item_id, n_windows, n_matched, n_slots, n_changed, kind``.

    ``docs`` has ``doc_id, text``, ``benchmark`` ``item_id, text``. Writes the benchmark's windows to the shared folder
    and fetches their bit map when it is called.
    """
    store = Store(docs.sparkSession, "decontaminate")
    texts = _texts(benchmark, "item_id").distinct()
    wanted = {False: list(range(literals, span + 1)), True: list(range(1, span + 1))}
    items = store.keep(texts.mapInArrow(_window_rows(wanted, literals, None), WINDOWS), "items")
    spans: dict[bool, list[int]] = {}
    for kind, length in items.select("plain", "span").distinct().collect():
        spans.setdefault(kind, []).append(length)
    sizes = items.groupBy("id", "text_key", "plain").agg(F.count("*").alias("n_windows"))
    items = items.join(sizes, ["id", "text_key", "plain"])
    bits = docs.sparkSession.sparkContext.broadcast(_bit_map(items, map_bits))

    def windows(batches):
        return _window_rows(spans, literals, bits.value)(batches)

    found = _texts(docs, "doc_id").mapInArrow(windows, WINDOWS).distinct()
    right = [F.col(c).alias(f"item_{c}") for c in ("id", "text_key", "place", "slots")]
    met = found.join(items.select("plain", "hash", "span", "template", "n_windows", *right), ["plain", "hash", "span", "template"])
    slots = F.arrays_zip("kinds", F.col("item_slots").alias("theirs"), F.col("slots").alias("ours"), "offsets")
    placed = F.transform(
        slots,
        lambda s: F.struct(
            (F.col("item_place") + s["offsets"]).alias("at"),
            F.struct(s["kinds"].alias("kinds"), s["theirs"].alias("theirs"), s["ours"].alias("ours")).alias("pair"),
        ),
    )
    pair = ["id", "text_key", "item_id", "item_text_key"]
    aligned = (
        met.groupBy(*pair, "plain", "n_windows", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.collect_list(F.struct("item_place", placed.alias("slots"))).alias("windows"))
    )
    per_item = (
        aligned.select(*pair, "plain", "n_windows", _counting(F.col("windows")).alias("windows"))
        .groupBy(*pair, "plain", "n_windows")
        .agg(F.flatten(F.collect_list("windows")).alias("windows"))
        .select(
            "*",
            F.size(F.array_distinct("windows.item_place")).cast("long").alias("n_matched"),
            F.array_distinct(F.flatten(F.transform("windows", lambda w: w["slots"]["pair"]))).alias("pairs"),
        )
    )
    changed = F.size(F.filter("pairs", lambda p: p["theirs"] != p["ours"])).cast("long")
    enough = per_item.where(F.col("n_matched") >= coverage * F.col("n_windows")).select(
        *pair, F.struct("plain", "n_windows", "n_matched", F.size("pairs").cast("long").alias("n_slots"), changed.alias("n_changed")).alias("f")
    )
    # What the templates say holds; the plain windows speak where these do not.
    told = enough.groupBy(*pair).agg(F.min("f").alias("f"))
    return told.select(
        F.col("id").alias("doc_id"),
        "text_key",
        "item_id",
        "f.n_windows",
        "f.n_matched",
        "f.n_slots",
        "f.n_changed",
        F.when(F.col("f.n_changed") > 0, "reparameterised").otherwise("copy").alias("kind"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = matches(docs, benchmark, **limits).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_key"])
    return docs.join(bad, same, "left_anti")
