"""Benchmark decontamination by template canonicalisation.

Words become template tokens: a word with a digit is a number, a word after a
number that names a unit is a unit, a capitalised word (of any script) inside a
sentence is a name; all others are themselves, A-Z lower-cased, without
surrounding ASCII punctuation.  A capitalised word that opens a sentence may be
a name or not: windows that hold such words are taken twice, with all of them
as names and with none.  Windows of template tokens are hash-joined between
documents and benchmark items (an item shorter than a window is one window of
its length).  The joined windows are then checked for slot consistency: within
an occurrence one value of an item's slot must always stand for the same value.
Occurrences are the windows of one text at one distance from the item's, those
at distances of up to ``GAP`` apart (words put in or left out), and all of the
document.  A pair is reported when the consistent windows of one of them cover
at least ``least_share`` of the item's, as ``exact`` (all slots equal) or
``reparameterised``, whichever holds for the best occurrence.

Changed values alone are no evidence, as in some languages every noun has a
capital: an occurrence counts as re-parameterised only if a number changed, or
a value that stands at two places of the item or more.  Without that only its
equal windows count.

No window is left out.  Every window is also joined by its words as they are,
which finds equal windows whatever their slots and the words before them; with
``fold_case`` in any case of A-Z (as the query and the pipeline do).  With changed values a window
is a join key from ``least_key`` plain words on (so lists of names or numbers
match only as they are), and the windows matched must together hold
``least_plain`` plain words of the item, in items under twice that length half
of its words, at least ``least_key``.  The share is taken over all windows of
the item and over those of ``least_plain`` plain words (all, in a shorter one);
the larger counts.

A window that many items and many documents have does not bring all of them
together.  A reported pair shares so many of the item's windows that it shares
one of the rarest of them, counted by items: with ``m`` of ``n`` needed, one of
any ``n - m + 1``.  Pairs come from these alone; only then all windows of the
pair are joined.  Windows of documents that occur in no item are dropped before
the shuffle while the item windows are few (``MAX_LOCAL``, counted first);
beyond that a join drops them.

Defined results: null or empty texts match nothing; very long texts are taken
whole; items of under ``least_item`` tokens match only as they are; rows with a
null doc_id or item_id are not reported; rows that repeat an id are one document
or item with the windows of each; an empty table on either side gives no pair;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WINDOW = 8
LEAST_PLAIN = 5
LEAST_KEY = 3
LEAST_ITEM = 4
LEAST_SHARE = 0.5
GAP = 4
MAX_LOCAL = 2_000_000

# fixed values: unit words after a number, in English and the languages around it
UNITS = ("kg g mg lb lbs oz km m cm mm mi ft in yd mph kph l ml s sec min h hr hrs day days week weeks month months "
         "year years hour hours minute minutes second seconds meter meters metre metres mile miles foot feet inch inches "
         "gram grams liter liters litre litres dollar dollars euro euros cent cents percent % degree degrees "
         "stunde stunden minuten sekunden tag tage woche wochen monat monate jahr jahre prozent grad "
         "heure heures seconde secondes jour jours semaine semaines mois an ans "
         "hora horas minuto minutos segundo segundos semana semanas mes meses por ciento "
         "кг г км м см мм л мин час часа часов минут минуты секунд секунды дней дня день недель недели лет года год "
         "рублей рубля долларов доллара процентов процента").split()

NUMBER, UNIT, NAME = 1, 2, 3
SLOT_CODE = C.mix(np.arange(4, dtype=np.uint64) + np.uint64(901))
AS_IS = np.uint64(1 << 32)
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
UNIT_CODES = np.sort(np.array([int(C.Stretches(C.BYTE_CODES[np.frombuffer(u.encode(), np.uint8)]).hash(
    np.array([0]), np.array([len(u)]))[0]) for u in UNITS], np.uint64))


#: Which of the first 65,536 code points are capitals.
CAPITAL = np.array([chr(c).isupper() for c in range(1 << 16)])


ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?:"]] = True


def capitals(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a capital starts at bytes ``at`` (characters above 65,535 are none)."""
    first = b[at]
    out = CAPITAL[first] & (first < 0x80)
    wide = np.flatnonzero((first >= 0xC0) & (first < 0xF0))
    if len(wide):
        one, two, three = (b[np.minimum(at[wide] + k, len(b) - 1)].astype(np.int64) for k in range(3))
        out[wide] = CAPITAL[np.where(one < 0xE0, (one & 0x1F) << 6 | two & 0x3F,
                                     (one & 0x0F) << 12 | (two & 0x3F) << 6 | three & 0x3F)]
    return out


def trimmed(b: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without up to 8 marks at the end, then at the start; one byte stays."""
    s, e = s.copy(), e.copy()
    for ends in (True, False):
        left = np.arange(len(s))
        for _ in range(8):
            left = left[(e[left] - s[left] > 1) & PUNCTUATION[b[e[left] - 1 if ends else s[left]]]]
            if not len(left):
                break
            if ends:
                e[left] -= 1
            else:
                s[left] += 1
    return s, e


def template(data: bytes, fold_case: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token codes, slot kind (0: plain), value code and code as it is of every word; the plain ones that may be names."""
    b, starts, ends = C.word_spans(data)
    if not len(starts):
        return np.empty(0, C.U64), np.empty(0, np.int8), np.empty(0, C.U64), np.empty(0, C.U64), np.empty(0, bool)
    s, e = trimmed(b, starts, ends)
    value = C.Stretches(C.BYTE_CODES[LOWER[b]]).hash(s, e)
    number, unit, opens = (np.zeros(len(s), bool) for _ in range(3))
    digits = np.flatnonzero((b >= 48) & (b <= 57))
    if len(digits):
        number = np.searchsorted(digits, e) > np.searchsorted(digits, s)
        after = np.flatnonzero(number[:-1] & ~number[1:]) + 1
        unit[after] = UNIT_CODES[np.minimum(np.searchsorted(UNIT_CODES, value[after]), len(UNIT_CODES) - 1)] == value[after]
    capital = capitals(b, s)
    opens[0] = True
    opens[1:] = ENDS[b[ends[:-1] - 1]]
    line = np.searchsorted(starts, np.flatnonzero(b == 10))  # the word after every line's end
    opens[line[line < len(s)]] = True
    kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(capital & ~opens, NAME, 0))).astype(np.int8)
    word = value if fold_case else C.Stretches(C.BYTE_CODES[b]).hash(s, e)
    return np.where(kind > 0, SLOT_CODE[kind], value), kind, value, word, capital & (kind == 0)


def windows(data: bytes, sizes, least_key: int, least_item: int, fold_case: bool):
    """(hash, start, size, as it is, opened) of all windows, with slot kinds and values of the words.

    ``opened``: the window's words that open a sentence with a capital are taken as names.
    """
    code, kind, value, word, maybe = template(data, fold_case)
    named = np.where(maybe, SLOT_CODE[NAME], code)
    prefix, names, words = C.Stretches(code), C.Stretches(named), C.Stretches(word)
    slots, openers = (np.concatenate(([0], np.cumsum(x))) for x in (kind > 0, maybe))
    out = []

    def add(of, at, size, as_is, opened):
        h = (of.sums[at + size] - of.sums[at]) * of.inv[at]
        out.append((C.mix(h + np.uint64(size) + (AS_IS if as_is else np.uint64(0))), at, np.full(len(at), size),
                    np.full(len(at), as_is), np.full(len(at), opened)))

    for size in sizes:
        if len(code) >= size:
            at = np.arange(len(code) - size + 1)
            add(words, at, size, True, False)
            if size >= least_item:
                plain = size - (slots[size:] - slots[:-size])
                may = openers[size:] - openers[:-size]
                add(prefix, at[plain >= least_key], size, False, False)
                add(names, at[(may > 0) & (plain - may >= least_key)], size, False, True)
    if not out:
        none = np.empty(0, np.int64)
        return np.empty(0, C.U64), none, none, np.empty(0, bool), np.empty(0, bool), kind, value, maybe
    return *(np.concatenate(x) for x in zip(*out)), kind, value, maybe


class Known:
    """Sorted window hashes with a table that tells most others apart by some
    bits.  The table is built once a task and travels with none."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.marked = hashes, None

    def __reduce__(self):
        return Known, (self.hashes,)

    def hits(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes) or not len(h):
            return np.empty(0, np.int64)
        if self.marked is None:
            self.bits = np.uint64((1 << max(16, int(len(self.hashes) * 16).bit_length())) - 1)
            self.marked = np.zeros(int(self.bits) + 1, bool)
            self.marked[self.hashes & self.bits] = True
        at = np.flatnonzero(self.marked[h & self.bits])
        return at[self.hashes[np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)] == h[at]]


def _window_rows(texts: DataFrame, sizes, least_plain: int, least_key: int, least_item: int, fold_case: bool,
                 known: Known | None, own_size: int | None):
    """(id, tag of the text, window, pos, as_is, base, informative, words, slots, spots, numeric, plain).

    ``slots`` are the value codes of the window's slots (none if it is taken as
    it is), ``spots`` their places, ``numeric`` whether they are numbers,
    ``plain`` the places of its plain words.  ``informative``: the template at
    that place has ``least_plain`` plain words; ``base``: this is that
    template, no opening word taken as a name.  ``own_size``: texts are items,
    each with windows of that size or, if shorter, one window of its whole
    length.
    """
    def rows(batch):
        out = {n: [] for n in ("id", "tag", "window", "pos", "as_is", "base", "informative", "words")}
        slots, spots, numeric, plain = [], [], [], []
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            use = sizes
            if own_size is not None:
                n = len(data.split())
                use = [min(own_size, n)] if min(own_size, n) in sizes else []
            h, at, size, as_is, opened, kind, value, maybe = windows(data, use, least_key, least_item, fold_case)
            if known is not None:
                hit = known.hits(h)
                h, at, size, as_is, opened = h[hit], at[hit], size[hit], as_is[hit], opened[hit]
            if not len(h):
                continue
            filled = np.concatenate(([0], np.cumsum(kind > 0)))
            rich = size - (filled[at + size] - filled[at]) >= np.minimum(size, least_plain)
            for name, v in (("id", np.full(len(h), i, np.int64)), ("tag", np.full(len(h), C.tag_of(data), np.int64)),
                            ("window", C.signed(h)), ("pos", at.astype(np.int64)), ("as_is", as_is),
                            ("base", rich & ~as_is & ~opened), ("informative", rich), ("words", np.full(len(h), len(kind), np.int64))):
                out[name].append(v)
            for a, n, x, m in zip(at.tolist(), size.tolist(), as_is.tolist(), opened.tolist()):
                slot = (kind[a:a + n] > 0) | maybe[a:a + n] if m else kind[a:a + n] > 0
                where = np.empty(0, np.int64) if x else np.flatnonzero(slot) + a
                slots.append(C.signed(value[where]).tolist())
                spots.append(where.tolist())
                numeric.append((kind[where] == NUMBER).tolist())
                plain.append((a + np.flatnonzero(~slot)).tolist())
        empty = {"as_is": bool, "base": bool, "informative": bool}
        return {n: np.concatenate(v) if v else np.empty(0, empty.get(n, np.int64)) for n, v in out.items()} | {
            "slots": pa.array(slots, pa.list_(pa.int64())), "spots": pa.array(spots, pa.list_(pa.int64())),
            "numeric": pa.array(numeric, pa.list_(pa.bool_())), "plain": pa.array(plain, pa.list_(pa.int64()))}

    return C.map_arrow(texts, rows, "id long, tag long, window long, pos long, as_is boolean, base boolean, "
                                    "informative boolean, words long, slots array<long>, spots array<long>, "
                                    "numeric array<boolean>, plain array<long>")


def rarest_windows(of_items: DataFrame, least_share: float) -> DataFrame:
    """(item_id, window): of every item the windows at the places of which any
    document that holds ``least_share`` of them has at least one.

    Places are taken by the number of items that share one of their windows,
    once among all and once among those of enough plain words.  An item's
    places are one group: the item's text bounds it.
    """
    items = of_items.select(F.col("id").alias("item_id"), "window", "pos", "informative").distinct()
    shared = items.groupBy("window").agg(F.countDistinct("item_id").alias("items"))
    places = (items.join(shared, "window").groupBy("item_id", "pos")
              .agg(F.max("items").alias("items"), F.max("informative").alias("rich")))
    of_item = Window.partitionBy("item_id")
    by_rarity = of_item.orderBy("items", "pos")

    def rare(chosen):
        n = F.sum(chosen.cast("int")).over(of_item)
        rank = F.sum(chosen.cast("int")).over(by_rarity.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        # one more than may be missing; at least one
        return chosen & (rank <= F.greatest(n - F.ceil(n * F.lit(least_share) - F.lit(1e-9)) + 1, F.lit(1)))

    kept = places.select("item_id", "pos", (rare(F.lit(True)) | rare(F.col("rich"))).alias("rare")).where("rare")
    return items.join(kept, ["item_id", "pos"]).select("item_id", "window").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE,
                 least_plain: int = LEAST_PLAIN, least_item: int = LEAST_ITEM, max_local: int = MAX_LOCAL,
                 least_key: int = LEAST_KEY, fold_case: bool = False) -> DataFrame:
    """(doc_id, item_id, matched, windows, share, kind): documents that hold a benchmark item."""
    C.prepare(docs.sparkSession)
    items = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    texts = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    words = F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    sizes = sorted(r.n for r in items.select(F.least(words, F.lit(window)).alias("n"))
                   .where("n > 0").distinct().collect())  # window values at most
    of_items = C.stored(_window_rows(items, sizes, least_plain, least_key, least_item, fold_case, None, window))
    distinct = of_items.select("window").distinct()
    known = None
    if distinct.limit(max_local + 1).count() <= max_local:
        # at most max_local hashes of 8 bytes go with the tasks
        known = Known(np.sort(np.array([r.window for r in distinct.toLocalIterator()], np.int64).view(C.U64)))
        sizes = sizes if len(known.hashes) else []
    of_docs = _window_rows(texts, sizes, least_plain, least_key, least_item, fold_case, known, None)
    if known is None:
        of_docs = of_docs.join(distinct, "window", "left_semi")
    of_docs = C.stored(of_docs.select(F.col("id").alias("doc_id"), "tag", F.col("pos").alias("at"), "window",
                                      F.col("base").alias("plainly"), F.col("slots").alias("here")).distinct())
    totals = of_items.groupBy(F.col("id").alias("item_id")).agg(
        F.countDistinct("pos").alias("windows"), F.countDistinct(F.when(F.col("informative"), F.col("pos"))).alias("rich"),
        F.max("words").alias("words"))
    likely = C.stored(of_docs.select("doc_id", "window").distinct().join(rarest_windows(of_items, least_share), "window")
                      .select("doc_id", "item_id").distinct())
    pairs = C.stored(likely.join(of_items.select(F.col("id").alias("item_id"), "window", "pos", F.col("slots").alias("there"),
                                                 "spots", "numeric", "informative", "plain", "base"), "item_id")
                     .join(of_docs, ["doc_id", "window"]))
    # templates of enough plain words also count by themselves, undisturbed by the others
    pairs = pairs.withColumn("apart", F.explode(F.when(F.col("plainly") & F.col("base"), F.array(F.lit(False), F.lit(True)))
                                                .otherwise(F.array(F.lit(False)))))
    # two distances of up to GAP apart share one of the overlapping spans of 2 * GAP
    off = F.col("at") - F.col("pos")
    spans = [F.floor((off + k) / (2 * GAP)).cast("long") for k in (0, GAP)]
    places = [(F.lit(0), F.lit(0), F.lit(0)), *((F.lit(k + 1), F.col("tag"), v) for k, v in enumerate([off, *spans]))]
    pairs = pairs.withColumn("place", F.explode(F.array(*(F.array(*(v.cast("long") for v in x)) for x in places))))
    group = ["doc_id", "item_id", "apart", "place"]
    # one value of an item must stand for one value in the document
    meaning = (pairs.where(F.size("there") > 0)
               .select(*group, F.explode(F.arrays_zip("there", "here", "spots", "numeric")).alias("s"))
               .groupBy(*group, F.col("s.there").alias("value"))
               .agg(F.countDistinct("s.here").alias("meanings"), F.countDistinct("s.spots").alias("spots"),
                    F.max("s.numeric").alias("numeric"), F.max(F.col("s.there") != F.col("s.here")).alias("changed")))
    slots = meaning.groupBy(*group).agg(
        F.max("meanings").alias("meanings"), F.max("changed").alias("changed"),
        F.max(F.col("changed") & (F.col("numeric") | (F.col("spots") > 1))).alias("evident"))
    same = (F.col("here") == F.col("there")).cast("int")
    matched = (pairs.groupBy(*group, "pos").agg(
        F.max(same).alias("same"), F.max(F.col("informative").cast("int")).alias("of_rich"),
        F.flatten(F.collect_set("plain")).alias("plain"))
        .groupBy(*group).agg(
            F.count("*").alias("matched"), F.sum("same").alias("same"), F.sum("of_rich").alias("rich_matched"),
            F.sum(F.col("same") * F.col("of_rich")).alias("rich_same"),
            F.size(F.array_distinct(F.flatten(F.collect_set("plain")))).alias("covered")))
    found = matched.join(totals, "item_id").join(slots, group, "left")
    need = F.greatest(F.lit(least_key), F.least(F.lit(least_plain), F.ceil(F.col("words") / 2)))
    other = F.coalesce("changed", F.lit(False))
    consistent = (F.coalesce("meanings", F.lit(1)) <= 1) & (~other | (F.col("evident") & (F.col("covered") >= need)))
    # other pairs can still hold the item itself: their equal windows count
    counted = F.when(consistent, F.col("matched")).otherwise(F.col("same"))
    rich = F.when(consistent, F.col("rich_matched")).otherwise(F.col("rich_same"))
    of_all, of_rich = counted / F.col("windows"), F.when(F.col("rich") > 0, rich / F.col("rich"))
    best = F.when(of_rich > of_all, F.struct(of_rich.alias("share"), rich.alias("matched"), F.col("rich").alias("windows"))
                  ).otherwise(F.struct(of_all.alias("share"), counted.alias("matched"), F.col("windows").alias("windows")))
    passed = found.select("doc_id", "item_id", best.alias("b"), (~(consistent & other)).alias("exact"))
    return (passed.where(F.col("b.share") >= least_share).groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("b.share", "exact", "b.matched", "b.windows")).alias("b"))  # of the best occurrence
            .select("doc_id", "item_id", "b.matched", "b.windows", F.round("b.share", 6).alias("share"),
                    F.when(F.col("b.exact"), "exact").otherwise("reparameterised").alias("kind")))


def op7_template_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item."""
    return contaminated(C.read(spark, sf_dir, "documents").select("doc_id", "text"), C.read(spark, sf_dir, "benchmark"),
                        fold_case=True)
