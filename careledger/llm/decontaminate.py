"""Benchmark decontamination by template windows.

Texts are canonicalised: numbers, names and units become typed placeholders that keep their value
beside them, everything else lower-case words without punctuation. Windows of WINDOW tokens, with
values left out, are hashed and joined with the windows of the benchmark, so a question with other
numbers or names still meets its template. Then values are checked: within one alignment of a
document with an item, an item's value must always stand for the same value of the document. A
window without placeholders is evidence by itself.

Whether a capital starts a name can't be told where a sentence starts, so texts and items are read in three
forms, and windows of any two may meet: names as capitals inside a sentence, no names at all, and every
capital a name (each of a run by itself) but for FUNCTION words. Windows with fewer than LITERALS plain words
are too general for a template; those are searched in a fourth form, with all their values. Slots are checked
for each form of an item by itself.

A window holds each plain word of its template, so only windows that hold the longest word of some
benchmark window, its anchor, can meet one; and they hold the second longest as well, as many tokens away. Both are
bitmaps of fixed size: documents without such two words near each other are read once and left alone, and of the others
only windows around such a pair are hashed. Only windows that meet a benchmark window leave the map side.

Defined results: null and empty texts have no windows; an item shorter than WINDOW is one window of
its own length; items of fewer than LITERALS tokens say too little to be found; rows with one doc_id, or
without one, are reported under that id together; without items or documents there are no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import any_row, staged, text_of

WINDOW = 8
LITERALS = 4
# Windows of the benchmark up to which they are sent to every task; beyond, the join shuffles.
BROADCAST_WINDOWS = 500_000
# Bits of the map of anchors, and of that of their pairs.
ANCHOR_BITS = 1 << 20

# Units of measure and of money that may follow a number.
UNITS = (
    "kg", "g", "mg", "km", "m", "cm", "mm", "l", "ml", "kilograms?", "grams?", "kilomet(?:er|re)s?",
    "met(?:er|re)s?", "centimet(?:er|re)s?", "lit(?:er|re)s?", "miles?", "feet", "foot", "inch(?:es)?", "pounds?",
    "ounces?", "seconds?", "minutes?", "hours?", "days?", "weeks?", "months?", "years?", "percent", "degrees?",
    "dollars?", "euros?", "cents?", "usd", "eur", "mph", "kmh", "watts?", "volts?",
)
NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
# Any other capital: at the start of a sentence, or behind a name.
CAPITAL = "\u0004"
# A capital inside a sentence starts a name.
_NAMES = r"([\p{Ll}\p{N},;:]['’]? )(\p{Lu}\p{Ll}+)"
_CAPITALS = r"(?<![\p{L}\p{N}" + NAME + r"])(\p{Lu}\p{Ll}+)"
# Words that start sentences and are no names.
FUNCTION = (
    "a an the this that these those what which who whom whose when where why how if in on at of to for from by with "
    "as and or but so then there here it he she they we you i his her its their our my your is are was were do does "
    "did has have had can could will would should may might must each every all some any no not one two after before "
    "der die das ein eine wer wie wo wann warum welche welcher welches wenn und oder in im am an auf es er sie wir ist "
    "le la les un une des du qui que quel quelle quels quelles comment pourquoi quand si et ou il elle ils elles est "
    "el los las una uno quien cual como cuando donde por para se es y o qué quién cuál cómo cuándo dónde"
).split()
# Possessive, so that long lists of numbers are matched in a loop.
_NUMBERS = r"([0-9]++(?:[.,:/][0-9]++)*+)"
_UNITS = NUMBER + r"([0-9.,:/]+) +(" + "|".join(UNITS) + r")([^\p{L}\p{N}]|$)"
# Signs count as units only next to a number.
_BEHIND = NUMBER + r"([0-9.,:/]+) *[%€$£°]"
_BEFORE = r"[€$£] *" + NUMBER
_LOOSE = r"[.,:/]+([^0-9]|$)"
_SPLIT = r"[^\p{L}\p{N}" + NAME + NUMBER + UNIT + CAPITAL + r".,:/]+"
# What stands between the words of a text, where numbers are none.
_BETWEEN = r"[[^\p{L}\p{N}][0-9]]+"
# Texts whose words can't be told without their placeholders: they hold placeholders' own characters, or the
# letter whose lower case rests on what is beside it.
_ODD = "[" + NAME + NUMBER + UNIT + CAPITAL + "Σ]"
_SPLIT_WORDS = r"[^\p{L}\p{N}" + NAME + CAPITAL + r"]+"


def canonical(text: Column) -> Column:
    """The text with placeholders for names, and for numbers and units where it has digits."""
    marked = F.regexp_replace(text, _NAMES, "$1" + NAME + "$2")
    out = F.lower(F.regexp_replace(marked, _CAPITALS, CAPITAL + "$1"))
    numbered = F.regexp_replace(out, _NUMBERS, f" {NUMBER}$1 ")
    numbered = F.regexp_replace(numbered, _BEHIND, f"{NUMBER}$1 {UNIT}sign ")
    numbered = F.regexp_replace(numbered, _BEFORE, f" {UNIT}sign {NUMBER}")
    numbered = F.regexp_replace(numbered, _UNITS, f"{NUMBER}$1 {UNIT}$2 $3")
    return F.when(text.rlike("[0-9]"), F.regexp_replace(numbered, _LOOSE, " $1")).otherwise(out)


def with_tokens(rows: DataFrame, text: Column) -> DataFrame:
    """rows with _tokens (words and placeholders; a placeholder is its type's character, then its
    value), _single (whether there are no placeholders) and _forms (hashes of the tokens in each form; only the first
    where there are no placeholders)."""
    rows = rows.withColumn("_canonical", canonical(text))
    numbered = F.contains("_canonical", F.lit(NUMBER))
    named = F.contains("_canonical", F.lit(NAME)) | F.contains("_canonical", F.lit(CAPITAL))
    rows = rows.withColumn("_tokens", F.array_remove(
        F.when(numbered, F.split("_canonical", _SPLIT)).otherwise(F.split("_canonical", _SPLIT_WORDS)), "",
    ))
    rows = rows.withColumn("_single", ~(named | numbered))
    forms = [_hashes(F.col("_tokens"), form) for form in range(FORMS)]
    return rows.withColumn("_forms", F.when(F.col("_single"), F.array(forms[0])).otherwise(F.array(*forms))).drop("_canonical")


#: Names inside sentences; no names; every capital a name; no placeholders at all.
INSIDE, BARE, EVERY, VERBATIM = range(4)
FORMS = 4


def _is_slot(token: Column, form: int) -> Column:
    code = F.ascii(token)
    if form == INSIDE:
        return code.between(1, 3)
    if form == BARE:
        return code.between(2, 3)
    if form == VERBATIM:
        return F.lit(False)
    return code.between(2, 3) | (code.isin(1, 4) & ~F.substring(token, 2, 1_000_000_000).isin(FUNCTION))


def _kind(token: Column, form: int) -> Column:
    code = F.ascii(token)
    kind = F.when(code == 4, F.lit(NAME)).otherwise(F.substring(token, 1, 1))
    return F.when(~code.between(1, 4), token).when(_is_slot(token, form), kind).otherwise(F.substring(token, 2, 1_000_000_000))


def _hashes(tokens: Column, form: int) -> Column:
    if form == VERBATIM:
        # Never the same as a window of another form.
        return F.transform(tokens, lambda t: F.xxhash64(F.lit("verbatim"), _value(t)))
    return F.transform(tokens, lambda t: F.xxhash64(_kind(t, form)))


def _value(token: Column) -> Column:
    """A name is the same wherever it stands."""
    return F.translate(token, CAPITAL, NAME)


def _slots(at: Column, size: int, form: int) -> Column:
    """Place and token of each placeholder of a window."""
    window = F.transform(F.slice("_tokens", at, size), lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    return F.filter(window, lambda x: _is_slot(x["t"], form))


def windows(rows: DataFrame, size: int, keep: list[str], hits: str | None = None) -> DataFrame:
    """keep, at (from 0), form, template (hash) of the windows of rows in all their forms; with hits, the name of a
    column of pairs of places (low, high, from 1), only of windows that hold both places of one."""
    last = F.size("_tokens") - (size - 1)
    at = F.sequence(F.lit(1), last)
    if hits:
        near = F.filter(hits, lambda h: h["high"] - h["low"] < size)
        reach = F.transform(near, lambda h: F.sequence(F.greatest(h["high"] - (size - 1), F.lit(1)), F.least(h["low"], last)))
        at = F.array_distinct(F.flatten(reach))

    def template(i: Column, form: int) -> Column:
        if hits:
            # Few windows: their tokens are hashed one by one.
            return F.xxhash64(_hashes(F.slice("_tokens", i, size), form))
        return F.xxhash64(F.slice(F.col("_forms")[form], i, size))

    alone = F.transform(at, lambda i: F.struct((i - 1).alias("at"), F.array(template(i, 0)).alias("forms")))
    every = F.transform(at, lambda i: F.struct((i - 1).alias("at"), F.array(
        *(template(i, k) for k in range(FORMS)),
    ).alias("forms")))
    # No filter on the size: it would be moved before the tokens and compute them a second time.
    none = F.expr("CAST(array() AS array<struct<at:int,forms:array<bigint>>>)")
    each = F.when(last < 1, none).when(F.col("_single"), alone).otherwise(every)
    cut = rows.select(*keep, F.explode(each).alias("_each"))
    return cut.select(*keep, F.col("_each.at").alias("at"), F.posexplode("_each.forms").alias("form", "template"))


def _by_form(of) -> Column:
    out = F.when(F.col("form") == 0, of(0))
    for form in range(1, FORMS):
        out = out.when(F.col("form") == form, of(form))
    return out


def _anchor(size: int, form: int) -> Column:
    """The longest word that each window with this template holds."""
    plain = F.filter(F.slice("_tokens", F.col("at") + 1, size), lambda t: ~_is_slot(t, form))
    if form == VERBATIM:
        plain = F.flatten(F.transform(plain, lambda t: F.split(t, r"[^\p{L}\p{N}]+")))
    else:
        plain = F.transform(plain, lambda t: F.translate(t, NAME + CAPITAL, ""))
    return F.array_max(F.transform(plain, lambda t: F.struct(F.length(t).alias("n"), t.alias("word"))))["word"]


def _word(token: Column) -> Column:
    """The same for a word whichever capital it has."""
    return F.translate(token, NAME + CAPITAL, "")


def _longest(size: int, form: int) -> Column:
    """The words that each window with this template holds, the longest first."""
    plain = F.transform(F.slice("_tokens", F.col("at") + 1, size), lambda t, i: F.struct(
        F.length(_word(t)).alias("n"), _word(t).alias("word"), i.alias("i"), _is_slot(t, form).alias("slot"),
    ))
    return F.sort_array(F.filter(plain, lambda x: ~x["slot"]), asc=False)


def _pair(longest: Column) -> Column:
    """The two longest words of a window, and how far the second is from the first."""
    first, second = F.get(longest, F.lit(0)), F.get(longest, F.lit(1))
    return F.struct(first["word"].alias("first"), second["word"].alias("second"), (second["i"] - first["i"]).alias("apart"))


def _distances(longest: Column) -> Column:
    """How far the second may be from the first in a text's words: numbers are none, and units may be signs."""
    first, second = F.get(longest, F.lit(0))["i"], F.get(longest, F.lit(1))["i"]
    between = F.slice("_tokens", F.col("at") + 1 + F.least(first, second), F.abs(second - first))
    most = F.abs(second - first) - F.size(F.filter(between, lambda t: F.ascii(t) == 2))
    least = most - F.size(F.filter(between, lambda t: F.ascii(t) == 3))
    return F.transform(F.sequence(least, most), lambda n: F.when(second > first, n).otherwise(-n))


def known_windows(benchmark: DataFrame) -> DataFrame:
    """Of items (item_id, _t): item_id, size, template, item_at, item_form, item_slots, anchor, pair, distances of the
    windows searched."""
    items = with_tokens(benchmark, F.col("_t"))
    items = items.withColumn("_size", F.least(F.size("_tokens"), F.lit(WINDOW))).where(F.col("_size") >= LITERALS)
    parts = []
    for size in range(LITERALS, WINDOW + 1):
        cut = windows(items.where(F.col("_size") == size), size, ["item_id", "_tokens"])
        general = size - F.size(_slots(F.col("at") + 1, size, INSIDE)) < LITERALS
        cut = cut.withColumn("item_slots", _by_form(lambda form: _slots(F.col("at") + 1, size, form)))
        cut = cut.withColumn("_longest", _by_form(lambda form: _longest(size, form)))
        parts.append(cut.where(
            F.when(F.col("form") == VERBATIM, general).otherwise(size - F.size("item_slots") >= LITERALS),
        ).select(
            "item_id", F.lit(size).alias("size"), "template", F.col("at").alias("item_at"), F.col("form").alias("item_form"),
            "item_slots", _by_form(lambda form: _anchor(size, form)).alias("anchor"),
            _pair(F.col("_longest")).alias("pair"),
            F.when(F.col("form") != VERBATIM, _distances(F.col("_longest"))).alias("distances"),
        ))
    known = parts[0]
    for part in parts[1:]:
        known = known.union(part)
    return staged(known, "known")


def place_of(*columns: Column | str) -> Column:
    """Of a row among ANCHOR_BITS bits."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(ANCHOR_BITS - 1))


def _beside(place: Column, apart: Column) -> Column:
    return (place + apart).bitwiseAND(F.lit(ANCHOR_BITS - 1))


class Bits:
    """A set of rows (hashes of columns) as a table of bits: more may seem to be in it, none is missed."""

    def __init__(self, rows: DataFrame, bit: Column | None = None):
        """bit: the place of a row, instead of its hash."""
        at = rows.select((place_of(*rows.columns) if bit is None else bit).alias("bit")).distinct().dropna()
        bits = np.zeros(ANCHOR_BITS // 64, dtype=np.int64)
        # One row for 64 bits: a table of fixed size.
        for row in at.groupBy(F.expr("bit div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS int)))").alias("bits")).collect():
            bits[row["word"]] = row["bits"]
        self.table = F.lit(bits)

    def has(self, *columns: Column) -> Column:
        return self.at(F.xxhash64(*columns))

    def at(self, bit: Column) -> Column:
        place = F.shiftrightunsigned(bit, 6).bitwiseAND(F.lit(ANCHOR_BITS // 64 - 1)).cast("int")
        return F.getbit(F.get(self.table, place), bit.bitwiseAND(F.lit(63))) == 1


class Anchors:
    """The anchors of benchmark windows, and the pairs of words they hold."""

    def __init__(self, known: DataFrame):
        self.words = Bits(known.select("anchor"))
        self.firsts, self.pairs = Bits(known.select("pair.first")), Bits(known.select("pair.*"))
        # Distances at which a first word has a second one: bits beside the word's own.
        self.aparts = Bits(known, _beside(place_of("pair.first"), F.col("pair.apart")))
        verbatim = known.where(F.col("item_form") == VERBATIM)
        self.verbatim = any_row(verbatim)
        self.literals = Bits(verbatim.select("anchor")) if self.verbatim else None
        self.seconds = Bits(known.select("pair.second"))
        far = known.select("pair.first", "pair.second", F.explode("distances").alias("far"))
        self.beside = Bits(far, place_of(F.xxhash64("first"), F.xxhash64("second"), "far"))

    def among(self, text: Column, anchors: Bits | None = None) -> Column:
        """Whether a text holds an anchor, or one of some anchors."""
        words = F.split(F.lower(text), _BETWEEN)
        if self.verbatim:
            words = F.concat(words, F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)))
        return F.exists(words, lambda word: (anchors or self.words).has(word))

    def near(self, text: Column) -> Column:
        """Whether a text holds the two words of some window, as far from each other as there, or the anchor of a
        verbatim one."""
        hashes = F.transform(F.split(F.lower(text), _BETWEEN), lambda word: F.xxhash64(word))

        def firsts(words: Column) -> Column:
            return F.array_compact(F.transform(words, lambda w, i: F.when(self.firsts.at(w), i)))

        def beside(words: Column, i: Column) -> Column:
            def second(far: Column) -> Column:
                word = F.get(words, i + far)
                return self.seconds.at(word) & self.beside.at(place_of(F.get(words, i), word, far))

            return F.exists(F.sequence(F.lit(1 - WINDOW), F.lit(WINDOW - 1)), second)

        # An array of one array, so that the words are hashed once.
        found = F.exists(F.array(hashes), lambda words: F.exists(firsts(words), lambda i: beside(words, i)))
        found = F.coalesce(found, F.lit(False))
        if self.verbatim:
            found = found | self.among(text, self.literals)
        return found | text.rlike(_ODD)

    def with_hits(self, rows: DataFrame) -> DataFrame:
        """rows with _hits: the places (low, high, from 1) of pairs among _tokens."""
        rows = rows.withColumn("_words", F.transform("_tokens", _word))
        rows = rows.withColumn("_firsts", F.array_compact(F.transform("_words", lambda w, i: F.when(
            self.firsts.has(w), F.struct((i + 1).alias("p"), place_of(w).alias("place")),
        ))))

        def second(first: Column, apart: Column) -> Column:
            p = first["p"]
            word = F.get("_words", p + apart - 1)
            # Words are hashed only at the distances that the first word has.
            near = (apart != 0) & self.aparts.at(_beside(first["place"], apart))
            return near & word.isNotNull() & self.pairs.has(F.get("_words", p - 1), word, apart)

        def pairs(first: Column) -> Column:
            p = first["p"]
            far = F.filter(F.sequence(F.lit(1 - WINDOW), F.lit(WINDOW - 1)), lambda apart: second(first, apart))
            return F.transform(far, lambda apart: F.struct(
                F.least(p, p + apart).alias("low"), F.greatest(p, p + apart).alias("high"),
            ))

        return rows.withColumn("_hits", F.flatten(F.transform("_firsts", pairs))).drop("_words", "_firsts")


def holding(docs: DataFrame, known: DataFrame, text: Column, anchors: Anchors | None = None) -> DataFrame:
    """The rows of docs whose text holds an anchor of known windows."""
    return docs.where((anchors or Anchors(known)).among(text))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_windows (different windows of the item found), n_slots: documents that
    hold an item, verbatim or with other values."""
    known = known_windows(benchmark.select(F.col(item_col).alias("item_id"), text_of(item_text).alias("_t")))
    plain = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_t"))
    anchors = Anchors(known)
    plain = staged(plain.where(anchors.near(F.col("_t"))), "holding")
    texts = anchors.with_hits(with_tokens(plain, F.col("_t")))
    found = None
    for row in known.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect():
        size = row["size"]
        theirs = known.where(F.col("size") == size)
        theirs = F.broadcast(theirs) if row["n"] <= BROADCAST_WINDOWS else theirs
        part = windows(texts, size, ["doc_id"], "_hits").join(theirs, "template")
        found = part if found is None else found.union(part)
    if found is None:
        return _none(docs.select(F.col(id_col).alias("doc_id")), known)
    found = staged(found, "met")
    aligned = _values(plain, found).withColumn("shift", F.col("at") - F.col("item_at")).select(
        "doc_id", "item_id", "item_form", "shift", "item_at", F.explode_outer("pairs").alias("slot"),
    ).groupBy("doc_id", "item_id", "item_form", "shift").agg(
        F.collect_set("item_at").alias("hits"), F.collect_set("slot").alias("slots"),
        F.max(F.when(F.col("slot").isNull(), 1).otherwise(0)).alias("literal"),
    )
    steady = F.size(F.array_distinct(F.col("slots.item"))) == F.size("slots")
    return aligned.where((F.col("literal") == 1) | steady).groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("hits")))).cast("bigint").alias("n_windows"),
        F.max(F.size("slots")).cast("bigint").alias("n_slots"),
    )


def _values(docs: DataFrame, found: DataFrame) -> DataFrame:
    """found with pairs: the values (item, own) that stand in the same slot. Texts are read again only for
    documents that met a window with placeholders."""
    slotted = found.where(F.size("item_slots") > 0)
    wanted = staged(slotted.select(F.col("doc_id").alias("_id")).distinct(), "wanted")
    bare = found.where(F.size("item_slots") == 0).withColumn("pairs", F.expr("CAST(NULL AS array<struct<item:string,own:string>>)"))
    columns = ["doc_id", "item_id", "item_form", "at", "item_at", "pairs"]
    n = wanted.count()
    if n == 0:
        return bare.select(*columns)
    wanted = F.broadcast(wanted) if n <= BROADCAST_WINDOWS else wanted
    again = with_tokens(docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"), F.col("_t"))
    # Rows may share a doc_id: the window must be there in this row's text.
    there = F.expr("form < size(_forms) AND xxhash64(slice(_forms[least(form, size(_forms) - 1)], at + 1, size)) = template")
    valued = slotted.join(again.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id"))).where(there)
    pairs = F.transform("item_slots", lambda s: F.struct(
        _value(s["t"]).alias("item"), _value(F.get("_tokens", F.col("at") + s["i"])).alias("own"),
    ))
    return bare.select(*columns).union(valued.withColumn("pairs", pairs).select(*columns))


def _none(texts: DataFrame, items: DataFrame) -> DataFrame:
    spark = texts.sparkSession
    kinds = (texts.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString())
    return spark.sql(
        f"SELECT CAST(null AS {kinds[0]}) AS doc_id, CAST(null AS {kinds[1]}) AS item_id, 0L AS n_windows, 0L AS n_slots WHERE false"
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item, with all their columns; rows without an id are told apart by text."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.sha2(text_of(text_col), 256)))
    gone = contaminated(docs.select(key.alias("_key"), text_col), benchmark, "_key", text_col)
    gone = gone.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, key == F.col("_gone"), "left_anti")
