"""Benchmark items in documents, also with other numbers, names and units: windows of templates, then slots.

A text becomes a template: numbers, units after numbers and names (capitalised words inside a sentence) are typed
placeholders, the rest is lower-cased and loses its punctuation. Windows of template words are hashed and joined, and so
are windows with first words of sentences as names, with all names as words (so that case does not matter), and with
numbers and units as they stand. Windows that agree on one diagonal (place in the document less place in the item) are
one match. A match counts when it is long enough and either agrees word for word over that length or has consistent
slots: each value of the item stands for one value of the document. DataFrame functions only.

Defined cases: null and empty texts and texts of punctuation alone match nothing; an item with fewer words than a window
is found as a whole, word for word, however short it is; of items that repeat item_id with another text each is
reported; rows that repeat doc_id and text are one document; an empty table on either side gives no row. Windows with
fewer than ``plain`` words outside placeholders count only where they agree word for word.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulluse.llm.common import Scratch, keyed, shown_id

WINDOW, PLAIN, RUN, MOST_BITS = 8, 5, 6, 1 << 20
NUM, UNIT, NAME = "‹num›", "‹unit›", "‹name›"
SIGNS = r"\-+*/×÷^=<>−–$€£%"
#: Nothing that is marked or dropped begins with these; looking first makes most places cheap.
RARE = r"(?=[^a-z \n])"
UNITS = "km|cm|mm|kg|mg|ml|kwh|mph|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|meters?|grams?|dollars?|euros?|percent"


def marked(text: Column) -> Column:
    """The text with marks before numbers, units and names; places of white space stay."""
    out = F.replace(F.replace(text, F.lit("‹"), F.lit("")), F.lit("›"), F.lit(""))
    # What looks back is behind what is found, since a look back at every place costs most.
    out = F.regexp_replace(out, rf"(?i)(\d ?)((?:{UNITS}|[%€$£])(?![\p{{L}}\p{{N}}]))", "$1‹u›$2")
    # Possessive repetition: a long list of numbers takes no stack.
    out = F.regexp_replace(out, r"\d++(?:[.,]\d++)*+", "‹d›$0")
    out = F.regexp_replace(out, rf"{RARE}(?<=[^.!?\s]\s)\p{{Lu}}[\p{{L}}'’-]*+", "‹m›$0")
    # The first word of a sentence may be a name.
    out = F.regexp_replace(out, rf"{RARE}(?<![\p{{L}}\p{{N}}›'’-])\p{{Lu}}[\p{{L}}'’-]*+", "‹s›$0")
    # Signs stay beside numbers: what is 3 + 4 is not what is 3 * 4.
    out = F.regexp_replace(out, rf"\s(?<=\d\s)\s*([{SIGNS}])\s+(?=‹d›)", " $1")
    return F.regexp_replace(
        F.lower(out), rf"{RARE}(?:[^\p{{L}}\p{{N}}\s‹›.,{SIGNS}]+|(?<!\d)[.,]|[.,](?!\d)|(?<!‹u›)[{SIGNS}](?!‹d›))", ""
    )


def tokens(text: Column) -> Column:
    """The text's words: lower-cased, without punctuation, with marks."""
    return F.split(F.trim(F.regexp_replace(marked(text), r"\s+", " ")), " ")


def reading(word: Column, names: str) -> Column:
    """A marked word with placeholders for numbers and units; ``names`` are the marks of words that are names here."""
    out = F.regexp_replace(word, f"‹[{names}]›[^‹]*", NAME) if names else word
    out = F.regexp_replace(F.regexp_replace(out, rf"[{SIGNS}]*‹d›[^‹\p{{L}}{SIGNS}]*", NUM), r"‹u›[^‹]*", UNIT)
    return F.when(word.contains("‹"), F.regexp_replace(out, "‹[ms]›", "")).otherwise(word)


def template(word: Column) -> Column:
    return reading(word, "m")


def named(word: Column) -> Column:
    """First words of sentences are names too, so that it does not matter what stands before them."""
    return reading(word, "ms")


def plainly(word: Column) -> Column:
    """Names stay words, so that their case does not matter."""
    return reading(word, "")


def value(word: Column) -> Column:
    """What the word stands for."""
    return F.when(word.contains("‹"), F.regexp_replace(word, "‹[dums]›", "")).otherwise(word)


def slots(text: Column) -> Column:
    """The template's words, those with more names, and what they stand for: word, named, value."""
    return F.transform(tokens(text), lambda w: F.struct(template(w).alias("word"), named(w).alias("named"), value(w).alias("value")))


#: A window agrees when it does so in one reading.
READINGS = {"template": template, "named": named, "plainly": plainly, "value": value}


def run_hash(words: Column, length: int = WINDOW) -> Column:
    """The hash that ``hashed`` gives a run of these words."""
    return F.xxhash64(*(F.xxhash64(F.element_at(words, k + 1)) for k in range(length)))


def sieve(items: DataFrame) -> tuple[Column, int]:
    """Bits of the hashes of the words that items have, as an array of longs, and how many bits there are.

    About sixteen bits for each word, and at most ``MOST_BITS`` whatever the benchmark; more words only sieve less.
    """
    hashes = items.select(F.explode("words").alias("w")).select(F.xxhash64(value(F.col("w"))).alias("h")).distinct()
    bits = min(max(1 << (16 * hashes.count()).bit_length(), 64), MOST_BITS)
    place = F.pmod("h", F.lit(bits))
    longs = hashes.groupBy(F.shiftright(place, 6).cast("int").alias("k")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(h, {bits}L) & 63L as int))")).alias("bits")
    )
    held = {r["k"]: r["bits"] for r in longs.collect()}
    # The smallest long cannot be written as a literal of its own.
    shown = (f"{x}L" if (x := held.get(k, 0)) > -(2**63) else "shiftleft(1L, 63)" for k in range(bits // 64))
    return F.expr(f"array({', '.join(shown)})"), bits


def hashed(rows: DataFrame, lengths: list[int], sifted: tuple[Column, int], *keep: str) -> DataFrame:
    """keep..., at, h: the windows of rows with words, each with the different hashes of its readings, and runs of other
    ``lengths`` with their values.

    A word without a mark reads alike everywhere, so a window that has one which no item has agrees with none. Windows
    are hashed only where every word is marked or passes the sieve of item words. Each word in one is read and hashed
    once, and a window's hash is made of those of its words.
    """
    known, bits = sifted

    def starts(length: int) -> Column:
        first, last = F.instr("_pass", "1" * length), F.size("words") - length
        every = F.when(first > 0, F.sequence(first - 1, last)).otherwise(F.array().cast("array<int>"))
        flags = F.col("_pass").cast("binary")
        return F.filter(every, lambda at: F.substring(flags, at + 1, F.lit(length)) == F.lit(b"1" * length))

    def runs(length: int, names: dict[str, str]) -> Column:
        """at and the hash in each reading, by the columns with the hashes of words."""
        def cut(at: Column, name: str) -> Column:
            return F.xxhash64(*(F.get(F.col(name), at + k) for k in range(length)))

        return F.transform(starts(length), lambda at: F.struct(at.alias("at"), *(cut(at, of).alias(name) for name, of in names.items())))

    def passes(h: Column) -> Column:
        place = F.pmod(h, F.lit(bits))
        held = F.getbit(F.get(known, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1
        return F.when(h.isNull() | held, "1").otherwise("0")

    least = min([WINDOW, *lengths])

    def read_hashes(read: Callable[[Column], Column]) -> Column:
        """Of each word in this reading, if it may be in a window or run."""
        def near(k: Column) -> Column:
            around = F.substring(F.col("_starts").cast("binary"), F.greatest(k - (least - 1), F.lit(0)) + 1, F.lit(least))
            return F.instr(around.cast("string"), "2") > 0

        own = F.transform("words", lambda w, k: F.coalesce(F.get(F.col("_plain"), k), F.when(near(k), F.xxhash64(read(w)))))
        return F.when(F.instr("_starts", "2") > 0, own)

    # No filter on the number of words: it would split each text twice. Short texts have no window.
    words = rows.select(*keep, "words", F.transform("words", lambda w: F.when(~w.contains("‹"), F.xxhash64(w))).alias("_plain"))
    words = words.select(*keep, "words", "_plain", F.array_join(F.transform("_plain", passes), "").alias("_pass"))
    # A 2 is the first of so many words that pass as the shortest run has.
    words = words.select("*", F.regexp_replace("_pass", f"1(?=1{{{least - 1}}})", "2").alias("_starts"))
    of = {name: f"_{name}" for name in READINGS}
    words = words.select(*keep, "words", "_pass", *(read_hashes(read).alias(of[name]) for name, read in READINGS.items()))
    windows = runs(WINDOW, of)
    for length in lengths:
        windows = F.concat(windows, runs(length, dict.fromkeys(READINGS, of["value"])))
    found = words.select(*keep, F.inline_outer(windows)).filter("at is not null")
    one, *others = (F.col(name) for name in READINGS)
    same = reduce(and_, (one == other for other in others))
    # Mostly all readings of a window are the same.
    hashes = F.when(same, F.array(one)).otherwise(F.array_distinct(F.array(one, *others)))
    return found.select(*keep, "at", F.explode_outer(hashes).alias("h"))


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, item_tag, q, span, h, firm, exact: the windows of items, or a shorter item as a whole. In readings with
    placeholders only those with enough words outside; ``firm``: so in the template; ``exact``: with the values."""
    rows = items.filter(F.element_at("words", 1) != "").select("item_id", F.xxhash64("text").alias("item_tag"), "words")
    out = rows.filter(F.size("words") >= WINDOW).withColumn("q", F.explode(F.sequence(F.lit(0), F.size("words") - WINDOW)))
    window = F.slice("words", F.col("q") + 1, WINDOW)
    found = {}
    for name, read in READINGS.items():
        words = F.transform(window, lambda w: read(w))
        plain = F.size(F.filter(words, lambda w: ~w.startswith("‹")))
        found[name] = F.when((plain >= PLAIN) | F.lit(name == "value"), run_hash(words))
    out = out.select(
        "item_id", "item_tag", "q", F.lit(WINDOW).alias("span"), F.explode(F.array_compact(F.array_distinct(F.array(*found.values())))).alias("h"),
        found["template"].isNotNull().alias("firm"), found["value"].alias("own"),
    )
    words = F.transform("words", lambda w: value(w))
    whole = F.when(F.size("words") == 1, run_hash(words, 1))
    for length in range(2, WINDOW):
        whole = whole.when(F.size("words") == length, run_hash(words, length))
    short = rows.filter(F.size("words") < WINDOW).select(
        "item_id", "item_tag", F.lit(0).alias("q"), F.size("words").alias("span"), whole.alias("h"), F.lit(False).alias("firm"), whole.alias("own")
    )
    return out.union(short).withColumn("exact", F.col("h") == F.col("own")).drop("own")


def matches(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, run: int = RUN) -> DataFrame:
    """doc_id, item_id, first_word and last_word in the item, n_windows, n_slots, reparameterised: consistent matches."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).distinct().withColumn("words", tokens(F.col("text")))
    wanted = scratch.save(item_windows(items), "item_windows")
    # Windows of the template, or all of them, must agree. The first word may be another one: an item of few windows
    # matches with those that are not over it.
    rest = F.when(F.col("q") > 0, F.col("q"))
    counted = {
        "all": F.col("q"), "rest": rest, "firm": F.when(F.col("firm"), F.col("q")), "firm_rest": F.when(F.col("firm"), rest),
    }
    need = wanted.groupBy("item_id", "item_tag").agg(
        *(F.least(F.countDistinct(c), F.lit(run)).alias(f"need_{name}") for name, c in counted.items())
    )
    lengths = sorted(r["span"] for r in wanted.select("span").distinct().collect() if r["span"] < WINDOW)
    rows = keyed(docs)
    found = hashed(rows.withColumn("words", tokens(F.col("text"))), lengths, sieve(items), "doc_id", "tag").join(wanted, "h")
    runs = (
        found.groupBy("doc_id", "tag", "item_id", "item_tag", (F.col("at") - F.col("q")).alias("shift"))
        .agg(
            *(F.size(F.collect_set(c)).alias(f"n_{name}") for name, c in counted.items()), F.collect_set("q").alias("qs"),
            F.size(F.collect_set(F.when(F.col("exact"), F.col("q")))).alias("n_exact"),
            F.size(F.collect_set(F.when(F.col("exact"), rest))).alias("n_exact_rest"),
            F.min("q").alias("first"), (F.max(F.col("q") + F.col("span")) - 1).alias("last"),
        )
        .join(need, ["item_id", "item_tag"])
        .filter(" or ".join(f"need_{name} > 0 and n_{name} >= need_{name}" for name in counted))
        .withColumnRenamed("n_all", "n_windows")
    )
    runs = scratch.save(runs, "runs")
    # Only matched documents and items are read again, with their values.
    doc_words = rows.join(runs.select("doc_id", "tag").distinct(), ["doc_id", "tag"], "left_semi").dropDuplicates(
        ["doc_id", "tag"]
    ).select("doc_id", "tag", slots(F.col("text")).alias("doc_words"))
    known = F.transform(F.filter("item_words", lambda w: w["word"].startswith(NAME)), lambda w: w["value"])
    item_slots = items.select("item_id", F.xxhash64("text").alias("item_tag"), slots(F.col("text")).alias("item_words")).select(
        "item_id", "item_tag", known.alias("known"), F.posexplode("item_words").alias("q", "s")
    ).filter(F.col("s.named").startswith("‹"))
    at = F.col("q") + F.col("shift") + 1
    covered = F.exists("qs", lambda x: (x <= F.col("q")) & (F.col("q") < x + WINDOW))
    pairs = (
        runs.join(item_slots, ["item_id", "item_tag"])
        .filter("q between first and last")
        .join(doc_words, ["doc_id", "tag"])
        .select(
            "doc_id", "tag", "item_id", "item_tag", "shift", "s.word", F.col("s.named").alias("kind"), "known", covered.alias("covered"),
            F.col("s.value").alias("item_value"), F.element_at("doc_words", at.cast("int")).alias("d"),
        )
        # A slot in a gap between matched windows need not be one in the document. The first word of a sentence is one
        # if it is another there, or a name elsewhere in the item.
        .filter(F.col("d.named") == F.col("kind"))
        .filter(
            (F.col("word") == F.col("kind")) & (F.col("d.word") == F.col("kind"))
            | F.col("covered") & ((F.col("item_value") != F.col("d.value")) | F.array_contains("known", F.col("item_value")))
        )
    )
    key = ["doc_id", "tag", "item_id", "item_tag", "shift"]
    verdicts = pairs.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_slots"),
        F.countDistinct("kind", "item_value").alias("values"),
        F.countDistinct("kind", "item_value", "d.value").alias("both"),
        F.max(F.col("item_value") != F.col("d.value")).alias("reparameterised"),
    )
    # A run that agrees word for word needs no consistency: an edited mention elsewhere does not undo the copy.
    literal = "need_all > 0 and n_exact >= need_all or need_rest > 0 and n_exact_rest >= need_rest"
    return (
        runs.join(verdicts, key, "left")
        .filter(f"n_slots is null or values = both or {literal}")
        .select(
            shown_id(), "item_id", F.col("first").alias("first_word"), F.col("last").alias("last_word"), "n_windows",
            F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
            F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"), "tag", "shift",
        )
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    out = scratch.save(matches(docs, benchmark, scratch).select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).distinct(), "out")
    tag = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(out, docs["doc_id"].eqNullSafe(out["_id"]) & (tag == out["_tag"]), "left_anti")
