"""Benchmark decontamination by template windows.

Texts are brought to a canonical form in which numbers, names and units of measure are
typed placeholders; everything else is lower case. Windows of ``WINDOW`` canonical words
of the benchmark are hash-joined with those of all documents. Windows that lie on one
diagonal (same distance between document and item places) form a passage; its placeholders
are then compared with the values in the document: each value of the item must stand for
one value of the document and the other way round (slot consistency). A passage counts as
a leak when it covers ``MIN_WORDS`` words, or ``SHARE`` of the item if that is less, and its
slots agree: ``exact`` when all values are equal, ``reworded`` (re-parameterised) when
they are consistent.

* number: a run of digits that no letter precedes; unit: one of ``UNITS`` right after a number; name: a
  capitalised word that does not begin a text, a line or a sentence.
* Windows of placeholders alone, or with fewer than ``MIN_PLAIN`` other words, say nothing
  and are not joined. Items of fewer than ``WINDOW`` words have no window; they cannot be
  found and are listed by ``short_items``.

The benchmark's windows are broadcast while there are at most ``MAX_BROADCAST`` of them;
beyond that Spark shuffles both sides. Only documents with a window hit are read again.

Nulls, empties: null or empty texts have no windows. Null ids match as any other value
would. Repeated rows of a document count as one (equal texts give equal passages); equal
items are reported each. Extra columns are not read by ``find_leaks`` and pass through
``drop_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.scratch import written

WINDOW = 8
MIN_PLAIN = 5
MIN_WORDS = 12
SHARE = 0.8
MAX_BROADCAST = 200_000            # windows; some 10 MB

#: Units of measure: fixed values.
UNITS = ("kg", "g", "mg", "lb", "lbs", "oz", "ton", "tons", "km", "m", "cm", "mm", "mile",
         "miles", "ft", "feet", "inch", "inches", "yard", "yards", "l", "ml", "gallon", "gallons",
         "s", "sec", "seconds", "second", "min", "minute", "minutes", "h", "hour", "hours", "day",
         "days", "week", "weeks", "month", "months", "year", "years", "usd", "eur", "dollars",
         "euros", "cents", "percent", "degrees", "mph", "kmh")

# marks around a placeholder's value; private-use characters
NUMBER, UNIT, NAME, PLACEHOLDERS = "\ue001", "\ue002", "\ue003", "\ue001-\ue003"


def marked(text: Column) -> Column:
    """The text with each placeholder's value behind its mark, names in their case."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{PLACEHOLDERS}]", " ")
    # a capitalised word after a letter, digit or comma and one space
    t = F.regexp_replace(t, r"(?<=[\p{L}\p{N},;] )(\p{Lu}\p{Ll}[\p{L}]*)", NAME + "$1")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}])(\p{N}+)", f" {NUMBER}$1 ")
    units = "|".join(sorted(UNITS, key=lambda u: -len(u)))
    return F.regexp_replace(t, rf"(?<=\p{{N}} )(\s?)({units})(?![\p{{L}}\p{{N}}])", f" {UNIT}$2")


def words_of(text: Column) -> Column:
    """Marked words in lower case, without punctuation."""
    plain = F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}{PLACEHOLDERS}]+", " ")
    return F.array_remove(F.split(plain, " "), "")


def canonical(text: Column) -> Column:
    """Marked text with the placeholders' values taken out."""
    return F.regexp_replace(text, rf"([{PLACEHOLDERS}])[\p{{L}}\p{{N}}]+", "$1")


def windows(df: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """(keep, at, window): the hash of every window of canonical words."""
    rows = df.select(*keep, words_of(canonical(marked(F.col(text_col)))).alias("_w"))
    n = F.size("_w")
    # the condition stands in the column: a filter would be pushed below the regexes
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(
        n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)])))
    return rows.select(*keep, hashes.alias("_hashes")).select(
        *keep, F.posexplode_outer("_hashes").alias("at", "window")).where(
        F.col("window").isNotNull())


def item_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, item_at, window, item_words): the windows with enough plain words."""
    rows = benchmark.select(F.col(item_col).alias("item_id"), words_of(canonical(marked(
        F.col(text_col)))).alias("_w")).where(F.size("_w") >= WINDOW)
    plain = F.size(F.filter("_part", lambda w: ~w.isin(NUMBER, UNIT, NAME)))
    return rows.select(
        "item_id", F.size("_w").alias("item_words"), "_w",
        F.explode(F.sequence(F.lit(0), F.size("_w") - WINDOW)).alias("item_at")).withColumn(
        "_part", F.slice("_w", F.col("item_at") + 1, F.lit(WINDOW))).where(
        plain >= MIN_PLAIN).select("item_id", "item_words", "item_at", F.xxhash64(
            *[F.get("_part", F.lit(k)) for k in range(WINDOW)]).alias("window"))


def short_items(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text"
                ) -> DataFrame:
    """The items that no window can find."""
    n = F.size(words_of(canonical(marked(F.col(text_col)))))
    return benchmark.where(n < WINDOW).select(F.col(item_col).alias("item_id"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
               ) -> DataFrame:
    """(doc_id, item_id, first_word, n_windows, n_words, item_words, n_slots, kind): each
    item's longest leaking passage in each document. Words count in canonical words."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_hash"),
                       F.col(text_col).alias("text"))
    items = written(item_windows(benchmark, item_col, item_text_col), "item-windows")
    side = F.broadcast(items) if items.count() <= MAX_BROADCAST else items
    hits = windows(docs, ["doc_id", "_hash"], "text").join(side, "window")
    passages = written(hits.groupBy(
        "doc_id", "_hash", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.array_sort(F.collect_set("item_at")).alias("places"),
        F.max("item_words").alias("item_words")), "passages")
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to")), lambda a, p: F.struct(
            (a["n"] + p + WINDOW - F.greatest(a["to"], p)).alias("n"),
            (p + WINDOW).alias("to")))["n"]
    enough = F.least(F.lit(MIN_WORDS), F.ceil(F.col("item_words") * SHARE))
    long = passages.withColumn("n_words", covered).where(F.col("n_words") >= F.greatest(
        enough, F.lit(WINDOW)))

    # the values of the passages' placeholders, from the documents that have one
    some = long.groupBy("doc_id", "_hash").agg(F.collect_list(F.struct(
        "item_id", "shift", "places", "item_words", "n_words")).alias("_found"))
    read = docs.join(some.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"),
                                  "_found"), F.col("doc_id").eqNullSafe(F.col("_id"))
                      & (F.col("_hash") == F.col("_h"))).select(
        "doc_id", words_of(marked(F.col("text"))).alias("_dw"), F.explode("_found").alias("f"))
    item_values = benchmark.select(F.col(item_col).alias("_item"), words_of(
        marked(F.col(item_text_col))).alias("_iw"))
    both = read.join(item_values, F.col("f")["item_id"].eqNullSafe(F.col("_item")))
    at = F.array_distinct(F.flatten(F.transform(F.col("f")["places"], lambda p: F.sequence(
        p, p + WINDOW - 1))))
    mark = lambda w: F.substring(w, 1, 1).isin(NUMBER, UNIT, NAME)
    pairs = F.transform(F.filter("_at", lambda i: mark(F.get("_iw", i))), lambda i: F.struct(
        F.get("_iw", i).alias("item"), F.get("_dw", i + F.col("f")["shift"]).alias("doc")))
    found = both.withColumn("_at", at).withColumn("_pairs", F.array_distinct(pairs))
    values = lambda k: F.size(F.array_distinct(F.transform("_pairs", lambda p: p[k])))
    consistent = (values("item") == F.size("_pairs")) & (values("doc") == F.size("_pairs"))
    equal = F.forall("_pairs", lambda p: p["item"] == p["doc"])
    kinds = found.select(
        "doc_id", F.col("f")["item_id"].alias("item_id"), F.col("f")["shift"].alias("_shift"),
        (F.col("f")["shift"] + F.col("f")["places"][0]).cast("long").alias("first_word"),
        F.size(F.col("f")["places"]).cast("long").alias("n_windows"),
        F.col("f")["n_words"].cast("long").alias("n_words"),
        F.col("f")["item_words"].cast("long").alias("item_words"),
        F.size("_pairs").cast("long").alias("n_slots"),
        F.when(equal, "exact").when(consistent, "reworded").alias("kind")).where(
        F.col("kind").isNotNull())
    best = F.max_by(F.struct("first_word", "n_windows", "n_words", "item_words", "n_slots", "kind"),
                    F.struct("n_words", -F.col("first_word")))
    return kinds.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options
               ) -> DataFrame:
    """``docs`` without the documents that hold a leaked passage."""
    leaks = find_leaks(docs, benchmark, id_col=id_col, **options).select(
        F.col("doc_id").alias("__llm_id")).distinct()
    return docs.join(leaks, F.col(id_col).eqNullSafe(F.col("__llm_id")), "left_anti")
