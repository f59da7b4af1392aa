"""Quality rules by distribution divergence, in DataFrame operations only.

Two histograms of a document are compared with those of its language, by Jensen-Shannon
distance (base 2, 0 to 1): character classes (upper case, digits, white space, symbols,
punctuation, the rest) and the ``TOP_WORDS`` words that are most frequent in the language,
with one more bin for all other words.  The references are counted over the whole corpus by
``lang``; a document whose language is null or has under ``MIN_LANGUAGE_ROWS`` documents
is compared with the whole corpus.

A document is kept unless it fails the base rules (under 50 words, or more than half of its
words in repeated three-word windows), or its character distance exceeds ``max_chars`` with at
least ``MIN_CHARS`` characters, or its word distance exceeds ``max_words`` with at least
``MIN_WORDS`` words.  The guards are there because a short text's histogram is far from any
reference by chance.

Windows are compared by 64-bit hashes of their three words.

Scale: four scans of the texts.  No text, document or rare word is shuffled: the first counts
words by language and hash bucket (``BUCKETS`` a language), the second counts the words of the
most frequent buckets, the third sums character classes, the last is a projection.  The reference on the driver is ``TOP_WORDS``
words for each of at most ``MAX_LANGUAGES`` languages.

Edge cases: null and empty texts have no words and fail the base rules; ties between reference
words go to the word first in order; repeated rows are judged alike; an empty table gives none.
The input row is held in one struct, so column names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tideline.llm.common import keep_rows, materialise
from tideline.sources.tables import read_table

TOP_WORDS = 30
BUCKETS = 1 << 16
TOP_BUCKETS = 256
MIN_LANGUAGE_ROWS = 20
MAX_LANGUAGES = 200
MIN_CHARS = 200
MIN_WORDS = 50
MAX_CHARS_DISTANCE = 0.25
MAX_WORDS_DISTANCE = 0.45
_WS = " \t\n\x0b\x0c\r"
_ALL = ""  # reference of the whole corpus


def split_words(t: Column) -> Column:
    """Words between white space; a split at one character takes no regular expression."""
    for c in _WS[1:]:
        t = F.replace(t, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(t, " ", -1), "")


def _row_and_text(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(row, lang, t, odd): odd is what isn't a to z or white space."""
    return (docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
            .select("row", F.col("row")[lang].alias("lang"), F.coalesce(F.col("row")[text], F.lit("")).alias("t"))
            .withColumn("odd", F.regexp_replace("t", r"[a-z\x20\x09-\x0D]+", "")))


def character_classes(df: DataFrame, word_chars: Column) -> DataFrame:
    """``classes``: counts of upper case, digits, white space, symbols, marks and the rest; and ``n_symbols``."""
    upper, digit, mark, symbol = (F.regexp_count("odd", F.lit(p)) for p in ("[A-Z]", "[0-9]", "[.,;:!?'\"()-]", "[#*$%&|<>]"))
    df = df.withColumns({"upper": upper, "digit": digit, "mark": mark, "n_symbols": symbol.cast("long"), "word_chars": word_chars.cast("long")})
    rest = F.col("word_chars") - F.col("upper") - F.col("digit") - F.col("n_symbols") - F.col("mark")
    return df.withColumn("classes", F.array(*(c.cast("double") for c in (F.col("upper"), F.col("digit"), F.length("t") - F.col("word_chars"),
                                                                           F.col("n_symbols"), F.col("mark"), rest)))).drop("upper", "digit", "mark", "odd")


def measure(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(row, lang, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes)."""
    df = _row_and_text(docs, text, lang).withColumn("words", split_words(F.col("t")))
    df = (character_classes(df, F.length(F.array_join("words", ""))).withColumn("n_words", F.size("words").cast("long"))
          .withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(_WS)) != ""))
          .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines"))
    window = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    df = df.withColumn("windows", F.when(F.col("n_words") > 2, F.slice(window, F.lit(1), F.size("words") - 2)).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # only texts with a repeated window are sorted
    df = df.withColumn("placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    again = F.filter("placed", lambda x, k: (x["h"] == F.get("placed", k - 1)["h"]) | (x["h"] == F.get("placed", k + 1)["h"]))
    at = F.sort_array(F.transform(again, lambda x: x["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(at, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])
    return df.withColumn("n_repeat_words", covered.cast("long")).drop("windows", "placed")


def references(docs: DataFrame, text: str, lang: str) -> dict[str, tuple[list[float], list[str], list[float]]]:
    """By language: shares of the character classes, the top words, their shares and that of all others."""
    rows = docs.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).filter(F.col("lang").isNotNull() & (F.col("n") >= MIN_LANGUAGE_ROWS))
    langs = sorted(r["lang"] for r in rows.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect())
    group = F.when(F.col(lang).isin(langs), F.col(lang)).otherwise(_ALL) if langs else F.lit(_ALL)
    words = docs.select(group.alias("lang"), F.explode(split_words(F.coalesce(text, F.lit("")))).alias("w"))
    bucket = F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).cast("int")
    counts = materialise(words.select("lang", bucket.alias("b")).groupBy("lang", "b").agg(F.count("*").alias("n")), "word-buckets")
    every = counts.groupBy(F.lit(_ALL).alias("lang"), "b").agg(F.sum("n").alias("n"))
    both = counts.filter(F.col("lang") != _ALL).union(every)
    best = (both.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "b"))).withColumn("total", F.sum("n").over(Window.partitionBy("lang")))
            .filter(F.col("k") <= TOP_BUCKETS).select("lang", "b", "total").collect())
    total = {r["lang"]: r["total"] for r in best}
    frequent = sorted({r["b"] for r in best})
    counts = materialise(words.filter(bucket.isin(frequent)).groupBy("lang", "w").agg(F.count("*").alias("n")), "frequent-words") if frequent else None
    chars = {}
    solid = F.col("t")
    for c in _WS:
        solid = F.replace(solid, F.lit(c), F.lit(""))
    classes = character_classes(_row_and_text(docs, text, lang), F.length(solid)).groupBy(group_of(langs)).agg(*(F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(6)))
    for r in classes.collect():
        chars[r[0]] = [r[f"c{i}"] or 0.0 for i in range(6)]
    chars[_ALL] = [sum(x) for x in zip(*chars.values())] if chars else [0.0] * 6
    top: dict[str, list] = {}
    if counts is not None:
        every = counts.groupBy(F.lit(_ALL).alias("lang"), "w").agg(F.sum("n").alias("n"))
        ranked = counts.filter(F.col("lang") != _ALL).union(every).withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w")))
        for r in ranked.filter(F.col("k") <= TOP_WORDS).orderBy("lang", "k").collect():
            top.setdefault(r["lang"], []).append((r["w"], r["n"]))
    out = {}
    for x in {*langs, _ALL}:
        c, known = chars.get(x, [0.0] * 6), top.get(x, [])
        all_words = max(1, total.get(x, 0))
        share = [n / all_words for _, n in known]
        out[x] = ([v / max(1.0, sum(c)) for v in c], [w for w, _ in known], [*share, max(0.0, 1 - sum(share))])
    return out


def group_of(langs: list[str]) -> Column:
    return F.when(F.col("lang").isin(langs), F.col("lang")).otherwise(_ALL) if langs else F.lit(_ALL)


def add_distance(df: DataFrame, out: str, counts: Column, reference: Column) -> DataFrame:
    """``out``: distance of a histogram of counts from shares; 0 without counts.  The counts and their
    sum are columns of their own, so that lambdas don't compute them anew for each bin."""
    c, n = f"{out}_counts", f"{out}_total"
    df = df.withColumn(c, counts).withColumn(n, F.aggregate(c, F.lit(0.0), lambda a, x: a + x))

    def part(x, m):  # x log2(x / m)
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def both(k, p):
        q = k / F.greatest(F.col(n), F.lit(1.0))
        m = (p + q) / 2
        return (part(p, m) + part(q, m)) / 2

    total = F.aggregate(F.zip_with(c, reference, both), F.lit(0.0), lambda a, x: a + x)
    distance = F.when(F.col(n) > 0, F.sqrt(F.greatest(F.least(total, F.lit(1.0)), F.lit(0.0)))).otherwise(0.0)
    return df.withColumn(out, distance).drop(c, n)


def _literal(values: list, kind: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", max_chars: float = MAX_CHARS_DISTANCE, max_words: float = MAX_WORDS_DISTANCE) -> DataFrame:
    """(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept)."""
    refs = references(docs, text, lang)
    langs = sorted(x for x in refs if x != _ALL)

    def by_language(of, kind: str) -> Column:
        out = _literal(of(refs[_ALL]), kind)
        for x in langs:
            out = F.when(F.col("lang") == x, _literal(of(refs[x]), kind)).otherwise(out)
        return out

    common = sorted({w for r in refs.values() for w in r[1]})
    df = measure(docs, text, lang).withColumn("hits", F.filter("words", lambda w: w.isin(common)) if common else F.array().cast("array<string>"))
    df = df.withColumn("tops", by_language(lambda r: r[1], "string"))
    # how often each top word is among the hits: what the text of all hits loses when it is taken out
    df = df.withColumn("hits", F.concat(F.lit(" "), F.array_join("hits", "  "), F.lit(" ")))
    df = df.withColumn("found", F.transform("tops", lambda w: ((F.octet_length("hits") - F.octet_length(F.replace("hits", F.concat(F.lit(" "), w, F.lit(" ")))))
                                                               / (F.octet_length(w) + 2)).cast("double")))
    others = F.col("n_words").cast("double") - F.aggregate("found", F.lit(0.0), lambda a, x: a + x)
    df = add_distance(df, "char_distance", F.col("classes"), by_language(lambda r: r[0], "double"))
    df = add_distance(df, "word_distance", F.concat("found", F.array(others)), by_language(lambda r: r[2], "double"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = ((F.length("t") >= MIN_CHARS) & (F.col("char_distance") > max_chars)) | ((F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > max_words))
    return df.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                     "char_distance", "word_distance", (~failed & ~far).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """The documents (all columns) that pass all rules."""
    return keep_rows(judge(docs, text, lang, **limits), F.col("kept")).select("row.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                              F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"), "kept")
