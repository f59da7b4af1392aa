"""Information-theoretic sanitisation of personal data, in DataFrame operations only.

Protected entities are e-mail addresses, IP addresses, card and phone numbers and secrets
(keys and tokens: runs of 20 or more letters and digits mixed), found by pattern.  Other
words can give an entity away too.  Over the whole corpus

    p(e | t) = documents with term t near entity e / documents with t
    I(t; e)  = log2( p(e | t) / p(e) )        bits of disclosure

where near means within ``NEAR`` characters and p(e) is the share of documents with e.  A
term is a run of at least ``MIN_LETTERS`` letters, lower-cased.  An entity e is a value, a
pool of values (an address's local part or domain, an IP's first three parts, a card's
issuer digits, a phone's area digits) or a whole kind.  A term discloses e if I(t; e) >=
``min_bits`` and one of these holds:

* it is near e in at least ``min_support`` different texts and p(e | t) >= ``generalise_at``;
* it is too rare for that, and its rarity stands for support: it is near entities in one
  text only, or near one value only, and p(e | t) >= ``remove_at`` over the whole corpus.

Each occurrence of a disclosing term becomes a span: of kind ``removed`` if it has support
and p(e | t) >= ``remove_at``, else of kind ``term`` (generalised to a token).  A term that
discloses a value is replaced wherever it stands, also in documents without an entity; one
that discloses a pool or a kind only in documents that hold one of it.

Positions are code points, ends exclusive.  Matches of a kind don't overlap; a match that
fails its check (an IP part over 255, a card that fails Luhn, a wrong number of digits) is
dropped and not tried again shorter.  Spans of different kinds may overlap; the redacted
text has one token for what overlaps.

The patterns are written so that Java's matcher neither recurses nor rescans: possessive
repeats, and a start only where a run starts or the last match ended (``\\G``).

Scale: only documents with an entity (and their text) are written to the shared folder.
Term counts are grouped by term, pairs by entity and term, combined before the shuffle, and
copies of a text count as one row with a number; joins are by term, by digest of the text
or by both digest and entity, so no pair of a document and a term is made that doesn't
occur in it.  Documents without an entity are joined to the terms found in them by digest,
a table whose size Spark knows.

Edge cases: null and empty texts have no spans and stay; repeated rows are counted as
documents but add no support (support counts different texts); an empty table gives an empty
table.  The input row is held in one struct, so column names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.llm.common import keep_rows, materialise
from tideline.sources.tables import read_table

# The kinds in their order, and their patterns.
KINDS = ["email", "ip", "card", "phone", "secret", "term", "removed"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKENS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "secret": "<SECRET>", "term": "<TERM>", "removed": ""}
SECRET = r"(?<![A-Za-z0-9])[A-Za-z0-9]{20,}+"
LETTERS = r"\p{L}++"

NEAR = 100
MIN_LETTERS = 3
#: Levels of what a span stands for.
VALUE, POOL, KIND = 0, 1, 2
_CHUNK = 256
_TERM = KINDS.index("term")
_SECRET_GUARD = r"[0-9][A-Za-z]|[A-Za-z][0-9]"
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def find_matches(df: DataFrame, text: str, pattern: str, out: str, kind: int, only_if: Column | None = None) -> DataFrame:
    """``out``: the matches of a pattern as structs (start, kind, end, value).

    The pieces around the matches give the positions; their running sum is taken in
    chunks, so that a text of many matches doesn't cost the square of their number."""
    t, m, step, chunk = F.col(text), f"{out}_m", f"{out}_step", f"{out}_chunk"
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    df = df.withColumn(m, F.coalesce(found if only_if is None else F.when(only_if, found), none))
    df = df.withColumn(f"{out}_gap", F.when(F.size(m) > 0, F.transform(F.split(t, pattern, -1), F.length)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(step, F.transform(m, lambda x, i: F.get(F.col(f"{out}_gap"), i) + F.length(x)))
    df = df.withColumn(chunk, F.transform(F.sequence(F.lit(0), F.floor(F.size(m) / _CHUNK).cast("int")),
                                          lambda c: _sum(F.slice(step, c * _CHUNK + 1, F.lit(_CHUNK)))))

    def span(x, i):
        c = F.floor(i / _CHUNK).cast("int")
        start = (_sum(F.slice(chunk, F.lit(1), c)) + _sum(F.slice(step, c * _CHUNK + 1, i - c * _CHUNK)) + F.get(F.col(f"{out}_gap"), i)).cast("int")
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(x)).alias("end"), x.alias("value"))

    return df.withColumn(out, F.transform(m, span)).drop(m, step, chunk, f"{out}_gap")


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "secret":  # digits and letters mixed, and not a few repeated
        return (F.length(digits) >= 3) & (F.length(value) - F.length(digits) >= 3) & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
    return F.lit(True)


def _check(kind: str):
    return lambda x: _valid(kind, x["value"])


def _of_kind(i: int):
    return lambda s: s["kind"] == i


def base_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: all pattern spans, by start and kind."""
    t = F.col(text)
    guard = {"email": t.contains("@"), "phone": t.contains("+"), "ip": t.rlike(r"[0-9]\.[0-9]"), "card": t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")}
    for k, kind in enumerate(KINDS[:4]):
        df = find_matches(df, text, PATTERNS[kind], f"{out}_{kind}", k, guard[kind])
        if kind != "email":
            df = df.withColumn(f"{out}_{kind}", F.filter(f"{out}_{kind}", _check(kind)))
    return df.withColumn(out, F.array_sort(F.concat(*(f"{out}_{k}" for k in KINDS[:4])))).drop(*(f"{out}_{k}" for k in KINDS[:4]))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def _entities(s: Column) -> Column:
    """What a protected span stands for: (level, name) of its value, of the pools it belongs to and of its kind."""
    kind, value = F.get(F.array(*map(F.lit, KINDS)), s["kind"]), F.lower(s["value"])
    digits = F.regexp_replace(value, "[^0-9]", "")

    def pool(name, part):
        return F.struct(F.lit(POOL).alias("level"), F.concat(F.lit(name), part).alias("name"))

    pools = (F.when(kind == "email", F.array(pool("local part ", F.substring_index(value, "@", 1)), pool("domain ", F.substring_index(value, "@", -1))))
             .when(kind == "ip", F.array(pool("network ", F.substring_index(value, ".", 3))))
             .when(kind == "card", F.array(pool("issuer ", F.substring(digits, 1, 6))))
             .when(kind == "phone", F.array(pool("area ", F.substring(digits, 1, 4))))
             .otherwise(F.array().cast("array<struct<level:int,name:string>>")))
    return F.concat(F.array(F.struct(F.lit(VALUE).alias("level"), F.concat_ws(" ", kind, value).alias("name"))), pools,
                    F.array(F.struct(F.lit(KIND).alias("level"), kind.alias("name"))))


def disclosing_terms(private: DataFrame, corpus: DataFrame, min_support: int, generalise_at: float, remove_at: float, min_bits: float) -> DataFrame:
    """(entity, level, name, term, kind, p, bits), a row for each entity or pool that a term discloses.
    private: digest, protected, words of documents with an entity; corpus: t of all documents."""
    near = F.filter("words", lambda w: (w["end"] > F.col("s.start") - NEAR) & (w["start"] < F.col("s.end") + NEAR))
    # a text counts once for a pair, however often the two stand together and however many copies it has
    mentions = (private.withColumn("s", F.explode("protected"))
                .select("digest", F.array_distinct(F.transform(near, lambda w: F.lower(w["value"]))).alias("near"), _entities(F.col("s")).alias("of"))
                .select("digest", "near", F.inline("of")).withColumn("entity", F.xxhash64("level", "name")))
    copies = private.groupBy("digest").agg(F.count("*").alias("copies"))
    named = mentions.groupBy("digest", "entity").agg(F.first("level").alias("level"), F.first("name").alias("name"))
    n_e = named.join(copies, "digest").groupBy("entity").agg(F.sum("copies").alias("n_e"), F.first("level").alias("level"), F.first("name").alias("name"))
    together = materialise(mentions.select("digest", "entity", "level", F.explode("near").alias("term")).distinct().join(copies, "digest"), "mentions")
    often = (together.groupBy("entity", "term").agg(F.count("*").alias("support"), F.sum("copies").alias("n_te"))
             .filter(F.col("support") >= min_support).select("entity", "term", "n_te", F.lit(False).alias("rare")))
    # rarity stands for support: every mention in one text, or every mention beside one entity
    rare = (together.filter(F.col("level") == VALUE).groupBy("term")
            .agg(F.count("*").alias("pairs"), *(f(c).alias(f"{n}_{c}") for c in ("digest", "entity") for n, f in (("a", F.min), ("b", F.max))),
                 F.max("copies").alias("copies"), F.sum("copies").alias("n"))
            .withColumn("one_text", F.col("a_digest") == F.col("b_digest"))
            .filter(F.col("one_text") | ((F.col("a_entity") == F.col("b_entity")) & (F.col("pairs") < min_support)))
            .select(F.explode(F.array_distinct(F.array("a_entity", "b_entity"))).alias("entity"), "term",
                    F.when(F.col("one_text"), F.col("copies")).otherwise(F.col("n")).alias("n_te"), F.lit(True).alias("rare")))
    pairs = often.unionByName(rare)
    counts = corpus.select(F.explode(F.array_distinct(F.split(F.lower("t"), r"[^\p{L}]++"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    total = corpus.count()
    likely = (pairs.join(counts, "term").withColumn("p", F.col("n_te") / F.greatest("n_t", "n_te"))
              .filter(F.col("p") >= F.when(F.col("rare"), remove_at).otherwise(generalise_at)))
    kind = F.when((F.col("p") >= remove_at) & ~F.col("rare"), KINDS.index("removed")).otherwise(KINDS.index("term"))
    return (likely.join(n_e, "entity").withColumn("bits", F.log2(F.col("p") * F.lit(total) / F.col("n_e")))
            .filter(F.col("bits") >= min_bits).select("entity", "level", "name", "term", kind.alias("kind"), "p", "bits"))


def _texts(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(clean, private): rows without and with a protected entity; the latter with their words, written to the shared folder."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).withColumn("t", F.col("row")[text])
    base = base_spans(rows, "t", "base")
    base = find_matches(base, "t", SECRET, "secret", KINDS.index("secret"), F.col("t").rlike(_SECRET_GUARD))
    base = base.withColumn("protected", F.array_sort(F.concat("base", F.filter("secret", _check("secret"))))).drop("secret").withColumn("digest", F.unhex(F.md5("t")))
    private = find_matches(keep_rows(base, F.size("protected") > 0), "t", LETTERS, "words", _TERM)
    words = F.filter("words", lambda w: (w["end"] - w["start"] >= MIN_LETTERS)
                     & ~F.exists("protected", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    return keep_rows(base, F.size("protected") == 0), materialise(private.withColumn("words", words), "private")


def disclosures(docs: DataFrame, text: str = "text", min_support: int = 3, generalise_at: float = 0.5, remove_at: float = 0.9,
                min_bits: float = 4.0) -> DataFrame:
    """What ``sanitise`` acts on: (entity, level, name, term, kind, p, bits)."""
    return disclosing_terms(_texts(docs, text)[1], docs.select(F.col(text).alias("t")), min_support, generalise_at, remove_at, min_bits)


def sanitise(docs: DataFrame, text: str = "text", min_support: int = 3, generalise_at: float = 0.5, remove_at: float = 0.9,
             min_bits: float = 4.0) -> DataFrame:
    """(row, spans, base, redacted): the input row as a struct, all spans, those by pattern, and the redacted text."""
    clean, private = _texts(docs, text)
    corpus = docs.select(F.col(text).alias("t"))
    terms = materialise(disclosing_terms(private, corpus, min_support, generalise_at, remove_at, min_bits), "terms")

    # a term that discloses a value does so wherever it stands, one that discloses a pool in documents that hold one of it
    texts = private.select("digest", F.explode(F.array_distinct(F.transform("words", lambda w: F.lower(w["value"])))).alias("term")).distinct().join(terms, "term")
    held = (private.select("digest", F.explode("protected").alias("s")).select("digest", F.inline(_entities(F.col("s"))))
            .select("digest", F.xxhash64("level", "name").alias("entity")).distinct())
    found = (texts.filter(F.col("level") == VALUE).select("digest", "term", "kind")
             .union(texts.filter(F.col("level") > VALUE).join(held, ["digest", "entity"], "left_semi").select("digest", "term", "kind")))
    # the few terms with p < 1 are all that other documents can have; a table of their own shows Spark how small they are
    spread = materialise(terms.filter((F.col("level") == VALUE) & (F.col("p") < 1)).select("term", "kind"), "spread-terms")
    elsewhere = (corpus.select(F.unhex(F.md5("t")).alias("digest"), F.explode(F.array_distinct(F.split(F.lower("t"), r"[^\p{L}]++"))).alias("term"))
                 .join(spread, "term").select("digest", "term", "kind"))
    # merged at every size: private documents are shuffled, others only if the terms found in them outgrow a broadcast
    private = private.join(_by_text(found).hint("merge"), "digest", "left")
    clean = clean.join(materialise(_by_text(elsewhere), "terms-elsewhere"), "digest", "left")
    clean = find_matches(clean, "t", LETTERS, "words", _TERM, F.col("terms").isNotNull())
    same = ["row", "t", "base", "protected", "words", "terms"]
    return _redacted(private.select(same)).union(_redacted(clean.select(same)))


def _by_text(found: DataFrame) -> DataFrame:
    """(digest, terms): a map from term to kind, from rows (digest, term, kind)."""
    return (found.groupBy("digest", "term").agg(F.max("kind").alias("kind"))
            .groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("terms")))


def _redacted(df: DataFrame) -> DataFrame:
    """(row, spans, base, redacted) from t, base, protected, words and the disclosing terms of the text."""
    hits = F.filter(F.transform("words", lambda w: F.struct(w["start"].alias("start"), F.element_at("terms", F.lower(w["value"])).alias("kind"),
                                                            w["end"].alias("end"), w["value"].alias("value"))), lambda w: w["kind"].isNotNull())
    df = df.withColumn("spans", F.when(F.col("terms").isNull(), F.col("protected")).otherwise(F.array_sort(F.concat("protected", hits))))
    tokens = F.array(*(F.lit(TOKENS[k]) for k in KINDS))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(acc, s):
        more = F.concat(acc["out"], F.substr("t", acc["at"] + 1, s["start"] - acc["at"]), F.get(tokens, s["kind"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

    redacted = F.when(F.size("spans") == 0, F.col("t")).otherwise(
        F.aggregate("spans", begin, put, lambda acc: F.concat(acc["out"], F.substr("t", acc["at"] + 1, F.length("t")))))
    return df.select("row", F.col("spans").cast(_SPAN), F.col("base").cast(_SPAN), redacted.alias("redacted"))


def redact(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """All columns of ``docs``, the text redacted (and ``n_chars``, where there is one, set to its length)."""
    out = sanitise(docs, text, **limits)
    return out.select(*((F.col("redacted") if c == text else F.length("redacted").cast(docs.schema[c].dataType) if c == "n_chars" else F.col("row")[c]).alias(c)
                        for c in docs.columns))


def op4_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    out = sanitise(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = {k: F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])}
    return out.select(F.col("row.doc_id").alias("doc_id"), *count.values(), F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                      _written(F.col("spans")).alias("spans"))
