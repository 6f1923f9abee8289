"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Fixed patterns find e-mail and IP addresses, card and phone numbers; these base spans always stay.
They seed the bootstrap: the words beside them are lexical patterns, and every identifier-like
token of the corpus (one with a digit or @) is linked with the words beside it. Each round scores
a pattern by the share of all its occurrences in the corpus that stand beside known identifiers
of one kind, and an unknown token by the patterns that it is linked with; what scores high becomes
known and counts in the next round, also as support of patterns that no base span stands beside;
rounds go on until one finds nothing. The score's base is every occurrence of the word, so an
ordinary word that happens to precede an address finds nothing, and clean text stays as it is.

Defined results: null and empty texts have no span. Rows are told apart by id and text, so rows
that share an id keep their own spans, and repeated rows give the same result each; rows without
an id are searched too. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import stored, table

KINDS = ["email", "ip", "card", "phone"]

# The patterns in forms that never backtrack over a repeated group: a match starts where the run
# of its first class starts, or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

#: What a text must hold for a kind to be looked for at all.
TRIGGERS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

#: Identifier-like tokens, and how many characters beside one are searched for a whole word.
TOKEN, CONTEXT_CHARS = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+", 64

#: Known identifiers a pattern needs, and scores that accept a pattern and a token.
LEAST_SUPPORT, LEAST_PATTERN, LEAST_TOKEN = 5, 0.5, 0.8

SPAN = "struct<kind:string,start:int,end:int,value:string>"


def spans(text: Column, pattern: str, kind: str, trigger: str) -> Column:
    """Matches as (kind, start, end, value), in code points: what lies between them gives their places."""
    hits = F.when(text.rlike(trigger), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    places = F.aggregate(
        F.zip_with(hits, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), lambda hit, gap: F.struct(
            hit.alias("value"), F.char_length(gap).alias("gap"), F.char_length(hit).alias("length")
        )),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found")),
        lambda done, hit: F.struct(
            (done["at"] + hit["gap"] + hit["length"]).alias("at"),
            F.concat(done["found"], F.array(F.struct(
                F.lit(kind).alias("kind"), (done["at"] + hit["gap"]).alias("start"),
                (done["at"] + hit["gap"] + hit["length"]).alias("end"), hit["value"].alias("value"),
            ))).alias("found"),
        ),
        lambda done: done["found"],
    )
    return F.when(F.size(hits) > 0, places).otherwise(F.array().cast(f"array<{SPAN}>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled, brings the sum to a multiple of ten."""
    turned = F.reverse(digits)

    def term(place: Column) -> Column:
        digit = F.substring(turned, place, F.lit(1)).cast("int")
        doubled = digit * F.when(place % 2 == 0, 2).otherwise(1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(F.transform(places, term), F.lit(0), lambda total, x: total + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "email":
        return F.lit(True)
    size = F.char_length(_digits(value))
    if kind == "phone":
        return size.between(8, 15)
    return F.when(size.between(16, 19), _luhn(_digits(value))).otherwise(F.lit(False))


def base_spans(text: Column) -> Column:
    """All base spans of a text, by kind and then by place."""

    def valid(kind: str) -> Column:
        return F.filter(spans(text, PATTERNS[kind], kind, TRIGGERS[kind]), lambda s: _valid(kind, s["value"]))

    return F.concat(*map(valid, KINDS))


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Base spans of each row, and its other identifier-like tokens."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("base", base_spans(F.col("text")))
    tokens = F.transform(
        spans(F.col("text"), TOKEN, "", "[0-9@]"),
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.regexp_replace(s["value"], r"""[^\p{L}\p{N}]+$""", "").alias("value"),
        ),
    )
    tokens = F.transform(tokens, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"),
        (s["start"] + F.char_length(s["value"])).alias("end"), s["value"].alias("value"),
    ))
    free = F.filter(tokens, lambda s: (F.char_length(s["value"]) >= 5) & ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
    ))

    def beside(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        left = F.substring(F.col("text"), begin + 1, s["start"] - begin)
        right = F.substring(F.col("text"), s["end"] + 1, F.lit(CONTEXT_CHARS))
        return F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.lower(s["value"]).alias("value"),
            F.lower(F.regexp_extract(left, r"(\S+)\s+$", 1)).alias("left"),
            F.lower(F.regexp_extract(right, r"^\S*\s+(\S+)", 1)).alias("right"),
        )

    return base.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "base",
        F.transform(F.concat("base", free), beside).alias("linked"),
    )


def _graph(scanned: DataFrame) -> DataFrame:
    """One row for each occurrence and each pattern that it is linked with."""
    seen = scanned.where(F.size("linked") > 0).select("doc_id", "text_hash", F.explode("linked").alias("s"))
    sides = F.array(
        F.struct(F.lit("left").alias("side"), F.col("s.left").alias("word")),
        F.struct(F.lit("right").alias("side"), F.col("s.right").alias("word")),
    )
    return (
        seen.select("doc_id", "text_hash", "s.kind", "s.start", "s.end", "s.value", F.explode(sides).alias("p"))
        .where("p.word <> ''")
        .select("doc_id", "text_hash", "kind", "start", "end", "value", "p.side", "p.word")
    )


def _word_counts(docs: DataFrame, text_col: str, words: DataFrame) -> DataFrame:
    """How often each of some words stands anywhere in the corpus."""
    every = docs.select(F.explode(F.split(F.lower(F.col(text_col)), r"\s+")).alias("word"))
    return every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(words, "word")


def _discover(docs: DataFrame, scanned: DataFrame, text_col: str) -> DataFrame:
    """Spans beyond the base: (doc_id, text_hash, kind, start, end)."""
    graph = stored(_graph(scanned))
    edges = stored(graph.groupBy("value", "side", "word").agg(F.count(F.lit(1)).alias("times")))
    # Whatever becomes known, a pattern has no more values and no more occurrences than these.
    most = edges.groupBy("side", "word").agg(F.count(F.lit(1)).alias("values"), F.sum("times").alias("most"))
    most = stored(most.where(F.col("values") >= LEAST_SUPPORT))
    counted = _word_counts(docs, text_col, most.select("word").distinct())
    able = most.join(counted, "word").where(F.col("most") / F.col("n") >= LEAST_PATTERN).select("side", "word", "n")
    links = stored(edges.join(stored(able), ["side", "word"]))
    seeds = graph.where("kind <> ''").groupBy("value").agg(F.min("kind").alias("known"))
    known = stored(seeds.join(links.select("value"), "value", "left_semi").withColumn("score", F.lit(1.0)))
    while True:
        scored = (
            links.join(known, "value")
            .groupBy("side", "word", "n", F.col("known").alias("kind"))
            .agg(F.count(F.lit(1)).alias("support"), F.sum(F.col("times") * F.col("score")).alias("mass"))
            .withColumn("precision", F.least(F.col("mass") / F.col("n"), F.lit(0.99)))
            .where((F.col("support") >= LEAST_SUPPORT) & (F.col("precision") >= LEAST_PATTERN))
        )
        patterns = stored(scored.select("side", "word", F.col("kind").alias("known"), "precision"))
        if patterns.isEmpty():
            break
        found = stored(
            links.join(known.select("value"), "value", "left_anti")
            .join(patterns, ["side", "word"])
            .groupBy("value", "known")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("precision"))))).alias("score"))
            .where(F.col("score") >= LEAST_TOKEN)
            .groupBy("value")
            .agg(F.max_by("known", F.struct("score", "known")).alias("known"), F.max("score").alias("score"))
        )
        if found.isEmpty():
            break
        known = stored(known.union(found.select(known.columns)))
    return (
        graph.where("kind = ''")
        .drop("kind")
        .join(known, "value")
        .join(patterns, ["side", "word", "known"], "left_semi")
        .select("doc_id", "text_hash", F.col("known").alias("kind"), "start", "end")
        .distinct()
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added) for each row: spans of the fixed patterns, and those discovered."""
    scanned = stored(_scanned(docs, id_col, text_col))
    added = _added(docs, scanned, text_col)
    rows = scanned.select("doc_id", "text_hash", "base")
    same = rows["doc_id"].eqNullSafe(added["_id"]) & (rows["text_hash"] == added["_hash"])
    return rows.join(added, same, "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("added")
    )


def _added(docs: DataFrame, scanned: DataFrame, text_col: str) -> DataFrame:
    found = _discover(docs, scanned, text_col)
    return stored(
        found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    )


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with every span of their text replaced by its kind in angle brackets."""
    added = _added(docs, stored(_scanned(docs, id_col, text_col)), text_col)
    added = added.toDF("__pii_id", "__pii_hash", "__pii_added")
    text = F.col("__pii_text")
    every = F.array_sort(F.transform(
        F.concat(
            F.transform("__pii_base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))),
            F.coalesce("__pii_added", F.array().cast("array<struct<kind:string,start:int,end:int>>")),
        ),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    ))
    clean = F.aggregate(
        "__pii_every",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda done, s: F.when(s["start"] < done["at"], F.struct(
            F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out")
        )).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(
                done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]),
                F.lit("<"), F.upper(s["kind"]), F.lit(">"),
            ).alias("out"),
        )),
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text))),
    )
    columns = docs.columns
    rows = docs.withColumn("__pii_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("__pii_base", base_spans(text))
    rows = rows.withColumn("__pii_key", F.xxhash64("__pii_text"))
    same = rows[id_col].eqNullSafe(added["__pii_id"]) & (rows["__pii_key"] == added["__pii_hash"])
    rows = rows.join(added.hint("shuffle_hash"), same, "left").withColumn("__pii_every", every)
    new = F.when(F.size("__pii_every") > 0, clean).otherwise(F.col(text_col))
    return rows.withColumn(text_col, new).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
        )))

    def of_kind(spans: Column, kind: str) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    counts = [F.size(of_kind(F.col("base"), kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    every = F.concat(*[F.array_sort(of_kind(F.concat(base, F.col("added")), kind)) for kind in KINDS])
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
