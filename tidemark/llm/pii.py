"""Personal data: base patterns plus bootstrapped contextual extraction, native.

Base kinds (email, ip, card, phone) are found by regular expressions over whole
texts; positions come from the lengths of the pieces between matches. The
bootstrap works on identifier-like tokens (with a digit or @), less the
punctuation around them. Seeds are tokens that are a whole base span, and keys:
long runs of letters and digits that no word looks like. A token's lexical
patterns are the two words before it, and the word before with the word behind,
each with the token's coarse class (address, number, other). Over the graph of
patterns and instances a pattern's score is the share of its instances that are
known, if enough are; an instance's score joins those of its confident patterns
(one less the product of what each leaves open) and decides. Rounds go on until no
instance is added. Accepted instances that overlap no base span are added spans of
kind ``id``: long ones wherever they stand, short ones in a confident pattern.

Everything is DataFrame expressions. The graph is aggregated to one row per
(pattern, instance) before any join, so a context or value that fills a third of
all rows is a single edge with a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, if_small, only, written

KINDS = ("email", "ip", "card", "phone", "id")  # order of kinds that start together
#: Share of known instances and number of them that make a pattern confident; score from which an instance is accepted;
#: characters from which an accepted value is marked in every context.
SHARE, SUPPORT, ACCEPT, MARKED = 0.5, 3, 0.6, 8
#: Matches that are placed one after the other; longer runs are placed by chunks of that many.
CHUNK = 64

# Each expression accepts exactly what its base pattern matches leftmost and greedily;
# anchors to run starts (or the end of the match before) only spare retries inside a run.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

_SPAN = "array<struct<a:int,k:int,b:int,v:string>>"


def _placed(pairs: Column, start: Column, kind: int) -> Column:
    """Spans of (piece before, match) pairs, one after the other from ``start``."""
    zero = F.struct(start.alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["p"])
        b = a + F.length(x["m"])
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(F.struct(
            a.alias("a"), F.lit(kind).alias("k"), b.alias("b"), x["m"].alias("v")))).alias("out"))

    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Matches of ``pattern`` as (start, kind, end, value), in code points, end exclusive.

    An array grows by copying, so long runs are cut into chunks whose starts are summed up first: work grows with
    the matches times the length of a chunk and with the square of the number of chunks (of numbers only)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def chunked(pairs: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(1), F.size(pairs), F.lit(CHUNK)), lambda i: F.slice(pairs, i, F.lit(CHUNK)))

        def starts(cs: Column) -> Column:
            wide = F.transform(cs, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + F.length(x["p"]) + F.length(x["m"])))
            zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
            sums = F.aggregate(wide, zero, lambda acc, n: F.struct(
                (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
            return F.flatten(F.zip_with(cs, sums, lambda c, at: _placed(c, at, kind)))

        return F.flatten(F.transform(F.array(chunks), starts))  # the chunks are made once

    def placed(pairs: Column) -> Column:
        return F.when(F.size(pairs) <= CHUNK, _placed(pairs, F.lit(0), kind)).otherwise(chunked(pairs))

    pairs = F.filter(F.arrays_zip(between.alias("p"), found.alias("m")), lambda x: x["m"].isNotNull())
    return F.flatten(F.transform(F.array(pairs), placed))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _byte_parts(v: Column) -> Column:
    """All parts of a dotted number at most 255 (leading zeros count for nothing)."""
    return F.forall(F.split(v, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                    & (F.right(p, F.lit(3)).cast("int") <= 255))


def _luhn(v: Column) -> Column:
    d = F.split(F.reverse(_digits(v)), "")
    total = F.aggregate(F.transform(d, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        (x.cast("int") * 2) % 10 + F.floor(x.cast("int") / 5).cast("int"))), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """All base spans of a text, sorted by start, then kind."""
    none = F.array().cast(_SPAN)
    digits = text.rlike("[0-9]")

    def when(test: Column, spans: Column) -> Column:
        return F.when(test, spans).otherwise(none)

    email = when(F.contains(text, F.lit("@")), _spans(text, _EMAIL, 0))
    ip = when(digits & F.contains(text, F.lit(".")), F.filter(_spans(text, _IP, 1), lambda s: _byte_parts(s["v"])))
    card = when(digits, F.filter(_spans(text, _CARD, 2), lambda s: _luhn(s["v"])))
    phone = when(digits & F.contains(text, F.lit("+")),
                 F.filter(_spans(text, _PHONE, 3), lambda s: F.length(_digits(s["v"])).between(9, 15)))
    return F.array_sort(F.concat(email, ip, card, phone))


#: What a token leaves when the punctuation around it goes, and tokens that are keys.
_HEAD, _TAIL = r"^[^\p{L}\p{N}+]+", r"[^\p{L}\p{N}]+$"
_KEY = r"^(?=(?:[^0-9]*[0-9]){3})(?=(?:[^A-Za-z]*[A-Za-z]){3})[A-Za-z0-9_-]{16,}$"


def _occurrences(found: DataFrame) -> DataFrame:
    """Identifier-like tokens that are a whole base span or overlap none: row key, span, instance, whether it
    is a base span, whether a seed, patterns."""
    zipped = F.arrays_zip(_spans(F.col("text"), _TOKEN, 4).alias("t"), F.split(F.col("text"), _TOKEN, -1).alias("p"))
    rows = found.where(F.col("text").rlike("[0-9@]")).select("id", "h", "base", zipped.alias("z"))
    # the piece behind a token is the one before the next
    rows = rows.select("id", "h", "base", F.inline(F.arrays_zip(
        F.col("z.t").alias("t"), F.col("z.p").alias("p"), F.slice("z.p", F.lit(2), F.size("z")).alias("q")))).where("t is not null")
    rows = rows.select("id", "h", "base", "p", "q", F.col("t.a").alias("a0"), F.col("t.v").alias("v"),
                       F.regexp_replace(F.regexp_replace("t.v", _HEAD, ""), _TAIL, "").alias("core"),
                       F.length(F.regexp_extract("t.v", _HEAD, 0)).alias("skip"))
    rows = rows.where(F.col("core") != "").withColumn("a", F.col("a0") + F.col("skip")).withColumn("b", F.col("a") + F.length("core"))
    whole = F.exists("base", lambda s: (s["a"] == F.col("a")) & (s["b"] == F.col("b")))
    overlaps = F.exists("base", lambda s: (s["a"] < F.col("b")) & (s["b"] > F.col("a")))
    key = F.col("core").rlike(_KEY)
    kind = F.when(F.contains("core", F.lit("@")), "@").when(~F.col("core").rlike(r"\p{L}"), "9").otherwise("a")

    def word(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), "[0-9]+", "9")

    two = r"(?:(?<!\S)(\S++)\s++)?+(?<!\S)(\S++)\s*+$"
    rows = rows.select("id", "h", "a", "b", F.lower("core").alias("instance"), whole.alias("base"), overlaps.alias("overlaps"), key.alias("key"), kind.alias("kind"),
                       word(F.regexp_extract("p", two, 1)).alias("w2"), word(F.regexp_extract("p", two, 2)).alias("w1"),
                       word(F.regexp_extract("q", r"^\s*+(\S++)", 1)).alias("r1")).where(F.col("base") | ~F.col("overlaps"))
    patterns = F.filter(F.array(
        F.when((F.col("w1") != "") & (F.col("w2") != ""), F.concat_ws(" ", "w2", "w1", F.lit("_"), "kind")),
        F.when((F.col("w1") != "") & (F.col("r1") != ""), F.concat_ws(" ", "w1", F.lit("_"), "kind", "r1"))), lambda x: x.isNotNull())
    return rows.select("id", "h", "a", "b", "instance", "base", (F.col("base") | F.col("key")).alias("seed"), patterns.alias("patterns"))


def bootstrap(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted instances, confident patterns) when no round adds an instance any more.

    ``edges``: pattern, instance, seed (boolean), one row per pair. A round joins the known instances to the
    edges, scores patterns, then instances; each but the last adds one instance at least.
    """
    known = written(edges.where("seed").select("instance").distinct(), "known")
    before = known.count()
    while True:
        marked = edges.join(known.withColumn("known", F.lit(1)), "instance", "left")
        pattern = (marked.groupBy("pattern").agg(F.count("*").alias("n"), F.count("known").alias("k"))
                   .where((F.col("k") >= SUPPORT) & (F.col("k") >= SHARE * F.col("n")))
                   .select("pattern", (F.col("k") / (F.col("n") + 1)).alias("score")))
        pattern = written(pattern, "patterns")
        accepted = written(edges.join(pattern, "pattern").groupBy("instance")
                           .agg((1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("score"))
                           .where(F.col("score") >= ACCEPT).select("instance"), "accepted")
        known = written(known.unionByName(accepted).distinct(), "known")
        now = known.count()
        if now == before:
            return accepted, pattern.select("pattern")
        before = now


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def added_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, added): spans that the bootstrap found, by id and text hash; only rows that have some."""
    rows = _keyed(docs, id_col, text_col).where(F.col("text").rlike("[0-9@]"))
    found = written(_occurrences(rows.withColumn("base", base_spans(F.col("text")))), "tokens")
    # an instance is a seed wherever it stands: equal contexts and values are one edge
    edges = found.select(F.explode("patterns").alias("pattern"), "instance", "seed")
    accepted, confident = bootstrap(written(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges"))
    free = found.where(~F.col("base")).join(accepted, "instance", "left_semi")
    short = free.where(F.length("instance") < MARKED).select("id", "h", "a", "b", F.explode("patterns").alias("pattern"))
    spans = free.where(F.length("instance") >= MARKED).select("id", "h", "a", "b").unionByName(
        short.join(confident, "pattern", "left_semi").select("id", "h", "a", "b"))
    return spans.groupBy("id", "h").agg(F.array_sort(F.collect_set(F.struct("a", F.lit(4).alias("k"), "b", F.lit("").alias("v")))).alias("added"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base_col: str = "base",
         all_col: str = "all_spans") -> DataFrame:
    """``docs`` with ``base_col`` and ``all_col`` (arrays of start a, kind number k, end b, value v; sorted).

    Positions count code points, ends are exclusive. A null text counts as
    empty (no spans). Rows, repeated ones too, and further columns stay; columns
    of the two names are replaced. A null id is a value like any other. An empty
    table gives an empty one.
    """
    i, h, added, key = fresh(docs, "__id", "__h", "__added", "__key")
    extra = written(added_spans(docs, id_col, text_col), "added").select(
        F.col("id").alias(i), F.col("h").alias(h), F.col("added").alias(added))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    based = docs.withColumn(key, F.xxhash64(text)).withColumn(base_col, base_spans(text))
    joined = based.join(if_small(extra, 256), F.col(id_col).eqNullSafe(F.col(i)) & (F.col(key) == F.col(h)), "left")
    every = F.when(F.col(added).isNull(), F.col(base_col)).otherwise(F.array_sort(F.concat(base_col, added)))
    return joined.withColumn(all_col, every).drop(i, h, added, key)


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["k"] + 1), s["a"].cast("string"), s["b"].cast("string"))))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span (overlapping ones: the first, then what reaches beyond it) replaced by its kind's name."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["a"] >= acc["at"]
        part = F.concat(F.substr(text, acc["at"] + 1, s["a"] - acc["at"]), F.element_at(names, s["k"] + 1))
        return F.struct(F.greatest(acc["at"], s["b"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], F.array(part))).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, zero, step, lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substr(text, acc["at"] + 1))))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with all spans masked in the texts and ``chars_col``, where there is one, counted anew."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base, spans = fresh(docs, "base", "all_spans")
    out = find(docs, id_col, text_col, base, spans)
    out = out.withColumn(text_col, F.when(F.size(spans) > 0, masked(text, F.col(spans))).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(F.size(spans) > 0, F.length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return only(out, docs.columns)
