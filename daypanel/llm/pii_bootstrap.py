"""Personal data in whole texts: fixed patterns, and bootstrapped contextual extraction.

Four regular expressions find the base entities (email, ip, card, phone), which are the
seeds.  Every other identifier-like token (five digits or more, or an @) is an unknown
instance, and so is a run of digit groups with space, dot, bracket or hyphen between them
(five to ``MOST`` digits; its tokens are none of their own).  The words before an instance and
those after it, one or two of them, are its lexical patterns.  On the graph of patterns and instances, scores spread in rounds, ``rounds`` at least and until no instance is accepted anew:

    confidence of a pattern for a kind = sum of its instances' scores / (its instances + 1)
    score of an unknown instance       = 1 - product over its confident patterns (1 - confidence)

A pattern counts as confident from ``least`` on and with at least ``support`` worth of
instances.  Unknown instances that end with ``accept`` or more are identifiers of that kind,
wherever they stand.

Everything is columns, joins and aggregations; positions come from the lengths of the
stretches between matches.  The graph has a row per distinct (pattern, instance), grouped by
partial sums, so a frequent word before identifiers is a counter, not a group.

Very long texts: positions, overlaps and contexts cost about as much per match in a long text
as in a short one; only context words longer than ``CHUNK`` characters are looked for in the whole text.

Edge cases: a null text is empty; spans are code points, end exclusive; repeated rows get
the same spans; a null id is carried along; extra columns are ignored or, by ``mask``,
kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Possessive where no shorter match can ever be right, so
# that long runs need no backtracking.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that any text with a match passes.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"(?:[0-9][\x20-]?){15}[0-9]", "phone": r"\+[0-9]"}
#: A word with a digit or an @ in it.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Digit groups written apart, the cheap test for them, and the most digits they have together.
GROUPS = (r"(?<![0-9][\x20().-]{0,3})[+(]{0,2}[0-9]++(?:[\x20().-]{1,3}[0-9]++){1,18}+"
          r"(?![\x20().-]{0,3}[0-9])")
APART = r"[0-9][).-]{0,2}\x20[\x20(.-]{0,2}[0-9]"
MOST = 19
#: Matches in a block of running positions, and characters in a chunk of a text.
BLOCK, CHUNK = 512, 1024
_PLACE = "array<struct<s:int,e:int,v:string>>"
_SPAN = "array<struct<k:int,s:int,e:int>>"


def _let(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (s, e, v).

    Positions are running sums: first inside blocks of ``BLOCK`` matches, then over the blocks, so
    that lists are never extended match by match over their whole length.
    """
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("v"))
    parts = F.filter(parts, lambda x: x["v"].isNotNull())

    def place(s: Column, e: Column, v: Column) -> Column:
        return F.struct(s.alias("s"), e.alias("e"), v.alias("v"))

    def add(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["v"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(place(s, e, x["v"]))).alias("out"))

    def follow(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda m: place(m["s"] + acc["at"], m["e"] + acc["at"], m["v"]))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def blocks(p: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(p) - 1, F.lit(0)) / BLOCK).cast("int"))
        return F.transform(numbers, lambda i: F.slice(p, i * BLOCK + 1, F.lit(BLOCK)))

    first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_PLACE})").alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{_PLACE}>)").alias("out"))
    inner = _let(parts, lambda p: F.transform(blocks(p), lambda b: F.aggregate(b, first, add)))
    return F.flatten(F.aggregate(inner, start, follow)["out"]).cast(_PLACE)


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a text of digits ends in 0."""
    def part(i: Column) -> Column:  # i-th digit from the right, from 0
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    places = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), part)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: p.rlike("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        fits = F.length(digits).between(16, 19)
        return fits & _luhn(F.when(fits, digits).otherwise(F.lit("0")))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Base entities of a text as (kind number, s, e), by kind, then start."""
    none = F.expr(f"cast(array() as {_PLACE})")
    kinds = []
    for k, kind in enumerate(KINDS):
        hint = F.contains(text, F.lit(HINTS[kind])) if kind == "email" else text.rlike(HINTS[kind])
        found = F.filter(F.when(hint, _matches(text, PATTERNS[kind])).otherwise(none), lambda m: _valid(kind, m["v"]))
        kinds.append(F.transform(found, lambda m: F.struct(F.lit(k).alias("k"), m["s"].alias("s"), m["e"].alias("e"))))
    return F.concat(*kinds).cast(_SPAN)


def _digits(m: Column) -> Column:
    return F.length(F.regexp_replace(m["v"], "[^0-9]", ""))


def _clear_of(places: Column, spans: Column) -> Column:
    """The places, none of which overlap each other, that overlap no span: one walk over both by their starts."""
    def event(x: Column, kind: int, v: Column) -> Column:
        return F.struct(x["s"].alias("s"), F.lit(kind).alias("kind"), x["e"].alias("e"), v.alias("v"))

    events = F.array_sort(F.concat(F.transform(spans, lambda b: event(b, 0, F.lit(""))),
                                   F.transform(places, lambda m: event(m, 1, m["v"]))))
    none = F.expr(f"cast(array() as {_PLACE})")

    def walk(acc: Column, x: Column) -> Column:
        span = x["kind"] == 0
        here = F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v")))
        # only the last place can reach beyond the start of the next span
        kept = F.filter(acc["last"], lambda p: p["e"] <= x["s"])
        return F.struct(F.when(span, F.greatest(acc["end"], x["e"])).otherwise(acc["end"]).alias("end"),
                        F.when(span, kept).when(x["s"] >= acc["end"], here).otherwise(none).alias("last"),
                        F.when(span, acc["out"]).otherwise(F.concat(acc["out"], acc["last"])).alias("out"))

    start = F.struct(F.lit(0).alias("end"), none.alias("last"), none.alias("out"))
    walked = F.aggregate(events, start, walk, lambda acc: F.concat(acc["out"], acc["last"])).cast(_PLACE)
    return F.when((F.size(places) == 0) | (F.size(spans) == 0), places).otherwise(walked)


def spaced_groups(text: Column, base: Column) -> Column:
    """Runs of digit groups outside the base entities; those without a space are part of one token."""
    none = F.expr(f"cast(array() as {_PLACE})")
    groups = F.filter(F.when(text.rlike(APART), _matches(text, GROUPS)).otherwise(none),
                      lambda m: F.contains(m["v"], F.lit(" ")) & _digits(m).between(5, MOST))
    return _let(groups, lambda g: _clear_of(g, base))


def unknown_tokens(text: Column, base: Column, groups: Column) -> Column:
    """Identifier-like tokens outside the base entities and groups, without the punctuation around them."""
    none = F.expr(f"cast(array() as {_PLACE})")
    tokens = F.when(text.rlike("[0-9@]"), _matches(text, TOKEN)).otherwise(none)
    # most words with a digit have too few; test that before comparing with spans
    tokens = F.filter(tokens, lambda m: F.contains(m["v"], F.lit("@")) | (_digits(m) >= 5))
    tokens = _let(tokens, lambda t: _clear_of(t, base))
    tokens = _let(tokens, lambda t: _clear_of(t, groups))

    def bare(m: Column) -> Column:
        lead = F.length(F.regexp_extract(m["v"], "^[^A-Za-z0-9+]*", 0))
        v = F.regexp_extract(m["v"], "^[^A-Za-z0-9+]*(.*?)[^A-Za-z0-9]*$", 1)
        s = m["s"] + lead
        return F.struct(s.alias("s"), (s + F.length(v)).alias("e"), v.alias("v")).cast("struct<s:int,e:int,v:string>")

    return F.filter(F.transform(tokens, bare), lambda m: m["e"] > m["s"])


def _piece(text: Column, chunks: Column, s: Column, e: Column) -> Column:
    """``text`` from ``s`` to ``e``; a piece of at most ``CHUNK`` characters is cut from two chunks of the text."""
    c = F.floor(s / CHUNK).cast("int")
    two = F.concat(F.coalesce(F.get(chunks, c), F.lit("")), F.coalesce(F.get(chunks, c + 1), F.lit("")))
    return (F.when(e - s <= CHUNK, F.substring(two, s - c * CHUNK + 1, e - s))
            .otherwise(F.substring(text, s + 1, e - s)))


def _patterns(text: Column, chunks: Column, size: Column, s: Column, e: Column) -> Column:
    """The last word, and the last two, before position ``s``, the first and first two after ``e``; digits alike.

    Words are whole: where 80 characters, or ``CHUNK``, don't hold two of them, all that stands
    before or after is taken.
    """
    word, space = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"
    start = r"(?<![^\x20\x09-\x0D])"

    def whole_words(parts: list[tuple[Column, Column]], rest: Column) -> Column:
        out = F.when(parts[0][1], parts[0][0])
        for piece, enough in parts[1:]:
            out = out.when(enough, piece)
        return F.regexp_replace(F.lower(out.otherwise(rest)), "[0-9]", "0")

    before = [_piece(text, chunks, F.greatest(s - n, F.lit(0)), s) for n in (80, CHUNK)]
    after = [_piece(text, chunks, e, F.least(e + n, size)) for n in (80, CHUNK)]
    left = whole_words([(a, (s <= n) | a.rlike(rf"{space}{word}{space}+{word}{space}*$"))
                        for a, n in zip(before, (80, CHUNK))], F.substring(text, F.lit(1), s))
    right = whole_words([(a, (e + n >= size) | a.rlike(rf"^{space}*{word}{space}+{word}{space}"))
                         for a, n in zip(after, (80, CHUNK))], F.substring(text, e + 1, size - e))
    sides = ((left, rf"{start}({word}){space}*$"), (left, rf"{start}({word}{space}+{word}{space}*)$"),
             (right, rf"^{space}*({word})"), (right, rf"^{space}*({word}{space}+{word})"))
    found = F.array(*[F.concat(F.lit(f"{k} "), F.regexp_extract(x, p, 1)) for k, (x, p) in enumerate(sides, 1)])
    return F.filter(found, lambda p: F.length(p) > 2)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, base, items) per row; items: (kind number or null, s, e, v, patterns)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    d = d.withColumn("base", base_spans(F.col("text"))).withColumn("groups", spaced_groups(F.col("text"), F.col("base")))
    d = d.withColumn("tokens", F.concat("groups", unknown_tokens(F.col("text"), F.col("base"), F.col("groups"))))
    t = F.col("text")
    cut = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def items(whole: Column) -> Column:
        chunks, size = whole["chunks"], whole["size"]

        def known(b: Column) -> Column:
            return F.struct(b["k"].alias("k"), b["s"].alias("s"), b["e"].alias("e"),
                            F.lower(_piece(t, chunks, b["s"], b["e"])).alias("v"), _patterns(t, chunks, size, b["s"], b["e"]).alias("p"))

        def other(m: Column) -> Column:
            return F.struct(F.lit(None).cast("int").alias("k"), m["s"].alias("s"), m["e"].alias("e"),
                            F.lower(m["v"]).alias("v"), _patterns(t, chunks, size, m["s"], m["e"]).alias("p"))

        return F.concat(F.transform("base", known), F.transform("tokens", other))

    # a text is cut and measured once, not once for each item
    cut = F.when(F.size("base") + F.size("tokens") > 0, cut)
    return d.select("id", row_key(F.col("id"), t).alias("key"), "base", _let(F.struct(cut.alias("chunks"), F.length(t).alias("size")), items).alias("items"))


def row_key(id_: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("null")), text).cast("binary"))


def bootstrap(items: DataFrame, rounds: int = 3, least: float = 0.7, support: float = 4.0,
              accept: float = 0.8) -> DataFrame:
    """Unknown instances that the graph of (k, v, patterns) accepts: (v, k, score)."""
    edges = materialise(items.select("v", "k", F.explode("p").alias("p")).groupBy("p", "v").agg(F.min("k").alias("k")))
    size = edges.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    seeds = edges.filter("k is not null").select("v", "k").distinct().withColumn("score", F.lit(1.0))
    unknown = edges.filter("k is null").select("p", "v")
    scores = seeds
    ever = seeds.select("v", "k").limit(0)
    done, fresh = 0, True
    while done < rounds or fresh:
        worth = edges.select("p", "v").join(scores, "v").groupBy("p", "k").agg(F.sum("score").alias("worth"))
        sure = (worth.filter(F.col("worth") >= support).join(size, "p")
                .withColumn("c", F.col("worth") / (F.col("n") + 1)).filter(F.col("c") >= least))
        found = (unknown.join(sure, "p").groupBy("v", "k")
                 .agg((1 - F.exp(F.sum(F.log(1 - F.col("c"))))).alias("score")))
        found = materialise(found)
        scores = seeds.union(found)
        new = materialise(found.filter(F.col("score") >= accept).select("v", "k").join(ever, ["v", "k"], "left_anti"))
        done, fresh, ever = done + 1, not new.isEmpty(), ever.union(new)
    best = found.filter(F.col("score") >= accept).groupBy("v").agg(
        F.max_by("k", F.struct("score", -F.col("k"))).alias("k"), F.max("score").alias("score"))
    return best


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, key, base, spans) of every row: base entities, and all spans with the discovered ones."""
    rows = materialise(scan(docs, id_col, text_col))
    items = rows.select("key", F.explode("items").alias("i")).select("key", "i.k", "i.s", "i.e", "i.v", "i.p")
    accepted = bootstrap(items.select("k", "v", "p"), **options)
    more = (items.filter("k is null").select("key", "v", "s", "e").join(accepted.select("v", "k"), "v")
            .groupBy("key").agg(F.collect_set(F.struct(F.col("k"), F.col("s"), F.col("e"))).alias("more")))
    none = F.expr(f"cast(array() as {_SPAN})")
    return (rows.join(more, "key", "left").select(
        F.col("id").alias(id_col), "key", "base",
        F.array_sort(F.concat("base", F.coalesce(F.col("more").cast(_SPAN), none))).alias("spans")))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a hash of the base spans and all spans as text."""
    counts = [F.size(F.filter("base", lambda b: b["k"] == k)).cast("long").alias(f"n_{name}")
              for k, name in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans become the first."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        piece = F.when(x["s"] >= acc["at"], F.concat(
            F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.element_at(names, x["k"] + 1))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    whole = F.aggregate(by_start, start, add)
    return F.when(F.size(spans) > 0, F.concat(whole["out"], F.substring(text, whole["at"] + 1, F.length(text)))).otherwise(text)


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all spans of ``text_col`` masked; other columns stay.

    Only rows with spans are shuffled to meet them.
    """
    spans = (find(docs.select(id_col, text_col), id_col, text_col, **options).filter(F.size("spans") > 0)
             .groupBy("key").agg(F.first("spans").alias("_spans")).withColumnRenamed("key", "_key"))
    keyed = docs.withColumn("_key", row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))))
    none = F.expr(f"cast(array() as {_SPAN})")
    joined = keyed.join(spans, "_key", "left")
    return joined.select(*[masked(F.col(text_col), F.coalesce("_spans", none)).alias(c) if c == text_col else F.col(c)
                           for c in docs.columns])
