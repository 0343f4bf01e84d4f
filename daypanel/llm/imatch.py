"""I-Match document fingerprints with randomised lexicon subsets.

The lexicon holds the terms (lower-cased words) whose document frequency lies in a band: in at
most ``most_common`` of all documents, where large groups of copies and near copies (texts with
equal signatures, two min-hashes of their terms, that make up 1 / 1000 of all or more) count as one document
each, so that a text's copies don't push its own terms out; and in at least 2 and 1 / ``lexicon`` of all (document,
term) pairs of repeated terms.  The band's rare end bounds the lexicon by ``lexicon`` terms
whatever the corpus, which is why it may be broadcast.  A seeded hash puts each term into one
of 16 subsets on each of up to four levels; level l keeps one term in 8 ** l, so that texts
of very different lengths each have a level with a few terms per subset.  A fingerprint lists,
for every subset with terms of the text, the subset's number (two hex digits, the first is the
level) and the first 8 digits of the MD5 of the text's sorted distinct terms in it.  A text
without any lexicon term has the MD5 of its lower-cased text instead.

Likeness: 1 for equal fingerprints, else the largest share, over levels, of equal subsets among
those filled in either (at least 8 are counted).

``compare`` also edits every text with the start of the next document.  Documents are dealt to
buckets of neighbouring ids at approximate quantiles of the ids (bounded size, one shuffle of
the texts); the first document of each bucket also goes to the bucket before.  Exploding to
terms, the broadcast join, regrouping and the look at the next row all stay in that bucket.

Edge cases: ids are whole numbers, or texts in byte order; null texts are empty; null ids come last and count as one larger than any; rows
with the same id follow each other by the hash of their text; of a single document, the next
is itself; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.common import materialise

SUBSETS, LEVELS = 16, (1, 8, 64, 512)
_SPACE = r"[\x20\x09-\x0D]+"
#: Stands for the row itself among its terms; no word holds a space.
_ROW = " "
#: A document's weight in document frequencies.
ONE = 1_000_000


def terms(text: Column) -> Column:
    """Distinct lower-cased words of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _SPACE)), "")


def signature(words: Column) -> Column:
    """Two min-hashes of a text's terms as one number: equal for most near copies, seldom for other texts."""
    return F.xxhash64(*[F.array_min(F.transform(words, lambda w: F.xxhash64(F.concat(F.lit(f"{i}:"), w)))) for i in (1, 2)])


def lexicon_of(texts: DataFrame, lexicon: int = 200_000, most_common: float = 0.1, seed: int = 1) -> DataFrame:
    """(term, subset, level) of the band; ``texts`` has one column ``text`` without nulls.

    There are at most ``lexicon`` rows: their frequencies add up to no more than all repeated
    terms' frequencies, and each has at least 1 / ``lexicon`` of that sum.
    """
    marked = texts.select(terms(F.col("text")).alias("t")).select("t", signature(F.col("t")).alias("sig"))
    groups = materialise(marked.groupBy("sig").agg(F.count(F.lit(1)).alias("c")))
    n = groups.agg(F.sum("c")).first()[0] or 0
    large = groups.filter((F.col("c") > 1) & (F.col("c") * 1000 >= n))  # at most 1,000 rows
    # millionths of a document, in whole numbers, so that sums don't depend on their order
    weight = F.coalesce(F.floor(F.lit(ONE) / F.col("c")), F.lit(ONE)).cast("long")
    whole = groups.join(F.broadcast(large.select("sig")), "sig", "left_anti").agg(F.sum("c")).first()[0] or 0
    n = whole + large.count()
    df = materialise(marked.join(F.broadcast(large), "sig", "left").select(F.explode("t").alias("term"), weight.alias("w"))
                     .groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("w").alias("weight")).filter("df >= 2"))
    pairs = df.agg(F.sum("df")).first()[0] or 0
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("term")).cast("binary")), 1, 8), 16, 10).cast("long")
    deep = F.floor(h / SUBSETS)
    level = sum((F.when(deep % d == 0, 1).otherwise(0) for d in LEVELS[1:]), F.lit(0))
    return (df.filter((F.col("df") * lexicon >= pairs) & (F.col("weight") <= ONE * max(2, int(n * most_common))))
            .select("term", (h % SUBSETS).cast("int").alias("subset"), level.cast("int").alias("level")))


def fingerprint(kept: Column, text_hash: Column) -> Column:
    """Fingerprint of the kept terms (code, term) of a text with the given hash.

    One pass over the sorted terms closes a subset's list whenever the code changes.
    """
    def close(acc: Column) -> Column:
        return F.concat(acc["out"], F.when(acc["code"] < 0, F.lit("")).otherwise(F.concat(
            F.lit("."), F.lpad(F.hex(acc["code"]), 2, "0"), F.substring(F.md5(acc["list"].cast("binary")), 1, 8))))

    def add(acc: Column, x: Column) -> Column:
        same = acc["code"] == x["code"]
        return F.struct(x["code"].alias("code"),
                        F.when(same, F.concat(acc["list"], F.lit(" "), x["term"])).otherwise(x["term"]).alias("list"),
                        F.when(same, acc["out"]).otherwise(close(acc)).alias("out"))

    start = F.struct(F.lit(-1).alias("code"), F.lit("").alias("list"), F.lit("").alias("out"))
    entries = F.aggregate(F.sort_array(kept), start, add, lambda acc: F.substr(close(acc), F.lit(2)))
    return F.when(F.size(kept) == 0, F.concat(F.lit("="), text_hash)).otherwise(entries)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    x, y = F.split(a, r"\."), F.split(b, r"\.")
    shares = []
    for level in range(len(LEVELS)):
        def on(e: Column) -> Column:
            return F.startswith(e, F.lit(str(level)))

        mine, other = F.filter(x, on), F.filter(y, on)
        same = F.size(F.array_intersect(mine, other))
        used = F.size(F.array_union(F.transform(mine, lambda e: F.substring(e, 1, 2)),
                                    F.transform(other, lambda e: F.substring(e, 1, 2))))
        shares.append(same / F.greatest(used, F.lit(8)))
    plain = F.startswith(a, F.lit("=")) | F.startswith(b, F.lit("="))
    return F.when(a == b, F.lit(1.0)).when(plain, F.lit(0.0)).otherwise(F.greatest(*shares)).cast("double")


def _buckets(keys: DataFrame, rows: int) -> tuple[Column, DataFrame]:
    """(bucket of column k, table of each bucket's first k and the bucket before it, round the end).

    Cut points are approximate quantiles, at most 10,000; their search is a binary search.
    """
    n = keys.count()
    parts = max(1, min(10_000, n // rows))
    cuts = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        cuts = sorted(set(keys.agg(F.percentile_approx("k", at, 20 * parts)).first()[0]))
    if cuts:
        table = F.lit(cuts)
        halves = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
        span = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

        def halve(s: Column, _: Column) -> Column:
            mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            right = (s["lo"] < s["hi"]) & (F.get(table, mid) <= F.col("k"))
            return F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"),
                            F.when(right | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

        bucket = F.aggregate(halves, span, halve)["lo"]
    else:
        bucket = F.lit(0)
    firsts = keys.withColumn("b", bucket).groupBy("b").agg(F.min("k").alias("first")).orderBy("b").collect()
    before = [(r["first"], firsts[i - 1]["b"]) for i, r in enumerate(firsts)]
    return bucket, keys.sparkSession.createDataFrame(before, "first long, before int")


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 1000,
            **options) -> DataFrame:
    """Fingerprints of every text, of its edited text, and likenesses (see the module)."""
    if docs.schema[id_col].dataType.typeName() in ("string", "varchar", "char"):  # the first seven bytes
        start = F.rpad(F.hex(F.substring(F.col(id_col).cast("binary"), 1, 7)), 14, "0")
        order = F.conv(start, 16, 10).cast("long")
    else:
        order = F.col(id_col).cast("long")
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"),
                    F.coalesce(order, F.lit(2**63 - 1)).alias("k"))
    bucket, before = _buckets(d.select("k"), rows)
    lexicon = lexicon_of(d.select("text"), **options)
    marker = d.sparkSession.createDataFrame([(_ROW, -1, -1)], lexicon.schema)
    lexicon = lexicon.union(marker)
    own = F.struct(F.col("b").alias("b"), F.lit(0).alias("extra"))
    guest = F.struct(F.col("before").alias("b"), F.lit(1).alias("extra"))
    dealt = (d.withColumn("b", bucket).join(F.broadcast(before), F.col("k") == F.col("first"), "left")
             .withColumn("at", F.explode(F.when(F.col("first").isNull(), F.array(own)).otherwise(F.array(own, guest))))
             .select("id", "text", "k", "at.b", "at.extra"))
    line = Window.partitionBy("b").orderBy("extra", "k", F.asc_nulls_last("id"), F.xxhash64("text"))
    following = F.coalesce(F.lead("text").over(line), F.col("text"))
    n = F.length("text")
    tail = F.floor(n / 4).cast("int")
    edited = (dealt.withColumn("rn", F.row_number().over(line)).withColumn("next", following)
              .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - tail),
                                             F.substring(F.col("next"), F.lit(1), tail))))
    whole = F.struct(F.col("id"), F.col("extra"), n.cast("long").alias("n_chars"),
                     F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                     F.md5(F.lower("text").cast("binary")).alias("hash"),
                     F.md5(F.lower("edited").cast("binary")).alias("edited_hash"))
    nothing = F.when(F.lit(False), whole)

    def marked(text: Column, f: int) -> Column:
        return F.transform(terms(text), lambda t: F.struct(t.alias("term"), F.lit(f).alias("f"), nothing.alias("row")))

    head = F.array(F.struct(F.lit(_ROW).alias("term"), F.lit(0).alias("f"), whole.alias("row")))
    uses = edited.select("b", "rn", F.explode(F.concat(head, marked(F.col("text"), 1), marked(F.col("edited"), 2))).alias("u"))
    kept = F.struct("code", "term")
    levels = F.when(F.col("level") >= 0, F.sequence(F.lit(0), F.col("level"))).otherwise(F.array(F.lit(0)))
    found = (uses.select("b", "rn", "u.term", "u.f", "u.row").join(F.broadcast(lexicon), "term")
             .select("b", "rn", "term", "f", "row", "subset", F.explode(levels).alias("on"))
             .withColumn("code", F.col("on") * SUBSETS + F.col("subset"))
             .groupBy("b", "rn").agg(F.first("row", ignorenulls=True).alias("row"),
                                     F.collect_list(F.when(F.col("f") == 1, kept)).alias("own"),
                                     F.collect_list(F.when(F.col("f") == 2, kept)).alias("changed")))
    prints = found.select("b", "rn", "row.*", fingerprint(F.col("own"), F.col("row.hash")).alias("fingerprint"),
                          fingerprint(F.col("changed"), F.col("row.edited_hash")).alias("edited_fingerprint"))
    succ = F.coalesce(F.lead("fingerprint").over(Window.partitionBy("b").orderBy("rn")), F.col("fingerprint"))
    return (prints.withColumn("next_fingerprint", succ).filter("extra = 0")
            .select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")))
