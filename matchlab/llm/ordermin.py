"""Order MinHash fingerprints, with DataFrame functions only.

The k-mers of a text are its runs of ``K`` words (a text with fewer words:
all of them), each with the number of its occurrence in the text. A hash of
both puts them into ``BINS`` bins and in an order within their bin. From
each bin the two smallest are selected; they are put in the order in which
they stand in the text, and hashed as a tuple, so exchanged passages change
a fingerprint and not only missing ones. The fingerprint lists bin and tuple
of every bin that isn't empty.

All of it works on one array of longs for each text: a k-mer's hash and
place share a long, so both sorts are sorts of primitive arrays. (40 bits
are the hash, 24 the place; places beyond 2^24 words wrap around.)

The likeness of two fingerprints is the square root of the share of bins with
equal tuples among those that either has: both k-mers of a tuple have to be
shared, so the root estimates the share of common k-mers in like order.

Defined results: null and empty texts, and those of white space only, have an
empty fingerprint, like only to an empty one; equal texts have equal
fingerprints; rows equal in id and text are one document; a null id comes
last in the order; a single document is its own next; an empty table gives
an empty one; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from matchlab.llm.common import id_text, materialize, partitions_for

K = 2
BINS = 64       # fixed by the six top bits of the hash
_PLACE = (1 << 24) - 1


def _sketch_steps(name: str) -> list[tuple[str, callable]]:
    """Successive columns that lead from the text column ``name`` to its tuples ``name_t``."""
    c = lambda s: F.col(f"{name}_{s}")

    def words() -> Column:
        ink = F.regexp_replace(F.col(name), "^[ \t-\r]+", "")
        return F.filter(F.split(ink, "[ \t-\r]+"), lambda w: w != "")

    def kmers() -> Column:
        h = c("h")
        return F.when(F.size(h) < K, F.transform(F.slice(h, 1, 1), lambda x: F.xxhash64(x))).otherwise(
            F.transform(F.slice(h, 1, F.greatest(F.size(h) - (K - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, K)])))

    def placed() -> Column:
        return F.sort_array(F.transform(c("k"), lambda x, i: x.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(F.coalesce(i.cast("bigint").bitwiseAND(F.lit(_PLACE)), F.lit(0)))))

    def numbered() -> Column:
        s = c("p")
        kmer = lambda i: F.shiftright(F.get(s, i), 24)

        def one(x, i):
            own = F.shiftright(x, 24)
            # equal k-mers stand together: halving steps lead to the first of them
            steps = F.array(*[F.lit(1 << b) for b in range(23, -1, -1)])
            first = F.aggregate(steps, i, lambda at, step: F.when((at >= step) & (kmer(at - step) == own), at - step).otherwise(at))
            nth = F.when((i == 0) | (kmer(i - 1) != own), F.lit(0)).otherwise(i - first)
            return F.coalesce(F.xxhash64(own, nth).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(x.bitwiseAND(F.lit(_PLACE))), F.lit(0))

        return F.sort_array(F.transform(s, one))

    def smallest() -> Column:
        s = c("n")
        return F.filter(s, lambda x, i: (i < 2) | (F.shiftright(F.get(s, i - 2), 58) != F.shiftright(x, 58)))

    def tuples() -> Column:
        s = c("s")

        def one(x, i):
            mate = F.get(s, i + 1)
            paired = mate.isNotNull() & (F.shiftright(mate, 58) == F.shiftright(x, 58))
            low, high = F.shiftright(x, 24), F.shiftright(mate, 24)
            value = F.when(~paired, F.xxhash64(low)).when(x.bitwiseAND(F.lit(_PLACE)) < mate.bitwiseAND(F.lit(_PLACE)), F.xxhash64(low, high)).otherwise(F.xxhash64(high, low))
            begins = (i == 0) | (F.shiftright(F.get(s, i - 1), 58) != F.shiftright(x, 58))
            return F.when(begins, F.shiftleft(F.shiftrightunsigned(x, 58), 24).bitwiseOR(value.bitwiseAND(F.lit(_PLACE))))

        return F.filter(F.transform(s, one), lambda x: x.isNotNull())

    return [("h", lambda: F.transform(words(), lambda w: F.xxhash64(w))), ("k", kmers), ("p", placed), ("n", numbered), ("s", smallest), ("t", tuples)]


def sketch(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with the tuples ``<name>_t`` of each text column."""
    keep = df.columns
    for step in zip(*[_sketch_steps(n) for n in names]):
        last = [c for c in df.columns if c not in keep]
        df = df.withColumns({f"{n}_{s}": make() for n, (s, make) in zip(names, step)}).drop(*last)
    return df


def likeness(a: str, b: str) -> Column:
    """0 to 1, of two tuple columns."""
    bins = lambda t: F.transform(F.col(t), lambda x: F.shiftright(x, 24))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, 1.0).otherwise(F.sqrt(F.size(F.array_intersect(a, b)) / either))


def as_text(t: str) -> Column:
    """Eight hexadecimal digits for each bin: its number and its tuple's hash."""
    return F.array_join(F.transform(F.col(t), lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def preceding(docs: DataFrame) -> DataFrame:
    """``doc_id, uid`` and ``prev_id, prev_uid, prev_chars`` of the distinct
    documents of ``docs`` (doc_id, uid, text) in descending order; the first
    is preceded by the last. The ids are dealt out by ranges; what precedes a
    range's first id is the last of the range before, from a table with a row
    for each range."""
    ids = docs.select("doc_id", "uid", F.length("text").alias("n")).distinct()
    order, back = [F.desc_nulls_last("doc_id"), F.desc("uid")], [F.asc_nulls_first("doc_id"), F.asc("uid")]
    ranges = materialize(ids.repartitionByRange(partitions_for(docs, 64), *order).select("*", F.spark_partition_id().alias("part")), "ranges")
    one = F.struct("doc_id", "uid", "n")
    lasts = ranges.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy(*back))).where("k = 1").select("part", one.alias("last"))
    every = Window.orderBy("part")
    lasts = lasts.select("part", F.coalesce(F.lag("last").over(every), F.last("last").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("last"))
    prev = F.coalesce(F.lag(one).over(Window.partitionBy("part").orderBy(*order)), "last")
    return ranges.join(lasts, "part").withColumn("prev", prev).select(
        "doc_id", "uid", F.col("prev.doc_id").alias("prev_id"), F.col("prev.uid").alias("prev_uid"), F.col("prev.n").alias("prev_chars"))


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint, that of the text whose last half is replaced
    by the beginning of the next document, and both likenesses. A document
    sends its predecessor no more than the characters asked for and its own
    tuples, so the texts are shuffled once as a whole."""
    docs = id_text(df, id_col=id_col, text_col=text_col).withColumn("uid", F.xxhash64("text"))
    a, b = docs.alias("a"), preceding(docs).alias("b")
    sent = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.uid") == F.col("b.uid"))).select(
        "prev_id", "prev_uid", F.substring("a.text", F.lit(1), F.floor(F.col("prev_chars") / 2).cast("int")).alias("begin"), F.col("a.text").alias("next"))
    sent = sketch(sent, ["next"]).select("prev_id", "prev_uid", "begin", "next_t").dropDuplicates(["prev_id", "prev_uid"]).alias("c")
    both = a.join(sent, F.col("a.doc_id").eqNullSafe(F.col("c.prev_id")) & (F.col("a.uid") == F.col("c.prev_uid"))).select(
        "a.doc_id", "a.text", "c.begin", "c.next_t", F.length("a.text").cast("bigint").alias("n_chars"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    both = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), "begin")).drop("begin")
    both = sketch(both.withColumn("edited_sha256", F.sha2("edited", 256)), ["text", "edited"])
    return both.select("doc_id", "n_chars", "edited_sha256", as_text("text_t").alias("fingerprint"), as_text("edited_t").alias("edited_fingerprint"),
                       likeness("text_t", "edited_t").alias("near_edited"), likeness("text_t", "next_t").alias("near_next"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    return sketch(id_text(df, id_col=id_col, text_col=text_col), ["text"]).select("doc_id", as_text("text_t").alias("fingerprint"))
