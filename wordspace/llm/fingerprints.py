"""SimHash document fingerprints, in DataFrame functions alone.

Method. Terms are the lower-cased five-word shingles of a text (a shorter text
is one term). Each occurrence of a term votes with the signed bits of its
128-bit hash, so a term weighs as often as it occurs. A bit of the fingerprint
is set if more than half of the votes are for it. Votes are counted in packed
lanes: one long holds four 16-bit counters, so 32 sums count 128 bits, and a
text is counted in stretches of ``STRETCH`` terms that no lane can overflow.

``near_pairs`` finds all fingerprints within a Hamming radius: the bits are cut
into blocks, and for each way to keep all but ``radius`` blocks there is one
table keyed by the kept blocks; two fingerprints within the radius share at
least one such key. Equal fingerprints are collapsed first.

Defined results: a null or empty text has no votes and the fingerprint 0; equal
texts have equal fingerprints; repeated rows are rows of their own; a null id
sorts after all others; extra columns are dropped; an empty table gives an empty
result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 128
TERM_WORDS = 5
STRETCH = 60_000  # below 2**16 votes, so that lanes cannot overflow
BUCKETS_PER_PARTITION = 8
LANES = 16  # distance of the bits that share a packed counter
_LANE_MASK = sum(1 << (LANES * i) for i in range(4))
_SPACE = " \t\n\x0b\x0c\r"


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def term_hashes(df: DataFrame, text: str, words: int = TERM_WORDS) -> DataFrame:
    """Adds ``terms``: a 64-bit hash for each run of ``words`` words."""
    split = F.split(F.btrim(F.lower(F.col(text)), F.lit(_SPACE)), "[ \\t-\\r]+")
    df = df.withColumn("_w", F.transform(F.when(F.btrim(F.col(text), F.lit(_SPACE)) != "", split).otherwise(F.array().cast("array<string>")), lambda w: F.xxhash64(w)))
    at = F.sequence(F.lit(0), F.size("_w") - F.lit(words))
    runs = F.transform(at, lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(words)]))
    short = F.when(F.size("_w") > 0, F.array(F.xxhash64("_w"))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn("terms", F.when(F.size("_w") >= words, runs).otherwise(short)).drop("_w")


def _voted(ones: list[Column], votes: Column) -> Column:
    """The 64-bit value whose bits have more than half of the votes."""
    bits = [F.when(2 * o > votes, F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long")).otherwise(F.lit(0).cast("long")) for b, o in enumerate(ones)]
    while len(bits) > 1:
        bits = [x.bitwiseOR(y) for x, y in zip(bits[::2], bits[1::2], strict=True)]
    return bits[0]


def simhash(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with ``hi`` and ``lo``, the halves of the fingerprint. Rows with
    equal keys count as one text. No exchange is needed where ``df`` is already
    dealt by some of the keys."""
    terms = term_hashes(df.select(*keys, _text(text).alias("_t")), "_t").select(*keys, F.posexplode_outer("terms").alias("_at", "h0"))
    terms = terms.select(*keys, F.coalesce(F.floor(F.col("_at") / STRETCH), F.lit(0)).cast("int").alias("_stretch"), "h0", F.when(F.col("h0").isNotNull(), F.xxhash64("h0", F.lit(1))).alias("h1"))
    packed = [F.sum(F.shiftrightunsigned(F.col(h), k).bitwiseAND(F.lit(_LANE_MASK))).alias(f"{h}_{k}") for h in ("h0", "h1") for k in range(LANES)]
    stretches = terms.groupBy(*keys, "_stretch").agg(F.count("h0").alias("_n"), *packed)
    lane = lambda h, b: F.shiftrightunsigned(F.col(f"{h}_{b % LANES}"), b - b % LANES).bitwiseAND(F.lit(0xFFFF))
    sums = [F.sum(lane(h, b)).alias(f"{h}b{b}") for h in ("h0", "h1") for b in range(64)]
    counted = stretches.groupBy(*keys).agg(F.sum("_n").alias("_n"), *sums)
    half = lambda h: _voted([F.coalesce(F.col(f"{h}b{b}"), F.lit(0)) for b in range(64)], F.col("_n"))
    return counted.select(*keys, half("h0").alias("hi"), half("h1").alias("lo"))


def hex_of(hi: str, lo: str) -> Column:
    return F.concat(F.lpad(F.lower(F.hex(hi)), 16, "0"), F.lpad(F.lower(F.hex(lo)), 16, "0"))


def likeness(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """Share of equal bits of two fingerprints."""
    return 1 - (F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))) / F.lit(float(BITS))


def in_order(df: DataFrame, order: str, buckets: int) -> DataFrame:
    """Adds ``bucket``, a stretch of ``order`` (descending), and copies the row
    that follows a bucket's last one into it, marked ``ghost``; after the last
    row of all comes the first. Buckets are cut at quantiles, so that each holds
    about as many rows; the cuts (one number a bucket) go through the driver."""
    shares = [(i + 1) / buckets for i in range(buckets - 1)]
    cuts = df.agg(F.percentile_approx(order, shares, 50 * buckets).alias("q")).first()["q"] if shares else []
    cuts = sorted(set(cuts or []))
    steps = max(1, len(cuts)).bit_length()
    if cuts:
        bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
        # binary search: how many cuts are below the value
        step = lambda at, jump: F.when(F.coalesce(F.get(bounds, at + jump - 1) < F.col(order), F.lit(False)), at + jump).otherwise(at)
        bucket = F.aggregate(F.array(*[F.lit(1 << k) for k in range(steps, -1, -1)]), F.lit(0), step)
    else:
        bucket = F.lit(0)
    marked = df.withColumn("bucket", bucket)
    tops = sorted((r["bucket"], r["top"]) for r in marked.groupBy("bucket").agg(F.max(order).alias("top")).collect())
    if not tops:
        return marked.withColumn("ghost", F.lit(False))
    follow = [(tops[i - 1][1], tops[i][0]) for i in range(len(tops))]  # the lowest bucket is followed by the highest row
    pairs = df.sparkSession.range(1).select(F.explode(F.arrays_zip(F.array(*[F.lit(t).cast("long") for t, _ in follow]).alias("top"), F.array(*[F.lit(b) for _, b in follow]).alias("into"))).alias("p")).select(F.col("p.top").alias("_top"), F.col("p.into").alias("_into"))
    with_ghosts = marked.join(F.broadcast(pairs), F.col(order) == F.col("_top"), "left")
    copies = F.filter(F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g")), F.struct(F.col("_into").alias("b"), F.lit(True).alias("g"))), lambda x: x["b"].isNotNull())
    return with_ghosts.withColumn("_c", F.explode(copies)).withColumn("bucket", F.col("_c.b")).withColumn("ghost", F.col("_c.g")).drop("_c", "_top", "_into")


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text (the last third replaced
    by the start of the next text in descending key order) and their likeness.

    The text moves once: rows are dealt by a stretch of keys, and all that
    follows (next text, votes, next fingerprint) stays in that stretch."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), _text(text).alias("text")).withColumn("ord", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    rows = in_order(rows, "ord", BUCKETS_PER_PARTITION * partitions)
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("ord").desc(), F.xxhash64("text"))
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("nr", F.row_number().over(order)).withColumn("n_chars", F.length("text").cast("long"))
    third = F.expr("CAST(n_chars DIV 3 AS INT)")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - third), F.coalesce(F.col("next_text").substr(F.lit(1), third), F.lit("")))
    rows = rows.select("bucket", "nr", "ghost", "doc_id", "n_chars", "text", edited.alias("edited")).withColumn("edited_sha256", F.sha2("edited", 256))
    own = ["bucket", "nr", "ghost", "doc_id", "n_chars", "edited_sha256"]
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))
    prints = simhash(rows.select(*own, kinds.alias("k")).select(*own, "k.kind", "k.text"), [*own, "kind"])
    of = lambda kind, col: F.max(F.when(F.col("kind") == kind, F.col(col)))
    both = prints.groupBy(*own).agg(of(0, "hi").alias("hi"), of(0, "lo").alias("lo"), of(1, "hi").alias("ehi"), of(1, "lo").alias("elo"))
    by_nr = Window.partitionBy("bucket").orderBy("nr")
    both = both.withColumn("nhi", F.lead("hi").over(by_nr)).withColumn("nlo", F.lead("lo").over(by_nr)).filter("NOT ghost")
    return both.select(
        "doc_id", "n_chars", "edited_sha256",
        hex_of("hi", "lo").alias("fingerprint"), hex_of("ehi", "elo").alias("edited_fingerprint"),
        likeness(F.col("hi"), F.col("lo"), F.col("ehi"), F.col("elo")).alias("near_edited"),
        likeness(F.col("hi"), F.col("lo"), F.col("nhi"), F.col("nlo")).alias("near_next"),
    )


def near_pairs(prints: DataFrame, radius: int, blocks: int | None = None, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints within ``radius`` bits, as (a, b,
    distance) of class ids, and the membership (key, class_id): a class holds
    the rows of one fingerprint and is named by its smallest key."""
    blocks = blocks or radius + 2
    if not 0 <= radius < blocks or BITS % 2:
        raise ValueError("radius must lie below the number of blocks")
    classes = prints.filter("hi IS NOT NULL AND lo IS NOT NULL").groupBy("hi", "lo").agg(F.min(key).alias("class_id"))
    members = prints.join(classes, ["hi", "lo"]).select(F.col(key), "class_id")
    bits = F.concat(F.lpad(F.bin("hi"), 64, "0"), F.lpad(F.bin("lo"), 64, "0"))
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [F.col("_bits").substr(edges[i] + 1, edges[i + 1] - edges[i]) for i in range(blocks)]
    tables = [F.xxhash64(F.lit(t), *[parts[i] for i in keep]) for t, keep in enumerate(combinations(range(blocks), blocks - radius))]
    assert len(tables) == comb(blocks, radius)
    keyed = classes.withColumn("_bits", bits).select("class_id", "hi", "lo", F.explode(F.array(*tables)).alias("_key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    distance = F.bit_count(F.col("a.hi").bitwiseXOR(F.col("b.hi"))) + F.bit_count(F.col("a.lo").bitwiseXOR(F.col("b.lo")))
    found = a.join(b, (F.col("a._key") == F.col("b._key")) & (F.col("a.class_id") < F.col("b.class_id")) & (distance <= radius))
    return found.select(F.col("a.class_id").alias("a"), F.col("b.class_id").alias("b"), distance.alias("distance")).distinct(), members
