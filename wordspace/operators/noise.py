"""Negative draws from the smoothed unigram distribution.

Two samplers, matching the two variants:

* exact categorical (N2): ``x = floor(u * weight_total)`` picks the word with
  ``cdf_lo <= x < cdf_hi``. The interval lookup (a CDF inversion) becomes an
  search in the running mass, which is sent to the tasks, or, where that is too
  large, an equi-join on a bin key: the integer mass is cut into ``bins`` equal
  bins, each word is listed in every bin it overlaps, a draw joins its bin and
  keeps the one word whose interval holds it.
* slot table (N3, N4): ``table_size`` slots, slot ``s`` belongs to the first
  word whose cumulative mass reaches ``s / table_size``; a draw picks a slot.

Draws are hashed uniforms keyed by (epoch, pair id, draw number), so they are
fresh per epoch and identical for any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import task_uniforms, uniform
from ..session import spread
from .encode import join_lookup

# fixed value: slot-table size of the sentence variant
TABLE_SIZE = 1_000_000
# mass bins of the exact lookup: at least this many, and four a word
MIN_BINS = 1 << 16

PAIR_KEY = ("gpos", "off")
# noise mass up to this many bytes is sent to the tasks
MASS_BROADCAST_BYTES = 256 << 20
# pairs drawn for at a time by a task, and rows handed on at a time
PAIRS_AT_ONCE = 1 << 15
ROWS_AT_ONCE = 1 << 16


def bin_of(x, total, bins: int):
    """Bin of an integer mass position: ``floor(x * bins / total)`` in double
    arithmetic. Any non-decreasing function works (a word is listed in the
    bins of its first and last position and all between, so the bin of any
    position inside it lists it); doubles keep it cheap and identical in SQL."""
    return F.floor(F.col(x).cast("double") * F.lit(float(bins)) / F.col(total).cast("double")).cast("long")


def bins_for(noise: DataFrame) -> int:
    """Number of mass bins: a draw meets a bounded number of words in its bin
    on average, whatever the size of the vocabulary."""
    return max(MIN_BINS, 4 * noise.count())


def cdf_bins(noise: DataFrame, bins: int) -> DataFrame:
    """Each word listed once per mass bin it overlaps: ``bin, idx, cdf_lo,
    cdf_hi`` (at most V + bins rows)."""
    w = noise.filter(F.col("weight") > 0).withColumn("_last", F.col("cdf_hi") - 1)
    return w.select(
        F.explode(F.sequence(bin_of("cdf_lo", "weight_total", bins), bin_of("_last", "weight_total", bins))).alias("bin"),
        "idx", "cdf_lo", "cdf_hi", "weight_total",
    )


def held_mass(noise: DataFrame):
    """The words with noise in order of their mass and its running sums, for the
    tasks (12 bytes a word); None if that is above the size of a broadcast
    (checked first) or the words leave gaps."""
    import numpy as np

    if noise.count() * 12 > MASS_BROADCAST_BYTES:
        return None
    words = noise.filter(F.col("weight") > 0).select("idx", "cdf_lo", "cdf_hi", "weight_total").toArrow()
    idx, lo, hi = (words.column(c).to_numpy() for c in ("idx", "cdf_lo", "cdf_hi"))
    order = np.argsort(hi, kind="stable")
    idx, lo, hi = idx[order].astype(np.int32), lo[order], hi[order].astype(np.int64)
    if not np.array_equal(lo, np.concatenate([[0], hi[:-1]])[: len(hi)]):
        return None
    return {"idx": idx, "mass": hi, "total": words.column("weight_total")[0].as_py() if len(hi) else 0}


def merged(batches, rows: int = PAIRS_AT_ONCE):
    """Record batches of about ``rows`` rows, whatever the size they come in."""
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            held.append(batch.slice(a, rows))
            n += held[-1].num_rows
            if n >= rows:
                yield pa.concat_batches(held)
                held, n = [], 0
    if held:
        yield pa.concat_batches(held)


# words that a draw may pass from where its bin of the mass begins
STEPS = 8


def mass_guide(mass):
    """For ``mass_places``: the running mass with an end, the place of the first
    word that reaches into each of equal bins of the mass (two to four a word), and
    the bits by which a position is shifted to its bin."""
    import numpy as np

    total = int(mass[-1]) if len(mass) else 0
    shift = max(0, total.bit_length() - len(mass).bit_length() - 1)
    starts = np.arange((total >> shift) + 1, dtype=np.int64) << shift
    return np.append(mass, np.iinfo(np.int64).max), np.searchsorted(mass, starts, side="right").astype(np.int32), shift


def mass_places(guide, x):
    """``searchsorted(mass, x, side="right")`` for positions from 0 to the mass's
    total: a few steps from the bin's first word, not a search of the whole mass."""
    import numpy as np

    mass, first, shift = guide
    x = x.ravel()
    at = first[x >> shift]
    todo = np.flatnonzero(mass[at] <= x)
    for _ in range(STEPS):
        if not len(todo):
            return at
        at[todo] += 1
        todo = todo[mass[at[todo]] <= x[todo]]
    at[todo] = np.searchsorted(mass[:-1], x[todo], side="right")
    return at


def mass_draws(held: dict, part, k: int, seed: int, epoch: int, key=PAIR_KEY):
    """N2 in a task: the words of ``k`` draws for each pair of an Arrow batch, and
    whether a draw met one."""
    import numpy as np

    if "guide" not in held:  # once a worker
        held["guide"] = mass_guide(held["mass"])
    u = task_uniforms("neg", seed, (epoch,), [part.column(part.schema.get_field_index(c)) for c in key], range(k))
    at = mass_places(held["guide"], np.floor(u * float(held["total"])).astype(np.int64)).reshape(u.shape)
    return held["idx"][np.minimum(at, len(held["idx"]) - 1)], at < len(held["idx"])


def held_slots(slots: DataFrame, words: int, table_size: int) -> dict:
    """The slot table and each word's run of slots, for the tasks."""
    import numpy as np

    runs = slots.groupBy("idx").agg(F.min("slot").cast("long").alias("lo"), F.count(F.lit(1)).alias("n")).toArrow()
    idx, lo, n = (runs.column(c).to_numpy() for c in ("idx", "lo", "n"))
    held = {"size": table_size, "lo": np.full(words, table_size + 1, np.int64), "n": np.zeros(words, np.int64), "slots": np.full(table_size, -1, np.int32)}
    held["lo"][idx], held["n"][idx] = lo, n
    for i, a, m in zip(idx, lo, n, strict=True):
        held["slots"][a : a + m] = i
    return held


def slot_draws(held: dict, part, k: int, seed: int, epoch: int, key=PAIR_KEY):
    """N5 in a task: the words of ``k`` draws, neither center nor context, for each
    pair of an Arrow batch, and whether a draw met one."""
    import numpy as np

    center, context = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("center", "context"))
    lo_c, n_c, lo_o = held["lo"][center], held["n"][center], held["lo"][context]
    n_o = np.where(center == context, 0, held["n"][context])
    left = held["size"] - n_c - n_o
    if (left <= 0).any():
        raise ValueError("no slot is left beside center and context")
    u = task_uniforms("negtable", seed, (epoch,), [part.column(part.schema.get_field_index(c)) for c in key], range(k))
    s = np.floor(u * left[:, None]).astype(np.int64)
    first = lo_c <= lo_o
    for at, n in ((np.where(first, lo_c, lo_o), np.where(first, n_c, n_o)), (np.where(first, lo_o, lo_c), np.where(first, n_o, n_c))):
        s += np.where(s >= at[:, None], n[:, None], 0)
    word = np.where(s < held["size"], held["slots"][np.minimum(s, held["size"] - 1)], -1)
    return np.maximum(word, 0), word >= 0


def draw_exact(
    pairs: DataFrame,
    noise: DataFrame,
    k: int,
    seed: int = 42,
    epoch: int = 1,
    bins: int | None = None,
    key=PAIR_KEY,
    carry: tuple[str, ...] = (),
    spread_input: bool = True,
    summed: str | None = None,
) -> DataFrame:
    """N2 + N6 + E8: ``k`` independent draws per pair, long form
    ``(*key, *carry, k, neg)``; the center and context may be drawn
    (variant A). With ``summed`` (an integer column of the key) the draws are added up where
    they are made and only these sums leave a task: ``(neg, n_draws, sum_<summed>)``, a
    row per word and task. Draws are looked up where their pair lies, in the running mass of
    the words, if its checked size allows a broadcast; otherwise, for keys that
    are no integers, or where ``bins`` is given, they are joined with bins of the mass."""
    src = pairs.select(*key, *carry)
    src = spread(src, *key) if spread_input else src
    whole = all(dict(src.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") for c in key)
    held = held_mass(noise) if whole and bins is None else None
    if held is None:
        joined = _joined_draws(src, noise, k, seed, epoch, bins or bins_for(noise), key, carry)
        if summed is None:
            return joined
        return joined.groupBy("neg").agg(F.count(F.lit(1)).alias("n_draws"), F.sum(summed).cast("long").alias(f"sum_{summed}"))
    sent = src.sparkSession.sparkContext.broadcast(held)
    names = src.columns

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in merged(batches):
            if not len(sent.value["idx"]):
                continue
            neg, hit = mass_draws(sent.value, part, k, seed, epoch, key)
            row, draw = np.nonzero(hit)
            for a in range(0, len(row), ROWS_AT_ONCE):
                at, no = row[a : a + ROWS_AT_ONCE], draw[a : a + ROWS_AT_ONCE]
                rows = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(no.astype(np.int32)), pa.array(neg[at, no])], names=[*names, "k", "neg"])

    def run_summed(batches):
        import numpy as np
        import pyarrow as pa

        held = sent.value
        n_draws, sums = (np.zeros(len(held["idx"]), np.int64) for _ in range(2))
        place = np.zeros(int(held["idx"].max(initial=-1)) + 1, np.int64)
        place[held["idx"]] = np.arange(len(held["idx"]))
        for part in merged(batches):
            if not len(held["idx"]):
                continue
            neg, hit = mass_draws(held, part, k, seed, epoch, key)
            at = place[neg[hit]]
            value = part.column(part.schema.get_field_index(summed)).fill_null(0).to_numpy().astype(np.int64)
            np.add.at(n_draws, at, 1)
            np.add.at(sums, at, np.repeat(value, hit.sum(axis=1)))
        some = np.flatnonzero(n_draws)
        for a in range(0, len(some), ROWS_AT_ONCE):
            at = some[a : a + ROWS_AT_ONCE]
            yield pa.RecordBatch.from_arrays([pa.array(held["idx"][at]), pa.array(n_draws[at]), pa.array(sums[at])], names=["neg", "n_draws", f"sum_{summed}"])

    if summed is not None:
        return src.mapInArrow(run_summed, f"neg int, n_draws long, sum_{summed} long")
    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("k", T.IntegerType()), T.StructField("neg", T.IntegerType())]))


def _joined_draws(src: DataFrame, noise: DataFrame, k: int, seed: int, epoch: int, bins: int, key, carry) -> DataFrame:
    """The draws of ``draw_exact`` by an equi-join with the bins of the mass."""
    table = cdf_bins(noise, bins)
    total = noise.select("weight_total").limit(1)
    draws = src.join(F.broadcast(total), how="cross").select(
        *key, *carry, "weight_total", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k")
    )
    u = uniform("neg", seed, F.lit(epoch), *key, "k")
    # non-nullable keys: otherwise inferred isnotnull filters re-evaluate md5
    draws = draws.withColumn("_x", F.coalesce(F.floor(u * F.col("weight_total")).cast("long"), F.lit(-1).cast("long")))
    draws = draws.withColumn("_bin", F.coalesce(bin_of("_x", "weight_total", bins), F.lit(-1).cast("long")))
    hit = join_lookup(draws, table.withColumnRenamed("bin", "_bin").drop("weight_total"), ["_bin"])
    hit = hit.filter((F.col("cdf_lo") <= F.col("_x")) & (F.col("_x") < F.col("cdf_hi")))
    return hit.select(*key, *carry, "k", F.col("idx").alias("neg"))


def slot_ranges(noise: DataFrame, table_size: int = TABLE_SIZE) -> DataFrame:
    """Slots owned by each word, ``[slot_lo, slot_hi]`` inclusive (left
    search: slot s goes to the first word with cdf_hi * M >= s * total).
    Words lighter than one slot may own none."""
    lo = F.expr(f"CAST(cdf_lo AS DECIMAL(38,0)) * {table_size} div weight_total") + 1
    hi = F.expr(f"CAST(cdf_hi AS DECIMAL(38,0)) * {table_size} div weight_total")
    lo = F.when(F.col("idx") == 0, F.lit(0)).otherwise(lo)
    hi = F.least(hi, F.lit(table_size - 1))
    out = noise.select("idx", lo.cast("int").alias("slot_lo"), hi.cast("int").alias("slot_hi"))
    return out.filter(F.col("slot_lo") <= F.col("slot_hi")).withColumn(
        "n_slots", F.col("slot_hi") - F.col("slot_lo") + 1
    )


def slot_table(noise: DataFrame, table_size: int = TABLE_SIZE) -> DataFrame:
    """N3 materialised: ``slot int, idx int`` (``table_size`` rows)."""
    r = slot_ranges(noise, table_size)
    return r.select(F.explode(F.sequence("slot_lo", "slot_hi")).alias("slot"), "idx")


def draw_from_table(
    pairs: DataFrame,
    slots: DataFrame,
    attempts_from: int,
    attempts_to: int,
    seed: int = 42,
    epoch: int = 1,
    table_size: int = TABLE_SIZE,
    key=PAIR_KEY,
    carry: tuple[str, ...] = (),
    spread_input: bool = True,
) -> DataFrame:
    """Draws ``a in [attempts_from, attempts_to)`` per pair from the slot
    table: ``(*key, *carry, a, neg)``."""
    src = pairs.select(*key, *carry)
    src = spread(src, *key) if spread_input else src
    draws = src.select(
        *key, *carry, F.explode(F.sequence(F.lit(attempts_from), F.lit(attempts_to - 1))).alias("a")
    )
    u = uniform("negtable", seed, F.lit(epoch), *key, "a")
    draws = draws.withColumn("slot", F.coalesce(F.floor(u * table_size).cast("int"), F.lit(-1)))
    hit = join_lookup(draws, slots, ["slot"])
    return hit.select(*key, *carry, "a", F.col("idx").alias("neg"))


def draw_excluding(
    pairs: DataFrame,
    slots: DataFrame,
    k: int,
    seed: int = 42,
    epoch: int = 1,
    table_size: int = TABLE_SIZE,
    key=PAIR_KEY,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``k`` negatives per pair that are neither its center nor its context.

    A word owns one run of slots, so the table without the two words is the
    table with at most two gaps: a draw is uniform over the slots that are left
    and moves past the gaps that lie at or before it. This is exact, needs no
    second try, and fails only for a pair that leaves no slot.

    Output ``(*key, *carry, k, neg)`` with ``k`` in 0..k-1."""
    runs = slots.groupBy("idx").agg(F.min("slot").cast("long").alias("lo"), F.count(F.lit(1)).alias("n"))
    src = pairs.select(*key, "center", "context", *[c for c in carry if c not in ("center", "context")])
    for col, tag in (("center", "c"), ("context", "o")):
        named = runs.select(F.col("idx").alias(col), F.col("lo").alias(f"_lo_{tag}"), F.col("n").alias(f"_n_{tag}"))
        src = join_lookup(src, named, [col], how="left")
    n_c = F.coalesce("_n_c", F.lit(0))
    n_o = F.when(F.col("center") == F.col("context"), F.lit(0)).otherwise(F.coalesce("_n_o", F.lit(0)))
    none = F.lit(table_size + 1).cast("long")
    src = src.withColumn("_c", F.struct(F.coalesce("_lo_c", none).alias("lo"), n_c.cast("long").alias("n")))
    src = src.withColumn("_o", F.struct(F.coalesce("_lo_o", none).alias("lo"), n_o.cast("long").alias("n")))
    src = src.withColumn("_left", F.lit(table_size) - F.col("_c.n") - F.col("_o.n"))
    src = src.withColumn("_left", F.when(F.col("_left") > 0, F.col("_left")).otherwise(F.raise_error(F.lit("no slot is left beside center and context")).cast("long")))
    src = src.select(*key, *carry, "_left", F.least("_c", "_o").alias("_a"), F.greatest("_c", "_o").alias("_b"))
    draws = src.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k"))
    first = F.floor(uniform("negtable", seed, F.lit(epoch), *key, "k") * F.col("_left")).cast("long")
    draws = draws.withColumn("_s", first)
    for gap in ("_a", "_b"):
        draws = draws.withColumn("_s", F.col("_s") + F.when(F.col("_s") >= F.col(f"{gap}.lo"), F.col(f"{gap}.n")).otherwise(F.lit(0)))
    draws = draws.select(*key, *carry, "k", F.coalesce(F.col("_s").cast("int"), F.lit(-1)).alias("slot"))
    return join_lookup(draws, slots, ["slot"]).select(*key, *carry, "k", F.col("idx").alias("neg"))
