"""Skip-gram negative-sampling maths as DataFrame plans.

Parameters live in one table ``params(matrix string, idx int, vec
array<double>)`` with ``matrix`` in {'center', 'context'}. A synchronous step
(M12) is one plan: gather joins -> scores -> loss -> the union of center,
context and negative gradient rows -> a grouped vector sum (scatter-add with
duplicates) -> update. A batch applies the *sum* of its pair gradients, all
taken at the batch-start weights.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..functions.hashing import uniform
from .encode import join_lookup
from .noise import PAIRS_AT_ONCE, TABLE_SIZE, draw_exact, draw_excluding, held_mass, held_slots, mass_draws, merged, slot_draws

PAIR_KEY = ("gpos", "off")
# parameter rows up to this many bytes are broadcast to a gather
PARAM_BROADCAST_BYTES = 256 << 20


def init_params(vocab: DataFrame, dim: int, seed: int = 42, context: str = "zeros") -> DataFrame:
    """M1: center rows U(-0.5/d, 0.5/d) from hashed uniforms keyed by
    (idx, dim); context rows zero (``context='hashed'`` gives non-zero rows
    from another salt, for tests that need sigma != 0.5)."""
    # one expression per dimension: inside a lambda the hash would run
    # interpreted, outside whole-stage codegen
    def hashed(salt):
        return F.array(*[(uniform(salt, seed, "idx", F.lit(i)) - F.lit(0.5)) / F.lit(float(dim)) for i in range(dim)])

    center = vocab.select(
        F.lit("center").alias("matrix"),
        F.col("idx").cast("int").alias("idx"),
        hashed("init").alias("vec"),
    )
    if context == "zeros":
        ctx_vec = F.array_repeat(F.lit(0.0), dim)
    elif context == "hashed":
        ctx_vec = hashed("initctx")
    else:
        raise ValueError(context)
    ctx = vocab.select(F.lit("context").alias("matrix"), F.col("idx").cast("int").alias("idx"), ctx_vec.alias("vec"))
    return center.unionByName(ctx)


def matrix_rows(params: DataFrame, matrix: str, idx_name: str, vec_name: str) -> DataFrame:
    return params.filter(F.col("matrix") == matrix).select(F.col("idx").alias(idx_name), F.col("vec").alias(vec_name))


# uses of one parameter row that one join task may meet
HOT_USES = 1_000_000


def _gather(df: DataFrame, rows: DataFrame, on: str, dim: int, hot: DataFrame | None = None, key=PAIR_KEY, hot_uses: int | None = None) -> DataFrame:
    """Join every use of a word with its row. Small tables are broadcast.
    Otherwise words of ``hot`` (idx, uses) are dealt over ``ceil(uses /
    HOT_USES)`` tasks: their rows are copied as often, their uses are salted by
    the pair's id. The hot words are at most all uses over ``HOT_USES``, so
    their list is broadcast."""
    limit = PARAM_BROADCAST_BYTES // (8 * dim + 48)
    if hot is None or rows.count() <= limit:
        return join_lookup(df, rows, [on], limit)
    copies = F.ceil(F.col("uses") / F.lit(hot_uses or HOT_USES)).cast("int").alias("_copies")
    many = F.broadcast(hot.select(F.col("idx").alias(on), copies).filter("_copies > 1"))
    one = F.coalesce("_copies", F.lit(1))
    uses = df.join(many, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*key), one).cast("int")).drop("_copies")
    copied = rows.join(many, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("_copies")
    return uses.join(copied, [on, "_salt"]).drop("_salt")


def row_uses(pairs: DataFrame, negs: DataFrame) -> DataFrame:
    """(idx, uses): the most often that one gather uses a word's row; summed
    map-side, a row per word."""
    most = None
    for source, column in ((pairs, "center"), (pairs, "context"), (negs, "center"), (negs, "neg")):
        one = source.groupBy(F.col(column).alias("idx")).agg(F.count(F.lit(1)).alias("uses"))
        most = one if most is None else most.unionByName(one)
    return most.groupBy("idx").agg(F.max("uses").alias("uses"))


def scored(
    pairs: DataFrame, negs: DataFrame, params: DataFrame, form: str = "clip", key=PAIR_KEY, hot: DataFrame | None = None, hot_uses: int | None = None, dim: int | None = None
):
    """E4 + M4 + M5/M6: positive rows ``(*key, center, context, v_c, u_o,
    s_pos, sig_pos)`` and negative rows ``(*key, k, center, neg, v_c, u_k,
    s_neg, sig_neg)``. ``negs`` carries ``center``; ``hot`` (idx, uses), such as
    ``row_uses`` or the vocabulary's counts, lets hot words be dealt out. With ``dim``
    known and matrices that may be sent to the tasks (checked), positive rows are scored
    where they lie and come without their vectors."""
    first = params.select(F.size("vec").alias("d")).first()
    d = first["d"] if first else 1
    vc = matrix_rows(params, "center", "center", "v_c")
    uo = matrix_rows(params, "context", "context", "u_o")
    uk = matrix_rows(params, "context", "neg", "u_k")
    gather = lambda df, rows, on: _gather(df, rows, on, d, hot, key, hot_uses)
    pos = pairs.select(*key, "center", "context")
    held = None if dim is None else _held_matrices(params, dim, vc.count())
    if held is None:
        pos = gather(gather(pos, vc, "center"), uo, "context").withColumn("s_pos", VX.dot("v_c", "u_o"))
    else:
        pos = _scores_in_tasks(pos, held, dim)
    pos = pos.withColumn("sig_pos", VX.sigmoid(F.col("s_pos"), form))
    neg = gather(gather(negs.select(*key, "k", "center", "neg"), vc, "center"), uk, "neg")
    neg = neg.withColumn("s_neg", VX.dot("v_c", "u_k")).withColumn("sig_neg", VX.sigmoid(F.col("s_neg"), form))
    return pos, neg


def _scores_in_tasks(pairs: DataFrame, held: dict, dim: int) -> DataFrame:
    """``s_pos`` of pairs, summed left to right like ``VX.dot``."""
    sent = pairs.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part in merged(batches):
            vec, out = (sent.value[c].take(part.column(part.schema.get_field_index(c)).to_numpy(), axis=0) for c in ("center", "context"))
            score = np.zeros(len(vec))
            for i in range(dim):
                score += vec[:, i] * out[:, i]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, "s_pos"])

    return pairs.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in pairs.dtypes) + ", s_pos double")


def pair_loss(pos: DataFrame, neg: DataFrame, key=PAIR_KEY) -> DataFrame:
    """M7 (+ M13): ``-ln(sig_pos + eps) - sum_k ln(1 - sig_k + eps)`` per pair."""
    nl = neg.groupBy(*key).agg(F.sum(VX.neg_log(F.lit(1.0) - F.col("sig_neg"))).alias("_neg_loss"))
    out = pos.join(nl, list(key), "left")
    return out.select(
        *key,
        "center",
        "context",
        "s_pos",
        "sig_pos",
        (VX.neg_log(F.col("sig_pos")) + F.coalesce(F.col("_neg_loss"), F.lit(0.0))).alias("loss"),
    )


def gradient_rows(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """M8-M10 as rows ``(matrix, idx, g)``: the union of every contribution."""
    coeff = -(F.lit(1.0) - F.col("sig_pos"))
    rows = [
        pos.select(F.lit("center").alias("matrix"), F.col("center").alias("idx"), VX.scale("u_o", coeff).alias("g")),
        pos.select(F.lit("context").alias("matrix"), F.col("context").alias("idx"), VX.scale("v_c", coeff).alias("g")),
        neg.select(F.lit("center").alias("matrix"), F.col("center").alias("idx"), VX.scale("u_k", F.col("sig_neg")).alias("g")),
        neg.select(F.lit("context").alias("matrix"), F.col("neg").alias("idx"), VX.scale("v_c", F.col("sig_neg")).alias("g")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _held_tables(noise: DataFrame, params: DataFrame, dim: int):
    """Running noise mass and both matrices in order of the words' numbers, for
    the tasks; None if they are above the size of a broadcast (checked first)."""
    n = noise.count()
    if n * (16 * dim + 32) > PARAM_BROADCAST_BYTES:
        return None
    mass, matrices = held_mass(noise), _held_matrices(params, dim, n)
    return None if mass is None or matrices is None else mass | matrices


def _held_matrices(params: DataFrame, dim: int, n: int):
    """Both matrices of ``n`` words in order of the words' numbers, or None."""
    import numpy as np

    if n * 16 * dim > PARAM_BROADCAST_BYTES:
        return None
    held = {}
    for matrix in ("center", "context"):
        flat = params.filter(F.col("matrix") == matrix).select("idx", *[F.col("vec")[i].alias(f"v{i}") for i in range(dim)]).toArrow()
        order = np.argsort(idx := flat.column("idx").to_numpy())
        if not np.array_equal(idx[order], np.arange(n)):
            return None
        held[matrix] = np.stack([flat.column(f"v{i}").to_numpy()[order] for i in range(dim)], axis=1) if n else np.zeros((0, dim))
    return held


def _scored_batches(batches, held: dict, form: str, k: int, seed: int, epoch: int):
    """Of each stretch of pairs: its Arrow columns, rows of centers and targets
    (context first), whether a target counts, and the activations."""
    import numpy as np

    draws = slot_draws if "slots" in held else mass_draws
    for part in merged(batches):
        center, context = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("center", "context"))
        drawn, hit = draws(held, part, k, seed, epoch)
        targets = np.concatenate([context[:, None], drawn], axis=1)
        counts = np.concatenate([np.ones((len(context), 1), bool), hit], axis=1)
        vec, out = held["center"].take(center, axis=0), held["context"].take(targets, axis=0)
        score = np.einsum("bd,bkd->bk", vec, out)
        if form == "clip":
            act = 1.0 / (1.0 + np.exp(-np.clip(score, -VX.SIGMOID_CLIP, VX.SIGMOID_CLIP)))
        else:
            small = np.exp(-np.abs(score))
            act = np.where(score >= 0, 1.0, small) / (1.0 + small)
        yield part, center, targets, counts, vec, out, act


def drawn_loss(
    pairs: DataFrame, noise: DataFrame, params: DataFrame, k: int, seed: int, epoch: int, dim: int, form: str = "clip",
    slots: DataFrame | None = None, table_size: int = TABLE_SIZE, carry: tuple[str, ...] = (),
) -> DataFrame:
    """N2 (with ``slots``: N5) + E4 + M4-M7 in one pass: ``(gpos, off, center,
    context, *carry, loss)`` with the draws of ``draw_exact`` (``draw_excluding``). A pair
    is drawn for and scored where it lies; the two matrices are sent to the tasks
    if their checked size allows a broadcast, otherwise draws and rows are joined."""
    held = _held_tables(noise, params, dim)
    if held is None:
        if slots is None:
            negs = draw_exact(pairs, noise, k, seed, epoch, carry=("center",))
        else:
            negs = draw_excluding(pairs, slots, k, seed, epoch, table_size, carry=("center",))
        pos, neg = scored(pairs, negs, params, form)
        loss = pair_loss(pos, neg).select(*PAIR_KEY, "center", "context", "loss")
        loss = loss.join(pairs.select(*PAIR_KEY, *carry), list(PAIR_KEY)) if carry else loss
        return loss.select(*PAIR_KEY, "center", "context", *carry, "loss")
    if slots is not None:
        held |= held_slots(slots, len(held["center"]), table_size)
    sent = pairs.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for part, _, _, counts, _, _, act in _scored_batches(batches, sent.value, form, k, seed, epoch):
            right = np.concatenate([act[:, :1], 1.0 - act[:, 1:]], axis=1)
            loss = np.where(counts, -np.log(right + VX.LOG_EPS), 0.0).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(loss)], names=[*part.schema.names, "loss"])

    src = pairs.select(*PAIR_KEY, "center", "context", *carry)
    return src.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in src.dtypes) + ", loss double")


def _add_up(sums, rows, columns) -> None:
    """Adds ``columns`` (a value of each row, dimension by dimension) to the rows
    ``rows`` of ``sums``: where the words are many beside the rows the work goes with
    the rows."""
    import numpy as np

    for i, c in enumerate(columns):
        if len(sums) <= 4 * len(rows):
            sums[:, i] += np.bincount(rows, c, len(sums))
        else:
            np.add.at(sums[:, i], rows, c)


def drawn_gradients(pairs: DataFrame, noise: DataFrame, params: DataFrame, k: int, seed: int, epoch: int, dim: int, form: str = "clip") -> DataFrame:
    """N2 + E4 + M4-M10 + V11 in one pass: summed gradients ``(matrix, idx, g)``
    of all pairs. A task adds up the gradients of its pairs, at most a row per
    word and matrix, and only these sums are shuffled."""
    held = _held_tables(noise, params, dim)
    if held is None:
        negs = draw_exact(pairs, noise, k, seed, epoch, carry=("center",))
        pos, neg = scored(pairs, negs, params, form, hot=row_uses(pairs, negs))
        return gradients(pos, neg, dim)
    sent = pairs.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        n = len(sent.value["center"])
        sums, used = {m: np.zeros((n, dim), order="F" if n <= 4 * PAIRS_AT_ONCE else "C") for m in ("center", "context")}, {m: np.zeros(n, bool) for m in ("center", "context")}
        for _, center, targets, counts, vec, out, act in _scored_batches(batches, sent.value, form, k, seed, epoch):
            act[:, 0] -= 1.0
            act[~counts] = 0.0
            pull = np.einsum("bk,bkd->bd", act, out)
            used["center"][center] = True
            used["context"][targets[counts]] = True
            _add_up(sums["center"], center, (pull[:, i] for i in range(dim)))
            _add_up(sums["context"], targets.ravel(), ((act * vec[:, i : i + 1]).ravel() for i in range(dim)))
        for matrix in ("center", "context"):
            idx = np.flatnonzero(used[matrix])
            for a in range(0, len(idx), PAIRS_AT_ONCE):
                at = idx[a : a + PAIRS_AT_ONCE]
                g = pa.FixedSizeListArray.from_arrays(pa.array(sums[matrix][at].ravel()), dim).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array([matrix] * len(at), pa.string()), pa.array(at.astype(np.int32)), g], names=["matrix", "idx", "g"])

    part = pairs.select(*PAIR_KEY, "center", "context").mapInArrow(run, "matrix string, idx int, g array<double>")
    return scatter_sum(part, dim=dim)


def drawn_step(pairs: DataFrame, noise: DataFrame, params: DataFrame, lr: float, k: int, seed: int, epoch: int, dim: int, form: str = "clip") -> DataFrame:
    """M12 on the exact draws of an epoch: the parameters after one synchronous
    step on all ``pairs``."""
    return apply_update(params, drawn_gradients(pairs, noise, params, k, seed, epoch, dim, form), lr, dim)


# dimensions summed by one aggregate row: with the keys and sums of two levels well
# below the number of fields up to which Spark generates code
DIM_BLOCK = 48


def scatter_sum(rows: DataFrame, vec_col: str = "g", by=("matrix", "idx"), dim: int | None = None, mean: bool = False) -> DataFrame:
    """Element-wise vector sum (or mean) per row index.

    With ``dim`` known each vector is cut into blocks of ``DIM_BLOCK`` dimensions
    and one aggregate keyed by (index, block) holds one ``sum`` per dimension of
    a block: fixed-width buffers in generated code whatever the dimension, with
    map-side partial sums (a hot index costs one buffer per task and block, not
    one row per use). The sums of an index, one row a block, are then put
    together. Without ``dim`` the vector ``Summarizer`` is used."""
    if dim is None:
        fn = Summarizer.mean if mean else Summarizer.sum
        agg = rows.groupBy(*by).agg(fn(array_to_vector(F.col(vec_col))).alias("_s"))
        return agg.select(*by, vector_to_array("_s").alias(vec_col))
    width = min(dim, DIM_BLOCK)
    sums = [F.sum(F.get(vec_col, F.lit(i))).alias(f"_s{i}") for i in range(width)]
    scale = (F.lit(1.0) / F.col("_n")) if mean else F.lit(1.0)
    vec = F.array(*[F.col(f"_s{i}") * scale if mean else F.col(f"_s{i}") for i in range(width)]).alias(vec_col)
    if dim <= DIM_BLOCK:
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *sums).select(*by, vec)
    starts = range(0, dim, DIM_BLOCK)
    blocks = F.array(*[F.slice(vec_col, i + 1, DIM_BLOCK) for i in starts])
    cut = rows.select(*by, F.posexplode(blocks).alias("_block", vec_col))
    agg = cut.groupBy(*by, "_block").agg(F.count(F.lit(1)).alias("_n"), *sums).select(*by, "_block", vec)
    # at most dim / DIM_BLOCK rows an index; the last block is filled up with nulls
    whole = agg.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_block", vec_col))).alias("_b"))
    return whole.select(*by, F.slice(F.flatten(F.transform("_b", lambda b: b[vec_col])), 1, dim).alias(vec_col))


def gradients(pos: DataFrame, neg: DataFrame, dim: int | None = None) -> DataFrame:
    return scatter_sum(gradient_rows(pos, neg), dim=dim)


def apply_update(params: DataFrame, grads: DataFrame, lr, dim: int | None = None) -> DataFrame:
    """``W[i] -= lr * sum g`` for touched rows; others unchanged.
    With ``dim`` known the update is unrolled per dimension (codegen'd)."""
    lr_col = lr if not isinstance(lr, (int, float)) else F.lit(float(lr))
    j = params.join(grads, ["matrix", "idx"], "left")
    if dim is None:
        upd = F.zip_with("vec", "g", lambda w, g: w - lr_col * g)
    else:
        upd = F.array(*[F.col("vec")[i] - lr_col * F.col("g")[i] for i in range(dim)])
    new_vec = F.when(F.col("g").isNull(), F.col("vec")).otherwise(upd)
    return j.select("matrix", "idx", new_vec.alias("vec"))


def sync_step(
    pairs: DataFrame, negs: DataFrame, params: DataFrame, lr: float, form: str = "clip", key=PAIR_KEY, dim: int | None = None, hot: DataFrame | None = None
):
    """One synchronous step on the whole ``pairs`` batch. Returns
    ``(new_params, mean_loss_df)``."""
    pos, neg = scored(pairs, negs, params, form, key, hot)
    loss = pair_loss(pos, neg, key).agg(F.avg("loss").alias("mean_loss"), F.count(F.lit(1)).alias("n_pairs"))
    return apply_update(params, gradients(pos, neg, dim), lr, dim), loss


def explode_params(params: DataFrame, digits: int | None = None) -> DataFrame:
    """Long form ``matrix, idx, dim, val`` (for checks and SQL twins)."""
    out = params.select("matrix", "idx", F.posexplode("vec").alias("dim", "val"))
    if digits is not None:
        out = out.withColumn("val", F.round("val", digits))
    return out
