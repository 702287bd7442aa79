"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables (``documents``, ``conversations``,
``embeddings``) in full. Doubles are rounded so results can be compared with
the DuckDB twins in :mod:`wordspace.sql_oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batches as B
from ..operators import encode as E
from ..operators import noise as N
from ..operators import step as ST
from ..operators import pairs as P
from ..operators import vocab as V
from ..session import materialize, written
from ..sources import corpus as C

# fixed parameters of the registered queries
SEED = 42
MIN_COUNT = 5
WINDOW = 5
T_PLAIN = 1e-5
T_ADDITIVE = 1e-4
K_EXACT = 10
K_TABLE = 5
TABLE_SIZE = 1_000_000
PREFIX_TOKENS = 100_000
VOCAB_CAP = 1000
DIGITS = 9
GRAD_DIGITS = 6
DIM = 100
DIM_CHECK = 8
BATCH = 256
EPOCHS_CHECK = 2
LR0 = 0.025
LOG_EVERY = 100
PAIR_LOG_EVERY = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def doc_tokens(spark, sf_dir) -> DataFrame:
    return C.tokenize(documents(spark, sf_dir))


def doc_vocab(spark, sf_dir, min_count: int = MIN_COUNT) -> DataFrame:
    return pinned(spark, sf_dir, f"vocab{min_count}", lambda: V.build_vocab(doc_tokens(spark, sf_dir), min_count))


def r(c, digits: int = DIGITS):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- S / T --------------------------------------------------------------


def q_corpus_stats(spark, sf_dir):
    return C.corpus_stats(documents(spark, sf_dir))


def q_tokens_positions(spark, sf_dir):
    return doc_tokens(spark, sf_dir)


def q_sentence_tokens(spark, sf_dir):
    sents = C.conversation_sentences(table(spark, sf_dir, "conversations"))
    toks = C.explode_sentences(sents.select("sent_id", "tokens"))
    return toks.select(F.col("doc_id").alias("sent_id"), "pos", "word")


def q_token_prefix(spark, sf_dir):
    return C.document_prefix(documents(spark, sf_dir), PREFIX_TOKENS)


def q_text_scan(spark, sf_dir):
    """Documents written as lines of text files, scanned in file order."""
    from ..session import scratch_path

    path = scratch_path(spark, "lines")
    C.write_lines(documents(spark, sf_dir), path)
    return C.tokenize(C.read_text(spark, path)).select(F.col("doc_id").alias("line_no"), "pos", "word")


# --- V / R / P / N ---------------------------------------------------------


def q_word_counts(spark, sf_dir):
    return V.word_counts(doc_tokens(spark, sf_dir), MIN_COUNT)


def q_vocab_ranked(spark, sf_dir):
    return doc_vocab(spark, sf_dir).select("idx", "word", "cnt")


def q_vocab_capped(spark, sf_dir):
    return V.build_vocab(doc_tokens(spark, sf_dir), MIN_COUNT, VOCAB_CAP).select("idx", "word", "cnt")


def q_vocab_frequencies(spark, sf_dir):
    v = V.with_frequencies(doc_vocab(spark, sf_dir))
    return v.select("idx", "word", "cnt", "total", "vocab_size", r("freq", 12).alias("freq"))


def q_keep_prob_plain(spark, sf_dir):
    v = V.keep_probability(doc_vocab(spark, sf_dir), T_PLAIN, "plain")
    return v.select("idx", "word", r("keep_prob").alias("keep_prob"))


def q_keep_prob_additive(spark, sf_dir):
    v = V.keep_probability(doc_vocab(spark, sf_dir), T_ADDITIVE, "additive")
    return v.select("idx", "word", r("keep_prob").alias("keep_prob"))


def q_noise_distribution(spark, sf_dir):
    n = V.noise_table(doc_vocab(spark, sf_dir))
    return n.select("idx", "word", "weight", "weight_total", r("prob", 12).alias("prob"))


def q_noise_cumulative(spark, sf_dir):
    n = V.noise_table(doc_vocab(spark, sf_dir))
    return n.select("idx", "cdf_lo", "cdf_hi")


# --- E / P / R3 / G -----------------------------------------------------


def conv_tokens(spark, sf_dir) -> DataFrame:
    sents = C.conversation_sentences(table(spark, sf_dir, "conversations"))
    return C.explode_sentences(sents.select("sent_id", "tokens"))


def kept_stream(spark, sf_dir, t=T_PLAIN, form="plain", tokens=None):
    """Encoded + subsampled stream with keep probabilities of the given form."""
    toks = doc_tokens(spark, sf_dir) if tokens is None else tokens
    vocab = V.keep_probability(V.build_vocab(toks, MIN_COUNT), t, form)
    enc = E.encode(toks, vocab, carry=("keep_prob",))
    return E.subsample(enc, SEED).drop("keep_prob")


def q_encoded_corpus(spark, sf_dir):
    toks = doc_tokens(spark, sf_dir)
    enc = E.encode(toks, doc_vocab(spark, sf_dir))
    return E.dense_positions(enc, with_doc_pos=True).select("doc_id", "pos", "idx", "dpos")


def q_subsampled_stream(spark, sf_dir):
    return E.dense_positions(kept_stream(spark, sf_dir)).select("doc_id", "pos", "idx", "gpos")


def q_subsampled_sentences(spark, sf_dir):
    kept = kept_stream(spark, sf_dir, T_ADDITIVE, "additive", tokens=conv_tokens(spark, sf_dir))
    out = E.dense_positions(kept, with_doc_pos=True)
    return out.select(F.col("doc_id").alias("sent_id"), "pos", "idx", "dpos")


def q_subsample_report(spark, sf_dir):
    toks = doc_tokens(spark, sf_dir)
    vocab = V.keep_probability(V.build_vocab(toks, MIN_COUNT), T_PLAIN, "plain")
    return E.subsample_report(E.encode(toks, vocab, carry=("keep_prob",)), SEED)


def kept(spark, sf_dir, name, build):
    """Build once per session: the value hangs on the session itself, so it
    goes with it and no other session can meet it."""
    held = spark.__dict__.setdefault("_wordspace_kept", {})
    k = (sf_dir.rstrip("/"), name)
    if k not in held:
        held[k] = build()
    return held[k]


def pinned(spark, sf_dir, name, build):
    """A checkpointed table that many queries share (the pairs, as the trainer
    reuses them per epoch; the vocabulary)."""
    return kept(spark, sf_dir, name, lambda: materialize(build()))


# what steps need of a pair: its words and its id
STEP_COLUMNS = ("center", "context", "gpos", "off")
WORD_COLUMNS = ("center", "context")


def fresh_stream_pairs(spark, sf_dir, columns=None):
    return P.window_pairs(E.dense_positions(kept_stream(spark, sf_dir)), WINDOW, SEED, sentence=False, columns=columns)


def stream_pairs(spark, sf_dir):
    """The pairs for queries that read them more than once, written once."""
    return kept(spark, sf_dir, "stream_pairs", lambda: written(fresh_stream_pairs(spark, sf_dir, STEP_COLUMNS), "stream_pairs"))


def q_pairs_stream(spark, sf_dir):
    return fresh_stream_pairs(spark, sf_dir).select("doc_id", "center_pos", "ctx_doc", "context_pos", "center", "context")


def q_pairs_sentence(spark, sf_dir):
    kept = kept_stream(spark, sf_dir, T_ADDITIVE, "additive", tokens=conv_tokens(spark, sf_dir))
    pairs = P.window_pairs(E.dense_positions(kept), WINDOW, SEED, sentence=True)
    return pairs.select(F.col("doc_id").alias("sent_id"), "center_pos", "context_pos", "center", "context")


def q_pair_counts(spark, sf_dir):
    kept = kept_stream(spark, sf_dir, T_ADDITIVE, "additive")
    pairs = P.window_pairs(E.dense_positions(kept), WINDOW, SEED, sentence=True, columns=WORD_COLUMNS)
    return P.pair_counts(pairs)


# --- N / R5 R6 / M -------------------------------------------------------


def sentence_pairs(spark, sf_dir):
    def build():
        kept = kept_stream(spark, sf_dir, T_ADDITIVE, "additive", tokens=conv_tokens(spark, sf_dir))
        return P.window_pairs(E.dense_positions(kept), WINDOW, SEED, sentence=True, columns=STEP_COLUMNS)

    return kept(spark, sf_dir, "sentence_pairs", lambda: written(build(), "sentence_pairs"))


def conv_noise(spark, sf_dir):
    return V.noise_table(V.build_vocab(conv_tokens(spark, sf_dir), MIN_COUNT))


def doc_noise(spark, sf_dir):
    return V.noise_table(doc_vocab(spark, sf_dir))


def per_neg(negs):
    return negs.groupBy("neg").agg(F.count(F.lit(1)).alias("n_draws"), F.sum("gpos").cast("long").alias("sum_gpos"))


def q_noise_slot_table(spark, sf_dir):
    return N.slot_ranges(doc_noise(spark, sf_dir), TABLE_SIZE)


def q_negatives_exact(spark, sf_dir):
    pairs = fresh_stream_pairs(spark, sf_dir, ("gpos", "off"))  # dealt out by chunks
    sums = N.draw_exact(pairs, doc_noise(spark, sf_dir), K_EXACT, SEED, epoch=1, spread_input=False, summed="gpos")
    return sums.groupBy("neg").agg(F.sum("n_draws").alias("n_draws"), F.sum("sum_gpos").cast("long").alias("sum_gpos"))


def q_negatives_table(spark, sf_dir):
    slots = N.slot_table(conv_noise(spark, sf_dir), TABLE_SIZE)
    return per_neg(N.draw_from_table(sentence_pairs(spark, sf_dir), slots, 0, K_TABLE, SEED, 1, TABLE_SIZE))


def q_negatives_excluding(spark, sf_dir):
    slots = N.slot_table(conv_noise(spark, sf_dir), TABLE_SIZE)
    negs = N.draw_excluding(sentence_pairs(spark, sf_dir), slots, K_TABLE, SEED, 1, TABLE_SIZE)
    return per_neg(negs)


def by_epoch(name, one, epochs=EPOCHS_CHECK):
    """The rows of one epoch after the other, each written, so that the disk holds
    the shuffle of one epoch at a time."""
    out = None
    for e in range(1, epochs + 1):
        rows = written(one(e), name)
        out = rows if out is None else out.unionByName(rows)
    return out


def q_shuffled_batches(spark, sf_dir):
    pairs = stream_pairs(spark, sf_dir)

    def one(e):
        return B.batches(B.shuffle_order(pairs, SEED, e), BATCH).groupBy("epoch", "batch").agg(
            F.count(F.lit(1)).alias("n_pairs"),
            F.sum("center").cast("long").alias("sum_center"),
            F.sum("context").cast("long").alias("sum_context"),
        )

    return by_epoch("shuffled_batches", one)


def q_lr_relative(spark, sf_dir):
    pairs = stream_pairs(spark, sf_dir)
    nb = B.num_batches(pairs.count(), BATCH)
    steps = by_epoch("steps", lambda e: B.batches(B.shuffle_order(pairs, SEED, e, carry=()), BATCH).select("epoch", "batch").distinct())
    out = B.with_batch_lr(steps, nb, EPOCHS_CHECK, LR0)
    return out.select("epoch", "batch", "step", r("lr", 12).alias("lr"))


def q_lr_absolute(spark, sf_dir):
    pairs = sentence_pairs(spark, sf_dir)
    ranked = B.shuffle_order(pairs, SEED, 1)
    out = B.with_pair_lr(ranked, pairs.count(), 1, LR0, 1e-4)
    return out.select("step", r("lr", 12).alias("lr"))


def q_param_init(spark, sf_dir):
    p = ST.init_params(doc_vocab(spark, sf_dir), DIM, SEED)
    return ST.explode_params(p, 12)


def check_model(spark, sf_dir, epoch=1, pairs=None):
    """Stream pairs, exact negatives of ``epoch`` and hashed d=8 params."""
    vocab = doc_vocab(spark, sf_dir)
    pairs = stream_pairs(spark, sf_dir) if pairs is None else pairs
    negs = N.draw_exact(pairs, V.noise_table(vocab), K_EXACT, SEED, epoch, carry=("center",))
    params = ST.init_params(vocab, DIM_CHECK, SEED, context="hashed")
    return pairs, negs, params


def q_sigmoid_forms(spark, sf_dir):
    pairs = fresh_stream_pairs(spark, sf_dir, STEP_COLUMNS)
    _, negs, params = check_model(spark, sf_dir, pairs=pairs)
    pos, _ = ST.scored(pairs, negs, params, dim=DIM_CHECK)
    from ..functions import vectors as VX

    return pos.select(
        "gpos", "off", r("s_pos").alias("s_pos"),
        r(VX.sigmoid_clipped(F.col("s_pos"))).alias("sig_clip"),
        r(VX.sigmoid_branched(F.col("s_pos"))).alias("sig_branch"),
    )


def drawn_model(spark, sf_dir):
    """Noise and hashed d=8 params of the check model, pinned."""
    noise = pinned(spark, sf_dir, "doc_noise", lambda: doc_noise(spark, sf_dir))
    return noise, ST.init_params(noise, DIM_CHECK, SEED, context="hashed")


def losses_of(spark, sf_dir, pairs, epoch=1, carry=()):
    return ST.drawn_loss(pairs, *drawn_model(spark, sf_dir), K_EXACT, SEED, epoch, DIM_CHECK, carry=carry)


def q_pair_loss(spark, sf_dir):
    out = losses_of(spark, sf_dir, fresh_stream_pairs(spark, sf_dir, STEP_COLUMNS))
    return out.select("gpos", "off", "center", "context", r("loss", GRAD_DIGITS).alias("loss"))


def epoch_pair_losses(spark, sf_dir, epochs=EPOCHS_CHECK):
    out = None
    for e in range(1, epochs + 1):
        lo = losses_of(spark, sf_dir, stream_pairs(spark, sf_dir), e).withColumn("epoch", F.lit(e))
        out = lo if out is None else out.unionByName(lo)
    return out


def batch_losses(spark, sf_dir, epochs=EPOCHS_CHECK):
    """Pairs move into the epoch's permutation with their words, which compress
    better than losses, and are scored there."""
    pairs = stream_pairs(spark, sf_dir)

    def one(e):
        losses = losses_of(spark, sf_dir, B.shuffle_order(pairs, SEED, e), e, carry=("rank", "epoch"))
        return B.batches(losses, BATCH).groupBy("epoch", "batch").agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("loss").alias("mean_loss"))

    return by_epoch("batch_losses", one, epochs)


def q_batch_loss(spark, sf_dir):
    bl = batch_losses(spark, sf_dir, 1)
    return bl.select("epoch", "batch", "n_pairs", r("mean_loss", GRAD_DIGITS).alias("mean_loss"))


def q_loss_history(spark, sf_dir):
    nb = B.num_batches(stream_pairs(spark, sf_dir).count(), BATCH)
    h = B.log_windows(batch_losses(spark, sf_dir), nb, LOG_EVERY)
    return h.select("epoch", "window_no", "n_pairs", r("avg_loss", GRAD_DIGITS).alias("avg_loss"))


def q_epoch_loss(spark, sf_dir):
    lo = epoch_pair_losses(spark, sf_dir)
    out = lo.groupBy("epoch").agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("loss").alias("mean_loss"))
    return out.select("epoch", "n_pairs", r("mean_loss", GRAD_DIGITS).alias("mean_loss"))


def q_gradients(spark, sf_dir):
    g = ST.drawn_gradients(fresh_stream_pairs(spark, sf_dir, STEP_COLUMNS), *drawn_model(spark, sf_dir), K_EXACT, SEED, 1, DIM_CHECK)
    out = g.select("matrix", "idx", F.posexplode("g").alias("dim", "g"))
    return out.withColumn("g", r("g", GRAD_DIGITS))


def q_sync_step(spark, sf_dir):
    pairs, (noise, params) = fresh_stream_pairs(spark, sf_dir, STEP_COLUMNS), drawn_model(spark, sf_dir)
    return ST.explode_params(ST.drawn_step(pairs, noise, params, LR0, K_EXACT, SEED, 1, DIM_CHECK), GRAD_DIGITS)


# --- embeddings table: I / E2 / E6 / E7 / R7 / T8 ----------------------------

TOP_K = 10


def emb_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def emb_probes(spark, sf_dir):
    """One probe per label: its smallest vec_id."""
    e = table(spark, sf_dir, "embeddings")
    return e.groupBy("label").agg(F.min("vec_id").alias("id")).select(F.col("id").alias("query_id"), "id")


def emb_words(spark, sf_dir):
    return emb_vectors(spark, sf_dir).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("word"))


def emb_probe_words(spark, sf_dir):
    """Found probes (``v<min id>`` per label) and missing ones
    (``v<max id + 1 + label>``), all derived from the table."""
    e = table(spark, sf_dir, "embeddings")
    mx = e.agg(F.max("vec_id").alias("mx"))
    per = e.groupBy("label").agg(F.min("vec_id").alias("mn")).join(F.broadcast(mx), how="cross")
    found = per.select(F.concat(F.lit("v"), F.col("mn").cast("string")).alias("query"))
    missing = per.select(F.concat(F.lit("v"), (F.col("mx") + 1 + F.col("label")).cast("string")).alias("query"))
    return found.unionByName(missing)


def q_embedding_lookup(spark, sf_dir):
    from ..operators import similarity as S

    hit = S.lookup(emb_vectors(spark, sf_dir), emb_probes(spark, sf_dir))
    return hit.select(F.col("id").alias("vec_id"), "label", F.posexplode("vec").alias("dim", "val")).withColumn(
        "val", r("val")
    )


def q_embedding_table(spark, sf_dir):
    v = emb_vectors(spark, sf_dir)
    return v.select(F.col("id").alias("vec_id"), F.posexplode("vec").alias("dim", "val")).withColumn("val", r("val"))


def q_embedding_norms(spark, sf_dir):
    from ..operators import similarity as S

    return S.norms(emb_vectors(spark, sf_dir)).select(F.col("id").alias("vec_id"), r("norm").alias("norm"))


def q_cosine_all(spark, sf_dir):
    from ..operators import similarity as S

    sc = S.cosine_scores(emb_vectors(spark, sf_dir), emb_probes(spark, sf_dir))
    return sc.select("query_id", F.col("id").alias("vec_id"), r("similarity").alias("similarity"))


def q_cosine_all_max_guard(spark, sf_dir):
    """I3 with the other guard: rows divided by max(norm, 1e-10)."""
    from ..operators import similarity as S

    sc = S.cosine_scores(emb_vectors(spark, sf_dir), emb_probes(spark, sf_dir), guard="max")
    return sc.select("query_id", F.col("id").alias("vec_id"), r("similarity").alias("similarity"))


def q_most_similar(spark, sf_dir):
    from ..operators import similarity as S

    top = S.most_similar(emb_vectors(spark, sf_dir), emb_probes(spark, sf_dir), TOP_K)
    return top.select("query_id", "rank", F.col("id").alias("vec_id"), r("similarity").alias("similarity"))


def q_probe_eval(spark, sf_dir):
    from ..operators import similarity as S

    lines, _ = S.neighbour_lines(emb_vectors(spark, sf_dir), emb_words(spark, sf_dir), emb_probe_words(spark, sf_dir), 8)
    return lines


def q_probe_missing(spark, sf_dir):
    from ..operators import similarity as S

    _, missing = S.probe_words(emb_probe_words(spark, sf_dir), emb_words(spark, sf_dir))
    return missing


# --- D1-D3 ----------------------------------------------------------------


def q_pmi(spark, sf_dir):
    pc = written(P.pair_counts(fresh_stream_pairs(spark, sf_dir, WORD_COLUMNS)), "pair_counts")
    na = pc.groupBy("center").agg(F.sum("n").alias("n_a"))
    nb = pc.groupBy("context").agg(F.sum("n").alias("n_b"))
    tot = pc.agg(F.sum("n").alias("n_total"))
    j = E.join_lookup(E.join_lookup(pc, na, ["center"]), nb, ["context"]).join(F.broadcast(tot), how="cross")
    pmi = F.log((F.col("n").cast("double") * F.col("n_total").cast("double")) / (F.col("n_a").cast("double") * F.col("n_b").cast("double")))
    import math

    return j.select(
        "center", "context", "n", r(pmi).alias("pmi"), r(pmi - F.lit(math.log(K_EXACT))).alias("spmi")
    )


def q_avg_embedding(spark, sf_dir):
    p = ST.init_params(doc_vocab(spark, sf_dir), DIM, SEED, context="hashed")
    c = p.filter("matrix = 'center'").select("idx", F.col("vec").alias("a"))
    x = p.filter("matrix = 'context'").select("idx", F.col("vec").alias("b"))
    avg = c.join(x, "idx").select("idx", F.zip_with("a", "b", lambda u, v: (u + v) / 2.0).alias("vec"))
    return avg.select("idx", F.posexplode("vec").alias("dim", "val")).withColumn("val", r("val", 12))


def q_epoch_redraw(spark, sf_dir):
    toks = doc_tokens(spark, sf_dir)
    vocab = V.keep_probability(V.build_vocab(toks, MIN_COUNT), T_PLAIN, "plain")
    enc = E.encode(toks, vocab, carry=("keep_prob",))
    out = None
    for e in range(1, EPOCHS_CHECK + 1):
        kept = E.subsample(enc, SEED, epoch=e).drop("keep_prob")
        dense = E.dense_positions(kept)
        pairs = P.window_pairs(dense, WINDOW, SEED, sentence=False, epoch=e)
        row = dense.agg(F.count(F.lit(1)).alias("n_kept")).join(
            pairs.agg(F.count(F.lit(1)).alias("n_pairs")), how="cross"
        ).select(F.lit(e).alias("epoch"), "n_kept", "n_pairs")
        out = row if out is None else out.unionByName(row)
    return out


# --- M14 / M15 / S5-S8 (rows-only checks) -----------------------------------


def train_config():
    """The reference defaults: 100 dimensions, 5 epochs, 10 negatives; a task
    holds a sixteenth of the words of each matrix."""
    from .trainer import variant_stream

    return variant_stream(log_every=200, parts=16)


def sentence_config():
    """The sentence variant's defaults: one pair a step, slot table, exclusion."""
    from .trainer import variant_sentence

    return variant_sentence(log_every=20_000)


def q_train_sentence(spark, sf_dir):
    """M15, sentence variant over conversations: epochs, log windows, their
    pairs and rates."""
    from .trainer import fit

    model = kept(spark, sf_dir, "sentence_model", lambda: fit(conv_tokens(spark, sf_dir), sentence_config()))
    return model.history.select("epoch", "window_no", "n_pairs", r("lr", 12).alias("lr"))


def q_pair_log_windows(spark, sf_dir):
    """Log windows over single pairs, in the epoch's permutation."""
    pairs = sentence_pairs(spark, sf_dir)
    noise = pinned(spark, sf_dir, "conv_noise", lambda: conv_noise(spark, sf_dir))
    slots, params = N.slot_table(noise, TABLE_SIZE), ST.init_params(noise, DIM_CHECK, SEED, context="hashed")

    def one(e):
        ranked = B.shuffle_order(pairs, SEED, e)
        losses = ST.drawn_loss(ranked, noise, params, K_TABLE, SEED, e, DIM_CHECK, "branch", slots, TABLE_SIZE, carry=("rank", "epoch"))
        return B.pair_log_windows(losses, PAIR_LOG_EVERY)

    return by_epoch("pair_log_windows", one).withColumn("avg_loss", r("avg_loss", GRAD_DIGITS))


def fitted(spark, sf_dir):
    from .trainer import fit

    return kept(spark, sf_dir, "model", lambda: fit(doc_tokens(spark, sf_dir), train_config()))


def q_train_rounds(spark, sf_dir):
    """Epochs, log windows, their pairs and rates (the losses are in train_loss)."""
    return fitted(spark, sf_dir).history.select("epoch", "window_no", "n_pairs", r("lr", 12).alias("lr"))


def q_train_loss(spark, sf_dir):
    return fitted(spark, sf_dir).history


# fixed values: probe words (frequent words of the driver corpus plus one that is absent)
PROBES = ["the", "of", "ci", "de", "and", "king"]
TOP_N = 8


def neighbours(spark, sf_dir):
    from ..operators import similarity as S

    m = fitted(spark, sf_dir)
    words = m.vocab.select(F.col("idx").cast("long").alias("id"), "word")
    vecs = m.embeddings().select(F.col("idx").cast("long").alias("id"), "vec")
    probes = spark.createDataFrame([(w,) for w in PROBES], "query string")
    return probes, S.neighbour_lines(vecs, words, probes, TOP_N, dim=m.config.dim)


def q_fit_neighbours(spark, sf_dir):
    return neighbours(spark, sf_dir)[1][0]


def q_fit_probe_report(spark, sf_dir):
    """How many neighbours each probe word has; 0: the word is not known."""
    probes, (lines, _) = neighbours(spark, sf_dir)
    listed = lines.select("query", F.size(F.split("neighbours", ", ")).cast("long").alias("n"))
    return probes.join(listed, "query", "left").select("query", F.coalesce("n", F.lit(0)).cast("long").alias("n_neighbours"))


def q_params_roundtrip(spark, sf_dir):
    """Save and load a model whose values SQL knows, value by value."""
    from ..session import scratch_path
    from ..sources import model_io as IO
    from .trainer import Model

    vocab = doc_vocab(spark, sf_dir)
    params = ST.init_params(vocab, DIM, SEED)
    meta = {"vocab_size": vocab.count(), "embedding_dim": DIM, "seed": SEED}
    path = scratch_path(spark, "params")
    IO.save_model(Model(vocab=vocab, params=params, history=None, config=train_config(), meta=meta), path)
    return ST.explode_params(IO.load_model(spark, path).params, 12)


def q_model_roundtrip(spark, sf_dir):
    from ..session import scratch_path
    from ..sources import model_io as IO

    m = fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    IO.save_model(m, path)
    back = IO.load_model(spark, path)
    return back.params.groupBy("matrix").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("vec")).alias("dim")
    ).withColumn("vocab_size", F.lit(back.meta["vocab_size"]))


def q_export_embeddings(spark, sf_dir):
    from ..session import scratch_path
    from ..sources import model_io as IO

    m = fitted(spark, sf_dir)
    path = scratch_path(spark, "embeddings")
    IO.export_embeddings(m, path)
    return IO.load_embeddings(spark, path).select("idx", "word", F.size("vec").alias("dim"))


def q_export_values(spark, sf_dir):
    """S7 + S8: every value of the exported table, for a model whose values SQL
    knows, at the reference's dimension."""
    from ..session import scratch_path
    from ..sources import model_io as IO
    from .trainer import Model

    vocab, config = doc_vocab(spark, sf_dir), train_config()
    params = ST.init_params(vocab, config.dim, SEED)
    path = scratch_path(spark, "values")
    IO.export_embeddings(Model(vocab=vocab, params=params, history=None, config=config, meta={}), path)
    back = IO.load_embeddings(spark, path)
    return back.select("idx", "word", F.posexplode("vec").alias("dim", "val")).withColumn("val", r("val", 12))


QUERIES = {
    "corpus_stats": q_corpus_stats,
    "tokens_positions": q_tokens_positions,
    "sentence_tokens": q_sentence_tokens,
    "token_prefix": q_token_prefix,
    "text_scan": q_text_scan,
    "word_counts": q_word_counts,
    "vocab_ranked": q_vocab_ranked,
    "vocab_capped": q_vocab_capped,
    "vocab_frequencies": q_vocab_frequencies,
    "keep_prob_plain": q_keep_prob_plain,
    "keep_prob_additive": q_keep_prob_additive,
    "noise_distribution": q_noise_distribution,
    "noise_cumulative": q_noise_cumulative,
    "encoded_corpus": q_encoded_corpus,
    "subsampled_stream": q_subsampled_stream,
    "subsampled_sentences": q_subsampled_sentences,
    "subsample_report": q_subsample_report,
    "pairs_stream": q_pairs_stream,
    "pairs_sentence": q_pairs_sentence,
    "pair_counts": q_pair_counts,
    "noise_slot_table": q_noise_slot_table,
    "negatives_exact": q_negatives_exact,
    "negatives_table": q_negatives_table,
    "negatives_excluding": q_negatives_excluding,
    "shuffled_batches": q_shuffled_batches,
    "lr_relative": q_lr_relative,
    "lr_absolute": q_lr_absolute,
    "param_init": q_param_init,
    "sigmoid_forms": q_sigmoid_forms,
    "pair_loss": q_pair_loss,
    "batch_loss": q_batch_loss,
    "loss_history": q_loss_history,
    "epoch_loss": q_epoch_loss,
    "gradients": q_gradients,
    "sync_step": q_sync_step,
    "embedding_lookup": q_embedding_lookup,
    "embedding_table": q_embedding_table,
    "embedding_norms": q_embedding_norms,
    "cosine_all": q_cosine_all,
    "cosine_all_max_guard": q_cosine_all_max_guard,
    "most_similar": q_most_similar,
    "probe_eval": q_probe_eval,
    "probe_missing": q_probe_missing,
    "pmi": q_pmi,
    "avg_embedding": q_avg_embedding,
    "epoch_redraw": q_epoch_redraw,
    "train_rounds": q_train_rounds,
    "train_loss": q_train_loss,
    "train_sentence": q_train_sentence,
    "pair_log_windows": q_pair_log_windows,
    "fit_neighbours": q_fit_neighbours,
    "fit_probe_report": q_fit_probe_report,
    "model_roundtrip": q_model_roundtrip,
    "params_roundtrip": q_params_roundtrip,
    "export_embeddings": q_export_embeddings,
    "export_values": q_export_values,
}


def flagship(spark, sf_dir):
    return q_fit_neighbours(spark, sf_dir)
