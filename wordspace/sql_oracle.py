"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the driver's views (``documents``,
``conversations``, ``embeddings``...). Shared building blocks are CTE strings
so that every query spells out the same stages as its Spark plan.
"""

from __future__ import annotations

from .functions.hashing import sql_uniform
from .plans import catalog as Q

D = Q.DIGITS


def tokens_cte(name: str = "tokens") -> str:
    return f"""{name} AS (
  SELECT doc_id, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS word
  FROM (SELECT CAST(doc_id AS BIGINT) AS doc_id, regexp_extract_all(lower(text), '[a-z]+') AS arr FROM documents) d
)"""


def counts_cte(min_count: int = Q.MIN_COUNT, src: str = "tokens", name: str = "wc") -> str:
    return f"""{name}_raw AS (
  SELECT word, count(*) AS cnt, min(CAST(doc_id AS HUGEINT) * 10000000000 + pos) AS fk
  FROM {src} GROUP BY word HAVING count(*) >= {min_count}
),
{name} AS (
  SELECT word, cnt, CAST(fk // 10000000000 AS BIGINT) AS first_doc,
         CAST(fk % 10000000000 AS INTEGER) AS first_pos FROM {name}_raw
)"""


def vocab_cte(min_count: int = Q.MIN_COUNT, cap: int | None = None, src: str = "tokens", name: str = "vocab") -> str:
    where = f"WHERE idx < {cap}" if cap is not None else ""
    return f"""{counts_cte(min_count, src, name + '_wc')},
{name} AS (
  SELECT * FROM (
    SELECT CAST(row_number() OVER (ORDER BY cnt DESC, first_doc, first_pos) - 1 AS INTEGER) AS idx,
           word, cnt, first_doc, first_pos FROM {name}_wc) x {where}
)"""


def freq_cte(src: str = "vocab", name: str = "vfreq") -> str:
    return f"""{name} AS (
  SELECT v.*, t.total, t.vocab_size, v.cnt / t.total AS freq
  FROM {src} v, (SELECT CAST(sum(cnt) AS BIGINT) AS total, CAST(count(*) AS INTEGER) AS vocab_size FROM {src}) t
)"""


def keep_cte(t: float, form: str, src: str = "vfreq", name: str = "vkeep") -> str:
    ratio = f"({t!r}::DOUBLE / freq)"
    if form == "plain":
        kp = f"least(1.0::DOUBLE, sqrt({ratio}))"
    else:
        kp = f"CAST(CAST(least(1.0::DOUBLE, sqrt({ratio}) + {ratio}) AS FLOAT) AS DOUBLE)"
    return f"""{name} AS (SELECT *, {kp} AS keep_prob FROM {src})"""


def noise_cte(src: str = "vocab", name: str = "noise", power: float = 0.75, scale: int = 1_000_000) -> str:
    return f"""{name}_w AS (
  SELECT *, CAST(round(pow(CAST(cnt AS DOUBLE), {power!r}::DOUBLE) * {float(scale)!r}::DOUBLE) AS BIGINT) AS weight FROM {src}
),
{name} AS (
  SELECT w.*, CAST(sum(weight) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cdf_hi,
         t.weight_total
  FROM {name}_w w, (SELECT CAST(sum(weight) AS BIGINT) AS weight_total FROM {name}_w) t
)"""


def conv_tokens_cte(name: str = "stokens") -> str:
    return f"""{name} AS (
  SELECT sent_id AS doc_id, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS word
  FROM (SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS sent_id,
               regexp_extract_all(lower(text), '[a-z]+') AS arr FROM conversations) s
)"""


def kept_ctes(t: float, form: str, src: str = "tokens", seed: int = Q.SEED, window: int = Q.WINDOW) -> list[str]:
    """vocab -> keep -> encode -> subsample -> dense stream with radius."""
    u_keep = sql_uniform("subsample", seed, "doc_id", "pos")
    u_win = sql_uniform("window", seed, "doc_id", "pos")
    return [
        vocab_cte(src=src),
        freq_cte(),
        keep_cte(t, form),
        f"""enc AS (SELECT t.doc_id, t.pos, v.idx, v.keep_prob FROM {src} t JOIN vkeep v ON t.word = v.word)""",
        f"""kept AS (SELECT * FROM enc WHERE {u_keep} < keep_prob)""",
        f"""dense AS (
  SELECT doc_id, pos, idx, CAST(row_number() OVER (ORDER BY doc_id, pos) - 1 AS BIGINT) AS gpos,
         CAST(1 + floor({u_win} * {window}) AS INTEGER) AS r
  FROM kept
)""",
    ]


def pairs_cte(sentence: bool, name: str = "pairs") -> str:
    same = "AND x.doc_id = c.doc_id" if sentence else ""
    return f"""{name} AS (
  SELECT c.doc_id, c.pos AS center_pos, x.doc_id AS ctx_doc, x.pos AS context_pos, c.idx AS center, x.idx AS context,
         c.gpos, CAST(x.gpos - c.gpos AS INTEGER) AS off
  FROM dense c JOIN dense x ON x.gpos >= c.gpos - c.r AND x.gpos <= c.gpos + c.r AND x.gpos <> c.gpos {same}
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["corpus_stats"] = """
SELECT CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(coalesce(len(regexp_extract_all(lower(text), '[a-z]+')), 0)) AS BIGINT) AS n_tokens,
       CAST(sum(CASE WHEN coalesce(len(regexp_extract_all(lower(text), '[a-z]+')), 0) > 0 THEN 1 ELSE 0 END) AS BIGINT)
         AS n_nonempty_docs
FROM documents"""

SQL["text_scan"] = with_(tokens_cte()) + """
SELECT n.line_no, t.pos, t.word FROM tokens t
JOIN (SELECT CAST(doc_id AS BIGINT) AS doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS line_no FROM documents) n USING (doc_id)"""
SQL["tokens_positions"] = with_(tokens_cte()) + "SELECT doc_id, pos, word FROM tokens"

SQL["sentence_tokens"] = """
WITH s AS (
  SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS sent_id,
         regexp_extract_all(lower(text), '[a-z]+') AS arr
  FROM conversations
)
SELECT sent_id, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS word FROM s"""

SQL["token_prefix"] = with_(tokens_cte()) + f"""
SELECT doc_id, pos, gpos, word FROM (
  SELECT doc_id, pos, word, CAST(row_number() OVER (ORDER BY doc_id, pos) - 1 AS BIGINT) AS gpos FROM tokens
) x WHERE gpos < {Q.PREFIX_TOKENS}"""

SQL["word_counts"] = with_(tokens_cte(), counts_cte()) + "SELECT word, cnt, first_doc, first_pos FROM wc"

SQL["vocab_ranked"] = with_(tokens_cte(), vocab_cte()) + "SELECT idx, word, cnt FROM vocab"

SQL["vocab_capped"] = with_(tokens_cte(), vocab_cte(cap=Q.VOCAB_CAP)) + "SELECT idx, word, cnt FROM vocab"

SQL["vocab_frequencies"] = with_(tokens_cte(), vocab_cte(), freq_cte()) + """
SELECT idx, word, cnt, total, vocab_size, (round(freq, 12) + 0.0::DOUBLE) AS freq FROM vfreq"""

SQL["keep_prob_plain"] = with_(tokens_cte(), vocab_cte(), freq_cte(), keep_cte(Q.T_PLAIN, "plain")) + f"""
SELECT idx, word, (round(keep_prob, {D}) + 0.0::DOUBLE) AS keep_prob FROM vkeep"""

SQL["keep_prob_additive"] = with_(tokens_cte(), vocab_cte(), freq_cte(), keep_cte(Q.T_ADDITIVE, "additive")) + f"""
SELECT idx, word, (round(keep_prob, {D}) + 0.0::DOUBLE) AS keep_prob FROM vkeep"""

SQL["noise_distribution"] = with_(tokens_cte(), vocab_cte(), noise_cte()) + """
SELECT idx, word, weight, weight_total, (round(weight / weight_total, 12) + 0.0::DOUBLE) AS prob FROM noise"""

SQL["noise_cumulative"] = with_(tokens_cte(), vocab_cte(), noise_cte()) + """
SELECT idx, cdf_hi - weight AS cdf_lo, cdf_hi FROM noise"""

SQL["encoded_corpus"] = with_(tokens_cte(), vocab_cte()) + """
SELECT t.doc_id, t.pos, v.idx, CAST(row_number() OVER (PARTITION BY t.doc_id ORDER BY t.pos) - 1 AS INTEGER) AS dpos
FROM tokens t JOIN vocab v ON t.word = v.word"""

SQL["subsampled_stream"] = with_(tokens_cte(), *kept_ctes(Q.T_PLAIN, "plain")) + """
SELECT doc_id, pos, idx, gpos FROM dense"""

SQL["subsampled_sentences"] = with_(conv_tokens_cte(), *kept_ctes(Q.T_ADDITIVE, "additive", src="stokens")) + """
SELECT doc_id AS sent_id, pos, idx, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS dpos
FROM dense"""

SQL["subsample_report"] = with_(tokens_cte(), *kept_ctes(Q.T_PLAIN, "plain")[:4]) + f"""
SELECT CAST(sum(CASE WHEN {sql_uniform("subsample", Q.SEED, "doc_id", "pos")} < keep_prob THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) - sum(CASE WHEN {sql_uniform("subsample", Q.SEED, "doc_id", "pos")} < keep_prob THEN 1 ELSE 0 END)
            AS BIGINT) AS removed
FROM enc"""

SQL["pairs_stream"] = with_(tokens_cte(), *kept_ctes(Q.T_PLAIN, "plain"), pairs_cte(False)) + """
SELECT doc_id, center_pos, ctx_doc, context_pos, center, context FROM pairs"""

SQL["pairs_sentence"] = with_(conv_tokens_cte(), *kept_ctes(Q.T_ADDITIVE, "additive", src="stokens"), pairs_cte(True)) + """
SELECT doc_id AS sent_id, center_pos, context_pos, center, context FROM pairs"""

SQL["pair_counts"] = with_(tokens_cte(), *kept_ctes(Q.T_ADDITIVE, "additive"), pairs_cte(True)) + """
SELECT center, context, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY center, context"""


# --- noise draws, batches, step maths ----------------------------------------

STREAM = [tokens_cte(), *kept_ctes(Q.T_PLAIN, "plain"), pairs_cte(False)]
SENTENCE = [conv_tokens_cte(), *kept_ctes(Q.T_ADDITIVE, "additive", src="stokens"), pairs_cte(True)]
GBINS = 1 << 16
M = Q.TABLE_SIZE


def slots_ctes() -> list[str]:
    return [
        noise_cte(),
        f"""slots_r AS (
  SELECT idx,
         CASE WHEN idx = 0 THEN 0
              ELSE CAST((CAST(cdf_hi - weight AS HUGEINT) * {M}) // weight_total AS BIGINT) + 1 END AS slot_lo,
         least(CAST((CAST(cdf_hi AS HUGEINT) * {M}) // weight_total AS BIGINT), {M - 1}) AS slot_hi
  FROM noise
)""",
        """slot_rows AS (
  SELECT CAST(unnest(range(slot_lo, slot_hi + 1)) AS INTEGER) AS slot, idx FROM slots_r WHERE slot_lo <= slot_hi
)""",
    ]


def sql_bin(x: str, total: str) -> str:
    return f"CAST(floor(CAST({x} AS DOUBLE) * {float(GBINS)!r}::DOUBLE / CAST({total} AS DOUBLE)) AS BIGINT)"


def exact_negs_cte(k: int, epoch: int, name: str = "negs") -> list[str]:
    u = sql_uniform("neg", Q.SEED, str(epoch), "p.gpos", "p.off", "t.k")
    return [
        f"""{name}_bins AS (
  SELECT unnest(range({sql_bin("cdf_hi - weight", "weight_total")}, {sql_bin("cdf_hi - 1", "weight_total")} + 1)) AS bin,
         idx, cdf_hi - weight AS cdf_lo, cdf_hi
  FROM noise WHERE weight > 0
)""",
        f"""{name}_draws AS (
  SELECT p.gpos, p.off, p.center, CAST(t.k AS INTEGER) AS k,
         CAST(floor({u} * n.weight_total) AS BIGINT) AS x, n.weight_total
  FROM pairs p CROSS JOIN range({k}) t(k) CROSS JOIN (SELECT DISTINCT weight_total FROM noise) n
)""",
        f"""{name} AS (
  SELECT d.gpos, d.off, d.center, d.k, b.idx AS neg
  FROM {name}_draws d JOIN {name}_bins b
    ON b.bin = {sql_bin("d.x", "d.weight_total")} AND b.cdf_lo <= d.x AND d.x < b.cdf_hi
)""",
    ]


def table_draws_cte(a0: int, a1: int, epoch: int = 1, name: str = "tdraws") -> str:
    u = sql_uniform("negtable", Q.SEED, str(epoch), "p.gpos", "p.off", "t.a")
    return f"""{name} AS (
  SELECT d.gpos, d.off, d.center, d.context, d.a, s.idx AS neg
  FROM (SELECT p.gpos, p.off, p.center, p.context, CAST(t.a AS INTEGER) AS a,
               CAST(floor({u} * {M}) AS INTEGER) AS slot
        FROM pairs p CROSS JOIN range({a0}, {a1}) t(a)) d
  JOIN slot_rows s ON s.slot = d.slot
)"""


PER_NEG = "SELECT neg, CAST(count(*) AS BIGINT) AS n_draws, CAST(sum(gpos) AS BIGINT) AS sum_gpos FROM {src} GROUP BY neg"

SQL["noise_slot_table"] = with_(tokens_cte(), vocab_cte(), *slots_ctes()) + """
SELECT idx, CAST(slot_lo AS INTEGER) AS slot_lo, CAST(slot_hi AS INTEGER) AS slot_hi,
       CAST(slot_hi - slot_lo + 1 AS INTEGER) AS n_slots
FROM slots_r WHERE slot_lo <= slot_hi"""

SQL["negatives_exact"] = with_(*STREAM, noise_cte(), *exact_negs_cte(Q.K_EXACT, 1)) + PER_NEG.format(src="negs")

SQL["negatives_table"] = with_(*SENTENCE, *slots_ctes(), table_draws_cte(0, Q.K_TABLE)) + PER_NEG.format(src="tdraws")

EXCLUDING_U = sql_uniform("negtable", Q.SEED, "1", "p.gpos", "p.off", "t.k")
SQL["negatives_excluding"] = with_(*SENTENCE, *slots_ctes()) + f"""
, runs AS (SELECT idx, min(slot) AS lo, count(*) AS n FROM slot_rows GROUP BY idx),
gaps AS (
  SELECT p.gpos, p.off, coalesce(c.lo, {M} + 1) AS c_lo, coalesce(c.n, 0) AS c_n, coalesce(o.lo, {M} + 1) AS o_lo,
         CASE WHEN p.center = p.context THEN 0 ELSE coalesce(o.n, 0) END AS o_n
  FROM pairs p LEFT JOIN runs c ON c.idx = p.center LEFT JOIN runs o ON o.idx = p.context
),
firsts AS (
  SELECT p.*, CAST(floor({EXCLUDING_U} * ({M} - c_n - o_n)) AS BIGINT) AS s0
  FROM gaps p CROSS JOIN range({Q.K_TABLE}) t(k)
),
seconds AS (
  SELECT *, s0 + CASE WHEN s0 >= least(c_lo, o_lo) THEN CASE WHEN c_lo <= o_lo THEN c_n ELSE o_n END ELSE 0 END AS s1 FROM firsts
),
thirds AS (
  SELECT *, s1 + CASE WHEN s1 >= greatest(c_lo, o_lo) THEN CASE WHEN c_lo <= o_lo THEN o_n ELSE c_n END ELSE 0 END AS s2 FROM seconds
),
drawn AS (SELECT d.gpos, s.idx AS neg FROM thirds d JOIN slot_rows s ON s.slot = d.s2)
""" + PER_NEG.format(src="drawn")


def batches_cte(epochs: int = Q.EPOCHS_CHECK, name: str = "sb") -> str:
    u = sql_uniform("shuffle", Q.SEED, "e.epoch", "p.gpos", "p.off")
    return f"""{name} AS (
  SELECT e.epoch, p.gpos, p.off, p.center, p.context,
         CAST(row_number() OVER (PARTITION BY e.epoch ORDER BY {u}, p.gpos, p.off) - 1 AS BIGINT) AS rank
  FROM pairs p CROSS JOIN (SELECT CAST(range + 1 AS INTEGER) AS epoch FROM range({epochs})) e
),
{name}_b AS (SELECT *, CAST(rank // {Q.BATCH} AS BIGINT) AS batch FROM {name})"""


SQL["shuffled_batches"] = with_(*STREAM, batches_cte()) + """
SELECT epoch, batch, CAST(count(*) AS BIGINT) AS n_pairs, CAST(sum(center) AS BIGINT) AS sum_center,
       CAST(sum(context) AS BIGINT) AS sum_context
FROM sb_b GROUP BY epoch, batch"""

SQL["lr_relative"] = with_(*STREAM) + f"""
, nb AS (SELECT CAST((count(*) + {Q.BATCH} - 1) // {Q.BATCH} AS BIGINT) AS nb FROM pairs),
steps AS (
  SELECT CAST(e.range + 1 AS INTEGER) AS epoch, CAST(b.range AS BIGINT) AS batch, nb.nb
  FROM nb, range({Q.EPOCHS_CHECK}) e, range(nb.nb) b
)
SELECT epoch, batch, CAST((epoch - 1) * nb + batch + 1 AS BIGINT) AS step,
       (round(greatest({Q.LR0}::DOUBLE * (1.0::DOUBLE - CAST((epoch - 1) * nb + batch AS DOUBLE)
                        / greatest(CAST({Q.EPOCHS_CHECK} * nb AS DOUBLE), 1.0::DOUBLE)),
                      {Q.LR0 * 1e-4!r}::DOUBLE), 12) + 0.0::DOUBLE) AS lr
FROM steps"""

SQL["lr_absolute"] = with_(*SENTENCE, batches_cte(1)) + f"""
SELECT rank AS step,
       (round(greatest(0.0001::DOUBLE, {Q.LR0}::DOUBLE * (1.0::DOUBLE - CAST(rank AS DOUBLE)
                      / CAST((SELECT count(*) FROM pairs) AS DOUBLE))), 12) + 0.0::DOUBLE) AS lr
FROM sb"""


def params_cte(dim: int = Q.DIM_CHECK, context: str = "hashed") -> str:
    uc = sql_uniform("init", Q.SEED, "idx", "i")
    ux = sql_uniform("initctx", Q.SEED, "idx", "i")
    ctx = f"list_transform(range({dim}), lambda i: ({ux} - 0.5::DOUBLE) / {float(dim)!r}::DOUBLE)"
    if context == "zeros":
        ctx = f"list_transform(range({dim}), lambda i: 0.0::DOUBLE)"
    return f"""params AS (
  SELECT 'center' AS matrix, idx, list_transform(range({dim}), lambda i: ({uc} - 0.5::DOUBLE) / {float(dim)!r}::DOUBLE) AS vec
  FROM vocab
  UNION ALL
  SELECT 'context' AS matrix, idx, {ctx} AS vec FROM vocab
)"""


SQL["param_init"] = with_(tokens_cte(), vocab_cte(), params_cte(Q.DIM, context="zeros")) + f"""
SELECT matrix, idx, CAST(unnest(range({Q.DIM})) AS INTEGER) AS dim, (round(unnest(vec), 12) + 0.0::DOUBLE) AS val FROM params"""


def sig(x: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-greatest(-20.0::DOUBLE, least(20.0::DOUBLE, {x})))))"


def scored_ctes(epoch: int = 1) -> list[str]:
    return [
        noise_cte(),
        *exact_negs_cte(Q.K_EXACT, epoch),
        params_cte(),
        f"""pos AS (
  SELECT p.gpos, p.off, p.center, p.context, c.vec AS v_c, x.vec AS u_o, list_dot_product(c.vec, x.vec) AS s_pos,
         {sig('list_dot_product(c.vec, x.vec)')} AS sig_pos
  FROM pairs p JOIN params c ON c.matrix = 'center' AND c.idx = p.center
               JOIN params x ON x.matrix = 'context' AND x.idx = p.context
)""",
        f"""neg AS (
  SELECT n.gpos, n.off, n.k, n.center, n.neg, c.vec AS v_c, x.vec AS u_k,
         {sig('list_dot_product(c.vec, x.vec)')} AS sig_neg
  FROM negs n JOIN params c ON c.matrix = 'center' AND c.idx = n.center
              JOIN params x ON x.matrix = 'context' AND x.idx = n.neg
)""",
        """loss AS (
  SELECT pos.gpos, pos.off, pos.center, pos.context,
         -ln(pos.sig_pos + 1e-10::DOUBLE) + coalesce(nl.nl, 0.0::DOUBLE) AS loss
  FROM pos LEFT JOIN (SELECT gpos, off, sum(-ln(1.0::DOUBLE - sig_neg + 1e-10::DOUBLE)) AS nl FROM neg GROUP BY gpos, off) nl
    ON nl.gpos = pos.gpos AND nl.off = pos.off
)""",
    ]


G = Q.GRAD_DIGITS

SQL["sigmoid_forms"] = with_(*STREAM, *scored_ctes()) + f"""
SELECT gpos, off, (round(s_pos, {D}) + 0.0::DOUBLE) AS s_pos, (round({sig('s_pos')}, {D}) + 0.0::DOUBLE) AS sig_clip,
       (round(CASE WHEN s_pos >= 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + exp(-s_pos))
                  ELSE exp(s_pos) / (1.0::DOUBLE + exp(s_pos)) END, {D}) + 0.0::DOUBLE) AS sig_branch
FROM pos"""

SQL["pair_loss"] = with_(*STREAM, *scored_ctes()) + f"""
SELECT gpos, off, center, context, (round(loss, {G}) + 0.0::DOUBLE) AS loss FROM loss"""


def epoch_losses_sql(epochs: int) -> str:
    parts = []
    for e in range(1, epochs + 1):
        ctes = scored_ctes(e)
        parts.append("(" + with_(*ctes).replace("WITH ", "WITH ", 1) + f"SELECT {e} AS epoch, gpos, off, loss FROM loss)")
    return " UNION ALL ".join(parts)


def batch_loss_sql(epochs: int) -> str:
    return with_(*STREAM, batches_cte(epochs)) + f"""
, el AS ({epoch_losses_sql(epochs)}),
bl AS (
  SELECT b.epoch, b.batch, CAST(count(*) AS BIGINT) AS n_pairs, avg(el.loss) AS mean_loss
  FROM sb_b b JOIN el ON el.epoch = b.epoch AND el.gpos = b.gpos AND el.off = b.off
  GROUP BY b.epoch, b.batch
)
"""


SQL["batch_loss"] = batch_loss_sql(1) + f"SELECT epoch, batch, n_pairs, (round(mean_loss, {G}) + 0.0::DOUBLE) AS mean_loss FROM bl"

SQL["loss_history"] = batch_loss_sql(Q.EPOCHS_CHECK) + f"""
, nb AS (SELECT CAST((count(*) + {Q.BATCH} - 1) // {Q.BATCH} AS BIGINT) AS nb FROM pairs)
SELECT epoch, CAST(floor(((epoch - 1) * nb + batch) / {Q.LOG_EVERY}) AS BIGINT) AS window_no,
       CAST(sum(n_pairs) AS BIGINT) AS n_pairs, (round(sum(mean_loss * n_pairs) / sum(n_pairs), {G}) + 0.0::DOUBLE) AS avg_loss
FROM bl, nb GROUP BY 1, 2"""

SQL["epoch_loss"] = with_(*STREAM) + f"""
, el AS ({epoch_losses_sql(Q.EPOCHS_CHECK)})
SELECT epoch, CAST(count(*) AS BIGINT) AS n_pairs, (round(avg(loss), {G}) + 0.0::DOUBLE) AS mean_loss FROM el GROUP BY epoch"""

GRAD_CTES = [
    """grows AS (
  SELECT 'center' AS matrix, center AS idx, list_transform(u_o, lambda x: x * (-(1.0::DOUBLE - sig_pos))) AS g FROM pos
  UNION ALL SELECT 'context', context, list_transform(v_c, lambda x: x * (-(1.0::DOUBLE - sig_pos))) FROM pos
  UNION ALL SELECT 'center', center, list_transform(u_k, lambda x: x * sig_neg) FROM neg
  UNION ALL SELECT 'context', neg, list_transform(v_c, lambda x: x * sig_neg) FROM neg
)""",
    f"""gsum AS (
  SELECT matrix, idx, dim, sum(g) AS g FROM (
    SELECT matrix, idx, CAST(unnest(range({Q.DIM_CHECK})) AS INTEGER) AS dim, unnest(g) AS g FROM grows) x
  GROUP BY matrix, idx, dim
)""",
]

SQL["gradients"] = with_(*STREAM, *scored_ctes(), *GRAD_CTES) + f"""
SELECT matrix, idx, dim, (round(g, {G}) + 0.0::DOUBLE) AS g FROM gsum"""

SQL["sync_step"] = with_(*STREAM, *scored_ctes(), *GRAD_CTES) + f"""
, plong AS (SELECT matrix, idx, CAST(unnest(range({Q.DIM_CHECK})) AS INTEGER) AS dim, unnest(vec) AS val FROM params)
SELECT p.matrix, p.idx, p.dim, (round(CASE WHEN g.g IS NULL THEN p.val ELSE p.val - {Q.LR0}::DOUBLE * g.g END, {G}) + 0.0::DOUBLE) AS val
FROM plong p LEFT JOIN gsum g ON g.matrix = p.matrix AND g.idx = p.idx AND g.dim = p.dim"""


# --- embeddings table ------------------------------------------------------

EMB = """emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings),
probes AS (SELECT min(vec_id) AS query_id FROM embeddings GROUP BY label),
unit AS (SELECT vec_id, list_transform(vec, lambda x: x / (sqrt(list_sum(list_transform(vec, lambda y: y * y))) + 1e-10::DOUBLE)) AS vec
         FROM emb),
cos AS (
  SELECT p.query_id, u.vec_id, list_dot_product(u.vec, q.vec) AS similarity
  FROM probes p JOIN unit q ON q.vec_id = p.query_id CROSS JOIN unit u
),
top AS (
  SELECT * FROM (
    SELECT query_id, vec_id, similarity,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank
    FROM cos WHERE vec_id <> query_id) x
)"""

SQL["embedding_lookup"] = f"""WITH {EMB}
SELECT e.vec_id, e.label, CAST(unnest(range(len(e.vec))) AS INTEGER) AS dim, (round(unnest(e.vec), {D}) + 0.0::DOUBLE) AS val
FROM emb e WHERE e.vec_id IN (SELECT query_id FROM probes)"""

SQL["embedding_table"] = f"""WITH {EMB}
SELECT vec_id, CAST(unnest(range(len(vec))) AS INTEGER) AS dim, (round(unnest(vec), {D}) + 0.0::DOUBLE) AS val FROM emb"""

SQL["embedding_norms"] = f"""WITH {EMB}
SELECT vec_id, (round(sqrt(list_sum(list_transform(vec, lambda y: y * y))), {D}) + 0.0::DOUBLE) AS norm FROM emb"""

SQL["cosine_all"] = f"""WITH {EMB}
SELECT query_id, vec_id, (round(similarity, {D}) + 0.0::DOUBLE) AS similarity FROM cos"""

EMB_MAX = EMB.replace("(sqrt(list_sum(list_transform(vec, lambda y: y * y))) + 1e-10::DOUBLE)", "greatest(sqrt(list_sum(list_transform(vec, lambda y: y * y))), 1e-10::DOUBLE)")
SQL["cosine_all_max_guard"] = SQL["cosine_all"].replace(EMB, EMB_MAX)

SQL["most_similar"] = f"""WITH {EMB}
SELECT query_id, rank, vec_id, (round(similarity, {D}) + 0.0::DOUBLE) AS similarity FROM top WHERE rank <= {Q.TOP_K}"""

PROBE_WORDS = """pw AS (
  SELECT 'v' || CAST(min(vec_id) AS VARCHAR) AS query FROM embeddings GROUP BY label
  UNION ALL
  SELECT 'v' || CAST((SELECT max(vec_id) FROM embeddings) + 1 + label AS VARCHAR) FROM embeddings GROUP BY label
),
words AS (SELECT vec_id, 'v' || CAST(vec_id AS VARCHAR) AS word FROM embeddings)"""

SQL["probe_eval"] = f"""WITH {EMB}, {PROBE_WORDS},
found AS (SELECT w.vec_id AS qid, pw.query FROM pw JOIN words w ON w.word = pw.query),
fcos AS (
  SELECT f.query, u.vec_id, list_dot_product(u.vec, q.vec) AS similarity
  FROM found f JOIN unit q ON q.vec_id = f.qid CROSS JOIN unit u WHERE u.vec_id <> f.qid
),
ftop AS (
  SELECT * FROM (SELECT query, vec_id, similarity,
                        row_number() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id) AS rank FROM fcos) x
  WHERE rank <= 8
)
SELECT t.query, string_agg(printf('%s (%.3f)', w.word, t.similarity), ', ' ORDER BY t.rank) AS neighbours
FROM ftop t JOIN words w ON w.vec_id = t.vec_id GROUP BY t.query"""

SQL["probe_missing"] = f"""WITH {PROBE_WORDS}
SELECT query FROM pw WHERE query NOT IN (SELECT word FROM words)"""

SQL["pmi"] = with_(*STREAM) + f"""
, pc AS (SELECT center, context, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY center, context),
na AS (SELECT center, sum(n) AS n_a FROM pc GROUP BY center),
nb AS (SELECT context, sum(n) AS n_b FROM pc GROUP BY context),
tot AS (SELECT sum(n) AS n_total FROM pc),
j AS (
  SELECT pc.center, pc.context, pc.n,
         ln((CAST(pc.n AS DOUBLE) * CAST(tot.n_total AS DOUBLE)) / (CAST(na.n_a AS DOUBLE) * CAST(nb.n_b AS DOUBLE))) AS pmi
  FROM pc JOIN na ON na.center = pc.center JOIN nb ON nb.context = pc.context CROSS JOIN tot
)
SELECT center, context, n, (round(pmi, {D}) + 0.0::DOUBLE) AS pmi, (round(pmi - ln({Q.K_EXACT}::DOUBLE), {D}) + 0.0::DOUBLE) AS spmi FROM j"""

SQL["avg_embedding"] = with_(tokens_cte(), vocab_cte(), params_cte(Q.DIM)) + f"""
, av AS (
  SELECT c.idx, list_transform(list_zip(c.vec, x.vec), lambda t: (t[1] + t[2]) / 2.0::DOUBLE) AS vec
  FROM params c JOIN params x ON c.idx = x.idx AND c.matrix = 'center' AND x.matrix = 'context'
)
SELECT idx, CAST(unnest(range({Q.DIM})) AS INTEGER) AS dim, (round(unnest(vec), 12) + 0.0::DOUBLE) AS val FROM av"""


def redraw_sql(epochs: int) -> str:
    parts = []
    for e in range(1, epochs + 1):
        u_keep = sql_uniform("subsample", Q.SEED, str(e), "doc_id", "pos")
        u_win = sql_uniform("window", Q.SEED, str(e), "doc_id", "pos")
        parts.append(f"""SELECT {e} AS epoch, (SELECT CAST(count(*) AS BIGINT) FROM dense{e}) AS n_kept,
       (SELECT CAST(count(*) AS BIGINT) FROM dense{e} c JOIN dense{e} x
          ON x.gpos >= c.gpos - c.r AND x.gpos <= c.gpos + c.r AND x.gpos <> c.gpos) AS n_pairs""")
        parts[-1] = (f"dense{e} AS (SELECT doc_id, pos, CAST(row_number() OVER (ORDER BY doc_id, pos) - 1 AS BIGINT) AS gpos, "
                     f"CAST(1 + floor({u_win} * {Q.WINDOW}) AS INTEGER) AS r FROM enc WHERE {u_keep} < keep_prob)", parts[-1])
    ctes = [p[0] for p in parts]
    sels = [p[1] for p in parts]
    return with_(tokens_cte(), *kept_ctes(Q.T_PLAIN, "plain")[:4], *ctes) + " UNION ALL ".join(sels)


SQL["epoch_redraw"] = redraw_sql(Q.EPOCHS_CHECK)


# --- trained tables: all but the trained floats follows from the corpus ---------

TRAIN = Q.train_config()
TRAIN_U = sql_uniform("shuffle", Q.SEED, "e.epoch", "p.gpos", "p.off")


def trained_windows(cfg) -> str:
    """Windows of the grid schedule: a batch is so many pairs of a block of
    centers in the epoch's permutation, its step that of its first pair."""
    size = max(1, cfg.batch_size)
    floor = cfg.lr * 1e-4 if cfg.lr_floor == "relative" else cfg.lr_min
    return f"""
, n AS (SELECT CAST(ceil(count(*) / {size}) AS BIGINT) AS steps FROM pairs),
placed AS (
  SELECT e.epoch, p.center % {cfg.parts} AS part, {TRAIN_U} AS u, p.gpos, p.off FROM pairs p CROSS JOIN range(1, {cfg.epochs} + 1) e(epoch)
),
ranked AS (SELECT epoch, part, u, (row_number() OVER (PARTITION BY epoch, part ORDER BY u, gpos, off) - 1) // {size} AS batch FROM placed),
stepped AS (SELECT (epoch - 1) * n.steps + CAST(floor(min(u) OVER (PARTITION BY epoch, part, batch) * n.steps) AS BIGINT) AS step, epoch, n.steps FROM ranked, n)
SELECT CAST(epoch AS INTEGER) AS epoch, CAST(step // {cfg.log_every} AS BIGINT) AS window_no, count(*) AS n_pairs,
       (round(greatest({cfg.lr}::DOUBLE * (1.0::DOUBLE - CAST(max(step) AS DOUBLE) / CAST(any_value(steps) * {cfg.epochs} AS DOUBLE)), {floor!r}::DOUBLE), 12) + 0.0::DOUBLE) AS lr
FROM stepped GROUP BY 1, 2"""


SQL["train_rounds"] = with_(*STREAM) + trained_windows(TRAIN)

SQL["train_sentence"] = with_(*SENTENCE) + trained_windows(Q.sentence_config())


def excluded_draws(epoch: int) -> str:
    """(gpos, off, center, k, neg): draws past the two words' slot gaps."""
    u = sql_uniform("negtable", Q.SEED, str(epoch), "p.gpos", "p.off", "t.k")
    return f"""
  SELECT d.gpos, d.off, d.center, s.idx AS neg
  FROM (
    SELECT *, s1 + CASE WHEN s1 >= greatest(c_lo, o_lo) THEN CASE WHEN c_lo <= o_lo THEN o_n ELSE c_n END ELSE 0 END AS s2
    FROM (
      SELECT *, s0 + CASE WHEN s0 >= least(c_lo, o_lo) THEN CASE WHEN c_lo <= o_lo THEN c_n ELSE o_n END ELSE 0 END AS s1
      FROM (SELECT p.*, CAST(floor({u} * ({M} - c_n - o_n)) AS BIGINT) AS s0 FROM gaps p CROSS JOIN range({Q.K_TABLE}) t(k)) a
    ) b
  ) d JOIN slot_rows s ON s.slot = d.s2"""


def branched(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + exp(-({x}))) ELSE exp({x}) / (1.0::DOUBLE + exp({x})) END)"


SQL["pair_log_windows"] = with_(*SENTENCE, *slots_ctes(), params_cte()) + f"""
, runs AS (SELECT idx, min(slot) AS lo, count(*) AS n FROM slot_rows GROUP BY idx),
gaps AS (
  SELECT p.gpos, p.off, p.center, p.context, coalesce(c.lo, {M} + 1) AS c_lo, coalesce(c.n, 0) AS c_n, coalesce(o.lo, {M} + 1) AS o_lo,
         CASE WHEN p.center = p.context THEN 0 ELSE coalesce(o.n, 0) END AS o_n
  FROM pairs p LEFT JOIN runs c ON c.idx = p.center LEFT JOIN runs o ON o.idx = p.context
),
negs AS ({" UNION ALL ".join(f"SELECT {e} AS epoch, x.* FROM ({excluded_draws(e)}) x" for e in range(1, Q.EPOCHS_CHECK + 1))}),
terms AS (
  SELECT e.epoch, p.gpos, p.off, -ln({branched("list_dot_product(c.vec, x.vec)")} + 1e-10::DOUBLE) AS loss
  FROM pairs p CROSS JOIN range(1, {Q.EPOCHS_CHECK} + 1) e(epoch)
  JOIN params c ON c.matrix = 'center' AND c.idx = p.center JOIN params x ON x.matrix = 'context' AND x.idx = p.context
  UNION ALL
  SELECT n.epoch, n.gpos, n.off, -ln(1.0::DOUBLE - {branched("list_dot_product(c.vec, x.vec)")} + 1e-10::DOUBLE)
  FROM negs n JOIN params c ON c.matrix = 'center' AND c.idx = n.center JOIN params x ON x.matrix = 'context' AND x.idx = n.neg
),
losses AS (SELECT epoch, gpos, off, sum(loss) AS loss FROM terms GROUP BY 1, 2, 3),
placed AS (
  SELECT l.epoch, l.loss, row_number() OVER (PARTITION BY l.epoch ORDER BY {sql_uniform("shuffle", Q.SEED, "l.epoch", "l.gpos", "l.off")}, l.gpos, l.off) - 1 AS rank FROM losses l
)
SELECT CAST(epoch AS INTEGER) AS epoch, CAST(rank // {Q.PAIR_LOG_EVERY} AS BIGINT) AS window_no, count(*) AS n_pairs,
       (round(sum(loss) / {Q.PAIR_LOG_EVERY}, {G}) + 0.0::DOUBLE) AS avg_loss
FROM placed GROUP BY 1, 2 HAVING count(*) = {Q.PAIR_LOG_EVERY}"""

SQL["fit_probe_report"] = with_(tokens_cte(), vocab_cte()) + f"""
SELECT q.query, CAST(CASE WHEN v.idx IS NULL THEN 0 ELSE least({Q.TOP_N}, (SELECT count(*) - 1 FROM vocab)) END AS BIGINT) AS n_neighbours
FROM (SELECT unnest([{", ".join("'" + w + "'" for w in Q.PROBES)}]) AS query) q LEFT JOIN vocab v ON v.word = q.query"""

SQL["model_roundtrip"] = with_(tokens_cte(), vocab_cte()) + f"""
SELECT m.matrix, count(*) AS rows, CAST({TRAIN.dim} AS INTEGER) AS dim, CAST(count(*) AS INTEGER) AS vocab_size
FROM vocab CROSS JOIN (SELECT unnest(['center', 'context']) AS matrix) m GROUP BY m.matrix"""

SQL["params_roundtrip"] = SQL["param_init"]

SQL["export_embeddings"] = with_(tokens_cte(), vocab_cte()) + f"""
SELECT idx, word, CAST({TRAIN.dim} AS INTEGER) AS dim FROM vocab"""

SQL["export_values"] = with_(tokens_cte(), vocab_cte(), params_cte(TRAIN.dim, context="zeros")) + f"""
SELECT p.idx, v.word, CAST(unnest(range({TRAIN.dim})) AS INTEGER) AS dim, (round(unnest(p.vec), 12) + 0.0::DOUBLE) AS val
FROM params p JOIN vocab v ON v.idx = p.idx WHERE p.matrix = 'center'"""
