"""Corpus sources: documents, plain text, sentence tables, the demo corpus.

Stream order is always the pair of columns ``(doc_id, pos)``, never row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ordering import global_index

# fixed value: the tokeniser keeps maximal runs of ASCII lower-case letters
TOKEN_PATTERN = "[a-z]+"

# fixed values: the built-in demo corpus (20 sentences, repeated 200 times)
DEMO_SENTENCES = [
    "the king is a man the queen is a woman",
    "the prince is a young man the princess is a young woman",
    "a man is strong a woman is beautiful",
    "the king and the queen rule the kingdom",
    "the prince and the princess are the children of the king and queen",
    "a boy is a young man a girl is a young woman",
    "the king lives in a castle the queen lives in a castle",
    "the prince will become a king the princess will become a queen",
    "a man and a woman can have a boy or a girl",
    "the kingdom is a large country ruled by a king or a queen",
    "the dog chased the cat the cat climbed the tree",
    "a dog is an animal a cat is an animal",
    "the bird flew over the tree the fish swam in the river",
    "the city is large the village is small",
    "a car drives on the road a boat sails on the river",
    "the teacher teaches the student the student learns from the teacher",
    "a doctor heals the patient a lawyer defends the client",
    "the sun rises in the east the moon shines at night",
    "a computer processes data a phone connects people",
    "the book has many pages the page has many words",
]
DEMO_REPEATS = 200


# words of a file without line ends that make one document
WORDS_PER_DOCUMENT = 4096


def token_array(text_col="text"):
    """T1 + T2: lower-case, then all maximal ``[a-z]+`` runs (null -> null)."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, pos int, word string`` (pos is 0-based)."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.posexplode(token_array(text_col)).alias("pos", "word"),
    )


def explode_sentences(sentences: DataFrame, id_col: str = "sent_id", tokens_col: str = "tokens") -> DataFrame:
    """S3: pre-tokenised sentences ``(sent_id, tokens array<string>)`` to the
    token table; each sentence plays the role of one document."""
    return sentences.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.posexplode(F.col(tokens_col)).alias("pos", "word"),
    )


def conversation_sentences(conversations: DataFrame) -> DataFrame:
    """Sentence corpus from a turn table: one turn = one sentence; ``sent_id``
    is the rank of ``(conv_id, turn)``, computed without a single task."""
    ids = global_index(conversations.select("conv_id", "turn"), ["conv_id", "turn"], idx_col="sent_id")
    return conversations.join(ids, ["conv_id", "turn"]).select(
        "sent_id", "conv_id", "turn", token_array("text").alias("tokens")
    )


def read_text(spark: SparkSession, path: str, one_line: bool = False) -> DataFrame:
    """Plain UTF-8 text to ``(doc_id, text)``.

    By default one line is one document (a token never spans a line break, so
    the token stream equals the whole-file stream). ``one_line=True`` is for
    files with a single huge line: they are split on spaces, so they are read in
    parallel blocks, and ``WORDS_PER_DOCUMENT`` words in a row make a document.
    Documents are numbered in file order; only one row a document is ranked.
    """
    reader = spark.read.format("text")
    if one_line:
        reader = reader.option("lineSep", " ")
    raw = reader.load(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        # scan order inside one block; used only to recover the file order
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["_file", "_block", "_row"]
    if one_line:
        chunk = F.floor(F.col("_row") / WORDS_PER_DOCUMENT)
        words = F.array_sort(F.collect_list(F.struct("_row", "value")))
        raw = raw.groupBy("_file", "_block", chunk.alias("_chunk")).agg(words.alias("_w"))
        raw = raw.select("_file", "_block", F.col("_chunk").alias("_row"), F.array_join(F.transform("_w", lambda x: x["value"]), " ").alias("value"))
    ranked = global_index(raw, order, idx_col="doc_id")
    return ranked.select("doc_id", F.col("value").alias("text"))


def write_lines(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """One line per document in the order of the ids, as ``read_text`` numbers
    them: line breaks inside a text become spaces (no token spans one), a null
    text is an empty line. Files are ranges of ids, so no task holds more."""
    line = F.coalesce(F.regexp_replace(F.col(text_col), r"[\r\n]+", " "), F.lit("")).alias("value")
    ordered = docs.select(F.col(id_col).alias("_id"), line).orderBy("_id")
    ordered.select("value").write.mode("overwrite").text(path)


def demo_corpus(spark: SparkSession) -> DataFrame:
    """The 20 demo sentences x 200; ``doc_id = rep * 20 + i`` keeps order."""
    base = spark.createDataFrame(list(enumerate(DEMO_SENTENCES)), "i int, text string")
    reps = base.select("i", "text", F.explode(F.sequence(F.lit(0), F.lit(DEMO_REPEATS - 1))).alias("rep"))
    n = len(DEMO_SENTENCES)
    return reps.select((F.col("rep") * n + F.col("i")).cast("long").alias("doc_id"), "text")


def doc_offsets(tokens: DataFrame, order_cols=("doc_id",), count_name: str = "n_tokens") -> DataFrame:
    """Per-document token counts and the stream offset where each starts."""
    counts = tokens.groupBy(*order_cols).agg(F.count(F.lit(1)).alias(count_name))
    ranked = global_index(counts, list(order_cols), idx_col="_doc_rank", sums=[(count_name, "_cum")])
    return ranked.select(*order_cols, count_name, (F.col("_cum") - F.col(count_name)).alias("offset"))


def token_prefix(tokens: DataFrame, max_tokens: int) -> DataFrame:
    """The first ``max_tokens`` tokens of the stream ordered by (doc_id, pos).

    Offsets come from a distributed running sum over per-document counts; only
    documents that start before the cut are joined back.
    """
    offs = doc_offsets(tokens).filter(F.col("offset") < max_tokens).select("doc_id", "offset")
    joined = tokens.join(offs, "doc_id")
    return joined.select(
        "doc_id", "pos", (F.col("offset") + F.col("pos")).cast("long").alias("gpos"), "word"
    ).filter(F.col("gpos") < max_tokens)


def document_prefix(docs: DataFrame, max_tokens: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """S4 from documents: counts come from token arrays, before any explode, and
    only documents up to the cut (a pushed filter on the id) are tokenised."""
    n = F.coalesce(F.size(token_array(text_col)), F.lit(0))
    counts = docs.select(F.col(id_col).cast("long").alias("doc_id"), n.alias("n")).filter("n > 0")
    starts = global_index(counts, ["doc_id"], idx_col="_rank", sums=[("n", "_cum")])
    starts = starts.select("doc_id", (F.col("_cum") - F.col("n")).alias("offset")).filter(F.col("offset") < max_tokens)
    cut = starts.agg(F.max("doc_id")).first()[0]
    if cut is None:
        return token_prefix(tokenize(docs, id_col, text_col), max_tokens)
    tokens = tokenize(docs.filter(F.col(id_col) <= cut), id_col, text_col)
    placed = tokens.join(starts, "doc_id").select("doc_id", "pos", (F.col("offset") + F.col("pos")).cast("long").alias("gpos"), "word")
    return placed.filter(F.col("gpos") < max_tokens)


def corpus_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents (sentences) and tokens in one aggregate."""
    n_tok = F.coalesce(F.size(token_array(text_col)), F.lit(0))
    n_tok = F.when(n_tok < 0, 0).otherwise(n_tok)
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(n_tok).cast("long").alias("n_tokens"),
        F.sum(F.when(n_tok > 0, 1).otherwise(0)).cast("long").alias("n_nonempty_docs"),
    )
