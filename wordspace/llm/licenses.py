"""Licence scan by canonical digests, in DataFrame functions alone.

Method. A text is brought to a canonical form: lower case, copyright statements
at the start of a line left out (what follows them on the line stays), every run of characters that are neither letters nor digits one space, and
equivalent spellings made one in texts that speak of licences (``SPELLINGS``,
``LICENSE_MARKS``). The digest of the entire
canonical text is looked up by a hash join against the digests of the known
texts, which go through the same expressions. Besides a whole document, each run
of its consecutive lines (blank ones do not count) is an entire text, so a
licence or notice inside a document is found wherever it begins and ends with a
line, however its lines and paragraphs are broken. Of these runs only those are
digested that begin like a known text and are as long as it.

The known texts are a constant table, so their broadcast has a fixed bound:
notices and short licences (``KNOWN``) and the whole texts of ``license_files``.
A document's digests are exploded and grouped again by row (the group is
partially aggregated where it is made).

Defined results: a null or empty text, or one of copyright statements alone, has the
digest of the empty text, which is no licence; repeated rows give a row each;
extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import KNOWN, whole_texts

#: equivalent spellings on canonical text (fixed values): pattern, replacement
SPELLINGS = [
    ("licence", "license"),
    ("licenc(ed|ing|or|ee)", "licens$1"),
    ("sub license", "sublicense"),
    ("non (commercial|infringement)", "non$1"),
    ("(behavi|col|fav|hon|lab)our", "$1or"),
    ("(author|organ|recogn|real|util|custom|initial|modern|optim)is(e|ing|ation)", "$1iz$2"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("https www |https |http www |http ", "http "),
    ("whilst", "while"),
    ("fulfil(ment|s|) ", "fulfill$1 "),
    ("per cent", "percent"),
]
#: of the SQL twin, which leaves out whole lines
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n©]*(copyright \(c\)|copyright ©|copyright [0-9]|\(c\)|©|all rights reserved)[^\n]*$"
#: words that follow a copyright statement and are not its holder
_AFTER = r"(?:all rights reserved|(?:is |are )?(?:licen[sc]ed|released|distributed|available|provided) under|permission |redistribution |this )"
#: the end of a holder: of the line; a full stop after a word that is neither an
#: initial nor a company's ending that goes on; or the words after a statement
_ENDS = (
    r"(?:[^\p{L}\p{N}\n]*$|(?<=[\p{L}\p{N})>]{2})(?<!\b(?:inc|ltd|corp|co|llc|jr|sr|dr|st))\.(?=\s)"
    r"|(?<=\b(?:inc|ltd|corp|co|llc|jr|sr))\.(?=\s+(?!and\b|&|et\b|or\b|[<(,]|https?:|all rights))|(?=[^\p{L}\p{N}\n]" + _AFTER + "))"
)
#: copyright statements at the start of a line: a mark, at most 200 characters of
#: years and holder, and the end; or "all rights reserved" as a sentence. An
#: enumerated "(c)" without a year, and a longer sentence, are none.
COPYRIGHT_STATEMENTS = (
    r"(?m)^[^\p{L}\p{N}\n©]*(?<!\()(?:(?:(?:copyright (?:\(c\)|©|(?=(?:19|20)[0-9]{2}))|\(c\)(?=[^\p{L}\p{N}\n]*(?:19|20)[0-9]{2})|©)"
    rf"[^\n]{{0,200}}?{_ENDS}|all rights reserved(?:\.(?=\s)|[^\p{{L}}\p{{N}}\n]*$|(?=[^\p{{L}}\p{{N}}\n]+{_AFTER})))[^\p{{L}}\p{{N}}\n©(]*)++"
)
COPYRIGHT_MARKS = ["copyright", "(c)", "©", "all rights reserved"]
#: every known text has one of these; spellings are made one only in texts that have
LICENSE_MARKS = ["license", "licence", "permission", "permitted", "redistribut", "warrant", "copyright"]
#: first characters of a known text that a line, and the lines from it on, must have
START, HEAD = 16, 64


def _has(text: Column, marks: list[str]) -> Column:
    return reduce(lambda x, y: x | y, [F.contains(text, F.lit(m)) for m in marks])


def plain(text: Column) -> Column:
    """Lower case without copyright statements."""
    text = F.lower(F.coalesce(text, F.lit("")))
    return F.when(_has(text, COPYRIGHT_MARKS), F.regexp_replace(text, COPYRIGHT_STATEMENTS, "")).otherwise(text)


def spaced(text: Column) -> Column:
    """Words with one space between them; line ends stay."""
    return F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " "), r" ?\n ?", "\n")


def spelled(text: Column) -> Column:
    """One spelling for equivalent ones in texts that speak of licences."""
    same = text
    for pattern, replacement in SPELLINGS:
        same = F.regexp_replace(same, pattern, replacement)
    return F.when(_has(text, LICENSE_MARKS), same).otherwise(text)


def _forms(df: DataFrame, text: str, form: str) -> DataFrame:
    """Adds the canonical form; a step a projection, so that none runs twice."""
    return df.withColumn("_a", plain(F.col(text))).withColumn("_b", spaced(F.col("_a"))).withColumn(form, spelled(F.col("_b"))).drop("_a", "_b")


def _line(form: Column) -> Column:
    """A run of lines of a canonical form as one line."""
    return F.btrim(F.regexp_replace(form, r"\n+", " "))


def known_digests(spark) -> DataFrame:
    """(digest, license, size, head): one row for each known canonical text."""
    known = _forms(spark.createDataFrame(KNOWN + whole_texts(), "license string, text string"), "text", "form").select("license", _line(F.col("form")).alias("form"))
    return known.select(F.sha2("form", 256).alias("digest"), "license", F.length("form").alias("size"), F.substring("form", 1, HEAD).alias("head")).distinct()


def _run_digests(lines: Column, known: list) -> Column:
    """Digests of the runs of lines that begin and are as long as a known text.

    A run must begin with a line that begins a known text (looked up among the
    first characters of all of them, so that nearly all lines leave here), go on
    like the head of one, and have a line end where that one ends."""
    starts = sorted({k.head[:n] for k in known for n in range(1, START + 1)})
    kinds = F.array(*[F.struct(F.lit(h).alias("head"), F.lit(n).alias("size")) for h, n in sorted({(k.head, k.size) for k in known})])
    # lines are not empty, so a run of n characters has at most (n + 1) / 2
    at = F.filter(F.transform(lines, lambda x, i: F.when(F.substring(x, 1, START).isin(starts), i + 1)), lambda i: i.isNotNull())

    def runs(i: Column) -> Column:
        near = F.substring(F.array_join(F.slice(lines, i, HEAD // 2 + 1), " "), 1, HEAD)
        fitting = F.filter(kinds, lambda k: near.startswith(k["head"]))
        return F.filter(F.transform(fitting, lambda k: run(i, k["size"])), lambda x: x.isNotNull())

    def run(i: Column, size: Column) -> Column:
        # one character more than the known text: a line end, or missing at the end of the text
        text = F.rtrim(F.substring(F.array_join(F.slice(lines, i, F.floor(size / 2).cast("int") + 2), "\n"), 1, size + 1), F.lit("\n"))
        return F.when(F.length(text) == size, F.sha2(F.translate(text, "\n", " "), 256))

    return F.array_distinct(F.flatten(F.transform(at, runs)))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_digest, license, notices, n_notices): the licence that the
    whole text is (or null), and the distinct licences of runs of lines, sorted
    and joined by a comma (empty if none), with their number."""
    spark = docs.sparkSession
    found = known_digests(spark).collect()  # a constant table of a few dozen rows
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("_t")).withColumn("_row", F.monotonically_increasing_id())
    rows = _forms(rows, "_t", "_form").select("_row", "doc_id", "_form")
    lines = F.filter(F.transform(F.split("_form", "\n"), lambda x: F.btrim(x)), lambda x: x != "")
    rows = rows.select("_row", "doc_id", F.sha2(_line(F.col("_form")), 256).alias("text_digest"), lines.alias("_lines"))
    units = rows.select("_row", "doc_id", "text_digest", _run_digests(F.col("_lines"), found).alias("_parts"))
    known = F.broadcast(spark.createDataFrame(sorted({(k.digest, k.license) for k in found}), "digest string, license string"))
    own = known.withColumnRenamed("digest", "text_digest")
    exploded = units.select("_row", "doc_id", "text_digest", F.explode_outer("_parts").alias("digest")).join(known.withColumnRenamed("license", "_notice"), "digest", "left")
    grouped = exploded.groupBy("_row", "doc_id", "text_digest").agg(F.collect_set("_notice").alias("_all"))
    return grouped.join(own, "text_digest", "left").select("doc_id", "text_digest", "license", F.array_join(F.array_sort("_all"), ",").alias("notices"), F.size("_all").cast("long").alias("n_notices"))


# ---- SQL twin ----------------------------------------------------------------
def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    has = lambda x, marks: "(" + " OR ".join(f"contains({x}, {_quoted(m)})" for m in marks) + ")"
    low = f"lower(coalesce({text}, ''))"
    sql = f"CASE WHEN {has(low, COPYRIGHT_MARKS)} THEN regexp_replace({low}, {_quoted(COPYRIGHT_LINE)}, '', 'g') ELSE {low} END"
    words = "[^\\p{L}\\p{N}\\n]+"
    sql = f"regexp_replace(regexp_replace({sql}, '{words}', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"
    same = sql
    for pattern, replacement in SPELLINGS:
        same = f"regexp_replace({same}, {_quoted(pattern)}, {_quoted(replacement.replace('$', chr(92)))}, 'g')"
    return f"CASE WHEN {has(sql, LICENSE_MARKS)} THEN {same} ELSE {sql} END"


def _whole_sql(form: str) -> str:
    return f"sha256(trim(regexp_replace({form}, '\\n+', ' ', 'g')))"


def scan_sql() -> str:
    """The query of ``scan`` over ``documents`` in DuckDB's SQL."""
    known = ", ".join("('" + k + "', '" + t.replace("'", "''") + "')" for k, t in KNOWN)
    return f"""
        WITH texts(license, text) AS (VALUES {known}),
        known AS (SELECT DISTINCT {_whole_sql(_canonical_sql('text'))} AS digest, license FROM texts),
        rows AS (SELECT row_number() OVER () AS nr, doc_id, {_canonical_sql('text')} AS form FROM documents),
        parts AS (
            SELECT nr, unnest(list_concat(string_split(form, chr(10)), regexp_split_to_array(form, '\n\n+'))) AS part FROM rows
        ),
        found AS (
            SELECT nr, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(DISTINCT license) AS n_notices
            FROM parts JOIN known ON {_whole_sql('part')} = digest GROUP BY nr
        )
        SELECT doc_id, {_whole_sql('form')} AS text_digest, license, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
        FROM rows LEFT JOIN found USING (nr) LEFT JOIN known ON {_whole_sql('form')} = digest
    """
