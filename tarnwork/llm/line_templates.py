"""Line deduplication by log templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import DOCUMENT, materialize, pick, table

c = F.col

#: The white space that parts words, and what stands for a word with a digit.
SPACE, VARIABLE = r"[\x20\x09-\x0D]+", "<*>"
_WITH_DIGIT = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
LEAD, BANDS, LEAST_WORDS = 3, 3, 5


def _words(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _WITH_DIGIT, VARIABLE)).otherwise(line)
    return F.array_remove(F.split(masked, SPACE), "")


def _templates(words: Column, lead: int, bands: int) -> Column:
    """Hashes of the templates that a line of these words falls under: one for each band that may vary."""
    n = F.size(words)
    width = F.ceil((n - lead) / bands).cast("int")
    path = F.xxhash64(n, F.slice(words, 1, lead))
    band = [F.xxhash64(F.slice(words, F.lit(lead + 1) + j * width, width)) for j in range(bands)]
    return F.array_compact(F.array(*[
        F.when(n > lead + j * width, F.xxhash64(F.lit(j), path, *band[:j], *band[j + 1 :])) for j in range(bands)
    ]))


def _whole(words: Column) -> Column:
    """The one template of a short line: all its words, none open."""
    return F.array(F.xxhash64(F.lit(-1), F.size(words), words))


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(2**63 - 1))


def recurring_lines(docs: DataFrame, lead: int = LEAD, bands: int = BANDS, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, row, dropped): the numbers of the lines whose template a smaller id has too; rows without are missing.

    ``row`` is the hash of the text, for ids that occur with several texts.
    """
    if least_words <= lead:
        raise ValueError("least_words is over lead")
    rows = pick(docs, doc_id="long", text="string").select(
        _order(c("doc_id")).alias("doc"), F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line", "of")
    )
    templates = F.when(F.size("words") >= least_words, _templates(c("words"), lead, bands)).otherwise(_whole(c("words")))
    words = rows.select("doc", "row", "line", _words(c("of")).alias("words")).where(F.size("words") > 0)
    lines = materialize(words.select("doc", "row", "line", templates.alias("templates")), "lines")
    each = lines.select("doc", "row", "line", F.explode("templates").alias("template"))
    shared = materialize(
        each.groupBy("template").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("template", "first"),
        "recurring-templates",
    )
    again = each.join(shared, "template").where("first < doc").select("doc", "row", "line")
    return again.groupBy("doc", "row").agg(F.collect_set("line").alias("dropped"))


def drop_recurring_lines(docs: DataFrame, lead: int = LEAD, bands: int = BANDS, least_words: int = LEAST_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text, ``keep``) of every row of ``docs``, the text without lines of recurring templates.

    A line's place in the template tree is its number of words and its first
    ``lead`` words, words with a digit standing for any such word; the words
    after them are cut into ``bands`` runs of nearly equal length, and a leaf
    holds lines that agree on all runs but one, whose words are the variable
    fields.  A template recurs if several ids have it: the smallest id keeps
    its lines, all others lose theirs.  A line may fall under up to ``bands``
    templates and goes if one of them recurs.

    A line of 1 to ``least_words`` - 1 words has one template, its number of
    words and all of them, none open.  Lines without a word always stay.

    Leaves are hashes that are aggregated, never lists of lines, so a template
    of a third of all lines is one row of each task.  A null text stays null;
    rows with one id are one document; null ids are one document after all
    others; no rows give no rows.  Text is shuffled once.
    """
    rows = pick(docs, doc_id="long", text="string", **{n: DOCUMENT[n] for n in keep}).withColumns(
        {"doc": _order(c("doc_id")), "row": F.xxhash64("text")}
    )
    gone = recurring_lines(docs, lead, bands, least_words)
    lines = F.split("text", "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), c("dropped")), lambda i: F.get(lines, i))
    return rows.join(gone, ["doc", "row"], "left").select(
        "doc_id",
        F.when(c("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(c("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.when(c("dropped").isNull(), c("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        *keep,
    )


def op1_line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(table(spark, sf_dir, "documents"))


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, text, ls, unnest(range(len(ls))) AS line FROM (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents)
), words AS (
  SELECT doc_id, text, line, list_filter(string_split_regex(regexp_replace(ls[line + 1], '{_WITH_DIGIT}', '{VARIABLE}', 'g'), '{SPACE}'), lambda x: x <> '') AS w
  FROM lines
), long_lines AS (
  SELECT doc_id, text, line, w, len(w) AS n, ceil((len(w) - {LEAD}) / {BANDS}.0)::BIGINT AS width FROM words WHERE len(w) >= {LEAST_WORDS}
), templates AS (
  SELECT doc_id, text, line, [n::VARCHAR, j::VARCHAR] || w[1:{LEAD} + j * width] || ['|'] || w[{LEAD} + (j + 1) * width + 1:n] AS template
  FROM (SELECT *, unnest(range({BANDS})) AS j FROM long_lines) WHERE n > {LEAD} + j * width
  UNION ALL
  SELECT doc_id, text, line, [len(w)::VARCHAR, 'whole'] || w AS template FROM words WHERE len(w) BETWEEN 1 AND {LEAST_WORDS} - 1
), recurring AS (
  SELECT template, min(doc_id) AS first FROM templates GROUP BY template HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT doc_id, text, list(DISTINCT line) AS dropped FROM templates JOIN recurring USING (template) WHERE first < doc_id GROUP BY doc_id, text
)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(dropped), 0)::BIGINT AS n_dropped,
  CASE WHEN dropped IS NULL THEN d.text ELSE array_to_string(
    list_filter(string_split(d.text, chr(10)), lambda x, i: NOT list_contains(dropped, i - 1)), chr(10)) END AS text
FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id AND d.text = g.text
"""
