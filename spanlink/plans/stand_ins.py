"""Tables of the library's shapes made from general ones, for queries and their SQL.

A document is a book and its text lines are the book's lines, in the baseline and in the current snapshot. Since the baseline every eleventh
book came under its present title and every seventh went under its old one; in the current snapshot every fifth has an edited first line and
every third its first two lines swapped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.schemas import LINES


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _all(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("source", "doc_id", F.col("lang").alias("context"), F.split("text", "\n").alias("parts"))
    return d.select("source", "doc_id", "context", F.size("parts").alias("n"), F.posexplode("parts").alias("line_index", "content"))


def prior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all(spark, sf_dir).withColumn("title", _title(11, "old ")).select(*LINES.names)


def _title(every: int, prefix: str) -> Column:
    name = F.col("doc_id").cast("string")
    return F.when(F.col("doc_id") % every == 0, F.concat(F.lit(prefix), name)).otherwise(name)


def current_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    swapped = (F.col("doc_id") % 3 == 0) & (F.col("n") >= 2) & (F.col("line_index") < 2)
    edited = (F.col("doc_id") % 5 == 0) & (F.col("line_index") == 0)
    content = F.when(edited, F.concat("content", F.lit(" edited"))).otherwise(F.col("content"))
    d = _all(spark, sf_dir).withColumn("title", _title(7, "new "))
    return d.select("source", "title", F.when(swapped, 1 - F.col("line_index")).otherwise(F.col("line_index")).alias("line_index"), content.alias("content"), "context")


CTE = """
l AS (SELECT source, doc_id, lang AS context, len(string_split(text, chr(10))) AS n,
             unnest(string_split(text, chr(10))) AS content, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS line_index
      FROM documents),
pri AS (SELECT source, CASE WHEN doc_id % 11 = 0 THEN 'old ' ELSE '' END || doc_id AS title, line_index, content, context FROM l),
cur AS (SELECT source, CASE WHEN doc_id % 7 = 0 THEN 'new ' ELSE '' END || doc_id AS title, (CASE WHEN doc_id % 3 = 0 AND n >= 2 AND line_index < 2 THEN 1 - line_index ELSE line_index END)::INTEGER AS line_index,
               CASE WHEN doc_id % 5 = 0 AND line_index = 0 THEN content || ' edited' ELSE content END AS content, context
        FROM l)"""

DIGESTS = CTE + """,
hc AS (SELECT source, title, substr(sha1(string_agg(line_index::VARCHAR || chr(0) || content || chr(0) || context || chr(0), '' ORDER BY line_index)), 1, 16) AS hash, count(*) AS n_lines FROM cur GROUP BY ALL),
hp AS (SELECT source, title, substr(sha1(string_agg(line_index::VARCHAR || chr(0) || content || chr(0) || context || chr(0), '' ORDER BY line_index)), 1, 16) AS hash, count(*) AS n_lines FROM pri GROUP BY ALL)"""

PAIRS = CTE + """,
ic AS (SELECT source, title, line_index, md5(content || chr(0) || context) AS fp FROM cur),
ip AS (SELECT source, title, line_index, md5(content || chr(0) || context) AS fp FROM pri),
same AS (SELECT source, title, line_index AS old_index, line_index AS new_index FROM ic JOIN ip USING (source, title, line_index, fp)),
rc AS (SELECT *, row_number() OVER (PARTITION BY source, title, fp ORDER BY line_index) AS k FROM ic ANTI JOIN ip USING (source, title, line_index, fp)),
rp AS (SELECT *, row_number() OVER (PARTITION BY source, title, fp ORDER BY line_index) AS k FROM ip ANTI JOIN ic USING (source, title, line_index, fp)),
mv AS (SELECT rc.source, rc.title, rp.line_index AS old_index, rc.line_index AS new_index FROM rc JOIN rp USING (source, title, fp, k)),
pairs AS (SELECT * FROM same UNION ALL SELECT * FROM mv),
again AS (SELECT source, title, line_index FROM ic ANTI JOIN (SELECT source, title, new_index AS line_index FROM pairs) USING (source, title, line_index)),
isl AS (SELECT *, line_index - row_number() OVER (PARTITION BY source, title ORDER BY line_index) AS g FROM again),
rng AS (SELECT source, title, min(line_index)::INTEGER AS "start", (max(line_index) + 1)::INTEGER AS "end" FROM isl GROUP BY source, title, g)"""


def values(rows: list[tuple], names: str) -> str:
    """Rows as an SQL table."""

    def lit(x) -> str:
        if x is None:
            return "NULL"
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)

    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS v({names}))"
