"""Secret scans with multipart credential linking, in built-in column functions and joins alone.

Base kinds are matched leftmost and non-overlapping per kind over whole texts: `assign`, `access`, `hex`. Text between
matches (split) and matches (extract) alternate, so running lengths give positions in code points.

Parts of credentials that mean little alone are candidates: `weak_id` (account-like names), `weak_secret` (random-looking
strings with a digit and a letter), `endpoint` (addresses of services), each of any length. Every part is posted by its scope buckets, SCOPE
code points wide, and candidates meet the parts of all buckets within SCOPE in an equi-join cut down to gaps of at most SCOPE. A weak identifier is
reported when a secret lies in its scope, a weak secret when an identifier does, an endpoint when both do. Candidates that overlap a base
span are that span already. A bucket holds at most SCOPE code points' worth of parts, whatever the document's length.

Defined cases: null or empty text has no spans; repeated rows are scanned each for itself; a null doc_id is kept; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import materialize, table

SCOPE = 300
#: kind: (pattern, group that must have `least` characters, least)
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    # every run of 24 and more is a leftmost match of the unbounded pattern too, and the others are dropped anyway
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
WEAK = {
    "weak_id": (r"""(?:(?<![A-Za-z0-9])(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{12,}|(?i:client_?id|account_?id|access_?id|key_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}+)""", 0, 6),
    "weak_secret": (r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{28,}+={0,2}+(?![A-Za-z0-9+/=_-])", 0, 28),
    "endpoint": (r"""(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]{3,}+""", 0, 8),
}
#: What a value of the kind must hold besides, wherever in it.
HOLDS = {"weak_secret": ("[0-9]", "[A-Za-z]")}
KINDS = [*BASE, *WEAK]
_SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Sorted spans of a kind; end is exclusive."""
    p = F.lit(pattern)
    hits = F.regexp_extract_all(text, p, F.lit(0))
    values = F.regexp_extract_all(text, p, F.lit(group)) if group else hits
    steps = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value"))
    none = F.array().cast(_SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), end.alias("end"), F.lit(kind).alias("kind"))
        counts = F.length(x["value"]) >= least
        for held in HOLDS.get(kind, ()):
            counts = counts & x["value"].rlike(held)
        kept = F.when(counts, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, weak): spans of each row; `row` tells rows of one id apart."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    base = F.array_sort(F.concat(*[spans_of(F.col("text"), k, *rule) for k, rule in BASE.items()]))
    weak = F.concat(*[spans_of(F.col("text"), k, *rule) for k, rule in WEAK.items()])
    return d.select("row", "doc_id", base.alias("base"), weak.alias("weak")).withColumn(
        "weak", F.filter("weak", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    )


def linked(scanned: DataFrame) -> DataFrame:
    """(row, linked): the weak spans of each row that complementary parts lie near to, by an interval join."""
    role = F.when(F.col("kind").isin("access", "weak_id"), "identifier").when(F.col("kind") == "endpoint", "endpoint").otherwise("secret")
    some = scanned.where(F.size("weak") > 0)
    parts = some.select("row", F.explode(F.concat("base", "weak")).alias("s")).select("row", "s", F.col("s.kind").alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end")).withColumn("role", role)
    # a part is posted in every bucket that it touches, a candidate asks all that a part within SCOPE may touch
    first, last = F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE)
    from_, to = F.floor((F.col("start") - SCOPE - 1) / SCOPE), F.floor((F.col("end") + SCOPE) / SCOPE)
    posted = parts.where("role <> 'endpoint'").select("row", F.explode(F.sequence(first, last)).alias("bucket"), F.col("role").alias("near"), F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    asking = parts.where(F.col("kind").isin(*WEAK)).select("row", F.explode(F.sequence(from_, to)).alias("bucket"), "role", "s")
    near = asking.join(posted, ["row", "bucket"]).where((F.col("p_start") - F.col("s.end") <= SCOPE) & (F.col("s.start") - F.col("p_end") <= SCOPE))
    seen = near.groupBy("row", "role", "s").agg(F.max(F.col("near") == "identifier").alias("identifier"), F.max(F.col("near") == "secret").alias("secret"))
    role = F.col("role")
    kept = ((role == "identifier") & F.col("secret")) | ((role == "secret") & F.col("identifier")) | ((role == "endpoint") & F.col("secret") & F.col("identifier"))
    return seen.where(kept).groupBy("row").agg(F.collect_list("s").alias("linked"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) per row of (doc_id, text): spans in order of start, then kind as in KINDS."""
    scanned = materialize(scan(docs))
    out = scanned.join(linked(scanned), "row", "left")
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN))))
    return out.select("doc_id", "base", every.alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    counts = [count_of(k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _letters(*words: str) -> str:
    """An alternation of words whose ASCII letters may be of either case; `?` stays."""
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


_NAMES = _letters("password", "passwd", "secret", "token", "api_?key")
_IDS = _letters("client_?id", "account_?id", "access_?id", "key_?id", "user_?name", "login")
_SCHEMES = _letters("https?", "ftp", "postgres(?:ql)?", "mysql", "mongodb", "redis", "amqp", "s3")
#: kind: (pattern without look-around, group, condition on hit and value). What an identifier must not follow is taken into the hit
#: and off again; a weak secret is a maximal run of its characters and of "=" that has the right form.
_SQL_RULES = {
    "assign": (rf"""({_NAMES})["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""", 2, "length(val) >= 6"),
    "access": ("AKIA[A-Z0-9]+", 0, "length(val) >= 20"),
    "hex": ("[0-9a-f]{24,}", 0, "true"),
    "weak_id": (rf"""(?:^|[^A-Za-z0-9])(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{{12,}}|(?:{_IDS})["\']?\x20*[:=]\x20*["\']?[A-Za-z0-9_.@-]{{3,}}""", 0, "true"),
    "weak_secret": ("[A-Za-z0-9+/=_-]{28,}", 0, "regexp_full_match(hit, '[A-Za-z0-9+/_-]{28,}={0,2}') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')"),
    "endpoint": (rf"""(?:{_SCHEMES})://[^\x20\x09-\x0D"\'<>]{{3,}}""", 0, "true"),
}


def _sql_spans(kind: str) -> str:
    pattern, group, holds = _SQL_RULES[kind]
    p = "'" + pattern.replace("\\'", "''") + "'"
    cut = f"(SELECT row, regexp_extract_all(text, {p}) AS hits, regexp_extract_all(text, {p}, {group}) AS vals, regexp_split_to_array(text, {p}) AS gaps FROM d WHERE regexp_matches(text, {p}))"
    each = f"(SELECT row, unnest(hits) AS hit, unnest(vals) AS val, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM {cut})"
    ends = f"(SELECT row, hit, val, sum(length(gap) + length(hit)) OVER (PARTITION BY row ORDER BY i) AS stop FROM {each})"
    body = "regexp_replace(hit, '^[^A-Za-z0-9]', '')" if kind == "weak_id" else "hit"
    return f"SELECT row, {KINDS.index(kind)} AS no, '{kind}' AS kind, (stop - length({body}))::BIGINT AS start, stop::BIGINT AS stop FROM {ends} WHERE {holds}"


OP7_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED ({" UNION ALL ".join(map(_sql_spans, BASE))}),
weak AS MATERIALIZED (SELECT * FROM ({" UNION ALL ".join(map(_sql_spans, WEAK))}) w WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = w.row AND b.start < w.stop AND w.start < b.stop)),
parts AS (SELECT *, CASE WHEN kind IN ('access', 'weak_id') THEN 'identifier' WHEN kind = 'endpoint' THEN 'endpoint' ELSE 'secret' END AS role FROM (SELECT * FROM base UNION ALL SELECT * FROM weak)),
near AS (SELECT w.row, w.no, w.kind, w.start, w.stop, w.role, bool_or(p.role = 'identifier') AS identifier, bool_or(p.role = 'secret') AS secret
  FROM parts w JOIN parts p ON p.row = w.row AND p.role <> 'endpoint' AND p.start - w.stop <= {SCOPE} AND w.start - p.stop <= {SCOPE} WHERE w.kind LIKE 'weak%' OR w.kind = 'endpoint' GROUP BY ALL),
found AS (SELECT row, no, kind, start, stop FROM base UNION ALL
  SELECT row, no, kind, start, stop FROM near WHERE (role = 'identifier' AND secret) OR (role = 'secret' AND identifier) OR (role = 'endpoint' AND secret AND identifier)),
said AS (SELECT row, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
  coalesce(string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, no) FILTER (no < {len(BASE)}), '') AS base, string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, no) AS spans FROM found GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN said USING (row)
"""
