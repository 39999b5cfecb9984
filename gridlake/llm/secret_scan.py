"""Secret scans with corpus-wide ownership frequency.

Candidates are found in every whole text by three patterns (assignments, access
key ids, long hex runs).  Each candidate value is hashed, and the distinct
repositories and owners that hold it are counted over the corpus: a value that
``EXAMPLE_OWNERS`` owners or ``EXAMPLE_REPOS`` repositories hold is a copied
example, whatever it looks like; one that fewer hold is a live-looking
credential and gets a span of its own, ``live``, on the value, unless it names
itself a placeholder or is a hex run that does not look random (a digest or a
bar of one digit).  The report and the redaction follow this one rule.

All DataFrame functions.  Texts are read once for all kinds and leave that pass
as spans only, which are written to the shared folder for counting and judging.  Positions come from splitting a text at its matches: pieces and
matches alternate, so a running sum of their lengths gives each start (code
points).  Counting first reduces to distinct (value, repository, owner), so a
value copied into a third of all rows leaves each map task once.

Which columns name repository and owner are parameters.  By default a
repository is a (source, language) pair and an owner a source.

Cases: a null text counts as empty; a text of any length is searched whole; a row without candidates has zeros and
empty lists; repeated rows are reported each; null repository or owner counts
as one unnamed holder; null ids are allowed; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# The patterns of the contract; letters of the assignment words in either case.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"""AKIA[A-Z0-9]+"""
HEX = r"""[0-9a-f]+"""
#: Runs shorter than this are no candidates, so they need not be matches either.
HEX_LONG = r"""[0-9a-f]{24,}"""
ACCESS_LONG = r"""AKIA[A-Z0-9]{16,}"""

KINDS = ("assign", "access", "hex")
EXAMPLE_OWNERS = 3      # a value that so many owners hold is an example
EXAMPLE_REPOS = 4       # and so is one in so many repositories, be they of one owner
PLACEHOLDERS = "example|placeholder|changeme|your_|xxxx"
RANDOM_CHARS = 8        # different characters of a hex run that looks random


def _holder(columns):
    return F.concat_ws("\u0000", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def candidates(docs: DataFrame, repo=("source", "lang"), owner=("source",)) -> DataFrame:
    """Base spans of ``docs``: row, doc_id, text_hash, repo, owner, kind, start, end, value.

    ``row`` numbers the rows of this pass; doc_id and the hash of the text name a row elsewhere.
    """
    texts = (docs.where(F.col("text").rlike(f"{ASSIGN}|{ACCESS_LONG}|{HEX_LONG}"))
             .select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"),
                     _holder(repo).alias("repo"), _holder(owner).alias("owner"), "text"))

    def cut(kind, pattern, group):
        """Pieces and matches of one kind; null if the text has none."""
        def when(c):
            return F.when(F.col("text").rlike(pattern), c)
        return F.struct(F.lit(kind).alias("kind"), when(F.split("text", pattern, -1)).alias("pieces"),
                        when(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("found"),
                        when(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).alias("vals"))
    key = ["row", "doc_id", "text_hash", "repo", "owner"]
    by_kind = texts.select(*key, F.inline(F.array(
        cut("assign", ASSIGN, 2), cut("access", ACCESS_LONG, 0), cut("hex", HEX_LONG, 0)))).where("found is not null")
    parts = by_kind.select(*key, "kind", F.posexplode(F.transform(
        F.arrays_zip("pieces", "found", "vals"),
        lambda x: F.struct((F.length(x["pieces"]) + F.coalesce(F.length(x["found"]), F.lit(0))).alias("step"),
                           F.length(x["found"]).alias("long"), x["vals"].alias("value")))).alias("i", "x"))
    before = Window.partitionBy("row", "kind").orderBy("i")
    return (parts.select(*key, "kind", "i", "x.*").withColumn("end", F.sum("step").over(before))
            .where(F.col("long").isNotNull() & ((F.col("kind") != "assign") | (F.length("value") >= 6)))
            .select(*key, "kind", (F.col("end") - F.col("long")).alias("start"), "end", "value"))


def ownership(found: DataFrame) -> DataFrame:
    """(value_hash, n_repos, n_owners) over ``found(value_hash, repo, owner)``."""
    held = found.groupBy("value_hash", "repo", "owner").agg(F.count("*").alias("n"))
    per_owner = held.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return per_owner.groupBy("value_hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"),
                                               F.sum("n").alias("n_uses"))


def looks_like_credential(kind: str = "kind", value: str = "value"):
    """No placeholder word; a hex run also has digits, letters and more than a handful of different characters."""
    v = F.col(value)
    kinds = F.size(F.array_distinct(F.filter(F.split(v, ""), lambda c: c != "")))
    random = v.rlike("[0-9]") & v.rlike("[a-f]") & (kinds >= RANDOM_CHARS)
    return ~F.lower(v).rlike(PLACEHOLDERS) & ((F.col(kind) != "hex") | random)


def scan(docs: DataFrame, repo=("source", "lang"), owner=("source",)) -> DataFrame:
    """All spans: row, doc_id, text_hash, kind, start, end, n_repos, n_owners, verdict.

    ``verdict``: example (many owners or repositories), live (few of both) or weak
    (few, but a placeholder or no credential by its looks).  Live candidates have a
    further span of kind ``live``.
    """
    spans = stored(candidates(docs, repo, owner).withColumn("value_hash", F.sha2("value", 256)), "secret-spans")
    counted = ownership(spans.select("value_hash", "repo", "owner"))
    judged = (spans.join(counted, "value_hash", "left")
              .withColumn("verdict", F.when((F.col("n_owners") >= EXAMPLE_OWNERS)
                                            | (F.col("n_repos") >= EXAMPLE_REPOS), "example")
                          .when(looks_like_credential(), "live").otherwise("weak")))
    columns = ["row", "doc_id", "text_hash", "kind", "start", "end", "n_repos", "n_owners", "verdict"]
    kinds = F.when(F.col("verdict") == "live", F.array("kind", F.lit("live"))).otherwise(F.array("kind"))
    # the base span, and for a live value its own, once however many kinds found it
    both = judged.select("*", F.explode(kinds).alias("as")).select(
        "row", "doc_id", "text_hash", F.col("as").alias("kind"),
        F.when(F.col("as") == "live", F.col("end") - F.length("value")).otherwise(F.col("start")).alias("start"),
        "end", "n_repos", "n_owners", "verdict")
    return both.dropDuplicates(["row", "kind", "start", "end"]).select(columns)


def _rows(spans: DataFrame, *aggregates) -> DataFrame:
    """Aggregates of a row's spans, once for each doc_id and text (rows that repeat both have the same spans)."""
    return (spans.groupBy("row", "doc_id", "text_hash").agg(*aggregates)
            .dropDuplicates(["doc_id", "text_hash"]).drop("row"))


def _joined(spans, base_only: bool):
    """Comma-joined kind:start:end of an ordered array of (start, rank, end, kind)."""
    if base_only:
        spans = F.filter(spans, lambda s: s["rank"] < len(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, **holders) -> DataFrame:
    """Per row of ``docs``: counts of base spans, their digest, all spans, live and example counts."""
    spans = scan(docs, **holders)
    rank = F.expr("array_position(array('assign', 'access', 'hex', 'live'), kind) - 1")
    per_row = (_rows(spans, F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("list"),
                     *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in (*KINDS, "live")],
                     F.count(F.when((F.col("verdict") == "example"), 1)).alias("n_example"))
               .withColumnRenamed("doc_id", "id").withColumnRenamed("text_hash", "hash"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    out = rows.join(per_row, F.expr("doc_id <=> id and text_hash = hash"), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
            for c in ("n_assign", "n_access", "n_hex", "n_live", "n_example")]
    lists = F.coalesce("list", F.expr("cast(array() as array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>)"))
    return out.select("doc_id", *zero[:3], F.sha2(_joined(lists, True), 256).alias("base_sha256"),
                      _joined(lists, False).alias("spans"), *zero[3:])


def redact(docs: DataFrame, mark: str = "[secret]", **holders) -> DataFrame:
    """``docs`` with every live span of ``text`` replaced by ``mark``; all rows and columns stay.

    A column n_chars, if there is one, follows the new text.
    """
    live = (_rows(scan(docs, **holders).where("kind = 'live'"),
                  F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__live"))
            .withColumnRenamed("doc_id", "__id").withColumnRenamed("text_hash", "__hash"))
    # Overlapping spans are merged from left to right while the text is rebuilt.
    rebuilt = F.expr(
        "aggregate(__live, named_struct('at', 0L, 'out', ''), "
        "(a, s) -> if(s.end <= a.at, a, named_struct("
        "'at', cast(s.end as bigint), 'out', concat(a.out, substring(text, int(a.at) + 1, greatest(int(s.start - a.at), 0)), "
        f"if(s.start < a.at, '', '{mark}')))), "
        "a -> concat(a.out, substring(text, int(a.at) + 1)))")
    joined = docs.join(live, F.expr("doc_id <=> __id and xxhash64(text) = __hash"), "left")
    out = joined.withColumn("text", F.when(F.col("__live").isNull(), F.col("text")).otherwise(rebuilt))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__live").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


# The same result in DuckDB SQL (its regex library folds more than ASCII letters, so cases are spelled out).
_SQL_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _sql_kind(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT rid, '{kind}' AS kind, {rank} AS rank,
         list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s,
         length(m[i]) AS n, v[i] AS value
  FROM (SELECT rid, p, m, v, unnest(range(1, len(m) + 1)) AS i FROM
        (SELECT rid, string_split_regex(text, '{pattern}') AS p, regexp_extract_all(text, '{pattern}') AS m,
                regexp_extract_all(text, '{pattern}', {group}) AS v FROM t))
  WHERE length(v[i]) >= {least}"""


ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS owner, coalesce(lang, '') AS lang,
                  coalesce(text, '') AS text FROM documents),
base AS ({_sql_kind('assign', 0, _SQL_ASSIGN, 2, 6)}
  UNION ALL {_sql_kind('access', 1, ACCESS, 0, 20)}
  UNION ALL {_sql_kind('hex', 2, HEX, 0, 24)}),
owners AS (SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, lang)) AS n_repos
  FROM base JOIN t USING (rid) GROUP BY value),
judged AS (SELECT base.*, CASE WHEN n_owners >= 3 OR n_repos >= 4 THEN 'example'
    WHEN regexp_matches(lower(value), 'example|placeholder|changeme|your_|xxxx') THEN 'weak'
    WHEN kind <> 'hex' OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-f]')
         AND len(list_distinct(string_split(value, ''))) >= 8) THEN 'live'
    ELSE 'weak' END AS verdict FROM base JOIN owners USING (value)),
spans AS (SELECT rid, kind, rank, s, s + n AS e, verdict FROM judged
  UNION ALL SELECT DISTINCT rid, 'live', 3, s + n - length(value), s + n, verdict FROM judged WHERE verdict = 'live'),
lists AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'live') AS n_live,
    count(*) FILTER (verdict = 'example') AS n_example,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (rank < 3) AS base_spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM t LEFT JOIN lists USING (rid)
"""
