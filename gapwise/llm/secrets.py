"""Secret scans: pattern spans plus corpus-wide ownership of candidate values.  [native]

Base spans come from three patterns (``KINDS``), each matched leftmost and without overlaps over the whole text.
The method then looks at every candidate value of the corpus: the values of the base spans, and any
random-looking run of 16 characters or more that mixes letters and digits.  Each value's hash is aggregated by
the distinct repositories and owners that hold it.  A value that many owners carry is a copied example; one
that stays with few owners is a live-looking credential, and its bare occurrences outside base spans are
added as spans of kind ``live``.  Base spans are always kept.

Positions are Unicode code points, end exclusive.  They are found natively: splitting a text by a pattern
gives what stands between the matches, and the lengths of both add up to the positions.

Scale: texts are read once and never shuffled; only documents with candidates send small rows.  Distinct
repositories and owners are counted by two-step aggregates with map-side combining, so a value present in
every document stays cheap.  Edge cases: null text is empty; repeated rows get equal results; null owners
count as one owner; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, stored

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: kind, pattern, group that holds the value, its least length, a cheap test that finds every text with a span.
KINDS = (
    ("assign", ASSIGN, 2, 8, r"(?i:passw(?:or)?d|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}"),
    ("access", ACCESS, 0, 16, r"AKIA[A-Z0-9]{12}"),
    ("hex", HEX, 0, 32, r"[0-9a-f]{32}"),
)
#: Random-looking runs: 16 characters or more with a digit next to a letter.
RUN = r"[A-Za-z0-9+/_=-]{16,}"
RUN_TEST = r"[A-Za-z0-9+/_=-]{15}"
RUN_MIX = r"(?:[0-9][A-Za-z][A-Za-z0-9+/_=-]*[0-9][A-Za-z])|(?:[0-9].*[A-Za-z].*[0-9].*[A-Za-z].*[0-9])"

SPAN = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"
#: Owners and repositories (documents) that may hold a value before it counts as widely copied.
MAX_OWNERS, MAX_REPOSITORIES = 2, 20


def _spans(text: Column, pattern: str, group: int, least: int, test: str, kind: int) -> Column:
    """Spans of one pattern, in order."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    between = F.split(text, pattern, -1)
    steps = F.arrays_zip(F.transform(between, lambda x: F.length(x)).alias("g"), F.transform(hits, lambda x: F.length(x)).alias("m"), values.alias("v"))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(f"cast(array() as {SPAN})").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["g"]
        end = start + x["m"]
        one = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value")))
        ok = x["m"].isNotNull() & (F.length(x["v"]) >= least)
        return F.struct(F.coalesce(end, start).cast("bigint").alias("at"), F.when(ok, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(steps, zero, step, lambda acc: acc["out"])
    return F.when(text.rlike(test), found).otherwise(F.expr(f"cast(array() as {SPAN})"))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind as listed."""
    parts = [_spans(text, p, g, least, test, k) for k, (_, p, g, least, test) in enumerate(KINDS)]
    return F.array_sort(F.concat(*parts), lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(a["kind"] - b["kind"]))


def _listed(spans: Column, kinds: tuple) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """docs(doc_id, text, owner, repository) -> doc_id, __key, base, live, n_shared.

    A value is widely copied if more than ``max_owners`` owners or more than ``max_repositories`` repositories hold it; the table of
    those values, not of all, is joined back, as a broadcast only where its counted rows are few.  ``live`` holds the added spans: runs
    whose value is not widely copied and that touch no base span.  ``n_shared`` counts a document's widely copied candidates.
    ``__key`` is the text's hash.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.col(owner).cast("string").alias("__owner"), F.col(repository).cast("string").alias("__repo"), text.alias("__t"))
    runs = F.filter(_spans(F.col("__t"), RUN, 0, 16, RUN_TEST, len(KINDS)), lambda x: x["value"].rlike(RUN_MIX))
    rows = rows.select("doc_id", "__owner", "__repo", F.xxhash64("__t").alias("__key"), base_spans(F.col("__t")).alias("base"), runs.alias("__runs"))
    free = F.filter("__runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    rows = stored(rows.withColumn("__runs", free), "secret-rows")

    cand = rows.where((F.size("base") > 0) | (F.size("__runs") > 0))
    held = cand.select("__owner", "__repo", F.explode(F.array_distinct(F.transform(F.concat("base", "__runs"), lambda x: F.sha2(x["value"], 256)))).alias("__h"))
    distinct = lambda c: held.select("__h", c).distinct().groupBy("__h")
    many = [distinct(c).agg(F.count("*").alias("c")).where(F.col("c") > most).select("__h") for c, most in (("__owner", max_owners), ("__repo", max_repositories))]
    wide = stored(many[0].union(many[1]).distinct().withColumn("__copied", F.lit(True)), "secret-copied")
    copied = F.col("__copied").isNotNull()
    each = cand.select("doc_id", "__key", F.explode(F.concat("base", "__runs")).alias("s")).distinct().withColumn("__h", F.sha2(F.col("s.value"), 256))
    judged = each.join(bounded(wide, wide.count()), "__h", "left").groupBy("doc_id", "__key").agg(
        F.sort_array(F.collect_list(F.when((F.col("s.kind") == len(KINDS)) & ~copied, F.col("s")))).alias("live"),
        F.sum(copied.cast("long")).alias("n_shared"),
    )
    judged = judged.withColumnsRenamed({"doc_id": "__id", "__key": "__k"})
    plain = rows.where((F.size("base") == 0) & (F.size("__runs") == 0))
    plain = plain.select("doc_id", "__key", "base", F.lit(None).cast(SPAN).alias("live"), F.lit(0).cast("long").alias("n_shared"))
    found = cand.join(judged, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__k"))).select("doc_id", "__key", "base", "live", "n_shared")
    return plain.unionByName(found).withColumn("live", F.coalesce("live", F.expr(f"cast(array() as {SPAN})")))


def all_spans() -> Column:
    return F.array_sort(F.concat("base", "live"), lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(a["kind"] - b["kind"]))


def redacted(docs: DataFrame, mark: str = "[SECRET]", **how) -> DataFrame:
    """The documents, each secret replaced by ``mark``; overlapping spans become one.  Columns stay as they are."""
    cols = docs.columns
    found = scan(docs, **how).where((F.size("base") > 0) | (F.size("live") > 0)).select(F.col("doc_id").alias("__id"), F.col("__key").alias("__k"), all_spans().alias("__s")).dropDuplicates(["__id", "__k"])
    rows = docs.withColumn("__key", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__k")), "left")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out"))
        inside = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(inside)

    masked = F.aggregate("__s", zero, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))))
    rows = rows.withColumn("text", F.when(F.col("__s").isNotNull(), masked).otherwise(F.col("text")))
    if "n_chars" in cols:
        rows = rows.withColumn("n_chars", F.when(F.col("__s").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*cols)


def op2(spark, sf_dir: str) -> DataFrame:
    from .common import table

    names = (*[k for k, *_ in KINDS], "live")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base"), names), 256).alias("base_sha256"),
        _listed(all_spans(), names).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.col("n_shared").cast("long").alias("n_shared"),
    )


def _oracle() -> str:
    keyword = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    assign = rf"""({keyword})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = ((assign, 2, 8), (ACCESS, 0, 16), (HEX, 0, 32), (RUN, 0, 16))
    parts = []
    for k, (p, g, least) in enumerate(kinds):
        mix = f" AND regexp_matches(v[i], '{RUN_MIX}')" if k == 3 else ""
        parts.append(
            f"SELECT rid, {k} AS kind, unnest(list_transform(list_filter(range(1, len(m) + 1), lambda i: length(v[i]) >= {least}{mix}), "
            f"lambda i: {{'s': CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT), 'm': length(m[i]), 'v': v[i]}})) AS x "
            f"FROM (SELECT rid, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {g}) AS v, regexp_split_to_array(t, '{p}') AS g FROM d)"
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
a AS (SELECT rid, kind, x.s AS s, CAST(x.s + x.m AS BIGINT) AS e, x.v AS v FROM ({" UNION ALL ".join(parts)})),
c AS (SELECT * FROM a WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM a b WHERE b.rid = a.rid AND b.kind < 3 AND b.s < a.e AND a.s < b.e)),
o AS (SELECT v, count(DISTINCT coalesce(source, '~null')) > 2 OR count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '~null')) > 20 AS copied FROM c JOIN d USING (rid) GROUP BY v),
j AS (SELECT c.*, copied, CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'live' END || ':' || s || ':' || e AS n FROM c JOIN o USING (v)),
p AS (SELECT rid, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
        string_agg(n, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base, string_agg(n, ',' ORDER BY s, kind) FILTER (WHERE kind < 3 OR NOT copied) AS spans,
        count(*) FILTER (WHERE kind = 3 AND NOT copied) AS n_live, count(*) FILTER (WHERE copied) AS n_shared FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared
FROM d LEFT JOIN p USING (rid)
"""


ORACLE_OP2 = _oracle()
