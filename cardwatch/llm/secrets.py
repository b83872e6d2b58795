"""Secrets by corpus-wide ownership frequency, in DataFrame operations only.

Candidates are spans of secret-like patterns.  The hash of each candidate's
secret is counted over the corpus by distinct repositories and owners: a secret
that at least ``copied_owners`` owners hold is a widely copied example, any
other is owner-specific and looks live.

Base spans (assign, access, hex) always stay and are classed; loose candidates
(service tokens, mixed blobs) are added only if they are owner-specific and
overlap no base span.

Defined results: null and empty texts have no span; a null repository counts as
one repository and owner; the owner is the repository's part before ``/``;
repeated rows get the same result; an empty table gives an empty result.

Scale: one pass over the texts, whose (few) candidates are written to the
shared folder.  Counting is by partial aggregates, first by (hash, owner,
repository), so a secret in a third of all rows is a few rows per task.  The
counts are written before spans are joined with them: the spans are then a
plain shuffle read, which adaptive execution splits where one secret has very
many.  Rows without candidates are in no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import common
from cardwatch.llm.spans import joined, let, matches

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "service", "blob")

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "service": (r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[baprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
                r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})"),
    "blob": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}",
}
MARKS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk_live_", "xox", "AIza", "eyJ")
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,hash:string>>"


def _spans(kind: str, text: Column) -> Column:
    """Matches of one kind: start, rank of the kind, end, kind and the hash of the secret."""
    gate = {"assign": F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), "access": F.contains(text, F.lit("AKIA")),
            "hex": text.rlike("[0-9a-f]{24}"), "blob": text.rlike("[A-Za-z0-9+/_-]{32}")}
    gate["service"] = F.contains(text, F.lit(MARKS[0]))
    for mark in MARKS[1:]:
        gate["service"] = gate["service"] | F.contains(text, F.lit(mark))
    secret = lambda m: F.regexp_extract(m["value"], ASSIGN, 1) if kind == "assign" else m["value"]
    found = matches(text, gate[kind], PATTERNS[kind], context=1)
    if kind == "assign":
        found = F.filter(found, lambda m: F.length(secret(m)) >= 6)
    if kind == "blob":
        found = F.filter(found, lambda m: m["value"].rlike("[a-z]") & m["value"].rlike("[A-Z]") & m["value"].rlike("[0-9]"))
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"),
                                                 F.lit(kind).alias("kind"), F.sha2(secret(m), 256).alias("hash"))).cast(SPAN)


def candidates(text: Column) -> Column:
    """Base spans, and loose spans that overlap none of them, as a struct of two arrays."""
    base = F.concat(*[_spans(k, text) for k in BASE_KINDS])
    loose = F.concat(*[_spans(k, text) for k in KINDS if k not in BASE_KINDS])

    def clear(s: Column) -> Column:
        service = lambda x: x["kind"] == "service"
        free = F.filter(s["loose"], lambda x: ~F.exists(s["base"], lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
        # a blob that is part of a service token is that token
        own = let(free, lambda f: F.filter(f, lambda x: service(x) | ~F.exists(f, lambda y: service(y) & (y["start"] < x["end"]) & (x["start"] < y["end"]))))
        return F.struct(F.array_sort(s["base"]).alias("base"), F.array_sort(own).alias("loose"))

    return let(F.struct(base.alias("base"), loose.alias("loose")), clear)


def ownership(held: DataFrame) -> DataFrame:
    """Per ``hash`` the numbers of repositories and owners, from rows of ``hash``, ``owner``, ``repo``."""
    return (held.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
            .groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
            .groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"), F.sum("n").alias("n_rows")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", copied_owners: int = 3) -> DataFrame:
    """One row per row of ``docs``: the id and ``secrets``, an array ordered by start and kind of kind, start, end, base,
    ``n_repos``, ``n_owners`` and ``live``."""
    repo = F.coalesce(F.col(repo_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), repo.alias("repo"), F.substring_index(repo, "/", 1).alias("owner"),
                       F.col(text_col).alias("text"))
    rows = rows.withColumn("c", candidates(F.col("text")))
    some = F.size("c.base") + F.size("c.loose") > 0
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("null")), "repo", F.md5("text")))
    rows = common.shared(rows.select("id", "repo", "owner", F.when(some, key).alias("key"), "c.base", "c.loose"))

    spans = F.concat(F.transform("base", lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["hash"], F.lit(True).alias("base"))),
                     F.transform("loose", lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["hash"], F.lit(False).alias("base"))))
    held = rows.filter(F.col("key").isNotNull()).select("key", "repo", "owner", F.explode(spans).alias("s")).select(
        "key", "repo", "owner", F.col("s.start").alias("start"), F.col("s.rank").alias("rank"), F.col("s.end").alias("end"),
        F.col("s.kind").alias("kind"), F.col("s.base").alias("base"), F.col("s.hash").alias("hash"))
    known = held.select("hash", "owner", "repo")
    judged = held.distinct().join(common.shared(ownership(known)), "hash").withColumn("live", F.col("n_owners") < copied_owners).filter("base OR live")
    per_row = judged.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
        "start", "rank", "end", "kind", "base", "n_repos", "n_owners", "live"))).alias("secrets"))
    kind = per_row.schema["secrets"].dataType
    out = [F.col("id").alias(id_col), F.coalesce("secrets", F.array().cast(kind)).alias("secrets")]
    with_some = rows.filter(F.col("key").isNotNull()).join(per_row, "key", "left").select(*out)
    return with_some.union(rows.filter(F.col("key").isNull()).select(F.col("id").alias(id_col), F.array().cast(kind).alias("secrets")))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, classed by how many sources hold them."""
    found = scan(common.table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["base"])
    count = lambda k: F.size(F.filter("secrets", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    live = F.size(F.filter("secrets", lambda s: s["live"])).cast("long")
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"), live.alias("n_live"),
                        (F.size("secrets") - live).cast("long").alias("n_examples"))
