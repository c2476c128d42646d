"""Secret scan with multipart credential linking (built-in functions only).

Base spans, leftmost and non-overlapping for each kind, are found by the fixed
patterns.  Weak candidates (short values given to a secret's name, short access
identifiers, user names, endpoints) are not reported by themselves: an interval
join within their scope, the paragraph, puts each beside the parts of other roles.
A candidate counts only when the parts it lacks are there, none of which may overlap
it: a secret needs an identifier or endpoint, an identifier needs a secret, an
endpoint needs both.  Whether a scope holds a part of a role outside an interval follows
from the first end and the last start of that role's parts, so the scope's parts are
aggregated to these before the join, and no pairs arise; neither length nor distance is limited.

Positions come from the lengths of the pieces around matches (`split`) and of
the matches themselves (`regexp_extract_all`), summed in order, so a text with
many matches costs no more than its length.  Only matches and row keys are
shuffled; ``redact`` also shuffles the texts that pass the first look, the others stay where they are.

A null text is empty (no spans); repeated rows each get the same result; a null
doc_id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import row_key, written

# Base patterns, fixed values of the operator's contract: (kind, pattern, least length, of group).
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    ("access", r"AKIA[A-Z0-9]+", 18, 0),
    ("hex", r"[0-9a-f]{16,}", 16, 0),
]
# Weak candidates: (kind, pattern, least length, of group).
WEAK = [
    ("link_secret", BASE[0][1], 8, 2),
    ("link_access", r"AKIA[A-Z0-9]+", 16, 0),
    (
        "link_user",
        r"""(?i)\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]+)""",
        3,
        1,
    ),
    ("link_endpoint", r"""(?i)\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb)://[^\s"'<>]+""", 10, 0),
]
# What a kind stands for when parts are put together.
ROLE = {
    "assign": "secret", "hex": "secret", "link_secret": "secret", "access": "id", "link_access": "id",
    "link_user": "id", "link_endpoint": "endpoint",
}
ORDER = ["assign", "access", "hex", "link_secret", "link_access", "link_user", "link_endpoint"]
# A cheap first look: a text without any of these has no base span and no weak candidate to report
# (an endpoint or a user name needs a secret beside it).
FIRST_LOOK = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{16}"


def _pieces(kind: str, pattern: str, group: int) -> F.Column:
    """Array of (kind, order, length before, match length, group length) for one pattern."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split("text", pattern, -1), F.length)
    return F.transform(
        F.arrays_zip(F.transform(found, F.length).alias("m"), F.transform(value, F.length).alias("g"), gaps.alias("b")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), x["b"].alias("before"), x["m"].alias("size"), x["g"].alias("value")
        ),
    )


def parts(docs: DataFrame) -> DataFrame:
    """All base spans, weak candidates and paragraph breaks: ``(k, kind, start, end)``."""
    texts = (
        docs.select(row_key("doc_id", "text").alias("k"), "text").filter(F.col("text").rlike(FIRST_LOOK))
    )
    scans = [(k, p, g) for k, p, _, g in BASE] + [(k, p, g) for k, p, _, g in WEAK if k not in ("link_secret", "link_access")]
    scans.append(("break", r"\n[\x20\t\r]*\n", 0))
    found = texts.select("k", F.explode(F.concat(*[_pieces(*s) for s in scans])).alias("p")).select("k", "p.*")
    # the piece after the last match has no match; repeated rows of one key count once
    found = found.filter("size is not null").dropDuplicates(["k", "kind", "i"])
    order = Window.partitionBy("k", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("before") + F.col("size")).over(order)
    spans = found.select("k", "kind", "value", (ends - F.col("size")).alias("start"), ends.alias("end"))
    least = {k: n for k, _, n, _ in BASE}
    kind = F.col("kind")
    named = F.when(kind == "break", kind)
    for k, n in least.items():
        named = named.when((kind == k) & (F.col("value") >= n), kind)
    for k, _, low, _ in WEAK:  # a value long enough for a base span is one
        of = {"link_secret": "assign", "link_access": "access"}.get(k, k)
        named = named.when((kind == of) & (F.col("value") >= low), F.lit(k))
    return spans.select("k", named.alias("kind"), "start", "end").filter("kind is not null")


def linked(spans: DataFrame) -> DataFrame:
    """The weak candidates of ``spans`` whose complementary parts co-occur in their paragraph."""
    para = Window.partitionBy("k").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    scoped = (
        spans.withColumn("scope", F.sum(F.when(F.col("kind") == "break", 1).otherwise(0)).over(para))
        .filter("kind <> 'break'")
        .withColumn("role", F.element_at(role, F.col("kind")))
    )
    roles = ("secret", "id", "endpoint")
    edge = lambda f, r, of: f(F.when(F.col("role") == r, F.col(of)))
    scopes = scoped.groupBy("k", "scope").agg(
        *[edge(F.min, r, "end").alias(f"first_{r}") for r in roles], *[edge(F.max, r, "start").alias(f"last_{r}") for r in roles]
    )
    weak = scoped.filter(F.col("kind").startswith("link_")).join(scopes, ["k", "scope"])
    has = {
        r: F.coalesce((F.col(f"first_{r}") <= F.col("start")) | (F.col(f"last_{r}") >= F.col("end")), F.lit(False)) for r in roles
    }
    is_a = lambda r: F.col("role") == r
    complete = (
        (is_a("secret") & (has["id"] | has["endpoint"])) | (is_a("id") & has["secret"])
        | (is_a("endpoint") & has["secret"] & has["id"])
    )
    return weak.filter(complete).select("k", "kind", "start", "end")


EMPTY = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def found_in(docs: DataFrame) -> DataFrame:
    """``(_span_key, _found)``: the spans of each text with any, an array of (start, rank, kind, end), in order.

    ``rank`` is the place of the kind in ``ORDER``.
    """
    spans = written(parts(docs), "secret-parts")
    base = spans.filter(F.col("kind").isin([k for k, *_ in BASE]))
    rank = F.create_map(*[F.lit(x) for n, k in enumerate(ORDER) for x in (k, n)])
    one = F.struct("start", F.element_at(rank, F.col("kind")).alias("rank"), "kind", "end")
    found = base.union(linked(spans)).groupBy("k").agg(F.array_sort(F.collect_list(one)).alias("_found"))
    return written(found, "secret-spans").withColumnRenamed("k", "_span_key")


def scan(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` (all columns) with their spans, ``_spans``; always joined by shuffling, so the plan does not depend on sizes."""
    keyed = docs.withColumn("_span_key", row_key("doc_id", "text"))
    joined = keyed.join(found.hint("merge"), "_span_key", "left")
    return joined.withColumn("_spans", F.coalesce("_found", F.array().cast(EMPTY))).drop("_span_key", "_found")


def listed(found: F.Column) -> F.Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts, the base spans' digest and all spans for every row of ``docs (doc_id, text)``."""
    docs = docs.select("doc_id", "text")
    rows = scan(docs, found_in(docs))
    kinds = [k for k, *_ in BASE]
    of = lambda *ks: F.filter("_spans", lambda s: s["kind"].isin(list(ks)))
    return rows.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(listed(of(*kinds)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one); same columns."""
    columns = docs.columns
    name = "_secret_runs"
    looked = F.coalesce(F.col("text").rlike(FIRST_LOOK), F.lit(False))
    rows = scan(docs.filter(looked), found_in(docs))
    # merge overlapping spans in order; a fold over a document's own spans
    start = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(done, s):
        last = F.element_at(done, -1)
        fresh = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (s["start"] < last["end"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(fresh)))

    rows = rows.withColumn(name, F.when(F.size("_spans") > 0, F.aggregate("_spans", start, step)))
    text = F.col("text")
    pieces = F.transform(
        name,
        lambda s, i: F.substring(
            text,
            F.when(i == 0, F.lit(1)).otherwise(F.col(name)[i - 1]["end"] + 1).cast("int"),
            (s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.col(name)[i - 1]["end"])).cast("int"),
        ),
    )
    tail = F.substring(text, (F.element_at(name, -1)["end"] + 1).cast("int"), F.length(text))
    clean = F.when(F.col(name).isNotNull(), F.concat_ws(mark, F.concat(pieces, F.array(tail)))).otherwise(text)
    return rows.withColumn("text", clean).select(*columns).union(docs.filter(~looked))
