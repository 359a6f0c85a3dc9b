"""Secret scan with corpus-wide ownership frequency. DataFrame functions only.

Three base kinds and one candidate kind (``opaque``: long tokens of letters and digits) are found by regular
expressions. Every candidate value is hashed and counted over the corpus by distinct repositories (texts: copies of a
document are one repository) and distinct owners (sources). A value is a copied example if different owners hold it in different
repositories, or if more than ``MAX_OWNERS`` owners hold it at all, be it in copies of one text. A value of which one owner holds all
repositories, however many, and which few others have in verbatim copies only, looks live if it has enough different characters. Base
spans always stay; opaque spans are added where they look live and do not overlap a base span.

Offsets are code points. They come from ``split``, which returns the gaps between the matches: the running sum of gaps
and matches is where a match starts. It is taken over blocks of matches, so that a very long text of nothing but matches costs little more
than its length.

Defined results: a null text is empty and has no spans; repeated rows get the same spans; null sources are one owner; of spans that start at the same
place, the kinds come in their listed order; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.skew import left_join
from premia.llm.common import documents, text_of, with_row_id, written

#: kind -> (pattern, group of the value, least length of that group). Fixed values; hex and access runs below the length
#: never match, and skipping them changes no other match, as a run is matched from its start.
KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "opaque": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}", 0, 20),
}
BASE = ("assign", "access", "hex")
#: Distinct owners that may hold a value in verbatim copies of one text before it counts as a copied example.
MAX_OWNERS = 3
#: Matches of a text that are located at a time.
BLOCK = 512
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:binary,varied:int>>"  # sorts by start, then kind as listed


def located(zipped: Column) -> Column:
    """Start, end and value of every match, from the gaps and the matches behind them. An array that grows is copied at every step, so
    it grows within a block only, and the blocks' own starts are summed before."""
    plain = "array<struct<start:int,end:int,value:string>>"
    size = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))
    last = F.floor((F.size(zipped) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(zipped, b * BLOCK + 1, F.lit(BLOCK)))
    sums = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + size(x)))
    none = F.array().cast("array<int>")
    starts = F.aggregate(
        sums, F.struct(F.lit(0).alias("at"), none.alias("all")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
    )["all"]

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        more = F.when(x["match"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span)))
        return F.struct(end.alias("at"), more.alias("spans"))

    def inside(pair):
        start = F.struct(pair["start"].alias("at"), F.array().cast(plain).alias("spans"))
        return F.aggregate(pair["block"], start, step)["spans"]

    return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), starts.alias("start")), inside))


def spans_of(text: Column, kind: str) -> Column:
    """All spans of one kind, in order. The expression is evaluated only for texts that have a match."""
    pattern, group, least = KINDS[kind]
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), values.alias("value"))
    good = F.filter(located(zipped), lambda s: F.length(s["value"]) >= least)
    out = F.transform(
        good,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(list(KINDS).index(kind)).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.unhex(F.sha2(s["value"], 256)).alias("value"),
            F.size(F.array_distinct(F.split(s["value"], ""))).alias("varied"),
        ),
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), out).otherwise(F.lit([]).cast(SPAN)).cast(SPAN)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, least_varied: int = 8, max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per document: rid, doc_id, base spans, all spans, and how many base values look live or copied."""
    rows = with_row_id(docs.select("doc_id", "text", "source"), "rid").withColumn("text", text_of())
    text = F.col("text")
    found = written(
        rows.select(
            "rid",
            "doc_id",
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("owner"),
            F.xxhash64("text").alias("repository"),
            F.array_sort(F.concat(*[spans_of(text, k) for k in BASE])).alias("base"),
            spans_of(text, "opaque").alias("more"),
        ),
        "secrets",
    )
    overlaps = lambda s: F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    found = found.withColumn("more", F.filter("more", lambda s: ~overlaps(s)))
    each = found.select("rid", "owner", "repository", F.explode(F.concat("base", "more")).alias("s"))
    value = F.col("s.value").alias("value")
    # Distinct pairs first: a widely copied value reaches its final count as one row per owner and text.
    seen = each.select(value, "owner", "repository").distinct()
    per_owner = seen.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("texts"))
    most = per_owner.groupBy("value").agg(F.max("texts").alias("texts"), F.count(F.lit(1)).alias("owners"))
    repositories = seen.select("value", "repository").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("repositories"))
    one_owner = (F.col("texts") == F.col("repositories")) & (F.col("owners") <= max_owners)
    live = most.join(repositories, "value").select("value", one_owner.alias("rare"))
    each = left_join(each.select("rid", value, "s"), live, "value")  # a value may be in very many texts
    looks_live = F.col("rare") & (F.col("s.varied") >= least_varied)
    is_base = F.col("s.rank") < len(BASE)
    added = each.groupBy("rid").agg(
        F.collect_list(F.when(~is_base & looks_live, F.col("s"))).alias("added"),  # spans of one document
        F.count_if(is_base & looks_live).alias("n_live"),
        F.count_if(is_base & ~F.col("rare")).alias("n_copied"),
    )
    out = found.join(added, "rid", "left")
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    everything = F.array_sort(F.concat("base", F.coalesce("added", F.lit([]).cast(SPAN))))
    return out.select(
        "rid", "doc_id", *[n(k).alias(f"n_{k}") for k in BASE], joined(F.col("base")).alias("base_spans"), joined(everything).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied")],
    )


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_live", "n_copied"
    )
