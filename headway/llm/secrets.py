"""Secret scans (operator 1): spans by pattern, and credentials whose parts stand apart, linked by interval joins.

Base spans are found per kind, leftmost and non-overlapping: assignments with a value of 12 or
more characters, access identifiers of 18 or more, hex runs of 16 or more.  Weaker parts (logins
and other identifiers, opaque mixed tokens, short assigned values, endpoints) mean nothing alone;
they are reported only if complementary parts co-occur within a scope of ``SCOPE`` code points:

* an identifier needs a secret, a weak secret needs an identifier, an endpoint needs both;
* parts of base kinds count as complements; a weak part that overlaps a span of a kind listed
  before its own is dropped.

The co-occurrence is an interval join: texts are laid out in cells of one scope, a part is
entered in all cells that it touches, a complement in those that it can reach, and a semi-join on (text, cell) tests the distance.  A
text's parts so spread over its cells, and no pair of parts is ever a row of the result.

All of it is DataFrame functions: positions come from the lengths of the matches and of what
``split`` leaves between them, in code points.

Defined results: a null text is empty and has no spans; repeated rows are scanned each,
whatever their id, a null one too; texts of any length are scanned whole; spans that start alike are
ordered by kind; an empty table gives no rows; extra columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import staged

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_VALUE = 12

# Patterns of the weak kinds.
IDENTIFIER = r"""(?i)\b(?:(?:access|client|account)_?(?:key_?)?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}"""
TEMPORARY = r"(?<![A-Za-z0-9])A(?:SI|RO|ID|GP|IP|NP|NV)A[A-Z0-9]{12,}"
OPAQUE = r"(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""\b(?:https?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|ssh|ftp)://[^\s"'<>]{4,}"""
MIN_SHORT = 6

#: Kinds in listing order; spans with the same start are sorted so.
KINDS = ("assign", "access", "hex", "identifier", "endpoint", "short", "opaque")
IDENTIFIERS, SECRETS = ("access", "identifier"), ("assign", "hex", "opaque", "short")
BASE = KINDS[:3]
#: Largest distance in code points between complementary parts.
SCOPE = 256
#: Arrays are summed up in blocks of this length, so a text with many matches costs no square of them.
BLOCK = 256

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _running(values: Column) -> Column:
    """Running sums of a short array."""
    start = F.array(F.lit(0).cast("bigint"))
    return F.slice(F.aggregate(values, start, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))), 2, F.greatest(F.size(values), F.lit(1)))


def running_sums(values: Column) -> Column:
    """Running sums of an array of longs, block by block."""
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / BLOCK).cast("int") - 1), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    sums = F.transform(blocks, _running)
    before = F.concat(F.array(F.lit(0).cast("bigint")), _running(F.transform(sums, lambda s: F.element_at(s, -1))))
    return F.flatten(F.zip_with(sums, F.slice(before, 1, F.size(sums)), lambda s, b: F.transform(s, lambda x: x + b)))


def _with_spans(df: DataFrame, kind: str, pattern: str, value_group: int = 0) -> DataFrame:
    """Add ``kind``: all matches as (start, rank, end, kind, chars of the value group)."""
    rank = KINDS.index(kind)
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,chars:int>>")
    some = F.size("hits") > 0
    return (
        df.withColumn("hits", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        .withColumn("values", F.when(some, F.regexp_extract_all("text", F.lit(pattern), F.lit(value_group))) if value_group else F.col("hits"))
        .withColumn("gaps", F.when(some, F.split("text", pattern, -1)))
        .withColumn("steps", F.zip_with("hits", F.slice("gaps", 1, F.size("hits")), lambda h, g: (F.char_length(h) + F.char_length(g)).cast("bigint")))
        .withColumn("ends", F.when(some, running_sums(F.col("steps"))))
        .withColumn("chars", F.zip_with("hits", "values", lambda h, v: F.struct(F.char_length(h).alias("hit"), F.char_length(v).alias("value"))))
        .withColumn(
            kind,
            F.coalesce(
                F.zip_with(
                    "ends",
                    "chars",
                    lambda e, c: F.struct((e - c["hit"]).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), F.lit(kind).alias("kind"), c["value"].alias("chars")),
                ),
                empty,
            ),
        )
        .drop("hits", "values", "gaps", "steps", "ends", "chars")
    )


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))


def _as_short(spans: Column) -> Column:
    """Assignments with a short value, as parts of their own kind."""
    short = F.filter(spans, lambda s: (s["chars"] >= MIN_SHORT) & (s["chars"] < MIN_VALUE))
    return F.transform(short, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index("short")).alias("rank"), s["end"].alias("end"), F.lit("short").alias("kind")))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Equal for rows with the same id and text, which have the same spans."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def parts(docs: DataFrame) -> DataFrame:
    """row_key, doc_id, and the sorted base spans and weak parts of every whole text."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", row_key())
    for kind, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("identifier", f"{IDENTIFIER}|{TEMPORARY}", 0), ("opaque", OPAQUE, 0), ("endpoint", ENDPOINT, 0)):
        df = _with_spans(df, kind, pattern, group)
    strong = F.concat(_plain(F.filter("assign", lambda s: s["chars"] >= MIN_VALUE)), _plain(F.col("access")), _plain(F.col("hex")))
    weak = F.concat(_plain(F.col("identifier")), _plain(F.col("opaque")), _as_short(F.col("assign")), _plain(F.col("endpoint")))
    return df.select("row_key", "doc_id", F.array_sort(strong.cast(SPAN)).alias("base"), F.array_sort(weak.cast(SPAN)).alias("weak"))


def _cells(first: Column, last: Column) -> Column:
    """The cells of one scope's width that an interval touches."""
    cell = lambda x: F.floor(x / SCOPE).cast("bigint")
    return F.explode(F.sequence(cell(F.greatest(first, F.lit(0))), cell(last)))


def _kind_in(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return df.where(F.col("kind").isin(*kinds))


def link_parts(found: DataFrame) -> DataFrame:
    """The weak parts that complementary parts confirm: row_key, start, rank, end, kind."""
    both = found.where(F.size("weak") > 0)
    weak = both.select("row_key", F.explode("weak").alias("s")).select("row_key", "s.*").distinct()
    base = both.select("row_key", F.explode("base").alias("s")).select("row_key", "s.*").distinct()

    def near(left: DataFrame, right: DataFrame, reach: int, how: str) -> DataFrame:
        """Rows of ``left`` with (or without) an interval of ``right`` at most ``reach`` away."""
        other = right.select("row_key", F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("rank").alias("o_rank"))
        spread = other.withColumn("cell", _cells(F.col("o_start") - reach, F.col("o_end") + reach))
        at = left.withColumn("cell", _cells(F.col("start"), F.col("end")))  # all its cells, however long it is
        close = [at["row_key"] == spread["row_key"], at["cell"] == spread["cell"], spread["o_start"] < at["end"] + reach, at["start"] < spread["o_end"] + reach]
        if how == "overlap":
            hit = at.join(spread, [*close, spread["o_rank"] < at["rank"]], "left_semi").drop("cell").distinct()
            return left.join(hit, ["row_key", "start", "rank", "end", "kind"], "left_anti")
        return at.join(spread, close, "left_semi").drop("cell").distinct()

    free = near(weak, base.unionByName(weak), 0, "overlap")
    usable = base.unionByName(free)
    identifiers, secrets = _kind_in(usable, IDENTIFIERS), _kind_in(usable, SECRETS)
    confirmed = [
        near(_kind_in(free, IDENTIFIERS), secrets, SCOPE, "semi"),
        near(_kind_in(free, SECRETS), identifiers, SCOPE, "semi"),
        near(near(_kind_in(free, ("endpoint",)), identifiers, SCOPE, "semi"), secrets, SCOPE, "semi"),
    ]
    return reduce(DataFrame.unionByName, confirmed)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, base and spans (base and confirmed weak ones, sorted)."""
    found = staged(parts(docs))
    linked = link_parts(found).groupBy("row_key").agg(F.collect_set(F.struct("start", "rank", "end", "kind")).alias("linked"))
    spans = F.array_sort(F.concat("base", F.coalesce(F.col("linked").cast(SPAN), F.array().cast(SPAN))))
    return found.join(linked, "row_key", "left").select("row_key", "doc_id", "base", spans.alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; n_chars, where present, follows the text."""
    found = scan(docs).where(F.size("spans") > 0).select("row_key", "spans").dropDuplicates(["row_key"])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        kept = F.concat(acc["out"], F.substring("text", (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, kept).otherwise(acc["out"]).alias("out"))

    cleaned = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring("text", (acc["at"] + 1).cast("int"), F.char_length("text"))))
    rows = docs.select(F.struct("*").alias("row"), F.col("text"), row_key().alias("row_key")).join(found, "row_key", "left")
    rows = rows.select("row", F.when(F.col("spans").isNull(), F.col("text")).otherwise(cleaned).alias("clean"), F.col("spans").isNotNull().alias("changed"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("changed"), F.char_length("clean").cast("bigint")).otherwise(F.col("row")["n_chars"])
    return rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
