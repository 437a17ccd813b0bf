"""Secret scan: pattern hits, and weak credential parts that occur together (native).

``scan(docs)`` gives, for each row of ``docs``, all spans. Three kinds are always reported:
``assign`` (a named value of 8 or more characters), ``access`` and ``hex``. Three weak kinds are
reported only when complementary parts stand together: an identifier (``ident``) or an address
(``endpoint``) needs a secret nearby, a weak secret (``weak``) an identifier or an address.
Nearby: starts at most REACH code points apart within one scope, a scope being a run of text
without a blank line. The parts are linked by an interval join: each part probes its own and
both neighbouring bins of REACH code points, where the parts of a side are first reduced to their
smallest and largest start, so no pair is ever made.

Null or empty text: no spans, empty strings, the digest of the empty string. Repeated rows and
ids are each answered on their own; other columns are ignored. A very long text with many hits
stays linear: hits become rows, and running sums give their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from energy_mart.llm.common import settle

#: Fixed values. Kind to its pattern, in the order in which equal starts are listed.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+",
    "ident": r"""(?i)\b(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}""",
    "endpoint": r"""(?i)\b(?:(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+|(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]+(?::[0-9]+)?)""",
    "weak": r"""(?i)\b(?:pwd|passphrase|credentials?|auth|private_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}""",
    "break": r"\n[\x20\t]*\n",
}
KINDS = list(PATTERNS)
BASE = ("assign", "access", "hex")
LEAST = {"assign": 8, "access": 16, "hex": 32}
SIDE = {"assign": "secret", "hex": "secret", "weak": "secret", "access": "other", "ident": "other", "endpoint": "other"}
REACH = 256


def _found(text: Column) -> Column:
    """Cheap test: some part other than a blank line may be here."""
    return text.rlike("|".join(f"(?:{p.removeprefix('(?i)')})" if not p.startswith("(?i)") else f"(?i:{p[4:]})" for k, p in PATTERNS.items() if k != "break"))


def _matches(text: Column, kind: str) -> Column:
    """Array of (gap before, length, length that counts) of the leftmost matches, and a last gap."""
    pattern = PATTERNS[kind]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    counted = (lambda m: F.length(F.regexp_extract(m, pattern, 2))) if kind == "assign" else F.length
    lengths = F.transform(hits, lambda m: F.struct(F.length(m).alias("length"), counted(m).alias("counted")))
    return F.zip_with(gaps, lengths, lambda g, m: F.struct(g.alias("gap"), m.length.alias("length"), m.counted.alias("counted")))


def matches(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kinds): every kind's matches, null for texts without any part; one pass."""
    text = F.coalesce("text", F.lit(""))
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), _matches(text, k).alias("hits")) for i, k in enumerate(KINDS)])
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.when(_found(text), kinds).alias("kinds"))


def parts(matched: DataFrame) -> DataFrame:
    """(row, kind, start, end) of every part and blank line."""
    hits = (
        matched.select("row", F.explode("kinds").alias("k"))
        .filter(F.size("k.hits") > 1)
        .select("row", "k.kind", F.posexplode("k.hits").alias("at", "hit"))
        .select("row", "kind", "at", "hit.*")
        .filter(F.col("length").isNotNull())
    )
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    least = F.create_map(*[F.lit(x) for k, n in LEAST.items() for x in (KINDS.index(k), n)])
    return (
        hits.withColumn("end", end)
        .filter(F.col("counted") >= F.coalesce(least[F.col("kind")], F.lit(1)))
        .select("row", "kind", (F.col("end") - F.col("length")).alias("start"), "end")
    )


def linked(found: DataFrame) -> DataFrame:
    """The weak parts (row, kind, start, end) that a complementary part stands near to."""
    in_order = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    scope = F.sum((F.col("kind") == KINDS.index("break")).cast("int")).over(in_order)
    side = F.create_map(*[F.lit(x) for k, s in SIDE.items() for x in (KINDS.index(k), s)])
    placed = (
        found.withColumn("scope", scope)
        .filter(F.col("kind") != KINDS.index("break"))
        .withColumn("side", side[F.col("kind")])
        .withColumn("bin", F.floor(F.col("start") / REACH))
    )
    ranges = placed.groupBy("row", "scope", "bin", F.col("side").alias("wanted")).agg(
        F.min("start").alias("lowest"), F.max("start").alias("highest")
    )
    probes = (
        placed.filter(~F.col("kind").isin([KINDS.index(k) for k in BASE]))
        .withColumn("wanted", F.when(F.col("side") == "secret", "other").otherwise("secret"))
        .withColumn("own", F.col("bin"))
        .withColumn("bin", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)))
    )
    near = (
        (F.col("bin") == F.col("own"))
        | ((F.col("bin") < F.col("own")) & (F.col("highest") >= F.col("start") - REACH))
        | ((F.col("bin") > F.col("own")) & (F.col("lowest") <= F.col("start") + REACH))
    )
    return (
        probes.join(ranges, ["row", "scope", "bin", "wanted"])
        .filter(near)
        .select("row", "kind", "start", "end")
        .distinct()
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans array<struct<start, kind, end>> sorted by start, then kind, for every row."""
    rows = settle(matches(docs))
    found = parts(rows)
    base = [KINDS.index(k) for k in BASE]
    spans = found.filter(F.col("kind").isin(base)).unionByName(linked(found))
    grouped = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return rows.select("row", "doc_id").join(grouped, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast(grouped.schema["spans"].dataType)).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans as text."""
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s.kind], s.start, s.end)), ",")
    of = lambda kind: F.filter("spans", lambda s: s.kind == KINDS.index(kind))
    base = F.filter("spans", lambda s: s.kind < len(BASE))
    return scanned.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
