"""Secret scans: fixed patterns, and a battery of randomness tests over long tokens. DataFrame functions only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedyard.llm.common import id_text
from feedyard.session import stable

# The patterns of the three base kinds and the least length of what must follow or match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}+"  # a run is taken whole, so this is the run of any length, then filtered
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
# Long tokens with a digit; white space, quotes and most marks end them.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}"
KINDS = ("assign", "access", "hex", "random")

# Alphabets by inferred encoding, in the order in which they are tried.
ALPHABETS = {
    "hex": ("^(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef"),
    "HEX": ("^(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF"),
    "base32": ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "upper": ("^(?=.*[A-Z])[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    "lower": ("^(?=.*[a-z])[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    "alnum": ("^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    "base64": ("^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": ("^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-"),
}
# Of the tokens thrown out as not random in a class of encoding and length, the share that may be random after all.
FALSE_DISCOVERY = 0.05
BIN = 0.05  # width of the bins of -log10 p
MAX_BINS = 400


def _matches(body: Column, pattern: str, kind: int, value_group: int = 0, with_text: bool = False) -> Column:
    """Matches of a text as ``array<struct<kind, gap, len, value_len, token>>``; ``gap`` is the text before a match, since the last one."""
    found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    gaps = F.split(body, pattern, -1)
    values = F.regexp_extract_all(body, F.lit(pattern), F.lit(value_group)) if value_group else found
    made = F.transform(F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"), values.alias("v")),
                       lambda x: F.struct(F.lit(kind).alias("kind"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"),
                                          F.length(x["v"]).alias("value_len"), (x["m"] if with_text else F.lit("")).alias("token")))
    none = F.expr("cast(array() as array<struct<kind:int,gap:int,len:int,value_len:int,token:string>>)")
    return F.when(body.rlike(pattern), made).otherwise(none)


def _tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution (Abramowitz and Stegun 7.1.26), at least 1e-12."""
    x = F.abs(z) / F.lit(2.0 ** 0.5)
    t = 1 / (1 + 0.3275911 * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.least(series * F.exp(-x * x), F.lit(1.0)), F.lit(1e-12))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _fit(at: Column, size: Column) -> Column:
    """p of the three tests together, for places ``at`` in an alphabet of ``size`` characters."""
    def tests(n: Column, mean: Column, high: Column, pairs: Column) -> Column:
        squares = F.aggregate(F.array_distinct(at), F.lit(0.0), lambda acc, v: acc + F.pow(F.size(F.filter(at, lambda x: x == v)).cast("double"), 2))
        z_chi = (squares * size / n - n - (size - 1)) / F.sqrt(2 * (size - 1) * (1 - 1 / n))
        runs = 1.0 + F.size(F.filter(pairs, lambda p: (2 * p["a"] >= size) != (2 * p["b"] >= size)))
        expected = 2 * high * (n - high) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, (runs - expected) / F.sqrt(spread)).otherwise(F.lit(7.0))
        cov = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + (p["a"] - mean) * (p["b"] - mean))
        var = F.aggregate(at, F.lit(0.0), lambda acc, v: acc + F.pow(v - mean, 2))
        z_serial = F.when(var > 0, (cov / var + 1 / n) * F.sqrt(n)).otherwise(F.lit(7.0))
        logs = [_let(z, lambda v: F.log(_tail(v))) for z in (z_chi, z_runs, z_serial)]
        return _let(-(logs[0] + logs[1] + logs[2]), lambda s: F.exp(-s) * (1 + s + s * s / 2))

    pairs = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    total = F.aggregate(at, F.lit(0.0), lambda acc, v: acc + v)
    high = F.size(F.filter(at, lambda v: 2 * v >= size)).cast("double")
    n = F.size(at).cast("double")
    return _let(F.struct(n.alias("n"), (total / n).alias("mean"), high.alias("high"), pairs.alias("pairs")),
                lambda x: tests(x["n"], x["mean"], x["high"], x["pairs"]))


def score_tokens(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Adds ``encoding`` (NULL if none fits) and ``p``: how well a token fits a uniform random string of its encoding.

    Three tests on the places of its characters in the alphabet: chi-squared uniformity, normalised by its exact mean
    and variance for this length, so it holds for short tokens too; runs above and below the middle of the
    alphabet; lag-one serial correlation. Fisher's method puts the three p-values together.
    """
    encoding = F.coalesce(*[F.when(F.col(token).rlike(pattern), F.lit(name)) for name, (pattern, _) in ALPHABETS.items()])
    alphabets = F.create_map(*[F.lit(x) for name, (_, letters) in ALPHABETS.items() for x in (name, letters)])
    characters = F.split(F.rtrim(F.col(token), F.lit("=")), "(?<=.)(?=.)")

    def fit(letters: Column) -> Column:
        return _let(F.transform(characters, lambda c: F.instr(letters, c) - 1), lambda at: _fit(at, F.length(letters).cast("double")))

    return tokens.withColumn("encoding", encoding).withColumn("p", F.when(F.col("encoding").isNotNull(), _let(alphabets[F.col("encoding")], fit)))


def _length_class() -> Column:
    return F.floor(F.log2(F.col("len").cast("double")) * 2).cast("int")


def thrown_out(scored: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """``(encoding, length_class, cut)``: tokens with ``p <= cut`` are not random, by the step-up rule of Benjamini and Hochberg.

    Each class of encoding and length is a family of its own. Ranks come from counts per bin of ``-log10 p``, at
    most MAX_BINS per class, whose upper edge stands for p, so the rate holds; the table is as small as the classes are few.
    """
    size = scored.filter("p is not null").withColumn("length_class", _length_class())
    level = F.least(F.floor(-F.log10(F.greatest(F.col("p"), F.lit(1e-300))) / BIN), F.lit(MAX_BINS)).cast("int")
    bins = size.groupBy("encoding", "length_class", level.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    family = Window.partitionBy("encoding", "length_class")
    upto = family.orderBy(F.desc("bin"))
    ranked = bins.withColumn("rank", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(family)).withColumn("edge", F.pow(F.lit(10.0), -F.col("bin") * BIN))
    return ranked.filter(F.col("edge") <= rate * F.col("rank") / F.col("all")).groupBy("encoding", "length_class").agg(F.max("edge").alias("cut"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_spans, spans)`` of every row; both are ``array<struct<start, kind_no, end, kind>>``.

    Matches of the three base kinds are leftmost and do not overlap within a kind; one that is too short is dropped
    but still takes its place. The battery adds spans of kind ``random``: long tokens with an encoding whose randomness
    is not refuted, unless a base span holds them. Offsets are code points, end exclusive. NULL and empty texts have no
    spans. Ids may be NULL or repeat; rows with equal id and text get equal spans.
    """
    rows = id_text(docs, id_col, text_col).select("id", F.xxhash64("body").alias("tag"), F.col("body").cast("string").alias("body"))
    body = F.col("body")
    found = stable(rows.select("id", "tag", F.concat(
        _matches(body, ASSIGN, 0, value_group=1), _matches(body, ACCESS, 1), _matches(body, HEX, 2), _matches(body, TOKEN, 3, with_text=True)).alias("found")))
    each = found.filter(F.size("found") > 0).dropDuplicates(["id", "tag"]).select("id", "tag", F.posexplode("found").alias("k", "x")).select("id", "tag", "k", "x.*")
    order = Window.partitionBy("id", "tag", "kind").orderBy("k")
    end = F.sum(F.col("gap") + F.col("len")).over(order)
    each = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    ok = F.when(F.col("kind") == 0, F.col("value_len") >= ASSIGN_LEAST).when(F.col("kind") == 1, F.col("len") >= ACCESS_LEAST).otherwise(True)
    each = stable(each.filter(ok).select("id", "tag", "kind", "start", "end", "len", "token"))
    scored = score_tokens(each.filter("kind = 3")).filter("p is not null").withColumn("length_class", _length_class())
    cuts = thrown_out(scored, rate)
    random = scored.join(F.broadcast(cuts), ["encoding", "length_class"], "left").filter("cut is null or p > cut").select(*each.columns)
    spans = each.filter("kind < 3").union(random)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    entry = F.struct(F.col("start"), F.col("kind").alias("kind_no"), F.col("end"), name.alias("kind"))
    per = spans.groupBy("id", "tag").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    per = per.withColumn("base_spans", F.filter("all", lambda x: x["kind_no"] < 3))
    added = F.filter("all", lambda x: (x["kind_no"] == 3) & ~F.exists("base_spans", lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
    per = per.select(F.col("id").alias("own_id"), F.col("tag").alias("own_tag"), "base_spans", F.array_sort(F.concat("base_spans", added)).alias("spans"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>)")
    out = found.select("id", "tag").join(per, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("tag") == F.col("own_tag")), "left")
    out = out.select(F.col("id").alias("doc_id"), F.coalesce("base_spans", none).alias("base_spans"), F.coalesce("spans", none).alias("spans"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, KINDS[:3]), "base_spans", "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
