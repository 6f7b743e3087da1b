"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong kinds are reported wherever they stand: `assign` (a keyword with a value of 12 characters or more),
`access` (an access key id) and `hex` (16 digits or more). Weak kinds alone mean little: a login name or
client id (`weak_id`), a short value or a bare long token (`weak_secret`), a service address (`endpoint`).
They are joined by interval with the parts around them and reported only when a complementary part lies
within SCOPE code points: identifiers and endpoints need a secret, a weak secret needs either of them. A bare
token inside an address is part of it and no partner for an endpoint, its own or a neighbour's; an identifier
still links with it.

Positions come from splitting the text at a pattern and adding up the lengths of pieces and matches.
Documents without a weak candidate are settled in their row. For the others, parts are dealt to scope bins
and meet in an equi-join on (document, bin); parts of a kind do not overlap, so a bin holds a bounded number.

Defined results: null texts count as empty and have no spans; empty tables give empty results; repeated
rows are each reported alike; null ids are kept; other columns pass through. Offsets are code points, end
exclusive; keywords match ASCII letters in either case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCOPE = 200
#: Reported kinds in their order.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")

# The patterns of the strong kinds.
_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{14,}"
_HEX = r"[0-9a-f]{16,}"
# The patterns of the weak kinds.
_LOGIN = r"""(?i:(user|username|login|account|client_?id|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=@-]{3,})"""
_SHORT_ACCESS = r"(?<![A-Z0-9])AKIA[A-Z0-9]{4,13}(?![A-Z0-9])"
_BARE = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]{0,40}[0-9])[A-Za-z0-9+/]{32,}"
_ENDPOINT = r"""(?i:https?|ftp|ssh|amqp|jdbc:[a-z]+|postgres|mysql|redis|mongodb)://[^\x00-\x20"'<>]+"""

#: Inner rank of all bare tokens; those outside addresses have the rank of weak_secret too.
_ANY_BARE = len(KINDS)
#: Roles that complement each other.
_PARTNERS = (("secret", "id"), ("secret", "endpoint"), ("bare", "id"))

_BLOCK = 256
_SPAN = "array<struct<start:long,rank:int,stop:long>>"
_EMPTY = f"cast(array() as {_SPAN})"


def _positions(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """Spans of all matches, in order. keep: a condition on the matched string."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("hit")),
        lambda z: F.struct(
            F.char_length(z["gap"]).cast("long").alias("gap"),
            F.coalesce(F.char_length(z["hit"]), F.lit(-1)).cast("long").alias("size"),
            (keep(z["hit"]) if keep else F.lit(True)).alias("keep"),
        ),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(_EMPTY).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["gap"]
        span = F.struct(at.alias("start"), F.lit(rank).alias("rank"), (at + x["size"]).alias("stop"))
        good = (x["size"] >= 0) & x["keep"]
        return F.struct((at + x["size"]).alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def shift(acc: Column, block: Column) -> Column:
        moved = F.transform(
            block["out"],
            lambda s: F.struct((s["start"] + acc["at"]).alias("start"), s["rank"].alias("rank"), (s["stop"] + acc["at"]).alias("stop")),
        )
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    def spans(all_sizes: Column) -> Column:
        # Blocks keep the cost of appending near linear in the number of matches.
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_sizes) - 1) / _BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(all_sizes, b * _BLOCK + 1, _BLOCK), start, step),
        )
        return F.aggregate(blocks, start, shift)["out"]

    # Within the lambda the sizes are a variable: the text is split and matched once, not once for each block.
    once = F.transform(F.array(sizes), spans)[0]
    return F.when(text.rlike(pattern), once).otherwise(F.expr(_EMPTY))


def _strong(text: Column) -> list[Column]:
    has_sign = text.contains("=") | text.contains(":")
    assign = _positions(text, _ASSIGN, 0, lambda m: F.char_length(F.regexp_extract(m, _ASSIGN, 2)) >= 12)
    return [
        F.when(has_sign, assign).otherwise(F.expr(_EMPTY)).alias("__assign"),
        F.when(text.contains("AKIA"), _positions(text, _ACCESS, 1)).otherwise(F.expr(_EMPTY)).alias("__access"),
        _positions(text, _HEX, 2).alias("__hex"),
    ]


def _short(match: Column) -> Column:
    size = F.char_length(F.regexp_extract(match, _ASSIGN, 2))
    return (size >= 4) & (size < 12)


def _weak(text: Column) -> Column:
    return F.concat(
        _positions(text, _LOGIN, 3),
        _positions(text, _SHORT_ACCESS, 3),
        _positions(text, _ASSIGN, 4, _short),
        _positions(text, _BARE, _ANY_BARE),
        _positions(text, f"{_ENDPOINT}|{_BARE}", 4, lambda m: ~m.contains(":")),
        _positions(text, _ENDPOINT, 5),
    )


def _may_be_weak(text: Column) -> Column:
    """False only where no weak pattern matches."""
    sign = text.contains("=") | text.contains(":")
    return (sign & (text.rlike(_LOGIN) | text.rlike(_ASSIGN) | text.rlike(_ENDPOINT))) | (
        text.contains("AKIA") & text.rlike(_SHORT_ACCESS)
    ) | (text.rlike("[0-9]") & text.rlike(_BARE))


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts near a complementary part, as one array for each document key."""
    rows = parts.select("__key", F.explode("__all").alias("p")).select("__key", "p.start", "p.rank", "p.stop")
    role = F.when(F.col("rank").isin(1, 3), "id").when(F.col("rank") == 5, "endpoint").when(F.col("rank") == _ANY_BARE, "bare").otherwise("secret")
    rows = rows.withColumn("role", role)

    def bins(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope))).alias("bin")

    weak = rows.where("rank >= 3").select("*", bins(F.col("start") - scope, F.col("stop") + scope)).alias("w")
    near = rows.select("*", bins(F.col("start"), F.col("stop"))).alias("n")
    pair = (
        (F.col("w.__key") == F.col("n.__key"))
        & (F.col("w.bin") == F.col("n.bin"))
        & (F.col("n.start") <= F.col("w.stop") + scope)
        & (F.col("w.start") <= F.col("n.stop") + scope)
        & F.concat_ws(" ", "w.role", "n.role").isin(*[f"{a} {b}" for x, y in _PARTNERS for a, b in ((x, y), (y, x))])
    )
    rank = F.when(F.col("rank") == _ANY_BARE, 4).otherwise(F.col("rank")).alias("rank")
    found = weak.join(near, pair, "left_semi").select("__key", "start", rank, "stop").distinct()
    return found.groupBy("__key").agg(F.collect_list(F.struct("start", "rank", "stop")).alias("__weak"))


def _marked(id_: Column) -> Column:
    """The id with its length before it, so that no other id and text together read alike; a dash for null."""
    text = id_.cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The rows of docs with `__base` (strong spans) and `__spans` (those and linked weak ones), in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    strong = F.array_sort(F.concat("__assign", "__access", "__hex"))
    columns = docs.columns

    def with_strong(rows: DataFrame) -> DataFrame:
        return rows.select("*", *_strong(text)).select(*columns, strong.alias("__base"), *rows.columns[len(columns) :])

    plain = with_strong(docs.where(~_may_be_weak(text))).withColumn("__spans", F.col("__base"))
    open_ = docs.where(_may_be_weak(text)).withColumn("__key", F.sha2(F.concat(_marked(F.col("doc_id")), text), 256))
    parts = with_strong(open_.select(*columns, "__key")).withColumn("__all", F.concat("__base", _weak(text)))
    links = _linked(parts.select("__key", "__all").dropDuplicates(["__key"]), scope)
    joined = parts.drop("__all").join(links, "__key", "left")
    spans = F.array_sort(F.array_distinct(F.concat("__base", F.coalesce("__weak", F.expr(_EMPTY)))))
    return plain.unionByName(joined.select(*columns, "__base", spans.alias("__spans")))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: counts of the strong kinds, their digest, and all spans."""
    found = find_secrets(docs.select("doc_id", "text"), scope)

    def count(rank: int) -> Column:
        return F.size(F.filter("__base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("__spans")).alias("spans"),
    )


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """docs with every reported span replaced by `mark`; overlapping spans become one. Columns as given; a column
    n_chars follows the text."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return (
            F.when(s["stop"] <= acc["at"], acc)
            .when((s["start"] < acc["at"]), F.struct(s["stop"].alias("at"), acc["out"].alias("out")))
            .otherwise(F.struct(s["stop"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out")))
        )

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.char_length("text")))

    found = find_secrets(docs, scope)
    text = F.when(F.size("__spans") > 0, F.aggregate("__spans", start, step, finish)).otherwise(F.col("text"))
    out = found.withColumn("text", text).select(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return out
