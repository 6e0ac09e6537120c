"""Multipart credential linking: secrets, access identifiers and endpoints joined by nearness.

Strong secrets are reported wherever they stand. Weak candidates (a bare mixed-case token, a
login, an endpoint) mean nothing alone; they are reported only when a complementary part lies
within `scope` characters: a secret near an access identifier or endpoint, and the other way
round. The nearness is an interval join on buckets of a text's positions.

All of it is column expressions. Positions come from the pieces between matches: `split`
and `regexp_extract_all` cut a text at the same places, so summed lengths give offsets in
code points.

Defined cases: a null text is an empty one and has no spans; repeated rows have equal spans;
columns other than `doc_id` and `text` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cashwatch.llm.common import staged

# The kinds in order, strong ones first, with pattern, the capture group whose
# length counts, and the least length of that group.
STRONG = {
    "assign": (
        r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        1,
        6,
    ),
    "access": (r"(AKIA[A-Z0-9]{16,})", 1, 20),
    "hex": (r"([0-9a-f]{24,})", 1, 24),
}
WEAK = {
    "login": (r"((?i:user(?:name)?|login|client_id|account_id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]+)", 1, 6),
    "bare": (r"(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_-]{20,}={0,2})", 1, 20),
    "endpoint": (r"((?:https?|ftp|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+)", 1, 10),
}
KINDS = [*STRONG, *WEAK]
SECRETS = ["assign", "hex", "bare"]  # the rest identify or locate
SCOPE = 200
PORTION = 64  # matches that are placed together

_SPAN = "struct<start:int,place:int,kind:string,end:int>"


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches whose group is long enough, as an array of spans."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1))
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)),
        F.zip_with(found, value, lambda f, v: F.struct(F.char_length(f).alias("n"), v.alias("v"))),
        lambda piece, f: F.struct(F.char_length(piece).alias("gap"), f["n"].alias("n"), f["v"].alias("v")),
    )
    keep = lambda v: F.char_length(v) >= least
    if kind == "bare":  # a random token mixes cases and digits
        keep = lambda v: v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9]")
    none = F.array().cast(f"array<{_SPAN}>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("place"),
            F.lit(kind).alias("kind"),
            (start + x["n"]).alias("end"),
        )
        out = F.when(keep(x["v"]), F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct((start + x["n"]).alias("at"), out.alias("out"))

    # Arrays are copied when they grow, so matches are placed in portions, and portions put together.
    def portion(state: Column, some: Column) -> Column:
        first = F.struct(state["at"].alias("at"), none.alias("out"))
        placed = F.aggregate(some, first, step)
        joined = lambda p: F.struct(p["at"].alias("at"), F.concat(state["out"], F.array(p["out"])).alias("out"))
        return F.transform(F.array(placed), joined)[0]

    def placed_in_portions(all_steps: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(all_steps) - 1, F.lit(PORTION))
        portions = F.transform(starts, lambda i: F.slice(all_steps, i + 1, F.lit(PORTION)))
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
        return F.flatten(F.aggregate(portions, nothing, portion, lambda state: state["out"]))

    # An array of one names the matches, so that they are found once and not for each portion.
    spans = F.transform(F.array(steps), placed_in_portions)[0]
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _all(text: Column, kinds: dict[str, tuple[str, int, int]]) -> Column:
    return F.array_sort(F.concat(*[_matches(text, kind, *rule) for kind, rule in kinds.items()]))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """`doc_id, strong, spans`: the strong spans, and all spans with the linked weak ones.

    A span is `(start, place, kind, end)` in code points, arrays are in the order of start
    and kind. One row per row of `docs`; the texts are read once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = staged(
        docs.select("doc_id", text.alias("text")).select(
            "doc_id",
            F.xxhash64(F.lit(1), "text").alias("t1"),
            F.xxhash64(F.lit(2), "text").alias("t2"),
            _all(F.col("text"), STRONG).alias("strong"),
            _all(F.col("text"), WEAK).alias("weak"),
        ),
        "secrets",
    )
    doubtful = F.size("weak") > 0
    plain = found.filter(~doubtful).select("doc_id", "strong", F.col("strong").alias("spans"))
    candidates = found.filter(doubtful)
    joined = candidates.join(_linked(candidates, scope), ["t1", "t2"], "left")
    both = F.array_sort(F.concat("strong", F.coalesce("linked", F.array().cast(f"array<{_SPAN}>"))))
    return plain.unionByName(joined.select("doc_id", "strong", both.alias("spans")))


def _linked(candidates: DataFrame, scope: int) -> DataFrame:
    """`t1, t2, linked`: the weak spans of a text that have a complement in scope.

    Texts are told apart by a hash, so copies are linked once. A span meets another one in
    a bucket of `scope` characters that its interval, widened by the scope, touches.
    """
    texts = candidates.dropDuplicates(["t1", "t2"])
    parts = texts.select("t1", "t2", F.explode(F.concat("strong", "weak")).alias("span"))
    parts = parts.withColumn("is_secret", F.col("span.kind").isin(SECRETS)).withColumn(
        "is_weak", F.col("span.kind").isin(list(WEAK))
    )
    start, end = F.col("span.start"), F.col("span.end")
    buckets = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))
    weak = parts.filter("is_weak").select("t1", "t2", "span", "is_secret", buckets(start, end).alias("bucket"))
    # The bare token inside a strong span or an endpoint is no part of its own.
    other = parts.select(
        "t1",
        "t2",
        (~F.col("is_secret")).alias("is_secret"),
        start.alias("from_"),
        end.alias("to_"),
        buckets(F.greatest(start - scope, F.lit(0)), end + scope).alias("bucket"),
    )
    near = (F.col("from_") - F.col("span.end") <= scope) & (F.col("span.start") - F.col("to_") <= scope)
    apart = (F.col("from_") >= F.col("span.end")) | (F.col("to_") <= F.col("span.start"))
    same = [weak[c] == other[c] for c in ("t1", "t2", "is_secret", "bucket")]
    kept = weak.join(other, [*same, near, apart], "left_semi").select("t1", "t2", "span").distinct()
    return kept.groupBy("t1", "t2").agg(F.collect_list("span").alias("linked"))
