"""Language identification by Bayesian evidence fusion.

Four sources of evidence about a row's language are multiplied: the likelihood of its text
under byte-trigram models, the declared markup language, the address suffix, and a prior of
its host. Host priors come from grouped aggregation: the first three give a soft vote per row,
votes are summed by host, by domain and over all, and each level is smoothed with the level
above it. A row's own vote is taken out of its host's sums.

The text models are fitted on a bounded sample of labelled rows (`fit`). A further model, `und`,
gives every trigram the same chance: text that no language explains better is undetermined, and
such rows are rejected, as are rows whose best language stays below `accept`.

Defined cases: a null or empty text has no text evidence and is rejected; null host, suffix or
declared language give no evidence; unknown declared languages give none either; repeated
rows have equal results; an empty table gives an empty result; other columns are passed through
by `identify`, replacing any that have the names of its results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cashwatch.llm.common import staged

CELLS = 1 << 14
SAMPLE_ROWS = 4000  # labelled rows that the text models are fitted on, at most
SAMPLE_CHARS = 2000  # of each of them
TEXT_WEIGHT = 0.2  # trigrams overlap, so they are not independent evidence
DECLARED_RIGHT = 0.9  # how often a declared language is true
SUFFIX_RIGHT = 0.8
HOST_STRENGTH = 5.0  # rows that the level above counts for
ACCEPT = 0.5
UNDETERMINED = "und"
RESULTS = ["language", "probability", "accepted"]


@dataclass
class TextModel:
    """Log chances of trigram cells, one row per language; the last row is `und`."""

    languages: list[str]
    log_chance: np.ndarray

    def scores(self, text: str | None) -> np.ndarray | None:
        """Log likelihood of a text under each language, None for a text without words."""
        cells = trigram_cells(text)
        if len(cells) == 0:
            return None
        counts = np.bincount(cells, minlength=CELLS)
        used = np.flatnonzero(counts)
        return self.log_chance[:, used] @ counts[used].astype(np.float64) * TEXT_WEIGHT


# ASCII letters and all bytes beyond ASCII stay, anything else counts as a space.
_LETTERS = bytes(c if c > 0x7F or chr(c).isalpha() else 0x20 for c in range(256))


def trigram_cells(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text; what is no letter counts as one space."""
    words = (text or "").lower().encode("utf-8").translate(_LETTERS).split()
    if not words:
        return np.zeros(0, np.int64)
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    mixed = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(18)).astype(np.int64)


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> TextModel:
    """Text models from `labelled` (`text, lang`): a sample of at most `rows` different texts,
    chosen by hash, and of each at most `chars` characters. Only texts below a hash bound are
    shuffled, about `rows` of them in a table of any size. Trigrams are counted on the
    executors; the driver gets one count per language and cell."""
    known = labelled.filter("lang IS NOT NULL")
    share = min(1.0, rows / max(1, known.count()))
    key = F.xxhash64("text", "lang")
    sample = (
        known.filter("text IS NOT NULL")
        .select("lang", F.substring("text", 1, chars).alias("text"), key.alias("_key"))
        .filter(F.col("_key") <= int(-(2**63) + share * (2**64 - 1025)))
        .dropDuplicates(["_key"])
        .orderBy("_key")
        .limit(rows)
        .select("lang", "text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine = sums.setdefault(lang, np.zeros(CELLS, np.int64))
                mine += np.bincount(trigram_cells(text), minlength=CELLS)
            for lang, mine in sums.items():
                used = np.flatnonzero(mine)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * len(used), "cell": used.astype(np.int32), "n": mine[used]}
                )

    counts = (
        sample.mapInArrow(count, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    )
    found = counts.collect()  # languages x cells at most
    languages = sorted({r["lang"] for r in found})
    table = np.full((len(languages) + 1, CELLS), 0.1)
    for r in found:
        table[languages.index(r["lang"]), r["cell"]] += r["n"]
    table[-1] = 1.0
    return TextModel([*languages, UNDETERMINED], np.log(table / table.sum(1, keepdims=True)))


def identify(rows: DataFrame, model: TextModel, accept: float = ACCEPT, keep_text: bool = True) -> DataFrame:
    """`rows` (`text, host, domain, suffix, declared` and others) plus `language`,
    `probability` and `accepted`; without `text` unless `keep_text`.

    `suffix` and `declared` name a language or nothing. Without texts, rows are written with their
    scores, so that each text is scored once; with them, texts are scored again for the result
    rather than written a second time. Only the sums per host and domain are shuffled; the priors
    are written too, so that the join back goes by their real size.
    """
    rows = rows.drop(*RESULTS)
    k = len(model.languages)
    known = [l for l in model.languages if l != UNDETERMINED]
    carried = [c for c in rows.columns if keep_text or c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(model)  # languages x cells

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.scores(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
            logs = np.array([np.zeros(k) if f is None else f for f in found]).reshape(-1, k)
            for column, right in (("declared", DECLARED_RIGHT), ("suffix", SUFFIX_RIGHT)):
                logs += _stated(batch.column(batch.schema.get_field_index(column)), right, known)
            chances = np.exp(logs - logs.max(1, keepdims=True)) if len(logs) else logs
            chances = chances / chances.sum(1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in carried),
                    pa.array([f is not None for f in found], pa.bool_()),
                    pa.array(list(logs), pa.list_(pa.float64())),
                    pa.array(list(chances), pa.list_(pa.float64())),
                ],
                names=[*carried, "_has_text", "_evidence", "_vote"],
            )

    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    scored = rows.mapInArrow(score, f"{types}, _has_text boolean, _evidence array<double>, _vote array<double>")
    return _fused(scored if keep_text else staged(scored, "scores"), known, k, accept)


def _stated(column: pa.Array, right: float, known: list[str]) -> np.ndarray:
    """Log likelihoods of stated languages under each language and `und`, a row each."""
    logs = np.full((len(known) + 1, len(known) + 1), np.log((1 - right) / max(1, len(known) - 1)))
    np.fill_diagonal(logs, np.log(right))
    logs[:, -1] = np.log(1 / max(1, len(known)))
    logs[-1] = 0.0  # nothing stated, or no known language
    said = pc.fill_null(pc.index_in(column, pa.array(known, column.type)), len(known))
    return logs[np.asarray(said)]


def _fused(scored: DataFrame, known: list[str], k: int, accept: float) -> DataFrame:
    votes = [F.sum(F.col("_vote")[i]).alias(f"_v{i}") for i in range(k)]
    hosts = staged(scored.groupBy("domain", "host").agg(*votes, F.count("*").alias("_n")), "hosts")
    sums = [F.sum(f"_v{i}").alias(f"_v{i}") for i in range(k)]
    # One row of sums over all, bounded by the number of languages.
    everything = hosts.agg(*sums).first()
    total = sum(everything[f"_v{i}"] or 0.0 for i in range(k))
    overall = [((everything[f"_v{i}"] or 0.0) + 1.0) / (total + k) for i in range(k)]

    domains = hosts.groupBy(F.col("domain").alias("_domain")).agg(*sums, F.sum("_n").alias("_n"))
    above = [(F.col(f"_v{i}") + HOST_STRENGTH * overall[i]) / (F.col("_n") + HOST_STRENGTH) for i in range(k)]
    domain_prior = domains.select("_domain", *[a.alias(f"_above{i}") for i, a in enumerate(above)])
    priors = staged(
        hosts.join(domain_prior, hosts["domain"].eqNullSafe(domain_prior["_domain"])).select(
            "_domain",
            F.col("host").alias("_host"),
            F.col("_n").alias("_rows"),
            *[f"_v{i}" for i in range(k)],
            *[f"_above{i}" for i in range(k)],
        ),
        "priors",
    )
    joined = scored.join(
        priors, scored["host"].eqNullSafe(priors["_host"]) & scored["domain"].eqNullSafe(priors["_domain"])
    )

    def fused(i: int) -> Column:
        others = F.greatest(F.col(f"_v{i}") - F.col("_vote")[i], F.lit(0.0))
        prior = (others + HOST_STRENGTH * F.col(f"_above{i}")) / (F.col("_rows") - 1 + HOST_STRENGTH)
        return F.col("_evidence")[i] + F.log(F.when(F.col("host").isNull(), overall[i]).otherwise(prior))

    logs = joined.withColumns({f"_log{i}": fused(i) for i in range(k)})
    top = F.array_max(F.array(*[f"_log{i}" for i in range(k)]))
    names = F.array(*[F.lit(l) for l in [*known, UNDETERMINED]])
    best = F.array_position(F.array(*[f"_log{i}" for i in range(k)]), F.col("_top")).cast("int")
    raised = sum((F.exp(F.col(f"_log{i}") - F.col("_top")) for i in range(1, k)), F.exp(F.col("_log0") - F.col("_top")))
    out = logs.withColumn("_top", top).withColumns(
        {"language": F.element_at(names, best), "probability": F.lit(1.0) / raised}
    )
    accepted = F.col("_has_text") & (F.col("language") != UNDETERMINED) & (F.col("probability") >= accept)
    return out.select(
        *[c for c in scored.columns if c not in ("_has_text", "_evidence", "_vote")],
        "language",
        "probability",
        accepted.alias("accepted"),
    )


# Web pages ---------------------------------------------------------------------------------


def page_evidence(pages: DataFrame) -> DataFrame:
    """`page_id, text, host, domain, suffix, declared` of `pages` (`page_id, url, html`).

    The suffix is the country ending of the host, or a language segment that starts the path."""
    html, url = F.coalesce(F.col("html"), F.lit("")), F.lower(F.coalesce(F.col("url"), F.lit("")))
    host = F.nullif(F.regexp_extract(url, r"^[a-z]+://([^/?#:]+)", 1), F.lit(""))
    ending = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    segment = F.regexp_extract(url, r"^[a-z]+://[^/?#]+/([a-z]{2})(?:[-_/?#.]|$)", 1)
    written = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    # Up to the last closing bracket every tag ends, so each character is passed once, however long a tag is.
    closed = F.length(written) - F.instr(F.reverse(written), ">") + 1
    last = F.when(F.instr(written, ">") > 0, closed).otherwise(0)
    tagless = F.regexp_replace(F.substring(written, F.lit(1), last), r"<[^>]*+>", " ")
    shown = F.regexp_replace(F.concat(tagless, F.substring(written, last + 1, F.length(written))), r"&[a-zA-Z#0-9]++;", " ")
    declared = F.lower(F.regexp_extract(written, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2})", 1))
    return pages.select(
        "page_id",
        shown.alias("text"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.coalesce(F.nullif(segment, F.lit("")), ending).alias("suffix"),
        declared.alias("declared"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as rows of evidence: `source` is the host, `lang` the declared language.
    Their other columns come as `row`."""
    return docs.select(
        F.struct(*[c for c in docs.columns if c != "text"]).alias("row"),
        "text",
        F.col("source").alias("host"),
        F.lit(None).cast("string").alias("domain"),
        F.lit(None).cast("string").alias("suffix"),
        F.col("lang").alias("declared"),
    )
