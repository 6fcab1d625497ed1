"""Secrets in texts: fixed patterns, and Markov models of random strings and of ordinary identifiers.

Everything is a DataFrame expression. Matches come from splitting a text at a pattern: the pieces
between the matches and the matches themselves give every place by running sums of lengths.

The method's own spans are runs of token characters outside all fixed matches. Two character
models (first-order Markov), one of random strings and one of ordinary identifiers, are counted
from labelled samples; a run is reported where the logarithm of its likelihood ratio is at least
THRESHOLD.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.tables import row_key, text_of

# The patterns of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12
KINDS = ("assign", "access", "hex", "random")

#: Characters of the models; any other counts as one more.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
SYMBOLS = len(ALPHABET) + 1
#: What the method looks at: runs of token characters of this length at least.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Least log-likelihood ratio of a reported run, in nats.
THRESHOLD = 15.0
#: Added to the count of each pair of characters.
PSEUDO_COUNT = 0.5
#: Documents whose words and secrets are labelled samples, at most about this many.
SAMPLE_DOCUMENTS = 1000
#: Random strings of each alphabet among the labelled samples.
RANDOM_STRINGS = 2000
#: Characters of a run that are looked at together.
PART = 8192
#: Matches whose places are summed one by one; blocks of them are summed first.
BLOCK = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def running_starts(steps: Column) -> Column:
    """The sums of the first 1, 2, ... steps of an array, in two levels of blocks."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def indices(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def with_sums(held: Column) -> Column:
        sums = F.transform(indices(F.ceil(F.size(held) / BLOCK).cast("int")), lambda b: total(F.slice(held, b * BLOCK + 1, BLOCK)))
        return _let(sums, lambda each: _let(
            F.transform(indices(F.size(each)), lambda b: total(F.slice(each, F.lit(1), b))),
            lambda before: F.transform(indices(F.size(held)), lambda i: F.get(before, (i / BLOCK).cast("int")) + total(F.slice(held, i - i % BLOCK + 1, i % BLOCK + 1))),
        ))

    return _let(steps, with_sums)


def matches(text: Column, pattern: str, possible: Column | None = None) -> Column:
    """All matches of a pattern, leftmost first and not overlapping: an array of (start, end, found) in characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))

    def placed(held: Column) -> Column:
        lengths = F.transform(held, lambda m: F.length(m))
        gaps = F.zip_with(F.slice(steps, F.lit(1), F.size(held)), F.concat(F.array(F.lit(0)), F.slice(lengths, F.lit(1), F.greatest(F.size(held) - 1, F.lit(0)))), lambda gap, before: gap + before)
        return F.zip_with(running_starts(gaps), held, lambda start, m: F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("found")))

    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    some = _let(found, lambda held: F.when(F.size(held) > 0, placed(held)).otherwise(empty))
    return F.when(possible, some).otherwise(empty) if possible is not None else some


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans (start, kind, end) of the fixed patterns, for each kind."""
    assigned = matches(text, ASSIGN, F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")))
    long_enough = F.filter(assigned, lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= ASSIGN_VALUE)
    return {
        "assign": _spans(long_enough, 0),
        "access": _spans(matches(text, ACCESS, F.contains(text, F.lit("AKIA"))), 1),
        "hex": _spans(matches(text, HEX), 2),
    }


def symbol(character: Column) -> Column:
    """The place of a character in the alphabet from 1; 0 for any other."""
    return F.instr(F.lit(ALPHABET), character)


def _pairs(text: Column) -> Column:
    """The numbers of a string's pairs of neighbours, in order. The string is cut once, so it takes linear time."""

    def neighbours(codes: Column) -> Column:
        rest = F.greatest(F.size(codes) - 1, F.lit(0))
        return F.zip_with(F.slice(codes, F.lit(1), rest), F.slice(codes, F.lit(2), rest), lambda a, b: a * SYMBOLS + b)

    return _let(F.transform(F.split(text, ""), symbol), neighbours)


def train(samples: DataFrame) -> list[float]:
    """Log ratio, random to ordinary, of each pair of characters, from samples (text, random).

    The model is a table of SYMBOLS * SYMBOLS numbers whatever the samples are. Null texts and
    texts of one character add nothing.
    """
    pairs = samples.where("text is not null and random is not null").select("random", F.explode(_pairs(F.col("text"))).alias("pair"))
    counted = pairs.groupBy("pair").agg(F.count_if(F.col("random")).alias("random"), F.count_if(~F.col("random")).alias("ordinary"))
    counts = {row["pair"]: (row["random"], row["ordinary"]) for row in counted.collect()}  # a row for each pair of characters
    ratios = []
    for first in range(SYMBOLS):
        row = [counts.get(first * SYMBOLS + second, (0, 0)) for second in range(SYMBOLS)]
        of_random, of_ordinary = (sum(c[k] for c in row) + PSEUDO_COUNT * SYMBOLS for k in (0, 1))
        ratios += [math.log((r + PSEUDO_COUNT) / of_random) - math.log((o + PSEUDO_COUNT) / of_ordinary) for r, o in row]
    return ratios


def likelihood_ratio(text: Column, model: list[float]) -> Column:
    """The sum of the model's log ratios over the pairs of characters of a string, a part at a time."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    parts = F.ceil((F.length(text) - 1) / PART).cast("int")
    starts = F.when(parts > 0, F.sequence(F.lit(0), parts - 1)).otherwise(F.array().cast("array<int>"))

    def of_part(n: Column) -> Column:
        pairs = _pairs(F.substr(text, n * PART + 1, F.lit(PART + 1)))  # parts share a character
        return F.aggregate(pairs, F.lit(0.0), lambda total, pair: total + F.get(table, pair))

    return F.aggregate(F.transform(starts, of_part), F.lit(0.0), lambda total, part: total + part)


def labelled_samples(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, strings: int = RANDOM_STRINGS) -> DataFrame:
    """Labelled strings (text, random) for the models.

    Ordinary: the words of a bounded sample of documents, picked by a hash of doc_id, with their
    fixed matches cut out, each also as a constant (WORD_WORD) and in camel case (wordWord). Random: the values that the fixed patterns find in the same documents,
    and random strings in base 64, base 32 and base 16.
    """
    rows = max(docs.count(), 1)
    part = math.ceil(1_000_000 * min(1.0, documents / rows))
    place = F.conv(F.substring(F.md5(docs["doc_id"].cast("string")), 1, 8), 16, 10).cast("long") % 1_000_000
    chosen = docs.where(place < part).select(text_of(docs).alias("text"))
    cut = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    found = chosen.select(F.explode(F.regexp_extract_all(cut, F.lit(r"[A-Za-z_][A-Za-z0-9_-]{3,}"), F.lit(0))).alias("word"))
    forms = F.array("word", F.concat_ws("_", F.upper("word"), F.upper("word")), F.concat(F.lower("word"), F.initcap("word")))
    words = found.select(F.explode(forms).alias("text"))
    joined = F.concat(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    values = chosen.select(F.explode(joined).alias("text")).where(F.length("text") >= ASSIGN_VALUE)
    digest = F.sha2(F.col("id").cast("string"), 256)

    def base_32_sign(k: int) -> Column:
        value = F.conv(F.substr(digest, F.lit(2 * k + 1), F.lit(2)), 16, 10).cast("int")
        return F.substr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), value % 32 + 1, F.lit(1))

    base_32 = F.concat(*[base_32_sign(k) for k in range(32)])
    made = docs.sparkSession.range(strings).select(F.explode(F.array(F.base64(F.unhex(digest)), base_32, F.substring(digest, 1, 40))).alias("text"))
    random = values.unionByName(made).withColumn("random", F.lit(True))
    return words.withColumn("random", F.lit(False)).unionByName(random)


def scan(docs: DataFrame, model: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """For each row: doc_id, text_key, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Null texts count as empty and have no spans. Rows of equal doc_id are rows of their own. Other
    columns are not read. Spans are kind:start:end in characters, the end left out, by start, then
    kind; base_sha256 is of the fixed kinds alone.
    """
    texts = docs.select(*row_key(docs), text_of(docs).alias("text"))
    kinds = base_spans(F.col("text"))
    runs = matches(F.col("text"), CANDIDATE)
    likely = F.filter(runs, lambda m: likelihood_ratio(m["found"], model) >= threshold)
    found = texts.select("doc_id", "text_key", *[spans.alias(kind) for kind, spans in kinds.items()], likely.alias("likely"))
    base = F.array_sort(F.concat("assign", "access", "hex"))
    based = found.select("*", base.alias("base"))
    apart = F.filter("likely", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    told = based.select("*", _spans(apart, 3).alias("random"))

    def listed(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return told.select(
        "doc_id",
        "text_key",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "random"))).alias("spans"),
    )


def scan_documents(docs: DataFrame) -> DataFrame:
    """scan with models trained on labelled samples from docs."""
    return scan(docs, train(labelled_samples(docs)))
