"""Quality rules as a short-circuit cascade.

Every rule is a boolean Column that says "reject". On a bounded sample the share of texts that a
rule rejects (selectivity) and the seconds it takes (cost) are measured; the rules are then ordered
by rejection per second and evaluated as one ``CASE WHEN``, which stops at the first rule that
rejects. A text is kept when no rule rejects it, so the order changes the cost and never the result.

Only DataFrame functions are used: one narrow stage, no shuffle, no Python on executors.

Edge cases: a null text counts as empty; an empty text has no words and fails the length rule;
repeated rows are judged alike; an empty table gives an empty result with the same columns; extra
columns are ignored by ``text_metrics`` and carried by ``cascade``. Metric columns of ``cascade``
live in one struct named by the caller, so that they cannot clash with the table's own columns.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarebird.llm.common import SPACE, SPACE_CHARS, let, text_of

SYMBOLS = "[#*$%&|<>]+"
#: rows of the sample on which cost and selectivity are measured
SAMPLE_ROWS = 1000


def repeated_words(words: Column, grams: Column, size: int = 3) -> Column:
    """Words inside windows of ``size`` words that occur at least twice in the list ``words``.

    ``grams`` is ``packed_grams`` of the list: sorted longs whose high 33 bits come from a window's
    hash and whose low 31 bits are its position. Windows with a neighbour of the same high bits are
    suspects (a repeat is always one); only those are compared by their words, so the count is exact.
    """
    bits = lambda x: F.shiftright(x, 31)
    with_next = F.filter(grams, lambda x, i: F.shiftright(x.bitwiseXOR(F.get(grams, i + 1)), 31) == 0)
    suspects = F.filter(grams, lambda x, i: (bits(x) == bits(F.get(grams, i + 1))) | (bits(x) == bits(F.get(grams, i - 1))))
    at = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    window = lambda x: let(at(x), lambda p: F.struct(F.slice(words, p + 1, size).alias("w"), p.alias("p")))

    def covered(xs: Column) -> Column:
        same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
        hits = F.filter(xs, lambda x, i: same(x, F.get(xs, i - 1)) | same(x, F.get(xs, i + 1)))
        zero = F.struct(F.lit(-size).cast("int").alias("last"), F.lit(0).cast("long").alias("sum"))
        step = lambda acc, s: F.struct(
            s.alias("last"), (acc["sum"] + F.least(F.lit(size), s - acc["last"])).cast("long").alias("sum"))
        return F.aggregate(F.sort_array(F.transform(hits, lambda x: x["p"])), zero, step, lambda acc: acc["sum"])

    exact = let(F.sort_array(F.transform(suspects, window)), covered)
    return F.when(F.size(F.coalesce(with_next, F.array())) > 0, exact).otherwise(F.lit(0).cast("long"))


def packed_grams(words: Column, size: int = 3) -> Column:
    """Sorted (hash, position) of every window of ``size`` words; null where there are fewer than two windows."""
    pack = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]).bitwiseAND(
        F.lit(-(1 << 31))).bitwiseOR(i.cast("long"))
    return F.when(F.size(words) > size, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - size), pack)))


def text_metrics(docs: DataFrame, text: str = "text", into: str = "m", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all of them by default), a struct ``into`` of the metrics of the whole text,
    and the text itself as ``<into>_text``.

    The steps are columns of successive projections, each referenced more than once, so that Spark
    evaluates each of them once per row (inside compiled code where it can).
    """
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    body, words, grams, lines = (F.col(f"__{into}_{k}") for k in ("text", "words", "grams", "lines"))
    space = F.lit(SPACE_CHARS)
    trimmed = F.btrim(body, space)
    out = docs.select(*kept, text_of(text).alias(f"__{into}_text"))
    out = out.select(*kept, body, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE)).alias(f"__{into}_words"), F.filter(
            F.split(body, "\n"), lambda x: F.btrim(x, space) != "").alias(f"__{into}_lines"))
    out = out.select(*kept, body, words, lines, packed_grams(words).alias(f"__{into}_grams"))
    return out.select(*kept, F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words, grams).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
    ).alias(into), body.alias(f"{into}_text"))


def default_rules(m: str = "m") -> dict[str, Column]:
    """Rejecting rules over the metrics struct ``m`` and the text column ``m_text``."""
    c = lambda k: F.col(f"{m}.{k}")
    body = F.col(f"{m}_text")
    letters = lambda s: F.length(F.regexp_replace(s, "[^\\p{L}]+", ""))
    return {
        "too_short": c("n_words") < 50,
        "too_long": c("n_words") > 10_000_000,
        "repeats": 100 * c("n_repeat_words") > 50 * c("n_words"),
        "word_length": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 20 * c("n_words")),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "duplicate_lines": 10 * c("n_dup_lines") > 3 * c("n_lines"),
        "shouting": 2 * c("n_shouts") > c("n_words"),
        "few_letters": 2 * letters(body) < c("word_chars"),
    }


def measure(sample: DataFrame, rules: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """(share rejected, seconds) of each rule over the rows of ``sample``."""

    def run(rule: Column | None) -> tuple[float, float]:
        what = F.avg(F.when(rule, 1.0).otherwise(0.0)) if rule is not None else F.count(F.lit(1)) * 1.0
        began = time.perf_counter()
        got = sample.agg(what.alias("x")).first()["x"]
        return float(got or 0.0), time.perf_counter() - began

    run(None)
    base = run(None)[1]
    out = {}
    for name, rule in rules.items():
        run(rule)  # compiles
        share, took = run(rule)
        out[name] = (share, max(took - base, 1e-4))
    return out


def order_rules(measured: Mapping[str, tuple[float, float]]) -> list[str]:
    """Names by rejection per second, highest first; ties by cost, then by name."""
    return sorted(measured, key=lambda k: (-measured[k][0] / measured[k][1], measured[k][1], k))


def cascade(frame: DataFrame, rules: Mapping[str, Column], order: list[str], into: str = "failed_rule") -> DataFrame:
    """Adds the first rule in ``order`` that rejects a row (null: kept)."""
    chain = None
    for name in order:
        chain = F.when(rules[name], F.lit(name)) if chain is None else chain.when(rules[name], F.lit(name))
    return frame.withColumn(into, F.lit(None).cast("string") if chain is None else chain)


def quality_cascade(docs: DataFrame, text: str = "text", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS,
                    seed: int = 7) -> DataFrame:
    """doc_id, metrics struct ``m`` and ``failed_rule`` (null: kept) of every document.

    The sample (about ``sample_rows`` rows, never more) only decides the order of the rules.
    """
    rows = docs.count()
    rules = default_rules()
    share = min(1.0, 4 * sample_rows / max(rows, 1))
    sample = text_metrics(docs.sample(share, seed=seed).limit(sample_rows), text, keep=[id_col]).persist()
    try:
        order = order_rules(measure(sample, rules))
    finally:
        sample.unpersist()
    return cascade(text_metrics(docs, text, keep=[id_col]), rules, order).drop("m_text")
