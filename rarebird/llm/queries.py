"""The registered queries of the operators: each reads its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rarebird.llm import classifier, decontaminate, html_crf, mixing, near_dup, pii, rules, runs, secret_scan, sql, suffix_dedup, suffix_tree_lm, url_filter, whitening
from rarebird.llm.common import Scratch, let, table, text_of, word_list


def op1_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    held_out = F.coalesce(classifier.bucket("doc_id", 7) == 2, F.lit(False))
    model = suffix_tree_lm.fit(docs.where(~held_out), scratch)
    scored = suffix_tree_lm.score(docs, model, scratch)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), F.array("source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_cascade(table(spark, sf_dir, "documents"))
    failed = (F.col("m.n_words") < 50) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))
    return judged.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("failed_rule").isNull()).alias("kept"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(classifier.bucket("doc_id", 5) == 0, F.lit(False))
    model = classifier.fit(docs, table(spark, sf_dir, "labels"), held_out=held_out)
    scored = classifier.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_pii(docs, count_into="n_entities").select("doc_id", "n_entities", "text")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def looped_words(words: Column, g: Column) -> Column:
    """The words with everything from word a = g % n on repeating its first 1 + floor((n - a) / (3 + g % 8))."""
    n = F.size(words)
    first = F.pmod(g, n)
    period = 1 + F.floor((n - first) / (3 + F.pmod(g, F.lit(8))))
    at = lambda a, p: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
    looped = let(F.struct(first.alias("a"), period.alias("p")), lambda x: at(x["a"], x["p"]))
    return F.when(n > 0, looped).otherwise(words)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string"))
    text = F.when(h % 10 == 0, let(word_list(text_of()), lambda w: F.array_join(looped_words(w, F.floor(h / 10)), " "))).otherwise(text_of())
    found = runs.find_runs(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), keep=["doc_id"])
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select("doc_id", "n_words", "runs", "collapsed", longest.alias("m")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("m.s").alias("start"), (-F.col("m.l")).alias("length"),
        F.col("m.p").alias("period"), F.expr("(-1000 * m.l) div m.p").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dup, op2_lm_scoring, op3_mixing, op4_html_extraction, op5_suffix_dedup, op6_quality_rules,
    op7_quality_classifier, op8_decontamination, op9_url_filters, op10_pii, op11_embedding_whitening, op12_periodic_runs,
    op13_secret_scan)}
ORACLES: dict[str, str] = {"op3_mixing": sql.OP3, "op6_quality_rules": sql.OP6, "op9_url_filters": sql.OP9,
                           "op12_periodic_runs": sql.OP12}
