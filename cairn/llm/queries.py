"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import (
    decontaminate,
    html_text,
    imatch,
    interpolation,
    mixing,
    ngram_join,
    periodic_runs,
    pu_quality,
    quality_rules,
    spelling,
    training_order,
    url_filter,
    warc,
)
from cairn.llm.oracles import ORACLES  # noqa: F401
from cairn.llm.scratch import stored
from cairn.llm.text import words

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a mix of 150 % of all words takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt without those held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    held_out = F.coalesce(pu_quality.remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    trusted = labels.where((F.col("quality") == 1) & ~held_out).select("doc_id")
    model = pu_quality.learn(docs.where(~held_out), trusted)
    scored, name = pu_quality.score(docs, model)
    score = F.col(name)
    return scored.select(
        "doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences in training order; a row per slot."""
    docs = table(spark, sf_dir, "documents")
    return training_order.materialise(docs, training_order.shard_folder(docs)).drop("file")


# Remainders of the id's CRC-32 by 7: held out for good, and deleted for learning the weights.
HELD_OUT, DELETED = 2, 3


def op4_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learnt without those held out."""
    remainder = pu_quality.remainder(F.col("doc_id"), 7)
    docs = table(spark, sf_dir, "documents")
    scored, _ = interpolation.score(docs, "doc_id", "text", remainder == HELD_OUT, remainder == DELETED)
    return scored


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found, name = html_text.extract(pages, keep=["page_id", "url"])
    return found.select("page_id", "url", F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality_rules.judge(docs, lang="lang")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    pages = table(spark, sf_dir, "pages")
    folder = warc.archive_folder(pages)
    index = warc.write_archives(pages, folder)
    read = warc.read_records(index, folder, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicate documents of every document."""
    return ngram_join.component_ids(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = decontaminate.annotate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


# The rules of the production list, with the longest fitting one deciding.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged, _ = url_filter.classify(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def with_periods(doc_id: Column, text: Column) -> Column:
    """The words of a text, joined by spaces; those of every tenth id made periodic from some place on."""
    found, h = words(text), F.crc32(doc_id.cast("string"))
    n, g = F.size(found), F.floor(h / 10)
    at = (g % F.greatest(n, F.lit(1))).cast("int")
    period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(found, at + 1, period), F.ceil((n - at) / period).cast("int")))
    periodic = F.concat(F.slice(found, F.lit(1), at), F.slice(repeated, F.lit(1), n - at))
    return F.array_join(F.when((h % 10 == 0) & (n > 0), periodic).otherwise(found), " ")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of them made periodic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", with_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found, runs, collapsed = periodic_runs.collapse_runs(docs)

    def strongest_first(a: Column, b: Column) -> Column:
        """By length over period, then start, then period."""
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        order = F.struct(y.alias("r"), a["start"].alias("s"), a["period"].alias("p"))
        other = F.struct(x.alias("r"), b["start"].alias("s"), b["period"].alias("p"))
        return F.when(order < other, -1).when(order > other, 1).otherwise(0)

    best = F.get(F.array_sort(runs, strongest_first), F.lit(0))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    chosen = found.select("doc_id", runs, collapsed, best.alias("best"))
    return chosen.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(collapsed, 256).alias("collapsed_sha256"),
    )


# The share of a text's end that is replaced by the beginning of the next one.
EDITED = 4
NO_ID = -(2**63)


def with_edited(docs: DataFrame) -> DataFrame:
    """``key, doc_id, text, n, next, edited`` of every row of ``doc_id, text``.

    A NULL id is smaller than all others. Of rows that share an id, the one with
    the smallest beginning gives it to the document before. Texts are dealt by
    id once, for giving and for taking.
    """
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    taken = F.floor(F.length("text") / EDITED).cast("int")
    sizes = texts.groupBy("key").agg(F.max(taken).alias("most"))
    ring = imatch.successors(sizes.select("key"))
    ring = stored(ring.join(sizes, F.col("id") == F.col("key")).select("id", "next", "most"), "ring-needs")
    before = ring.select(F.col("id").alias("before"), F.col("next").alias("own"), "most")
    given = texts.join(before, F.col("key") == F.col("own")).select("before", F.expr("substring(text, 1, most)").alias("piece"))
    given = given.groupBy("before").agg(F.min("piece").alias("piece"))
    joined = texts.join(ring.select("id", "next"), F.col("key") == F.col("id")).join(given, F.col("key") == F.col("before"))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - taken), F.substring("piece", F.lit(1), taken))
    doc_id = F.nullif(F.col("key"), F.lit(NO_ID)).alias("doc_id")
    return joined.select("key", doc_id, "text", n.alias("n"), "next", edited.alias("edited"))


def op12_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they and the next one's are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = imatch.lexicon(docs)
    hashes = F.md5(F.col("text").cast("binary")).alias("body"), F.sha2("edited", 256).alias("edited_sha256")
    texts = [F.struct(F.lit(i == 1).alias("changed"), F.col(c).alias("text")) for i, c in enumerate(("text", "edited"))]
    both = with_edited(docs).select("key", "doc_id", "next", "n", *hashes, F.array(*texts).alias("texts"))
    both = both.select(*both.columns[:-1], F.inline_outer("texts"))
    keys = ["key", "doc_id", "next", "n", "body", "edited_sha256", "changed"]
    prints = imatch.fingerprints(both, known, keys).groupBy(*keys[:-1])
    found = stored(
        prints.agg(
            F.max("copies").alias("copies"),
            F.max(F.when(~F.col("changed"), F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("changed"), F.col("fingerprint"))).alias("edited_fingerprint"),
        ),
        "imatch-prints",
    )
    following = found.groupBy(F.col("key").alias("after")).agg(F.min(F.struct("body", "fingerprint"))["fingerprint"].alias("next_print"))
    joined = found.join(following, F.col("next") == F.col("after"))
    return joined.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        imatch.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        imatch.likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


# One run in that many, by the hash of id and run, loses a letter.
MISSPELT = 199


def with_misspellings(doc_id: Column, word: Column) -> Column:
    """A word of a document, some without one of their letters."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = (h % F.length(word)).cast("int")
    without = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % MISSPELT == 0, without).otherwise(word)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their near words, forms and roots."""
    runs = table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(spelling.letter_runs(F.col("text"))).alias("run"))
    return spelling.variants(spelling.vocabulary(runs.select(with_misspellings(F.col("doc_id"), F.col("run")).alias("word"))))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pu_quality": op2_pu_quality,
    "op3_training_order": op3_training_order,
    "op4_interpolation": op4_interpolation,
    "op5_html_text": op5_html_text,
    "op6_quality_rules": op6_quality_rules,
    "op7_warc": op7_warc,
    "op8_ngram_join": op8_ngram_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_url_filter": op10_url_filter,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_imatch": op12_imatch,
    "op13_spelling_variants": op13_spelling_variants,
}
