"""The operators over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketrank.llm import chat, embeddings, language, licenses, manifest, packing, pages, periods, pieces, pii, quality, recipes, simhash
from docketrank.llm.common import ASCII_SPACE, let, prepare, read_table, split_words


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(prepare(spark), folder, "documents")
    judged = quality.judge(docs.select("doc_id", "text", "lang", "source"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
    )


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(prepare(spark), folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~held_out(F.col("doc_id"))))
    named = language.identify(docs.select("doc_id", "text"), model)
    return named.select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(held_out(F.col("row.doc_id")), F.lit(False)).alias("held_out"),
        F.col("found.lang_pred").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.size("found.spans").cast("long").alias("n_spans"),
    )


def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(prepare(spark), folder, "documents"))
    return found.select("doc_id", simhash.hex_text(F.col("fp")).alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(prepare(spark), folder, "documents")
    spans = docs.select("doc_id", pii.personal_data(F.col("text")).alias("spans"))

    def listed(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS[:4]))
    return spans.select(
        "doc_id",
        *(counted(kind) for kind in pii.KINDS[:4]),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        *(counted(kind) for kind in pii.KINDS[4:]),
        F.array_join(F.transform("spans", lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"),
    )


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encode(read_table(prepare(spark), folder, "documents"), pieces.public_model())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = embeddings.near_duplicates(read_table(prepare(spark), folder, "embeddings"))
    return found


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read_table(prepare(spark), folder, "documents"))


# A conversation that says control strings, added to the table.
CONTROL_ROWS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(prepare(spark), folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_ROWS, "conv_id long, turn long, role string, text string")
    read = chat.examples(rows.unionByName(control)).select(
        "conv_id",
        "example",
        F.length("formatted").alias("chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
    )
    whole = read.groupBy("conv_id").agg(
        F.max_by("turns", "example").alias("turns"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(prepare(spark), folder, "pages").select("page_id", "url", "html")
    model = pages.fit(table)
    texts = table.select("page_id", "url", pages.main_text(F.col("html"), model).alias("text"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(prepare(spark), folder, "documents"), packing.public_vocabulary())


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.exact_duplicates(read_table(prepare(spark), folder, "documents"))


MANIFEST_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _lower_some(docs: DataFrame) -> dict[str, Column]:
    """Texts of about a fifth of all documents with A-Z in lower case, all others as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return {"text": F.when(chosen, F.translate(F.col("text"), upper, upper.lower())).otherwise(F.col("text"))}


def manifest_rows(docs: DataFrame) -> DataFrame:
    made = manifest.manifest(docs, MANIFEST_COLUMNS, tampered=_lower_some)
    steps = F.transform("proof", lambda step: F.concat(step["left"], step["right"]))
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_rows(read_table(prepare(spark), folder, "documents"))


def _partly_periodic(doc_id: Column, text: Column) -> Column:
    """The words of a text, joined by blanks; in a tenth of all texts words from some place on repeat."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        begin = F.pmod(g, n)
        period = F.lit(1).cast("long") + F.floor((n - begin) / (F.pmod(g, F.lit(8)) + 3)).cast("long")
        return F.transform(
            words, lambda word, i: F.when(i < begin, word).otherwise(F.get(words, (begin + F.pmod(i - begin, period)).cast("int")))
        )

    changed = let(split_words(text, ASCII_SPACE), lambda words: F.when(F.size(words) > 0, repeated(words)).otherwise(words))
    return F.when(h % 10 == 0, F.array_join(changed, " ")).otherwise(text)


def run_rows(docs: DataFrame) -> DataFrame:
    found = periods.periodic_runs(docs.select("doc_id", _partly_periodic(F.col("doc_id"), F.col("text")).alias("text")))

    def better(best: Column, run: Column) -> Column:
        """Whether a run has the greater exponent; runs come by start and period, so of ties the first stays."""
        return best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])

    top = F.aggregate(
        "runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda best, run: F.when(better(best, run), run).otherwise(best)
    )
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    return found.select("doc_id", "runs", "collapsed", top.alias("top"), F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("listed")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.col("listed")).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_rows(read_table(prepare(spark), folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_embedding_dedup,
        op3_quality_rules,
        op4_language_id,
        op5_simhash_dedup,
        op6_pii,
        op7_license_scan,
        op8_chat_format,
        op9_main_text,
        op10_packing,
        op11_exact_dedup,
        op12_merkle_manifest,
        op13_periodic_runs,
    )
}
