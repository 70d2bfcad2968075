"""Held-out accuracy, rejection, and odd rows."""

from pyspark.sql import functions as F

from weirstone.llm.language_id import Settings, identify

ROOT = "/root/testdata/sf0.01"
SMALL = Settings(sample_rows=400, sample_chars=600, epochs=3)


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(90001, None, "en"), (90002, "", "fr"), (90003, "12 34 !?", "de"), (90004, "x" * 200_000, None), (None, "the that and of", "en"), (90006, "Und die nicht", None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("language_", F.lit(1)).withColumn("score", F.lit(2))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    judged, model = identify(docs, ~held & F.col("doc_id").isNotNull(), SMALL)
    rows = judged.select("doc_id", "lang", held.alias("held"), "language.*").collect()
    assert len(rows) == docs.count() and set(model.languages) == {"de", "en", "es", "fr"}
    tested = [r for r in rows if r.held and r.doc_id < 90000]
    assert sum(r.lang == r.lang_pred for r in tested) / len(tested) > 0.97
    assert sum(r.rejected for r in tested) / len(tested) < 0.01
    by_id = {r.doc_id: r for r in rows}
    for i in (90001, 90002, 90003):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[90006].lang_pred == "de" and by_id[90004].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    judged, model = identify(docs, F.lit(True), SMALL)
    assert model is None and {r.lang_pred for r in judged.select("language.lang_pred").collect()} == {"und"}
    assert identify(docs.limit(0), F.lit(True), SMALL)[0].count() == 0


def test_unlearned_languages_and_junk_are_rejected(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text", "lang")
    foreign = [
        "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita.",
        "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił.",
        "De hond loopt over straat en het kind speelt buiten met zijn vriendjes bij de winkel op de hoek van de gracht.",
        "Мой дядя самых честных правил, когда не в шутку занемог, он уважать себя заставил и лучше выдумать не мог.",
        "qxzv wkjpt zzqrx vbnmq xcvkl pqwzj hjkqz mnbvx zxqwk jjqxv kwqzp vvxzq bqjxk qxzv wkjpt zzqrx vbnmq",
    ]
    extra = [(90000 + i, t * n, None) for n in (1, 20) for i, t in enumerate(foreign, 100 * n)]
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    lines = docs.where(held).select((F.col("doc_id") + 100_000).alias("doc_id"), F.explode(F.split("text", r"\n|(?<=\.) ")).alias("text"), "lang")
    short = lines.where(F.length("text").between(4, 80) & F.col("text").rlike(r"^\p{Lu}[\p{L} ,]+\.$"))
    both = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(short)
    judged, _ = identify(both, ~held & (F.col("doc_id") < 90000), SMALL)
    rows = judged.select("doc_id", "text", "language.rejected").collect()
    assert all(r.rejected for r in rows if 90000 <= r.doc_id < 100_000)
    clean = [r for r in rows if r.doc_id >= 100_000]
    assert len(clean) > 1000 and sum(r.rejected for r in clean) / len(clean) < 0.005
