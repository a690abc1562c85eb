"""The documented bounds of samples hold for null and repeated ids too."""

from pyspark.sql import functions as F

from fieldnorm.llm import language, main_text


def counted_collects(monkeypatch, module):
    seen = []
    real = module.train

    def train(labelled):
        seen.append(len(labelled))
        return real(labelled[:5])

    monkeypatch.setattr(module, "train", train)
    return seen


def test_pages_without_ids(spark, monkeypatch):
    pages = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).cast("long").alias("page_id"),
        F.concat(F.lit("<article><p>words of page "), "id", F.lit("</p></article>")).alias("html"),
    )
    pages = pages.union(spark.range(1500).select(F.lit(9).cast("long"), F.lit("<article><p>the same again</p></article>")))
    seen = counted_collects(monkeypatch, main_text)
    main_text.learn(pages)
    given = seen[0] - main_text.COMPOSED
    assert main_text.SAMPLE / 2 < given <= main_text.SAMPLE


def test_texts_without_ids(spark, monkeypatch):
    sizes = []
    real = language.clustered
    monkeypatch.setattr(language, "SAMPLE", 60)
    monkeypatch.setattr(language, "stored", lambda df, name: sizes.append(dict(map(tuple, df.groupBy("lang").count().collect()))) or df)
    rows = spark.range(2000).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.concat(F.lit("some words number "), "id").alias("text"),
        F.when(F.col("id") % 2 == 0, "aa").otherwise("bb").alias("lang"),
    )
    rows = rows.union(spark.range(3000).select(F.lit(1).cast("long"), F.lit("the same again"), F.lit("aa")))
    model = language.learn(rows)
    assert set(model.langs) == {"aa", "bb"} and real is language.clustered
    assert set(sizes[0]) == {"aa", "bb"} and all(n <= 60 for n in sizes[0].values()) and sizes[0]["bb"] > 30
