"""Training-data curation: splits, leakage, caps, augmentation, length filters, private text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.sampling import cap, draw
from plumbline.query import query, table

_H = "md5(concat_ws(',', '{}', {}::VARCHAR))"
#: Splits from the laxest to the strictest.
RANK = {"train": 0, "val": 1, "test": 2}


@query("SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN 'test' WHEN source = 'src3' THEN 'val' ELSE 'train' END AS split FROM documents")
def split_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("source").isin("src1", "src2"), "test").when(F.col("source") == "src3", "val").otherwise("train").alias("split"))


@query("""WITH h AS (SELECT DISTINCT md5(text) AS k FROM documents WHERE source = 'src1') SELECT doc_id FROM documents WHERE source <> 'src1' AND md5(text) NOT IN (SELECT k FROM h)""")
def leakage_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows without the items of the held-out series."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("k"))
    return d.where("source <> 'src1'").join(d.where("source = 'src1'").select("k").distinct(), "k", "left_anti").select("doc_id")


@query("""WITH m AS (SELECT user_id AS conv, event_id, event_type, (value::INTEGER % 40)::BIGINT AS mention FROM events), s AS (SELECT event_id, CASE event_id % 10 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS own, CASE WHEN mention IN (3, 7) THEN 2 WHEN mention = 11 THEN 1 ELSE 0 END AS seen FROM m)
SELECT event_id, ['train', 'val', 'test'][greatest(own, seen) + 1] AS split, seen > own AS moved FROM s""")
def strictest_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strictest of a row's own split and those of everything it mentions."""
    e = table(spark, sf_dir, "events").select("event_id", (F.rint("value").cast("long") % 40).alias("mention"))
    listed = spark.createDataFrame([(3, 2), (7, 2), (11, 1)], "mention long, seen int")
    own = F.when(F.col("event_id") % 10 == 0, 2).when(F.col("event_id") % 10 == 1, 1).otherwise(0)
    j = e.join(F.broadcast(listed), "mention", "left").select("event_id", own.alias("own"), F.coalesce("seen", F.lit(0)).alias("seen"))
    names = F.array(*[F.lit(s) for s in RANK])
    return j.select("event_id", F.get(names, F.greatest("own", "seen")).alias("split"), (F.col("seen") > F.col("own")).alias("moved"))


@query(f"""WITH e AS (SELECT doc_id, text, ('0x' || substr({_H.format(11, 'doc_id')}, 1, 8))::BIGINT % 100 AS d FROM documents WHERE lang <> 'de')
SELECT doc_id || '_low' AS id, doc_id, 'low' AS aug FROM e WHERE d < 25 UNION ALL SELECT doc_id::VARCHAR, doc_id, NULL FROM documents""")
def augmented_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows and a seeded quarter of the eligible ones again under a new id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    share = F.conv(F.substring(draw(11, "doc_id"), 1, 8), 16, 10).cast("long") % 100
    copies = d.where((F.col("lang") != "de") & (share < 25)).select(F.concat(F.col("doc_id").cast("string"), F.lit("_low")).alias("id"), "doc_id", F.lit("low").alias("aug"))
    return copies.unionByName(d.select(F.col("doc_id").cast("string").alias("id"), "doc_id", F.lit(None).cast("string").alias("aug")))


@query("""WITH n AS (SELECT conv_id, sum(length(text)) AS n FROM conversations GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n) - 1 AS i, count(*) OVER () AS c FROM n), m AS (SELECT ceil(max(CASE WHEN i = least(c - 1, floor(0.95 * c)) THEN n END) / 256.0) * 256 AS max_len FROM r)
SELECT conv_id, n::BIGINT AS n, n <= max_len AS kept FROM n, m""")
def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keeps rows up to the 95th rank percentile rounded up to 256; the percentile comes from counts of lengths."""
    from pyspark.sql import Window

    n = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(F.length("text")).alias("n"))
    lengths = n.groupBy("n").agg(F.count("*").alias("k")).withColumn("slice", F.floor(F.col("n") / 4096))
    by_slice = lengths.groupBy("slice").agg(F.sum("k").alias("k"))
    before = by_slice.withColumn("before", F.sum("k").over(Window.orderBy("slice")) - F.col("k")).drop("k")
    upto = lengths.join(before, "slice").withColumn("upto", F.col("before") + F.sum("k").over(Window.partitionBy("slice").orderBy("n")))
    total = lengths.agg(F.sum("k").alias("c"))
    limit = upto.join(F.broadcast(total)).where(F.col("upto") > F.least(F.col("c") - 1, F.floor(0.95 * F.col("c")))).agg((F.ceil(F.min("n") / 256.0) * 256).alias("max_len"))
    return n.join(F.broadcast(limit)).select("conv_id", "n", (F.col("n") <= F.col("max_len")).alias("kept"))


@query(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY {_H.format(3, 'doc_id')}, doc_id) AS rn FROM documents WHERE lang = 'en') WHERE rn <= 3")
def quota_per_situation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap(table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", "source"), ["source"], 3, "doc_id", 3).select("doc_id")


@query("""SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'human' WHEN role = 'assistant' THEN 'model' ELSE role END AS speaker, CASE WHEN turn = 0 THEN 'first' WHEN role = 'assistant' THEN 'reply' ELSE 'follow' END AS kind FROM conversations""")
def chat_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(role == "user", "human").when(role == "assistant", "model").otherwise(role).alias("speaker"), F.when(F.col("turn") == 0, "first").when(role == "assistant", "reply").otherwise("follow").alias("kind"))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', '<mail>', 'g'), '[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}', '<ip>', 'g')) AS h FROM documents""")
def private_text_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = F.regexp_replace(F.regexp_replace("text", "[A-Za-z0-9._]+@[A-Za-z0-9.]+", "<mail>"), r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}", "<ip>")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(masked).alias("h"))


@query("SELECT lang, source, count(*) AS rows_, count(DISTINCT md5(text)) AS texts, min(n_chars) AS shortest, max(n_chars) AS longest FROM documents GROUP BY 1, 2")
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("rows_"), F.countDistinct(F.md5("text")).alias("texts"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))


@query("SELECT count(*) FILTER (WHERE regexp_matches(text, '(^|[^A-Za-z])None([^A-Za-z]|$)')) AS bad FROM conversations WHERE role = 'assistant'")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many answers hold the word None; a build stops if any do."""
    return table(spark, sf_dir, "conversations").where("role = 'assistant'").agg(F.count_if(F.col("text").rlike("(^|[^A-Za-z])None([^A-Za-z]|$)")).alias("bad"))
