import random

from pyspark.sql import functions as F

from claimscope.llm import lang_id


def test_copies_neither_empty_nor_fill_the_sample(spark):
    rng = random.Random(1)
    hashes = spark.createDataFrame([(i, "".join(rng.choices("abcdefg ", k=30))) for i in range(400)], "i long, text string").select("text", F.xxhash64(F.col("text").cast("binary"), F.lit(lang_id.SEED)).alias("h"))
    # the old draw takes a text at a rate of 1600 / rows: these it would leave out, or take alone
    high = [r["text"] for r in hashes.where("h < 0").limit(4).collect()]
    few = spark.createDataFrame([(t, "x") for t in high], "text string, lang string").crossJoin(spark.range(1500)).select("text", "lang")
    low = hashes.where("h > 0").orderBy("h").first()["text"]
    other = spark.createDataFrame([(low, "y")] * 500 + [("".join(rng.choices("mnopqrs ", k=30)), "y") for _ in range(60)], "text string, lang string")
    model = lang_id.learn(few.unionByName(other), F.lit(True))
    assert set(model["langs"]) == {"x", "y"} and model["langs"].count("y") == lang_id.CENTROIDS
    got = lang_id.predict(few.unionByName(other), model, keep=["lang", "text"]).collect()
    assert all(r["lang_pred"] == r["lang"] and not r["rejected"] for r in got)
