"""Synthetic clip tables for tests (FIXTURES §3): spark.range + hash expressions.

Locales of Zipf-like size (one very large), versions 1 / 5.1 / 16.1 / 20.0,
all buckets, two algorithms, ~2 % missing durations, multi-accent values,
old and new gender labels. Used only by tests; no registered query reads it.
"""

from pyspark.sql import functions as F

LOCALES = ["en", "tr", "de", "ca", "cy"]
VERSIONS = ["1", "5.1", "16.1", "20.0"]


def _h(salt, mod, seed=42):
    return F.pmod(F.xxhash64(F.col("id"), F.lit(salt), F.lit(seed)), F.lit(mod))


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (idx + 1).cast("int"))


def clips(spark, n=20000):
    base = spark.range(n)
    lc_idx = F.when(_h("lc", 100) < 55, 0).when(_h("lc", 100) < 75, 1).when(_h("lc", 100) < 88, 2) \
        .when(_h("lc", 100) < 96, 3).otherwise(4)
    sp_idx = F.when(_h("sp", 10) < 6, 0).when(_h("sp", 10) < 8, 1).otherwise(2)
    ages = ["teens", "twenties", "thirties", "fourties", None, "odd"]
    genders = ["male", "female", "male_masculine", "female_feminine", "non-binary", None]
    accents = ["x", "x,z", None, "z,w", "y", "Long (paren)"]
    df = base.select(
        "id",
        _pick(VERSIONS, _h("ver", 4)).alias("ver"),
        _pick(LOCALES, lc_idx).alias("lc"),
        F.lit("").alias("alg"),
        _pick(["validated", "invalidated", "other"], sp_idx).alias("sp"),
        F.concat(F.lit("u"), _h("client", 400).cast("string")).alias("client_id"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"),
        F.when(_h("case", 10) == 0, F.concat(F.lit("S"), _h("sent", 900).cast("string")))
         .otherwise(F.concat(F.lit("s"), _h("sent", 900).cast("string"))).alias("sentence"),
        _h("up", 6).cast("int").alias("up_votes"),
        _h("down", 4).cast("int").alias("down_votes"),
        _pick(ages, _h("age", len(ages))).alias("age"),
        _pick(genders, _h("gender", len(genders))).alias("gender"),
        _pick(accents, _h("acc", len(accents))).alias("accents"),
        _pick(["v1 text", None], _h("var", 2)).alias("variant"),
    )
    buckets = df.drop("id")
    val = df.where(F.col("sp") == "validated")
    algos = []
    for alg in ("s1", "s99"):
        algos.append(val.select(
            "ver", "lc", F.lit(alg).alias("alg"),
            _pick(["train", "dev", "test"], F.when(_h(alg, 10) < 7, 0).when(_h(alg, 10) < 9, 1).otherwise(2)).alias("sp"),
            *[c for c in buckets.columns if c not in ("ver", "lc", "alg", "sp")]))
    out = buckets
    for a in algos:
        out = out.unionByName(a)
    return out


def durations(spark, n=20000):
    return (spark.range(n).where(_h("missing", 50) != 0)
            .select(_pick(LOCALES, F.when(_h("lc", 100) < 55, 0).when(_h("lc", 100) < 75, 1)
                          .when(_h("lc", 100) < 88, 2).when(_h("lc", 100) < 96, 3).otherwise(4)).alias("lc"),
                    F.concat(F.lit("p"), F.col("id").cast("string")).alias("clip"),
                    (F.lit(800) + _h("dur", 12000)).alias("duration_ms")))


def specs(spark, n=20000):
    lc = _pick(LOCALES, F.when(_h("lc", 100) < 55, 0).when(_h("lc", 100) < 75, 1)
               .when(_h("lc", 100) < 88, 2).when(_h("lc", 100) < 96, 3).otherwise(4))
    return spark.range(n).select(
        F.col("id").alias("clip_id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("orig_path"),
        _pick(["mp3", "wav"], _h("enc", 2)).alias("orig_encoding"),
        _pick(["48000", "32000"], _h("sr", 2)).cast("long").alias("orig_sample_rate"),
        F.lit(1).cast("short").alias("orig_num_channels"), F.lit(64).cast("short").alias("orig_bitrate_kbps"),
        (F.lit(800) + _h("dur", 12000)).alias("duration"), (F.lit(300) + _h("sdur", 700)).alias("speech_duration"),
        F.when(_h("nov", 30) == 0, None).otherwise(_h("pw", 1000) / F.lit(1e7)).alias("speech_power"),
        (_h("sil", 1000) / F.lit(1e10)).alias("silence_power"),
        F.when(_h("nov", 30) == 0, None).otherwise(_h("snr", 9000) / F.lit(100.0) - F.lit(10.0)).alias("est_snr"),
        _pick(["5.1", "16.1", "20.0"], _h("sver", 3)).alias("ver"), F.lit("cv").alias("ds"), lc.alias("lc"))
