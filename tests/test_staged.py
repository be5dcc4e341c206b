"""Staged parts: a round trip, and every way in which a part can be broken."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from evidencelake.sources import staged


def frame(spark, n):
    rng = random.Random(1)
    return spark.createDataFrame([(k, None if k == 3 else "".join(rng.choice("가나다abc ") for _ in range(rng.randint(0, 90)))) for k in range(n)], "k long, line string").repartition(3)


def test_round_trip_in_order(spark, tmp_path):
    df = frame(spark, 3000)
    manifest = staged.write_parts(df, f"{tmp_path}/s", "line", ["k"], part_bytes=4000, member_bytes=1500)
    assert manifest.agg(F.max("bytes"), F.sum("rows")).first()[1] == 3000 and manifest.agg(F.max("bytes")).first()[0] <= 4000 and manifest.count() > 10
    back = [r["line"] for r in staged.read_parts(spark, f"{tmp_path}/s").orderBy("chunk", "part", "line_no").collect()]
    want = [r["line"] or "" for r in df.orderBy("k").collect()]
    assert back == want
    # the parts behind one another are one gzip stream
    whole = b"".join(bytes(r["data"]) for r in spark.read.parquet(f"{tmp_path}/s/parts").orderBy("chunk", "part").collect())
    assert gzip.decompress(whole).decode() == "".join(f"{x}\n" for x in want)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        staged.write_parts(df, f"{tmp_path}/s", "line", ["k"])


def test_broken_parts_are_refused(spark, tmp_path):
    staged.write_parts(frame(spark, 500), f"{tmp_path}/s", "line", ["k"], part_bytes=2000, member_bytes=800)
    parts, manifest = (spark.read.parquet(f"{tmp_path}/s/{x}").cache() for x in ("parts", "manifest"))
    first = manifest.orderBy("chunk", "part").first()
    at = (F.col("chunk") == first["chunk"]) & (F.col("part") == first["part"])
    faults = lambda p, m=manifest: [(r["chunk"], r["part"], r["fault"]) for r in staged.broken(p, m).collect()]
    key = (first["chunk"], first["part"])
    assert faults(parts) == []
    assert faults(parts.withColumn("data", F.when(at, F.concat(F.col("data").substr(F.lit(1), F.length("data") - 1), F.lit(b"\x7f"))).otherwise(F.col("data")))) == [(*key, "changed")]
    assert faults(parts.where(~at)) == [(*key, "missing")]
    assert faults(parts, manifest.where(~at)) == [(*key, "unknown")]
    assert faults(parts.unionByName(parts.where(at))) == [(*key, "repeated")]
    parts.where(~at).write.parquet(f"{tmp_path}/t/parts")
    manifest.write.parquet(f"{tmp_path}/t/manifest")
    with pytest.raises(ValueError, match="missing"):
        staged.read_parts(spark, f"{tmp_path}/t")


def test_empty(spark, tmp_path):
    staged.write_parts(spark.createDataFrame([], "k long, line string"), f"{tmp_path}/e", "line", ["k"])
    assert staged.read_parts(spark, f"{tmp_path}/e").collect() == []
