"""Sources, sinks, the limiter, serving and audits on small tables."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from evidencelake.operators import joins
from evidencelake.plans import audits, serve
from evidencelake.sources import files, sinks
from evidencelake.streaming import limiter


def test_sources(spark, tmp_path):
    good = tmp_path / "a.jsonl"
    good.write_text('{"a": "x", "n": 1}\n\n{"a": "y"}\n', encoding="utf-8")
    bad = tmp_path / "b.jsonl"
    bad.write_text('{"a": "x"}\nnot json\n', encoding="utf-8")
    assert [(r["a"], r["n"]) for r in files.jsonl(spark, str(good), "a string, n int").collect()] == [("x", 1), ("y", None)]
    with pytest.raises(Exception):
        files.jsonl(spark, str(bad), "a string").collect()
    assert tuple(files.jsonl_counts(spark, str(bad), "a string").first()) == (2, 1)
    table = tmp_path / "c.csv"
    table.write_bytes("﻿code,name\n1,가\n2,\n".encode())
    assert [tuple(r) for r in files.csv(spark, str(table), "code", "name").collect()] == [("1", "가"), ("2", "")]
    assert files.log(spark, str(good), "a").count() == 2 and files.ordered(files.jsonl(spark, str(good), "a string")).orderBy("seq").first()["a"] == "x"
    df = spark.createDataFrame([(b"%PDF-1", "서울특별시 종로구 1"), (b"PK\3\4", "x"), (b"<!DOCTYPE html>", ""), (bytes.fromhex("d0cf11e0a1"), " a  b c"), (b"?", None)], "c binary, t string")
    assert [r[0] for r in df.select(files.payload_kind(F.col("c"))).collect()] == ["pdf", "zip", "html", "ole", "unknown"]
    assert [r[0] for r in df.select(files.district_of(F.col("t"))).collect()] == ["종로구", "", "", "b", ""]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    sinks.write_jsonl(df, f"{tmp_path}/j")
    with pytest.raises(Exception):
        sinks.write_jsonl(df, f"{tmp_path}/j")
    changed = sinks.updated(df, spark.createDataFrame([(2, None), (9, "z")], "k int, v string"), ["k"])
    assert sorted((r["k"], r["v"]) for r in changed.collect()) == [(1, "a"), (2, None), (3, "c")]
    assert sum(r["rows"] for r in sinks.manifest(df, f"{tmp_path}/m", 2).collect()) == 3
    with pytest.raises(ValueError, match="bad: 1"):
        sinks.fail_if_any(df.where("k = 1"), "bad", "k")
    assert sinks.summary({"by": df.groupBy("v").count()}).first()["by"] == {"a": 1, "b": 1, "c": 1}


def test_a_manifest_of_many_small_parts(spark, tmp_path):
    """No checksum file, and so no second process, for each part; parts are read by no more tasks than a shuffle has."""
    rows = spark.range(0, 300, numPartitions=3).select("id", F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("v"))
    parts = sinks.manifest(rows, f"{tmp_path}/m", 2)
    named = {p.name for p in (tmp_path / "m").glob("part-*")}
    assert len(named) == 150 and not list((tmp_path / "m").glob(".part-*.crc"))
    got = parts.collect()
    assert {r["file"] for r in got} == named and {r["rows"] for r in got} == {2} and len({r["sha256"] for r in got}) == 150
    assert spark.read.parquet(f"{tmp_path}/m").rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions")) and "Coalesce 4" in parts._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.manifest(rows, f"{tmp_path}/m", 2)
    assert sinks.manifest(rows.where("id < 0"), f"{tmp_path}/none", 2).collect() == []


def plain(times, limit, window):
    held, out = [], []
    for t in times:
        held = [h for h in held if h > t - window]
        out.append(len(held) < limit)
        if out[-1]:
            held.append(t)
    return out


def test_limiter(spark):
    rng = random.Random(3)
    rows = sorted((rng.randint(0, 600), rng.randint(0, 2)) for _ in range(300))
    hits = [(k, i, t) for i, (t, k) in enumerate(rows)]
    df = spark.createDataFrame(hits, "k int, seq int, t int").select("k", "seq", F.timestamp_seconds("t").alias("ts"))
    got = {r["seq"]: r["accepted"] for r in limiter.limited(df, "k", "ts", "seq", 5).collect()}
    for k in range(3):
        mine = [(i, t) for kk, i, t in hits if kk == k]
        assert [got[i] for i, _ in mine] == plain([t for _, t in mine], 5, 60.0)


def test_limiter_stream(spark, tmp_path):
    rng = random.Random(4)
    rows = sorted((rng.randint(0, 400), rng.randint(0, 2)) for _ in range(120))
    hits = [(k, i, t) for i, (t, k) in enumerate(rows)]
    for n, part in enumerate((hits[:60], hits[60:])):  # two batches, in order
        spark.createDataFrame(part, "k int, seq int, t int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in{n}")
    out = {}
    for n in (0, 1):
        frame = spark.readStream.schema("k int, seq int, t int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in*").select("k", "seq", F.timestamp_seconds("t").alias("ts"))
        if n:
            break
        query = limiter.limited_stream(frame, "k", "ts", "seq", 5).writeStream.foreachBatch(lambda df, _: out.update({r["seq"]: r["accepted"] for r in df.collect()})).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination(120)
    for k in range(3):
        mine = [(i, t) for kk, i, t in hits if kk == k]
        assert [out[i] for i, _ in mine] == plain([t for _, t in mine], 5, 60.0)


@pytest.fixture(scope="module")
def published(spark):
    ids = [f"{i:024x}" for i in range(4)]
    cases = spark.createDataFrame([Row(case_id=c, curriculum="2015", subject="생명과학Ⅰ", region=("서울", "서울", "부산", "")[i], district=("종로", "중구", "해운대", "")[i], school_name=f"학교{i}", title=f"세포 탐구 {i}", excerpt="본문", action_tags=["탐구"] if i % 2 else ["탐구", "발표"], review_score=10 + i, title_basis="source_detail" if i < 3 else "catalog_only", subject_alignment="other" if i == 1 else "expected", source_url="u" if i else "", sha256="s", source_format="pdf", task_names=["세포 관찰하기", "왜?"]) for i, c in enumerate(ids)])
    items = spark.createDataFrame([Row(item_id=f"{c}-{k}", case_id=c, item_order=k, title=f"효소 실험 {k}", overview="DNA" if k == 2 else "", extraction_status="bounded" if k < 3 else "bundle_review", title_basis="table", boundary_status="subject_heading:assessment_anchor" if i else "subject_heading_not_found:assessment_anchor", source_html="010-1234-5678" if (i, k) == (2, 1) else "<p>x</p>") for i, c in enumerate(ids) for k in (1, 2, 3)])
    rankings = items.select("item_id", F.when(F.col("item_order") == 1, 50).otherwise(38).alias("priority_score"), F.lit("experiment").alias("category"))
    axes = items.select("item_id", F.explode(F.array(F.struct(F.lit("method").alias("axis"), F.lit("experiment").alias("value")), F.struct(F.lit("method").alias("axis"), F.lit("writing").alias("value")), F.struct(F.lit("topic").alias("axis"), F.when(F.col("item_order") == 2, "genetics").otherwise("cell").alias("value")))).alias("a")).select("item_id", "a.*")
    stats = spark.createDataFrame([("2015", "생명과학Ⅰ", 4, 4, 11.5, 3, 1)], "curriculum string, subject string, documents long, schools long, median_review_score double, coverage_found long, coverage_unknown long")
    return serve.Published(cases.cache(), items.cache(), rankings.cache(), stats, axes.cache())


def test_cases(published):
    found = serve.cases(published, limit=2)
    assert found["total"].first()["total"] == 3 and [r["review_score"] for r in found["items"].collect()] == [12, 11]
    assert [r["excerpt"] for r in found["items"].collect()] == ["본문", ""]  # the second belongs to another subject
    assert serve.cases(published, region="서울", tag="발표")["total"].first()["total"] == 1
    assert serve.cases(published, query="세포 dna")["total"].first()["total"] == 3 and serve.cases(published, query="없음")["total"].first()["total"] == 0
    with pytest.raises(ValueError):
        serve.cases(published, district="종로")
    with pytest.raises(ValueError):
        serve.cases(published, limit=31)
    facets = serve.facets(published, region="서울")
    assert {r["value"]: r["count"] for r in facets["regions"].collect()} == {"서울": 2, "부산": 1}
    assert {r["value"] for r in facets["districts"].collect()} == {"종로", "중구"} and {r["value"]: r["count"] for r in facets["action_tags"].collect()} == {"탐구": 2, "발표": 1}
    assert tuple(serve.meta(published).first()) == (4, 4, 4, 4, 8)
    assert serve.with_status(published, "unconfirmed").count() == 1


def test_references(published):
    found = serve.references(published, category="writing", topic="genetics", region="서울")
    assert found["total"].first()["total"] == 2 and found["items"].count() == 2
    assert {r["value"]: r["count"] for r in found["regions"].collect()} == {"서울": 4, "부산": 2}  # whatever the topic and region
    assert serve.curated(published, category="experiment", limit=3).first()["priority_score"] == 50
    assert serve.case_detail(published, f"{1:024x}").count() == 2 and serve.case_detail(published, f"{3:024x}").count() == 0
    assert serve.assessment_item(published, f"{1:024x}-1").count() == 1 and serve.assessment_item(published, f"{1:024x}-3").count() == 0
    with pytest.raises(ValueError):
        serve.case(published, "x")


def test_audits(spark, published):
    details = published.cases.select("case_id", F.lit("subject_heading:assessment_anchor_not_found").alias("boundary_status"), F.lit(100).alias("section_char_count"))
    assert {r["relation"]: r["orphans"] for r in audits.orphan_counts(published, details.limit(3)).collect()}["cases_without_detail"] == 1
    reasons = {r["item_id"]: r["reasons"] for r in audits.gate_reasons(published.items, published.cases).collect()}
    assert reasons == {f"{0:024x}-{k}": "missing_source_url|boundary_not_trusted" for k in (1, 2)}
    assert [r["item_id"] for r in audits.identity_leaks(published.items).collect()] == [f"{2:024x}-1"]
    assert audits.structure_queue(details).count() == 4 and audits.grade_crosstab(details, published.cases).first()["partial"] == 4
    assert audits.recomputed_stats(published.cases, published.subject_stats).count() == 0
    assert [(r["field"], r["stored"]) for r in audits.recomputed_stats(published.cases, published.subject_stats.withColumn("documents", F.lit(9))).collect()] == [("documents", "9")]
    graded = audits.title_grades(published.cases)
    assert {r["confidence"] for r in graded.collect()} == {"supported", "reject"} and audits.unresolved(published.cases, graded).count() == 0
    rows = [("c", "t", "high", "table_row", "expected", True, True, False), ("c", "t", "high", "table_row", "expected", True, True, False), ("c", "u", "low", "table_row", "expected", True, True, False), ("c", "v", "high", "table_row", "other", True, True, False)]
    kept, dropped = audits.promotable(spark.createDataFrame(rows, "case_id string, candidate string, confidence string, detection string, subject_alignment string, explicit_name_label boolean, title_looks_complete boolean, other_subject_signal boolean"))
    assert kept.count() == 1 and {r["reason"]: r["candidates"] for r in dropped.collect()} == {"not_high_confidence": 1, "not_expected_subject": 1}


def test_spans_and_attachments(spark):
    inner = spark.createDataFrame([(1, 5, 8), (1, 20, 30), (2, 5, 8)], "d int, start int, end int")
    outer = spark.createDataFrame([(1, 0, 10)], "d int, start int, end int")
    assert sorted((r["d"], r["start"]) for r in joins.suppressed_spans(inner, outer, "d").collect()) == [(1, 20), (2, 5)]


def test_checked_json_lines(spark, tmp_path):
    import pytest

    from evidencelake.sources import files

    good = tmp_path / "good.jsonl"
    good.write_text('{"key": "a", "words": ["x", " ", "y"]}\n[1]\n"t"\nnull\n 3\n{"key": "b", "key": "c"}\n', encoding="utf-8")
    assert [tuple(r) for r in files.objects(spark, str(good), "key string").collect()] == [("a",), ("c",)]
    assert files.lexicon(spark, str(good)) == (("a", ("x", "y")), ("c", ()))
    for bad, line in (('{"a": 1}\n{"a": 2} x\n{', 2), ("\n{}", 1), ('{"a":1}\n{"a"', 2), ('{"a":1}\n1, 2\n', 2)):
        path = tmp_path / f"bad{abs(hash(bad))}.jsonl"
        path.write_text(bad)
        with pytest.raises(ValueError, match=rf"\.jsonl:{line}:"):
            files.objects(spark, str(path), "a int")
    # a file that is read in many blocks has the same line numbers
    long = tmp_path / "long.jsonl"
    long.write_text("".join(f'{{"a": {i}}}\n' if i not in (3000, 4000) else f"{{{i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        assert [(r["line_no"], r["value"]) for r in files.first_bad_lines(spark, [str(long), str(good)]).collect()] == [(3001, "{3000")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_replaced_and_marked(spark, tmp_path):
    from evidencelake.sources import files, sinks

    path = str(tmp_path / "t")
    for n in (3, 5):
        sinks.replace_table(spark.range(n), path)
        assert spark.read.parquet(path).count() == n
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    sinks.write_csv(spark.createDataFrame([("가", "1")], "name string, n string").coalesce(1), str(tmp_path / "c"), bom=True)
    part = next((tmp_path / "c").glob("*.csv"))
    assert part.read_bytes().startswith("﻿name,n".encode())
    back = files.csv(spark, str(tmp_path / "c"))
    assert back.columns == ["name", "n"] and back.first()["name"] == "가"
