"""Drafts of designs as structures and as text. One row for each design; lists stay arrays, so nothing is shuffled but the designs' join to the few patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands for a missing topic or standard, policies and their guidance, names of the sections, sentences.
NO_TOPIC, NO_STANDARDS = "수업에서 다룬 핵심 개념", "교사 확인 후 입력"
SOURCE_CHECK = "교육부·NCIC 공식 성취기준 원문과 학교 학업성적관리규정을 확인한 뒤 작성"
NO_AI, SEARCH_AI = "사용하지 않음", "자료 조사만 허용"
GUIDANCE = {
    NO_AI: "생성형 AI를 사용하지 않습니다. 검색·계산 도구의 허용 범위는 교사가 별도로 안내합니다.",
    SEARCH_AI: "생성형 AI는 탐색어 제안과 기초 자료 조사에만 사용합니다. 최종 분석·표현은 학생이 작성하고, 사용한 질문과 결과를 부록에 남깁니다.",
}
OTHER_GUIDANCE = "생성형 AI 활용을 허용하되, 사용한 질문·결과·수정한 내용을 구분해 기록합니다. 학생의 과학적 탐구 사고와 검증 과정을 별도로 평가합니다."
BRIEF = "%s학년 %s 수업에서 '%s'을 중심으로 %s. %s 활동으로 진행하며, 최종 결과뿐 아니라 선택·시도·수정의 과정 증거를 함께 제출합니다."
FAIRNESS = (
    "과제·평가기준·제출 형식을 시작 전에 학생에게 공개한다.",
    "%s 활동에서도 개인별 판단과 기여가 드러나는 증거를 받는다.",
    "기기·소프트웨어 접근이 어려운 학생에게 동등한 대체 경로를 제공한다.",
    "결시·전입·장기 미제출 학생의 재평가 방법을 사전에 정한다.",
    "해부·채집·시약을 쓰는 과제는 안전 지침과 생명윤리 대체 활동을 함께 안내한다.",
    "결과물의 화려함보다 과학적 탐구 사고와 수정 과정을 평가한다.",
)
SECTIONS = ("기본 조건", "연결 성취기준", "공식 원문 확인", "수행 과제", "최종 산출물", "과정과 증거", "루브릭 초안", "AI 활용", "공정성 점검")


def shared_points(total: Column, weights: Column) -> Column:
    """Points of criteria as an array: the floor of each share, then one more for the first ones until the total is reached."""
    floors = F.transform(weights, lambda w: F.floor(total * w / 100))
    left = total - F.aggregate(floors, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(floors, lambda p, i: p + F.when(i < left, 1).otherwise(0))


def lessons_of(index: Column, phases: Column, lessons: Column) -> Column:
    """The lessons of a phase as text; earlier phases begin first, and each has one at least."""
    start = F.floor(index * lessons / phases) + 1
    end = F.greatest(start, F.floor((index + 1) * lessons / phases))
    return F.when(start == end, F.concat(start, F.lit("차시"))).otherwise(F.concat(start, F.lit("–"), end, F.lit("차시")))


def drafts(designs: DataFrame, patterns: DataFrame) -> DataFrame:
    """Designs with title, brief, rubric, lesson plan, guidance and checks.

    ``designs``: design_id, pattern, topic, subject, curriculum, grade, semester,
    lessons, points, collaboration, ai_policy. ``patterns``: pattern, label,
    product, method_phrase, phases (title, evidence), criteria (label, weight,
    focus). A design of an unknown pattern has no row; a blank or null topic is
    named by what was taught; null texts are empty.
    """
    d = designs.join(patterns, "pattern")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    topic = F.coalesce(F.nullif(F.trim(blank("topic")), F.lit("")), F.lit(NO_TOPIC))
    guidance = F.lit(OTHER_GUIDANCE)
    for policy, sentence in GUIDANCE.items():
        guidance = F.when(F.col("ai_policy") == policy, sentence).otherwise(guidance)
    points = shared_points(F.col("points"), F.transform("criteria", lambda c: c["weight"]))
    rubric = F.transform("criteria", lambda c, i: F.struct(c["label"].alias("label"), F.get(F.col("_points"), i).alias("points"), c["focus"].alias("focus")))
    plan = F.transform("phases", lambda p, i: F.struct(lessons_of(i, F.size("phases"), F.col("lessons")).alias("lesson"), p["title"].alias("title"), p["evidence"].alias("evidence")))
    made = d.withColumn("_points", points).withColumn("_topic", topic)
    return made.select(
        *designs.columns, F.concat(F.col("_topic"), F.lit(" — "), F.col("label")).alias("title"), F.format_string(BRIEF, blank("grade"), blank("subject"), F.col("_topic"), blank("method_phrase"), blank("collaboration")).alias("task_brief"),
        F.lit("").alias("achievement_standards"), F.lit(SOURCE_CHECK).alias("source_check"), "product", plan.alias("lesson_plan"), rubric.alias("rubric"), F.transform("phases", lambda p: p["evidence"]).alias("evidence_checklist"),
        guidance.alias("ai_guidance"), F.array(*(F.format_string(x, blank("collaboration")) if "%s" in x else F.lit(x) for x in FAIRNESS)).alias("fairness_checklist"),
    )


def as_text(made: DataFrame) -> DataFrame:
    """(design_id, text) of drafts: the title, then each section under its name."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    dashed = lambda a: F.array_join(F.transform(a, lambda x: F.concat(F.lit("- "), x)), "\n")
    conditions = F.concat_ws(
        "\n", F.concat(F.lit("- "), blank("curriculum"), F.lit(" 개정 "), blank("subject")),
        F.concat(F.lit("- "), blank("grade"), F.lit("학년 "), blank("semester"), F.lit("학기 · "), blank("lessons"), F.lit("차시 · "), blank("collaboration")), F.concat(F.lit("- 총 "), blank("points"), F.lit("점")),
    )
    process = dashed(F.transform("lesson_plan", lambda p: F.concat(p["lesson"], F.lit(" "), p["title"], F.lit(": "), p["evidence"])))
    rubric = dashed(F.transform("rubric", lambda r: F.concat(r["label"], F.lit(" ("), r["points"], F.lit("점): "), r["focus"])))
    standards = F.coalesce(F.nullif(blank("achievement_standards"), F.lit("")), F.lit(NO_STANDARDS))
    bodies = (conditions, standards, blank("source_check"), blank("task_brief"), blank("product"), process, rubric, blank("ai_guidance"), dashed("fairness_checklist"))
    return made.select("design_id", F.concat_ws("\n\n", "title", *(F.concat(F.lit(f"[{name}]\n"), body) for name, body in zip(SECTIONS, bodies, strict=True))).alias("text"))
