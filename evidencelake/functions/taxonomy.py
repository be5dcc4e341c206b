"""Classification of names by lexicon: all categories tied on the longest word found, then on how many."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .headings import bound

# Method axis, key and words.
METHODS = (
    ("reasoning", ("추론", "이유", "근거", "원리", "설명", "해석", "논증", "제안")),
    ("measurement", ("계산", "측정", "구하기", "산출")),
    ("experiment", ("실험", "문제인식", "가설", "변인 통제", "변인통제", "자료해석", "모델", "실습", "검출")),
    ("problem", ("해결", "풀이", "전략", "판단")),
    ("analysis", ("분석", "비교")),
    ("discussion", ("발표", "토론", "의견", "토의", "구술", "논의")),
    ("writing", ("작성", "쓰기", "감상문", "보고서", "서술", "논술", "정리", "기록", "활동지", "에세이", "일지", "일기", "글쓰기")),
    ("production", ("제작", "설계", "만들기", "고안", "카드뉴스", "시나리오", "인포그래픽", "만화", "발명", "아이디어", "장치", "모형")),
    ("process", ("포트폴리오", "스크랩", "과정평가", "누적")),
    ("inquiry", ("탐구", "조사", "관찰", "프로젝트")),
)

# Ticked options and the method they stand for, the first that occurs counts.
DECLARED = (
    ("실험", "experiment"), ("실습", "experiment"), ("프로젝트", "inquiry"), ("포트폴리오", "process"), ("토의", "discussion"), ("토론", "discussion"), ("구술", "discussion"),
    ("발표", "discussion"), ("조사", "inquiry"), ("관찰보고서", "inquiry"), ("논술", "writing"), ("서술", "writing"), ("보고서", "writing"), ("서답형", "writing"),
)

# Words that say nothing about content, besides the method words.
FILLERS = (
    "과학", "과학적", "수행평가", "평가", "활동", "주제", "자유", "자율", "심화", "학습", "수업", "교과", "내용", "결과", "과정", "능력", "자료", "개념", "질문",
    "영역", "차시", "단원", "개별", "모둠", "협력", "학습지", "형성평가", "만들기", "쓰기", "하기", "수행", "및", "평가지",
)
FREE, UMBRELLA = "free", "inquiry"
TICKED = r"[■☑☒✓✔þＶ]|□\s*[VvＶ]"


def fold(value: str) -> str:
    """NFKC without white space, in lower case."""
    return re.sub(r"\s+", "", unicodedata.normalize("NFKC", value)).lower()


@F.pandas_udf(StringType())
def _folded(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else fold(v))


@F.pandas_udf(StringType())
def _composed(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def _other(text: Column) -> Column:
    """A text with signs beyond ASCII, else null: only such ones need Python."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), text)


def folded(text: Column) -> Column:
    return F.coalesce(_folded(_other(text)), F.lower(F.regexp_replace(text, r"[\s\x1C-\x1F]+", "")))


def composed(text: Column) -> Column:
    """NFKC; white space stays."""
    return F.coalesce(_composed(_other(text)), text)


@F.pandas_udf(ArrayType(StringType()))
def all_folded(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else [fold(x) for x in v])


def winners(name: Column, lexicon) -> Column:
    """Keys of the best categories of a folded name, keys descending; none for an empty name. ``lexicon``: (key, words), a parameter."""

    def score(key: str):
        return lambda f: F.struct(F.coalesce(F.array_max(F.transform(f, lambda w: F.length(w))), F.lit(0)).alias("longest"), F.size(f).alias("hits"), F.lit(key).alias("key"))

    def best(hit: Column) -> Column:
        top = F.array_max(F.transform(hit, lambda s: F.struct(s["longest"], s["hits"])))
        return bound(top, lambda t: F.transform(F.filter(hit, lambda s: (s["longest"] == t["longest"]) & (s["hits"] == t["hits"])), lambda s: s["key"]))

    def found(text: Column) -> Column:
        scored = [bound(F.filter(F.array(*(F.lit(fold(w)) for w in words)), lambda w: F.contains(text, w)), score(key)) for key, words in lexicon]
        return F.filter(F.array(*scored), lambda s: s["hits"] > 0)

    keys = bound(bound(name, found), best)
    return F.coalesce(F.sort_array(keys, asc=False), F.array().cast("array<string>"))


def ticked_options(method: Column) -> Column:
    """The ticked options of a menu; the whole text if it has no ticked box; none if it is empty."""
    text = F.regexp_replace(F.regexp_replace(method, r"(?U)\s+", " "), "^ | $", "")
    parts = F.transform(F.split(text, "(?=[■☑☒✓✔þ□])"), lambda s: F.regexp_replace(s, "^ +| +$", ""))
    picked = F.transform(F.filter(parts, lambda s: s.rlike(f"^(?:{TICKED})")), lambda s: F.regexp_replace(F.regexp_replace(s, TICKED, ""), r"^[ ·|]+|[ ·|]+$", ""))
    return F.when(text == "", F.array().cast("array<string>")).when(text.rlike(TICKED), F.filter(picked, lambda s: s != "")).otherwise(F.array(text))


def declared_methods(method: Column) -> Column:
    """Method keys of the ticked options, in their order."""

    def axis(option: Column) -> Column:
        chain = F.lit(None).cast("string")
        for needle, key in reversed(DECLARED):
            chain = F.when(F.contains(option, F.lit(needle)), key).otherwise(chain)
        return chain

    return F.array_distinct(F.array_compact(F.transform(all_folded(ticked_options(method)), axis)))


def content_free(title: Column) -> Column:
    """Whether all words of the name are method words or fillers."""
    known = sorted({fold(w) for _, words in METHODS for w in words} | {fold(w) for w in FILLERS})
    tokens = F.regexp_extract_all(composed(title), F.lit("[가-힣A-Za-z]{2,}"), 0)
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: F.array_contains(F.array(*map(F.lit, known)), F.lower(t)))


def classify(df: DataFrame, title: str, overview: str, declared: str, topics, methods=METHODS) -> DataFrame:
    """Add topics, methods, topic, method and ambiguous: title first; overview and ticked methods only for an axis the title leaves empty."""
    pick = lambda a: F.coalesce(F.try_element_at(F.col(a), F.lit(1)), F.lit(""))
    some = lambda a: bound(a, lambda v: F.when(F.size(v) > 0, v))
    none = F.array().cast("array<string>")
    named = df.withColumn("_title", folded(F.col(title))).withColumn("_overview", folded(F.col(overview))).withColumn("_declared_methods", declared_methods(F.col(declared)))
    by_word = named.withColumn("_topics", F.coalesce(some(winners(F.col("_title"), topics)), some(winners(F.col("_overview"), topics)), none))
    by_word = by_word.withColumn("_methods", F.coalesce(some(winners(F.col("_title"), methods)), some(F.col("_declared_methods")), some(winners(F.col("_overview"), methods)), none))
    concrete = F.filter("_methods", lambda k: k != UMBRELLA)
    made = by_word.withColumn("methods", F.when(F.size(concrete) > 0, concrete).otherwise(F.col("_methods")))
    made = made.withColumn("topics", F.when((F.size("_topics") == 0) & content_free(F.col(title)), F.array(F.lit(FREE))).otherwise(F.col("_topics")))
    made = made.withColumn("topic", pick("topics")).withColumn("method", pick("methods")).withColumn("ambiguous", (F.size("topics") != 1) | (F.size("methods") != 1))
    return made.drop("_title", "_overview", "_topics", "_methods", "_declared_methods")


# Names of the evidence an item may have.
SIGNALS = ("채점기준", "성취기준", "배점", "평가방법", "평가 개요")


def item_signals(rubric: Column, standards: Column, score: Column, weight: Column, method: Column, overview: Column) -> Column:
    """The names of the kinds of evidence that an item has; ``standards`` is an array, the others are texts."""
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    present = (filled(rubric), F.coalesce(F.size(standards), F.lit(0)) > 0, filled(score) | filled(weight), filled(method), filled(overview))
    return F.array_compact(F.array(*(F.when(p, F.lit(name)) for name, p in zip(SIGNALS, present, strict=True))))
