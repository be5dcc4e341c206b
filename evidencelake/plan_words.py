"""Vocabulary of assessment plans: labels of their tables, headings of their structure, rewrites of titles.

Patterns hold no look-around, so Spark and other SQL engines read them alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Headings that are structure and no task, compact.
STRUCTURAL_NAMES = (
    "항목별계획", "평가영역", "평가요소별세부채점기준", "평가항목별채점기준", "기본점수부여여부및방법", "평가방법및활용", "고사별배점", "수행평가의세부기준평가과제별로작성",
    "수행평가세부기준및배점", "수행평가영역별세부기준", "수행평가세부계획", "수업참여도세부기준", "방침", "수행평가과제별개요", "수행평가범위와기준", "평가과제별세부계획",
    "AI활용금지범위", "수행평가인정점산출기준", "수행평가평가기준", "과정중심수행평가세부계획", "평가방법및반영비율", "수업계획", "수행평가영역및평가항목배점및채점기준",
    "수행평가요소및성취기준", "평가과제별반영비율및성취수준", "평가과제별채점기준", "수행평가1", "수행평가2", "세부평가내용", "평가방법및평가내용", "정기시험세부계획", "과제별배점",
    "최종배점", "수행평가내용및평가세부기준", "수행평가인정점부여기준", "수행평가세부기준영역별배점및채점기준", "수행평가세부계획과목특성에따라양식변경", "기본방향", "평가방법과반영비율",
    "수행평가세부계획교과사정에따라변경될수있음", "수행평가세부계획1", "수행평가세부계획2", "수행평가세부계획평가과제별로작성", "항목별평가기준", "항목별", "영역별세부", "영역별", "일반사항",
    "학기단위성취수준설정", "최소성취수준설정", "최소성취수준설정공통과목", "1학기", "2학기", "성취기준과", "통계", "벡터", "행렬",
)

# Patterns of structural headings. "whole" must match the whole heading, "start" its beginning, "part" any part; "compact" any part of the compact heading of ten signs or more.
STRUCTURAL_PATTERNS = (
    ("whole", r"평가\s*개요(?:표)?|채점\s*기준표?|공통\s*(?:사항|유의\s*사항)|개요|영역|세부\s*내용\s*및\s*평가\s*척도표|세부\s*(?:채점\s*)?기준|피드백\s*및\s*기록|(?:수행)?평가\s*(?:세부\s*)?(?:계획|기준|기준안|운영)|수행\s*평가\s*세부\s*기준\s*\([^)]*\)|수행평가\s*(?:개요|분할\s*점수(?:\s*산출)?|성취율과\s*원점수)|(?:수행)?평가\s*영역\s*및\s*(?:평가\s*기준|반영\s*비율)|수행평가\s*영역\s*및\s*배점|수행평가\s*영역별\s*(?:평가\s*요소\s*및\s*채점\s*기준|성취기준\s*및\s*평가\s*척도)|(?:평가\s*)?영역별\s*(?:세부\s*)?(?:평가\s*)?(?:기준|채점\s*기준|반영\s*비율)|영역별\s*평가\s*방법과\s*채점\s*기준|평가\s*영역\s*및\s*배점|세부\s*(?:시행\s*)?계획|평가\s*(?:요소\s*및\s*(?:채점\s*기준|배점|성취\s*기준)|항목과\s*배점|과제)|평가\s*방법\s*및\s*내용|(?:관련\s*)?성취기준|성취\s*기준과\s*평가\s*기준|성취기준\s*및\s*(?:평가기준|성취수준|평가\s*방법)|교육과정\s*성취기준\s*및\s*평가\s*기준(?:,\s*평가\s*요소\s*및\s*배점)?|\[?\s*(?:평가\s*)?유의\s*사항\s*\]?|출제\s*계획표?|학기\s*단위\s*성취수준|최소\s*성취수준\s*진술문|결시생?\s*처리기준|동점자\s*처리\s*기준|(?:사회정서학습\s*연계\s*)?정의적\s*(?:능력|영역)\s*평가(?:의\s*실제|\s*(?:방안|계획|세부\s*사항|요소와\s*평가\s*방법))?|(?:(?:통합|생명)?과학\s*)?학습\s*과정\s*평가|서(?:술)?[·‧ㆍ]?\s*논술형\s*평가(?:\s*계획)?|세부\s*평가\s*척도|평가\s*방법\s*및\s*결과의\s*활용|정기시험\s*및\s*수행평가\s*세부계획|기타\s*사항|(?:평가과제|수행과제|평가영역|수행)\s*[12]|평가의?\s*종류\s*(?:와|및)\s*반영\s*비율|시행\s*계획|영역별\s*세부\s*계획|기준\s*성취율\s*(?:와|및)\s*성취도.*|.*평가하지\s*않는\s*성취기준.*|(?:세부\s*)?평가\s*계획|평가\s*세부\s*계획|수행평가\s*성취기준"),
    ("start", r"(?:교육과정\s*)?성취\s*기준\s*[:：]?\s*\[(?:10|12)"),
    ("whole", r"(?:학기\s*단위\s*)?성취\s*수준(?:\s*설정.*)?|최소\s*성취\s*수준(?:\s*(?:설정|진술).*)?"),
    ("whole", r"(?:일반|공통|기타)\s*사항|영역별"),
    ("whole", r"\[(?:10|12)[^\]]+\](?:\s*[~\\-].*)?"),
    ("start", r"성취\s*기준\s*및\s*성취\s*수준|수강생.*통합\s*산출\s*여부"),
    ("part", r"동일\s*학년\s*동일\s*교과|신체\s*장애\s*학생|통합반\s*선생님|채점\s*기준표"),
    ("whole", r"수행평가\s*과제별\s*세부\s*계획|평가\s*방법\s*및\s*채점\s*기준\s*배점|채점\s*기준\s*및\s*배점|성취\s*기준\s*및\s*평가\s*기준|평가\s*내용\s*및\s*방법|실시\s*시기\s*및\s*횟수|평가\s*관점[·ㆍ]?\s*요소|수행\s*수준\s*\(채점\s*기준\)\s*및\s*배점"),
    ("start", r"수행평가에서\s*인공지능|수행평가\s*유형은|수행평가\s*결과물에\s*AI|수행평가\s*세부\s*계획과\s*채점|수행평가의\s*영역|전[·ㆍ]?편입생|영역\s*만점은|질병\s*결석|최소\s*성취수준|기준\s*성취율"),
    ("part", r"(?i)(?:AI|인공지능).*(?:활용\s*(?:가능|금지|허용)|사용\s*금지|힌트\s*요청|활용\s*내역)"),
    ("part", r"교과협의회|학업성적(?:관리)?|관리위원회|심의\s*후|평가\s*관련\s*제반\s*문제|평가\s*결과의?\s*활용"),
    ("start", r"평소\s*수업\s*활동이\s*자연스럽게\s*평가로\s*이어지도록"),
    ("start", r"수행평가\s*(?:결시자의|영역별\s*특성|시간에|에\s*참여한|의\s*(?:목표|반영\s*비율)|를\s*할\s*때|는|인공지능|결과물은)|결석의\s*경우|결시(?:생|\s*\()|영역의\s*특성|질병\s*및\s*인정\s*결석|특수교육\s*대상자|AI(?:는|의\s*활용|를\s*활용)|교과의\s*특성을|전입생이|성취기준에\s*근거한\s*평가의|정기시험(?:은|에서)|내용\s*영역,\s*성취기준|모둠토의|포트폴리오에서|성취기준별\s*성취수준에\s*따른\s*수행\s*정도|출제\s*원안에는|모든\s*출제\s*원안|객관적이고\s*공정한\s*채점\s*기준|학생이\s*성취기준에|학생의\s*수업\s*시간\s*활동|원안\s*제출\s*시|5지\s*선다형|평가\s*\(정기시험\s*및\s*수행평가\)의|성취기준을\s*분석하여|비고\s*[:：]|평가\s*요소\s*[:：]"),
    ("start", r"최하\s*\d+점부터|[「『]?공교육\s*정상화\s*촉진"),
    ("part", r"(?:제출\s*금지|구분하여\s*명시|해당\s*없음)$"),
    ("part", r"(?:수행하였는가|활동하고\s*있는가|명확하게.*있는가)\s*\?$"),
    ("compact", r"(?:한다|된다|따른다|바란다|않는다|서술함|할수있다|부여할수있다)$"),
)

# Prose of policies. Length in compact signs from which a pattern counts.
PROSE_PATTERNS = (
    (12, r"(?:다|음|함|됨|짐|것|바람)\s*[.。]?$"),
    (20, r"(?:은|는|을|를|(?:^|[^토논회합정협주강])의|에|에서|으로|로|및|에게|부터|까지|하여|하고|하며|되어|되며|이며|으며|지만|면서)\s*$"),
    (15, r"(?:을|를)\s*평가\s*\.?$"),
    (0, r"[ⅠⅡⅢⅣⅤ]\s*[.．].*[ⅠⅡⅢⅣⅤ]\s*[.．]"),
)
ACTIVITY = r"보고서|실험|발표|프로젝트|포트폴리오|제작|조사|탐구|논술|서술|설계|작성|만들기|분석|토론|글쓰기|캠페인|관찰|측정|모형|에세이|일지|하기"
POLICY_WORDS = r"이의\s*신청|인정점|결시|동점자|미응시|미제출|분할\s*점수|학적\s*변동|성적\s*처리|재평가|전입생|부정행위"
ADMIN_WORDS = r"수행평가|정기시험|지필평가|평가|채점|배점|점수|만점|합계|총점|비율|반영|영역|요소|항목|내용|방법|기준안|기준|세부|계획|안내|운영|시기|횟수|단원|개요|표|성취기준|성취수준|성취율|성취도|등급|학기|학년|과목|교과|문항|고사|중간|기말|공통|일반|기타|사항|구분|순위|기본|합계|합|별|등|회|차|[0-9]|[및와과의는은이가을를에서로]"

# Rewrites of a heading into a title, in order; "$1" is the first group.
TITLE_REWRITES = (
    (r"^(?:#{1,6}\s*)?(?:[가-하]\s*[.)]|\d{1,2}\s*[.)]|\(\d{1,2}\)|[①-⑳])\s*(.+?)\s*$", "$1"),
    (r"^\[\s*([^\[\]]{2,60})\s*\]$", "$1"),
    (r"^\(\s*([^()]{2,60})\s*\)$", "$1"),
    (r"^\[[^\[\]]{1,20}\]\s*(\S)", "$1"),
    (r"^수행평가\s*\(\s*\d+\s*\)\s*[-:–—]?\s*", ""),
    (r"\s*\([^)]*(?:\d+(?:\.\d+)?\s*(?:점|%)|만점|반영\s*비율)[^)]*\)\s*$", ""),
    (r"\s*\(\s*(?:[5-9]|[1-9]\d|100)\s*\)\s*$", ""),
    (r"\s+(?:[5-9]|[1-9]\d|100)\s*\(\s*점\s*\)(\s*(?:\([^)]*\))?\s*)$", "$1"),
    (r"^수행\s*평가\s*세부\s*(?:계획|기준)(?:\s*\([^)]*\))?\s*(?:[가-하]\s*[.)]|\([가-하]\))\s*", ""),
    (r"^수행\s*평가\s*\d+\s*[:：]\s*", ""),
    (r"^수행\s*평가\s*영역\s*\d+\s*[:：]\s*", ""),
    (r"^(?:[A-Z]\s*)?(?:평가\s*)?영역\s*\d*\s*[:：]\s*(\S)", "$1"),
    (r"^.*?(?:수행\s*평가|평가)\s*(?:과제)?명\s*[:：]\s*(\S)", "$1"),
    (r"^수행\s*평가\s*세부\s*(?:기준|계획|내용)\s*[(（]\s*\d{1,2}\s*[)）]\s*(\S)", "$1"),
    (r"\s*[(（]\s*동점자\s*\d*\s*순위\s*[)）]\s*$", ""),
    (r"^\d+\s*순위\s*\([^)]*반영\s*비율[^)]*\)\s*[:：]\s*", ""),
    (r"^\[\s*(?:서[·ㆍ]?논술형|서술형|논술형)\s*\]\s*", ""),
    (r"\s*\(\s*평가\s*시기.*$", ""),
    (r"^(.{2,}?)\s*\([^)]*(?:\d+(?:\.\d+)?\s*(?:점|%))[^)]*\)\s*[:：]\s*.+$", "$1"),
)
# Words behind a task's name that go if a name of its own is left of them.
TITLE_TAILS = (r"^(.+?)\s*수행\s*평가\s*기준$", r"^(.+?)\s*평가\s*기준$")
# Decoration of a title: a list sign before it, a field's label glued behind it, signs at its ends.
DECORATION = (
    (r"^[\s•·∙‣▪▫◦●○※*・ㆍ]+", ""),
    (r"\s+(?:\d+\s*[).]|[가-하]\s*[).])\s*(?:평가\s*단원|영역별\s*성취\s*기준|성취\s*기준|평가\s*요소|채점\s*기준|평가\s*방법)\s*[:：]?.*$", ""),
    (r"^[\s:|·-]+|[\s:|·-]+$", ""),
)

# What no title is. Pairs of how a pattern applies (as above) and the pattern.
NO_TITLES = (
    ("whole", r"수행평가|정기시험|평가\s*세부\s*계획|평가의?\s*(?:목적|방침|방향)|성취기준(?:과\s*성취수준)?|채점\s*기준|평가\s*방법|성취도|결시자.*|미응시자.*|학적\s*변동.*|성적\s*처리.*|평가\s*결과.*"),
    ("whole", r"[0-9점%./~\s]+"),
)
EXAMS = ("whole", r"(?:제?[12]|중간|기말)\s*(?:차|회)?\s*(?:정기)?\s*(?:고사|시험)|[12]\s*(?:차|회)|정기\s*(?:고사|시험)(?:\s*\(\s*\d+%\s*\))?|선택형|서[·‧ㆍ]?논술형")
#: Signs without which no title that ``EXAMS`` names can be left after cleaning, which only takes signs away.
EXAM_SIGNS = "(?s)^(?:(?=.*고).*사|(?=.*시).*험|(?=.*[12]).*[차회]|(?=.*[선논]).*형)"
NO_PLAN_TITLES = (
    ("part", r"[.。]$"),
    ("part", r"(?:평가|반영)\s*비율|\d+\s*(?:점|%)$"),
    ("whole", r"통합과학[12]\s*전체|(?:정기\s*)?\d+\s*차\s*시험|중간|기말|[IVⅠⅡⅢⅣ]+"),
    ("whole", r"(?:프로젝트|포트폴리오|서술형|논술형|교사\s*관찰)\s*평가"),
    EXAMS,
    ("start", r"\[?\s*(?:10|12)[가-힣A-Za-zⅠ-Ⅹ]{1,6}\s*\d"),
    ("whole", r"[\d\s.,()%점배분/~-]+"),
)
NO_PLAN_NAMES = ("수행평가", "평가영역", "영역만점", "평가내용", "평가항목", "평가요소", "채점기준", "배점", "평소", "단원", "수준", "학습", "직무", "그외", "과학과", "점수점", "평가만점", "평가방법", "반영비율", "평가시기", "평가요소방법", "정기시험")
RUBRIC_END = r"(?:다|음|함|됨|경우)$"
RUBRIC_WORDS = r"부족|미흡|충족|만족|참여|제출|응시|모호|불명확|불충분|없음|않음|못함|요함|우수|노력|결석|보통|충분|정확|적절|근거|논리|오류|누락"

# Labels of table cells, compact.
TITLE_LABEL = r"평가영역(?:명|[1-9])?|수행평가(?:명|영역|과제명|과제)|수행과제(?:명)?|평가과제(?:명)?|과제명"
STOP_LABEL = r"영역?만점(?:점)?|총점|학기|반영비율|평가시기(?:횟수)?|평가방법\d*|평가단원|관련?성취기준|교육과정성취기준|평가요소(?:배점|채점요소)?|채점기준|세부기준|기본점수|배점|평가항목|평가내용(?:점수|및요소|평가방법)?|평가방식|평가만점|성취수준|처리기준|동점자처리기준순위|평가수준채점기준|점수부여기준|기준영역|구분|시기"
FIELD_LABELS = {
    "overview": ("평가개요", "평가내용", "수행과제", "과제내용"),
    "method": ("평가방법", "방법", "평가유형", "평가주체", "평가방식"),
    "timing": ("평가시기", "실시시기", "평가일시횟수", "시기"),
    "weight": ("점수반영비율", "반영비율", "평가비율"),
    "score": ("영역만점", "만점", "총점"),
}
OTHER_LABELS = ("성취기준", "평가기준", "평가요소", "세부기준", "부여점수", "관련단원", "영역")
COLUMN_LABELS = ("평가내용", "수행평가명", "수행평가영역", "수행평가과제", "평가영역", "평가과제", "과제명")
PLAN_COLUMNS = ("평가내용", "수행평가명", "수행평가영역", "평가영역", "과제명")
PLAN_LABELS = ("수행평가명", "수행평가과제명", "평가과제명", "과제명")
AREA_LABELS, AREA_SUPPORT = ("영역만점", "평가영역만점"), ("평가항목", "평가요소", "채점기준", "배점")
STRONG_LABELS = ("평가영역명", "평가영역", "영역만점", "수행평가명", "수행평가과제", "평가과제", "수행과제", "과제명")
EVIDENCE_LABELS = ("성취기준", "평가방법", "반영비율", "채점기준", "평가요소", "배점", "만점")
VALUE_TAIL = r"\s+(?:(?:영역\s*)?만점|학기)(?:\s|$)"

# Codes of standards by subject, their shape, and what a code must hold to be one.
CODE_PREFIXES = {
    "통합과학": "10통과", "과학탐구실험": "10과탐", "생명과학Ⅰ": "12생과Ⅰ", "생명과학Ⅱ": "12생과Ⅱ", "통합과학1": "10통과1", "과학탐구실험1": "10과탐1", "생명과학": "12생과",
    "생명과학실험": "12생실", "고급생명과학": "12고생",
}
CODE_SHAPE = r"\[\s*([^\[\]]{2,24})\s*-\s*\d"
CODE_SIGNS = "[^0-9A-Za-z가-힣ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]"
GRADED = r"^(?:10|12)"
RELIABLE = ("subject_heading", "subject_heading_exact", "zip_member_subject")


@dataclass(frozen=True)
class PlanWords:
    """The labels and codes by which tables of a plan are read."""

    title_label: str = TITLE_LABEL
    stop_label: str = STOP_LABEL
    fields: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(FIELD_LABELS))
    other_labels: tuple[str, ...] = OTHER_LABELS
    column_labels: tuple[str, ...] = COLUMN_LABELS
    plan_columns: tuple[str, ...] = PLAN_COLUMNS
    plan_labels: tuple[str, ...] = PLAN_LABELS
    area_labels: tuple[str, ...] = AREA_LABELS
    area_support: tuple[str, ...] = AREA_SUPPORT
    strong_labels: tuple[str, ...] = STRONG_LABELS
    evidence_labels: tuple[str, ...] = EVIDENCE_LABELS
    value_tail: str = VALUE_TAIL
    code_prefixes: dict[str, str] = field(default_factory=lambda: dict(CODE_PREFIXES))

    def labels(self) -> tuple[str, ...]:
        return (*(x for names in self.fields.values() for x in names), *self.other_labels)


PLANS = PlanWords()
