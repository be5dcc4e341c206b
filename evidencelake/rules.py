"""Domain vocabulary. Operators take it from a ``RulePack``; none is hard-wired elsewhere."""

from __future__ import annotations

from dataclasses import dataclass, field

# Subjects by curriculum bucket.
SUBJECTS = {
    "2015": ("통합과학", "과학탐구실험", "생명과학Ⅰ", "생명과학Ⅱ"),
    "2022": ("통합과학1", "과학탐구실험1", "생명과학"),
    "specialized": ("생명과학실험", "고급생명과학"),
}

# What may follow a subject's name as its number, and what must not.
ROMAN_1 = r"(?:\s*Ⅰ|\s*I(?!I))"
ROMAN_2 = r"(?:\s*Ⅱ|\s*II)"
DIGIT_1 = r"1(?!\d)"
DIGIT_2 = r"2(?!\d)"
FIRST = rf"(?:{ROMAN_1}|{DIGIT_1})"
SECOND = rf"(?:{ROMAN_2}|{DIGIT_2})"
PLAIN = rf"(?!{ROMAN_1})(?!{DIGIT_1})(?!{ROMAN_2})(?!{DIGIT_2})"

# Subject patterns, searched without regard to case.
SUBJECT_PATTERNS = (
    ("2015", "통합과학", rf"통합\s*과학{PLAIN}"),
    ("2015", "과학탐구실험", rf"과학\s*탐구\s*실험{PLAIN}"),
    ("2015", "생명과학Ⅰ", rf"생명\s*과학{FIRST}"),
    ("2015", "생명과학Ⅱ", rf"생명\s*과학{SECOND}"),
    ("2022", "통합과학1", r"통합\s*과학1(?!\d)"),
    ("2022", "과학탐구실험1", r"과학\s*탐구\s*실험1(?!\d)"),
    ("2022", "생명과학", rf"(?<!고급)(?<!고급\s)생명\s*과학{PLAIN}(?!\s*실험)"),
    ("specialized", "생명과학실험", r"생명\s*과학\s*실험"),
    ("specialized", "고급생명과학", r"고급\s*생명\s*과학"),
)

# File name aliases, the first that matches counts.
ALIASES = (
    ("고급생명과학", r"고급\s*생명\s*과학"),
    ("생명과학실험", r"생명\s*과학\s*실험"),
    ("생명과학Ⅱ", r"생명\s*과학\s*(?:Ⅱ|II|2)"),
    ("생명과학Ⅰ", r"생명\s*과학\s*(?:Ⅰ|I|1)"),
    ("생명과학", r"생명\s*과학(?!\s*[ⅠⅡI12])"),
    ("과학탐구실험1", r"과학\s*탐구\s*실험\s*[ⅠI1]"),
    ("과학탐구실험", r"과학\s*탐구\s*실험(?!\s*[ⅠⅡI12])"),
    ("통합과학1", r"통합\s*과학\s*[ⅠI1]"),
    ("통합과학", r"통합\s*과학(?!\s*[ⅠⅡI12])"),
    ("과학", r"과학"),
)

# Achievement code keys of subjects.
CODE_KEYS = {
    "통합과학": "통과", "과학탐구실험": "과탐", "생명과학Ⅰ": "생과Ⅰ", "생명과학Ⅱ": "생과Ⅱ", "통합과학1": "통과1",
    "과학탐구실험1": "과탐1", "생명과학": "생과", "생명과학실험": "생실", "고급생명과학": "고생",
}

# Markers of assessment content, counted in a section.
MARKERS = {
    "performance_assessment": r"수행\s*평가",
    "rubric": r"평가\s*기준|채점\s*기준|루브릭",
    "achievement_standard": r"성취\s*기준",
    "weight_or_points": r"반영\s*비율|배점",
    "assessment_method": r"평가\s*방법|평가\s*요소",
}

# Marker name, most occurrences that count, points for each.
SCORE_CAPS = (("performance_assessment", 3, 3), ("rubric", 3, 2), ("achievement_standard", 3, 2), ("weight_or_points", 2, 1), ("assessment_method", 2, 2))

# Action tags and their patterns.
ACTION_TAGS = {
    "탐구": r"탐구(?:\s*(?:보고서|활동|과제))?", "프로젝트": r"프로젝트", "문제해결": r"문제\s*해결", "생태조사": r"생태\s*조사|야외\s*(?:조사|관찰)", "발표": r"발표",
    "토론": r"토론", "포트폴리오": r"포트폴리오", "보고서": r"보고서", "제작": r"제작", "실험": r"실험",
}
TASK_CONTEXT = r"수행\s*평가|평가\s*(?:영역|과제|내용|방법)|영역\s*명|과제\s*명|활동\s*명|채점\s*기준"
TICKED, EMPTY = "■☑☒✓✔", "□☐"

# Headings that bound sections.
COURSE_HEADER = r"(?im)^(?:#{1,6}\s*)?\d{4}\s*학년도[^\n]{0,180}(?:교수\s*[·ㆍ‧/\-]?\s*학습|교수학습)[^\n]{0,100}평가\s*계획[^\n]*$"
TASK_SECTION = r"(?im)^(?:#{1,6}\s*)?(?:[가-힣0-9]+[.)]?\s*)?수행\s*평가\s*(?:세부\s*)?(?:계획|기준|내용|방법|채점)[^\n]*$"
TABLE_SECTION = r"(?im)^(?:#{1,6}\s*)?(?:[가-힣0-9]+[.)]?\s*)?평가\s*영역\s*및\s*반영\s*비율[^\n]*$"
OTHER_SECTION = r"(?im)^(?:#{1,6}\s*)?(?:\d+|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+)[.)]\s*(?:결시|학적|평가\s*결과|성적|최소\s*성취|기타)[^\n]*$"
TASK_ITEM = r"(?m)^\s*(?:#{1,6}\s*)?[가나다라마바사아자차카타파하][.)]\s*([^\n<]{2,100})\s*$"
NO_TASK = r"결시|학적|처리|성취\s*수준|평가\s*결과|유의\s*사항"
ANCHORS = r"수행\s*평가|평가\s*(?:계획|방법|기준|요소|영역)|채점\s*기준|성취\s*기준|반영\s*비율|배점|루브릭"
ANCHOR_GROUPS = (r"수행\s*평가", r"평가\s*영역|영역\s*명|과제\s*명|활동\s*명", r"평가\s*기준|채점\s*기준|루브릭", r"반영\s*비율|배점", r"성취\s*기준", r"평가\s*방법|평가\s*요소")
JUMP = "\n\n[...문맥 전환...]\n\n"

# Masks of personal data, in order.
MASKS = (
    (r"\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b", "[이메일]"),
    (r"(?<!\d)01[0-9][-\s]?\d{3,4}[-\s]?\d{4}(?!\d)", "[전화번호]"),
    (r"(?<!\d)\d{6}[-\s]?[1-4]\d{6}(?!\d)", "[식별번호]"),
)

# A sign without which a mask's pattern does not occur; texts without it are not searched.
MASK_SIGNS = {MASKS[0][0]: "@"}

# Ranks of extraction results.
STATUS_RANK = {"ok": 4, "short": 3, "failed": 2, "missing": 1}


@dataclass(frozen=True)
class RulePack:
    """One domain's vocabulary."""

    subjects: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SUBJECTS))
    subject_patterns: tuple[tuple[str, str, str], ...] = SUBJECT_PATTERNS
    aliases: tuple[tuple[str, str], ...] = ALIASES
    code_keys: dict[str, str] = field(default_factory=lambda: dict(CODE_KEYS))
    markers: dict[str, str] = field(default_factory=lambda: dict(MARKERS))
    score_caps: tuple[tuple[str, int, int], ...] = SCORE_CAPS
    action_tags: dict[str, str] = field(default_factory=lambda: dict(ACTION_TAGS))
    task_context: str = TASK_CONTEXT
    course_header: str = COURSE_HEADER
    task_section: str = TASK_SECTION
    table_section: str = TABLE_SECTION
    other_section: str = OTHER_SECTION
    task_item: str = TASK_ITEM
    no_task: str = NO_TASK
    anchors: str = ANCHORS
    anchor_groups: tuple[str, ...] = ANCHOR_GROUPS
    masks: tuple[tuple[str, str], ...] = MASKS
    mask_signs: dict[str, str] = field(default_factory=lambda: dict(MASK_SIGNS))

    def groups(self) -> list[tuple[str, str]]:
        """(curriculum, subject) of all subjects, in configured order."""
        return [(c, s) for c, names in self.subjects.items() for s in names]

    def buckets(self, subject: str) -> list[str]:
        return [c for c, names in self.subjects.items() if subject in names]


PLANS_KO = RulePack()

#: Words that occur in the driver's tables, so that the same operators can be held against SQL there.
DRIVER = RulePack(
    subjects={"latin": ("es", "fr"), "german": ("de", "en")},
    subject_patterns=(("latin", "es", r"ción"), ("latin", "fr", r"eaux"), ("german", "de", r"keit"), ("german", "en", r"tion")),
    markers={"performance_assessment": r"the", "rubric": r"and|der|les", "achievement_standard": r"of", "weight_or_points": r"in|an", "assessment_method": r"to"},
    action_tags={"license": r"[Ll]icense", "table": r"\|", "shout": r"!!"},
    anchors=r"license",
    task_context=r"the",
    masks=((r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_.-]+\.[A-Za-z]{2,}", "[mail]"),),
    mask_signs={r"[A-Za-z0-9_.+-]+@[A-Za-z0-9_.-]+\.[A-Za-z]{2,}": "@"},
)
