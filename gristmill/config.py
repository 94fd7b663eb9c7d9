"""Settings as one frozen object; nothing reads the environment or module state, so a sweep is a column of settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# Vocabularies and limits that must be as they are for equal results.
CORE = tuple("태권도 태권 겨루기 품새 격파 발차기 도복 검은띠 국기원 세계태권도연맹 태권도협회 시범단 태권도장 도장 승품심사 승단심사 단증 품증 사범 관장 유단자 수련생 공인단 겨루기장 품새복".split())
GENERIC = tuple("협회 연맹 지도자 심판 대회 선수권 챔피언십 올림픽 아시안게임 전국체전 예선 결선 금메달 은메달 동메달 우승 준우승 입상 선수 국가대표 대표팀 감독 코치 시범 공연 훈련 수련 합동훈련 교류 보급 협약 체결".split())
CRIME = tuple("불법촬영 몰카 성추행 강제추행 성폭행 성폭력 성착취 성범죄 음란물 성희롱 아동학대 노인학대 동물학대 학대혐의 학대의혹 학대정황 폭행 감금 협박 가혹행위 마약 음주운전 뺑소니 상해죄 사기혐의 사기죄 횡령 배임 징역 구형 실형 집행유예 기소 구속영장 송치 입건 체포 피의자 유죄 선고공판 신상공개 혐의".split())
DISPUTE = tuple("징계 항소심 소송 가처분 고소 고발 제명 직무정지 자격정지 비리 법정공방 사퇴촉구 집단행동 갈등".split())
PARTICLES = tuple("으로서 에서는 으로는 이라는 라는 에게 에서 으로 이나 까지 부터 에서도 에도 마다 처럼 보다 조차 밖에 은 는 이 가 을 를 의 에 와 과 도 만 로".split())
STOPWORDS = tuple(
    "이번 지난 올해 내년 작년 현재 최근 당시 오늘 내일 그동안 앞으로 이날 이후 이전 가운데 관련 통해 위해 대해 따라 면서 라며 라고 했다 이라고 있다 없다 된다 "
    "우리 저희 자신 모두 각각 여러 다른 같은 많은 새로운 경우 때문 정도 수준 방법 내용 부분 결과 과정 상황 이라며 밝혔다 말했다 전했다 덧붙였다 설명했다 강조했다 "
    "기자 특파원 뉴스 기사 보도 취재 인터뷰 본보 연합뉴스 오전 오후 예정 계획 진행 개최 실시 참가 참여 출전 지역 국내 해외 전국 서울 정부 시장 군수 시청 군청 "
    "이상 이하 미만 초과 약간 매우 정말 특히 또한 그리고 세계 경쟁력 대표 오는 지난해 당일 행사 개최지 관계자 가능성 필요성 중요성 역할 의미 가치 "
    "문화 교육 사업 지원 운영 추진 협력 구축 확대".split()
)
VERB_TAIL = "(?:했다|한다|하는|하고|하며|해서|이다|되다|된다|되는|됐다|있는|있다|없는|없다|였다|이라|으로|위한|위해|대한|따른|같은|다른|많은|모든|도록|면서|지만|는데|으며|어야|아야|고자|려고|거나|까지|부터|마다|처럼|조차)$"
CAPTION_TAGS = tuple("포토 사진 화보 영상 카드뉴스 그래픽 만평".split())


@dataclass(frozen=True)
class Vocabulary:
    core: tuple[str, ...] = CORE
    generic: tuple[str, ...] = GENERIC
    crime: tuple[str, ...] = CRIME
    stem: str = "태권"
    token: str = "[가-힣]{2,5}"
    signature: str = r"[가-힣]{2,6}|[A-Za-z]{2,}|\d{4}"
    particles: tuple[str, ...] = PARTICLES
    stopwords: tuple[str, ...] = STOPWORDS
    verb_tail: str = VERB_TAIL


#: Words of the Latin-script test tables, so that every branch is taken there.
LATIN = Vocabulary(
    core=("tion", "ment", "keit", "ción", "erin", "ingst"),
    generic=("the", "der", "les", "que", "and", "und"),
    crime=("thblest", "ndstnt", "ofreea", "réeuxch", "achlichau"),
    stem="tion",
    token="[a-z]{2,}",
    signature="[a-z]{2,}",
    particles=("ing", "ed"),
    stopwords=("the", "and", "of", "to", "in"),
    verb_tail="(?:tion|ly)$",
)


@dataclass(frozen=True)
class Gate:
    """Limits of the topic gate, in the order in which it looks at them."""

    incident_body_hits: int = 3
    body_chars: int = 250
    core_types: int = 3
    core_spans: int = 1
    mentions: int = 4
    density_from_chars: int = 600
    core_density: float = 0.8
    core_density_untitled: float = 2.0
    mention_density: float = 1.5
    mention_density_untitled: float = 3.0
    domain_hits: int = 5
    domain_hits_untitled: int = 8


@dataclass(frozen=True)
class Events:
    """When two records tell of the same event, and what a signature holds."""

    jaccard: float = 0.15
    overlap: float = 0.5
    shared: int = 15
    frequent_share: float = 0.5
    frequent_least: int = 3
    cluster_bonus: float = 0.35
    cluster_bonus_most: float = 1.5


@dataclass(frozen=True)
class Trend:
    keywords: int = 15
    least_documents: int = 2
    domain_weight: float = 2.0
    title_bonus: float = 1.5


@dataclass(frozen=True)
class Config:
    words: Vocabulary = field(default_factory=Vocabulary)
    gate: Gate = field(default_factory=Gate)
    events: Events = field(default_factory=Events)
    trend: Trend = field(default_factory=Trend)
