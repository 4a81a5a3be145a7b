"""Fixed values and default parameters.

Every function that uses one of these takes it as a parameter, so another locale or news
source only needs other arguments.
"""

# --- fixed values: names that stand in for missing reporters and publishers -------------
DEFAULT_PUBLISHER = "네이버뉴스"
DEFAULT_REPORTER = "익명"
ANONYMOUS_PREFIX = "익명기자_"
INVALID_NAMES = ["", " ", "익명", "기자", "사용자", "-", "_"]
MIN_NAME_LENGTH = 2
MIN_PUBLISHER_LENGTH = 2

# --- fixed values: byline and reporter-card words ----------------------------------------
REPORTER_SUFFIX = "기자"
JOB_TITLES = ["기자", "인턴기자", "인턴", "캐스터", "기상캐스터", "PD", "리포터", "편집장", "외신캐스터"]

# --- fixed values: accepted links and article limits ---------------------------------------
LINK_FRAGMENT = "news.naver.com"
URL_PREFIXES = ["https://n.news.naver.com", "https://m.entertain.naver.com"]
MOBILE_PATH = "/mnews/article/"
CANONICAL_PATH = "/article/"
MIN_TITLE_LENGTH = 9
MIN_CONTENT_LENGTH = 100
MAX_CONTENT_LENGTH = 700
MIN_SCORE = 0
MAX_SCORE = 100
LOCAL_ZONE = "Asia/Seoul"
LOCAL_OFFSET_HOURS = 9

# --- fixed values: keywords -------------------------------------------------------------------
DEFAULT_KEYWORDS = [
    "논란", "충격", "경악", "발칵", "깜짝", "SNS", "화들짝", "화제", "네티즌들은", "온라인 커뮤니티",
]
VAGUE_PRONOUNS = ["이것", "저것", "그것"]
SENSATIONAL_WORDS = ["충격", "경악", "발칵"]
KEYWORD_PUNCTUATION = ".,'\"-+?!/()[]{}:;&%@#*^$_=~`\\"
TREND_LIMIT = 5
ITEMS_PER_KEYWORD = 1000

# --- fixed values: scoring ---------------------------------------------------------------------
TOP_SCORES = 10
STORED_AVG_TOLERANCE = 0.01
EXPLANATION_LIMIT = 500
DEFAULT_EXPLANATION = "자동 생성된 점수"
CUSTOM_ID_PREFIX = "article_"
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
REQUEST_MODEL = "gpt-4o-mini"
MAX_BATCH_SIZE = 800
SCORE_FIELD = "clickbait_score"
EXPLANATION_FIELD = "clickbait_explanation"
SCHEMA_NAME = "clickbait_evaluation"
SCORE_BANDS = [(0, 20), (21, 40), (41, 60), (61, 80), (81, 100)]

# --- fixed values: batch states and the moves allowed between them ------------------------------
STATUS_MOVES = {
    "in_progress": ["completed", "failed", "cancelled"],
    "completed": ["completed"],
    "failed": ["failed", "in_progress"],
    "cancelled": ["cancelled"],
}

# --- defaults of this project: wording of the scoring request ------------------------------------
SYSTEM_MESSAGE = (
    "뉴스 제목이 본문에 비해 얼마나 과장되었는지 0에서 100 사이의 정수로 채점하고 근거를 설명하세요."
)
PROMPT_TEMPLATE = (
    "아래 기사 제목이 본문을 얼마나 왜곡하거나 과장하는지 평가하세요. 점수는 0(정확함)부터 "
    "100(본문과 무관함)까지의 정수입니다.\n\n제목: {title}\n\n본문: {content}"
)

# --- defaults of this project: table layout ---------------------------------------------------------
JOURNALIST_BUCKETS = 64
URL_BUCKETS = 1024
