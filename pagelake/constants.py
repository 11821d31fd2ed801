"""Words, patterns and limits that results depend on.

Everything in this module is data, not logic.  The values have to be exactly
these for the extracted records to come out right.  Patterns are written in
Java dialect: ``(?iu)`` folds Cyrillic letters, ``(?U)`` makes ``\\s`` Unicode aware.
Patterns for page text need no ``(?U)``: its whitespace is already evened out.
"""

# ---- versions carried on every record -------------------------------------
PARSER_VERSION = "0.5.0"
SCHEMA_VERSION = "1"
STATE_PAYLOAD_VERSION = 1

# ---- text, numbers, money --------------------------------------------------
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
INTEGER = r"(?U)[0-9][0-9\s]*"
DECIMAL = r"(?U)-?[0-9][0-9\s]*(?:[.,][0-9]+)?"
AMOUNT = r"[0-9][0-9\s]*(?:[.,][0-9]+)?"
UP_TO_LAST_CURRENCY = r"(?isu)^(.*(?:₽|руб(?:\.|лей|ля)?|\$|usd|€|eur))"
NEGOTIABLE_WORD = "договор"
INTERVIEW_WORD = "собеседован"

# ---- Russian dates ---------------------------------------------------------
MONTHS_GENITIVE = [
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
]
MONTHS_ENGLISH = [
    "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
]
TODAY_WORD = "сегодня"
YESTERDAY_WORD = "вчера"
CLOCK = r"(\d{1,2}):(\d{2})"
ABSOLUTE_DATE = r"(\d{1,2})\s+([а-яё]+)(?:\s+(\d{4}))?(?:[^\d]+(\d{1,2}):(\d{2}))?"
RELATIVE_DATE = r"(\d+)\s+(минут[\wа-яё]*|час[\wа-яё]*|дн[\wа-яё]*|день|дня|недел[\wа-яё]*|месяц[\wа-яё]*)\s+назад"
SECONDS_PER_UNIT = [  # word start, seconds; a month is 30 days
    ("минут", 60),
    ("час", 3_600),
    ("дн", 86_400),
    ("ден", 86_400),
    ("недел", 604_800),
    ("месяц", 2_592_000),
]
DEFAULT_TIMEZONE = "Europe/Moscow"

# ---- URLs ------------------------------------------------------------------
PROJECT_PATH = r"/projects/(\d+)(?:(?:/[^?#]*)?\.html|/)?(?:[?#].*)?$"
USER_PATH = r"/users/([^/?#]+)/?(?:[^?#]*)?$"
USER_LINK = r"/users/[^/?#]+/?"
PERSON_HREF = r"^/users/[^/?#]+/?$"
CATEGORY_HREF = "/projects/category/"
CATEGORY_SLUG = r"/projects/category/(.+?)/?$"
PAGE_IN_PATH = r"/page-(\d+)/?"
SECRET_QUERY = r"(?i)(token|key|password|secret|signature)=([^&]+)"
UNSAFE_FILE_CHARS = r"[^a-zA-Z0-9_.-]+"
FAILURE_KEY_LENGTH = 160
BLOCKED_BODY_BYTES = 1_000_000
SENSITIVE_HEADERS = ["authorization", "cookie", "set-cookie", "proxy-authorization"]

# ---- response classification ----------------------------------------------
STRONG_BLOCK_MARKERS = [
    "g-recaptcha",
    "hcaptcha",
    "captcha-container",
    "cf-chl-",
    "challenge-platform",
    "<title>access denied",
    "<title>доступ ограничен",
]
BLOCK_URL_WORDS = ["captcha", "challenge", "blocked"]
AUTH_MARKERS = ["необходимо авторизоваться", "войдите в аккаунт"]
SUSPICIOUS_STATUSES = [403, 429, 503]
RETRY_STATUSES = [408, 425, 429, 500, 502, 503, 504]

# ---- listing cards ---------------------------------------------------------
PROJECT_CARD_CLASSES = ["b-post", "project-card", "project", "catalog-item"]
PROJECT_CARD_DATA_ID = "qa-lenta-"
PEOPLE_CARD_CLASS = r"(?i)(?:freelancer|user-card|b-user|catalog-item)"
PEOPLE_CARD_MARKERS = ["опыт:", "портфолио:", "отзыв", "предложить заказ", "сроки и цены"]
NEXT_LABEL = "след"
CATALOG_END_MARKERS = ["ничего не найдено", "нет проектов", "заказов не найдено"]
DESCRIPTION_STOP_WORDS = ["откликнуться", "ответов", "больше 300"]
DETAIL_STOP_WORDS = [
    "зарегистрирован:",
    "информация о заказчике",
    "посмотреть другие заказы",
    "выберите способ верификации",
]
BUDGET_FALLBACKS = [
    r"(?iu)(?:от\s+)?\d[\d\s]*(?:\s*[₽$€]|\s*(?:руб(?:лей|ля|ль)?|USD|EUR))"
    r"(?:\s*[–-]\s*\d[\d\s]*(?:\s*[₽$€]|\s*(?:руб(?:лей|ля|ль)?|USD|EUR)))?",
    r"(?iu)по договоренности",
    r"(?iu)по результатам собеседования",
]
PUBLISHED_PATTERNS = [
    r"(?iu)(?:сегодня|вчера)[^\n]{0,20}\d{1,2}:\d{2}",
    r"(?iu)\d{1,2}\s+[А-Яа-яЁё]+(?:\s+\d{4})?[^\n]{0,20}\d{1,2}:\d{2}",
    r"(?iu)\d+\s+(?:минут[\wа-яё]*|час[\wа-яё]*|дн[\wа-яё]*|недел[\wа-яё]*)\s+назад",
]

# ---- kinds, statuses and their words ----------------------------------------
KIND_WORDS = [("вакансия", "vacancy"), ("конкурс", "contest"), ("заказ", "order"), ("проект", "order")]
STATUS_WORDS = [
    ("исполнитель определ", "executor_selected"),
    ("исполнитель выбран", "executor_selected"),
    ("закрыт", "closed"),
    ("завершен", "closed"),
    ("завершён", "closed"),
    ("откликнуться", "open"),
]
KINDS = ["order", "vacancy", "contest"]
KIND_CODES = {"order": "1", "vacancy": "2", "contest": "3"}
KIND_ALIASES = {
    "order": "order", "orders": "order", "заказ": "order", "заказы": "order", "1": "order",
    "vacancy": "vacancy", "vacancies": "vacancy", "вакансия": "vacancy", "вакансии": "vacancy",
    "2": "vacancy",
    "contest": "contest", "contests": "contest", "конкурс": "contest", "конкурсы": "contest",
    "3": "contest",
}

# ---- labelled values in page text (pattern, group 1 is the value) -----------
LABELS = {
    "responses": r"(?iu)(\d+)\s+ответ",
    "views": r"(?iu)((?:больше\s+)?\d+\s+(?:просмотр|$))",
    "location": r"(?iu)(?:Вакансия|Заказ)\s*\(([^)]+)\)",
    "budget": r"(?iu)Бюджет:\s*([^\n]+)",
    "published": r"(?iu)Опубликован(?:о)?\s+([^\n]+)",
    "updated": r"(?iu)Последнее изменение:\s*([^\n]+)",
    "experience": r"(?iu)Опыт:\s*([^\n]+)",
    "portfolio_count": r"(?iu)Портфолио:\s*(\d+)\s+работ",
    "reviews_count": r"(?iu)(\d+)\s+отзыв",
    "people_rating": r"(?iu)Рейтинг\s*[:]?\s*([\d\s.,]+)",
    "registered": r"(?iu)На сайте\s+([^\n(]+)",
    "last_seen": r"(?iu)\((?:заходил|заходила)\s+([^)]+)\)",
    "rating": r"(?iu)Рейтинг\s+([\d\s.,]+)",
    "safe_deals": r"(?iu)Безопасные сделки\s+(\d+)",
    "tab_all": r"(?iu)Все\s*\((\d+)\)",
    "tab_vacancies": r"(?iu)Вакансии\s*\((\d+)\)",
    "tab_contests": r"(?iu)Конкурсы\s*\((\d+)\)",
}
REVIEW_COUNTS = [
    r"(?iu)Отзывы\s*\+?\s*(\d+)\s*-\s*(\d+)",
    r"\+\s*(\d+)\s*-\s*(\d+)",
]
TITLE_PERSON = r"(?iu)(?:Заказчик|Фрилансер)\s+(.+?)\s+ID:\s*(\d+)"
TITLE_ROLES = [("заказчик", "customer"), ("фрилансер", "freelancer")]
TITLE_PLACE = r"(?iu)\Q{site}\E,\s*(.+?)(?:\s*\(|$)"
EXECUTOR_MARKER = r"(?iu)Заказчик выбрал исполнителя"
SENTIMENTS = [(r"(?iu)отрицат|минус", "negative"), (r"(?iu)положит|плюс", "positive")]
VERIFIED_WORD = "верифиц"
VERIFIED_TEXT = r"(?iu)верифицирован"
ATTACHMENT_URL = r"(?i)\.(?:pdf|docx?|xlsx?|zip|rar|7z|png|jpe?g)(?:\?|$)"

# ---- structure signals ------------------------------------------------------
CLASS_TOKEN_LENGTH = 40
VOLATILE_CLASS = r"\d{4,}|[a-f0-9]{10,}"

# ---- health and latency ------------------------------------------------------
FAILURE_CATEGORIES = {
    "blocked": "blocked",
    "auth_required": "authentication_required",
    "empty_page": "empty_page",
    "selector_drift": "selector_drift",
}
LATENCY_SAMPLES = 1_000
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
CONFIDENCE_ITEMS = 1.0
CONFIDENCE_END = 0.8
CONFIDENCE_EMPTY = 0.2
CONFIDENCE_THRESHOLD = 0.75
