"""Word lists, score tables and thresholds.

Everything here is plain data that results depend on, so it is stated in full
and in its natural order. The engines that use it live elsewhere.
"""

# --- domain classifiers (fixed values; order matters, first hit wins) --------

# Titles of landed datasets, compared in lower case.
DOMAIN_WORDS_LANDING = [
    ("population", ["人口", "世帯", "出生", "死亡", "国勢調査", "人口動態"]),
    ("labor", ["労働", "雇用", "賃金", "給与", "就業", "失業", "労働力"]),
    ("education", ["教育", "学校", "学生", "生徒", "児童", "教員", "大学"]),
    ("health", ["保健", "医療", "患者", "病院", "診療所", "疾病", "健康"]),
    ("agriculture", ["農業", "林業", "漁業", "農林", "水産", "農家", "漁獲"]),
    ("construction", ["建設", "建築", "住宅", "着工", "土地", "不動産"]),
    ("transport", ["運輸", "輸送", "交通", "通信", "自動車", "鉄道", "航空"]),
    ("trade", ["商業", "小売", "卸売", "サービス", "飲食", "宿泊"]),
    ("social_welfare", ["福祉", "介護", "保育", "年金", "社会保障", "生活保護"]),
    ("economy", ["経済", "gdp", "産業", "企業", "事業所", "家計", "消費", "景気"]),
]

# Titles of the full listing, compared as written.
DOMAIN_WORDS_LISTING = [
    ("population", ["人口", "国勢調査", "世帯"]),
    ("labor", ["労働", "雇用", "賃金", "就業"]),
    ("economy", ["経済", "GDP", "景気", "物価", "消費"]),
    ("education", ["教育", "学校", "学生", "生徒"]),
    ("health", ["医療", "健康", "病院", "診療"]),
    ("agriculture", ["農業", "林業", "水産", "農林"]),
    ("construction", ["建設", "建築", "住宅", "着工"]),
    ("transport", ["運輸", "交通", "輸送", "鉄道", "自動車"]),
    ("trade", ["商業", "小売", "卸売", "貿易"]),
    ("social_welfare", ["福祉", "介護", "年金", "社会保障"]),
]

# Title or search keyword of a catalog entry, compared in lower case.
DOMAIN_WORDS_CATALOG = [
    ("population", ["人口", "国勢調査", "人口推計"]),
    ("labor", ["労働", "雇用", "賃金", "勤労"]),
    ("economy", ["経済", "gdp", "産業連関", "景気"]),
    ("price", ["物価", "消費者物価"]),
    ("household", ["家計", "消費", "支出"]),
    ("education", ["学校", "教育", "児童", "生徒"]),
    ("housing", ["住宅", "土地", "建物"]),
]

# --- title words (fixed values) ---------------------------------------------

FREQUENCY_WORDS = [
    ("monthly", ["月次", "月報"]),
    ("quarterly", ["四半期"]),
    ("yearly", ["年次", "年報"]),
]
CORE_STATISTICS_WORDS = ["基幹統計", "基本集計"]
FREQUENT_WORDS = ["月次", "四半期", "月報"]
RECENT_FROM = "2023-01-01"
COVERAGE_WORDS = ["全国", "総合", "全体", "全て"]
FREQUENCY_POINTS = [("月次", 30), ("月報", 30), ("四半期", 20), ("年次", 10), ("年報", 10)]
TIME_WORDS = ["年", "月", "四半期", "時系列", "推移"]

# --- keyword extraction (fixed values) --------------------------------------

KEYWORD_STOPWORDS = [
    "について", "に関する", "による", "など",
    "その他", "全国", "都道府県", "市区町村",
    "に係る", "における", "に関して",
]
SIMPLE_KEYWORD_STOPWORDS = [
    "について", "に関する", "による", "など", "その他", "全国",
    "に係る", "における", "の", "を", "が", "は", "で", "と",
]
CATEGORY_KEYWORDS = ["人口", "経済", "労働", "教育", "医療", "農業", "建設", "運輸", "商業", "福祉"]
ENGLISH_KEYWORDS = {
    "人口": "population", "労働": "labor", "雇用": "employment", "賃金": "wage",
    "経済": "economy", "GDP": "gdp", "産業": "industry",
    "教育": "education", "学校": "school", "学生": "student",
    "医療": "healthcare", "病院": "hospital", "患者": "patient",
    "農業": "agriculture", "漁業": "fishery",
    "建設": "construction", "住宅": "housing",
    "運輸": "transport", "交通": "traffic",
    "商業": "commerce", "小売": "retail",
    "福祉": "welfare", "介護": "care",
    "都道府県": "prefecture", "市区町村": "municipality",
    "年度": "year", "月次": "monthly", "四半期": "quarter",
}
DOMAIN_SEARCH_KEYWORDS = [
    ("population", ["人口", "世帯", "出生", "死亡", "国勢調査", "人口動態", "人口統計"]),
    ("labor", ["労働", "雇用", "賃金", "給与", "就業", "失業", "労働力", "労働時間"]),
    ("economy", ["経済", "GDP", "産業", "企業", "事業所", "家計", "消費", "景気"]),
    ("education", ["教育", "学校", "学生", "生徒", "児童", "教員", "大学"]),
    ("health", ["保健", "医療", "患者", "病院", "診療所", "疾病", "健康"]),
    ("agriculture", ["農業", "林業", "漁業", "農林", "水産", "農家", "漁獲"]),
    ("construction", ["建設", "建築", "住宅", "着工", "土地", "不動産"]),
    ("transport", ["運輸", "輸送", "交通", "通信", "自動車", "鉄道", "航空"]),
    ("trade", ["商業", "小売", "卸売", "サービス", "飲食", "宿泊"]),
    ("social_welfare", ["福祉", "介護", "保育", "年金", "社会保障"]),
]

# --- search (fixed values) ----------------------------------------------------

QUERY_EXPANSIONS = [
    ("人口", ["人口", "世帯", "国勢調査", "population"]),
    ("労働", ["労働", "雇用", "就業", "失業", "labor", "employment"]),
    ("経済", ["経済", "GDP", "景気", "economy"]),
    ("教育", ["教育", "学校", "生徒", "education"]),
    ("医療", ["医療", "健康", "病院", "health"]),
    ("農業", ["農業", "農家", "agriculture"]),
    ("工業", ["工業", "製造", "industry"]),
    ("商業", ["商業", "小売", "commerce"]),
]
QUERY_SUGGESTIONS = [
    ("人口", ["世帯", "国勢調査", "人口動態", "人口推計"]),
    ("労働", ["雇用", "就業", "失業率", "賃金"]),
    ("経済", ["GDP", "景気動向", "物価", "消費"]),
    ("教育", ["学校", "生徒数", "教員", "進学率"]),
    ("医療", ["病院", "患者", "医療費", "健康"]),
    ("農業", ["農家", "作物", "農業生産", "農地"]),
    ("工業", ["製造業", "生産額", "工場", "出荷額"]),
    ("商業", ["小売", "卸売", "販売額", "店舗"]),
    ("統計", ["人口統計", "経済統計", "労働統計", "調査データ"]),
    ("データ", ["統計データ", "調査データ", "集計データ"]),
]
FALLBACK_SUGGESTIONS = ["人口統計", "労働統計", "経済統計", "教育統計"]
RELATED_DATA_SUFFIX = "関連データ"

# --- error classes (fixed values; order matters) ----------------------------
# (type, words in the message, words in the class name)
ERROR_WORDS = [
    ("timeout_error", ["timeout"], ["timeout"]),
    ("network_error", ["connection", "network", "unreachable"], ["connectionerror"]),
    ("api_error", ["api"], ["api"]),
    ("data_error", ["json", "parse", "format", "invalid"], []),
    ("validation_error", ["validation"], ["validation"]),
    ("storage_error", ["s3", "storage", "bucket"], []),
]
RETRYABLE_ERRORS = ["api_error", "network_error", "timeout_error", "storage_error"]

# --- dimension items (fixed values) -------------------------------------------
TOTAL_ITEM_WORDS = ["_計", "_合計", "総数", "全体"]
AREA_DIMENSION_WORDS = ["地域", "都道府県"]
TIME_DIMENSION_WORDS = ["年", "時間", "調査年"]
TIME_COLUMN_WORDS = ["time", "year", "年", "年度", "年月", "date", "日付"]
ALL_PREFECTURES = 47

FIELD_DESCRIPTIONS = {
    "@time": "時間軸", "@area": "地域コード",
    "@cat01": "分類1", "@cat02": "分類2", "@cat03": "分類3", "@cat04": "分類4", "@cat05": "分類5",
    "@unit": "単位", "$": "統計値",
}

# --- costs, sizes, targets (fixed values) ---------------------------------------
STORAGE_USD_PER_GB = 0.025
SCAN_USD_PER_TB = 5.0
TRANSFER_USD_PER_GB = 0.114
BYTES_PER_RECORD = 1024
LATENCY_TARGETS_MS = {"catalog_search": 100.0, "sql": 5000.0}
CHUNK_SIZE = 100_000
STALE_DAYS = 30
VERY_STALE_DAYS = 90
MIN_DATASETS_PER_DOMAIN = 3
