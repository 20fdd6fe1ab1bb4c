"""Word lists and labels that results depend on, and rules over them.

The values in this module are fixed values: changing one changes what is kept, tagged or reported.
"""

# --- fixed values: relevance -------------------------------------------------------------------------

SEMANTIC_TERMS = (
    "robtaxi", "robotaxi", "driverless taxi", "self-driving taxi", "autonomous taxi", "autonomous vehicle", "autonomous truck",
    "driverless truck", "driverless car", "self-driving car", "autonomous car", "无人驾驶", "自动驾驶", "无人驾驶货车", "自动驾驶货车",
    "智能网联汽车", "无人驾驶汽车", "网约车", "车队", "示范运营", "示范应用", "许可", "准入", "监管", "道路测试", "上路许可", "牌照管理",
    "征求意见稿", "通行管理", "l3", "l4", "level 3", "level 4", "icv", "deployment permit", "testing permit", "driverless testing",
    "rulemaking", "public comment", "disengagement report", "operational design domain", "commercial motor vehicle",
)
KNOWN_COMPANY_ALIASES = (
    "小鹏", "小鹏汽车", "xpeng", "waymo", "tesla", "cybercab", "pony.ai", "pony ai", "小马智行", "weride", "文远知行", "apollo go",
    "萝卜快跑", "百度apollo", "百度 apollo", "momenta",
)
STRATEGIC_COMPANIES = (
    "小鹏", "小鹏汽车", "xpeng", "waymo", "tesla", "cybercab", "pony.ai", "pony ai", "小马智行", "weride", "文远知行", "apollo go",
    "萝卜快跑", "百度apollo", "百度 apollo",
)
STRATEGIC_AUTONOMY = ("robotaxi", "无人驾驶出租车", "自动驾驶出租车", "l4", "l3", "无人驾驶汽车", "自动驾驶")
STRATEGIC_TITLE_AUTONOMY = ("robotaxi", "l4", "l3", "无人驾驶出租车", "自动驾驶出租车")
STRATEGY_SIGNALS = (
    "直奔", "跳过", "落地", "部署", "推进", "量产", "商业化", "战略", "路线", "规划", "试运营", "示范运营", "deploy", "deployment",
    "commercialize", "commercialization", "strategy", "roadmap", "rollout", "launch", "scale", "l4 strategy", "robotaxi push",
)
SAFETY_ENTITIES = (
    "momenta", "waymo", "tesla", "pony.ai", "pony ai", "weride", "文远知行", "百度apollo", "百度 apollo", "apollo go", "mobileye", "zoox",
    "cruise",
)
SAFETY_AUTONOMY = ("自动驾驶", "智能驾驶", "无人驾驶", "robotaxi")
SAFETY_MILESTONES = (
    "功能安全", "安全认证", "最高等级", "asil d", "安全机制", "安全中间件", "functional safety", "safety certification", "safety case",
    "safety middleware",
)
SAFETY_TITLE = ("asil d", "安全认证")
AUTONOMY_CONTEXT = (
    "无人驾驶", "自动驾驶", "robotaxi", "robtaxi", "autonomous", "self-driving", "driverless", "智能网联汽车", "无人驾驶汽车", "icv",
    "intelligent connected vehicle", "av", "apollo go",
)
LEVEL_TERMS = ("l3", "l4", "level 3", "level 4")
TRUCK_TERMS = ("无人驾驶货车", "自动驾驶货车", "无人货运", "autonomous truck", "driverless truck", "freight", "truck")
FAST_PASS_TITLE_ZH = ("robotaxi", "无人驾驶出租车", "自动驾驶出租车", "l4", "l3", "智能网联汽车", "无人驾驶汽车")
FAST_PASS_TITLE_EN = (
    "robotaxi", "driverless taxi", "autonomous taxi", "self-driving taxi", "level 4", "level 3", "intelligent connected vehicle", "icv",
    "driverless car", "autonomous car", "self-driving car",
)
SOURCE_PROFILES = ("general_media", "industry_media", "newsroom", "regulator", "research")
PROFILE_POINTS = {"general_media": 0, "industry_media": 6, "newsroom": 10, "regulator": 10, "research": 8}
THRESHOLDS = {
    "high_precision": {"general_media": 75, "industry_media": 65, "newsroom": 55, "regulator": 55, "research": 55, "search_api": 65},
    "balanced": {"general_media": 68, "industry_media": 58, "newsroom": 50, "regulator": 50, "research": 50, "search_api": 58},
    "high_recall": {"general_media": 60, "industry_media": 50, "newsroom": 45, "regulator": 45, "research": 45, "search_api": 52},
}
UNKNOWN_PROFILE_THRESHOLD = 65
REASON_LABELS = {
    "blocked_publisher": "命中屏蔽发布源",
    "query_rss_unresolved_url": "查询发现源真实链接未解析",
    "query_rss_unverified_published": "查询发现源发布时间未验证",
    "search_result_unverified_published": "搜索发现源发布时间未验证",
    "general_no_core_or_company": "通用媒体缺少核心词或公司信号",
    "score_below_threshold": "相关性评分低于阈值",
    "time_window": "超出时间窗口",
    "url_invalid": "链接无效",
    "url_homepage": "首页链接非文章",
    "url_not_in_allow_patterns": "链接不在允许路径",
    "url_blocked_pattern": "命中屏蔽路径",
    "url_external_domain_not_allowed": "外链域名不在白名单",
    "general_source_cap": "通用媒体单源条数超限",
    "pair_rule_mismatch": "关键词配对规则不满足",
    "published_missing": "发布时间缺失",
    "published_unparseable": "发布时间无法解析",
    "published_missing_or_unparseable": "发布时间缺失或无法解析",
    "not_today": "非当日新闻",
    "source_max_age": "超出来源时效窗口",
    "outside_window": "非统计窗口新闻",
    "candidate_gate_miss": "未命中候选信号",
    "fast_pass": "直通保留",
    "kept": "保留",
}

# --- fixed values: summaries ---------------------------------------------------------------------------

ALLOWED_TAGS = ("监管", "融资", "扩张", "合作", "安全", "产品", "运营")
TAG_WORDS = {
    "监管": ("cpuc", "监管", "工信部", "permit", "regulation", "政策", "nhtsa"),
    "融资": ("融资", "funding", "ipo", "投资", "raise", "估值", "并购", "股价"),
    "扩张": ("扩张", "launch", "new city", "新增", "部署", "扩大", "上线"),
    "合作": ("合作", "partnership", "joint", "alliance", "签约", "联合"),
    "安全": ("事故", "safety", "collision", "召回", "安全", "停运"),
    "产品": ("产品", "发布", "platform", "feature", "版本", "车型", "量产"),
    "运营": ("运营", "ride", "订单", "fleet", "商业化", "车队", "网约车"),
}
DEFAULT_TAG = "运营"
IMPACT_TARGETS = ("运营方", "车企", "供应链", "监管", "资本市场")
IMPACT_WORDS = {
    "运营方": ("运营", "网约车", "fleet", "dispatch", "运力", "ride-hailing", "商业化运营", "车队", "订单"),
    "车企": ("车企", "整车", "主机厂", "automaker", "oem", "车型", "量产", "tesla", "toyota", "byd"),
    "供应链": ("供应链", "芯片", "激光雷达", "传感器", "地图", "算力", "零部件", "tier1", "platform"),
    "监管": ("监管", "许可", "牌照", "政策", "法规", "cpuc", "工信部", "nhtsa", "compliance"),
    "资本市场": ("融资", "ipo", "估值", "并购", "投资", "股价", "earnings", "funding", "财报"),
}
BAN_PHRASES = ("详见原文", "建议查看原文")
SUMMARY_VERSION = "w-w-sw-v1"
FALLBACK_EN = ("{title} 相关进展已披露", "背景是企业在商业化落地、合作推进或监管变化中持续调整", "这将影响Robotaxi行业的运营效率、竞争格局与监管节奏")
FALLBACK_ZH_WHY = "事件背景与企业阶段性策略调整相关"
FALLBACK_ZH_SO_WHAT = "这对Robotaxi商业化推进、行业竞争和监管预期具有参考价值"
CACHE_WHY, CACHE_SO_WHAT = "背景是企业在商业化推进与监管环境中持续调整", "这将影响Robotaxi行业的竞争格局与商业化节奏"

# --- fixed values: digest and reports --------------------------------------------------------------------

TOPICS = (("商业运营", ("运营", "扩张")), ("监管政策", ("监管",)), ("安全事件", ("安全",)), ("融资与资本", ("融资", "合作")), ("技术与产品", ("产品",)))
DEFAULT_TOPIC = "商业运营"
FOREIGN_PLACES = (
    "阿联酋", "迪拜", "多哈", "卡塔尔", "沙特", "韩国", "首尔", "日本", "东京", "美国", "欧洲", "英国", "德国", "奥斯汀", "旧金山",
    "洛杉矶", "凤凰城", "休斯顿", "纽约", "硅谷", "加州", "亚利桑那", "得克萨斯", "新加坡", "以色列",
)
METHODS = ("rss", "structured_web", "search_result", "official_api", "search_api")
METHOD_LABELS = {"rss": "RSS", "structured_web": "结构化网页", "search_result": "搜索结果", "official_api": "官方 API", "search_api": "Search API"}
STAGES = ("fetched", "candidate", "filtered", "kept")
PRE_CANDIDATE_REASONS = {"no_title_or_link": "缺少标题或链接", "dup_link": "一级去重（链接）", "seen": "历史去重（已见文章）", "dup_title": "二级去重（标题）"}
#: Ordered: the first rule whose words (all of one group) occur in the lower-case message gives the code.
ERROR_RULES = (
    ("search_api_missing_key", "缺少 Search API 密钥", (("search_api_missing_key",),)),
    ("auth_unauthorized", "鉴权失败（密钥无效或未授权）", (("401",), ("unauthorized",))),
    ("access_forbidden", "目标站点拒绝访问", (("403",), ("forbidden",))),
    ("origin_unreachable", "目标站点源站不可达", (("521",),)),
    ("not_found", "页面不存在或路径失效", (("404",), ("not found",))),
    ("dns_error", "域名解析失败", (("name or service not known",), ("nodename nor servname provided",))),
    ("timeout", "请求超时", (("timed out",), ("timeout",))),
    ("remote_closed", "目标站点连接被远端中断", (("remote end closed connection without response",),)),
    ("upstream_h2_reset", "目标站点连接不稳定（HTTP/2 中断）", (("http/2 stream", "not closed cleanly"), ("curl: (92)",))),
    ("ssl_error", "SSL 握手或证书异常", (("ssl",), ("handshake",), ("certificate",))),
    ("connection_error", "网络连接失败", (("connection reset",), ("connection refused",))),
    ("invalid_provider", "搜索服务配置无效", (("invalid search provider",),)),
    ("invalid_query_rss_provider", "查询 RSS 提供方配置无效", (("invalid query_rss provider",),)),
    ("invalid_search_result_provider", "搜索结果提供方配置无效", (("invalid search_result provider",),)),
    ("invalid_official_api_provider", "官方 API 提供方配置无效", (("invalid official_api provider",),)),
    ("invalid_query_set", "搜索查询配置无效", (("invalid query set",),)),
    ("missing_entry_urls", "结构化源缺少入口配置", (("structured_web source missing entry_urls",),)),
    ("non_rss_or_challenge_page", "目标页不是有效 RSS（可能触发反爬挑战）", (("mismatched tag",),)),
    ("unsupported_source_type", "不支持的数据源类型", (("unsupported source_type",),)),
    ("incomplete_read", "响应数据不完整（服务端提前关闭连接）", (("incompleteread",),)),
)
UNKNOWN_ERROR = ("unknown_error", "抓取异常")
#: What, why and so-what of a summary whose fallback breaks a rule.
LAST_RESORT = ("该资讯已发布", "背景是行业商业化与监管环境持续变化", "这将影响Robotaxi运营策略、竞争格局与资本预期")
