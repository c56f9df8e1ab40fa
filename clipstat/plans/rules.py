"""Our own small default rules; callers pass theirs."""

THEME_RULES = (
    ("tutorial", ("how to", "guide", "tutorial", "教程", "怎么")),
    ("review", ("review", "unboxing", "测评", "开箱")),
    ("story", ("story", "diary", "故事", "日常")),
    ("offer", ("sale", "discount", "coupon", "优惠", "折扣")),
)

COMMENT_PATTERNS = (
    ("question", r"[?？]|how|why|怎么|为什么"),
    ("intent", r"buy|order|link|想买|链接"),
    ("praise", r"great|love|nice|喜欢|真好"),
    ("doubt", r"fake|scam|advert|骗|广告"),
)

COMMENT_GROUPS = (
    ("question", COMMENT_PATTERNS[0][1], 4),
    ("doubt", COMMENT_PATTERNS[3][1], 3),
    ("intent", COMMENT_PATTERNS[1][1], 4),
)
