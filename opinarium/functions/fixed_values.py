"""Values that results depend on and that must stay as they are."""

# Fixed value: a URL as the text cleaner sees it. One flat character class; an
# alternation repeated with "+" recurses in Java regex and overflows the
# stack on very long URLs. "%" lies between "$" and "_", so escapes are covered.
URL_PATTERN = r"http[s]?://[a-zA-Z0-9$-_@.&+!*\(\),]+"

# Characters that end a sentence.
SENTENCE_ENDS = "?!？！。…"

# Characters kept by the strict cleaner and by the alphanumeric one.
KEPT_ALNUM = r"一-龥0-9A-Za-z"
KEPT_STRICT = KEPT_ALNUM + SENTENCE_ENDS

# Fixed value: what counts as white space (Unicode white space and the four
# information separators), and as a mention (from "@" to the next white space).
WHITE_SPACE = r"\s\x1c-\x1f"

# Fixed value: the same white space, character by character, for trimming.
WHITE_SPACE_CHARACTERS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Tokens dropped from word bags besides blanks. The second list has the marks
# outside ASCII in their original order, each once.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WIDE_PUNCTUATION = (
    "—！，。？、￥…（）｡＂＃＄％＆＇＊＋－／：；＜＝＞＠［＼］＾＿｀｛｜｝～｟｠｢｣､〃》"
    "「」『』【】〔〕〖〗〘〙〚〛〜〝〞〟〰〾〿–‘‛“”„‟‧﹏"
)

# Sentiment names by class id.
EMOTION_NAMES = ["负面", "中性", "正面"]

# Property names by class id. Models with 110 outputs add one
# catch-all class at the end; models with 109 outputs do not have it.
PROPERTY_NAMES = [
    "上下车便利性", "个人维修维护便利性", "二手车保值率", "交车服务", "企业形象", "侧面", "保养服务", "保有量",
    "保险及其他增值服务", "信息/按键标识便利性", "充电便利性", "充电安全", "充电时间", "内饰布局", "内饰材质",
    "内饰细节特征", "内饰风格", "刹车/制动性能", "前排座椅舒适性", "前排空间大小", "加速动力性能", "动力参数",
    "厂家售后服务", "合格证及上牌上户", "后备厢/后备箱空间", "后备箱取放物品便利性", "后排座椅空间灵活性", "品牌价值",
    "售后服务态度", "售后诚信", "售后费用", "声音品质感", "备件服务", "外观协调性", "外观品质感", "安全性配置",
    "导航系统", "尺寸参数", "底盘高度/离地间隙", "座椅舒适性", "异响", "影音娱乐系统", "悬架/减振舒适性",
    "战略规划", "按键、调节操作便利性", "换挡操作性能", "接近角/离去角", "操作品质感", "整体便利性", "整体信息娱乐性",
    "整体充电", "整体内饰", "整体动力", "整体外观", "整体安全性", "整体性价比", "整体操控性", "整体智能化",
    "整体电池", "整体空间", "整体舒适性", "整体质量", "整体通过性", "智能远程控制", "智能驾驶辅助", "服务其他",
    "爬坡动力性能", "电池衰减/里程衰减", "碰撞测试星级", "空调舒适性", "第三排座椅空间灵活性", "第三排座椅舒适性",
    "第三排空间大小", "第二排座椅舒适性", "第二排空间大小", "经营表现", "续航里程", "维修质量", "综合油耗",
    "行驶稳定性", "试乘试驾", "质量投诉", "购车价格", "购车费用", "起步动力性能", "车内互联系统", "车内储物空间",
    "车内气味", "车内静音效果", "车头", "车尾", "车标", "车系评价", "车联网", "车身结构安全", "车轮",
    "转向性能", "配置丰富性", "配置实用性", "销售专业性", "销售政策", "销售服务态度", "销售诚信", "销量",
    "门店布局", "门店环境", "门店设施", "驾驶操作舒适性", "驾驶视觉安全",
]
CATCH_ALL_PROPERTY = "general"

# Columns of the opinion table and of the keyword sheet.
OPINION_COLUMNS = ["text", "news_uuid", "property", "emotion", "hits", "datatime"]
SHEET_NAME_COLUMN = "class3_name"
SHEET_KEYWORD_COLUMNS = [f"Keyword{k}" for k in range(1, 11)]

# Total row target and seed of the capped sample, words kept per
# explained sentence, rows explained per run, rows per relational write batch.
SAMPLE_TOTAL = 30000
SAMPLE_SEED = 24
TOP_WORDS = 6
EXPLAINED_ROWS = 2800
WRITE_BATCH = 1024
