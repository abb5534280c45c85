"""Vocabularies, labels and constants that decide results.

They are plain data and every operator takes them as parameters, so a caller
can swap in another vocabulary without touching the operators.
"""

from __future__ import annotations

# --- fixed values: enumerations -------------------------------------------------
SOURCE_TYPES = ("news", "blog", "research", "social", "release", "forum", "unknown")
LANGUAGES = ("zh", "en", "other", "unknown")
EVENT_TYPES = (
    "product_launch", "funding", "policy", "research", "controversy", "partnership", "market", "security",
    "model_release", "other",
)
SENTIMENTS = ("positive", "neutral", "negative", "mixed", "unknown")
IMPACT_SCOPES = ("technology", "industry", "capital", "policy", "user", "ecosystem", "security", "other")
LEVELS = ("low", "medium", "high", "unknown")
TREND_STATES = ("new", "continuing", "heating_up", "cooling_down", "reversing")
SOURCE_STATUSES = ("succeeded", "partial", "failed", "rate_limited", "empty")

# --- fixed values: topic taxonomy -----------------------------------------------
TOPICS = (
    "AI Agents", "Foundation Models", "AI Infrastructure", "AI Applications", "Developer Tools and Open Source",
    "AI Safety and Governance", "AI Research", "AI Business and Market",
)
# Aliases per topic; the topic's own lower-cased name is an alias as well.
TOPIC_ALIASES = {
    "AI Agents": (
        "agents", "ai agent", "ai agents", "agentic ai", "agent workflows", "autonomous agents", "coding agents",
    ),
    "Foundation Models": (
        "foundation model", "foundation models", "ai model", "ai models", "model release", "model releases",
        "frontier models", "llms", "large language models",
    ),
    "AI Infrastructure": (
        "ai hardware", "ai infrastructure", "infrastructure", "compute", "chips", "gpu", "gpus",
    ),
    "AI Applications": ("ai application", "ai applications", "enterprise ai applications", "consumer ai"),
    "Developer Tools and Open Source": (
        "ai developer tools", "developer tools", "developer tooling", "open source ai", "open-source ai",
        "open source", "open-source",
    ),
    "AI Safety and Governance": (
        "ai safety", "ai governance", "ai safety and governance", "model safety", "policy", "regulation",
        "ai policy", "ai regulation",
    ),
    "AI Research": ("ai research", "research", "ml research", "machine learning research", "academic research"),
    "AI Business and Market": (
        "ai industry", "ai business", "ai market", "ai business and market", "business and market",
        "enterprise ai", "market",
    ),
}

# --- fixed values: relevance vocabulary -----------------------------------------
ENTITY_TERMS = (
    "openai", "anthropic", "google deepmind", "deepmind", "deepseek", "mistral", "cohere", "hugging face",
    "perplexity", "nvidia", "xai", "英伟达", "华为昇腾", "昇腾", "百度文心", "阿里通义", "通义千问", "腾讯混元", "字节豆包", "月之暗面", "智谱", "商汤",
    "百川智能", "零一万物",
)
TECH_TERMS = (
    "generative ai", "llm", "large language model", "foundation model", "chatgpt", "gpt", "claude", "gemini",
    "llama", "agent", "agents", "copilot", "multimodal", "reasoning model", "vision-language", "machine learning",
    "deep learning", "neural network", "transformer", "人工智能", "生成式ai", "生成式人工智能", "大模型", "语言模型", "基座模型", "基础模型",
    "多模态", "视觉语言", "智能体", "ai助手", "ai 助手", "推理模型", "机器学习", "深度学习", "神经网络", "模型推理", "模型训练",
)
DIRECT_TERMS = (
    ("ai", "aigc", "artificial intelligence", "人工智能", "生成式ai", "生成式人工智能") + ENTITY_TERMS + TECH_TERMS
)
WEAK_TERMS = ("ai", "aigc", "artificial intelligence", "人工智能", "生成式ai", "生成式人工智能", "model", "models", "模型")
INFRA_TERMS = (
    "gpu", "tpu", "npu", "accelerator", "ai chip", "inference", "training", "model serving", "serving framework",
    "vllm", "transformers", "cuda", "cann", "rocm", "blackwell", "h100", "b200", "gb200", "ascend", "ai cloud",
    "compute cluster", "gpu cluster", "datacenter", "data center", "数据中心", "memory bandwidth", "hbm", "all-reduce",
    "ai芯片", "ai 芯片", "智算", "智算中心", "算力", "算力集群", "训练集群", "推理集群", "推理框架", "推理引擎", "模型服务", "模型部署", "显存", "高带宽内存",
    "昇腾", "寒武纪", "海光", "ai服务器", "ai 服务器", "云服务", "通用云服务",
)
WORKLOAD_TERMS = (
    "model training", "model inference", "model serving", "llm serving", "training cluster", "inference workload",
    "ai workload", "ai training", "ai inference", "gpu utilization", "llm deployment", "token", "tokens", "模型训练",
    "模型推理", "大模型训练", "大模型推理", "推理部署", "模型服务", "大模型服务", "llm服务", "llm 服务", "ai工作负载", "ai 工作负载", "训练任务", "推理任务",
)
POLICY_TERMS = (
    "policy", "regulation", "regulatory", "governance", "law", "lawsuit", "copyright", "safety", "audit", "audits",
    "compliance", "evaluation", "eval", "content label", "content labeling", "watermark", "deepfake", "政策", "监管",
    "治理", "法规", "法律", "诉讼", "版权", "安全", "审计", "合规", "评测", "备案", "内容标识", "水印", "深度合成", "深度伪造",
)
POLICY_TARGET_TERMS = (
    "ai act", "ai model", "ai models", "ai system", "ai systems", "ai-generated", "ai generated", "generative ai",
    "synthetic media", "deepfake", "model safety", "model audit", "model evaluation", "training data",
    "generated content", "content label", "content labeling", "watermark", "人工智能法", "ai法案", "ai 法案", "ai模型",
    "ai 模型", "ai系统", "ai 系统", "人工智能系统", "生成式ai", "生成式 ai", "生成式人工智能", "生成式人工智能服务", "大模型", "模型安全", "模型评测", "算法备案",
    "模型备案", "训练数据", "生成内容", "内容标识", "深度合成", "深度伪造",
)
RESEARCH_TERMS = (
    "paper", "research", "researchers", "benchmark", "dataset", "architecture", "method", "study", "arxiv",
    "experiment", "论文", "研究", "研究人员", "基准", "基准测试", "数据集", "架构", "方法", "实验", "评测",
)
TECH_RESEARCH_TERMS = DIRECT_TERMS + (
    "benchmark", "dataset", "architecture", "alignment", "rlhf", "fine-tuning", "pretraining", "post-training",
    "reasoning", "vision-language", "大模型", "多模态", "智能体", "推理", "推理模型", "对齐", "微调", "预训练", "后训练", "模型架构", "基准测试",
    "数据集", "模型评测",
)
PRODUCT_TERMS = (
    "launch", "launches", "unveil", "unveils", "unveiled", "release", "released", "introduce", "introduced",
    "announce", "announced", "preview", "product", "platform", "api", "发布", "推出", "上线", "预览", "产品", "平台", "接口",
)
CAPABILITY_TERMS = (
    "assistant", "copilot", "agent", "agents", "workflow", "workflows", "developer", "助手", "ai助手", "ai 助手", "智能体",
    "工作流", "开发者", "企业工作流", "模型api", "模型 api",
)
STRONG_PRODUCT_TERMS = (
    "agent", "agents", "copilot", "assistant", "api", "developer", "workflow", "enterprise", "llm",
    "large language model", "foundation model", "chatgpt", "claude", "gemini", "generative ai", "大模型", "语言模型",
    "基座模型", "智能体", "助手", "ai助手", "开发者", "工作流", "企业", "生成式ai", "生成式人工智能",
)
BUSINESS_TERMS = (
    "funding", "valuation", "revenue", "ipo", "acquisition", "partnership", "investment", "compute deal",
    "cloud deal", "adoption", "enterprise deal", "融资", "估值", "营收", "收入", "上市", "收购", "合作", "投资", "算力订单", "云服务订单",
    "商业化", "企业客户", "采用",
)
BUSINESS_TARGET_TERMS = (
    ENTITY_TERMS
    + TECH_TERMS
    + (
        "ai company", "ai startup", "model company", "model lab", "ai lab", "ai platform", "compute spend",
        "training compute", "inference spend", "ai公司", "ai 公司", "ai创业公司", "ai 创业公司", "大模型公司", "模型公司", "模型实验室",
        "ai实验室", "ai 实验室", "ai平台", "ai 平台", "算力支出", "训练算力", "推理成本", "推理支出",
    )
)
NEGATIVE_TERMS = (
    "game", "gaming", "movie", "music", "sports", "fashion", "celebrity", "travel", "restaurant", "smartphone",
    "phone", "camera", "laptop", "pc", "tv", "appliance", "car", "ev", "游戏", "影视", "电影", "音乐", "体育", "时尚", "明星",
    "旅行", "餐厅", "手机", "相机", "拍照", "电脑", "笔记本", "电视", "家电", "汽车", "电动车", "座舱", "数据中心", "通用云服务", "数据库", "存储",
    "企业应用托管",
)
NEGATED_CONTEXT_PATTERNS = (
    r"没有明确的?.{0,12}(大模型|模型|ai|人工智能).{0,12}(训练|推理|工作负载|任务|部署|服务)",
    r"(ai|人工智能|大模型).{0,12}(只是|仅是|仅作为|顺带|附带|下游用途|小功能)",
    r"(不是|并非).{0,12}(监管对象|核心产品能力|主要事件|核心能力)",
)
# Every pattern needs a word of this class, so texts without one skip them.
NEGATED_CONTEXT_GUARD = "[㐀-鿿]"
RELEVANCE_FAMILIES = {
    "direct": DIRECT_TERMS,
    "weak": WEAK_TERMS,
    "negative": NEGATIVE_TERMS,
    "infra": INFRA_TERMS,
    "workload": WORKLOAD_TERMS,
    "tech_entity": TECH_TERMS + ENTITY_TERMS,
    "policy": POLICY_TERMS,
    "policy_target": POLICY_TARGET_TERMS,
    "research": RESEARCH_TERMS,
    "tech_research": TECH_RESEARCH_TERMS,
    "product": PRODUCT_TERMS,
    "capability": CAPABILITY_TERMS,
    "strong_product": STRONG_PRODUCT_TERMS,
    "business": BUSINESS_TERMS,
    "business_target": BUSINESS_TARGET_TERMS,
}
RELEVANCE_THRESHOLD = 70

# --- fixed values: extraction vocabulary (plain substrings) ---------------------
TOPIC_WORDS = {
    "AI Safety and Governance": (
        "safety", "policy", "governance", "regulation", "risk", "lawsuit", "privacy", "audit",
    ),
    "AI Research": ("paper", "research", "benchmark", "study", "arxiv", "algorithm", "experiment"),
    "AI Agents": ("agent", "agents", "autonomous", "copilot"),
    "Foundation Models": (
        "foundation model", "frontier model", "model release", "new model", "gemini", "claude", "gpt", "llama",
        "mistral", "multimodal", "reasoning",
    ),
    "Developer Tools and Open Source": (
        "open source", "open-source", "hugging face", "open-weight", "github", "sdk", "framework",
        "developer tool", "vllm", "ollama", "langchain",
    ),
    "AI Infrastructure": (
        "gpu", "nvidia", "blackwell", "cloud", "chip", "training", "inference", "data center", "hbm",
    ),
    "AI Applications": (
        "chatgpt", "workspace", "health", "search", "productivity", "education", "design", "consumer",
    ),
    "AI Business and Market": (
        "funding", "investment", "valuation", "acquisition", "revenue", "market", "customer", "partnership",
        "enterprise adoption",
    ),
}
EVENT_WORDS = {
    "funding": ("funding", "investment", "valuation"),
    "policy": ("policy", "regulation", "governance", "law"),
    "research": ("paper", "research", "benchmark", "study"),
    "security": ("security", "safety", "risk", "misuse"),
    "partnership": ("partnership", "partner", "collaboration"),
    "controversy": ("controversy", "lawsuit", "complaint"),
}
RELEASE_WORDS = ("release", "launch", "introduce", "announce", "preview")
SCOPE_WORDS = {
    "technology": ("developer", "api", "model", "benchmark", "gpu"),
    "industry": ("enterprise", "business", "customer", "market"),
    "user": ("user", "consumer", "chatgpt", "workspace"),
}
HIGH_RISK_WORDS = ("lawsuit", "ban", "breach", "misuse", "security risk", "safety risk")
MEDIUM_RISK_WORDS = ("risk", "safety", "regulation", "policy", "concern", "privacy")
HIGH_OPPORTUNITY_WORDS = ("developer", "enterprise", "open source", "gpu", "agent", "productivity")
MIXED_SENTIMENT_WORDS = ("concern", "risk", "scrutiny", "controversy")
BIG_NAME_WORDS = ("google", "openai", "anthropic", "microsoft", "nvidia", "meta")
MOMENTUM_WORDS = ("developer", "enterprise", "agent", "frontier", "gpu")
ENTITY_NAMES = (
    "OpenAI", "Google", "DeepMind", "Anthropic", "Microsoft", "NVIDIA", "Meta", "Mistral", "Hugging Face",
    "Perplexity", "Cohere", "Amazon", "Apple", "Adobe",
)
DEFAULT_ENTITY = "AI industry"
EVENT_PHRASES = {
    "product_launch": "产品发布",
    "funding": "融资事件",
    "policy": "政策事件",
    "research": "研究进展",
    "controversy": "争议事件",
    "partnership": "合作事件",
    "market": "市场动态",
    "security": "安全事件",
    "model_release": "模型发布",
    "other": "事件",
}
SCOPE_PHRASES = {
    "technology": "技术能力",
    "industry": "产业部署",
    "capital": "资本市场",
    "policy": "政策合规",
    "user": "用户体验",
    "ecosystem": "生态协作",
    "security": "安全治理",
    "other": "相关方向",
}
EVIDENCE_HINTS = (
    (("developer", "workflow", "coding", "api", "sdk"), "来源提到开发者工作流"),
    (("enterprise", "customer", "business", "deployment"), "来源提到企业部署或客户需求"),
    (("gpu", "chip", "infrastructure", "data center", "inference", "training"), "来源提到算力或基础设施"),
    (("model", "benchmark", "reasoning", "multimodal"), "来源提到模型能力或评测"),
    (("policy", "regulation", "law", "governance", "compliance"), "来源提到监管或合规要求"),
    (("risk", "safety", "security", "privacy", "misuse", "breach"), "来源提到安全或隐私风险"),
    (("partnership", "partner", "collaboration"), "来源提到合作部署"),
    (("open source", "open-source", "github", "framework"), "来源提到开源或开发者生态"),
    (("funding", "investment", "valuation", "acquisition"), "来源提到融资或资本动作"),
)
NO_EVIDENCE_HINT = "可引用证据仍较有限"
DEFAULT_EVIDENCE_HINT = "来源给出可追踪事件事实"

# --- fixed values: similarity ---------------------------------------------------
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "for", "from", "in", "into", "is", "of", "on", "or", "the", "to", "with",
    "ai", "artificial", "intelligence", "new", "news", "update", "updates",
)
GENERIC_ENTITIES = ("ai industry", "artificial intelligence", "ai")
NOVELTY_WORDS = (
    "adds", "added", "after", "begin", "begins", "expands", "expansion", "follow up", "follow-up", "now",
    "rollout", "ships", "shipping", "starts", "updated", "upgrade", "upgrades", "version", "新增", "更新", "升级", "上线",
    "落地", "开始", "进一步",
)
TOKEN_PATTERN = "[a-z0-9]+|[㐀-鿿]"
SPECIFIC_TOKEN_PATTERN = (
    r"(?:gpt|claude|gemini|llama|mistral|opus|sonnet|haiku|codex)?\d+(?:\.\d+)*[a-z]*"
    r"|\$?\d+(?:\.\d+)?(?:b|m|bn|million|billion|%)?"
)
SPECIFIC_TERM_PATTERNS = (
    r"\b[A-Z][A-Za-z0-9_.+-]{1,}\b",
    r"\b[A-Za-z]+[-_]?[A-Za-z0-9]*\d+[A-Za-z0-9_.-]*\b",
    r"\b\d+(?:\.\d+)?\s?(?:%|TOPS|GB|TB|tokens?|parameters?|B|M)\b",
)
RELATIONSHIP_RANK = {"likely_duplicate": 3, "continuing": 2, "related_context": 1, "new": 0}

# --- fixed values: validation ---------------------------------------------------
GENERIC_RATIONALES = ("根据新闻判断", "根据材料判断", "根据内容判断", "依据新闻判断", "依据材料判断", "信息不足", "暂无", "无")
RISK_WORDS = (
    "risk", "safety", "security", "vulnerability", "vulnerabilities", "breach", "misuse", "abuse", "lawsuit",
    "complaint", "regulation", "regulatory", "governance", "compliance", "privacy", "cyber", "scrutiny",
    "weakness", "weaknesses",
)
OPPORTUNITY_WORDS = (
    "agent", "agents", "developer", "developers", "enterprise", "customer", "customers", "product", "platform",
    "workflow", "workflows", "model", "models", "release", "launch", "partnership", "partner", "open source",
    "gpu", "cloud", "productivity", "deployment", "adoption",
)

# --- fixed values: URLs and pages -----------------------------------------------
TRACKING_PREFIX = "utm_"
TRACKING_KEYS = (
    "fbclid", "gclid", "dclid", "gbraid", "wbraid", "mc_cid", "mc_eid", "igshid", "ref", "ref_src", "spm",
)
AGGREGATOR_HOST = "news.google.com"
DIRECT_FETCH_KINDS = ("rss", "arxiv_api", "github_releases", "hackernews_api")
SKIP_TAGS = (
    "script", "style", "noscript", "svg", "canvas", "iframe", "form", "nav", "header", "footer", "aside", "button",
)
BLOCK_TAGS = ("p", "li", "h1", "h2", "h3", "blockquote", "pre")
CONTAINER_TAGS = ("article", "main")
CONTAINER_HINTS = ("article", "content", "story", "post", "entry", "body", "main")
CONTAINER_ATTRIBUTES = ("id", "class", "role", "itemprop")
BOILERPLATE_PHRASES = (
    "accept cookies", "all rights reserved", "sign up", "subscribe to", "privacy policy", "terms of service",
)

# --- fixed values: display labels -----------------------------------------------
LEVEL_LABELS = {"low": "低", "medium": "中", "high": "高", "unknown": "未知"}
TREND_LABELS = {
    "new": "新信号", "continuing": "延续", "heating_up": "升温", "cooling_down": "回落", "reversing": "反转"
}
SCOPE_LABELS = {
    "technology": "技术", "industry": "产业", "capital": "资本", "policy": "政策", "user": "用户",
    "ecosystem": "生态", "security": "安全", "other": "其他",
}
TREND_TITLES = {
    "new": "新信号出现", "continuing": "延续跟踪", "heating_up": "热度上升", "cooling_down": "热度回落", "reversing": "方向反转",
}
PROSE_STATES = {"heating_up": "升温", "cooling_down": "降温", "continuing": "延续", "reversing": "反转"}

# --- fixed values: labels of level fields in prose -----------------------------
LEVEL_FIELDS = {"opportunity_level": "机会等级", "risk_level": "风险等级"}
