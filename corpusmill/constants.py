"""Fixed values. They decide results and must stay exactly as they are."""

# Languages in priority order.
LANGUAGES = ["pt", "en", "es", "fr", "de", "it", "ja", "zh"]

# Canonical categories and their weights.
CATEGORY_WEIGHTS = {
    "Programação": 1.0,
    "Algoritmos": 0.9,
    "Linguagens de programação": 1.2,
    "Estruturas de dados": 0.95,
    "Engenharia de software": 1.1,
    "Ciência da computação": 0.85,
    "Desenvolvimento web": 1.15,
    "Banco de dados": 0.9,
    "Inteligência artificial": 1.3,
    "Segurança da informação": 0.95,
    "Machine Learning": 1.25,
    "Redes neurais": 1.1,
    "Visão computacional": 0.9,
    "Processamento de linguagem natural": 1.2,
    "Sistemas distribuídos": 0.85,
    "Computação quântica": 0.8,
    "Blockchain": 0.9,
    "Internet das Coisas": 0.85,
    "Realidade virtual": 0.8,
    "DevOps": 1.0,
}
DEFAULT_WEIGHT = 1.0

# Folded alias -> canonical category.
CATEGORY_ALIASES = {"programacao": "Programação"}

# Limits.
MAX_CATEGORY_DEPTH = 3
MAX_PAGES = 1000
MIN_TEXT_LENGTH = 150
MAX_TEXT_LENGTH = 10000
MAX_KEYWORDS = 10
MAX_KEYWORD_QUESTIONS = 5
MAX_ENTITY_QUESTIONS = 5
MAX_PARAGRAPHS = 3
SUMMARY_SENTENCES = 3
CLUSTER_K = 10
CLUSTER_SEED = 42
REVISION_LIMIT = 5
RELATED_LIMIT = 10
PAYLOAD_LIMIT = 10
HASH_PREFIX = 50
EMBEDDING_THRESHOLD = 0.95
SIMHASH_DISTANCE = 3
NS_MAIN = 0
NS_CATEGORY = 14

# Base addresses by language; other languages use the pattern.
BASE_URLS = {
    "en": "https://en.wikipedia.org",
    "pt": "https://pt.wikipedia.org",
}
BASE_URL_PATTERN = "https://{lang}.wikipedia.org"
IMAGE_URL_PREFIX = "https://commons.wikimedia.org/wiki/Special:FilePath/"
RECORD_SOURCE = "wikipedia"
WIKI_MARKER = "/wiki/"
CONTENT_ID = "mw-content-text"

# Category page prefixes.
CATEGORY_PREFIXES = ["Category:", "Categoria:"]

# Phrases that start a "see also" tail.
SEE_ALSO = ["ver também", "see also", "véase también", "voir aussi"]

# Section headings whose text is dropped, in this order.
DROPPED_SECTIONS = [
    "referências", "references", "referencias",
    "bibliografia", "bibliography", "bibliografía",
    "ligações externas", "external links", "enlaces externos",
]

# Relation verbs of the sentence pattern.
RELATION_VERBS = ["worked at", "studied at", "discovered"]

# Topic rules, tried in this order; (topic, keywords, [(subtopic, keywords)]).
DEFAULT_TOPIC = "engenharia de software"
DEFAULT_SUBTOPIC = "geral"
TOPIC_RULES = [
    (
        "ai",
        ["inteligência artificial", "machine learning", "ai", "deep learning", "redes neurais"],
        [
            ("nlp", ["processamento de linguagem natural", "pln", "nlu", "nlp"]),
            ("vision", ["visão computacional", "computer vision", "reconhecimento de imagem"]),
            ("robotics", ["robótica", "robots", "autonomous systems"]),
        ],
    ),
    (
        "web",
        ["desenvolvimento web", "frontend", "backend", "full stack", "javascript", "html", "css"],
        [
            ("frontend", ["frontend", "interface", "ui", "ux", "react", "vue", "angular"]),
            ("backend", ["backend", "servidor", "api", "rest", "graphql", "node.js"]),
            ("fullstack", ["full stack", "full-stack", "mern", "mean"]),
        ],
    ),
    (
        "data",
        ["banco de dados", "big data", "data science", "data analytics", "sql", "nosql"],
        [
            ("sql", ["sql", "relacional", "mysql", "postgresql", "oracle"]),
            ("nosql", ["nosql", "mongodb", "cassandra", "redis", "elasticsearch"]),
            ("bigdata", ["big data", "hadoop", "spark", "data lake"]),
        ],
    ),
]

# Question texts, (type, difficulty, template).
DEFINITION_QUESTION = ("definition", "easy", "What is {title}?")
KEYWORD_QUESTIONS = [
    ("relation", "medium", "How does {keyword} relate to {title}?"),
    ("role", "medium", "What is the role of {keyword} in {title}?"),
    ("explanation", "hard", "Can you explain {keyword} in the context of {title}?"),
]
ENTITY_QUESTION = ("significance", "medium", "What is the significance of {entity} in {title}?")
ENTITY_QUESTION_TYPES = ["PERSON", "ORG", "LOC", "PRODUCT"]

# Question phrase replacements per language, applied in this order.
QUESTION_PHRASES = {
    "pt": [
        ("What is", "O que é"),
        ("How does", "Como"),
        ("relate to", "se relaciona com"),
        ("What is the role of", "Qual é o papel de"),
        ("Can you explain", "Você pode explicar"),
        ("in the context of", "no contexto de"),
        ("What is the significance of", "Qual é a importância de"),
    ],
    "es": [
        ("What is", "Qué es"),
        ("How does", "Cómo"),
        ("relate to", "se relaciona con"),
        ("What is the role of", "Cuál es el papel de"),
        ("Can you explain", "Puedes explicar"),
        ("in the context of", "en el contexto de"),
        ("What is the significance of", "Cuál es la importancia de"),
    ],
    "fr": [
        ("What is", "Qu'est-ce que"),
        ("How does", "Comment"),
        ("relate to", "se rapporte à"),
        ("What is the role of", "Quel est le rôle de"),
        ("Can you explain", "Pouvez-vous expliquer"),
        ("in the context of", "dans le contexte de"),
        ("What is the significance of", "Quelle est l'importance de"),
    ],
}

# Month abbreviations in calendar order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Stop word list names known to Spark ML, by language code.
STOP_WORD_LISTS = {
    "en": "english", "pt": "portuguese", "es": "spanish", "fr": "french", "de": "german", "it": "italian",
}
