"""Fixed values. Results depend on them, so they are stated once, as text."""

# Every character that counts as white space when text is stripped or split.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a character class body for regular expressions.
WHITE_SPACE_CLASS = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A number with a unit, or two or more digits, or a decimal.
NUMBER_PATTERN = (
    r"\p{Nd}+\.?\p{Nd}*[" + WHITE_SPACE_CLASS + r"]*[%倍元万亿美元$€]"
    r"|\p{Nd}{2,}|[1-9]\p{Nd}*\.\p{Nd}+"
)

# A run of CJK ideographs, or a run of letters, numbers and underscores.
WORD_PATTERN = r"[\u4e00-\u9fff]+|[\p{L}\p{N}_]+"

# ROUGE tokens, taken after lower-casing.
ROUGE_TOKEN_PATTERN = r"[a-z0-9]+"

# Characters that end a finished sentence.
SENTENCE_ENDS = ["。", "！", "？", ".", "!", "?"]

# Labels of the rendered prompt.
LABEL_INSTRUCTION = "指令: "
LABEL_INPUT = "\n输入: "
LABEL_ANSWER = "\n回答:"

# Mark before each assistant turn, and before each human turn, of a transcript.
ASSISTANT_MARK = "\n\nAssistant:"
HUMAN_MARK = "\n\nHuman:"

# Weights of the combined reward, added up in this order.
REWARD_WEIGHTS = {"length": 0.4, "number": 0.3, "no_repeat": 0.2, "format": 0.1}

# Length reward: (characters at most, reward), then the reward beyond.
LENGTH_REWARDS = [(9, -1.0), (49, 0.0), (500, 1.0), (800, 0.5)]
LENGTH_REWARD_BEYOND = 0.0

# Number reward: (mentions at least, reward), from the top; without a mention 0.
NUMBER_REWARDS = [(3, 1.0), (1, 0.5)]

# Repetition reward: (share of own words in the prompt above which, reward), from the top.
REPEAT_REWARDS = [(0.8, -0.5), (0.6, 0.0)]
NO_REPEAT_REWARD = 0.5

# Length limits, in characters.
MIN_CHOSEN = 20
MIN_REJECTED = 10
MIN_TRANSCRIPT_REPLY = 11
MAX_PROMPT = 300
MIN_ANSWER = 10
MIN_CHUNK = 50
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50

# Row counts and the seed of the default runs.
SEED = 42
SFT_QUOTAS = {"instruction": 4000, "sentiment": 1000}
NUM_PREFERENCE_ROWS = 1000
OVER_FETCH = 1.2
NUM_TRANSCRIPTS = 2000
NUM_PROMPTS = 1000
NUM_EVAL_SAMPLES = 30
COMPLETIONS_PER_PROMPT = 4

# Floor of the base value in a relative change, and of the spread of a group.
DELTA_FLOOR = 1e-8
ADVANTAGE_EPSILON = 1e-4

# The request for question/answer pairs, around the text of one chunk.
QA_REQUEST_HEAD = """你是一个专业的数据标注员。请根据下面这段文档内容，生成 3 个高质量的问答对。

要求：
1. 问题要自然，像真实用户会问的
2. 答案要基于文档内容，准确简洁
3. 覆盖不同角度（事实查询、操作指引、概念解释）
4. 每个问答对用 JSON 格式，如下：

[
  {"question": "问题1", "answer": "答案1"},
  {"question": "问题2", "answer": "答案2"},
  {"question": "问题3", "answer": "答案3"}
]

文档内容：
"""
QA_REQUEST_TAIL = """

请直接输出 JSON 数组，不要其他内容："""
