"""Schemas of the row kinds. Readers take them as given; nothing is inferred."""

INSTRUCTION = "instruction STRING, input STRING, output STRING"
SENTIMENT = "input STRING, output STRING"
QUESTION = "system_prompt STRING, question STRING, response STRING"
SCORED_POST = (
    "title STRING, selftext STRING, "
    "comments ARRAY<STRUCT<body: STRING, score: BIGINT>>"
)
TRANSCRIPT_PAIR = "chosen STRING, rejected STRING"
PREFERENCE = "prompt STRING, chosen STRING, rejected STRING"
PROMPT = "prompt STRING"
GENERATION = "id BIGINT, model STRING, text STRING, elapsed_s DOUBLE, error STRING"
REPLY = "chunk_id STRING, reply STRING"
SAMPLE_SCORE = (
    "model STRING, sample_id BIGINT, rouge_l DOUBLE, win BIGINT, n_words BIGINT, "
    "elapsed_s DOUBLE"
)
METRIC_VALUES = (
    "rouge_l_mean DOUBLE, rouge_l_max DOUBLE, win_rate DOUBLE, avg_length DOUBLE, "
    "avg_latency DOUBLE, total_time DOUBLE"
)
EVAL_SUMMARY = "model STRING, " + METRIC_VALUES
EVAL_RESULTS = f"MAP<STRING, STRUCT<{METRIC_VALUES}>>"
