"""The same queries as SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from prefdata.functions import fixed
from prefdata.operators import evaluation as ev
from prefdata.plans import inputs
from prefdata.plans import queries as q

# RE2 spells code points its own way.
WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NUMBER = (
    r"\p{Nd}+\.?\p{Nd}*" + WS + r"*[%倍元万亿美元$€]|\p{Nd}{2,}|[1-9]\p{Nd}*\.\p{Nd}+"
)
WORD = r"[\x{4e00}-\x{9fff}]+|[\p{L}\p{N}_]+"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def prompt(instruction: str, input_: str = "''") -> str:
    return (
        f"{text(fixed.LABEL_INSTRUCTION)} || {strip(instruction)} || "
        f"{text(fixed.LABEL_INPUT)} || {strip(input_)} || {text(fixed.LABEL_ANSWER)}"
    )


PAIR = """pair AS (
  SELECT conv_id, turn, prompt, text AS completion FROM (
    SELECT conv_id, turn, role, text,
           lag(role) OVER w AS before_role, lag(text) OVER w AS prompt
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'assistant' AND before_role = 'user')"""

PAIR_ID = "conv_id * 4294967296 + turn"

GENERATED = """source AS (
  SELECT doc_id, 'Write a text in ' || lang AS instruction, source AS input,
         text AS output FROM documents),
generated AS (
  SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN d.text ELSE n.text END AS text
  FROM documents d JOIN documents n ON n.doc_id = d.doc_id + 1
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

CANDIDATE = f"""{GENERATED},
candidate AS (
  SELECT s.doc_id, {prompt("s.instruction", "s.input")} AS prompt,
         {strip("s.output")} AS chosen, {strip("g.text")} AS rejected
  FROM source s JOIN generated g ON g.doc_id = s.doc_id)"""

LONG = f"length(chosen) >= {fixed.MIN_CHOSEN}"
USABLE = f"rejected <> chosen AND length(rejected) >= {fixed.MIN_REJECTED}"
READ = f"doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT {q.PAIRS_WANTED * 6 // 5})"

ALL_PAIRS = f"""WITH {CANDIDATE}
SELECT doc_id, prompt, chosen, rejected FROM candidate WHERE {LONG} AND {USABLE}"""


def length_reward(c: str) -> str:
    n = f"length({strip(c)})"
    return (
        f"(CASE WHEN {n} < 10 THEN -1 WHEN {n} < 50 THEN 0 WHEN {n} <= 500 THEN 1 "
        f"WHEN {n} <= 800 THEN 0.5 ELSE 0 END)::DOUBLE"
    )


def number_reward(c: str) -> str:
    n = f"len(regexp_extract_all({c}, '{NUMBER}'))"
    return f"(CASE WHEN {n} >= 3 THEN 1 WHEN {n} >= 1 THEN 0.5 ELSE 0 END)::DOUBLE"


def no_repeat_reward(c: str, p: str) -> str:
    own = f"list_distinct(regexp_extract_all({c}, '{WORD}'))"
    shared = f"len(list_intersect({own}, list_distinct(regexp_extract_all({p}, '{WORD}'))))"
    overlap = f"({shared}::DOUBLE / len({own})::DOUBLE)"
    return (
        f"(CASE WHEN len({own}) = 0 THEN -1 WHEN {overlap} > 0.8::DOUBLE THEN -0.5 "
        f"WHEN {overlap} > 0.6::DOUBLE THEN 0 ELSE 0.5 END)::DOUBLE"
    )


def format_reward(c: str) -> str:
    ends = ", ".join(text(e) for e in fixed.SENTENCE_ENDS)
    return (
        f"(CASE WHEN {strip(c)} = '' THEN -1 "
        f"WHEN right({strip(c)}, 1) IN ({ends}) THEN 0.5 ELSE 0 END)::DOUBLE"
    )


TOTAL = (
    "0.4::DOUBLE * length_reward + 0.3::DOUBLE * number_reward "
    "+ 0.2::DOUBLE * no_repeat_reward + 0.1::DOUBLE * format_reward"
)


def all_rewards(c: str, p: str) -> str:
    return (
        f"{length_reward(c)} AS length_reward, {number_reward(c)} AS number_reward, "
        f"{no_repeat_reward(c, p)} AS no_repeat_reward, {format_reward(c)} AS format_reward"
    )


LAST_LINE = "string_split(text, chr(10))[-1]"
ONE_REWARD = "SELECT doc_id, {} AS reward FROM documents"


def chunks(separator: str, documents: str = "documents") -> str:
    size, overlap = fixed.CHUNK_SIZE, fixed.CHUNK_OVERLAP
    return f"""paras AS (
  SELECT doc_id, list_filter(list_transform(
    regexp_split_to_array({strip("text")}, '{separator}'),
    lambda x: {strip("x")}), lambda x: x <> '') AS p
  FROM {documents}),
fold AS (
  SELECT doc_id, p, 0 AS i, '' AS open, NULL::VARCHAR AS closed FROM paras
  UNION ALL
  SELECT doc_id, p, i + 1,
    CASE WHEN length(open) + length(p[i + 1]) <= {size} THEN open
         ELSE right(open, {overlap}) END || p[i + 1] || chr(10),
    CASE WHEN length(open) + length(p[i + 1]) <= {size} OR open = '' THEN NULL
         ELSE {strip("open")} END
  FROM fold WHERE i < len(p)),
pieces AS (
  SELECT doc_id, i, closed AS chunk FROM fold WHERE closed IS NOT NULL
  UNION ALL
  SELECT doc_id, i + 1, {strip("open")} FROM fold WHERE i = len(p)),
chunks AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_no, chunk
  FROM pieces WHERE length(chunk) >= {fixed.MIN_CHUNK})"""


JOINED = f"""(SELECT doc_id // {q.TEXTS_JOINED} AS doc_id, string_agg(text, chr(10) ORDER BY doc_id) AS text
  FROM documents GROUP BY 1)"""

MARKED = """marked AS (
  SELECT conv_id, string_agg(
    CASE role WHEN 'assistant' THEN chr(10) || chr(10) || 'Assistant: '
              WHEN 'user' THEN chr(10) || chr(10) || 'Human: '
              ELSE chr(10) || chr(10) || 'System: ' END || text, '' ORDER BY turn) AS text
  FROM conversations GROUP BY 1)"""

IN_PROMPT = "before < length(p.prompt)"

MARK = "chr(10) || chr(10) || 'Assistant:'"


def dialogue_reply(c: str) -> str:
    tail = f"string_split({c}, {MARK})[-1]"
    return f"CASE WHEN contains({c}, {MARK}) THEN {strip(tail)} ELSE '' END"


PARSED = f"""{MARKED},
parsed AS (
  SELECT a.conv_id,
    CASE WHEN contains(a.text, {MARK})
         THEN array_to_string(string_split(a.text, {MARK})[:-2], {MARK}) || {MARK}
         ELSE a.text END AS prompt,
    {dialogue_reply("a.text")} AS chosen, {dialogue_reply("b.text")} AS rejected
  FROM marked a JOIN marked b ON b.conv_id = a.conv_id + 1),
turns AS (
  SELECT conv_id, turn,
    CASE role WHEN 'assistant' THEN chr(10) || chr(10) || 'Assistant: '
              WHEN 'user' THEN chr(10) || chr(10) || 'Human: '
              ELSE chr(10) || chr(10) || 'System: ' END || text AS text FROM conversations),
reach AS (
  SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM turns)"""

# The piece of the prompt in each turn; the replies stand where the prompt ends.
BY_TURN = """
SELECT conv_id, turn, left(r.text, greatest(0, length(p.prompt) - before)::BIGINT) AS prompt,
  CASE WHEN before + length(r.text) >= length(p.prompt) THEN chosen END AS chosen,
  CASE WHEN before + length(r.text) >= length(p.prompt) THEN rejected END AS rejected
FROM parsed p JOIN reach r USING (conv_id)"""

REPLIES = f"""{PAIR},
good AS (
  SELECT *, to_json([{{'question': prompt, 'answer': completion}}])::VARCHAR AS j,
    to_json([{{'question': prompt, 'answer': completion || ' [1]'}}])::VARCHAR AS jb,
    to_json([{{'question': prompt, 'answer': '012345678'}}])::VARCHAR AS js FROM pair),
replies AS (
  SELECT conv_id, turn, unnest([
    {{'kind': 'good', 'reply': 'Sure: ' || j || ' done [1]'}},
    {{'kind': 'bracket', 'reply': jb}},
    {{'kind': 'cut_off', 'reply': replace(j, '}}]', '')}},
    {{'kind': 'short', 'reply': js}},
    {{'kind': 'two', 'reply': '[{{"answer":"0123456789"}},' || j[2:]}},
    {{'kind': 'number', 'reply': '[{{"question":5}},' || j[2:]}},
    {{'kind': 'null', 'reply': '[{{"question":null}},' || j[2:]}},
    {{'kind': 'quotes',
      'reply': '[{{''question'':''q'',''answer'':''0123456789''}}]'}}], recursive := true)
  FROM good),
spans AS (
  SELECT *, regexp_extract(reply, '(?s)\\[.*?\\]') AS span FROM replies),
items AS (
  SELECT conv_id, turn, kind, from_json(span, '["JSON"]') AS items
  FROM spans WHERE CASE WHEN span = '' THEN false ELSE json_valid(span) END),
sound AS (
  SELECT * FROM items WHERE len(list_filter(items, lambda x:
    json_type(x) <> 'OBJECT'
    OR coalesce(json_type(x, '$.question'), 'VARCHAR') <> 'VARCHAR'
    OR coalesce(json_type(x, '$.answer'), 'VARCHAR') <> 'VARCHAR')) = 0),
fields AS (
  SELECT conv_id, turn, kind,
    {strip("coalesce(json_extract_string(x, '$.question'), '')")} AS instruction,
    {strip("coalesce(json_extract_string(x, '$.answer'), '')")} AS output
  FROM (SELECT conv_id, turn, kind, unnest(items) AS x FROM sound)),
qa AS (
  SELECT * FROM fields
  WHERE instruction <> '' AND length(output) >= {fixed.MIN_ANSWER})"""


def tokens(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '[a-z0-9]+')"


def common(a: str, b: str) -> str:
    """Longest common subsequence of two token lists, row by row of the full table."""
    row = (
        f"list_reduce(range(1, len({b}) + 1), lambda cur, j: list_append(cur, "
        f"CASE WHEN {b}[j] = x THEN r[j] + 1 ELSE greatest(r[j + 1], cur[j]) END), "
        "[0::BIGINT])"
    )
    zeros = f"list_transform(range(0, len({b}) + 1), lambda z: 0::BIGINT)"
    return (
        f"(CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 "
        f"ELSE list_reduce({a}, lambda r, x: {row}, {zeros})[-1] END)"
    )


def f1(n: str, a: str, b: str) -> str:
    p, r = f"{n}::DOUBLE / len({a})", f"{n}::DOUBLE / len({b})"
    return (
        f"(CASE WHEN {n} = 0 THEN 0::DOUBLE "
        f"ELSE 2 * ({p}) * ({r}) / ({p} + {r}) END)"
    )


MODEL = f"'turn_' || (turn % {inputs.MODELS})::VARCHAR"

SCORES = f"""{PAIR},
last AS (
  SELECT conv_id, arg_max(text, turn) AS text FROM conversations
  WHERE role = 'assistant' GROUP BY conv_id),
judged AS (
  SELECT p.conv_id AS sample_id, p.turn, {MODEL} AS model, p.completion,
    length(p.completion) / 100.0::DOUBLE AS elapsed_s,
    {tokens("p.completion")} AS a, {tokens("c.text")} AS b, {tokens("r.text")} AS d
  FROM pair p JOIN last c ON c.conv_id = p.conv_id
  JOIN last r ON r.conv_id = p.conv_id + 1),
counted AS MATERIALIZED (
  SELECT *, {common("a", "b")} AS nb, {common("a", "d")} AS nd FROM judged),
scores AS (
  SELECT sample_id, turn, model, elapsed_s,
    {f1("nb", "a", "b")} AS rouge_l, {f1("nd", "a", "d")} AS rouge_l_rejected,
    (CASE WHEN {f1("nb", "a", "b")} > {f1("nd", "a", "d")} THEN 1 ELSE 0 END)::BIGINT AS win,
    len(list_filter(regexp_split_to_array(completion, '{WS}+'), lambda w: w <> ''))::BIGINT
      AS n_words
  FROM counted)"""

METRICS = """avg(rouge_l) AS rouge_l_mean, max(rouge_l) AS rouge_l_max,
    avg(win) AS win_rate, avg(n_words) AS avg_length,
    avg(elapsed_s) AS avg_latency, sum(elapsed_s) AS total_time"""

SUMMARY = f"""{SCORES},
summary AS (SELECT model, {METRICS} FROM scores GROUP BY model)"""

ROUNDED = ", ".join(f"round({m}, 9) AS {m}" for m in ev.METRICS)

MIX_SOURCES = f"""{PAIR},
mixed AS (
  SELECT 'instruction' AS source, {PAIR_ID} AS id, prompt AS instruction,
         '' AS input, completion AS output FROM pair
  UNION ALL
  SELECT 'sentiment', doc_id, text, '', lang FROM documents)"""


def quota(quotas: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {n}" for k, n in quotas.items())
    return (
        "(SELECT * FROM mixed QUALIFY row_number() OVER (PARTITION BY source ORDER BY id) "
        f"<= CASE source {cases} END)"
    )


GRID = ", ".join(
    f"({i}, {text(a)}, {text(b)})" for i, (a, b) in enumerate(q.QUESTIONS)
)

ORACLE: dict[str, str] = {
    # Sources and sinks
    "jsonl_roundtrip": """
SELECT doc_id, 'Write a text in ' || lang AS instruction, source AS input, text AS output
FROM documents""",
    "jsonl_lenient": """
SELECT CASE WHEN lang <> 'fr' THEN doc_id END AS doc_id, CASE WHEN lang <> 'fr' THEN lang END AS lang,
  CASE WHEN lang <> 'fr' THEN source END AS source,
  CASE WHEN lang = 'fr' THEN '{"doc_id":' || doc_id END AS _corrupt_record FROM documents""",
    "text_files_kinds": """
SELECT DISTINCT lang, CASE WHEN lang = 'de' THEN '.json' ELSE '.txt' END AS extension,
  CASE WHEN lang = 'de' THEN 'rejected' ELSE 'read' END AS kind,
  CASE WHEN lang = 'de' THEN '' ELSE '_sft_data.jsonl' END AS output FROM documents""",
    "prefix_scan": f"""
SELECT doc_id, lang, source, text FROM documents ORDER BY doc_id LIMIT {q.PREFIX_ROWS}""",
    "text_files_scan": """
SELECT lang, '.txt' AS extension, unnest(string_split(text, chr(10))) AS line
FROM documents""",
    "partitioned_pairs": f"""
WITH pairs AS ({ALL_PAIRS})
SELECT doc_id, prompt, chosen, rejected, 'first' AS model FROM pairs
UNION ALL SELECT doc_id, prompt, rejected, chosen, 'second' FROM pairs""",
    "eval_results_json": f"WITH {SUMMARY} SELECT model, {ROUNDED} FROM summary",
    "write_if_absent": """
SELECT doc_id, text, true AS wrote_first, false AS wrote_again FROM documents""",
    # Projections and predicates
    "strip_text": f"""
SELECT doc_id, {strip("chr(9) || chr(160) || ' ' || text || chr(12288) || chr(31) || chr(10)")}
  AS text FROM documents""",
    "answer_stats": f"""
SELECT doc_id, replace(left(text, 100), chr(10), ' ') AS preview,
  regexp_matches(text, '\\p{{Nd}}') AS has_digit, length(text)::BIGINT AS n_chars,
  len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> ''))::BIGINT AS n_words
FROM documents""",
    "normalize_sentiment": """
SELECT doc_id AS id, text AS instruction, '' AS input, lang AS output FROM documents""",
    "normalize_question": """
SELECT doc_id, 'What is written in ' || lang AS instruction,
  CASE WHEN source = 'src0' THEN '' ELSE source END AS input, text AS output
FROM documents""",
    "render_prompt": f"""
WITH {PAIR} SELECT {PAIR_ID} AS id, {prompt("prompt")} AS prompt FROM pair""",
    "render_sft_text": f"""
WITH {PAIR} SELECT {PAIR_ID} AS id,
  {prompt("prompt")} || ' ' || {strip("completion")} AS text FROM pair""",
    "grpo_prompts": f"""
WITH {PAIR}, r AS (SELECT {PAIR_ID} AS id, {prompt("prompt")} AS prompt FROM pair)
SELECT id, prompt FROM r WHERE length(prompt) <= {fixed.MAX_PROMPT}""",
    "topic_subset": f"""
SELECT doc_id, lang FROM documents WHERE regexp_matches(text,
  '(?i)(^|[^\\p{{L}}\\p{{N}}_])({"|".join(q.KEYWORDS)})([^\\p{{L}}\\p{{N}}_]|$)')""",
    # Mixing
    "source_quota": f"""
WITH {MIX_SOURCES} SELECT source, id, instruction, output FROM {quota(q.QUOTAS)}""",
    "sft_mix": f"""
WITH {MIX_SOURCES}
SELECT md5('{fixed.SEED}:' || source || ':' || id) AS shuffle_key,
  source || ':' || id AS row_id,
  {prompt("instruction", "input")} || ' ' || {strip("output")} AS text
FROM {quota(fixed.SFT_QUOTAS)}""",
    "seeded_sample": f"""
SELECT md5('{fixed.SEED}:' || doc_id) AS shuffle_key, doc_id, text FROM documents
ORDER BY shuffle_key, doc_id LIMIT {fixed.NUM_EVAL_SAMPLES}""",
    # Preference triples
    "transcript_stitch": f"WITH {MARKED} SELECT conv_id, text FROM marked",
    "hh_parse": f"WITH {PARSED} {BY_TURN} WHERE {IN_PROMPT}",
    "hh_pairs": f"""
WITH {PARSED} {BY_TURN}
WHERE {IN_PROMPT} AND length(p.chosen) > 10 AND length(p.rejected) > 10""",
    "hh_parse_rows": f"WITH {PARSED} SELECT conv_id, prompt, chosen, rejected FROM parsed",
    "hh_pairs_rows": f"""
WITH {PARSED} SELECT conv_id, prompt, chosen, rejected FROM parsed
WHERE length(chosen) > 10 AND length(rejected) > 10""",
    "prefix_by_text": f"""
SELECT 'https://www.example.org/' || source || '/' || lang || '/' || lpad(doc_id::VARCHAR, 9, '0') AS url,
  doc_id, text
FROM documents ORDER BY url LIMIT {q.PREFIX_ROWS}""",
    "pref_pairs": ALL_PAIRS,
    "pref_pairs_first": f"""
{ALL_PAIRS} AND {READ} ORDER BY doc_id LIMIT {q.PAIRS_WANTED}""",
    "pref_pairs_accepted": f"{ALL_PAIRS} ORDER BY doc_id LIMIT {q.PAIRS_ACCEPTED}",
    "pref_pairs_counts": f"""
WITH {CANDIDATE},
flagged AS (SELECT doc_id, {LONG} AS long, {LONG} AND {USABLE} AS good FROM candidate
  WHERE {READ}),
running AS (SELECT *, coalesce(sum(good::INT) OVER (ORDER BY doc_id ROWS BETWEEN
  UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had FROM flagged),
stop AS (SELECT min(doc_id) AS at_id FROM running WHERE long AND had >= {q.PAIRS_WANTED})
SELECT (count(*) FILTER (good AND had < {q.PAIRS_WANTED}))::BIGINT AS accepted,
  (count(*) FILTER (NOT good AND (at_id IS NULL OR doc_id < at_id)))::BIGINT AS skipped
FROM running, stop""",
    "funnel_counts": f"""
WITH {CANDIDATE}, flags AS (
  SELECT {LONG} AS a, {LONG} AND {USABLE} AS b,
    {LONG} AND {USABLE} AND length(prompt) <= {fixed.MAX_PROMPT} AS c FROM candidate)
SELECT 0::BIGINT AS stage_no, 'read' AS stage, count(*) AS n_rows FROM flags
UNION ALL SELECT 1, 'chosen long enough', count(*) FROM flags WHERE a
UNION ALL SELECT 2, 'rejected usable', count(*) FROM flags WHERE b
UNION ALL SELECT 3, 'prompt fits', count(*) FROM flags WHERE c""",
    "score_pairs": f"""
WITH {PAIR},
rewarded AS (SELECT *, {all_rewards("completion", "prompt")} FROM pair),
scored AS (SELECT conv_id, turn, completion, {TOTAL} AS score FROM rewarded),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS best,
    row_number() OVER (PARTITION BY conv_id ORDER BY score, turn DESC) AS worst FROM scored)
SELECT b.conv_id, b.completion AS chosen, w.completion AS rejected,
  round(b.score, 9) AS chosen_score, round(w.score, 9) AS rejected_score
FROM ranked b JOIN ranked w USING (conv_id)
WHERE b.best = 1 AND w.worst = 1 AND b.score > w.score""",
    "post_pairs": f"""
WITH lines AS (
  SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS body,
    generate_subscripts(string_split(text, chr(10)), 1) AS position FROM documents),
ranked AS (
  SELECT *, length(body) AS score,
    row_number() OVER (PARTITION BY doc_id ORDER BY length(body) DESC, position) AS best,
    row_number() OVER (PARTITION BY doc_id ORDER BY length(body), position DESC) AS worst
  FROM lines)
SELECT b.doc_id, {prompt("b.lang", "b.source")} AS prompt, b.body AS chosen,
  w.body AS rejected
FROM ranked b JOIN ranked w USING (doc_id)
WHERE b.best = 1 AND w.worst = 1 AND b.score > w.score""",
    # Rewards
    "reward_length": ONE_REWARD.format(length_reward("text")),
    "reward_number": ONE_REWARD.replace("{}", number_reward("text")),
    "reward_no_repeat": ONE_REWARD.replace("{}", no_repeat_reward("text", LAST_LINE)),
    "reward_format": ONE_REWARD.format(format_reward("text")),
    "reward_combined": f"""
WITH r AS (SELECT doc_id, {all_rewards("text", LAST_LINE)} FROM documents)
SELECT *, round({TOTAL}, 9) AS reward FROM r""",
    "reward_custom": f"""
WITH r AS (SELECT doc_id, {length_reward("text")} AS length_reward,
  (length(text) - length(replace(text, ',', ''))) / (1 + length({LAST_LINE}))::DOUBLE
    AS commas FROM documents)
SELECT doc_id, length_reward, round(commas, 9) AS commas_reward,
  round(0.5::DOUBLE * length_reward + 0.25::DOUBLE * commas, 9) AS reward FROM r""",
    "prompt_fanout": f"""
WITH {PAIR}, r AS (SELECT {PAIR_ID} AS id, {prompt("prompt")} AS prompt FROM pair)
SELECT id, prompt, unnest(range(1, {fixed.COMPLETIONS_PER_PROMPT} + 1)) AS sample_id
FROM r WHERE length(prompt) <= {fixed.MAX_PROMPT}""",
    "group_advantage": f"""
WITH {PAIR}, r AS (SELECT conv_id, turn, {length_reward("completion")} AS reward FROM pair)
SELECT conv_id AS prompt_id, turn AS sample_id, reward,
  round(CASE WHEN count(*) OVER w = 1 THEN 0 ELSE (reward - avg(reward) OVER w)
    / (stddev_samp(reward) OVER w + 1e-4) END, 9) AS advantage
FROM r WINDOW w AS (PARTITION BY conv_id)""",
    # Documents
    "doc_chunks": f"""
WITH RECURSIVE {chunks(q.LINES)} SELECT doc_id, chunk_no, chunk FROM chunks""",
    "doc_chunks_blank_lines": f"""
WITH RECURSIVE {chunks("\\n{2,}")} SELECT doc_id, chunk_no, chunk FROM chunks""",
    "doc_chunks_large": f"""
WITH RECURSIVE {chunks(q.LINES, JOINED)}
SELECT doc_id AS text_no, chunk_no, chunk FROM chunks""",
    "chunk_stats": f"""
WITH RECURSIVE {chunks(q.LINES)},
n AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id)
SELECT lang, count(*) AS n_documents, sum(length(text))::BIGINT AS n_chars,
  coalesce(sum(n), 0)::BIGINT AS n_chunks
FROM documents LEFT JOIN n USING (doc_id) GROUP BY lang""",
    "render_qa_prompt": f"""
WITH RECURSIVE {chunks(q.LINES)}
SELECT doc_id, chunk_no, {text(fixed.QA_REQUEST_HEAD)} || chunk ||
  {text(fixed.QA_REQUEST_TAIL)} AS prompt FROM chunks""",
    "qa_extract": f"""
WITH {REPLIES} SELECT conv_id, turn, kind, instruction, '' AS input, output FROM qa""",
    "qa_refused": f"""
WITH {REPLIES} SELECT conv_id, turn, kind FROM replies ANTI JOIN qa USING (conv_id, turn, kind)""",
    "qa_stats": f"""
WITH {REPLIES},
n AS (SELECT kind, count(*) AS n FROM qa GROUP BY kind)
SELECT kind, n_replies, coalesce(n, 0)::BIGINT AS n_pairs
FROM (SELECT kind, count(*) AS n_replies FROM replies GROUP BY kind) LEFT JOIN n USING (kind)""",
    # Generation
    "batch_generate": f"""
WITH {PAIR}, r AS (SELECT {PAIR_ID} AS id, {prompt("prompt")} AS prompt FROM pair)
SELECT id, 'echo' AS model,
  CASE WHEN length(prompt) <= {q.TOO_LONG} THEN 'You said: ' || prompt END AS text,
  CASE WHEN length(prompt) > {q.TOO_LONG} THEN 'ValueError: prompt too long' END AS error
FROM r""",
    # Evaluation
    "rouge_l": f"""
WITH {PAIR},
t AS (SELECT conv_id, turn, {tokens("completion")} AS a, {tokens("prompt")} AS b FROM pair),
n AS (SELECT *, {common("a", "b")} AS n FROM t)
SELECT conv_id, turn, round({f1("n", "a", "b")}, 9) AS rouge_l FROM n""",
    "win_flag": f"""
WITH {SCORES}
SELECT sample_id, turn, model, round(rouge_l, 9) AS rouge_l,
  round(rouge_l_rejected, 9) AS rouge_l_rejected, win, n_words FROM scores""",
    "eval_summary": f"WITH {SUMMARY} SELECT model, {ROUNDED} FROM summary",
    "eval_filtered": f"""
WITH {SUMMARY} SELECT model, {ROUNDED} FROM summary
WHERE model IN ({", ".join(text(m) for m in q.MODELS_WANTED)})
  AND model IN (SELECT {MODEL} FROM conversations WHERE turn % {inputs.MODELS} < 2)""",
    "eval_best_model": f"""
WITH {SUMMARY}, long AS (
  SELECT 'rouge_l_mean' AS metric, model, round(rouge_l_mean, 9) AS value FROM summary
  UNION ALL SELECT 'win_rate', model, round(win_rate, 9) FROM summary)
SELECT metric, model, value FROM long
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) = 1""",
    "eval_adjacent_delta": f"""
WITH {SUMMARY}, b AS (
  SELECT *, lag(model) OVER w AS base_model, lag(rouge_l_mean) OVER w AS r,
    lag(win_rate) OVER w AS v FROM summary WINDOW w AS (ORDER BY model))
SELECT base_model, model,
  round((rouge_l_mean - r) / greatest(r, 1e-8) * 100, 9) AS rouge_delta_pct,
  round(win_rate - v, 9) AS win_delta FROM b WHERE base_model IS NOT NULL""",
    "model_question_grid": f"""
WITH {PAIR}, m AS (SELECT DISTINCT {MODEL} AS model FROM pair)
SELECT model, no::BIGINT AS question_no, instruction, input
FROM m, (VALUES {GRID}) AS g(no, instruction, input)""",
}
