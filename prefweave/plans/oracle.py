"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: the pair fixture is derived from
flat turns exactly as FIXTURES.md states it, statuses and templates use list
lambdas (DuckDB lambdas are 1-based and use the ``lambda x, i:`` syntax).
"""

from __future__ import annotations

from prefweave.functions.tokens import TOKEN_PATTERN

P = TOKEN_PATTERN  # contains no single quote

CONVS = """convs AS (
  SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages
  FROM conversations GROUP BY conv_id)"""

PAIRS = """fx_a AS (SELECT conv_id, max(CASE WHEN role = 'assistant' THEN turn END) AS fi
                FROM conversations GROUP BY conv_id),
fx_n AS (SELECT count(*) AS k FROM fx_a),
fx_last AS (SELECT a.conv_id, c.text FROM fx_a a JOIN conversations c
            ON c.conv_id = a.conv_id AND c.turn = a.fi),
fx_alt AS (SELECT a.conv_id, l.text AS alt_text FROM fx_a a CROSS JOIN fx_n n
           JOIN fx_last l ON l.conv_id = (a.conv_id + 1) % n.k),
fx_rej AS (
  SELECT c.conv_id, c.turn, c.role,
         CASE WHEN c.turn = a.fi THEN coalesce(alt.alt_text, c.text)
              WHEN a.conv_id % 13 = 0 AND c.turn = 0 AND a.fi > 0 THEN c.text || ' (edited)'
              ELSE c.text END AS text
  FROM conversations c JOIN fx_a a ON a.conv_id = c.conv_id
  LEFT JOIN fx_alt alt ON alt.conv_id = c.conv_id),
fx_cm AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m
          FROM conversations GROUP BY conv_id),
fx_rm AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m
          FROM fx_rej GROUP BY conv_id),
pairs AS (SELECT c.conv_id AS pair_id, c.m AS chosen, r.m AS rejected
          FROM fx_cm c JOIN fx_rm r ON r.conv_id = c.conv_id)"""


def _fi(m: str) -> str:
    return f"list_max(list_transform({m}, lambda x, i: CASE WHEN x.role = 'assistant' THEN i - 1 END))"


_ALT_VIOLATION = """list_filter(list_transform(pm, lambda x, i:
      CASE WHEN coalesce(x.role = 'user', false) <> ((i - 1) % 2 = 0) THEN 'roles_not_alternating'
           WHEN NOT coalesce(x.role IN ('user', 'assistant'), false) THEN 'unsupported_role'
           WHEN x.content IS NULL THEN 'null_content' END), lambda s: s IS NOT NULL)[1]"""
_CHATML_VIOLATION = """list_filter(list_transform(pm, lambda x:
      CASE WHEN x.role IS NULL THEN 'unsupported_role'
           WHEN x.content IS NULL THEN 'null_content' END), lambda s: s IS NOT NULL)[1]"""


def _final_violation(r: str, chatml: bool) -> str:
    role_bad = f"{r}.role IS NULL" if chatml else f"NOT coalesce({r}.role = 'assistant', false)"
    return f"CASE WHEN {role_bad} THEN 'unsupported_role' WHEN {r}.content IS NULL THEN 'null_content' END"


_ALT_RENDER = """array_to_string(list_transform(pm, lambda x:
      CASE WHEN x.role = 'user' THEN '[INST] ' || x.content || ' [/INST]'
           WHEN x.role = 'assistant' THEN ' ' || x.content || '</s>' END), '')"""
_CHATML_PIECE = "'<|im_start|>' || {x}.role || chr(10) || {x}.content || chr(10) || '<|im_end|>' || chr(10)"


def _varied(side: str) -> str:
    null_answer = "WHEN pair_id % 16 = 6 AND i - 1 = fi THEN NULL " if side == "rejected" else ""
    null_side = "WHEN pair_id % 16 = 1 THEN NULL " if side == "chosen" else ""
    return f"""CASE {null_side}WHEN pair_id % 16 = 2 AND fi IS NOT NULL THEN list_slice({side}, fi + 1, fi + 1)
     ELSE list_transform({side}, lambda x, i: {{
       'role': CASE WHEN pair_id % 16 = 3 AND i = 2 AND fi > 1 THEN 'tool' WHEN pair_id % 16 = 4 AND i = 1 AND fi > 0 THEN NULL
                    WHEN pair_id % 16 = 7 AND i = 1 AND fi > 0 THEN 'assistant' ELSE x.role END,
       'content': CASE WHEN pair_id % 16 = 5 AND i = 1 AND fi > 0 THEN NULL {null_answer}ELSE x.content END}}) END AS {side}"""


VARIED = f"""{PAIRS.replace("pairs AS (", "plain_pairs AS (")},
placed_pairs AS (SELECT *, {_fi('chosen')} AS fi FROM plain_pairs),
pairs AS (SELECT pair_id, {_varied('chosen')}, {_varied('rejected')} FROM placed_pairs)"""


def triplets_cte(chatml: bool = False, pairs: str = PAIRS) -> str:
    """CTEs ``tp_*`` ending in ``trip(pair_id, status, prompt, chosen, rejected)``."""
    if chatml:
        pm = ("CASE WHEN coalesce(pr[1].role = 'system', false) THEN pr "
              "ELSE list_prepend({'role': 'system', 'content': 'You are a helpful assistant.'}, pr) END")
        sys_rule = ""
        violation = _CHATML_VIOLATION
        render = f"array_to_string(list_transform(pm, lambda x: {_CHATML_PIECE.format(x='x')}), '')"
        final_c, final_r = _CHATML_PIECE.format(x="resp_c"), _CHATML_PIECE.format(x="resp_r")
    else:
        pm = "pr"
        sys_rule = "WHEN coalesce(pr[1].role = 'system', false) THEN 'system_not_supported'"
        violation = _ALT_VIOLATION
        render = _ALT_RENDER
        final_c, final_r = "resp_c.content || '</s>'", "resp_r.content || '</s>'"
    return f"""{pairs},
tp_idx AS (SELECT pair_id, chosen, rejected, {_fi('chosen')} AS ci, {_fi('rejected')} AS ri FROM pairs),
tp_parts AS (SELECT pair_id, ci, ri, chosen IS NULL OR rejected IS NULL AS null_conv,
                    list_slice(chosen, 1, ci) AS pr, list_slice(rejected, 1, ri) AS rr,
                    chosen[ci + 1] AS resp_c, rejected[ri + 1] AS resp_r FROM tp_idx),
tp_pm AS (SELECT *, {pm} AS pm FROM tp_parts),
tp_st AS (
  SELECT pair_id, pm, resp_c, resp_r,
         CASE WHEN null_conv THEN 'null_conversation'
              WHEN ci IS NULL OR ri IS NULL THEN 'no_assistant'
              WHEN pr IS DISTINCT FROM rr THEN 'prefix_mismatch'
              WHEN ci = 0 THEN 'empty_prompt'
              {sys_rule}
              ELSE coalesce({violation}, {_final_violation('resp_c', chatml)},
                            {_final_violation('resp_r', chatml)}, 'ok') END AS status
  FROM tp_pm),
trip AS (
  SELECT pair_id, status,
         CASE WHEN status = 'ok' THEN {render} END AS prompt,
         CASE WHEN status = 'ok' THEN {final_c} END AS chosen,
         CASE WHEN status = 'ok' THEN {final_r} END AS rejected
  FROM tp_st)"""


SPLIT = f"""{triplets_cte()},
ok AS (SELECT pair_id, prompt, chosen, rejected FROM trip WHERE status = 'ok'),
sp_rank AS (SELECT pair_id,
                   row_number() OVER (ORDER BY md5('7:' || CAST(pair_id AS VARCHAR)), pair_id) AS rn,
                   count(*) OVER () AS n FROM ok),
split AS (SELECT o.*, CASE WHEN r.rn <= CAST(floor(0.2 * r.n) AS BIGINT) THEN 'test' ELSE 'train' END AS split
          FROM ok o JOIN sp_rank r ON r.pair_id = o.pair_id)"""

LENGTHS = f"""{SPLIT},
lens AS (SELECT pair_id, split,
                CAST(len(regexp_extract_all(prompt, '{P}')) AS BIGINT) AS prompt_len,
                CAST(len(regexp_extract_all(prompt || chosen, '{P}')) AS BIGINT) AS prompt_chosen_len,
                CAST(len(regexp_extract_all(prompt || rejected, '{P}')) AS BIGINT) AS prompt_rejected_len
         FROM split),
lim0 AS (SELECT CAST(floor(quantile_cont(prompt_len, 0.97)) AS BIGINT) AS prompt_length,
                CAST(floor(quantile_cont(prompt_chosen_len, 0.97)) AS BIGINT) AS max_seq_length_chosen,
                CAST(floor(quantile_cont(prompt_rejected_len, 0.97)) AS BIGINT) AS max_seq_length_rejected
         FROM lens WHERE split = 'train'),
lim AS (SELECT *, greatest(max_seq_length_chosen, max_seq_length_rejected) AS max_seq_length FROM lim0)"""

def _quarter(i: int) -> str:
    return f"list_sum(list_transform(list_slice(embedding, {i} * q + 1, {i} * q + q), lambda c: CAST(c AS DOUBLE))) * 100"


LOGPROBS = f"""lp AS (SELECT CAST(floor(vec_id / 4) AS BIGINT) + 1 AS step, vec_id AS pair_id,
                  {_quarter(0)} AS pol_c, {_quarter(1)} AS pol_r, {_quarter(2)} AS ref_c, {_quarter(3)} AS ref_r
           FROM (SELECT *, len(embedding) // 4 AS q FROM embeddings)),
m1 AS (SELECT *, 0.1 * (pol_c - ref_c) AS reward_chosen, 0.1 * (pol_r - ref_r) AS reward_rejected FROM lp),
m2 AS (SELECT *, reward_chosen - reward_rejected AS margin FROM m1),
m3 AS (SELECT *, greatest(-margin, 0) + ln(1 + exp(-abs(margin))) AS loss, margin > 0 AS correct FROM m2)"""

SUMMARY_COLS = """count(*) AS n_pairs, round(avg(loss), 6) AS loss, round(avg(margin), 6) AS margin,
       round(avg(CAST(correct AS DOUBLE)), 6) AS accuracy, round(avg(reward_chosen), 6) AS reward_chosen,
       round(avg(reward_rejected), 6) AS reward_rejected"""

ANSWERS = """ans AS (SELECT doc_id // 40 AS question_id, CAST((doc_id // 20) % 2 + 1 AS INTEGER) AS turn,
                   source AS model, n_chars
            FROM documents)"""

MATCHUPS = f"""{ANSWERS},
mu AS (SELECT a.question_id, a.turn, a.model AS model_a, b.model AS model_b,
              a.n_chars AS n_chars_a, b.n_chars AS n_chars_b
       FROM ans a JOIN ans b ON a.question_id = b.question_id AND a.turn = b.turn AND a.model < b.model)"""


def _last_n(t: str, n: int) -> str:
    return f"list_slice({t}, greatest(1, len({t}) - {n} + 1), len({t}))"


ORACLE_SQL: dict[str, str] = {
    "turns_to_messages": f"""WITH {CONVS}
SELECT conv_id, CAST(len(messages) AS BIGINT) AS n_messages,
       array_to_string(list_transform(messages, lambda x: x.role || ': ' || x.content), chr(10)) AS transcript
FROM convs""",

    "final_assistant": f"""WITH {CONVS}
SELECT conv_id, {_fi('messages')} AS final_idx,
       list_filter(messages, lambda x: x.role = 'assistant')[-1].content AS final_content
FROM convs""",

    "prompt_and_response": f"""WITH {CONVS},
f AS (SELECT conv_id, messages, {_fi('messages')} AS fi FROM convs),
p AS (SELECT conv_id, CASE WHEN fi IS NOT NULL THEN list_slice(messages, 1, fi) END AS pm,
             messages[fi + 1] AS resp FROM f)
SELECT conv_id, CAST(len(pm) AS BIGINT) AS n_prompt_messages,
       array_to_string(list_transform(pm, lambda x: x.role), ',') AS prompt_roles,
       resp.content AS response_content
FROM p""",

    "prompt_and_response_flat": f"""WITH r AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS idx
  FROM conversations),
f AS (SELECT conv_id, max(idx) AS fi FROM r WHERE role = 'assistant' GROUP BY conv_id)
SELECT r.conv_id, r.idx, CASE WHEN r.idx = f.fi THEN 'response' ELSE 'prompt' END AS part, r.role, r.text
FROM r JOIN f ON f.conv_id = r.conv_id WHERE r.idx <= f.fi""",

    "pair_status": f"WITH {triplets_cte()}\nSELECT pair_id, status FROM trip",

    "triplets_alternating": f"""WITH {triplets_cte()}
SELECT pair_id, prompt, chosen, rejected FROM trip WHERE status = 'ok'""",

    "triplets_chatml": f"""WITH {triplets_cte(chatml=True)}
SELECT pair_id, prompt, chosen, rejected FROM trip WHERE status = 'ok'""",

    "prompts_upstream_template": f"""WITH {CONVS},
v AS (SELECT conv_id, messages, coalesce(list_filter(list_transform(messages, lambda x, i:
        CASE WHEN coalesce(x.role = 'user', false) <> ((i - 1) % 2 = 0) THEN 'roles_not_alternating'
             WHEN NOT coalesce(x.role IN ('user', 'assistant'), false) THEN 'unsupported_role'
             WHEN x.content IS NULL THEN 'null_content' END), lambda s: s IS NOT NULL)[1], 'ok') AS status
      FROM convs)
SELECT conv_id, status,
       CASE WHEN status = 'ok' THEN '<s>' || array_to_string(list_transform(messages, lambda x:
            CASE WHEN x.role = 'user' THEN '[INST] ' || x.content || ' [/INST]'
                 WHEN x.role = 'assistant' THEN x.content || '</s>' END), '') END AS text
FROM v""",

    "templated_eval_prompts": """SELECT item_id AS pos, '[INST] ' || text || ' [/INST]' AS templated
FROM benchmark""",

    "sample_n": f"""WITH {PAIRS}
SELECT pair_id FROM pairs ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT 70""",

    "train_test_split": f"WITH {SPLIT}\nSELECT pair_id, split FROM split",

    "json_round_trip": f"WITH {SPLIT}\nSELECT pair_id, prompt, chosen, rejected, split FROM split",

    "pairs_json_round_trip": f"""WITH {PAIRS}
SELECT pair_id, CAST(len(chosen) AS BIGINT) AS n_chosen, CAST(len(rejected) AS BIGINT) AS n_rejected,
       array_to_string(list_transform(chosen, lambda x: x.role || ': ' || x.content), chr(10)) AS chosen_text,
       array_to_string(list_transform(rejected, lambda x: x.role || ': ' || x.content), chr(10)) AS rejected_text
FROM pairs""",

    "prepare_sampled": f"""WITH {triplets_cte()},
sampled AS (SELECT pair_id FROM pairs ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT 70),
ok AS (SELECT t.pair_id, t.prompt, t.chosen, t.rejected FROM trip t JOIN sampled s ON s.pair_id = t.pair_id
       WHERE t.status = 'ok'),
r AS (SELECT pair_id, row_number() OVER (ORDER BY md5('7:' || CAST(pair_id AS VARCHAR)), pair_id) AS rn,
             count(*) OVER () AS n FROM ok)
SELECT o.pair_id, o.prompt, o.chosen, o.rejected,
       CASE WHEN r.rn <= CAST(floor(0.2 * r.n) AS BIGINT) THEN 'test' ELSE 'train' END AS split
FROM ok o JOIN r ON r.pair_id = o.pair_id""",

    "dataset_profile": f"""WITH {SPLIT}
SELECT split, count(*) AS n_rows,
       CAST(min(length(prompt)) AS BIGINT) AS min_prompt_chars, CAST(max(length(prompt)) AS BIGINT) AS max_prompt_chars,
       CAST(min(length(chosen)) AS BIGINT) AS min_chosen_chars, CAST(max(length(chosen)) AS BIGINT) AS max_chosen_chars,
       CAST(min(length(rejected)) AS BIGINT) AS min_rejected_chars,
       CAST(max(length(rejected)) AS BIGINT) AS max_rejected_chars,
       min(pair_id) AS first_pair_id, arg_min(prompt, pair_id) AS first_prompt,
       arg_min(chosen, pair_id) AS first_chosen, arg_min(rejected, pair_id) AS first_rejected
FROM split GROUP BY split""",

    "length_limits": f"""WITH {LENGTHS}
SELECT prompt_length, max_seq_length_chosen, max_seq_length_rejected, max_seq_length,
       CAST(((prompt_length + 1) // 2) * 2 AS BIGINT) AS prompt_length_even,
       CAST(((max_seq_length + 1) // 2) * 2 AS BIGINT) AS max_seq_length_even
FROM lim""",

    "length_filtered": f"""WITH {LENGTHS}
SELECT pair_id, split, prompt_chosen_len FROM lens
WHERE prompt_chosen_len <= (SELECT max_seq_length FROM lim)""",

    "left_truncated": f"""WITH {triplets_cte()},
tk AS (SELECT pair_id, regexp_extract_all(prompt, '{P}') AS pt, regexp_extract_all(chosen, '{P}') AS ct
       FROM trip WHERE status = 'ok'),
t1 AS (SELECT pair_id, {_last_n('pt', 64)} AS ptk, ct FROM tk),
t2 AS (SELECT pair_id, ptk, list_concat(ptk, ct) AS s FROM t1),
t3 AS (SELECT pair_id, ptk, {_last_n('s', 96)} AS seq FROM t2)
SELECT pair_id, CAST(len(ptk) AS BIGINT) AS n_prompt_tokens, CAST(len(seq) AS BIGINT) AS n_sequence_tokens,
       array_to_string(seq, ' ') AS sequence_text
FROM t3""",

    "prompt_batches": """SELECT CAST(floor(item_id / 7) AS BIGINT) AS batch_id, count(*) AS n_prompts,
       string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS positions
FROM benchmark GROUP BY 1""",

    "positioned_batches": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM labels)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, CAST(floor(pos / 7) AS BIGINT) AS batch_id FROM r""",

    "padded_batches": f"""WITH t AS (SELECT item_id AS pos, CAST(floor(item_id / 8) AS BIGINT) AS batch_id,
                  regexp_extract_all('[INST] ' || text || ' [/INST]', '{P}') AS tokens FROM benchmark),
w AS (SELECT *, max(len(tokens)) OVER (PARTITION BY batch_id) AS width FROM t)
SELECT pos, batch_id, CAST(width AS BIGINT) AS width, CAST(width - len(tokens) AS BIGINT) AS n_pad,
       CAST(len(tokens) AS BIGINT) AS mask_sum,
       array_to_string(list_concat(list_transform(range(width - len(tokens)), lambda x: '</s>'), tokens), ' ')
         AS input_text
FROM w""",

    "padded_fixed_width": f"""WITH t AS (SELECT item_id AS pos, CAST(floor(item_id / 8) AS BIGINT) AS batch_id,
                  regexp_extract_all('[INST] ' || text || ' [/INST]', '{P}') AS tokens FROM benchmark),
c AS (SELECT pos, batch_id, {_last_n('tokens', 32)} AS cut FROM t)
SELECT pos, batch_id, CAST(32 AS BIGINT) AS width, CAST(len(cut) AS BIGINT) AS mask_sum,
       array_to_string(list_concat(list_transform(range(32 - len(cut)), lambda x: '</s>'), cut), ' ')
         AS input_text
FROM c""",

    "preference_row_metrics": f"""WITH {LOGPROBS}
SELECT step, pair_id, round(reward_chosen, 6) AS reward_chosen, round(reward_rejected, 6) AS reward_rejected,
       round(margin, 6) AS margin, round(loss, 6) AS loss, CAST(correct AS BIGINT) AS correct
FROM m3""",

    "preference_summary": f"WITH {LOGPROBS}\nSELECT {SUMMARY_COLS} FROM m3",

    "preference_metric_log": f"""WITH {LOGPROBS}
SELECT CAST((floor((step - 1) / 25) + 1) * 25 AS BIGINT) AS log_step, max(step) AS last_step,
       CAST(max(step) % 25 = 0 AS BIGINT) AS complete, {SUMMARY_COLS}
FROM m3 GROUP BY 1""",

    "pairwise_matchups": f"WITH {MATCHUPS}\nSELECT * FROM mu",

    "baseline_matchups": f"""WITH {ANSWERS}
SELECT a.question_id, a.turn, a.model, 'src0' AS baseline, a.n_chars, b.n_chars AS baseline_n_chars
FROM ans a JOIN ans b ON a.question_id = b.question_id AND a.turn = b.turn AND b.model = 'src0'
WHERE a.model <> 'src0'""",

    "pairwise_win_rates": f"""WITH {MATCHUPS},
j AS (SELECT model_a, model_b,
             CASE WHEN abs(n_chars_a - n_chars_b) * 10 <= greatest(n_chars_a, n_chars_b) THEN 'tie'
                  WHEN n_chars_a > n_chars_b THEN 'a' ELSE 'b' END AS winner FROM mu),
s AS (SELECT model_a AS model, CAST(winner = 'a' AS BIGINT) AS win, CAST(winner = 'b' AS BIGINT) AS loss,
             CAST(winner = 'tie' AS BIGINT) AS tie FROM j
      UNION ALL
      SELECT model_b, CAST(winner = 'b' AS BIGINT), CAST(winner = 'a' AS BIGINT), CAST(winner = 'tie' AS BIGINT)
      FROM j),
c AS (SELECT model, CAST(sum(win) AS BIGINT) AS win, CAST(sum(loss) AS BIGINT) AS loss,
             CAST(sum(tie) AS BIGINT) AS tie FROM s GROUP BY model)
SELECT model, win, loss, tie, round(win / (win + loss + tie), 6) AS win_rate,
       round(loss / (win + loss + tie), 6) AS loss_rate,
       round((win + 0.5 * tie) / (win + loss + tie), 6) AS win_rate_adjusted
FROM c""",

    "baseline_win_rates": f"""WITH {ANSWERS},
j AS (SELECT a.model AS model_a, b.model AS model_b,
             CASE WHEN abs(a.n_chars - b.n_chars) * 10 <= greatest(a.n_chars, b.n_chars) THEN 'tie'
                  WHEN a.n_chars > b.n_chars THEN 'a' ELSE 'b' END AS winner
      FROM ans a JOIN ans b ON a.question_id = b.question_id AND a.turn = b.turn AND b.model = 'src0'
      WHERE a.model <> 'src0'),
s AS (SELECT model_a AS model, CAST(winner = 'a' AS BIGINT) AS win, CAST(winner = 'b' AS BIGINT) AS loss,
             CAST(winner = 'tie' AS BIGINT) AS tie FROM j
      UNION ALL
      SELECT model_b, CAST(winner = 'b' AS BIGINT), CAST(winner = 'a' AS BIGINT), CAST(winner = 'tie' AS BIGINT)
      FROM j),
c AS (SELECT model, CAST(sum(win) AS BIGINT) AS win, CAST(sum(loss) AS BIGINT) AS loss,
             CAST(sum(tie) AS BIGINT) AS tie FROM s GROUP BY model)
SELECT model, win, loss, tie, round(win / (win + loss + tie), 6) AS win_rate,
       round(loss / (win + loss + tie), 6) AS loss_rate,
       round((win + 0.5 * tie) / (win + loss + tie), 6) AS win_rate_adjusted
FROM c""",

    "score_summary": """SELECT d.source AS model, 1 AS turn, count(*) AS n_scores,
       round(avg(CAST(1 + 6 * l.quality + 3 * (1 - l.toxic) AS DOUBLE)), 6) AS avg_score
FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source""",
}

ORACLE_SQL["preference_metric_log_stream"] = ORACLE_SQL["preference_metric_log"]
ORACLE_SQL["preference_eval_log"] = f"""WITH {LOGPROBS},
per_step AS (SELECT step, {SUMMARY_COLS} FROM m3 GROUP BY step),
points AS (SELECT unnest(range(70, (SELECT max(step) FROM m3) + 1, 70)) AS eval_step)
SELECT p.eval_step, s.step AS last_step, s.n_pairs, s.loss, s.margin, s.accuracy, s.reward_chosen, s.reward_rejected
FROM points p ASOF JOIN per_step s ON p.eval_step >= s.step"""
ORACLE_SQL["prepare_outcome"] = f"""WITH {triplets_cte()},
o AS (SELECT t.pair_id, t.status, row_number() OVER (ORDER BY md5('42:' || CAST(t.pair_id AS VARCHAR)), t.pair_id) AS place
      FROM trip t),
s AS (SELECT pair_id, status, row_number() OVER (PARTITION BY status = 'ok'
                                                 ORDER BY md5('7:' || CAST(pair_id AS VARCHAR)), pair_id) AS rn,
             count(*) FILTER (WHERE status = 'ok') OVER () AS n FROM o WHERE place <= 70)
SELECT pair_id, CASE WHEN status <> 'ok' THEN status
                     WHEN rn <= CAST(floor(0.2 * n) AS BIGINT) THEN 'test' ELSE 'train' END AS outcome
FROM s"""
ORACLE_SQL["keyless_pairs"] = f"""WITH {PAIRS},
k AS (SELECT CAST('0x' || substr(md5(CAST(to_json({{'chosen': chosen, 'rejected': rejected}}) AS VARCHAR)), 1, 15) AS BIGINT)
             AS pair_id FROM pairs),
s AS (SELECT pair_id FROM k ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)) LIMIT 70),
r AS (SELECT pair_id, row_number() OVER (ORDER BY md5('7:' || CAST(pair_id AS VARCHAR))) AS rn, count(*) OVER () AS n FROM s)
SELECT pair_id, CASE WHEN rn <= CAST(floor(0.2 * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM r"""

_OUTCOMES = f"({ORACLE_SQL['prepare_outcome']})"
ORACLE_SQL["prepare_outcome_counts"] = f"SELECT outcome, count(*) AS n_pairs FROM {_OUTCOMES} GROUP BY outcome"
ORACLE_SQL["prepare_growing"] = ORACLE_SQL["json_round_trip"]
ORACLE_SQL["triplets_strict"] = ORACLE_SQL["triplets_alternating"]
# Templates given as text must give the same rows as the built-in ones.
ORACLE_SQL["triplets_template_text"] = ORACLE_SQL["triplets_alternating"]
ORACLE_SQL["prompts_template_text"] = ORACLE_SQL["prompts_upstream_template"]
ORACLE_SQL["pair_status_varied"] = f"WITH {triplets_cte(pairs=VARIED)}\nSELECT pair_id, status FROM trip"

# The flat forms give the rows of the array forms.
ORACLE_SQL["final_assistant_flat"] = ORACLE_SQL["final_assistant"]
ORACLE_SQL["pair_status_flat"] = ORACLE_SQL["pair_status"]


def _feistel(source: str, n: str, seed: int = 42, rounds: int = 8) -> str:
    """CTE ``walked(pos, place)``: the network written out, walked on up to 24 times."""
    from prefweave.operators.permutation import PRIME, round_keys

    def h(x: str, key: tuple[int, int, int]) -> str:
        k, m, c = key
        t = f"(({x} + {k}) % {PRIME})"
        return f"(({t} * {t} % {PRIME} * {m} + {c}) % {PRIME})"

    def once(x: str) -> str:
        sub = f"SELECT pos, a, b, {x} // b AS l, {x} % b AS r FROM src0"
        for i, key in enumerate(round_keys(seed, rounds)):
            new = f"(l + {h('r', key)}) % a AS l, r" if i % 2 == 0 else f"l, (r + {h('l', key)}) % b AS r"
            sub = f"SELECT pos, a, b, {new} FROM ({sub})"
        return sub

    step = once("x").replace("FROM src0", "FROM walk WHERE x >= n OR fresh")
    step = step.replace("pos, a, b", "pos, n, a, b")
    return f"""base AS ({source}),
size AS (SELECT n, a, CAST(ceil(CAST(n AS DOUBLE) / a) AS BIGINT) AS b FROM (
  SELECT {n} AS n, CAST(ceil(sqrt({n})) AS BIGINT) AS a FROM base)),
walk AS (SELECT pos, n, a, b, pos AS x, true AS fresh FROM base, size
  UNION ALL SELECT pos, n, a, b, l * b + r AS x, false AS fresh FROM ({step})),
walked AS (SELECT pos, x AS place FROM walk WHERE NOT fresh AND x < n)"""


ORACLE_SQL["shuffled_positions"] = f"""WITH RECURSIVE {PAIRS},
{_feistel("SELECT pair_id AS pos FROM pairs", "count(*)")}
SELECT pos AS pair_id, place FROM walked"""

# Words in the vocabulary are one token, others one a character.
ORACLE_SQL["length_limits_vocabulary"] = f"""WITH {SPLIT},
words AS (SELECT unnest(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS w FROM conversations),
vocab AS (SELECT w FROM words GROUP BY w ORDER BY count(*) DESC, w LIMIT 500),
pieces AS (SELECT pair_id, split, 'p' AS k, prompt AS t FROM split
           UNION ALL SELECT pair_id, split, 'c', prompt || chosen FROM split
           UNION ALL SELECT pair_id, split, 'r', prompt || rejected FROM split),
cut AS (SELECT pair_id, split, k, unnest(regexp_extract_all(t, '[^ \\t\\n\\x0B\\f\\r]+')) AS w FROM pieces),
counts AS (SELECT pair_id, split, k, sum(CASE WHEN w IN (SELECT w FROM vocab) THEN 1 ELSE length(w) END) AS n
           FROM cut GROUP BY pair_id, split, k),
lim0 AS (SELECT CAST(floor(quantile_cont(n, 0.97) FILTER (WHERE k = 'p')) AS BIGINT) AS prompt_length,
                CAST(floor(quantile_cont(n, 0.97) FILTER (WHERE k = 'c')) AS BIGINT) AS max_seq_length_chosen,
                CAST(floor(quantile_cont(n, 0.97) FILTER (WHERE k = 'r')) AS BIGINT) AS max_seq_length_rejected
         FROM counts WHERE split = 'train'),
lim AS (SELECT *, greatest(max_seq_length_chosen, max_seq_length_rejected) AS max_seq_length FROM lim0)
SELECT prompt_length, max_seq_length_chosen, max_seq_length_rejected, max_seq_length,
       CAST(((prompt_length + 1) // 2) * 2 AS BIGINT) AS prompt_length_even,
       CAST(((max_seq_length + 1) // 2) * 2 AS BIGINT) AS max_seq_length_even
FROM lim"""
