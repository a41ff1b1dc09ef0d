"""The registered queries once more, as DuckDB SQL over the same tables.

Written at turn and token grain with windows, joins and regular expressions,
where the Spark side works on arrays and substrings.
"""

from __future__ import annotations

from ..functions.tokens import TOKEN_PATTERN
from ..operators.rendering import DEFAULT_SYSTEM
from .inputs import VARIED_TURNS_SQL
from .queries import HISTORY_BUDGET, LIST_LIMIT, TURN_LIMIT

_WS = "(' ' || chr(9) || chr(10) || chr(13))"
_THINK = r"(?s)<think>\s*(.*?)\s*</think>\s*"
_NL = "chr(10)"


def _toks(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN_PATTERN}')"


def _trim(c: str) -> str:
    return f"trim({c}, {_WS})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


VARIED = f"varied AS ({VARIED_TURNS_SQL})"

# Raw conversations in the shape of the varied turns.
PLAIN = """varied AS (
  SELECT conv_id, turn, role, text AS content, NULL::VARCHAR AS reasoning_content,
         NULL::VARCHAR AS reasoning, NULL::VARCHAR AS thinking, NULL::VARCHAR AS tools
  FROM conversations)"""

# Tool schemas, lists of objects, in one spelling: each key once, in its first place, with its last value.
_SPELLED = """tool_pairs AS (
  SELECT tools, i, key, min(rowid) AS place, arg_max(value::VARCHAR, rowid) AS v
  FROM (SELECT tools, unnest(range(json_array_length(tools)::BIGINT)) AS i
        FROM (SELECT DISTINCT tools FROM {0} WHERE json_valid(tools))) t,
    json_each(json_extract(t.tools, '$[' || t.i || ']')) GROUP BY ALL),
spelled AS (
  SELECT tools AS given, '[' || string_agg(o, ',' ORDER BY i) || ']' AS text
  FROM (SELECT tools, i, '{{' || string_agg(to_json(key) || ':' || v, ',' ORDER BY place) || '}}' AS o
        FROM tool_pairs GROUP BY ALL) GROUP BY tools)"""


def _canonical(source: str, key: str, think: bool = True, drop: bool = False) -> str:
    """CTEs from a turn table to canonical turns ``canon`` (think turns still flagged)."""
    blank = f"coalesce({_trim('reasoning_content')}, '') = ''"
    found = f"role = 'assistant' AND regexp_matches(content, '{_THINK}')" if think else "false"
    cleared = "CASE WHEN r2 IS NOT NULL THEN '' END" if drop else "r2"
    dropped = "role = 'think'" if drop else "false"
    return f"""{_SPELLED.format(source)},
cleaned AS (
  SELECT {key}, turn, {_trim('coalesce(role, $$$$)')} AS role, coalesce(content, '') AS content,
         reasoning_content, reasoning, thinking, tools
  FROM {source}
  WHERE NOT ({_trim('coalesce(role, $$$$)')} = 'system' AND {_trim('coalesce(content, $$$$)')} = '')),
settled AS (
  SELECT {key}, turn, role, content, tools,
    coalesce(nullif({_trim('reasoning')}, ''), nullif({_trim('thinking')}, '')) AS other,
    CASE WHEN {blank} THEN coalesce(nullif({_trim('reasoning')}, ''),
      nullif({_trim('thinking')}, ''), reasoning_content) ELSE reasoning_content END AS r1,
    {blank} AS was_blank
  FROM cleaned),
thought AS (
  SELECT {key}, turn, role, tools, (was_blank AND other IS NOT NULL)::BIGINT AS moved,
    ({found})::BIGINT AS extracted,
    CASE WHEN {found} THEN ltrim(regexp_replace(content, '{_THINK}', ''), {_WS})
      ELSE content END AS content,
    CASE WHEN {found} AND coalesce({_trim('r1')}, '') = ''
      THEN regexp_extract(content, '{_THINK}', 1) ELSE r1 END AS r2
  FROM settled),
canon AS (
  SELECT {key}, turn, role, content, moved, extracted, {cleared} AS r, {dropped} AS is_dropped,
    CASE WHEN {_trim('tools')} = '' THEN NULL WHEN text IS NOT NULL THEN text ELSE tools END AS tools,
    tools IS NOT NULL AND json_valid(tools) AS tools_from_string
  FROM thought LEFT JOIN spelled ON tools = given)"""


def _render(r: str, extra: str = "''") -> str:
    """Rendered message; ``extra`` stands before the end marker."""
    return f"""('<|im_start|>' || role || {_NL}
      || CASE WHEN role = 'assistant' AND coalesce({r}, '') <> ''
           THEN '<think>' || {_NL} || {r} || {_NL} || '</think>' || {_NL} || {_NL} ELSE '' END
      || content || {extra} || '<|im_end|>' || {_NL})"""


_SCHEMAS = f"('# Tools' || {_NL} || '<tools>' || {_NL} || tools || {_NL} || '</tools>')"
_BLOCK = f"('<|im_start|>system' || {_NL} || {_SCHEMAS} || '<|im_end|>' || {_NL})"


def _first(r: str) -> str:
    """Rendered first message, with tool schemas."""
    inside = _render(r, f"{_NL} || {_NL} || {_SCHEMAS}")
    return f"""CASE WHEN tools IS NULL THEN {_render(r)} WHEN role = 'system' THEN {inside}
      ELSE {_BLOCK} || {_render(r)} END"""


def _pieces(key: str) -> str:
    return f"""pieces AS (
  SELECT {key}, turn, role, content, r, tools,
    {_render('r')} AS piece, {_first('r')} AS first_piece,
    row_number() OVER (PARTITION BY {key} ORDER BY turn) - 1 AS i
  FROM canon WHERE NOT is_dropped)"""


def _fitted(key: str, limit: int, filtered: bool = True) -> str:
    """CTEs to ``fitted``: kept turns with final reasoning, and ``lengths`` per key."""
    keep = "WHERE last IS NOT NULL" if filtered else ""
    return f"""counted AS (
  SELECT *, len({_toks('piece')}) AS n, len({_toks('first_piece')}) - len({_toks('piece')}) AS lead
  FROM pieces),
conv AS (
  SELECT {key}, max(CASE WHEN i = 0 AND role = 'system' THEN 1 ELSE 0 END) AS head,
    max(CASE WHEN role = 'assistant' THEN i END) AS last, sum(n)::BIGINT + min_by(lead, i) AS raw,
    min_by(lead, i) AS lead0, min_by(n, i) AS n0
  FROM counted GROUP BY {key}),
kept_conv AS (
  SELECT *, CASE WHEN last IS NOT NULL THEN greatest(head, last - 1) END AS tail,
    last IS NOT NULL AND raw > {limit} AS over
  FROM conv {keep}),
starts AS (
  SELECT {key}, c.i, k.head * k.n0 + CASE WHEN k.head = 1 THEN k.lead0 ELSE c.lead END
    + sum(c.n) OVER (PARTITION BY {key} ORDER BY c.i
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS total
  FROM counted c JOIN kept_conv k USING ({key}) WHERE c.i >= k.head),
chosen AS (
  SELECT {key}, any_value(k.head) AS head, any_value(k.tail) AS tail, any_value(k.raw) AS raw,
    any_value(k.over) AS over, any_value(k.last) AS last,
    CASE WHEN any_value(k.over) THEN coalesce(
      min(CASE WHEN s.i < k.tail AND s.total <= {limit} THEN s.i END), any_value(k.tail))
      ELSE any_value(k.head) END AS start,
    max(CASE WHEN s.i = k.tail THEN s.total END) AS anchors
  FROM kept_conv k JOIN starts s USING ({key}) GROUP BY {key}),
thinkers AS (
  SELECT c.*, h.anchors, row_number() OVER (PARTITION BY {key} ORDER BY c.i) AS nth
  FROM counted c JOIN chosen h USING ({key})
  WHERE h.over AND h.start = h.tail AND c.i >= h.tail AND c.role = 'assistant'
    AND coalesce({_trim('c.r')}, '') <> ''),
tries AS (
  SELECT *, length(r) >> k AS chars, len({_toks(_render('left(r, (length(r) >> k)::BIGINT)'))}) AS cut_n
  FROM thinkers CROSS JOIN (SELECT unnest(range(0, 40)) AS k) WHERE length(r) >> k > 0),
cleared AS (SELECT *, len({_toks(_render("''"))}) AS bare_n FROM thinkers),
one AS (
  SELECT {key}, t.i, any_value(t.n) AS n, any_value(t.bare_n) AS bare_n, any_value(t.anchors) AS anchors,
    coalesce((SELECT max(x.chars) FROM tries x WHERE ({_same('x', 't', key)}) AND x.i = t.i
      AND x.anchors - x.n + x.cut_n <= {limit}), 0) AS chars
  FROM cleared t WHERE nth = 1 GROUP BY {key}, t.i),
two AS (
  SELECT {key}, t.i,
    coalesce((SELECT max(x.chars) FROM tries x WHERE ({_same('x', 't', key)}) AND x.i = t.i
      AND x.anchors - one.n + one.bare_n - x.n + x.cut_n <= {limit}), 0) AS chars
  FROM cleared t JOIN one USING ({key}) WHERE t.nth = 2 AND one.chars = 0),
cuts AS (SELECT {key}, i, chars FROM one UNION ALL SELECT {key}, i, chars FROM two),
fitted_turns AS (
  SELECT {key}, c.turn, c.role, c.content, c.tools, c.i,
    CASE WHEN u.chars IS NULL THEN c.r ELSE left(c.r, u.chars::BIGINT) END AS r,
    coalesce(u.chars < length(c.r), false) AS shortened,
    row_number() OVER (PARTITION BY {key} ORDER BY c.i) - 1 AS j
  FROM counted c JOIN chosen h USING ({key}) LEFT JOIN cuts u USING ({key}, i)
  WHERE c.i < h.head OR c.i >= h.start),
fitted AS (
  SELECT *, CASE WHEN j = 0 THEN {_first('r')} ELSE {_render('r')} END AS piece FROM fitted_turns),
lengths AS (
  SELECT {key}, any_value(h.raw) AS raw_length,
    sum(len({_toks('piece')}))::BIGINT AS structured_length,
    least(sum(len({_toks('piece')})), {limit})::BIGINT AS final_length,
    CASE WHEN sum(len({_toks('piece')})) > {limit} THEN 'tokens'
         WHEN bool_or(shortened) THEN 'reasoning'
         WHEN any_value(h.start) > any_value(h.head) THEN 'middle' ELSE 'fits' END AS stage
  FROM fitted JOIN chosen h USING ({key}) GROUP BY {key})"""


def _same(a: str, b: str, key: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in key.split(", "))


def _marked(source: str, key: str, mode: str) -> str:
    """CTEs to ``marked``: one row per token, in loss if any of its characters is."""
    spans = {
        "all": "role = 'assistant'",
        "answer_only": """role = 'assistant' AND NOT (o > 0 AND c > o AND t_start < c + 7)""",
        "answer_plus_think": """role = 'assistant' AND NOT (o > 0 AND c > o
          AND ((t_start >= o - 1 AND t_end <= o + 6) OR (t_start >= c - 1 AND t_end <= c + 7)))""",
    }
    return f"""listed AS (
  SELECT {key}, turn, i, role, strpos(piece, '<think>') AS o, strpos(piece, '</think>') AS c,
    unnest({_toks('piece')}) AS token, generate_subscripts({_toks('piece')}, 1) - 1 AS place
  FROM {source}),
offsets AS (
  SELECT *, sum(length(token)) OVER w AS t_end, sum(length(token)) OVER w - length(token) AS t_start
  FROM listed WINDOW w AS (PARTITION BY {key}, turn ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
marked AS (
  SELECT {key}, turn, i, role, place, token, {spans[mode]} AS in_loss FROM offsets)"""


_ID = "('0x' || substr(md5(token), 1, 15))::BIGINT"


def _cut(key: str, limit: int, side: str) -> str:
    """CTE ``cut``: ids and labels after the token cut."""
    number = "i, place" if side == "right" else "i DESC, place DESC"
    return f"""placed AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {number}) AS spot,
    count(*) OVER (PARTITION BY {key}) AS size
  FROM marked),
closed AS (
  SELECT {key}, i, place,
    CASE WHEN {side == 'right'} AND size > {limit} AND spot = {limit} THEN '<|im_end|>' ELSE token END AS token,
    CASE WHEN {side == 'right'} AND size > {limit} AND spot = {limit} AND token <> '<|im_end|>'
      THEN false ELSE in_loss END AS in_loss
  FROM placed WHERE spot <= {limit}),
cut AS (
  SELECT {key}, string_agg({_ID}, ',' ORDER BY i, place) AS input_ids,
    string_agg(CASE WHEN in_loss THEN {_ID} ELSE -100 END, ',' ORDER BY i, place) AS labels,
    string_agg(token, '' ORDER BY i, place) AS final_text,
    count(*) AS n, count(*) FILTER (WHERE in_loss) AS n_loss
  FROM closed GROUP BY {key})"""


def _samples(key: str, limit: int, side: str = "left", mode: str = "all", filtered: bool = True) -> tuple:
    return (
        _pieces(key),
        _fitted(key, limit, filtered),
        _marked("fitted", key, mode),
        _cut(key, limit, side),
    )


_TURNS = (VARIED, _canonical("varied", "conv_id"))
_DROPPED = (VARIED, _canonical("varied", "conv_id", drop=True))
_FIT = (*_TURNS, _pieces("conv_id"), _fitted("conv_id", TURN_LIMIT))
_PLAIN_FIT = (
    PLAIN,
    _canonical("varied", "conv_id"),
    _pieces("conv_id"),
    _fitted("conv_id", TURN_LIMIT),
)

_SAMPLE_SELECT = """SELECT conv_id, input_ids, labels, n AS n_attended,
  structured_length AS original_length, raw_length FROM cut JOIN lengths USING (conv_id)"""

_REPORT = """odd AS (
  SELECT conv_id, string_agg(role, ',' ORDER BY seen) AS roles FROM (
    SELECT conv_id, role, min(turn) AS seen FROM canon WHERE NOT is_dropped
      AND role NOT IN ('', 'system', 'user', 'assistant', 'tool', 'think') GROUP BY 1, 2)
  GROUP BY conv_id),
report AS (
  SELECT conv_id, 'messages' AS schema, sum(extracted)::BIGINT AS extracted_think,
    sum(moved)::BIGINT AS moved_reasoning, count(*) FILTER (WHERE is_dropped) AS dropped_think,
    any_value(tools) IS NOT NULL AS tools_present,
    bool_or(tools_from_string) AS tools_from_string,
    coalesce(any_value(roles), '') AS unknown_roles
  FROM canon LEFT JOIN odd USING (conv_id) GROUP BY conv_id)"""

_NEIGHBOURS = """asked AS (
  SELECT q.conv_id, q.turn, q.text, coalesce(a.text, '') AS reply
  FROM conversations q LEFT JOIN conversations a
    ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
  WHERE q.role = 'user')"""


def _loss(mode: str) -> str:
    return (
        _with(*_TURNS, _pieces("conv_id"), _marked("pieces", "conv_id", mode))
        + "SELECT conv_id, turn, place, token, in_loss FROM marked"
    )


def _cap(c: str) -> str:
    return f"array_to_string(list_slice({_toks(c)}, 1, 20), '')"


def _percentiles(lengths: str, limit: int) -> str:
    """From a CTE ``lengths(len)``: elements of the sorted list by position."""
    flag = f"(v.label <> 'max' AND length >= {limit})" if limit else "false"
    return f"""{lengths},
ordered AS (SELECT len, row_number() OVER (ORDER BY len) - 1 AS spot, count(*) OVER () AS n FROM lens),
wanted AS (SELECT unnest(['p25', 'p50', 'p75', 'p90', 'p95', 'p99', 'max']) AS label,
                  unnest([25, 50, 75, 90, 95, 99, 100]) AS p)
SELECT v.label, v.length, {flag} AS at_max FROM (
  SELECT label, len::BIGINT AS length FROM ordered JOIN wanted
    ON spot = floor((p / 100.0::DOUBLE) * (n - 1))::BIGINT) v"""


_LENS = _with(*_PLAIN_FIT) + ", lens AS (SELECT final_length AS len FROM lengths)"

_EX_FIRST = f"""joined AS (
  SELECT conv_id,
    string_agg(CASE WHEN i = 0 THEN first_piece ELSE piece END, '' ORDER BY i) AS rendered
  FROM pieces GROUP BY conv_id)"""

_HEAD = f"""('<|im_start|>system' || {_NL} || '{DEFAULT_SYSTEM}' || '<|im_end|>' || {_NL})"""
_SAID = f"CASE WHEN role IN ('user', 'assistant') THEN {_trim('content')} ELSE content END"
_HISTORY = (
    f"""said AS (SELECT * REPLACE ({_SAID} AS content) FROM canon WHERE NOT is_dropped),
history AS (SELECT conv_id, turn, role, {_render('r')} AS piece FROM said
  WHERE NOT (role = 'user' AND content = '')),
placed AS (SELECT *, len({_toks('piece')}) AS n, sum(len({_toks('piece')})) OVER
    (PARTITION BY conv_id ORDER BY turn) AS until FROM history),
heads AS (SELECT conv_id, CASE WHEN min_by(role, turn) = 'system' THEN min(turn) END AS head_turn,
    CASE WHEN min_by(role, turn) = 'system' THEN min_by(piece, turn) ELSE {_HEAD} END AS head
  FROM placed GROUP BY conv_id),
later AS (SELECT p.*, head, len({_toks('head')}) + 3 AS fixed FROM placed p JOIN heads USING (conv_id)
  WHERE head_turn IS NULL OR turn <> head_turn),
ranges AS (SELECT u.conv_id, u.turn, min(c.turn) AS first_turn
  FROM later u JOIN later c ON u.conv_id = c.conv_id AND c.turn <= u.turn
  WHERE u.role = 'user' AND (c.turn = u.turn OR u.until - c.until + c.n + u.fixed <= {HISTORY_BUDGET})
  GROUP BY ALL)""",
)


ORACLES: dict[str, str] = {
    "assemble": f"""SELECT conv_id, rank // 4096 AS part, count(*) AS n_messages,
  string_agg(role || ': ' || text, {_NL} ORDER BY turn) AS messages_text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rank FROM conversations)
GROUP BY 1, 2""",
    "explode": """SELECT conv_id,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
  role, text AS content FROM conversations""",
    "detect_schema": """SELECT conv_id, 0::BIGINT AS turn, 'messages' AS schema
FROM (SELECT DISTINCT conv_id FROM conversations)
UNION ALL SELECT conv_id, turn, 'prompt_response' FROM conversations WHERE role = 'user'
UNION ALL SELECT conv_id, turn, 'unknown' FROM conversations WHERE role = 'system'""",
    "pairs": _with(_NEIGHBOURS)
    + """SELECT conv_id, turn, 'prompt_response' AS schema, text AS user_text,
  reply AS assistant_text FROM asked""",
    "clean_messages": _with(VARIED, _canonical("varied", "conv_id", think=False))
    + "SELECT conv_id, turn, role, content FROM canon",
    "reasoning_norm": _with(VARIED, _canonical("varied", "conv_id", think=False))
    + "SELECT conv_id, turn, r AS reasoning_content, moved FROM canon",
    "think_extract": _with(*_TURNS)
    + "SELECT conv_id, turn, content, r AS reasoning_content, extracted FROM canon",
    "think_cap": _with(*_TURNS)
    + f"""SELECT conv_id, turn, role,
  CASE WHEN role = 'think' THEN {_cap('content')} ELSE content END AS content,
  CASE WHEN r IS NOT NULL THEN {_cap('r')} END AS reasoning_content FROM canon""",
    "think_policy": _with(VARIED, _canonical("varied", "conv_id", drop=True))
    + """SELECT conv_id, turn, role, content, r AS reasoning_content
FROM canon WHERE NOT is_dropped""",
    "tools_norm": _with(*_TURNS)
    + """SELECT DISTINCT conv_id, tools, tools_from_string FROM canon""",
    "unknown_roles": _with(*_TURNS)
    + """SELECT conv_id, role, min(turn) AS first_seen FROM canon
WHERE role NOT IN ('', 'system', 'user', 'assistant', 'tool', 'think') GROUP BY 1, 2""",
    "turn_report": _with(VARIED, _canonical("varied", "conv_id", drop=True))
    + f"""SELECT conv_id, sum(extracted)::BIGINT AS extracted_think,
  sum(moved)::BIGINT AS moved_reasoning, count(*) FILTER (WHERE is_dropped) AS dropped_think,
  count(*) FILTER (WHERE NOT is_dropped) AS n_messages,
  sum(CASE WHEN NOT is_dropped THEN len({_toks(_render('r'))}) END)::BIGINT AS total_tokens
FROM canon GROUP BY conv_id""",
    "parse_report": _with(*_DROPPED, _REPORT) + "SELECT * FROM report",
    "parse_summary": _with(*_DROPPED, _REPORT)
    + """, every AS (
  SELECT schema, extracted_think, moved_reasoning, dropped_think, tools_present, tools_from_string FROM report
  UNION ALL SELECT CASE role WHEN 'user' THEN 'prompt_response' ELSE 'unknown' END, 0, 0, 0, false, false
  FROM conversations WHERE role IN ('user', 'system'))
SELECT schema, count(*) AS n_rows, sum(extracted_think)::BIGINT AS extracted_think,
  sum(moved_reasoning)::BIGINT AS moved_reasoning, sum(dropped_think)::BIGINT AS dropped_think,
  count(*) FILTER (WHERE tools_present) AS tools_present,
  count(*) FILTER (WHERE tools_from_string) AS tools_from_string,
  avg(tools_present::INT::DOUBLE) AS tools_share FROM every GROUP BY schema""",
    "unknown_role_counts": _with(*_TURNS)
    + """SELECT 'messages' AS schema, role, count(DISTINCT conv_id) AS n_conversations FROM canon
WHERE role NOT IN ('', 'system', 'user', 'assistant', 'tool', 'think') GROUP BY role""",
    "rendered": _with(*_TURNS, _pieces("conv_id"))
    + "SELECT conv_id, turn, piece AS rendered FROM pieces",
    "rendered_tools": _with(*_TURNS, _pieces("conv_id"), _EX_FIRST) + "SELECT * FROM joined",
    "token_counts": f"""SELECT conv_id, count(*) AS n_messages,
  sum(len({_toks(f"('<|im_start|>' || role || {_NL} || text || '<|im_end|>' || {_NL})")}))::BIGINT AS total_tokens
FROM conversations GROUP BY conv_id""",
    "exchange_token_counts": _with(*_TURNS, _pieces("conv_id"), _EX_FIRST)
    + f"SELECT conv_id, len({_toks('rendered')})::BIGINT AS total_tokens FROM joined",
    "token_ids": f"""SELECT token, {_ID}::BIGINT AS token_id FROM (SELECT DISTINCT
  unnest({_toks(f"('<|im_start|>' || role || {_NL} || text || '<|im_end|>' || {_NL})")}) AS token
  FROM conversations)""",
    "role_spans": _with(*_TURNS, _pieces("conv_id"))
    + """SELECT conv_id, turn, role,
  (sum(length(piece)) OVER w - length(piece))::BIGINT AS span_start,
  (sum(length(piece)) OVER w)::BIGINT AS span_end
FROM pieces WINDOW w AS (PARTITION BY conv_id ORDER BY turn
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "token_offsets": _with(
        *_TURNS,
        _pieces("conv_id"),
        f"""listed AS (SELECT conv_id, turn, unnest({_toks('piece')}) AS token,
  (generate_subscripts({_toks('piece')}, 1) - 1)::BIGINT AS place FROM pieces)""",
    )
    + """SELECT conv_id, turn, place, token,
  (sum(length(token)) OVER w - length(token))::BIGINT AS token_start,
  (sum(length(token)) OVER w)::BIGINT AS token_end
FROM listed WINDOW w AS (PARTITION BY conv_id ORDER BY turn, place
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "anchors": _with(*_FIT)
    + """SELECT h.conv_id, h.head::BIGINT AS head, t.turn AS tail_turn, l.turn AS last_assistant_turn
FROM chosen h JOIN counted t ON t.conv_id = h.conv_id AND t.i = h.tail
JOIN counted l ON l.conv_id = h.conv_id AND l.i = h.last""",
    "drop_middle": _with(*_FIT)
    + """SELECT h.conv_id, h.raw AS raw_total, h.over, (h.start - h.head)::BIGINT AS dropped,
  c.turn AS first_kept_turn
FROM chosen h JOIN counted c ON c.conv_id = h.conv_id AND c.i = h.start""",
    "shard_plan": _with(*_TURNS, *_samples("conv_id", TURN_LIMIT))
    + """, buckets AS (
  SELECT ('0x' || substr(md5(conv_id::VARCHAR), 1, 4))::INT AS bucket, sum(n)::DOUBLE AS tokens
  FROM cut GROUP BY 1),
middles AS (
  SELECT bucket, sum(tokens) OVER (ORDER BY bucket) - tokens / 2 AS middle, sum(tokens) OVER () AS total
  FROM buckets)
SELECT least(floor(middle * 4 / total), 3)::BIGINT AS shard, count(*) AS n_rows, sum(n)::BIGINT AS n_tokens
FROM cut JOIN middles ON bucket = ('0x' || substr(md5(conv_id::VARCHAR), 1, 4))::INT GROUP BY 1""",
    "history_prompts": _with(*_TURNS, *_HISTORY)
    + """SELECT conv_id, r.turn, r.first_turn, count(*) AS n_turns,
  (sum(n) + any_value(fixed))::BIGINT AS n_tokens,
  any_value(head) || string_agg(piece, '' ORDER BY l.turn) || '<|im_start|>assistant' || chr(10) AS prompt
FROM ranges r JOIN later l USING (conv_id) WHERE l.turn BETWEEN r.first_turn AND r.turn
GROUP BY conv_id, r.turn, r.first_turn""",
    "turn_cuts": _with(*_FIT)
    + """SELECT h.conv_id, h.raw AS raw_total, h.over, (h.start - h.head)::BIGINT AS dropped,
  c.turn AS first_kept_turn
FROM chosen h JOIN counted c ON c.conv_id = h.conv_id AND c.i = h.start""",
    "halve_reasoning": _with(*_FIT)
    + f"""SELECT conv_id, turn, r AS reasoning_content,
  len({_toks('piece')})::BIGINT AS n_tokens FROM fitted""",
    "trace": _with(*_FIT)
    + "SELECT conv_id, raw_length, structured_length, final_length, stage FROM lengths",
    "truncate_left": _with(
        *_TURNS, *_samples("conv_id", TURN_LIMIT, "left", "answer_plus_think", filtered=False)
    )
    + _SAMPLE_SELECT,
    "truncate_right": _with(
        *_TURNS, *_samples("conv_id", TURN_LIMIT, "right", "answer_only", filtered=False)
    )
    + _SAMPLE_SELECT,
    "loss_all": _loss("all"),
    "loss_answer_only": _loss("answer_only"),
    "loss_answer_plus_think": _loss("answer_plus_think"),
    "token_labels": _with(
        *_TURNS,
        _pieces("conv_id"),
        """whole AS (SELECT * REPLACE (CASE WHEN i = 0 THEN first_piece ELSE piece END AS piece)
  FROM pieces)""",
        _marked("whole", "conv_id", "answer_only"),
    )
    + """SELECT conv_id, i AS message_index, role, place, token, in_loss FROM marked""",
    "samples": _with(*_TURNS, *_samples("conv_id", TURN_LIMIT)) + _SAMPLE_SELECT,
    "exchange_samples": _with(*_TURNS, *_samples("conv_id", LIST_LIMIT)) + _SAMPLE_SELECT,
    "sample_stats": _with(*_TURNS, *_samples("conv_id", TURN_LIMIT))
    + """SELECT conv_id, n AS total_tokens, n_loss AS loss_tokens, n < raw_length AS was_truncated
FROM cut JOIN lengths USING (conv_id)""",
    "debug": _with(*_TURNS, _REPORT, *_samples("conv_id", LIST_LIMIT, filtered=False))
    + """SELECT conv_id, schema, tools_present, extracted_think, unknown_roles,
  raw_length, structured_length, n AS final_length, n_loss AS loss_tokens, final_text
FROM report JOIN cut USING (conv_id) JOIN lengths USING (conv_id)
ORDER BY conv_id LIMIT 20""",
    "len_hist": _LENS + " SELECT len AS length, count(*) AS n_samples FROM lens GROUP BY len",
    "len_pct": _percentiles(_LENS, TURN_LIMIT),
    "utilisation": _LENS
    + f""",
buckets AS (SELECT * FROM (VALUES ('< 25%', 0.0, {TURN_LIMIT * 0.25}),
  ('25-50%', {TURN_LIMIT * 0.25}, {TURN_LIMIT * 0.5}), ('50-75%', {TURN_LIMIT * 0.5}, {TURN_LIMIT * 0.75}),
  ('75-99%', {TURN_LIMIT * 0.75}, {TURN_LIMIT - 1.0}), ('at max', {float(TURN_LIMIT)}, 1e300)) v(bucket, lo, hi)),
shares AS (SELECT bucket, count(*) FILTER (WHERE len BETWEEN lo AND hi) AS n_samples,
  count(*) FILTER (WHERE len BETWEEN lo AND hi)::DOUBLE / count(*) AS ratio
  FROM buckets CROSS JOIN lens GROUP BY bucket)
SELECT bucket, n_samples, ratio, repeat('█', round_even(ratio * 20, 0)::INT)
  || repeat('░', 20 - round_even(ratio * 20, 0)::INT) AS bar FROM shares""",
    "trunc_summary": _LENS
    + f""" SELECT count(*) AS n, count(*) FILTER (WHERE len >= {TURN_LIMIT}) AS truncated,
  count(*) FILTER (WHERE len < {TURN_LIMIT}) AS not_truncated,
  count(*) FILTER (WHERE len >= {TURN_LIMIT})::DOUBLE / count(*) AS truncated_share,
  count(*) FILTER (WHERE len < {TURN_LIMIT})::DOUBLE / count(*) AS not_truncated_share FROM lens""",
    "raw_len": _with(*_PLAIN_FIT)
    + """SELECT max(structured_length) AS dataset_max, max(final_length) AS final_max,
  count(*) AS n_samples FROM lengths""",
    "advice": _LENS
    + f""", shares AS (SELECT count(*) FILTER (WHERE len >= {TURN_LIMIT})::DOUBLE / count(*) AS at_max_share,
  count(*) FILTER (WHERE len <= {TURN_LIMIT} * 0.25)::DOUBLE / count(*) AS short_share FROM lens HAVING count(*) > 0)
SELECT *, CASE WHEN at_max_share > 0.30 THEN 'raise max_length or filter long samples'
  WHEN short_share > 0.50 THEN 'lower max_length' ELSE 'keep max_length' END AS advice FROM shares""",
    "role_totals": _with(*_TURNS, _pieces("conv_id"), _marked("pieces", "conv_id", "answer_only"))
    + """SELECT role, count(DISTINCT (conv_id, turn)) AS n_messages, count(*) AS tokens,
  count(*) FILTER (WHERE in_loss) AS loss_tokens FROM marked GROUP BY role""",
    "tools_overhead": _with(*_TURNS, _pieces("conv_id"))
    + f""", costs AS (SELECT conv_id,
    sum(len({_toks("CASE WHEN i = 0 THEN first_piece ELSE piece END")})) AS total_tokens,
    sum(len({_toks("CASE WHEN i = 0 THEN first_piece ELSE piece END")})) - sum(len({_toks('piece')})) AS cost
  FROM pieces GROUP BY conv_id)
SELECT cost > 0 AS tools_present, count(*) AS n_conversations, sum(cost)::BIGINT AS added_tokens,
  avg(cost)::DOUBLE AS mean_added, max(cost)::BIGINT AS max_added,
  avg((total_tokens >= {TURN_LIMIT})::INT)::DOUBLE AS at_max_share FROM costs GROUP BY 1""",
    "token_freq": f"""WITH counted AS (SELECT token, count(*) AS n, {_ID} AS token_id FROM (SELECT
  unnest({_toks(f"('<|im_start|>' || role || {_NL} || text || '<|im_end|>' || {_NL})")}) AS token
  FROM conversations) GROUP BY token)
SELECT *, count(*) OVER (PARTITION BY token_id) AS n_same_id FROM counted""",
    "gen_prompts": _with(*_TURNS, _pieces("conv_id"), _EX_FIRST)
    + f"""SELECT conv_id, rendered || '<|im_start|>assistant' || {_NL} || '<think>' || {_NL}
  || {_NL} || '</think>' || {_NL} || {_NL} AS generation_prompt FROM joined""",
    "text_prompts": f"""SELECT item_id, '<|im_start|>system' || {_NL} || '{DEFAULT_SYSTEM}'
  || '<|im_end|>' || {_NL} || '<|im_start|>user' || {_NL} || text || '<|im_end|>' || {_NL}
  || '<|im_start|>assistant' || {_NL} AS generation_prompt FROM benchmark""",
    "rendered_lengths": _percentiles(
        _with(
            f"""lens AS (SELECT sum(len({_toks(f"('<|im_start|>' || role || {_NL} || text || '<|im_end|>' || {_NL})")}))
  AS len FROM conversations GROUP BY conv_id)"""
        ),
        0,
    ),
}
ORACLES["external_samples"] = ORACLES["exchange_samples"]
